"""Lines of files that grow: nothing lost, nothing twice, torn lines wait."""

import io
import os

import pytest

from spikewatch.sources import growing
from spikewatch.sources.growing import BEGINNING, ByteRange, GrowingLinesReader, lines_in
from spikewatch.sources.lines import stream_lines


def drain(spark, tmp_path, **options):
    got, sizes = [], []

    def keep(batch, _):
        rows = [r.value for r in batch.collect()]
        got.extend(rows)
        sizes.append(len(rows))

    lines = stream_lines(spark, "growing_lines", path=str(tmp_path / "in"), **options)
    query = (
        lines.writeStream.option("checkpointLocation", str(tmp_path / "cp")).foreachBatch(keep).start()
    )
    query.processAllAvailable()
    query.stop()
    return got, [n for n in sizes if n]


def test_appended_lines_and_a_restart(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    with open(folder / "a.json", "a") as file:
        file.write("one\n\ntwo\r\nto")
        file.flush()
        assert drain(spark, tmp_path)[0] == ["one", "two"]
        file.write("rn\nthree\n")
    assert drain(spark, tmp_path)[0] == ["torn", "three"]
    with open(folder / "a.json", "a") as file:
        file.write("last of a")
    (folder / "b.json").write_text("of b\ntorn again")
    (folder / "_hidden").write_text("no\n")
    assert drain(spark, tmp_path)[0] == ["last of a", "of b"]
    assert drain(spark, tmp_path)[0] == []


def test_a_batch_per_folder(spark, tmp_path):
    for n in range(3):
        os.makedirs(tmp_path / "in" / f"part={n}")
        for name in "ab":
            (tmp_path / "in" / f"part={n}" / name).write_text(f"{n}{name}\n")
    options = {"folderPerBatch": "true", "checkpoint": str(tmp_path / "cp")}
    assert drain(spark, tmp_path, **options)[1] == [2, 2, 2]
    os.makedirs(tmp_path / "in" / "part=3")
    (tmp_path / "in" / "part=3" / "a").write_text("3a\n")
    assert drain(spark, tmp_path, **options)[0] == ["3a"]


@pytest.mark.parametrize("block", [1, 3, 1000])
@pytest.mark.parametrize("text", [b"", b"\n", b"a\n\nbc\nd", b"ab\ncd\n", b"abcdefgh\ni\n"])
def test_ranges_share_lines_out(monkeypatch, block, text):
    monkeypatch.setattr(growing, "BLOCK_BYTES", block)
    expected = text.split(b"\n")[:-1] + ([text.split(b"\n")[-1]] if text.split(b"\n")[-1] else [])
    for width in range(1, len(text) + 2):
        got = []
        for start in range(0, len(text), width):
            part = ByteRange("f", start, min(start + width, len(text)), len(text), start == 0)
            got += [line for lines in lines_in(io.BytesIO(text), part) for line in lines]
        assert got == expected, width


def test_positions(tmp_path, monkeypatch):
    monkeypatch.setattr(growing, "TAIL_BYTES", 2)
    reader = GrowingLinesReader({"path": str(tmp_path / "in")})
    assert reader.latestOffset() == BEGINNING
    (tmp_path / "in").mkdir()
    file = tmp_path / "in" / "a"
    file.write_text("no line yet")
    assert reader.latestOffset() == {"file": str(file), "bytes": 0}
    file.write_text("ab\ncdefgh")
    end = reader.latestOffset()
    assert end == {"file": str(file), "bytes": 3}
    reader.partitions(BEGINNING, end)
    file.write_text("a")
    with pytest.raises(ValueError, match="shorter"):
        reader.latestOffset()
    with pytest.raises(ValueError, match="checkpoint"):
        GrowingLinesReader({"path": "x", "folderperbatch": "true"})
