import json

import pytest
from pyspark.sql import functions as F

from spikewatch.functions.numbers import plain_decimal, round_cents, round_table
from spikewatch.sources.lines import read_lines, stream_lines
from spikewatch.sources.requests import (
    accepted,
    late_line,
    parse_requests,
    reject_counts,
    rejected,
    request_line,
)

TIME = '"timestamp":"2026-03-23T18:00:00Z"'


def parse(spark, *lines):
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    return parse_requests(df)


def one(spark, line):
    return parse(spark, line).first()


def test_plain_request(spark):
    line = f'{{"ride_id":"r1","zone_id":"Downtown",{TIME},"is_simulated_late":true}}'
    r = one(spark, line)
    assert (r.ride_id, r.zone_id, r.timestamp) == ("r1", "Downtown", "2026-03-23T18:00:00Z")
    assert (r.event_time_millis, r.is_simulated_late, r.reject_reason) == (
        1774288800000,
        True,
        None,
    )


@pytest.mark.parametrize(
    "text, millis",
    [
        ("2026-03-23T18:00:00", 1774288800000),
        ("2026-03-23T18:00:00.25Z", 1774288800250),
        ("2026-03-23T18:00:00.123987Z", 1774288800123),
        ("2026-03-23T20:00:00+02:00", 1774288800000),
        ("2026-03-23", 1774224000000),
    ],
)
def test_event_time_text(spark, text, millis):
    line = json.dumps({"ride_id": "r", "zone_id": "z", "timestamp": text})
    assert one(spark, line).event_time_millis == millis


@pytest.mark.parametrize(
    "value, millis",
    [
        ("12", 12),
        ("12.7", 12),
        ("-12.7", -12),
        ('"34"', 34),
        ('" 34 "', 34),
        ("true", 1),
        ("1.774e12", 1774000000000),
        ("null", 1774288800000),
    ],
)
def test_explicit_event_time_wins(spark, value, millis):
    line = f'{{"ride_id":"r","zone_id":"z",{TIME},"event_time_millis":{value}}}'
    assert one(spark, line).event_time_millis == millis


@pytest.mark.parametrize(
    "value, flag",
    [
        ("true", True),
        ("false", False),
        ('"false"', True),
        ('"0"', True),
        ('""', False),
        ("0", False),
        ("0.0", False),
        ("2", True),
        ("null", False),
        ("[]", False),
        ("{}", False),
        ('[""]', True),
    ],
)
def test_flag_truth(spark, value, flag):
    line = f'{{"ride_id":"r","zone_id":"z",{TIME},"is_simulated_late":{value}}}'
    assert one(spark, line).is_simulated_late is flag


@pytest.mark.parametrize(
    "line, reason",
    [
        ('{"ride_id":"r"', "Malformed JSON"),
        ("not json", "Malformed JSON"),
        ("[]", "Malformed JSON"),
        ("5", "Malformed JSON"),
        ("null", "Malformed JSON"),
        ("{'ride_id':'r'}", "Malformed JSON"),
        (f'{{"ride_id":"r","zone_id":"z",{TIME}}} tail', "Malformed JSON"),
        (f'{{"ride_id":"r","zone_id":"z",{TIME}}}{{"a":1}}', "Malformed JSON"),
        (f'{{"ride_id":"r","zone_id":"z",{TIME}}},{{"a":1}}', "Malformed JSON"),
        (f'{{"ride_id":"r","zone_id":"z",{TIME}}}}}', "Malformed JSON"),
        ("{}", "Missing required event fields: ride_id, timestamp, zone_id"),
        (f'{{"ride_id":null,"zone_id":"z",{TIME}}}', "Missing required event fields: ride_id"),
        ('{"ride_id":"r","zone_id":"z","timestamp":"soon"}', "Unreadable event time"),
        (
            f'{{"ride_id":"r","zone_id":"z",{TIME},"event_time_millis":"12.5"}}',
            "Unreadable event time",
        ),
        (f'  {{"ride_id":"r","zone_id":"z",{TIME}}}  ', None),
        (f'{{"ride_id":"}}","zone_id":"a}}{{",{TIME}}}', None),
        (f'{{"ride_id":"r\\"}}","zone_id":"z","x":{{"y":[{{}},{{"q":1}}]}},{TIME}}}', None),
    ],
)
def test_reject_reason(spark, line, reason):
    assert one(spark, line).reject_reason == reason


def test_quarantine_and_failfast(spark):
    good = f'{{"ride_id":"r","zone_id":"z",{TIME}}}'
    parsed = parse(spark, good, "junk", good, "{}")
    assert accepted(parsed).count() == 2
    assert {r.value for r in rejected(parsed).collect()} == {"junk", "{}"}
    assert {(r.reject_reason, r.lines) for r in reject_counts(parsed).collect()} == {
        (None, 2),
        ("Malformed JSON", 1),
        ("Missing required event fields: ride_id, timestamp, zone_id", 1),
    }
    with pytest.raises(Exception, match="Malformed JSON"):
        # Even when no column of the bad row is asked for.
        accepted(parse(spark, good, "junk"), failfast=True).select(F.lit(1)).collect()
    assert accepted(parse(spark, good), failfast=True).count() == 1


def test_lines_skip_blanks(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a":1}\n\n   \n\t\n \nx\n', encoding="utf-8")
    assert [r.value for r in read_lines(spark, str(tmp_path)).collect()] == ['{"a":1}', "x"]
    assert stream_lines(spark, "text", path=str(tmp_path)).isStreaming
    with pytest.raises(ValueError):
        stream_lines(spark, "socket", host="localhost", port="0")


def test_request_and_late_lines(spark):
    parsed = accepted(parse(spark, f'{{"ride_id":"é","zone_id":"z",{TIME}}}'))
    line = parsed.select(request_line()).first()[0]
    assert json.loads(line) == {
        "event_time_millis": 1774288800000,
        "is_simulated_late": False,
        "ride_id": "é",
        "timestamp": "2026-03-23T18:00:00Z",
        "zone_id": "z",
    }
    assert line.isascii() and list(json.loads(line)) == sorted(json.loads(line))
    assert parsed.select(late_line()).first()[0] == (
        "LATE_EVENT | zone=z | ride_id=é | timestamp=2026-03-23T18:00:00Z"
        " | is_simulated_late=false"
    )


def test_rounding_rules(spark):
    xs = [2.675, 2.665, 1.005, 0.125, 0.375, 8.125, 1.115, 33.335, 1234567.125, 99999999.995]
    xs += [i / 1000 + 1 for i in range(0, 4000, 5)] + [72.8, 95.84, 1e7, 12345678.9, 60.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    x = F.col("x")
    rows = df.select(x, round_cents(x), round_table(x, 1), plain_decimal(round_cents(x))).collect()
    for value, cents, tenth, text in rows:
        assert cents == round(value, 2), value
        assert text == repr(round(value, 2)), value
        scaled = value * 10
        assert tenth == round(scaled) / 10, value
