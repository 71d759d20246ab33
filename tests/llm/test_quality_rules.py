"""Counts and verdicts against plain Python."""

import re
from collections import Counter

from spikewatch.llm.quality_rules import judge_documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if seen[w] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
        failed,
    )


def test_counts(make_docs, prose):
    texts = [
        None,
        "",
        " \n\t ",
        "a b c a b c a b",
        "a a a a",
        "x y z",
        prose(1, 49) + ".",
        prose(1, 50) + ".",
        "same line here.\nsame line here.\n\n \nsame line here. ",
        prose(2, 300, 12) + ".",
        "né e # * $ % & | < > 😀 \x0b\x0c\r ü",
        prose(3, 20_000) + ".",
        prose(2, 300, 12) + ".",
    ]
    rows = judge_documents(make_docs(list(enumerate(texts)))).orderBy("doc_id").collect()
    for row, text in zip(rows, texts, strict=True):
        q = row.quality
        got = (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words, q.base_failed)
        assert got == base(text), text and text[:40]
        assert row.kept == "y" and row.chunk == "x"


def test_verdicts(make_docs, prose):
    good = "\n".join(prose(n, 30) + "." for n in range(4))
    bars = " | ".join(prose(9, 120).split())
    cases = [
        (good, True, good),
        # Lines that fail go; enough is left.
        (good + "\nHome | About | Contact", True, good),
        (good + "\nPlease accept cookies.", True, good),
        (good + "\n" + " ".join(w + "%%%" for w in prose(5, 20).split()) + ".", True, good),
        # Too much goes.
        (good + "\n" + bars + ".\n" + bars + ".", False, None),
        (good.upper().replace(" ", "!! ") + "!!", False, None),
        (prose(6, 200), False, None),
        (prose(7, 100) + ". " + prose(8, 100), True, None),
        (prose(8, 49) + ".", False, None),
        (None, False, ""),
        ("", False, ""),
    ]
    docs = make_docs([(n, text) for n, (text, _, _) in enumerate(cases)])
    rows = judge_documents(docs).orderBy("doc_id").collect()
    for row, (_, kept, cleaned) in zip(rows, cases, strict=True):
        assert row.quality.kept == kept, row.text
        assert cleaned is None or row.quality.cleaned == cleaned


def test_filters_stay_above_the_steps(make_docs, prose):
    """A filter on the verdict must not be written out in terms of all steps below it."""
    judged = judge_documents(make_docs([(1, prose(1, 80) + ".")])).filter("quality.kept")
    assert judged.count() == 1
    assert "Generate explode(array(" in judged._jdf.queryExecution().optimizedPlan().toString()


def test_empty_table(make_docs):
    assert judge_documents(make_docs([])).collect() == []
