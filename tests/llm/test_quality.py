"""Quality rules against plain Python, and the cascade's order and short circuit."""

from __future__ import annotations

import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from skyground.llm import quality_rules as q
from tests.llm.conftest import SCHEMA, sentence


def measured(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
    m = {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }
    n = m["n_words"]
    base = n < 20 or 100 * m["n_repeat_words"] > 30 * n
    letterless = sum(not any(c.isalpha() for c in w) for w in words)
    bullets = sum(bool(re.match(r"[\x20\x09-\x0D]*[-*•‣▪●][\x20\x09-\x0D]", x)) for x in lines)
    dots = sum(x.rstrip(" \t\x0b\x0c\r").endswith(("...", "…")) for x in lines)
    bad = base or not 3 * n <= m["word_chars"] <= 10 * n or 10 * m["n_symbols"] > n or 100 * m["n_dup_lines"] > 30 * len(lines)
    bad = bad or 100 * letterless > 20 * n or 100 * bullets > 90 * len(lines) or 100 * dots > 30 * len(lines)
    return {**m, "base_failed": base, "kept": not bad}


PROSE = "the quiet river bends around an old stone mill where seven grey herons wait for fish until evening falls over meadows"
TEXTS = [
    None,
    "",
    " \n\t ",
    PROSE,
    PROSE + " " + PROSE,
    f"{PROSE}\n{PROSE} again and then something else entirely follows here\n{PROSE}",
    # Overlapping repeats, and windows that repeat only where they overlap themselves.
    "a b " * 30,
    "w " * 9,
    "one two three four five six seven eight one two three four five six seven",
    "\n".join(f"- {w} of the list here" for w in PROSE.split()),
    "\n".join(f"{w} and so on ... \t" for w in PROSE.split()),
    "\n".join(f"{w} and so on…" for w in PROSE.split()),
    "\n".join(["same line here"] * 9 + [PROSE]),
    PROSE.replace(" ", "# "),
    "12 34 " * 3 + PROSE + " 5 6 7 8 9 10 11",
    "naïve café ÅNGSTRÖM 中文 слово 😀 ٣٤ " + PROSE,
    "x\x0by\x0cz\r\n" + PROSE + "\xa0tail end",
    "supercalifragilistic " * 25,
    "i " * 25,
]


@pytest.fixture
def texts(spark):
    rows = [(i, t, "en", "a", 1) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, rows[4], (None, PROSE, None, None, None)], SCHEMA)


def check(rows):
    for r in rows:
        want = measured(r.text)
        assert {k: r[k] for k in want} == want, r.text and r.text[:60]
        assert r.kept == (r.rejected_by is None)


def test_report_is_plain_pythons(spark, texts, documents, clashing, nothing):
    out = q.report(texts).collect()
    assert len(out) == len(TEXTS) + 2
    check(out)
    assert any(r.kept for r in out) and {r.rejected_by for r in out} >= {"few_words", "bullets", "ellipses", "symbols"}
    check(q.report(documents).collect())
    odd = clashing.withColumns({c: F.lit("x") for c in ("_words", "_text", "N_WORDS", "rejected_by", "_rejected", "_lines")})
    out = q.report(odd)
    assert set(out.columns) == {*[c for c in odd.columns if c not in ("N_WORDS", "kept", "rejected_by")], *q.RESULTS}
    check(out.collect())
    assert q.report(nothing).count() == 0 and q.judge(nothing).count() == 0


def test_judge_keeps_what_report_keeps_in_any_order(spark, texts):
    want = Counter((r.doc_id, r.kept) for r in q.report(texts).collect())
    assert Counter((r.doc_id, r.kept) for r in q.judge(texts).collect()) == want
    boxed, _ = q._boxed(texts)
    for rules in (q.RULES, q.RULES[::-1]):
        got = q._cascade(boxed, rules).select("_box.doc_id", F.col("rejected_by").isNull().alias("kept")).collect()
        assert Counter((r.doc_id, r.kept) for r in got) == want


def test_order_is_by_rejection_per_cost():
    rules = [
        q.Rule("costly", ("n_repeat_words",), "true"),
        q.Rule("cheap", ("n_symbols",), "true"),
        q.Rule("same_rows", ("n_lines",), "true"),
        q.Rule("shares", ("n_repeat_words",), "true"),
    ]
    seconds = {"_words": 1.0, "n_repeat_words": 9.0, "n_symbols": 1.0, "_lines": 0.5, "n_lines": 0.5}
    # Bit 0: costly, 1: cheap, 2: same_rows, 3: shares.
    found = q.Estimate(seconds, {0b0001: 100, 0b0110: 40, 0b0010: 10, 0b1000: 5, 0: 500})
    # cheap rejects 50 a second; what same_rows would reject is gone then, so the costly one and what shares its measure come first.
    assert [r.name for r in q.ordered(rules, found)] == ["cheap", "costly", "shares", "same_rows"]


def test_dead_rows_cost_nothing(spark, texts):
    boxed, _ = q._boxed(texts)
    rows = q._cascade(boxed, q.RULES).collect()
    for r in rows:
        if r.rejected_by == "few_words":
            assert r.n_repeat_words is None and r.n_bullets is None and r._lines is None
        if r.rejected_by is None:
            assert r.n_ellipses is not None


def test_estimate_counts_and_times(spark, texts):
    boxed, _ = q._boxed(texts)
    found = q.estimate(boxed, q.RULES)
    assert sum(found.combinations.values()) == len(TEXTS) + 2
    assert set(found.seconds) == set(q.MEASURES) and all(s > 0 for s in found.seconds.values())
    some = q.estimate(boxed, q.RULES, q.BASE)
    assert not set(some.seconds) & {*q.BASE, "_words", "_lines"}


def test_very_long_texts(spark):
    """Ten megabytes each: no repeats, one long word without a letter, and one line repeated throughout."""
    line = sentence(5, 40) + "\n"
    texts = [sentence(1, 1_300_000), "1" * 10_000_000, line * (10_000_000 // len(line))]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    began = time.monotonic()
    boxed, _ = q._boxed(docs)
    out = {r.doc_id: r for r in q._add(boxed, [*q.BASE, "n_letterless"]).select("_box.doc_id", *q.BASE, "n_letterless").collect()}
    assert time.monotonic() - began < 90
    assert out[0].n_words == 1_300_000 and out[0].n_repeat_words < 100
    assert (out[1].n_words, out[1].n_letterless, out[1].word_chars) == (1, 1, 10_000_000)
    assert out[2].n_repeat_words == out[2].n_words and out[2].n_dup_lines == len(texts[2]) // len(line) - 1
