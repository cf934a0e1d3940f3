"""Quality rules as a short-circuit cascade ordered by rejection per cost.

A rule compares measures of a text. On a sample each measure is timed and the rules each row breaks are counted as
combinations; the order is then chosen step by step: next comes the rule that rejects most of the sample's rows still
alive per second that its measures, as far as no rule before needed them, take. Along the cascade a row is dead with the
first rule it breaks, and no later measure is computed for it. The order decides what is computed and which broken rule is named, never
what is kept: all rows pass the same rules. The sample is about ``SAMPLE_ROWS`` rows, drawn from all of the table.

All measures are column expressions over whole texts; arrays of a text live in its row, nothing is shuffled. Work grows with a
text's length, times its logarithm where eight-word windows repeat. Windows are compared by 64-bit hashes.

Defined cases: null text has no words and no lines, and breaks the first rule; rows that repeat are judged each; ids may be null; an empty
table gives no rows. Columns of the documents are carried unless they have a result's name, whatever working columns are called.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyground.functions.variant import with_computed
from skyground.llm.common import boxed, others, staged, unboxed

# What stands between words, and what does not.
BLANK, WORD, BLANKS = r"\x20\x09-\x0D", r"[^\x20\x09-\x0D]", " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
SAMPLE_ROWS = 2_000
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RESULTS = (*BASE, "base_failed", "kept", "rejected_by")


class Rule(NamedTuple):
    """Rows for which ``broken`` holds go; ``needs`` names the measures it compares."""

    name: str
    needs: tuple[str, ...]
    broken: str


# --- fixed values: published thresholds for prose -----------------------------------------------------------
RULES = [
    Rule("few_words", ("n_words",), "n_words < 20"),
    Rule("repeats", ("n_words", "n_repeat_words"), "100 * n_repeat_words > 30 * n_words"),
    Rule("word_length", ("n_words", "word_chars"), "word_chars < 3 * n_words OR word_chars > 10 * n_words"),
    Rule("symbols", ("n_words", "n_symbols"), "10 * n_symbols > n_words"),
    Rule("duplicate_lines", ("n_lines", "n_dup_lines"), "100 * n_dup_lines > 30 * n_lines"),
    Rule("few_letters", ("n_words", "n_letterless"), "100 * n_letterless > 20 * n_words"),
    Rule("bullets", ("n_lines", "n_bullets"), "100 * n_bullets > 90 * n_lines"),
    Rule("ellipses", ("n_lines", "n_ellipses"), "100 * n_ellipses > 30 * n_lines"),
]
BASE_RULES = ("few_words", "repeats")
BULLETS = r"[-*•‣▪●]"
# ------------------------------------------------------------------------------------------------------------


class Measure(NamedTuple):
    """A column over ``_text`` and the measures it ``needs``; ``of`` gets the frame, the name and which rows are alive."""

    needs: tuple[str, ...]
    of: Callable[[DataFrame, str, Column], DataFrame]


def _plain(value: Callable[[], Column], *needs: str) -> Measure:
    return Measure(needs, lambda df, name, alive: with_computed(df, name, F.when(alive, value())))


def _beside(array: str, same: Callable[[Column, Column], Column]) -> Column:
    """The elements of a sorted array that are the ``same`` as the one before or behind them."""

    def lonely(x: Column, at: Column) -> Column:
        near = lambda by: F.coalesce(same(F.get(array, at + by), x), F.lit(False))
        return near(-1) | near(1)

    return F.filter(array, lonely)


def _doubled(df: DataFrame, step: int, source: str, target: str) -> DataFrame:
    """Prints of twice as many words, each of two prints (or words) ``step`` apart, as many as fit."""
    behind = F.slice(source, F.lit(step + 1), F.size(source))
    pairs = F.zip_with(F.col(source), behind, lambda a, b: F.xxhash64(a, b))
    return with_computed(df, target, F.slice(pairs, F.lit(1), F.greatest(F.size(source) - step, F.lit(0))))


def _n_repeat_words(df: DataFrame, name: str, alive: Column) -> DataFrame:
    """Words in windows found twice or more: the windows that repeat, in order, each cover what the next one does not.

    Prints of two, four and eight words are made from those before, the last ones only where some four words repeat. Windows
    that may repeat are found by sorting 33 bits of their prints with their places as whole numbers; among those
    whole prints decide.
    """
    repeats = lambda prints: F.size(F.array_distinct(prints)) < F.size(prints)
    df = with_computed(df, "_some", F.when(alive, F.col("_words")))
    df = _doubled(df, 1, "_some", "_two").drop("_some")
    df = _doubled(df, 2, "_two", "_four").drop("_two")
    df = with_computed(df, "_fours", F.when(repeats("_four"), F.col("_four"))).drop("_four")
    df = _doubled(df, 4, "_fours", "_prints").drop("_fours")
    place = (1 << 31) - 1
    packed = F.transform("_prints", lambda p, at: F.shiftleft(p, 31).bitwiseOR(at.cast("long")))
    df = with_computed(df, "_packed", F.when(repeats("_prints"), F.sort_array(packed)))
    likely = _beside("_packed", lambda a, b: a.bitwiseXOR(b).between(0, place))
    likely = F.transform(likely, lambda x: x.bitwiseAND(F.lit(place)).cast("int"))
    df = with_computed(df, "_likely", likely).drop("_packed")
    keyed = F.transform("_likely", lambda at: F.struct(F.get("_prints", at).alias("print"), at.alias("at")))
    df = with_computed(df, "_keyed", F.sort_array(keyed)).drop("_likely", "_prints")
    places = F.transform(_beside("_keyed", lambda a, b: a["print"] == b["print"]), lambda x: x["at"])
    df = with_computed(df, "_places", F.sort_array(places)).drop("_keyed")
    after = F.slice("_places", F.lit(2), F.size("_places"))
    steps = F.zip_with(after, F.col("_places"), lambda b, a: F.least(b - a, F.lit(WINDOW)))
    # The last pair has no second place and stands for the last window, which covers all its words.
    covered = F.aggregate(steps, F.lit(0).cast("long"), lambda total, by: total + F.coalesce(by, F.lit(WINDOW)))
    covered = F.when(F.col("_places").isNull(), F.lit(0).cast("long")).otherwise(covered)
    return with_computed(df, name, F.when(alive, covered)).drop("_places")


def _size(array: Column) -> Column:
    return F.size(array).cast("long")


MEASURES: dict[str, Measure] = {
    "_words": _plain(lambda: F.regexp_extract_all("_text", F.lit(f"{WORD}+"), F.lit(0))),
    # Lines with a word.
    "_lines": _plain(lambda: F.filter(F.split("_text", "\n", -1), lambda line: line.rlike(WORD))),
    "n_words": _plain(lambda: _size(F.col("_words")), "_words"),
    "word_chars": _plain(lambda: F.length(F.array_join("_words", "")).cast("long"), "_words"),
    "n_symbols": _plain(lambda: F.regexp_count("_text", F.lit(f"[{SYMBOLS}]")).cast("long")),
    "n_dup_lines": _plain(lambda: _size(F.col("_lines")) - F.size(F.array_distinct("_lines")), "_lines"),
    "n_repeat_words": Measure(("_words",), _n_repeat_words),
    "n_lines": _plain(lambda: _size(F.col("_lines")), "_lines"),
    # A blank, or the start, and what follows up to the next blank without a letter in it.
    "n_letterless": _plain(lambda: F.regexp_count("_text", F.lit(rf"(?:^|[{BLANK}])[^{BLANK}\p{{L}}]++(?![^{BLANK}])")).cast("long")),
    "n_bullets": _plain(lambda: _size(F.filter("_lines", lambda x: F.ltrim(x, F.lit(BLANKS)).rlike(f"^{BULLETS}[{BLANK}]"))), "_lines"),
    "n_ellipses": _plain(lambda: _size(F.filter("_lines", lambda x: F.rtrim(x, F.lit(BLANKS)).rlike(r"(?:\.\.\.|…)\z"))), "_lines"),
}


def _closure(names: list[str], there: set[str]) -> list[str]:
    """``names`` that are not ``there``, each behind what it needs."""
    out: list[str] = []
    for name in names:
        if name not in there and name not in out:
            out += [n for n in _closure(list(MEASURES[name].needs), there | set(out))]
            out.append(name)
    return out


def _add(df: DataFrame, names: list[str], alive: Column | None = None) -> DataFrame:
    """``df`` with the measures not in it, and what they need, for rows that are ``alive``."""
    for name in _closure(names, set(df.columns)):
        df = MEASURES[name].of(df, name, F.lit(True) if alive is None else alive)
    return df


def _boxed(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """``docs`` as ``_text`` and one column of all that is carried."""
    carried = others(docs, RESULTS)
    return docs.select(F.coalesce("text", F.lit("")).alias("_text"), boxed(carried)), carried


class Estimate(NamedTuple):
    """Seconds per measure over the sample, and how many of its rows break which rules (bit i: rule i)."""

    seconds: dict[str, float]
    combinations: dict[int, int]


def estimate(texts: DataFrame, rules: list[Rule], there: tuple[str, ...] = (), rows: int = SAMPLE_ROWS) -> Estimate:
    """Cost of the measures beyond those ``there`` and selectivity of the rules, from about ``rows`` rows of all."""
    n = texts.count()
    picked = texts.select("_text").sample(min(1.0, rows / max(n, 1)), seed=1)
    sample = staged(_add(picked, list(there)), "quality-sample")

    def timed(names: list[str]) -> float:
        began = time.monotonic()
        _add(sample, names).write.format("noop").mode("overwrite").save()
        return time.monotonic() - began

    names = _closure([n for r in rules for n in r.needs], set(sample.columns))
    timed(names)
    seconds = {}
    for name in names:
        *before, _ = _closure([name], set(sample.columns))
        seconds[name] = max(timed([name]) - timed(before), 1e-3)
    broken = [F.when(F.expr(r.broken), F.lit(1 << i)).otherwise(F.lit(0)) for i, r in enumerate(rules)]
    masks = _add(sample, names).select(sum(broken[1:], broken[0]).alias("mask")).groupBy("mask").count()
    return Estimate(seconds, {r["mask"]: r["count"] for r in masks.collect()})


def ordered(rules: list[Rule], found: Estimate) -> list[Rule]:
    """The rules, each next one with the most rejections per second among rows that earlier ones keep."""
    alive, left, out = dict(found.combinations), list(enumerate(rules)), []
    free = set(MEASURES) - set(found.seconds)
    while left:

        def worth(entry: tuple[int, Rule]) -> float:
            i, rule = entry
            rejected = sum(n for mask, n in alive.items() if mask >> i & 1)
            return rejected / (1e-3 + sum(found.seconds[m] for m in _closure(list(rule.needs), free)))

        best = max(left, key=worth)
        left.remove(best)
        out.append(best[1])
        free |= set(_closure(list(best[1].needs), free))
        alive = {mask: n for mask, n in alive.items() if not mask >> best[0] & 1}
    return out


def _cascade(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """``df`` with ``rejected_by``, the first of ``rules`` a row breaks; its later measures stay null."""
    df = df.withColumn("_rejected", F.lit(None).cast("string"))
    for rule in rules:
        alive = F.col("_rejected").isNull()
        df = _add(df, list(rule.needs), alive)
        verdict = F.when(~alive, F.col("_rejected")).when(F.expr(rule.broken), F.lit(rule.name))
        df = with_computed(df, "_verdict", verdict).drop("_rejected").withColumnRenamed("_verdict", "_rejected")
    return df.withColumnRenamed("_rejected", "rejected_by")


def judge(docs: DataFrame, rules: list[Rule] = RULES, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with ``kept`` and ``rejected_by``; measures are computed as far as the cascade needs them."""
    texts, carried = _boxed(docs)
    order = ordered(rules, estimate(texts, rules, rows=rows))
    out = _cascade(texts, order)
    return out.select(*unboxed(carried), F.col("rejected_by").isNull().alias("kept"), "rejected_by")


def report(docs: DataFrame, rules: list[Rule] = RULES, rows: int = SAMPLE_ROWS) -> DataFrame:
    """As :func:`judge`, with the measures of ``BASE`` for every row and whether the rules of ``BASE_RULES`` reject it.

    These measures are there before the cascade, so the rules on them cost next to nothing and the others see fewer rows.
    """
    texts, carried = _boxed(docs)
    order = ordered(rules, estimate(texts, rules, BASE, rows))
    out = _cascade(_add(texts, list(BASE)), order)
    base = F.expr(" OR ".join(f"({r.broken})" for r in rules if r.name in BASE_RULES))
    return out.select(
        *unboxed(carried), *BASE, base.alias("base_failed"), F.col("rejected_by").isNull().alias("kept"), "rejected_by"
    )
