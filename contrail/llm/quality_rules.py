"""Text statistics, and decision lists learned from labelled ones. Column expressions and aggregates throughout."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.tables import landed
from contrail.llm.text import BLANK_CLASS, blank_words, let, unused

WINDOW = 3
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def _covered(starts: Column, width: int) -> Column:
    """How many positions the windows of ``width`` at the ascending ``starts`` cover."""
    return F.aggregate(
        F.transform(starts, lambda p, i: F.coalesce(F.least(F.lit(width), F.get(starts, i + 1) - p), F.lit(width))),
        F.lit(0).cast("long"), lambda total, step: total + step)


def _repeat_words(words: Column) -> Column:
    """Words inside windows of three words that the text holds twice or more.

    Windows are sorted by hash and position within the row, so that equal ones are neighbours: n log n steps, however
    often a window recurs.
    """
    n = F.size(words)
    grams = F.when(n >= WINDOW, F.transform(
        F.sequence(F.lit(0), n - WINDOW),
        lambda i: F.struct(F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]).alias("h"), i.alias("p"))))
    ordered = F.array_sort(F.coalesce(grams, F.expr("cast(array() as array<struct<h: bigint, p: int>>)")))

    def repeated(rows: Column) -> Column:
        same = F.filter(rows, lambda x, i: F.coalesce(F.get(rows, i - 1)["h"] == x["h"], F.lit(False))
                        | F.coalesce(F.get(rows, i + 1)["h"] == x["h"], F.lit(False)))
        return let(F.array_sort(F.transform(same, lambda x: x["p"])), lambda starts: _covered(starts, WINDOW))

    return let(ordered, repeated)


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the ``STATISTICS`` of each text (all long); one narrow pass.

    ``word_chars`` are code points in words, ``n_symbols`` characters of ``#*$%&|<>``, ``n_lines`` lines with a word,
    ``n_dup_lines`` those equal to an earlier one, ``n_repeat_words`` words in 3-word windows that occur twice or more
    in the text. A null or empty text has zeros. Columns of the input that have these names are replaced.
    """
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))

    def counted(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.aggregate(words, F.lit(0).cast("long"), lambda n, w: n + F.length(w)).alias("word_chars"),
            (F.length(whole) - F.length(F.translate(whole, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
            let(F.filter(F.split(whole, "\n"), lambda x: F.length(F.regexp_replace(x, BLANK_CLASS + "+", "")) > 0),
                lambda lines: F.struct(F.size(lines).cast("long").alias("n"),
                                       F.size(F.array_distinct(lines)).cast("long").alias("d"))).alias("lines"),
            _repeat_words(words).alias("n_repeat_words"))

    found = unused("found", docs)
    out = docs.withColumn(found, let(blank_words(F.col(f"`{text}`")), counted))
    return out.withColumns({
        **{c: F.col(f"{found}.{c}") for c in ("n_words", "word_chars", "n_symbols", "n_repeat_words")},
        "n_lines": F.col(f"{found}.lines.n"), "n_dup_lines": F.col(f"{found}.lines.n") - F.col(f"{found}.lines.d"),
    }).drop(found)


def _share(part: str, whole: str) -> Column:
    return F.coalesce(F.try_divide(F.col(part), F.col(whole)), F.lit(0.0))


def features() -> dict[str, Column]:
    """The measures that rules may test, as expressions of the statistics."""
    return {
        "words": F.col("n_words").cast("double"),
        "mean_word_chars": _share("word_chars", "n_words"),
        "symbols_per_word": _share("n_symbols", "n_words"),
        "dup_line_share": _share("n_dup_lines", "n_lines"),
        "repeat_word_share": _share("n_repeat_words", "n_words"),
        "words_per_line": _share("n_words", "n_lines"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float

    def column(self) -> Column:
        value = features()[self.feature]
        return value >= self.threshold if self.at_least else value < self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.threshold:.6g}"


@dataclass
class DecisionList:
    """Rules in order, each a conjunction of thresholds that rejects a text; what no rule meets is kept."""

    rules: list[list[Condition]] = field(default_factory=list)

    def rule(self) -> Column:
        """The number of the first rule that a text meets, from 1; null for a text that is kept."""
        chain = None
        for k, conditions in enumerate(self.rules, 1):
            met = _all(conditions)
            chain = F.when(met, k) if chain is None else chain.when(met, k)
        return F.lit(None).cast("int") if chain is None else chain.cast("int")

    def kept(self) -> Column:
        return self.rule().isNull()

    def __str__(self) -> str:
        return "\n".join("reject if " + " and ".join(map(str, r)) for r in self.rules) or "keep everything"


def _all(conditions: list[Condition]) -> Column:
    met = F.lit(True)
    for c in conditions:
        met = met & c.column()
    return met


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    """Information gained by the rejected texts that stay covered."""
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0


def _interval(value: Column, cuts: list[float]) -> Column:
    """How many of the ascending cuts are not above the value."""
    return F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= value))


def _best_condition(rows: DataFrame, cuts: dict[str, list[float]]) -> tuple[float, Condition | None, int]:
    """The threshold with the largest gain over ``rows``, and how many kept texts it leaves covered. One aggregate of
    a row for each feature and interval."""
    binned = [F.struct(F.lit(name).alias("f"), _interval(features()[name], at).alias("b")) for name, at in cuts.items()]
    counts: dict[str, dict[int, tuple[int, int]]] = {}
    for f, b, p, n in (rows.select("bad", F.explode(F.array(*binned)).alias("x")).groupBy("x.f", "x.b")
                       .agg(F.sum(F.col("bad").cast("int")), F.sum((~F.col("bad")).cast("int"))).collect()):
        counts.setdefault(f, {})[b] = (p, n)
    best: tuple[float, Condition | None, int] = (0.0, None, 0)
    for name in sorted(counts):
        bins = counts[name]
        p0, n0 = sum(p for p, _ in bins.values()), sum(n for _, n in bins.values())
        if not p0:
            continue
        for k, cut in enumerate(cuts[name]):
            p = sum(v[0] for b, v in bins.items() if b > k)
            n = sum(v[1] for b, v in bins.items() if b > k)
            for at_least, pp, nn in ((True, p, n), (False, p0 - p, n0 - n)):
                if (gain := _gain(pp, nn, p0, n0)) > best[0] + 1e-9:
                    best = (gain, Condition(name, at_least, cut), nn)
    return best


def learn(labelled: DataFrame, key: str, bad: Column, max_rows: int = 200_000, max_rules: int = 6,
          max_conditions: int = 3, min_precision: float = 0.9, min_support: int = 5, n_cuts: int = 24) -> DecisionList:
    """A decision list from texts with statistics and a mark of the ``bad`` ones, by sequential covering.

    Two thirds of the rows (by hash of ``key``) grow a rule, one threshold at a time by information gain; the last
    third prunes its tail and must confirm it: at least ``min_support`` bad texts covered, at ``min_precision``. The
    rows a rule covers are set aside before the next one. Thresholds are quantiles of the bad and of the other texts.
    About ``max_rows`` labelled rows are used, those with the smallest hashes of their keys. Every step is an aggregate
    whose result has a row for each feature and interval. Rows with a null mark are left out; without bad rows, or
    without others, the list is empty and keeps everything.
    """
    columns = [F.col(f"`{key}`").alias("key"), *STATISTICS, bad.alias("bad")]
    marked = labelled.select(*columns).filter("bad is not null")
    share = min(1.0, max_rows / max(1, marked.count()))
    rows = landed(marked.filter((F.xxhash64("key").cast("double") + 2.0 ** 63) / 2.0 ** 64 <= share), "quality-labels")
    steps = [k / n_cuts for k in range(n_cuts + 1)]
    cuts: dict[str, set[float]] = {name: set() for name in features()}
    for row in rows.groupBy("bad").agg(*[F.percentile_approx(c, steps, 10_000).alias(n) for n, c in features().items()]
                                       ).collect():
        for name in cuts:
            cuts[name].update(row[name] or ())
    at = {name: sorted(values) for name, values in cuts.items() if len(values) > 1}
    part = F.pmod(F.xxhash64(F.lit("part"), "key"), F.lit(3))
    left, found = rows, DecisionList()
    while at and len(found.rules) < max_rules:
        rule: list[Condition] = []
        grow = left.filter(part != 0)
        while len(rule) < max_conditions:
            gain, condition, wrong = _best_condition(grow.filter(_all(rule)), at)
            if condition is None:
                break
            rule.append(condition)
            if not wrong:
                break
        if not rule:
            break
        counts = left.filter(part == 0).agg(*[
            F.coalesce(F.sum((_all(rule[:k]) & (F.col("bad") == side)).cast("int")), F.lit(0))
            for k in range(1, len(rule) + 1) for side in (True, False)]).first()
        worth = [(counts[2 * k] - counts[2 * k + 1]) / max(1, counts[2 * k] + counts[2 * k + 1])
                 for k in range(len(rule))]
        keep = max(range(len(rule)), key=lambda k: (worth[k], -k))
        p, n = counts[2 * keep], counts[2 * keep + 1]
        if p < min_support or p < min_precision * (p + n):
            break
        rule = rule[: keep + 1]
        found.rules.append(rule)
        left = left.filter(~_all(rule))
    return found
