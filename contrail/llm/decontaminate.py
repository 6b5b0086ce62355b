"""Benchmark decontamination by winnowed fingerprints, in DataFrame operations only.

Of every ``window`` consecutive words the ``k``-gram with the smallest hash is kept, in documents and benchmark items
alike, so a shared span of ``window`` words always shares a fingerprint. Fingerprints are joined, and each hit is
extended word by word to both sides.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.text import alnum_words, let
from contrail.llm.tables import landed

# Fingerprints of the benchmark are broadcast up to this many; beyond it the join shuffles both sides.
MAX_BROADCAST_ROWS = 1_000_000

_FINGERPRINT = "array<struct<h: bigint, p: int, left: int, near: array<string>>>"


def _gram(words: Column, at: Column, k: int) -> Column:
    return F.xxhash64(*[F.get(words, at + j) for j in range(k)])


def fingerprints(words: Column, window: int, k: int) -> Column:
    """The winnowed ``k``-grams of an array of words: hash ``h``, position ``p`` and the words around it, ``near``, of
    which ``left`` stand before it. Of equal hashes in a window all are kept. Empty below ``window`` words."""
    width, reach = window - k + 1, window - k
    none = F.lit(None).cast(_FINGERPRINT.removeprefix("array<")[:-1])

    def selected(h: Column) -> Column:
        lows = F.transform(F.sequence(F.lit(0), F.size(h) - width),
                           lambda s: F.least(*[F.get(h, s + j) for j in range(width)]))

        def kept(m: Column) -> Column:
            # A gram is the lowest of one of its windows if the greatest of their minima is its own hash.
            marked = F.transform(h, lambda x, p: F.when(
                x == F.greatest(*[F.get(m, p - j) for j in range(width)]),
                F.struct(x.alias("h"), p.alias("p"), F.least(p, F.lit(reach)).alias("left"),
                         F.slice(words, F.greatest(p - reach, F.lit(0)) + 1,
                                 F.least(p, F.lit(reach)) + k + reach).alias("near"))).otherwise(none))
            return F.filter(marked, lambda f: f.isNotNull())

        return let(lows, kept)

    grams = F.transform(F.sequence(F.lit(0), F.size(words) - k), lambda i: _gram(words, i, k))
    return F.when(F.size(words) >= window, let(grams, selected)).otherwise(F.expr(f"cast(array() as {_FINGERPRINT})"))


def _run(ours: Column, our_first: Column, theirs: Column, their_first: Column, step: int, most: int) -> Column:
    """How many words agree from the two places on, at most ``most``, in the direction of ``step``."""
    length = F.lit(0)
    for j in reversed(range(most)):
        same = F.get(ours, our_first + j * step) == F.get(theirs, their_first + j * step)
        length = F.when(same, length + 1).otherwise(0)
    return length


def _cover(spans: DataFrame, keys: list[str]) -> DataFrame:
    """Overlapping and touching spans of a key merged: ``spans`` in order and ``n_hit``, the words in them."""
    order = Window.partitionBy(*keys).orderBy("begin", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = spans.distinct().withColumn("_new", F.coalesce((F.col("begin") > reach).cast("int"), F.lit(1)))
    numbered = marked.withColumn("_run", F.sum("_new").over(order))
    merged = numbered.groupBy(*keys, "_run").agg(F.min("begin").alias("begin"), F.max("end").alias("end"))
    return merged.groupBy(*keys).agg(
        F.sum(F.col("end") - F.col("begin")).cast("long").alias("n_hit"),
        F.array_sort(F.collect_list(F.struct("begin", "end"))).alias("spans"))


def contamination(docs: DataFrame, benchmark: DataFrame, key: str, text: str, item: str, item_text: str,
                  window: int = 10, k: int = 5) -> DataFrame:
    """For each document: ``n_words``, ``n_hit`` (words inside any occurrence of an item's window), ``items`` (ids as
    strings, sorted) and ``spans`` of hit words.

    Words are runs of digits, letters and non-ASCII characters, A-Z lower-cased. An item's windows are its runs of
    ``window`` words; a shorter item is one window, an item without words has none, and an item without an id marks
    words but is not listed. A null text has no words. Rows with the same key and text are the same document and each
    get its result; a null key is a key. Other columns are not read.

    Documents are read once. Their fingerprints meet those of the benchmark in the same task while the benchmark has
    at most ``MAX_BROADCAST_ROWS`` of them, counted before the join, so no text is shuffled.
    """
    words = alnum_words(F.col("_text"))
    ours = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text")).select(
        "_key", F.xxhash64("_text").alias("_same"), words.alias("_words"))
    items = landed(benchmark.select(F.col(f"`{item}`").cast("string").alias("_item"),
                                    F.col(f"`{item_text}`").alias("_text"))
                   .select("_item", words.alias("_words")).filter(F.size("_words") > 0), "benchmark-words")
    marks = landed(items.filter(F.size("_words") >= window)
                   .select("_item", F.explode(fingerprints(F.col("_words"), window, k)).alias("_f"))
                   .select("_item", F.col("_f.h").alias("_h"), F.col("_f.left").alias("_their_left"),
                           F.col("_f.near").alias("_theirs")).distinct(), "benchmark-fingerprints")
    if marks.count() <= MAX_BROADCAST_ROWS:
        marks = F.broadcast(marks)

    # A marker for each document travels with its fingerprints, so that one pass also yields the number of words.
    marker = F.array(F.struct(F.lit(None).cast("bigint").alias("h"), F.lit(-1).alias("p"), F.lit(0).alias("left"),
                              F.lit(None).cast("array<string>").alias("near")))
    found = (ours.select("_key", "_same", F.size("_words").alias("n_words"),
                         F.explode(F.concat(marker, fingerprints(F.col("_words"), window, k))).alias("_f"))
             .select("_key", "_same", "n_words", F.col("_f.h").alias("_h"), F.col("_f.p").alias("_p"),
                     F.col("_f.left").alias("_left"), F.col("_f.near").alias("_ours"))
             .join(marks, "_h", "left").filter("_p < 0 or _theirs is not null"))
    reach = window - k
    before = _run(F.col("_ours"), F.col("_left") - 1, F.col("_theirs"), F.col("_their_left") - 1, -1, reach)
    after = _run(F.col("_ours"), F.col("_left"), F.col("_theirs"), F.col("_their_left"), 1, k + reach)
    rows = landed(found.select(
        "_key", "_same", "n_words", "_p", "_item", before.alias("_before"), after.alias("_after")).select(
        "_key", "_same", "n_words", "_item", (F.col("_p") < 0).alias("_marker"),
        F.when((F.col("_after") >= k) & (F.col("_before") + F.col("_after") >= window),
               F.col("_p") - F.col("_before")).alias("begin"), (F.col("_p") + F.col("_after")).alias("end")
    ).filter("_marker or begin is not null"), "benchmark-hits")

    spans = [rows.filter("not _marker").select("_key", "_same", "_item", "begin", "end")]
    short = items.filter(F.size("_words") < window)
    for (length,) in short.select(F.size("_words")).distinct().collect():  # fewer than ``window`` of them
        spans.append(_whole_items(ours, short.filter(F.size("_words") == length), length))
    spans_all = reduce(DataFrame.unionByName, spans)
    keys = ["_key", "_same"]
    listed = spans_all.groupBy(*keys).agg(F.array_sort(F.collect_set("_item")).alias("items"))
    covered = _cover(spans_all.select(*keys, "begin", "end"), keys)
    texts = rows.filter("_marker").select("_key", "_same", F.col("n_words").cast("long").alias("n_words"))
    out = texts.alias("t")
    for part in (covered.alias("c"), listed.alias("l")):
        name = "c" if "n_hit" in part.columns else "l"
        out = out.join(part, F.col("t._key").eqNullSafe(F.col(f"{name}._key"))
                       & (F.col("t._same") == F.col(f"{name}._same")), "left")
    return out.select(
        F.col("t._key").alias(key), F.col("t._same").alias("_same"), "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"),
        F.coalesce("spans", F.expr("cast(array() as array<struct<begin: int, end: int>>)")).alias("spans"))


def _whole_items(ours: DataFrame, items: DataFrame, length: int) -> DataFrame:
    """Occurrences of items that are one window of ``length`` words, by the hash of all words and their comparison."""
    theirs = items.select("_item", _gram(F.col("_words"), F.lit(0), length).alias("_h"),
                          F.col("_words").alias("_theirs"))
    grams = F.transform(F.sequence(F.lit(0), F.size("_words") - length), lambda i: F.struct(
        _gram(F.col("_words"), i, length).alias("h"), i.alias("p"), F.slice("_words", i + 1, length).alias("w")))
    mine = ours.filter(F.size("_words") >= length).select("_key", "_same", F.explode(grams).alias("_f")).select(
        "_key", "_same", F.col("_f.h").alias("_h"), F.col("_f.p").alias("begin"), F.col("_f.w").alias("_ours"))
    return mine.join(theirs, "_h").filter(F.col("_ours") == F.col("_theirs")).select(
        "_key", "_same", "_item", "begin", (F.col("begin") + length).alias("end"))
