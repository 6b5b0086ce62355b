"""Substring de-duplication over words by seed and extend."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm import seeds
from contrail.llm.tables import landed, settled


def repeats(docs: DataFrame, key: str, text: str, window: int = 50) -> DataFrame:
    """``doc, content, begin, end``: spans of words whose ``window``-word runs all start in a document with a smaller key too.

    Documents meet on winnowed anchors of half a window. A seed is extended to both sides over all the windows that
    chose it: where its signature, a hash of everything these windows hold, is known from a smaller key, the match
    covers them all. Only occurrences that are the first of their signature, beside others of the same anchor, are
    extended window by window; these lie where repeats begin and end. Spans are not merged.

    Equality is that of two 64-bit hashes, of the anchor and of all the words. Rows with a null key neither remove nor
    lose words. Rows with the same key, which may hold different texts, do not remove one another; ``content`` tells
    them apart.
    """
    texts = seeds.keyed(docs, key, text).filter("doc is not null")
    found = seeds.repeated(texts, seeds.WORDS, window, window // 2)
    signatures = landed(found.groupBy("anchor", "signature").agg(F.min("doc").alias("least")), "anchor-signatures")
    several = signatures.groupBy("anchor").agg(F.count("*").alias("ways"))
    known = landed(signatures.join(several, "anchor"), "anchor-ways")
    rows = landed(found.join(known, ["anchor", "signature"]).filter("doc > least or ways > 1"), "anchor-matches")
    covered = rows.filter("doc > least").select(
        "doc", "content", F.col("first").alias("begin"), (F.col("first") + F.col("n") - 1 + window).alias("end"))

    keys = landed(seeds.window_keys(texts, rows.filter("doc = least"), seeds.WORDS, window), "window-keys")
    earlier = keys.groupBy("anchor", "hash").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).filter(
        "least < most").select("anchor", "hash", "least")
    extended = keys.join(landed(earlier, "window-firsts"), ["anchor", "hash"]).filter("doc > least").select(
        "doc", "content", F.col("start").alias("begin"), (F.col("start") + window).alias("end"))
    return covered.unionByName(extended)


def dedup_substrings(docs: DataFrame, key: str, text: str, window: int = 50) -> DataFrame:
    """For each row: the key as ``doc``, ``n_words``, ``n_removed``, ``spans`` (removed stretches of words, maximal, in
    order) and ``kept``, the other words joined by one blank.

    A word is removed if a run of ``window`` consecutive words around it, judged on the input, also starts in a
    document with a smaller key. Words are runs of non-blank characters, unchanged. A null or empty text has no words
    and an empty ``kept``. Other columns are not read.
    """
    spans = settled(lambda: seeds.spans_by_doc(repeats(docs, key, text, window)), "repeated-spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, kept, stretches = [], [], [], []
            for value, own in zip(batch.column(1), batch.column(2)):
                words = (value.as_py() or "").encode().split()
                begin = end = np.empty(0, np.int64)
                if own.is_valid:
                    inside, begin, end = seeds.merged(own.values.field(0).to_numpy(), own.values.field(1).to_numpy(),
                                                      len(words))
                    kept.append(b" ".join(compress(words, (~inside).tolist())).decode())
                else:
                    kept.append(b" ".join(words).decode())
                n_words.append(len(words))
                n_removed.append(int((end - begin).sum()))
                stretches.append([{"begin": b, "end": e} for b, e in zip(begin.tolist(), end.tolist())])
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                pa.array(stretches, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
                pa.array(kept, pa.string())], ["doc", "n_words", "n_removed", "spans", "kept"])

    texts = seeds.keyed(docs, key, text)
    kind = dict(texts.dtypes)["doc"]
    return seeds.to_texts(texts, spans, "left").select("doc", "text", "spans").mapInArrow(
        cut, f"doc {kind}, n_words long, n_removed long, spans array<struct<begin: long, end: long>>, kept string")
