"""Repeated stretches of a corpus from winnowed anchors, for words and for bytes.

Every window of the corpus belongs to one anchor occurrence, and equal windows to equal anchors. An occurrence is told
by its document and its first window start, and has a signature of all units its windows hold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm import grams
from contrail.llm.tables import landed

WORDS, BYTES = "words", "bytes"
# Anchors are worked out in chunks of about so many bytes; numbers of eight bytes for each are to fit a core's cache.
ANCHOR_BYTES = 1 << 17


def units_of(data: np.ndarray, offsets: np.ndarray, unit: str) -> tuple[np.ndarray, np.ndarray]:
    """The units of a chunk of texts, and their offsets."""
    if unit == BYTES:
        return grams.byte_units(data), offsets
    begin, end, starts = grams.words(data, offsets)
    return grams.word_units(data, begin, end), starts


def keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``doc, content, text``. ``content``, a hash of the text, tells rows of one key apart that hold different texts."""
    rows = docs.select(F.col(f"`{key}`").alias("doc"), F.col(f"`{text}`").alias("text"))
    return rows.select("doc", F.xxhash64("text").alias("content"), "text")


def to_texts(texts: DataFrame, rows: DataFrame, how: str = "inner") -> DataFrame:
    """``texts`` with the columns of ``rows``, which has a row for each ``doc`` and ``content``; null is a key like
    others."""
    named = rows.withColumnsRenamed({"doc": "_doc", "content": "_content"})
    same = texts["doc"].eqNullSafe(named["_doc"]) & (texts["content"] == named["_content"])
    return texts.join(named, same, how).drop("_doc", "_content")


def anchors_of(texts: pa.Array, unit: str, window: int, gram: int, signed: bool = True) -> grams.Anchors:
    """The anchors of the texts, which are numbered from 0, worked out in chunks that fit a core's cache."""
    parts = []
    for start, data, offsets in grams.chunks(texts, ANCHOR_BYTES):
        found = grams.anchors(*units_of(data, offsets, unit), window, gram, signed)
        found.text = found.text + start
        parts.append(found)
    none = np.empty(0, np.int64)
    return grams.Anchors(*(np.concatenate([none, *(getattr(p, f.name) for p in parts)]) for f in fields(grams.Anchors)))


def occurrences(docs: DataFrame, unit: str, window: int, gram: int) -> DataFrame:
    """``doc, content, anchor, signature, first, n``: each anchor occurrence with its first window start and how many
    follow."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = anchors_of(batch.column(2), unit, window, gram)
            at = pa.array(found.text)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(at), batch.column(1).take(at), pa.array(found.anchor), pa.array(found.signature),
                pa.array(found.first.astype(np.int32)), pa.array((found.last - found.first + 1).astype(np.int32))],
                ["doc", "content", "anchor", "signature", "first", "n"])

    kind = dict(docs.dtypes)["doc"]
    return docs.select("doc", "content", "text").mapInArrow(
        find, f"doc {kind}, content long, anchor long, signature long, first int, n int")


def repeated(docs: DataFrame, unit: str, window: int, gram: int) -> DataFrame:
    """The occurrences whose anchor occurs twice or more in the corpus.

    Anchors are worked out twice rather than kept: they take less time than the space they would need. The first time
    goes without signatures. Counting combines in the tasks, so a frequent anchor leaves each of them as one row.
    """

    def only_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = anchors_of(batch.column(0), unit, window, gram, signed=False)
            yield pa.RecordBatch.from_arrays([pa.array(found.anchor)], ["anchor"])

    twice = landed(docs.select("text").mapInArrow(only_anchors, "anchor long").groupBy("anchor").count().filter(
        "count > 1").select("anchor"), "repeated-anchors")
    return landed(occurrences(docs, unit, window, gram).join(twice, "anchor"), "anchor-occurrences")


def window_keys(docs: DataFrame, rows: DataFrame, unit: str, window: int) -> DataFrame:
    """``anchor, hash, doc, content, start``: every window of the given occurrences, which are joined to their texts."""
    wanted = rows.groupBy("doc", "content").agg(F.collect_set(F.struct("anchor", "first", "n")).alias("rows"))
    joined = to_texts(docs, wanted).select("doc", "content", "text", "rows")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
            bounds = np.concatenate(([0], np.cumsum(lengths)))
            anchor, first, n = (lists.flatten().field(k).to_numpy() for k in range(3))
            for start, data, offsets in grams.chunks(batch.column(2)):
                units, at = units_of(data, offsets, unit)
                own = slice(bounds[start], bounds[start + len(offsets) - 1])
                text = np.repeat(np.arange(len(offsets) - 1), lengths[start:start + len(offsets) - 1])
                count = n[own]
                each = np.repeat(np.arange(len(count)), count)
                local = first[own][each] + np.arange(len(each)) - np.repeat(np.cumsum(count) - count, count)
                hashes = grams.window_hashes(grams.Sums(units, 1), local + at[text[each]], window)
                row = pa.array(start + text[each])
                yield pa.RecordBatch.from_arrays([
                    pa.array(anchor[own][each]), pa.array(hashes), batch.column(0).take(row), batch.column(1).take(row),
                    pa.array(local.astype(np.int32))], ["anchor", "hash", "doc", "content", "start"])

    kind = dict(docs.dtypes)["doc"]
    return joined.mapInArrow(hashed, f"anchor long, hash long, doc {kind}, content long, start int")


def spans_by_doc(spans: DataFrame) -> DataFrame:
    """``doc, content, spans``: the spans ``begin, end`` of a text in one row."""
    return spans.groupBy("doc", "content").agg(F.collect_set(F.struct("begin", "end")).alias("spans"))


def merged(begin: np.ndarray, end: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which of ``size`` units the spans cover, and begin and end of the covered stretches."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, np.minimum(begin, size), 1)
    np.add.at(change, np.minimum(end, size), -1)
    inside = np.cumsum(change[:-1]) > 0
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    return inside, edges[::2], edges[1::2]
