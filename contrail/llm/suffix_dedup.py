"""Byte-level de-duplication by longest-previous-factor arrays over suffix order.

Anchors narrow the corpus to stretches that may repeat; the suffixes of these are sorted in buckets of anchors, so that
all suffixes that agree in ``window`` bytes are in one bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm import seeds
from contrail.llm.tables import landed, settled

ALL, LATER = "all", "later"
WORD = 8


def words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on as one number, zeros beyond the end."""
    padded = np.concatenate((data, np.zeros(WORD, np.uint8)))
    words = np.zeros(len(data), np.uint64)
    for k in range(WORD):
        words = (words << np.uint64(8)) | padded[k:k + len(data)]
    return words


def suffix_order(words: np.ndarray, limits: np.ndarray, depth: int) -> np.ndarray:
    """Places with ``depth`` bytes before their limit, in the order of these bytes, by prefix doubling; equal ones in the
    order of their places.

    ``words`` are those of ``words_at``, ``limits`` the end of the text that each place lies in. A length is ranked only
    where so many bytes are left, which are the places that a longer one looks at; the last step overlaps the one before.
    """
    n = len(words)
    room = limits - np.arange(n)
    bits = np.uint64(n.bit_length())
    packed, mask = 3 * int(bits) <= 64, (np.uint64(1) << bits) - np.uint64(1)
    width, rank = WORD, np.zeros(n, np.uint64)
    at = np.flatnonzero(room >= width)
    order = np.argsort(words[at], kind="stable" if width == depth else None)
    found = words[at[order]]
    while width < depth:
        rank[at[order]] = np.cumsum(np.append(False, found[1:] != found[:-1])[:len(at)], dtype=np.uint64)
        step = min(width, depth - width)
        width += step
        at = np.flatnonzero(room >= width)
        both = (rank[at] << bits) | rank[at + step]
        if packed:  # a number's place rides in its low bits, as numbers sort faster than places by them
            both = np.sort((both << bits) | np.arange(len(at), dtype=np.uint64))
            order, found = (both & mask).astype(np.int64), both >> bits
        else:
            order = np.argsort(both, kind="stable" if width == depth else None)
            found = both[order]
    return at[order].astype(np.int32)


def common_prefix(a: np.ndarray, b: np.ndarray, words: np.ndarray, limits: np.ndarray, depth: int) -> np.ndarray:
    """Common prefix of pairs of suffixes in whole steps of eight bytes, up to ``depth``, which is such a multiple. Pairs
    are compared word by word, and leave at their first difference."""
    length = np.zeros(len(a), np.int32)
    room = np.minimum(limits[a] - a, limits[b] - b)
    going = np.arange(len(a))
    for done in range(0, depth, WORD):
        same = (words.take(a + done, mode="clip") == words.take(b + done, mode="clip")) & (room >= done + WORD)
        if not same.all():
            going, a, b, room = going[same], a[same], b[same], room[same]
        length[going] += WORD
    return length


def factors(order: np.ndarray, prefix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Longest previous and longest next factor of every place, from places in suffix order and the common prefix of
    each with the one before it.

    Places between which no prefix is shorter than a length have that many bytes in common. All of them but the
    smallest have a previous factor of that length, and all but the largest a next one; the longest length counts.
    """
    n = len(order)
    earlier, later = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for length in np.unique(prefix[prefix > 0]):
        first = np.flatnonzero(np.append(True, prefix[1:] < length))
        size = np.diff(np.append(first, n))
        earlier[order[order > np.repeat(np.minimum.reduceat(order, first), size)]] = length
        later[order[order < np.repeat(np.maximum.reduceat(order, first), size)]] = length
    return earlier, later


def bucket_repeats(parts: list[bytes], starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the stretches of one bucket, in the order of their places and with ``starts`` windows each: row and offset of
    each window start, and whether its window occurs at an earlier (bit 1) or a later one (bit 2)."""
    sizes = np.array([len(p) for p in parts], np.int32)
    words = words_at(np.frombuffer(b"".join(parts), np.uint8))
    begins = np.cumsum(sizes, dtype=np.int32) - sizes
    limits = np.repeat(begins + sizes, sizes)
    order = suffix_order(words, limits, window)
    row = np.repeat(np.arange(len(parts), dtype=np.int32), sizes)
    order = order[(order - begins[row[order]]) < starts[row[order]]]  # window starts only
    prefix = np.zeros(len(order), np.int32)
    prefix[1:] = common_prefix(order[:-1], order[1:], words, limits, window)
    # Suffixes that share no whole window with a neighbour have no factor of that length.
    shares = (prefix >= window) | np.append(prefix[1:] >= window, False)
    kept, near = order[shares], np.where(prefix >= window, prefix, 0)[shares]
    by_place = np.argsort(kept)
    numbers = np.empty(len(kept), np.int64)
    numbers[by_place] = np.arange(len(kept))
    earlier, later = factors(numbers, near)
    spots = kept[by_place]
    found = (earlier >= window) + 2 * (later >= window)
    return row[spots], spots - begins[row[spots]], found


def repeats(docs: DataFrame, key: str, text: str, window: int = 400, remove: str = ALL,
            bucket_bytes: int = 1 << 20, max_stretches: int = 4_000) -> DataFrame:
    """``doc, content, begin, end``: spans of bytes whose ``window``-byte strings also start elsewhere (``remove="all"``), or at
    a smaller key or earlier in the same text (``"later"``, which keeps the first copy; null is the smallest key).
    ``content`` tells texts of one key apart. ``window`` is a multiple of 8.

    Occurrences of an anchor with the same signature, a hash of all the bytes of their windows, are one stretch that
    repeats as a whole. One stretch of each signature goes on where an anchor has several; these are sorted by suffix
    in buckets of anchors that hold about ``bucket_bytes``. An anchor with more than ``max_stretches`` different
    surroundings, which one task should not hold, is settled by the hashes of its windows instead.
    """
    texts = seeds.keyed(docs, key, text)
    found = seeds.repeated(texts, seeds.BYTES, window, window // 2)
    at = F.struct("doc", "content", "first")
    signatures = landed(found.groupBy("anchor", "signature").agg(
        F.count("*").alias("copies"), F.min(at).alias("least")), "byte-signatures")
    several = signatures.groupBy("anchor").agg(F.count("*").alias("ways"))
    known = landed(signatures.join(several, "anchor").filter("copies > 1 or ways > 1"), "byte-ways")
    is_first = at.eqNullSafe(F.col("least"))
    rows = landed(found.join(known, ["anchor", "signature"]).select(
        "doc", "content", "anchor", "first", "n", "copies", "ways", is_first.alias("is_first")), "byte-matches")
    whole = rows.filter("copies > 1" if remove == ALL else "not is_first").select(
        "doc", "content", F.col("first").alias("begin"), (F.col("first") + F.col("n") - 1 + window).alias("end"))

    # The first place of each signature stands for all of them.
    open_ends = rows.filter("is_first and ways > 1").select("doc", "content", "anchor", "first", "n", "ways")
    few = landed(stretches(texts, open_ends.filter(F.col("ways") <= max_stretches), window), "byte-stretches")
    total = few.agg(F.sum(F.length("bytes"))).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    dealt = few.withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(buckets)))
    wanted = 3 if remove == ALL else 1
    kind = dict(texts.dtypes)["doc"]

    def sort(table: pa.Table) -> pa.Table:
        places = [(c, "ascending") for c in ("doc", "content", "first")]
        table = table.take(pc.sort_indices(table, places, null_placement="at_start"))
        row, offset, how = bucket_repeats(table.column("bytes").to_pylist(), table.column("n").to_numpy(), window)
        row, offset = pa.array(row[how & wanted > 0]), offset[how & wanted > 0]
        return pa.table({"doc": table.column("doc").take(row), "content": table.column("content").take(row),
                         "begin": pc.add(table.column("first").take(row), pa.array(offset.astype(np.int32)))})

    sorted_out = dealt.groupBy("bucket").applyInArrow(sort, f"doc {kind}, content long, begin int")

    keys = landed(seeds.window_keys(texts, open_ends.filter(F.col("ways") > max_stretches), seeds.BYTES, window),
                  "byte-window-keys")
    place = F.struct("doc", "content", "start")
    twice = keys.groupBy("anchor", "hash").agg(F.count("*").alias("copies"), F.min(place).alias("least")).filter(
        "copies > 1")
    hashed = keys.join(twice, ["anchor", "hash"])
    if remove != ALL:
        hashed = hashed.filter(~place.eqNullSafe(F.col("least")))
    ends = sorted_out.unionByName(hashed.select("doc", "content", F.col("start").alias("begin")))
    return whole.unionByName(ends.select("doc", "content", "begin", (F.col("begin") + window).alias("end")))


def stretches(texts: DataFrame, rows: DataFrame, window: int) -> DataFrame:
    """``doc, content, anchor, first, n, bytes``: the bytes of all the windows of each occurrence."""
    wanted = rows.groupBy("doc", "content").agg(F.collect_set(F.struct("anchor", "first", "n")).alias("rows"))
    joined = seeds.to_texts(texts, wanted).select("doc", "content", F.col("text").cast("binary").alias("text"), "rows")
    return joined.select("doc", "content", "text", F.explode("rows").alias("r")).select(
        "doc", "content", "r.anchor", "r.first", "r.n",
        F.substring(F.col("text"), F.col("r.first") + 1, F.col("r.n") + window - 1).alias("bytes"))


def dedup_bytes(docs: DataFrame, key: str, text: str, window: int = 400, remove: str = ALL) -> DataFrame:
    """For each row: the key as ``doc``, ``n_bytes``, ``n_removed``, ``spans`` (removed stretches of bytes, maximal, in
    order) and ``kept``, the bytes that remain.

    A byte is removed if a string of ``window`` bytes around it, judged on the input, also starts elsewhere: in another
    row, rows with the same key included, or in the same text, where the two may overlap. A null text is like an empty
    one. Rows with a null key are rows like others, and rows of one key may hold different texts. Other columns are not
    read.
    """
    spans = settled(lambda: seeds.spans_by_doc(repeats(docs, key, text, window, remove)), "byte-spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_bytes, n_removed, kept, stretches = [], [], [], []
            for value, own in zip(batch.column(1), batch.column(2)):
                data = (value.as_py() or "").encode()
                begin = end = np.empty(0, np.int64)
                if own.is_valid:
                    inside, begin, end = seeds.merged(own.values.field(0).to_numpy(), own.values.field(1).to_numpy(),
                                                      len(data))
                    kept.append(np.frombuffer(data, np.uint8)[~inside].tobytes())
                else:
                    kept.append(data)
                n_bytes.append(len(data))
                n_removed.append(int((end - begin).sum()))
                stretches.append([{"begin": b, "end": e} for b, e in zip(begin.tolist(), end.tolist())])
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()),
                pa.array(stretches, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
                pa.array(kept, pa.binary())], ["doc", "n_bytes", "n_removed", "spans", "kept"])

    texts = seeds.keyed(docs, key, text)
    kind = dict(texts.dtypes)["doc"]
    return seeds.to_texts(texts, spans, "left").select("doc", "text", "spans").mapInArrow(
        cut, f"doc {kind}, n_bytes long, n_removed long, spans array<struct<begin: long, end: long>>, kept binary")
