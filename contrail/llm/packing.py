"""Token pieces of documents, and their packing into sequences of bounded length by swap-based local search."""

from __future__ import annotations

import functools
import itertools
import json
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.tables import landed
from contrail.llm.text import unused

# Characters whose lower case is one character and which no normal form changes: ASCII and Latin-1 without its signs.
_PLAIN = "^[!-~À-ÖØ-Þß-öø-ÿ]+$"
_LETTERS = "^[a-zß-öø-ÿ]+$"
# What a worker holds at a time: bytes of pieces and of words it remembers, by an estimate of ``_KEY_BYTES`` for each and
# what its characters and ids take; megabytes of texts it gets, and of these the bytes it works on.
_REMEMBERED = 128 << 20
_KEY_BYTES = 200
BATCH_MB = 8
CHUNK_BYTES = 4 << 20


class Ragged:
    """Rows of ids one after the other."""

    def __init__(self, flat: np.ndarray, sizes: np.ndarray):
        self.flat, self.sizes = flat, sizes

    @staticmethod
    def of(rows: list[list[int]]) -> Ragged:
        flat = np.fromiter(itertools.chain.from_iterable(rows), np.uintc)
        return Ragged(flat, np.fromiter(map(len, rows), np.int64, len(rows)))

    @staticmethod
    def joined(parts: list[Ragged]) -> Ragged:
        return Ragged(np.concatenate([p.flat for p in parts]), np.concatenate([p.sizes for p in parts]))

    def take(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the rows ``at`` one after the other, and where each row's begin (one more than rows)."""
        count = self.sizes[at]
        total = np.concatenate(([0], np.cumsum(count)))
        starts = (np.cumsum(self.sizes) - self.sizes)[at]
        return self.flat[np.repeat(starts - total[:-1], count) + np.arange(total[-1])], total


class Memory:
    """The ids of keys that were worked out. Beyond ``_REMEMBERED`` bytes the half that was looked up last is kept."""

    def __init__(self, work_out: Callable[[list[str]], Ragged]):
        self.work_out = work_out
        self.row: dict[str, int] = {}  # in the order of the rows
        self.rows, self.bytes, self.looked_up = Ragged.of([]), np.empty(0, np.int64), np.empty(0, np.int64)
        self.time = 0

    def __call__(self, keys: list[str]) -> np.ndarray:
        """The rows of distinct keys in ``rows``, until the next call."""
        if self.bytes.sum() > _REMEMBERED:
            self._forget()
        self.time += 1
        place = np.fromiter(map(self.row.get, keys, itertools.repeat(-1)), np.int64, len(keys))
        missing = np.flatnonzero(place < 0)
        if len(missing):
            fresh = [keys[i] for i in missing.tolist()]
            found, known = self.work_out(fresh), len(self.row)
            place[missing] = np.arange(known, known + len(fresh))
            self.row.update(zip(fresh, range(known, known + len(fresh))))
            self.rows = Ragged.joined([self.rows, found])
            # Python keeps a text in one to four bytes a character.
            more = _KEY_BYTES + 4 * np.fromiter(map(len, fresh), np.int64, len(fresh)) + 4 * found.sizes
            self.bytes = np.concatenate((self.bytes, more))
            self.looked_up = np.concatenate((self.looked_up, np.zeros(len(fresh), np.int64)))
        self.looked_up[place] = self.time
        return place

    def _forget(self) -> None:
        latest = np.argsort(-self.looked_up, kind="stable")
        stay = latest[np.cumsum(self.bytes[latest]) <= _REMEMBERED // 2]
        flat, total = self.rows.take(stay)
        keys = list(self.row)
        self.row = {keys[i]: k for k, i in enumerate(stay.tolist())}
        self.rows, self.bytes, self.looked_up = Ragged(flat, np.diff(total)), self.bytes[stay], self.looked_up[stay]


class Encoder:
    """The ids of texts by a tokenizer file that drops white space, without special tokens.

    Such a tokenizer treats each word between blanks for itself, and each piece that its pattern cuts a word into. So
    the distinct words of a batch are cut into pieces, the distinct pieces are looked up, and ids are gathered back by
    number. Pieces not met before go to the tokenizer together; their ids are told apart by the ends of words that the
    vocabulary marks. Words of other than plain characters, and all words where the file is of another make, go to the
    whole tokenizer one by one. What was worked out is remembered (see ``Memory``).
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.whole = Tokenizer.from_file(path)
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        split = next((s for s in steps if s["type"] == "Split"), None)
        lowered = json.dumps(spec.get("normalizer")).count('"Lowercase"') == 1
        by_bytes = bool(steps) and steps[-1]["type"] == "ByteLevel" and not steps[-1]["add_prefix_space"]
        mark = (spec.get("model") or {}).get("end_of_word_suffix")
        self.pattern = split["pattern"]["Regex"] if split and lowered and by_bytes and mark else None
        self.added = [t["content"] for t in spec["added_tokens"]]
        vocabulary = self.whole.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        if mark:
            self.ends[[v for k, v in vocabulary.items() if k.endswith(mark)]] = True
        self.words, self.pieces = Memory(self._alone), Memory(self._together)

    def __call__(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, each followed by ``end`` if it is given, and where each text's
        begin (one more than texts). Nulls are empty texts."""
        lists = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
        words = lists.flatten().dictionary_encode()
        rows, place = self._words(words.dictionary)
        bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        codes = place[words.indices.to_numpy()]
        if end is not None:
            rows = Ragged(np.append(rows.flat, np.uintc(end)), np.append(rows.sizes, 1))
            codes = np.insert(codes, bounds[1:], len(rows.sizes) - 1)
            bounds = bounds + np.arange(len(bounds))
        ids, total = rows.take(codes)
        return ids, total[bounds]

    def _words(self, words: pa.Array) -> tuple[Ragged, np.ndarray]:
        """The ids of distinct words, and in which row those of each word are."""
        plain = np.zeros(len(words), bool)
        if self.pattern is not None:
            mask = pc.match_substring_regex(words, _PLAIN)
            for token in self.added:
                mask = pc.and_not(mask, pc.match_substring(words, token))
            plain = mask.to_numpy(zero_copy_only=False)
        others = np.flatnonzero(~plain)
        seen = self.words(_texts(words.take(pa.array(others))))
        ids, total = self.words.rows.take(seen)
        rest = Ragged(ids, np.diff(total))
        if not plain.any():
            return rest, np.arange(len(words))
        lowered = pc.utf8_lower(words.filter(pa.array(plain)))
        # Words of letters only are one piece; the others are cut where the pattern says.
        cut = pc.invert(pc.match_substring_regex(lowered, _LETTERS))
        # The whole match, not a group in it: a group makes the pattern slower by the factor seven.
        spaced = pc.replace_with_mask(lowered, cut, pc.replace_substring_regex(lowered.filter(cut), self.pattern, r"\0 "))
        lists = pc.ascii_split_whitespace(spaced)
        pieces = lists.flatten().dictionary_encode()
        seen = self.pieces(_texts(pieces.dictionary))
        # A blank ends what is cut, so its list has an empty piece at its end, which has no ids.
        ids, total = self.pieces.rows.take(seen[pieces.indices.to_numpy()])
        sizes = np.diff(total[lists.offsets.to_numpy() - lists.offsets[0].as_py()])
        place = np.empty(len(words), np.int64)
        place[np.concatenate((np.flatnonzero(plain), others))] = np.arange(len(words))
        return Ragged.joined([Ragged(ids, sizes), rest]), place

    def _alone(self, words: list[str]) -> Ragged:
        return Ragged.of([self.whole.encode(w, add_special_tokens=False).ids for w in words])

    def _together(self, pieces: list[str]) -> Ragged:
        out = []
        for first in range(0, len(pieces), 4096):
            part = pieces[first:first + 4096]
            ids = np.array(self.whole.encode(" ".join(part), add_special_tokens=False).ids, np.uintc)
            stops = np.flatnonzero(self.ends[ids]) + 1
            some = np.fromiter(map(bool, part), bool, len(part))
            if len(stops) != some.sum() or (len(stops) and stops[-1] != len(ids)):
                out.append(self._alone(part))  # the vocabulary marks no ends here
                continue
            sizes = np.zeros(len(part), np.int64)
            sizes[some] = np.diff(stops, prepend=0)
            out.append(Ragged(ids, sizes))
        return Ragged.joined(out)


def _texts(values: pa.Array) -> list[str]:
    return values.to_numpy(zero_copy_only=False).tolist()


@functools.cache
def shared_encoder(path: str) -> Encoder:
    """One for each Python worker."""
    return Encoder(path)


def encoder(path: str) -> Callable[[str], np.ndarray]:
    """The ids of one text."""
    return lambda text: shared_encoder(path)(pa.array([text]))[0]


def token_pieces(docs: DataFrame, key: str, text: str, tokenizer: str, capacity: int, end: int,
                 with_ids: bool = True) -> DataFrame:
    """The token ids of each whole text, then ``end``, cut into pieces where they exceed ``capacity``.

    Returns the key as ``doc_id``, ``piece`` from 0, ``start`` in the document's ids, ``length``, ``ids_crc32`` of the
    little-endian 32-bit ids, and with ``with_ids`` the ``ids``. A null text is like an empty one, a piece of one id.
    Repeated rows give repeated pieces. Narrow; texts are worked on in chunks of about ``CHUNK_BYTES``.
    """
    kind = dict(docs.dtypes)[key]
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = shared_encoder(tokenizer)
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
            chunk = np.cumsum(sizes, dtype=np.int64) // CHUNK_BYTES
            edges = [0, *(np.flatnonzero(np.diff(chunk)) + 1).tolist(), len(sizes)]
            for first, last in zip(edges, edges[1:]):
                if first < last:
                    yield pieces(batch.slice(first, last - first), encode)

    def pieces(batch: pa.RecordBatch, encode: Encoder) -> pa.RecordBatch:
        ids, bounds = encode(batch.column(1), end)
        ids = ids.astype("<u4", copy=False)
        sizes = np.diff(bounds)
        several = -(-sizes // capacity)
        at = np.repeat(np.arange(len(sizes)), several)
        piece = np.arange(len(at)) - np.repeat(np.cumsum(several) - several, several)
        start = piece * capacity
        length = np.minimum(sizes[at] - start, capacity)
        begin = bounds[at] + start
        crc = [zlib.crc32(ids[b:b + n]) for b, n in zip(begin.tolist(), length.tolist())]
        columns = [batch.column(0).take(pa.array(at)), pa.array(piece.astype(np.int32)),
                   pa.array(start), pa.array(length), pa.array(crc, pa.int64())]
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        if with_ids:
            columns.append(pa.ListArray.from_arrays(pa.array(np.append(begin, bounds[-1]).astype(np.int32)),
                                                    pa.array(ids.astype(np.int32))))
            names.append("ids")
        return pa.RecordBatch.from_arrays(columns, names)

    return docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(cut, schema)


def best_fit(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """A first packing: longest first, each into the fullest bin that has room. Returns the bin of each length."""
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    some = np.zeros(capacity + 1, bool)
    bins, count = np.empty(len(lengths), np.int64), 0
    for i in np.argsort(-lengths, kind="stable"):
        size = int(lengths[i])
        step = int(some[size:].argmax())
        room = size + step
        if some[room]:
            b = by_room[room].pop()
            some[room] = bool(by_room[room])
        else:
            b, count, room = count, count + 1, capacity
        bins[i] = b
        by_room[room - size].append(b)
        some[room - size] = True
    return bins


def _pairs(lengths: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct sums of two pieces of a bin, ascending, and two pieces for each."""
    own = own[np.argsort(lengths[own], kind="stable")]
    sizes = lengths[own]
    own = own[(sizes != np.roll(sizes, 2)) | (np.arange(len(own)) < 2)]  # of equal lengths two are enough
    a, b = np.triu_indices(len(own), 1)
    sums, one = np.unique(lengths[own[a]] + lengths[own[b]], return_index=True)
    return sums, own[a[one]], own[b[one]]


class _Bins:
    """Bins with their pieces, fills and sums of pairs."""

    def __init__(self, lengths: np.ndarray, bins: np.ndarray, capacity: int):
        n = int(bins.max(initial=-1)) + 1
        sizes = np.bincount(bins, minlength=n)
        self.lengths, self.capacity = lengths, capacity
        self.pieces = np.split(np.argsort(bins, kind="stable"), np.cumsum(sizes)[:-1])
        self.fill = np.bincount(bins, lengths, n).astype(np.int64)
        self.pairs = [_pairs(lengths, p) for p in self.pieces]

    def exchange(self, giver: int) -> tuple[int, np.ndarray, np.ndarray] | None:
        """The exchange that takes most out of ``giver`` and raises the squared fill: the other bin, the pieces that
        leave and those that come back. A move, if any piece fits elsewhere: the longest, to where the least room is
        left. Else one piece for one, two for one, or one for two. Of the giver's sorted lengths and sums, the largest
        that a place has room for is looked up for all places at once, so no pair of pieces is passed over."""
        room = self.capacity - self.fill
        own = self.pieces[giver][np.argsort(self.lengths[self.pieces[giver]], kind="stable")]
        mine = self.lengths[own]
        takers = np.flatnonzero((self.fill > 0) & (room > 0))
        takers = takers[takers != giver]
        if not len(takers):
            return None

        def gains(sums: np.ndarray, theirs: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            k = np.searchsorted(sums, theirs + room[where], "right") - 1
            net = np.where(k >= 0, sums[k] - theirs, 0)
            return np.where(self.fill[where] + net > self.fill[giver], net, 0), k

        net, k = gains(mine, np.zeros(len(takers), np.int64), takers)
        if net.max() > 0:
            best = np.flatnonzero(net == net.max())
            at = best[np.argmin(room[takers[best]])]
            return int(takers[at]), own[[k[at]]], own[:0]
        singles = np.concatenate([self.pieces[t] for t in takers])
        of_single = np.repeat(takers, [len(self.pieces[t]) for t in takers])
        doubles = np.concatenate([self.pairs[t][0] for t in takers])
        of_double = np.repeat(takers, [len(self.pairs[t][0]) for t in takers])
        best, found = 0, None
        sums, first, second = self.pairs[giver]
        for mine_now, parts in ((mine, [own]), (sums, [first, second])):
            if len(mine_now):
                net, k = gains(mine_now, self.lengths[singles], of_single)
                at = int(net.argmax())
                if net[at] > best:
                    best = int(net[at])
                    found = int(of_single[at]), np.array([p[k[at]] for p in parts]), singles[[at]]
        if len(doubles):
            net, k = gains(mine, doubles, of_double)
            at = int(net.argmax())
            if net[at] > best:
                taker = int(of_double[at])
                j = at - int(np.flatnonzero(of_double == taker)[0])
                found = taker, own[[k[at]]], np.array([self.pairs[taker][1][j], self.pairs[taker][2][j]])
        return found

    def change(self, giver: int, taker: int, out: np.ndarray, back: np.ndarray) -> None:
        for b, less, more in ((giver, out, back), (taker, back, out)):
            self.pieces[b] = np.concatenate((self.pieces[b][~np.isin(self.pieces[b], less)], more))
            self.fill[b] += self.lengths[more].sum() - self.lengths[less].sum()
            self.pairs[b] = _pairs(self.lengths, self.pieces[b])


def local_search(lengths: np.ndarray, bins: np.ndarray, capacity: int) -> np.ndarray:
    """Empty bins by exchanges that make fuller bins fuller, so that each raises the sum of squared fills.

    The emptiest bin gives, as long as an exchange takes something out of it (see ``_Bins.exchange``); then the next
    emptiest one that has not been tried since the last change. The search ends when the bins are as few as the total
    allows, or when as many bins in a row as there are have been tried without emptying one.
    """
    least = -(-int(lengths.sum()) // capacity)
    used = int(bins.max(initial=-1)) + 1
    if used <= least:
        return bins
    state, failed, changes = _Bins(lengths.astype(np.int64), bins, capacity), 0, 0
    tried: dict[int, int] = {}
    while used > least and failed < used:
        emptiest = np.argsort(np.where(state.fill > 0, state.fill, capacity + 1), kind="stable")[:used].tolist()
        giver = next((b for b in emptiest if tried.get(b) != changes), None)
        if giver is None:
            break
        before = changes
        while state.fill[giver] and (change := state.exchange(giver)) is not None:
            state.change(giver, *change)
            changes = before + 1
        tried[giver] = changes
        used, failed = (used - 1, 0) if not state.fill[giver] else (used, failed + 1)
    out = np.empty(len(lengths), np.int64)
    for k, b in enumerate(np.flatnonzero(state.fill)):
        out[state.pieces[b]] = k
    return out


def pack(pieces: DataFrame, capacity: int, length: str = "length", group_size: int = 16_000,
         pool_below: float = 0.995) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to every piece, so that each sequence holds at most ``capacity``.

    Pieces are dealt into groups of about ``group_size`` by their number, whatever their keys, and every group is packed
    for itself by best fit. What lies in sequences filled below ``pool_below`` is dealt and packed again across groups,
    by best fit and then local search: where best fit fills well, that is little, and where it does not, nearly all. A group is all that a task holds. Offsets in a sequence leave no gap. Pieces longer
    than ``capacity``, or not above 0, are refused by an error; an empty table gives an empty one.
    """
    number = unused("number", pieces)
    numbered = landed(pieces.withColumn(number, F.monotonically_increasing_id()), "packing-pieces", BATCH_MB)
    sizes = numbered.agg(F.min(length), F.max(length), F.count("*")).first()
    if sizes[2] and (sizes[0] is None or sizes[0] < 1 or sizes[1] > capacity):
        raise ValueError(f"lengths must lie between 1 and {capacity}")
    light = numbered.select(F.col(number).alias("_n"), F.col(length).cast("long").alias("_length"))
    first = landed(_packed(light, sizes[2], capacity, group_size, 0), "packing-first")
    full = first.filter(F.col("_fill") >= pool_below * capacity)
    rest = first.filter(F.col("_fill") < pool_below * capacity).select("_n", "_length")
    second = _packed(rest, rest.count(), capacity, group_size, 1)
    placed = full.unionByName(second).select(F.col("_n").alias(number), "sequence_id", "offset")
    return numbered.join(placed, number).drop(number)


def _packed(rows: DataFrame, count: int, capacity: int, group_size: int, turn: int) -> DataFrame:
    groups = max(1, -(-count // group_size))

    def one(group: tuple, batch: pd.DataFrame) -> pd.DataFrame:
        batch = batch.sort_values("_n", ignore_index=True)
        lengths = batch["_length"].to_numpy()
        bins = best_fit(lengths, capacity)
        if turn:
            bins = local_search(lengths, bins, capacity)
        order = np.lexsort((batch["_n"].to_numpy(), bins))
        ends = np.cumsum(lengths[order])
        begins = ends - lengths[order]
        starts = np.flatnonzero(np.diff(bins[order], prepend=-1))
        offset = np.empty(len(batch), np.int64)
        offset[order] = begins - np.repeat(begins[starts], np.diff(starts, append=len(batch)))
        return pd.DataFrame({
            "_n": batch["_n"], "_length": lengths, "offset": offset,
            "sequence_id": ((2 * int(group[0]) + turn) << 24) + bins,
            "_fill": np.bincount(bins, lengths).astype(np.int64)[bins]})

    # Rows are a few bytes each and groups much work, so their number of tasks is given and not made smaller.
    dealt = rows.withColumn("_group", F.pmod(F.xxhash64("_n"), F.lit(groups))).repartition(groups, "_group")
    return dealt.groupBy("_group").applyInPandas(
        one, "_n long, _length long, offset long, sequence_id long, _fill long")
