"""Near-duplicate groups by an n-gram Jaccard join with adaptive multi-match prefixes.

Shingles are ordered by how often they occur, rare ones first. Two similar sets share at least ``l`` shingles among the
first ``n - ceil(threshold * n) + l`` of each, for every ``l``. Each set takes the ``l`` whose longer prefix, with more
matches asked for, is estimated to cost least.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm import grams
from contrail.llm.tables import landed, marked, place_of, remove, settled

# Shingles whose frequency is known to every task, so a bound of what is broadcast; the others count as rare.
MAX_FREQUENT = 1 << 18
# The largest number of shared prefix shingles that a set may ask for.
MATCHES = 4
# Up to so many sets with the same prefix shingle are compared with each other; beyond, by way of a central one first.
SHORT_LIST = 24
# At most about so many sets of a component, with so many shingles together, are compared with as many others in one go
# when links are counted, by so many shingles at a time.
BLOCK, BLOCK_SHINGLES, COLUMNS = 2048, 1 << 20, 1024
# A set travels as the low five bytes of its shingles' hashes, in order, and with counts of these by their last bits.
HASH_BYTES, BINS = 5, 64
# A worker that reads or compares whole sets gets so much at a time.
BATCH_MB = 8
# Prefix shingles are met in so many parts, one after the other, so that only one part's are on the move at a time.
PARTS = 4

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Shingles:
    """The distinct shingle hashes of each text of a chunk: ``hashes``, ascending within a text, of text ``row``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, width: int):
        data = _LOWER[data]
        begin, end, starts = grams.words(data, offsets)
        sums = grams.Sums(grams.word_units(data, begin, end))
        count = np.diff(starts)
        at = np.arange(len(begin))
        text = np.repeat(np.arange(len(count)), count)
        at = at[at + width <= starts[text + 1]]
        short = np.flatnonzero((count > 0) & (count < width))  # the whole text is one shingle
        first = np.concatenate((at, starts[short]))
        last = np.concatenate((at + width, starts[short] + count[short]))
        hashes = grams.scramble(sums.of(first, last) + (last - first).astype(np.uint64))
        row = np.concatenate((text[at], short))
        order = np.lexsort((hashes, row))
        hashes, row = hashes[order], row[order]
        new = np.ones(len(row), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
        self.hashes, self.row = hashes[new], row[new]
        self.sizes = np.bincount(self.row, minlength=len(count))
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(grams.scramble(self.hashes))))
        ends = np.cumsum(self.sizes)
        sums_of = total[ends] - total[ends - self.sizes]
        self.nodes = grams.scramble(sums_of + self.sizes.astype(np.uint64)).view(np.int64)


def packed(hashes: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Lists of hashes, cut at ``bounds``, as bytes: five for each hash."""
    data = np.ascontiguousarray(hashes).view(np.uint8).reshape(-1, 8)[:, :HASH_BYTES].tobytes()
    return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [
        None, pa.py_buffer((bounds * HASH_BYTES).astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())


def unpacked(cells: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all cells one after the other, and the size of each cell."""
    parts = [np.frombuffer(cell.as_buffer(), np.uint8).reshape(-1, HASH_BYTES) for cell in cells]
    whole = np.concatenate(parts) if parts else np.empty((0, HASH_BYTES), np.uint8)
    wide = np.zeros((len(whole), 8), np.uint8)
    wide[:, :HASH_BYTES] = whole
    return wide.view(np.int64).ravel(), np.array([len(p) for p in parts], np.int64)


def counts_by_bin(hashes: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """How many hashes of each row fall into each bin, up to 255; a row of bytes each."""
    bins = (hashes.view(np.uint64) % np.uint64(BINS)).astype(np.int64)
    return np.minimum(np.bincount(row * BINS + bins, minlength=rows * BINS), 255).astype(np.uint8).reshape(rows, BINS)


def least_overlap(n: Column, percent: int) -> Column:
    """The smallest integer that is at least ``percent`` of ``n``."""
    return F.floor((n * percent + 99) / 100).cast("int")


def frequent_shingles(texts: DataFrame, width: int) -> np.ndarray:
    """The most frequent shingles over all texts, rarest first.

    Counting is lossy: within a batch of rows, sets that are equal count once and shingles of one set are left out. A
    shingle in more sets than there are batches is thus always counted. Only the order of shingles depends on this.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen, kept = set(), []
            for _, data, offsets in grams.chunks(batch.column(0)):
                sets = Shingles(data, offsets, width)
                fresh = np.zeros(len(sets.nodes), bool)
                for k, node in enumerate(sets.nodes.tolist()):
                    fresh[k] = node not in seen
                    seen.add(node)
                kept.append(sets.hashes[fresh[sets.row]])
            hashes, counts = np.unique(np.concatenate(kept), return_counts=True) if kept else (np.empty(0),) * 2
            yield pa.RecordBatch.from_arrays([
                pa.array(hashes[counts > 1].astype(np.uint64).view(np.int64)),
                pa.array(counts[counts > 1].astype(np.int64))], ["h", "n"])

    counted = landed(texts.select("text").mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")),
                     "shingle-counts")
    # How frequent a shingle must be for the bound, from the numbers of shingles by size of their counts.
    level = F.floor(F.log2("n") * 8).cast("int")
    taken, least = 0, None
    for at, number in sorted(counted.groupBy(level.alias("at")).count().collect(), reverse=True):
        taken += number
        if taken > MAX_FREQUENT:
            break
        least = at
    if least is None:
        return np.empty(0, np.int64)
    top = counted.filter(level >= least).toPandas()
    remove(texts.sparkSession, [place_of(counted)])
    return top.sort_values(["n", "h"])["h"].to_numpy(np.int64).copy()


def prefixes(texts: DataFrame, frequent: np.ndarray, width: int, percent: int) -> DataFrame:
    """``doc, node, n, prefix, bins``: the number of shingles of each text, a hash of its set as ``node``, the longest
    prefix that the set may need, and counts of its hashes by bin. Of equal sets in a batch only the first carries the
    two."""
    by_hash = np.argsort(frequent)
    known = texts.sparkSession.sparkContext.broadcast((frequent[by_hash], by_hash + 1))
    kind = dict(texts.dtypes)["doc"]

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, ranks = known.value
        for batch in batches:
            seen = set()
            for start, data, offsets in grams.chunks(batch.column(1)):
                sets = Shingles(data, offsets, width)
                h = sets.hashes.view(np.int64)
                rank = np.zeros(len(h), np.int64)
                if len(hashes):
                    at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
                    rank = np.where(hashes[at] == h, ranks[at], 0)
                order = np.lexsort((h, rank, sets.row))
                n = sets.sizes
                overlap = (n * percent + 99) // 100
                ends = np.cumsum(n)
                place = np.arange(len(h)) - np.repeat(ends - n, n)
                fresh = np.zeros(len(n), bool)
                for k, node in enumerate(sets.nodes.tolist()):
                    fresh[k] = n[k] > 0 and node not in seen
                    seen.add(node)
                length = np.where(fresh, n - overlap + np.minimum(MATCHES, overlap), 0)
                taken = h[order][place < np.repeat(length, n)]
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(length))), pa.int32()),
                                                 pa.array(taken))
                counts = counts_by_bin(sets.hashes, sets.row, len(n))
                bins = pa.array([b.tobytes() if f else None for b, f in zip(counts, fresh.tolist())], pa.binary())
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(start, len(n)), pa.array(sets.nodes), pa.array(n.astype(np.int32)), lists, bins],
                    ["doc", "node", "n", "prefix", "bins"])

    return texts.select("doc", "text").mapInArrow(
        look, f"doc {kind}, node long, n int, prefix array<long>, bins binary")


def _index(sets: DataFrame, percent: int) -> DataFrame:
    """``h, node, n, pos, ell, df``: the prefix shingles of every set at its own number of matches ``ell``, without
    sets that cannot have a partner.

    A set whose prefix for ``l`` matches holds fewer than ``l`` shingles that other prefixes hold is left out. Of the
    others' possible ``l`` the one with the least estimated cost counts: the lists to be read, whose lengths add up,
    and candidates to be verified, of which those with ``l`` matches are estimated as that sum divided by ``l`` squared.
    """
    tokens = sets.select("node", "n", F.posexplode("prefix").alias("pos", "h"))
    parts = []
    for part in range(PARTS):
        own = tokens.filter(F.pmod("h", F.lit(PARTS)) == part)
        twice = landed(own.groupBy("h").count().filter("count > 1").select("h"), "shared-shingles")
        parts.append(landed(own.join(twice, "h").groupBy("h", "node").agg(
            F.min("n").alias("n"), F.min("pos").alias("pos")), "shared-prefixes"))
    shared = reduce(DataFrame.unionByName, parts)
    lengths = landed(shared.groupBy("h").agg(F.count("*").alias("df")).filter("df > 1"), "shingle-frequencies")
    rows = landed(shared.join(lengths, "h"), "prefix-rows")
    overlap = least_overlap(F.col("n"), percent)
    inside = [F.col("pos") < F.col("n") - overlap + k for k in range(1, MATCHES + 1)]
    sums = rows.groupBy("node", "n").agg(
        *[F.count(F.when(x, 1)).alias(f"count{k}") for k, x in enumerate(inside, 1)],
        *[F.sum(F.when(x, F.col("df"))).alias(f"read{k}") for k, x in enumerate(inside, 1)])
    possible = F.lit(True)
    cost = []
    for k in range(1, MATCHES + 1):
        allowed = overlap >= k
        possible = possible & (~allowed | (F.col(f"count{k}") >= k))
        cost.append(F.when(allowed, F.struct((F.col(f"read{k}") * (1 + 20 / k ** 2)).alias("cost"),
                                             F.lit(k).alias("ell"))))
    chosen = sums.filter(possible).select("node", F.least(*cost)["ell"].alias("ell"))
    return rows.join(chosen, "node").filter(F.col("pos") < F.col("n") - overlap + F.col("ell")).select(
        "h", "node", "n", "pos", "ell", "df")


def _plausible(x: str, y: str, percent: int) -> Column:
    """Whether the overlap that two sets need fits what is left of both from a shared prefix shingle on."""
    need = F.floor((percent * (F.col(f"{x}.n") + F.col(f"{y}.n")) + 99 + percent) / (100 + percent))
    left = F.least(F.col(f"{x}.n") - F.col(f"{x}.pos"), F.col(f"{y}.n") - F.col(f"{y}.pos"))
    sizes = 100 * F.least(F.col(f"{x}.n"), F.col(f"{y}.n")) >= percent * F.greatest(F.col(f"{x}.n"), F.col(f"{y}.n"))
    return sizes & (left >= need)


def _candidates(index: DataFrame, percent: int) -> DataFrame:
    """``x, y`` (x < y): pairs from short lists that share the shingles they must.

    A pair needs the smaller ``ell`` of the two in common. It also needs its whole overlap: that is at most the common
    prefix shingles and what the longer remainder holds. Shingles with long lists count as common if both have them.
    """
    long_ones = index.groupBy("node").agg(F.count(F.when(F.col("df") > SHORT_LIST, 1)).alias("long"))
    rows = index.filter(F.col("df") <= SHORT_LIST).join(long_ones, "node")
    x, y = rows.alias("x"), rows.alias("y")
    pairs = x.join(y, (F.col("x.h") == F.col("y.h")) & (F.col("x.node") < F.col("y.node"))).groupBy(
        F.col("x.node").alias("x"), F.col("y.node").alias("y"), F.col("x.n").alias("nx"), F.col("y.n").alias("ny"),
        F.col("x.ell").alias("lx"), F.col("y.ell").alias("ly"), F.least("x.long", "y.long").alias("long")).agg(
        F.count("*").alias("common"), F.max(_plausible("x", "y", percent)).alias("plausible"))
    need = F.floor((percent * (F.col("nx") + F.col("ny")) + 99 + percent) / (100 + percent))
    rest = F.greatest(least_overlap(F.col("nx"), percent) - F.col("lx"), least_overlap(F.col("ny"), percent) - F.col("ly"))
    most = F.col("common") + F.col("long")
    # With shingles in long lists the first common one may be among those, and its place is not known here.
    return pairs.filter((F.col("plausible") | (F.col("long") > 0)) & (most >= F.least("lx", "ly"))
                        & (most + rest >= need)
                        & (100 * F.least("nx", "ny") >= percent * F.greatest("nx", "ny"))).select("x", "y", "common")


def _likely(pairs: DataFrame, short: DataFrame, percent: int) -> DataFrame:
    """The pairs that may be similar enough by ``short`` (``node, n, bins``): what two sets have in common is at most the
    sum of their smaller counts by bin (a full count, 255, bounds nothing). Lists are moved for these only."""
    one = pairs.join(short.select(F.col("node").alias("x"), F.col("n").alias("nx"), F.col("bins").alias("bx")), "x")
    both = one.join(short.select(F.col("node").alias("y"), F.col("n").alias("ny"), F.col("bins").alias("by")), "y")

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bx, by = (np.frombuffer(b"".join(c.as_buffer() for c in batch.column(k)), np.uint8).reshape(-1, BINS)
                      for k in (3, 5))
            nx, ny = (batch.column(k).to_numpy().astype(np.int64) for k in (2, 4))
            least = np.minimum(bx, by)
            most = np.where((least == 255).any(axis=1), np.minimum(nx, ny), least.sum(axis=1, dtype=np.int64))
            keep = pa.array(100 * most >= percent * (nx + ny - most))
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(keep) for k in (0, 1)], ["x", "y"])

    return both.select("x", "y", "nx", "bx", "ny", "by").mapInArrow(bound, "x long, y long")


def _verified(pairs: DataFrame, short: DataFrame, texts: DataFrame, docs: DataFrame, width: int,
              percent: int) -> DataFrame:
    """The pairs whose sets are similar enough, by the sets themselves; ``docs`` (``node, doc``) says where to read one."""
    likely = landed(_likely(pairs, short, percent), "likely-pairs", BATCH_MB)
    nodes = likely.select(F.explode(F.array("x", "y")).alias("node")).distinct()
    lists = landed(_sets(texts, docs.join(nodes, "node", "left_semi"), width), "similar-sets", BATCH_MB)
    one = likely.join(lists.select(F.col("node").alias("x"), F.col("hashes").alias("xs")), "x")
    both = one.join(lists.select(F.col("node").alias("y"), F.col("hashes").alias("ys")), "y").select("x", "y", "xs", "ys")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for k in range(batch.num_rows):
                (a, _), (b, _) = (unpacked(batch.column(c).slice(k, 1)) for c in (2, 3))
                common = len(a) + len(b) - len(np.union1d(a, b))
                keep.append(100 * common >= percent * (len(a) + len(b) - common))
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep, pa.bool_())) for c in batch.columns[:2]],
                                             ["x", "y"])

    return both.mapInArrow(compare, "x long, y long")


def _sets(texts: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``node, hashes`` of the wanted ``doc, node``, once for each node.

    The node is worked out from the text, as rows of one ``doc`` may hold different sets; a null ``doc`` is one like
    others.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in grams.chunks(batch.column(0)):
                sets = Shingles(data, offsets, width)
                bounds = np.concatenate(([0], np.cumsum(sets.sizes)))
                yield pa.RecordBatch.from_arrays([pa.array(sets.nodes), packed(sets.hashes, bounds)], ["node", "hashes"])

    held = marked(texts.select("doc", "text"), "doc", wanted, "doc", "asked").filter("asked")
    rows = held.select("text").mapInArrow(read, "node long, hashes binary")
    return rows.join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"])


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``node, comp``: the smallest node that links reach, by passing on the smallest label and following labels."""
    both = landed(links.select("x", "y").unionByName(links.select(F.col("y").alias("x"), F.col("x").alias("y"))), "links")
    labels = landed(nodes.select("node", F.col("node").alias("comp")), "labels")

    def passed_on(labels: DataFrame) -> DataFrame:
        near = both.join(labels, both["y"] == labels["node"]).groupBy("x").agg(F.min("comp").alias("near"))
        nearer = labels.join(near, labels["node"] == near["x"], "left").select(
            "node", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        onward = labels.select(F.col("node").alias("_at"), F.col("comp").alias("_on"))
        return nearer.join(onward, nearer["comp"] == onward["_at"]).select(
            "node", "old", F.least("comp", "_on").alias("comp"))

    while True:
        before, labels = labels, landed(passed_on(labels.select("node", "comp")), "labels")
        remove(labels.sparkSession, [place_of(before)])
        if labels.filter("comp < old").isEmpty():
            return labels.select("node", "comp")


def _partners(table: pa.Table, percent: int) -> pa.Table:
    """``node, links``: the rows of the sets that each set of two blocks of a component links to across the blocks, or
    within the block if both are one."""
    hashes, sizes = unpacked(table.column("hashes").combine_chunks())
    block, a, b = (table.column(c).to_numpy() for c in ("block", "a", "b"))
    rows = table.column("rows").to_numpy()
    left, right = np.flatnonzero(block == a), np.flatnonzero(block == b)
    _, column, held = np.unique(hashes, return_inverse=True, return_counts=True)
    # A shingle of one set is in no intersection.
    column = np.where(held > 1, np.cumsum(held > 1) - 1, -1)[column]
    owner = np.repeat(np.arange(len(sizes)), sizes)[column >= 0]
    column = column[column >= 0]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    common = np.zeros((len(left), len(right)), np.int32)
    for start in range(0, int(column.max(initial=-1)) + 1, COLUMNS):
        part = slice(*np.searchsorted(column, (start, start + COLUMNS)))
        has = np.zeros((len(sizes), COLUMNS), np.float32)
        has[owner[part], column[part] - start] = 1
        common += (has[left] @ has[right].T).astype(np.int32)
    linked = (100 + percent) * common.astype(np.int64) >= percent * (sizes[left][:, None] + sizes[right])
    links = np.zeros(len(sizes), np.int64)
    if a[0] == b[0]:
        np.fill_diagonal(linked, False)
        links[left] = linked @ rows[right]
    else:
        links[left] = linked @ rows[right]
        links[right] = linked.T @ rows[left]
    return pa.table({"node": table.column("node"), "links": pa.array(links)})


def _links(final: DataFrame, own: DataFrame, short: DataFrame, texts: DataFrame, docs: DataFrame, width: int,
           percent: int) -> DataFrame:
    """``node, links``: the number of rows of other sets that a set links to.

    All links lie within components. Of two sets in one each links to the other; in larger ones every set is compared
    with every other, block by block, so the work grows with the square of a component, as the links may. A block holds
    ``BLOCK`` sets or ``BLOCK_SHINGLES`` shingles, so a set is sent out once for each such part of its component.
    """
    sized = final.join(short.select("node", "n"), "node")
    sizes = sized.groupBy("comp").agg(F.count("*").alias("size"), F.sum("n").alias("shingles")).filter("size > 1")
    members = landed(final.join(sizes, "comp").join(own.select("node", "rows"), "node"), "component-members")
    two = members.filter("size = 2").select("comp", "node", "rows")
    pairs = two.alias("x").join(two.alias("y"), (F.col("x.comp") == F.col("y.comp")) & (F.col("x.node") != F.col("y.node")))
    blocks = F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("shingles") / BLOCK_SHINGLES))
    larger = members.filter("size > 2")
    sets = landed(_sets(texts, docs.join(larger.select("node"), "node", "left_semi"), width), "component-sets", BATCH_MB)
    dealt = larger.withColumn("block", F.pmod(F.xxhash64("node"), blocks)).join(sets, "node").select(
        "comp", "node", "rows", "hashes", "block", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("other"))
    met = dealt.select("comp", "node", "rows", "hashes", "block", F.least("block", "other").alias("a"),
                       F.greatest("block", "other").alias("b")).groupBy("comp", "a", "b").applyInArrow(
        lambda table: _partners(table, percent), "node long, links long")
    return pairs.select("x.node", F.col("y.rows").alias("links")).unionByName(met).groupBy("node").agg(
        F.sum("links").alias("links"))


def near_duplicates(docs: DataFrame, key: str, text: str, width: int = 5, percent: int = 80,
                    count_links: bool = False) -> DataFrame:
    """For each row: the key as ``doc``, ``n_shingles`` and ``component``, the smallest key that links reach; with
    ``count_links`` also ``n_links``, the number of other rows it links to, copies included.

    Two texts link when their intersection is at least ``percent`` percent of their union. A set holds the distinct
    ``width``-word shingles, A-Z lower-cased; a text of fewer words is one shingle, and a text without words, or a null
    one, has none and no links: its component is its own key. Rows of equal sets link, repeated rows too. A null key
    is a row that links like others and has the smallest key it reaches, null if there is none. Other columns are not
    read.

    Equal sets are one node. Where a prefix shingle has at most ``SHORT_LIST`` sets, they are compared with each other.
    In a longer list each set is first compared with a central one, the set with the fewest rare shingles; after that
    only sets that are still in different components are paired, if the rest of both sets leaves room for the overlap.
    That finds all components but not all links; to count these, the sets of each component are compared again.
    """
    return settled(lambda: _groups(docs, key, text, width, percent, count_links), "near-duplicates")


def _groups(docs: DataFrame, key: str, text: str, width: int, percent: int, count_links: bool) -> DataFrame:
    texts = docs.select(F.col(f"`{key}`").alias("doc"), F.col(f"`{text}`").alias("text"))
    found = landed(prefixes(texts, frequent_shingles(texts, width), width, percent), "shingle-sets")
    index = settled(lambda: _index(found.filter("size(prefix) > 0"), percent), "prefix-index")
    short = landed(found.filter("bins is not null").dropDuplicates(["node"]).select("node", "n", "bins"), "set-bins")
    whole, found = found, landed(found.drop("prefix", "bins"), "shingle-nodes")
    remove(docs.sparkSession, [place_of(whole)])

    # The centre of a long list, and for each set the centre it shares most lists with.
    long_rows = index.filter(F.col("df") > SHORT_LIST)
    centres = long_rows.groupBy("h").agg(F.min(F.struct("pos", "node", "n")).alias("c"))
    stars = (long_rows.alias("x").join(centres, "h").filter("c.node != node")
             .filter(100 * F.least("n", "c.n") >= percent * F.greatest("n", "c.n"))
             .groupBy("node", F.col("c.node").alias("centre")).count()
             .groupBy("node").agg(F.max(F.struct("count", "centre")).alias("best"))
             .select(F.least("node", "best.centre").alias("x"), F.greatest("node", "best.centre").alias("y")))
    candidates = landed(_candidates(index, percent), "similar-candidates")
    # Of the pairs of short lists each set's likeliest goes first; many others then lie within a component.
    likely = candidates.select(F.explode(F.array(F.struct(F.col("x").alias("node"), F.col("y").alias("other"), "common"),
                                                 F.struct(F.col("y").alias("node"), F.col("x").alias("other"), "common")
                                                 )).alias("p")).groupBy("p.node").agg(
        F.max(F.struct("p.common", "p.other")).alias("best")).select(
        F.least("node", "best.other").alias("x"), F.greatest("node", "best.other").alias("y"))
    first = landed(stars.unionByName(likely).distinct(), "first-pairs")

    nodes = landed(index.select("node").distinct(), "similar-nodes")
    rep = landed(found.groupBy("node").agg(F.min("doc").alias("doc")).join(nodes, "node"), "similar-documents")
    links = settled(lambda: _verified(first, short, texts, rep, width, percent), "first-links", BATCH_MB)
    labels = components(nodes, links)

    def apart(pairs: DataFrame) -> DataFrame:
        a = labels.select(F.col("node").alias("x"), F.col("comp").alias("cx"))
        b = labels.select(F.col("node").alias("y"), F.col("comp").alias("cy"))
        return pairs.join(a, "x").join(b, "y").filter("cx != cy").select("x", "y")

    # Long lists: sets outside of the list's largest component meet the others.
    placed = landed(long_rows.join(labels, "node"), "long-lists")
    sizes = placed.groupBy("h", "comp").agg(F.count("*").alias("size"), F.min("n").alias("least"))
    lists = sizes.groupBy("h").agg(F.count("*").alias("comps"), F.max(F.struct("size", "comp"))["comp"].alias("main"),
                                   F.min("least").alias("least")).filter("comps > 1")
    split = landed(placed.join(lists, "h"), "split-lists")
    need = F.floor((percent * (F.col("n") + F.col("least")) + 99 + percent) / (100 + percent))
    outer = split.filter("comp != main").filter(F.col("n") - F.col("pos") >= need)
    across = (outer.alias("x").join(split.alias("y"), "h")
              .filter((F.col("x.comp") != F.col("y.comp")) & _plausible("x", "y", percent))
              .select(F.least("x.node", "y.node").alias("x"), F.greatest("x.node", "y.node").alias("y")))
    rest = landed(apart(candidates.select("x", "y").unionByName(across).distinct()).join(
        first, ["x", "y"], "left_anti"), "other-pairs")
    more = settled(lambda: _verified(rest, short, texts, rep, width, percent), "other-links", BATCH_MB)
    final = components(nodes, links.unionByName(more))

    least = found.groupBy("node").agg(F.min("doc").alias("doc")).join(final, "node").groupBy("comp").agg(
        F.min("doc").alias("component"))
    known = landed(final.join(least, "comp").select("node", "component"), "node-components")
    own = found.filter("n > 0").groupBy("node").agg(F.min("doc").alias("least"), F.count("*").alias("rows"))
    named = own.join(known, "node", "left").select("node", "rows", F.coalesce("component", "least").alias("component"))
    columns = ["doc", F.col("n").cast("long").alias("n_shingles"),
               F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc")).alias("component")]
    if count_links:
        named = named.join(settled(lambda: _links(final, own, short, texts, rep, width, percent), "link-counts"), "node", "left")
        linked = F.coalesce("links", F.lit(0)) + F.col("rows") - 1
        columns.append(F.when(F.col("n") > 0, linked).otherwise(F.lit(0)).alias("n_links"))
    return found.alias("f").join(named, "node", "left").select(*columns)
