"""The prefix trie of conversations: which beginnings they share, by fixed-length block hashing.

Turns are cut into blocks of a fixed number. A sequence of turns is known by its digest: two 64-bit hashes of every turn
with its place, combined by exclusive or, so the digest of a longer sequence follows from that of a shorter one and of
the block between. Conversations are first grouped by the digests of their successive blocks; only where the groups
behind one beginning differ in a block is that block taken apart into turns and grouped again. Everything is a join, a
window or an aggregate of the engine; a turn travels as a digest of 16 bytes, never as text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.tables import landed
from contrail.llm.text import blank_words

BLOCK = 4
_SEGMENT = 4096


@dataclass(frozen=True)
class Trie:
    """``nodes``: one row for each distinct beginning. ``ends``: for each conversation the node that is all of it, as
    ``conv`` and the node's key ``top`` (its smallest member) and ``depth``."""

    nodes: DataFrame
    ends: DataFrame


# ---- turns

def numbered_turns(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv``, ``place`` from 1, the 16-byte ``digest`` of role and text and the ``words`` of the text.

    In the order of ``turn``, null first; equal ones by role, then by digest. A null role or text is an empty one. Rows
    without a conversation are left out, repeated rows are turns like others. Places are counted within segments of
    ``_SEGMENT`` turn numbers and the segments' counts added, so a long conversation is not one task's.
    """
    spoken = F.coalesce(F.col(f"`{role}`").cast("string"), F.lit(""))
    said = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = df.filter(F.col(f"`{conv}`").isNotNull()).select(
        F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"), spoken.alias("role"),
        F.unhex(F.md5(F.concat(F.octet_length(spoken).cast("string"), F.lit(":"), spoken, said).cast("binary"))).alias("digest"),
        F.size(blank_words(F.col(f"`{text}`").cast("string"))).cast("long").alias("words"))
    rows = rows.withColumn("segment", F.floor(F.col("turn") / _SEGMENT))
    inside = Window.partitionBy("conv", "segment").orderBy(F.asc_nulls_first("turn"), "role", "digest")
    before = Window.partitionBy("conv").orderBy(F.asc_nulls_first("segment")).rowsBetween(
        Window.unboundedPreceding, -1)
    sizes = rows.groupBy("conv", "segment").count().select(
        F.col("conv").alias("c"), F.col("segment").alias("s"),
        F.coalesce(F.sum("count").over(before), F.lit(0)).alias("earlier"))
    placed = rows.withColumn("inner", F.row_number().over(inside))
    return placed.join(sizes, F.col("conv").eqNullSafe(F.col("c")) & F.col("segment").eqNullSafe(F.col("s"))).select(
        "conv", (F.col("inner") + F.col("earlier")).alias("place"), "digest", "words")


def rebuilt_turns(turns: DataFrame, heads: DataFrame) -> DataFrame:
    """Conversations whose first turns are another's: ``heads`` has ``conv``, ``donor`` and ``h``, and each conversation
    becomes the first ``h`` turns of the donor (fewer if it has fewer), then its own turns after its first ``h``."""
    most = heads.agg(F.max("h")).first()[0] or 0
    first = turns.filter(F.col("place") <= most).select(F.col("conv").alias("donor"), "place", "digest", "words")
    lent = heads.join(first, "donor").filter(F.col("place") <= F.col("h")).select("conv", "place", "digest", "words")
    got = lent.groupBy("conv").agg(F.count("*").alias("got"))
    shifts = heads.join(got, "conv", "left").select("conv", "h", F.coalesce("got", F.lit(0)).alias("got"))
    own = turns.join(shifts, "conv").filter(F.col("place") > F.col("h")).select(
        "conv", (F.col("place") - F.col("h") + F.col("got")).alias("place"), "digest", "words")
    return lent.select("conv", F.col("place").cast("long"), "digest", "words").unionByName(own)


# ---- blocks

def _xor(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, v: a.bitwiseXOR(v))


def _running(df: DataFrame, by: str, order: str, whole: dict[str, Column], after: bool) -> DataFrame:
    """Columns combined over the rows of a conversation up to each row, or with ``after`` over the rows behind it; in
    segments first and over segments then, so that no window holds a long conversation's rows. ``whole`` has an
    aggregate function by column name; it is used for rows and, under the same name, for segments."""
    direction = F.desc if after else F.asc
    end = -1 if after else 0
    seg = F.floor(F.col(order) / _SEGMENT)
    rows = df.withColumn("segment", seg)
    inside = Window.partitionBy(by, "segment").orderBy(direction(order)).rowsBetween(Window.unboundedPreceding, end)
    across = Window.partitionBy(by).orderBy(direction("segment")).rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(by, "segment").agg(*[f.alias(n) for n, f in whole.items()])
    earlier = totals.select(F.col(by).alias("o_by"), F.col("segment").alias("o_segment"),
                            *[f.over(across).alias(f"o_{n}") for n, f in whole.items()])
    run = rows.select("*", *[f.over(inside).alias(f"i_{n}") for n, f in whole.items()])
    return run.join(earlier, (F.col(by) == F.col("o_by")) & (F.col("segment") == F.col("o_segment"))).drop(
        "o_by", "o_segment", "segment")


def blocks_of(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """Blocks of the conversations: ``conv``, block number ``k``, digests ``qa, qb`` of all turns before it and
    ``pa, pb`` up to its end, and arrays over its turns: ``ta, tb`` hashes of turn and place, ``words``."""
    hashed = turns.select(
        "conv", ((F.col("place") - 1) / block).cast("long").alias("k"), "place", "words",
        F.xxhash64("place", "digest").alias("ta"), F.xxhash64("digest", "place").alias("tb"))
    cut = hashed.groupBy("conv", "k").agg(F.array_sort(F.collect_list(F.struct("place", "ta", "tb", "words"))).alias("t"))
    cut = cut.select("conv", "k", F.col("t.ta").alias("ta"), F.col("t.tb").alias("tb"), F.col("t.words").alias("words"))
    cut = cut.withColumns({"da": _xor(F.col("ta")), "db": _xor(F.col("tb"))})
    run = _running(cut, "conv", "k", {"da": F.bit_xor("da"), "db": F.bit_xor("db")}, after=False)

    def upto(n: str) -> Column:
        return F.col(f"i_{n}").bitwiseXOR(F.coalesce(f"o_{n}", F.lit(0)))

    return run.select("conv", "k", upto("da").bitwiseXOR(F.col("da")).alias("qa"),
                      upto("db").bitwiseXOR(F.col("db")).alias("qb"), upto("da").alias("pa"), upto("db").alias("pb"),
                      "ta", "tb", "words")


def _prefixes(column: str, start: str) -> Column:
    """The digests of the sequences that end at each turn of a block, given the digest of what lies before it."""
    ends = F.sequence(F.lit(1), F.size(column))
    return F.transform(ends, lambda e: F.col(start).bitwiseXOR(_xor(F.slice(F.col(column), F.lit(1), e))))


GROUP = ["k", "qa", "qb", "pa", "pb"]
NODE = ["depth", "a", "b"]


def _turns_of_groups(groups: DataFrame, block: int, extra: list[Column]) -> DataFrame:
    """The turns of every group of equal blocks: ``depth``, digest ``a, b`` of the sequence that ends there, and that
    before it, ``ua, ub``."""
    each = F.arrays_zip(_prefixes("ta", "qa").alias("a"), _prefixes("tb", "qb").alias("b"), F.col("words").alias("w"))
    opened = groups.withColumn("each", each).select("*", F.posexplode("each").alias("at", "turn"))
    return opened.select(
        (F.col("k") * block + F.col("at") + 1).alias("depth"), F.col("turn.a").alias("a"), F.col("turn.b").alias("b"),
        F.when(F.col("at") == 0, F.col("qa")).otherwise(F.col("each")[F.col("at") - 1]["a"]).alias("ua"),
        F.when(F.col("at") == 0, F.col("qb")).otherwise(F.col("each")[F.col("at") - 1]["b"]).alias("ub"),
        F.col("at"), F.col("words"), *extra)


def prefix_trie(turns: DataFrame, convs: DataFrame, block: int = BLOCK) -> Trie:
    """The trie of all beginnings of the conversations ``convs.conv``, whose turns are ``turns`` (``conv``, ``place``
    from 1 without gaps, ``digest``, ``words``); conversations without turns belong to the root.

    A node's key is its smallest member ``conv`` and its ``depth``: ``parent``, ``n_convs`` members, ``n_children``,
    ``n_leaves`` childless nodes in its subtree, and ``saved``: the words that its subtree's nodes would repeat if each
    member brought its own. No row is passed from node to node: a subtree's sums are sums over the members of what each
    has behind this node, since every node is owned by its smallest member, which is a member of all nodes above too.
    """
    blocks = landed(blocks_of(turns, block), "trie-blocks")
    convs = convs.select("conv")
    groups = blocks.groupBy(*GROUP).agg(
        F.count("*").alias("n"), F.min("conv").alias("top"), F.min("ta").alias("ta"), F.min("tb").alias("tb"),
        F.min("words").alias("words"))
    siblings = groups.groupBy("k", "qa", "qb").agg(F.count("*").alias("siblings"))
    groups = landed(groups.join(siblings, ["k", "qa", "qb"]), "trie-groups")

    # Where all go on alike a block is a chain; where they part, its turns are grouped once more.
    extra = [F.col("n"), F.col("top")]
    alike = _turns_of_groups(groups.filter("siblings = 1"), block, extra)
    apart = _turns_of_groups(groups.filter("siblings > 1"), block, extra)
    columns = [*NODE, "ua", "ub", "n", "top"]
    merged = apart.groupBy(*NODE, "ua", "ub").agg(F.sum("n").alias("n"), F.min("top").alias("top"))
    members = convs.agg(F.count("*").alias("n"), F.min("conv").alias("top")).filter("n > 0")
    zero = F.lit(0).cast("long")
    root = members.select(zero.alias("depth"), zero.alias("a"), zero.alias("b"), F.lit(None).cast("long").alias("ua"),
                          F.lit(None).cast("long").alias("ub"), "n", "top")
    nodes = landed(alike.select(*columns).unionByName(merged.select(*columns)).unionByName(root.select(*columns)),
                   "trie-nodes")

    up = nodes.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("ua"), F.col("b").alias("ub"),
                      F.col("top").alias("parent"))
    linked = landed(nodes.join(up, ["depth", "ua", "ub"], "left").select(*NODE, "n", "top", "parent"), "trie-linked")
    children = linked.filter("depth > 0").groupBy(F.col("parent").alias("top"), (F.col("depth") - 1).alias("depth")).agg(
        F.count("*").alias("n_children"))
    linked = landed(linked.join(children, ["top", "depth"], "left").fillna(0, ["n_children"]), "trie-children")

    # What a conversation owns: all its nodes from one depth on. It owns a leaf if its last node has no child.
    owners = landed(linked.groupBy(F.col("top").alias("conv")).agg(
        F.min("depth").alias("since"), F.max((F.col("n_children") == 0).cast("int")).alias("leaf")), "trie-owners")
    sums = _subtree_sums(blocks, groups, owners, block)
    found = linked.join(sums, NODE, "left").select(
        F.col("top").alias("conv"), "depth", "parent", F.col("n").alias("n_convs"), "n_children", "n_leaves", "saved")
    last = blocks.groupBy("conv").agg(F.max(F.struct("k", F.size("words").alias("size"), "pa", "pb")).alias("end"))
    ends = convs.join(last, "conv", "left").select(
        "conv", F.coalesce(F.col("end.k") * block + F.col("end.size"), zero).alias("depth"),
        F.coalesce("end.pa", zero).alias("a"), F.coalesce("end.pb", zero).alias("b"))
    return Trie(found, ends.join(linked.select(*NODE, "top"), NODE).select("conv", "top", "depth"))


def _subtree_sums(blocks: DataFrame, groups: DataFrame, owners: DataFrame, block: int) -> DataFrame:
    """``n_leaves`` and ``saved`` by node. For a member, a turn saves its words unless the member owns its node."""
    per_conv = blocks.select("conv", *GROUP, "words").join(owners, "conv", "left")
    at = F.col("k") * block + 1  # depth of the block's first turn
    owned = F.aggregate(F.slice("words", F.greatest(F.lit(1), F.least(
        F.col("since") - at + 1, F.size("words") + 1)).cast("int"), F.size("words")),
        F.lit(0).cast("long"), lambda a, w: a + w)
    every = F.aggregate("words", F.lit(0).cast("long"), lambda a, w: a + w)
    per_conv = per_conv.withColumn("here", every - F.when(F.col("since").isNull(), 0).otherwise(owned))
    behind = _running(per_conv.select("conv", *GROUP, "here", "leaf"), "conv", "k", {"here": F.sum("here")}, after=True)
    later = F.coalesce("i_here", F.lit(0)) + F.coalesce("o_here", F.lit(0))
    of_groups = behind.groupBy(*GROUP).agg(F.sum(later).alias("behind"), F.sum(F.coalesce("leaf", F.lit(0))).alias("leaves"))

    rows = groups.join(of_groups, GROUP).join(
        owners.select(F.col("conv").alias("top"), F.col("since")), "top", "left")
    turns = _turns_of_groups(rows, block, [F.col(c) for c in ("n", "behind", "leaves", "since", "siblings")])
    # Of this block: the turns from this one on, for every member, less those that the group's smallest member owns.
    first = F.col("depth") - F.col("at")
    rest = F.aggregate(F.slice("words", F.col("at") + 1, F.size("words")), F.lit(0).cast("long"), lambda a, w: a + w)
    own = F.aggregate(
        F.slice("words", F.least(F.greatest(F.col("at") + 1, F.coalesce(F.col("since") - first + 1, F.size("words") + 1)),
                                 F.size("words") + 1).cast("int"), F.size("words")),
        F.lit(0).cast("long"), lambda a, w: a + w)
    turns = turns.select(*NODE, "siblings", "leaves", (F.col("behind") + F.col("n") * rest - own).alias("saved"))
    apart = turns.filter("siblings > 1").groupBy(*NODE).agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved"))
    alike = turns.filter("siblings = 1").select(*NODE, F.col("leaves").alias("n_leaves"), "saved")
    # The root: all conversations with all they have.
    zero = F.lit(0).cast("long")
    parts = owners.select(F.col("leaf").cast("long").alias("n_leaves"), zero.alias("saved")).unionByName(
        per_conv.select(zero.alias("n_leaves"), F.col("here").alias("saved")))
    root = parts.agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved")).filter(
        "n_leaves is not null").select(zero.alias("depth"), zero.alias("a"), zero.alias("b"), "n_leaves", "saved")
    return alike.unionByName(apart).unionByName(root)


def joined_ids(ends: DataFrame, chunk_bits: int = 12) -> DataFrame:
    """For every node that conversations end in, the SHA-256 of their ids, ascending and joined by commas.

    Ids are put together in chunks by value first, of ``2**chunk_bits`` ids at most where they are distinct, and a node's
    chunks go through the hash one after the other: a node with a third of all conversations costs its task a stream of
    chunks and the memory of one.
    """
    import hashlib

    import pyarrow as pa

    chunked = ends.groupBy("top", "depth", F.shiftright("conv", chunk_bits).alias("chunk")).agg(
        F.array_join(F.sort_array(F.collect_list("conv")).cast("array<string>"), ",").alias("ids"))

    def hashed(batches):
        node, state = None, None
        for batch in batches:
            tops, depths, out = [], [], []
            for top, depth, ids in zip(*(batch.column(c).to_pylist() for c in ("top", "depth", "ids"))):
                if node == (top, depth):
                    state.update(b"," + ids.encode())
                    continue
                if node is not None:
                    tops.append(node[0]), depths.append(node[1]), out.append(state.hexdigest())
                node, state = (top, depth), hashlib.sha256(ids.encode())
            yield shaped(tops, depths, out)
        if node is not None:
            yield shaped([node[0]], [node[1]], [state.hexdigest()])

    def shaped(tops, depths, out):
        return pa.RecordBatch.from_arrays(
            [pa.array(tops, pa.int64()), pa.array(depths, pa.int64()), pa.array(out, pa.string())],
            ["top", "depth", "ends"])

    return chunked.repartition("top", "depth").sortWithinPartitions("top", "depth", "chunk").mapInArrow(
        hashed, "top long, depth long, ends string")
