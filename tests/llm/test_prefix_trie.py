"""The prefix trie against one built node by node."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from contrail.llm import prefix_trie

import plain

SCHEMA = "conv_id long, turn long, role string, text string"


def by_hand(convs):
    """Rows by (smallest member, depth) of conversations given as lists of (role, text)."""
    members, children, out = {}, {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)

    def below(node):
        yield node
        for child in children.get(node, []):
            yield from below(child)

    for node, inside in members.items():
        under = list(below(node))
        ends = ",".join(str(c) for c in sorted(c for c in inside if len(convs[c]) == len(node)))
        out[min(inside), len(node)] = (
            min(members[node[:-1]]) if node else None, len(inside), len(children.get(node, [])),
            sum(u not in children for u in under),
            sum((len(members[u]) - 1) * (len(plain.words(u[-1][1])) if u else 0) for u in under),
            hashlib.sha256(ends.encode()).hexdigest())
    return out


def built(spark, rows, block, heads=None):
    df = spark.createDataFrame(rows, SCHEMA).withColumns(
        {c: F.lit(1) for c in ("conv", "place", "digest", "words", "segment", "k")}).repartition(3)
    turns = prefix_trie.numbered_turns(df, "conv_id", "turn", "role", "text")
    convs = turns.select("conv").distinct()
    if heads is not None:
        turns = prefix_trie.rebuilt_turns(turns, spark.createDataFrame(heads, "conv long, donor long, h int"))
    trie = prefix_trie.prefix_trie(turns, convs, block)
    nothing = hashlib.sha256(b"").hexdigest()
    found = trie.nodes.join(prefix_trie.joined_ids(trie.ends, 1).withColumnRenamed("top", "conv"), ["conv", "depth"], "left")
    return {(r.conv, r.depth): (r.parent, r.n_convs, r.n_children, r.n_leaves, r.saved, r.ends or nothing)
            for r in found.collect()}


def random_convs(seed, n, longest):
    rng, out = random.Random(seed), {}
    for c in rng.sample(range(1000), n):
        base = list(rng.choice(list(out.values()))) if out and rng.random() < 0.7 else []
        base = base[:rng.randint(0, len(base))]
        base += [(rng.choice(["user", "bot"]), rng.choice(["a b", "c", "", "d  e\tf"])) for _ in range(rng.randint(0, longest))]
        out[c] = base or [("user", "a b")]
    return out


@pytest.mark.parametrize("seed, block", [(1, 1), (2, 2), (3, 4), (4, 3)])
def test_like_a_trie_built_by_hand(spark, seed, block):
    convs = random_convs(seed, 40, 7)
    rows = [(c, i if i else None, *t) for c, turns in convs.items() for i, t in enumerate(turns)]
    assert built(spark, rows, block) == by_hand(convs)


def test_a_shared_beginning_of_many_and_a_long_conversation(spark):
    convs = {c: [("user", "hello you")] + [("bot", f"t{c % 7}")] * (c % 3) for c in range(300)}
    convs[300] = [("user", "hello you")] + [("bot", "w")] * 90
    convs[301] = convs[300][:88]
    rows = [(c, i, *t) for c, turns in convs.items() for i, t in enumerate(turns)]
    prefix_trie._SEGMENT, before = 8, prefix_trie._SEGMENT
    try:
        assert built(spark, rows, 4) == by_hand(convs)
    finally:
        prefix_trie._SEGMENT = before


def test_borrowed_beginnings(spark):
    convs = random_convs(9, 30, 5)
    ids = sorted(convs)
    heads = [(c, random.Random(c).choice([*ids, -1]), c % 4) for c in ids]
    rebuilt = {c: convs.get(donor, [])[:h] + convs[c][h:] for c, donor, h in heads}
    rows = [(c, i, *t) for c, turns in convs.items() for i, t in enumerate(turns)]
    assert any(not turns for turns in rebuilt.values()) or built(spark, rows, 4, heads) == by_hand(rebuilt)
    heads = [(c, -1, 3) for c in ids]  # some are left without turns
    assert built(spark, rows, 4, heads) == by_hand({c: convs[c][3:] for c in ids})


def test_odd_rows(spark):
    rows = [(None, 1, "user", "x"), (1, None, None, None), (1, None, None, None), (2, None, "", ""), (3, 5, "u", "w " * 30_000),
            (-7, -5000, "u", "a"), (-7, 9000, "u", "b")]
    convs = {1: [("", ""), ("", "")], 2: [("", "")], 3: [("u", "w " * 30_000)], -7: [("u", "a"), ("u", "b")]}
    assert built(spark, rows, 4) == by_hand(convs)
    assert built(spark, rows[:1], 4) == {}
    assert built(spark, [], 4) == {}
    alone = {(-3, 0): (None, 1, 0, 1, 0, hashlib.sha256(b"-3").hexdigest())}
    assert built(spark, [(-3, 1, "u", "a")], 4, [(-3, -1, 1)]) == alone
