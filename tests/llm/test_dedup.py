"""Substring, byte and near-duplicate operators against plain versions."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from contrail.llm import grams, jaccard_join, seeds, suffix_dedup
from contrail.llm.jaccard_join import near_duplicates
from contrail.llm.substring_dedup import dedup_substrings
from contrail.llm.suffix_dedup import dedup_bytes

import plain

ODD = [(None, "a b c d e f g h"), (1, None), (2, ""), (3, " \t\n "), (4, "x"), (5, "é ü\xa0ß 日本 \x1f z"),
       (6, "w" * 9000 + " v" * 9000), (7, "w" * 9000 + " v" * 9000), (8, "a b c d e f g h"), (8, "a b c d e f g h")]


def frame(spark, rows):
    """Rows of id and text, with extra columns that have working names."""
    wide = [(t, d, 1, "x", 2) for d, t in rows]
    return spark.createDataFrame(wide, "text string, doc_id long, doc int, n string, anchor int").coalesce(3)


def cut(text, places):
    return " ".join(w for i, w in enumerate(text) if i not in places)


@pytest.mark.parametrize("seed", [1, 2])
def test_substrings_like_a_plain_search(spark, seed):
    docs = dict(enumerate(plain.random_texts(seed, 40, ["a", "b", "C", "ä"], 30)))
    gone = plain.substring_removed(docs, 8)
    out = dedup_substrings(frame(spark, [(d, " ".join(w)) for d, w in docs.items()]), "doc_id", "text", 8).collect()
    assert len(out) == 40
    for r in out:
        assert (r.n_words, r.n_removed, r.kept) == (len(docs[r.doc]), len(gone[r.doc]), cut(docs[r.doc], gone[r.doc]))
        assert {k for s in r.spans for k in range(s.begin, s.end)} == gone[r.doc]


def test_substrings_of_odd_rows(spark):
    out = dedup_substrings(frame(spark, ODD), "doc_id", "text", 4).collect()
    by = {}
    for r in out:
        by.setdefault(r.doc, []).append((r.n_words, r.n_removed))
    # Rows with the same id do not remove one another, and a null id removes nothing.
    assert by[8] == [(8, 0), (8, 0)] and by[None] == [(8, 0)]
    assert by[1] == by[2] == by[3] == [(0, 0)] and by[4] == [(1, 0)] and by[5] == [(5, 0)]
    assert by[6] == [(9001, 0)] and by[7] == [(9001, 9001)]
    assert dedup_substrings(frame(spark, ODD).limit(0), "doc_id", "text").count() == 0


@pytest.mark.parametrize("most", [4000, 1])
@pytest.mark.parametrize("remove", ["all", "later"])
def test_bytes_like_a_plain_search(spark, most, remove):
    docs = {d: " ".join(w) for d, w in enumerate(plain.random_texts(3, 25, ["a", "bc", "ä"], 40))}
    raw = {d: t.encode() for d, t in docs.items()}
    gone = plain.bytes_removed(raw, 16, remove == "later")
    spans = suffix_dedup.repeats(frame(spark, docs.items()), "doc_id", "text", 16, remove, max_stretches=most).collect()
    got = {d: set() for d in docs}
    for s in spans:
        got[s.doc].update(range(s.begin, s.end))
    assert got == gone


def test_bytes_of_odd_rows(spark):
    out = dedup_bytes(frame(spark, ODD), "doc_id", "text", 16).collect()
    by = {}
    for r in out:
        by.setdefault(r.doc, []).append((r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(r.kept).hexdigest()))
    none = hashlib.sha256(b"").hexdigest()
    assert by[1] == by[2] == [(0, 0, 0, none)]
    assert by[6] == by[7] == [(27000, 27000, 1, none)]
    assert [r[:2] for r in by[8]] == [(15, 0)] * 2  # shorter than the window
    assert by[None][0][:2] == (15, 0)
    assert dedup_bytes(frame(spark, ODD).limit(0), "doc_id", "text").count() == 0


def test_bytes_of_null_and_repeated_ids(spark):
    """Rows, not ids: every row is judged by its own text."""
    shared = "the same stretch of text in both, long enough"
    rows = [(None, shared + " and an end"), (1, shared), (1, "short one"), (2, "x" * 20 + shared), (None, "alone here"),
            (3, "twice over"), (3, "twice over, and more of it")]
    raw = {i: t.encode() for i, (_, t) in enumerate(rows)}
    gone = plain.bytes_removed(raw, 8, False)
    out = dedup_bytes(frame(spark, rows), "doc_id", "text", 8).collect()
    expected = sorted((str(rows[i][0]), len(raw[i]), len(gone[i]),
                       bytes(b for k, b in enumerate(raw[i]) if k not in gone[i])) for i in raw)
    assert sorted((str(r.doc), r.n_bytes, r.n_removed, bytes(r.kept)) for r in out) == expected


def test_substrings_of_repeated_ids(spark):
    rows = [(0, "a b c d e f g h"), (1, "a b c d e f x"), (1, "short one"), (1, "q a b c d z"), (2, "short one two three"),
            (1, "short one two three")]
    out = dedup_substrings(frame(spark, rows), "doc_id", "text", 4).collect()
    assert sorted((r.doc, r.n_words, r.kept) for r in out) == sorted([
        (0, 8, "a b c d e f g h"), (1, 7, "x"), (1, 2, "short one"), (1, 6, "q z"), (2, 4, ""),
        (1, 4, "short one two three")])


def test_factors_are_those_of_a_plain_search():
    rng = np.random.default_rng(5)
    data = rng.integers(97, 99, 200).astype(np.uint8)
    limits = np.full(len(data), len(data))
    words = suffix_dedup.words_at(data)
    order = suffix_dedup.suffix_order(words, limits, 16)
    order = order[order < len(data) - 15]
    prefix = np.zeros(len(order), np.int64)
    prefix[1:] = suffix_dedup.common_prefix(order[:-1], order[1:], words, limits, 16)
    earlier, later = suffix_dedup.factors(order, prefix)
    text = data.tobytes()
    for i in range(len(order)):
        best = [max([0] + [8 * min(2, next((k for k in range(16) if text[i + k] != text[j + k]), 16) // 8)
                           for j in js]) for js in (range(i), range(i + 1, len(order)))]
        assert [earlier[i], later[i]] == best


@pytest.mark.parametrize("idle", [0, 1 << 21])
@pytest.mark.parametrize("depth", [8, 24, 40])
def test_suffix_order_ranks_whole_windows_only(depth, idle):
    rng = np.random.default_rng(7)
    texts = [bytes(rng.integers(97, 99, int(size)).astype(np.uint8)) for size in rng.integers(0, 90, 30)]
    texts += texts[:4] + [b"a" * 80]
    data = np.frombuffer(b"".join(texts) + bytes(idle), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    # Places of no text: so many that a rank and its place no longer fit one number.
    limits = np.concatenate((np.repeat(ends, [len(t) for t in texts]), np.arange(ends[-1], len(data))))
    order = suffix_dedup.suffix_order(suffix_dedup.words_at(data), limits, depth)
    raw = data.tobytes()
    windows = [i for i in range(ends[-1]) if i + depth <= limits[i]]
    assert order.tolist() == sorted(windows, key=lambda i: (raw[i:i + depth], i))


@pytest.mark.parametrize("unit, window", [(seeds.BYTES, 12), (seeds.WORDS, 6)])
def test_anchors_do_not_depend_on_chunks(monkeypatch, unit, window):
    texts = [" ".join(w) for w in plain.random_texts(4, 30, ["a", "bc", "ä"], 60)] + [None, "", "x", "a bc " * 40]
    (_, data, offsets), = grams.chunks(pa.array(texts))
    whole = grams.anchors(*seeds.units_of(data, offsets, unit), window, window // 2)
    assert len(whole.first)
    for size in (1, 100, 1 << 17):
        monkeypatch.setattr(seeds, "ANCHOR_BYTES", size)
        signed = seeds.anchors_of(pa.array(texts), unit, window, window // 2)
        bare = seeds.anchors_of(pa.array(texts), unit, window, window // 2, signed=False)
        for part in ("text", "first", "last", "anchor", "signature"):
            assert np.array_equal(getattr(signed, part), getattr(whole, part))
        assert np.array_equal(bare.anchor, whole.anchor) and not len(bare.signature)
    assert not len(seeds.anchors_of(pa.array([], pa.string()), unit, window, window // 2).first)


def test_passages_are_judged_by_bytes_not_words(spark):
    def words(seed, n, size):
        rng = random.Random(seed)
        return " ".join("".join(rng.choices("abcdefgh", k=size)) for _ in range(n))

    short, long = words(1, 60, 5), words(2, 60, 7)  # 359 and 479 bytes, of 60 words each
    texts = [f"{words(10 + k, 30, 6)} {passage} {words(20 + k, 30, 6)}"
             for k, passage in enumerate([short, short, long, long])]
    out = {r.doc: r for r in dedup_bytes(frame(spark, enumerate(texts)), "doc_id", "text").collect()}
    assert [out[k].n_removed for k in (0, 1)] == [0, 0]
    for k in (2, 3):
        (span,) = out[k].spans
        assert long in texts[k][span.begin:span.end] and out[k].n_removed <= len(long) + 2 + 4


@pytest.mark.parametrize("short_list", [24, 2])
def test_near_duplicates_like_all_pairs(spark, monkeypatch, short_list):
    monkeypatch.setattr(jaccard_join, "SHORT_LIST", short_list)
    rng, texts = random.Random(9), []
    for family in range(3):
        base = [rng.choice("abcdefghij") + str(rng.randint(0, 40)) for _ in range(rng.randint(20, 90))]
        for _ in range(14):
            own = base[:rng.randint(len(base) * 7 // 10, len(base))]
            for _ in range(rng.randint(0, 4)):
                own[rng.randrange(len(own))] = "new" + str(rng.randint(0, 9))
            texts.append(" ".join(own))
    common = " ".join(f"boiler{i}" for i in range(30))
    texts += [common + " " + " ".join(f"{k}x{i}" for i in range(12)) for k in range(12)]
    docs = dict(enumerate(texts))
    comps, sizes = plain.groups(docs)
    out = near_duplicates(frame(spark, docs.items()), "doc_id", "text").collect()
    assert {r.doc: r.component for r in out} == comps
    assert {r.doc: r.n_shingles for r in out} == sizes


def test_near_duplicates_of_odd_rows(spark):
    rows = [*ODD, (9, "X"), (10, "x"), (None, None)]
    out = near_duplicates(frame(spark, rows), "doc_id", "text").collect()
    by = {(r.doc, r.n_shingles): r.component for r in out}
    assert len(out) == len(rows)
    assert by[1, 0] == 1 and by[2, 0] == 2 and by[3, 0] == 3  # no words, no links
    assert by[4, 1] == by[9, 1] == by[10, 1] == 4
    assert by[8, 4] == 8 and by[None, 4] == 8 and by[None, 0] is None
    assert by[6, 2] == by[7, 2] == 6
    assert near_duplicates(frame(spark, rows).limit(0), "doc_id", "text").count() == 0


def test_near_copies_of_null_and_repeated_ids_link(spark):
    def text(name, changed=""):
        return " ".join([f"{name}{i}" for i in range(40)] + [changed])

    # A near copy without an id, and an id with two texts, of which each has a near copy.
    rows = [(None, text("a", "x")), (1, text("a")), (2, text("b", "x")), (2, text("c", "x")), (2, "q r"), (5, text("c")),
            (4, text("b")), (None, text("d")), (None, text("d", "x"))]
    out = near_duplicates(frame(spark, rows), "doc_id", "text").collect()
    assert sorted((str(r.doc), r.n_shingles, str(r.component)) for r in out) == sorted([
        ("None", 37, "1"), ("1", 36, "1"), ("2", 37, "2"), ("2", 37, "2"), ("2", 1, "2"), ("4", 36, "2"), ("5", 36, "2"),
        ("None", 36, "None"), ("None", 37, "None")])


@pytest.mark.parametrize("block, columns", [(256, 4096), (4, 16)])
def test_links_within_components_are_counted(spark, monkeypatch, block, columns):
    monkeypatch.setattr(jaccard_join, "SHORT_LIST", 4)
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(jaccard_join, "COLUMNS", columns)
    rng, texts = random.Random(4), ["", "x", "X", "one two three four five six"]
    for family in range(3):
        base = [f"{family}w{i}" for i in range(80)]
        for _ in range(16):
            own = base[:rng.randint(64, 80)]
            own[rng.randrange(len(own))] = "new" + str(rng.randint(0, 9))
            texts += [" ".join(own)] * rng.randint(1, 2)
    sets = [plain.shingles(t) for t in texts]
    links = [sum(5 * len(s & t) >= 4 * len(s | t) for j, t in enumerate(sets) if j != i and s) for i, s in enumerate(sets)]
    out = near_duplicates(frame(spark, enumerate(texts)), "doc_id", "text", count_links=True).collect()
    assert {r.doc: r.n_links for r in out} == dict(enumerate(links))
    comps, _ = plain.groups(dict(enumerate(texts)))
    assert {r.doc: r.component for r in out} == comps
    assert any(0 < n < sum(c == comps[i] for c in comps.values()) - 1 for i, n in enumerate(links))
