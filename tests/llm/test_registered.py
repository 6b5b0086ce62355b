"""Registered queries against their SQL, and the pipeline's stages against plain versions."""

import numpy as np
import pytest
from conftest import SMALL
from oracle import compare, connect
from pyspark.sql import functions as F

import corpus_pipeline
from contrail.llm import jaccard_join, queries, tables

import plain

CON = connect(SMALL)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_its_sql(spark, name):
    rows, problems = compare(queries.QUERIES[name](spark, SMALL), CON, queries.ORACLES[name])
    assert problems == [] and rows > 0


def test_all_operators_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "ngram_jaccard_join", "benchmark_decontamination", "secret_scans", "best_fit_packing"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage makes of the documents and some odd rows, written and read again."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    again = docs.filter("doc_id = 7")
    odd = spark.createDataFrame([(None, "lone row without an id", None, None, None), (900001, None, "en", "s", None),
                                 (900002, "", "en", None, 0), (900003, " \n ", None, "s", 3)], docs.schema)
    working = ("node", "gone", "kept", "rows", "before", "doc", "content", "values", "found", "_kept", "_again", "_old")
    out = [docs.unionByName(again).unionByName(odd).withColumns({name: F.lit(1) for name in working})]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "rows")
        stage(spark, out[-1], SMALL).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_stages_return_the_columns_of_documents(stages):
    assert all(s.columns == stages[0].columns for s in stages[:-1])


def test_toxic_documents_go(spark, stages):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    before, after = ({r.doc_id: r.toxic for r in s.join(labels, "doc_id").collect()} for s in stages[:2])
    gone = set(before) - set(after)
    assert sum(before[d] for d in gone) >= 0.5 * sum(before.values())  # of a few dozen labels
    assert sum(1 - before[d] for d in gone) <= 0.06 * len(before)


def test_one_document_of_each_group_stays(stages):
    rows = {r.doc_id: r.text for r in stages[1].filter("doc_id is not null").collect()}
    comps, _ = plain.groups(rows)
    kept = [r.doc_id for r in stages[2].collect()]
    assert sorted(d for d in kept if d is not None) == sorted(set(comps.values())) and kept.count(None) == 1


def test_contaminated_documents_go(spark, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    clean = [r.doc_id for r in stages[2].collect() if not plain.hits(r.text, items)[1]]
    assert sorted(map(str, clean)) == sorted(str(r.doc_id) for r in stages[3].collect())


def test_secrets_are_masked_and_all_documents_stay(stages):
    before, after = ({r.doc_id: r for r in s.collect()} for s in stages[3:5])
    assert before.keys() == after.keys()
    for d, row in before.items():
        if row.text is None or 'token = "' not in row.text.lower():
            assert after[d] == row
        else:
            assert "<secret>" in after[d].text and after[d].n_chars == len(after[d].text)


def test_all_documents_are_packed(stages):
    pieces = stages[5].toPandas()
    assert pieces["doc_id"].nunique(dropna=False) == stages[4].count()
    ordered = pieces.sort_values(["sequence_id", "offset"])
    ends = ordered.groupby("sequence_id")["length"].cumsum()
    assert (ends - ordered["length"] == ordered["offset"]).all() and ends.max() <= queries.SEQUENCE_TOKENS
    assert pieces["sequence_id"].nunique() <= -(-pieces["length"].sum() // queries.SEQUENCE_TOKENS) + 1


def test_the_stages_take_an_empty_table(spark, stages):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, stages[0].limit(0), SMALL).count() == 0


def test_documents_that_surely_stay_are_not_moved(spark):
    """Of the branches that read whole documents, one has no exchange above the scan, whatever may be broadcast."""
    rows = [(d, f"word{d} " * 9, "en", "s", 9) for d in range(40)] + [(50, "word3 " * 9, "en", "s", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = corpus_pipeline.drop_near_duplicates(spark, docs, SMALL)
        plan = out._jdf.queryExecution().executedPlan().toString().split("\n")
        assert sorted(r.doc_id for r in out.collect()) == list(range(40))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    moved, above = [], []
    for line in plan:
        depth = len(line) - len(line.lstrip(" :+-*"))
        above = [(d, x) for d, x in above if d < depth] + [(depth, line)]
        if "Scan ExistingRDD" in line and "text" in line:
            moved.append(any("Exchange hashpartitioning" in x for _, x in above))
    assert moved and not all(moved)


def test_prefix_shingles_are_met_in_parts(spark, monkeypatch):
    rows = [(d, " ".join(f"w{d // 2}x{k}" for k in range(60))) for d in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    texts, met = docs.select(F.col("doc_id").alias("doc"), F.concat("text", F.lit(" "), "doc_id").alias("text")), []

    def landed(df, purpose, *more):
        out = tables.landed(df, purpose, *more)
        if purpose == "shared-shingles":
            met.append(out.count())
        return out

    monkeypatch.setattr(jaccard_join, "landed", landed)
    found = jaccard_join.prefixes(texts, np.empty(0, np.int64), 5, 80)
    index = jaccard_join._index(found, 80)
    assert index.select("node").distinct().count() == 40
    assert len(met) > 1 and max(met) < 0.6 * sum(met)
