"""The registered queries of the text operators, and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm import (
    decontaminate, jaccard_join, language_id, packing, prefix_trie, quality_rules, secret_scan, substring_dedup, suffix_dedup,
    toxicity, warc, whitening,
)
from contrail.llm.text import fold
from contrail.llm.url_filters import ALLOW, BLOCK, Rule, judge_urls
from contrail.llm.tables import landed

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


URL_RULES = (Rule(BLOCK, "net", "/"), Rule(ALLOW, "example.net", "/en/"), Rule(BLOCK, "example.com", "/de/"),
             Rule(ALLOW, "org", "/fr/"))


@_query
def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


ORACLES["op4_url_filters"] = r"""
WITH place AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
fitting AS (
  SELECT *,
         (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') AS net,
         (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') AS net_en,
         (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') AS com_de,
         (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') AS org_fr
  FROM place)
SELECT page_id, host, path,
       CASE WHEN net_en THEN 'example.net/en/' WHEN net THEN 'net/' WHEN com_de THEN 'example.com/de/'
            WHEN org_fr THEN 'org/fr/' END AS rule,
       CASE WHEN net_en THEN 'allow' WHEN net OR com_de THEN 'block' ELSE 'allow' END AS verdict
FROM fitting
"""


def _labels(spark: SparkSession, sf_dir: str, column: str) -> DataFrame:
    """One label for each document; of several, the smallest."""
    return _table(spark, sf_dir, "labels").filter("doc_id is not null").groupBy("doc_id").agg(
        F.min(column).alias(column))


@_query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    stats = landed(quality_rules.with_statistics(docs).drop("text"), "quality-statistics")
    rules = quality_rules.learn(stats.join(_labels(spark, sf_dir, "quality"), "doc_id"), "doc_id",
                                F.col("quality") == 0)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return stats.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & rules.kept()).alias("kept"), rules.rule().alias("rule"))


@_query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 4) == 2
    profiles = language_id.fit_profiles(docs.filter(~held_out), "text", "lang", "doc_id")
    found = language_id.identify(docs.select("doc_id", "text"), profiles)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Classifier:
    """Learned from the labelled texts outside of the held-out fold."""
    labels = _labels(spark, sf_dir, "toxic").filter(fold(F.col("doc_id"), 5) != 0)
    return toxicity.fit(docs.select("doc_id", "text").join(labels, "doc_id"), "text", "toxic", "doc_id")


@_query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = docs.withColumn("score", toxicity.score(docs, toxicity_model(spark, docs, sf_dir)))
    return scored.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


SEQUENCE_TOKENS = 4096
END_OF_DOCUMENT = 1


def tokenizer_path() -> str:
    """The vocabulary file that the packing query is stated for; it is installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def packed_documents(docs: DataFrame) -> DataFrame:
    pieces = packing.token_pieces(docs, "doc_id", "text", tokenizer_path(), SEQUENCE_TOKENS, END_OF_DOCUMENT,
                                  with_ids=False)
    return packing.pack(pieces, SEQUENCE_TOKENS).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@_query
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(_table(spark, sf_dir, "documents"))


@_query
def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"),
                                        "doc_id", "text", "item_id", "text")
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


ORACLES["op8_benchmark_decontamination"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
        FROM b WHERE len(w) > 0)),
doc_windows AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM item_windows) WHERE len(w) >= n)),
hits AS (SELECT doc_id, i, n, item_id FROM doc_windows JOIN item_windows USING (n, g)),
words AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM (SELECT DISTINCT doc_id, i, n FROM hits)) GROUP BY 1),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY 1)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@_query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.dedup_substrings(_table(spark, sf_dir, "documents"), "doc_id", "text")
    return found.select(F.col("doc").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLES["op1_substring_dedup"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, md5_number(array_to_string(w[i:i + 49], ' ')) AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
firsts AS (SELECT g, min(doc_id) AS least FROM windows GROUP BY g),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS place
  FROM windows JOIN firsts USING (g) WHERE doc_id > least),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM d),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS kept
  FROM words ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


@_query
def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.dedup_bytes(_table(spark, sf_dir, "documents"), "doc_id", "text")
    return found.select(F.col("doc").alias("doc_id"), "n_bytes", "n_removed",
                        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


# Windows of bytes as hexadecimal digits, two for each byte.
ORACLES["op3_suffix_array_dedup"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (
  SELECT r, i, md5_number(substr(h, 2 * i + 1, 800)) AS g
  FROM (SELECT r, h, unnest(range(0, length(h) // 2 - 399)) AS i FROM d WHERE length(h) >= 800)),
starts AS (SELECT r, i FROM windows SEMI JOIN (SELECT g FROM windows GROUP BY g HAVING count(*) > 1) USING (g)),
runs AS (
  SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS k
  FROM (SELECT r, i, coalesce((i > lag(i) OVER (PARTITION BY r ORDER BY i) + 400)::INT, 1) AS new FROM starts)),
spans AS (SELECT r, min(i) AS b, max(i) + 400 AS e FROM runs GROUP BY r, k),
gaps AS (
  SELECT r, b, e, coalesce(lag(e) OVER (PARTITION BY r ORDER BY b), 0) AS before,
         lead(b) OVER (PARTITION BY r ORDER BY b) IS NULL AS last
  FROM spans),
kept AS (
  SELECT r, count(*) AS n_spans, sum(e - b) AS n_removed,
         string_agg(substr(h, 2 * before + 1, 2 * (b - before)) || CASE WHEN last THEN substr(h, 2 * e + 1) ELSE '' END,
                    '' ORDER BY b) AS kept
  FROM gaps JOIN d USING (r) GROUP BY r)
SELECT doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""


@_query
def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.near_duplicates(_table(spark, sf_dir, "documents"), "doc_id", "text", count_links=True)
    return found.select(F.col("doc").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), "n_links")


ORACLES["op2_ngram_jaccard_join"] = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
           ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS g
  FROM d),
shingles AS (SELECT r, len(g) AS n, unnest(g) AS h FROM sets),
links AS (
  SELECT a.r AS x, b.r AS y FROM shingles a JOIN shingles b ON a.h = b.h AND a.r <> b.r
  GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (SELECT r AS x, r AS y FROM sets UNION SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y)
SELECT s.doc_id, len(g) AS n_shingles,
       (SELECT min(o.doc_id) FROM reach JOIN sets o ON o.r = reach.y WHERE reach.x = s.r) AS component_id,
       (SELECT count(*) FROM links WHERE links.x = s.r) AS n_links
FROM sets s
"""


def scanned(docs: DataFrame) -> DataFrame:
    """All findings in the texts with their scores. Labels are the silver ones of documents outside of fold 0 of 5."""
    found = landed(secret_scan.findings(docs, "doc_id", "text"), "secret-candidates")
    train = found.filter(fold(F.col("doc"), 5) != 0).withColumn("label", secret_scan.silver_label(found))
    return secret_scan.fit(train, "label", secret_scan.dictionary(docs, "text")).score(found)


@_query
def op6_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = scanned(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select(F.col("doc").alias("doc_id"), "word", F.length("value").alias("n_chars"),
                         F.sha2("value", 256).alias("value_sha256"), "score", "secret", "run")


@_query
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 32)
    return found.select(F.col("id").alias("vec_id"), "component", "n", F.col("deviation").cast("long").alias("deviation"),
                        "whitened", "explained", "identity_error")


@_query
def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    archive = warc.write_archive(pages, "page_id", "url", "html", min_bytes=0)
    return warc.read_archive(archive, with_payload=False).select(
        F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


# SHA-1 as hexadecimal digits, then five bits at a time; the alphabet is that of RFC 4648.
ORACLES["op11_warc"] = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
digits AS (
  SELECT page_id, strlen(payload) AS payload_bytes, hex,
         list_transform(range(1, 41), lambda i: strpos('0123456789abcdef', hex[i]) - 1) || [0] AS d
  FROM p),
coded AS (
  SELECT page_id, payload_bytes, hex,
         array_to_string(list_transform(range(0, 32), lambda i:
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[
             (((d[i * 5 // 4 + 1] * 16 + d[i * 5 // 4 + 2]) >> (3 - i * 5 % 4)) & 31) + 1]), '') AS payload_digest,
         min(page_id) OVER (PARTITION BY hex, payload_bytes) AS least
  FROM digits)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN least IS NULL OR page_id IS NOT DISTINCT FROM least THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN least IS NOT NULL AND page_id IS DISTINCT FROM least THEN least END AS refers_to
FROM coded
"""


@_query
def op13_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = landed(prefix_trie.numbered_turns(_table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text"),
                   "turns")
    convs = turns.select("conv").distinct()
    heads = convs.select("conv", (F.col("conv") - F.col("conv") % 20).alias("donor"),
                         (F.crc32(F.col("conv").cast("string").cast("binary")) % 4).alias("h"))
    trie = prefix_trie.prefix_trie(prefix_trie.rebuilt_turns(turns, heads), convs)
    ends = prefix_trie.joined_ids(trie.ends)
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return trie.nodes.join(ends.withColumnRenamed("top", "conv"), ["conv", "depth"], "left").select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", F.col("saved").alias("saved_tokens"), F.coalesce("ends", nothing).alias("ends_sha256"))


# crc32 byte by byte: a list of each byte and eight marks, folded over the running remainder.
ORACLES["op13_conversation_prefix_trie"] = r"""
WITH own AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS place,
         coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, conv_id - conv_id % 20 AS donor,
         xor(list_reduce([4294967295::BIGINT] || flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
               lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
             lambda r, v: CASE WHEN v >= 0 THEN xor(r, v) ELSE xor(r >> 1, 3988292384 * (r & 1)) END),
           4294967295::BIGINT) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM own)),
lent AS (
  SELECT c.conv_id, o.place, o.role, o.text FROM convs c JOIN own o ON o.conv_id = c.donor AND o.place <= c.h),
turns AS (
  SELECT * FROM lent UNION ALL
  SELECT c.conv_id, o.place - c.h + (SELECT count(*) FROM lent l WHERE l.conv_id = c.conv_id), o.role, o.text
  FROM convs c JOIN own o USING (conv_id) WHERE o.place > c.h),
whole AS (
  SELECT conv_id, list(strlen(role) || ':' || role || strlen(text) || ':' || text ORDER BY place) AS ts,
         list(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) ORDER BY place) AS ws
  FROM turns GROUP BY 1),
paths AS (
  SELECT conv_id, d AS depth, CASE WHEN d = 0 THEN '' ELSE md5(array_to_string(ts[1:d], '')) END AS node,
         CASE WHEN d = 0 THEN NULL WHEN d = 1 THEN '' ELSE md5(array_to_string(ts[1:d - 1], '')) END AS up,
         CASE WHEN d = 0 THEN 0 ELSE ws[d] END AS words, d = coalesce(len(ts), 0) AS last
  FROM (SELECT conv_id, ts, ws, unnest(range(0, coalesce(len(ts), 0) + 1)) AS d FROM convs LEFT JOIN whole USING (conv_id))),
nodes AS (
  SELECT depth, node, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs,
         (count(*) - 1) * any_value(words) AS saved,
         coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE last), '') AS ends
  FROM paths GROUP BY 1, 2),
linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id,
         (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.up = n.node) AS n_children
  FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.node = n.up),
below AS (
  SELECT DISTINCT a.depth, a.node, b.depth AS d, b.node AS below
  FROM paths a JOIN paths b ON a.conv_id = b.conv_id AND b.depth >= a.depth)
SELECT n.conv_id, n.depth, n.parent_conv_id, n.n_convs, n.n_children,
       CAST(sum(CASE WHEN b.n_children = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves,
       CAST(sum(b.saved) AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM linked n JOIN below x ON x.depth = n.depth AND x.node = n.node JOIN linked b ON b.depth = x.d AND b.node = x.below
GROUP BY n.conv_id, n.depth, n.parent_conv_id, n.n_convs, n.n_children, n.ends
"""
