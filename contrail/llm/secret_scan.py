"""Secret scans: candidate strings, and a random forest that removes the false ones. DataFrame operations only."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.tables import landed
from contrail.llm.text import blank_words, let, unused

# A candidate is any such run in a word, with a digit or a capital after a small letter in it. Addresses, numbers and
# names qualify: the forest tells them from secrets.
RUN = r"[A-Za-z0-9_+/=.@\-]{16,}"
KEYWORDS = r"(?i)(pass(word|wd)?|pwd|secret|token|api|key|auth|bearer|credential|private)"
HASH_WORDS = r"(?i)(sha\d*|md5|commit|digest|checksum|hash|uuid|etag|revision|license)"
# How tokens of well-known providers begin, and web tokens.
TOKENS = (r"(?<![A-Za-z0-9])((AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])|gh[pousr]_[A-Za-z0-9]{20}|github_pat_\w{20}"
          r"|glpat-[\w\-]{20}|xox[abeoprs]-[\w\-]{10}|[sr]k_(live|test)_\w{10}|sk-[\w\-]{20}|AIza[\w\-]{35}"
          r"|npm_\w{36}|hf_[A-Za-z]{30}|SG\.[\w\-]{20}|ya29\.[\w\-]{20}|eyJ[\w\-]{8,}\.eyJ)")
MASK = "<secret>"
# What a run stands in ends at these, and after so many characters; so do the neighbouring words.
_ENDS = r",;&?|(){}<>\[\]"
_NEAR = 64
_BUCKETS = 8


def findings(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``doc, content, word, run, value, lead, around, before, after``: every candidate with a hash of its text, the
    number of its word and its number among the word's runs.

    A candidate is a run of 16 or more letters, digits and ``_+/=.@-`` in a word, if it has a digit or a capital after a
    small letter; a word has as many as it holds, and each is judged for itself. ``lead`` is what stands before the run
    in the word and ``around`` the run with that and what follows it, up to a separator such as a comma, the run after
    the neighbouring one or 64 characters; ``before`` are the two words before the word and ``after`` the next one, the
    64 nearest characters of each. Only texts that hold such a run are split into words. A null text has none; a null
    key is kept; repeated rows have repeated findings. Narrow.
    """
    whole = docs.select(F.col(f"`{key}`").alias("doc"), F.col(f"`{text}`").alias("text"))
    words = whole.filter(F.col("text").rlike(RUN)).select(
        "doc", F.xxhash64("text").alias("content"), blank_words(F.col("text")).alias("words"))

    def at(i: Column) -> Column:
        return F.coalesce(F.get("words", i), F.lit(""))

    holding = F.filter(F.transform("words", lambda w, i: F.struct(
        i.alias("word"), w.alias("whole"),
        F.concat_ws(" ", F.right(at(i - 2), F.lit(_NEAR)), F.right(at(i - 1), F.lit(_NEAR))).alias("before"),
        F.left(at(i + 1), F.lit(_NEAR)).alias("after"))), lambda f: f["whole"].rlike(RUN))
    held = words.select("doc", "content", F.explode(holding).alias("f")).select("doc", "content", "f.*")

    def each(parts: Column) -> Column:
        runs, gaps = parts["runs"], parts["gaps"]

        def one(value: Column, k: Column) -> Column:
            ahead = F.concat(F.coalesce(F.get(runs, k - 1), F.lit("")), F.get(gaps, k))
            behind = F.concat(F.get(gaps, k + 1), F.coalesce(F.get(runs, k + 1), F.lit("")))
            lead = F.regexp_extract(F.right(ahead, F.lit(_NEAR)), f"[^{_ENDS}]*$", 0)
            tail = F.regexp_extract(F.left(behind, F.lit(_NEAR)), f"^[^{_ENDS}]*", 0)
            return F.struct(k.alias("run"), value.alias("value"), lead.alias("lead"),
                            F.concat(lead, value, tail).alias("around"))

        return F.filter(F.transform(runs, one), lambda f: f["value"].rlike(r"[0-9]|[a-z].*[A-Z]"))

    # The runs of a word and what stands between them, worked out once for all of them.
    parts = F.struct(F.regexp_extract_all("whole", F.lit(RUN), 0).alias("runs"), F.split("whole", RUN, -1).alias("gaps"))
    return held.select("doc", "content", "word", "before", "after", F.explode(let(parts, each)).alias("f")).select(
        "doc", "content", "word", "f.run", "f.value", "f.lead", "f.around", "before", "after")


def silver_label(rows: DataFrame) -> Column:
    """Labels for findings where nobody has labelled any.

    1 for the token of a well-known provider, a password in a connection string, and a value with a digit that is
    assigned to a key word, as ``token = "..."``, ``"token":"..."`` or ``token=...``. 0 for what is by its own form an
    address, the name of a file or of words put together, or a number. Null for the rest, whether or not a key word is
    near: bare keys and digests look alike.
    """
    value, lead = F.col("value"), F.col("lead")
    word = r"[\w.\-]*" + KEYWORDS.replace("(?i)", "") + r"[\w.\-]*"
    assigned = F.col("before").rlike(KEYWORDS) & F.col("before").rlike(r"[=:]$") & F.col("around").rlike("^[\"'`]")
    joined = lead.rlike(rf"(?i){word}[\"'`]?[=:]+[\"'`]?$") | value.rlike(rf"(?i)^{word}=[\w+/.\-]{{16,}}")
    login = lead.rlike(r"://[^\s/@]*:$") & value.rlike("^[^@]+@") | value.rlike("^//[^/@]+@")
    mail = value.rlike(r"^[\w.+\-]+@[A-Za-z0-9\-]+(\.[A-Za-z0-9\-]+)*\.[A-Za-z]{2,}\.?$")
    site = value.rlike(r"^//[^@=]+$") & lead.rlike("(?i)[a-z]:$") | value.rlike(
        r"(?i)^([a-z0-9\-]+\.)+(com|org|net|edu|gov|io|info)\.?(/[^@=]*)?$")
    file = value.rlike(r"(?i)^[^@=]+\.(html?|png|jpe?g|gif|svg|pdf|js|css|txt|json|xml|md|py|java)\.?$")
    # Nothing is left of a name without its words: two letters or more, small, capital or with a first capital.
    name = F.regexp_replace(value, r"[A-Z]?[a-z]{2,}|[A-Z]{2,}(?![a-z])|[_/.=+@\-]", "") == ""
    number = ~value.rlike("[A-Za-z]")
    secret = value.rlike(TOKENS) | login & ~mail | (assigned | joined) & value.rlike("[0-9]") & ~(mail | site | file)
    return F.when(secret, 1).when(mail | site | file | name | number, 0)


def dictionary(docs: DataFrame, text: str, size: int = 800) -> list[str]:
    """The ``size`` words of three letters or more that the most of all texts hold; of equal ones the first in order.
    A word counts once for each text and is counted within tasks before it is sent on."""
    words = docs.select(F.explode(F.array_distinct(
        F.regexp_extract_all(F.lower(F.col(f"`{text}`")), F.lit(r"\p{L}{3,}"), 0))))
    top = words.groupBy("col").count().orderBy(F.desc("count"), "col").limit(size)
    return [r[0] for r in top.collect()]


def features(words: list[str]) -> dict[str, Column]:
    """What the forest sees of a finding."""
    value, around, before, after = (F.col(c) for c in ("value", "around", "before", "after"))
    size = F.length("value").cast("double")
    # Longer words first, so that the alternation takes as much as it can.
    known = "|".join(sorted(words, key=lambda w: (-len(w), w)))
    uncovered = F.length(F.regexp_replace(F.lower(value), known, "")) if words else F.length("value")
    near = F.lower(F.regexp_replace(F.substring_index(before, " ", -1), r"[^\p{L}]", ""))
    return {
        "length": size,
        "digits": F.regexp_count(value, F.lit("[0-9]")) / size,
        "upper": F.regexp_count(value, F.lit("[A-Z]")) / size,
        "hex": F.regexp_count(value, F.lit("[0-9a-fA-F]")) / size,
        "distinct": F.size(F.array_distinct(F.split(value, ""))) / size,
        "transitions": F.regexp_count(value, F.lit(
            "(?<=[a-zA-Z])(?=[0-9])|(?<=[0-9])(?=[a-zA-Z])|(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])")) / size,
        "longest_letters": F.array_max(F.transform(F.split(value, "[^A-Za-z]+"), lambda x: F.length(x))) / size,
        "dictionary": 1 - uncovered / size,
        "path_slashes": F.regexp_count(around, F.lit("/")).cast("double"),
        "path_address": around.rlike(r"://|@|\.\w{2,4}\b").cast("double"),
        "quoted": around.rlike("^[\"'`]").cast("double"),
        "assigned": F.concat(before, around).rlike(r"[=:]").cast("double"),
        "key_word": F.concat_ws(" ", before, F.substring_index(around, "=", 1)).rlike(KEYWORDS).cast("double"),
        "hash_word": F.concat_ws(" ", before, after).rlike(HASH_WORDS).cast("double"),
        **{f"near_{k}": (F.pmod(F.xxhash64(near), F.lit(_BUCKETS)) == k).cast("double") for k in range(_BUCKETS)},
    }


@dataclass
class Scanner:
    """A forest with its dictionary; without a forest all findings have the same score."""

    forest: RandomForestClassificationModel | None = None
    words: list[str] = field(default_factory=list)
    otherwise: float = 1.0

    def score(self, found: DataFrame) -> DataFrame:
        """Add ``score``, the forest's probability that a finding is a secret, and ``secret``, from 0.5 on."""
        if self.forest is None:
            return found.withColumns({"score": F.lit(self.otherwise), "secret": F.lit(self.otherwise >= 0.5)})
        judged = self.forest.transform(_assembled(found, self.words))
        return judged.withColumn("score", vector_to_array("probability")[1]).select(
            *[F.col(f"`{c}`") for c in found.columns], "score", (F.col("score") >= 0.5).alias("secret"))


def _assembled(found: DataFrame, words: list[str]) -> DataFrame:
    columns = {f"_f_{name}": F.coalesce(c, F.lit(0.0)) for name, c in features(words).items()}
    return VectorAssembler(inputCols=list(columns), outputCol="_features").transform(found.withColumns(columns))


def fit(labelled: DataFrame, label: str, words: list[str], max_findings: int = 20_000, trees: int = 24,
        depth: int = 6, seed: int = 7) -> Scanner:
    """A scanner from findings with a ``label`` of 1 (secret) or 0; others are left out.

    About ``max_findings`` are used, those with the smallest hashes. Without labels of both kinds there is no forest:
    nothing is a secret if all labels are 0, and everything is if they are 1 or there are none.
    """
    rows = labelled.filter(F.col(f"`{label}`").isin(0, 1)).withColumn("_y", F.col(f"`{label}`").cast("double"))
    kinds = {r[0]: r[1] for r in rows.groupBy("_y").count().collect()}
    if len(kinds) < 2:
        return Scanner(None, words, 0.0 if 0.0 in kinds else 1.0)
    share = min(1.0, max_findings / sum(kinds.values()))
    spread = (F.xxhash64("doc", "word", "value").cast("double") + 2.0 ** 63) / 2.0 ** 64
    train = landed(_assembled(rows.filter(spread <= share), words).select("_features", "_y"), "secret-findings")
    forest = RandomForestClassifier(featuresCol="_features", labelCol="_y", numTrees=trees, maxDepth=depth, seed=seed,
                                    featureSubsetStrategy="sqrt")
    return Scanner(forest.fit(train), words)


def mask(docs: DataFrame, secrets: DataFrame, key: str, text: str) -> DataFrame:
    """``docs`` with every value of ``secrets`` (``doc``, ``value`` and ``content`` of findings) in the text it was found
    in replaced by ``MASK``; other texts and null ones stay. A null key is one like others, and texts of one key are
    told apart by their hash; without ``content`` a value is replaced in all texts of its key. Longer values go first,
    as one may lie in another. Columns stay as they are."""
    doc, content, values = (unused(n, docs) for n in ("doc", "content", "values"))
    keys = [F.col("doc").alias(doc)] + [F.col("content").alias(content)] * ("content" in secrets.columns)
    listed = secrets.groupBy(*keys).agg(F.array_sort(F.collect_set(
        F.struct((-F.length("value")).alias("n"), "value"))).alias(values))
    whole = docs[f"`{text}`"]
    same = docs[f"`{key}`"].eqNullSafe(F.col(doc))
    if content in listed.columns:
        same = same & (F.xxhash64(whole) == F.col(content))
    masked = F.when(F.col(values).isNull(), whole).otherwise(F.aggregate(
        values, whole, lambda w, v: F.replace(w, v["value"], F.lit(MASK))))
    return docs.join(listed, same, "left").withColumn(text, masked).select(*[F.col(f"`{c}`") for c in docs.columns])
