"""Allow and block lists of hosts and path prefixes, matched through a trie."""

from __future__ import annotations

import string
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from contrail.llm.text import ascii_lower, unused

ALLOW, BLOCK = "allow", "block"
# The trie goes to every task, so the text of all its rules may not exceed this; longer lists go through a join.
MAX_TRIE_BYTES = 64 * 1024 * 1024

_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
_JUDGED = StructType([StructField("rule", StringType()), StructField("verdict", StringType())])


@dataclass(frozen=True)
class Rule:
    """``host`` with all its subdomains, for paths that start with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


class Trie:
    """Rules by reversed host labels, and below each host by whole path segments.

    A rule's path ends in a whole segment (``/en/``) or in the beginning of one (``/en``); the beginning is kept
    beside the node of the whole segments before it.
    """

    def __init__(self, rules: Sequence[Rule]):
        self.root: dict = {}
        # Of two rules for the same place the blocking one holds.
        for rule in sorted(rules, key=lambda r: r.verdict == BLOCK):
            node = self.root
            for label in reversed(rule.host.translate(_LOWER).split(".")):
                node = node.setdefault("labels", {}).setdefault(label, {})
            *whole, begun = rule.path.split("/")
            for segment in whole:
                node = node.setdefault("segments", {}).setdefault(segment, {})
            node.setdefault("ends", {})[begun] = rule

    def match(self, host: str, path: str) -> Rule | None:
        """The rule with the most host labels that fits, and of those the one with the longest path."""
        node, hosts = self.root, []
        for label in reversed(host.split(".")):
            node = node.get("labels", {}).get(label)
            if node is None:
                break
            hosts.append(node)
        segments = path.split("/")
        for node in reversed(hosts):
            best = None
            for k, segment in enumerate([*segments, None]):
                ends = node.get("ends", {})
                if ends and k < len(segments):
                    fits = [begun for begun in ends if segment.startswith(begun)]
                    best = ends[max(fits, key=len)] if fits else best
                node = node.get("segments", {}).get(segment) if k < len(segments) - 1 else None
                if node is None:
                    break
            if best is not None:
                return best
        return None


def judge_urls(pages: DataFrame, rules: Sequence[Rule], url: str = "url", otherwise: str = ALLOW) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` (null where none fits) and ``verdict`` to every row; no shuffle.

    The rule with the longest host wins, then the one with the longest path, whatever its verdict; where the same
    place is allowed and blocked, it is blocked. A null url, and one without ``://``, has an empty host and path, which
    no rule with a host fits. Rows are kept as they are, repeated ones included; columns of the input that have one of
    the four names are replaced. Lists beyond ``MAX_TRIE_BYTES`` are refused: ``judge_urls_by_join`` takes those.
    """
    if sum(len(r.name.encode()) for r in rules) > MAX_TRIE_BYTES:
        raise ValueError("the rules exceed MAX_TRIE_BYTES; use judge_urls_by_join")
    trie = pages.sparkSession.sparkContext.broadcast(Trie(rules))

    @F.pandas_udf(_JUDGED)
    def judged(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for hosts, paths in batches:
            found = [trie.value.match(h, p) for h, p in zip(hosts, paths)]
            yield pd.DataFrame({
                "rule": [r.name if r else None for r in found],
                "verdict": [r.verdict if r else otherwise for r in found],
            }, dtype=object)

    place = pages.withColumns({"host": host_of(F.col(f"`{url}`")), "path": path_of(F.col(f"`{url}`"))})
    found = unused("judged", place)
    out = place.withColumn(found, judged("host", "path"))
    return out.withColumns({"rule": F.col(f"{found}.rule"), "verdict": F.col(f"{found}.verdict")}).drop(found)


def judge_urls_by_join(pages: DataFrame, rules: DataFrame, key: str, url: str = "url",
                       otherwise: str = ALLOW) -> DataFrame:
    """``judge_urls`` for a list of any length, given as a table of ``verdict``, ``host`` and ``path``.

    Each page asks for every suffix of its host and every beginning of its path up to a ``/``, so rule paths must end
    in ``/``. Hosts of rules are lower-cased like those of pages, A-Z only. Rows are told apart by ``key`` and url: a
    null key is one like others, rows of one key may have different urls, and repeated rows stay repeated. Returns
    ``key``, ``host``, ``path``, ``rule`` and ``verdict``.
    """
    labels = F.split("host", r"\.")
    address = F.col(f"`{url}`")
    place = pages.select(F.col(f"`{key}`").alias("id"), F.xxhash64(address).alias("same"),
                         host_of(address).alias("host"), path_of(address).alias("path"))
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels))))
    cuts = F.size(F.split("path", "/")) - 1
    asked = (place.withColumn("end", F.explode(suffixes)).filter(cuts > 0)
             .withColumn("start", F.explode(F.transform(F.sequence(F.lit(1), cuts), lambda i: F.concat(
                 F.call_function("substring_index", F.col("path"), F.lit("/"), i), F.lit("/"))))))
    known = rules.groupBy(ascii_lower(F.col("host")).alias("end"), F.col("path").alias("start")).agg(
        F.max("verdict").alias("says"))
    best = asked.join(known, ["end", "start"]).groupBy(F.col("id").alias("best_id"), F.col("same").alias("best_same")).agg(
        F.max(F.struct(F.size(F.split("end", r"\.")).alias("depth"), F.length("start").alias("size"),
                       F.concat("end", "start").alias("rule"), F.col("says").alias("verdict"))).alias("best"))
    same = F.col("id").eqNullSafe(F.col("best_id")) & (F.col("same") == F.col("best_same"))
    return place.join(best, same, "left").select(
        F.col("id").alias(key), "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.verdict"), F.lit(otherwise)).alias("verdict"))
