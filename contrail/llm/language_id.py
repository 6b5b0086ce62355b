"""Language identification by rank-order profiles of character n-grams."""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from contrail.llm.text import unused

UNKNOWN = "und"
MAX_LANGUAGES = 1_000
_CODES = 0x110000
_BITS = 21
_PREDICTION = StructType([StructField("lang_pred", StringType()), StructField("score", DoubleType())])


@functools.cache
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For every code point: whether it is a letter, and its lower case (itself where that is not one code point)."""
    chars = [chr(c) for c in range(_CODES)]
    is_letter = np.fromiter((c.isalpha() for c in chars), bool, _CODES)
    lower = np.fromiter((ord(low) if len(low := c.lower()) == 1 else ord(c) for c in chars), np.int64, _CODES)
    return is_letter, lower


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The different n-grams of one to three characters and their counts; none for a text without a letter.

    Letters count in lower case; each run of other characters is one blank, as are both ends. N-grams of blanks alone
    are left out. An n-gram is its code points in 21 bits each.
    """
    is_letter, lower = _letters()
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    letter = is_letter[codes]
    if not letter.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    codes = np.concatenate(([0], np.where(letter, lower[codes], 0), [0]))
    codes = codes[np.concatenate(([True], (codes[1:] != 0) | (codes[:-1] != 0)))]
    two = (codes[:-1] << _BITS) | codes[1:]
    three = (two[:-1] << _BITS) | codes[2:]
    return np.unique(np.concatenate((codes[codes != 0], two, three)), return_counts=True)


def _top(grams: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The most frequent n-grams in order; of equally frequent ones the smaller code first."""
    if len(grams) > 4 * size:  # only those that can be among them are sorted
        floor = np.partition(counts, len(counts) - size)[len(counts) - size]
        keep = counts >= floor
        grams, counts = grams[keep], counts[keep]
    return grams[np.lexsort((grams, -counts))[:size]]


@dataclass
class Profiles:
    """The ranked n-grams of each language, sorted by n-gram for lookup."""

    languages: list[str]
    grams: list[np.ndarray]
    ranks: list[np.ndarray]
    size: int

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language at the smallest out-of-place distance, and how far the next one is from it.

        An n-gram of the text that a profile lacks counts as ``size`` places. The score is the share of the second
        distance that the smallest one saves, from 0 (a tie, which the first language by name takes) to 1; with one
        language it is the share of the largest distance.
        """
        own = _top(*ngrams(text), self.size) if text else np.empty(0, np.int64)
        if not len(own) or not self.languages:
            return UNKNOWN, 0.0
        place = np.arange(len(own))
        distances = []
        for grams, ranks in zip(self.grams, self.ranks):
            at = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
            away = np.where(grams[at] == own, np.minimum(np.abs(ranks[at] - place), self.size), self.size)
            distances.append(int(away.sum()))
        best = int(np.argmin(distances))
        others = distances[:best] + distances[best + 1:]
        other = min(others) if others else self.size * len(own)
        return self.languages[best], (1.0 - distances[best] / other) if other else 0.0


def fit_profiles(labelled: DataFrame, text: str, lang: str, key: str, size: int = 400,
                 max_texts: int = 4_000) -> Profiles:
    """The ``size`` most frequent n-grams of each language.

    Fitted on about ``max_texts`` texts a language, those with the smallest hashes of their keys; n-grams are counted
    in the tasks, and the driver gets ``size`` n-grams of each language. Rows without text or language are left out. More than ``MAX_LANGUAGES`` are refused.
    """
    rows = labelled.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang"),
                           F.xxhash64(F.col(f"`{key}`")).alias("h")).filter("text is not null and lang is not null")
    # A share of the hashes bounds the sample of a language; it is looked up, so that texts need no shuffle.
    sizes = rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    shares = F.create_map(*[F.lit(v) for lang, n in sizes for v in (lang, min(1.0, max_texts / n))])
    spread = (F.col("h").cast("double") + 2.0 ** 63) / 2.0 ** 64
    picked = rows.filter(spread <= shares[F.col("lang")]) if sizes else rows

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for language, texts in batch.groupby("lang")["text"]:
                found = [ngrams(t) for t in texts]  # a batch of Arrow rows, bounded by the session's setting
                grams, inverse = np.unique(np.concatenate([g for g, _ in found]), return_inverse=True)
                counts = np.bincount(inverse, np.concatenate([c for _, c in found]), len(grams)).astype(np.int64)
                yield pd.DataFrame({"lang": language, "gram": grams, "n": counts})

    counted = picked.select("lang", "text").mapInPandas(count, "lang string, gram long, n long").groupBy(
        "lang", "gram").agg(F.sum("n").alias("n"))
    place = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    ranked = counted.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= size)
    profiles: dict[str, list[int]] = {}
    for language, _, gram in sorted(ranked.select("lang", "rank", "gram").collect()):
        profiles.setdefault(language, []).append(gram)
    languages = sorted(profiles)
    order = [np.argsort(np.array(profiles[language])) for language in languages]
    return Profiles(languages, [np.sort(np.array(profiles[x])) for x in languages], order, size)


def identify(docs: DataFrame, profiles: Profiles, text: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score`` to every row, from its whole text; no shuffle.

    A null text, one without a letter, and every text where nothing was learned is ``und`` with score 0. Columns of
    the input that have these names are replaced. The profiles go to every task; their size is bounded by the number
    of languages and ``Profiles.size``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(profiles)

    @F.pandas_udf(_PREDICTION)
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([shared.value.predict(t) for t in texts], columns=["lang_pred", "score"])

    found = unused("found", docs)
    out = docs.withColumn(found, predicted(F.col(f"`{text}`")))
    return out.withColumns({"lang_pred": F.col(f"{found}.lang_pred"), "score": F.col(f"{found}.score")}).drop(found)
