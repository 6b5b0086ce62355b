"""Toxicity by weak supervision: many voters, a generative model of their votes, a linear classifier on its labels."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_WORD = re.compile(r"[^\W\d_]+")
STEMS = (4, 5, 6, 7)
# Pattern voters: what a match says about a text, toxic (1) or clean (-1).
PATTERNS = (
    (re.compile(r"\b[A-Z]{4,}\b[^\n]*\b[A-Z]{4,}\b"), 1),
    (re.compile(r"[!?]{2,}"), 1),
    (re.compile(r"(?i)\byou(?:'re| are)? (?:an? )?\w+[.!]"), 1),
    (re.compile(r"(?i)\blicen[cs]ed? under\b|\bcopyright\b"), -1),
    (re.compile(r"https?://|\w@\w+\.\w"), -1),
)
_CACHE_WORDS = 500_000


def stems_of(word: str) -> list[str]:
    """What a lexicon may hold for a word: the word, and its beginnings (marked by ``*``)."""
    return [word, *(word[:k] + "*" for k in STEMS if len(word) > k)]


def entries_in(stems: Iterable[str]) -> set[str]:
    """The lexicon entries of a text from the stems of its different words: each stem, and whether two or three
    different words have it."""
    counts = Counter(stems)
    return {e + mark for e, n in counts.items() for mark in ("", "2", "3")[:n]}


def words_of(text: str | None) -> set[str]:
    """The different words of a text: runs of letters in lower case."""
    return set(_WORD.findall(text.lower())) if text else set()


@dataclass
class LabelModel:
    """P(vote | class) of every voter, and how much of its evidence counts beside the voters it agrees with."""

    prior: float
    chances: np.ndarray  # voter, class, vote + 1
    weight: np.ndarray

    @classmethod
    def fit(cls, votes: np.ndarray, prior: float, rounds: int = 50) -> LabelModel:
        """Expectation maximisation from the majority vote, with the class balance held at ``prior``.

        Voters that agree beyond what the class explains share their evidence: a voter's log-likelihood is divided by
        one plus the sum of its correlations above 0.1 with the others, within classes. They are estimated anew in
        every round, with the accuracies.
        """
        n, m = votes.shape
        balance = votes.sum(1)
        posterior = np.where(balance > 0, 0.9, np.where(balance < 0, 0.02, prior))
        model = cls(prior, np.full((m, 2, 3), 1 / 3), np.ones(m))
        onehot = np.stack([votes == v for v in (-1, 0, 1)], 2).astype(float)
        for turn in range(rounds):
            share = np.stack([1 - posterior, posterior], 1)
            # Two counted-in votes of the overall distribution keep rare voters from certainty.
            base = onehot.mean(0) + 1e-6
            model.chances = (np.einsum("nc,nmv->mcv", share, onehot) + 2 * base[:, None, :]) / (
                share.sum(0)[None, :, None] + 2)
            # What the classes leave unexplained; at first by the likelier class, as posteriors still are vague.
            belief = share if turn >= 5 else np.stack([posterior < 0.5, posterior >= 0.5], 1).astype(float)
            means = (belief.T @ votes) / np.maximum(belief.sum(0), 1e-9)[:, None]
            rest = votes - belief @ means
            rest = rest / np.maximum(rest.std(0), 0.05 * votes.std(0) + 1e-9)  # little is left where classes explain all
            related = np.abs(rest.T @ rest) / max(n, 1)
            np.fill_diagonal(related, 0)
            model.weight = 1 / (1 + np.where(related > 0.1, related, 0).sum(1))
            before, posterior = posterior, model.posterior(votes)
            if turn > 5 and np.abs(posterior - before).max(initial=0) < 1e-6:
                break
        return model

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """P(toxic | votes)."""
        logs = np.log(self.chances[:, 1, :]) - np.log(self.chances[:, 0, :])
        evidence = logs[np.arange(votes.shape[1])[None, :], votes + 1] @ self.weight
        return 1 / (1 + np.exp(-np.clip(evidence + np.log(self.prior / (1 - self.prior)), -50, 50)))


@dataclass
class Classifier:
    """A logistic score of the lexicon entries that a text holds."""

    bias: float = -4.0
    weights: dict[str, float] = field(default_factory=dict)
    seen: dict[str, tuple[str, ...]] = field(default_factory=dict, repr=False)

    def __post_init__(self):
        self.stems = {e.rstrip("23") for e in self.weights}

    def of_word(self, word: str) -> tuple[str, ...]:
        """The stems of a word that matter; remembered, as words recur."""
        found = self.seen.get(word)
        if found is None:
            if len(self.seen) >= _CACHE_WORDS:
                self.seen.clear()
            found = self.seen[word] = tuple(e for e in stems_of(word) if e in self.stems)
        return found

    def score(self, text: str | None) -> float:
        entries = entries_in(e for w in words_of(text) for e in self.of_word(w))
        z = self.bias + sum(self.weights.get(e, 0.0) for e in sorted(entries))
        return float(1 / (1 + np.exp(-np.clip(z, -50, 50))))


def _sample(labelled: DataFrame, text: str, label: str, key: str, max_texts: int) -> DataFrame:
    """About ``max_texts`` labelled rows, those with the smallest hashes of their keys."""
    rows = labelled.select(F.col(f"`{text}`").alias("text"), F.col(f"`{label}`").cast("int").alias("y"),
                           F.xxhash64(F.col(f"`{key}`")).alias("h")).filter("y in (0, 1)")
    share = min(1.0, max_texts / max(1, rows.count()))
    return rows.filter((F.col("h").cast("double") + 2.0 ** 63) / 2.0 ** 64 <= share).select("text", "y")


def _lexicon(sample: DataFrame, min_texts: int, min_precision: float, max_entries: int) -> dict[str, float]:
    """Entries that toxic labels go with, with the share of toxic texts among those that hold them."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            toxic, clean = Counter(), Counter()
            for text, y in zip(batch["text"], batch["y"]):
                (toxic if y else clean).update(entries_in(e for w in words_of(text) for e in stems_of(w)))
            found = sorted(toxic.keys() | clean.keys())
            yield pd.DataFrame({"entry": found, "p": [toxic[e] for e in found], "n": [clean[e] for e in found]})

    counts = sample.mapInPandas(count, "entry string, p long, n long").groupBy("entry").agg(
        F.sum("p").alias("p"), F.sum("n").alias("n"))
    share = F.col("p") / (F.col("p") + F.col("n"))
    kept = counts.filter((F.col("p") >= min_texts) & (share >= min_precision)).select("entry", "p", share.alias("share"))
    top = kept.orderBy(F.desc("p"), "entry").limit(max_entries)
    return {r["entry"]: r["share"] for r in top.collect()}


def _facts(texts: pd.Series, lexicon: set[str]) -> Iterator[tuple[list[str], int, list[int]]]:
    for text in texts:
        words = words_of(text)
        entries = sorted(entries_in(e for w in words for e in stems_of(w)) & lexicon)
        yield entries, len(words), [side if p.search(text or "") else 0 for p, side in PATTERNS]


def fit(labelled: DataFrame, text: str, label: str, key: str, max_texts: int = 12_000, n_lexicons: int = 24,
        min_texts: int = 3, min_precision: float = 0.8, max_entries: int = 4_000) -> Classifier:
    """A toxicity classifier from labelled texts.

    Voters are ``n_lexicons`` groups of words and stems that labels of 1 go with (a stem and its words in one group),
    two voters for clean texts that find nothing of the groups' strong entries, and ``PATTERNS``. ``LabelModel``
    turns votes into posterior labels, and a logistic regression of the entries in a text is fitted to those. About
    ``max_texts`` labelled rows are used, at most ``max_entries`` entries; both bound what the driver gets. Labels
    other than 0 and 1 are left out. Without labels of both kinds every text has the same low score.
    """
    sample = _sample(labelled, text, label, key, max_texts)
    lexicon = _lexicon(sample, min_texts, min_precision, max_entries)
    known = set(lexicon)

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = list(_facts(batch["text"], known))
            yield pd.DataFrame({"entries": [r[0] for r in rows], "words": [r[1] for r in rows],
                                "patterns": [r[2] for r in rows], "y": batch["y"].to_numpy()})

    facts = sample.mapInPandas(look, "entries array<string>, words int, patterns array<int>, y int").toPandas()
    if not lexicon or facts["y"].nunique() < 2:
        return Classifier()
    group = {e: zlib.crc32(e.rstrip("23*")[:STEMS[0]].encode()) % n_lexicons for e in lexicon}
    votes = np.zeros((len(facts), n_lexicons + 2 + len(PATTERNS)), int)
    for i, (entries, patterns) in enumerate(zip(facts["entries"], facts["patterns"])):
        for e in entries:
            votes[i, group[e]] = 1
        strong = sum(lexicon[e] >= 0.9 for e in entries)
        votes[i, n_lexicons] = -1 if not len(entries) else 0
        votes[i, n_lexicons + 1] = -1 if not strong else 1 if strong > 2 else 0
        votes[i, n_lexicons + 2:] = patterns
    prior = float(np.clip(facts["y"].mean(), 0.001, 0.5))
    posterior = LabelModel.fit(votes, prior).posterior(votes)
    return _regress(list(facts["entries"]), posterior, sorted(lexicon))


def _regress(entries: list[list[str]], target: np.ndarray, names: list[str], ridge: float = 0.05,
             rounds: int = 2_000) -> Classifier:
    """Logistic regression of probabilities on the presence of entries, with a ridge penalty.

    Descent with momentum; each step is scaled by the curvature that an entry's number of texts bounds.
    """
    index = {e: k for k, e in enumerate(names)}
    rows = np.repeat(np.arange(len(entries)), [len(e) for e in entries])
    cols = np.array([index[e] for own in entries for e in own], int)
    scale = 0.25 * np.bincount(cols, minlength=len(names)) + ridge
    w, b = np.zeros(len(names)), float(np.log(target.mean() / (1 - target.mean())))
    step_w, step_b = np.zeros_like(w), 0.0
    for _ in range(rounds):
        look = w + 0.9 * step_w
        z = b + 0.9 * step_b + np.bincount(rows, look[cols], len(entries))
        error = 1 / (1 + np.exp(-np.clip(z, -50, 50))) - target
        step_w = 0.9 * step_w - 0.05 * (np.bincount(cols, error[rows], len(names)) + ridge * look) / scale
        step_b = 0.9 * step_b - 0.1 * error.mean()
        w, b = w + step_w, b + step_b
    return Classifier(float(b), {e: float(w[k]) for e, k in index.items() if w[k]})


def score(docs: DataFrame, model: Classifier, text: str = "text") -> Column:
    """The score of each whole text between 0 and 1, higher where label 1 is likelier; narrow.

    A null or empty text holds no entry and has the lowest score there is without one. Equal texts have equal scores.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(shared.value.score).astype("float64")

    return scored(F.coalesce(F.col(f"`{text}`"), F.lit("")))
