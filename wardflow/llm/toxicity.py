"""Toxicity by weak supervision.

1. Terms that mark toxic rows are mined from a bounded sample of labelled rows and dealt
   to several lexicon voters; further voters look for patterns.
2. All documents are read once; how often every combination of votes occurs is counted
   over the whole table.
3. A generative label model is fitted to these counts by expectation maximisation: how
   often each voter fires on toxic and on clean documents, and how voters correlate given
   the class, so that voters which repeat each other count less.
4. A linear classifier on terms, patterns and votes is trained on the model's posteriors.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.columns import keeps_columns
from wardflow.session import materialize

#: Bound of the labelled sample, for each of the two classes.
SAMPLE_ROWS = 4_000
#: Bound of the mined lexicon.
MOST_TERMS = 1_500
LEXICON_VOTERS = 8
#: How often a label is right, as a voter among others.
LABEL_ACCURACY = 0.995
PREFIX = 4

# Patterns that may speak for abuse, each a voter.
PATTERNS = (
    r"\byou(?:'re| are)? (?:a |an |so |such )",
    r"[!?]{3,}",
    r"\b[A-Z]{4,}(?: [A-Z]{4,})+\b",
    r"\b\w+[*@$#]+\w+\b",
)
VOTERS = LEXICON_VOTERS + len(PATTERNS) + 1  # the last one speaks for clean texts

_TOKEN = re.compile(r"\w+")


def terms_of(text: str) -> set[str]:
    """Words of a text in lower case, and the beginnings of longer ones."""
    words = set(_TOKEN.findall(text.lower()))
    return words | {w[:PREFIX] + "~" for w in words if len(w) > PREFIX}


def labelled_sample(
    docs: DataFrame, labels: DataFrame, sample_rows: int
) -> tuple[DataFrame, dict[bool, int]]:
    """Text and label of at most ``sample_rows`` rows of each class, chosen by hash.

    Also the number of labelled documents of each class. Several labels of a document count by their majority. The chosen ids are few by the
    bound, which is why they are broadcast.
    """
    label = (F.avg("toxic") >= 0.5).alias("_toxic")
    rated = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(label)
    order = F.xxhash64("doc_id", F.lit("sample"))
    classes = [rated.where(F.col("_toxic") == c).orderBy(order, "doc_id").limit(sample_rows) for c in (True, False)]
    ids = materialize(classes[0].union(classes[1]).withColumnRenamed("doc_id", "_id"), "toxicity_sample")
    sample = docs.select(F.col("doc_id").alias("_id"), F.coalesce("text", F.lit("")).alias("_text")).join(
        F.broadcast(ids), "_id"
    )
    return sample, {r["_toxic"]: r["count"] for r in rated.groupBy("_toxic").count().collect()}


def mine_terms(sample: DataFrame, most_terms: int) -> list[tuple[str, float]]:
    """Terms (with log odds) that are much commoner in toxic rows of the sample.

    A term must occur in three rows at least, and its odds must be four times as high
    after one standard error is taken off; the terms with most evidence are kept.
    """

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen: dict[str, list[int]] = {}
            for text, toxic in zip(batch["_text"], batch["_toxic"], strict=True):
                for term in terms_of(text):
                    seen.setdefault(term, [0, 0])[bool(toxic)] += 1
            counts = np.array(list(seen.values()), np.int64).reshape(-1, 2)
            # A batch without any word must still have a text column.
            names = pd.Series(list(seen), dtype=object)
            yield pd.DataFrame({"term": names, "clean": counts[:, 0], "toxic": counts[:, 1]})

    total = {r["_toxic"]: r["count"] for r in sample.groupBy("_toxic").count().collect()}
    clean, toxic = total.get(False, 0), total.get(True, 0)
    odds = F.log((F.col("toxic") + 0.2) / (toxic + 1.0)) - F.log((F.col("clean") + 0.2) / (clean + 1.0))
    found = (
        sample.mapInPandas(rows, "term string, clean long, toxic long")
        .groupBy("term")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .where("toxic >= 3")
        .withColumn("odds", odds)
        .where(F.col("odds") - F.sqrt(1 / F.col("toxic") + 1 / (F.col("clean") + 0.5)) >= float(np.log(4)))
        .orderBy((F.col("toxic") * F.col("odds")).desc(), "term")
        .limit(most_terms)
        .collect()
    )
    return [(r["term"], r["odds"]) for r in found]


def evidence(text: Column, terms: list[str]) -> Column:
    """Struct (terms: numbers of the lexicon terms in a text, votes: a bit for each voter)."""
    number = {t: i for i, t in enumerate(terms)}
    patterns = PATTERNS

    @F.pandas_udf("terms array<int>, votes int")
    def look(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = frozenset(number)
        compiled = [re.compile(p) for p in patterns]
        for texts in batches:
            found, votes = [], []
            for t in texts:
                t = t or ""
                hits = sorted(number[x] for x in terms_of(t) & known)
                vote = 0
                for h in hits:
                    vote |= 1 << (h % LEXICON_VOTERS)
                for k, p in enumerate(compiled):
                    if p.search(t):
                        vote |= 1 << (LEXICON_VOTERS + k)
                if not hits:
                    vote |= 1 << (VOTERS - 1)
                found.append(hits)
                votes.append(vote)
            yield pd.DataFrame({"terms": found, "votes": votes})

    return look(text)


@dataclass
class LabelModel:
    """Class prior, firing rates by class, and the weight left to each voter by its correlations."""

    prior: float
    fires: np.ndarray  # 2 x voters
    weight: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability that rows of a 0/1 vote matrix are toxic."""
        p = np.log(self.fires), np.log1p(-self.fires)
        score = (votes * (p[0][1] - p[0][0]) + (1 - votes) * (p[1][1] - p[1][0])) @ self.weight
        return 1 / (1 + np.exp(-np.clip(score + np.log(self.prior / (1 - self.prior)), -30, 30)))


def with_label(posterior: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Posterior with a label as one more voter, which is right with ``LABEL_ACCURACY``."""
    p = np.clip(posterior, 1e-9, 1 - 1e-9)
    z = np.log(p / (1 - p)) + (2 * label - 1) * np.log(LABEL_ACCURACY / (1 - LABEL_ACCURACY))
    return 1 / (1 + np.exp(-z))


def vote_matrix(votes) -> np.ndarray:
    return (np.asarray(votes, np.int64)[:, None] >> np.arange(VOTERS)) & 1


def fit_label_model(votes: np.ndarray, counts: np.ndarray, labels: np.ndarray, *, rounds: int = 60) -> LabelModel:
    """Fit to vote combinations, their counts, and labels (1, 0, or -1 where none is known)."""
    known = labels >= 0
    prior = float(np.clip((counts * (labels == 1)).sum() / max((counts * known).sum(), 1), 0.005, 0.5))
    start = np.where(votes[:, :-1].any(axis=1), 0.6, 0.02)
    p = np.where(known, labels, start).astype(float)
    weight = np.ones(votes.shape[1])
    model = None
    for _ in range(rounds):
        mass = np.stack([counts * (1 - p), counts * p])
        total = mass.sum(axis=1, keepdims=True)
        fires = (mass @ votes + 0.5) / (total + 1)
        prior = float(np.clip(total[1, 0] / total.sum(), 0.002, 0.6))
        # Correlation of two voters given the class, averaged over classes.
        joint = np.zeros((votes.shape[1],) * 2)
        for c in (0, 1):
            off = votes - fires[c]
            sd = np.sqrt(fires[c] * (1 - fires[c])) + 1e-9
            joint += (off * mass[c][:, None]).T @ off / max(total[c, 0], 1) / np.outer(sd, sd) / 2
        np.fill_diagonal(joint, 0)
        weight = 1 / (1 + np.clip(joint, 0, 1).sum(axis=1))
        model = LabelModel(prior, np.clip(fires, 1e-4, 1 - 1e-4), weight)
        p = model.posterior(votes)
        p = np.where(known, with_label(p, labels), p)
    return model


@dataclass
class Classifier:
    bias: float
    terms: np.ndarray
    votes: np.ndarray

    def score(self, terms: list[np.ndarray], votes) -> np.ndarray:
        z = vote_matrix(votes) @ self.votes + self.bias
        z += np.array([self.terms[t].sum() if len(t) else 0.0 for t in terms])
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_classifier(
    terms: list[np.ndarray], votes, target: np.ndarray, stands_for: np.ndarray, n_terms: int, *, steps: int = 400
) -> Classifier:
    """Logistic regression on soft targets by gradient steps; a row stands for so many."""
    stands_for = stands_for / max(stands_for.sum(), 1e-9)
    row = np.repeat(np.arange(len(terms)), [len(t) for t in terms])
    col = np.concatenate([*terms, np.empty(0, np.int64)]).astype(np.int64)
    v = vote_matrix(votes).astype(float)
    share = float(np.clip(stands_for @ target, 1e-3, 1 - 1e-3))
    w, u, b = np.zeros(n_terms), np.zeros(VOTERS), float(np.log(share / (1 - share)))
    first, second = np.zeros(n_terms + VOTERS + 1), np.zeros(n_terms + VOTERS + 1)
    for step in range(1, steps + 1):
        z = v @ u + b + np.bincount(row, w[col], minlength=len(terms))
        g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target) * stands_for
        full = np.concatenate([np.bincount(col, g[row], minlength=n_terms) + 1e-5 * w, v.T @ g + 1e-5 * u, [g.sum()]])
        first += 0.1 * (full - first)
        second += 0.01 * (full * full - second)
        move = 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
        w, u, b = w - move[:n_terms], u - move[n_terms:-1], b - move[-1]
    return Classifier(b, w, u)


@keeps_columns("doc_id", "text", new=("toxicity",), dropped=("text",))
def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    *,
    sample_rows: int = SAMPLE_ROWS,
    most_terms: int = MOST_TERMS,
) -> DataFrame:
    """``docs`` (doc_id, text and any other columns) with ``toxicity`` between 0 and 1.

    ``labels`` (doc_id, toxic) holds what may be learned from, nothing else is. Only the text
    enters a score. A text that is NULL or empty is scored as one without any sign; without
    usable labels every score is 0. Rows with the same text get the same score; ids may be
    NULL or repeated; no rows give no rows.
    """
    sample, totals = labelled_sample(docs, labels, sample_rows)
    lexicon = mine_terms(sample, most_terms)
    terms = [t for t, _ in lexicon]
    keep = [c for c in docs.columns if c not in ("text", "toxicity")]
    seen = materialize(
        docs.select(*keep, evidence(F.col("text"), terms).alias("_seen")), "toxicity_evidence"
    )
    taught = sample.select("_toxic", evidence(F.col("_text"), terms).alias("_seen")).collect()
    combinations = seen.groupBy(F.col("_seen.votes").alias("votes")).count().collect()
    if not taught or not combinations:
        return seen.drop("_seen").withColumn("toxicity", F.lit(0.0))
    taught = sorted((r["_seen"]["votes"], tuple(r["_seen"]["terms"]), bool(r["_toxic"])) for r in taught)
    combinations = sorted(combinations)
    own = pd.DataFrame([(v, int(y)) for v, _, y in taught], columns=["votes", "label"]).value_counts().sort_index()
    votes = [c["votes"] for c in combinations] + [k[0] for k in own.index]
    taught_as = own.groupby(level="votes").sum().to_dict()
    model = fit_label_model(
        vote_matrix(votes),
        # A labelled row counts once, with its label.
        np.array([max(c["count"] - taught_as.get(c["votes"], 0), 0) for c in combinations] + list(own), float),
        np.array([-1] * len(combinations) + [k[1] for k in own.index]),
    )
    lists, taught_votes = [np.array(t, np.int64) for _, t, _ in taught], [v for v, _, _ in taught]
    truth = np.array([y for _, _, y in taught], float)
    target = with_label(model.posterior(vote_matrix(taught_votes)), truth)
    share = {y: totals.get(y, 0) / max((truth == y).sum(), 1) for y in (False, True)}
    stands_for = np.where(truth == 1, share[True], share[False])
    fitted = fit_classifier(lists, taught_votes, target, stands_for, len(terms))

    @F.pandas_udf("double")
    def score(seen_terms: pd.Series, seen_votes: pd.Series) -> pd.Series:
        return pd.Series(fitted.score([np.asarray(t, np.int64) for t in seen_terms], seen_votes.to_numpy()))

    return seen.withColumn("toxicity", score("_seen.terms", "_seen.votes")).drop("_seen")
