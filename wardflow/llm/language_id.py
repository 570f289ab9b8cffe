"""Language identification by a byte convolutional network.

The network looks at windows of ``WINDOW`` bytes. For each width in ``WIDTHS`` a set
of filters slides over the embedded bytes; a filter's largest response in the window
feeds a softmax over the languages. It is trained with plain gradient steps in numpy
on the driver, on a bounded sample of labelled windows. Texts of any length are cut
into windows, all of which count.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.columns import keeps_columns

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 12
EMBEDDED = 8
#: Bound of the training sample: windows expected for each language.
SAMPLE_WINDOWS = 1_500
STEPS = 600
UNDETERMINED = "und"


@dataclass
class Network:
    languages: list[str]
    embedding: np.ndarray  # 256 x EMBEDDED
    filters: list[np.ndarray]  # for each width: width x EMBEDDED x FILTERS
    bias: np.ndarray
    output: np.ndarray  # features x languages
    output_bias: np.ndarray

    def response_tables(self) -> list[list[np.ndarray]]:
        """What two neighbouring bytes (or one) add to each filter's response.

        Filters are linear in the embedded bytes, so responses to all 65,536 pairs
        are worked out once and a window needs lookups only.
        """
        tables = []
        for w in self.filters:
            single = np.einsum("be,kef->kbf", self.embedding, w).astype(np.float32)
            parts = [
                (single[k][:, None, :] + single[k + 1][None, :, :]).reshape(65536, -1)
                for k in range(0, len(w) - 1, 2)
            ]
            tables.append(parts + ([single[-1]] if len(w) % 2 else []))
        return tables

    def features(self, windows: np.ndarray, tables: list[list[np.ndarray]]) -> np.ndarray:
        # Places come first, so that the largest response is a run of whole-array maxima.
        single = np.ascontiguousarray(windows.T).astype(np.intp)
        pairs = single[:-1] * 256 + single[1:]
        pooled = []
        for width, parts in zip(WIDTHS, tables, strict=True):
            n = windows.shape[1] - width + 1
            r = np.take(parts[0], pairs[:n], axis=0)
            for i, part in enumerate(parts[1:], 1):
                at = pairs if len(part) > 256 else single
                r += np.take(part, at[2 * i : 2 * i + n], axis=0)
            pooled.append(r.max(axis=0))
        return np.maximum(np.concatenate(pooled, axis=1) + self.bias, 0)

    def log_probabilities(self, windows: np.ndarray, tables) -> np.ndarray:
        z = self.features(windows, tables) @ self.output + self.output_bias
        z -= z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def windows_of(text: str) -> np.ndarray:
    """All bytes of a text in rows of WINDOW bytes; the last row is filled with zeros."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    rows = np.zeros(-(-max(len(data), 1) // WINDOW) * WINDOW, np.uint8)
    rows[: len(data)] = data
    return rows.reshape(-1, WINDOW)


def train(texts: list[str], languages: list[str], *, steps: int = STEPS, seed: int = 7) -> Network:
    """Fit the network to labelled pieces of text (at least one)."""
    names = sorted(set(languages))
    x = np.concatenate([windows_of(t)[:1] for t in texts])
    y = np.array([names.index(lang) for lang in languages])
    rng = np.random.default_rng(seed)
    net = Network(
        names,
        rng.normal(0, 0.5, (256, EMBEDDED)),
        [rng.normal(0, (2 / (w * EMBEDDED)) ** 0.5, (w, EMBEDDED, FILTERS)) for w in WIDTHS],
        np.zeros(len(WIDTHS) * FILTERS),
        rng.normal(0, 0.2, (len(WIDTHS) * FILTERS, len(names))),
        np.zeros(len(names)),
    )
    weights = [net.embedding, *net.filters, net.bias, net.output, net.output_bias]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    shares = np.bincount(y, minlength=len(names)).astype(float)
    odds = (1 / np.maximum(shares, 1))[y]
    odds /= odds.sum()
    for step in range(1, steps + 1):
        pick = rng.choice(len(x), size=min(64, len(x)), p=odds)
        batch = x[pick].copy()
        # Short texts are windows filled with zeros: show some of those.
        for row in np.flatnonzero(rng.random(len(batch)) < 0.4):
            batch[row, int(rng.integers(6, WINDOW)) :] = 0
        for w, g, m, v in zip(weights, _gradients(net, batch, y[pick]), first, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            w -= 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def _gradients(net: Network, batch: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    rows = np.arange(len(batch))[:, None]
    embedded = net.embedding[batch]
    fields, best = [], []
    for width, w in zip(WIDTHS, net.filters, strict=True):
        n = batch.shape[1] - width + 1
        stack = np.concatenate([embedded[:, k : k + n] for k in range(width)], axis=2)
        response = stack @ w.reshape(-1, FILTERS)
        at = response.argmax(axis=1)
        fields.append((stack, at))
        best.append(np.take_along_axis(response, at[:, None, :], axis=1)[:, 0])
    before = np.concatenate(best, axis=1) + net.bias
    features = np.maximum(before, 0)
    z = features @ net.output + net.output_bias
    p = np.exp(z - z.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    p[np.arange(len(y)), y] -= 1
    p /= len(y)
    back = (p @ net.output.T) * (before > 0)
    to_embedding, to_filters = np.zeros_like(net.embedding), []
    for i, (width, w) in enumerate(zip(WIDTHS, net.filters, strict=True)):
        stack, at = fields[i]
        g = back[:, i * FILTERS : (i + 1) * FILTERS]
        seen = stack[rows, at]  # batch x filters x (width * embedded)
        to_filters.append(np.einsum("bfe,bf->ef", seen, g).reshape(w.shape))
        for k in range(width):
            np.add.at(to_embedding, batch[rows, at + k].ravel(), (g[:, :, None] * w[k].T[None]).reshape(-1, EMBEDDED))
    return [to_embedding, *to_filters, back.sum(axis=0), features.T @ p, p.sum(axis=0)]


def labelled_windows(docs: DataFrame, text: str, label: str, sample_windows: int) -> DataFrame:
    """About ``sample_windows`` different pieces of text for each label, at most twice that.

    Rows are counted for each label over the whole table first (a classifier has few
    labels). Then rows are chosen by a hash of the text, so that a group of copies counts
    once; of a chosen row up to four windows count, at places the hash sets.
    """
    # An empty text has no window; NULL never equals a label.
    known = docs.where(F.col(label).isNotNull() & (F.length(text) > 0)).select(
        F.col(label).alias("_label"), F.col(text).alias("_text")
    )
    counts = {r["_label"]: r["count"] for r in known.groupBy("_label").count().collect()}
    share = F.lit(0.0)
    for name, n in counts.items():
        share = F.when(F.col("_label") == name, sample_windows / 4 / n).otherwise(share)
    chance = F.pmod(F.xxhash64("_text", F.lit("rows")), F.lit(1 << 30)) / float(1 << 30)
    return (
        known.withColumn("_chance", chance)
        .where(F.col("_chance") <= share)
        .withColumn("_places", places_of("_text"))
        .select("_label", "_chance", piece_of("_text", "_places").alias("_piece"))
        .distinct()
        .orderBy("_chance", "_piece", "_label")
        .limit(2 * sample_windows * max(len(counts), 1))
    )


def places_of(text: str) -> Column:
    """Four starts of windows in a text, set by its hash."""
    last = F.greatest(F.length(text) - WINDOW, F.lit(1))
    return F.array(*[(F.pmod(F.xxhash64(F.col(text), F.lit(k)), last) + 1).cast("int") for k in range(4)])


def piece_of(text: str, places: str) -> Column:
    return F.explode(F.transform(F.col(places), lambda at: F.col(text).substr(at, F.lit(WINDOW))))


def fit(docs: DataFrame, text: str = "text", label: str = "lang", *, sample_windows: int = SAMPLE_WINDOWS) -> Network | None:
    """Network for the labels of ``docs``; None where no row has text and label.

    What reaches the driver is bounded by ``sample_windows`` times the number of languages.
    """
    rows = labelled_windows(docs, text, label, sample_windows).collect()
    if not rows:
        return None
    rows = sorted((r["_piece"], r["_label"]) for r in rows)
    return train([p for p, _ in rows], [lang for _, lang in rows])


def predicted(column: Column, net: Network | None) -> Column:
    """Struct (lang, score) of a text column: the language of largest mean log probability.

    ``score`` is its share when those means are made to sum to 1. A text that is NULL or
    has no letter is ``und`` with score 0, and so is every text where nothing was learned.
    """

    @F.pandas_udf("lang string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tables = net.response_tables() if net else None
        for texts in batches:
            lang, score = [], []
            pending: list[np.ndarray] = []

            def flush(pending=pending, lang=lang, score=score):
                if not pending:
                    return
                rows = np.concatenate(pending)
                sums = np.empty((len(rows), len(net.languages)))
                for i in range(0, len(rows), 256):
                    sums[i : i + 256] = net.log_probabilities(rows[i : i + 256], tables)
                bounds = np.cumsum([0] + [len(p) for p in pending])
                mean = np.add.reduceat(sums, bounds[:-1]) / np.diff(bounds)[:, None]
                p = np.exp(mean - mean.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                lang.extend(net.languages[k] for k in p.argmax(axis=1))
                score.extend(p.max(axis=1))
                pending.clear()

            size = 0
            for text in texts:
                if text is None or net is None:
                    flush()
                    lang.append(UNDETERMINED)
                    score.append(0.0)
                    continue
                pending.append(windows_of(text))
                size += len(pending[-1])
                if size >= 4096:
                    flush()
                    size = 0
            flush()
            yield pd.DataFrame({"lang": lang, "score": score}, columns=["lang", "score"])

    return predict(F.when(column.rlike(r"\p{L}"), column))


@keeps_columns("text", new=("lang_pred", "lang_score"))
def identify(docs: DataFrame, net: Network | None) -> DataFrame:
    """``docs`` (text, others) with ``lang_pred`` and ``lang_score`` (replacing columns of that name).

    Only the text goes through Python; every other column, of whatever name, stays as it
    is. Repeated rows get the same answer; no rows give no rows.
    """
    return (
        docs.withColumn("_predicted", predicted(F.col("text"), net))
        .withColumn("lang_pred", F.col("_predicted.lang"))
        .withColumn("lang_score", F.col("_predicted.score"))
        .drop("_predicted")
    )
