"""Language-model scoring with a probabilistic suffix tree over bytes.

A text is its lower-cased words, each followed by a space, then an end symbol. The tree
holds contexts of up to ``DEPTH`` bytes. A context seen ``LEAST_COUNT`` times is kept if its
next-symbol counts diverge from what the next shorter context predicts (by more than ``GAIN``
nats for each symbol seen); its distribution is smoothed with that of the shorter one. Every
byte is scored in the state of the longest kept suffix of what stands before it.

The tree has all such contexts and stays distributed. Tasks get its commonest states, a table
of bounded size; a state says whether longer ones are left out of the table. Bytes that stand
in such a state are counted for each text and meet the whole tree in joins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wardflow.llm import words
from wardflow.llm.columns import keeps_columns
from wardflow.session import materialize

DEPTH = 5
LEAST_COUNT = 50
GAIN = 3.0
#: Bounds of the tables of the commonest tokens and of the next symbols of the commonest states.
COMMON_TOKENS, COMMON_SYMBOLS = 1 << 16, 1 << 20
END, SPACE = 0, 32


def symbols(run: words.Run) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts of a run and where each text begins (NUL in a word counts as 1)."""
    lengths = run.ends - run.starts
    owner = np.repeat(np.arange(len(run)), np.diff(run.bounds))
    out_starts = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1] + owner
    sizes = np.bincount(owner, lengths + 1, len(run)).astype(np.int64) + 1
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    out = np.full(bounds[-1], SPACE, np.uint8)
    out[bounds[1:] - 1] = END
    shift = np.repeat(out_starts - run.starts, lengths)
    source = np.flatnonzero(words.IS_WORD[run.data])
    out[source + shift] = np.maximum(run.data[source], 1)
    return out, bounds


def grams(stream: np.ndarray) -> np.ndarray:
    """Contexts of DEPTH bytes with the next symbol, packed into integers, for each symbol.

    The context of a text's first byte is the end symbol; nothing before it counts.
    """
    padded = np.concatenate([np.zeros(DEPTH, np.uint8), stream])
    n = len(stream)
    packed = stream.astype(np.uint64)
    inside = np.ones(n, bool)
    for k in range(1, DEPTH + 1):
        byte = padded[DEPTH - k : DEPTH - k + n]
        packed |= np.where(inside, byte, 0).astype(np.uint64) << np.uint64(8 * k)
        inside &= byte != END
    return packed


def corpus_counts(docs: DataFrame) -> DataFrame:
    """Rows (kind, key, n): counts of tokens by hash (kind 0) and of grams (kind 1)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for kind in (0, 1):
                keys, counts = [], []
                for run in words.runs(batch.column("text"), lower=True):
                    k, n = np.unique(run.hashes, return_counts=True) if kind == 0 else np.unique(grams(symbols(run)[0]), return_counts=True)
                    keys.append(k)
                    counts.append(n)
                if not keys:
                    continue
                k, inverse = np.unique(np.concatenate(keys), return_inverse=True)
                n = np.bincount(inverse, np.concatenate(counts)).astype(np.int64)
                for i in range(0, len(k), 200_000):
                    part = k[i : i + 200_000].view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(part), kind, np.int8)), pa.array(part), pa.array(n[i : i + 200_000])],
                        names=["kind", "key", "n"],
                    )

    return docs.select("text").mapInArrow(rows, "kind byte, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))


def state_key(d: int, context: np.ndarray) -> np.ndarray:
    """A number for the last ``d`` bytes of contexts, in the order of d."""
    return (context & ((1 << (8 * d)) - 1)) | (d << 40)


@dataclass
class Table:
    """The commonest states by key, with the sum and number of their next symbols and whether
    all longer states are here too; counts of the symbols by state and symbol."""

    states: np.ndarray
    totals: np.ndarray
    kinds: np.ndarray
    closed: np.ndarray
    symbols: np.ndarray
    counts: np.ndarray

    def score(self, packed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 probability of packed grams, and whether it is that of the whole tree."""
        packed = packed.view(np.int64)
        context, symbol = packed >> 8, packed & 255
        p, sure = np.full(len(packed), 1 / 256), np.ones(len(packed), bool)
        left = np.arange(len(packed))
        for d in range(DEPTH + 1):
            key = state_key(d, context[left])
            at = np.minimum(np.searchsorted(self.states, key), len(self.states) - 1)
            found = self.states[at] == key
            left, key, at = left[found], key[found], at[found]
            cell = (key << 8) | symbol[left]
            place = np.minimum(np.searchsorted(self.symbols, cell), max(len(self.symbols) - 1, 0))
            n = np.where(self.symbols[place] == cell, self.counts[place], 0) if len(self.symbols) else 0
            weight = self.kinds[at] if d else 128
            p[left] = (n + weight * p[left]) / (self.totals[at] + weight)
            sure[left] = self.closed[at]
        return np.log10(p), sure


def context_counts(grams: DataFrame) -> DataFrame:
    """Rows (d, context, next, n): counts of the next symbols of all contexts of up to DEPTH bytes."""
    levels = None
    for d in range(DEPTH + 1):
        context = F.shiftright("key", 8).bitwiseAND(F.lit((1 << (8 * d)) - 1))
        level = grams.select(F.lit(d).alias("d"), context.alias("context"), F.col("key").bitwiseAND(F.lit(255)).alias("next"), "n")
        levels = level if levels is None else levels.union(level)
    return materialize(levels.groupBy("d", "context", "next").agg(F.sum("n").alias("n")), "context_counts")


def totals_of(levels: DataFrame) -> DataFrame:
    return levels.groupBy("d", "context").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))


def kept_contexts(levels: DataFrame) -> DataFrame:
    """Rows (d, context) of the contexts that diverge from the next shorter one."""
    totals = totals_of(levels)
    rated = levels.join(totals.where(F.col("total") >= LEAST_COUNT), ["d", "context"])
    upper = levels.join(totals, ["d", "context"]).select(
        (F.col("d") + 1).alias("d"), F.col("context").alias("shorter"), "next", (F.log("n") - F.log("total")).alias("expected")
    )
    shorter = F.expr("context & (shiftleft(1L, 8 * (d - 1)) - 1)")
    gain = F.sum(F.col("n") * (F.log("n") - F.log("total") - F.col("expected")))
    return (
        rated.where("d > 0").withColumn("shorter", shorter).join(upper, ["d", "shorter", "next"])
        .groupBy("d", "context").agg(gain.alias("gain"), F.first("kinds").alias("kinds"))
        .where(F.col("gain") > GAIN * F.col("kinds")).select("d", "context")
    )


def tree_states(levels: DataFrame) -> DataFrame:
    """Rows (d, context, total, kinds, size): the states of the tree.

    Every part of a kept context is a state. ``size`` grows with the total; no state has more
    than the shorter ones that end it.
    """
    parts = "flatten(transform(sequence(0, d), a -> transform(sequence(0, d - a), b -> {part})))"
    part = "struct(b AS d, shiftright(context, 8 * a) & (shiftleft(1L, 8 * b) - 1) AS context)"
    states = kept_contexts(levels).select(F.explode(F.expr(parts.format(part=part))).alias("_x")).select("_x.*")
    root = levels.sparkSession.range(1).select(F.lit(0).alias("d"), F.lit(0).cast("long").alias("context"))
    states = states.union(root).distinct().join(totals_of(levels), ["d", "context"])
    return materialize(states.withColumn("size", F.floor(16 * F.log2("total")).cast("int")), "tree_states")


def common_table(levels: DataFrame, states: DataFrame) -> Table:
    """The states of the largest sizes, as many as the bound allows."""
    least, so_far = None, 0
    for r in states.groupBy("size").agg(F.sum("kinds").alias("kinds")).orderBy(F.col("size").desc()).collect():
        so_far += r["kinds"]
        if least is not None and so_far > COMMON_SYMBOLS:
            break
        least = r["size"]
    if least is None:
        # Nothing to learn from: the root alone, where all symbols are equally likely.
        none = np.empty(0, np.int64)
        return Table(np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int64), np.ones(1, bool), none, none)
    key = F.col("context").bitwiseOR(F.shiftleft(F.col("d").cast("long"), 40)).alias("key")
    common = states.where(F.col("size") >= least)
    above = states.where(F.col("size") < least).select(
        (F.col("d") - 1).alias("d"), F.expr("context & (shiftleft(1L, 8 * (d - 1)) - 1)").alias("context")
    )
    held = common.join(above.distinct().withColumn("open", F.lit(True)), ["d", "context"], "left").select(
        key, "total", "kinds", F.col("open").isNull().alias("closed")
    ).toArrow().sort_by("key")
    cell = F.shiftleft(key, 8).bitwiseOR(F.col("next")).alias("cell")
    cells = levels.join(common.select("d", "context"), ["d", "context"]).select(cell, "n").toArrow().sort_by("cell")
    return Table(*[held.column(c).to_numpy() for c in ("key", "total", "kinds", "closed")], *[cells.column(c).to_numpy() for c in ("cell", "n")])


def gram_scores(wanted: DataFrame, levels: DataFrame, states: DataFrame) -> DataFrame:
    """Rows (key, value): log10 probability of packed grams (key) by the whole tree."""
    each = wanted.select("key", F.explode(F.sequence(F.lit(0), F.lit(DEPTH))).alias("d")).select(
        "key", "d", F.expr("shiftright(key, 8) & (shiftleft(1L, 8 * d) - 1)").alias("context"), F.expr("key & 255").alias("next")
    )
    found = each.join(states.select("d", "context", "total", "kinds"), ["d", "context"]).join(levels, ["d", "context", "next"], "left")
    step = F.struct("d", "total", F.when(F.col("d") > 0, F.col("kinds")).otherwise(128).alias("weight"), F.coalesce("n", F.lit(0)).alias("n"))
    p = F.aggregate(
        F.sort_array(F.collect_list(step)), F.lit(1 / 256), lambda p, x: (x["n"] + x["weight"] * p) / (x["total"] + x["weight"])
    )
    return found.groupBy("key").agg(F.log10(p).alias("value"))


@keeps_columns("text", new=("n_tokens", "n_known", "train_tokens", "base_score", "score"), dropped=("text",))
def score_texts(docs: DataFrame, training: DataFrame) -> DataFrame:
    """``docs`` with n_tokens, n_known, train_tokens, base_score and score.

    Tokens are the lower-cased words (A-Z only) of a text and one end. ``score`` is the
    tree's log10 probability of the text, ``base_score`` that of single tokens:
    log10((c + 0.5) / (N + 0.5 * (V + 1))) summed up, with a token's count c, N tokens and V
    different ones in ``training``. A NULL text is empty and has the end only. With no
    training rows nothing is known and all symbols are equally likely. Repeated rows, with
    or without ids, get the same scores; no rows give no rows. Columns of the result's names
    are replaced, others stay; ``text`` is dropped.
    """
    own = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    keep = [c for c in docs.columns if c not in (*own, "text")]
    counted = materialize(corpus_counts(training), "corpus_counts")
    vocabulary = counted.where("kind = 0").select("key", "n")
    ends = training.count()
    held = vocabulary.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    tokens, kinds = (held["n"] or 0) + ends, held["v"] + (1 if ends else 0)
    levels = context_counts(counted.where("kind = 1").select("key", "n"))
    states = tree_states(levels)
    tree = common_table(levels, states)
    common = vocabulary.orderBy(F.col("n").desc(), "key").limit(COMMON_TOKENS).collect()
    table = np.array(sorted((r["key"], r["n"]) for r in common), np.int64).reshape(-1, 2)
    known_hashes, known_counts = table[:, 0], table[:, 1]
    below = tokens + 0.5 * (kinds + 1)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in words.runs(batch.column("text"), lower=True):
                n, owner = len(run), np.repeat(np.arange(len(run)), np.diff(run.bounds))
                h = run.hashes.view(np.int64)
                at = np.minimum(np.searchsorted(known_hashes, h), max(len(known_hashes) - 1, 0))
                is_common = known_hashes[at] == h if len(known_hashes) else np.zeros(len(h), bool)
                value = np.log10((known_counts[at[is_common]] + 0.5) / below)
                base = np.bincount(owner[is_common], value, n) + np.log10((ends + 0.5) / below)
                common_tokens = np.bincount(owner[is_common], minlength=n) + (1 if ends else 0)
                # The other tokens of each text, once each, with how often they stand in it.
                order = np.lexsort((h[~is_common], owner[~is_common]))
                o, x = owner[~is_common][order], h[~is_common][order]
                starts = np.flatnonzero((np.diff(o, prepend=-1) != 0) | (np.diff(x, prepend=0) != 0))
                times = np.diff(np.append(starts, len(o))).astype(np.int32)
                offsets = pa.array(np.searchsorted(o[starts], np.arange(n + 1)).astype(np.int32))
                # Scores of different symbols in their contexts; what longer states may change is left open.
                stream, ends_at = symbols(run)
                packed, inverse = np.unique(grams(stream), return_inverse=True)
                value, sure = tree.score(packed)
                writer = np.repeat(np.arange(n), np.diff(ends_at))
                score = np.bincount(writer, np.where(sure, value, 0.0)[inverse], n)
                open_at = np.flatnonzero(~sure[inverse])
                pair, seen = np.unique(writer[open_at] * len(packed) + inverse[open_at], return_counts=True)
                open_offsets = pa.array(np.searchsorted(pair // len(packed), np.arange(n + 1)).astype(np.int32))
                own_rows = batch.slice(run.first, n)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[own_rows.column(k) for k in range(1, batch.num_columns)],
                        pa.array((np.diff(run.bounds) + 1).astype(np.int64)),
                        pa.array(common_tokens.astype(np.int64)),
                        pa.array(base),
                        pa.array(score),
                        pa.ListArray.from_arrays(offsets, pa.array(x[starts])),
                        pa.ListArray.from_arrays(offsets, pa.array(times)),
                        pa.ListArray.from_arrays(open_offsets, pa.array(packed[pair % len(packed)].view(np.int64))),
                        pa.ListArray.from_arrays(open_offsets, pa.array(seen.astype(np.int32))),
                    ],
                    names=schema.names,
                )

    keyed = docs.select("text", F.xxhash64(*docs.columns).alias("_row"), *keep)
    added = StructType.fromDDL(
        "n_tokens long, _common long, _base double, _score double, _rare array<long>, _times array<int>, _open array<long>, _symbols array<int>"
    )
    schema = StructType(keyed.schema.fields[1:] + added.fields)
    partial = materialize(keyed.mapInArrow(rows, schema), "partial_scores")
    def spread(keys: str, times: str) -> DataFrame:
        return partial.select("_row", F.explode(F.arrays_zip(keys, times)).alias("_x")).select(
            "_row", F.col(f"_x.{keys}").alias("key"), F.col(f"_x.{times}").alias("_n")
        )

    # Rare tokens meet their counts in a join; each document's tokens are counted first.
    value = F.log10((F.coalesce("n", F.lit(0)) + 0.5) / F.lit(below))
    summed = (
        spread("_rare", "_times").join(vocabulary, "key", "left").groupBy("_row")
        .agg(
            F.sum(value * F.col("_n")).alias("_sum"),
            F.sum(F.when(F.col("n").isNotNull(), F.col("_n")).otherwise(0)).alias("_seen"),
            F.sum("_n").alias("_all"),
        )
    )
    # So do symbols in states that the table of common ones leaves open.
    left_open = spread("_open", "_symbols")
    rest = (
        left_open.join(gram_scores(left_open.select("key").distinct(), levels, states), "key").groupBy("_row")
        .agg(F.sum(F.col("value") * F.col("_n")).alias("_rest"), F.sum("_n").alias("_all_open"))
    )

    # Rows that are equal in all columns share a key; each takes its share of the sums.
    def share(times: str, of: str) -> Column:
        own = F.aggregate(times, F.lit(0).cast("long"), lambda t, x: t + x)
        return F.coalesce(own / F.col(of), F.lit(0.0))

    rare = share("_times", "_all")
    return partial.drop("_rare", "_open").join(summed, "_row", "left").join(rest, "_row", "left").select(
        *keep,
        "n_tokens",
        (F.col("_common") + F.round(F.coalesce("_seen", F.lit(0)) * rare)).cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("_base") + F.coalesce("_sum", F.lit(0.0)) * rare).alias("base_score"),
        (F.col("_score") + F.coalesce("_rest", F.lit(0.0)) * share("_symbols", "_all_open")).alias("score"),
    )
