"""Removal of long repeated passages, found by minimal hashes.

The anchor of a window of ``length`` words is, of the shorter windows in it, the first one of
least hash. Equal windows have equal anchors in the same place, and neighbouring windows mostly
share theirs. Anchors are compared first. The windows of an anchor that occurs twice are
neighbours and travel as one row, which the anchor brings together with the others; there the
windows are compared one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow.llm import words
from wardflow.llm.columns import keeps_columns
from wardflow.session import materialize

LENGTH = 20

#: Anchors known to occur this often are common ones: each of their windows travels alone.
CROWD = 1_000
#: Bound of the table of common anchors.
COMMON = 1 << 16


def anchored(run: words.Run, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of a run's anchors by place, and for every window of ``length`` words the place of
    its anchor there, its text and the anchor's first word in that text."""
    size = length // 2 + 1
    hashes, bounds = run.grams(size)
    n = np.maximum(np.diff(run.bounds) - length + 1, 0)
    text = np.repeat(np.arange(len(run)), n)
    begin = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n) + bounds[text]
    at = begin.copy()
    for k in range(1, length - size + 1):
        at = np.where(hashes[begin + k] < hashes[at], begin + k, at)
    return hashes >> np.uint64(1), at, text, at - bounds[text]


def changes(*columns: np.ndarray) -> np.ndarray:
    """Whether a row differs from the one before it."""
    out = np.zeros(len(columns[0]), bool)
    out[:1] = True
    for c in columns:
        out[1:] |= c[1:] != c[:-1]
    return out


def _batch(*columns: tuple[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for _, c in columns], names=[n for n, _ in columns])


def anchors(docs: DataFrame, length: int) -> DataFrame:
    """Rows (anchor, row_key, at): anchors of every text, ``at`` counting words from 0.

    An anchor that a batch has several times is known to repeat: one row without a place
    tells others so, and its places are sent under hashes of their own, marked ``known``.
    That way a very common passage sends one row from each batch to its common hash.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.asarray(batch.column("row_key"))
            found, owners, places = [], [], []
            for run in words.runs(batch.column("text"), lower=False):
                hashes, at, text, place = anchored(run, length)
                new = changes(at)
                found.append(hashes[at[new]])
                owners.append(keys[run.first + text[new]])
                places.append(place[new].astype(np.int32))
            if not found or not sum(map(len, found)):
                continue
            h, owner, place = np.concatenate(found).view(np.int64), np.concatenate(owners), np.concatenate(places)
            _, inverse, counts = np.unique(h, return_inverse=True, return_counts=True)
            known = counts[inverse] > 1
            once = np.unique(h[known])
            own = (words.mixed(owner.view(np.uint64) + place.astype(np.uint64)) | np.uint64(1 << 63)).view(np.int64)
            h = np.concatenate([np.where(known, own, h), once])
            owner = pa.array(np.concatenate([owner, np.zeros(len(once), np.int64)]))
            place = np.concatenate([place, np.full(len(once), -1, np.int32)])
            for i in range(0, len(h), 200_000):
                yield _batch(("anchor", h[i : i + 200_000]), ("row_key", owner[i : i + 200_000]), ("at", place[i : i + 200_000]))

    return docs.select("row_key", "text").mapInArrow(rows, "anchor long, row_key long, at int")


def repeated_places(found: DataFrame) -> DataFrame:
    """Rows (row_key, places): where each document has anchors that occur elsewhere too."""
    same = Window.partitionBy("anchor").orderBy("row_key", "at")
    before, after = F.lag(F.lit(1)).over(same), F.lead(F.lit(1)).over(same)
    return (
        found.withColumn("_twice", before.isNotNull() | after.isNotNull())
        # Negative hashes belong to places that are known to repeat.
        .where("(_twice OR anchor < 0) AND at >= 0")
        .groupBy("row_key").agg(F.collect_set("at").alias("places"))
    )


def common_anchors(docs: DataFrame, length: int) -> np.ndarray:
    """Anchors that batches have many times, sorted; which ones are named only matters for speed."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.empty(0, np.uint64)]
            for run in words.runs(batch.column("text"), lower=False):
                hashes, at, _, _ = anchored(run, length)
                found.append(hashes[at[changes(at)]])
            h, n = np.unique(np.concatenate(found), return_counts=True)
            often = n >= 8
            yield _batch(("anchor", h[often].view(np.int64)), ("n", n[often].astype(np.int64)))

    counted = docs.select("text").mapInArrow(rows, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))
    top = counted.where(F.col("n") >= CROWD).orderBy(F.col("n").desc(), "anchor").limit(COMMON).collect()
    return np.array(sorted(r["anchor"] for r in top), np.int64)


def long_windows(docs: DataFrame, length: int, common: np.ndarray) -> DataFrame:
    """Rows (key, doc_id, order, windows): consecutive windows of a text that have a repeated anchor.

    ``key`` and a member of ``windows`` are 127 bits of hashes that tell windows apart: the key is
    the anchor's hash, or the window's own where the anchor is a common one. Of equal windows of a
    batch the earliest goes to the common key; the others are later ones for sure and are sent
    under keys of their own (negative, as above). ``order`` holds 31 bits of the text's hash, which
    tell rows of one id apart, and the place of the first window.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            order_ids = np.array([-(1 << 63) if x is None else x for x in ids.to_pylist()], np.int64)
            order_key = np.asarray(batch.column("order_key"))
            lists = batch.column("places")
            parts = []
            for run in words.runs(batch.column("text"), lower=False):
                hashes, at, text, place = anchored(run, length)
                own = lists.slice(run.first, len(run))
                owners = np.repeat(np.arange(len(run)), np.diff(np.asarray(own.offsets)))
                repeated = (owners << 32) | np.asarray(own.flatten())
                near = np.flatnonzero(np.isin((text << 32) | place, repeated))
                if not len(near):
                    continue
                grams, bounds = run.grams(length)
                others, _ = run.grams(length, words.OTHER_FACTOR)
                owner, anchor = run.first + text[near], hashes[at[near]].view(np.int64)
                alone = np.isin(anchor, common)
                key = np.where(alone, (grams[near] >> np.uint64(1)).view(np.int64), anchor)
                order = order_key[owner] + near - bounds[text[near]]
                parts.append((key, others[near].view(np.int64), owner, order, at[near], alone))
            if not parts:
                continue
            key, window, owner, order, at, alone = (np.concatenate(x) for x in zip(*parts, strict=True))
            sort = np.lexsort((order, order_ids[owner], window, key))
            first = np.maximum.accumulate(np.where(changes(key[sort], window[sort]), np.arange(len(sort)), 0))
            earliest = np.empty(len(sort), np.int64)
            earliest[sort] = sort[first]
            # The same row twice in a batch is the same document, not a later one.
            same = (order_ids[owner] == order_ids[owner[earliest]]) & (order == order[earliest])
            later = ~same
            stays = later | (earliest == np.arange(len(sort)))
            key, window, owner, order, at, alone, later = (x[stays] for x in (key, window, owner, order, at, alone, later))
            # A row ends where the text, the anchor or the kind of window changes, or a place is left out.
            begins = np.flatnonzero(changes(owner, at, later, order - np.arange(len(order))) | alone)
            own = words.mixed(words.mixed(order_ids[owner[begins]].view(np.uint64)) + order[begins].view(np.uint64))
            key = np.where(later[begins], (own | np.uint64(1 << 63)).view(np.int64), key[begins])
            window = np.where(later, 0, window)
            ends = np.append(begins[1:], len(order))
            for i in range(0, len(begins), 20_000):
                part = slice(i, i + 20_000)
                offsets = np.append(begins[part], ends[part][-1])
                yield _batch(
                    ("key", key[part]),
                    ("doc_id", ids.take(pa.array(owner[begins[part]]))),
                    ("order", order[begins[part]]),
                    ("windows", pa.ListArray.from_arrays(pa.array((offsets - offsets[0]).astype(np.int32)), pa.array(window[offsets[0] : offsets[-1]]))),
                )

    return docs.mapInArrow(rows, "key long, doc_id long, order long, windows array<long>")


def order_key(text: str) -> Column:
    """31 bits of a text's hash, in the upper half of a long."""
    return F.shiftleft(F.shiftrightunsigned(F.xxhash64(text), 33), 32)


def removed_starts(windows: DataFrame) -> DataFrame:
    """Rows (doc_id, order_key, starts): windows of a document that start earlier somewhere."""
    # Rows of several windows are dealt out before they are taken apart.
    each = windows.repartition("key").select("key", "doc_id", "order", F.posexplode("windows").alias("_nth", "window"))
    each = each.select("key", "window", "doc_id", (F.col("order") + F.col("_nth")).alias("order"))
    earliest = Window.partitionBy("key", "window").orderBy(F.col("doc_id").asc_nulls_first(), "order")
    first = F.first(F.struct("doc_id", "order")).over(earliest)
    return (
        each.withColumn("_first", first)
        .where("key < 0 OR NOT (_first.doc_id <=> doc_id) OR _first.order <> order")
        .groupBy("doc_id", F.col("order").bitwiseAND(F.lit(-(1 << 32))).alias("order_key"))
        .agg(F.collect_set(F.col("order").bitwiseAND(F.lit((1 << 32) - 1)).cast("int")).alias("starts"))
    )


def repeated_windows(docs: DataFrame, *, length: int = LENGTH) -> DataFrame:
    """Rows (doc_id, order_key, starts) for ``docs`` (row_key, doc_id, text, others)."""
    places = materialize(repeated_places(anchors(docs, length)), "repeated_places")
    near = docs.join(places.hint("merge"), "row_key").withColumn("order_key", order_key("text"))
    common = common_anchors(docs, length)
    return removed_starts(long_windows(near.select("doc_id", "order_key", "text", "places"), length, common))


@keeps_columns("doc_id", "text", new=("n_words", "n_removed", "kept", "removed_spans"))
def remove_repeats(docs: DataFrame, *, length: int = LENGTH) -> DataFrame:
    """``docs`` (doc_id, text, others) with n_words, n_removed, kept and removed_spans.

    A word goes if a window of ``length`` words covers it whose words also start earlier:
    in a document of smaller id or earlier in the same one, judged on the input. ``kept``
    is the remaining words joined by one space, ``removed_spans`` the word ranges
    [begin, end) that went. A NULL id comes first, rows with the same id follow a hash of
    their texts, and rows equal in id and text are one document and get the same answer.
    NULL and empty texts have no words. No rows give no rows; columns of the result's names
    are replaced, all others stay.
    """
    own = ("n_words", "n_removed", "kept", "removed_spans")
    keep = [c for c in docs.columns if c not in own]
    # The same projection is joined twice by the same key, so its texts are shuffled once.
    keyed = docs.select(*keep, F.xxhash64("doc_id", "text").alias("row_key"))
    starts = repeated_windows(keyed, length=length).select(
        F.col("doc_id").alias("_id"), F.col("order_key").alias("_order"), "starts"
    )
    rows = keyed.select(
        "row_key", F.struct("doc_id", order_key("text").alias("order_key")).alias("_row")
    )
    by_row = starts.select(F.struct(F.col("_id").alias("doc_id"), F.col("_order").alias("order_key")).alias("_row"), "starts")
    joined = keyed.join(by_row.join(rows, "_row").select("row_key", "starts").dropDuplicates(["row_key"]).hint("merge"), "row_key", "left")

    @F.pandas_udf("n_words long, n_removed long, kept string, removed_spans array<struct<begin:int,end:int>>")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, lists in batches:
            out = []
            column = pa.array(texts, pa.string())
            for run in words.runs(column, lower=False):
                raw = run.data.tobytes()
                for i in range(len(run)):
                    begin, end = run.bounds[i], run.bounds[i + 1]
                    gone = np.zeros(end - begin + 1, np.int32)
                    own_starts = lists.iloc[run.first + i]
                    if own_starts is not None and len(own_starts):
                        s = np.asarray(own_starts)
                        np.add.at(gone, s, 1)
                        np.add.at(gone, s + length, -1)
                    gone = np.cumsum(gone)[:-1] > 0
                    edges = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]])))
                    spans = [{"begin": int(a), "end": int(b)} for a, b in edges.reshape(-1, 2)]
                    stays = np.flatnonzero(~gone) + begin
                    kept = b" ".join([raw[a:b] for a, b in zip(run.starts[stays], run.ends[stays], strict=True)])
                    out.append((end - begin, int(gone.sum()), kept.decode("utf-8"), spans))
            yield pd.DataFrame(out, columns=["n_words", "n_removed", "kept", "removed_spans"])

    return joined.withColumn("_cut", cut("text", "starts")).select(*keep, "_cut.*")

