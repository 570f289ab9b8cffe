"""Removal of byte strings that a document with a smaller id has too, by suffix arrays.

No task could hold the suffix array of all texts, so texts are cut where equal strings are
cut alike: a window of ``length`` bytes is labelled by the least hash of the ``GRAM``-byte
strings in it, and consecutive windows of one label form a piece. Equal windows have equal
labels, so the suffix array of each label's pieces finds all of them.

Labels go out first, with the id and a hash of the piece. A label that one document has needs
nothing more. Where all pieces of a label are equal (they agree in 128 bits of hashes), those of
larger ids are covered as a whole; there would be nothing to sort. Only the pieces of the other
labels, at the ends of what documents share, are cut out and sent to their label's suffix array.
What very many documents share does not pile up there: of equal pieces in a batch of
documents only the one with the least id is sent, as it covers the others.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow.llm import words
from wardflow.llm.columns import keeps_columns, quoted
from wardflow.llm.suffix_arrays import suffix_arrays
from wardflow.session import materialize

LENGTH = 50
#: Bytes of the strings whose hashes label a window.
GRAM = 20
#: Windows of a piece at most; longer runs of a label (repetitive text) are cut.
PIECE = 64
#: Pieces of a label at most that go to one suffix array whole.
LABEL_PIECES = 64
#: Bytes of pieces that a task sorts at a time, and of texts that it labels at a time.
SORT_BYTES, RUN_BYTES = 1 << 19, 1 << 20
#: Pieces of a batch that are held to be compared with each other.
HELD = 50_000

SPANS = "array<struct<begin:int,end:int>>"


@keeps_columns("doc_id", "text", new=("n_bytes", "n_removed", "removed_spans", "kept"))
def remove_earlier_strings(docs: DataFrame, *, length: int = LENGTH, label_pieces: int = LABEL_PIECES) -> DataFrame:
    """Add n_bytes, n_removed, removed_spans and kept (binary) to ``docs`` (doc_id, text).

    Removed is each UTF-8 byte covered by a string of ``length`` bytes that also starts in a
    document with a smaller ``doc_id``, judged on the whole input. ``removed_spans`` are the
    maximal removed runs (begin, end). NULL text counts as empty. A row without ``doc_id``
    loses nothing and takes nothing from others, and rows repeating an id take nothing from
    each other. ``doc_id`` is a whole number. Other columns of ``docs`` stay; a column with the
    name of a new one is replaced.
    """
    rows = docs.select("*", F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("version"))
    known = docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("version"), "text").where(
        F.col("id").isNotNull() & (F.octet_length("text") >= length)
    )
    gone = removed_spans(known, length, label_pieces)
    text = F.coalesce("text", F.lit(""))
    # Only texts that lose something leave the JVM.
    cut = rows.join(gone, ["id", "version"], "left").select(
        *map(quoted, docs.columns), _cutter()(F.when(F.col("spans").isNotNull(), text), "spans.begin", "spans.end").alias("_cut")
    )
    return cut.select(
        *map(quoted, docs.columns),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.coalesce("_cut.n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("_cut.removed_spans", F.array().cast("array<struct<begin:int,end:int>>")).alias("removed_spans"),
        F.coalesce("_cut.kept", text.cast("binary")).alias("kept"),
    )


def removed_spans(docs: DataFrame, length: int, label_pieces: int) -> DataFrame:
    """Rows (id, version, spans): for documents that lose bytes, spans that cover them (they may overlap)."""
    seen = docs.mapInArrow(_labels(length), "label long, id long, name long, kind int")
    # What is known of a row already does not need its label's other rows: such rows are spread by their ids.
    plain = F.col("kind") == PLAIN
    same = Window.partitionBy("label", F.when(~plain, F.col("id")))
    ranges = {end: f(column).over(same) for end, f, column in (("least", F.min, "id"), ("most", F.max, "id"), ("name1", F.min, "name"), ("name2", F.max, "name"))}
    differ, later = F.col("name1") != F.col("name2"), F.col("least") < F.col("id")
    shared = seen.select("label", "id", "kind", *[column.alias(end) for end, column in ranges.items()]).where(
        ~plain | ((F.col("least") < F.col("most")) & (differ | later))
    )
    kind = F.when(plain, F.when(differ, OPEN).otherwise(COVERED)).otherwise(F.col("kind"))
    shared = shared.select("id", "label", kind.alias("kind"))
    labels = shared.groupBy("id").agg(
        *[F.collect_set(F.when(F.col("kind") == k, F.col("label"))).alias(name) for name, k in (("covered", COVERED), ("open", OPEN))]
    )
    labels = materialize(labels, "shared_labels")
    cut = docs.join(labels, "id").select("id", "version", "text", "covered", "open").mapInArrow(_pieces(length), f"{PIECES}, spans {SPANS}")
    cut = materialize(cut, "pieces")
    spans = [cut.where("piece IS NULL").select("id", "version", "spans")]
    pieces = cut.where("piece IS NOT NULL").drop("spans")
    counts = pieces.groupBy("label").agg(F.count("*").alias("pieces"))
    crowded = materialize(counts.where(F.col("pieces") > label_pieces).select("label"), "crowded_labels")
    if not crowded.isEmpty():
        # A task must not sort all that meets at the end of a very common passage. There
        # the windows themselves are dealt out, known by 128 bits of hashes.
        windows = pieces.join(crowded, "label", "left_semi").mapInArrow(
            _windows(length), "w1 long, w2 long, id long, version long, start int, covered boolean"
        )
        pieces = pieces.join(crowded, "label", "left_anti")
        alike = Window.partitionBy("w1", "w2", F.when(F.col("covered"), F.col("id")))
        later = windows.withColumn("least", F.min("id").over(alike)).where("covered OR least < id")
        span = F.struct(F.col("start").alias("begin"), (F.col("start") + length).alias("end"))
        spans.append(later.groupBy("id", "version").agg(F.collect_list(span).alias("spans")))
    dealt = pieces.repartition("label").sortWithinPartitions("label")
    spans.append(dealt.mapInArrow(_covered(length), f"id long, version long, spans {SPANS}"))
    every = spans[0]
    for more in spans[1:]:
        every = every.unionByName(more)
    return materialize(every, "spans").groupBy("id", "version").agg(F.flatten(F.collect_list("spans")).alias("spans"))


#: Of the label of a document: undecided, its piece is equal to one of a smaller id, or must be compared.
PLAIN, COVERED, OPEN = range(3)

#: A piece of a document and the places where it begins there.
PIECES = "label long, id long, version long, starts array<int>, piece binary"


def _runs(texts: pa.Array, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(text, start, windows, label, hash) of the pieces of all texts, some texts or one block at a time."""
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + RUN_BYTES, side="right")) - 1)
        begin, end = offsets[i], offsets[j]
        # A text longer than a run comes in blocks that share all but one byte of a window.
        for at in range(begin, max(begin + 1, end - length + 1), RUN_BYTES):
            stop = end if j > i + 1 else min(end, at + RUN_BYTES + length - 1)
            bounds = np.array([0, stop - at]) if j == i + 1 else offsets[i : j + 1] - begin
            owner, start, n, label, name = _label(data[at:stop], bounds, length)
            yield owner + i, start + (at - begin if j == i + 1 else 0), n, label, name
            if j > i + 1:
                break
        i = j


# Odd numbers, which have inverses modulo 2**64.
_BASE, _OTHER_BASE = 0x9E3779B97F4A7C15, 0xD1B54A32D192ED03


@lru_cache(maxsize=4)
def _powers(n: int, of: int = _BASE) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base, and of its inverse, modulo 2**64."""
    both = []
    for base in (of, pow(of, -1, 1 << 64)):
        factors = np.full(n, base, np.uint64)
        factors[0] = 1
        both.append(np.multiply.accumulate(factors))
    return both[0], both[1]


def _label(data: np.ndarray, bounds: np.ndarray, length: int):
    """(text, start, windows, label, hash) of the pieces of texts laid end to end."""
    n = len(data) - length + 1
    if n <= 0:
        return (np.empty(0, np.int64),) * 5
    up, down = _powers(max(len(data), RUN_BYTES + LENGTH))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    gram = min(GRAM, length)
    least = words.mixed((total[gram:] - total[:-gram]) * down[: len(data) - gram + 1])
    # Least hash of each window, by doubling.
    wide, need = 1, length - gram + 1
    while 2 * wide <= need:
        least = np.minimum(least[:-wide], least[wide:])
        wide *= 2
    if wide < need:
        least = np.minimum(least[: wide - need], least[need - wide :])
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[:n]
    whole = np.flatnonzero(np.arange(n) + length <= bounds[1:][owner])
    owner, least = owner[whole], least[whole].view(np.int64)
    new = np.append(True, (owner[1:] != owner[:-1]) | (least[1:] != least[:-1]))[: len(whole)]
    first = np.flatnonzero(new)
    since = np.arange(len(whole)) - np.repeat(first, np.diff(np.append(first, len(whole))))
    first = np.flatnonzero(since % PIECE == 0)
    sizes = np.diff(np.append(first, len(whole)))
    begin = whole[first]
    name = words.mixed((total[begin + sizes + length - 1] - total[begin]) * down[begin] + sizes.astype(np.uint64))
    return owner[first], begin - bounds[owner[first]], sizes, least[first], name.view(np.int64)


def _send(names: list[str], columns: list, size: int = 100_000) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(columns[0]), size):
        yield pa.RecordBatch.from_arrays([pa.array(c[i : i + size]) for c in columns], names=names)


def _labels(length: int):
    """Rows (label, id, name, kind): labels of each text and hashes of its pieces.

    Within a run, equal pieces of larger ids are known to be covered. Where a label has
    different pieces of several ids, they must be compared; then the least and the largest
    of its ids and names go out once more as plain rows, for others to see.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.asarray(batch.column("id"))
            for owner, _, _, label, name in _runs(batch.column("text"), length):
                if not len(label):
                    continue
                of = ids[owner]
                order = _sorted(label, name, of)
                label, of, name = label[order], of[order], name[order]
                new_label = np.append(True, label[1:] != label[:-1])
                new_name = new_label | np.append(True, name[1:] != name[:-1])
                once = new_name | np.append(True, of[1:] != of[:-1])
                head, names = np.flatnonzero(new_label), np.flatnonzero(new_name)
                least, most = np.minimum.reduceat(of, head), np.maximum.reduceat(of, head)
                several = (np.add.reduceat(new_name.astype(np.int64), head) > 1) & (least < most)
                sizes = np.diff(np.append(head, len(label)))
                kind = np.where(np.repeat(several, sizes), OPEN, PLAIN)
                kind[of > np.repeat(of[names], np.diff(np.append(names, len(label))))] = COVERED
                tail = head + sizes - 1
                columns = [
                    np.concatenate([label[once], label[head][several], label[head][several]]),
                    np.concatenate([of[once], least[several], most[several]]),
                    np.concatenate([name[once], name[head][several], name[tail][several]]),
                    np.concatenate([kind[once], np.full(2 * int(several.sum()), PLAIN)]).astype(np.int32),
                ]
                yield from _send(["label", "id", "name", "kind"], columns)

    return rows


def _sorted(label: np.ndarray, name: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Order by label, name and id; few labels occur twice, so ties are sorted apart."""
    order = np.argsort(label, kind="stable")
    same = label[order[1:]] == label[order[:-1]]
    tied = np.flatnonzero(np.append(same, False) | np.append(False, same))
    some = order[tied]
    order[tied] = some[np.lexsort((of[some], name[some], label[some]))]
    return order


class _Pieces:
    """Pieces of a batch: rows to send, and what equal pieces of smaller ids cover already."""

    def __init__(self):
        self.label: list[int] = []
        self.id: list[int] = []
        self.version: list[int] = []
        self.starts: list[list[int]] = []
        self.piece: list[bytes] = []
        self.gone: dict[tuple, list] = {}

    def cover(self, owner: np.ndarray, begin: np.ndarray, end: np.ndarray, ids: list, versions: list) -> None:
        """Spans (begin, end) of texts, in order; those that meet become one."""
        if not len(owner):
            return
        apart = np.append(True, (owner[1:] != owner[:-1]) | (begin[1:] > end[:-1]))
        head = np.flatnonzero(apart)
        last = np.append(head[1:], len(owner)) - 1
        for o, b, e in zip(owner[head].tolist(), begin[head].tolist(), end[last].tolist(), strict=True):
            self.gone.setdefault((ids[o], versions[o]), []).append([b, e])

    def add(self, label: int, id_: int, version: int, starts: list[int], piece: bytes) -> None:
        self.label.append(label)
        self.id.append(id_)
        self.version.append(version)
        self.starts.append(starts)
        self.piece.append(piece)

    def batches(self) -> Iterator[pa.RecordBatch]:
        least: dict[bytes, int] = {}
        for piece, i in zip(self.piece, self.id, strict=True):
            if i < least.get(piece, i + 1):
                least[piece] = i
        first_of: dict[tuple, int] = {}
        gone, places = self.gone, {}
        for row, (i, version, starts, piece) in enumerate(zip(self.id, self.version, self.starts, self.piece, strict=True)):
            if i > least[piece]:
                spans = gone.setdefault((i, version), [])
                for start in starts:
                    if spans and spans[-1][0] <= start <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], start + len(piece))
                    else:
                        spans.append([start, start + len(piece)])
            else:
                first = first_of.setdefault((i, version, piece), row)
                places.setdefault(first, []).extend(starts)
        rows = list(places)
        sent = [[column[r] for r in rows] for column in (self.label, self.id, self.version)]
        yield from self._send([*sent, list(places.values()), [self.piece[r] for r in rows], [None] * len(rows)])
        keys, none = list(gone), [None] * len(gone)
        spans = [[{"begin": b, "end": e} for b, e in gone[k]] for k in keys]
        yield from self._send([none, [k[0] for k in keys], [k[1] for k in keys], none, none, spans])

    @staticmethod
    def _send(columns: list[list]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.binary(), span]
        names = ["label", "id", "version", "starts", "piece", "spans"]
        for at in range(0, len(columns[1]), 20_000):
            arrays = [pa.array(c[at : at + 20_000], kind) for c, kind in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)


def _pieces(length: int):
    """Of each text the pieces whose label is ``open``, and spans of those whose label is ``covered``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, versions = batch.column("id").to_pylist(), batch.column("version").to_pylist()
            texts, wanted = batch.column("text"), {}
            for kind in ("covered", "open"):
                lists = batch.column(kind)
                sizes = np.diff(np.asarray(lists.offsets))
                wanted[kind] = np.sort(_pair(np.repeat(np.arange(len(sizes)), sizes), np.asarray(lists.flatten())))
            found, data, at = _Pieces(), b"", -1
            for owner, start, n, label, _ in _runs(texts, length):
                pairs = _pair(owner, label)
                # A text may have different pieces of a label; then they are compared.
                compared = _among(pairs, wanted["open"])
                whole = _among(pairs, wanted["covered"]) & ~compared
                found.cover(owner[whole], start[whole], (start + n + length - 1)[whole], ids, versions)
                some = np.flatnonzero(compared)
                for o, s, k, mark in zip(owner[some].tolist(), start[some].tolist(), n[some].tolist(), label[some].tolist(), strict=True):
                    if o != at:
                        data, at = texts[o].as_py().encode(), o
                    found.add(mark, ids[o], versions[o], [s], data[s : s + k + length - 1])
                if len(found.piece) > HELD:
                    yield from found.batches()
                    found = _Pieces()
            yield from found.batches()

    return rows


def _pair(owner: np.ndarray, label: np.ndarray) -> np.ndarray:
    """64 bits for a text of the batch and one of its labels; label and piece add 128 more."""
    return words.mixed(words.mixed(label.view(np.uint64)) + owner.astype(np.uint64))


def _among(values: np.ndarray, ascending: np.ndarray) -> np.ndarray:
    if not len(ascending):
        return np.zeros(len(values), bool)
    return ascending[np.minimum(np.searchsorted(ascending, values), len(ascending) - 1)] == values


def _windows(length: int):
    """The windows of pieces by their hashes; ``covered`` where a smaller id of the batch has the same."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 2_000) for b in batches for i in range(0, b.num_rows, 2_000)):
            pieces, lists = batch.column("piece").to_pylist(), batch.column("starts")
            offsets = np.append(0, np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces))))
            data = np.frombuffer(b"".join(pieces), np.uint8)
            n, places = np.diff(offsets) - length + 1, np.diff(np.asarray(lists.offsets))
            # Every window of every place at which a piece begins.
            row = np.repeat(np.arange(len(n)), places)
            at = _counting(n[row])
            begin = np.repeat(np.asarray(lists.flatten()).astype(np.int64), n[row]) + at
            row = np.repeat(row, n[row])
            first = offsets[row] + at
            hashes = []
            for base in (_BASE, _OTHER_BASE):
                up, down = _powers(max(len(data) + 1, RUN_BYTES + LENGTH), base)
                total = np.zeros(len(data) + 1, np.uint64)
                np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
                hashes.append(words.mixed((total[first + length] - total[first]) * down[first]).view(np.int64))
            ids, versions = np.asarray(batch.column("id"))[row], np.asarray(batch.column("version"))[row]
            order = np.lexsort((ids, hashes[1], hashes[0]))
            w1, w2, ids, versions, begin = (x[order] for x in (*hashes, ids, versions, begin))
            new = np.append(True, (w1[1:] != w1[:-1]) | (w2[1:] != w2[:-1]))[: len(w1)]
            covered = ids > ids[np.maximum.accumulate(np.where(new, np.arange(len(w1)), 0))]
            yield from _send(["w1", "w2", "id", "version", "start", "covered"], [w1, w2, ids, versions, begin.astype(np.int32), covered])

    return rows


def _counting(counts: np.ndarray) -> np.ndarray:
    """0, 1, .. up to each count, one after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def _covered(length: int):
    """Spans of pieces that have windows of smaller ids.

    Rows come sorted by label. The different pieces of a label form one text, each followed by
    a symbol of its own kind; windows that begin alike are neighbours in its suffix array.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            for i in range(0, batch.num_rows, 2_000):
                some = batch.slice(i, 2_000)
                waiting.append(some)
                size += some.column("piece").nbytes
                if size < SORT_BYTES:
                    continue
                rows_here = pa.Table.from_batches(waiting).combine_chunks()
                labels = np.asarray(rows_here.column("label"))
                whole = int(np.searchsorted(labels == labels[-1], True))  # the last label may go on
                if whole:
                    yield from spans_of(rows_here.slice(0, whole))
                waiting = rows_here.slice(whole).combine_chunks().to_batches()
                size = sum(b.column("piece").nbytes for b in waiting)
        if waiting:
            yield from spans_of(pa.Table.from_batches(waiting))

    def spans_of(table: pa.Table) -> Iterator[pa.RecordBatch]:
        label, ids, versions, starts, pieces = (table.column(c).to_pylist() for c in ("label", "id", "version", "starts", "piece"))
        different: dict[tuple, int] = {}
        of = [different.setdefault(key, len(different)) for key in zip(label, pieces, strict=True)]
        least = np.full(len(different), np.iinfo(np.int64).max)
        np.minimum.at(least, of, ids)
        lists = least_ids(np.array([k[0] for k in different], np.int64), [k[1] for k in different], least, length)
        out: list[tuple] = []
        for row, piece in enumerate(of):
            spans = [
                {"begin": start + begin, "end": start + end}
                for begin, end, low in zip(*lists[piece], strict=True) if low < ids[row] for start in starts[row]
            ]
            if spans:
                out.append((ids[row], versions[row], spans))
        span = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
        for at in range(0, len(out), 20_000):
            columns = zip(*out[at : at + 20_000], strict=True)
            arrays = [pa.array(c, kind) for c, kind in zip(columns, (pa.int64(), pa.int64(), span), strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "version", "spans"])

    return rows


def least_ids(labels: np.ndarray, pieces: list[bytes], ids: np.ndarray, length: int) -> list[tuple[list, list, list]]:
    """For each piece its parts (begin, end, least id): runs of windows whose least id is the same.

    Rows of one label lie together; ``ids`` holds the least id that has the piece.
    """
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    data = np.frombuffer(b"".join(pieces), np.uint8)
    # Symbols: 0 after each piece, else the byte plus 1 (UTF-8 has no byte 255).
    piece_of = np.repeat(np.arange(len(sizes)), sizes + 1)
    begins = np.cumsum(sizes + 1) - sizes - 1
    at = np.arange(len(piece_of)) - begins[piece_of]
    symbols = np.zeros(len(piece_of), np.uint8)
    symbols[at < sizes[piece_of]] = data + 1
    new = np.flatnonzero(np.append(True, labels[1:] != labels[:-1]))
    order = suffix_arrays(symbols.astype(np.int64), np.append(begins[new], len(symbols)))
    # Only places at which a window begins; equal windows lie side by side.
    order = order[at[order] + length <= sizes[piece_of[order]]]
    same = labels[piece_of[order[1:]]] == labels[piece_of[order[:-1]]]
    wide = 8 if length >= 8 else 1
    padded = np.append(symbols, np.zeros(length + 8, np.uint8))
    views = np.ndarray((len(symbols) + length,), f"<u{wide}", padded.tobytes(), 0, (1,))
    for k in {*range(0, length - wide, wide), length - wide}:
        same &= views[order[1:] + k] == views[order[:-1] + k]
    head = np.flatnonzero(np.append(True, ~same))
    least = np.minimum.reduceat(ids[piece_of[order]], head)
    of_window = np.empty(len(symbols), np.int64)
    of_window[order] = np.repeat(least, np.diff(np.append(head, len(order))))
    # Consecutive windows of a piece with the same least id form a part.
    windows = np.sort(order)
    offset, low, piece = at[windows], of_window[windows], piece_of[windows]
    cut = np.flatnonzero(np.append(True, (piece[1:] != piece[:-1]) | (low[1:] != low[:-1])))
    last = np.append(cut[1:], len(windows)) - 1
    begin, end, low = offset[cut].tolist(), (offset[last] + length).tolist(), low[cut].tolist()
    bounds = np.searchsorted(piece[cut], np.arange(len(sizes) + 1)).tolist()
    return [(begin[a:b], end[a:b], low[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def _cutter() -> Callable[..., Column]:
    @F.pandas_udf("n_removed long, removed_spans array<struct<begin:int,end:int>>, kept binary")
    def cut(texts: pd.Series, begins: pd.Series, ends: pd.Series) -> pd.DataFrame:
        """Union of the spans of each text, and the bytes outside of it; NULL where there are no spans."""
        out = []
        for text, begin, end in zip(texts, begins, ends, strict=True):
            if text is None:
                out.append((None, None, None))
                continue
            data = text.encode()
            order = np.argsort(begin, kind="stable")
            begin, reach = np.asarray(begin)[order], np.maximum.accumulate(np.asarray(end)[order])
            head = np.flatnonzero(np.append(True, begin[1:] > reach[:-1]))
            begin, end = begin[head], reach[np.append(head[1:], len(reach)) - 1]
            kept = b"".join(data[a:b] for a, b in zip(np.append(0, end), np.append(begin, len(data)), strict=True))
            spans = [{"begin": int(a), "end": int(b)} for a, b in zip(begin, end, strict=True)]
            out.append((int((end - begin).sum()), spans, kept))
        return pd.DataFrame(out, columns=["n_removed", "removed_spans", "kept"])

    return cut
