"""Packing of token sequences by the sum-of-squares rule.

Documents come online, one after the other.  A document longer than a window is
cut into full windows and a rest.  The rest goes whole into the fill level
(including the empty one) for which the sum of the squared counts of partially
filled windows is least afterwards; the counts are a level array of the window's
length.

Each task packs the documents it reads, so tokens are never shuffled.  Windows
still open at its end are merged by cutting freely, which leaves at most one
open window a task; those of up to GROUP tasks are merged once more.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, prepare
from .tokens import encoder

#: Tasks whose last windows are merged by one task of the second step.
GROUP = 1024
#: Token bytes of finished pieces that a task holds before it passes them on.
FLUSH = 8 << 20


class Packer:
    """Level array, and the open windows of each level."""

    def __init__(self, size: int):
        self.size = size
        self.count = np.zeros(size + 1, np.int64)
        self.open: dict[int, list[list]] = {}
        self.closed: list[list] = []

    def level_for(self, n: int) -> int:
        """The level that a piece of ``n`` is added to: least sum of squares after.

        Moving a window from level h to h + n changes the sum by
        2 * (count[h+n] - count[h]) + 2, and by less if h is empty (a new window
        is opened) or h + n is full (it counts no more)."""
        h = np.flatnonzero(self.count[1:self.size - n + 1]) + 1
        new = 2 * self.count[n] + 1 if n < self.size else 0
        if not len(h):
            return 0
        change = 2 * (self.count[h + n] - self.count[h]) + 2
        change[h + n == self.size] = 1 - 2 * self.count[h[h + n == self.size]]
        k = int(len(h) - 1 - np.argmin(change[::-1]))  # ties: the fullest window
        return int(h[k]) if change[k] <= new else 0

    def add(self, pieces: list, n: int) -> None:
        """Place pieces of ``n`` tokens together (0 < n <= size)."""
        h = self.level_for(n)
        if h:
            window = self.open[h].pop()
            self.count[h] -= 1
        else:
            window = []
        window.extend(pieces)
        if h + n == self.size:
            self.closed.append(window)
        else:
            self.open.setdefault(h + n, []).append(window)
            self.count[h + n] += 1

    def finish(self) -> list:
        """Merge the open windows by cutting; returns the pieces of the last one."""
        rest, filled = [], 0
        for h in sorted(self.open, reverse=True):
            for window in self.open[h]:
                for piece in window:
                    while piece:
                        head, piece = cut(piece, self.size - filled)
                        rest.append(head)
                        filled += head[2]
                        if filled == self.size:
                            self.closed.append(rest)
                            rest, filled = [], 0
        self.open, self.count[:] = {}, 0
        return rest


def cut(piece: tuple, room: int) -> tuple[tuple, tuple | None]:
    """A piece is (document's columns, start, length, token bytes)."""
    doc, start, n, ids = piece
    if n <= room:
        return piece, None
    return ((doc, start, room, ids[:4 * room]), (doc, start + room, n - room, ids[4 * room:]))


def _rows(windows: list[list], first_id: int, with_ids: bool) -> pa.RecordBatch:
    doc, total, start, length, crc, seq, offset, data = [], [], [], [], [], [], [], []
    for k, window in enumerate(windows):
        at = 0
        for (ident, n), s, m, ids in window:
            doc.append(ident)
            total.append(n)
            start.append(s)
            length.append(m)
            crc.append(zlib.crc32(ids))
            seq.append(first_id + k)
            offset.append(at)
            at += m
            data.append(ids)
    if with_ids:
        sizes = np.array([len(x) // 4 for x in data], np.int64)
        flat = np.frombuffer(b"".join(data), "<u4").astype(np.int32)
        ids = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(flat, pa.int32()))
    else:
        ids = pa.nulls(len(doc), pa.list_(pa.int32()))
    long = pa.int64()
    return pa.RecordBatch.from_arrays(
        [pa.array(doc, long), pa.array(start, long), pa.array(length, long), pa.array(crc, long),
         pa.array(total, long), pa.array(seq, long), pa.array(offset, long), ids],
        [c.split()[0] for c in PIECES.split(", ")])


PIECES = ("uid long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long, ids array<int>")
#: Sequence numbers of the second step start here; those of a task's last open
#: window, which the second step takes, are below zero.
MERGED = 1 << 62


def _documents(uids: list, parts: Iterator[tuple[int, bytes]], end: bytes) -> Iterator[tuple[int, bytes]]:
    """(identifier, whole text's identifiers and the end mark) from parts of texts."""
    row, held = 0, []
    for r, ids in parts:
        if r != row:
            yield uids[row], b"".join([*held, end])
            row, held = r, []
        held.append(ids)
    if uids:
        yield uids[row], b"".join([*held, end])


def _pack_task(batches: Iterator[pa.RecordBatch], path: str, end_id: int, size: int,
               with_ids: bool) -> Iterator[pa.RecordBatch]:
    """(uid, text, task) -> pieces; those of the last open window keep their ids."""
    packer, task, number = Packer(size), 0, 0
    encode, end = encoder(path), np.array([end_id], "<u4").tobytes()
    for batch in batches:
        if not batch.num_rows:
            continue
        task = batch.column(2)[0].as_py()
        held = 0
        for uid, ids in _documents(batch.column(0).to_pylist(), encode.encode_all(batch.column(1)), end):
            n, data = len(ids) // 4, memoryview(ids)
            whole = n - n % size
            for at in range(0, whole, size):
                packer.closed.append([((uid, n), at, size, data[4 * at:4 * (at + size)])])
                held += 4 * size
                if held > FLUSH:
                    yield _rows(packer.closed, (task << 40) + number, with_ids)
                    number += len(packer.closed)
                    packer.closed, held = [], 0
            if whole < n:  # a copy, so that an open window does not hold the whole text
                packer.add([((uid, n), whole, n - whole, ids[4 * whole:])], n - whole)
                held += 4 * (n - whole)
    encode.end_task()
    rest = packer.finish()
    yield _rows(packer.closed, (task << 40) + number, with_ids)
    if rest:
        yield _rows([rest], -task - 1, True)


def _merge(batches: Iterator[pa.RecordBatch], size: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    """(group, then a piece's columns), sorted by group: the groups' windows packed anew."""
    group, packer, number = None, Packer(size), 0

    def done():
        rest = packer.finish()
        windows = packer.closed + ([rest] if rest else [])
        return _rows(windows, MERGED + (group << 40) + number, with_ids)

    for batch in batches:
        for r in batch.to_pylist():
            if r["group"] != group:
                if group is not None:
                    yield done()
                group, packer, number = r["group"], Packer(size), 0
            ids = np.array(r["ids"], "<u4").tobytes()
            packer.add([((r["uid"], r["doc_tokens"]), r["start"], r["length"], ids)], r["length"])
            if len(packer.closed) >= 512:
                yield _rows(packer.closed, MERGED + (group << 40) + number, with_ids)
                number += len(packer.closed)
                packer.closed = []
    if group is not None:
        yield done()


def pack(docs: DataFrame, tokenizer: str, end_id: int, text: str = "text", doc_id: str = "doc_id",
         size: int = 4096, with_ids: bool = True) -> DataFrame:
    """Pack all documents into sequences of at most ``size`` tokens.

    One row for each piece of a document: the identifier column, ``start`` and
    ``length`` (in the document's tokens), ``ids_crc32`` (of its identifiers as
    little-endian unsigned 32-bit numbers), ``doc_tokens``, ``sequence_id`` and
    ``offset`` there (gapless from 0), and ``ids`` if ``with_ids``.  Every
    document ends with ``end_id``, so null and empty texts are one token.  Rows
    with one identifier are packed each for itself.  An empty table gives an
    empty result.  Other columns are not read, whatever their names.

    The first step's pieces are written once to the shared checkpoint folder.
    ``tokenizer`` is a file that every worker can read.
    """
    spark = prepare(docs.sparkSession)
    if docs.schema[doc_id].dataType.simpleString() not in ("bigint", "int", "smallint", "tinyint"):
        raise ValueError("identifiers must be whole numbers")
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("uid"), F.col(f"`{text}`").alias("text"),
                       F.spark_partition_id().alias("task"))
    pieces = materialize(rows.mapInArrow(
        lambda it: _pack_task(it, tokenizer, end_id, size, with_ids), PIECES), "pieces")
    n_shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    left = (pieces.where("sequence_id < 0")
            .withColumn("group", F.floor((-F.col("sequence_id") - 1) / GROUP).cast("long"))
            .repartition(n_shuffle, "group")
            .sortWithinPartitions("group", "sequence_id", "offset"))
    merged = left.mapInArrow(lambda it: _merge(it, size, with_ids), PIECES)
    out = pieces.where("sequence_id >= 0").unionByName(merged)
    return out.withColumnRenamed("uid", doc_id).drop(*([] if with_ids else ["ids"]))
