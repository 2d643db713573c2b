"""Operator 6: harmonic packing of token ids into fixed-length sequences.

Class k holds pieces of exactly ``capacity // k`` ids, and a sequence of the
class holds k of them.  A document is cut greedily: the largest class length
that fits, then its rest.  So every worker fills the sequences of each class
with a fixed number of pieces, without looking at other workers, and hardly
pads.  What no worker could fill (fewer than k pieces a class) goes on to
merging rounds of ``FAN_IN`` workers each; the last few pieces are cut into
power-of-two sequences, which need no padding.
"""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, claim, materialise
from .tokens import token_ids

#: Workers whose unfilled classes one merging task takes; each has under 64 classes x ``capacity`` ids.
FAN_IN = 32
#: Ids that a worker gathers before it writes a batch.
FLUSH_IDS = 1 << 20

PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()),
                    ("sequence_id", pa.int64()), ("offset", pa.int64()), ("worker", pa.int64()), ("ids", pa.binary())])
PIECES_SQL = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, worker long, ids binary"


def class_lengths(capacity: int) -> list[int]:
    """Piece lengths in rising order: ``capacity // k`` for k up to 64, then powers of two down to 1."""
    lengths = {capacity // k for k in range(1, 65) if capacity // k}
    small, power = min(lengths), 1
    while power < small:
        lengths.add(power)
        power *= 2
    return sorted(lengths)


class Filler:
    """One worker's open sequences, a list of pieces per class length."""

    def __init__(self, capacity: int, first_id: int):
        self.capacity, self.next_id = capacity, first_id
        self.lengths = class_lengths(capacity)
        self.open: dict[int, list[tuple]] = {n: [] for n in self.lengths}
        self.done: list[tuple] = []
        self.held = 0

    def cut(self, n: int) -> list[int]:
        """The class lengths that a run of ``n`` ids is cut into, largest first."""
        out = [self.capacity] * (n // self.capacity)
        n %= self.capacity
        while n:
            out.append(self.lengths[bisect.bisect_right(self.lengths, n) - 1])
            n -= out[-1]
        return out

    def add(self, doc: int | None, start: int, total: int, ids: bytes) -> None:
        """Place one piece, whose length is a class length."""
        length = len(ids) // 4
        row = self.open[length]
        row.append((doc, start, total, ids))
        if len(row) == self.capacity // length:
            self.seal(row)
            self.open[length] = []

    def seal(self, row: list[tuple]) -> None:
        offset = 0
        for doc, start, total, ids in row:
            n = len(ids) // 4
            self.done.append((doc, start, n, total, self.next_id, offset, None, ids))
            offset += n
        self.next_id += 1
        self.held += offset

    def finish(self) -> None:
        """Cut what is left into full sequences and, at last, into sequences of a power of two."""
        rest = [p for row in self.open.values() for p in row]
        total = sum(len(p[3]) // 4 for p in rest)
        room, row = min(self.capacity, 1 << max(0, total.bit_length() - 1)), []
        for doc, start, size, ids in rest:
            while ids:
                n = min(room, len(ids) // 4)
                row.append((doc, start, size, ids[: 4 * n]))
                start, ids, room, total = start + n, ids[4 * n:], room - n, total - n
                if not room:
                    self.seal(row)
                    row, room = [], min(self.capacity, 1 << max(0, total.bit_length() - 1))
        self.open = {}

    def take(self, worker: int | None = None) -> pa.RecordBatch:
        """The sealed pieces so far; with ``worker``, the open ones too, marked by it."""
        rows = self.done
        if worker is not None:
            rows = rows + [(d, s, len(i) // 4, t, None, None, worker, i) for r in self.open.values() for d, s, t, i in r]
        self.done, self.held = [], 0
        return batches(dict(zip(PIECES.names, zip(*rows, strict=True) if rows else [[]] * len(PIECES), strict=True)), PIECES)


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int, capacity: int = 4096, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Pieces of all documents with their place: ``(doc_id, start, length, doc_tokens, sequence_id, offset, ids)``.

    ``ids`` are little-endian uint32 bytes; ``sequence_id`` is unique, not
    consecutive.  A null text is empty and packs its end id alone; repeated
    rows and null ids are packed like any row; no rows give no pieces.  A
    document of any length is cut into pieces of ``capacity`` ids and a rest.
    """
    tokens = token_ids(docs, vocabulary, end_id, id_col, text_col)

    def fill(tables):
        worker = TaskContext.get().partitionId()
        filler = Filler(capacity, worker << 28)
        for b in tables:
            for doc, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                at, n = 0, len(ids) // 4
                for length in filler.cut(n):
                    filler.add(doc, at, n, ids[4 * at: 4 * (at + length)])
                    at += length
                if filler.held >= FLUSH_IDS:
                    yield filler.take()
        yield filler.take(worker)

    level = materialise(tokens.mapInArrow(fill, PIECES_SQL), "pieces")
    sealed, rounds = [level.where("worker is null")], 0
    workers = level.agg(F.max("worker")).first()[0]
    while workers is not None:
        rounds, last = rounds + 1, workers < FAN_IN
        merged = materialise(level.where("worker is not null")
                             .withColumn("group", F.floor(F.col("worker") / FAN_IN).cast("long"))
                             .groupBy("group").applyInArrow(_merge(capacity, rounds, last), PIECES_SQL), "pieces")
        sealed.append(merged.where("worker is null"))
        level, workers = merged, None if last else workers // FAN_IN
    out = sealed[0]
    for more in sealed[1:]:
        out = out.unionByName(more)
    return out.drop("worker")


def _merge(capacity: int, rounds: int, last: bool):
    def merge(key, table):
        claim("packing")
        group = key[0].as_py()
        filler = Filler(capacity, (rounds << 58) | (group << 28))
        rows = table.select(["doc_id", "start", "doc_tokens", "ids"]).to_pylist()
        rows.sort(key=lambda r: (len(r["ids"]), r["doc_id"] is not None, r["doc_id"] or 0, r["start"], r["ids"]))
        for r in rows:
            filler.add(r["doc_id"], r["start"], r["doc_tokens"], r["ids"])
        if last:
            filler.finish()
        return pa.Table.from_batches([filler.take(group)], PIECES)
    return merge
