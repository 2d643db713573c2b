"""Operator 5: removal of word passages that occur more than once.

Difference-cover anchors.  ``COVERS`` holds sets D of residues modulo a period
v such that any two positions i, j have some d < v with i + d and j + d both in
D modulo v.  Only windows of ``window - v + 1`` words at cover positions are
hashed, so two equal windows of ``window`` words hold an equal pair of anchors
at the same distance from their starts, wherever they lie.  Anchors that occur
once are dropped; the others extend to every window around them, and those
windows are compared as a whole by 96-bit hashes.

Documents are dealt to chunks by a hash.  A chunk sends its distinct hashes,
sorted and packed, to hash buckets, and a bucket answers with one bit per hash:
does it occur elsewhere?  So a passage that a third of all rows share costs one
entry per chunk, no pair of occurrences is ever formed, and the texts are
shuffled once (the exchange is reused by all three passes).
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bucket_of, chunks_for, in_chunks, window_hashes
from .words import Words, split

#: Perfect difference sets, period -> residues.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}

_SECOND = np.uint64(0xA0761D6478BD642F)
SENT, REPLY = "bucket int, chunk int, hi binary, lo binary, many binary", "chunk int, bucket int, bits binary"
_SENT = pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), ("hi", pa.binary()), ("lo", pa.binary()), ("many", pa.binary())])


def cover_for(window: int) -> tuple[int, tuple[int, ...]]:
    """The longest period that leaves anchors of at least two fifths of the window."""
    period = max(v for v in COVERS if v == 1 or window - v + 1 >= 0.4 * window)
    return period, COVERS[period]


class _Keys:
    """Sorted distinct keys of a chunk, ``hi`` and optionally 32 more bits ``lo``, cut into hash buckets."""

    def __init__(self, hi: np.ndarray, lo: np.ndarray | None, buckets: int):
        order = np.argsort(hi, kind="stable") if lo is None else np.lexsort((lo, hi))
        hi = hi[order]
        new = np.ones(len(hi), bool)
        new[1:] = hi[1:] != hi[:-1]
        if lo is not None:
            lo = lo[order]
            new[1:] |= lo[1:] != lo[:-1]
        firsts = np.flatnonzero(new)
        self.hi, self.lo = hi[firsts], None if lo is None else lo[firsts]
        self.many = np.diff(np.append(firsts, len(hi))) > 1
        self.group = np.empty(len(hi), np.int64)
        self.group[order] = np.cumsum(new) - 1
        self.edges = np.searchsorted(bucket_of(self.hi, buckets), np.arange(buckets + 1))

    def sent(self, chunk: int) -> pa.Table:
        used = np.flatnonzero(np.diff(self.edges))
        cut = [(self.edges[b], self.edges[b + 1]) for b in used]
        lo = [b"" if self.lo is None else self.lo[s:e].tobytes() for s, e in cut]
        return pa.table([pa.array(used, pa.int32()), pa.array([chunk] * len(used), pa.int32()),
                         pa.array([self.hi[s:e].tobytes() for s, e in cut], pa.binary()), pa.array(lo, pa.binary()),
                         pa.array([np.packbits(self.many[s:e]).tobytes() for s, e in cut], pa.binary())], schema=_SENT)

    def shared(self, reply: pa.Table) -> np.ndarray:
        """For every input key: does it occur more than once anywhere?"""
        found = np.zeros(len(self.hi), bool)
        for b, bits in zip(reply["bucket"].to_pylist(), reply["bits"].to_pylist(), strict=True):
            s, e = self.edges[b], self.edges[b + 1]
            found[s:e] = np.unpackbits(np.frombuffer(bits, np.uint8))[: e - s]
        return found[self.group]


def _answer(key, sent):
    """A bucket's reply to every chunk: a bit per key, set if the key occurs more than once."""
    his = [np.frombuffer(x, np.uint64) for x in sent["hi"].to_pylist()]
    los = [np.frombuffer(x, np.uint32) for x in sent["lo"].to_pylist()]
    ends = np.cumsum([len(x) for x in his])
    many = np.concatenate([np.unpackbits(np.frombuffer(m, np.uint8))[: len(x)] for m, x in zip(sent["many"].to_pylist(), his, strict=True)])
    lo = np.concatenate(los)
    keys = _Keys(np.concatenate(his), lo if len(lo) else None, 1)
    shared = keys.many[keys.group] | many.astype(bool)
    bits = [np.packbits(x).tobytes() for x in np.split(shared, ends[:-1])]
    return pa.table({"chunk": sent["chunk"], "bucket": sent["bucket"], "bits": pa.array(bits, pa.binary())})


def _covered(starts: np.ndarray, before: int, after: int, n: int) -> np.ndarray:
    """Positions within ``[s - before, s + after)`` of some s."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, np.maximum(starts - before, 0), 1)
    np.add.at(steps, np.minimum(starts + after, n), -1)
    return np.cumsum(steps[:-1]) > 0


class _Passages:
    """One chunk's documents through the three passes."""

    def __init__(self, texts: list[bytes], window: int, buckets: int):
        self.words, self.window, self.buckets = Words(texts), window, buckets
        w, (self.period, residues) = self.words, cover_for(window)
        self.width = window - self.period + 1
        hashes = window_hashes(w.h, self.width)
        n, on = len(hashes), np.zeros(self.period, bool)
        on[list(residues)] = True
        whole = w.left[:n] + w.pos[:n] >= window
        self.at = np.flatnonzero(on[w.pos[:n] % self.period] & (w.left[:n] >= self.width) & whole)
        self.anchors = _Keys(hashes[self.at], None, buckets)

    def windows(self, reply: pa.Table) -> _Keys:
        """All windows that hold an anchor which occurs elsewhere."""
        w, n = self.words, len(self.words.h)
        hot = self.at[self.anchors.shared(reply)]
        near = _covered(hot, self.window - self.width, 1, n)
        self.starts = np.flatnonzero(near & (w.left >= self.window))
        hi = window_hashes(w.h, self.window)[self.starts]
        lo = (window_hashes(w.h ^ _SECOND, self.window)[self.starts] >> np.uint64(32)).astype(np.uint32)
        return _Keys(hi, lo, self.buckets)

    def removed(self, anchor_reply: pa.Table, window_reply: pa.Table) -> np.ndarray:
        keys = self.windows(anchor_reply)
        return _covered(self.starts[keys.shared(window_reply)], 0, self.window, len(self.words.h))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35,
                   keep_layout: bool = False) -> DataFrame:
    """All rows and columns of ``docs``, ``text_col`` holding its kept words joined by one space, plus ``n_words``
    and ``n_removed`` (longs; they replace columns of these names).

    A word goes if a window of ``window`` words over it also starts anywhere
    else, in the same text or another.  A null text has no words and becomes an
    empty one; a text shorter than the window keeps all words; a repeated row
    is one more occurrence; a text of any length lies in one chunk; an empty
    table gives an empty one.  With ``keep_layout``, a text that loses nothing
    is returned as it was, a null one included.
    """
    rows = docs.drop("n_words", "n_removed", "__chunk")
    n = chunks_for(docs, text_col)
    chunks = in_chunks(rows, F.xxhash64(id_col, text_col), n)

    def texts(table):
        return [b"" if x is None else x.encode() for x in table[text_col].to_pylist()]

    def send_anchors(table):
        return _Passages(texts(table), window, n).anchors.sent(table["__chunk"][0].as_py())

    def send_windows(table, reply):
        if not table.num_rows:
            return _SENT.empty_table()
        return _Passages(texts(table), window, n).windows(reply).sent(table["__chunk"][0].as_py())

    schema = T.StructType([T.StructField(f.name, T.StringType() if f.name == text_col else f.dataType, True) for f in rows.schema]
                          + [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])

    def clean(table, replies):
        if not table.num_rows:
            return None
        raw = texts(table)
        work = _Passages(raw, window, n)
        second = pc.equal(replies["pass"], 2)
        gone = work.removed(replies.filter(pc.invert(second)), replies.filter(second))
        out, counts = [], []
        for text, s, size in zip(raw, work.words.starts.tolist(), work.words.lengths.tolist(), strict=True):
            mask = gone[s: s + size]
            counts.append(int(mask.sum()))
            kept = list(compress(split(text), ~mask)) if counts[-1] else split(text)
            out.append(b" ".join(kept).decode())
        if keep_layout:
            out = [new if c else old for new, c, old in zip(out, counts, table[text_col].to_pylist(), strict=True)]
        done = table.drop_columns(["__chunk"])
        done = done.set_column(done.schema.get_field_index(text_col), text_col, pa.array(out, pa.string()))
        return done.append_column("n_words", pa.array(work.words.lengths)).append_column("n_removed", pa.array(counts, pa.int64()))

    def answers(sent, number):
        reply = sent.repartition(n, "bucket").groupBy("bucket").applyInArrow(_answer, REPLY)
        return reply.select(F.col("chunk").alias("__chunk"), "bucket", "bits", F.lit(number).alias("pass"))

    def with_replies(replies, fn, out):
        return chunks.groupBy("__chunk").cogroup(replies.repartition(n, "__chunk").groupBy("__chunk")).applyInArrow(fn, out)

    anchors = answers(chunks.groupBy("__chunk").applyInArrow(send_anchors, SENT), 1)
    windows = answers(with_replies(anchors, send_windows, SENT), 2)
    return with_replies(anchors.unionByName(windows), clean, schema)
