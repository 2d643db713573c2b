"""Operator 9: stupid-backoff scores of every document under the corpus' own n-gram counts.

Count tables of all n-grams up to an order, partitioned by hash.  Documents are dealt
to chunks; a chunk explodes its texts to n-grams, counts them, and sends the
distinct ones, sorted and packed, to hash buckets.  A bucket adds the counts up
and joins the totals back to the chunks that asked, where they are summed per
document.  A frequent n-gram costs one entry per chunk.  N-grams are identified
by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import CHUNK_BYTES, bucket_of, in_chunks, mix, prepare, shuffle_partitions
from .words import Words

SENT, REPLY = "size int, bucket int, chunk int, grams binary, counts binary", "size int, chunk int, bucket int, counts binary"
SCORES = "doc_id long, n_words long, n_backoff long, log_score double"
_SENT = pa.schema([("size", pa.int32()), ("bucket", pa.int32()), ("chunk", pa.int32()), ("grams", pa.binary()), ("counts", pa.binary())])
_SCORES = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_backoff", pa.int64()), ("log_score", pa.float64())])


def _planes(keys: np.ndarray) -> bytes:
    """Sorted keys byte by byte: the high bytes hardly change, so the shuffle's compression removes them."""
    return keys.view(np.uint8).reshape(-1, 8).T.tobytes()


def _from_planes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view(np.uint64).reshape(-1)


class _Grams:
    """The n-grams of one chunk by size: ``at``, the words that begin one inside a document, and tables of their hashes."""

    def __init__(self, texts: list[bytes], buckets: int, order: int):
        self.words, self.buckets = Words(texts), buckets
        w, grams = self.words, self.words.h
        self.at = {1: np.arange(len(w.h))}
        self.tables = {1: np.unique(w.h, return_inverse=True, return_counts=True)}
        for size in range(2, order + 1):
            inside = w.left[self.at[size - 1]] >= size
            self.at[size] = self.at[size - 1][inside]
            grams = mix(grams[inside], w.h[self.at[size] + size - 1])
            self.tables[size] = np.unique(grams, return_inverse=True, return_counts=True)

    def edges(self, size: int) -> np.ndarray:
        return np.searchsorted(bucket_of(self.tables[size][0], self.buckets), np.arange(self.buckets + 1))

    def sent(self, chunk: int) -> pa.Table:
        rows = []
        for size, (keys, _, counts) in self.tables.items():
            edges = self.edges(size)
            for b in np.flatnonzero(np.diff(edges)).tolist():
                s, e = edges[b], edges[b + 1]
                rows.append((size, b, chunk, _planes(keys[s:e]), counts[s:e].astype("<u4").tobytes()))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * 5, _SENT, strict=True)],
                                    schema=_SENT)

    def totals(self, size: int, reply: dict) -> np.ndarray:
        """The corpus count of every n-gram occurrence in the chunk."""
        keys, at, _ = self.tables[size]
        edges, out = self.edges(size), np.zeros(len(keys), np.int64)
        for s, b, counts in zip(reply["size"], reply["bucket"], reply["counts"], strict=True):
            if s == size:
                out[edges[b]: edges[b + 1]] = np.frombuffer(counts, "<i8")
        return out[at]


def _add_up(key, sent):
    """A bucket's totals, sent back to every chunk in the order it asked."""
    grams = [_from_planes(x) for x in sent["grams"].to_pylist()]
    counts = np.concatenate([np.frombuffer(x, "<u4") for x in sent["counts"].to_pylist()]).astype(np.int64)
    keys, at = np.unique(np.concatenate(grams), return_inverse=True)
    total = np.zeros(len(keys), np.int64)
    np.add.at(total, at, counts)
    parts = np.split(total[at], np.cumsum([len(g) for g in grams])[:-1])
    return pa.table({"size": sent["size"], "chunk": sent["chunk"], "bucket": sent["bucket"],
                     "counts": pa.array([p.astype("<i8").tobytes() for p in parts], pa.binary())})


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", backoff: float = 0.4,
                    min_count: int = 2, order: int = 2) -> DataFrame:
    """``(doc_id, n_words, n_backoff, log_score, mean_log_score)`` for every row.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged.  A word's context is the up to
    ``order`` - 1 words before it in its document.  With a context it scores
    count(context and word) / count(context) if those words occur ``min_count``
    times or more in all documents, else ``backoff`` times its score under the
    context without its first word; without any context, count(word) / N.
    ``log_score`` sums natural logarithms, ``n_backoff`` counts the steps to a
    shorter context.  A null or empty text scores 0 with a null mean; repeated
    rows count as often as they occur; no rows give no rows.

    The counts hold the scored text itself, so at a ``min_count`` of 1 no word
    would ever back off: an n-gram met once is that text's own.
    """
    if order < 1:
        raise ValueError("order must be at least 1")
    spark = docs.sparkSession
    prepare(spark)
    words = F.size(F.array_remove(F.split(F.col("text"), r"[\x20\x09-\x0D]+"), ""))
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    total, size = source.agg(F.sum(words.cast("long")), F.sum(F.octet_length("text").cast("long"))).first()
    n = max(shuffle_partitions(spark), -(-(size or 0) // CHUNK_BYTES))
    chunks = in_chunks(source, F.xxhash64("doc_id", "text"), n)
    log_n, log_back = float(np.log(total or 1)), float(np.log(backoff))

    def send(table):
        return _Grams([x.encode() for x in table["text"].to_pylist()], n, order).sent(table["__chunk"][0].as_py())

    def score(table, reply):
        if not table.num_rows:
            return None
        g = _Grams([x.encode() for x in table["text"].to_pylist()], n, order)
        answers = reply.to_pydict()
        totals = g.totals(1, answers)
        logs = np.log(totals) - log_n if len(totals) else np.zeros(0)
        backed = np.zeros(len(logs) + 1, np.int64)
        for size in range(2, order + 1):  # a word's score under one more word of context replaces the shorter one's
            context = np.zeros(len(logs), np.int64)
            context[g.at[size - 1]] = totals
            totals, behind = g.totals(size, answers), g.at[size] + size - 1
            known = totals >= min_count
            backed[behind[~known]] += 1
            logs[behind[~known]] += log_back
            backed[behind[known]] = 0
            logs[behind[known]] = np.log(totals[known]) - np.log(context[g.at[size][known]])
        starts, lengths = g.words.starts, g.words.lengths
        some = lengths > 0
        sums, backs = np.zeros(len(starts)), np.zeros(len(starts), np.int64)
        if some.any():
            sums[some] = np.add.reduceat(logs, starts[some])
            backs[some] = np.add.reduceat(backed[:-1], starts[some])
        return pa.Table.from_arrays([table["doc_id"].combine_chunks(), pa.array(lengths), pa.array(backs), pa.array(sums)], schema=_SCORES)

    sent = chunks.groupBy("__chunk").applyInArrow(send, SENT)
    replies = sent.repartition(n, "bucket").groupBy("size", "bucket").applyInArrow(_add_up, REPLY) \
        .withColumnRenamed("chunk", "__chunk").repartition(n, "__chunk")
    scored = chunks.groupBy("__chunk").cogroup(replies.groupBy("__chunk")).applyInArrow(score, SCORES)
    return scored.withColumn("mean_log_score", F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")))
