"""Operator 7: token ids in Huffman-coded shard files.

File format, a folder of two Parquet tables (Parquet carries the coded blocks,
so any store that Spark writes to will do, with Spark's commit protocol):

* ``codebook``: ``(id, bits)``, the code length of every id that occurs.  Codes
  are canonical: counted up by (length, id).
* ``blocks``: ``shard`` (rises with doc_id), ``block`` (number in the shard),
  ``first`` (ids of the shard before the block), ``doc_ids`` and ``lengths``
  (the block's documents in order), ``n_ids``, ``checkpoints`` (little-endian
  uint64 bit offset of every ``STEP``-th id) and ``payload`` (the codes, most
  significant bit first, in big-endian 32-bit words).

A block is decoded alone, and inside it all checkpoints are decoded side by
side through a table indexed by the next ``max_bits`` bits.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shared_dir
from .common import batches, claim, materialise, shuffle_partitions, prepare
from .tokens import token_ids

#: Ids between two checkpoints; ids after which a block is closed; the longest code.
STEP, BLOCK_IDS, MAX_BITS = 256, 1 << 19, 16
#: Words whose ids a worker keeps in a generation: about 250 MB in both generations at most.  Bytes of text encoded at once.
WORDS, AT_ONCE = 600_000, 12 << 20

BLOCKS = ("shard int, block int, first long, n_ids long, doc_ids array<bigint>, lengths array<bigint>, "
          "checkpoints binary, payload binary")


def code_lengths(counts: np.ndarray, max_bits: int) -> np.ndarray:
    """Optimal code lengths of at most ``max_bits`` for positive counts (package-merge).

    One symbol gets one bit; more than ``2**max_bits`` symbols are an error.
    """
    n = len(counts)
    if n > 1 << max_bits:
        raise ValueError(f"{n} symbols don't fit codes of {max_bits} bits")
    if n < 2:
        return np.ones(n, np.int64)
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.int64)
    row, leaf_marks = leaves, [np.ones(n, bool)]
    for _ in range(max_bits - 1):
        packages = row[: len(row) // 2 * 2].reshape(-1, 2).sum(axis=1)
        merged = np.concatenate([leaves, packages])
        by_weight = np.argsort(merged, kind="stable")
        row = merged[by_weight]
        leaf_marks.append(by_weight < n)
    lengths, take = np.zeros(n, np.int64), 2 * (n - 1)
    for marks in reversed(leaf_marks):
        used = int(marks[:take].sum())
        lengths[:used] += 1
        take = 2 * (min(take, len(marks)) - used)
    out = np.zeros(n, np.int64)
    out[order] = lengths
    return out


def canonical_codes(ids: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """The code of each id: counted up by (length, id)."""
    order = np.lexsort((ids, bits))
    widths = bits[order]
    top = int(widths.max(initial=1))
    starts = np.concatenate([[0], np.cumsum(np.int64(1) << (top - widths))[:-1]]) if len(ids) else np.zeros(0, np.int64)
    codes = np.zeros(len(ids), np.int64)
    codes[order] = starts >> (top - widths)
    return codes


def pack(ids: np.ndarray, code_of: np.ndarray, bits_of: np.ndarray, step: int = STEP, run: int = 128) -> tuple[bytes, np.ndarray]:
    """The codes of ``ids`` one after another as big-endian 32-bit words; the bit offset of every ``step``-th.

    ``run`` checkpoints are packed at a time, so that what a pass leaves is still
    in the processor's cache for the next.
    """
    widest = int(bits_of.max(initial=1))
    code_of, bits_of = code_of.astype(np.uint64), bits_of.astype(np.int64)
    words = np.zeros(len(ids) * widest // 32 + 3, np.uint64)
    checkpoints, total = [np.zeros(0, np.int64)], 0
    for first in range(0, len(ids), run * step):
        part = ids[first: first + run * step]
        codes, n = code_of[part], bits_of[part]
        at = np.cumsum(n)
        at += total - n
        total = int(at[-1] + n[-1])
        checkpoints.append(at[::step])
        if widest <= 16:  # two codes fit where one is put
            if len(n) % 2:
                codes, n, at = np.append(codes, np.uint64(0)), np.append(n, 0), np.append(at, total)
            codes, n, at = (codes[::2] << n[1::2].astype(np.uint64)) | codes[1::2], n[::2] + n[1::2], at[::2]
        word = at >> 5
        value = codes << (64 - (at & 31) - n).astype(np.uint64)
        firsts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        words[word[firsts]] += np.add.reduceat(value >> np.uint64(32), firsts)
        words[word[firsts] + 1] += np.add.reduceat(value & np.uint64(0xFFFFFFFF), firsts)
    return words[: ((total + 31) >> 5) + 2].astype(">u4").tobytes(), np.concatenate(checkpoints)


def unpack(payload: bytes, checkpoints: np.ndarray, n: int, symbol: np.ndarray, width: np.ndarray, max_bits: int,
           step: int = STEP) -> np.ndarray:
    """All ``n`` ids of a block: one id of every checkpoint's run at a time."""
    words = np.frombuffer(payload, ">u4").astype(np.uint64)
    pairs = (words[:-1] << np.uint64(32)) | words[1:]
    out = np.zeros((step, len(checkpoints)), symbol.dtype)
    at, shift = checkpoints.astype(np.int64), np.uint64(64 - max_bits)
    for i in range(step):
        if i == n - (len(checkpoints) - 1) * step:  # the last run ends
            at = at[:-1]
        seen = ((pairs[at >> 5] << (at & 31).astype(np.uint64)) >> shift).astype(np.int64)
        out[i, : len(at)] = symbol[seen]
        at = at + width[seen]
    return out.T.reshape(-1)[:n]


def decode_table(ids: np.ndarray, bits: np.ndarray, dtype: str, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The id and its code length for every value of the next ``max_bits`` bits."""
    order = np.lexsort((ids, bits))
    runs = np.int64(1) << (max_bits - bits[order])
    symbol, width = np.zeros(1 << max_bits, dtype), np.ones(1 << max_bits, np.int64)
    used = int(runs.sum())
    symbol[:used], width[:used] = np.repeat(ids[order], runs), np.repeat(bits[order], runs)
    return symbol, width


def codebook(tokens: DataFrame, dtype: str, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Ids that occur and their code lengths.  What is collected has a row per vocabulary entry at most."""
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64())])

    def count(tables):
        claim("blocks")
        total = np.zeros(0, np.int64)
        for b in tables:
            got = np.bincount(np.frombuffer(b"".join(b.column(0).to_pylist()), dtype))
            total, got = (total, got) if len(total) >= len(got) else (got, total)
            total[: len(got)] += got
        ids = np.flatnonzero(total)
        yield batches({"id": ids, "n": total[ids]}, schema)

    rows = tokens.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    rows.sort()
    ids, counts = np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64)
    return ids, code_lengths(counts, max(max_bits, int(len(ids)).bit_length()))


def write_token_files(docs: DataFrame, path: str, vocabulary: str, end_id: int, id_col: str = "doc_id",
                      text_col: str = "text", dtype: str = "<u2", max_bits: int = MAX_BITS) -> None:
    """Encode every whole text, append ``end_id``, and write the ids in ascending ``id_col`` order to ``path``.

    A null text is empty (its end id alone), a null id sorts first, repeated
    ids are kept in the order of their ids' hash; no rows give no blocks.  A
    document lies in one block.
    """
    spark = docs.sparkSession
    tokens = materialise(token_ids(docs, vocabulary, end_id, id_col, text_col, dtype, WORDS, AT_ONCE), "ids")
    ids, bits = codebook(tokens, dtype, max_bits)
    spark.createDataFrame([(int(i), int(b)) for i, b in zip(ids, bits, strict=True)], "id long, bits int") \
        .coalesce(1).write.parquet(f"{path}/codebook")
    code_of, bits_of = np.zeros(int(ids.max(initial=0)) + 1, np.int64), np.zeros(int(ids.max(initial=0)) + 1, np.int64)
    code_of[ids], bits_of[ids] = canonical_codes(ids, bits), bits
    schema = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()),
                        ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
                        ("checkpoints", pa.binary()), ("payload", pa.binary())])

    def encode(tables):
        claim("blocks")
        shard, block, first = TaskContext.get().partitionId(), 0, 0
        names, parts, held = [], [], 0

        def close():
            flat = np.frombuffer(b"".join(parts), dtype)
            payload, checkpoints = pack(flat, code_of, bits_of)
            return batches({"shard": [shard], "block": [block], "first": [first], "n_ids": [len(flat)],
                            "doc_ids": [names], "lengths": [[len(p) // np.dtype(dtype).itemsize for p in parts]],
                            "checkpoints": [checkpoints.astype("<u8").tobytes()], "payload": [payload]}, schema)

        for b in tables:
            for name, part in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                names.append(name)
                parts.append(part)
                held += len(part) // np.dtype(dtype).itemsize
                if held >= BLOCK_IDS:
                    yield close()
                    block, first, names, parts, held = block + 1, first + held, [], [], 0
        if names:
            yield close()

    tie = F.xxhash64("ids")
    in_order = tokens.repartitionByRange(shuffle_partitions(spark), F.col("doc_id").asc_nulls_first(), tie) \
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), tie)
    in_order.mapInArrow(encode, BLOCKS).write.parquet(f"{path}/blocks")


def read_token_files(spark: SparkSession, path: str, dtype: str = "<u2", max_bits: int = MAX_BITS) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)``: ``start`` counts the ids of all documents before it, ``ids`` is uint32 bytes."""
    prepare(spark, rows=16)
    book = spark.read.parquet(f"{path}/codebook").collect()  # a row per vocabulary entry at most
    ids, bits = np.array([r["id"] for r in book], np.int64), np.array([r["bits"] for r in book], np.int64)
    max_bits = max(max_bits, int(bits.max(initial=1)))
    schema = pa.schema([("shard", pa.int32()), ("doc_id", pa.int64()), ("at", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids", pa.binary())])

    def decode(tables):
        claim("blocks")
        symbol, width = decode_table(ids, bits, dtype, max_bits)
        for b in tables:
            for r in b.to_pylist():
                flat = unpack(r["payload"], np.frombuffer(r["checkpoints"], "<u8"), r["n_ids"], symbol, width, max_bits)
                ends = np.cumsum(r["lengths"])
                raw = flat.astype("<u4").tobytes()
                starts = ends - r["lengths"]
                yield batches({"shard": [r["shard"]] * len(ends), "doc_id": r["doc_ids"], "at": r["first"] + starts,
                               "n_tokens": r["lengths"],
                               "ids": [raw[4 * s: 4 * e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]},
                              schema)

    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    # a row per shard, and the shards are as many as the partitions that wrote them: small enough to broadcast
    before = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n")).select(
        "shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("before"))
    docs = blocks.mapInArrow(decode, "shard int, doc_id long, at long, n_tokens long, ids binary")
    return docs.join(F.broadcast(before), "shard").select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids")


def token_files(docs: DataFrame, vocabulary: str, end_id: int, **columns: str) -> DataFrame:
    """Write ``docs`` to a fresh folder in the shared folder and read the files back."""
    spark = docs.sparkSession
    path = f"{shared_dir(spark)}/lapsewise-llm/token-files-{uuid.uuid4().hex}"
    write_token_files(docs, path, vocabulary, end_id, **columns)
    return read_token_files(spark, path)
