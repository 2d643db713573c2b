"""Operator 3: SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints within the radius meet at a variant half-way between them.
The radius is 3, so half of it is one flipped bit and a half step more.  Every
fingerprint emits its variants within one bit, each with one of four 16-bit
blocks erased (the half step); variants are shuffled and sorted, and only those
that several fingerprints share go on.  For these the half step is made exact:
parity tells which side takes it.  Fingerprints an odd distance apart differ in
parity, so even ones emit one flip and odd ones that flip and one in the erased
block, and whole 64-bit variants meet.  Around a variant all even fingerprints
are within two bits of each other and within three of every odd one, so one
link from the smallest even fingerprint to each other member joins the group:
links grow with the members, never with their pairs, and each link's distance
is verified.  Odd pairs two bits apart meet the same way at one flip.

Copies share a fingerprint and are one node from the start.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import batches, claim, materialise, prepare, utf8
from .components import components
from .words import split

BLOCK = 16
#: Shingles hashed at once.
SLICE = 1 << 16


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """64-bit SimHash of a text: A-Z lowered, word shingles, XXH64 with seed 42, bits set in over half of them."""
    words = split(text.lower())  # bytes.lower() changes A-Z only
    n = max(1, len(words) - shingle + 1) if words else 0
    ones = np.zeros(64, np.int64)
    for at in range(0, n, SLICE):
        size = min(SLICE, n - at)
        part = words[at: at + size + shingle - 1]
        joined = b" ".join(part)
        ends = np.cumsum([len(w) + 1 for w in part])
        starts = (ends - [len(w) + 1 for w in part])[:size].tolist()
        stops = (ends - 1)[len(part) - size:].tolist()
        digest = xxhash.xxh64_intdigest
        h = np.fromiter((digest(joined[s:e], 42) for s, e in zip(starts, stops, strict=True)), "<u8", size)
        ones += np.unpackbits(h.view(np.uint8).reshape(size, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * ones > n).tolist())


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``(doc_id, f)``: the fingerprint of every row as a signed long; null and empty texts have zero."""
    prepare(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("f", pa.int64())])

    def score(tables):
        claim("simhash")
        for b in tables:
            f = np.array([fingerprint(x, shingle) for x in b.column(1).to_pylist()], np.uint64).view(np.int64)
            yield batches({"doc_id": b.column(0), "f": f}, schema)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(text_col).alias("t")).mapInArrow(score, "doc_id long, f long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _variants(odd: bool) -> Column:
    """(block, flip, kept): erase a block after no flip or one flip in a block before it (even) or behind it (odd)."""
    rows = []
    for b in range(4):
        kept = _signed(~(0xFFFF << (BLOCK * b)) & (1 << 64) - 1)
        outside = range(BLOCK * (b + 1), 64) if odd else range(BLOCK * b)
        rows += [(b, flip, kept) for flip in [0, *(_signed(1 << i) for i in outside)]]
    return F.array(*[F.struct(F.lit(b).cast("tinyint").alias("block"), F.lit(f).cast("long").alias("flip"), F.lit(k).cast("long").alias("kept"))
                     for b, f, k in rows])


def _flips(block: int, pairs: bool) -> list[int]:
    bits = [1 << i for i in range(BLOCK * block, BLOCK * block + BLOCK)]
    return [_signed(x ^ y) for i, x in enumerate(bits) for y in bits[i + 1:]] if pairs else [_signed(x) for x in bits]


def _in_block(pairs: bool) -> Column:
    """The masks that flip one bit (or two) of the erased block."""
    out = F.lit(None)
    for b in range(4):
        out = F.when(F.col("block") == b, F.array(*[F.lit(x).cast("long") for x in _flips(b, pairs)])).otherwise(out)
    return out


def links(prints: DataFrame) -> DataFrame:
    """``(a, b)``: links within 3 bits that join all fingerprints ``f`` (distinct longs) that such links connect.

    Every pair within 3 bits lies in one component of these links, and every
    link is such a pair.
    """
    odd = (F.bit_count("f") % 2 == 1).alias("odd")
    emitted = prints.select("f", odd).select("f", "odd", F.explode(F.when(F.col("odd"), _variants(True)).otherwise(_variants(False))).alias("v")) \
        .select("f", "odd", "v.block", "v.flip", F.col("f").bitwiseXOR(F.col("v.flip")).bitwiseAND(F.col("v.kept")).alias("key"))
    place = Window.partitionBy("block", "key")
    met = emitted.withColumn("n", F.count(F.lit(1)).over(place)).where("n > 1")
    flip, one = F.col("flip"), F.col("flip") == 0
    exact = F.when(~F.col("odd") & one, _in_block(False)).when(~F.col("odd"), F.array(flip)) \
        .when(one, _in_block(True)).otherwise(F.transform(_in_block(False), lambda x: x.bitwiseXOR(flip)))
    mixed = met.select("f", "odd", F.explode(exact).alias("mask"), F.lit(0).alias("kind"))
    alone = met.where("odd").select("f", "odd", F.explode(F.when(one, _in_block(False)).otherwise(F.array(flip))).alias("mask"), F.lit(1).alias("kind"))
    variants = mixed.union(alone).select("f", "odd", "kind", F.col("f").bitwiseXOR(F.col("mask")).alias("variant")).distinct()
    # kind 0: the smallest even member joins all; kind 1: odd members, all within two bits
    center = F.min(F.when((F.col("kind") == 1) | ~F.col("odd"), F.col("f"))).over(Window.partitionBy("kind", "variant"))
    found = variants.withColumn("center", center).where("center <> f")
    near = F.bit_count(F.col("f").bitwiseXOR(F.col("center"))) <= 3
    return found.where(near).select(F.col("center").alias("a"), F.col("f").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row; ``component_id`` is the smallest id reachable over links
    of at most 3 differing bits, ``fingerprint`` 16 lowercase hex digits.

    Null and empty texts have fingerprint zero and are linked like any other;
    fewer words than a shingle count as one shingle; a repeated row appears
    again; a null id keeps its row, counts for links, and is reported as its
    component's smallest id or null; no rows give no rows.
    """
    prints = materialise(fingerprints(docs, id_col, text_col, shingle), "prints")
    nodes = prints.groupBy("f").agg(F.min("doc_id").alias("least"))
    roots = components(links(nodes.select("f"))).withColumnRenamed("node", "f")
    labelled = nodes.join(roots, "f", "left").select("f", F.coalesce("root", "f").alias("root"), "least")
    smallest = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = labelled.select("f", "root").join(smallest, "root").select("f", "component_id")
    return prints.join(classes, "f").select("doc_id", F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``docs`` with one row of each component, one of its smallest id.

    Rows that repeat an id count as one document: one of them stays, the first
    by a hash of all columns.  Rows of null id, which no component can name,
    stay.
    """
    found = near_duplicates(docs, id_col, text_col, shingle).where("doc_id is not null")
    ids = materialise(found.groupBy("doc_id").agg(F.count("*").alias("n"), F.min("component_id").alias("c"))
                      .where("n > 1 or doc_id <> c").select(F.col("doc_id").alias("__id"), F.col("n").alias("__n"), F.col("c").alias("__c")), "extra")
    same = F.col(id_col).cast("long") == F.col("__id")
    single = docs.join(ids, same, "left_anti")
    again = docs.join(ids.where("__n > 1 and __id = __c"), same, "left_semi")
    first = F.row_number().over(Window.partitionBy(id_col).orderBy(F.xxhash64(*docs.columns)))
    return single.unionByName(again.withColumn("__place", first).where("__place = 1").drop("__place"))
