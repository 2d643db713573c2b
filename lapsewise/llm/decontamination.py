"""Operator 2: benchmark decontamination by SimHash windows, in DataFrame functions only.

Documents are cut into windows of a benchmark item's word count.  A window's
64-bit SimHash over its five-word shingles (each as often as it occurs) is
looked up among the fingerprints of the items of that size through a
multi-index: ``RADIUS + 1`` bit blocks, of which two fingerprints within
``RADIUS`` bits must agree in one.  Pairs within the radius are verified by
their exact weighted similarity: the shared shingle count over the joint one.

Windows without any shingle of an item have similarity zero to all, so only
windows around shared shingles are fingerprinted; this loses nothing.  At a
similarity of 0.8 two fingerprints differ in about 10 bits, with a deviation of
about 3, which sets the radius.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

SHINGLE, SIMILARITY, RADIUS = 5, 0.8, 18
_BOUNDS = [round(64 * i / (RADIUS + 1)) for i in range(RADIUS + 2)]


def _words(text: str) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.array_remove(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _shingled(text: str) -> Column:
    """Word count ``n`` and hashes ``s``, one per ``SHINGLE`` consecutive words; fewer words make one, none make none."""
    def hashes(w: Column) -> Column:
        each = F.transform(F.sequence(F.lit(0), F.size(w) - SHINGLE), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(SHINGLE)]))
        s = F.when(F.size(w) >= SHINGLE, each).when(F.size(w) > 0, F.array(F.xxhash64(F.concat_ws(" ", w)))) \
            .otherwise(F.array().cast("array<bigint>"))
        return F.struct(F.size(w).alias("n"), s.alias("s"))
    return _let(_words(text), hashes)


def _simhash(s: Column) -> Column:
    """Bits set in over half of the shingles."""
    return F.when(F.size(s) < 1 << 15, _majority(s, 16)).otherwise(_majority(s, 32))


def _majority(s: Column, width: int) -> Column:
    """The same by counters of ``width`` bits that share a long, the top one signed: bits g, g + width and so on."""
    places = range(0, 64, width)

    def counted(g: Column) -> Column:
        def bits(total: Column) -> Column:
            out = F.lit(0).cast("long")
            for up in places:
                count = F.shiftrightunsigned(total, up).bitwiseAND(F.lit((1 << width) - 1))
                out = out.bitwiseOR(F.call_function("shiftleft", F.when(2 * count > F.size(s), F.lit(1)).otherwise(F.lit(0)).cast("long"), g + up))
            return out

        lanes = F.lit(sum(1 << up for up in places)).cast("long")
        return F.aggregate(s, F.lit(0).cast("long"), lambda total, h: total + F.call_function("shiftrightunsigned", h, g).bitwiseAND(lanes), bits)

    return F.aggregate(F.transform(F.sequence(F.lit(0), F.lit(width - 1)), counted), F.lit(0).cast("long"), lambda f, g: f.bitwiseOR(g))


def _mask(block: int) -> int:
    """The block's bits, as a signed long."""
    value = (1 << _BOUNDS[block + 1]) - (1 << _BOUNDS[block])
    return value - (1 << 64) if value >= 1 << 63 else value


def _blocks(f: str) -> Column:
    masks = F.array(*[F.struct(F.lit(b).alias("block"), F.lit(_mask(b)).cast("long").alias("mask")) for b in range(RADIUS + 1)])
    return F.explode(F.transform(masks, lambda m: F.struct(m["block"].alias("block"), F.col(f).bitwiseAND(m["mask"]).alias("bits"))))


def _first_agreeing(x: Column) -> Column:
    """The first block in which a difference ``x`` has no bit: a pair is taken there and nowhere else."""
    out = F.lit(None)
    for b in reversed(range(RADIUS + 1)):
        out = F.when(x.bitwiseAND(F.lit(_mask(b)).cast("long")) == 0, b).otherwise(out)
    return out


def _similarity(a: str, b: str) -> Column:
    """Weighted Jaccard similarity of two shingle arrays, a shingle's weight being its count."""
    both, x, y = F.array_intersect(a, b), F.col(a), F.col(b)
    plain = (F.size(F.array_distinct(x)) == F.size(x)) & (F.size(F.array_distinct(y)) == F.size(y))
    counted = F.aggregate(both, F.lit(0), lambda n, h: n + F.least(F.size(F.filter(x, lambda v: v == h)), F.size(F.filter(y, lambda v: v == h))))
    shared = F.when(plain, F.size(both)).otherwise(counted)
    return shared / (F.size(x) + F.size(y) - shared)


def _row(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col).cast("long"), F.col(text_col))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 similarity: float = SIMILARITY, by_row: bool = False) -> DataFrame:
    """``(doc_id, item_id, similarity, distance, start, size)``: each document and item of which a window reaches
    ``similarity``, with its most similar window (the first of equals): first word and word count.

    Benchmark rows are ``(item_id, text)``.  Null and empty texts and items
    match nothing; an item of fewer words than a shingle, or of more words than
    the document, is compared with documents as a whole; a null id is reported
    as null; repeated rows give one result; no rows give no rows.  ``by_row``
    returns only ``row``, the hash of id and text of every contaminated row.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), _shingled("text").alias("x")) \
        .select("item_id", F.col("x.n").alias("size"), F.col("x.s").alias("item")).where("size > 0").distinct()
    items = materialise(items.withColumn("f", _simhash(F.col("item"))), "items")
    # sizes of the items that hold a shingle: as many rows as the benchmark has words
    known = items.select("size", F.explode("item").alias("h")).groupBy("h").agg(F.collect_set("size").alias("sizes"))

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                        _row(id_col, text_col).alias("row"))
    places = texts.select("row", F.posexplode(_shingled("text").getField("s")).alias("at", "h")).join(known, "h")
    hits = materialise(places.select("row", "at", F.explode("sizes").alias("size")).groupBy("row", "size")
                       .agg(F.sort_array(F.collect_set("at")).alias("at")), "hits")
    shingled = materialise(texts.join(hits.select("row").distinct().hint("shuffle_hash"), "row")
                           .select("row", "doc_id", _shingled("text").alias("x")).select("row", "doc_id", "x.n", "x.s")
                           .dropDuplicates(["row"]), "shingled")

    # a window starts at most one window before a hit and behind the hit before; a short document is one window
    m, last = F.greatest(F.col("size") - SHINGLE + 1, F.lit(1)), F.greatest(F.col("n") - F.col("size"), F.lit(0))
    low = lambda p, i: F.greatest(p - m + 1, F.when(i > 0, F.get("at", i - 1) + 1).otherwise(0))
    starts = F.flatten(F.transform("at", lambda p, i: F.when(low(p, i) <= F.least(p, last), F.sequence(low(p, i), F.least(p, last)))
                                   .otherwise(F.array().cast("array<int>"))))
    windows = shingled.join(hits, "row").withColumn("start", F.explode(F.array_distinct(starts))) \
        .select("row", "size", "start", _let(F.slice("s", F.col("start") + 1, m), _simhash).alias("f"))
    asked = windows.select("row", "size", "start", "f", _blocks("f").alias("b")).select("row", "size", "start", "f", "b.block", "b.bits")
    index = items.select("item_id", "size", F.col("f").alias("g"), _blocks("f").alias("b")).select("item_id", "size", "g", "b.block", "b.bits")
    x = F.col("f").bitwiseXOR(F.col("g"))
    near = asked.join(index, ["size", "block", "bits"]).where((F.bit_count(x) <= RADIUS) & (_first_agreeing(x) == F.col("block"))) \
        .select("row", "item_id", "size", "start", F.bit_count(x).alias("distance"))

    checked = near.join(shingled, "row").withColumn("window", F.slice("s", F.col("start") + 1, m)) \
        .select("row", "doc_id", "item_id", "size", "start", "distance", "window") \
        .join(items.select("item_id", "size", "item"), ["item_id", "size"]).withColumn("similarity", _similarity("window", "item")) \
        .where(F.col("similarity") >= similarity)
    if by_row:
        return checked.select("row").distinct()
    best = checked.groupBy("doc_id", "item_id").agg(
        F.max(F.struct("similarity", (-F.col("start")).alias("back"), (-F.col("distance")).alias("near"), "size")).alias("b"))
    return best.select("doc_id", "item_id", "b.similarity", (-F.col("b.near")).alias("distance"), (-F.col("b.back")).alias("start"), "b.size")


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that ``contaminated`` finds; all columns, null ids included."""
    found = contaminated(docs, benchmark, id_col, text_col, by_row=True)
    return docs.join(found.withColumnRenamed("row", "__row"), _row(id_col, text_col) == F.col("__row"), "left_anti")
