"""Operator 12: phrase collocations of every language, by tiles of frequency-ranked id pairs.

1. Chunks of whole texts become codes of their distinct words, once, and are written.
2. Words met ``min_count`` times or more get ids in the order of their counts.
3. A phrase of k + 1 words is a pair of overlapping phrases of k words (for
   k = 1, of adjacent words), each given by its id.  Ids are cut into blocks of
   equal count mass, so the pairs of one block and another, a tile, are about
   as many in every tile.  Each chunk counts its pairs and sends every tile its
   sorted distinct ones; a tile of few cells adds them up in a dense array
   (``np.bincount``), a tile of many cells as sorted coordinates.
4. Frequent pairs are ranked by count again, get ids, go back to the chunks that
   sent them, and are the next level's units.

A pair can be frequent only if both its parts are, so no other pairs are sent.
Words are told apart by their text and phrases by ids; no hash stands for either.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import ordered
from ..session import shared_dir
from .common import claim, give_back, materialise, prepare, shuffle_partitions, utf8

#: Bytes of text in a chunk; bytes split at once; pair occurrences a tile has on average; cells of the largest dense tile.
CHUNK_BYTES, SPLIT_BYTES, TILE_PAIRS, DENSE_CELLS = 12 << 20, 4 << 20, 1 << 18, 1 << 22
#: No word, or one too rare: nothing that holds it can be frequent.
GAP = -1

# Fixed values of the contract: piece ends, and the language of rows without one.
PIECE_ENDS, NO_LANG = b".,;:!?\n\x0b\x0c\r", "und"
_MARK = b"\xff"  # never a byte of UTF-8
_TABLE = bytes(0xFF if b in PIECE_ENDS else 0x20 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))

CODED = "chunk long, lang string, n_words long, words array<string>, counts array<bigint>, codes binary"
UNITS = "chunk long, units binary"
SENT = "tile long, chunk long, cells binary, counts binary"
FOUND = "tile long, left long, right long, n long"
REPLY = "chunk long, pairs binary, ids binary"
_CODED = pa.schema([("chunk", pa.int64()), ("lang", pa.string()), ("n_words", pa.int64()), ("words", pa.list_(pa.string())),
                    ("counts", pa.list_(pa.int64())), ("codes", pa.binary())])
_NO_UNITS = pa.schema([("chunk", pa.int64()), ("units", pa.binary())]).empty_table()
_NO_REPLY = pa.schema([("chunk", pa.int64()), ("pairs", pa.binary()), ("ids", pa.binary())]).empty_table()


def words_of(text: bytes):
    """Lower-cased words of a text in order, ``b"\\xff"`` standing for the ends of pieces; a bounded part at a time."""
    text, at = text.translate(_TABLE), 0
    while at < len(text):
        end = at + SPLIT_BYTES
        if end < len(text):
            cut = max(text.rfind(b" ", at, end), text.rfind(_MARK, at, end))
            if cut <= at:  # one word fills the part
                cuts = [c for c in (text.find(b" ", end), text.find(_MARK, end)) if c >= 0]
                cut = min(cuts, default=len(text))
            end = cut
        # space, tab and marks are the only ASCII white space left, so split() cuts at nothing else
        yield text[at:end].replace(_MARK, b" \xff ").split()
        at = end


class _Codes(dict):
    """Codes of words by their first meeting."""

    def __missing__(self, word):
        code = self[word] = len(self) - 1
        return code


class _Coder:
    """Words of one language in a chunk, coded."""

    def __init__(self):
        self.codes, self.parts = _Codes({_MARK: GAP}), []

    def add(self, text: bytes) -> None:
        for words in words_of(text):
            self.parts.append(np.fromiter(map(self.codes.__getitem__, words), np.int32, len(words)))
        self.parts.append(np.array([GAP], np.int32))


def code_chunks(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """Rows of ``CODED``, one per chunk and language."""
    prepare(docs.sparkSession)

    def code(tables):
        claim("collocations")
        task, number, held, coders = TaskContext.get().partitionId(), 0, 0, {}

        def close():
            nonlocal number
            rows = []
            for lang, coder in coders.items():
                codes = np.concatenate(coder.parts)
                words = [w for w in coder.codes if w != _MARK]
                counts = np.bincount(codes[codes >= 0], minlength=len(words))
                rows.append(((task << 32) + number, lang, int(counts.sum()), [w.decode("utf-8", "replace") for w in words], counts, codes.tobytes()))
                number += 1
            coders.clear()
            for r in rows:
                yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(r, _CODED, strict=True)], schema=_CODED)
            give_back()

        for b in tables:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if lang not in coders:
                    coders[lang] = _Coder()
                coders[lang].add(text)
                held += len(text)
                if held >= CHUNK_BYTES:
                    yield from close()
                    held = 0
        yield from close()

    return docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG)), utf8(text_col)).mapInArrow(code, CODED)


def _edges(ranked: DataFrame, blocks: int) -> np.ndarray:
    """First ids of blocks of about equal count mass, and the number of ids; at most ``blocks`` + 1 numbers reach the driver."""
    sums = ordered.running(ranked.select("id", "n"), ["id"], "n", "before")
    total, count = ranked.agg(F.sum("n"), F.count("*")).first()
    if not count:
        return np.array([0, 0], np.int64)
    block = F.floor(F.col("before").cast("double") * blocks / total)
    firsts = sums.groupBy(block.alias("b")).agg(F.min("id").alias("id")).collect()
    return np.array([*sorted(r["id"] for r in firsts), count], np.int64)


def _pair_keys(units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose unit and the next one's are both there, and the two ids as one key."""
    at = np.flatnonzero((units[:-1] >= 0) & (units[1:] >= 0))
    return at, units[at].astype(np.uint64) << np.uint64(32) | units[at + 1].astype(np.uint64)


class _Tiles:
    """The grid of tiles over blocks of ids, and the cells inside them."""

    def __init__(self, edges: np.ndarray):
        self.edges, self.blocks = edges, len(edges) - 1

    def block(self, ids: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.edges, ids, "right") - 1

    def split(self, keys: np.ndarray):
        """``(tile, order)``: the tile of each key, and the stable order that groups keys by tile."""
        left, right = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
        bl, br = self.block(left), self.block(right)
        cell = (left - self.edges[bl]) * (self.edges[br + 1] - self.edges[br]) + (right - self.edges[br])
        return bl * self.blocks + br, cell

    def sides(self, tile: int) -> tuple[int, int, int, int]:
        """First id and number of ids, on the left and on the right."""
        a, b = divmod(tile, self.blocks)
        return self.edges[a], self.edges[a + 1] - self.edges[a], self.edges[b], self.edges[b + 1] - self.edges[b]


def _planes(values: np.ndarray) -> bytes:
    """Unsigned 64-bit values byte by byte: high bytes hardly change, so compression removes them."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _from_planes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view("<u8").reshape(-1).astype(np.int64)


def _send(edges: np.ndarray, with_counts: bool):
    """A chunk's distinct pairs, sorted, a row per tile."""
    def send(tables):
        claim("collocations")
        grid = _Tiles(edges)
        for b in tables:
            for chunk, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                keys, counts = np.unique(_pair_keys(np.frombuffer(raw, np.int32))[1], return_counts=True)
                tile, cell = grid.split(keys)
                order = np.argsort(tile, kind="stable")
                tiles, starts = np.unique(tile[order], return_index=True)
                ends = np.append(starts[1:], len(order))
                cell, counts = cell[order], counts[order]
                for i in range(0, len(tiles), 256):
                    part = list(zip(tiles[i: i + 256].tolist(), starts[i: i + 256].tolist(), ends[i: i + 256].tolist(), strict=True))
                    yield pa.RecordBatch.from_pydict({
                        "tile": pa.array([t for t, _, _ in part], pa.int64()), "chunk": pa.array([chunk] * len(part), pa.int64()),
                        "cells": pa.array([_planes(cell[s:e]) for _, s, e in part], pa.binary()),
                        "counts": pa.array([_planes(counts[s:e]) if with_counts else b"" for _, s, e in part], pa.binary())})
                give_back()
    return send


def _add_up(edges: np.ndarray, min_count: int):
    """A tile's pairs of ``min_count`` or more occurrences."""
    def add(sent):
        tile = sent["tile"][0].as_py()
        left, height, right, width = (int(x) for x in _Tiles(edges).sides(tile))
        cells = np.concatenate([_from_planes(x) for x in sent["cells"].to_pylist()])
        counts = np.concatenate([_from_planes(x) for x in sent["counts"].to_pylist()])
        if height * width <= DENSE_CELLS and int(counts.sum()) < 1 << 53:  # the sums in doubles are exact below that
            total = np.bincount(cells, weights=counts, minlength=height * width)
            cells = np.flatnonzero(total >= min_count)
            counts = total[cells].astype(np.int64)
        else:
            order = np.argsort(cells, kind="stable")
            cells, starts = np.unique(cells[order], return_index=True)
            counts = np.add.reduceat(counts[order], starts)
            cells, counts = cells[counts >= min_count], counts[counts >= min_count]
        return pa.table({"tile": pa.array(np.full(len(cells), tile), pa.int64()), "left": pa.array(left + cells // width, pa.int64()),
                         "right": pa.array(right + cells % width, pa.int64()), "n": pa.array(counts, pa.int64())})
    return add


def _answer(edges: np.ndarray):
    """The ids of a tile's frequent pairs, to every chunk that has sent them."""
    def answer(sent, found):
        if not sent.num_rows or not found.num_rows:
            return _NO_REPLY
        tile = sent["tile"][0].as_py()
        left, _, right, width = (int(x) for x in _Tiles(edges).sides(tile))
        l, r, ids = (found[c].to_numpy() for c in ("left", "right", "id"))  # noqa: E741
        known = (l - left) * width + (r - right)
        order = np.argsort(known)
        known, ids = known[order], ids[order]
        rows = []
        for chunk, raw in zip(sent["chunk"].to_pylist(), sent["cells"].to_pylist(), strict=True):
            cells = _from_planes(raw)
            at = np.minimum(np.searchsorted(known, cells), len(known) - 1)
            hit = known[at] == cells
            if hit.any():
                got = cells[hit]
                pairs = (left + got // width).astype(np.uint64) << np.uint64(32) | (right + got % width).astype(np.uint64)
                rows.append((chunk, _planes(pairs), ids[at[hit]].astype("<i4").tobytes()))
        return pa.table({"chunk": pa.array([x[0] for x in rows], pa.int64()), "pairs": pa.array([x[1] for x in rows], pa.binary()),
                         "ids": pa.array([x[2] for x in rows], pa.binary())})
    return answer


def _rename(units, reply):
    """A chunk's next units: the id of the pair that begins at each place."""
    if not units.num_rows:
        return _NO_UNITS
    now = np.frombuffer(units["units"][0].as_py(), np.int32)
    at, keys = _pair_keys(now)
    out = np.full(max(len(now) - 1, 0), GAP, np.int32)
    if reply.num_rows:
        pairs = np.concatenate([_from_planes(x) for x in reply["pairs"].to_pylist()]).astype(np.uint64)
        ids = np.concatenate([np.frombuffer(x, "<i4") for x in reply["ids"].to_pylist()])
        order = np.argsort(pairs)
        pairs, ids = pairs[order], ids[order]
        place = np.minimum(np.searchsorted(pairs, keys), len(pairs) - 1)
        out[at] = np.where(pairs[place] == keys, ids[place], GAP)
    return pa.table({"chunk": units["chunk"], "units": pa.array([out.tobytes()], pa.binary())})


def _encode(coded, mapping):
    """A chunk's word ids at every place."""
    if not coded.num_rows:
        return _NO_UNITS
    codes = np.frombuffer(coded["codes"][0].as_py(), np.int32)
    ids = np.full(int(codes.max(initial=-1)) + 2, GAP, np.int32)  # the last entry is that of gaps
    ids[mapping["code"].to_numpy()] = mapping["id"].to_numpy()
    return pa.table({"chunk": coded["chunk"], "units": pa.array([ids[codes].tobytes()], pa.binary())})


def _written(df: DataFrame, label: str) -> DataFrame:
    """As ``materialise``, in the codec that makes most of repeated ids."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/lapsewise-llm/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _apart(df: DataFrame) -> DataFrame:
    """The same columns under new ids, for a cogroup with rows of the same origin."""
    return df.select(*[F.col(c).alias(c) for c in df.columns])


def _ids(counts: DataFrame, order: list) -> DataFrame:
    """``counts`` with ``id``, the row's number by falling ``n``."""
    got = materialise(ordered.ranked(materialise(counts, "counts"), [F.col("n").desc(), *order], "id"), "ranked")
    if got.count() >= 1 << 31:
        raise ValueError("over 2**31 frequent phrases of one length")
    return got


def count_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = 30,
                  max_words: int = 4) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """``(totals, words, levels)``: ``totals`` is (lang, n), all word occurrences; ``words`` (id, lang, word, n) the
    frequent words; ``levels[k]`` (left, right, n and, but for the last, id) the frequent phrases of k + 2 words, each
    as the ids of its first and last k + 1 words.

    Null texts are empty; a null language is ``und``; repeated rows count as
    often as they occur; phrases never cross a piece or a document.
    """
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    coded = _written(code_chunks(docs, text_col, lang_col), "coded")
    totals = coded.groupBy("lang").agg(F.sum("n_words").alias("n"))
    each = coded.select("chunk", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("code", "x")) \
        .select("chunk", "lang", "code", F.col("x.words").alias("word"), F.col("x.counts").alias("n"))
    frequent = each.groupBy("lang", "word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
    words = _ids(frequent, ["lang", "word"])
    mapping = each.select("chunk", "lang", "code", "word").join(words.select("lang", "word", "id"), ["lang", "word"]).select("chunk", "code", "id")
    units = _written(coded.select("chunk", "codes").groupBy("chunk").cogroup(_apart(mapping).groupBy("chunk")).applyInArrow(_encode, UNITS), "units")
    occurrences = totals.agg(F.sum("n")).first()[0] or 0
    blocks = int(np.ceil(np.sqrt(max(occurrences / TILE_PAIRS, 4 * parts))))
    ranked, levels = words, []
    for size in range(2, max_words + 1):
        edges = _edges(ranked, blocks)
        sent = units.mapInArrow(_send(edges, True), SENT)
        found = sent.groupBy("tile").applyInArrow(_add_up(edges, min_count), FOUND)
        if size == max_words:
            levels.append(materialise(found, "found").drop("tile"))
            break
        ranked = _ids(found, ["left", "right"])
        levels.append(ranked.drop("tile"))
        asked = units.mapInArrow(_send(edges, False), SENT)
        replies = asked.groupBy("tile").cogroup(_apart(ranked).groupBy("tile")).applyInArrow(_answer(edges), REPLY)
        units = _written(units.groupBy("chunk").cogroup(_apart(replies).groupBy("chunk")).applyInArrow(_rename, UNITS), "units")
    return totals, words, levels


def _spelled(words: DataFrame, levels: list[DataFrame]) -> list[DataFrame]:
    """Each level with ``lang``, ``phrase`` and ``f``: the counts of its beginnings and of its ends, by their words."""
    w = words.select("id", "lang", F.col("word").alias("phrase"), F.array("n").alias("firsts"), F.array("n").alias("lasts"), F.col("word").alias("last"))
    out = []
    for number, level in enumerate(levels):
        a = w.select(F.col("id").alias("left"), "lang", F.col("phrase").alias("head"), "firsts")
        b = w.select(F.col("id").alias("right"), "last", "lasts")
        whole = level.join(a, "left").join(b, "right")
        # firsts[i]: count of the first i + 1 words; lasts[i]: of the last i + 1 words
        spelled = whole.withColumns({"phrase": F.concat_ws(" ", "head", "last"), "firsts": F.concat("firsts", F.array("n")),
                                     "lasts": F.concat("lasts", F.array("n"))}).drop("head")
        if number < len(levels) - 1:
            spelled = materialise(spelled, "spelled")
            w = spelled.select("id", "lang", "phrase", "firsts", "lasts", "last")
        out.append(spelled)
    return out


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = 30, max_words: int = 4,
                 top: int = 2000, covered: int = 80) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's ``top`` phrases of 2 to ``max_words`` words.

    ``a`` counts the phrase; of its cuts in two parts counted ``l`` and ``r``
    times the one with the least score, floor(2,000,000 a / (l + r)), counts
    (ties: the shortest first part).  A phrase inside one longer by a word that
    has ``covered`` % or more of its count goes (a longer phrase's count is no
    higher than those of the phrases between, so these decide).  Order: score
    and ``a`` falling, then the phrase in UTF-8 bytes.  No rows give no rows.
    """
    totals, words, levels = count_phrases(docs, text_col, lang_col, min_count, max_words)
    kept = []
    spelled = _spelled(words, levels)
    for number, level in enumerate(spelled):
        if number < len(spelled) - 1:
            longer = spelled[number + 1]
            most = longer.select(F.col("left").alias("id"), F.col("n").alias("m")).union(longer.select("right", "n")) \
                .groupBy("id").agg(F.max("m").alias("most"))
            wide = [F.col(c).cast("decimal(38,0)") for c in ("most", "n")]
            level = level.join(most, "id", "left").where(F.col("most").isNull() | (wide[0] * 100 < wide[1] * covered))
        size = number + 2
        cuts = F.array(*[F.struct(
            F.expr(f"2000000 * CAST(n AS DECIMAL(30,0)) div (CAST(firsts[{k - 1}] AS DECIMAL(30,0)) + lasts[{size - k - 1}])").alias("score"),
            F.lit(k).alias("k"), F.expr(f"firsts[{k - 1}]").alias("l"), F.expr(f"lasts[{size - k - 1}]").alias("r")) for k in range(1, size)])
        kept.append(level.select("lang", "phrase", F.col("n").alias("a"), F.array_min(cuts).alias("cut")))
    found = kept[0]
    for level in kept[1:]:
        found = found.union(level)
    found = found.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top).join(totals, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score")))
