"""Operator 13: the tokens of two tokenizers aligned by merge-path partitioning.

Both tokenizers cut the same bytes, so aligning them is merging two rising
lists of token end offsets.  The merge of all documents of a task is one path;
it is cut at every ``PIECE_STEPS``-th step, and a document that lies across a
cut is divided there by a binary search along the path's diagonal.  Pieces are
rows of equal work that need nothing of each other: each finds the overlaps
that end in it.  Groups that lie across a cut are stitched together from the
pieces' loose ends.

Counts of id pairs are added up by Spark.  They come back to the pieces in a
broadcast table while its measured size is within ``TABLE_BYTES``, and joined
to each piece's own pairs beyond that.
"""

from __future__ import annotations

import os
import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_dir
from .common import claim, give_back, materialise, prepare, utf8
from .tokens import BYTE_LEVEL, LETTERS, PUNCTUATION, Encoder, id_type

#: Characters of a word from which it goes to the tokenizer's own library, whose merging doesn't slow down.
LONG_WORD = 500
#: Merge steps (tokens of both sides) in a piece; bytes of pair counts that are broadcast at most, at 17 a pair.
PIECE_STEPS, TABLE_BYTES = 1 << 20, 32 << 20

PIECES = ("piece long, cut boolean, rows array<bigint>, doc_ids array<bigint>, n_a array<bigint>, n_b array<bigint>, "
          "base_a long, base_b long, a binary, b binary, pairs array<bigint>, counts array<bigint>")
_PIECES = pa.schema([("piece", pa.int64()), ("cut", pa.bool_()), ("rows", pa.list_(pa.int64())), ("doc_ids", pa.list_(pa.int64())),
                     ("n_a", pa.list_(pa.int64())), ("n_b", pa.list_(pa.int64())), ("base_a", pa.int64()), ("base_b", pa.int64()),
                     ("a", pa.binary()), ("b", pa.binary()), ("pairs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])
ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"
#: A cut document's part: its loose ends before the first and after the last common offset, and the whole groups between.
PARTS = ALIGNED.replace("groups string", "row long, piece long, head array<string>, body string, tail array<string>")
_ALIGNED = pa.schema([(x.split()[0], pa.string() if x.endswith("string") else pa.int64()) for x in ALIGNED.split(", ")])
_PARTS = pa.schema([*list(_ALIGNED)[:-1], ("row", pa.int64()), ("piece", pa.int64()), ("head", pa.list_(pa.string())),
                    ("body", pa.string()), ("tail", pa.list_(pa.string()))])
_SUMS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


class Vocabularies:
    """Both tokenizers in a worker: ids of texts, and the bytes and decimal names of ids."""

    _open: dict[tuple[str, str], Vocabularies] = {}

    @classmethod
    def of(cls, path_a: str, path_b: str) -> Vocabularies:
        claim("alignment", cls._open)
        if (path_a, path_b) not in cls._open:
            cls._open.clear()
            cls._open[path_a, path_b] = cls(path_a, path_b)
        return cls._open[path_a, path_b]

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(path_a)
        self.type_a = id_type(path_a)
        self.a = Encoder(path_a, self.type_a)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.type_b = "<u2" if self.b.get_piece_size() <= 1 << 16 else "<u4"
        byte = {chr(c): b for b, c in BYTE_LEVEL.items()} | {chr(b): b for b in range(256) if b not in BYTE_LEVEL}
        names = [whole.id_to_token(i) or "" for i in range(whole.get_vocab_size(with_added_tokens=True))]
        self.bytes_a = [bytes(byte[c] for c in x) if all(c in byte for c in x) else x.encode() for x in names]
        self.bytes_b = [self._piece(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]
        self.len_a = np.array([len(x) for x in self.bytes_a], np.int32)
        self.len_b = np.array([len(x) for x in self.bytes_b], np.int32)
        solid = f"[{LETTERS}0-9{PUNCTUATION}\n]{{0,{LONG_WORD}}}+"
        self.plain = re.compile(f"(?:{solid} )*+{solid}").fullmatch
        self.ranks = self._ranks(whole)
        # decimal ids with what follows them: inside a side, at its end, and at the end of a text
        names = [f"{i}{end}" for n, ends in ((len(self.bytes_a), ",|"), (len(self.bytes_b), ",;")) for end in ends for i in range(n)]
        names += [str(i) for i in range(len(self.bytes_b))]
        self.name_lengths = np.array([len(x) for x in names], np.int32)
        self.names = np.array(names, "S").view(np.uint8).reshape(len(names), -1)  # padded with zero bytes

    def _ranks(self, whole):
        """The byte-level model for plain texts, where it merges in the order of its ids and cuts words as its library does; else None."""
        import json

        import public_tokenizers
        import tiktoken

        spec = json.loads(whole.to_str())
        ids = whole.get_vocab(with_added_tokens=False)
        merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "", 1) for m in spec["model"]["merges"]]
        order = [ids[m] for m in merged]
        cuts = spec["pre_tokenizer"] or {}
        if spec["normalizer"] or order != sorted(order) or cuts.get("type") != "ByteLevel" or cuts.get("add_prefix_space") or not cuts.get("use_regex", True):
            return None
        if {bytes([b]) for b in range(256)} - set(self.bytes_a) or any(ids[x] > order[0] for x in ids if len(x) == 1):
            return None
        return tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks={self.bytes_a[i]: i for i in ids.values() if self.bytes_a[i]}, special_tokens={})

    @staticmethod
    def _piece(piece: str) -> bytes:
        if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both sides, or None where a side doesn't give the text's bytes back."""
        whole, b = " " + text, self.b.encode(text)
        if b"".join([self.bytes_b[i] for i in b]) != whole.encode():
            return None
        if self.ranks and self.plain(text):
            a = np.array(self.ranks.encode_ordinary(whole), self.type_a)
        else:
            a = np.frombuffer(self.a.encode(whole), self.type_a)
        # the byte-level side cuts the very bytes, so their number tells
        return (a, np.array(b, self.type_b)) if int(self.len_a[a].sum()) == len(whole.encode()) else None


def diagonal(a: np.ndarray, b: np.ndarray, step: int) -> tuple[int, int]:
    """How many of the rising ends ``a`` and ``b`` the first ``step`` merge steps take (``a`` first where both are equal; an
    equal pair is never divided, so it may be a step more)."""
    low, high = max(0, step - len(b)), min(step, len(a))
    while low < high:
        mid = (low + high) // 2
        if a[mid] <= b[step - mid - 1]:
            low = mid + 1
        else:
            high = mid
    i, j = low, step - low
    return (i, j + 1) if i and j < len(b) and a[i - 1] == b[j] else (i, j)


def _planes(ids: np.ndarray) -> bytes:
    """Ids byte by byte, low bytes first, which compresses better."""
    return ids.view(np.uint8).reshape(-1, ids.itemsize).T.tobytes()


def _from_planes(raw: bytes, dtype: str) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, -1).T).view(dtype).reshape(-1)


def cut_pieces(docs: DataFrame, path_a: str, path_b: str, id_col: str, text_col: str, steps: int) -> DataFrame:
    """Rows of ``PIECES``: the whole documents between two cuts, or the part of a cut document between two cuts.

    A part's ids are those that end in it, and the next one of either side.
    ``pairs`` and ``counts``: the id pairs of the piece's overlaps.
    """
    prepare(docs.sparkSession)

    def cut(tables):
        words = Vocabularies.of(path_a, path_b)
        task, row, at, number = TaskContext.get().partitionId(), 0, 0, 0
        held: list[tuple] = []
        none = np.zeros(0, words.type_a), np.zeros(0, words.type_b)

        def close(split, rows, names, n_a, n_b, base_a, base_b, a, b):
            nonlocal number
            number += 1
            o = Overlaps(words, a, b, sum(n_a), sum(n_b), base_a, base_b)
            values = ((task << 33) + number, split, rows, names, n_a, n_b, base_a, base_b, _planes(a), _planes(b), *o.distinct())
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _PIECES, strict=True)], schema=_PIECES)

        def whole():
            out = close(False, [x[0] for x in held], [x[1] for x in held], [len(x[2]) for x in held], [len(x[3]) for x in held], 0, 0,
                        np.concatenate([x[2] for x in held]), np.concatenate([x[3] for x in held]))
            held.clear()
            return out

        for batch in tables:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a, b = (words.encode(text.decode("utf-8", "replace")) if text else None) or none
                row, end = row + 1, at + len(a) + len(b)
                key = (task << 33) + row
                if at // steps == max(end - 1, at) // steps:
                    held.append((key, name, a, b))
                    if len(held) >= 50_000 or end % steps == 0:
                        yield whole()
                else:
                    if held:
                        yield whole()
                    ends_a, ends_b = np.cumsum(words.len_a[a]), np.cumsum(words.len_b[b])
                    i = j = 0
                    for edge in [*range((at // steps + 1) * steps - at, len(a) + len(b), steps), len(a) + len(b)]:
                        k, l = diagonal(ends_a, ends_b, edge)  # noqa: E741
                        yield close(True, [key], [name], [k - i], [l - j], int(ends_a[i - 1]) if i else 0, int(ends_b[j - 1]) if j else 0,
                                    a[i: k + 1], b[j: l + 1])
                        i, j = k, l
                at = end
            give_back()
        if held:
            yield whole()

    source = docs.select(F.col(id_col).cast("long"), utf8(text_col))
    return source.mapInArrow(cut, PIECES)


class Overlaps:
    """The overlaps of a piece, given its ids and how many of them end in it: ``pairs_a``, one for the end of every A token, and ``pairs_b``, for every B end that is no A end."""

    def __init__(self, words: Vocabularies, a: np.ndarray, b: np.ndarray, n_a: int, n_b: int, base_a: int, base_b: int):
        self.a, self.b, self.n_a, self.n_b = a.astype(np.int64), b.astype(np.int64), n_a, n_b
        width = len(words.bytes_b)
        # offsets from the piece's first byte, which small integers hold
        low = min(base_a, base_b)
        ends_a = np.cumsum(words.len_a[a[:n_a]], dtype=np.int32) + np.int32(base_a - low)
        ends_b = np.cumsum(words.len_b[b[:n_b]], dtype=np.int32) + np.int32(base_b - low)
        first_b = np.searchsorted(ends_b, ends_a)  # the B token that an A end lies in; beyond the piece the next one
        self.common_a, self.common_b = np.zeros(self.n_a, bool), np.zeros(self.n_b, bool)
        inside = first_b < self.n_b
        self.common_a[inside] = ends_b[first_b[inside]] == ends_a[inside]
        self.common_b[first_b[self.common_a]] = True
        self.only_b = np.flatnonzero(~self.common_b)
        first_a = np.searchsorted(ends_a, ends_b[self.only_b])
        self.pairs_a = self.a[:n_a] * width + self.b[first_b]
        self.pairs_b = self.a[first_a] * width + self.b[self.only_b]

    def names(self, words: Vocabularies, last: np.ndarray) -> np.ndarray:
        """The ids that end in the piece as numbers of names, group by group, A before B; ``last``: B tokens that end a text."""
        group_a = np.cumsum(self.common_a) - self.common_a
        group_b = np.cumsum(self.common_b) - self.common_b
        firsts_b = np.append(0, np.flatnonzero(self.common_b) + 1)  # first B token of each group
        ends_a = np.append(np.flatnonzero(self.common_a) + 1, self.n_a)  # A tokens up to each group's end
        size_a, size_b = len(words.bytes_a), len(words.bytes_b)
        name_b = self.b[: self.n_b] + size_b * self.common_b
        name_b[last] += size_b
        out = np.empty(self.n_a + self.n_b, np.int64)
        out[np.arange(self.n_a) + firsts_b[group_a]] = self.a[: self.n_a] + size_a * self.common_a
        out[np.arange(self.n_b) + ends_a[group_b]] = name_b + 2 * size_a
        return out

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        return np.unique(np.concatenate([self.pairs_a, self.pairs_b]), return_counts=True)


def spell(words: Vocabularies, names: np.ndarray, edges: np.ndarray) -> pa.Array:
    """Texts made of the names between each two edges."""
    raw = words.names[names].reshape(-1)
    ends = np.concatenate([[0], np.cumsum(words.name_lengths[names], dtype=np.int64)])[edges]
    return pa.StringArray.from_buffers(len(edges) - 1, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(raw[raw != 0]))


class Counts:
    """Corpus counts of id pairs, found by a table of their hashes; pairs that share a place are searched."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, best: np.ndarray):
        self.keys, self.counts, self.best = keys, counts, best
        self.shift = np.uint64(64 - max(16, int(len(keys)).bit_length() + 5))
        self.place = np.zeros(1 << (64 - int(self.shift)), np.int32)
        self.place[self._hash(keys)] = np.arange(len(keys))

    def _hash(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def find(self, keys: np.ndarray) -> np.ndarray:
        at = self.place[self._hash(keys)]
        miss = np.flatnonzero(self.keys[at] != keys) if len(keys) else np.zeros(0, np.int64)
        at[miss] = np.searchsorted(self.keys, keys[miss])
        return at


def _sums(row: dict, o: Overlaps, table: Counts) -> dict[str, np.ndarray]:
    """Per document of the piece: its sums, given the corpus counts of id pairs."""
    edges_a, edges_b = np.cumsum([0, *row["n_a"]]), np.cumsum([0, *row["n_b"]])

    def between(values, edges):
        total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        return total[edges[1:]] - total[edges[:-1]]

    at_a, at_b = table.find(o.pairs_a), table.find(o.pairs_b)
    only_b = np.searchsorted(o.only_b, edges_b)
    n_a, n_b, groups = np.diff(edges_a), np.diff(edges_b), between(o.common_a, edges_a)
    return {"n_a": n_a, "n_b": n_b, "n_groups": groups, "n_links": n_a + n_b - groups,
            "n_best": between(table.best[at_a], edges_a) + between(table.best[at_b], only_b),
            "count_sum": between(table.counts[at_a], edges_a) + between(table.counts[at_b], only_b)}


def _score(words: Vocabularies, row: dict, table: Counts) -> pa.Table:
    """A piece's documents, or a cut document's part with its loose ends."""
    o = Overlaps(words, _from_planes(row["a"], words.type_a), _from_planes(row["b"], words.type_b), sum(row["n_a"]), sum(row["n_b"]), row["base_a"], row["base_b"])
    sums = _sums(row, o, table)
    values = {"doc_id": row["doc_ids"], **sums}
    if not row["cut"]:
        lasts = np.cumsum(row["n_b"])[np.array(row["n_b"]) > 0] - 1
        values["groups"] = spell(words, o.names(words, lasts), np.cumsum(np.concatenate([[0], sums["n_a"] + sums["n_b"]])))
    else:
        names = o.names(words, np.zeros(0, np.int64))
        text = lambda s, e: spell(words, names[s:e], np.array([0, e - s]))[0].as_py()
        common_a, common_b = np.flatnonzero(o.common_a), np.flatnonzero(o.common_b)
        n, closed = len(names), len(common_a) > 0
        first, last = (int(common_a[k] + common_b[k]) + 2 if closed else n for k in (0, -1))  # names up to the first and to the last common offset
        head_a, tail_a = (int(common_a[0]) + 1, last + o.n_a - int(common_a[-1]) - 1) if closed else (o.n_a, n)
        # a side's part is its ids with commas, as its group isn't whole here
        values |= {"row": row["rows"], "piece": [row["piece"]], "body": [text(first, last)], "tail": [[text(last, tail_a), text(tail_a, n)]],
                   "head": [[text(0, head_a).replace("|", ","), text(head_a, first).replace(";", ","), "closed" if closed else "open"]]}
    return pa.table({f.name: pa.array(values[f.name], f.type) for f in (_PARTS if row["cut"] else _ALIGNED)})


def stitch(parts: list[dict]) -> dict:
    """A cut document from its parts in order."""
    a = b = ""
    out = []
    for p in parts:
        a, b = a + p["head"][0], b + p["head"][1]
        if p["head"][2] == "closed":
            out.append(f"{a[:-1]}|{b[:-1]};{p['body']}")
            a, b = p["tail"]
    return {"doc_id": parts[0]["doc_id"], **{c: sum(p[c] for p in parts) for c in _SUMS}, "groups": "".join(out)[:-1]}


def _stitch(table):
    whole = stitch(sorted(table.to_pylist(), key=lambda r: r["piece"]))
    return pa.table({f.name: pa.array([whole[f.name]], f.type) for f in _ALIGNED})


def piece_vocabulary(path: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path).get_piece_size()


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
          steps: int = PIECE_STEPS, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """``ALIGNED`` for every row: a byte-level vocabulary ``path_a`` on space and text, a sentencepiece model ``path_b`` on the text.

    A group ends at every byte offset where a token of either side ends;
    ``groups`` is ``a1,a2|b1;a3|b2,b3`` in decimal ids.  A link is a pair of
    overlapping tokens, ``count_sum`` adds up how many links of all rows have
    the link's ids, and ``n_best`` counts the links whose count is the highest
    of their B id.  Null and empty texts, and texts that a side doesn't give
    back byte for byte, have no tokens: zeros and ``''``.  Repeated rows count
    and appear as often as they occur; a null id stays null; no rows give none.
    """
    spark = docs.sparkSession
    path = f"{shared_dir(spark)}/lapsewise-llm/pieces-{uuid.uuid4().hex}"
    cut_pieces(docs, path_a, path_b, id_col, text_col, steps).write.option("compression", "zstd").parquet(path)
    pieces = spark.read.schema(PIECES).parquet(path)

    bodies = pieces.drop("pairs", "counts")
    width = F.lit(piece_vocabulary(path_b))
    asked = pieces.select("piece", F.inline(F.arrays_zip("pairs", "counts")).alias("pair", "n"))
    counts = materialise(asked.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("b", F.col("pair") % width), "pair-counts")
    highest = counts.groupBy("b").agg(F.max("n").alias("top"))
    found = counts.join(highest, "b").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))
    if counts.count() * 17 <= table_bytes:
        rows = found.orderBy("pair").toArrow()
        table = spark.sparkContext.broadcast(tuple(rows[c].to_numpy() for c in ("pair", "n", "best")))

        def scored(wanted, schema):
            def score(tables):
                words, counts = Vocabularies.of(path_a, path_b), Counts(*table.value)
                for batch in tables:
                    for row in batch.to_pylist():
                        yield from _score(words, row, counts).to_batches()
                    give_back()
            return bodies.where(F.col("cut") == wanted).mapInArrow(score, schema)
    else:
        answers = asked.select("piece", "pair").join(found, "pair").select(F.col("piece").alias("of"), "pair", "n", "best")

        def scored(wanted, schema):
            def score(piece, got):
                if not piece.num_rows:
                    return (_PARTS if wanted else _ALIGNED).empty_table()
                words, got = Vocabularies.of(path_a, path_b), got.sort_by("pair")
                return _score(words, piece.to_pylist()[0], Counts(*(got[c].to_numpy() for c in ("pair", "n", "best"))))
            return bodies.where(F.col("cut") == wanted).groupBy("piece").cogroup(answers.groupBy("of")).applyInArrow(score, schema)

    return scored(False, ALIGNED).union(scored(True, PARTS).groupBy("row").applyInArrow(_stitch, ALIGNED))
