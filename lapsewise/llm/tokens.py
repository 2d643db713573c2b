"""Token ids of whole texts with the tokenizers library, a distinct piece at a time.

Byte-pair encoding works inside pre-tokens, so a text may be cut between
pre-tokens and the parts encoded alone.  Texts are cut before every space that
follows a non-space; each distinct part is encoded once per worker and kept in
a bounded cache.  Parts made of plain letters, digits and common punctuation
are cut into pre-tokens here and handed to the library's byte-pair model; all
others go through the library's whole pipeline.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, claim, prepare, utf8

#: Parts that follow a space, and other pre-tokens, whose ids a worker keeps (two generations of this size at most).
CACHE_WORDS, CACHE_PARTS = 250_000, 20_000

# Characters whose pre-token class is the same in every regex engine and Unicode version.
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
PUNCTUATION = ".,;:!?|%&$*#@()\\-/"
#: Byte-level alphabet: printable bytes stand for themselves, the others, in order, for the characters from 256 on.
BYTE_LEVEL = {b: 256 + i for i, b in enumerate(b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b))}
_MARKS = PUNCTUATION.replace("\\", "")
_SPACE, _LINE = (chr(BYTE_LEVEL[b]) for b in b" \n")
#: A white-space character (what ``\\s`` matches) and a space: in ASCII texts, and in all.
_RUNS = [chr(c) + " " for c in (*range(9, 14), *range(28, 33))]
_ALL_RUNS = _RUNS + [chr(c) + " " for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
_CUT = re.compile(r"(?<=\S)(?= )")


def _has_run(text: str) -> bool:
    """Whether a white-space character stands before a space."""
    return any([run in text for run in (_RUNS if text.isascii() else _ALL_RUNS) if run[0] in text])  # few such characters stand in a text


class _Cache:
    """Ids of parts in two generations of at most ``size`` parts each."""

    def __init__(self, size: int):
        self.size, self.new, self.old = size, {}, {}

    def get(self, part: str) -> bytes | None:
        ids = self.new.get(part)
        if ids is None:
            ids = self.old.get(part)
            if ids is not None:
                self.new[part] = ids
        return ids

    def put(self, part: str, ids: bytes) -> bytes:
        if len(self.new) >= self.size:
            self.old, self.new = self.new, {}
        self.new[part] = ids
        return ids

    def put_early(self, part: str, ids: bytes) -> bytes:
        """``put`` in the first half of a generation, where what is frequent turns up."""
        return self.put(part, ids) if 2 * len(self.new) < self.size else ids


class Encoder:
    """Encodes texts to little-endian id bytes; one per worker process and vocabulary file."""

    _open: dict[tuple[str, str, int], Encoder] = {}

    @classmethod
    def of(cls, path: str, dtype: str, words: int = CACHE_WORDS) -> Encoder:
        claim("tokens", cls._open)
        if (path, dtype, words) not in cls._open:
            cls._open.clear()
            cls._open[path, dtype, words] = cls(path, dtype, words)
        return cls._open[path, dtype, words]

    def __init__(self, path: str, dtype: str = "<u4", words: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.code = {"<u2": "H", "<u4": "I"}[dtype]
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        self.model = self.whole.model
        self.lower = "Lowercase" in repr(self.whole.normalizer)
        drops_space = "Split(" in repr(self.whole.pre_tokenizer)
        self.space, digits, line = ("", "[0-9]", "") if drops_space else (" ", "[0-9]+", "|\n")
        gap, solid = " ?" if self.space else "", f"[{LETTERS}0-9{PUNCTUATION}]"
        self.find = re.compile(f"{gap}[{LETTERS}]+|{gap}{digits}|{gap}[{PUNCTUATION}]+{line}").findall
        self.plain = re.compile(f" ?{solid}+(?:\n{solid}+)*").fullmatch
        self.is_word = re.compile(f"[{LETTERS}]+").fullmatch
        self.words, self.parts = _Cache(words), _Cache(CACHE_PARTS)

    def _piece(self, piece: str) -> bytes:
        """Ids of one pre-token of plain characters, its bytes spelled in the byte-level alphabet."""
        if self.lower:
            piece = piece.lower()
        if piece.isascii():  # all but a space and a line's end stand for themselves
            spelled = piece.replace(" ", _SPACE).replace("\n", _LINE)
        else:
            spelled = piece.encode().decode("latin-1").translate(BYTE_LEVEL)
        return array(self.code, [t.id for t in self.model.tokenize(spelled)]).tobytes()

    def _word(self, word: str) -> bytes:
        """``_piece`` of a word of letters and the space before it."""
        if self.space and not self.lower and word.isascii():
            return array(self.code, [t.id for t in self.model.tokenize(_SPACE + word)]).tobytes()
        return self._piece(self.space + word)

    def _whole(self, part: str) -> bytes:
        """Ids of a text that is cut before a space or at its ends."""
        if not self.plain(part):
            return array(self.code, self.whole.encode(part, add_special_tokens=False).ids).tobytes()
        out, skip = [], len(self.space)
        for x in self.find(part):
            if x.startswith(self.space) and self.is_word(x, skip):
                out.append(self.words.get(x[skip:]) or self.words.put(x[skip:], self._piece(x)))
            else:
                out.append(self.parts.get(x) or self.parts.put(x, self._piece(x)))
        return b"".join(out)

    def _after_space(self, rest: str) -> bytes:
        """Ids of a space and ``rest``, which holds none at its start."""
        ids = self.words.get(rest)
        if ids is not None:
            return ids
        if rest.isalpha() and (rest.isascii() or self.is_word(rest)):
            return self.words.put(rest, self._word(rest))
        word = rest.rstrip(_MARKS)
        if len(word) < len(rest) and word.isalpha() and (word.isascii() or self.is_word(word)):
            # most other parts: a word and the marks after it, quickly put together again where they aren't kept
            marks = rest[len(word):]
            ids = self._after_space(word) + (self.parts.get(marks) or self.parts.put(marks, self._piece(marks)))
            return self.words.put_early(rest, ids)
        return self.words.put(rest, self._whole(" " + rest))

    def encode(self, text: str) -> bytes:
        if _has_run(text):
            first, *rest = _CUT.split(text)
            rest = [x[1:] for x in rest]
        else:
            first, *rest = text.split(" ")
        known, other = self.words.new.get, self._after_space
        ids = b"".join([known(x) or other(x) for x in rest])
        return self._whole(first) + ids if first else ids

    def encode_all(self, texts: list[bytes], end: bytes) -> pa.Array:
        """``encode`` of each UTF-8 text with ``end`` after it.  The texts are
        split and put together by Arrow, so that what follows a space is looked
        up once per call, however often it stands in the texts."""
        heads, rests = [], []
        for raw in texts:
            text = raw.decode("utf-8", "replace")
            first, space, rest = text.partition(" ")
            if space and _has_run(text):
                heads.append(self.encode(text))
                rests.append(None)
            else:
                heads.append(self._whole(first) if first else b"")
                rests.append(rest if space else None)
        lists = pc.split_pattern(pa.array(rests, pa.large_string()), " ")
        pieces = lists.flatten().dictionary_encode()
        known, other = self.words.new.get, self._after_space
        ids = [known(x) or other(x) for x in pieces.dictionary.to_pylist()]
        # each text: its head, what follows its spaces, its end
        ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy() + 2)
        order = np.full(int(ends[-1]) if len(ends) else 0, -1, np.int64)
        order[np.concatenate([[0], ends[:-1]])[: len(ends)]] = len(ids) + 1 + np.arange(len(ends))
        order[ends - 1] = len(ids)
        order[order < 0] = pieces.indices.to_numpy()
        flat = pa.array([*ids, end, *heads], pa.large_binary()).take(pa.array(order))
        at = np.frombuffer(flat.buffers()[1], np.int64, len(flat) + 1, 8 * flat.offset)
        bounds = np.concatenate([at[:1], at[ends]])
        return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(bounds), flat.buffers()[2]]).cast(pa.binary())


def id_type(path: str) -> str:
    """The narrowest little-endian unsigned type that holds every id of the vocabulary."""
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"


def token_ids(docs: DataFrame, vocabulary: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
              dtype: str = "<u4", words: int = CACHE_WORDS, at_once: int = 0) -> DataFrame:
    """``(doc_id, ids)``: each row's ids, the end id last, as little-endian bytes of ``dtype``.

    ``words`` bounds a generation of what a worker keeps, about 200 bytes each.
    Arrow batches are put together until they hold ``at_once`` bytes: more share
    more words, and take more memory.
    """
    prepare(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])
    end = np.array([end_id], dtype).tobytes()

    def encode(tables):
        encoder = Encoder.of(vocabulary, dtype, words)
        names, texts, held = [], [], 0
        for b in tables:
            names += b.column(0).to_pylist()
            texts += b.column(1).to_pylist()
            held += b.nbytes
            if held >= at_once:
                yield batches({"doc_id": names, "ids": encoder.encode_all(texts, end)}, schema)
                names, texts, held = [], [], 0
        if names:
            yield batches({"doc_id": names, "ids": encoder.encode_all(texts, end)}, schema)

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(text_col).alias("text"))
    return source.mapInArrow(encode, "doc_id long, ids binary")
