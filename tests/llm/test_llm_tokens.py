"""Token ids, packing and token files: against the tokenizers library and as round trips."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lapsewise.llm import packing, token_files
from lapsewise.llm.tokens import Encoder

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "  ", "a  b", "a \n b", "\n", "it's don't", "x  y", "x   y", "\x1c \x1d a!\x1c b", "foo\x85 bar",
       "é ́x", "ΑΣ ΟΣ Σ", "<|endoftext|> a <|endoftext|>", "a1b22 333", " lead", "trail ", "日本 語", "İstanbul ẞ",
       "a\tb \tc\r\n d", "'S 'LL mixed's", "µ ª º", "!\n\n? x\n", "#$ %\n&x", "​ ​c", "ſ K Å", "12.50 a-b (c)", "the.\nThe,the"]
DOCS = [(1, "One small text."), (2, None), (3, ""), (None, "no id"), (4, "twice"), (4, "twice"), (5, "long text " * 9000),
        *((i, f"document {i} " * i) for i in range(10, 60))]


def reference(path, text, dtype="<u4"):
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], dtype)


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_encoder_equals_the_library(path):
    rng, letters = np.random.default_rng(0), list("ab' \n\t.é !1σΣ́ S|")
    texts = ODD + ["".join(rng.choice(letters, size=rng.integers(0, 25))) for _ in range(3000)]
    whole = Tokenizer.from_file(path)
    whole.encode_special_tokens = True
    encoder = Encoder(path, "<u4")
    expected = [np.array(e.ids, "<u4").tobytes() for e in whole.encode_batch(texts, add_special_tokens=False)]
    assert [encoder.encode(t) for t in texts] == expected


def check_pieces(rows, docs, capacity):
    """Every id in one piece, sequences gapless; returns the share of padding."""
    ids = {}
    for doc, text in docs:
        ids.setdefault(doc, []).append(reference(WORDS, text))
    spans, sequences = {}, {}
    for r in rows:
        own = ids[r["doc_id"]][0]
        assert bytes(r["ids"]) == own[r["start"]: r["start"] + r["length"]].tobytes()
        assert r["doc_tokens"] == len(own) and r["length"] > 0
        spans.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for doc, copies in ids.items():
        times = np.zeros(len(copies[0]), int)
        for start, length in spans[doc]:
            times[start: start + length] += 1
        assert (times == len(copies)).all()
    padding = total = 0
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
        total += at
        padding += capacity - at if at & (at - 1) else 0
    return padding / total


def test_packing_tiles_documents_and_hardly_pads(spark):
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in DOCS], "doc_id long, text string, worker int, ids string").repartition(5)
    rows = packing.pack_documents(docs, WORDS, 2, capacity=4096).collect()
    assert check_pieces(rows, DOCS, 4096) < 0.01


def test_packing_merges_many_workers(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").repartition(70)
    assert check_pieces(packing.pack_documents(docs, WORDS, 2, capacity=512).collect(), DOCS, 512) < 0.02


def test_packing_nothing(spark):
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, text string"), WORDS, 2).collect() == []


def test_token_files_round_trip(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in DOCS], "doc_id long, text string, ids string").repartition(4)
    rows = sorted(token_files.token_files(docs, BYTES, 2).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == sorted((i for i, _ in DOCS), key=lambda i: (i is not None, i or 0))
    text_of, at = dict(DOCS), 0
    for r in rows:
        own = reference(BYTES, text_of[r["doc_id"]])
        assert (r["start"], r["n_tokens"]) == (at, len(own)) and zlib.crc32(bytes(r["ids"])) == zlib.crc32(own.tobytes())
        at += len(own)


def test_token_files_of_nothing(spark):
    assert token_files.token_files(spark.createDataFrame([], "doc_id long, text string"), BYTES, 2).collect() == []


def test_code_lengths_are_optimal_and_limited():
    import heapq

    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 50, 700):
        counts = (rng.pareto(0.7, n) * 10).astype(np.int64) + 1
        heap, cost = counts.tolist(), 0
        heapq.heapify(heap)
        while len(heap) > 1:
            a = heapq.heappop(heap) + heapq.heappop(heap)
            cost += a
            heapq.heappush(heap, a)
        free = token_files.code_lengths(counts, 40)
        assert n == 1 or (free * counts).sum() == cost
        limit = max(1, int(n - 1).bit_length()) + 1
        tight = token_files.code_lengths(counts, limit)
        assert tight.max() <= limit and (2.0 ** -tight).sum() <= 1
    with pytest.raises(ValueError):
        token_files.code_lengths(np.ones(5, np.int64), 2)


def test_packed_codes_are_the_bits_one_after_another():
    rng = np.random.default_rng(2)
    for widest in (1, 5, 16, 17):
        bits = rng.integers(1, widest + 1, 40)
        codes = rng.integers(0, 1 << 20, 40) % (1 << bits)
        for n in (0, 1, 2, 5, 8, 9, 33):
            ids = rng.integers(0, 40, n).astype("<u2")
            payload, checkpoints = token_files.pack(ids, codes, bits, step=2, run=2)  # in several runs
            spelled = "".join(format(codes[i], f"0{bits[i]}b") for i in ids)
            assert "".join(format(b, "08b") for b in payload).startswith(spelled) and not any(payload[-(-len(spelled) // 8):])
            assert checkpoints.tolist() == [0, *np.cumsum(bits[ids]).tolist()][:n:2]
