"""Alignment of two tokenizers against a direct one, over piece sizes and both ways back of the counts."""

from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lapsewise.llm import alignment
from lapsewise.llm.tokens import BYTE_LEVEL

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string"


def tokens(text, model_a, model_b):
    """``(id, bytes)`` of both sides, straight from the libraries."""
    back = {chr(c): b for b, c in BYTE_LEVEL.items()}
    a = [(i, bytes(back.get(c, ord(c) & 255) for c in model_a.id_to_token(i))) for i in model_a.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, bytes([int(p[3:5], 16)]) if p.startswith("<0x") and len(p) == 6 else p.replace("▁", " ").encode())
         for i, p in zip(model_b.encode(text), model_b.encode(text, out_type=str))]
    whole = (" " + text).encode()
    return (a, b) if text and b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else ([], [])


def brute(rows):
    model_a, model_b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    model_a.encode_special_tokens = True
    docs, counts = [], Counter()
    for name, text in rows:
        a, b = tokens(text or "", model_a, model_b)
        spans = []
        for side in (a, b):
            at, out = 0, []
            for i, x in side:
                out.append((at, at + len(x), i))
                at += len(x)
            spans.append(out)
        links, j0 = [], 0
        for s, e, i in spans[0]:
            while j0 < len(spans[1]) and spans[1][j0][1] <= s:
                j0 += 1
            j = j0
            while j < len(spans[1]) and spans[1][j][0] < e:
                links.append((i, spans[1][j][2]))
                j += 1
        counts.update(links)
        common = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, low = [], 0
        for edge in common:
            groups.append("|".join(",".join(str(i) for _, e, i in side if low < e <= edge) for side in spans))
            low = edge
        docs.append((name, len(a), len(b), len(groups), links, ";".join(groups)))
    top = Counter()
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    return sorted(((name, n_a, n_b, n_g, len(links), sum(counts[x] == top[x[1]] for x in links), sum(counts[x] for x in links), groups)
                   for name, n_a, n_b, n_g, links, groups in docs), key=repr)


def rows():
    rng = np.random.default_rng(5)
    words = ["the", "Retitioning", "naïve", "é", "Übermaß", "x" * 30, "12345", "</s>", "<|endoftext|>", "▁", "中文", "\U0001F600", "a\tb", "re.\nErtion", "", "\x00"]
    out = [(i, " ".join(rng.choice(words, int(rng.integers(0, 40))))) for i in range(60)]
    out += [(100, None), (101, ""), (None, "null id"), (102, "same text"), (102, "same text"), (103, " "), (104, "ab" * 4000), (105, "word " * 3000), (106, "▁x")]
    return out + [(200 + i, "hot copy of a text") for i in range(40)]


@pytest.mark.parametrize("steps, table_bytes", [(1 << 20, 1 << 20), (1 << 20, 0), (37, 1 << 20), (500, 0)])
def test_against_direct_alignment(spark, steps, table_bytes):
    df = spark.createDataFrame(rows(), SCHEMA).repartition(3).selectExpr("*", "1 AS piece", "'x' AS groups", "2 AS n_a")
    got = alignment.align(df, A, B, steps=steps, table_bytes=table_bytes)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows())


def test_no_rows(spark):
    assert alignment.align(spark.createDataFrame([], SCHEMA), A, B).collect() == []


ENDS = st.lists(st.integers(1, 40), unique=True, min_size=1, max_size=20).map(sorted)


@given(ENDS, ENDS)
def test_diagonals_divide_the_merge(a, b):
    last = 41
    a, b = np.array([*a, last]), np.array([*b, last])
    for step in range(len(a) + len(b) + 1):
        i, j = alignment.diagonal(a, b, step)
        assert step <= i + j <= step + 1
        taken, rest = [*a[:i], *b[:j]], [*a[i:], *b[j:]]
        assert not taken or not rest or max(taken) < min(rest) or (max(taken) <= min(rest) and i + j == step and max(taken) not in (set(a) & set(b)))
