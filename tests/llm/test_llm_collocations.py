"""Collocations against a direct count in Python, the dense and the sparse tile, and the SQL."""

import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from lapsewise.llm import collocations as co
from lapsewise.llm.queries import ORACLE, REGISTRY

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_count, top, max_words=4):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        n[lang] += 0
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            n[lang] += len(words)
            for size in range(1, max_words + 1):
                f.update((lang, tuple(words[i: i + size])) for i in range(len(words) - size + 1))
    found = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= min_count}
    gone = {(lang, w[i: i + size]) for (lang, w), a in found.items() for size in range(2, len(w)) for i in range(len(w) - size + 1)
            if 100 * a >= 80 * f[lang, w[i: i + size]]}
    out = []
    for (lang, w), a in found.items():
        if (lang, w) not in gone:
            score, _, l, r = min((2000000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))  # noqa: E741
            out.append((lang, " ".join(w), a, l, r, n[lang], score))
    out.sort(key=lambda x: (x[0], -x[6], -x[2], x[1].encode()))
    place = Counter()
    ranked = []
    for x in out:
        place[x[0]] += 1
        if place[x[0]] <= top:
            ranked.append((x[0], place[x[0]], *x[1:]))
    return ranked


def rows():
    rng = np.random.default_rng(3)
    out = [("en", " ".join(f"w{int(x)}" for x in rng.zipf(1.4, 40) if x < 60)) for _ in range(120)]
    out += [("en", "One two. three four, ONE two three\tfour  five")] * 90  # a hot copy
    out += [(None, "a b a b a b"), (None, None), ("", "x y"), ("de", ""), ("de", "Äpfel Äpfel äpfel x \x1c  y")] * 3
    out += [("fr", "a b c d e f " * 4000), ("fr", "z" * 200_000), ("fr", "...;;!!\x0b\x0c\r\n")]
    return out


@pytest.mark.parametrize("min_count, top, max_words", [(3, 2000, 4), (2, 5, 3), (1, 40, 2)])
def test_against_direct_counts(spark, min_count, top, max_words):
    df = spark.createDataFrame(rows(), "lang string, text string").repartition(4).selectExpr("*", "1 AS chunk", "'x' AS words", "2 AS n", "3 AS tile")
    got = co.collocations(df, min_count=min_count, top=top, max_words=max_words).collect()
    assert sorted(map(tuple, got)) == sorted(brute(rows(), min_count, top, max_words))


def test_no_rows_and_nothing_frequent(spark):
    df = spark.createDataFrame(rows()[:3], "lang string, text string")
    assert co.collocations(df.limit(0)).collect() == []
    assert co.collocations(df, min_count=1000).collect() == []


@pytest.mark.parametrize("dense", [0, 1 << 30])
def test_dense_and_sparse_tiles_agree(monkeypatch, dense):
    monkeypatch.setattr(co, "DENSE_CELLS", dense)
    rng, edges = np.random.default_rng(1), np.array([0, 7, 30, 100])
    grid, total, sent = co._Tiles(edges), Counter(), {}
    for chunk in range(5):
        keys, counts = np.unique(rng.integers(0, 100, 900).astype(np.uint64) << np.uint64(32) | rng.integers(0, 100, 900).astype(np.uint64), return_counts=True)
        tile, cell = grid.split(keys)
        for k, n, t, c in zip(keys.tolist(), counts.tolist(), tile.tolist(), cell.tolist(), strict=True):
            total[k >> 32, k & 0xFFFFFFFF] += n
            sent.setdefault(t, {}).setdefault(chunk, []).append((c, n))
    got = {}
    for t, chunks in sent.items():
        table = pa.table({"tile": [t] * len(chunks), "cells": [co._planes(np.array([c for c, _ in x])) for x in chunks.values()],
                          "counts": [co._planes(np.array([n for _, n in x])) for x in chunks.values()]})
        got |= {(r["left"], r["right"]): r["n"] for r in co._add_up(edges, 2)(table).to_pylist()}
    assert got == {k: n for k, n in total.items() if n >= 2}


def test_long_texts_are_split_between_words(monkeypatch):
    monkeypatch.setattr(co, "SPLIT_BYTES", 7)
    text = "Aa bb,cccccccccccccccc dd\tee.f  "
    assert [w for part in co.words_of(text.encode()) for w in part] == "aa bb \xff cccccccccccccccc dd ee \xff f".encode("latin-1").split(b" ")


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    got = REGISTRY["op12_collocations"](spark, "/root/testdata/sf0.001")
    want = con.execute(ORACLE["op12_collocations"])
    names = [c[0] for c in want.description]
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(want.fetchall())
