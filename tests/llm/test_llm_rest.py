"""Operators 4 and 10, the registered queries' SQL, and the pipeline."""

import duckdb
import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from lapsewise.llm import chat, neighbours
from lapsewise.llm.queries import ORACLE, REGISTRY

from ..conftest import SF001

CONTROL = st.lists(st.sampled_from(["<s>", "</s>", "[INST]", "[/INST]", "<|", "\\", "<", "s>", "\n", "a", "<<SYS>>", "é"]), max_size=8).map("".join)


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system"]), CONTROL), max_size=5))
def test_chat_round_trip_and_mask(turns):
    text, rewritten, spans = chat.locate(turns, chat.template)
    assert rewritten is None and text == chat.template(turns) and chat.parse(text) == turns
    assert [chat.unescape(text[s["text_start"]: s["text_stop"]]) for s in spans] == [t for _, t in turns]
    assert [s["start"] for s in spans[1:]] == [s["stop"] for s in spans[:-1]]
    for body in (chat.escape(t) for _, t in turns):
        assert not any(c in body for c in ("<s>", "</s>", "[INST]", "[/INST]", "<|"))


def test_chat_detects_a_template_that_rewrites_history():
    last_only = lambda turns: "".join(f"{r}:{t if i == len(turns) - 1 else '...'};" for i, (r, t) in enumerate(turns))
    assert chat.locate([("user", "a"), ("assistant", "b")], last_only)[1:] == (1, [])


def test_chat_rows(spark):
    rows = spark.createDataFrame([(1, 1, "assistant", None, 0), (1, 0, "user", "hi", 0), (1, None, None, "first", 0), (None, 0, "user", "x", 0),
                                  (2, 0, "assistant", "twice", 0), (2, 0, "assistant", "twice", 0), (3, 0, "user", "long " * 50000, 0)],
                                 "conv_id long, turn long, role string, text string, spans int")
    out = {r["conv_id"]: r for r in chat.read_back(chat.format_conversations(rows)).collect()}
    assert {k: (r["n_turns"], r["loss_chars"]) for k, r in out.items()} == {1: (3, 0), None: (1, 0), 2: (2, 10), 3: (1, 0)}
    assert chat.format_conversations(rows.limit(0)).collect() == []


def brute(rows, k=10):
    good = sorted({(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}, key=repr)
    out = {}
    for q, v in good:
        if q % 10 == 0:
            d = sorted({(float(np.sqrt(((np.array(w, float) - np.array(v, float)) ** 2).sum())), i) for i, w in good if i != q})
            out[q] = d[:k]
    return out


def test_neighbours_against_brute_force(spark):
    rng = np.random.default_rng(0)
    vectors = np.concatenate([rng.normal(c, 0.3, (60, 6)) for c in rng.normal(0, 2, (5, 6))]).astype(np.float32)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)] + [(1000 + i, [0.5] * 6) for i in range(80)] + [
        (2000, None), (2010, [0.0] * 6), (2020, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (2030, [float("nan")] * 6), (2040, [float("inf")] + [1.0] * 5),
        (2050, [1.0, 2.0]), (None, [1.0] * 6), (7, [float(x) for x in vectors[7]])]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, node int")
    got = {}
    for r in neighbours.nearest_neighbours(frame, F.col("vec_id") % 10 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    want = brute([x for x in rows if x[1] is None or len(x[1]) == 6])
    assert got.keys() == want.keys()
    hits = sum(len(set(got[q]) & set(want[q])) for q in want)
    assert hits >= 0.9 * sum(len(w) for w in want.values())
    assert got[1000] == [(0.0, i) for i in range(1001, 1011)] and all(g == sorted(g) for g in got.values())


def test_neighbours_of_few_rows_and_none(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (100, [0.0, 1.0]), (3, [2.0, 0.0])], "vec_id long, embedding array<float>")
    got = [tuple(r) for r in neighbours.nearest_neighbours(few, F.col("vec_id") == 0).orderBy("rank").collect()]
    assert got == [(0, 1, 3, 1.0), (0, 2, 100, 2 ** 0.5)]
    assert neighbours.nearest_neighbours(few.limit(0), F.col("vec_id") == 0).collect() == []


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql_gives_the_same_rows(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    found = con.execute(ORACLE[name])
    columns = [c[0] for c in found.description]
    want = sorted(found.fetchall(), key=repr)
    got = sorted((tuple(r) for r in REGISTRY[name](spark, SF001).select(*columns).collect()), key=repr)
    assert got == want and want


def test_pipeline_keeps_columns_and_drops_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    ids, kept = {r["doc_id"] for r in docs.select("doc_id").collect()}, docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SF001)
        assert kept.columns == docs.columns
    left = {r["doc_id"] for r in kept.select("doc_id").collect()}
    packed = {r["doc_id"] for r in corpus_pipeline.run(spark, SF001).select("doc_id").distinct().collect()}
    assert packed == left < ids


def test_pipeline_of_nothing(spark):
    empty = spark.read.parquet(f"{SF001}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF001).collect() == []
