"""Operator 8: quality by logistic regression on hashed word n-grams, trained with follow-the-regularised-leader updates.

Features: words, runs of punctuation, and pairs of neighbours, hashed to
``DIMENSIONS`` weights; a word that repeats one of the two before it is hashed
as one "same" token, so that repetition is a feature whatever repeats.  A text
of n tokens weighs each by 1 / sqrt(n); its score is a sparse dot product.

Training: a bounded sample, ``PER_CLASS`` documents a class, dealt to
``SHARDS``.  In each of ``ROUNDS`` rounds every shard runs FTRL-proximal over
its documents from the common state, and the states are averaged.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batches, materialise, mix, prepare, utf8
from .labelled import sample

PER_CLASS, DIMENSIONS, SHARDS, ROUNDS = 8000, 1 << 18, 4, 4
#: FTRL-proximal: learning rate, its offset, and the two regularisers.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.1, 0.1

_tokens = re.compile(r"\w+|[^\w\s]+").findall
_SAME = "\0same"
_STATE = pa.schema([("z", pa.binary()), ("n", pa.binary())])


def features(text: bytes) -> np.ndarray:
    """Hashed feature of every token and pair of neighbours, repeats included; the bias is feature 0."""
    tokens = _tokens(text.decode("utf-8", "replace"))
    tokens = [_SAME if t == a or t == b else t for t, a, b in zip(tokens, ["", *tokens], ["", "", *tokens])]
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))
    both = np.concatenate([h, mix(h[:-1], h[1:])]) if len(h) > 1 else h
    return ((both >> np.uint64(20)) % np.uint64(DIMENSIONS - 1) + np.uint64(1)).astype(np.int32)


def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
    w[np.abs(z) <= L1] = 0
    return w


def _logit(w: np.ndarray, at: np.ndarray) -> float:
    return float(w[0] + w[at].sum() / np.sqrt(max(1, len(at))))


def _pass(z: np.ndarray, n: np.ndarray, docs: list[tuple[int, float, np.ndarray]]) -> None:
    """One FTRL pass in place: (label, weight, features) a document."""
    for y, weight, at in docs:
        keys, counts = np.unique(np.append(at, 0), return_counts=True)
        x = counts / np.sqrt(max(1, len(at)))
        x[0] = 1.0
        w = _weights(z[keys], n[keys])
        p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
        g = weight * (p - y) * x
        step = (np.sqrt(n[keys] + g * g) - np.sqrt(n[keys])) / ALPHA
        z[keys] += g - step * w
        n[keys] += g * g


def train(docs: DataFrame, labels: DataFrame, label: str, learn: Column, id_col: str = "doc_id", text_col: str = "text",
          per_class: int = PER_CLASS) -> np.ndarray:
    """The weights.  Classes are weighted to their share of all labels, at a mean weight of 1 over the sample, so
    that the regularisers weigh alike however many labels there are; without labels all weights are zero."""
    spark = docs.sparkSession
    prepare(spark, rows=500)
    drawn, counts = sample(docs, labels, label, learn, per_class, id_col, text_col)
    share = {y: max(1.0, n / per_class) for y, n in counts.items()}
    schema = pa.schema([("shard", pa.int32()), ("doc_id", pa.int64()), ("y", pa.int32()), ("at", pa.binary())])

    def hashed(tables):
        for b in tables:
            yield batches({"shard": b.column(0), "doc_id": b.column(1), "y": b.column(2),
                           "at": [features(t).tobytes() for t in b.column(3).to_pylist()]}, schema)

    shard = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(SHARDS)).cast("int").alias("shard")
    rows = materialise(drawn.select(shard, "doc_id", "y", "text").mapInArrow(hashed, "shard int, doc_id long, y int, at binary"), "features")
    drawn_rows = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    mean = sum(share[y] * n for y, n in drawn_rows.items()) / max(1, sum(drawn_rows.values()))
    share = {y: s / (mean or 1) for y, s in share.items()}
    z, n = np.zeros(DIMENSIONS), np.zeros(DIMENSIONS)
    for number in range(ROUNDS):
        state = spark.sparkContext.broadcast((z, n))

        def learn_shard(table):
            order = np.random.default_rng(number).permutation(table.num_rows)
            rank = np.argsort(table["doc_id"].to_numpy(), kind="stable")
            ys, ats = table["y"].to_pylist(), table["at"].to_pylist()
            own_z, own_n = state.value[0].copy(), state.value[1].copy()
            _pass(own_z, own_n, [(ys[i], share[ys[i]], np.frombuffer(ats[i], np.int32)) for i in rank[order].tolist()])
            return pa.table({"z": [own_z.tobytes()], "n": [own_n.tobytes()]}, schema=_STATE)

        states = rows.groupBy("shard").applyInArrow(learn_shard, "z binary, n binary").collect()  # SHARDS rows of fixed size
        if not states:
            break
        z = np.mean([np.frombuffer(s["z"]) for s in states], axis=0)
        n = np.mean([np.frombuffer(s["n"]) for s in states], axis=0)
    return _weights(z, n)


def score_documents(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, score, predicted)`` for every row.

    Null and empty texts score by the bias alone; texts of any length are read
    whole; repeated rows score alike; no rows give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # DIMENSIONS weights
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def score(tables):
        for b in tables:
            z = np.array([_logit(shared.value, features(t)) for t in b.column(1).to_pylist()])
            yield batches({"doc_id": b.column(0), "score": 1 / (1 + np.exp(-np.clip(z, -40, 40)))}, schema)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(text_col).alias("text"))
    return rows.mapInArrow(score, "doc_id long, score double").withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def quality_scores(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "quality", **columns: str) -> DataFrame:
    return score_documents(docs, train(docs, labels, label, learn, **columns), **columns)
