"""Operator 1: toxicity by class-conditional Kneser-Ney models.

One character n-gram model per class, over the words of a document.  The
highest order of a model is its class's own absolute-discounted counts: whole
contexts, and shorter ones at a word's start.  All lower orders are Kneser-Ney
continuation counts (in how many different left contexts an n-gram was met),
pooled over both classes: an expression that neither class has seen often backs
off to the same probabilities in both and tells them apart little.  Counts are
document frequencies, so a repeated line counts once.

An expression, a word, is compared by the difference of its toxic and ordinary
log-likelihoods, normalised by its length.  A document's evidence is that of
its most toxic expression, so a long text does not dilute it.  One logistic map
with a positive slope, fitted on labelled documents that the models did not
count and weighted to the classes' shares, turns it into a score.

The models learn from a bounded sample: ``PER_CLASS`` documents a class.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import batches, claim, materialise, prepare, utf8
from .labelled import sample

#: Documents of a class that the models learn from; longest n-gram; discount.
PER_CLASS, ORDER, DISCOUNT = 4000, 5, 0.75
#: Words whose evidence a worker keeps.
CACHE_WORDS = 150_000

_find_words = re.compile(r"\w+").findall
_evidence: dict[str, dict[str, float]] = {}


def words_of(text: bytes) -> list[str]:
    return _find_words(text.decode("utf-8", "replace").lower())


def grams_of(word: str, order: int) -> list[str]:
    """The n-gram that ends at each character of the word and at its end mark: ``order`` characters, fewer at the start."""
    s = f"^{word}$"
    return [s[max(0, i - order + 1): i + 1] for i in range(1, len(s))]


class Shared:
    """Kneser-Ney probabilities of the lower orders, by both classes' distinct n-grams."""

    def __init__(self, grams, discount: float):
        known = {g[i:] for g in grams for i in range(len(g))}
        self.discount, self.met, self.total, self.types, self.cache = discount, Counter(g[1:] for g in known if len(g) > 1), Counter(), Counter(), {}
        for gram, n in self.met.items():
            self.total[gram[:-1]] += n
            self.types[gram[:-1]] += 1
        self.uniform = 1 / (self.types[""] + 1)

    def __call__(self, gram: str) -> float:
        if gram not in self.cache:
            context = gram[:-1]
            if not gram:
                p = self.uniform
            elif not self.total[context]:
                p = self(gram[1:])
            else:
                p = (max(self.met[gram] - self.discount, 0) + self.discount * self.types[context] * self(gram[1:])) / self.total[context]
            self.cache[gram] = p
        return self.cache[gram]


class Model:
    """``gain``: log-likelihood difference of a seen n-gram's last character; ``shift``: of any other after a
    seen context, in which the shared probability cancels out."""

    def __init__(self, rows: list[tuple[str, int, int]], order: int, discount: float):
        self.name, self.order, self.gain, self.shift = uuid.uuid4().hex, order, {}, {}
        self.slope, self.base = 0.0, 0.0
        total, types = (Counter(), Counter()), (Counter(), Counter())
        for gram, *both in rows:
            for c, n in enumerate(both):
                total[c][gram[:-1]] += n
                types[c][gram[:-1]] += n > 0
        shared = Shared([gram for gram, *_ in rows], discount)
        back = [lambda context, c=c: discount * types[c][context] / total[c][context] if total[c][context] else 1.0 for c in (0, 1)]
        for gram, *both in rows:
            context, below = gram[:-1], shared(gram[1:])
            p = [(max(n - discount, 0) / total[c][context] if n else 0.0) + back[c](context) * below for c, n in enumerate(both)]
            self.gain[gram] = math.log(p[1] / p[0])
        for context in {*total[0], *total[1]}:
            self.shift[context] = math.log(back[1](context) / back[0](context))

    def evidence(self, word: str) -> float:
        """The word's toxic less its ordinary log-likelihood, per character and end mark."""
        out = 0.0
        for gram in grams_of(word, self.order):
            known = self.gain.get(gram)
            out += known if known is not None else self.shift.get(gram[:-1], 0.0)
        return out / (len(word) + 1)

    def of_text(self, text: bytes) -> float:
        """The evidence of the text's most toxic word; 0 without words."""
        if self.name not in _evidence:
            _evidence.clear()
        known = _evidence.setdefault(self.name, {})
        if len(known) > CACHE_WORDS:
            known.clear()
        words = set(words_of(text))
        for w in words:
            if w not in known:
                known[w] = self.evidence(w)
        return max((known[w] for w in words), default=0.0)


def _fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps with a small ridge, on scaled columns."""
    scale = np.maximum(x.std(axis=0), 1e-9)
    scale[-1] = 1
    a, w = x / scale, np.zeros(x.shape[1])
    ridge = np.diag([1e-2] * (len(w) - 1) + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        hessian = (a * (weight * p * (1 - p))[:, None]).T @ a + ridge
        w = w + np.linalg.solve(hessian, a.T @ (weight * (y - p)) - ridge @ w)
    return w / scale


def train(docs: DataFrame, labels: DataFrame, label: str, learn: Column, id_col: str = "doc_id", text_col: str = "text",
          per_class: int = PER_CLASS, order: int = ORDER, discount: float = DISCOUNT) -> Model:
    """Fit on ``labels`` rows where ``learn`` holds (over ``doc_id``); without both classes the score is a constant."""
    spark = docs.sparkSession
    prepare(spark, rows=200)
    drawn, counts = sample(docs, labels, label, learn, per_class, id_col, text_col)
    drawn = materialise(drawn, "labelled")

    def count_words(tables):
        claim("toxicity", _evidence)
        schema = pa.schema([("y", pa.int32()), ("word", pa.string()), ("n", pa.int64())])
        for b in tables:
            seen = Counter((y, w) for y, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for w in set(words_of(text)))
            yield batches({"y": [k[0] for k in seen], "word": [k[1] for k in seen], "n": list(seen.values())}, schema)

    def count_grams(tables):
        claim("toxicity", _evidence)
        schema = pa.schema([("gram", pa.string()), ("n0", pa.int64()), ("n1", pa.int64())])
        for b in tables:
            seen = (Counter(), Counter())
            for y, word, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for gram in grams_of(word, order):
                    seen[y][gram] += n
            grams = list(seen[0].keys() | seen[1].keys())
            yield batches({"gram": grams, "n0": [seen[0][g] for g in grams], "n1": [seen[1][g] for g in grams]}, schema)

    words = drawn.where("part > 0").select("y", "text").mapInArrow(count_words, "y int, word string, n long") \
        .groupBy("y", "word").agg(F.sum("n").alias("n"))
    grams = materialise(words.mapInArrow(count_grams, "gram string, n0 long, n1 long").groupBy("gram")
                        .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")), "grams")
    model = Model([tuple(r) for r in grams.collect()], order, discount)  # bounded by the sample

    rest = found_evidence(drawn.where("part = 0").select("y", "text"), model).collect()
    model.base = math.log((counts.get(1, 0) + 0.5) / (counts.get(0, 0) + 0.5))
    y = np.array([r["y"] for r in rest])
    if len(set(y.tolist())) == 2:
        x = np.array([[r["__evidence"], 1.0] for r in rest])
        weight = np.where(y == 1, counts[1] / (y == 1).sum(), counts[0] / (y == 0).sum())
        slope, base = _fit(x, y, weight * len(y) / weight.sum()).tolist()
        if slope > 0:  # else the models tell nothing: the classes' shares alone
            model.slope, model.base = slope, base
    return model


def found_evidence(rows: DataFrame, model: Model) -> DataFrame:
    """Every column but the last, ``text`` (binary), and the ``__evidence`` of that text."""
    shared = rows.sparkSession.sparkContext.broadcast(model)  # bounded: the n-grams of the sample
    kept = rows.schema.fields[:-1]

    def score(tables):
        claim("toxicity", _evidence)  # before the model is read: other operators' caches go first
        for b in tables:
            found = [shared.value.of_text(t) for t in b.column(len(kept)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(found, pa.float64())], names=[*b.schema.names[:-1], "__evidence"])

    return rows.mapInArrow(score, T.StructType([*kept, T.StructField("__evidence", T.DoubleType())]))


def scored(rows: DataFrame, model: Model) -> DataFrame:
    """Every column of ``rows`` but the last, ``text`` (binary), and its ``__score``."""
    z = F.col("__evidence") * model.slope + model.base
    score = 1 / (1 + F.exp(-F.greatest(F.lit(-40.0), F.least(F.lit(40.0), z))))
    return found_evidence(rows, model).withColumn("__score", score).drop("__evidence")


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, score, predicted)`` for every row.

    Null and empty texts have no evidence and take the score of none; a word or
    text of any length is read whole; repeated rows score alike; no rows give
    no rows.
    """
    rows = scored(docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(text_col).alias("text")), model)
    return rows.select("doc_id", F.col("__score").alias("score"), (F.col("__score") >= 0.5).cast("int").alias("predicted"))


def toxic_scores(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "toxic", **columns: str) -> DataFrame:
    return score_documents(docs, train(docs, labels, label, learn, **columns), **columns)


def keep_clean(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "toxic", id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that score 0.5 or more; all columns as they
    were, whatever their names.  Null and empty texts stay unless most labels
    are toxic; repeated rows stay or go together; no rows give no rows."""
    model = train(docs, labels, label, learn, id_col, text_col)
    rows = scored(docs.select(F.struct(*docs.columns).alias("__row"), utf8(text_col).alias("text")), model)
    return rows.where("__score < 0.5").select("__row.*")
