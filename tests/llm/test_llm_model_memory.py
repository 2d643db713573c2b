"""A model is read in a worker after other operators' caches went."""

import public_tokenizers
from pyspark.sql import functions as F

from lapsewise.llm import tokens, toxicity
from lapsewise.llm.common import utf8


class Probe:
    """A model that, where it is read, notes whether the tokenizers' caches are still held."""

    def __reduce__(self):
        held = "bool(__import__('lapsewise.llm.tokens', fromlist=['Encoder']).Encoder._open)"
        return eval, (f"(lambda held: __import__('types').SimpleNamespace(of_text=lambda text: float(held)))({held})",)


def test_models_are_read_after_other_caches_went(spark):
    docs = spark.range(64).select(F.col("id").alias("doc_id"), F.concat(F.lit("some words, "), F.col("id").cast("string")).alias("text")).repartition(8)
    assert tokens.token_ids(docs, public_tokenizers.path("word_bpe_49k.json"), 2).count() == 64
    tokens.token_ids(docs, public_tokenizers.path("word_bpe_49k.json"), 2).write.format("noop").mode("overwrite").save()
    rows = docs.select("doc_id", utf8("text").alias("text"))
    assert [r["__evidence"] for r in toxicity.found_evidence(rows, Probe()).collect()] == [0.0] * 64
