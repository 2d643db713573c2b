"""The labelled sample is bounded by rows, whatever its ids repeat."""

from pyspark.sql import functions as F

from lapsewise.llm.labelled import sample


def test_a_repeated_id_gives_one_row(spark):
    docs = spark.createDataFrame([(1, "same")] * 4000 + [(1, "other"), (2, "two"), (3, None), (None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, 0), (4, 1), (None, 1), (2, None)], "doc_id long, toxic int")
    got, counts = sample(docs, labels, "toxic", F.lit(True), per_class=100)
    rows = {r["doc_id"]: (r["y"], bytes(r["text"])) for r in got.collect()}
    assert got.count() == 3 and rows[1][0] == 1 and rows[1][1] in (b"same", b"other") and rows[2] == (0, b"two") and rows[3] == (0, b"")
    assert counts == {1: 2, 0: 2}
