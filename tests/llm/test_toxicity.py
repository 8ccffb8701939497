import zlib

import numpy as np

from rushcart.llm.toxicity import THRESHOLD, grams, present, reject_toxic, score_toxicity, train
from .conftest import ODD, prose

BAD = ("idiot", "worthless", "scum")


def table(spark, docs, n=1200):
    rows = [(i, prose(30, i) + (f" {BAD[i % 3]} " + prose(5, i + 1) if i % 6 == 0 else "")) for i in range(n)]
    labels = spark.createDataFrame([(i, 1, int(i % 6 == 0)) for i in range(n) if i % 5], "doc_id long, quality int, toxic int")
    return docs(rows), labels, {i: int(i % 6 == 0) for i in range(n)}


def test_held_out_accuracy(spark, docs):
    df, labels, truth = table(spark, docs)
    result = score_toxicity(df, train(df, labels)).collect()
    assert len(result) == 1200
    for r in result:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= THRESHOLD)
    right = [r.predicted == truth[r.doc_id] for r in result if r.held_out]
    assert len(right) > 200 and np.mean(right) > 0.98


def test_held_out_labels_are_not_learned(spark, docs):
    df, labels, _ = table(spark, docs, 400)
    turned = labels.withColumn("toxic", labels.toxic)
    from rushcart.llm.toxicity import held_out
    from pyspark.sql import functions as F

    turned = labels.withColumn("toxic", F.when(held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = train(df, labels), train(df, turned)
    assert a.bias == b.bias and np.array_equal(a.weight, b.weight)


def test_odd_rows_and_labels(spark, docs):
    df, labels, _ = table(spark, docs, 300)
    odd = spark.createDataFrame([(1, 1, None), (None, 1, 1), (2, 1, 5), (9999, 0, 1), (7, 0, 1), (7, 0, 0)], "doc_id long, quality int, toxic int")
    model = train(df, labels.unionByName(odd))
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "a"), (3, "a"), (3, "a")]
    result = score_toxicity(docs(rows), model).collect()
    assert len(result) == len(rows) and all(0 <= r.score <= 1 for r in result)
    assert result[0].score == result[1].score
    assert score_toxicity(docs([]), model).count() == 0


def test_without_both_classes_all_texts_score_alike(spark, docs):
    one = spark.createDataFrame([(1, 1, 1), (3, 1, 1)], "doc_id long, quality int, toxic int")
    df = docs([(1, "a"), (2, "b"), (3, None)])
    assert len({r.score for r in score_toxicity(df, train(df, one)).collect()}) == 1
    none = one.where("false")
    assert {r.score for r in score_toxicity(df, train(df, none)).collect()} == {0.5}


def test_rejecting_keeps_the_rows_below_the_threshold(spark, docs):
    df, labels, _ = table(spark, docs, 600)
    model = train(df, labels)
    kept = reject_toxic(df, model)
    assert kept.columns == df.columns
    assert kept.count() == score_toxicity(df, model).where("predicted = 0").count() < 600


def test_ngrams_do_not_reach_into_the_next_text():
    rows = ["abc", "", "defg", "İx"]
    together = present(rows, None)
    apart = [present([x], None)[1] for x in rows]
    for i, own in enumerate(apart):
        assert sorted(together[1][together[0] == i]) == sorted(own)
    assert list(grams([""])) == []
