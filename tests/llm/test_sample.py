"""The training sample of the quality classifier."""

from pyspark.sql import functions as F

from carebase.llm import weak_quality


def test_copies_take_one_place_and_the_sample_is_the_same_each_time(spark):
    texts = ["the same text of many copies"] * 60 + [f"the text and number {i} of it" for i in range(30)]
    docs = spark.createDataFrame(enumerate(texts), "doc_id long, text string")
    rows = weak_quality.featured(docs, F.col("doc_id"))
    every = weak_quality.sampled(rows, 100).collect()
    assert sorted(row.copies for row in every) == [1] * 30 + [60]
    few = weak_quality.sampled(rows, 10).collect()
    again = weak_quality.featured(docs.repartition(5), F.col("doc_id"))
    assert few == weak_quality.sampled(again, 10).collect() == every[:10]
    assert weak_quality.sampled(rows.limit(0), 10).count() == 0
