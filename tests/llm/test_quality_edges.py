"""The classifier's training on tables with clashing columns and repeated labelled rows."""

from pyspark.sql import functions as F

from postloom.llm import quality


def test_training_with_clashing_columns_and_repeated_rows(spark):
    rows = [(i, ("good text with several words " * (5 + i % 7)) if i % 2 else "$$$ ### junk", 1, "x") for i in range(200)]
    rows += [(1, "good text with several words " * 6, 1, "x")] * 30  # one labelled id repeated
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, y int, label_id string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(200)] + [(1, 1, 0)] * 3, "doc_id bigint, quality int, toxic int")
    trees = quality.train(docs, labels)
    scored = quality.predictions(docs, labels)
    assert scored.count() == len(rows) and scored.where(F.col("score").isNull()).count() == 0
    assert quality.accepted(docs, trees).columns == docs.columns
