"""The training draw of the byte network counts different texts, not rows."""

from pyspark.sql import functions as F

from tessera.llm import byte_cnn


def test_copies_do_not_thin_out_the_sample(spark):
    """Two labels of 60,000 rows: 30 different pages in copies, and 3 pages
    among rows without a letter."""
    ids = spark.range(60000)
    pages = ids.select(F.lit("xx").alias("lang"), F.concat(F.lit("page number "), F.expr("id % 30")).alias("text"))
    bare = ids.select(F.lit("yy").alias("lang"), F.when(F.col("id") % 20000 == 7, F.concat(F.lit("leaf "), "id"))
                      .otherwise(F.col("id").cast("string")).alias("text"))
    sample = byte_cnn.training_sample(pages.unionByName(bare), "lang", "text", per_label=20, windows_per_doc=1)
    assert len({w for k, w in sample if k == "xx"}) == 20
    assert len({w for k, w in sample if k == "yy"}) == 3
