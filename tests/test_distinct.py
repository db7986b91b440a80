"""Distinct counts by bitmap against count_distinct."""

from pyspark.sql import functions as F

from tradewind.operators.distinct import distinct_counts


def test_counts_at_all_grains(spark):
    df = spark.range(120_000, numPartitions=5).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 40_000)).alias("k"),
        F.when(F.col("id") % 11 > 0, (F.col("id") % 11)).alias("fine"), (F.col("id") % 11 % 2).alias("coarse"), F.lit("all").alias("top"))
    df = df.unionByName(spark.createDataFrame([(None, 1, 1, "all"), ("k1", None, 1, "all")], df.schema))
    families = {"a": ["fine", "coarse", "top"], "b": ["coarse"]}
    got = {(r.family, r.grain, tuple(r.path)): r.distinct_keys for r in distinct_counts(df, "k", families).collect()}
    expected = {}
    for family, grains in families.items():
        present = df.na.drop(subset=["k", *grains])
        for i, grain in enumerate(grains):
            for row in present.groupBy(*grains[i:]).agg(F.count_distinct("k")).collect():
                expected[family, grain, tuple(map(str, row[:-1]))] = row[-1]
    assert got == expected


def test_nothing_to_count(spark):
    df = spark.createDataFrame([], "k STRING, g STRING")
    assert distinct_counts(df, "k", {"a": ["g"]}).collect() == []
    df = spark.createDataFrame([("k", None), (None, "g")], "k STRING, g STRING")
    assert distinct_counts(df, "k", {"a": ["g"]}).collect() == []


def test_facts_are_read_once(spark, tmp_path):
    """The plan of the result starts from the staged bitmaps, whatever the number of grains."""
    df = spark.range(100).select(F.col("id").alias("k"), (F.col("id") % 5).alias("month"), F.lit(1).alias("year"))
    df.write.parquet(str(tmp_path / "facts"))
    counts = distinct_counts(spark.read.parquet(str(tmp_path / "facts")), "k", {"t": ["month", "year"]})
    text = counts._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and "bits" in text and str(tmp_path) not in text
