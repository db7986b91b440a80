import datetime as dt

import pytest
from pyspark.sql import functions as F

from tradewind.functions import normalized
from tradewind.functions import elapsed_days, normalized
from tradewind.operators import clean, profile
from tradewind.sources import stage


def test_zero_fix_changes_only_columns_with_a_value_of_zero_or_less(spark, rows):
    df = stage(spark.createDataFrame(
        [(1, 0.0, None), (2, -3.0, 4.0), (3, None, 6.0), (4, 5.0, 5.0)], "id INT, a DOUBLE, b DOUBLE"))
    assert rows(clean.zero_to_one(df, ["a", "b"])) == [(1, 1.0, None), (2, -3.0, 4.0), (3, 1.0, 6.0), (4, 5.0, 5.0)]


def test_iqr_cap_keeps_nulls(spark, rows):
    df = stage(spark.createDataFrame([(i, float(i)) for i in range(1, 9)] + [(9, 1000.0), (10, None)], "id INT, v DOUBLE"))
    bounds = clean.iqr_bounds(df, ["v"])
    assert bounds == {"v": (-3.0, 13.0)}
    assert rows(clean.cap_outliers(df, bounds))[-2:] == [(9, 13.0), (10, None)]


def test_text(spark):
    df = spark.createDataFrame([("  SP ",), (None,), ("\tA b \n",)], "v STRING")
    assert [r[0] for r in df.select(normalized("v")).collect()] == ["sp", None, "a b"]
    assert [r[0] for r in df.select(normalized("v", "nan")).collect()] == ["sp", "nan", "a b"]


def test_coercion(spark, rows):
    df = spark.createDataFrame([("2018-01-02 03:04:05", "1.5"), ("soon", "NaN"), (None, "x")], "t STRING, n STRING")
    df = clean.coerce_numbers(clean.coerce_timestamps(df, ["t"]), ["n"])
    assert df.dtypes == [("t", "timestamp_ntz"), ("n", "double")]
    assert rows(df) == [(None, None), (None, None), (dt.datetime(2018, 1, 2, 3, 4, 5), 1.5)]


def test_elapsed_days_are_whole_24_hours(spark):
    df = spark.createDataFrame([(dt.datetime(2018, 1, 1, 23), dt.datetime(2018, 1, 3, 1))], "a TIMESTAMP_NTZ, b TIMESTAMP_NTZ")
    assert df.select(elapsed_days("a", "b")).first()[0] == 1


def test_fill_median(spark, rows):
    df = stage(spark.createDataFrame([(1, 1.0), (2, None), (3, 4.0), (4, None)], "id INT, v DOUBLE"))
    assert rows(clean.fill_median(df, ["v"])) == [(1, 1.0), (2, 2.5), (3, 4.0), (4, 2.5)]


def test_duplicates(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (1, None), (2, "b")], "x INT, y STRING")
    assert rows(profile.duplicate_profile(df)) == [(5, 3, 2)]
    assert clean.drop_duplicate_rows(df).count() == 3
    assert rows(profile.null_profile(df)) == [("x", 0), ("y", 2)]


def test_profiles_of_an_empty_table(spark, rows):
    df = spark.createDataFrame([], "x INT")
    assert rows(profile.duplicate_profile(df)) == [(0, 0, 0)]
    assert rows(profile.table_profile(df)) == [("x", "int", 0)]
    assert rows(profile.null_profile(df)) == [("x", 0)]


def test_cleaned_table_has_47_columns_and_the_message_as_title(spark, sf_dir):
    from tradewind.plans.tables import wide

    table = wide(spark, sf_dir, geolocation=True)
    assert len(table.columns) == 41
    small = stage(clean.clean(table))
    assert len(small.columns) == 47
    assert small.where("review_comment_title <> coalesce(review_comment_message, 'no_comment')").isEmpty()
    ranged = clean.clean(table)
    assert small.exceptAll(ranged.select(small.columns)).isEmpty()


def test_titles_that_are_not_used_are_not_staged(spark, sf_dir):
    from tradewind.plans.tables import wide

    cleaned = clean.clean(wide(spark, sf_dir, geolocation=True))
    assert cleaned.columns.index("review_comment_title") + 1 == cleaned.columns.index("review_comment_message")
    staged = spark.read.parquet(*cleaned.inputFiles()).columns
    assert "review_comment_message" in staged and "review_comment_title" not in staged


def test_a_wide_table_without_titles_gets_them_in_their_place(spark, sf_dir, rows):
    from tradewind.plans.tables import wide

    table = wide(spark, sf_dir, geolocation=True)
    full, bare = clean.clean(table), clean.clean(table.drop("review_comment_title"))
    assert bare.columns == full.columns
    assert rows(bare) == rows(full)


def test_the_query_cleans_a_wide_table_whose_texts_are_joined_already(spark, sf_dir, monkeypatch):
    from tradewind.plans import tables

    given = []
    cleaning = clean.clean
    monkeypatch.setattr(clean, "clean", lambda wide: given.append(wide) or cleaning(wide))
    assert len(tables.cleaned_table(spark, sf_dir).columns) == 47
    assert "review_comment_title" not in given[0].columns
    assert "collect_list" not in given[0]._jdf.queryExecution().executedPlan().toString()


def test_edges_of_texts_are_unicode_white_space(spark):
    """Every character of the basic plane, against the class of regular expressions; none is searched for by one."""
    chars = spark.range(1, 0x10000).where("id NOT BETWEEN 55296 AND 57343").select(
        F.decode(F.unhex(F.lpad(F.hex("id"), 4, "0")), "UTF-16BE").alias("c"))
    text = F.concat("c", F.lit(" "), "c", F.lit("a"), "c", F.lit("b\n"), "c")
    by_search = F.regexp_replace(F.lower(text), r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z", "")
    assert chars.where(normalized(text) != by_search).count() == 0
    assert chars.where(normalized(F.col("c")) == "").count() == 29
    assert "regexp" not in chars.select(normalized(text))._jdf.queryExecution().executedPlan().toString()
