import datetime as dt
import time

import pytest
from pyspark.errors import AnalysisException

from tradewind.operators.timeseries import daily_sales
from tradewind.sources import (
    load_or_build, read_periods, read_raw, replace_periods, write_csv, write_fact_table, write_series,
)
from tradewind.sources.staging import stage


def test_csv_with_byte_order_mark(spark, tmp_path, rows):
    path = tmp_path / "names.csv"
    path.write_bytes("﻿product_category_name,product_category_name_english\na,b\nNA,c".encode())
    assert rows(read_raw(spark, str(path), "category_translation")) == [(None, "c"), ("a", "b")]


def test_reviews_with_line_ends_and_quotes(spark, tmp_path, rows):
    path = tmp_path / "reviews.csv"
    path.write_text('order_id,review_score,review_comment_title,review_comment_message\n'
                    'o1,5,"a ""title""","two\nlines, and a comma"\no2,x,,nan\n')
    assert rows(read_raw(spark, str(path), "reviews")) == [
        ("o1", 5, 'a "title"', "two\nlines, and a comma"), ("o2", None, None, None)]


def test_bad_values_are_null_and_nan_is_missing(spark, tmp_path, rows):
    path = tmp_path / "items.csv"
    path.write_text("order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
                    "o1,1,p,s,2018-01-02 03:04:05,1.5,NaN\no2,x,p,s,never,,2\n")
    assert rows(read_raw(spark, str(path), "order_items")) == [
        ("o1", 1, "p", "s", dt.datetime(2018, 1, 2, 3, 4, 5), 1.5, None), ("o2", None, "p", "s", None, None, 2.0)]


def test_missing_file_raises(spark, tmp_path):
    with pytest.raises(AnalysisException):
        read_raw(spark, str(tmp_path / "none.csv"), "orders")


def test_series_is_written_in_order(spark, tmp_path):
    df = spark.createDataFrame([(dt.date(2018, 1, 2), 2.0), (dt.date(2018, 1, 1), 1.5)], "order_date DATE, total_sales DOUBLE")
    write_series(df, str(tmp_path / "daily"))
    (part,) = (tmp_path / "daily").glob("part-*")
    assert part.read_text() == "order_date,total_sales\n2018-01-01,1.5\n2018-01-02,2.0\n"


def test_fact_table_is_partitioned_by_month(spark, sf_dir, tmp_path):
    from tradewind.plans.tables import facts

    path = str(tmp_path / "facts")
    table = facts(spark, sf_dir, "order")
    write_fact_table(table, path)
    again = spark.read.parquet(path)
    assert again.count() == table.count()
    plan = again.where("order_purchase_year = 1997 AND order_purchase_month = 3")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(order_purchase_year" in plan


def test_whole_way_from_files(spark, sf_dir, tmp_path):
    """Raw CSV files to the cleaned table, and the rebuilt table where there is none yet."""
    from tradewind.plans.flows import build_cleaned_table, forecast_sales
    from tradewind.plans.roles import role
    from tradewind.schemas import RAW_SCHEMAS

    paths = {}
    for name in RAW_SCHEMAS:
        if name == "reviews":
            df = role(spark, sf_dir, "reviews_by_order")
        elif name == "payments":
            df = role(spark, sf_dir, "payments_by_type")
        else:
            df = role(spark, sf_dir, name)
        paths[name] = str(tmp_path / name)
        write_csv(df.select(RAW_SCHEMAS[name].names), paths[name])
    cleaned_path = str(tmp_path / "cleaned")

    rebuilt = load_or_build(spark, cleaned_path, paths, fill="zero")
    cleaned = build_cleaned_table(spark, paths, cleaned_path)
    assert len(cleaned.columns) == 47 and cleaned.count() > 0
    loaded = load_or_build(spark, cleaned_path, paths)
    assert loaded.exceptAll(cleaned).isEmpty()
    assert daily_sales(rebuilt).count() >= daily_sales(cleaned).count()

    result = forecast_sales(cleaned, horizon=40)
    assert result.future.count() == 40
    assert result.accuracy.first().rmse > 0
    assert result.fits.count() == result.daily.where("split = 'train'").count()


def stored(spark, path):
    """Months with 20 rows each, one of them NULL."""
    from pyspark.sql import functions as F

    df = spark.range(120).select("id", F.lit(2020).alias("order_purchase_year"), F.when(F.col("id") % 6 > 0, F.col("id") % 6).cast("int").alias("order_purchase_month"))
    write_fact_table(df, path)
    return df


def files(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


def test_replaced_months_leave_the_others_alone(spark, tmp_path):
    path = tmp_path / "months"
    df = stored(spark, str(path))
    before = files(path)
    new = df.where("order_purchase_month = 3").withColumn("id", df.id + 1000)
    replace_periods(new, str(path), [(2020, 3), (2020, 5)])
    after = files(path)
    kept = {name: at for name, at in before.items() if "month=3" not in name and "month=5" not in name}
    assert kept and all(after[name] == at for name, at in kept.items())
    months = {row[0]: row[1:] for row in spark.read.parquet(str(path)).groupBy("order_purchase_month").agg({"*": "count", "id": "min"}).collect()}
    assert set(months) == {None, 1, 2, 3, 4} and 1003 in months[3] and 20 in months[3]
    with pytest.raises(ValueError):
        replace_periods(new, str(path), [(2020, 4)])
    assert files(path) == after
    replace_periods(new.limit(0), str(path), [(2020, None), (2020, 3)])
    assert spark.read.parquet(str(path)).count() == 60


def test_only_the_wanted_months_are_opened(spark, tmp_path):
    stored(spark, str(tmp_path / "months"))
    month = read_periods(spark, str(tmp_path / "months"), [(2020, 2), (2020, None)])
    assert {(r.order_purchase_month) for r in month.collect()} == {2, None} and month.count() == 40
    filters = month._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("], PushedFilters")[0]
    assert "order_purchase_year" in filters and "order_purchase_month" in filters


def test_a_staged_table_leaves_no_shuffle_files(spark):
    """They go when it is written, not when the driver happens to collect its garbage."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return {name for name in (file.getName() for file in _each(files.getAllFiles())) if name.startswith("shuffle_")}

    def _each(found):
        return (found.apply(i) for i in range(found.size()))

    before = shuffled()
    staged = stage(spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count())
    staged = stage(staged.groupBy("k").agg({"count": "sum"}).repartition(3))
    for _ in range(50):  # the files of an execution are removed by a message after its end
        if not (left := shuffled() - before):
            break
        time.sleep(0.1)
    assert not left and staged.count() == 7
