"""CSV and Parquet sources and sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.functions import null_if_nan
from tradewind.schemas import MULTI_LINE_TABLES, RAW_SCHEMAS
from tradewind.sources.records import read_quoted_csv

# The unquoted words the usual CSV readers of data frames take as missing.
MISSING_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def missing_to_null(df: DataFrame, words: tuple[str, ...] = MISSING_WORDS) -> DataFrame:
    """NULL for NaN in floating point columns and for a missing word in text columns."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            column = null_if_nan(column)
        elif isinstance(field.dataType, T.StringType) and words:
            column = F.when(~column.isin(*words), column)
        columns.append(column.alias(field.name))
    return df.select(columns)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    multi_line: bool = False,
    missing_words: tuple[str, ...] = MISSING_WORDS,
    place: str | None = None,
) -> DataFrame:
    """CSV with a header and a declared schema; a value that does not parse is NULL.

    A path that does not exist raises. `place` adds a number in the order of the rows of a
    file, if values may hold line ends.
    """
    if multi_line:
        raw = read_quoted_csv(spark, path, schema, place)
    else:
        raw = spark.read.schema(schema).csv(path, header=True, quote='"', escape='"', mode="PERMISSIVE")
    return missing_to_null(raw, missing_words)


def read_raw(spark: SparkSession, path: str, table: str, place: str | None = None) -> DataFrame:
    """One of the nine raw tables, by its key in RAW_SCHEMAS."""
    return read_csv(spark, path, RAW_SCHEMAS[table], multi_line=table in MULTI_LINE_TABLES, place=place)


def read_raw_tables(spark: SparkSession, paths: Mapping[str, str], places: Mapping[str, str] | None = None) -> dict[str, DataFrame]:
    """All raw tables; `places` names a column for the place in the file of the rows of a table."""
    return {table: read_raw(spark, path, table, (places or {}).get(table)) for table, path in paths.items()}


def with_file_order(df: DataFrame, name: str) -> DataFrame:
    """Number the rows of a freshly read table so that the rows of a file are in file order.

    The numbers only order rows, they are neither dense nor meant to be stored.
    """
    return df.withColumn(name, F.monotonically_increasing_id())


def read_cleaned(spark: SparkSession, path: str) -> DataFrame:
    return missing_to_null(spark.read.parquet(path), words=())


def load_or_build(
    spark: SparkSession, cleaned_path: str, raw_paths: Mapping[str, str], fill: str = "median",
) -> DataFrame:
    """The cleaned table where it exists, else one rebuilt from the raw tables."""
    from tradewind.operators.denormalize import rebuild_wide

    try:
        return read_cleaned(spark, cleaned_path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    return rebuild_wide(read_raw_tables(spark, raw_paths), fill=fill)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, quoted so that `read_csv` gets the same values back."""
    df.write.mode("overwrite").csv(path, header=True, quote='"', escape='"')


PERIOD = ("order_purchase_year", "order_purchase_month")


def _by_period(df: DataFrame, partition_by: tuple[str, ...]):
    """A writer with the rows of a period in as many even files as its size asks for.

    The rebalance hint gathers them; a month with a third of all rows is split, small months share a task.
    """
    return df.hint("rebalance", *[F.col(name) for name in partition_by]).write.mode("overwrite").partitionBy(*partition_by)


def write_fact_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = PERIOD) -> None:
    """Parquet by purchase month."""
    _by_period(df, partition_by).parquet(path)


def replace_periods(df: DataFrame, path: str, periods: Sequence[tuple], partition_by: tuple[str, ...] = PERIOD) -> None:
    """Put the rows of `df` in the place of those of `periods` in a table of `write_fact_table`.

    The files of all other periods stay as they are and are not read. A period of the list without rows in
    `df` is emptied; rows of `df` outside the listed periods raise, before anything is written.
    Periods are values of `partition_by`, None for NULL. `df` must not read the same table.
    """
    listed = reduce(lambda a, b: a | b, [_in_period(period, partition_by) for period in periods], F.lit(False))
    counted = {tuple(row)[:-1]: row["count"] for row in df.groupBy(*partition_by).count().where(~listed).limit(1).collect()}
    if counted:
        raise ValueError(f"rows of {next(iter(counted))} are not in the periods to replace")
    _by_period(df, partition_by).option("partitionOverwriteMode", "dynamic").parquet(path)
    # An overwrite leaves the periods alone that have no rows.
    filled = {tuple(row) for row in df.select(*partition_by).distinct().collect()}  # at most one per listed period
    spark = df.sparkSession
    for period in periods:
        if tuple(period) not in filled:
            folder = "/".join(f"{name}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"
                              for name, value in zip(partition_by, period))
            target = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{folder}")
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _in_period(period: tuple, partition_by: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(name).eqNullSafe(F.lit(value)) for name, value in zip(partition_by, period)])


def read_periods(spark: SparkSession, path: str, periods: Sequence[tuple], partition_by: tuple[str, ...] = PERIOD) -> DataFrame:
    """The rows of some periods; the files of others are not opened."""
    chosen = reduce(lambda a, b: a | b, [
        reduce(lambda a, b: a & b, [F.col(name).isNull() if value is None else F.col(name) == F.lit(value)
                                    for name, value in zip(partition_by, period)]) for period in periods], F.lit(False))
    return missing_to_null(spark.read.parquet(path).where(chosen), words=())


def write_series(daily: DataFrame, path: str) -> None:
    """A daily series in date order (one row per calendar day, so one file)."""
    ordered = daily.select("order_date", "total_sales").repartition(1).sortWithinPartitions("order_date")
    write_csv(ordered, path)
