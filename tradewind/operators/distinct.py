"""Exact distinct counts at several grains from one pass over the facts.

A distinct count of a month does not add up to that of its year; a set of bits does. Every
key gets a number, and each finest group a bitmap of the numbers it holds. Coarser groups are
the union of their parts: a month's bitmap is made of facts, a year's of months'. What is
shuffled per group is one bit for each key of a range of 32,768 numbers, whatever the rows.

Numbers run without gaps within a task of the staged keys, so few ranges are mostly empty. A
bitmap has 4 KB, so this is for groups of many keys, as of periods, places and categories, not
for millions of groups with a handful of keys each.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.sources.staging import stage


def distinct_counts(df: DataFrame, key: str, families: Mapping[str, Sequence[str]]) -> DataFrame:
    """(family, grain, path, distinct_keys): the keys of every group of every grain.

    A family lists its grains, text or number columns, from the finest to the coarsest; a group is
    known by its values from its grain to the coarsest, which are the texts of `path`. Rows with a
    NULL in `key` or in any grain of a family do not count in that family.
    """
    # Each key in each of its groups once, before keys meet their numbers: a hot key has few groups.
    finest = F.explode(F.array(*[
        F.when(sum((F.col(grain).isNull().cast("int") for grain in grains), F.lit(0)) == 0, F.struct(
            F.lit(family).alias("family"), F.array(*[F.col(grain).cast("string") for grain in grains]).alias("path")))
        for family, grains in families.items()])).alias("cell")
    held = stage(df.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), finest).where("cell IS NOT NULL").select(
        "key", "cell.*").distinct(), "held")
    numbers = stage(held.select("key").distinct().withColumn("number", F.monotonically_increasing_id() + 1), "numbers")
    bitmaps = stage(held.join(numbers, "key").groupBy(
        "family", "path", F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits")), "bitmaps")
    names = F.create_map(*[
        part for family, grains in families.items() for part in (F.lit(family), F.array(*map(F.lit, grains)))])
    # A part stands in its own group and in those it is a part of.
    levels = F.explode(F.sequence(F.lit(0), F.size("path") - 1)).alias("level")
    united = bitmaps.select("family", "path", "bucket", "bits", levels).groupBy(
        "family", "level", F.expr("slice(path, level + 1, size(path))").alias("path"), "bucket").agg(
        F.bitmap_or_agg("bits").alias("bits"))
    return united.groupBy("family", "level", "path").agg(F.sum(F.bitmap_count("bits")).alias("distinct_keys")).select(
        "family", F.get(F.element_at(names, F.col("family")), F.col("level")).alias("grain"), "path", "distinct_keys")
