"""Order statistics by counting digits, without moving the rows.

The key at a position of a sorted column is found as a radix sort would find it, but only the
counts are shuffled. The first pass counts each column by a coarse digit that keeps the order: for
numbers the logarithm of the magnitude in steps of some four percent, with the sign. That
says into which digit a wanted position falls, and how many rows lie below. The next passes
look at the rows of these digits only, and split what lies between the least and the
greatest key of a digit into SPLIT equal parts, until a digit holds one key or so few rows
that its keys can be counted one by one. A pass is one scan of the wanted columns and one
partial aggregate of bounded size: no value is shuffled, no row is numbered or staged.

Every pass narrows each digit by the factor SPLIT, so a table a thousand times as large costs one
pass more. What comes to the driver is bounded: some 35,000 first digits a column (a few
hundred, where values are not spread over all magnitudes), then SPLIT + 1 digits or FEW
keys for each wanted position.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPLIT = 4096
# A digit with at most this many rows is counted key by key.
FEW = 2000
_STEPS = 23.0  # first digits per unit of the natural logarithm
_ZERO = 20_000  # more than any logarithm of a DOUBLE times _STEPS
_INFINITE, _NAN = 50_000, 60_000


@dataclass(frozen=True)
class Lane:
    """Keys to select from: a DOUBLE, BIGINT or STRING expression, NULL for rows that take no part.

    `positions` gives the wanted positions, from 0, for the number of keys. With a `weight`,
    a BIGINT of 1 or more, a row stands for as many equal ones.
    """

    key: Column
    positions: Callable[[int], Sequence[int]]
    weight: Column | None = None

    @property
    def times(self) -> Column:
        return F.lit(1).cast("bigint") if self.weight is None else self.weight.cast("bigint")


@dataclass(frozen=True)
class Found:
    key: object
    before: int     # keys that are less
    rows: int       # keys that are equal


@dataclass(frozen=True)
class Selected:
    rows: int                   # keys of the lane
    at: dict[int, Found]        # by position


@dataclass
class _Digit:
    lane: int
    low: object
    high: object
    before: int
    rows: int
    single: bool        # few enough to be counted key by key
    wanted: list[int] = field(default_factory=list)


def _coarse_number(key: Column) -> Column:
    """A first digit for DOUBLE and BIGINT keys. Functions whose results never fall where their argument grows."""
    number = key.cast("double")
    magnitude = F.abs(number)
    size = F.when(magnitude == float("inf"), _INFINITE).otherwise(F.floor(F.log(magnitude) * _STEPS) + _ZERO)
    return (F.when(F.isnan(number), F.lit(_NAN)).when(number > 0, size).when(number < 0, -size)
            .otherwise(0).cast("bigint"))


def _byte(text: Column, place: int) -> Column:
    """1 + the byte at a place (from 0) of the UTF-8 of a text, 0 beyond its end."""
    binary = text.cast("binary")
    return F.when(F.length(binary) > place,
                  F.conv(F.hex(F.substring(binary, place + 1, 1)), 16, 10).cast("bigint") + 1).otherwise(0)


def _text_digit(text: Column, place: int) -> Column:
    return _byte(text, place) * 257 + _byte(text, place + 1)


def _split(key: Column, low: object, high: object) -> Column:
    """The digit of a key between `low` and `high`; these two get different ones."""
    if isinstance(low, str):
        a, b = low.encode(), high.encode()
        same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        return _text_digit(key, same)
    if isinstance(low, int):
        return F.floor((key - F.lit(low)) / F.lit((high - low) // SPLIT + 1)) if high - low < 1 << 52 else \
            F.shiftright(key - F.lit(low), max((high - low).bit_length() - 12, 0))
    if math.isinf(low) or math.isinf(high) or math.isnan(high):
        return F.when(key == F.lit(high), 1).otherwise(0).cast("bigint")
    return F.floor((key - F.lit(low)) / F.lit(high - low) * SPLIT)


def _counts() -> list[Column]:
    return [F.sum("times").alias("rows"), (F.count("*") <= F.lit(FEW)).alias("few"), F.min("key").alias("low"),
            F.max("key").alias("high")]


def order_statistics(df: DataFrame, lanes: Sequence[Lane]) -> list[Selected]:
    """For each lane its size and what is found at the wanted positions. All lanes have keys of one type.

    `df` is scanned once per pass, two to five times, and should be staged.
    """
    if not lanes:
        return []
    kind = df.select(lanes[0].key.alias("key")).schema["key"].dataType.simpleString()
    coarse = (lambda key: _text_digit(key, 0)) if kind == "string" else _coarse_number
    cells = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("lane"), lane.key.alias("key"), lane.times.alias("times"))
        for i, lane in enumerate(lanes)])).alias("c"))
    counted = cells.select("c.*").where("key IS NOT NULL").groupBy("lane", coarse(F.col("key")).alias("digit")).agg(*_counts())
    found: list[dict[int, Found]] = [{} for _ in lanes]
    digits: list[list[tuple]] = [[] for _ in lanes]
    for lane, digit, *counts in counted.collect():
        digits[lane].append((digit, *counts))
    todo: list[_Digit] = []
    totals = [sum(rows for _, rows, *_ in own) for own in digits]
    for i, (lane, own, total) in enumerate(zip(lanes, digits, totals)):
        wanted = sorted(set(lane.positions(total))) if total else []
        todo += _narrowed(i, sorted(own, key=lambda d: d[0]), 0, wanted, found[i])
    while todo:
        parts = []
        for j, digit in enumerate(todo):
            key = lanes[digit.lane].key
            one_by_one = digit.single
            parts.append(F.when(key.between(F.lit(digit.low), F.lit(digit.high)), F.struct(
                F.lit(j).alias("place"), (F.lit(0).cast("bigint") if one_by_one else _split(key, digit.low, digit.high)).alias("digit"),
                (key if one_by_one else F.lit(None).cast(kind)).alias("single"), key.alias("key"),
                lanes[digit.lane].times.alias("times"))))
        here = df.select(F.explode(F.array(*parts)).alias("c")).where("c IS NOT NULL").select("c.*")
        counted = here.groupBy("place", "digit", "single").agg(*_counts())
        split: list[list[tuple]] = [[] for _ in todo]
        for place, digit, _, rows, few, low, high in counted.collect():
            # Keys counted one by one are ordered by themselves.
            split[place].append(((digit, low if low == low else math.inf), rows, few, low, high))
        todo = [narrow for digit, own in zip(todo, split) for narrow in _narrowed(
            digit.lane, sorted(own, key=lambda d: d[0]), digit.before, digit.wanted, found[digit.lane])]
    return [Selected(total, at) for total, at in zip(totals, found)]


def _narrowed(lane: int, digits: Sequence[tuple], before: int, wanted: Sequence[int],
              found: dict[int, Found]) -> list[_Digit]:
    """The digits that hold wanted positions; those with one key go to `found`."""
    out, at = [], 0
    for _, rows, single, low, high in digits:
        inside = []
        while at < len(wanted) and wanted[at] < before + rows:
            inside.append(wanted[at])
            at += 1
        if inside and (low == high or low != low):
            key = low + 0.0 if isinstance(low, float) else low  # no negative zero
            found.update({position: Found(key, before, rows) for position in inside})
        elif inside:
            out.append(_Digit(lane, low, high, before, rows, single, inside))
        before += rows
    return out
