"""Exact quantiles with linear interpolation at any row count.

A double is read as a 64-bit code with the same order. The code of an order statistic is found digit by digit (radix selection,
``DIGIT_BITS`` a pass): a pass counts the rows whose code begins with the digits found so far by their next digit, which are
at most 2**DIGIT_BITS counts for each order statistic, and the counts name the next digit. Each count carries the
smallest and the largest code behind it, so a search ends as soon as these are equal; four passes settle any column. All columns
and quantiles share the passes. Counts are summed on the map side, and the driver gets one row for each order statistic.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patronscope.session import settle

DIGIT_BITS = 16
_DIGITS = 1 << DIGIT_BITS
_LEVELS = 64 // DIGIT_BITS
_SIGN = 1 << 63


@dataclass
class _Search:
    """One order statistic: the digits found so far, and its rank among the rows that begin with them."""

    column: int
    p: float
    upper: bool  # the higher of the two neighbors of the position
    prefix: int = 0
    rank: int | None = None
    total: int = 0
    value: float | None = None
    done: bool = False


def exact_quantiles(df: DataFrame, wanted: dict[str, list[float]]) -> dict[str, list[float | None]]:
    """Quantiles per column, equal to ``percentile`` on the whole column; None without values.

    Nulls do not count, NaN is the largest value. ``df`` is read up to four times.
    """
    columns = list(wanted)
    searches = [_Search(i, p, upper) for i, c in enumerate(columns) for p in wanted[c] for upper in (False, True)]
    values = df.select(*[F.col(c).cast("double").alias(f"q{i}") for i, c in enumerate(columns)]) if columns else df
    for level in range(_LEVELS):
        pending = [s for s in searches if not s.done]
        if not pending:
            break
        _next_digit(values, pending, level)
    result: dict[str, list[float | None]] = {c: [] for c in columns}
    for low, high in zip(searches[::2], searches[1::2], strict=True):
        position = (low.total - 1) * low.p
        k, k2 = math.floor(position), math.ceil(position)
        same = low.value is None or k == k2 or low.value == high.value
        result[columns[low.column]].append(low.value if same else (k2 - position) * low.value + (position - k) * high.value)
    return result


def sorted_quantiles(df: DataFrame, wanted: dict[str, list[float]]) -> dict[str, list[float | None]]:
    """The same by sorting, with no task that holds all values: equal values are counted, the counts dealt over ranges of
    values, and the sizes of the ranges before are added to the running sum in a range."""
    result: dict[str, list[float | None]] = {}
    for c, ps in wanted.items():
        counted = df.select(F.col(c).cast("double").alias("value")).where(F.col("value").isNotNull())
        counted = counted.groupBy("value").agg(F.count(F.lit(1)).alias("n"))
        ranged = settle(counted.repartitionByRange("value").withColumn("part", F.spark_partition_id()), "ranged")
        before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
        sizes = ranged.groupBy("part").agg(F.sum("n").alias("held"))
        offsets = sizes.select("part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("skip"))
        total = ranged.agg(F.sum("n")).first()[0] or 0
        positions = [(total - 1) * p for p in ps]
        ranks = sorted({r for at in positions for r in (math.floor(at), math.ceil(at))}) if total else []
        upto = F.sum("n").over(Window.partitionBy("part").orderBy("value")) + F.col("skip")
        placed = ranged.join(offsets, "part").select("value", (upto - F.col("n")).alias("low"), upto.alias("upto"))
        hit = F.exists(F.array(*[F.lit(r).cast("long") for r in ranks]), lambda r: (r >= F.col("low")) & (r < F.col("upto")))
        rows = placed.where(hit).collect() if ranks else []  # two rows a quantile at most
        value = {r: row["value"] for r in ranks for row in rows if row["low"] <= r < row["upto"]}
        result[c] = [_between(value, at) if total else None for at in positions]
    return result


def _between(value: dict[int, float], position: float) -> float:
    k, k2 = math.floor(position), math.ceil(position)
    same = k == k2 or value[k] == value[k2]
    return value[k] if same else (k2 - position) * value[k] + (position - k) * value[k2]


def _next_digit(values: DataFrame, pending: list[_Search], level: int) -> None:
    """Count by the digit of ``level`` and take it over into the searches."""
    slots = sorted({(s.column, s.prefix) for s in pending})
    shift = np.uint64(64 - DIGIT_BITS * (level + 1))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for column in sorted({c for c, _ in slots}):
                codes = np.sort(_codes(batch.column(column)))
                for slot, (c, prefix) in enumerate(slots):
                    if c != column:
                        continue
                    low, high = prefix << int(shift) + DIGIT_BITS, (prefix + 1 << int(shift) + DIGIT_BITS) - 1
                    own = codes[np.searchsorted(codes, np.uint64(low)) : np.searchsorted(codes, np.uint64(high), side="right")]
                    digit, first, n = np.unique((own >> shift) & np.uint64(_DIGITS - 1), return_index=True, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(n), slot, np.int32)), pa.array(digit.astype(np.int32)), pa.array(n),
                         pa.array(_signed(own[first])), pa.array(_signed(own[first + n - 1]))],
                        names=["slot", "digit", "n", "low", "high"],
                    )

    counted = values.mapInArrow(count, "slot int, digit int, n long, low long, high long")
    summed = counted.groupBy("slot", "digit").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    slot = Window.partitionBy("slot")
    placed = summed.withColumns({"upto": F.sum("n").over(slot.orderBy("digit")), "total": F.sum("n").over(slot)})
    asked = values.sparkSession.createDataFrame(
        [(i, slots.index((s.column, s.prefix)), s.p, s.upper, s.rank) for i, s in enumerate(pending)],
        "item int, slot int, p double, upper boolean, rank long",
    )
    position = (F.col("total") - 1) * F.col("p")
    rank = F.coalesce("rank", F.when(F.col("upper"), F.ceil(position)).otherwise(F.floor(position)))
    hits = (
        placed.join(F.broadcast(asked), "slot").withColumn("rank", rank)  # two rows a quantile
        .where((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n")))
        .select("item", "digit", (F.col("rank") - F.col("upto") + F.col("n")).alias("rank"), "total", "low", "high")
    )
    found = {r["item"]: r for r in hits.collect()}
    for i, s in enumerate(pending):
        if i not in found:  # a column without values
            s.done = True
            continue
        r = found[i]
        s.prefix, s.rank = s.prefix << DIGIT_BITS | r["digit"], r["rank"]
        s.total = s.total or r["total"]
        if r["low"] == r["high"]:
            s.value, s.done = _decoded(r["low"]), True


def _codes(column: pa.Array) -> np.ndarray:
    """Unsigned codes in the order of the values; -0.0 is 0.0, and all NaN are one."""
    x = column.drop_null().to_numpy() + 0.0
    bits = np.where(np.isnan(x), np.nan, x).view(np.uint64)
    return np.where(bits >> np.uint64(63), ~bits, bits | np.uint64(_SIGN))


def _signed(codes: np.ndarray) -> np.ndarray:
    """The codes as signed numbers of the same order."""
    return (codes ^ np.uint64(_SIGN)).view(np.int64)


def _decoded(signed: int) -> float:
    code = np.array([signed], np.int64).view(np.uint64) ^ np.uint64(_SIGN)
    bits = np.where(code >> np.uint64(63), code ^ np.uint64(_SIGN), ~code)
    return float(bits.view(np.float64)[0])
