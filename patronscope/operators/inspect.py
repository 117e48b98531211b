"""Column lists, shapes, per-column information and summary statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronscope.functions.columns import most_common, union_all
from patronscope.functions.quantiles import exact_quantiles

Tables = dict[str, DataFrame]

TIMESTAMPS = (T.TimestampType, T.TimestampNTZType, T.DateType)


def quoted(df: DataFrame, name: str):
    return df[f"`{name}`"]


def column_list(tables: Tables) -> DataFrame:
    """(dataset, position, column, rows) of every column, with the rows of its table."""
    frames = []
    for name, df in tables.items():
        listed = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(c).alias("column")) for i, c in enumerate(df.columns)])
        counted = df.agg(F.count(F.lit(1)).alias("rows"))
        frames.append(counted.select(F.lit(name).alias("dataset"), F.inline(listed), "rows"))
    return union_all(frames)


def shapes(tables: Tables) -> DataFrame:
    return union_all(
        [
            df.agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(name).alias("dataset"), "rows", F.lit(len(df.columns)).alias("columns")
            )
            for name, df in tables.items()
        ]
    )


def per_column(df: DataFrame, dataset: str, aggregate, names: list[str], value: str) -> DataFrame:
    """One aggregate per column in a single pass, returned as one row per column."""
    row = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[aggregate(quoted(df, c)).alias(f"a{i}") for i, c in enumerate(names)],
    )
    entries = [
        F.struct(F.lit(c).alias("column"), F.col(f"a{i}").alias(value)) for i, c in enumerate(names)
    ]
    return row.select("rows", F.explode(F.array(*entries)).alias("e")).select(
        F.lit(dataset).alias("dataset"), F.col("e.column"), F.col(f"e.{value}"), "rows"
    )


def column_info(tables: Tables) -> DataFrame:
    """(dataset, column, dtype, non_null) for every column."""
    frames = []
    for name, df in tables.items():
        dtypes = F.create_map(*[F.lit(x) for pair in df.dtypes for x in pair])
        info = per_column(df, name, F.count, df.columns, "non_null")
        frames.append(info.select("dataset", "column", dtypes[F.col("column")].alias("dtype"), "non_null"))
    return union_all(frames)


def describe(df: DataFrame, dataset: str) -> DataFrame:
    """Summary of every column.

    Text columns get count, unique, top (ties to the smallest) and freq; numbers get
    count, mean, sample deviation, min, quartiles and max; timestamps the same without
    deviation, in epoch seconds.
    """
    spark = df.sparkSession
    numbers, texts, kinds = {}, [], {}
    for f in df.schema:
        if isinstance(f.dataType, TIMESTAMPS):
            kinds[f.name] = "timestamp"
            numbers[f.name] = F.unix_micros(quoted(df, f.name).cast("timestamp")) / F.lit(1e6)
        elif isinstance(f.dataType, T.NumericType):
            kinds[f.name] = "number"
            numbers[f.name] = quoted(df, f.name).cast("double")
        else:
            kinds[f.name] = "text"
            texts.append(f.name)
    frames = []
    if numbers:
        names = list(numbers)
        view = df.select(*[numbers[c].alias(f"n{i}") for i, c in enumerate(names)])
        quartiles = exact_quantiles(view, {f"n{i}": [0.25, 0.5, 0.75] for i in range(len(names))})
        stats = view.agg(
            *[
                F.struct(
                    F.count(f"n{i}").alias("count"),
                    F.avg(f"n{i}").alias("mean"),
                    (F.stddev_samp(f"n{i}") if kinds[c] == "number" else F.lit(None).cast("double")).alias("std"),
                    F.min(f"n{i}").alias("min"),
                    F.max(f"n{i}").alias("max"),
                ).alias(f"s{i}")
                for i, c in enumerate(names)
            ]
        )
        entries = []
        for i, c in enumerate(names):
            q25, q50, q75 = (F.lit(v).cast("double") for v in quartiles[f"n{i}"])
            entries.append(
                F.struct(
                    F.lit(c).alias("column"), F.lit(kinds[c]).alias("kind"), F.col(f"s{i}.count").alias("count"),
                    F.col(f"s{i}.mean").alias("mean"), F.col(f"s{i}.std").alias("std"), F.col(f"s{i}.min").alias("min"),
                    q25.alias("p25"), q50.alias("p50"), q75.alias("p75"), F.col(f"s{i}.max").alias("max"),
                )
            )
        frames.append(
            stats.select(F.explode(F.array(*entries)).alias("e")).select(
                F.lit(dataset).alias("dataset"), F.col("e.column"), F.col("e.kind"), F.col("e.count"),
                F.lit(None).cast("long").alias("unique"), F.lit(None).cast("string").alias("top"),
                F.lit(None).cast("long").alias("freq"),
                *[F.col(f"e.{s}") for s in ("mean", "std", "min", "p25", "p50", "p75", "max")],
            )
        )
    if texts:
        frames.append(_describe_text(df, dataset, texts, spark))
    return union_all(frames)


def _describe_text(df: DataFrame, dataset: str, texts: list[str], spark: SparkSession) -> DataFrame:
    # Counting values first keeps any column with many values spread over tasks.
    entries = F.array(
        *[F.struct(F.lit(c).alias("column"), quoted(df, c).cast("string").alias("value")) for c in texts]
    )
    counted = (
        df.select(F.explode(entries).alias("e"))
        .groupBy("e.column", "e.value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    known = F.col("value").isNotNull()
    stats = counted.groupBy("column").agg(
        F.sum(F.when(known, F.col("n")).otherwise(0)).alias("count"),
        F.count_if(known).alias("unique"),
        most_common(F.col("value"), F.col("n")).alias("top"),
        F.max(F.when(known, F.col("n"))).alias("freq"),
    )
    listed = spark.createDataFrame([(c,) for c in texts], "column string")
    nothing = F.lit(None).cast("double")
    return listed.join(stats, "column", "left").select(
        F.lit(dataset).alias("dataset"), "column", F.lit("text").alias("kind"),
        F.coalesce("count", F.lit(0)).cast("long").alias("count"),
        F.coalesce("unique", F.lit(0)).cast("long").alias("unique"), "top", "freq",
        *[nothing.alias(s) for s in ("mean", "std", "min", "p25", "p50", "p75", "max")],
    )


def describe_all(tables: Tables) -> DataFrame:
    return union_all([describe(df, name) for name, df in tables.items()])
