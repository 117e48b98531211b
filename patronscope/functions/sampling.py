"""Exact-size seeded samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: First digits of the digest by which rows are counted: at most 16^4 counts.
PREFIX_DIGITS = 4


def fixed_sample(df: DataFrame, keys: list[str], size: int, seed: int) -> DataFrame:
    """``min(size, rows)`` rows without replacement, the same rows on every run.

    Rows are ranked by a digest of key and seed. They are counted by its first digits, and only
    rows up to the digits that complete the sample are sorted, so the last task does not
    get ``size`` rows from every other one.
    """
    digest = F.md5(F.concat_ws("-", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))
    marked = df.withColumn("_digest", digest)
    prefix = F.substring("_digest", 1, PREFIX_DIGITS)
    counts = marked.groupBy(prefix.alias("_prefix")).agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(Window.orderBy("_prefix"))
    last = counts.select("_prefix", upto.alias("_upto")).where(F.col("_upto") >= size).agg(F.min("_prefix")).scalar()
    return (
        marked.where(prefix <= F.coalesce(last, F.lit("g")))  # fewer rows than asked for: all of them
        .orderBy("_digest", *keys)
        .limit(size)
        .drop("_digest")
    )
