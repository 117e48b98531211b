"""Writing results. Parquet is the default, CSV an option."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    options = {}
    if fmt == "csv":
        # as text, times have the loader's form and a fraction of a second only where there is one
        times = {f.name for f in df.schema if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))}
        df = df.select(*[df[f"`{c}`"].cast("string").alias(c) if c in times else df[f"`{c}`"] for c in df.columns])
        # the writer would trim text by default
        options = dict(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    df.write.mode("overwrite").options(**options).format(fmt).save(path)
    return path


def read_table(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """A written table with the types it had."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.options(header=True, escape='"', multiLine=True)
    return reader.format(fmt).load(path)


def bytes_at(spark: SparkSession, path: str) -> int:
    """Size of a written table."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength()


def write_tables(tables: dict[str, DataFrame], folder: str, suffix: str = "", fmt: str = "parquet") -> dict[str, str]:
    return {
        name: write_table(df, f"{folder.rstrip('/')}/{name}{suffix}", fmt)
        for name, df in tables.items()
    }


def write_text(lines: DataFrame, path: str) -> str:
    """Write a short (line_no, line) table as one text file in line order."""
    lines.orderBy("line_no").select("line").coalesce(1).write.mode("overwrite").text(path)
    return path
