"""Reading the table set, from CSV as delivered or from Parquet."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronscope import schema
from patronscope.functions.columns import null_if_in
from patronscope.sources.csv_blocks import read_quoted_csv

Tables = dict[str, DataFrame]


@dataclass
class Catalog:
    """Tables that were found, and the name patterns that matched nothing."""

    tables: Tables
    missing: dict[str, str]


def csv_pattern(table: str, prefix: str = "*") -> str:
    """File name pattern of a table: ``<prefix><table>_dataset.csv``, by default with any prefix."""
    if table == "category_name_translation":
        return schema.TRANSLATION_FILE
    return f"{prefix}{table}_dataset.csv"


def _matches(spark: SparkSession, pattern: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(str(s.getPath()) for s in (fs.globStatus(path) or []))


def load_csv_tables(spark: SparkSession, folder: str, names: list[str] | None = None, prefix: str = "*") -> Catalog:
    """Read the named tables; every column is text, null tokens become null.

    A match may be a file or a folder of part files. Missing tables are reported, and it
    is an error only if none is there. Two exports of a table side by side are an error; ``prefix`` names the one to read.
    """
    tables, missing = {}, {}
    for name in names or schema.TABLES:
        pattern = f"{folder.rstrip('/')}/{csv_pattern(name, prefix)}"
        paths = _matches(spark, pattern)
        if not paths:
            missing[name] = pattern
            continue
        if len(paths) > 1:
            raise ValueError(f"{name}: several files match {pattern}: {', '.join(paths)}")
        tables[name] = read_csv(spark, paths, multiline=name in schema.MULTILINE_TABLES)
    if not tables:
        raise FileNotFoundError(f"no input table found in {folder}")
    return Catalog(tables, missing)


def read_csv(spark: SparkSession, paths: list[str], multiline: bool = False) -> DataFrame:
    """CSV with header; quotes are doubled inside quoted fields. With ``multiline`` they may hold line breaks."""
    if multiline:
        return drop_null_tokens(read_quoted_csv(spark, paths))
    return drop_null_tokens(spark.read.options(header=True, quote='"', escape='"').csv(paths))


def drop_null_tokens(df: DataFrame, tokens: list[str] = schema.CSV_NULL_TOKENS) -> DataFrame:
    text = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    return df.select(
        *[null_if_in(df[f"`{c}`"], tokens).alias(c) if c in text else df[f"`{c}`"] for c in df.columns]
    )


def require(tables: Tables, *names: str) -> None:
    """Name the absent tables instead of failing later on a key."""
    absent = [n for n in names if n not in tables]
    if absent:
        raise KeyError(f"missing tables: {', '.join(absent)}")
