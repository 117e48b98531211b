"""Helpers shared by the corpus operators."""

from __future__ import annotations

import pickle
import sys
import types
import uuid
from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

#: White space of the word rule ``[^\x20\x09-\x0D]+``; ``bytes.split()`` uses the same set.
WHITE = " \t\n\x0b\x0c\r"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """Array of the words of a text; null and empty texts have none."""
    spaced = F.translate(F.coalesce(text, F.lit("")), WHITE, " " * len(WHITE))
    return F.filter(F.split(spaced, " "), lambda w: w != "")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packed_rows(docs: DataFrame, text: str = "text", keep_text: bool = False, **more: Column) -> DataFrame:
    """(row: the columns of ``docs`` as one struct, data: the text as bytes, ...).

    The struct keeps any name of the input apart from the names the operators add. With ``keep_text``
    the text is part of it and there is no ``data``; ``values_of`` reads either form.
    """
    kept = [docs[f"`{c}`"] for c in docs.columns if keep_text or c != text] or [F.lit(None).alias("none")]
    data = [] if keep_text else [F.coalesce(docs[f"`{text}`"].cast("binary"), F.lit(b"")).alias("data")]
    return docs.select(F.struct(*kept).alias("row"), *data, *[c.alias(k) for k, c in more.items()])


def values_of(batch: pa.RecordBatch, text: str = "text") -> list[bytes]:
    """The texts of a batch of packed rows as bytes; null is empty."""
    if "data" in batch.schema.names:
        return batch.column("data").to_pylist()
    return [v or b"" for v in pc.struct_field(batch.column("row"), [text]).cast(pa.binary()).to_pylist()]


def schema_with(row: StructType, *fields: tuple) -> StructType:
    return StructType([StructField("row", row), *[StructField(n, t) for n, t in fields]])


def worker_cache(name: str) -> dict:
    """A dictionary that outlives the task in this Python worker."""
    home = sys.modules.setdefault("_worker_cache", types.ModuleType("_worker_cache"))
    return home.__dict__.setdefault(name, {})


class Shared:
    """A broadcast value of any class of this package. Its classes travel with it, so executors need no copy of the
    package; a worker keeps the value it read last under each name."""

    def __init__(self, spark: SparkSession, name: str, value):
        self.name, self.key = name, uuid.uuid4().hex
        self.packed = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self):
        home = worker_cache("shared")
        if home.get(self.name, (None,))[0] != self.key:
            home[self.name] = self.key, pickle.loads(self.packed.value)
        return home[self.name][1]
