"""Batches of documents that exchange fingerprints in packed form.

A batch is a hash share of the documents of bounded size. It sends numpy arrays, one row for each bucket of
fingerprints; a bucket answers every batch with one value per fingerprint, in the order sent. Equal
fingerprints of a batch are sent once, so a hot one arrives at most once per batch. The texts are shuffled
once: all passes group the same frame by batch, and Spark reuses the exchange.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronscope.llm.common import packed_rows

#: Wanted bytes of text behind one row from a batch to a bucket, and most bytes in a batch.
CELL_BYTES = 20_000
BATCH_BYTES = 16_000_000
NO_ID = (1 << 63) - 1
MIX = np.uint64(0xBF58476D1CE4E5B9)
GOLD = np.uint64(0x9E3779B97F4A7C15)

SENT = "bucket int, batch long, round int, {}"
ANSWER = "batch long, bucket int, round int, flags binary"


class Texts(NamedTuple):
    """A batch in order of id and text: one byte array, document bounds, ids."""

    data: np.ndarray
    bounds: np.ndarray
    ids: np.ndarray
    order: pa.Array


def shares(total_bytes: int, cell_bytes: int = CELL_BYTES, batch_bytes: int = BATCH_BYTES) -> int:
    """Number of batches and of buckets."""
    return max(1, math.ceil(math.sqrt(total_bytes / cell_bytes)), math.ceil(total_bytes / batch_bytes))


def in_batches(docs: DataFrame, id_col: str, text: str, keep_text: bool = False, cell_bytes: int = CELL_BYTES) -> tuple[DataFrame, int]:
    """(row, data, id, batch) and the number of batches; a null id becomes ``NO_ID``."""
    who = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID))
    rows = packed_rows(docs, text, keep_text, id=who)
    total = rows.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    n = shares(total, cell_bytes)
    return rows.withColumn("batch", F.pmod(F.xxhash64("id", "data"), F.lit(n))), n


def texts_of(batch: pa.Table) -> Texts:
    order = pc.sort_indices(batch.select(["id", "data"]), sort_keys=[("id", "ascending"), ("data", "ascending")])
    column = batch.column("data").take(order).combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.binary())
    wide = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, wide)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    flat = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    return Texts(flat, bounds - bounds[0], batch.column("id").take(order).to_numpy(), order)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX
    return x ^ (x >> np.uint64(27))


def pack_ids(ids: np.ndarray) -> bytes:
    """Differences, byte planes apart: ids in ascending order compress well."""
    steps = np.diff(ids, prepend=np.int64(0)).astype("<i8")
    return steps.view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack_ids(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<i8").ravel())


def by_bucket(bucket: np.ndarray) -> tuple[np.ndarray, Iterator[tuple[int, int, int]]]:
    """A stable order by bucket, and (bucket, low, high) for every bucket used."""
    order = np.argsort(bucket, kind="stable")
    used, low, size = np.unique(bucket[order], return_index=True, return_counts=True)
    return order, list(zip(used.tolist(), low.tolist(), (low + size).tolist(), strict=True))


def answered(answers: pa.Table, round_: int, bucket: np.ndarray, kind=np.uint8) -> np.ndarray:
    """The answers of a round for every fingerprint sent, in the order of ``bucket``."""
    order, spans = by_bucket(bucket)
    out = np.zeros(len(bucket), kind)
    rounds, buckets, flags = (answers.column(c).to_pylist() for c in ("round", "bucket", "flags"))
    found = {b: f for r, b, f in zip(rounds, buckets, flags, strict=True) if r == round_}
    for name, low, high in spans:
        out[order[low:high]] = np.frombuffer(found[name], kind)
    return out


def sent_table(rows: list[tuple], names: list[str]) -> pa.Table:
    kinds = [pa.int32(), pa.int64(), pa.int32()] + [pa.binary()] * (len(names) - 3)
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def answer_table(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["batch", "bucket", "round", "flags"])


def group_starts(*keys: np.ndarray) -> np.ndarray:
    """For sorted columns, whether each row begins a new group."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = False
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
    return new
