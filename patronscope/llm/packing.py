"""Best-fit packing of documents into sequences under several capacities.

A sequence has room for so many tokens, so many documents and so much attention cost (the sum of the squared
lengths of its pieces). Pieces are placed by falling length; each goes to the open sequence that is fullest
afterwards, by the weighted norm of what is left of the capacities (``rule='norm'``) or by the weighted dot product of
the piece and what is left (``rule='dot'``), among those that have room under every constraint. A new sequence is opened
only if none has.

All demands of a piece follow from its length, of which there are at most as many as the token capacity. So the pieces
are counted by length, and the placement is planned for the counts: sequences in the same state are one interval of
sequence numbers, and a step of the plan fills an interval with pieces of one length, many at a time. The result is that of
placing the pieces one by one. The plan depends on the number of different lengths, not on the number of rows; every task
then places its rows by their rank among the pieces of their length. Ranks come from counts by task and length:
no sort, and a length that a third of the rows have is counted where the rows are.

Defined cases: null and empty texts have the end token only; a document longer than the longest piece is cut, its first
piece taking the remainder; repeated rows are packed one by one; very long texts are encoded whole, one at a time; an empty
table gives an empty result; input columns pass through inside ``row``.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType

from patronscope.llm.common import packed_rows, schema_with
from patronscope.llm.encoders import byte_encoder, text_of
from patronscope.session import settle


class Limits(NamedTuple):
    """Capacities of a sequence, and the weights of the three when the fullest is chosen."""

    tokens: int = 1024
    documents: int = 1024
    cost: int = 1024 * 1024
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01)

    def longest(self) -> int:
        """The longest piece that an empty sequence has room for."""
        return min(self.tokens, math.isqrt(self.cost))


class Plan(NamedTuple):
    """Steps by (length, rank): pieces of ``length`` with rank from ``rank`` on go to the sequences from ``sequence``
    on, ``each`` to one, the first at ``offset``."""

    length: np.ndarray
    rank: np.ndarray
    each: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int


def plan_best_fit(counts: dict[int, int], limits: Limits, rule: str = "norm") -> Plan:
    """The placement of ``counts`` pieces by length. ``counts`` has at most ``limits.tokens`` entries."""
    if limits.documents < 1 or rule not in ("norm", "dot"):
        raise ValueError("a sequence needs room for a document, and rule is 'norm' or 'dot'")
    capacity = np.array([limits.tokens, limits.documents, limits.cost], np.int64)
    weights = np.array(limits.weights)
    room, size, first = np.zeros((0, 3), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    steps: list[tuple[int, int, int, int, int]] = []
    opened = 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        if not 1 <= length <= limits.longest():
            raise ValueError(f"a piece of {length} tokens fits no sequence")
        need = np.array([length, 1, length * length], np.int64)
        while left:
            fits = np.flatnonzero((room >= need).all(axis=1))
            if len(fits):
                if rule == "norm":
                    spare = (weights * ((room[fits] - need) / capacity) ** 2).sum(axis=1)
                else:
                    spare = (weights * (need / capacity) * (room[fits] / capacity)).sum(axis=1)
                at = fits[np.lexsort((first[fits], spare))[0]]
            else:  # as many empty sequences as the pieces may need
                at, fresh = len(room), left
                room, size, first = np.vstack([room, capacity]), np.append(size, fresh), np.append(first, opened)
                opened += fresh
            each = int((room[at] // need).min())
            whole, rest = divmod(left, each)
            whole, bins = int(min(whole, size[at])), int(size[at])
            rest = rest if whole < bins else 0
            steps.append((length, rank, each, int(first[at]), int(limits.tokens - room[at, 0])))
            done, begin, before = whole * each + rest, int(first[at]), room[at].copy()
            parts = [(before - each * need, whole, begin)]
            if rest:
                parts.append((before - rest * need, 1, begin + whole))
            used = whole + (rest > 0)
            if len(fits):
                parts.append((before, bins - used, begin + used))
            else:
                opened = begin + used
            kept = np.arange(len(room)) != at
            new = [p for p in parts if p[1] and (p[0] >= 1).all()]  # the others are full
            room = np.vstack([room[kept], *[p[0] for p in new]])
            size = np.append(size[kept], [p[1] for p in new]).astype(np.int64)
            first = np.append(first[kept], [p[2] for p in new]).astype(np.int64)
            rank, left = rank + done, left - done
    columns = np.array(steps, np.int64).reshape(-1, 5).T
    order = np.lexsort((columns[1], columns[0]))
    return Plan(*columns[:, order], opened)


def best_fit(items: DataFrame, limits: Limits = Limits(), rule: str = "norm") -> DataFrame:
    """``items`` with ``sequence_id`` and ``offset``; their column ``length`` (long, 1 to ``limits.longest()``) is the size.

    ``items`` are written once. The driver gets one count for each length.
    """
    taken = {"task", "nth", "before", "sequence_id", "offset"} & set(items.columns)
    if taken:
        raise ValueError(f"columns in use: {sorted(taken)}")
    longest = limits.longest()
    numbered = items.withColumn("task", F.spark_partition_id()).withColumn("nth", F.lit(0).cast("long"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(longest + 1, np.int64)
        for batch in batches:
            length = batch.column("length").to_numpy()
            if len(length) and not (length.min() >= 1 and length.max() <= longest):
                raise ValueError(f"lengths are from 1 to {longest}")
            order = np.argsort(length, kind="stable")
            _, start, n = np.unique(length[order], return_index=True, return_counts=True)
            nth = np.empty(len(length), np.int64)
            nth[order] = np.arange(len(length)) - np.repeat(start, n)
            nth += seen[length]
            seen += np.bincount(length, minlength=longest + 1)
            yield batch.set_column(batch.schema.names.index("nth"), "nth", pa.array(nth))

    rows = settle(numbered.mapInArrow(number, numbered.schema), "pieces")
    by_task = rows.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = plan_best_fit(counts, limits, rule)
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    begin = by_task.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0).cast("long")).alias("before"))
    ranked = rows.join(begin, ["length", "task"]).select(
        *[f"`{c}`" for c in items.columns], (F.col("before") + F.col("nth")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    keys = plan.length * _RANKS + plan.rank
    table = (keys, plan.rank, plan.each, plan.sequence, plan.offset)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ranks, each, sequence, offset = table
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("sequence_id").to_numpy()
            step = np.searchsorted(keys, length * _RANKS + rank, side="right") - 1
            own, nth = np.divmod(rank - ranks[step], each[step])
            names = batch.schema.names
            batch = batch.set_column(names.index("sequence_id"), "sequence_id", pa.array(sequence[step] + own))
            yield batch.set_column(names.index("offset"), "offset", pa.array(offset[step] + nth * length))

    return ranked.mapInArrow(place, ranked.schema)


#: Ranks of a length are below this: 2**46 pieces of each of 2**17 lengths.
_RANKS = 1 << 46


def pieces(
    docs: DataFrame, vocabulary: str, pattern: str, end_id: int, longest: int, text: str = "text", with_ids: bool = False
) -> DataFrame:
    """(row, piece, start, length, ids_crc32[, ids]) of every document: its ids by ``vocabulary`` and ``end_id`` behind them.

    ``ids`` are little-endian unsigned 32-bit integers.
    """
    rows = packed_rows(docs, text)
    added = [(n, LongType()) for n in ("piece", "start", "length", "ids_crc32")] + ([("ids", BinaryType())] if with_ids else [])
    schema = schema_with(rows.schema["row"].dataType, *added)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_encoder(vocabulary, pattern, True)
        for batch in batches:
            at, found = [], []
            for i, value in enumerate(batch.column("data")):
                ids = np.append(encode(text_of(value.as_py())), end_id).astype("<u4")
                n = -(-len(ids) // longest)
                ends = len(ids) - longest * np.arange(n - 1, -1, -1)
                for k, (low, high) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)):
                    data = ids[low:high].tobytes()
                    at.append(i)
                    found.append((k, low, high - low, zlib.crc32(data), data)[: len(added)])
            columns = list(zip(*found, strict=True)) or [[]] * len(added)
            kinds = [pa.int64()] * 4 + [pa.binary()]
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row").take(pa.array(at, pa.int64())), *arrays], names=["row", *[n for n, _ in added]]
            )

    return rows.mapInArrow(cut, schema)


def pack_documents(
    docs: DataFrame, vocabulary: str, pattern: str, end_id: int, limits: Limits = Limits(), rule: str = "norm",
    text: str = "text", with_ids: bool = False,
) -> DataFrame:
    """(row, piece, start, length, ids_crc32[, ids], sequence_id, offset): all documents in sequences."""
    return best_fit(pieces(docs, vocabulary, pattern, end_id, limits.longest(), text, with_ids), limits, rule)
