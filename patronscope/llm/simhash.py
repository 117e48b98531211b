"""SimHash near-duplicates by a segment-popcount embedding.

Fingerprint: 64 bits over word shingles. Embedding: the popcount of every two-bit segment, kept in unary (the
bits of a segment sorted), so the Manhattan distance of two embeddings is the number of bits
in which the unary codes differ. It is a lower bound of the distance of the fingerprints.

Grid range-join: the 32 coordinates form ``BLOCKS`` blocks. Two embeddings within Manhattan distance
``distance`` agree in at least ``BLOCKS - distance`` of them, so they share a grid cell of one of the
choices of blocks. Pairs of a cell must pass the Manhattan bound, then the exact bit distance.
A cell of more than ``CELL_PAIRS`` fingerprints makes no pairs: its fingerprints are spread to all
fingerprints that differ in at most ``distance // 2`` bits; at distance 2 two fingerprints are linked
exactly if they meet in such a point, and each is linked to the smallest one there.

Only distinct fingerprints are joined; copies follow by membership. Components come from
star rounds over the links.

Defined cases: a null or empty text has fingerprint zero and is linked like any other; texts shorter than
the shingle are one shingle; a null id counts as larger than any id; repeated rows share a
component; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from patronscope.llm.common import packed_rows, schema_with, values_of
from patronscope.operators.components import connected_components
from patronscope.session import settle

SHINGLE = 3
DISTANCE = 2
BLOCKS = 5
CELL_PAIRS = 64
HASH_SEED = 42
SEGMENTS = 32
LOW_BITS = 0x5555555555555555


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def text_fingerprint(data: bytes, shingle: int) -> int:
    """The fingerprint of a text as an unsigned integer; 0 without words."""
    import numpy as np
    from xxhash import xxh64_intdigest

    words = data.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = min(shingle, len(words))
    spans = zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist(), strict=True)
    hashes = np.array([xxh64_intdigest(joined[a:b], HASH_SEED) for a, b in spans], "<u8")
    ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, keep_text: bool = False) -> DataFrame:
    """(row, fp) for every document."""
    rows = packed_rows(docs, text, keep_text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [signed(text_fingerprint(d, shingle)) for d in values_of(batch, text)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(found, pa.int64())], names=["row", "fp"])

    return rows.mapInArrow(run, schema_with(rows.schema["row"].dataType, ("fp", LongType())))


def embedding(fp: Column) -> Column:
    """Unary popcounts of the two-bit segments."""
    shifted = F.shiftrightunsigned(fp, 1)
    low = F.lit(LOW_BITS)
    return fp.bitwiseOR(shifted).bitwiseAND(low).bitwiseOR(F.shiftleft(fp.bitwiseAND(shifted).bitwiseAND(low), 1))


def bit_distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def cell_masks(blocks: int, distance: int) -> list[int]:
    """For every choice of blocks that may stay untouched, the bits of its coordinates."""
    masks = [
        sum(3 << (2 * s) for s in range(b * SEGMENTS // blocks, (b + 1) * SEGMENTS // blocks)) for b in range(blocks)
    ]
    return [signed(sum(chosen)) for chosen in combinations(masks, blocks - distance)]


def near_points(fp: Column, radius: int) -> Column:
    """All values that differ from ``fp`` in at most ``radius`` bits."""
    flips = [signed(reduce(int.__or__, (1 << b for b in bits), 0)) for r in range(radius + 1) for bits in combinations(range(64), r)]
    return F.transform(F.array(*map(F.lit, flips)), lambda f: fp.bitwiseXOR(f))


def links(distinct: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS, cell_pairs: int = CELL_PAIRS) -> DataFrame:
    """(a, b): links whose components are those of all pairs within ``distance`` (2 or less)."""
    if not 0 < distance <= 2:
        raise ValueError("the spread of crowded cells is exact for distances 1 and 2")
    masks = cell_masks(blocks, distance)
    cells = distinct.select("fp", embedding(F.col("fp")).alias("e")).select(
        "fp", "e",
        F.explode(F.array(*[F.struct(F.lit(i).alias("choice"), F.col("e").bitwiseAND(F.lit(m)).alias("cell")) for i, m in enumerate(masks)])).alias("at"),
    ).select("fp", "e", "at.choice", "at.cell")
    sizes = cells.groupBy("choice", "cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = settle(cells.join(sizes, ["choice", "cell"]), "cells")
    few = met.where(F.col("n") <= cell_pairs)
    other = few.select("choice", "cell", F.col("fp").alias("b"), F.col("e").alias("eb"))
    pairs = (
        few.select("choice", "cell", F.col("fp").alias("a"), F.col("e").alias("ea")).join(other, ["choice", "cell"])
        .where((F.col("a") < F.col("b")) & (bit_distance("ea", "eb") <= distance) & (bit_distance("a", "b") <= distance))
        .select("a", "b")
    )
    crowded = met.where(F.col("n") > cell_pairs).select("fp").distinct()
    if distance == 2:
        points = crowded.select("fp", F.explode(near_points(F.col("fp"), 1)).alias("point"))
        least = points.groupBy("point").agg(F.min("fp").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
        spread = points.join(least, "point").select(F.col("least").alias("a"), F.col("fp").alias("b"))
    else:
        points = crowded.select("fp", F.explode(near_points(F.col("fp"), 1)).alias("point"))
        spread = points.join(crowded.withColumnRenamed("fp", "b"), F.col("point") == F.col("b")).select(F.col("fp").alias("a"), "b")
    return pairs.unionByName(spread.where("a <> b")).distinct()


def simhash_groups(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE,
    keep_text: bool = False,
) -> DataFrame:
    """(row, fp, component_id, first) for every document.

    ``component_id`` is the smallest id reachable over links; ``first`` marks one row of each component.
    """
    marked = fingerprints(docs, text, shingle, keep_text)
    marked = settle(marked.withColumn("rid", F.monotonically_increasing_id()), "fingerprints")
    who = F.col(f"row.`{id_col}`")
    order = F.struct(who.isNull().alias("missing"), who.alias("id"), F.col("rid"))
    reps = settle(marked.groupBy("fp").agg(F.min(order).alias("head")), "representatives")
    found = connected_components(links(reps.select("fp"), distance)).withColumnRenamed("node", "fp")
    linked = reps.join(found, "fp")
    heads = linked.groupBy("component").agg(F.min("head").alias("lead"))
    led = linked.join(heads, "component").select("fp", "lead")
    # written, so that adaptive execution can split a hot fingerprint in the last join
    final = settle(reps.join(led, "fp", "left").select("fp", F.coalesce("lead", "head").alias("lead")), "leads")
    return (
        marked.join(final.hint("shuffle_hash"), "fp")
        .select("row", "fp", F.col("lead.id").alias("component_id"), (F.col("rid") == F.col("lead.rid")).alias("first"))
    )
