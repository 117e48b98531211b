"""Benchmark decontamination: rare words and word pairs as seeds, then Smith-Waterman alignment.

Test items are a stated query set; they are taken in blocks of bounded size, and each block meets all
documents. Two passes per block:

1. count how often every word and every pair of adjacent words of the items occurs (map-side sums, one row each);
   the rarest of them per item become its seeds;
2. where enough seeds of an item lie within the length of a passage, align it with the words around
   them. The score is the alignment's score over that of a perfect copy; substituted,
   inserted and dropped words lower it.

No pair of score ``min_score`` or more is lost. M matches and E edits score 2 M - E, and the matches
form at most E + 1 runs, so at least M - E - 1 adjacent pairs are intact: words and pairs together at least
score - 1. An item of L words has 2 L - 1 words and pairs. Of any ``most - least + t`` of them, ``least`` being the number
that must be intact and ``most`` all, t at least are. The counts only decide which are cheap to look for.

Defined cases: null texts have no words; items without words match nothing; an item of one word is
one seed; repeated items and documents give repeated rows; a document that holds an item more than once gives its best
passage; null ids are carried, ids keep their type; very long texts are searched whole; without documents or items the result is empty; other columns are
left out, or stay inside ``row``, so their names cannot clash.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType, LongType, StructField, StructType

from patronscope.llm.common import Shared, packed_rows, values_of

MIN_SCORE = 0.5
#: ``bounds`` relies on these costs.
MATCH, MISMATCH, GAP = 2, -1, -1
#: Of the words and pairs that must be intact, this part is looked for.
SEED_PART = 0.25
#: Bytes of item texts in a block, which is sent to all tasks.
BLOCK_BYTES = 8_000_000

WORD = re.compile(r"\w+")


class Items(NamedTuple):
    """A block of items: words as numbers, pairs of words as sorted codes; marks are the words, then the pairs."""

    words: dict[str, int]
    texts: list[np.ndarray]
    pairs: np.ndarray
    marks: list[np.ndarray]


class Seeds(NamedTuple):
    """Items by mark: those of mark m are ``item[first[m] : first[m + 1]]``. Per item the seeds and marks it takes and the length of a passage."""

    first: np.ndarray
    item: np.ndarray
    hits: np.ndarray
    least: np.ndarray
    span: np.ndarray


def pair_codes(ids: np.ndarray, words: int) -> np.ndarray:
    """One number per pair of neighbors; -1 is a word of no item, and no item holds a code made with it."""
    return (ids[:-1] + 1) * (words + 1) + ids[1:] + 1


def prepare(texts: list[str]) -> Items:
    words: dict[str, int] = {}
    numbered = [np.array([words.setdefault(w, len(words)) for w in WORD.findall(t.lower())], np.int64) for t in texts]
    codes = [pair_codes(t, len(words)) for t in numbered]
    pairs = np.unique(np.concatenate([np.zeros(0, np.int64), *codes]))
    marks = [np.concatenate([t, len(words) + np.searchsorted(pairs, c)]) for t, c in zip(numbered, codes, strict=True)]
    return Items(words, numbered, pairs, marks)


def text_marks(text: str, items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word numbers (-1: in no item), and the places and numbers of all marks in the text."""
    get = items.words.get
    ids = np.array([get(w, -1) for w in WORD.findall(text.lower())], np.int64)
    single = np.flatnonzero(ids >= 0)
    double = single[:-1][np.diff(single) == 1]
    codes = (ids[double] + 1) * (len(items.words) + 1) + ids[double + 1] + 1 if len(double) else double
    hit, at = find(items.pairs, codes)
    return ids, np.concatenate([single, double[hit]]), np.concatenate([ids[single], len(items.words) + at])


def find(known: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which of ``codes`` are among the sorted ``known``, their index)."""
    if not len(known):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(known, codes), len(known) - 1)
    hit = np.flatnonzero(known[at] == codes)
    return hit, at[hit]


def bounds(size: int, min_score: float) -> tuple[int, int]:
    """(marks that a copy of ``min_score`` keeps at least, words of its passage at most) for an item of ``size`` words."""
    need = math.ceil(min_score * MATCH * size - 1e-9)
    return max(need - 1, -(-need // MATCH), 1), size + MATCH * size - need


def choose_seeds(items: Items, counts: np.ndarray, min_score: float) -> Seeds:
    """The rarest marks of each item, so many that a copy of ``min_score`` keeps ``hits`` of them."""
    chosen, hits, least, span = [], [], [], []
    for own in items.marks:
        kept, longest = bounds((len(own) + 1) // 2, min_score)
        some = max(1, int(SEED_PART * kept))
        rare = own[np.argsort(counts[own], kind="stable")]
        chosen.append(np.unique(rare[: len(own) - kept + some]))
        hits.append(some)
        least.append(kept)
        span.append(longest)
    mark = np.concatenate([np.zeros(0, np.int64), *chosen])
    item = np.repeat(np.arange(len(chosen)), [len(c) for c in chosen])
    order = np.argsort(mark, kind="stable")
    first = np.searchsorted(mark[order], np.arange(len(counts) + 1))
    return Seeds(first, item[order], *[np.array(x, np.int64) for x in (hits, least, span)])


def seeded(places: np.ndarray, marks: np.ndarray, size: int, seeds: Seeds) -> dict[int, list[tuple[int, int]]]:
    """item -> parts of a text of ``size`` words that hold every passage with enough seeds of the item."""
    copies = seeds.first[marks + 1] - seeds.first[marks]
    total = int(copies.sum())
    if not total:
        return {}
    at = np.arange(total) + np.repeat(seeds.first[marks] - np.cumsum(copies) + copies, copies)
    step = size + int(seeds.span.max()) + 1
    key = np.sort(seeds.item[at] * step + np.repeat(places, copies))
    item = key // step
    last = np.arange(total) + seeds.hits[item] - 1
    inside = last < total
    item, key, end = item[inside], key[inside], key[last[inside]]
    near = end - key < seeds.span[item]
    item, key, end = item[near], key[near], end[near]
    lows = np.maximum(end - item * step - seeds.span[item] + 1, 0)
    highs = np.minimum(key - item * step + seeds.span[item], size)
    parts: dict[int, list[tuple[int, int]]] = {}
    for who, low, high in zip(item.tolist(), lows.tolist(), highs.tolist(), strict=True):
        own = parts.setdefault(who, [])
        if own and low <= own[-1][1]:
            own[-1] = own[-1][0], high
        else:
            own.append((low, high))
    return parts


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """(score, end in the passage) of the best local alignment with linear gaps."""
    row = np.zeros(len(passage) + 1, np.int64)
    slope = -GAP * np.arange(len(row))
    best, end = 0, 0
    for word in item.tolist():
        new = np.zeros_like(row)
        new[1:] = np.maximum(row[:-1] + np.where(passage == word, MATCH, MISMATCH), row[1:] + GAP)
        np.maximum(new, 0, out=new)
        row = np.maximum.accumulate(new + slope) - slope
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
    return best, end


def passages(
    ids: np.ndarray, parts: dict[int, list[tuple[int, int]]], items: Items, least: np.ndarray, min_score: float
) -> Iterator[tuple[int, float, int, int]]:
    """(item, score, first word, end word) of the best aligned passage per item; ``parts``: item -> where to look."""
    words = len(items.words)
    for item, spans in parts.items():
        own = items.texts[item]
        pairs = pair_codes(own, words)
        need = min_score * MATCH * len(own)
        best = (0, 0, 0)
        for a, b in spans:
            passage = ids[a:b]
            if np.isin(own, passage).sum() + np.isin(pairs, pair_codes(passage, words)).sum() < least[item]:
                continue
            score, end = align(own, passage)
            if score >= need and score > best[0]:
                _, back = align(own[::-1], passage[:end][::-1])
                best = (score, a + end - back, a + end)
        if best[0]:
            yield item, best[0] / (MATCH * len(own)), best[1], best[2]


def _blocks(benchmark: DataFrame, id_col: str, text: str, block_bytes: int) -> Iterator[list]:
    items = benchmark.select(F.col(f"`{id_col}`").alias("item"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, math.ceil(total / block_bytes))
    for part in range(parts):
        yield items.where(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == part).collect()


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", item_col: str = "item_id",
    item_text: str = "text", min_score: float = MIN_SCORE, block_bytes: int = BLOCK_BYTES, mark: bool = False,
) -> DataFrame:
    """(id, item, score, first_word, end_word) for every document and item that align.

    With ``mark`` (row, hits) for every document instead: its columns and how many items it holds.
    """
    rows = packed_rows(docs, text, keep_text=mark)
    spark, kind = docs.sparkSession, benchmark.schema[item_col].dataType
    result = None
    for block in _blocks(benchmark, item_col, item_text, block_bytes):
        items = prepare([r["text"] for r in block])
        shared = Shared(spark, "items", items)
        seeds = choose_seeds(items, _mark_counts(packed_rows(docs, text).select("data"), shared), min_score)
        plan = Shared(spark, "seeds", (seeds, [r["item"] for r in block]))
        if mark:
            found = _marked(rows if result is None else result, shared, plan, min_score, text)
        else:
            found = _pairs(rows.select(F.col(f"row.`{id_col}`").alias("id"), "data"), shared, plan, min_score, kind)
            found = found if result is None else result.unionByName(found)
        result = found
    return result


def _mark_counts(data: DataFrame, shared) -> np.ndarray:
    """How often each word and pair of the block occurs in the documents."""
    size = len(shared.value.words) + len(shared.value.pairs)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, sums = shared.value, np.zeros(size, np.int64)
        for batch in batches:
            for value in batch.column(0).to_pylist():
                np.add.at(sums, text_marks(value.decode(), items)[2], 1)
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(sums[used])], names=["mark", "n"])

    rows = data.mapInArrow(count, "mark long, n long").groupBy("mark").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(size)
    out[rows["mark"].to_numpy(np.int64)] = rows["n"]
    return out


def _search(shared, plan, min_score: float):
    """A function from a text to its aligned items."""
    items, (seeds, _) = shared.value, plan.value

    def search(text: str) -> list[tuple[int, float, int, int]]:
        ids, places, marks = text_marks(text, items)
        return list(passages(ids, seeded(places, marks, len(ids), seeds), items, seeds.least, min_score))

    return search


def _pairs(rows: DataFrame, shared, plan, min_score: float, kind: DataType) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, names = _search(shared, plan, min_score), plan.value[1]
        for batch in batches:
            out = []
            for who, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                out += [(who, names[i], s, a, b) for i, s, a, b in search(value.decode())]
            if out:
                columns = zip(*out, strict=True)
                kinds = [batch.schema.field(0).type, item_type, pa.float64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["id", "item", "score", "first_word", "end_word"]
                )

    item_type = to_arrow_type(kind)
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, item {kind.simpleString()}, score double, first_word long, end_word long")


def _marked(rows: DataFrame, shared, plan, min_score: float, text: str) -> DataFrame:
    again = "hits" in rows.columns
    schema = StructType([rows.schema["row"], StructField("hits", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = _search(shared, plan, min_score)
        for batch in batches:
            before = batch.column("hits").to_pylist() if again else [0] * batch.num_rows
            found = [n + len(search(v.decode())) for n, v in zip(before, values_of(batch, text), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(found, pa.int64())], names=["row", "hits"])

    return rows.mapInArrow(run, schema)
