"""Removal of repeated word sequences with difference-cover anchors.

A word goes if a window of ``WINDOW`` words that covers it starts earlier too: in a document with a smaller id, or
earlier in the same document.

1. Anchors. ``COVER`` is a difference cover modulo ``PERIOD``: for any two places there is a shift below the period that brings
   both to cover positions. Only the ``ANCHOR`` words at cover positions are hashed. Two equal windows therefore
   share an aligned anchor inside them, because ``PERIOD - 1 + ANCHOR <= WINDOW``. Batches send each distinct anchor once;
   its bucket says which occur more than once.
2. Extension. Windows that hold a shared anchor are extended to all ``WINDOW`` words, by two independent 64-bit hashes
   over the words. A batch sends each distinct one once with its smallest id; its bucket says whether a smaller id has it.
3. The words of the marked windows are cut.

Defined cases: a null text has no words; documents with fewer than ``WINDOW`` words lose nothing; a null id counts as
larger than any id; rows that share an id are separate documents of which neither is smaller; an empty table gives an
empty result; input columns stay inside ``row``, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType

from patronscope.llm.common import schema_with
from patronscope.llm.packed import (
    ANSWER,
    GOLD,
    MIX,
    SENT,
    Texts,
    answer_table,
    answered,
    by_bucket,
    group_starts,
    in_batches,
    mixed,
    pack_ids,
    sent_table,
    texts_of,
    unpack_ids,
)

WINDOW = 20
PERIOD = 13
COVER = (0, 1, 3, 9)
ANCHOR = 8
SLICE = 1 << 20

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _slices(texts: Texts) -> list[tuple[int, int]]:
    """Runs of whole documents of about ``SLICE`` bytes."""
    cuts, low = [], 0
    bounds = texts.bounds
    while low < len(bounds) - 1:
        high = max(low + 1, int(np.searchsorted(bounds, bounds[low] + SLICE, "right")) - 1)
        cuts.append((low, high))
        low = high
    return cuts


def word_hashes(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word, and the bounds of the documents among the words.

    The hash is a sum over the bytes of a mix of byte and place in the word.
    """
    hashes, counts = [], []
    for low, high in _slices(texts):
        at = texts.bounds[low : high + 1] - texts.bounds[low]
        data = texts.data[texts.bounds[low] : texts.bounds[high]]
        letter = ~IS_SPACE[data]
        begin = letter.copy()
        begin[1:] &= ~letter[:-1]
        heads = at[:-1][np.diff(at) > 0]
        begin[heads] = letter[heads]  # a word ends with its document
        starts = np.flatnonzero(begin)
        counts.append(np.diff(np.concatenate([[0], np.cumsum(begin)])[at]))
        if len(starts):
            place = np.arange(len(data)) - np.repeat(starts, np.diff(np.concatenate([starts, [len(data)]]))) if starts[0] == 0 else None
            if place is None:
                first = np.concatenate([[0], starts])
                place = np.arange(len(data)) - np.repeat(first, np.diff(np.concatenate([first, [len(data)]])))
            value = mixed((data.astype(np.uint64) + np.uint64(1)) * GOLD + place.astype(np.uint64) * MIX)
            value[~letter] = 0
            hashes.append(mixed(np.add.reduceat(value, starts) * GOLD))
    flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    return flat, np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype(np.int64) if counts else np.zeros(1, np.int64)


def run_hashes(words: np.ndarray, starts: np.ndarray, size: int, seed: int) -> np.ndarray:
    """A hash of the ``size`` words at each start."""
    out = np.full(len(starts), np.uint64(seed))
    for k in range(size):
        out = mixed(out * GOLD + words[starts + k])
    return out


def cover_places(bounds: np.ndarray) -> np.ndarray:
    """Words at cover positions of documents of at least ``WINDOW`` words that begin a whole anchor."""
    sizes = np.diff(bounds)
    place = np.arange(bounds[-1]) - np.repeat(bounds[:-1], sizes)
    chosen = np.isin(place % PERIOD, COVER) & (place + ANCHOR <= np.repeat(sizes, sizes)) & np.repeat(sizes >= WINDOW, sizes)
    return np.flatnonzero(chosen)


def distinct_anchors(texts: Texts) -> tuple:
    """(words, bounds, places, number of the distinct anchor at each place, distinct hashes, whether it repeats here)."""
    words, bounds = word_hashes(texts)
    places = cover_places(bounds)
    known, which, count = np.unique(run_hashes(words, places, ANCHOR, 1), return_inverse=True, return_counts=True)
    return words, bounds, places, which, known, count > 1


def open_windows(words: np.ndarray, bounds: np.ndarray, shared: np.ndarray) -> tuple:
    """Windows that hold a shared anchor: (start, document, two hashes); ``shared``: the places of such anchors."""
    sizes = np.diff(bounds)
    seen = np.zeros(len(words) + 1, np.int64)
    seen[shared + 1] = 1
    seen = np.cumsum(seen)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(words)) - np.repeat(bounds[:-1], sizes)
    fits = np.flatnonzero(place + WINDOW <= np.repeat(sizes, sizes))
    start = fits[seen[fits + PERIOD] > seen[fits]] if len(fits) else fits
    return start, doc[start], run_hashes(words, start, WINDOW, 2), run_hashes(words, start, WINDOW, 3)


def distinct_windows(doc: np.ndarray, ids: np.ndarray, high: np.ndarray, low: np.ndarray) -> tuple:
    """(number of the distinct window at each, standing window of each number, whether it is seen earlier in the batch).

    Windows are in order of id and place.
    """
    order = np.lexsort((low, high))
    new = group_starts(high[order], low[order])
    group = np.cumsum(new) - 1
    heads = order[np.flatnonzero(new)]
    in_row = ~group_starts(group, doc[order])  # not the first of its document
    before = np.zeros(len(order), bool)
    before[order] = in_row | (ids[doc[order]] > ids[doc[heads]][group])
    back = np.argsort(heads, kind="stable")
    rank = np.empty(len(back), np.int64)
    rank[back] = np.arange(len(back))
    which = np.empty(len(order), np.int64)
    which[order] = rank[group]
    return which, heads[back], before


def remove_repeated_windows(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", with_kept: bool = False, cell_bytes: int | None = None
) -> DataFrame:
    """(row, n_words, n_removed, kept_sha256[, kept]) for every document; kept words are joined by one space."""
    texts, n = in_batches(docs, id_col, text, **({"cell_bytes": cell_bytes} if cell_bytes else {}))
    names = ["bucket", "batch", "round", "keys", "more", "ids"]
    sent = SENT.format("keys binary, more binary, ids binary")

    def send(batch: pa.Table) -> pa.Table:
        *_, known, again = distinct_anchors(texts_of(batch))
        order, spans = by_bucket(known % np.uint64(n))
        number = batch.column("batch")[0].as_py()
        rows = [(b, number, 1, known[order[x:y]].tobytes(), np.packbits(again[order[x:y]]).tobytes(), b"") for b, x, y in spans]
        return sent_table(rows, names)

    def match(bucket: pa.Table) -> pa.Table:
        keys = [np.frombuffer(k, np.uint64) for k in bucket.column("keys").to_pylist()]
        again = [np.unpackbits(np.frombuffer(m, np.uint8), count=len(k)) for m, k in zip(bucket.column("more").to_pylist(), keys, strict=True)]
        _, which = np.unique(np.concatenate(keys), return_inverse=True)
        times = np.bincount(which, weights=1.0 + np.concatenate(again))
        flags = (times[which] > 1).astype(np.uint8)
        return _answers(bucket, 1, np.split(flags, np.cumsum([len(k) for k in keys])[:-1]))

    def send_open(batch: pa.Table, answers: pa.Table) -> pa.Table:
        if not batch.num_rows:
            return sent_table([], names)
        own = texts_of(batch)
        _, doc, high, low, _, standing, _ = _windows(own, answers, n)
        order, spans = by_bucket(high[standing] % np.uint64(n))
        at, number = standing[order], batch.column("batch")[0].as_py()
        rows = [
            (b, number, 2, high[at[x:y]].tobytes(), low[at[x:y]].tobytes(), pack_ids(own.ids[doc[at[x:y]]]))
            for b, x, y in spans
        ]
        return sent_table(rows, names)

    def compare(bucket: pa.Table) -> pa.Table:
        ids = [unpack_ids(x) for x in bucket.column("ids").to_pylist()]
        high = np.frombuffer(b"".join(bucket.column("keys").to_pylist()), np.uint64)
        low = np.frombuffer(b"".join(bucket.column("more").to_pylist()), np.uint64)
        who = np.concatenate(ids)
        order = np.lexsort((who, low, high))
        new = group_starts(high[order], low[order])
        flags = np.empty(len(who), np.uint8)
        flags[order] = who[order] > who[order][np.flatnonzero(new)][np.cumsum(new) - 1]
        return _answers(bucket, 2, np.split(flags, np.cumsum([len(x) for x in ids])[:-1]))

    fields = [("n_words", LongType()), ("n_removed", LongType()), ("kept_sha256", StringType())]
    schema = schema_with(texts.schema["row"].dataType, *fields, *([("kept", StringType())] if with_kept else []))

    def cut(batch: pa.Table, answers: pa.Table) -> pa.Table:
        own = texts_of(batch)
        start, _, high, _, which, standing, before = _windows(own, answers, n)
        _, bounds = word_hashes(own)
        flags = answered(answers, 2, high[standing] % np.uint64(n))
        hit = start[before | (flags[which] > 0)]
        marked = np.zeros(bounds[-1] + 1, np.int32)
        np.add.at(marked, hit, 1)
        np.add.at(marked, hit + WINDOW, -1)
        stays = np.cumsum(marked[:-1]) <= 0
        view, kept = memoryview(own.data), []
        for i in range(len(own.ids)):
            words = bytes(view[own.bounds[i] : own.bounds[i + 1]]).split()
            left = stays[bounds[i] : bounds[i + 1]]
            kept.append(b" ".join(words if left.all() else compress(words, left.tolist())))
        sizes = np.diff(bounds)
        columns = [
            batch.column("row").take(own.order), pa.array(sizes), pa.array(sizes - np.diff(np.concatenate([[0], np.cumsum(stays)])[bounds])),
            pa.array([hashlib.sha256(t).hexdigest() for t in kept], pa.string()),
        ]
        if with_kept:
            columns.append(pa.array([t.decode() for t in kept], pa.string()))
        return pa.table(columns, names=schema.names)

    batches = texts.groupBy("batch")
    first_answers = batches.applyInArrow(send, sent).groupBy("bucket").applyInArrow(match, ANSWER)
    opened = batches.cogroup(first_answers.groupBy("batch")).applyInArrow(send_open, sent)
    second_answers = opened.groupBy("bucket").applyInArrow(compare, ANSWER)
    answers = first_answers.unionByName(second_answers)
    return batches.cogroup(answers.groupBy("batch")).applyInArrow(cut, schema)


def _windows(own: Texts, answers: pa.Table, n: int) -> tuple:
    """The open windows of a batch after the first answers."""
    words, bounds, places, which, known, _ = distinct_anchors(own)
    shared = answered(answers, 1, known % np.uint64(n))
    start, doc, high, low = open_windows(words, bounds, places[shared[which] > 0])
    number, standing, before = distinct_windows(doc, own.ids, high, low)
    return start, doc, high, low, number, standing, before


def _answers(bucket: pa.Table, round_: int, parts: list[np.ndarray]) -> pa.Table:
    batches, name = bucket.column("batch").to_pylist(), bucket.column("bucket")[0].as_py()
    return answer_table([(b, name, round_, f.tobytes()) for b, f in zip(batches, parts, strict=True)])
