"""Which tokens of two tokenizers cover the same text, counted over the corpus.

Both token sequences of a text cut the same bytes. Offsets where tokens of both end cut the text into groups; tokens of A and B
in one group are linked. An array from each id of A to the id of B with the same bytes (the identity map) is the fast
path: the documents that hold a link of this map are counted in one vector over the vocabulary per task. Only other
pairs are shuffled, each once for a batch of documents, and their counts go back to the batches that asked.

1. Tasks encode and align the texts, and write per document its sizes, the digest of its groups, and its links
   as distinct pairs with their numbers, packed.
2. One pass over these links counts documents: a vector per task for pairs of the identity map, one row for each batch
   and pair for the rest.
3. Pairs are summed. Identity counts and the highest count of each id of A are vectors over the vocabulary, known to all tasks.
4. Each batch meets the counts of its pairs and adds up its documents.

A batch is a run of documents of one task, closed at ``BATCH_BYTES`` of text; the packed links of a batch are several times smaller
than its text. Group lists of a batch are formed chunk by chunk. In a group of many tokens, equal ids are counted before
pairs are formed, so that a long run of one token costs one pair.

Defined cases: null and empty texts, and texts that either tokenizer does not give back byte by byte, have no tokens: zeros, and an
empty digest; repeated rows are documents of their own; very long texts form a chunk alone; an empty table gives an empty result;
input columns pass through inside ``row``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType

from patronscope.llm.common import packed_rows, schema_with, worker_cache
from patronscope.llm.encoders import byte_encoder, text_of, token_bytes
from patronscope.session import settle

#: Bytes of text in a batch and in a chunk of one; a document over either size is one alone.
BATCH_BYTES = 16_000_000
CHUNK_BYTES = 1_000_000
#: Groups with more links than this are counted by distinct ids.
WIDE = 4096
#: A pair is ``a << SHIFT | b``.
SHIFT = 20
LOW = (1 << SHIFT) - 1

COUNTED = ["n_a", "n_b", "n_groups", "n_links"]


class Tables(NamedTuple):
    """What alignment needs of two vocabularies: bytes per id of A and B, the identity map (-1: none), bytes and digits of ids."""

    length_a: np.ndarray
    length_b: np.ndarray
    same: np.ndarray
    bytes_b: list[bytes]
    digits: np.ndarray
    width: np.ndarray


def piece_bytes(library) -> list[bytes | None]:
    """The bytes of each id of a sentencepiece model; None for control ids, which no text gives."""
    def content(i: int) -> bytes | None:
        if library.is_control(i):
            return None
        piece = library.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if library.is_byte(i) else piece.replace("▁", " ").encode()

    return [content(i) for i in range(library.get_piece_size())]


def identity_map(bytes_a: dict[bytes, int], bytes_b: list[bytes | None], last: set[int], size: int) -> np.ndarray:
    """For each id of A the id of B with the same bytes, or -1. Ids in ``last`` (single bytes) give way to others."""
    by_bytes: dict[bytes, int] = {}
    for i in sorted(range(len(bytes_b)), key=lambda i: (i not in last, -i)):
        if bytes_b[i]:
            by_bytes[bytes_b[i]] = i
    out = np.full(size, -1, np.int64)
    for content, i in bytes_a.items():
        out[i] = by_bytes.get(content, -1)
    return out


def tables(vocabulary: str, model: bytes):
    """(tables, B's library) from the content of the two vocabulary files."""
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    known, added = token_bytes(vocabulary)
    size = max([*known.values(), *added.values()]) + 1
    bytes_b = piece_bytes(library)
    same = identity_map(known, bytes_b, {i for i in range(len(bytes_b)) if library.is_byte(i)}, size)
    length_a = np.zeros(size, np.int64)
    for content, i in known.items():
        length_a[i] = len(content)
    top = max(size, len(bytes_b))
    if top > LOW:
        raise ValueError(f"ids are below {LOW}")
    text = np.arange(top).astype(f"S{len(str(top))}")
    width = np.char.str_len(text)
    digits = text.view(np.uint8).reshape(top, -1)
    plain = [b or b"" for b in bytes_b]
    return Tables(length_a, np.array([len(b) for b in plain], np.int64), same, plain, digits, width), library


class Links(NamedTuple):
    """A chunk of documents: sizes, group lists, and links as (document, pair, number) sorted by document and pair."""

    sizes: np.ndarray
    groups: list[bytes]
    document: np.ndarray
    pair: np.ndarray
    number: np.ndarray


def summed(*parts: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, pair, number) with equal (document, pair) added up, sorted."""
    document, pair, number = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.lexsort((pair, document))
    document, pair, number = document[order], pair[order], number[order]
    new = np.ones(len(pair), bool)
    new[1:] = (document[1:] != document[:-1]) | (pair[1:] != pair[:-1])
    start = np.flatnonzero(new)
    return document[new], pair[new], np.add.reduceat(number, start) if len(start) else number


def align(ids_a: list[np.ndarray], ids_b: list[np.ndarray], t: Tables) -> Links:
    """Links and group lists of documents whose ids cover the same bytes; documents without tokens have neither."""
    n = len(ids_a)
    a = np.concatenate([np.zeros(0, np.int64), *ids_a]).astype(np.int64)
    b = np.concatenate([np.zeros(0, np.int64), *ids_b]).astype(np.int64)
    size_a, size_b = np.array([len(x) for x in ids_a], np.int64), np.array([len(x) for x in ids_b], np.int64)
    none = np.zeros(0, np.int64)
    if not len(a):
        return Links(np.zeros((n, 4), np.int64), [b""] * n, none, none, none)
    # all documents are one run of bytes: both sides end together at the end of each
    end_a, end_b = np.cumsum(t.length_a[a]), np.cumsum(t.length_b[b])
    at = np.searchsorted(end_b, end_a)
    both_a = end_b[at] == end_a
    both_b = np.zeros(len(b), bool)
    both_b[at[both_a]] = True
    group_a, group_b = np.cumsum(both_a) - both_a, np.cumsum(both_b) - both_b
    many_a, many_b = np.bincount(group_a), np.bincount(group_b)
    first_a, first_b = np.cumsum(many_a) - many_a, np.cumsum(many_b) - many_b
    owner = np.repeat(np.arange(n), size_a)[first_a]
    links = many_a * many_b
    sizes = np.column_stack([size_a, size_b, np.bincount(owner, minlength=n), np.bincount(owner, links, n).astype(np.int64)])

    # fast path: one token each, the same by the identity map
    head_a, head_b = a[first_a], b[first_b]
    exact = (links == 1) & (t.same[head_a] == head_b)
    parts = [(owner[exact], head_a[exact] << SHIFT | head_b[exact], np.ones(int(exact.sum()), np.int64))]
    rest = np.flatnonzero(~exact & (links <= WIDE))
    each = links[rest]
    group = np.repeat(rest, each)
    nth = np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each)
    left, right = np.divmod(nth, many_b[group])
    parts.append((owner[group], a[first_a[group] + left] << SHIFT | b[first_b[group] + right], np.ones(len(group), np.int64)))
    for g in np.flatnonzero(links > WIDE).tolist():
        some_a, times_a = np.unique(a[first_a[g] : first_a[g] + many_a[g]], return_counts=True)
        some_b, times_b = np.unique(b[first_b[g] : first_b[g] + many_b[g]], return_counts=True)
        pairs = (some_a[:, None] << SHIFT | some_b).ravel()
        parts.append((np.full(len(pairs), owner[g]), pairs, np.outer(times_a, times_b).ravel()))
    return Links(sizes, group_lists(a, b, group_a, group_b, many_a, many_b, size_a + size_b, t), *summed(*parts))


def group_lists(a, b, group_a, group_b, many_a, many_b, tokens: np.ndarray, t: Tables) -> list[bytes]:
    """``a1,a2|b1;a3|b2`` of each document; ``tokens`` are both sides' tokens of each."""
    ids = np.empty(len(a) + len(b), np.int64)
    mark = np.full(len(ids), ord(","), np.uint8)
    before_a, before_b = np.cumsum(many_a) - many_a, np.cumsum(many_b) - many_b
    ids[np.arange(len(a)) + before_b[group_a]] = a
    ids[np.arange(len(b)) + (before_a + many_a)[group_b]] = b
    ends = np.cumsum(many_a + many_b)
    mark[ends - 1] = ord(";")
    mark[ends - many_b - 1] = ord("|")
    cells = np.empty((len(ids), t.digits.shape[1] + 1), np.uint8)
    cells[:, :-1] = t.digits[ids]
    used = t.width[ids]
    cells[np.arange(len(ids)), used] = mark
    flat = cells[np.arange(cells.shape[1]) <= used[:, None]].tobytes()
    bounds = np.concatenate([[0], np.cumsum(used + 1)])[np.concatenate([[0], np.cumsum(tokens)])].tolist()
    return [flat[low : max(low, high - 1)] for low, high in zip(bounds[:-1], bounds[1:], strict=True)]


def pack(pair: np.ndarray, number: np.ndarray) -> bytes:
    """Ascending pairs as differences and their numbers, byte planes apart."""
    steps = np.diff(pair, prepend=np.int64(0)).astype("<i8").view(np.uint8).reshape(-1, 8)[:, :6]
    return np.ascontiguousarray(np.hstack([steps, number.astype("<u4").view(np.uint8).reshape(-1, 4)]).T).tobytes()


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(data, np.uint8).reshape(10, -1).T
    steps = np.zeros((len(planes), 8), np.uint8)
    steps[:, :6] = planes[:, :6]
    return np.cumsum(steps.view("<i8").ravel()), np.ascontiguousarray(planes[:, 6:]).view("<u4").ravel().astype(np.int64)


def unpack_all(data: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place in the list, pair, number) of packed links."""
    found = [unpack(d) for d in data]
    place = np.repeat(np.arange(len(data)), [len(p) for p, _ in found])
    return place, *(np.concatenate([np.zeros(0, np.int64), *c]) for c in ([p for p, _ in found], [m for _, m in found]))


def aligned(
    docs: DataFrame, vocabulary: str, pattern: str, model: bytes, text: str = "text", with_groups: bool = False,
    batch_bytes: int = BATCH_BYTES, chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """(row, batch, n_a, n_b, n_groups, n_links, groups_sha256, links[, groups]), written by ``align_corpus``."""
    rows = packed_rows(docs, text).withColumn("batch", F.spark_partition_id().cast("long"))
    added = [("batch", LongType()), *[(n, LongType()) for n in COUNTED], ("groups_sha256", StringType()), ("links", BinaryType())]
    added += [("groups", StringType())] if with_groups else []
    schema = schema_with(rows.schema["row"].dataType, *added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        home = worker_cache("alignment")
        key = hash((vocabulary, model))
        if key not in home:
            home[key] = tables(vocabulary, model)
        t, library = home[key]
        encode = byte_encoder(vocabulary, pattern, False)

        def both(value: bytes) -> tuple[np.ndarray, np.ndarray]:
            nothing = np.zeros(0, np.int64), np.zeros(0, np.int64)
            if not value:
                return nothing
            known = text_of(value)
            b = library.encode(known, num_threads=1)
            if b"".join([t.bytes_b[i] for i in b]) != b" " + value:
                return nothing
            a = encode(" " + known)
            return (a, np.array(b, np.int64)) if t.length_a[a].sum() == len(value) + 1 else nothing

        part, filled = 0, 0
        for batch in batches:
            size = pc.binary_length(batch.column("data")).to_numpy(zero_copy_only=False).astype(np.int64)
            chunk = np.cumsum(size) // chunk_bytes
            for low, high in zip(*_runs(chunk), strict=True):
                values = batch.column("data").slice(low, high - low)
                ids = [both(v.as_py()) for v in values]
                found = align([x for x, _ in ids], [x for _, x in ids], t)
                n = len(ids)
                at = np.searchsorted(found.document, np.arange(n + 1))
                if filled + size[low:high].sum() > batch_bytes:
                    part, filled = part + 1, 0
                filled += int(size[low:high].sum())
                task = batch.column("batch")[low].as_py()
                arrays = [
                    batch.column("row").slice(low, n), pa.array(np.full(n, task << 32 | part)), *map(pa.array, found.sizes.T.copy()),
                    pa.array([hashlib.sha256(g).hexdigest() if g else "" for g in found.groups], pa.string()),
                    pa.array([pack(found.pair[i:j], found.number[i:j]) for i, j in zip(at[:-1], at[1:])], pa.binary()),
                ]
                if with_groups:
                    arrays.append(pa.array([g.decode() for g in found.groups], pa.string()))
                yield pa.RecordBatch.from_arrays(arrays, names=["row", *[f for f, _ in added]])

    return rows.mapInArrow(run, schema)


def _runs(key: np.ndarray) -> tuple[list[int], list[int]]:
    """Beginnings and ends of runs of equal values."""
    cuts = np.flatnonzero(np.diff(key)) + 1
    return ([0, *cuts.tolist()], [*cuts.tolist(), len(key)]) if len(key) else ([], [])


def link_counts(coded: DataFrame, same: np.ndarray) -> DataFrame:
    """(batch, pair, documents): how many documents hold a pair, by batch; for pairs of the identity map by task, ``batch`` null."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector = np.zeros(len(same), np.int64)
        open_batch, waiting = None, []

        def rows(batch, pair, documents):
            return pa.RecordBatch.from_arrays(
                [pa.array([batch] * len(pair), pa.int64()), pa.array(pair), pa.array(documents)], names=["batch", "pair", "documents"]
            )

        def close():
            if waiting:
                pair, documents = np.unique(np.concatenate(waiting), return_counts=True)
                yield rows(open_batch, pair, documents)
                waiting.clear()

        for batch in batches:
            names = batch.column("batch").to_numpy()
            links = batch.column("links")
            for low, high in zip(*_runs(names), strict=True):
                if names[low] != open_batch:
                    yield from close()
                    open_batch = int(names[low])
                for value in links.slice(low, high - low):
                    pair, _ = unpack(value.as_py())
                    a = pair >> SHIFT
                    exact = same[a] == (pair & LOW)
                    vector[a[exact]] += 1  # a pair is in a document's links once
                    waiting.append(pair[~exact])
        yield from close()
        used = np.flatnonzero(vector)
        yield rows(None, used << SHIFT | same[used], vector[used])

    return coded.select("batch", "links").mapInArrow(count, "batch long, pair long, documents long")


def align_corpus(
    docs: DataFrame, vocabulary: str, pattern: str, model: bytes, text: str = "text", with_groups: bool = False,
    batch_bytes: int = BATCH_BYTES, chunk_bytes: int = CHUNK_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """The documents (row, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256[, groups]) and the pair
    table (a, b, documents) of the corpus.

    A is the byte-level vocabulary with ``pattern`` on a space and the text, B the sentencepiece ``model`` on the text.
    """
    same = tables(vocabulary, model)[0].same
    coded = settle(aligned(docs, vocabulary, pattern, model, text, with_groups, batch_bytes, chunk_bytes), "aligned")
    sent = settle(link_counts(coded, same), "links")
    exact = sent.where("batch is null").groupBy("pair").agg(F.sum("documents").alias("documents"))  # at most one row per id of A
    other = settle(sent.where("batch is not null").groupBy("pair").agg(F.sum("documents").alias("documents")), "pairs")
    highest = other.groupBy(F.shiftright("pair", SHIFT).alias("a")).agg(F.max("documents").alias("documents"))
    known = np.zeros(len(same), np.int64)
    rows = exact.toArrow()
    known[rows.column("pair").to_numpy() >> SHIFT] = rows.column("documents").to_numpy()
    best = known.copy()
    rows = highest.toArrow()
    a = rows.column("a").to_numpy()
    best[a] = np.maximum(best[a], rows.column("documents").to_numpy())
    asked = sent.where("batch is not null").select("batch", "pair").join(other, "pair")
    names = [n for n in coded.columns if n not in ("batch", "links")]
    after = names.index("n_links") + 1
    given = coded.schema
    schema = schema_with(given["row"].dataType)
    for n in [*names[1:after], "n_best", "count_sum", *names[after:]]:
        schema.add(n, given[n].dataType if n in names else LongType())

    def finish(documents: pa.Table, answers: pa.Table) -> pa.Table:
        order = np.argsort(answers.column("pair").to_numpy(), kind="stable")
        pairs, counts = answers.column("pair").to_numpy()[order], answers.column("documents").to_numpy()[order]
        place, pair, number = unpack_all(documents.column("links").to_pylist())
        a = pair >> SHIFT
        exact = same[a] == (pair & LOW)
        count = np.where(exact, known[a], 0)
        count[~exact] = counts[np.searchsorted(pairs, pair[~exact])]
        n = documents.num_rows
        total, top = np.zeros(n, np.int64), np.zeros(n, np.int64)
        np.add.at(total, place, number * count)
        np.add.at(top, place, np.where(count == best[a], number, 0))
        more = {"n_best": pa.array(top), "count_sum": pa.array(total)}
        return pa.table({n: more[n] if n in more else documents.column(n) for n in schema.names})

    scored = coded.groupBy("batch").cogroup(asked.groupBy("batch")).applyInArrow(finish, schema)
    pairs = exact.unionByName(other).select(
        F.shiftright("pair", SHIFT).cast("int").alias("a"), F.col("pair").bitwiseAND(F.lit(LOW)).cast("int").alias("b"), "documents"
    )
    return scored, pairs
