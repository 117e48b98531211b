"""Token counts with a two-tier lookup, all on the map side.

Tier one is a table of the frequent pre-tokens and their lengths in tokens, sent to every
worker; its size is bounded by ``table_size`` and ``MAX_PIECE``. Everything else is encoded by
the library and kept in the worker's cache. The frequent pre-tokens come from one pass over all
texts: each task keeps at most ``2 * table_size`` counters, and only those summaries are
shuffled, never the pre-tokens. The table decides speed alone: counts are exact with any table.

Defined cases: a null text is empty and has no tokens; the added tokens of the vocabulary are found
inside texts as the library's default does; an empty table gives an empty result; repeated rows
are counted one by one; very long texts are counted whole; input columns pass through inside ``row``, so their names cannot clash.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from patronscope.llm.common import packed_rows, schema_with, worker_cache

#: The split of the byte-level vocabulary, a fixed value of its format.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters outside these ranges may be classed differently by other versions of Unicode;
#: a text with one is split by the library's own splitter, and its pieces are looked up like others.
UNSURE = "[^\\x00-ɏͰ-ͳΑ-ΡΣ-ϿЀ-ҁ‐-‧‰-⁞₠-€一-龥]"

TABLE_SIZE = 32_768
MAX_PIECE = 64
CACHE_SIZE = 500_000


def added_tokens(vocabulary: str) -> list[str]:
    return [t["content"] for t in json.loads(vocabulary).get("added_tokens") or []]


def _splitter(vocabulary: str):
    import re

    import regex

    marks = added_tokens(vocabulary)
    cut = re.compile("|".join(re.escape(m) for m in sorted(marks, key=len, reverse=True))) if marks else None
    return regex.compile(PIECES), regex.compile(UNSURE), cut


def frequent_pieces(docs: DataFrame, vocabulary: str, text: str = "text", table_size: int = TABLE_SIZE) -> list[str]:
    """At most ``table_size`` frequent pre-tokens of all texts, by counters that each task prunes."""
    column = docs.select(F.coalesce(docs[text], F.lit("")).alias("text"))

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, _, cut = _splitter(vocabulary)
        counts: Counter = Counter()
        for batch in batches:
            for value in batch.column(0).to_pylist():
                for part in cut.split(value) if cut else [value]:
                    counts.update(pieces.findall(part))
                    if len(counts) > 2 * table_size:
                        counts = Counter(dict(counts.most_common(table_size)))
        found = [(p, n) for p, n in counts.most_common(table_size) if len(p) <= MAX_PIECE and n > 1]
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in found], pa.string()), pa.array([n for _, n in found], pa.int64())], names=["piece", "n"]
        )

    top = (
        column.mapInArrow(summaries, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "piece").limit(table_size)
    )
    return [r["piece"] for r in top.collect()]


def token_counts(
    docs: DataFrame, vocabulary: str, text: str = "text", table_size: int = TABLE_SIZE, cache_size: int = CACHE_SIZE
) -> DataFrame:
    """(row, n_bytes, n_tokens) for every document; ``vocabulary`` is the content of the JSON file."""
    from tokenizers import Tokenizer

    frequent = frequent_pieces(docs, vocabulary, text, table_size)
    library = Tokenizer.from_str(vocabulary)
    library.no_truncation()
    library.no_padding()
    lengths = [len(e.ids) for e in library.encode_batch(frequent, add_special_tokens=False)]
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast((vocabulary, dict(zip(frequent, lengths, strict=True))))
    rows = packed_rows(docs, text)
    schema = schema_with(rows.schema["row"].dataType, ("n_bytes", LongType()), ("n_tokens", LongType()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        vocabulary, table = shared.value
        pieces, unsure, cut = _splitter(vocabulary)
        home = worker_cache("token_counts")
        key = hash(vocabulary)
        if key not in home:
            own = Tokenizer.from_str(vocabulary)
            own.no_truncation()
            own.no_padding()
            home[key] = own, {}
        own, cache = home[key]

        class Tiers(dict):
            def __missing__(self, piece: str) -> int:
                n = cache.get(piece)
                if n is None:
                    n = len(own.encode(piece, add_special_tokens=False).ids)
                    if len(piece) <= MAX_PIECE:
                        if len(cache) >= cache_size:
                            cache.clear()
                        cache[piece] = n
                return n

        lookup = Tiers(table).__getitem__

        def split(part: str) -> list[str]:
            if unsure.search(part):
                return [part[low:high] for _, (low, high) in own.pre_tokenizer.pre_tokenize_str(part)]
            return pieces.findall(part)

        def tokens(value: str) -> int:
            parts = cut.split(value) if cut else [value]
            return sum(sum(map(lookup, split(part))) for part in parts) + len(parts) - 1

        for batch in batches:
            data = batch.column("data").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array([len(d) for d in data], pa.int64()), pa.array([tokens(d.decode()) for d in data], pa.int64())],
                names=["row", "n_bytes", "n_tokens"],
            )

    return rows.mapInArrow(count, schema)
