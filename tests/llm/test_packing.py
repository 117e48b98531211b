import random
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers as P
import pytest
from llm.conftest import texts_of
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from patronscope.llm.packing import Limits, best_fit, pack_documents, plan_best_fit

JSON = Path(P.path("byte_bpe_50k.json")).read_text()
SPLIT = P.PATTERN


def one_by_one(lengths, limits, rule):
    """Best fit by falling length, a piece at a time: what is left of each sequence."""
    capacity, weights = np.array(limits[:3]), np.array(limits.weights)
    rooms = []
    for length in sorted(lengths, reverse=True):
        need = np.array([length, 1, length * length])
        scores = []
        for i, room in enumerate(rooms):
            if (room >= need).all():
                spare = ((room - need) / capacity) ** 2 if rule == "norm" else (need / capacity) * (room / capacity)
                scores.append((float((weights * spare).sum()), i))
        if scores:
            rooms[min(scores)[1]] -= need
        else:
            rooms.append(capacity - need)
    return rooms


LIMITS = [Limits(), Limits(100, 100, 10_000), Limits(100, 3, 10_000), Limits(100, 100, 3_000, (1.0, 0.5, 2.0)), Limits(60, 7, 2_000, (1.0, 1.0, 1.0))]


@pytest.mark.parametrize("rule", ["norm", "dot"])
@pytest.mark.parametrize("limits", LIMITS)
def test_plan_is_best_fit_piece_by_piece(limits, rule):
    chance = random.Random(5)
    longest = limits.longest()
    for n in (0, 1, 7, 300):
        lengths = [min(longest, max(1, int(chance.paretovariate(0.7)))) for _ in range(n)] + [longest // 3 + 1] * (n // 2)
        counts = defaultdict(int)
        for length in lengths:
            counts[length] += 1
        plan = plan_best_fit(counts, limits, rule)
        rooms = one_by_one(lengths, limits, rule)
        assert plan.sequences == len(rooms)
        used = defaultdict(lambda: np.zeros(3, np.int64))
        for length, rank, each, sequence, _ in zip(*plan[:5]):
            later = [r for x, r in zip(plan.length, plan.rank) if x == length and r > rank]
            for i in range(min(later, default=counts[length]) - rank):
                used[int(sequence + i // each)] += [length, 1, length * length]
        assert sorted(tuple(np.array(limits[:3]) - u) for u in used.values()) == sorted(map(tuple, rooms))


def check_sequences(rows, limits):
    """Every sequence is gapless from 0 and keeps all limits; the number of sequences."""
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by.values():
        places.sort()
        assert [o for o, _ in places] == [0, *np.cumsum([n for _, n in places]).tolist()[:-1]]
        assert sum(n for _, n in places) <= limits.tokens and len(places) <= limits.documents
        assert sum(n * n for _, n in places) <= limits.cost
    return len(by)


@pytest.mark.parametrize("limits", [Limits(), Limits(1024, 4, 1024 * 1024), Limits(512, 64, 90_000, (1.0, 1.0, 1.0))])
def test_documents_are_packed(small, odd, limits):
    docs = small.unionByName(odd).repartition(5)
    rows = pack_documents(docs, JSON, SPLIT, 2, limits, with_ids=True).select("row.doc_id", "*").collect()
    library = Tokenizer.from_str(JSON)
    wanted = []
    for i, text in texts_of(docs):
        ids = [*library.encode(text, add_special_tokens=False).ids, 2]
        head = len(ids) % limits.longest() or limits.longest()
        for k, (low, high) in enumerate(zip([0, *range(head, len(ids), limits.longest())], range(head, len(ids) + 1, limits.longest()))):
            data = np.array(ids[low:high], "<u4").tobytes()
            wanted.append((i, k, low, high - low, zlib.crc32(data), data))
    got = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"], bytes(r["ids"])) for r in rows]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)
    lengths = [n for _, _, _, n, _, _ in wanted]
    assert check_sequences(rows, limits) == len(one_by_one(lengths, limits, "norm"))
    if limits == Limits():
        assert check_sequences(rows, limits) <= 1.01 * sum(lengths) / limits.tokens + 1


def test_hot_length_and_clashing_names(spark):
    items = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 700).otherwise(F.col("id") % 900 + 1).cast("long").alias("length"), "id", F.lit(1).alias("rank"), F.lit("x").alias("row")
    )
    rows = best_fit(items.repartition(7)).collect()
    assert sorted(r["id"] for r in rows) == list(range(3000)) and {r["rank"] for r in rows} == {1}
    lengths = [r["length"] for r in rows]
    assert check_sequences(rows, Limits()) == len(one_by_one(lengths, Limits(), "norm"))
    with pytest.raises(ValueError):
        best_fit(items.withColumn("offset", F.lit(1)))
    docs = spark.createDataFrame([(1, "some text", 5, 6, "r")], "doc_id long, text string, length long, sequence_id long, row string")
    row = pack_documents(docs, JSON, SPLIT, 2).first()
    assert (row["row"]["length"], row["row"]["sequence_id"], row["row"]["row"], row["length"], row["offset"]) == (5, 6, "r", 3, 0)


def test_empty_table_and_long_white_space(spark, empty):
    assert pack_documents(empty, JSON, SPLIT, 2).count() == 0
    text = "a" + " " * 400_000 + "b <|endoftext|>" + "\n" * 10
    docs = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id long, text string")
    rows = pack_documents(docs, JSON, SPLIT, 2, with_ids=True).orderBy("row.doc_id", "piece").collect()
    ids = np.frombuffer(b"".join(bytes(r["ids"]) for r in rows if r["row"]["doc_id"] == 1), "<u4").tolist()
    assert ids == [*Tokenizer.from_str(JSON).encode(text, add_special_tokens=False).ids, 2]
    assert [(r["row"]["doc_id"], r["length"]) for r in rows if r["row"]["doc_id"] > 1] == [(2, 1), (3, 1)]
