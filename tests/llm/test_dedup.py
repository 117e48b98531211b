import hashlib
import random

import numpy as np
import pytest
from llm.conftest import same_rows, texts_of

from patronscope.llm.packed import pack_ids, unpack_ids
from patronscope.llm.substring_dedup import ANCHOR, COVER, PERIOD, WINDOW, remove_repeated_windows
from patronscope.llm.suffix_dedup import Family, remove_repeats, seen_before

LAST = 1 << 62


def brute_bytes(docs, length=50):
    first = {}
    data = [(LAST if i is None else i, i, t.encode()) for i, t in docs]
    for who, _, d in data:
        for p in range(len(d) - length + 1):
            w = d[p : p + length]
            first[w] = min(first.get(w, who), who)
    for who, i, d in data:
        gone = bytearray(len(d))
        for p in range(len(d) - length + 1):
            if first[d[p : p + length]] < who:
                gone[p : p + length] = b"\x01" * length
        kept = bytes(b for b, g in zip(d, gone, strict=True) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        yield i, len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()


def brute_words(docs, size=20):
    first = {}
    data = [(LAST if i is None else i, i, t.encode().split()) for i, t in docs]
    for who, _, w in data:
        for p in range(len(w) - size + 1):
            k = tuple(w[p : p + size])
            first[k] = min(first.get(k, who), who)
    for who, i, w in data:
        gone, own = [0] * len(w), set()
        for p in range(len(w) - size + 1):
            k = tuple(w[p : p + size])
            if first[k] < who or k in own:
                gone[p : p + size] = [1] * size
            own.add(k)
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        yield i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()


@pytest.fixture(scope="module")
def tangled(spark):
    """Short alphabets, runs, shared passages at odd offsets, overlaps, copies."""
    chance = random.Random(5)
    pool = ["".join(chance.choices("ab c\n", k=chance.randint(30, 300))) for _ in range(12)] + ["a" * 120, "ab " * 50, "é漢 " * 30]
    rows = []
    for i in range(150):
        parts = [chance.choice(pool) for _ in range(chance.randint(0, 4))]
        parts = [p[chance.randint(0, 20) : len(p) - chance.randint(0, 20)] for p in parts]
        rows.append((1000 - i if i % 7 else i, "".join(parts) + "".join(chance.choices("abcdefgh ", k=chance.randint(0, 120)))))
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(5)


@pytest.mark.parametrize("hot", [1, 4096])
def test_bytes(tangled, odd, small, hot):
    docs = tangled.unionByName(odd.select("doc_id", "text")).unionByName(small.select("doc_id", "text").where("doc_id < 60"))
    got = remove_repeats(docs, hot_contexts=hot, cell_bytes=2_000).select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    same_rows(got, brute_bytes(texts_of(docs)))


def test_words(tangled, odd, small):
    docs = tangled.unionByName(odd.select("doc_id", "text")).unionByName(small.select("doc_id", "text"))
    got = remove_repeated_windows(docs, cell_bytes=2_000).select("row.doc_id", "n_words", "n_removed", "kept_sha256").collect()
    same_rows(got, brute_words(texts_of(docs)))


def test_clashing_names_and_empty(spark, empty):
    rows = [(1, "x y " * 40, 5, "b", 1), (2, "x y " * 40, 6, "c", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, batch long, data string, n_bytes int")
    got = remove_repeats(docs, with_kept=True)
    assert got.select("row.*").columns == ["doc_id", "batch", "data", "n_bytes"]
    same_rows(got.select("row.doc_id", "row.n_bytes", "n_bytes", "kept").collect(), [(1, 1, 160, b"x y " * 40), (2, 2, 160, b"")])
    same_rows(remove_repeated_windows(docs, with_kept=True).select("row.doc_id", "n_removed", "kept").collect(), [(1, 78, "x y"), (2, 80, "")])
    assert remove_repeats(empty).count() == 0 and remove_repeated_windows(empty).count() == 0


def test_cover_is_a_difference_cover():
    for shift in range(PERIOD):
        assert any((a + shift) % PERIOD in COVER for a in COVER)
    assert PERIOD - 1 + ANCHOR <= WINDOW


def test_family_levels_stay_few():
    chance = random.Random(2)
    family, known = Family(), {}
    for who in range(200):
        batch = np.unique(np.array([bytes(chance.choices(b"\x00ab", k=4)) for _ in range(20)], "S4"))
        found = family.scan(batch)
        for w, f in zip(batch.tolist(), found.tolist(), strict=True):
            assert known.get(w, np.iinfo(np.int64).max) == f
            known.setdefault(w, who)
        family.add(batch, np.minimum(found, who))
    assert len(family.levels) <= 8
    pieces = [b"abcabcabc", b"xabcx", b"abca"]
    assert seen_before(pieces, np.array([3, 1, 2]), 3, batch=4).tolist() == [1, 1, 0, 1, 1, 0, 1, 0, 0, 0, 1, 0]


def test_ids_round_trip():
    ids = np.array([0, 0, 5, 5, 900, (1 << 63) - 1])
    assert unpack_ids(pack_ids(ids)).tolist() == ids.tolist()
