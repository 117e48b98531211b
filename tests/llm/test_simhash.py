import random
from collections import Counter

import pytest
import xxhash
from llm.conftest import same_rows, texts_of
from pyspark.sql import functions as F

from patronscope.llm.simhash import links, signed, simhash_groups
from patronscope.operators.components import connected_components


def brute_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text).encode().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def brute_groups(prints):
    """prints: value -> smallest id; smallest id reachable over links of two bits or less."""
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a in prints:
        for b in prints:
            if a < b and (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    least = {}
    for p, i in prints.items():
        r = find(p)
        least[r] = min(least.get(r, i), i, key=lambda x: (x is None, x or 0))
    return {p: least[find(p)] for p in prints}


def test_groups(small, odd, empty):
    docs = small.unionByName(odd)
    found = simhash_groups(docs, keep_text=True)
    got = found.select("row.doc_id", F.hex("fp"), "component_id").collect()
    prints = [(i, brute_fingerprint(t)) for i, t in texts_of(docs)]
    first = {}
    for i, p in prints:
        first[p] = min(first[p], i, key=lambda x: (x is None, x or 0)) if p in first else i
    groups = brute_groups(first)
    same_rows(got, [(i, f"{p:X}", groups[p]) for i, p in prints])
    heads = Counter(r["component_id"] for r in found.where("first").select("component_id").collect())
    assert set(heads.values()) == {1} and set(heads) == set(groups.values())
    assert found.select("row.*").columns == docs.columns
    assert simhash_groups(empty).count() == 0


@pytest.mark.parametrize("cell_pairs", [2, 64])
@pytest.mark.parametrize("distance", [1, 2])
def test_links_join_what_all_pairs_join(spark, cell_pairs, distance):
    chance = random.Random(distance)
    prints = set()
    for _ in range(12):
        center = chance.getrandbits(64)
        for _ in range(25):
            prints.add(center)
            for _ in range(chance.randint(0, 3)):
                center ^= 1 << chance.randrange(64)
    prints = sorted(map(signed, prints))
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    found = links(df, distance, cell_pairs=cell_pairs)
    near = {(a, b) for a in prints for b in prints if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= distance}
    got = {(r["component"], r["node"]) for r in connected_components(found).collect()}
    all_pairs = spark.createDataFrame(list(near), "a long, b long")
    assert got == {(r["component"], r["node"]) for r in connected_components(all_pairs).collect()}
