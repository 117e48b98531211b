import hashlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from llm.conftest import same_rows, texts_of
from tokenizers import Tokenizer

from patronscope.llm.alignment import LOW, SHIFT, align, align_corpus, pack, tables, unpack
from patronscope.llm.encoders import byte_of_char

JSON = Path(P.path("byte_bpe_50k.json")).read_text()
MODEL = Path(P.path("piece_bpe_32k.model")).read_bytes()
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


class Plain:
    """Links token by token, with the two libraries."""

    def __init__(self):
        self.a = Tokenizer.from_str(JSON)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
        self.chars = byte_of_char()

    def tokens(self, text):
        """[(id, bytes)] of both sides, or None."""
        if not text:
            return None
        found = self.a.encode(" " + text, add_special_tokens=False)
        a = [(i, bytes(self.chars[c] for c in self.a.id_to_token(i))) for i in found.ids]
        b = [(i, bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode())
             for i in self.b.encode(text) for p in [self.b.id_to_piece(i)]]
        whole = (" " + text).encode()
        return (a, b) if b"".join(t for _, t in a) == b"".join(t for _, t in b) == whole else None

    def groups(self, a, b):
        out, i, j = [], 0, 0
        while i < len(a):
            left, right, p, q = [a[i][0]], [b[j][0]], len(a[i][1]), len(b[j][1])
            i, j = i + 1, j + 1
            while p != q:
                if p < q:
                    left.append(a[i][0])
                    p, i = p + len(a[i][1]), i + 1
                else:
                    right.append(b[j][0])
                    q, j = q + len(b[j][1]), j + 1
            out.append((left, right))
        return out

    def rows(self, texts):
        """(doc_id, digest columns) of all documents, and the pair counts."""
        found = []
        for who, text in texts:
            both = self.tokens(text)
            groups = self.groups(*both) if both else []
            found.append((who, both or ([], []), groups, Counter((x, y) for g in groups for x in g[0] for y in g[1])))
        counts = Counter(pair for *_, links in found for pair in links)
        best = defaultdict(int)
        for (a, _), n in counts.items():
            best[a] = max(best[a], n)
        out = []
        for who, (a, b), groups, links in found:
            text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
            out.append((
                who, len(a), len(b), len(groups), sum(links.values()), sum(n for p, n in links.items() if counts[p] == best[p[0]]),
                sum(n * counts[p] for p, n in links.items()), hashlib.sha256(text.encode()).hexdigest() if groups else "",
            ))
        return out, counts


@pytest.fixture(scope="module")
def plain():
    return Plain()


@pytest.mark.parametrize("batch,chunk", [(16_000_000, 1_000_000), (20_000, 3_000)])
def test_alignment_equals_plain(spark, small, odd, plain, batch, chunk):
    more = [(1, "▁mark"), (2, " leading"), (3, "trailing  "), (4, "a\tb\r\nc"), (5, "�"), (6, "x" * 300 + "=" * 3000), (7, "<s> </s> <unk> <0x41>"),
            (8, "ﬁ ½ Å ｆｕｌｌ"), (9, "12345 6,789.01"), (9, "12345 6,789.01"), (None, "no id"), (10, "ab \x00 c"), (11, "ก็ไม่ได้ 한국어 שלום")]
    docs = small.unionByName(odd).select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string")).repartition(4)
    scored, pairs = align_corpus(docs, JSON, P.PATTERN, MODEL, with_groups=True, batch_bytes=batch, chunk_bytes=chunk)
    rows = scored.select("row.doc_id", *COLUMNS, "groups").collect()
    want, counts = plain.rows(texts_of(docs))
    same_rows([r[:-1] for r in rows], want)
    assert {(r["a"], r["b"]): r["documents"] for r in pairs.collect()} == dict(counts)
    assert all(r["groups_sha256"] == (hashlib.sha256(r["groups"].encode()).hexdigest() if r["groups"] else "") for r in rows)


def test_special_strings_are_plain_text(plain):
    a, b = plain.tokens("x <|endoftext|> y")
    assert 50256 not in [i for i, _ in a] and b"".join(t for _, t in b) == b" x <|endoftext|> y"


def test_wide_groups_are_counted_by_distinct_ids():
    t, _ = tables(JSON, MODEL)
    t = t._replace(length_a=np.array([2, 3, 1]), length_b=np.array([4, 5, 1]), same=np.array([-1, -1, 2]))
    a = np.array([2] + [0] * 200)  # bytes 1 + 2 * 200; with 4s shifted by 2 nothing meets before the end
    b = np.array([2, 2, 2, 2] + [0] * 99 + [2])
    found = align([a, np.zeros(0, np.int64)], [b, np.zeros(0, np.int64)], t)
    many = {(int(p) >> SHIFT, int(p) & LOW): int(n) for p, n in zip(found.pair, found.number)}
    groups = [([2], [2])]
    groups = Plain.groups(None, [(int(i), b"x" * int(t.length_a[i])) for i in a], [(int(i), b"x" * int(t.length_b[i])) for i in b])
    assert many == dict(Counter((x, y) for g in groups for x in g[0] for y in g[1]))
    a = np.array([0] * 2500 + [1])  # 5003 bytes
    b = np.array([0] * 1250 + [2] * 3)
    b = np.concatenate([[2], b[:-1]])
    found = align([a], [b], t)
    groups = Plain.groups(None, [(int(i), b"x" * int(t.length_a[i])) for i in a], [(int(i), b"x" * int(t.length_b[i])) for i in b])
    assert max(len(x) * len(y) for x, y in groups) > 4096
    many = {(int(p) >> SHIFT, int(p) & LOW): int(n) for p, n in zip(found.pair, found.number)}
    assert many == dict(Counter((x, y) for g in groups for x in g[0] for y in g[1]))


def test_packed_links():
    rng = np.random.default_rng(0)
    for n in (0, 1, 500):
        pair = np.sort(rng.choice(1 << 40, n, replace=False))
        number = rng.integers(1, 1 << 31, n)
        got = unpack(pack(pair, number))
        assert got[0].tolist() == pair.tolist() and got[1].tolist() == number.tolist()


def test_empty_table_and_clashing_names(spark, empty):
    scored, pairs = align_corpus(empty, JSON, P.PATTERN, MODEL)
    assert scored.count() == 0 and pairs.count() == 0
    docs = spark.createDataFrame([("a", "some text", 1, 2)], "row string, text string, batch long, links long")
    got = align_corpus(docs, JSON, P.PATTERN, MODEL)[0].first()
    assert (got["row"]["row"], got["row"]["batch"], got["row"]["links"], got["n_a"]) == ("a", 1, 2, 2)
    none = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert [tuple(r)[1:] for r in align_corpus(none, JSON, P.PATTERN, MODEL)[0].collect()] == [(0, 0, 0, 0, 0, 0, "")] * 2
