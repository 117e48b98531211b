import hashlib
import random
from pathlib import Path

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from llm.conftest import same_rows, texts_of
from tokenizers import Tokenizer

from patronscope.llm.bpe import Decoder, Transducer, bpe_round_trip, merge_by_rank, read_ranks, waiting, whole_tokens
from patronscope.llm.token_counts import UNSURE, frequent_pieces, token_counts

JSON = Path(P.path("byte_bpe_50k.json")).read_text()
RANKS = Path(P.path("byte_bpe_multi_50k.tiktoken")).read_bytes()
WHOLE = whole_tokens({r: t for t, r in read_ranks(RANKS).items()})


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_str(JSON)


@pytest.fixture(scope="module")
def encoding():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=read_ranks(RANKS), special_tokens={})


@pytest.mark.parametrize("table_size", [32, 32_768])
def test_token_counts(small, odd, empty, library, table_size):
    docs = small.unionByName(odd)
    got = token_counts(docs, JSON, table_size=table_size, cache_size=500).select("row.doc_id", "n_bytes", "n_tokens").collect()
    want = [(i, len(t.encode()), len(library.encode(t, add_special_tokens=False).ids)) for i, t in texts_of(docs)]
    same_rows(got, want)
    assert token_counts(empty, JSON).count() == 0


def test_token_counts_in_all_scripts(spark, library):
    """Texts beyond the sure ranges take the same two tiers."""
    words = ["مرحبا بالعالم", "안녕하세요 세계", "こんにちは 世界", "สวัสดีชาวโลก", "שלום עולם", "\U0001f600\U0001f468‍\U0001f469", "नमस्ते दुनिया", "ǅ Ⅷ ½ ²", "　 \u2028\u00a0x", "it's 12'll"]
    chance = random.Random(3)
    texts = [" ".join(chance.choices(words, k=chance.randint(1, 12))) + chance.choice(["", "\n\n ", "<|endoftext|>"]) for _ in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r[0]: r[1] for r in token_counts(docs, JSON, table_size=20, cache_size=30).select("row.doc_id", "n_tokens").collect()}
    assert [got[i] for i in range(200)] == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_frequent_pieces_are_bounded(small):
    assert len(frequent_pieces(small, JSON, table_size=50)) == 50


def test_sure_characters_are_split_as_the_library_does(library):
    import regex

    unsure = regex.compile(UNSURE)
    own = regex.compile(P.PATTERN)
    for block in range(0, 0x10000, 512):
        chars = [c for c in map(chr, range(block, block + 512)) if not 0xD800 <= ord(c) < 0xE000 and not unsure.match(c)]
        text = "".join(f"a{c}1{c}!{c}{c} " for c in chars)
        spans = [s for _, s in library.pre_tokenizer.pre_tokenize_str(text)]
        assert spans == [m.span() for m in own.finditer(text)]


def test_bpe(small, odd, empty, encoding):
    docs = small.unionByName(odd)
    got = bpe_round_trip(docs, RANKS, P.PATTERN, with_ids=True).drop("ids").select(
        "row.doc_id", "n_tokens", "ids_sha256", "decoded_sha256"
    ).collect()

    def digests(text):
        ids = encoding.encode_ordinary(text)
        return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()

    same_rows(got, [(i, *digests(t)) for i, t in texts_of(docs)])
    assert bpe_round_trip(empty, RANKS, P.PATTERN).count() == 0


def test_transducer_on_random_pieces():
    ranks = read_ranks(RANKS)
    machine, chance = Transducer(ranks, max_states=500), random.Random(1)
    tokens = list(ranks)
    pieces = [b"".join(chance.choices(tokens, k=chance.randint(1, 4))) for _ in range(300)]
    pieces += [bytes(chance.choices(b"aethnois ", k=chance.randint(1, 30))) for _ in range(300)]
    pieces += [chance.randbytes(chance.randint(1, 12)) for _ in range(300)] + [b"a" * n for n in range(1, 80)] + [b" " * 200]
    for piece in pieces:
        assert machine.encode(piece) == merge_by_rank(piece, ranks)


def test_decoder_releases_whole_characters():
    tokens = {i: bytes((i,)) for i in range(256)}
    text = "aé漢\U0001f600ࠀ퟿ z"
    decoder = Decoder(tokens)
    chunks = [*decoder.push(text.encode()), decoder.finish()]
    assert b"".join(chunks) == text.encode()
    assert [c.decode() for c in chunks if c] == list(text)
    broken = b"\xe6\xbc \xff\xc3\xc3\xa9\xed\xa0\x80\xf0\x9f\x98"
    decoder = Decoder(tokens)
    assert b"".join([*decoder.push(broken), decoder.finish()]) == broken
    chance, ranks = random.Random(4), read_ranks(RANKS)
    vocabulary = {r: t for t, r in ranks.items()}
    for _ in range(200):
        ids = np.array(chance.choices([*range(300), *chance.sample(range(50_000), 50)], k=chance.randint(0, 60)), np.int64)
        one, many = Decoder(vocabulary), Decoder(vocabulary)
        parts = [many.feed(x, WHOLE) for x in np.split(ids, [len(ids) // 3])]
        assert b"".join(one.push(ids.tolist())) == b"".join(parts) and one.finish() == many.finish()
    assert [waiting(b) for b in (b"", b"a", b"\xc3", b"\xe0\x80", b"\xe0\xa0", b"\xf0\x9f\x98", b"\x80\x80\x80")] == [0, 0, 1, 0, 2, 3, 0]


def test_pieces_are_encoded_once_and_without_collection():
    import gc

    from patronscope.llm.bpe import Pieces, no_collection

    ranks = {bytes((b,)): b for b in range(256)} | {b"ab": 256, b"abc": 257, b"bc": 258}
    machine, asked = Transducer(ranks), []
    plain = machine.encode
    machine.encode = lambda data: asked.append((data, gc.isenabled())) or plain(data)
    pieces = Pieces(machine, 2)
    with no_collection():
        got = [np.frombuffer(pieces[p], "<u4").tolist() for p in ["abc", "abc", "bca", "abbc", "abc", "x" * 100]]
    assert gc.isenabled()
    assert got == [merge_by_rank(p.encode(), ranks) for p in ["abc", "abc", "bca", "abbc", "abc", "x" * 100]]
    assert asked == [(p.encode(), False) for p in ["abc", "bca", "abbc", "abc", "x" * 100]]  # two pieces are kept
    assert len(pieces) <= 2 and "x" * 100 not in pieces
