"""Byte-level BPE as a lazily determinised transducer, and a streaming decoder.

Encoding. The pieces of a text are read byte by byte. A state of the nondeterministic machine is
a part of a token read so far, a node in the tree of all tokens, together with the tokens before it; a token may follow another
if the two encode to themselves when joined. The deterministic state is the set of all such
readings with their pending tokens; what all readings agree on is emitted, so a token leaves
after a lookahead of at most the longest token. States and arcs are made when first needed.

Decoding. ``Decoder`` takes ids one by one and releases bytes up to the last whole character; a
state machine over UTF-8 lead and follow bytes decides how many bytes wait.

Defined cases: a null text is empty and has no ids; repeated rows are encoded one by one; an empty
table gives an empty result; bytes that are not UTF-8 are released as they are when the next byte
cannot complete them or the stream ends.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import struct
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, LongType, StringType

from patronscope.llm.common import packed_rows, schema_with, worker_cache

MAX_STATES = 200_000
CACHE_SIZE = 300_000
CACHED_PIECE = 64


def read_ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(t): int(r) for t, r in (line.split() for line in content.splitlines() if line)}


def merge_by_rank(data: bytes, ranks: dict[bytes, int], below: int = 1 << 60) -> list[int]:
    """The definition: join the adjacent pair of lowest rank, leftmost first, until none ``below`` is left."""
    parts = [data[i : i + 1] for i in range(len(data))]
    while len(parts) > 1:
        rank, at = min((ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
        if rank >= below:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


class Transducer:
    """Encodes one piece at a time; ``encode`` gives the ids."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = MAX_STATES):
        self.ranks, self.max_states = ranks, max_states
        self.tokens = {r: t for t, r in ranks.items()}
        #: the tree of the tokens: 256 * node + byte -> node; by node, the token that ends there and whether longer ones go on
        self.nodes: dict[int, int] = {}
        self.token_at, self.goes_on = [-1], [True]
        for data, token in ranks.items():
            self._plant(data, token)
        self.follows: dict[tuple[int, int], bool] = {}
        self.whole: dict[int, bool] = {}
        self.halves: dict[int, tuple[int, int] | None] = {}
        self._reset()

    def _plant(self, data: bytes, token: int) -> None:
        node, nodes = 0, self.nodes
        for byte in data:
            self.goes_on[node] = True
            key = node << 8 | byte
            node = nodes.get(key)
            if node is None:
                node = nodes[key] = len(self.token_at)
                self.token_at.append(-1)
                self.goes_on.append(False)
        self.token_at[node] = token

    def _reset(self) -> None:
        #: number -> readings; readings are (pending tokens, last token, node of the part read)
        start = (((), -1, 0),)
        self.states, self.numbers = [start], {start: 0}
        self.arcs: list[dict[int, tuple[tuple, int]]] = [{}]
        self.ends: list[tuple | None] = [()]

    def _halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens that the last join of ``token`` joins; None for a byte or a token that no joins reach."""
        if token not in self.halves:
            data = self.tokens[token]
            parts = merge_by_rank(data, self.ranks, token) if len(data) > 1 else []
            self.halves[token] = tuple(parts) if len(parts) == 2 else None
            self.whole[token] = len(data) == 1 or len(parts) == 2
        return self.halves[token]

    def _may_follow(self, last: int, token: int) -> bool:
        """Whether the two stay apart when their bytes are joined.

        Joins happen in order of rank, so the two are taken apart again at their common edge, the later join
        first. The edge must not join before the join that has just been undone; of equal ranks the left one comes first.
        """
        self._halves(token)
        if last < 0 or not self.whole[token]:
            return self.whole[token]
        pair = last, token
        known = self.follows.get(pair)
        if known is None:
            if len(self.follows) > 2 * self.max_states:
                self.follows.clear()
            known = self.follows[pair] = self._stay_apart(last, token)
        return known

    def _stay_apart(self, left: int, right: int) -> bool:
        until, tokens, ranks = 1 << 60, self.tokens, self.ranks
        while True:
            if ranks.get(tokens[left] + tokens[right], 1 << 60) < until:
                return False
            left_parts, right_parts = self._halves(left), self._halves(right)
            if left_parts and (left > right or not right_parts):
                until, left = left, left_parts[1]
            elif right_parts:
                until, right = right + 1, right_parts[0]
            else:
                return True

    def _arc(self, state: int, byte: int) -> tuple[tuple, int]:
        readings, nodes, goes_on, token_at, end = [], self.nodes, self.goes_on, self.token_at, None
        for pending, last, node in self.states[state]:
            node = nodes.get(node << 8 | byte)
            if node is None:
                continue
            if goes_on[node]:
                readings.append((pending, last, node))
            token = token_at[node]
            if token >= 0 and end is None and self._may_follow(last, token):
                end = (*pending, token)  # the one reading in which all bytes so far are whole tokens
                readings.append((end, token, 0))
        if end is None:
            raise ValueError("the ranks do not encode this text")
        agreed = 0
        if len(readings) == 1:
            agreed = len(end)
        else:
            readings.sort()
            for one, other in zip(readings[0][0], readings[-1][0], strict=False):
                if one != other:
                    break
                agreed += 1
        out = end[:agreed]
        to = tuple((p[agreed:], last, node) for p, last, node in readings) if agreed else tuple(readings)
        number = self.numbers.get(to)
        if number is None:
            number = self.numbers[to] = len(self.states)
            self.states.append(to)
            self.arcs.append({})
            self.ends.append(end[agreed:])
        self.arcs[state][byte] = found = out, number
        return found

    def encode(self, piece: bytes) -> list[int]:
        if len(self.states) > self.max_states:
            self._reset()
        ids: list[int] = []
        state, arcs = 0, self.arcs
        for byte in piece:
            arc = arcs[state].get(byte)
            if arc is None:
                arc = self._arc(state, byte)
            out, state = arc
            if out:
                ids += out
        ids += self.ends[state]
        return ids


#: Follow bytes that a lead byte announces.
FOLLOWS = {**dict.fromkeys(range(0xC2, 0xE0), 1), **dict.fromkeys(range(0xE0, 0xF0), 2), **dict.fromkeys(range(0xF0, 0xF5), 3)}
#: The first follow byte has a narrower range after these leads.
FIRST = {0xE0: (0xA0, 0xBF), 0xED: (0x80, 0x9F), 0xF0: (0x90, 0xBF), 0xF4: (0x80, 0x8F)}


def waiting(data: bytes) -> int:
    """Bytes at the end of ``data`` that begin a character and lack its rest."""
    for back in range(1, min(3, len(data)) + 1):
        byte = data[-back]
        if byte & 0xC0 != 0x80:
            need = FOLLOWS.get(byte, 0)
            if need < back:
                return 0
            low, high = FIRST.get(byte, (0x80, 0xBF))
            return back if back == 1 or low <= data[-back + 1] <= high else 0
    return 0


class Decoder:
    """Ids in, bytes of whole characters out; ``arcs`` remembers (bytes held, id) -> (held, released)."""

    def __init__(self, tokens: dict[int, bytes], arcs: dict | None = None, max_arcs: int = 100_000):
        self.tokens, self.max_arcs, self.held = tokens, max_arcs, b""
        self.arcs = {} if arcs is None else arcs

    def push(self, ids: Iterable[int]) -> Iterator[bytes]:
        arcs, held = self.arcs, self.held
        for token in ids:
            arc = arcs.get((held, token))
            if arc is None:
                data = held + self.tokens[token]
                cut = len(data) - waiting(data)
                if len(arcs) >= self.max_arcs:
                    arcs.clear()
                arc = arcs[held, token] = data[cut:], data[:cut]
            held, out = arc
            yield out
        self.held = held

    def feed(self, ids: np.ndarray, whole: np.ndarray) -> bytes:
        """As ``push`` for many ids; runs of tokens that are ``whole`` characters need no state."""
        out, at, tokens, numbers = [], 0, self.tokens, ids.tolist()
        for odd in [*np.flatnonzero(~whole[ids]).tolist(), len(numbers)]:
            if odd < at:
                continue
            while self.held and at < len(numbers):
                out += self.push(numbers[at : at + 1])
                at += 1
            out += map(tokens.__getitem__, numbers[at:odd])
            at = max(at, odd)
            if at < len(numbers):
                out += self.push(numbers[at : at + 1])
                at += 1
        return b"".join(out)

    def finish(self) -> bytes:
        rest, self.held = self.held, b""
        return rest


class Pieces(dict):
    """Piece -> its ids as bytes, encoded when first asked for. Known pieces cost one look-up and no call."""

    def __init__(self, own: Transducer, size: int):
        super().__init__()
        self.own, self.size = own, size

    def __missing__(self, piece: str) -> bytes:
        ids = self.own.encode(piece.encode())
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= CACHED_PIECE:
            if len(self) >= self.size:
                self.clear()
            self[piece] = packed
        return packed


@contextmanager
def no_collection() -> Iterator[None]:
    """Reference cycles are not looked for inside: states and pieces hold none, and the search would pass over all of them again and again."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


def whole_tokens(tokens: dict[int, bytes]) -> np.ndarray:
    """By id, whether a token is whole characters of UTF-8."""
    out = np.zeros(max(tokens, default=-1) + 1, bool)
    for token, data in tokens.items():
        out[token] = data.decode("utf-8", "replace").encode() == data
    return out


def bpe_round_trip(
    docs: DataFrame, ranks: bytes, pattern: str, text: str = "text", with_ids: bool = False, cache_size: int = CACHE_SIZE,
    max_states: int = MAX_STATES,
) -> DataFrame:
    """(row, n_tokens, ids_sha256, decoded_sha256[, ids]) for every document.

    ``ranks`` is the content of the rank file. ``ids`` are little-endian unsigned 32-bit integers.
    Pieces of at most ``CACHED_PIECE`` characters are remembered per worker, at most ``cache_size``, and at most ``max_states`` states.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    rows = packed_rows(docs, text)
    fields = [("n_tokens", LongType()), ("ids_sha256", StringType()), ("decoded_sha256", StringType())]
    schema = schema_with(rows.schema["row"].dataType, *fields, *([("ids", BinaryType())] if with_ids else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        home = worker_cache("bpe")
        key = len(shared.value), hash(shared.value), max_states, cache_size
        if key not in home:
            own = Transducer(read_ranks(shared.value), max_states)
            home[key] = own, Pieces(own, cache_size), {}, whole_tokens(own.tokens)
        own, memo, arcs, whole = home[key]
        pieces = regex.compile(pattern)

        lookup = memo.__getitem__
        for batch in batches:
            counts, ids_digests, text_digests, all_ids = [], [], [], []
            with no_collection():
                for data in batch.column("data").to_pylist():
                    ids = b"".join(map(lookup, pieces.findall(data.decode())))
                    decoder = Decoder(own.tokens, arcs)
                    back = decoder.feed(np.frombuffer(ids, "<u4"), whole) + decoder.finish()
                    counts.append(len(ids) // 4)
                    ids_digests.append(hashlib.sha256(ids).hexdigest())
                    text_digests.append(hashlib.sha256(back).hexdigest())
                    if with_ids:
                        all_ids.append(ids)
            columns = [batch.column("row"), pa.array(counts, pa.int64()), pa.array(ids_digests, pa.string()), pa.array(text_digests, pa.string())]
            if with_ids:
                columns.append(pa.array(all_ids, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema.fields])

    return rows.mapInArrow(run, schema)
