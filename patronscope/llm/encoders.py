"""Byte-level encoders for whole texts, built in a worker from the content of a vocabulary file.

The merges of a byte-level vocabulary are numbered in the order in which they were learned, so its ids are
ranks, and ``tiktoken`` gives the ids that ``tokenizers`` gives, several times faster. Runs of white space that are too
long for its splitter (about 300,000 characters) go to ``tokenizers``.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import numpy as np

from patronscope.llm.common import worker_cache


def byte_of_char() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary, a fixed value of its format."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(others)}}


def token_bytes(vocabulary: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """Ids by the bytes of the ordinary tokens, and ids by the strings of the added ones."""
    content, known = json.loads(vocabulary), byte_of_char()
    added = {t["content"]: t["id"] for t in content.get("added_tokens") or []}
    own = {t: i for t, i in content["model"]["vocab"].items() if t not in added}
    return {bytes(known[c] for c in t): i for t, i in own.items()}, added


def byte_encoder(vocabulary: str, pattern: str, special: bool) -> Callable[[str], np.ndarray]:
    """A function from a text to its ids (uint32), without begin and end tokens.

    ``special``: whether the strings of added tokens inside a text become those tokens. The encoder is
    kept in this worker.
    """
    home = worker_cache("byte_encoder")
    key = hash((vocabulary, pattern, special))
    if key not in home:
        home[key] = _byte_encoder(vocabulary, pattern, special)
    return home[key]


def _byte_encoder(vocabulary: str, pattern: str, special: bool) -> Callable[[str], np.ndarray]:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import tiktoken
    from tokenizers import Tokenizer

    ranks, added = token_bytes(vocabulary)
    fast = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens=added if special else {})
    found: list = []
    use = {"allowed_special": "all" if special else set(), "disallowed_special": ()}

    def slow(text: str) -> np.ndarray:
        if not found:
            library = Tokenizer.from_str(vocabulary)
            library.no_truncation()
            library.no_padding()
            library.encode_special_tokens = not special
            found.append(library)
        return np.array(found[0].encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(text: str) -> np.ndarray:
        try:
            return fast.encode_to_numpy(text, **use)
        except ValueError:
            return slow(text)

    return encode


def text_of(value: bytes) -> str:
    """UTF-8 bytes as a string; invalid sequences become U+FFFD."""
    return value.decode("utf-8", "replace")
