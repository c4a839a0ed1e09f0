"""Ids of the byte-level vocabulary in a tokenizer's .json file, fast for many units.

The library named by the file encodes whole texts; short units, which occur by the
million, go to tiktoken with the same vocabulary as ranks, which gives the same ids.
"""

from __future__ import annotations

import json
import os
from functools import cache

from talktally.llm.units import UnitEncoder


def default_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@cache
def tokenizer(file: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(file)


def _byte_of() -> dict[str, int]:
    """Byte-level files write a byte as its own character if that is visible, else as one from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


@cache
def unit_encoder(file: str) -> UnitEncoder:
    """One for each worker process, so that its tasks share what is known."""
    import public_tokenizers
    import tiktoken

    with open(file, encoding="utf-8") as lines:
        spec = json.load(lines)
    special = [t["content"] for t in spec["added_tokens"]]
    byte_of = _byte_of()
    ranks = {
        bytes(byte_of[c] for c in piece): i
        for piece, i in spec["model"]["vocab"].items()
        if piece not in special
    }
    fast = tiktoken.Encoding(
        "units", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    return UnitEncoder(
        lambda units: list(map(fast.encode_ordinary, units)),
        lambda text: tokenizer(file).encode(text, add_special_tokens=False).ids,
        tuple(s.encode() for s in special),
    )
