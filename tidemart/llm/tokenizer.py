"""The byte-level vocabulary file, read where it is needed; its place is a parameter."""

from __future__ import annotations

import base64
from functools import lru_cache

import public_tokenizers


def default_path() -> str:
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=2)
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@lru_cache(maxsize=2)
def library(path: str):
    """The tokenizer library's own encoder over the same ranks."""
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(path),
                             special_tokens={})
