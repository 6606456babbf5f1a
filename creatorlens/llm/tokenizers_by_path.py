"""Tokenizers loaded once per Python worker from vocabulary files given by path."""

from __future__ import annotations

import functools
import json
from collections.abc import Callable

import numpy as np

#: How the byte-level vocabulary cuts a text before merging (fixed value).
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Beyond this many code points a text may exceed what the fast library splits.
FAST_CHARS = 200_000


def vocabulary(name: str) -> str:
    """Path of an installed public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.cache
def sentencepiece_model(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@functools.cache
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    made.no_truncation()
    made.no_padding()
    return made


@functools.cache
def _bytes_of_letters() -> dict[str, int]:
    """Byte-level vocabularies write each byte as one printable character."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@functools.cache
def _ranks(path: str):
    """The same vocabulary for the faster library: a token's id is its merge rank."""
    import tiktoken

    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    special = {t["content"]: t["id"] for t in described["added_tokens"]}
    letters = _bytes_of_letters()
    ranks = {
        bytes(letters[c] for c in token): i
        for token, i in described["model"]["vocab"].items()
        if token not in special
    }
    return tiktoken.Encoding("by_path", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)


def byte_bpe(path: str) -> Callable[[str], np.ndarray]:
    """Token ids of a text, as ``tokenizers`` gives them without added special tokens.

    The ids come from a faster implementation of the same vocabulary; tests hold it
    against ``tokenizers``. Texts of more than ``FAST_CHARS`` go to ``tokenizers``.
    """
    fast = _ranks(path)

    def encode(text: str) -> np.ndarray:
        if len(text) > FAST_CHARS:
            return np.asarray(_tokenizer(path).encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        return fast.encode_to_numpy(text, allowed_special="all")

    return encode
