"""Token ids of texts by a public byte-level vocabulary."""

from __future__ import annotations

import base64
from collections.abc import Callable

import numpy as np

VOCABULARY, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
SPECIAL = "<|endoftext|>"


def vocabulary_paths() -> tuple[str, str]:
    """Default files: the vocabulary and the same vocabulary as merge ranks."""
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY), public_tokenizers.path(RANKS)


def encoder(paths: tuple[str, str]) -> Callable[[str], np.ndarray]:
    """A function from a text to its ids (uint32), no special tokens added.

    The ids are those of ``tokenizers`` with the first file. Texts of Latin-1
    characters that hold no special token are encoded by ``tiktoken`` with the
    second file, several times as fast: on such texts the two split words alike
    (beyond Latin-1 they may follow different versions of Unicode).
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    vocabulary, ranks = paths
    with open(ranks, "rb") as lines:
        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={}
    )
    slow: list[Tokenizer] = []

    def encode(text: str) -> np.ndarray:
        try:
            text.encode("latin-1")
            plain = SPECIAL not in text
        except UnicodeEncodeError:
            plain = False
        if plain:
            return np.array(fast.encode_ordinary(text), dtype=np.uint32)
        if not slow:
            slow.append(Tokenizer.from_file(vocabulary))
        return np.array(slow[0].encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    return encode


def short_ids(ids: np.ndarray) -> np.ndarray:
    """The same ids in 16 bits. Ids beyond that are refused, never cut."""
    if len(ids) and (ids.max() > 0xFFFF or ids.min() < 0):
        raise ValueError(f"id {int(ids.max())} does not fit 16 bits")
    return ids.astype("<u2")


def token_byte_lengths(paths: tuple[str, str]) -> np.ndarray:
    """Bytes of text that each id stands for."""
    with open(paths[1], "rb") as lines:
        found = {int(b): len(base64.b64decode(a)) for a, b in map(bytes.split, lines)}
    found[max(found) + 1] = len(SPECIAL)
    out = np.zeros(max(found) + 1, dtype=np.int64)
    out[list(found)] = list(found.values())
    return out
