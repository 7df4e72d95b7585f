"""Token ids of the public 50k byte-level BPE, and pieces of bounded length.

``byte_bpe_50k.json`` is read by the tokenizers library; ``byte_bpe_50k.tiktoken`` holds the same
vocabulary as ranks. Byte-level BPE by ranks gives the same ids and is about three times as fast,
so texts made of the code points below ``U+0250`` and general punctuation (tested equal) take it,
and every other text, or one holding the special token's string, goes through tokenizers itself.
"""

from __future__ import annotations

import base64
import os
import re

import numpy as np

from kgspark.llm.common import worker_cache

SPECIAL = "<|endoftext|>"
#: Besides Latin-1: what both libraries surely split alike.
OUTSIDE = re.compile("[^\x00-ɏ‐-‧‰-⁞€]")


class Encoder:
    """``ids(text)``: uint32 ids, no special tokens added; None counts as the empty text."""

    def __init__(self, json_path: str, rank_path: str | None, pattern: str | None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(json_path)
        self.fast = None
        if rank_path:
            import tiktoken

            with open(rank_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    @staticmethod
    def _common(text: str) -> bool:
        if text.isascii():
            return True
        try:
            text.encode("latin-1")
            return True
        except UnicodeEncodeError:
            return not OUTSIDE.search(text)

    def ids(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, "<u4")
        if self.fast is not None and SPECIAL not in text and self._common(text):
            return np.array(self.fast.encode_ordinary(text), "<u4")
        return np.array(self.full.encode(text, add_special_tokens=False).ids, "<u4")


def encoder(name: str = "byte_bpe_50k", folder: str | None = None) -> Encoder:
    """One encoder per worker. ``folder`` holds the vocabulary files (default: the installed public ones)."""

    def make():
        import public_tokenizers as p

        at = (lambda f: os.path.join(folder, f)) if folder else p.path
        ranks = at(f"{name}.tiktoken")
        return Encoder(at(f"{name}.json"), ranks if os.path.exists(ranks) else None, p.PATTERN)

    return worker_cache(f"encoder:{name}:{folder}", make)


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: all full but the first."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)] if n else []
