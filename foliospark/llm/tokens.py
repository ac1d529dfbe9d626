"""Token counts by a public byte-level BPE vocabulary, read from a file that is a parameter."""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pre-token pattern that belongs to the default vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Tokenizer:
    """Loaded once a worker; a text's tokens are those of its UTF-8 bytes, and nothing in it is a special token."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bpe = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.lengths[rank] = len(token)

    def count(self, text: str) -> int:
        return len(self.bpe.encode_ordinary(text))

    def ends(self, text: str) -> np.ndarray:
        """The byte offset after each token."""
        return np.cumsum(self.lengths[np.array(self.bpe.encode_ordinary(text), np.int64)])


@lru_cache(maxsize=2)
def tokenizer(path: str = TOKENIZER) -> Tokenizer:
    return Tokenizer(path)
