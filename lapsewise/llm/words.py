"""Hashed words of a chunk of whole texts, laid out one document after another."""

from __future__ import annotations

import numpy as np
import xxhash

from .common import claim, give_back

_digest = xxhash.xxh3_64_intdigest


def split(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 bytes."""
    return text.split()


class Words:
    """``h``: a 64-bit hash per word; ``pos``: its number in its document; ``left``: words from it to the document's end."""

    def __init__(self, texts: list[bytes]):
        claim("words")
        give_back()  # what the chunk before has left
        parts, lengths = [], []
        for text in texts:
            words = split(text)
            lengths.append(len(words))
            parts.append(np.fromiter(map(_digest, words), np.uint64, len(words)))
        self.lengths = np.array(lengths, np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.h = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        at = np.arange(len(self.h), dtype=np.int64)
        self.pos = (at - np.repeat(self.starts, self.lengths)).astype(np.int32)
        self.left = (np.repeat(self.starts + self.lengths, self.lengths) - at).astype(np.int32)
