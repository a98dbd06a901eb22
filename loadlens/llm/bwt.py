"""Burrows-Wheeler transforms of many strings, and their merge.

A shard is a matrix of symbols, one string of equal length a row; a terminator
(symbol 0) follows each. Shards are transformed on their own. The merge starts
from an interleave that lists the shards one after another and refines it: the
interleave of suffixes by their first k symbols, read with the transforms,
gives the symbols that precede them, and a stable pass over these gives the
interleave by the first k + 1 symbols. No suffix is compared again. The depth
at which a boundary first appears between neighbours is the length of their
common prefix; boundaries that have not appeared bound the repeated intervals.
"""

from __future__ import annotations

import numpy as np


class Shard:
    """The transform of the strings, and where each suffix begins; equal suffixes are in the order of their strings."""

    def __init__(self, symbols: np.ndarray):
        many, length = symbols.shape
        width = length + 1
        text = np.zeros((many, width + 12), np.uint64)
        text[:, :length] = symbols
        part = text[:, : width + 8]
        for k in (1, 2, 3):
            part = (part << np.uint64(16)) | text[:, k : k + width + 8]
        covered = 4
        rank = self._ranked(part)
        while covered < width:
            # Three ranks side by side tell suffixes apart three times as far.
            wide = np.zeros((many, width + 2 * covered), np.uint64)
            wide[:, : rank.shape[1]] = rank[:, : wide.shape[1]]
            joined = wide[:, :width]
            for k in (1, 2):
                joined = (joined << np.uint64(21)) | wide[:, k * covered : k * covered + width]
            rank = self._ranked(joined)
            covered *= 3
        strings = np.arange(many, dtype=np.uint64)[:, None]
        self.suffixes = np.argsort(((rank[:, :width] << np.uint64(32)) | strings).ravel())
        before = np.zeros((many, width), np.uint16)
        before[:, 1:] = symbols
        self.transform = before.ravel()[self.suffixes]
        self.width = width

    @staticmethod
    def _ranked(keys: np.ndarray) -> np.ndarray:
        """Dense ranks from 1, kept at 0 where nothing but padding follows."""
        _, rank = np.unique(keys.ravel(), return_inverse=True)
        return (rank.reshape(keys.shape) + 1).astype(np.uint64)


# Ranks have 21 bits, and there are up to eight more for each string than it has suffixes.
MOST_SUFFIXES = (1 << 21) // 2


def merge(shards: list[Shard], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shards, suffixes and common prefixes in order of the suffixes' first ``depth`` symbols.

    The common prefix is that with the suffix before, ``depth`` where it is as long or longer.
    """
    sizes = [len(s.transform) for s in shards]
    strings = [n // s.width for n, s in zip(sizes, shards, strict=True)]
    symbols = np.concatenate([s.transform for s in shards])
    source = np.repeat(np.arange(len(shards), dtype=np.uint8), sizes)
    ends = np.repeat(np.arange(len(shards), dtype=np.uint8), strings)
    common = np.full(len(source), depth, np.int32)
    common[0] = 0
    block = np.zeros(len(source), np.int32)
    before = np.empty_like(symbols)
    for k in range(depth):
        before[np.argsort(source, kind="stable")] = symbols
        order = np.argsort(before, kind="stable")
        source, old, first = source[order], block[order], before[order]
        # Terminators stand in the order of their shards, whatever follows from the strings' beginnings.
        source[: len(ends)] = ends
        old[: len(ends)] = 0
        parted = np.empty(len(source), bool)
        parted[0] = False
        parted[1:] = (first[1:] != first[:-1]) | (old[1:] != old[:-1])
        common[parted & (common > k)] = k
        block = np.cumsum(parted, dtype=np.int32)
    place = np.argsort(source, kind="stable")
    suffix = np.empty(len(source), np.int64)
    suffix[place] = np.concatenate([s.suffixes for s in shards])
    return source, suffix, common


def intervals(common: np.ndarray, depth: int) -> np.ndarray:
    """For each suffix in merged order the number of its interval: suffixes that share ``depth`` symbols."""
    return np.cumsum(common < depth) - 1
