"""Cuckoo filters of 16-bit fingerprints in buckets of four, over keys that are pairs of 64-bit hashes.

A key's fingerprint stands in one of two buckets, each found from the other by the fingerprint alone, so it can
be moved without the key and taken out again. A filter that finds no room says so; its owner then
builds a larger one from the exact keys.
"""

from __future__ import annotations

import numpy as np

from noticelake.llm.words import mix

SLOTS, KICKS, LOAD = 4, 500, 0.8


def _parts(hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprint (never 0), first place and step to the other place, before masking."""
    print_ = np.maximum(hi.astype(np.int64).view(np.uint64) >> np.uint64(48), np.uint64(1))
    return print_.astype(np.uint16), lo.astype(np.int64).view(np.uint64), mix(print_)


class Cuckoo:
    def __init__(self, buckets: int):
        self.table = np.zeros((buckets, SLOTS), np.uint16)

    @classmethod
    def build(cls, hi: np.ndarray, lo: np.ndarray) -> Cuckoo:
        """A filter of distinct keys, as large as it needs to be."""
        buckets = 1 << max(0, int(np.ceil(np.log2(max(1, len(hi)) / (SLOTS * LOAD)))))
        while not (made := cls(buckets)).insert(hi, lo):
            buckets *= 2
        return made

    @classmethod
    def load(cls, data: bytes) -> Cuckoo:
        made = cls(0)
        made.table = np.frombuffer(data, np.uint16).reshape(-1, SLOTS).copy()
        return made

    def dump(self) -> bytes:
        return self.table.tobytes()

    def _places(self, hi: np.ndarray, lo: np.ndarray) -> tuple[list[int], list[int], list[int]]:
        mask = np.uint64(len(self.table) - 1)
        print_, first, step = _parts(hi, lo)
        return print_.tolist(), (first & mask).tolist(), (step & mask).tolist()

    def insert(self, hi: np.ndarray, lo: np.ndarray) -> bool:
        """Adds distinct keys that are not in the filter. False if one found no room: the filter is then of no use."""
        rows, mask = self.table.tolist(), np.uint64(len(self.table) - 1)
        steps: dict[int, int] = {}
        turn = 0
        for p, at, step in zip(*self._places(hi, lo)):
            for place in (at, at ^ step):
                if 0 in rows[place]:
                    rows[place][rows[place].index(0)] = p
                    break
            else:
                at ^= step
                for _ in range(KICKS):
                    turn = (turn + 1) % SLOTS
                    p, rows[at][turn] = rows[at][turn], p
                    if p not in steps:
                        steps[p] = int(mix(np.array([p], np.uint64))[0] & mask)
                    at ^= steps[p]
                    if 0 in rows[at]:
                        rows[at][rows[at].index(0)] = p
                        break
                else:
                    return False
        self.table = np.array(rows, np.uint16).reshape(-1, SLOTS)
        return True

    def delete(self, hi: np.ndarray, lo: np.ndarray) -> None:
        """Takes out keys that were inserted."""
        for p, at, step in zip(*self._places(hi, lo)):
            for place in (at, at ^ step):
                slot = np.flatnonzero(self.table[place] == p)
                if len(slot):
                    self.table[place, slot[0]] = 0
                    break


class Filters:
    """Filters of all shards side by side; a key's shard is in the lowest bits of its first hash."""

    def __init__(self, shards: int, dumps: dict[int, bytes]):
        tables = [Cuckoo.load(dumps[s]).table if s in dumps else np.zeros((1, SLOTS), np.uint16) for s in range(shards)]
        sizes = np.array([len(t) for t in tables], np.int64)
        self.shards, self.table = shards, np.concatenate(tables)
        self.start, self.mask = np.cumsum(sizes) - sizes, (sizes - 1).astype(np.uint64)

    def holds(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """True for every key that was inserted, and for about one in 8,000 others."""
        shard = (hi.astype(np.int64) & (self.shards - 1)).astype(np.int64)
        print_, first, step = _parts(hi, lo)
        mask, start = self.mask[shard], self.start[shard]
        one = self.table[start + (first & mask).astype(np.int64)] == print_[:, None]
        other = self.table[start + ((first ^ step) & mask).astype(np.int64)] == print_[:, None]
        return (one | other).any(axis=1)
