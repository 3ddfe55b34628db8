"""A minimal perfect hash over a fixed set of byte strings, built by hash and displace.

Keys fall into small buckets by one half of a 128-bit hash; for each bucket, largest first, a
displacement is sought that sends its keys to free slots by the other half. Buckets of one key take the
slots left over. A slot holds one key, so a lookup is one probe and one comparison."""

from __future__ import annotations

import numpy as np
import xxhash

_MIX = np.uint64(0x9E3779B97F4A7C15)
_FOLD = np.uint64(0xFF51AFD7ED558CCD)
_LOW = (1 << 64) - 1


def halves(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Both 64-bit halves of each key's hash."""
    whole = [xxhash.xxh3_128_intdigest(key) for key in keys]
    return (
        np.fromiter((h >> 64 for h in whole), np.uint64, len(whole)),
        np.fromiter((h & _LOW for h in whole), np.uint64, len(whole)),
    )


def slots(high: np.ndarray, shift: np.ndarray | int, n: int) -> np.ndarray:
    """The slot of each hash under a displacement."""
    x = high ^ (np.asarray(shift, dtype=np.uint64) * _MIX)
    x = (x ^ (x >> np.uint64(33))) * _FOLD
    return ((x ^ (x >> np.uint64(29))) % np.uint64(n)).astype(np.int64)


class PerfectHash:
    """Maps each of `keys` to the position of its value; anything else to -1."""

    def __init__(self, keys: list[bytes], values: list[int]):
        if len(set(keys)) != len(keys):
            raise ValueError("the keys of a perfect hash must differ")
        n = max(1, len(keys))
        self.n, self.buckets = n, max(1, n // 2)
        self.shift = np.zeros(self.buckets, np.int64)
        self.keys: list[bytes | None] = [None] * n
        self.values = np.full(n, -1, np.int64)
        if not keys:
            return
        high, low = halves(keys)
        home = (low % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(home, kind="stable")
        counts = np.bincount(home, minlength=self.buckets)
        starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
        free = np.ones(n, bool)
        lonely = []
        for b in np.argsort(-counts, kind="stable"):
            if counts[b] == 0:
                break
            members = order[starts[b] : starts[b] + counts[b]]
            if counts[b] == 1:
                lonely.append((b, members[0]))
                continue
            shift = 0
            while True:
                at = slots(high[members], shift, n)
                if free[at].all() and len(set(at.tolist())) == len(at):
                    break
                shift += 1
            free[at] = False
            self.shift[b] = shift
            for m, slot in zip(members, at):
                self.keys[slot], self.values[slot] = keys[m], values[m]
        for (b, m), slot in zip(lonely, np.flatnonzero(free)):
            self.shift[b] = -1 - slot
            self.keys[slot], self.values[slot] = keys[m], values[m]

    def lookup(self, wanted: list[bytes]) -> np.ndarray:
        """The value of each string, -1 for strings that are no key."""
        if not wanted:
            return np.zeros(0, np.int64)
        high, low = halves(wanted)
        shift = self.shift[(low % np.uint64(self.buckets)).astype(np.int64)]
        at = np.where(shift < 0, -1 - shift, slots(high, np.maximum(shift, 0), self.n))
        keys = self.keys
        same = np.fromiter((keys[a] == w for a, w in zip(at.tolist(), wanted)), bool, len(wanted))
        return np.where(same, self.values[at], -1)
