"""Two-stage suffix sorting of byte strings, inside one task.

Stage one sorts only the suffixes that are smaller than their
successors, eight bytes at a time.  Stage two induces all others by one
scan over the buckets of first bytes: whatever stands before a suffix
already placed takes the next free place of its own bucket.  The common
prefixes of neighbours follow.
"""

from __future__ import annotations

import numpy as np


class Suffixes:
    """The sorted suffixes of strings joined with a separator that is smaller than any byte.

    ``data`` holds the strings' bytes, none of them 0, each string ended
    by a 0.  Equal suffixes of different strings stand in the order of
    the strings.

    With ``least``, only suffixes of at least so many bytes are wanted.  Of
    the shorter ones just those are placed from which a wanted one is
    induced: up to the first that is smaller than its successor.
    """

    def __init__(self, data: np.ndarray, least: int = 0):
        self.data = data
        n = len(data)
        ends = np.flatnonzero(data == 0)
        #: Bytes from each position to the end of its string.
        self.left = np.repeat(ends, np.diff(np.concatenate(([-1], ends)))) - np.arange(n)
        padded = np.concatenate((data, np.zeros(8, np.uint8)))
        self.key = np.zeros(n, dtype=np.uint64)
        alive = np.ones(n, dtype=bool)
        for j in range(8):
            byte = padded[j:n + j]
            alive &= byte != 0
            self.key = (self.key << np.uint64(8)) | np.where(alive, byte, 0).astype(np.uint64)
        small = self.smaller_than_next() if n else np.empty(0, bool)
        self.needed = self._needed(small, least) if n else small
        self.order = self._induced(self._direct(small)) if n else np.empty(0, np.int64)

    def keys(self, at: np.ndarray, depth: int) -> np.ndarray:
        """The eight bytes that begin ``8 * depth`` bytes into each suffix; 0 past the string's end."""
        inside = self.left[at] > 8 * depth
        out = np.zeros(len(at), dtype=np.uint64)
        out[inside] = self.key[at[inside] + 8 * depth]
        return out

    def smaller_than_next(self) -> np.ndarray:
        """Whether each suffix is smaller than the one that starts a byte later."""
        data, n = self.data, len(self.data)
        change = np.flatnonzero(data[1:] != data[:-1])  # the last byte of each run of equal bytes
        run_end = np.concatenate((change, [n - 1]))
        size = np.diff(np.concatenate(([-1], run_end)))
        rises = np.concatenate((data[change] < data[change + 1], [True]))
        rises[data[run_end] == 0] = True
        return np.repeat(rises, size)

    def _needed(self, small: np.ndarray, least: int) -> np.ndarray:
        """Positions to place: those wanted, and after the last one of a string those up to a small one."""
        wanted = self.left >= least
        last = np.flatnonzero(wanted & ~np.append(wanted[1:], False))
        until = np.flatnonzero(small)
        until = until[np.searchsorted(until, last)]  # ends of strings count as small
        cover = np.zeros(len(small) + 1, dtype=np.int32)
        np.add.at(cover, last, 1)
        np.subtract.at(cover, until + 1, 1)
        return wanted | (np.cumsum(cover)[:-1] > 0)

    def _direct(self, small: np.ndarray) -> np.ndarray:
        """The small suffixes in order."""
        at = np.flatnonzero(small & self.needed & (self.data != 0))
        key = self.keys(at, 0)
        turn = np.argsort(key, kind="stable")
        at, key = at[turn], key[turn]
        new = np.concatenate(([True], key[1:] != key[:-1])) if len(at) else np.empty(0, bool)
        depth = 1
        while True:
            # only groups that are still tied, and whose members go on, need a further look
            group = np.cumsum(new) - 1
            tied = np.bincount(group, minlength=1)[group] > 1 if len(group) else new
            tied &= self.left[at] > 8 * depth if len(at) else tied
            open_group = np.zeros(int(group[-1]) + 1 if len(group) else 0, dtype=bool)
            open_group[group[tied]] = True
            slots = np.flatnonzero(open_group[group]) if len(group) else np.empty(0, np.int64)
            if not len(slots):
                return at
            key = self.keys(at[slots], depth)
            turn = np.lexsort((key, group[slots]))
            at[slots] = at[slots][turn]
            key = key[turn]
            grp = group[slots]
            new[slots[1:]] |= (key[1:] != key[:-1]) & (grp[1:] == grp[:-1])
            depth += 1

    def _induced(self, sorted_small: np.ndarray) -> np.ndarray:
        data, needed = self.data, self.needed
        first = data[sorted_small]
        edge = np.searchsorted(first, np.arange(257))
        waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
        out: list[np.ndarray] = []
        for c in range(256):
            if c == 0:
                placed = np.flatnonzero((data == 0) & needed)
            else:
                larger = waiting[c]
                batch = np.concatenate(larger) if larger else np.empty(0, np.int64)
                while len(batch):  # the same byte once more in front: a longer run comes later
                    before = batch - 1
                    before = before[before >= 0]
                    batch = before[(data[before] == c) & needed[before]]
                    if len(batch):
                        larger.append(batch)
                placed = np.concatenate([*larger, sorted_small[edge[c]:edge[c + 1]]])
                waiting[c] = []
            if not len(placed):
                continue
            out.append(placed)
            before = placed - 1
            before = before[before >= 0]
            chars = data[before]
            keep = (chars > c) & needed[before]
            before, chars = before[keep], chars[keep]
            if not len(chars):
                continue
            turn = np.argsort(chars, kind="stable")
            before, chars = before[turn], chars[turn]
            cut = np.flatnonzero(np.concatenate(([True], chars[1:] != chars[:-1])))
            for a, b in zip(cut, [*cut[1:], len(chars)], strict=True):
                waiting[int(chars[a])].append(before[a:b])
        return np.concatenate(out) if out else np.empty(0, np.int64)

    def common_prefixes(self, at: np.ndarray, most: int) -> np.ndarray:
        """Length of the common prefix of each of these suffixes and the one before it, at most ``most``."""
        out = np.zeros(len(at), dtype=np.int64)
        going = np.arange(1, len(at))
        for depth in range(-(-most // 8)):
            a, b = self.keys(at[going], depth), self.keys(at[going - 1], depth)
            differ = a ^ b
            same = differ == 0
            part = differ[~same]
            lead = np.zeros(len(part), dtype=np.int64)
            for j in range(8):
                lead += (part >> np.uint64(56 - 8 * j)) == 0
            out[going[~same]] += lead
            out[going[same]] += 8
            going = going[same]
        bound = np.minimum(self.left[at], most)
        bound[1:] = np.minimum(bound[1:], self.left[at[:-1]])
        return np.minimum(out, bound)
