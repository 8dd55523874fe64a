"""A cuckoo filter over 128-bit keys that inserts, looks up and deletes whole arrays of keys."""

from __future__ import annotations

import numpy as np

SLOTS = 4


class _Table:
    """Buckets of four 16-bit fingerprints (0: free); the second bucket of a fingerprint follows from the first."""

    def __init__(self, slots: np.ndarray):
        self.slots = slots
        self.last = np.int64(len(slots) - 1)

    def _other(self, bucket: np.ndarray, mark: np.ndarray) -> np.ndarray:
        return bucket ^ ((mark.astype(np.int64) * 0x5BD1E995) & self.last)

    def _place(self, mark: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Put marks in free slots of their buckets; which are left over."""
        order = np.argsort(bucket, kind="stable")
        b = bucket[order]
        first = np.flatnonzero(np.r_[True, b[1:] != b[:-1]])
        rank = np.arange(len(b)) - np.repeat(first, np.diff(np.r_[first, len(b)]))
        full = self.slots[b] != 0
        fits = rank < SLOTS - full.sum(axis=1)
        slot = np.argsort(full, axis=1, kind="stable")[np.arange(len(b)), np.minimum(rank, SLOTS - 1)]
        self.slots[b[fits], slot[fits]] = mark[order][fits]
        return order[~fits]

    def insert(self, mark: np.ndarray, bucket: np.ndarray, rounds: int = 200) -> np.ndarray:
        """Insert; the indexes of what found no place in two buckets and so many rounds of moving others on."""
        left = self._place(mark, bucket)
        if not len(left):
            return left
        after = self._place(mark[left], self._other(bucket[left], mark[left]))
        owner = left[after]
        mark, bucket = mark[owner], bucket[owner]
        dice = np.random.default_rng(len(self.slots))
        for _ in range(rounds):
            if not len(mark):
                break
            one = np.unique(bucket, return_index=True)[1]
            rest = np.setdiff1d(np.arange(len(mark)), one)
            slot = dice.integers(0, SLOTS, len(one))
            at = bucket[one]
            moved = self.slots[at, slot].copy()
            self.slots[at, slot] = mark[one]
            mark = np.r_[moved, mark[rest]]
            bucket = np.r_[self._other(at, moved), bucket[rest]]
            left = self._place(mark, bucket)
            mark, bucket = mark[left], bucket[left]
        self.lost = (mark, bucket)
        return np.arange(len(mark))

    def has(self, mark: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        m = mark[:, None]
        return (self.slots[bucket] == m).any(axis=1) | (self.slots[self._other(bucket, mark)] == m).any(axis=1)

    def delete(self, mark: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Free one slot for each mark; which were found."""
        found = np.zeros(len(mark), bool)
        for way in (bucket, self._other(bucket, mark)):
            todo = np.flatnonzero(~found)
            while len(todo):
                one = todo[np.unique(way[todo], return_index=True)[1]]
                same = self.slots[way[one]] == mark[one][:, None]
                hit = same.any(axis=1)
                self.slots[way[one][hit], same.argmax(axis=1)[hit]] = 0
                found[one[hit]] = True
                todo = np.setdiff1d(todo, one)
        return found


class CuckooFilter:
    """No false negatives for keys that were inserted once and not deleted since; about 0.01 % false positives.

    A table that is full is followed by another, so any number of keys can be inserted.  Keys are pairs of longs
    (halves of a 128-bit hash).  Insert a key only once and delete only keys that are in: the exact table behind
    the filter sees to that.
    """

    def __init__(self, capacity: int = 1024):
        size = 1 << max(4, int(np.ceil(np.log2(max(1, capacity) / (SLOTS * 0.8)))))
        self.tables = [_Table(np.zeros((size, SLOTS), np.uint16))]

    @staticmethod
    def _mark(k2: np.ndarray) -> np.ndarray:
        mark = (k2 & 0xFFFF).astype(np.uint16)
        return np.where(mark == 0, np.uint16(1), mark)

    @staticmethod
    def _bucket(table: _Table, k1: np.ndarray) -> np.ndarray:
        return (k1 >> 20) & table.last

    def contains(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        mark, found = self._mark(k2), np.zeros(len(k1), bool)
        for t in self.tables:
            found |= t.has(mark, self._bucket(t, k1))
        return found

    def insert(self, k1: np.ndarray, k2: np.ndarray) -> None:
        at = 0
        while at < len(k1):
            table = self.tables[-1]
            room = int(table.slots.size * 0.9) - int(np.count_nonzero(table.slots))
            take = slice(at, at + max(0, room))
            if room > 0:
                before = table.slots.copy()
                lost = table.insert(self._mark(k2[take]), self._bucket(table, k1[take]))
                if not len(lost):
                    at = take.stop
                    continue
                table.slots[:] = before
            self.tables.append(_Table(np.zeros((2 * len(table.slots), SLOTS), np.uint16)))

    def delete(self, k1: np.ndarray, k2: np.ndarray) -> None:
        for t in reversed(self.tables):
            found = t.delete(self._mark(k2), self._bucket(t, k1))
            k1, k2 = k1[~found], k2[~found]

    def to_bytes(self) -> bytes:
        sizes = np.array([len(self.tables), *(len(t.slots) for t in self.tables)], np.int64)
        return sizes.tobytes() + b"".join(t.slots.tobytes() for t in self.tables)

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        count = int(np.frombuffer(data, np.int64, 1)[0])
        sizes = np.frombuffer(data, np.int64, count, 8)
        out, at = cls.__new__(cls), 8 * (count + 1)
        out.tables = []
        for n in sizes:
            out.tables.append(_Table(np.frombuffer(data, np.uint16, n * SLOTS, at).reshape(n, SLOTS).copy()))
            at += 2 * SLOTS * int(n)
        return out
