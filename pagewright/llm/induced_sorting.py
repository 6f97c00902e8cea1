"""Suffix order and common prefixes by external induced sorting.

Suffix tuples (position, common prefix with the tuple before it) of sorted suffixes induce those of the suffixes one character longer.
They leave the induction in sorted order, so that the priority queue of (first character, rank of the rest) is a run of tuples for each
first character, read first in, first out; that holds for the descending pass too. Runs are written to disk whenever all queues
together hold more than `memory` bytes, and are read back in pieces. What a character's queue induces into itself is its next round.

The common prefix of two neighbours that are induced is one more than the least common prefix among the sources from the one's to the
other's: a range minimum over the sources' common prefixes, which are carried along. Seams, where nothing induces it, are compared: one
for each character between its L and S suffixes, and those of the seeds.

Left-most S suffixes, the seeds, are sorted by induction over their substrings, named, and, where names repeat, by recursion on the
string of names. Names that are many (ALPHABET) are ranked by doubling instead, as a queue for each of them would be as long as the
names. Order and common prefixes are exact to `depth` characters; ties beyond it are in no set order.

Text, types and results of texts over `memory` bytes are memory-mapped files in the worker's scratch folder, which is what Spark's own
spills use: nothing there outlives the call or is read by another process.
"""

from __future__ import annotations

import os
import tempfile
from contextlib import ExitStack

import numpy as np

#: Bytes of queued tuples that all queues of a sort keep in memory together.
MEMORY = 64 << 20
#: Tuples that are handled at once.
TAKE = 1 << 18
#: Names that a recursion by induction has at most; beyond that doubling is faster.
ALPHABET = 2048


class Scratch:
    """Arrays and files of one sort, in a folder that goes with it."""

    def __init__(self, memory: int):
        self.memory, self.stack, self.folder, self.files, self.spilled = memory, ExitStack(), None, 0, 0
        self.unread: dict[str, int] = {}

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self.stack.close()

    def name(self) -> str:
        if self.folder is None:
            self.folder = self.stack.enter_context(tempfile.TemporaryDirectory(prefix="induced-"))
        self.files += 1
        return os.path.join(self.folder, f"{self.files}.npy")

    def array(self, n: int, kind) -> np.ndarray:
        """An empty array, in a file if it has more than `memory` bytes."""
        if n * np.dtype(kind).itemsize <= self.memory:
            return np.empty(n, dtype=kind)
        return np.lib.format.open_memmap(self.name(), mode="w+", dtype=kind, shape=(n,))


class Queues:
    """First-in first-out queues of tuples (position, common prefix), one for each character."""

    def __init__(self, scratch: Scratch):
        self.scratch, self.held = scratch, 0
        self.parts: dict[int, list[tuple[np.ndarray, np.ndarray] | tuple[str, int]]] = {}

    def put(self, c: int, p: np.ndarray, common: np.ndarray) -> None:
        if not len(p):
            return
        self.parts.setdefault(c, []).append((p, common))
        self.held += p.nbytes + common.nbytes
        if self.held > self.scratch.memory:
            self._spill()

    def _spill(self) -> None:
        """All that is in memory goes to one file, queue by queue."""
        name, at, held = self.scratch.name(), 0, []
        with open(name, "wb") as f:
            for parts in self.parts.values():
                for k, x in enumerate(parts):
                    if isinstance(x[0], np.ndarray):
                        f.write(np.ascontiguousarray(x[0]).data)
                        f.write(np.ascontiguousarray(x[1]).data)
                        held.append((parts, k, (name, at, len(x[0]), x[0].dtype, x[1].dtype)))
                        at += x[0].nbytes + x[1].nbytes
        for parts, k, x in held:
            parts[k] = x
        self.held = 0
        self.scratch.spilled += at
        self.scratch.unread[name] = len(held)

    def put_by(self, characters: np.ndarray, p: np.ndarray, common: np.ndarray) -> None:
        """Each tuple to its character's queue. The tuples come character by character, in order for each."""
        if not len(p):
            return
        cut = np.concatenate([[0], np.flatnonzero(np.diff(characters)) + 1, [len(p)]])
        for c, a, b in zip(characters[cut[:-1]].tolist(), cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            self.put(c, p[a:b], common[a:b])

    def take(self, c: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """What the queue holds, in order, in few pieces of bounded size, each read when its turn comes."""
        parts = self.parts.pop(c, [])
        for x in parts:
            if isinstance(x[0], np.ndarray):
                self.held -= x[0].nbytes + x[1].nbytes
        out: list[list] = []
        size = TAKE
        for x in parts:
            n = len(x[0]) if isinstance(x[0], np.ndarray) else x[2]
            if size + n > TAKE:
                out.append([])
                size = 0
            out[-1].append(x)
            size += n
        return _Pieces(out, self.scratch)


class _Pieces(list):
    """Lists of parts, each list joined to one piece when it is asked for, once."""

    def __init__(self, parts: list, scratch: Scratch):
        super().__init__(parts)
        self.scratch = scratch

    def __iter__(self):
        return (self._joined(x) for x in list.__iter__(self))

    def __reversed__(self):
        return (self._joined(x) for x in list.__reversed__(self))

    def _joined(self, parts: list) -> tuple[np.ndarray, np.ndarray]:
        got = [x if isinstance(x[0], np.ndarray) else self._read(*x) for x in parts]
        return got[0] if len(got) == 1 else (np.concatenate([x[0] for x in got]), np.concatenate([x[1] for x in got]))

    def _read(self, name: str, at: int, n: int, kind: np.dtype, other: np.dtype) -> tuple[np.ndarray, np.ndarray]:
        with open(name, "rb") as f:
            f.seek(at)
            got = np.fromfile(f, kind, n), np.fromfile(f, other, n)
        self.scratch.unread[name] -= 1
        if not self.scratch.unread[name]:
            os.remove(name)
        return got


class Minima:
    """Common prefixes of what a pass induces: for each character, the least one among the sources since it was induced last."""

    def __init__(self, depth: int):
        self.depth, self.since = depth, {}
        self.rest = depth  # of characters that were never induced

    def step(self, common: np.ndarray, where: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """common: of all sources of a batch with the one before; where: numbers of those that induce; kind: into which queue. These
        come character by character, ascending for each. Gives each induced tuple's common prefix with the one before it in its queue.
        """
        n = len(common)
        table = [common]
        while (1 << len(table)) <= n:
            half, last = 1 << (len(table) - 1), table[-1]
            table.append(np.minimum(last[:-half], last[half:]))
        new = np.ones(len(where), dtype=bool)
        new[1:] = kind[1:] != kind[:-1]
        begin = np.zeros(len(where), dtype=np.int64)
        begin[1:] = where[:-1] + 1
        begin[new] = 0
        least = self._range(table, begin, where)
        heads = np.flatnonzero(new)
        names = kind[heads].tolist()
        old = np.array([self.since.get(c, self.rest) for c in names], dtype=common.dtype)
        least[heads] = np.minimum(least[heads], old)
        # After the batch: the rest of it for characters in it, all of it for the others.
        whole = int(common.min()) if n else self.depth
        for c in self.since:
            self.since[c] = min(self.since[c], whole)
        self.rest = min(self.rest, whole)
        tails = where[np.append(heads[1:], len(where)) - 1] if len(where) else where
        after = np.full(len(tails), self.depth, dtype=common.dtype)
        some = tails + 1 < n
        after[some] = self._range(table, tails[some] + 1, np.full(int(some.sum()), n - 1))
        self.since.update(zip(names, after.tolist(), strict=True))
        return np.minimum(least, self.depth - 1) + common.dtype.type(1)

    @staticmethod
    def _range(table: list[np.ndarray], begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The least of common[begin..end], both included."""
        out = np.empty(len(begin), dtype=table[0].dtype)
        length = end - begin + 1
        level = np.frexp(length)[1] - 1  # exact to 2^53
        for k in np.unique(level).tolist():
            pick = level == k
            a, b = begin[pick], end[pick]
            out[pick] = np.minimum(table[k][a], table[k][b - (1 << k) + 1])
        return out


def _types(t: np.ndarray, scratch: Scratch) -> np.ndarray:
    """Whether each suffix is smaller than the next one. The last character is the unique least one."""
    s = scratch.array(len(t), bool)
    s[-1] = True
    carry, step = True, 1 << 22
    for b in range(len(t) - 1, 0, -step):
        a = max(b - step, 0)
        part, after = t[a:b], t[a + 1 : b + 1]
        same = part == after
        rising = part < after
        # An equal character takes the type of the next one that is not equal.
        known = np.flatnonzero(~same)
        lengths = np.diff(np.concatenate([[-1], known, [b - a - 1]]))
        s[a:b] = np.repeat(np.append(rising[known], carry), lengths)
        carry = bool(s[a])
    return s


def _common(t: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """Common prefixes of the suffixes at a and b, to `depth`, eight characters at a time; of bytes as one number."""
    out, n = np.zeros(len(a), dtype=np.int64), len(t)
    left = np.arange(len(a))
    words = np.ndarray((n - 7,), dtype="<u8", buffer=t, strides=(1,)) if t.dtype == np.uint8 and n >= 8 and t.flags.c_contiguous else None
    for k in range(0, depth, 8):
        if not len(left):
            break
        x, y = a[left] + k, b[left] + k
        if words is not None:
            whole = np.maximum(x, y) < n - 7
            differ = words[np.where(whole, x, 0)] ^ words[np.where(whole, y, 0)]
            lowest = (differ & (~differ + np.uint64(1))).astype(np.float64)  # a power of two
            first = np.where(differ != 0, np.frexp(lowest)[1] - 1 >> 3, 8)
            if not whole.all():
                first[~whole] = _eight(t, x[~whole], y[~whole])
        else:
            first = _eight(t, x, y)
        out[left] = k + first
        left = left[first == 8]
    return np.minimum(out, depth)


def _eight(t: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    n, step = len(t), np.arange(8)
    x, y = x.astype(np.int64)[:, None] + step, y.astype(np.int64)[:, None] + step
    differ = t[np.minimum(x, n - 1)] != t[np.minimum(y, n - 1)]
    differ |= (x >= n) | (y >= n)
    return np.where(differ.any(axis=1), differ.argmax(axis=1), 8)


def _induce(t: np.ndarray, s: np.ndarray, seeds: np.ndarray, common: np.ndarray, depth: int, scratch: Scratch, carry: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """All suffixes in order, and their common prefixes with the one before, given the left-most S ones in order with theirs. Without
    `carry` the order alone."""
    kind = common.dtype
    present = np.unique(t).tolist()
    seeded, queue, low = Queues(scratch), Queues(scratch), Queues(scratch)
    for i in range(0, len(seeds), TAKE):
        p, l = seeds[i : i + TAKE], common[i : i + TAKE]  # noqa: E741
        order = np.argsort(t[p], kind="stable")
        seeded.put_by(t[p[order]], p[order], l[order])

    def send(p: np.ndarray, l: np.ndarray, small: bool, minima: Minima) -> None:  # noqa: E741
        at = np.flatnonzero(p > 0)
        q = p[at] - 1
        ok = s[q] == small
        at, q = at[ok], q[ok]
        c = t[q]
        order = np.argsort(c, kind="stable")
        at, q, c = at[order], q[order], c[order]
        queue.put_by(c, q, minima.step(l, at, c) if carry else np.zeros(len(q), kind))

    minima = Minima(depth)
    for c in present:
        last = None  # the source before, if it has the same first character
        while batch := queue.take(c):
            for p, l in batch:  # noqa: E741
                if last is None:
                    l = np.concatenate([np.zeros(1, kind), l[1:]])  # noqa: E741
                last = p[-1:]
                low.put(c, p, l)
                send(p, l, False, minima)
        for p, l in seeded.take(c):  # noqa: E741
            if last is None or last is not seeded:
                first = 0 if last is None else _common(t, last, p[:1], depth)[0]
                l = np.concatenate([np.array([first], kind), l[1:]])  # noqa: E741
            last = seeded
            send(p, l, False, minima)
    n = len(t)
    out, out_common, at = scratch.array(n, seeds.dtype), scratch.array(n, kind), n
    minima = Minima(depth)
    for c in present[::-1]:
        last = None
        while batch := queue.take(c):
            for p, l in batch:  # noqa: E741
                if last is None:
                    l = np.concatenate([np.zeros(1, kind), l[1:]])  # noqa: E741
                else:
                    out_common[at] = l[0]
                out[at - len(p) : at] = p[::-1]
                out_common[at - len(p) + 1 : at] = l[:0:-1]
                at -= len(p)
                last = p[-1:]
                send(p, l, True, minima)
        larger = 0
        for p, l in reversed(low.take(c)):  # noqa: E741
            if last is not None:
                larger = larger if last is low else int(_common(t, p[-1:], last, depth)[0])
                out_common[at] = larger
            out[at - len(p) : at] = p
            out_common[at - len(p) : at] = l
            at -= len(p)
            down = np.concatenate([np.array([larger], kind), l[:0:-1]])
            larger, last = int(l[0]), low
            send(p[::-1], down, True, minima)
        if last is not None:
            out_common[at] = 0
        if c == present[0]:  # the last suffix, which nothing induces
            at -= 1
            out[at], out_common[at] = n - 1, 0
    return out, out_common


def _doubling(r: np.ndarray, depth: int) -> np.ndarray:
    """Ranks of the suffixes of a string of numbers, exact to `depth` of them."""
    _, rank = np.unique(r, return_inverse=True)
    k, n = 1, len(r)
    while k < depth and int(rank.max()) + 1 < n:
        second = np.zeros(n, dtype=np.int64)
        second[: n - k] = rank[k:] + 1
        _, rank = np.unique(rank.astype(np.int64) * (n + 1) + second, return_inverse=True)
        k *= 2
    return rank


def _names(t: np.ndarray, left: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Names of the left-most S substrings, by rank: `number` has them in order; equal ones have equal names."""
    n = len(t)
    stop = np.append(left[1:], n - 1).astype(np.int64) + 1
    with np.errstate(over="ignore"):
        power = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n, 0xD6E8FEB86659FD93, dtype=np.uint64)]))
        h = np.concatenate([[np.uint64(0)], np.cumsum((t.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) * power[:n])])
        inverse = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n, pow(0xD6E8FEB86659FD93, -1, 1 << 64), dtype=np.uint64)]))
        key = (h[stop] - h[left]) * inverse[left]
    size = stop - left
    new = np.ones(len(left), dtype=bool)
    new[1:] = (key[number][1:] != key[number][:-1]) | (size[number][1:] != size[number][:-1])
    names = np.empty(len(left), dtype=np.int64)
    names[number] = np.cumsum(new)
    return names


def suffix_order(text: np.ndarray, depth: int, memory: int = MEMORY, told: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the suffixes of `text` (whole numbers, the last one the unique least) in order of their first `depth` characters,
    and each one's common prefix with the one before, to `depth`. `told` gets the bytes that went to disk and the depth of recursion."""
    t = np.asarray(text)
    n = len(t)
    kind, common_kind = (np.int32 if n < 1 << 31 else np.int64), (np.uint8 if depth < 256 else np.int64)
    with Scratch(memory) as scratch:
        s = _types(t, scratch)
        left = (np.flatnonzero(s[1:] & ~s[:-1]) + 1).astype(kind)
        if len(left) == 0:
            left = np.array([n - 1], dtype=kind)
            out = _induce(t, s, left, np.zeros(1, common_kind), depth, scratch)
        else:
            order, _ = _induce(t, s, left, np.zeros(len(left), common_kind), depth, scratch, carry=False)
            number = np.full(n, -1, dtype=kind)
            number[left] = np.arange(len(left))
            rank = number[order]
            rank = rank[rank >= 0]
            sorted_left = left[rank]
            names = _names(t, left, rank)
            distinct = int(names.max())
            if distinct < len(left):
                # A substring covers two characters at least, besides the one that it shares with the next.
                deeper = depth if len(left) < 4 else -(-depth // 2) + 1
                if distinct <= ALPHABET:
                    inner, _ = suffix_order(names, deeper, memory, told)
                    if told is not None:
                        told["levels"] = told.get("levels", 0) + 1
                    sorted_left = left[inner]
                else:
                    sorted_left = left[np.argsort(_doubling(names, deeper), kind="stable")]
            common = np.zeros(len(left), dtype=common_kind)
            for i in range(1, len(left), TAKE):
                j = min(i + TAKE, len(left))
                common[i:j] = _common(t, sorted_left[i - 1 : j - 1], sorted_left[i:j], depth)
            out = _induce(t, s, sorted_left, common, depth, scratch)
        if told is not None:
            told["spilled"] = told.get("spilled", 0) + scratch.spilled
        return np.array(out[0]), np.array(out[1])
