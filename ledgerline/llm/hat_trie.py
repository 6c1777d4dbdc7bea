"""A trie of word ids whose leaves are burstable hash containers.

Paths are up to five word ids, packed into two numbers. The trie starts as
one container that holds every path. A container keeps new paths in a buffer, adds
them up in a hash table when the buffer is full, and bursts when it then holds
more than ``BURST`` different paths: one that covers several words at its depth is
split in two at the middle word (a hybrid container), one that covers a single word
becomes a node of the next depth, with containers for the words beside it. So the trie is shallow where paths are few and deep
only under words that begin many. When it holds more than ``LIMIT`` paths, its largest
subtrees are given back whole as sorted runs, until half of the room is free.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bits of a word id; 0 stands for the end of a path. Three ids in the first number, two
#: in the second.
BITS = 21
DEPTH = 5
MASK = (1 << BITS) - 1
BURST = 1 << 16
LIMIT = 1 << 21


def pack(paths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two numbers per row of ids (as many columns as a path has words, 5 at most)."""
    ids = np.zeros((len(paths), DEPTH), np.int64)
    ids[:, :paths.shape[1]] = paths
    # First words in the low bits, which differ most: Arrow's hash table is slow without that.
    return ids[:, 0] | (ids[:, 1] << BITS) | (ids[:, 2] << 2 * BITS), \
        ids[:, 3] | (ids[:, 4] << BITS)


def unpack(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return np.stack([_word(first, second, k) for k in range(DEPTH)], -1)


def _word(first: np.ndarray, second: np.ndarray, depth: int) -> np.ndarray:
    return ((first >> depth * BITS) if depth < 3 else (second >> (depth - 3) * BITS)) & MASK


def added(first: np.ndarray, second: np.ndarray, count: np.ndarray) \
        -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different paths and the sums of their counts, by a hash table."""
    found = pa.table({"a": first, "b": second, "n": count}).group_by(["a", "b"], use_threads=False) \
        .aggregate([("n", "sum")])
    return tuple(found[c].to_numpy() for c in ("a", "b", "n_sum"))


class Container:
    def __init__(self, depth: int):
        self.depth = depth
        self.table = tuple(np.zeros(0, np.int64) for _ in range(3))
        self.buffer: list[tuple] = []
        self.waiting = 0

    def add(self, paths: tuple) -> None:
        self.buffer.append(paths)
        self.waiting += len(paths[0])
        if self.waiting >= BURST:
            self.settle()

    def settle(self) -> None:
        if self.buffer:
            self.table = added(*[np.concatenate(c) for c in zip(self.table, *self.buffer)])
            self.buffer, self.waiting = [], 0

    def size(self) -> int:
        return len(self.table[0]) + self.waiting

    def full(self) -> bool:
        return len(self.table[0]) > BURST

    def paths(self) -> Iterator[tuple]:
        self.settle()
        yield self.table


class Node:
    """Children by ranges of the word at ``depth``: child k has words from ``cuts[k]`` on."""

    def __init__(self, depth: int):
        self.depth = depth
        self.cuts = np.zeros(1, np.int64)
        self.children: list[Container | Node] = [Container(depth)]

    def add(self, paths: tuple) -> None:
        if len(self.children) == 1:
            shares = [(0, paths)]
        else:
            child = np.searchsorted(self.cuts, _word(paths[0], paths[1], self.depth), "right") - 1
            order = np.argsort(child, kind="stable")
            child = child[order]
            first = np.flatnonzero(np.concatenate([[True], child[1:] != child[:-1]]))
            ends = np.append(first[1:], len(child))
            shares = [(int(child[a]), tuple(c[order[a:b]] for c in paths))
                      for a, b in zip(first, ends)]
        for k, share in reversed(shares):
            self.children[k].add(share)
            if self.children[k].full():
                self.burst(k)

    def burst(self, k: int) -> None:
        """Split the full container k, and what comes of it as long as it is full."""
        held = self.children[k]
        word = _word(held.table[0], held.table[1], self.depth)
        low, high = int(word.min()), int(word.max())
        start = int(self.cuts[k])
        end = int(self.cuts[k + 1]) if k + 1 < len(self.cuts) else MASK + 1
        if low < high:
            cut = max(int(np.median(word)), low + 1)
            left, right = Container(self.depth), Container(self.depth)
            for part, take in ((left, word < cut), (right, word >= cut)):
                part.table = tuple(c[take] for c in held.table)
            self._replace(k, [start, cut], [left, right])
            for at in (k + 1, k):
                if self.children[at].full():
                    self.burst(at)
        elif self.depth + 1 < DEPTH:
            deeper = Node(self.depth + 1)
            deeper.children[0].table = held.table
            parts = [(start, Container(self.depth))] if start < low else []
            parts += [(low, deeper)]
            parts += [(low + 1, Container(self.depth))] if low + 1 < end else []
            self._replace(k, *zip(*parts))
            if deeper.children[0].full():
                deeper.burst(0)

    def _replace(self, k: int, cuts, children) -> None:
        self.children[k:k + 1] = list(children)
        self.cuts = np.concatenate([self.cuts[:k], cuts, self.cuts[k + 1:]]).astype(np.int64)

    def full(self) -> bool:
        return False

    def size(self) -> int:
        return sum(c.size() for c in self.children)

    def paths(self) -> Iterator[tuple]:
        for c in self.children:
            yield from c.paths()


class HatTrie:
    def __init__(self, limit: int = LIMIT):
        self.root, self.limit = Node(0), limit

    def add(self, paths: np.ndarray, count: np.ndarray | None = None) -> Iterator[tuple]:
        """Count the rows of ``paths``; gives back the subtrees that had to go."""
        if len(paths):
            first, second = pack(paths)
            self.root.add(added(first, second, np.ones(len(paths), np.int64)
                                if count is None else count))
        if self.root.size() > self.limit:
            sizes = [c.size() for c in self.root.children]
            for k in np.argsort(sizes)[::-1]:
                if self.root.size() <= self.limit // 2:
                    break
                yield self._taken(int(k))

    def _taken(self, k: int) -> tuple:
        child, self.root.children[k] = self.root.children[k], Container(0)
        return tuple(np.concatenate(c) for c in zip(*child.paths()))

    def drain(self) -> Iterator[tuple]:
        """All that is left, a subtree at a time; the trie is empty afterwards."""
        for k in range(len(self.root.children)):
            taken = self._taken(k)
            if len(taken[0]):
                yield taken
        self.root = Node(0)
