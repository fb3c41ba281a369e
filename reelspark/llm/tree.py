"""A hierarchical k-means tree over unit vectors, and its best-bin-first traversal.

The tree is fitted on the driver on a bounded sample and sent to the tasks; every row is then put into a leaf. Nodes are
split until few sample rows are left, so dense regions get more leaves and the leaves hold about equally many rows,
however skewed the vectors are. A table too large for ``MAX_LEAVES`` leaves gets trees below the leaves that hold too many
rows, each fitted in a task on a bounded sample of its leaf, so that what a leaf holds does not grow with the table.
"""

from __future__ import annotations

import numpy as np

#: Rows that a leaf should hold, and the bounds on leaves and on sample rows (vectors on the driver and in broadcasts).
LEAF_ROWS = 512
MAX_LEAVES = 16_384
SAMPLE_PER_LEAF = 16
#: Rows in a leaf from which it gets a tree of its own.
DEEP_ROWS = 4096
BRANCHES = 16
ROUNDS = 6


def sample_size(rows: int, leaf_rows: int = LEAF_ROWS) -> int:
    """Sample rows for a tree over ``rows`` rows: ``SAMPLE_PER_LEAF`` for each leaf that it may get, at most 262,144."""
    return SAMPLE_PER_LEAF * min(MAX_LEAVES, max(16, -(-rows // leaf_rows)))


def rows_of_lowest_leaf(rows: int, leaf_rows: int = LEAF_ROWS) -> float:
    """Rows that a lowest leaf holds on average with as many levels of trees as ``rows`` needs, at most two."""
    held = rows * SAMPLE_PER_LEAF / sample_size(rows, leaf_rows)
    return held if held <= DEEP_ROWS else held * SAMPLE_PER_LEAF / sample_size(int(held), leaf_rows)


def k_means(x: np.ndarray, k: int, random: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Centres and the centre of each row; fewer than ``k`` centres if rows coincide."""
    centres = np.unique(x[random.choice(len(x), k, replace=False)], axis=0)
    for r in range(ROUNDS + 1):
        near = (0.5 * (centres**2).sum(1) - x @ centres.T).argmin(1)
        used = np.bincount(near, minlength=len(centres))
        if r < ROUNDS:
            member = (near == np.arange(len(centres))[:, None]).astype(x.dtype)
            centres = ((member @ x)[used > 0] / used[used > 0, None]).astype(x.dtype)
    keep = np.flatnonzero(used)
    new = np.full(len(used), -1)
    new[keep] = np.arange(len(keep))
    return centres[keep], new[near]


class Tree:
    """``centre`` of each node; node 0 is the root. The children of node ``i`` are ``first[i]`` to ``last[i] - 1``; a leaf
    has none and has the number ``leaf[i]``."""

    def __init__(self, sample: np.ndarray, seed: int = 11) -> None:
        random = np.random.default_rng(seed)
        sample = sample.astype(np.float32)
        centre = [sample.mean(0) if len(sample) else np.zeros(sample.shape[1], np.float32)]
        first, last, todo = [0], [0], [(0, np.arange(len(sample)))]
        for node, rows in todo:  # grows as it runs
            if len(rows) <= 1.5 * SAMPLE_PER_LEAF:
                continue
            centres, near = k_means(sample[rows], min(BRANCHES, -(-len(rows) // SAMPLE_PER_LEAF)), random)
            if len(centres) < 2:
                continue
            first[node], last[node] = len(centre), len(centre) + len(centres)
            for c in range(len(centres)):
                todo.append((len(centre), rows[near == c]))
                centre.append(centres[c])
                first.append(0)
                last.append(0)
        self.centre = np.array(centre, np.float32)
        self.first, self.last = np.array(first), np.array(last)
        self.half = 0.5 * (self.centre.astype(np.float64) ** 2).sum(1)
        is_leaf = self.first == self.last
        self.leaf = np.where(is_leaf, np.cumsum(is_leaf) - 1, -1)
        self.leaves = int(is_leaf.sum())

    def cost(self, x: np.ndarray, node: int) -> np.ndarray:
        """For rows ``x`` and the children of ``node``: half the squared distance, less what is the same for all nodes."""
        a, b = self.first[node], self.last[node]
        return self.half[a:b] - x @ self.centre[a:b].T

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row: the nearest child at every node down from the root."""
        x = x.astype(np.float32, copy=False)
        out = np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        for node, rows in todo:
            if self.first[node] == self.last[node]:
                out[rows] = self.leaf[node]
                continue
            near = self.cost(x[rows], node).argmin(1)
            order = np.argsort(near, kind="stable")
            ends = np.searchsorted(near[order], np.arange(self.last[node] - self.first[node] + 1))
            todo += [(self.first[node] + c, rows[order[ends[c] : ends[c + 1]]]) for c in range(len(ends) - 1) if ends[c] < ends[c + 1]]
        return out

    def leaf_centres(self) -> np.ndarray:
        """The centre of each leaf."""
        return self.centre[np.flatnonzero(self.leaf >= 0)]

    def visit(self, x: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """For each row of ``x`` the first ``most`` leaves that best-bin-first reaches, -1 where there are fewer, and what
        their centres cost (see :meth:`cost`).

        A queue for each row holds the nodes seen and not yet opened, and the one whose centre is nearest is opened next. The
        queues of all rows are worked on at once, a step at a time; those that have their leaves stand still.
        """
        n, most = len(x), min(most, self.leaves)
        costs = self.half.astype(np.float32) - x.astype(np.float32, copy=False) @ self.centre.T
        out, paid, got = np.full((n, most), -1), np.full((n, most), np.inf, np.float32), np.zeros(n, np.int64)
        node = np.zeros((n, 64), np.int64)
        queue = np.full((n, 64), np.inf, np.float32)
        queue[:, 0], used = 0, 1
        rows = np.arange(n)
        while len(rows):
            at = queue[rows, :used].argmin(1)
            now = node[rows, at]
            price = queue[rows, at]
            queue[rows, at] = np.inf
            open_ = price < np.inf
            rows, now, at = rows[open_], now[open_], at[open_]
            size = self.last[now] - self.first[now]
            done = size == 0
            r = rows[done]
            out[r, got[r]], paid[r, got[r]] = self.leaf[now[done]], costs[r, now[done]]
            got[r] += 1
            r, first, size, at = rows[~done], self.first[now[~done]], size[~done], at[~done]
            if len(r):
                wide = int(size.max())
                if used + wide > queue.shape[1]:
                    queue = np.concatenate([queue, np.full((n, queue.shape[1] + wide), np.inf, np.float32)], axis=1)
                    node = np.concatenate([node, np.zeros((n, node.shape[1] + wide), np.int64)], axis=1)
                child = first[:, None] + np.arange(wide)
                there = np.arange(wide) < size[:, None]
                child = np.where(there, child, 0)
                node[r, used : used + wide] = child
                queue[r, used : used + wide] = np.where(there, costs[r[:, None], child], np.inf)
                used += wide
            rows = rows[got[rows] < most]
        return out, paid
