"""Cheapest edits of a run of turns, and among equally cheap ones the least audit, by ranks of doubled paths.

A run is a sequence of items; a node is a place before an item together with the state of the output so far. States:
0 nothing, 1 after the system turn, 2 after a user turn, 3 after an assistant turn. Arcs are edits: Delete, Insert,
Keep, Rerole, whose initials make up the audit. Costs to the end come first, backwards; arcs that keep to them are
optimal. Optimal arcs are then ranked by the audits that begin with them, of 1, 2, 4, ... letters: the rank for twice
the length is that of the pair of ranks of an arc and of the arc that many letters on. A node's least arc leads on, and
the least path is read off through the doubled pointers.
"""

from __future__ import annotations

import numpy as np

#: Costs of the edits, and what an undeleted truncated turn adds.
DELETE, INSERT, KEEP, REROLE, TRUNCATED = 4, 3, 0, 3, 3
LETTERS = "DIKR"
#: The state after one more user or assistant turn.
NEXT = np.array([2, 2, 3, 2])
#: Cost to end the output from each state, by inserts: nothing and after an assistant turn it may end.
END = np.array([0, 2 * INSERT, INSERT, 0])
FAR = 1 << 50
#: Items whose paths are ranked together.
CHUNK = 4096
#: Letters of paths that are held side by side.
WIDE = 1 << 20

#: An item's code: its role's initial (s, u, a, other), whether it must go, whether it is truncated.
SYSTEM, USER, ASSISTANT, OTHER = range(4)
DOOMED, CUT = 4, 8


def _keep_target() -> np.ndarray:
    """State after keeping a turn of an initial (column) in a state (row), or -1."""
    target = np.full((4, 4), -1)
    target[0, SYSTEM] = 1
    target[[0, 1, 3], USER] = 2
    target[2, ASSISTANT] = 3
    return target


KEEP_TARGET = _keep_target()
CODES = np.arange(16)


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Per edit and item code, for each state: the state it leads to, and its cost for one turn."""
    to, cost = np.zeros((4, 16, 4), int), np.zeros((4, 16, 4), np.int64)
    to[0], cost[0] = np.arange(4), DELETE
    to[1], cost[1] = NEXT, INSERT
    extra = np.where(CODES & CUT, TRUNCATED, 0)[:, None]
    keep = KEEP_TARGET[:, CODES & 3].T
    gone = (CODES & DOOMED > 0)[:, None]
    to[2], cost[2] = np.maximum(keep, 0), np.where(gone | (keep < 0), FAR, KEEP + extra)
    to[3], cost[3] = NEXT, np.where(gone, FAR, REROLE + extra)
    return to, cost


TO, COST = _tables()


def _with_inserts(gap: np.ndarray) -> np.ndarray:
    """Costs of the four states (last axis but one, if two) when turns may be inserted first."""
    user, assistant = np.minimum(gap[:, 2], INSERT + gap[:, 3]), np.minimum(gap[:, 3], INSERT + gap[:, 2])
    return np.stack([np.minimum(gap[:, 0], INSERT + user), np.minimum(gap[:, 1], INSERT + user), user, assistant], axis=1)


def _before(codes: np.ndarray, counts: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Costs before an item of each run, given the costs after it; an item stands for ``counts`` equal deletions."""
    rows = np.arange(len(codes))[:, None]
    extra = (0,) * (after.ndim - 2)
    wide = lambda c: c[(..., *[None] * len(extra))]
    best = after + wide((DELETE * counts)[:, None])
    for edit in (2, 3):
        best = np.minimum(best, wide(COST[edit, codes]) + after[rows, TO[edit, codes]])
    return np.minimum(_with_inserts(best), FAR)


def costs_to_end(codes: np.ndarray, counts: np.ndarray, lengths: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Costs of every node of many runs laid one after another, and where each run's nodes begin.

    ``ends``: per run the costs after its last item. A run of n items has n + 1 places.
    """
    begins = np.cumsum(lengths + 1) - (lengths + 1)
    items = np.cumsum(lengths) - lengths
    cost = np.zeros((int((lengths + 1).sum()), *ends.shape[1:]), np.int64)
    order = np.argsort(-lengths, kind="stable")
    cost[begins + lengths] = ends
    now, left = ends[order], lengths[order]
    for back in range(1, int(lengths.max(initial=0)) + 1):
        active = int(np.searchsorted(-left, -back, side="right"))
        runs = order[:active]
        at = lengths[runs] - back
        now = _before(codes[items[runs] + at], counts[items[runs] + at], now[:active])
        cost[begins[runs] + at] = now
    return cost, begins


def transfer(codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Least cost from each state before a run to each state after it (4 x 4)."""
    ends = np.where(np.eye(4, dtype=bool), 0, FAR)[None]
    cost, _ = costs_to_end(codes, counts, np.array([len(codes)]), ends)
    return cost[0]


def join_costs(matrix: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Costs before a run from its transfer and the costs after it."""
    return np.minimum((matrix + after).min(axis=1), FAR)


class _Arcs:
    """Optimal arcs of chunks of items, ranked by the audits that begin with them."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, lengths: np.ndarray, cost: np.ndarray):
        """``cost``: of all nodes, chunk after chunk, each of one place more than it has items."""
        begins = np.cumsum(lengths + 1) - (lengths + 1)
        place = np.delete(np.arange(len(cost)), begins + lengths)  # the last place of a chunk has no arcs
        nodes = (place[:, None] * 4 + np.arange(4)).ravel()
        state, code, count = np.tile(np.arange(4), len(codes)), np.repeat(codes, 4), np.repeat(counts, 4)
        flat, source, target, letter = cost.ravel(), [], [], []
        for edit in range(4):
            to = TO[edit, code, state]
            goal = (nodes - state) + to + (0 if edit == 1 else 4)
            price = COST[edit, code, state] * (count if edit == 0 else 1)
            good = flat[nodes] == price + flat[goal]
            good &= flat[nodes] < FAR
            source.append(nodes[good])
            target.append(goal[good])
            letter.append(np.full(good.sum(), edit))
        source, target, letter = map(np.concatenate, (source, target, letter))
        self.target, self.letter, self.source = target, letter, source
        none = len(source)  # stands for the end of a path: it ranks first and leads to itself
        rank = np.append(letter + 1, 0)
        on = np.append(self._least(rank, source, none, cost.size)[target], none)
        self.jumps, longest = [on], 1
        most = 3 * (int(lengths.max(initial=0)) + 1)
        while longest < most:
            _, rank = np.unique(rank * np.int64(none + 2) + rank[on], return_inverse=True)
            on = on[on]
            self.jumps.append(on)
            longest *= 2
        self.first, self.none = self._least(rank, source, none, cost.size), none

    @staticmethod
    def _least(rank: np.ndarray, source: np.ndarray, none: int, nodes: int) -> np.ndarray:
        """Each node's arc of least rank."""
        order = np.lexsort((rank[:none], source))
        first = np.full(nodes, none)
        head = order[np.append(True, source[order][1:] != source[order][:-1])] if none else order
        first[source[head]] = head
        return first

    def paths(self, starts: np.ndarray) -> np.ndarray:
        """Arcs of the least path from each node, in rows; filled up with the arc that stands for the end."""
        found = self.first[starts][:, None]
        for jump in reversed(self.jumps):
            found = np.stack([found, jump[found]], axis=2).reshape(len(starts), -1)
        return found


def _together(sizes: np.ndarray) -> list[np.ndarray]:
    """Chunks of like length in groups whose paths fit side by side."""
    groups = []
    kind = np.frexp(sizes)[1]
    for k in np.unique(kind):
        members, step = np.flatnonzero(kind == k), max(1, WIDE >> int(k))
        groups += [members[low : low + step] for low in range(0, len(members), step)]
    return groups


def least_audits(codes: np.ndarray, counts: np.ndarray, lengths: np.ndarray, cost: np.ndarray, entries: list[list[int]]) -> list[list[tuple[int, list[str]]]]:
    """For each run and each of its entry states, the state after it and the letters spent on each item.

    An item's letters are the inserts before it and its own edit; a deleted item has as many D as it counts.
    ``cost``: of all nodes as ``costs_to_end`` gives them. Long runs are ranked in chunks, whose ends are nodes with
    known costs, and put together afterwards.
    """
    chunks, item, node = [], 0, 0
    for run, n in enumerate(lengths.tolist()):
        chunks += [(run, min(CHUNK, n - low), item + low, node + low) for low in range(0, n, CHUNK)]
        item, node = item + n, node + n + 1
    results: list[list[tuple[int, list[str]]]] = [[(e, []) for e in entry] for entry in entries]
    if not chunks:
        return results
    runs, sizes, items, nodes = np.array(chunks).T
    single = np.bincount(runs, minlength=len(lengths)) == 1
    found = {}
    for group in _together(sizes):
        own = np.concatenate([np.arange(items[c], items[c] + sizes[c]) for c in group])
        places = np.concatenate([np.arange(nodes[c], nodes[c] + sizes[c] + 1) for c in group])
        arcs = _Arcs(codes[own], counts[own], sizes[group], cost[places])
        begins = np.cumsum(sizes[group] + 1) - (sizes[group] + 1)
        # Later chunks are asked from every state. One that no path can be in has no arcs and is not met in the end.
        asked = [(k, c, e) for k, c in enumerate(group) for e in (entries[runs[c]] if single[runs[c]] else range(4))]
        paths = arcs.paths(np.array([begins[k] * 4 + e for k, _, e in asked]))
        place, letters = np.append(arcs.source // 4, 0), np.append(arcs.letter, -1)
        for (k, c, e), path in zip(asked, paths, strict=True):
            path = path[path != arcs.none]
            pieces = [""] * int(sizes[c])
            for p, letter in zip((place[path] - begins[k]).tolist(), letters[path].tolist(), strict=True):
                pieces[p] += "D" * int(counts[items[c] + p]) if letter == 0 else LETTERS[letter]
            found[c, e] = (int(arcs.target[path[-1]]) % 4 if len(path) else e, pieces)
    for c, run in enumerate(runs.tolist()):
        for k, (state, done) in enumerate(results[run]):
            after, pieces = found[c, state]
            results[run][k] = (after, done + pieces)
    return results
