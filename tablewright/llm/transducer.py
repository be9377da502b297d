"""Minimal acyclic transducers: a sorted list of terms as an automaton that outputs ordinals.

Built from terms in byte order, one at a time: when a term leaves the path of
the one before, the states below the branch are final and are shared with an
equal state met earlier (same finality, same arcs), so the automaton is
minimal all along.  An arc outputs how many terms lie before it under its
state; the outputs along a term's path add up to the term's ordinal.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

from .kernels import Lookup

SPREAD = np.uint64(0x9E3779B97F4A7C15)      # odd: distinct arcs keep distinct products


class Transducer:
    """Arcs sorted by (state, byte) in arrays: where they lead and what they output."""

    def __init__(self, keys: np.ndarray, targets: np.ndarray, outputs: np.ndarray, final: np.ndarray, root: int):
        self.keys, self.targets, self.outputs, self.final, self.root = keys, targets, outputs, final, root
        self._spread = None

    @classmethod
    def build(cls, terms: Iterable[bytes]) -> Transducer:
        """From distinct terms in byte order."""
        known: dict[tuple, int] = {}
        below: list[int] = []                   # terms under each state
        states: list[tuple[bool, tuple]] = []
        path: list[list] = [[False, []]]        # open states along the last term
        last = b""

        def close(depth: int) -> None:
            while len(path) > depth:
                ends, arcs = path.pop()
                state = (ends, tuple(arcs))
                at = known.get(state)
                if at is None:
                    at = known[state] = len(states)
                    states.append(state)
                    below.append(ends + sum(below[t] for _, t in arcs))
                if path:
                    path[-1][1].append((last[len(path) - 1], at))
        for term in terms:
            same = 0
            while same < min(len(term), len(last)) and term[same] == last[same]:
                same += 1
            if term <= last and states + path[1:]:
                raise ValueError("terms must be distinct and sorted")
            close(same + 1)
            path.extend([False, []] for _ in term[same:])
            path[-1][0] = True
            last = term
        close(0)
        keys, targets, outputs = [], [], []
        for s, (ends, arcs) in enumerate(states):
            before = int(ends)
            for byte, t in arcs:
                keys.append(s << 8 | byte)
                targets.append(t)
                outputs.append(before)
                before += below[t]
        return cls(np.array(keys, np.int64), np.array(targets, np.int32), np.array(outputs, np.int64),
                   np.array([e for e, _ in states], bool), len(states) - 1)

    def to_bytes(self) -> bytes:
        head = np.array([len(self.keys), len(self.final), self.root], np.int64)
        return b"".join(x.tobytes() for x in (head, self.keys, self.targets, self.outputs, self.final))

    @classmethod
    def from_bytes(cls, data: bytes) -> Transducer:
        arcs, states, root = (int(x) for x in np.frombuffer(data, np.int64, 3))
        at, parts = 24, []
        for kind, n in ((np.int64, arcs), (np.int32, arcs), (np.int64, arcs), (bool, states)):
            parts.append(np.frombuffer(data, kind, n, at))
            at += parts[-1].nbytes
        return cls(*parts, root)

    def _table(self) -> tuple[Lookup, np.ndarray]:
        """Arcs by their spread keys, and where these stand among the sorted ones."""
        if self._spread is None:
            spread = self.keys.astype(np.uint64) * SPREAD
            order = np.argsort(spread)
            self._spread = Lookup(spread[order], 2), order
        return self._spread

    def ordinals(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Ordinals of the byte runs ``data[start:end]``, -1 for those that are no term; all walk in step."""
        out = np.full(len(starts), -1, np.int64)
        if not len(self.keys):
            return out
        table, arcs = self._table()
        lanes = np.flatnonzero(ends > starts)
        at, stop = starts[lanes], ends[lanes]
        state, total = np.full(len(lanes), self.root, np.int64), np.zeros(len(lanes), np.int64)
        while len(lanes):
            arc = table.find((state << 8 | data[at]).astype(np.uint64) * SPREAD)
            there = arcs[arc]                                   # of a lane without an arc: any, it ends here
            state, total = self.targets[there], total + self.outputs[there]
            at = at + 1
            done = at == stop
            hit = np.flatnonzero(done & (arc >= 0) & self.final[state])
            out[lanes[hit]] = total[hit]
            on = np.flatnonzero(~done & (arc >= 0))
            lanes, at, stop, state, total = lanes[on], at[on], stop[on], state[on].astype(np.int64), total[on]
        return out

    def terms(self) -> Iterator[bytes]:
        """All terms in order of their ordinals."""
        first = np.searchsorted(self.keys, np.arange(len(self.final) + 1) << 8)
        todo = [(self.root, b"")]
        while todo:
            state, word = todo.pop()
            if self.final[state]:
                yield word
            for arc in range(first[state + 1] - 1, first[state] - 1, -1):
                todo.append((int(self.targets[arc]), word + bytes([int(self.keys[arc]) & 255])))
