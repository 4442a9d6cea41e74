"""The stop-event state machine over Arrow batches of sorted (ship, slice) groups.

Shipped to the executors by value, so they need numpy and pyarrow but not this package.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

from fairlead.functions.grid import AXIS_BITS, AXIS_MASK, OFFSET

cloudpickle.register_pickle_by_value(sys.modules[__name__])

NONE = -1
#: The event that was open when the slice began.
ENTERED = -2
#: Slices of at most this many pings are run side by side; longer ones each by themselves, in blocks.
SHORT = 64


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables holding only whole (ship, slice) groups, with the group boundaries."""

    def keys(b):
        return b.column("mmsi").to_numpy(zero_copy_only=False), b.column("_slice").to_numpy(zero_copy_only=False)

    def whole(parts):
        table = pa.Table.from_batches(parts).combine_chunks()
        m, s = table["mmsi"].to_numpy(), table["_slice"].to_numpy()
        cuts = np.flatnonzero((m[1:] != m[:-1]) | (s[1:] != s[:-1])) + 1
        return table, np.concatenate(([0], cuts, [len(m)]))

    held: list[pa.RecordBatch] = []
    held_key = None
    for b in batches:
        if b.num_rows == 0:
            continue
        m, s = keys(b)
        changes = np.flatnonzero((m[1:] != m[:-1]) | (s[1:] != s[:-1])) + 1
        if not len(changes) and held_key == (m[0], s[0]):
            held.append(b)
            continue
        last = int(changes[-1]) if len(changes) else 0
        ready = held + ([b.slice(0, last)] if last else [])
        if ready:
            yield whole(ready)
        held, held_key = [b.slice(last)], (m[-1], s[-1])
    if held:
        yield whole(held)


class _Slice:
    """One slice of one ship: where events open and close."""

    def __init__(self, cells: np.ndarray, slow: np.ndarray, depth: int):
        self.q = ((cells >> AXIS_BITS) & AXIS_MASK) - OFFSET
        self.r = (cells & AXIS_MASK) - OFFSET
        self.cells, self.depth, self.n = cells, depth, len(cells)
        self.slow = np.flatnonzero(slow)
        self.known: dict[int, int] = {}

    def leaves(self, q: int, r: int, start: int) -> int:
        """First position from ``start`` out of reach of (q, r); n when none is."""
        block = 32
        while start < self.n:
            dq, dr = self.q[start : start + block] - q, self.r[start : start + block] - r
            away = np.maximum(np.maximum(np.abs(dq), np.abs(dr)), np.abs(dq + dr)) > self.depth
            if away.any():
                return start + int(away.argmax())
            start += block
            block *= 2
        return self.n

    def leaves_each(self, q: np.ndarray, r: np.ndarray, start: int) -> np.ndarray:
        """:meth:`leaves` for many centres at once."""
        out = np.full(len(q), self.n)
        alive = np.arange(len(q))
        while start < self.n and len(alive):
            dq = self.q[start : start + 2048] - q[alive, None]
            dr = self.r[start : start + 2048] - r[alive, None]
            away = np.maximum(np.maximum(np.abs(dq), np.abs(dr)), np.abs(dq + dr)) > self.depth
            gone = away.any(axis=1)
            out[alive[gone]] = start + away[gone].argmax(axis=1)
            alive = alive[~gone]
            start += 2048
        return out

    def opens(self, start: int) -> int:
        i = int(np.searchsorted(self.slow, start))
        return int(self.slow[i]) if i < len(self.slow) else self.n

    def events(self, start: int) -> Iterator[tuple[int, int]]:
        """(first, one past last) of each event when no event is open at ``start``."""
        while (first := self.opens(start)) < self.n:
            end = self.leaves(int(self.q[first]), int(self.r[first]), first + 1)
            yield first, end
            start = end + 1

    def open_at_end(self, start: int) -> int:
        """Anchor position of the event still open at the end, or NONE."""
        path, result = [], NONE
        while (first := self.opens(start)) < self.n:
            if first in self.known:
                result = self.known[first]
                break
            path.append(first)
            end = self.leaves(int(self.q[first]), int(self.r[first]), first + 1)
            if end == self.n:
                result = first
                break
            start = end + 1
        for p in path:
            self.known[p] = result
        return result


def _side_by_side(cells: np.ndarray, slow: np.ndarray, begin: np.ndarray, n: np.ndarray, state: list[np.ndarray], depth: int, path: np.ndarray | None = None) -> None:
    """Run the machine over short slices side by side: their first pings, then their second ones, and so on.

    ``state`` has the anchor's q and r and its position (NONE without an event, ENTERED for that of the entry), one
    row a slice and one column an entry state, and is changed in place. ``path`` takes the position that each
    ping belongs to, of the first column.
    """
    order = np.argsort(-n, kind="stable")
    begin, longest = begin[order], n[order]
    q, r, pos = (x[order] for x in state)
    for t in range(int(longest[0]) if len(longest) else 0):
        k = int(np.searchsorted(-longest, -t))
        at = begin[:k] + t
        cq = (((cells[at] >> AXIS_BITS) & AXIS_MASK) - OFFSET)[:, None]
        cr = ((cells[at] & AXIS_MASK) - OFFSET)[:, None]
        dq, dr, now = cq - q[:k], cr - r[:k], pos[:k]
        away = np.maximum(np.maximum(np.abs(dq), np.abs(dr)), np.abs(dq + dr)) > depth
        idle = now == NONE
        opened = idle & slow[at][:, None]
        now[away & ~idle] = NONE
        now[opened] = t
        np.copyto(q[:k], cq, where=opened)
        np.copyto(r[:k], cr, where=opened)
        if path is not None:
            path[at] = now[:, 0]
    for x, y in zip(state, (q, r, pos)):
        x[order] = y


# Per slice: what it does to each entry state, and the facts its ship is judged by.
SUMMARY = (
    "mmsi bigint, _slice bigint, none_pos int, none_cell bigint, far_pos int, far_cell bigint, "
    "stays array<bigint>, other array<bigint>, other_pos array<int>, other_cell array<bigint>, "
    "_n bigint, _first_unix bigint, _last_unix bigint, _type string, _imo bigint"
)
# State a slice is entered in, appended to the facts chosen by the caller.
STATE = "in_slice bigint, in_pos int, in_cell bigint"


_TYPES = {
    "bigint": pa.int64(), "int": pa.int32(), "string": pa.string(),
    "array<bigint>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
}


def _to_batch(columns: dict, schema: str) -> pa.RecordBatch:
    fields = [f.split(" ") for f in schema.split(", ")]
    made = [c if isinstance(c := columns[n], pa.Array) else pa.array(c, _TYPES[t]) for n, t in fields]
    return pa.record_batch(made, names=[n for n, _ in fields])


def _lists(values: np.ndarray, chosen: np.ndarray, kind: pa.DataType) -> pa.Array:
    """One list a row: the values chosen there."""
    offsets = np.concatenate(([0], np.cumsum(chosen.sum(axis=1))))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values[chosen], kind))


def summarise(offsets: list[tuple[int, int]], depth: int):
    off_q = np.array([dq for dq, _ in offsets])
    off_r = np.array([dr for _, dr in offsets])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in _groups(batches):
            ship, part = table["mmsi"].to_numpy(), table["_slice"].to_numpy()
            cells, slow = table["_cell"].to_numpy(), table["_slow"].to_numpy()
            unix, kinds = table["cluster_time"].to_numpy(), table["vessel_type"].take(pa.array(bounds[:-1])).to_pylist()
            imo_rows = np.flatnonzero(table["imo"].is_valid().to_numpy())
            imo_first = np.searchsorted(imo_rows, bounds[:-1])
            imos = table["imo"].take(pa.array(imo_rows)).to_numpy()
            begin, n = bounds[:-1], np.diff(bounds)
            head = cells[begin]
            # entry states: none open, one out of reach of the first ping, and one anchored at each cell in its reach
            q = (((head >> AXIS_BITS) & AXIS_MASK) - OFFSET)[:, None] + np.concatenate(([0, depth + 1], off_q))
            r = ((head & AXIS_MASK) - OFFSET)[:, None] + np.concatenate(([0, 0], off_r))
            pos = np.full(q.shape, ENTERED, np.int32)
            pos[:, 0] = NONE
            short = n <= SHORT
            state = [q[short], r[short], pos[short]]
            _side_by_side(cells, slow, begin[short], n[short], state, depth)
            pos[short] = state[2]
            for g in np.flatnonzero(~short):
                s = _Slice(cells[bounds[g] : bounds[g + 1]], slow[bounds[g] : bounds[g + 1]], depth)
                left = s.leaves_each(s.q[0] + off_q, s.r[0] + off_r, 1)
                after = [ENTERED if end == s.n else s.open_at_end(end + 1) for end in left.tolist()]
                pos[g] = [s.open_at_end(0), s.open_at_end(1), *after]
            at_end = np.where(pos >= 0, cells[begin[:, None] + np.maximum(pos, 0)], NONE)
            anchors = head[:, None] + (off_q << AXIS_BITS) + off_r
            stays = pos[:, 2:] == ENTERED
            other = ~stays & (pos[:, 2:] != pos[:, 1:2])
            got = imo_first < len(imo_rows)
            got[got] = imo_rows[imo_first[got]] < bounds[1:][got]
            imo = pa.array(imos, pa.int64()).take(pa.array(np.where(got, imo_first, 0), mask=~got))
            out = {
                "mmsi": ship[begin], "_slice": part[begin],
                "none_pos": pos[:, 0], "none_cell": at_end[:, 0], "far_pos": pos[:, 1], "far_cell": at_end[:, 1],
                "stays": _lists(anchors, stays, pa.int64()),
                "other": _lists(anchors, other, pa.int64()),
                "other_pos": _lists(pos[:, 2:], other, pa.int32()),
                "other_cell": _lists(at_end[:, 2:], other, pa.int64()),
                "_n": n, "_first_unix": unix[begin], "_last_unix": unix[bounds[1:] - 1], "_type": kinds, "_imo": imo,
            }
            yield _to_batch(out, SUMMARY)

    return run


MACHINE = ["mmsi", "_slice"] + [f.split(" ")[0] for f in SUMMARY.split(", ")][2:10]


def chain(facts: list[str]):
    """Follow each ship through its slice summaries, sorted by ship and slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ship, state = None, (NONE, NONE, NONE)
        for b in batches:
            out: dict[str, list] = {f.split(" ")[0]: [] for f in STATE.split(", ")}
            stays, other, other_pos, other_cell = (b.column(c) for c in MACHINE[-4:])
            alone = zip(*(b.column(c).to_pylist() for c in MACHINE[:-4]))
            for i, (mmsi, part, none_pos, none_cell, far_pos, far_cell) in enumerate(alone):
                if mmsi != ship:
                    ship, state = mmsi, (NONE, NONE, NONE)
                for name, v in zip(out, state):
                    out[name].append(v)
                # the lists are looked at only where an event is open
                if state[1] == NONE:
                    pos, cell = none_pos, none_cell
                elif state[2] in stays[i].as_py():
                    continue
                elif state[2] in (known := other[i].as_py()):
                    j = known.index(state[2])
                    pos, cell = other_pos[i][j].as_py(), other_cell[i][j].as_py()
                else:
                    pos, cell = far_pos, far_cell
                state = (part, pos, cell) if pos != NONE else (NONE, NONE, NONE)
            entered = _to_batch(out, STATE)
            kept = b.select(facts)
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, *entered.columns], names=[*kept.schema.names, *entered.schema.names]
            )

    return run


def label(depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in _groups(batches):
            part = table["_slice"].to_numpy()
            cells, slow = table["_cell"].to_numpy(), table["_slow"].to_numpy()
            in_slice, in_pos, in_cell = (table[c].to_numpy() for c in ("in_slice", "in_pos", "in_cell"))
            ev_slice, ev_pos = part.astype(np.int64), np.full(len(part), NONE, dtype=np.int32)
            begin, n = bounds[:-1], np.diff(bounds)
            short = n <= SHORT
            a = begin[short]
            entered = in_pos[a] != NONE
            state = [
                (((in_cell[a] >> AXIS_BITS) & AXIS_MASK) - OFFSET)[:, None],
                ((in_cell[a] & AXIS_MASK) - OFFSET)[:, None],
                np.where(entered, ENTERED, NONE).astype(np.int32)[:, None],
            ]
            _side_by_side(cells, slow, a, n[short], state, depth, ev_pos)
            carried = np.flatnonzero(ev_pos == ENTERED)
            ev_slice[carried], ev_pos[carried] = in_slice[carried], in_pos[carried]
            for a, b in zip(begin[~short], bounds[1:][~short]):
                s = _Slice(cells[a:b], slow[a:b], depth)
                start = 0
                if in_pos[a] != NONE:
                    c = int(in_cell[a])
                    q = ((c >> AXIS_BITS) & AXIS_MASK) - OFFSET
                    end = s.leaves(q, (c & AXIS_MASK) - OFFSET, 0)
                    ev_slice[a : a + end], ev_pos[a : a + end] = in_slice[a], in_pos[a]
                    start = end + 1
                for first, end in s.events(start):
                    ev_pos[a + first : a + end] = first
            kept = np.flatnonzero(ev_pos != NONE)
            labelled = table.append_column("_ev_slice", pa.array(ev_slice)).append_column("_ev_pos", pa.array(ev_pos))
            yield from labelled.take(pa.array(kept)).to_batches()

    return run
