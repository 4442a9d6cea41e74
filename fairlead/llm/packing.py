"""Packing of tokenised documents into sequences by linear grouping and best fit.

The plan is made on the histogram of piece lengths, which has as many bins as a sequence has
ids whatever the corpus holds. Documents take their places by rank, in parallel.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fairlead.llm.text import documents, ship, sliced, stored, trimmed
from fairlead.llm.tokens import tokenizer, vocabulary_path

CAPACITY = 4096
END = 1
#: Lengths above this share of a sequence are large.
LARGE = 1 / 8
#: Numbers of groups of equal cardinality into which large lengths are rounded up; the best plan counts.
GROUPS = (16, 64)
CHUNK = 1 << 20
#: Pieces of one length that one task ranks.
RANKED = 200_000
#: Parts in which pieces of one length are ranked, at least.
PARTS = 64


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): ids of each text and `end`, cut only where longer than a sequence."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = tokenizer(path)
        for batch in sliced(batches, "text", CHUNK):
            counts, flat = words.encode_texts(batch.column("text"))
            ids = np.insert(flat, np.cumsum(counts), end).astype("<u4")
            total = counts + 1
            n = -(-total // capacity)
            row = np.repeat(np.arange(len(n)), n)
            piece = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            start = piece * capacity
            length = np.minimum(total[row] - start, capacity)
            at = 4 * ((np.cumsum(total) - total)[row] + start)
            view = memoryview(ids.tobytes())
            crc = [zlib.crc32(view[a:b]) for a, b in zip(at.tolist(), (at + 4 * length).tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(row)), pa.array(piece.astype(np.int32)),
                    pa.array(start), pa.array(length), pa.array(crc, pa.int64()),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        trimmed(run), "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


def _best_configuration(sizes: np.ndarray, worth: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most worth that fits a sequence, and how often it takes each size."""
    best, picks = np.zeros(capacity + 1), []
    while True:
        new, pick = best.copy(), np.full(capacity + 1, -1)
        for g, s in enumerate(sizes.tolist()):
            value = best[: capacity + 1 - s] + worth[g]
            better = value > new[s:] + 1e-12
            new[s:][better], pick[s:][better] = value[better], g
        if (pick < 0).all():
            break
        best = new
        picks.append(pick)
    taken, room = np.zeros(len(sizes), np.int64), capacity
    for pick in reversed(picks):
        if pick[room] >= 0:
            taken[pick[room]] += 1
            room -= int(sizes[pick[room]])
    return float(best[capacity]), taken


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Configurations of a few sizes and how often to use each, by column generation, rounded down."""
    basis = [np.where(np.arange(len(sizes)) == g, capacity // s, 0) for g, s in enumerate(sizes.tolist())]
    used = np.zeros(len(sizes))
    for _ in range(50 * len(sizes) + 50):
        matrix = np.array(basis, float).T
        used = np.linalg.solve(matrix, demand)
        worth = np.linalg.solve(matrix.T, np.ones(len(sizes)))
        value, column = _best_configuration(sizes, worth, capacity)
        if value <= 1 + 1e-7:
            break
        change = np.linalg.solve(matrix, column)
        ratio = np.where(change > 1e-9, used / np.where(change > 1e-9, change, 1), np.inf)
        basis[int(np.argmin(ratio))] = column
    return [(c, int(np.floor(x + 1e-9))) for c, x in zip(basis, used) if x >= 1]


class _Bins:
    """Groups of equal sequences: (lengths, how many), found by the room that is left."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.rooms: list[int] = []
        self.by_room: dict[int, list[tuple[tuple, int]]] = {}
        self.full: list[tuple[tuple, int]] = []

    def add(self, lengths: tuple, room: int, many: int) -> None:
        """lengths: (length, copies) pairs."""
        if not many:
            return
        if not room:
            self.full.append((lengths, many))
            return
        if room not in self.by_room:
            insort(self.rooms, room)
            self.by_room[room] = []
        self.by_room[room].append((lengths, many))

    def best_fit(self, length: int, n: int) -> None:
        """Place n pieces, each where the least room is left that holds it."""
        while n:
            at = bisect_left(self.rooms, length)
            if at == len(self.rooms):
                lengths, room, many = (), self.capacity, n
            else:
                room = self.rooms[at]
                lengths, many = self.by_room[room].pop()
                if not self.by_room[room]:
                    del self.by_room[room], self.rooms[at]
            k = room // length
            whole = min(many, n // k)
            self.add((*lengths, (length, k)), room - k * length, whole)
            n -= whole * k
            if whole < many and n:
                self.add((*lengths, (length, n)), room - n * length, 1)
                n, whole = 0, whole + 1
            if lengths:
                self.add(lengths, room, many - whole)

    def all(self) -> list[tuple[tuple, int]]:
        return self.full + [x for room in self.rooms for x in self.by_room[room]]


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple, int]]:
    """Kinds of sequences, each as its (length, copies) pairs, and how many of each kind.

    Linear grouping rounds up, which pays only where small pieces fill what is left; so the plan with
    fewest sequences counts, of those with GROUPS and best fit alone (no group).
    """
    plans = [grouped_plan(histogram, groups, capacity) for groups in (*GROUPS, 0)]
    return min(plans, key=lambda kinds: sum(many for _, many in kinds))


def grouped_plan(histogram: dict[int, int], number: int, capacity: int = CAPACITY) -> list[tuple[tuple, int]]:
    """The plan with large lengths in that many groups; none: best fit of all lengths, longest first."""
    bins = _Bins(capacity)
    rest = {k: n for k, n in histogram.items() if n}
    bins.add(((capacity, 1),), 0, rest.pop(capacity, 0))
    large = sorted((k for k in rest if number and k > LARGE * capacity), reverse=True)
    total = sum(rest[k] for k in large)
    groups: list[list[int]] = []
    seen = 0
    for k in large:  # equal numbers of pieces in each group, lengths stay together
        if len(groups) <= seen * number // total:
            groups.append([])
        groups[-1].append(k)
        seen += rest[k]
    if groups:
        sizes = np.array([g[0] for g in groups])
        demand = np.array([sum(rest[k] for k in g) for g in groups], float)
        queues = [[[k, rest[k]] for k in g] for g in groups]
        for configuration, many in configurations(sizes, demand, capacity):
            slots = [g for g, a in enumerate(configuration.tolist()) for _ in range(a)]
            while many and all(sum(n for _, n in queues[g]) >= slots.count(g) for g in set(slots)):
                # as many sequences as the longest pieces now at hand fill alike
                use, ok = {}, many
                for g in set(slots):
                    need, took = slots.count(g), []
                    if queues[g][0][1] >= need:
                        took, ok = [(queues[g][0][0], need)], min(ok, queues[g][0][1] // need)
                    else:
                        ok, left = 1, need
                        for k, n in queues[g]:
                            took.append((k, min(n, left)))
                            left -= took[-1][1]
                            if not left:
                                break
                    use[g] = took
                lengths = tuple(x for g in sorted(use) for x in use[g])
                for g, took in use.items():
                    for k, n in took:
                        entry = next(e for e in queues[g] if e[0] == k)
                        entry[1] -= n * ok
                        rest[k] -= n * ok
                    queues[g] = [e for e in queues[g] if e[1]]
                bins.add(lengths, capacity - sum(k * n for k, n in lengths), ok)
                many -= ok
    for k in sorted(rest, reverse=True):
        bins.best_fit(k, rest[k])
    return bins.all()


def slots(kinds: list[tuple[tuple, int]]) -> dict[str, np.ndarray]:
    """Where the pieces of a length go by rank: blocks (length, first rank, copies, first sequence, offset)."""
    ranks: dict[int, int] = {}
    rows, sequence = [], 0
    for lengths, many in kinds:
        offset = 0
        for length, copies in lengths:
            first = ranks.get(length, 0)
            rows.append((length, first, copies, sequence, offset))
            ranks[length] = first + copies * many
            offset += length * copies
        sequence += many
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("length", "rank", "copies", "sequence", "offset"), table.T))


def ranked(df: DataFrame) -> DataFrame:
    """With `rank`: 0, 1, ... among the rows of one length, each length being dealt to many tasks."""
    salts = max(PARTS, -(-df.count() // RANKED))
    df = df.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    counts = df.groupBy("length", "salt").agg(F.count("*").alias("n"))
    bases = counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    return df.withColumn("rank", F.row_number().over(own) - 1).join(bases, ["length", "salt"]).withColumn(
        "rank", (F.col("rank") + F.col("base")).cast("long")
    )


def packed(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): every piece and its place.

    A null or empty text is the end id alone. Repeated rows are packed each; a null doc_id is
    kept; other columns are not read; an empty table gives no piece.
    """
    ship(docs.sparkSession)
    cut = stored(pieces(docs, path or vocabulary_path(), capacity, end))
    histogram = {r.length: r.n for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    table = slots(plan(histogram, capacity))
    # (length, rank) as one sorted key
    keys = (table["length"] << 48) | table["rank"] if len(histogram) else np.zeros(0, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(keys, (length << 48) | rank, side="right") - 1
            k = rank - table["rank"][at]
            copies = table["copies"][at]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
                + [pa.array(table["sequence"][at] + k // copies), pa.array(table["offset"][at] + k % copies * length)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    rows = ranked(cut).select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    return rows.mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(documents(spark, sf_dir))
