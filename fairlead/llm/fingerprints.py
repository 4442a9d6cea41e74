"""Document fingerprints from prefix polynomial hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairlead.llm.text import documents, mix, ship, sliced

#: Two moduli, so that a span hash has 62 bits, and the bases of the polynomials.
PRIMES = (2147483647, 2147483629)
BASES = (911382323, 972663749)
#: Characters of the spans that a fingerprint samples, and how many it keeps.
SPAN = 16
KEPT = 64
CHUNK = 2 << 20
#: Equal-width cells over the ids; the ranges that are dealt to tasks are made of whole cells.
CELLS = 1 << 14
#: Documents of one range.
RANGE = 2_000

_TABLES: dict[str, list[np.ndarray]] = {}


def _powers(n: int, inverse: bool = False) -> list[np.ndarray]:
    """base**i and base**-i modulo each prime, for i <= n at least."""
    if len(_TABLES.get("up", [[]])[0]) <= n:
        size = max(1 << 14, 1 << int(n).bit_length())
        for kind, sign in (("up", 1), ("down", -1)):
            tables = []
            for p, b in zip(PRIMES, BASES):
                have = np.ones(1, np.uint64)
                while len(have) <= size:
                    have = np.concatenate([have, have * np.uint64(pow(b, sign * len(have), p)) % np.uint64(p)])
                tables.append(have)
            _TABLES[kind] = tables
    return _TABLES["down" if inverse else "up"]


class Prefixes:
    """Prefix hashes of one text: any span's hash, equality and longest common extensions."""

    def __init__(self, codes: np.ndarray):
        self.n = len(codes)
        values = codes.astype(np.uint64) + np.uint64(1)
        self.sums = []
        for p, power in zip(PRIMES, _powers(self.n)):
            out = np.zeros(self.n + 1, np.uint64)
            np.cumsum(values * power[: self.n] % np.uint64(p), out=out[1:])
            out %= np.uint64(p)
            self.sums.append(out)

    def spans(self, first, last) -> np.ndarray:
        """62-bit hashes of the spans first..last-1, the same wherever the span stands."""
        out = np.uint64(0)
        for p, sums, down in zip(PRIMES, self.sums, _powers(self.n, True)):
            part = (sums[last] + np.uint64(p) - sums[first]) * down[first] % np.uint64(p)
            out = (out << np.uint64(31)) | part
        return out

    def span(self, first: int, last: int) -> int:
        out = 0
        for p, sums, down in zip(PRIMES, self.sums, _TABLES["down"]):
            out = out << 31 | (sums.item(last) - sums.item(first)) * down.item(first) % p
        return out

    def equal(self, other: Prefixes, first: int, at: int, length: int) -> bool:
        return self.span(first, first + length) == other.span(at, at + length)

    def extension(self, other: Prefixes, first: int = 0, at: int = 0) -> int:
        """Length of the longest common piece that begins at `first` here and at `at` there, by binary search."""
        low, high = 0, min(self.n - first, other.n - at)
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if self.equal(other, first, at, middle) else (low, middle - 1)
        return low

    def extension_back(self, other: Prefixes) -> int:
        """Length of the longest common ending."""
        low, high = 0, min(self.n, other.n)
        while low < high:
            middle = (low + high + 1) // 2
            ok = self.equal(other, self.n - middle, other.n - middle, middle)
            low, high = (middle, high) if ok else (low, middle - 1)
        return low


class Fingerprint:
    """Length and hash of the whole text, and the least hashes of its spans."""

    def __init__(self, text: str):
        self.prefixes = Prefixes(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4"))
        n = self.prefixes.n
        self.whole = self.prefixes.span(0, n)
        at = np.arange(max(n - SPAN, 0) + 1)
        stirred = mix(self.prefixes.spans(at, np.minimum(at + SPAN, n))) >> np.uint64(32)
        if len(stirred) > 8 * KEPT:
            least = np.unique(np.partition(stirred, 4 * KEPT)[: 4 * KEPT])
            stirred = least if len(least) >= KEPT else stirred
        self.sample = np.unique(stirred)[:KEPT]

    def __str__(self) -> str:
        return f"{self.prefixes.n:x}-{self.whole:016x}-" + self.sample.astype(">u4").tobytes().hex()


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    """1 for equal texts; else the share of spans in common that the samples show (Dice), or what the common
    beginning and ending prove if that is more. Below 1 for texts that differ."""
    n, m = a.prefixes.n, b.prefixes.n
    if n == m and a.whole == b.whole:
        return 1.0
    # both samples are sorted and distinct: what they share stands twice in their union
    merged = np.sort(np.concatenate([a.sample, b.sample]))
    twice = merged[1:] == merged[:-1]
    rank = np.arange(1, len(merged)) + 1 - np.cumsum(twice)
    jaccard = int((twice & (rank <= KEPT)).sum()) / min(KEPT, len(merged) - int(twice.sum()))
    ends = min(a.prefixes.extension(b.prefixes) + a.prefixes.extension_back(b.prefixes), n, m)
    return min(max(2 * jaccard / (1 + jaccard), ends / max(n, m)), 1 - 1 / (max(n, m) + 2))


def edited(text: str, following: str) -> str:
    """The last half of the characters replaced by the first as many of the document that follows."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _ranges(docs: DataFrame, rows_per_range: int) -> tuple[DataFrame, DataFrame]:
    """The documents with a range number that grows with doc_id, and per range its first document in descending order."""
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_hash"))
    bounds = rows.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).first()
    low, high = (bounds.low or 0), (bounds.high or 0)
    # doubles keep the order of longs; a null doc_id comes after all others, hence in the lowest range
    place = F.floor((F.col("doc_id").cast("double") - float(low)) / max(float(high) - float(low), 1.0) * CELLS)
    cell = F.when(F.col("doc_id").isNull(), 1).otherwise(F.least(place, F.lit(CELLS - 1)) + 2).cast("int")
    counts = {r.cell: r.n for r in rows.select(cell.alias("cell")).groupBy("cell").agg(F.count("*").alias("n")).collect()}
    number, filled, table = 0, 0, [0] * (CELLS + 1)
    for c in range(1, CELLS + 2):
        if filled >= rows_per_range:
            number, filled = number + 1, 0
        table[c - 1] = number
        filled += counts.get(c, 0)
    # one literal for the whole table, folded to an array once
    numbers = F.split(F.lit(",".join(map(str, table))), ",")
    rows = rows.withColumn("range", F.element_at(numbers, cell).cast("int"))
    key = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "text_hash")
    heads = rows.groupBy("range").agg(F.max(key).alias("head"))
    return rows, heads


def with_following(docs: DataFrame, rows_per_range: int = RANGE) -> DataFrame:
    """(range, guest, doc_id, text_hash, text), ready to be read range by range in descending doc_id.

    Each range also gets the first document of the next one as its guest, and the last
    range that of the first. Only the list of ranges is ever gathered.
    """
    rows, heads = _ranges(docs, rows_per_range)
    found = sorted((r for r in heads.collect()), key=lambda r: r.range)
    if not found:
        return rows.select("range", F.lit(True).alias("guest"), "doc_id", "text_hash", "text")
    # the head of a range is the guest of the range above; the topmost head that of the lowest
    numbers = [r.range for r in found]
    above = numbers[1:] + numbers[:1]
    table = docs.sparkSession.sql(
        "SELECT inline(from_json(:j, 'array<struct<r int, above int, known boolean, i bigint, h bigint>>'))",
        args={"j": "[" + ",".join(
            f'{{"r":{r.range},"above":{a},"known":{str(r.head.known).lower()},"i":{0 if r.head.doc_id is None else r.head.doc_id},"h":{r.head.text_hash}}}'
            for r, a in zip(found, above)
        ) + "]"},
    )
    on = (
        (rows["range"] == table["r"])
        & (rows["doc_id"].isNotNull() == table["known"])
        & (F.coalesce(rows["doc_id"], F.lit(0)) == table["i"])
        & (rows["text_hash"] == table["h"])
    )
    # one row per range: as many as tasks
    marked = rows.join(F.broadcast(table), on, "left")
    to = F.when(F.col("above").isNull(), F.array(F.struct(F.col("range").alias("range"), F.lit(False).alias("guest")))).otherwise(
        F.array(
            F.struct(F.col("range").alias("range"), F.lit(False).alias("guest")),
            F.struct(F.col("above").alias("range"), F.lit(True).alias("guest")),
        )
    )
    return marked.select(F.explode(to).alias("to"), "doc_id", "text_hash", "text").select("to.*", "doc_id", "text_hash", "text")


def fingerprinted(docs: DataFrame, rows_per_range: int = RANGE) -> DataFrame:
    """(doc_id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next) for every document.

    The next document is the one of the next smaller doc_id, after the last one the first;
    rows of one doc_id are ordered by their text's hash, rows without doc_id come last. A
    null text counts as empty, a single document follows itself, an empty table gives no
    row, other columns are not read. Documents are dealt by ranges of doc_id, each sorted
    by Spark, and a task holds two documents at a time.
    """
    ship(docs.sparkSession)
    ordered = with_following(docs, rows_per_range)
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = ordered.repartition(tasks, "range").sortWithinPartitions(
        "range", "guest", F.col("doc_id").desc_nulls_last(), F.col("text_hash").desc()
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited", pa.string()), ("fingerprint", pa.string()),
            ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
        ])
        held = None  # (range, doc_id, text, fingerprint) that waits for its next document
        for batch in sliced(batches, "text", CHUNK):
            out = []
            for group, guest, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("range", "guest", "doc_id", "text"))):
                if guest and (held is None or held[0] != group):
                    continue  # a guest that stands for one more row of the same document
                text = text or ""
                mark = held[3] if held is not None and held[2] == text else Fingerprint(text)
                if held is not None and held[0] == group:
                    new = edited(held[2], text)
                    new_mark = Fingerprint(new) if new != held[2] else held[3]
                    out.append((held[1], len(held[2]), new, str(held[3]), str(new_mark), likeness(held[3], new_mark), likeness(held[3], mark)))
                held = None if guest else (group, doc_id, text, mark)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [()] * 7, schema)], schema=schema)

    return ordered.select("range", "guest", "doc_id", "text").mapInArrow(
        run,
        "doc_id long, n_chars long, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    )


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprinted(documents(spark, sf_dir)).select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next"
    )
