"""SimHash fingerprints and near-duplicate groups by pivot distance tables."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairlead.llm.components import components
from fairlead.llm.text import documents, mix, ship, sliced, stored

SEED = 42
SHINGLE = 3
DISTANCE = 3
#: Reference fingerprints of the distance table; the first two also route.
PIVOTS = 16
#: Width of a routing cell in distance; larger than DISTANCE.
CELL = 8
#: Fingerprints that share the bits under a mask by chance, at most about.
GROUP = 64
CHUNK = 4 << 20
BLOCK = 1 << 16


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles of one text; 0 if it has no word."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < size:
        shingles = [b" ".join(words)]
    else:
        whole = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = [0, *ends[: len(words) - size].tolist()]
        shingles = [whole[a:b] for a, b in zip(starts, (ends[size - 1 :] - 1).tolist())]
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_digest
    for i in range(0, len(shingles), BLOCK):
        raw = b"".join([digest(s, SEED) for s in shingles[i : i + BLOCK]])
        counts += np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(shingles)).tobytes(), "big")


def with_fingerprints(docs: DataFrame, size: int = SHINGLE, hashed: bool = False) -> DataFrame:
    """(doc_id, fp long): one row per document, computed batch by batch where the text is read; text_hash too if `hashed`."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", CHUNK):
            fps = np.array([fingerprint(t.as_py(), size) for t in batch.column("text")], np.uint64)
            columns = [batch.column(c) for c in names[:-1]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(fps.view(np.int64))], names)

    names = ["doc_id", "text_hash", "fp"] if hashed else ["doc_id", "fp"]
    rows = docs.select(F.col("doc_id").cast("long"), "text", *([F.xxhash64("text").alias("text_hash")] if hashed else []))
    return rows.mapInArrow(run, ", ".join(f"{c} long" for c in names))


def pivots(n: int = PIVOTS) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64))


def masks(n: int) -> list[int]:
    """Bit masks of which one at least is free of differences between two linked fingerprints.

    64 bits in DISTANCE + k segments: DISTANCE differing bits leave k of them equal. k grows
    with the number n of fingerprints, so that few share the bits under a mask by chance.
    """
    k = next(k for k in (1, 2, 3, 4) if k == 4 or n / 2 ** (64 * k / (DISTANCE + k)) <= GROUP)
    cuts = [round(64 * i / (DISTANCE + k)) for i in range(DISTANCE + k + 1)]
    segments = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]
    return [sum(c) for c in combinations(segments, k)]


def routed(nodes: DataFrame, n: int) -> DataFrame:
    """(key, fp): the places at which two fingerprints of at most DISTANCE differing bits meet.

    Such a pair agrees under one of the masks. Its distances to any pivot differ by DISTANCE
    at most, so both lie in one cell of that pivot or in neighbouring ones. A fingerprint
    within reach of the next cell is sent there too; hence the pair meets in the cell that
    is the larger in each coordinate.
    """
    cells = []
    for p in pivots(2).view(np.int64).tolist():
        d = F.bit_count(F.col("fp").bitwiseXOR(F.lit(p)))
        cell = F.floor(d / CELL).cast("int")
        cells.append(F.when(d % CELL >= CELL - DISTANCE, F.array(cell, cell + 1)).otherwise(F.array(cell)))
    signed = [m - (1 << 64) if m >> 63 else m for m in masks(n)]
    parts = F.array(*[F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits")) for i, m in enumerate(signed)])
    out = nodes.select("fp", F.explode(cells[0]).alias("c0"))
    out = out.select("fp", "c0", F.explode(cells[1]).alias("c1"))
    out = out.select("fp", "c0", "c1", F.explode(parts).alias("p"))
    return out.select(F.xxhash64("p.mask", "p.bits", "c0", "c1").alias("key"), "fp")


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each end and the smallest one it is linked to: the same groups with far fewer links."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    low = np.arange(len(nodes))
    while True:
        m = np.minimum(low[x], low[y])
        new = low.copy()
        np.minimum.at(new, x, m)
        np.minimum.at(new, y, m)
        np.minimum.at(new, low, new)
        new = new[new]
        if np.array_equal(new, low):
            break
        low = new
    far = np.flatnonzero(low != np.arange(len(nodes)))
    return nodes[far], nodes[low[far]]


def near_in_order(key: np.ndarray, d: np.ndarray, fp: np.ndarray, fresh: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs of rows sorted by (key, d), the second from row `fresh` on.

    The table of distances to the pivots is filled once per row. A pair is dropped as soon
    as one coordinate differs by more than DISTANCE; survivors are verified bit by bit.
    """
    table = np.stack([np.bitwise_count(fp ^ p).astype(np.int8) for p in pivots()[2:]])
    found_a, found_b = [], []
    at, step = np.arange(len(key)), 1
    while True:
        at = at[at + step < len(key)]
        at = at[(key[at] == key[at + step]) & (d[at + step] - d[at] <= DISTANCE)]
        if not len(at):
            break
        i = at[at + step >= fresh]
        for row in table:
            i = i[np.abs(row[i] - row[i + step]) <= DISTANCE]
        i = i[np.bitwise_count(fp[i] ^ fp[i + step]) <= DISTANCE]
        if len(i):
            found_a.append(fp[i].view(np.int64))
            found_b.append(fp[i + step].view(np.int64))
        step += 1
    if not found_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return _forest(np.concatenate(found_a), np.concatenate(found_b))


def near_links(nodes: DataFrame, n: int) -> DataFrame:
    """(a, b): links that connect exactly the fingerprints at DISTANCE or fewer differing bits.

    Rows are dealt by key and sorted by the distance to a third pivot; Spark's sort may
    spill. A task then holds one Arrow batch and the rows of the running key that are
    still within DISTANCE of the last one.
    """
    ship(nodes.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, d, fp = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.uint64)
        for batch in batches:
            if not batch.num_rows:
                continue
            fresh = len(key)
            key = np.concatenate([key, batch.column("key").to_numpy()])
            d = np.concatenate([d, batch.column("d").to_numpy()])
            fp = np.concatenate([fp, batch.column("fp").to_numpy().view(np.uint64)])
            a, b = near_in_order(key, d, fp, fresh)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])
            keep = (key == key[-1]) & (d >= d[-1] - DISTANCE)
            key, d, fp = key[keep], d[keep], fp[keep]

    third = int(pivots(3).view(np.int64)[2])
    rows = routed(nodes, n).withColumn("d", F.bit_count(F.col("fp").bitwiseXOR(F.lit(third))).cast("int"))
    return rows.repartition("key").sortWithinPartitions("key", "d").mapInArrow(run, "a long, b long").distinct()


def rooted(fps: DataFrame) -> DataFrame:
    """(fp, root, first): every fingerprint, the one that names its component, and its smallest doc_id."""
    nodes = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(near_links(nodes.select("fp"), nodes.count())).toDF("fp", "root")
    named = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    return stored(named.select("fp", "root", "first"))


def near_groups(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, fp, component_id) for every document.

    Copies collapse to one fingerprint before any pair is looked for, so a group of equal
    texts costs one row. component_id is the smallest doc_id reachable. A null text has no
    word, hence fingerprint 0; a null doc_id never names a component (null if there is no
    other); repeated rows stay repeated; other columns are not read.
    """
    fps = stored(with_fingerprints(docs, size))
    groups = rooted(fps)
    names = groups.groupBy("root").agg(F.min("first").alias("component_id"))
    return fps.join(groups.select("fp", "root").join(names, "root"), "fp").select("doc_id", "fp", "component_id")


def one_per_group(docs: DataFrame, groups: DataFrame, nameless: bool = False) -> DataFrame:
    """The documents with one of each group: of smallest doc_id, then of smallest text hash.

    groups is (doc_id, text_hash, root) of all documents. Rows of one doc_id with texts of several
    groups are told apart; those that repeat id and text count once. Rows without doc_id all stay; with
    `nameless` they count too: they come last in their group and are named by their text.
    """
    known = docs if nameless else docs.filter("doc_id is not null")
    known = known.withColumn("_text_hash", F.xxhash64("text"))
    first = (groups if nameless else groups.filter("doc_id is not null")).groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("kept")
    )
    names = first.select(F.col("kept.doc_id").alias("_kept_id"), F.col("kept.text_hash").alias("_kept_text"))
    same = known["doc_id"].eqNullSafe(F.col("_kept_id")) & (known["_text_hash"] == F.col("_kept_text"))
    kept = known.join(names, same, "left_semi").dropDuplicates(["doc_id", "_text_hash"]).drop("_text_hash")
    return kept if nameless else kept.unionByName(docs.filter("doc_id is null"))


def deduplicated(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """The documents with one of each near-duplicate group."""
    fps = stored(with_fingerprints(docs, size, hashed=True))
    return one_per_group(docs, fps.join(rooted(fps).select("fp", "root"), "fp").select("doc_id", "text_hash", "root"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(documents(spark, sf_dir)).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
