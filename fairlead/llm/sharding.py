"""Shards by a consistent-hash ring with virtual nodes and bounded loads; DataFrame functions only."""

from __future__ import annotations

import json
import zlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fairlead.llm.text import documents

SHARDS = 24
#: Places of each shard on the ring.
VIRTUAL = 32
#: Cells of the ring: keys of one cell are alike to the ring.
CELLS = 1 << 14
#: Parts in which the rows of a cell are ranked, so that one id does not make one task.
PARTS = 64


def ring(shards: int, virtual: int = VIRTUAL, cells: int = CELLS) -> list[int]:
    """The shard that owns each cell: that of the next virtual node clockwise. A new shard changes only cells it takes."""
    points: dict[int, int] = {}
    for s in range(shards):
        for v in range(virtual):
            cell = zlib.crc32(f"shard {s} node {v}".encode()) % cells
            points[cell] = min(s, points.get(cell, s))  # the older shard keeps a contested cell
    owner, out = points[min(points)], [0] * cells
    for c in range(cells - 1, -1, -1):
        owner = points.get(c, owner)
        out[c] = owner
    return out


def placement(counts: dict[int, int], shards: int, virtual: int = VIRTUAL, cells: int = CELLS) -> list[tuple[int, int, int, int]]:
    """(cell, first, last, shard): ranks first..last-1 of a cell go to the shard.

    Every shard may take its part of all rows, the first ones one row more if these do not
    divide evenly. A cell's rows go to its owner; those that find it full go on clockwise to
    the next other shard, in rounds, so a shard takes its own rows before those of others.
    """
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    owners = ring(shards, virtual, cells)
    left = {c: [n, 0, c, frozenset()] for c, n in sorted(counts.items()) if n}
    out = []
    while left:
        for c in list(left):
            n, first, at, tried = left[c]
            shard = owners[at]
            take = min(n, room[shard])
            if take:
                out.append((c, first, first + take, shard))
                room[shard] -= take
            if take == n:
                del left[c]
                continue
            tried |= {shard}
            while owners[at] in tried:  # there is room somewhere, so this ends
                at = (at + 1) % cells
            left[c] = [n - take, first + take, at, tried]
    return out


def sharded(docs: DataFrame, shards: int = SHARDS, virtual: int = VIRTUAL) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot): row counts of the shards are at most one apart.

    size is the bytes of the text (null: none) plus 8; slots of a shard run from 0 without
    gap. A null doc_id is a key like any other; rows that repeat one id are ranked by their
    texts and may part; an empty table gives no row; other columns are not read. Only the
    row counts of the ring's cells reach the driver.
    """
    rows = docs.select(
        F.col("doc_id").cast("long"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
    ).withColumn("hash", F.xxhash64("doc_id"))
    rows = rows.withColumn("cell", F.pmod("hash", F.lit(CELLS)).cast("int"))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("hash", "text_crc32", "size"), F.lit(PARTS)).cast("int"))
    parts = rows.groupBy("cell", "part").agg(F.count("*").alias("n"))
    counts = {r.cell: r.n for r in parts.groupBy("cell").agg(F.sum("n").alias("n")).collect()}
    filled = [0] * shards
    plan = []
    for cell, first, last, shard in placement(counts, shards, virtual):
        plan.append({"at": cell, "first": first, "last": last, "shard": shard, "base": filled[shard]})
        filled[shard] += last - first
    table = docs.sparkSession.sql(
        "SELECT inline(from_json(:plan, 'array<struct<at int, first bigint, last bigint, shard int, base bigint>>'))",
        args={"plan": json.dumps(plan)},
    )
    before = Window.partitionBy("cell").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select("cell", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("below"))
    own = Window.partitionBy("cell", "part").orderBy("hash", "doc_id", "text_crc32", "size")
    ranked = rows.withColumn("rank", F.row_number().over(own) - 1).join(bases, ["cell", "part"])
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("below"))
    # the plan has a row or two for each cell, whatever the table holds
    placed = ranked.join(
        F.broadcast(table), (F.col("cell") == F.col("at")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last"))
    )
    return placed.select(
        "doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("rank") - F.col("first")).cast("long").alias("slot")
    )


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded(documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
