"""Joins against dimensions, registers and areas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairlead.functions import grid

# What a dimension may have, in rows and in bytes, to be sent to every executor.
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 << 20


def sized(dim: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``dim`` if its rows and bytes prove it small, else force a sort-merge join.

    For tables derived from outlines only: these have no useful size estimate, so Spark
    alone could pick a broadcast that grows with the data, and sizing them reads no ping.
    The table is kept on the executors' disks (and derived anew where one is lost), so the
    query that follows does not derive it a second time. The merge join spills, and adaptive
    execution splits its hot partitions. Tables derived from pings are left to adaptive
    execution, which decides on their real bytes.
    """
    kept = dim.persist(StorageLevel.DISK_ONLY)
    small = kept.count() <= max_rows and bytes_of(kept) <= max_bytes
    return F.broadcast(kept) if small else kept.hint("merge")


def bytes_of(df: DataFrame) -> int:
    """Spark's estimate of a frame's bytes; of a table that is kept, what it takes."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def require(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")


def cell_column(resolution: int) -> str:
    return f"H3_int_index_{resolution}"


def cells_of(df: DataFrame, cell: str = "boundary_h3") -> DataFrame:
    """Distinct cells, so that joining them never multiplies pings."""
    return df.select(cell).distinct()


def pings_in_ports(pings: DataFrame, ports: DataFrame, cell: str, port_cell: str = "boundary_h3") -> DataFrame:
    """Inner join on the cell; a cell shared by two ports yields two rows."""
    require(pings, cell)
    return pings.join(sized(ports), pings[cell] == ports[port_cell], "inner")


def tag_buffer(pings: DataFrame, buffer_cells: DataFrame, resolution: int = 8) -> DataFrame:
    """Left join: ``boundary_h3`` is set for pings inside the buffer, null outside."""
    cell = cell_column(resolution)
    require(pings, cell)
    cells = cells_of(buffer_cells)
    return pings.join(sized(cells), pings[cell] == cells["boundary_h3"], "left")


def keep_in_buffer(pings: DataFrame, buffer_cells: DataFrame, resolution: int = 8) -> DataFrame:
    """Reduce pings to the buffer; the matched cell stays as ``boundary_h3``."""
    cell = cell_column(resolution)
    require(pings, cell)
    cells = cells_of(buffer_cells)
    return pings.join(sized(cells), pings[cell] == cells["boundary_h3"], "inner")


def row_runs(runs: DataFrame) -> DataFrame:
    """(_r, _firsts, _lasts): the runs of each lattice row as sorted arrays; they must not overlap."""
    sorted_runs = F.array_sort(F.collect_list(F.struct("_first", "_last")))
    return runs.groupBy("_r").agg(sorted_runs.alias("_runs")).select(
        "_r", F.col("_runs._first").alias("_firsts"), F.col("_runs._last").alias("_lasts")
    )


def _found_in_runs(q: Column) -> Column:
    """Whether ``q`` lies in a run of its row, by binary search: steps of falling powers of two are
    taken while the run they lead to begins at or before ``q``."""
    steps = F.sequence(F.floor(F.log2(F.size("_firsts"))).cast("int"), F.lit(0), F.lit(-1))

    def stepped(at: Column, power: Column) -> Column:
        ahead = at + F.call_function("shiftleft", F.lit(1), power)
        return F.when(F.get("_firsts", ahead - 1) <= q, ahead).otherwise(at)

    return F.aggregate(steps, F.lit(0), stepped, lambda at: (at > 0) & (F.get("_lasts", at - 1) >= q))


def tag_runs(pings: DataFrame, runs: DataFrame, flag: str, resolution: int, cell: str | None = None) -> DataFrame:
    """Boolean ``flag``: the ping's cell lies in one of the runs (of the same resolution).

    The runs are never expanded into cells: a row of the lattice is one row of the joined table. Cells must
    be of this package's lattice and of this resolution; others raise. Pings without a cell are outside.
    """
    cell = cell or cell_column(resolution)
    require(pings, cell)
    c = grid.own(cell)
    wrong = F.raise_error(F.concat(F.lit("cell of another resolution: "), c.cast("string"))).cast("bigint")
    row = F.when(grid.resolution_of(c) == resolution, grid.cell_r(c)).when(c.isNotNull(), wrong)
    rows = sized(row_runs(runs)).withColumnRenamed("_r", "_run_row")
    joined = pings.withColumn("_row", row).join(rows, F.col("_row") == F.col("_run_row"), "left")
    found = F.coalesce(_found_in_runs(grid.cell_q(cell)), F.lit(False))
    return joined.withColumn(flag, found).drop("_row", "_run_row", "_firsts", "_lasts")


def keep_in_runs(pings: DataFrame, runs: DataFrame, resolution: int, cell: str | None = None) -> DataFrame:
    """Pings whose cell lies in one of the runs."""
    return tag_runs(pings, runs, "_in_runs", resolution, cell).filter("_in_runs").drop("_in_runs")


def tag_ports(pings: DataFrame, port_cells: DataFrame, resolution: int = 8) -> DataFrame:
    """Left join with the port cells, keeping pings outside every port."""
    cell = cell_column(resolution)
    require(pings, cell)
    return pings.join(sized(port_cells), pings[cell] == port_cells["h3_ids_int"], "left")


def events_in_ports(events: DataFrame, port_cells: DataFrame) -> DataFrame:
    """Stop events whose anchor cell lies in a port."""
    require(events, "h3_index_int")
    return events.join(sized(port_cells), events["h3_index_int"] == port_cells["h3_ids_int"], "inner")


def keyed_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    join_type: str = "INNER",
    return_type: str = "NullsOnly",
) -> DataFrame:
    """INNER or LEFT join on differently named keys, all columns of both sides.

    LEFT with ``NullsOnly`` keeps the left rows without a partner (an anti join) and
    still shows the right columns, all null.
    """
    if join_type not in ("INNER", "LEFT"):
        raise ValueError("join_type must be INNER or LEFT")
    if return_type not in ("NullsOnly", "All"):
        raise ValueError("return_type must be NullsOnly or All")
    a, b = left.alias("a"), right.alias("b")
    on = F.col(f"a.{left_key}") == F.col(f"b.{right_key}")
    if join_type == "INNER":
        return a.join(b, on, "inner")
    if return_type == "All":
        return a.join(b, on, "left")
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields]
    return a.join(b, on, "left_anti").select("*", *empty)


def pings_with_register(
    pings: DataFrame,
    register: DataFrame,
    ping_key: str = "mmsi",
    register_key: str = "MaritimeMobileServiceIdentityMMSINumber",
    keep: Sequence[str] = ("ShipStatus", "ShipName", "ShiptypeLevel5"),
) -> DataFrame:
    r = register.select(F.col(register_key).alias("_key"), *keep)
    return pings.join(r, pings[ping_key] == F.col("_key"), "inner").select(*keep, *[pings[c] for c in pings.columns])


def pings_without_register(
    pings: DataFrame,
    register: DataFrame,
    ping_key: str = "mmsi",
    register_key: str = "MaritimeMobileServiceIdentityMMSINumber",
) -> DataFrame:
    r = register.select(F.col(register_key).alias("_key")).distinct()
    return pings.join(r, pings[ping_key] == F.col("_key"), "left_anti")


def prefix_conflicts(register: DataFrame, pings: DataFrame, prefix: str = "ihs_") -> DataFrame:
    """Rename register columns that clash, ignoring case, with a ping column."""
    taken = {c.lower() for c in pings.columns}
    return register.select([F.col(c).alias(prefix + c if c.lower() in taken else c) for c in register.columns])


def match_register(
    pings: DataFrame,
    register: DataFrame,
    register_key: str,
    register_imo: str | None = None,
    register_name: str | None = None,
    return_all: bool = True,
    identities: DataFrame | None = None,
) -> DataFrame:
    """Attach register columns and ``ihs_matchtype``.

    Classes: 1 ship number and IMO agree, 2 ship number alone, 3 IMO alone, 4 name
    alone, 9 none. Matching runs on the distinct identities broadcast by ships, not
    on pings, and each identity takes its best class, so pings never multiply. Of the
    register rows with one number (and IMO), one IMO or one name only the first counts: that
    of the lowest ship number, rows without number last, then by all columns. So every
    join is to at most one row. Null and zero numbers, and null or empty names, match
    nothing. ``identities`` is a table cheaper to read than ``pings`` that holds the same
    identities.
    """
    from fairlead.operators.sequence import top_per_key

    who = [c for c in ("mmsi", "imo", "vessel_name") if c in pings.columns]
    ships = (pings if identities is None else identities).select(*who).distinct()
    fields = list(register.columns)
    # rows that repeat each other share an id and are told apart by nothing
    numbered = register.withColumn("_row", F.xxhash64(*fields))
    by_number = [F.col(register_key).asc_nulls_last(), "_row"]

    def usable(name: str) -> Column:
        text = dict(register.dtypes)[name] == "string"
        return F.col(name).isNotNull() & (F.trim(name) != "" if text else F.col(name) != 0)

    def first_of(*keys: str) -> DataFrame:
        rows = numbered.select(*dict.fromkeys([register_key, *keys]), "_row").filter(usable(keys[0]))
        picked = top_per_key(rows, list(keys), by_number)
        return picked.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_row")

    # The best row of each kind, found by joins that never multiply; the first that is there counts.
    kinds: list[tuple[int, list[str], list[str]]] = []
    if register_imo and "imo" in who:
        kinds.append((1, ["mmsi", "imo"], [register_key, register_imo]))
    kinds.append((2, ["mmsi"], [register_key]))
    if register_imo and "imo" in who:
        kinds.append((3, ["imo"], [register_imo]))
    if register_name and "vessel_name" in who:
        kinds.append((4, ["vessel_name"], [register_name]))
    found = ships
    for rank, mine, theirs in kinds:
        rows = first_of(*theirs).withColumnRenamed("_row", f"_row{rank}")
        on = [found[m] == rows[f"_k{i}"] for i, m in enumerate(mine)]
        found = found.join(rows, on, "left").drop(*[f"_k{i}" for i in range(len(mine))])
    ranks = [rank for rank, _, _ in kinds]
    best = found.select(
        *[F.col(c).alias(f"_w_{c}") for c in who],
        F.coalesce(*[F.col(f"_row{r}") for r in ranks]).alias("_row"),
        F.coalesce(*[F.when(F.col(f"_row{r}").isNotNull(), r) for r in ranks]).alias("_class"),
    ).filter("_class is not null")
    best = best.join(top_per_key(numbered, ["_row"], ["_row"]), "_row").drop("_row")
    on = [pings[c].eqNullSafe(F.col(f"_w_{c}")) for c in who]
    joined = pings.join(best, on, "left").drop(*[f"_w_{c}" for c in who])
    joined = joined.withColumn("ihs_matchtype", F.coalesce(F.col("_class"), F.lit(9))).drop("_class")
    return joined if return_all else joined.filter("ihs_matchtype <> 9")


def ship_type_port_combinations(
    df: DataFrame,
    mmsi: str = "mmsi",
    ship_name: str = "ShipName",
    ship_type: str = "ShiptypeLevel5",
    port_id: str = "port_name",
) -> DataFrame:
    return df.select(mmsi, ship_name, ship_type, port_id).distinct()
