"""Neighbouring rows of a ship's time series, without one task per ship.

``lag``/``lead`` over ``partitionBy(ship)`` puts a whole ship in one task, and one
shared or broken ship id can hold a third of all pings. Here a ship is cut into
time slices: the shuffle key is (ship, slice), so the largest task is one slice.
Rows away from a slice's ends find their neighbours inside it and, if they are not
wanted, are dropped there. The few rows at the ends (at most ``2 * depth`` per slice) then
meet in a second window over the ship alone, whose size is bounded by the number of
slices in the period. All is one branch over the input, so chained calls do not
multiply the plan.

A slice of fixed length still meets in one task however full it is; :class:`Slicing` cuts overfull ones.

Rows are always in a total order: after the given columns come all others, by name, so
rows of one time stand in the same order whatever the partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SHIP = "mmsi"
TIME = "dt_pos_utc"
# One slice of a ship should hold some thousands of its pings.
DEFAULT_SLICE_SECONDS = 6 * 3600

Pick = tuple[Column | str, int]


@dataclass(frozen=True)
class Slicing:
    """Time slices of ``seconds``; those of more than ``target`` rows are cut into parts of at most that many, about.

    Cuts cost one more narrow pass over the rows, and their table, a tree of short lists, is kept on the executors'
    disks. At most ``most`` slices can be over the limit, which
    is why the limit is ``target`` or one ``most``-th of all rows, whichever is larger: the table of cuts
    has at most ``2 * most`` rows and may be broadcast.
    """

    seconds: int = DEFAULT_SLICE_SECONDS
    target: int = 100_000
    most: int = 65_536


#: How the jobs cut ships unless told otherwise.
EVEN = Slicing()
#: Parts of a slice, and sampled rows of a part (the limit holds twice as many, so that none passes it by chance).
PART_BITS = 20
SAMPLES = 48
#: Levels of the tree of cuts: with 131,072 cuts, the most there can be, a node has 20 of them.
LEVELS = 4


def time_slice(time: Column | str = TIME, seconds: int = DEFAULT_SLICE_SECONDS) -> Column:
    if seconds <= 0:
        raise ValueError("slice length must be positive")
    c = F.col(time) if isinstance(time, str) else time
    return F.floor(F.unix_timestamp(c) / F.lit(int(seconds)))


def plain(slicing: int | Slicing) -> int:
    """The slice length alone, for passes over the few rows that an earlier pass has left."""
    return slicing.seconds if isinstance(slicing, Slicing) else slicing


def with_slices(
    df: DataFrame, order: Sequence[str], slicing: int | Slicing = DEFAULT_SLICE_SECONDS, key: str = SHIP
) -> DataFrame:
    """Add ``_slice``: a number that rises along each ship's rows in their total order.

    With seconds it is the time slice. With a :class:`Slicing` overfull slices are cut further, at rows of
    a hashed sample of their own (a sample is mergeable and holds rows, so cuts fall between rows of one time
    as well). Only rows that are equal in every column cannot be parted.
    """
    if not isinstance(slicing, Slicing):
        return df.withColumn("_slice", time_slice(order[0], slicing))
    ordered = total_order(df, order)
    based = df.withColumn("_base", time_slice(order[0], slicing.seconds))
    counts = based.groupBy(key, "_base").agg(F.count(F.lit(1)).alias("_n"))
    whole = counts.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n"))
    limit = F.greatest(F.lit(slicing.target), F.floor(whole.scalar() / F.lit(slicing.most)) + F.lit(1))
    heavy = counts.filter(F.col(key).isNotNull() & F.col("_base").isNotNull()).withColumn("_limit", limit).filter("_n > _limit")
    # Of each overfull slice about SAMPLES * 2 rows per limit; every SAMPLES-th is a cut.
    cells = 1 << 30
    rate = F.ceil(F.lit(2.0 * SAMPLES * cells) / F.col("_limit"))
    drawn = based.join(F.broadcast(heavy.drop("_n")), [key, "_base"]).filter(F.pmod(F.xxhash64(*ordered), F.lit(cells)) < rate)
    at = Window.partitionBy(key, "_base").orderBy(*ordered)
    drawn = drawn.withColumn("_i", F.row_number().over(at)).filter(F.col("_i") % SAMPLES == 0)
    cuts = drawn.select(key, "_base", F.struct(*ordered).alias("_cut"), (F.floor(F.col("_i") / SAMPLES) - 1).alias("_at"))
    # A tree of cuts: a row goes down it by one join a level, and meets one node's short list at each.
    whole_slice = Window.partitionBy(key, "_base")
    width = F.ceil(F.pow(F.max("_at").over(whole_slice) + 1, F.lit(1.0 / LEVELS)))
    firsts = cuts.withColumn("_width", width).withColumn("_level", F.explode(F.sequence(F.lit(0), F.lit(LEVELS - 1))))
    firsts = firsts.withColumn("_apart", F.pow("_width", F.lit(LEVELS - 1) - F.col("_level")).cast("bigint")).filter("_at % _apart = 0")
    nodes = firsts.groupBy(key, "_base", "_level", F.floor(F.col("_at") / (F.col("_apart") * F.col("_width"))).alias("_node")).agg(
        F.array_sort(F.collect_list("_cut")).alias("_cuts"), F.first("_width").alias("_width")
    )
    # kept on disk, some thousand rows: each level would sample the rows again
    nodes = nodes.persist(StorageLevel.DISK_ONLY)
    own, time = F.struct(*ordered), F.col(order[0])
    joined = based.withColumn("_node", F.lit(0).cast("bigint"))
    for level in range(LEVELS):
        at_level = F.broadcast(nodes.filter(F.col("_level") == level).drop("_level"))
        # the time alone mostly decides; the whole row is compared among cuts of its own time only
        below = F.filter("_cuts", lambda c: (c[order[0]] < time) | ((c[order[0]] == time) & (c <= own)))
        child = F.col("_node") * F.col("_width") + F.size(below) - 1
        joined = joined.join(at_level, [key, "_base", "_node"], "left").select(*based.columns, child.alias("_node"))
    # the last cut at or below the row; null where its slice has no cuts, or all are above it
    part = F.coalesce(F.col("_node") + 1, F.lit(0)).cast("bigint")
    sliced = joined.withColumn("_slice", F.col("_base") * F.lit(1 << PART_BITS) + part)
    return sliced.select(*df.columns, "_slice")


def total_order(df: DataFrame, order: Sequence[str]) -> list[str]:
    """The order, then every other column that can be compared, by name: rows that still tie are equal."""
    rest = sorted(f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType)))
    return [*order, *[c for c in rest if c not in order and not c.startswith("_")]]


def neighbours(
    df: DataFrame,
    order: Sequence[str],
    back: dict[str, Pick] | None = None,
    ahead: dict[str, Pick] | None = None,
    key: str = SHIP,
    slice_seconds: int | Slicing = DEFAULT_SLICE_SECONDS,
    keep: Column | None = None,
    keep_slice: bool = False,
) -> DataFrame:
    """Add columns taken ``n`` rows back or ahead in the ship's order.

    ``order[0]`` is the time column; the rest are tiebreaks, to which all other columns
    are added. ``back`` and ``ahead`` map a new column name to (source column, n). Only rows
    that satisfy ``keep`` are returned; most others never leave their slice. A ``_slice``
    column already present is used as it is, together with any partitioning by it;
    ``keep_slice`` leaves it for the next pass.
    """
    back, ahead = back or {}, ahead or {}
    depth = max(n for _, n in [*back.values(), *ahead.values()])
    ordered = total_order(df, order)
    in_slice = Window.partitionBy(key, "_slice").orderBy(*ordered)
    # Slice ends of a ship meet each other; all other rows stay among themselves.
    in_ship = Window.partitionBy(key, "_home").orderBy(*ordered)

    def found(window: Window, prefix: str = "") -> dict[str, Column]:
        cols = {prefix + name: F.lag(src, n).over(window) for name, (src, n) in back.items()}
        cols.update({prefix + name: F.lead(src, n).over(window) for name, (src, n) in ahead.items()})
        return cols

    sliced = df
    if "_slice" not in df.columns:
        # Explicit, because rows already hashed by ship (after a join, say) would satisfy
        # the window as they are and keep a hot ship in one task.
        sliced = with_slices(df, order, slice_seconds, key).repartition(key, "_slice")
    tagged = sliced.withColumns(
        {
            **found(in_slice),
            "_head": F.lag(F.lit(True), depth).over(in_slice).isNull(),
            "_tail": F.lead(F.lit(True), depth).over(in_slice).isNull(),
        }
    )
    at_end = F.col("_head") | F.col("_tail")
    if keep is not None:
        tagged = tagged.filter(at_end | keep)
    wide = tagged.withColumn("_home", F.when(~at_end, F.col("_slice"))).withColumns(found(in_ship, "_wide_"))
    names = [*back, *ahead]
    out = wide.withColumns(
        {
            name: F.when(F.col("_head" if name in back else "_tail"), F.col(f"_wide_{name}")).otherwise(F.col(name))
            for name in names
        }
    ).drop("_head", "_tail", "_home", *[f"_wide_{name}" for name in names], *([] if keep_slice else ["_slice"]))
    return out if keep is None else out.filter(keep)


def first_of_runs(
    df: DataFrame, value: str, order: Sequence[str], key: str = SHIP, slice_seconds: int | Slicing = DEFAULT_SLICE_SECONDS
) -> DataFrame:
    """Keep the first row of each run of equal ``value`` (null never equals null)."""
    new = ~F.coalesce(F.col(value) == F.col("_before"), F.lit(False))
    return neighbours(df, order, back={"_before": (value, 1)}, key=key, slice_seconds=slice_seconds, keep=new).drop("_before")


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """First row per key. Spark cuts each input partition to one row per key before
    the shuffle (window group limit), so a hot key does not travel."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def first_by_rank(df: DataFrame, key: str, time: str) -> DataFrame:
    """All rows tied for the earliest time of their key."""
    w = Window.partitionBy(key).orderBy(time)
    return df.withColumn("_rank", F.rank().over(w)).filter("_rank = 1").drop("_rank")


def latest_per_ship(df: DataFrame, columns: Sequence[str], order: Sequence[str], key: str = SHIP) -> DataFrame:
    """Latest row per ship, newest by ``order``, then by the attributes themselves."""
    picked = df.select(key, *dict.fromkeys([*columns, *order]))
    return top_per_key(picked, [key], [F.col(c).desc() for c in total_order(picked, order)]).select(key, *columns)


def earliest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return top_per_key(df, keys, [F.col(c).asc_nulls_last() for c in total_order(df, order)])
