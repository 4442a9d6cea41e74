"""Projections, filters and overrides on ping tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_columns(df: DataFrame, keep: Sequence[str] = ("*",)) -> DataFrame:
    """Keep listed columns in table order; unknown names are ignored, case matters."""
    if list(keep) == ["*"]:
        return df
    wanted = set(keep)
    return df.select([F.col(f"`{c}`") for c in df.columns if c in wanted])


def pick_variant(df: DataFrame, *names: str) -> Column:
    """First of several alternative column names the table has, under the first name.

    A column already so named is not aliased again: a redundant alias is removed in one
    branch of a union and kept in the other, and then their exchanges are not shared.
    """
    for n in names:
        if n in df.columns:
            return F.col(n) if n == names[0] else F.col(n).alias(names[0])
    raise ValueError(f"none of the columns {names} is present")


def matched_only(df: DataFrame, column: str = "ihs_matchtype") -> DataFrame:
    return df.filter(F.col(column) != 9)


def override_types(
    df: DataFrame, fixes: Sequence[tuple[str, str | None, str | None]], name: str = "vessel_name"
) -> DataFrame:
    """Replace type columns of named ships; later entries win, None leaves a column."""
    main, sub = F.col("vessel_type_main"), F.col("vessel_type_sub")
    for ship, type_main, type_sub in fixes:
        if type_main:
            main = F.when(F.col(name) == ship, type_main).otherwise(main)
        if type_sub:
            sub = F.when(F.col(name) == ship, type_sub).otherwise(sub)
    return df.withColumns({"vessel_type_main": main, "vessel_type_sub": sub})


def in_box(
    df: DataFrame,
    x_field: str = "longitude",
    y_field: str = "latitude",
    llx: float = -12.0,
    lly: float = 51.1,
    urx: float = -5.5,
    ury: float = 55.6,
) -> DataFrame:
    """Strictly inside a box, with a point column. The test is always on
    longitude/latitude; x_field and y_field only feed the point."""
    inside = (
        (F.col("longitude") > llx) & (F.col("latitude") > lly) & (F.col("longitude") < urx) & (F.col("latitude") < ury)
    )
    point = F.struct(F.col(x_field).cast("double").alias("lon"), F.col(y_field).cast("double").alias("lat"))
    return df.filter(inside).withColumn("geom", point)


def with_unix_time(df: DataFrame, ts_field: str = "dt_pos_utc") -> DataFrame:
    return df.select(F.unix_timestamp(ts_field).alias("cluster_time"), "*")


def report_period(
    df: DataFrame,
    time: str,
    port: str | None = None,
    port_column: str = "Port",
    day: int | None = None,
    month: int | None = None,
    year: int | None = None,
) -> DataFrame:
    """Optional report filters; an empty or zero value means no filter."""
    tests = []
    if port:
        tests.append(F.col(port_column) == port)
    if day:
        tests.append(F.dayofmonth(time) == day)
    if month:
        tests.append(F.month(time) == month)
    if year:
        tests.append(F.year(time) == year)
    for t in tests:
        df = df.filter(t)
    return df


def drop_incomplete(df: DataFrame) -> DataFrame:
    return df.dropna(how="any")


def as_timestamp(df: DataFrame, column: str) -> DataFrame:
    """Cast to timestamp unless the column is one already."""
    if df.schema[column].dataType.typeName().startswith("timestamp"):
        return df
    return df.withColumn(column, F.col(column).cast("timestamp"))
