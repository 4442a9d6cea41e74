"""Ping, port, zone, register and area tables derived from the driver's tables.

Each text runs unchanged in Spark and in the oracle engine; only reading a JSON
field is spelled differently.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairlead.operators import areas

# Test pings are sparse (a few per ship and day), so a slice is long here.
SLICE = 5 * 86400

_K_SPARK = "k_parsed"
_K_ORACLE = "CAST(json_extract_string(props, '$.k') AS BIGINT)"

_PINGS = """
SELECT event_id, user_id AS mmsi,
  CASE WHEN event_id % 3 = 0 THEN NULL ELSE 9000000 + user_id END AS imo,
  concat('V', CAST(user_id AS VARCHAR(20))) AS vessel_name,
  CASE user_id % 3 WHEN 0 THEN 'Tanker' WHEN 1 THEN 'Bulk' ELSE 'Passenger' END AS vessel_type,
  CASE user_id % 4 WHEN 0 THEN 'Oil' WHEN 1 THEN 'Dry' WHEN 2 THEN 'Gas' ELSE 'Ferry' END AS vessel_type_main,
  CASE user_id % 5 WHEN 0 THEN 'Crude' WHEN 1 THEN 'Coal' ELSE 'Other' END AS vessel_type_sub,
  CASE user_id % 4 WHEN 0 THEN 'Indonesia' WHEN 1 THEN 'Panama' WHEN 2 THEN 'Liberia' ELSE 'Japan' END AS flag_country,
  CASE user_id % 5 WHEN 0 THEN 'Indonesia' WHEN 1 THEN 'Greece' ELSE 'Japan' END AS RegisteredOwnerCountryofDomicile,
  CASE user_id % 6 WHEN 0 THEN 'Indonesia' WHEN 1 THEN NULL ELSE 'Norway' END AS GroupBeneficialOwnerCountryOfRegistration,
  CASE user_id % 7 WHEN 0 THEN 'Indonesia' WHEN 1 THEN 'Indonesia' WHEN 2 THEN NULL ELSE 'Greece' END AS GroupBeneficialOwnerCountryofDomicile,
  CAST(50 + user_id % 300 AS DOUBLE) AS length, CAST(51 + user_id % 300 AS DOUBLE) AS LengthOverallLOA,
  CAST(10 + user_id % 40 AS DOUBLE) AS width, CAST(11 + user_id % 40 AS DOUBLE) AS BreadthExtreme,
  CAST(5 + user_id % 20 AS DOUBLE) AS Depth, value AS draught,
  CAST(100 * (user_id % 900) AS DOUBLE) AS GrossTonnage, CAST(60 * (user_id % 900) AS DOUBLE) AS NetTonnage,
  CAST(150 * (user_id % 900) AS DOUBLE) AS Deadweight, CAST(30 * (user_id % 900) AS DOUBLE) AS LightDisplacementTonnage,
  event_type AS nav_status,
  CAST(CASE WHEN site <= 5 THEN (event_id % 4) / 2e0 ELSE 5 + (event_id % 20) / 2e0 END AS DOUBLE) AS sog,
  CAST(event_id % 360 AS DOUBLE) AS cog,
  CASE WHEN event_id % 2 = 0 THEN 'terrestrial' ELSE 'satellite' END AS source,
  concat('P', CAST(k % 6 AS VARCHAR(20))) AS destination,
  ts AS dt_pos_utc, site,
  CAST(-5 + 2e0 * site + k / 5e3 AS DOUBLE) AS latitude,
  CAST(100 + 3e0 * site + (event_id % 100) / 5e3 AS DOUBLE) AS longitude,
  site * 1000 + k % 10 AS H3_int_index_8
FROM (SELECT *, (user_id * 5 + CAST(floor((CAST(extract(day FROM ts) AS BIGINT) + user_id % 3) / 2e0) AS BIGINT) * 3) % 10 AS site,
      {K} AS k FROM {EVENTS}) e
"""

# Ten cells at each of ten sites.
_CELLS = (
    "(SELECT CAST(floor(v / 10e0) AS BIGINT) AS site, v % 10 AS j FROM (VALUES "
    + ", ".join(f"({v})" for v in range(100))
    + ") t(v)) c"
)

# One row per (port, cell): six ports of ten cells.
_PORT_CELLS = f"""
SELECT concat('P', CAST(site AS VARCHAR(20))) AS Port,
  CASE WHEN site < 3 THEN 'Indonesia' WHEN site = 3 THEN 'Qatar' ELSE 'Japan' END AS Country,
  CAST(site * 1000 + j AS BIGINT) AS boundary_h3,
  CAST(-5 + 2e0 * site + j / 1e2 AS DOUBLE) AS lat, CAST(100 + 3e0 * site + j / 1e2 AS DOUBLE) AS lon,
  concat('P', CAST(site AS VARCHAR(20)), ' - ', CASE WHEN site < 3 THEN 'Indonesia' WHEN site = 3 THEN 'Qatar' ELSE 'Japan' END) AS Port_Country
FROM {_CELLS} WHERE site <= 5
"""

_AOI_CELLS = f"""
SELECT CASE site WHEN 0 THEN 'BLW' WHEN 1 THEN 'DUM' WHEN 2 THEN 'MAK' WHEN 3 THEN 'BIT' WHEN 4 THEN 'NAM' ELSE 'XXX' END AS Kode,
  concat('prov', CAST(site AS VARCHAR(20))) AS Prov_ID, concat('h', CAST(site % 3 AS VARCHAR(20))) AS Hirarki_1,
  CAST(site * 1000 + j AS BIGINT) AS h3_ids_int
FROM {_CELLS} WHERE site <= 5
"""

_ZONE_CELLS = f"""
SELECT CASE WHEN site = 6 THEN 'strait' ELSE 'home' END AS zone, CAST(site * 1000 + j AS BIGINT) AS cell
FROM {_CELLS} WHERE site IN (6, 7, 0, 1, 2)
"""

# Ship numbers with gaps (every fifth is missing), so some pings have no register row.
_REGISTER = """
SELECT c_custkey + CAST(floor(c_custkey / 4e0) AS BIGINT) AS MaritimeMobileServiceIdentityMMSINumber,
  9000000 + c_custkey + CAST(floor(c_custkey / 6e0) AS BIGINT) AS LRIMOShipNo,
  c_name AS ShipName, CASE WHEN c_acctbal < 0 THEN 'Laid Up' ELSE 'In Service' END AS ShipStatus,
  c_mktsegment AS ShiptypeLevel5, n_name AS flag_country
FROM {CUSTOMER} c JOIN {NATION} n ON c.c_nationkey = n.n_nationkey
"""

# One area per supplier, inside the box of its site: plain square, square with a
# hole, two-part area, triangle. Corners lie off the ping lattice.
_AOI = """
SELECT s_suppkey, concat('S', CAST(s_suppkey AS VARCHAR(20))) AS Kode, n_name AS Prov_ID,
  concat('h', CAST(s_suppkey % 3 AS VARCHAR(20))) AS Hirarki_1,
  CASE WHEN s_suppkey % 10 < 3 THEN 'Indonesia' WHEN s_suppkey % 10 = 3 THEN 'Qatar' ELSE 'Japan' END AS Country, r_name AS TERRITORY1,
  CASE s_suppkey % 4 WHEN 0 THEN 'Manual' WHEN 1 THEN 'Cluster' WHEN 2 THEN 'Distance' ELSE 'Heatmap' END AS method,
  CASE CAST(floor(s_suppkey / 10e0) AS BIGINT) % 4
    WHEN 0 THEN concat('POLYGON ((', {P00}, ', ', {P80}, ', ', {P88}, ', ', {P08}, ', ', {P00}, '))')
    WHEN 1 THEN concat('POLYGON ((', {P00}, ', ', {P80}, ', ', {P88}, ', ', {P08}, ', ', {P00}, '), (',
                       {P22}, ', ', {P26}, ', ', {P66}, ', ', {P62}, ', ', {P22}, '))')
    WHEN 2 THEN concat('MULTIPOLYGON (((', {P00}, ', ', {P30}, ', ', {P38}, ', ', {P08}, ', ', {P00}, ')), ((',
                       {P50}, ', ', {P80}, ', ', {P88}, ', ', {P58}, ', ', {P50}, ')))')
    ELSE concat('POLYGON ((', {P00}, ', ', {P80}, ', ', {P48}, ', ', {P00}, '))') END AS wkt
FROM (SELECT *, 100 + 3 * (s_suppkey % 10) + CAST(CAST(floor(s_suppkey / 10e0) AS BIGINT) % 8 AS DECIMAL(9,4)) * 0.0015 + 0.0001 AS x0,
             -5 + 2 * (s_suppkey % 10) + CAST(CAST(floor(s_suppkey / 80e0) AS BIGINT) % 8 AS DECIMAL(9,4)) * 0.0015 + 0.0001 AS y0
      FROM {SUPPLIER}) s
JOIN {NATION} n ON s_nationkey = n_nationkey JOIN {REGION} r ON n_regionkey = r_regionkey
"""
for _i in "02345689":
    for _j in "02345689":
        _AOI = _AOI.replace(
            f"{{P{_i}{_j}}}",
            f"CAST(CAST(x0 + {int(_i)} * 0.0011 AS DECIMAL(9,4)) AS VARCHAR(20)), ' ', "
            f"CAST(CAST(y0 + {int(_j)} * 0.0011 AS DECIMAL(9,4)) AS VARCHAR(20))",
        )

TABLES = ("events", "customer", "nation", "region", "supplier")


def _text(sql: str, k: str, quote) -> str:
    out = sql.replace("{K}", k)
    for t in TABLES:
        out = out.replace("{" + t.upper() + "}", quote(t))
    return out


TEXTS = {
    "pings": _PINGS, "port_cells": _PORT_CELLS, "aoi_cells": _AOI_CELLS, "zone_cells": _ZONE_CELLS,
    "register": _REGISTER, "aoi": _AOI,
}


def oracle(name: str) -> str:
    return _text(TEXTS[name], _K_ORACLE, lambda t: t)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    text = _text(TEXTS[name], _K_SPARK, lambda t: "{" + t + "}")
    used = {t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in text}
    if "events" in used and "k_parsed" in text:
        # Parse the JSON field once per row: left in the projection it would be inlined
        # into every expression built on it.
        used["events"] = areas.settle(
            used["events"], k_parsed=F.get_json_object("props", "$.k").cast("bigint")
        )
    return spark.sql(text, **used)


def work_folder(spark: SparkSession) -> str:
    """Fresh folder below the cluster's shared checkpoint folder, which all executors see. In local mode, where
    there is but one machine, a folder of the warehouse stands in."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/fairlead-work"
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"
