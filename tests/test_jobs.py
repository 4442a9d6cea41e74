"""Jobs with several outputs read their pings once."""

import datetime as dt
import random

from pyspark.sql import functions as F

from fairlead.functions import grid
from fairlead.plans import jobs
from fairlead.schemas import SHIP_ATTRIBUTES
from fairlead.sources import writers

START = dt.datetime(2024, 1, 1)


def recorded(monkeypatch):
    """Of each table written: whether it reads the pings, and how many scans it has."""
    plans, write = [], writers.write_parquet

    def watched(df, path, *rest):
        reads = sum("these_pings" in f for f in df.inputFiles()) > 0
        plans.append((reads, df._jdf.queryExecution().executedPlan().toString().count("FileScan")))
        return write(df, path, *rest)

    monkeypatch.setattr(writers, "write_parquet", watched)
    return plans


def text(df):
    return sorted(map(str, df.collect()))


def stored_pings(spark, folder):
    rnd = random.Random(3)
    rows = []
    for k in range(3000):
        site = rnd.randrange(4)
        rows.append((k, rnd.randrange(40), START + dt.timedelta(seconds=rnd.randrange(20 * 86400)), rnd.choice("ab"), 1.0 + site, 100.0 + site))
    pings = spark.createDataFrame(rows, "event_id long, mmsi long, dt_pos_utc timestamp_ntz, vessel_type string, latitude double, longitude double")
    pings = pings.withColumn("H3_int_index_8", grid.cell_at("latitude", "longitude", 8))
    pings = pings.withColumns({c: (F.col("event_id") % 7).cast("double") for c in SHIP_ATTRIBUTES})
    path = writers.write_parquet(pings, f"{folder}/these_pings")
    return spark.read.parquet(path)


def test_port_traffic_reads_the_pings_once(spark, tmp_path, monkeypatch):
    pings = stored_pings(spark, tmp_path)
    sites = [(k, "Indonesia" if k < 2 else "Japan") for k in range(4)]
    ports = spark.createDataFrame([(f"P{k}", c, 1.0 + k, 100.0 + k) for k, c in sites], "Port string, Country string, la double, lo double")
    ports = ports.select(
        "Port", "Country", grid.cell_at("la", "lo", 8).alias("boundary_h3"), F.concat_ws(" - ", "Port", "Country").alias("Port_Country")
    )
    home, foreign = ports.filter("Country = 'Indonesia'"), ports.filter("Country <> 'Indonesia'")
    want = jobs.port_traffic(pings, home, foreign, ["event_id"])
    plans = recorded(monkeypatch)
    got = jobs.write_port_traffic(pings, home, foreign, str(tmp_path / "out"), ["event_id"], 86400)
    assert [reads for reads, _ in plans] == [True, False, False, False] and plans[0] == (True, 1)
    for name, df in got.items():
        assert text(df) == text(want[name]) and df.count() > 0


def test_port_call_reads_the_pings_once(spark, tmp_path, monkeypatch):
    pings = stored_pings(spark, tmp_path)
    rows = [(m, START + dt.timedelta(hours=m), "masuk", "in", 4000, "A", "d", "x") for m in range(50)]
    activity = spark.createDataFrame(
        rows, "mmsi long, dt_pos_utc timestamp_ntz, masuk_pelabuhan string, position string, time long, Port string, "
        "GroupBeneficialOwnerCountryofDomicile string, ns_vessel string",
    )
    text_columns = ["vessel_name", "vessel_type", "vessel_type_main", "vessel_type_sub", "fc_vessel",
                    "GroupBeneficialOwnerCountryOfRegistration", "RegisteredOwnerCountryofDomicile", "keluar_pelabuhan"]
    activity = activity.withColumns({c: F.lit("v") for c in text_columns} | {c: F.lit(1.0) for c in ("draught", "sog", "latitude", "longitude")})
    activity = activity.withColumn("H3_int_index_8", F.lit(1).cast("long"))
    strait = pings.filter("latitude = 3.0 and mmsi < 30").select("H3_int_index_8").distinct().toDF("cell").limit(1)
    strait = spark.createDataFrame(strait.collect(), "cell long")
    want = jobs.port_call(pings, activity, strait, tiebreak=["event_id"])
    plans = recorded(monkeypatch)
    got = jobs.write_port_call(pings, activity, strait, str(tmp_path / "out"), tiebreak=["event_id"])
    assert [reads for reads, _ in plans] == [True] + [False] * (len(plans) - 1) and plans[0] == (True, 1)
    for name, df in got.items():
        assert set(df.columns) == set(want[name].columns)
        assert text(df.select(*want[name].columns)) == text(want[name])
    assert got["through"].count() > 0 and got["not_through"].count() > 0
