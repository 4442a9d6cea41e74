"""Table layouts and the fixed settings of the standard jobs."""

from __future__ import annotations

from pyspark.sql import types as T

# Output columns of cleaned pings, in order.
PING_COLUMNS = [
    "mmsi", "imo", "vessel_name",
    "vessel_type", "vessel_type_main", "vessel_type_sub",
    "flag_country",
    "RegisteredOwnerCountryofDomicile",
    "GroupBeneficialOwnerCountryOfRegistration",
    "GroupBeneficialOwnerCountryofDomicile",
    "length", "LengthOverallLOA", "width", "BreadthExtreme", "Depth", "draught",
    "GrossTonnage", "NetTonnage", "Deadweight", "LightDisplacementTonnage",
    "nav_status", "sog",
    "dt_pos_utc", "latitude", "longitude", "H3_int_index_8",
]

# Latest ship attributes joined to the vessel lists.
SHIP_ATTRIBUTES = [
    "imo", "length", "width", "LengthOverallLOA",
    "BreadthExtreme", "GrossTonnage", "NetTonnage", "Deadweight",
    "LightDisplacementTonnage", "Depth",
]

# Manual type corrections (name, main type, sub type).
VESSEL_TYPE_FIXES = [
    ("PERTAMINA GAS DAHLIA", "Gas Tanker", "Lpg Tanker"),
    ("PERTAMINA PRIDE", "Oil And Chemical Tanker", "Crude Oil Tanker"),
    ("MARINA AMAN", "Oil And Chemical Tanker", "Crude Oil Tanker"),
    ("SC OCEAN LXI", "Oil And Chemical Tanker", "Crude Oil Tanker"),
    ("MBS BULELENG", "Bulk Carrier", None),
    ("SUCCESS FORTUNE XL", "Oil And Chemical Tanker", "Crude Oil Tanker"),
]

# Closed ring of the strait of Hormuz zone (lon, lat).
HORMUZ_WKT = (
    "POLYGON ((54.7 24.9, 54.7 26.0, 54.9 26.6, 55.5 27.0, 56.5 27.2, 56.5 26.5, "
    "56.1 26.1, 55.7 25.7, 54.7 24.9))"
)

REGION_RESOLUTION = 5
PORT_RESOLUTION = 8
AOI_METHODS = ("Manual", "Cluster", "Distance", "Heatmap")

_LONG = {"mmsi", "imo", "H3_int_index_8"}
_TEXT = {
    "vessel_name", "vessel_type", "vessel_type_main", "vessel_type_sub", "flag_country",
    "RegisteredOwnerCountryofDomicile", "GroupBeneficialOwnerCountryOfRegistration",
    "GroupBeneficialOwnerCountryofDomicile", "nav_status",
}


def _ping_type(name: str) -> T.DataType:
    if name in _LONG:
        return T.LongType()
    if name in _TEXT:
        return T.StringType()
    return T.TimestampType() if name == "dt_pos_utc" else T.DoubleType()


PING_SCHEMA = T.StructType([T.StructField(c, _ping_type(c)) for c in PING_COLUMNS])

REGISTER_SCHEMA = T.StructType(
    [
        T.StructField("MaritimeMobileServiceIdentityMMSINumber", T.LongType()),
        T.StructField("ShipName", T.StringType()),
        T.StructField("ShipStatus", T.StringType()),
        T.StructField("ShiptypeLevel5", T.StringType()),
    ]
)

PORT_CELL_SCHEMA = T.StructType(
    [
        T.StructField("Port", T.StringType()),
        T.StructField("Country", T.StringType()),
        T.StructField("boundary_h3", T.LongType()),
        T.StructField("Port_Country", T.StringType()),
    ]
)

# Stop events, name and Spark type, in the published order.
STOP_EVENT_COLUMNS = {
    "h3_index_int": "bigint", "mmsi": "bigint", "imo": "bigint", "length": "double", "width": "double",
    "vessel_type": "string", "vessel_type_main": "string", "obs_time": None, "flag_country": "string",
    "source": "string", "destination": "string", "time_lower": "int", "time_upper": "int",
    "unix_trigger": "bigint", "avg_unix": "bigint", "unix_disarm": "bigint", "sd_lat": "double",
    "sd_lng": "double", "trigger_lat": "double", "trigger_lng": "double", "avg_lat": "double",
    "avg_lng": "double", "disarm_lat": "double", "disarm_lng": "double", "mode_nav_status": "string",
    "obs_nav_status": "int", "state_initial": "int", "state_final": "int", "obs_count": "int",
    "is_valid": "string", "geom_wkt": "string", "wkt_avg_pt": "string",
}
