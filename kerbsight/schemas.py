"""Explicit schemas of the input tables and the gold tables."""

from __future__ import annotations

from pyspark.sql import types as T

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
#: parts -> vertices; a polygon is an array of closed-by-convention rings
GEOM = T.ArrayType(T.ArrayType(POINT))


_KINDS = {
    "string": T.StringType(), "double": T.DoubleType(), "bigint": T.LongType(), "int": T.IntegerType(),
    "timestamp": T.TimestampType(), "binary": T.BinaryType(),
}


def _schema(spec: str) -> T.StructType:
    """``name type, name type`` without needing a session, unlike the DDL parser."""
    pairs = [column.split() for column in spec.split(",") if column.strip()]
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in pairs])


CAR_COUNTS = _schema(
    "msid string, msname string, zsid string, zsname string, achse string, hnr string, hoehe string,"
    "ekoord double, nkoord double, richtung string, messung_dat_zeit timestamp,"
    "anz_fahrzeuge double, anz_fahrzeuge_status string"
)

PEDBIKE_COUNTS = _schema(
    "fk_standort bigint, datum timestamp, velo_in double, velo_out double,"
    "fuss_in double, fuss_out double, ost double, nord double"
)

TRANSIT_RUNS = _schema(
    "haltestellen_id bigint, nach_hst_id bigint, plan_fahrt_id bigint, tagtyp_id bigint, fz_ab string,"
    "einsteiger double, aussteiger double, besetzung double, distanz double, tage_dtv double,"
    "tage_dwv double, tage_sa double, tage_so double, tage_sa_n double, tage_so_n double"
)

#: gold tables: columns, primary key, NOT NULL columns and the parent of each foreign key
GOLD = {
    "frontage_visibility": {
        "schema": _schema(
            "objectid bigint, gwr_egid bigint, bezeichnung string, geometry binary,"
            "x_lon_center double, y_lat_centre double"
        ),
        "key": ["objectid"],
        "required": ["objectid", "gwr_egid", "geometry"],
    },
    "bike_edges": {
        "schema": _schema("edge_id bigint, geometry binary, u bigint, v bigint, key int"),
        "key": ["edge_id"],
        "required": ["edge_id", "geometry"],
    },
    "ped_edges": {
        "schema": _schema("edge_id bigint, geometry binary, u bigint, v bigint, key int"),
        "key": ["edge_id"],
        "required": ["edge_id", "geometry"],
    },
    "motorized_traffic_edges": {
        "schema": _schema(
            "edge_id bigint, geometry binary, u bigint, v bigint, key int, name string,"
            "length double, bearing double"
        ),
        "key": ["edge_id"],
        "required": ["edge_id", "geometry"],
    },
    "bike_flows": {
        "schema": _schema("edge_id bigint, hour int, flow double, flow_norm double"),
        "key": ["edge_id", "hour"],
        "required": ["edge_id", "hour"],
        "parent": "bike_edges",
    },
    "ped_flows": {
        "schema": _schema("edge_id bigint, hour int, flow double, flow_norm double"),
        "key": ["edge_id", "hour"],
        "required": ["edge_id", "hour"],
        "parent": "ped_edges",
    },
    "motorized_traffic_flows": {
        "schema": _schema("edge_id bigint, hour int, total_flow double, flow_norm double"),
        "key": ["edge_id", "hour"],
        "required": ["edge_id", "hour"],
        "parent": "motorized_traffic_edges",
    },
    "transit_flows_hourly": {
        "schema": _schema(
            "haltestellen_id string, nach_hst_id string, hour int, flow_besetzung double,"
            "n_runs int, geometry binary"
        ),
        "key": ["haltestellen_id", "nach_hst_id", "hour"],
        "required": ["haltestellen_id", "nach_hst_id", "hour", "geometry"],
    },
}
