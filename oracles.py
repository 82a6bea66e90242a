"""DuckDB statements that say what each registered query must return.

``VIEWS`` restates the stand-in tables of FIXTURES.md and the steps between them;
``statement`` puts the needed ones in front of a SELECT.
"""

from __future__ import annotations

import csv
import re
from pathlib import Path

#: the expected bearings, in the order in which they are tried; not read from the code under test
with Path(__file__).with_name("oracle_labels.csv").open(encoding="utf-8") as _file:
    LABELS = ", ".join(f"({i}, '{r['word']}', {r['bearing']}::DOUBLE)" for i, r in enumerate(csv.DictReader(_file)))


def lon(e: str, n: str) -> str:
    y, x = f"(({e}-2600000.0)/1000000.0)", f"(({n}-1200000.0)/1000000.0)"
    return f"((2.6779094+4.728982*{y}+0.791484*{y}*{x}+0.1306*{y}*{x}*{x}-0.0436*{y}*{y}*{y})*100/36)"


def lat(e: str, n: str) -> str:
    y, x = f"(({e}-2600000.0)/1000000.0)", f"(({n}-1200000.0)/1000000.0)"
    return (f"((16.9023892+3.238272*{x}-0.270978*{y}*{y}-0.002528*{x}*{x}"
            f"-0.0447*{y}*{y}*{x}-0.0140*{x}*{x}*{x})*100/36)")


def east(lo: str, la: str) -> str:
    p, k = f"(({la}*3600-169028.66)/10000.0)", f"(({lo}*3600-26782.5)/10000.0)"
    return f"(2600072.37+211455.93*{k}-10938.51*{k}*{p}-0.36*{k}*{p}*{p}-44.54*{k}*{k}*{k})"


def north(lo: str, la: str) -> str:
    p, k = f"(({la}*3600-169028.66)/10000.0)", f"(({lo}*3600-26782.5)/10000.0)"
    return f"(1200147.07+308807.95*{p}+3745.25*{k}*{k}+76.63*{p}*{p}-194.56*{k}*{k}*{p}+119.79*{p}*{p}*{p})"


def d2(px: str, py: str, s: str = "s") -> str:
    """Squared point-segment distance; ``t`` is the clamped foot of the perpendicular."""
    ux, uy = f"({s}.x2-{s}.x1)", f"({s}.y2-{s}.y1)"
    t = (f"greatest(0.0, least(1.0, coalesce((({px}-{s}.x1)*{ux}+({py}-{s}.y1)*{uy})"
         f"/nullif({ux}*{ux}+{uy}*{uy}, 0.0), 0.0)))")
    return f"(pow({px}-{s}.x1-{t}*{ux}, 2)+pow({py}-{s}.y1-{t}*{uy}, 2))"


def arc(a: str, b: str) -> str:
    return f"least(abs({a}-{b}), 360.0-abs({a}-{b}))"


def path_model(seeds: str, edges: str, max_distance: float, min_flow: float, alpha: float, max_arc: float,
               exponent: float, comfort: str) -> str:
    """Recursive levels of the comfort-weighted model over ``seeds``."""
    direction = (f"CASE WHEN f.bearing IS NULL OR e.bearing IS NULL THEN 1.0 "
                 f"WHEN {arc('f.bearing', 'e.bearing')} >= {max_arc} THEN 0.0 "
                 f"ELSE pow(1.0 - {arc('f.bearing', 'e.bearing')} / {max_arc}, {exponent}) END")
    return f"""
      SELECT seed, hour, bearing, u, v, key, 0.0::DOUBLE AS dist, flow, ''::VARCHAR AS path FROM {seeds}
      UNION ALL
      SELECT seed, hour, bearing, u, v, key, dist, arriving AS flow, path FROM (
        SELECT c.*, flow * w / sum(w) OVER (PARTITION BY seed, parent) * exp(-{alpha} * length) AS arriving FROM (
          SELECT f.seed, f.hour, f.bearing, e.u, e.v, e.key, f.dist + e.length AS dist, e.length, f.flow, f.path AS parent,
                 f.path || e.edge_id::VARCHAR || '/' AS path, ({direction}) * ({comfort}) AS w
          FROM flow_rows f JOIN {edges} e ON e.u = f.v
          WHERE f.dist < {max_distance} AND f.flow >= {min_flow} AND e.length > 0 AND f.dist + e.length <= {max_distance}
        ) c WHERE w > 0
      ) WHERE arriving >= {min_flow}"""


VIEWS: dict[str, str] = {
    "net_nodes": """
      SELECT c_custkey AS node_id, c_custkey % 40 AS gx, floor(c_custkey / 40.0)::BIGINT AS gy,
             (2676000 + 100 * (c_custkey % 40) + 3 * (c_nationkey % 7))::DOUBLE AS x,
             (1241000 + 100 * floor(c_custkey / 40.0) + 2 * (c_nationkey % 5))::DOUBLE AS y,
             c_acctbal < 0 AS one_way, c_mktsegment = 'BUILDING' AS doubled
      FROM customer""",
    "grid_steps": """
      SELECT a.node_id AS a, b.node_id AS b, a.x AS ax, a.y AS ay, b.x AS tx, b.y AS ty, a.one_way, a.doubled
      FROM net_nodes a JOIN net_nodes b ON (b.gx = a.gx + 1 AND b.gy = a.gy) OR (b.gx = a.gx AND b.gy = a.gy + 1)""",
    "net_ways": """
      SELECT a AS u, b AS v, 0 AS key, ax AS x1, ay AS y1, tx AS x2, ty AS y2 FROM grid_steps
      UNION ALL SELECT b, a, 0, tx, ty, ax, ay FROM grid_steps WHERE NOT one_way
      UNION ALL SELECT a, b, 1, ax, ay, tx, ty FROM grid_steps WHERE doubled""",
    "net_edges": """
      SELECT *, row_number() OVER (ORDER BY u, v, key) AS edge_id,
             CASE WHEN bent THEN sqrt((mx-x1)*(mx-x1)+(my-y1)*(my-y1)) + sqrt((x2-mx)*(x2-mx)+(y2-my)*(y2-my))
                  ELSE sqrt((x2-x1)*(x2-x1)+(y2-y1)*(y2-y1)) END AS length,
             CASE WHEN (u + v) % 53 = 0 THEN NULL WHEN degrees(atan2(x2-x1, y2-y1)) < 0
                  THEN degrees(atan2(x2-x1, y2-y1)) + 360.0 ELSE degrees(atan2(x2-x1, y2-y1)) END AS bearing,
             ['cycleway','residential','primary','footway','pedestrian','service','path;secondary'][((u+v) % 7 + 1)::INT] AS highway,
             'Street ' || (u % 17)::VARCHAR AS name
      FROM (SELECT *, (u + v) % 4 = 0 AS bent, (x1 + x2) / 2 + 7 AS mx, (y1 + y2) / 2 + 5 AS my FROM net_ways)""",
    "net_segments": """
      SELECT edge_id, u, v, key, x1, y1, CASE WHEN bent THEN mx ELSE x2 END AS x2, CASE WHEN bent THEN my ELSE y2 END AS y2 FROM net_edges
      UNION ALL SELECT edge_id, u, v, key, mx, my, x2, y2 FROM net_edges WHERE bent""",
    "counts_cars": """
      SELECT event_id AS id,
             CASE WHEN event_id % 401 = 0 THEN 'kaputt' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS messung_dat_zeit,
             'Z' || s::VARCHAR AS msid, 'Station ' || s::VARCHAR AS msname, 'Z' || (s % 12)::VARCHAR AS zsname,
             'Axis ' || (s % 7)::VARCHAR AS achse,
             CASE event_type WHEN 'view' THEN ' Einwärts' WHEN 'click' THEN 'auswaerts' WHEN 'signup' THEN 'Oerlikon'
                  WHEN 'purchase' THEN 'Höngg' ELSE CASE WHEN event_id % 5 = 0 THEN NULL ELSE 'unbekannt' END END AS richtung,
             CASE WHEN event_id % 97 = 0 THEN 'n/a' ELSE floor(value * 10)::BIGINT::VARCHAR END AS anz_fahrzeuge,
             CASE WHEN event_id % 211 = 0 THEN NULL ELSE (2676010 + (s * 211) % 3900)::VARCHAR END AS ekoord,
             (1241005 + s * 240 + (s * 53) % 97)::VARCHAR AS nkoord
      FROM (SELECT *, floor(user_id / 10.0)::BIGINT AS s FROM events)""",
    "car_clean": f"""
      SELECT *, hour(t)::INT AS hour, {lon('e', 'n')} AS lon, {lat('e', 'n')} AS lat FROM (
        SELECT id, msid, msname, zsname, achse, richtung, try_cast(messung_dat_zeit AS TIMESTAMP) AS t,
               try_cast(anz_fahrzeuge AS DOUBLE) AS cars, try_cast(ekoord AS DOUBLE) AS e, try_cast(nkoord AS DOUBLE) AS n
        FROM counts_cars) WHERE t IS NOT NULL AND e IS NOT NULL AND n IS NOT NULL""",
    "car_profile": """
      SELECT msid, richtung, hour, avg(cars) AS flow_value, arg_min(lon, (t, id)) AS lon, arg_min(lat, (t, id)) AS lat,
             arg_min(e, (t, id)) AS e, arg_min(n, (t, id)) AS n, arg_min(msname, (t, id)) AS msname,
             arg_min(zsname, (t, id)) AS zsname, arg_min(achse, (t, id)) AS achse
      FROM car_clean WHERE richtung IS NOT NULL GROUP BY msid, richtung, hour""",
    "label_table": f"SELECT * FROM (VALUES {LABELS}) AS t(ord, word, bearing)",
    "label_hits": """
      SELECT l.richtung, arg_min(t.bearing, t.ord) AS bearing
      FROM (SELECT DISTINCT richtung FROM counts_cars WHERE richtung IS NOT NULL) l JOIN label_table t
        ON contains(replace(replace(replace(lower(l.richtung), 'ö', 'oe'), 'ü', 'ue'), 'ä', 'ae'), t.word)
      GROUP BY l.richtung""",
    "car_seeds": """
      SELECT * FROM (
        SELECT p.*, k.kind AS richtung_typ, coalesce(
                 CASE k.kind WHEN 'in' THEN k.inward WHEN 'out' THEN fmod(k.inward + 180.0, 360.0) END, h.bearing) AS bearing_seed
        FROM car_profile p
        JOIN LATERAL (SELECT
               CASE WHEN lower(p.richtung) SIMILAR TO '.*(einwärts|einwaerts).*' THEN 'in'
                    WHEN lower(p.richtung) SIMILAR TO '.*(auswärts|auswaerts).*' THEN 'out' ELSE 'label' END AS kind,
               fmod(degrees(atan2(8.5390 - p.lon, 47.3724 - p.lat)) + 360.0, 360.0) AS inward) k ON TRUE
        LEFT JOIN label_hits h ON h.richtung = p.richtung
      ) WHERE bearing_seed IS NOT NULL""",
    "car_places": "SELECT DISTINCT e, n FROM car_seeds",
    "car_snaps": f"""
      SELECT e, n, arg_min({{'u': u, 'v': v, 'key': key}}, (d, u, v, key)) AS edge, min(d) AS d FROM (
        SELECT p.e, p.n, s.u, s.v, s.key, round({d2('p.e', 'p.n')}, 6) AS d FROM car_places p CROSS JOIN net_segments s
      ) GROUP BY e, n""",
    "car_starts": f"""
      SELECT c.*, w.edge.u AS u, w.edge.v AS v, w.edge.key AS key, sqrt(w.d) AS dist,
             CASE WHEN {arc('c.bearing_seed', 'coalesce(g.bearing, 180.0)')} > 90 THEN w.edge.v ELSE w.edge.u END AS start_node
      FROM car_seeds c JOIN car_snaps w ON w.e = c.e AND w.n = c.n
      JOIN net_edges g ON g.u = w.edge.u AND g.v = w.edge.v AND g.key = w.edge.key""",
    "car_rows": f"""
      SELECT 1 AS kind, 0 AS level, msid || '|' || richtung || '|' || hour::VARCHAR AS seed, hour, bearing_seed AS bearing,
             start_node AS node, 0.0::DOUBLE AS dist, flow_value AS flow, ''::VARCHAR AS path,
             NULL::BIGINT AS u, NULL::INT AS key, 0.0::DOUBLE AS edge_flow
      FROM car_starts WHERE flow_value IS NOT NULL
      UNION ALL
      SELECT r.kind, level + 1, seed, hour, bearing, r.node, r.dist, r.flow, r.path, r.u, r.key, r.edge_flow
      FROM (
        SELECT level, seed, hour, bearing, unnest(list_concat(
          CASE WHEN turn = 1 AND nth = 1 THEN [{{'kind': 0, 'node': node, 'dist': best, 'flow': NULL::DOUBLE, 'path': '',
                 'u': NULL::BIGINT, 'key': NULL::INT, 'edge_flow': 0.0::DOUBLE}}] ELSE [] END,
          CASE WHEN w > 0 THEN [{{'kind': 1, 'node': v, 'dist': dist + length, 'flow': flow * w / total * pow(0.985, length / 100.0),
                 'path': path || lpad(nth::VARCHAR, 2, '0'), 'u': node, 'key': ekey, 'edge_flow': flow * w / total}}] ELSE [] END)) AS r
        FROM (
          SELECT *, sum(w) OVER (PARTITION BY seed, node, turn) AS total,
                 row_number() OVER (PARTITION BY seed, node, turn ORDER BY v, ekey) AS nth
          FROM (
            SELECT j.*, e.v, e.key AS ekey, e.length,
                   CASE WHEN greatest(0.0, 1.0 - {arc('j.bearing', 'e.bearing')} / 135.0) >= 0.01 AND e.bearing IS NOT NULL
                        THEN greatest(0.0, 1.0 - {arc('j.bearing', 'e.bearing')} / 135.0) ELSE 0.0 END AS w
            FROM (
              SELECT *, kind = 1 AND (earlier IS NULL OR dist < earlier) AS goes FROM (
                SELECT *, min(dist) OVER (q ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier,
                       row_number() OVER q AS turn, min(dist) OVER (PARTITION BY seed, node) AS best,
                       count(*) FILTER (kind = 1) OVER (PARTITION BY seed) AS moving
                FROM car_rows WHERE kind = 0 OR (dist <= 5000 AND flow >= 5)
                WINDOW q AS (PARTITION BY seed, node ORDER BY kind, path)
              ) WHERE moving > 0
            ) j LEFT JOIN net_edges e ON e.u = CASE WHEN j.goes THEN j.node END
          )))""",
    "car_flow": """
      SELECT u, node AS v, key, hour, sum(edge_flow) AS total_flow FROM car_rows
      WHERE kind = 1 AND u IS NOT NULL GROUP BY u, node, key, hour""",
    "counts_pedbike": """
      SELECT event_id AS id, s AS fk_standort,
             CASE WHEN event_id % 401 = 0 THEN 'kaputt' ELSE strftime(ts, '%Y-%m-%dT%H:%M') END AS datum,
             CASE WHEN event_type IN ('view', 'signup') THEN floor(value * 4)::BIGINT::VARCHAR ELSE '0' END AS velo_in,
             CASE WHEN event_type = 'click' THEN floor(value * 5)::BIGINT::VARCHAR WHEN event_id % 13 = 0 THEN NULL ELSE '0' END AS velo_out,
             CASE WHEN s % 25 = 3 THEN '0' WHEN event_type = 'purchase' THEN floor(value * 3)::BIGINT::VARCHAR ELSE '1' END AS fuss_in,
             CASE WHEN s % 25 = 3 THEN '0' WHEN event_type = 'error' THEN floor(value * 2)::BIGINT::VARCHAR ELSE '0' END AS fuss_out,
             CASE WHEN event_id % 7 = 0 THEN NULL ELSE (2676010 + (s * 151) % 3900)::VARCHAR END AS ost,
             CASE WHEN event_id % 7 = 0 THEN NULL ELSE (1241005 + s * 145 + (s * 47) % 90)::VARCHAR END AS nord
      FROM (SELECT *, floor(user_id / 6.0)::BIGINT AS s FROM events)""",
    "pedbike_clean": """
      SELECT * , hour(t)::INT AS hour FROM (
        SELECT id, fk_standort, try_cast(replace(datum, 'T', ' ') || ':00' AS TIMESTAMP) AS t,
               coalesce(try_cast(velo_in AS DOUBLE), 0) AS velo_in, coalesce(try_cast(velo_out AS DOUBLE), 0) AS velo_out,
               coalesce(try_cast(fuss_in AS DOUBLE), 0) AS fuss_in, coalesce(try_cast(fuss_out AS DOUBLE), 0) AS fuss_out,
               try_cast(ost AS DOUBLE) AS ost, try_cast(nord AS DOUBLE) AS nord
        FROM counts_pedbike) WHERE t IS NOT NULL""",
    "pedbike_places": """
      SELECT fk_standort, arg_min(ost, (t, id)) FILTER (ost IS NOT NULL) AS ost,
             arg_min(nord, (t, id)) FILTER (nord IS NOT NULL) AS nord FROM pedbike_clean GROUP BY fk_standort""",
    **{
        f"station_hours_{how}": f"""
      SELECT *, coalesce(velo_in / nullif(velo_hour, 0), 0) AS velo_in_share, coalesce(velo_out / nullif(velo_hour, 0), 0) AS velo_out_share,
             coalesce(fuss_in / nullif(fuss_hour, 0), 0) AS fuss_in_share, coalesce(fuss_out / nullif(fuss_hour, 0), 0) AS fuss_out_share
      FROM (SELECT *, velo_in + velo_out AS velo_hour, fuss_in + fuss_out AS fuss_hour FROM (
        SELECT fk_standort, hour, {fold}(velo_in) AS velo_in, {fold}(velo_out) AS velo_out,
               {fold}(fuss_in) AS fuss_in, {fold}(fuss_out) AS fuss_out
        FROM pedbike_clean GROUP BY fk_standort, hour)) LEFT JOIN pedbike_places USING (fk_standort)"""
        for how, fold in (("mean", "avg"), ("sum", "sum"), ("median", "median"))
    },
    "station_snaps": f"""
      SELECT DISTINCT fk_standort, u, v, key, sqrt(d) AS dist FROM (
        SELECT p.fk_standort, s.u, s.v, s.key, round({d2('p.ost', 'p.nord')}, 6) AS d,
               min(round({d2('p.ost', 'p.nord')}, 6)) OVER (PARTITION BY p.fk_standort) AS best
        FROM pedbike_places p CROSS JOIN net_segments s WHERE p.ost IS NOT NULL AND p.nord IS NOT NULL
      ) WHERE d = best""",
    **{
        f"{mode}_seeds": f"""
      SELECT row_number() OVER (ORDER BY u, v, key, hour, flow, fk_standort) AS seed, * FROM (
        SELECT h.fk_standort, h.hour, e.bearing, e.u, e.v, e.key, h.{col}_hour * h.{col}_in_share AS flow
        FROM station_hours_mean h JOIN station_snaps p USING (fk_standort)
        JOIN net_edges e ON e.u = p.u AND e.v = p.v AND e.key = p.key WHERE h.{col}_hour > 0
        UNION ALL
        SELECT h.fk_standort, h.hour, b.bearing, b.u, b.v, b.key, h.{col}_hour * h.{col}_out_share
        FROM station_hours_mean h JOIN station_snaps p USING (fk_standort)
        JOIN (SELECT * FROM net_edges QUALIFY row_number() OVER (PARTITION BY u, v ORDER BY key) = 1) b
          ON b.u = p.v AND b.v = p.u WHERE h.{col}_hour > 0
      ) WHERE flow > 0"""
        for mode, col in (("bike", "velo"), ("ped", "fuss"))
    },
    "transit_runs": """
      SELECT l_suppkey AS haltestellen_id,
             CASE WHEN l_linenumber = 7 THEN NULL ELSE l_suppkey + 1 + l_linenumber % 3 END AS nach_hst_id,
             l_orderkey AS plan_fahrt_id, l_linenumber % 5 AS tagtyp_id, l_partkey % 26 AS clock,
             CASE WHEN l_orderkey % 89 = 0 THEN NULL ELSE l_quantity END AS besetzung FROM lineitem""",
    "segment_hours": """
      SELECT haltestellen_id, nach_hst_id, clock::INT AS hour, coalesce(sum(besetzung), 0) AS flow_besetzung,
             count(DISTINCT plan_fahrt_id) AS n_runs
      FROM transit_runs WHERE clock < 24 AND nach_hst_id IS NOT NULL
        AND tagtyp_id IN (SELECT r_regionkey FROM region WHERE r_regionkey IN (0, 1))
      GROUP BY ALL""",
    "feed_stops": """
      SELECT CASE WHEN s_suppkey % 10 = 9 THEN 'depot ' ELSE '' END || lower(s_name) AS stop_name,
             47.3154 + 0.0009 * floor(s_suppkey / 40.0) + 0.00002 * n AS stop_lat, 8.4438 + 0.00132 * (s_suppkey % 40) AS stop_lon
      FROM supplier, (VALUES (0), (1)) p(n)""",
    "matched_stops": """
      SELECT s.s_suppkey AS haltestellen_id, upper(s.s_name) AS name_norm, f.stop_lat, f.stop_lon
      FROM supplier s LEFT JOIN (SELECT upper(stop_name) AS name, avg(stop_lat) AS stop_lat, avg(stop_lon) AS stop_lon
                                 FROM feed_stops GROUP BY 1) f ON f.name = upper(s.s_name)""",
    "placed_stops": f"""
      SELECT haltestellen_id, {east('stop_lon', 'stop_lat')} AS e, {north('stop_lon', 'stop_lat')} AS n
      FROM matched_stops WHERE stop_lat IS NOT NULL""",
    "stop_extent": """
      SELECT min(stop_lon) - 0.01 AS west, max(stop_lon) + 0.01 AS east, min(stop_lat) - 0.01 AS south,
             max(stop_lat) + 0.01 AS north FROM matched_stops""",
    "near_nodes": f"""
      SELECT n.node_id, n.x, n.y, {lon('n.x', 'n.y')} AS lon, {lat('n.x', 'n.y')} AS lat FROM net_nodes n, stop_extent b
      WHERE {lon('n.x', 'n.y')} BETWEEN b.west AND b.east AND {lat('n.x', 'n.y')} BETWEEN b.south AND b.north""",
    "near_edges": """
      SELECT * FROM net_edges WHERE u IN (SELECT node_id FROM near_nodes) AND v IN (SELECT node_id FROM near_nodes)""",
    "stop_nodes": """
      SELECT haltestellen_id, arg_min(node_id, (d, node_id)) AS node_id, sqrt(min(d)) AS dist FROM (
        SELECT s.haltestellen_id, n.node_id, round((s.e - n.x) * (s.e - n.x) + (s.n - n.y) * (s.n - n.y), 6) AS d
        FROM placed_stops s CROSS JOIN near_nodes n) GROUP BY haltestellen_id""",
    "stop_pairs": """
      SELECT DISTINCT s.haltestellen_id, s.nach_hst_id, a.node_id AS src, b.node_id AS dst FROM segment_hours s
      JOIN stop_nodes a ON a.haltestellen_id = s.haltestellen_id JOIN stop_nodes b ON b.haltestellen_id = s.nach_hst_id""",
    "reach": """
      SELECT DISTINCT src, src AS node, 0.0::DOUBLE AS dist, 0 AS hops FROM stop_pairs
      UNION
      SELECT src, node, best.dist, best.hops FROM (
        SELECT r.src, e.v AS node, min({'dist': r.dist + e.length, 'hops': r.hops + 1}) AS best
        FROM reach r JOIN near_edges e ON e.u = r.node GROUP BY r.src, e.v) c
      LEFT JOIN recurring.reach o USING (src, node)
      WHERE o.dist IS NULL OR (best.dist, best.hops) < (o.dist, o.hops)""",
    "preds": """
      SELECT t.src, t.node, min(e.u) AS pred FROM reach t JOIN near_edges e ON e.v = t.node
      JOIN reach f ON f.src = t.src AND f.node = e.u
      WHERE f.dist + e.length = t.dist AND f.hops + 1 = t.hops GROUP BY t.src, t.node""",
    "walked": """
      SELECT DISTINCT p.src, p.dst, r.hops AS pos, p.dst AS node, r.dist AS length FROM stop_pairs p
      JOIN reach r ON r.src = p.src AND r.node = p.dst WHERE p.src <> p.dst
      UNION ALL
      SELECT w.src, w.dst, w.pos - 1, q.pred, w.length FROM walked w JOIN preds q ON q.src = w.src AND q.node = w.node""",
    "frontages": """
      SELECT objectid, gwr_egid, bezeichnung, pos, x1, y1,
             x1 + CASE objectid % 4 WHEN 0 THEN len WHEN 2 THEN -len ELSE 0 END AS x2,
             y1 + CASE objectid % 4 WHEN 1 THEN len WHEN 3 THEN -len ELSE 0 END AS y2
      FROM (
        SELECT p_partkey AS objectid, floor(p_partkey / 3.0)::BIGINT AS gwr_egid, p_name AS bezeichnung, pos,
               CASE WHEN p_partkey % 101 = 0 THEN 0 ELSE p_size END::DOUBLE AS len,
               (2676000 + 100 * (p_partkey % 40) + (p_partkey * 37) % 100 + 12 * pos)::DOUBLE AS x1,
               (1241000 + 75 * floor(p_partkey / 40.0) + (p_partkey * 53) % 75 + 180 * pos)::DOUBLE AS y1
        FROM part JOIN (VALUES (0), (1)) k(pos) ON pos = 0 OR p_partkey % 5 = 0)""",
    # quad of a wall of length len: rays at tangent + 90 +- 45 degrees, 30 m long
    "quads": """
      SELECT objectid, gwr_egid, bezeichnung, pos, x1 AS x_a, y1 AS y_a, x2 AS x_b, y2 AS y_b,
             x2 + 30 * cos(radians(tangent + 45)) AS x_c, y2 + 30 * sin(radians(tangent + 45)) AS y_c,
             x1 + 30 * cos(radians(tangent + 135)) AS x_d, y1 + 30 * sin(radians(tangent + 135)) AS y_d
      FROM (SELECT *, degrees(atan2(y2 - y1, x2 - x1)) AS tangent FROM frontages WHERE x1 <> x2 OR y1 <> y2)""",
    "quad_corners": """
      SELECT objectid, pos, k, CASE k WHEN 0 THEN x_a WHEN 1 THEN x_b WHEN 2 THEN x_c ELSE x_d END AS x,
             CASE k WHEN 0 THEN y_a WHEN 1 THEN y_b WHEN 2 THEN y_c ELSE y_d END AS y
      FROM quads, (VALUES (0), (1), (2), (3)) t(k)""",
    "quad_degrees": f"SELECT objectid, pos, k, {lon('x', 'y')} AS x, {lat('x', 'y')} AS y FROM quad_corners",
    "centroids": """
      SELECT objectid, ox + sum(mx) / sum(area) AS x_lon_center, oy + sum(my) / sum(area) AS y_lat_centre FROM (
        SELECT objectid, ox, oy, (px * qy - qx * py) / 2 AS area, (px + qx) * (px * qy - qx * py) / 6 AS mx,
               (py + qy) * (px * qy - qx * py) / 6 AS my
        FROM (
          SELECT a.objectid, o.x AS ox, o.y AS oy, a.x - o.x AS px, a.y - o.y AS py, b.x - o.x AS qx, b.y - o.y AS qy
          FROM quad_degrees a JOIN quad_degrees b ON b.objectid = a.objectid AND b.pos = a.pos AND b.k = (a.k + 1) % 4
          JOIN quad_degrees o ON o.objectid = a.objectid AND o.pos = 0 AND o.k = 0)
      ) GROUP BY objectid, ox, oy""",
    "quad_sides": """
      SELECT a.objectid, a.pos, a.k, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM quad_corners a
      JOIN quad_corners b ON b.objectid = a.objectid AND b.pos = a.pos AND b.k = (a.k + 1) % 4""",
}


def crossing(lines: str, keys: str) -> str:
    """Frontage/line pairs: a segment crosses a quad side, or starts inside the quad."""
    inside = " AND ".join(
        f"(q.x_{b}-q.x_{a})*(s.y1-q.y_{a})-(q.y_{b}-q.y_{a})*(s.x1-q.x_{a}) >= 0"
        for a, b in (("a", "b"), ("b", "c"), ("c", "d"), ("d", "a"))
    )
    o = "sign(({0}.x2-{0}.x1)*({1}.{3}-{0}.y1)-({0}.y2-{0}.y1)*({1}.{2}-{0}.x1))"
    s1, s2 = o.format("t", "s", "x1", "y1"), o.format("t", "s", "x2", "y2")
    t1, t2 = o.format("s", "t", "x1", "y1"), o.format("s", "t", "x2", "y2")
    boxes = ("least(t.x1, t.x2) <= greatest(s.x1, s.x2) AND least(s.x1, s.x2) <= greatest(t.x1, t.x2) AND "
             "least(t.y1, t.y2) <= greatest(s.y1, s.y2) AND least(s.y1, s.y2) <= greatest(t.y1, t.y2)")
    return f"""
      SELECT DISTINCT objectid, {keys} FROM (
        SELECT q.objectid, {keys} FROM quads q JOIN {lines} s
          ON s.x1 BETWEEN q.x_a - 100 AND q.x_a + 100 AND s.y1 BETWEEN q.y_a - 100 AND q.y_a + 100 WHERE {inside}
        UNION ALL
        SELECT t.objectid, {keys} FROM quad_sides t JOIN {lines} s ON {boxes}
        WHERE {s1} * {s2} <= 0 AND {t1} * {t2} <= 0)"""


VIEWS.update({
    "road_hits": crossing("net_segments", "edge_id"),
    "flows_bike": """
      SELECT edge_id, u, v, key, hour, CASE WHEN (u + hour) % 19 = 0 THEN NULL
             WHEN (u + v) % 3 = 0 THEN (u * 7 + v * 3 + hour) % 200 ELSE 0 END::DOUBLE AS flow
      FROM net_edges, (VALUES (7), (8), (17)) h(hour)""",
    "flows_ped": """
      SELECT edge_id, u, v, key, hour, CASE WHEN (u + v) % 7 = 0 THEN (u * 5 + v + hour) % 90 ELSE 0 END::DOUBLE AS flow
      FROM net_edges, (VALUES (12), (17)) h(hour)""",
    "flows_cars": """
      SELECT edge_id, u, v, key, hour, CASE WHEN key = 0 AND (u + v) % 2 = 1
             THEN (u * 11 + v * 2 + hour * 13) % 900 ELSE 0 END::DOUBLE / 4 AS total_flow
      FROM net_edges, (VALUES (6), (8), (13), (18)) h(hour)""",
    "flows_transit": """
      SELECT a.node_id::VARCHAR AS haltestellen_id, b.node_id::VARCHAR AS nach_hst_id, hour,
             ((a.node_id + hour) % 120)::DOUBLE AS flow_besetzung, (a.node_id % 9)::INT AS n_runs,
             a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2
      FROM net_nodes a JOIN net_nodes b ON b.node_id = a.node_id + 2, (VALUES (8), (17)) h(hour)""",
    "transit_lines": "SELECT DISTINCT haltestellen_id, nach_hst_id, x1, y1, x2, y2 FROM flows_transit",
    "transit_hits": crossing("transit_lines", "haltestellen_id, nach_hst_id"),
    "mode_hits": """
      SELECT objectid, 'transit' AS flow_type, f.haltestellen_id || f.nach_hst_id AS corridor, flow_besetzung AS flow
      FROM transit_hits JOIN flows_transit f USING (haltestellen_id, nach_hst_id) WHERE flow_besetzung > 0
      UNION ALL SELECT objectid, 'bike', edge_id::VARCHAR, flow FROM road_hits JOIN flows_bike USING (edge_id) WHERE flow > 0
      UNION ALL SELECT objectid, 'pedestrian', edge_id::VARCHAR, flow FROM road_hits JOIN flows_ped USING (edge_id) WHERE flow > 0
      UNION ALL SELECT objectid, 'motorized', edge_id::VARCHAR, total_flow FROM road_hits JOIN flows_cars USING (edge_id)
                WHERE total_flow > 0""",
    # quarters as whole numbers, so that rounding half up is exact
    "impressions": """
      SELECT objectid, flow_type, count(DISTINCT corridor) AS affected_corridors,
             floor((sum((flow * 4)::BIGINT) + 2) / 4.0)::DOUBLE AS total_impressions,
             ((sum((flow * 4)::BIGINT) * 50 + count(*)) // (2 * count(*)))::DOUBLE / 100 AS avg_flow
      FROM mode_hits GROUP BY objectid, flow_type""",
    "frontage_list": "SELECT DISTINCT objectid, gwr_egid, bezeichnung FROM quads",
})

RECURSIVE = {"flow_rows": "", "car_rows": "", "reach": "(src, node, dist, hops) USING KEY (src, node)", "walked": "",
             "street_roots": "(node, root)", "core_ahead": "(node)", "core_behind": "(node)"}
#: the largest component of two-way streets, and what it reaches and is reached from; most streets lead to the larger node only
CORE_VIEWS = {
    "streets": "SELECT DISTINCT u, v FROM net_edges WHERE u < v OR u > v AND (u + v) % 3 = 0",
    "two_way": "SELECT a.u, a.v FROM streets a JOIN streets b ON b.u = a.v AND b.v = a.u",
    "street_nodes": "SELECT u AS node FROM streets UNION SELECT v FROM streets",
    "street_roots": "SELECT node, node FROM street_nodes UNION"
                    " SELECT w.v, r.root FROM street_roots r JOIN two_way w ON w.u = r.node WHERE r.root < w.v",
    "least_roots": "SELECT node, min(root) AS root FROM street_roots GROUP BY node",
    "core_nodes": "SELECT node FROM least_roots WHERE root ="
                  " (SELECT root FROM least_roots GROUP BY root ORDER BY count(*) DESC, root LIMIT 1)",
    "core_ahead": "SELECT node FROM core_nodes UNION SELECT e.v FROM core_ahead r JOIN streets e ON e.u = r.node",
    "core_behind": "SELECT node FROM core_nodes UNION SELECT e.u FROM core_behind r JOIN streets e ON e.v = r.node",
}


def statement(select: str, **extra: str) -> str:
    """``select`` with the views it needs, in dependency order."""
    known = {**VIEWS, **extra}
    order: list[str] = []

    def need(text: str, own: str = "") -> None:
        for name in re.findall(r"[a-z_]+", text):
            if name in known and name != own and name not in order:
                need(known[name], name)
                if name not in order:
                    order.append(name)

    need(select)
    if not order:
        return select
    parts = ",\n".join(f"{n}{' ' + RECURSIVE[n] if RECURSIVE.get(n) else ''} AS ({known[n]})" for n in order)
    return f"WITH RECURSIVE {parts}\n{select}"


COMFORT_BIKE = ("1 + CASE WHEN regexp_matches(e.highway, 'cycleway|path') THEN 2 ELSE 0 END"
                " + CASE WHEN regexp_matches(e.highway, 'residential|living_street') THEN 1 ELSE 0 END"
                " - CASE WHEN regexp_matches(e.highway, 'primary|secondary|tertiary') THEN 0.5 ELSE 0 END")
COMFORT_PED = ("1 + CASE WHEN regexp_matches(e.highway, 'pedestrian|living_street') THEN 2 ELSE 0 END"
               " + CASE WHEN regexp_matches(e.highway, 'footway|path|steps') THEN 1 ELSE 0 END"
               " - CASE WHEN regexp_matches(e.highway, 'primary|secondary|tertiary') THEN 0.5 ELSE 0 END")
BIKE_ROWS = path_model("bike_seeds", "net_edges", 3000, 5, 0.0015, 90.0, 2, COMFORT_BIKE)
PED_ROWS = path_model("ped_seeds", "net_edges", 800, 3, 0.003, 120.0, 1, COMFORT_PED)
PATH_SUM = "SELECT u, v, key, hour, sum(flow) AS flow FROM flow_rows GROUP BY u, v, key, hour"


def _path_gold(rows: str) -> str:
    return statement(
        "SELECT e.edge_id, p.hour, round(p.flow, 4) AS flow, round(p.flow / max(p.flow) OVER (), 6) AS flow_norm"
        " FROM path_sum p JOIN net_edges e USING (u, v, key)", flow_rows=rows, path_sum=PATH_SUM,
    )


def _impressions(mode: str | None) -> str:
    where = f" WHERE flow_type = '{mode}'" if mode else ""
    return statement(
        "SELECT f.gwr_egid, f.objectid, f.bezeichnung, i.flow_type, i.affected_corridors, i.total_impressions, i.avg_flow"
        f" FROM impressions i JOIN frontage_list f USING (objectid){where}"
    )


def _of(mode: str, column: str, name: str) -> str:
    return f"coalesce(max(CASE WHEN flow_type = '{mode}' THEN {column} END), 0) AS {name}"


SUMMARY = ", ".join(
    part for mode, short, count in (("transit", "transit", "transit_corridors"), ("bike", "bike", "bike_edges"),
                                    ("pedestrian", "ped", "ped_edges"), ("motorized", "motorized", "motorized_edges"))
    for part in (_of(mode, "total_impressions", f"{short}_total_impressions"), _of(mode, "avg_flow", f"{short}_avg_flow"),
                 _of(mode, "affected_corridors", count))
)


def oracle_sql() -> dict[str, str]:
    s = statement
    station = ("SELECT fk_standort, hour, " + ", ".join(
        f"round({c}, 6) AS {c}" for c in ("velo_in", "velo_out", "fuss_in", "fuss_out", "velo_hour", "fuss_hour", "velo_in_share",
                                          "velo_out_share", "fuss_in_share", "fuss_out_share", "ost", "nord")) + " FROM ")
    period = """
      SELECT {key}, period, {fold}({flow}) AS {flow} FROM {table} JOIN
        (VALUES ('morning', 6, 10), ('midday', 11, 15), ('evening', 16, 20), ('whole_day', 0, 23)) p(period, a, b)
        ON hour BETWEEN a AND b GROUP BY {key}, period"""
    return {
        "conform_counts": s(
            "SELECT id, msid, richtung, cars AS anz_fahrzeuge, e AS ekoord, n AS nkoord, hour, round(lon, 8) AS lon,"
            " round(lat, 8) AS lat FROM car_clean"),
        "typical_day_cars": s(
            "SELECT msid, richtung, hour, round(flow_value, 6) AS flow_value, round(lon, 8) AS lon, round(lat, 8) AS lat,"
            " msname, zsname, achse FROM car_profile"),
        **{f"station_hour_{how}": s(station + f"station_hours_{how}") for how in ("mean", "sum", "median")},
        "classify_direction": s(
            "SELECT id, CASE WHEN richtung = ' Einwärts' THEN 'in' WHEN richtung = 'auswaerts' THEN 'out' ELSE 'label' END"
            " AS richtung_typ FROM counts_cars"),
        "label_bearing": s("SELECT c.id, h.bearing FROM counts_cars c LEFT JOIN label_hits h ON h.richtung = c.richtung"),
        "seed_bearing": s("SELECT msid, richtung, hour, richtung_typ, round(bearing_seed, 6) AS bearing_seed FROM car_seeds"),
        "direction_weights": s(f"""
          SELECT u, v, key, round(wide, 6) AS wide_arc, round(narrow, 6) AS narrow_arc,
                 round(greatest(0.0, 1 - wide / 135.0), 6) AS linear_weight,
                 round(CASE WHEN narrow IS NULL THEN 1.0 WHEN narrow >= 90 THEN 0 ELSE pow(1 - narrow / 90.0, 2) END, 6) AS bike_weight,
                 round(CASE WHEN narrow IS NULL THEN 1.0 WHEN narrow >= 120 THEN 0 ELSE 1 - narrow / 120.0 END, 6) AS ped_weight,
                 ({COMFORT_BIKE})::DOUBLE AS bike_comfort, ({COMFORT_PED})::DOUBLE AS ped_comfort,
                 round(1000 * pow(0.985, e.length / 100), 6) AS car_decay, round(1000 * exp(-0.0015 * e.length), 6) AS bike_decay
          FROM (SELECT *, coalesce({arc('bearing', '((u * 37) % 360)')}, 180) AS wide, {arc('bearing', '((u * 37) % 360)')} AS narrow
                FROM net_edges) e"""),
        "lv95_to_wgs84": s(f"""
          SELECT node_id, round(lon, 8) AS lon, round(lat, 8) AS lat, round({east('lon', 'lat')}, 4) AS east,
                 round({north('lon', 'lat')}, 4) AS north
          FROM (SELECT node_id, {lon('x', 'y')} AS lon, {lat('x', 'y')} AS lat FROM net_nodes)"""),
        "edge_bearings": s(f"""
          SELECT u, v, key, CASE WHEN u <> v THEN round(fmod(degrees(atan2(sin(dl) * cos(p2), cos(p1) * sin(p2) - sin(p1) * cos(p2) * cos(dl)))
                 + 360.0, 360.0), 5) END AS bearing
          FROM (SELECT u, v, key, radians({lat('x1', 'y1')}) AS p1, radians({lat('x2', 'y2')}) AS p2,
                       radians({lon('x2', 'y2')} - {lon('x1', 'y1')}) AS dl FROM net_edges)"""),
        "visibility_quads": s(
            "SELECT objectid, pos::INT AS pos, k::INT AS k, round(x, 4) AS x, round(y, 4) AS y FROM quad_corners"),
        "visibility_centroid": s(
            "SELECT objectid, round(x_lon_center, 7) AS x_lon_center, round(y_lat_centre, 7) AS y_lat_centre FROM centroids"),
        "edge_ids": s("SELECT edge_id, u, v, key FROM net_edges"),
        "flow_edge_ids": s("SELECT edge_id, hour, flow FROM flows_bike"),
        "time_of_day_buckets": s(
            "SELECT edge_id, period, total_flow, round(0.2 + 3.0 * total_flow / max(total_flow) OVER (), 6) AS weight FROM per",
            per=period.format(key="edge_id", fold="sum", flow="total_flow", table="flows_cars")),
        "time_of_day_means": s(
            "SELECT edge_id, period, round(total_flow, 6) AS total_flow FROM per",
            per=period.format(key="edge_id", fold="avg", flow="total_flow", table="flows_cars")),
        "transit_time_of_day": s(
            "SELECT edge_id, period, flow_besetzung, round(0.3 + 3.5 * flow_besetzung / max(flow_besetzung) OVER (), 6) AS weight FROM per",
            keyed="SELECT haltestellen_id || '_' || nach_hst_id AS edge_id, hour, flow_besetzung FROM flows_transit",
            per=period.format(key="edge_id", fold="sum", flow="flow_besetzung", table="keyed")),
        "incremental_pull": s(
            "SELECT * FROM counts_cars WHERE messung_dat_zeit LIKE '2024-%' AND (messung_dat_zeit > '2024-01-15T12:00:00'"
            " OR (messung_dat_zeit = '2024-01-15T12:00:00' AND id > 1000))"),
        "next_watermark": s(
            "SELECT messung_dat_zeit[:19] AS last_ts, id AS last_id FROM counts_cars ORDER BY 1 DESC, 2 DESC LIMIT 1"),
        "landing_by_day": s(
            "SELECT datum[:10] AS date, count(*) AS records_fetched FROM counts_pedbike WHERE datum >= '2024-01-01'"
            " AND datum < '2024-02-01' GROUP BY 1"),
        "upsert_month": s(
            "SELECT id, messung_dat_zeit, msid, CASE WHEN richtung = 'Oerlikon' THEN 'corrected' ELSE anz_fahrzeuge END"
            " AS anz_fahrzeuge FROM counts_cars WHERE messung_dat_zeit[:7] IN"
            " (SELECT messung_dat_zeit[:7] FROM counts_cars WHERE richtung = 'Oerlikon')"),
        "audit_summary": """
          SELECT strftime(ts, '%Y-%m-%d') AS run_id, count(*) AS units_total,
                 count(*) FILTER (event_type = 'view') AS units_success,
                 count(*) FILTER (event_type IN ('click', 'signup', 'purchase')) AS units_no_new_data,
                 count(*) FILTER (event_type = 'error') AS units_failed, sum(floor(value))::BIGINT AS records,
                 CASE WHEN count(*) FILTER (event_type = 'error') = 0 THEN 'success' ELSE 'partial' END AS status
          FROM events GROUP BY 1""",
        "table_fingerprint": """
          WITH d AS (SELECT sha256(concat_ws(chr(31), coalesce('=' || o_orderkey::VARCHAR, '-'), coalesce('=' || o_custkey::VARCHAR, '-'),
                       coalesce('=' || o_orderstatus, '-'), coalesce('=' || round(o_totalprice * 100)::BIGINT::VARCHAR, '-'),
                       coalesce('=' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), '-'), coalesce('=' || o_orderpriority, '-'))) AS h FROM orders)
          SELECT count(*) AS n_rows, sha256(concat_ws('-', count(*)::VARCHAR, """ + ", ".join(
            f"sum(('0x' || h[{8 * i + 1}:{8 * i + 8}])::BIGINT)::VARCHAR" for i in range(8)) + ")) AS sha256 FROM d",
        "stream_hourly_counts": """
          SELECT date_trunc('hour', ts) AS hour_start, user_id AS msid, round(avg(value), 6) AS mean_flow, count(value) AS n
          FROM events GROUP BY 1, 2""",
        "stream_deduped": "SELECT event_id AS id, ts, user_id AS msid, value AS flow FROM events",
        "nearest_edge_ties": s("SELECT fk_standort, u, v, key, round(dist, 4) AS dist FROM station_snaps"),
        "nearest_edge_crowded": s(
            "SELECT DISTINCT fk_standort, u, v, key, round(sqrt(d), 4) AS dist FROM crowd_snaps WHERE d = best",
            crowd_segments="SELECT u, v, key, x1, y1, x2, y2 FROM net_segments UNION ALL SELECT -o_orderkey, -1, 0,"
            " 2676100.0::DOUBLE + (o_orderkey * 7 % 10007) / 10007.0::DOUBLE, 1241100.0::DOUBLE + (o_orderkey * 13 % 10007) / 10007.0::DOUBLE,"
            " 2676100.0::DOUBLE + (o_orderkey * 17 % 10007) / 10007.0::DOUBLE, 1241100.0::DOUBLE + (o_orderkey * 29 % 10007) / 10007.0::DOUBLE FROM orders",
            crowd_snaps=f"SELECT *, min(d) OVER (PARTITION BY fk_standort) AS best FROM (SELECT p.fk_standort, s.u, s.v, s.key,"
            f" round({d2('p.ost', 'p.nord')}, 6) AS d FROM pedbike_places p CROSS JOIN crowd_segments s"
            " WHERE p.ost IS NOT NULL AND p.nord IS NOT NULL)"),
        "nearest_edge_one": s(
            "SELECT msid, richtung, hour, u, v, key, round(dist, 4) AS dist, start_node FROM car_starts"),
        "nearest_node": s("SELECT haltestellen_id, node_id FROM stop_nodes"),
        "spatial_intersects": s("SELECT objectid, edge_id FROM road_hits"),
        "propagate_bike": s("SELECT u, v, key, hour, round(flow, 4) AS flow FROM path_sum", flow_rows=BIKE_ROWS, path_sum=PATH_SUM),
        "propagate_ped": s("SELECT u, v, key, hour, round(flow, 4) AS flow FROM path_sum", flow_rows=PED_ROWS, path_sum=PATH_SUM),
        "bike_flows": _path_gold(BIKE_ROWS),
        "ped_flows": _path_gold(PED_ROWS),
        "propagate_cars": s("SELECT u, v, key, hour, round(total_flow, 4) AS total_flow FROM car_flow"),
        "car_flows": s(
            "SELECT edge_id, hour, round(total_flow, 4) AS total_flow, round(total_flow / max(total_flow) OVER (PARTITION BY hour), 6)"
            " AS flow_norm FROM balanced",
            balanced="SELECT e.edge_id, f.hour, f.total_flow * t.want / sum(f.total_flow) OVER (PARTITION BY f.hour) AS total_flow"
                     " FROM car_flow f JOIN net_edges e USING (u, v, key) JOIN"
                     " (SELECT hour, sum(flow_value) AS want FROM car_starts GROUP BY hour) t ON t.hour = f.hour"),
        "mass_balance": s(
            "SELECT edge_id, hour, round(flow, 6) AS total_flow, round(coalesce(flow / nullif(max(flow) OVER (PARTITION BY hour), 0), 0), 6)"
            " AS flow_norm FROM scaled",
            scaled="SELECT f.edge_id, f.hour, f.total_flow * coalesce(p.want, 0) / sum(f.total_flow) OVER (PARTITION BY f.hour) AS flow"
                   " FROM flows_cars f JOIN (SELECT hour, sum(flow_value) AS want FROM car_profile GROUP BY hour) p ON p.hour = f.hour"),
        "shortest_paths": s("SELECT src, dst, pos, node, round(length, 4) AS length FROM walked"),
        "transit_segment_hour": s("SELECT * FROM segment_hours"),
        "transit_segment_daily": s(
            "SELECT haltestellen_id, nach_hst_id, sum(flow_besetzung) AS flow_besetzung, sum(n_runs)::BIGINT AS n_runs"
            " FROM segment_hours GROUP BY 1, 2"),
        "transit_flows": s(
            "SELECT h.haltestellen_id, h.nach_hst_id, sum(h.flow_besetzung) AS flow_besetzung, sum(h.n_runs)::BIGINT AS n_runs,"
            " max(w.n)::INT AS n_vertices, round(max(w.length), 4) AS length FROM segment_hours h"
            " JOIN stop_pairs p USING (haltestellen_id, nach_hst_id)"
            " JOIN (SELECT src, dst, count(*) AS n, max(length) AS length FROM walked GROUP BY src, dst) w"
            "   ON w.src = p.src AND w.dst = p.dst GROUP BY 1, 2"),
        "stop_match": s(
            "SELECT haltestellen_id, name_norm, round(stop_lat, 8) AS stop_lat, round(stop_lon, 8) AS stop_lon FROM matched_stops"),
        "stop_coverage": s(
            "SELECT count(*) AS n_stops, round(avg((stop_lat IS NOT NULL)::INT) * 100, 6) AS coverage_pct FROM matched_stops"),
        "extent_clip": s("SELECT u, v, key FROM near_edges"),
        **{f"impressions_{m}": _impressions(m) for m in ("transit", "bike", "pedestrian", "motorized")},
        "impressions_all": _impressions(None),
        "impressions_summary": s(
            "SELECT f.gwr_egid, f.objectid, f.bezeichnung, round(b.lon, 6) AS longitude, round(b.lat, 6) AS latitude, t.* EXCLUDE (objectid)"
            " FROM totals t JOIN frontage_list f USING (objectid) JOIN buildings b USING (gwr_egid)",
            totals=f"SELECT objectid, {SUMMARY}, sum(total_impressions) AS total_all_impressions FROM impressions GROUP BY objectid",
            buildings="SELECT gwr_egid, arg_min(x_lon_center, objectid) AS lon, arg_min(y_lat_centre, objectid) AS lat"
                      " FROM frontage_list JOIN centroids USING (objectid) GROUP BY gwr_egid"),
        # what is published gives the summary again; of the second release six tables break a rule
        "released_summary": s(
            "SELECT f.gwr_egid, f.objectid, f.bezeichnung, round(b.lon, 6) AS longitude, round(b.lat, 6) AS latitude, t.* EXCLUDE (objectid),"
            " 'v1' AS released, 'bike_edges,bike_flows,motorized_traffic_edges,motorized_traffic_flows,ped_edges,ped_flows' AS refused"
            " FROM totals t JOIN frontage_list f USING (objectid) JOIN buildings b USING (gwr_egid)",
            totals=f"SELECT objectid, {SUMMARY}, sum(total_impressions) AS total_all_impressions FROM impressions GROUP BY objectid",
            buildings="SELECT gwr_egid, arg_min(x_lon_center, objectid) AS lon, arg_min(y_lat_centre, objectid) AS lat"
                      " FROM frontage_list JOIN centroids USING (objectid) GROUP BY gwr_egid"),
        "envelope_landing": """
          WITH e AS (SELECT *, user_id % 7 = 0 AS cut_off, event_id % 11 = 0 AS undated FROM events)
          SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n, sum(round(value * 100)::BIGINT)::BIGINT AS cents,
                 (SELECT count(DISTINCT (user_id, ts::DATE)) FROM e WHERE cut_off) AS broken,
                 (SELECT count(*) FROM e WHERE NOT cut_off AND undated) AS undated,
                 (SELECT count(DISTINCT (user_id, ts::DATE)) FROM e) AS documents,
                 (SELECT count(*) FROM e WHERE NOT cut_off) AS records
          FROM e WHERE NOT cut_off AND NOT undated GROUP BY 1""",
        "partition_refresh": """
          WITH o AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, round(o_totalprice * 100)::BIGINT AS cents FROM orders),
               m AS (SELECT month, count(*) AS n, sum(cents) AS cents FROM o GROUP BY 1),
               e AS (SELECT min(month) AS lo, max(month) AS hi, sum(n) AS n FROM m)
          SELECT month, CASE WHEN month = hi THEN 0 ELSE m.n END AS n_rows,
                 CASE month WHEN hi THEN 'gone' WHEN lo THEN 'changed' ELSE 'same' END AS action,
                 (CASE month WHEN hi THEN NULL WHEN lo THEN cents + m.n ELSE cents END)::BIGINT AS cents, 1::BIGINT AS idle_runs,
                 (e.n + (SELECT n FROM m WHERE month = lo))::BIGINT AS rows_written
          FROM m CROSS JOIN e""",
        "summary_check": s(
            "SELECT count(*) AS row_count, count(*) FILTER (total > 0) AS with_data FROM"
            " (SELECT objectid, sum(total_impressions) AS total FROM impressions GROUP BY objectid)"),
        "gold_checks": s("""
          SELECT 'frontage_visibility' AS table_name, (SELECT count(*) FROM centroids) AS n_rows, 0::BIGINT AS repeated, 0::BIGINT AS nulls, 0::BIGINT AS orphans
          UNION ALL SELECT t, n, r, g, 0 FROM (VALUES ('bike_edges'), ('ped_edges'), ('motorized_traffic_edges')) v(t),
            (SELECT count(*) + count(*) FILTER (edge_id % 10 = 0) AS n, count(*) FILTER (edge_id % 10 = 0) AS r,
                    count(*) FILTER (edge_id % 13 = 0) + count(*) FILTER (edge_id % 130 = 0) AS g FROM net_edges)
          UNION ALL SELECT t, count(*) + count(*) FILTER (edge_id % 10 = 0), count(*) FILTER (edge_id % 10 = 0), 0,
            count(*) FILTER (edge_id % 17 = 0) + count(*) FILTER (edge_id % 170 = 0)
            FROM (SELECT 'bike_flows' AS t, edge_id FROM flows_bike UNION ALL SELECT 'ped_flows', edge_id FROM flows_ped
                  UNION ALL SELECT 'motorized_traffic_flows', edge_id FROM flows_cars) GROUP BY t
          UNION ALL SELECT 'transit_flows_hourly', (SELECT count(*) FROM flows_transit), 0, 0, 0"""),
        "snap_stats": s("""
          SELECT count(dist) AS n, round(avg(dist), 4) AS mean, round(stddev(dist), 4) AS std, round(min(dist), 4) AS min,
                 round(quantile_cont(dist, 0.25), 4) AS q25, round(quantile_cont(dist, 0.5), 4) AS q50,
                 round(quantile_cont(dist, 0.75), 4) AS q75, round(max(dist), 4) AS max FROM car_starts"""),
        "direction_counts": s("SELECT richtung_typ, count(*) AS n FROM car_seeds GROUP BY 1"),
        "publish_gold": s("""
          SELECT 'frontage_visibility' AS table_name, (SELECT count(*) FROM centroids) AS n_rows, 0::BIGINT AS repeated, 0::BIGINT AS nulls, 0::BIGINT AS orphans
          UNION ALL SELECT t, n, r, g, 0 FROM (VALUES ('bike_edges'), ('ped_edges'), ('motorized_traffic_edges')) v(t),
            (SELECT count(*) + count(*) FILTER (edge_id % 10 = 0) AS n, count(*) FILTER (edge_id % 10 = 0) AS r,
                    count(*) FILTER (edge_id % 13 = 0) + count(*) FILTER (edge_id % 130 = 0) AS g FROM net_edges)
          UNION ALL SELECT t, count(*) + count(*) FILTER (edge_id % 10 = 0), count(*) FILTER (edge_id % 10 = 0), 0,
            count(*) FILTER (edge_id % 17 = 0) + count(*) FILTER (edge_id % 170 = 0)
            FROM (SELECT 'bike_flows' AS t, edge_id FROM flows_bike UNION ALL SELECT 'ped_flows', edge_id FROM flows_ped
                  UNION ALL SELECT 'motorized_traffic_flows', edge_id FROM flows_cars) GROUP BY t
          UNION ALL SELECT 'transit_flows_hourly', (SELECT count(*) FROM flows_transit), 0, 0, 0"""),
        "landed_days": s(
            "SELECT datum[1:4]::INT AS year, datum[6:7]::INT AS month, datum[9:10]::INT AS day, count(*) AS n FROM counts_pedbike"
            " WHERE datum >= '2024-01-01' AND datum < '2024-02-01' GROUP BY 1, 2, 3"),
        "named_files": "SELECT * FROM supplier",
        "csv_tables": "SELECT s_suppkey AS haltestellen_id, s_name || CASE s_nationkey % 3 WHEN 0 THEN ' (Stadt Zürich)'"
                      " WHEN 1 THEN ' (Zürich)' ELSE ' ' END AS haltestellenlangname FROM supplier",
        "network_core": s(
            "SELECT node, node IN (SELECT node FROM core_ahead) AS reached, node IN (SELECT node FROM core_behind) AS reaches"
            " FROM street_nodes", **CORE_VIEWS),
        "network_extent": s(
            "SELECT min(least(x1, x2)) AS min_x, min(least(y1, y2)) AS min_y, max(greatest(x1, x2)) AS max_x,"
            " max(greatest(y1, y2)) AS max_y FROM net_segments"),
        # a ring of five vertices takes 93 bytes, a multi-polygon nine more
        "visibility_gold": s(
            "SELECT objectid, f.gwr_egid, f.bezeichnung, round(x_lon_center, 7) AS x_lon_center, round(y_lat_centre, 7) AS y_lat_centre,"
            " (CASE WHEN f.n > 1 THEN 9 ELSE 0 END + 93 * f.n)::INT AS n_bytes FROM centroids JOIN"
            " (SELECT objectid, gwr_egid, bezeichnung, count(*) AS n FROM quads GROUP BY ALL) f USING (objectid)"),
        "ingest_run": s(
            "SELECT id::VARCHAR AS id, t AS messung_dat_zeit, msid, anz_fahrzeuge, place, 1::BIGINT AS idle_runs, n AS arrived, n AS accounted"
            " FROM (SELECT *, CASE WHEN id % 389 = 0 THEN regexp_replace(messung_dat_zeit, '^2024-..', '2024-00') ELSE messung_dat_zeit END AS t,"
            " count(*) OVER () AS n FROM counts_cars WHERE messung_dat_zeit LIKE '2024-%')"
            " JOIN (VALUES ('raw'), ('months'), ('rejects')) AS p(place) ON place = 'raw' OR (place = 'rejects') = (t LIKE '2024-00-%')"),
        "stream_upsert": "SELECT event_id AS id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS messung_dat_zeit, user_id AS msid, value AS flow FROM events",
        "geometry_roundtrip": s(
            "SELECT u, v, key, x1, y1, x2, y2, CASE WHEN bent THEN 3 ELSE 2 END::INT AS n_vertices FROM net_edges"),
    }
