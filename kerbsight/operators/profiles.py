"""Typical-day profiles of counts and transit runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from kerbsight import schemas
from kerbsight.functions import cleaning, direction, geo
from kerbsight.operators.conform import conform
from kerbsight.session import cut


def _with_id(schema: T.StructType, raw: DataFrame) -> T.StructType:
    """The schema plus the record id, where the table has one."""
    return T.StructType([*schema.fields, T.StructField("id", T.LongType())]) if "id" in raw.columns else schema


def first_known(name: str, order: Column) -> Column:
    """First non-null value of a column in ``order``."""
    return F.min_by(F.col(name), F.when(F.col(name).isNotNull(), order))


# ----------------------------------------------------------------------------- cars
def clean_car_counts(raw: DataFrame) -> DataFrame:
    """Typed car counts with hour and WGS84 position; rows without time or place go."""
    keep = conform(raw, _with_id(schemas.CAR_COUNTS, raw))
    typed = keep.dropna(subset=["messung_dat_zeit", "ekoord", "nkoord"])
    return typed.withColumns({
        "hour": cleaning.hour_of("messung_dat_zeit"),
        "lon": geo.lv95_to_lon(F.col("ekoord"), F.col("nkoord")),
        "lat": geo.lv95_to_lat(F.col("ekoord"), F.col("nkoord")),
    })


def typical_day_cars(counts: DataFrame) -> DataFrame:
    """Mean flow per station, direction and hour, with the first known attributes."""
    order = F.struct(*(["messung_dat_zeit"] + (["id"] if "id" in counts.columns else [])))
    names = [c for c in ("msname", "zsname", "achse") if c in counts.columns]
    place = [c for c in ("lon", "lat", "ekoord", "nkoord") if c in counts.columns]
    # the cleaned table has no row without a place, so its parts come from one row
    return (
        counts.dropna(subset=["msid", "richtung", "hour"])
        .groupBy("msid", "richtung", "hour")
        .agg(
            F.avg("anz_fahrzeuge").alias("flow_value"),
            F.min_by(F.struct(*place), order).alias("_place"),
            *[first_known(c, order).alias(c) for c in names],
        )
        .select("msid", "richtung", "hour", "flow_value", "_place.*", *names)
    )


def car_seeds(profile: DataFrame) -> DataFrame:
    """Profile rows with a direction kind and a seed bearing; rows without one go."""
    label, lon, lat = F.col("richtung"), F.col("lon"), F.col("lat")
    return profile.withColumns({
        "richtung_typ": direction.direction_kind(label),
        "bearing_seed": direction.seed_bearing(label, lon, lat),
    }).dropna(subset=["bearing_seed"])


# --------------------------------------------------------------- bike and pedestrian
COUNT_COLUMNS = ["velo_in", "velo_out", "fuss_in", "fuss_out"]


def clean_pedbike_counts(raw: DataFrame) -> DataFrame:
    """Typed counts with hour; a missing or bad count is 0, a bad time drops the row."""
    schema = _with_id(schemas.PEDBIKE_COUNTS, raw)
    typed = conform(raw, schema, defaults={c: 0.0 for c in COUNT_COLUMNS}, required=("fk_standort",))
    return typed.dropna(subset=["datum"]).withColumn("hour", cleaning.hour_of("datum"))


def station_places(counts: DataFrame) -> DataFrame:
    """First known coordinates per station."""
    order = F.struct(*(["datum"] + (["id"] if "id" in counts.columns else [])))
    return counts.dropna(subset=["fk_standort"]).groupBy("fk_standort").agg(
        first_known("ost", order).alias("ost"), first_known("nord", order).alias("nord")
    )


def station_hours(counts: DataFrame, how: str = "mean") -> DataFrame:
    """Counts per station and hour (``mean``, ``sum`` or ``median`` over days), with
    totals, in/out shares and the station's place."""
    keyed = counts.dropna(subset=["fk_standort", "hour"])
    if how == "median":
        profile = exact_median(keyed, ["fk_standort", "hour"], COUNT_COLUMNS)
    elif how in ("mean", "sum"):
        fold = F.avg if how == "mean" else F.sum
        profile = keyed.groupBy("fk_standort", "hour").agg(*[fold(c).alias(c) for c in COUNT_COLUMNS])
    else:
        raise ValueError(f"unknown aggregation {how!r}")
    totals = profile.withColumns({
        "velo_hour": F.col("velo_in") + F.col("velo_out"), "fuss_hour": F.col("fuss_in") + F.col("fuss_out"),
    }).withColumns({
        "velo_in_share": cleaning.share("velo_in", "velo_hour"), "velo_out_share": cleaning.share("velo_out", "velo_hour"),
        "fuss_in_share": cleaning.share("fuss_in", "fuss_hour"), "fuss_out_share": cleaning.share("fuss_out", "fuss_hour"),
    })
    return totals.join(station_places(counts), "fk_standort", "left")


def exact_median(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Median per group and column, in one row per group."""
    found = exact_quantiles(df, keys, columns, {"median": 0.5})
    return found.groupBy(*keys).agg(*[
        F.max(F.when(F.col("name") == n, F.col("value"))).alias(n) for n in columns
    ])


def exact_quantiles(df: DataFrame, keys: list[str], columns: list[str], quantiles: dict[str, float]) -> DataFrame:
    """Interpolated quantiles per group without bringing a group into one task.

    Values are counted first, then twice more in bins: logarithmic ones, and equal
    ones within the bin that holds a wanted position. The bins are found from their
    sizes alone, whose number is bounded, and only the last small bin's distinct
    values are ordered. Result: ``keys, name, quantile, value``.
    """
    c = F.col
    by = [*keys, "name"]
    long = df.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(n).alias("name"), c(n).alias("_value")) for n in columns
    ])).alias("_c")).select(*keys, "_c.name", "_c._value").dropna(subset=["_value"])
    # written once: every later step starts from the distinct values, none from the rows
    counted = cut(long.groupBy(*by, "_value").agg(F.count(F.lit(1)).alias("_n")), "value-counts")

    wanted = F.explode(F.array(*[
        F.struct(F.lit(n).alias("quantile"), F.lit(float(q)).alias("_q")) for n, q in quantiles.items()
    ]))
    spot = c("_q") * (c("_size") - 1)
    targets = (
        counted.groupBy(*by).agg(F.sum("_n").alias("_size")).select("*", wanted.alias("_w")).select(*by, "_size", "_w.*")
        .select(*by, "quantile", F.lit(0).cast("bigint").alias("_before"), (F.floor(spot) + 1).alias("_low"),
                (F.ceil(spot) + 1).alias("_high"), (spot - F.floor(spot)).alias("_part"))
    )
    group = [*by, "quantile"]
    values = counted.join(targets, by)
    log_bin = F.floor(F.signum("_value") * F.log2(F.abs("_value") + 1) * 64)
    values = _holding_bins(values.withColumn("_bin", log_bin), group)
    even_bin = F.floor((c("_value") - c("_least")) / (c("_most") - c("_least")) * 4096)
    values = _holding_bins(values.withColumn("_bin", F.coalesce(F.when(c("_most") > c("_least"), even_bin), F.lit(0))), [*group, "_least"])
    # the low and the high position may lie in two neighbouring bins: keep the running count per bin
    in_bin = Window.partitionBy(*group, "_least").orderBy("_value").rowsBetween(Window.unboundedPreceding, -1)
    placed = values.withColumn("_start", c("_before") + F.coalesce(F.sum("_n").over(in_bin), F.lit(0)))

    def at(position: str) -> Column:
        hit = (c("_start") < c(position)) & (c("_start") + c("_n") >= c(position))
        return F.max(F.when(hit, c("_value")))

    found = placed.groupBy(*group).agg(at("_low").alias("_lo"), at("_high").alias("_hi"), F.max("_part").alias("_part"))
    return found.select(*group, (c("_lo") + (c("_hi") - c("_lo")) * c("_part")).alias("value"))


def _holding_bins(values: DataFrame, group: list[str]) -> DataFrame:
    """Keep the rows of the bins that hold a wanted position.

    ``_before`` counts the rows below the current range; ``_least`` and ``_most`` become
    the limits of each kept bin.
    """
    c = F.col
    fixed = ["_before", "_low", "_high", "_part"]
    sizes = values.groupBy(*group, *[f for f in fixed], "_bin").agg(
        F.sum("_n").alias("_size"), F.min("_value").alias("_from"), F.max("_value").alias("_to")
    )
    running = Window.partitionBy(*group).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    held = (
        sizes.withColumn("_under", c("_before") + F.coalesce(F.sum("_size").over(running), F.lit(0)))
        .filter((c("_under") < c("_high")) & (c("_under") + c("_size") >= c("_low")))
        .select(*group, "_bin", "_under", "_from", "_to")
    )
    kept = values.join(held, [*group, "_bin"])
    outer = [g for g in group if g != "_least"]
    return kept.select(
        *outer, "_value", "_n", c("_under").alias("_before"), "_low", "_high", "_part",
        c("_from").alias("_least"), c("_to").alias("_most"),
    )


# -------------------------------------------------------------------------- transit
def clean_transit_runs(raw: DataFrame) -> DataFrame:
    """Typed runs with the departure hour (-1 when it is no time of day)."""
    return conform(raw, schemas.TRANSIT_RUNS).withColumn("hour", cleaning.clock_hour("fz_ab"))


def weekday_runs(runs: DataFrame, day_types: DataFrame, wanted: str = "15-A1-24") -> DataFrame:
    """Runs whose day type name contains ``wanted``; the dimension is one row per day type."""
    if "tagtyp_id" not in runs.columns or "tagtyp_id" not in day_types.columns:
        raise ValueError("both tables need tagtyp_id")
    names = day_types.select(cleaning.whole_id("tagtyp_id").alias("tagtyp_id"), "tagtypname")
    return runs.join(names, "tagtyp_id", "left").filter(cleaning.has_day_type("tagtypname", wanted))


def segment_hours(runs: DataFrame) -> DataFrame:
    """Occupancy and number of distinct runs per stop pair and hour."""
    known = runs.dropna(subset=["haltestellen_id", "nach_hst_id"]).filter(F.col("hour") >= 0)
    return known.groupBy("haltestellen_id", "nach_hst_id", "hour").agg(
        F.coalesce(F.sum("besetzung"), F.lit(0.0)).alias("flow_besetzung"),
        F.count_distinct("plan_fahrt_id").alias("n_runs"),
    )


def segment_days(hourly: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Daily sums per stop pair; runs are the sum of the hourly run numbers."""
    return hourly.groupBy("haltestellen_id", "nach_hst_id").agg(
        F.sum("flow_besetzung").alias("flow_besetzung"), F.sum("n_runs").alias("n_runs"),
        *[F.min_by(F.col(c), F.col("hour")).alias(c) for c in carry or []],
    )


def match_stops(stops: DataFrame, feed_stops: DataFrame) -> DataFrame:
    """Stops with the mean position of the feed's stops of the same normalized name."""
    feed = (
        feed_stops.withColumn("name_norm", cleaning.stop_name("stop_name")).filter(F.col("stop_name").isNotNull())
        .groupBy("name_norm").agg(F.avg("stop_lat").alias("stop_lat"), F.avg("stop_lon").alias("stop_lon"))
    )
    named = stops.withColumn("name_norm", F.when(
        F.col("haltestellenlangname").isNotNull(), cleaning.stop_name("haltestellenlangname")
    ))
    return named.join(feed, "name_norm", "left")


def match_coverage(matched: DataFrame) -> DataFrame:
    """Number of stops and the percentage with a position."""
    return matched.agg(
        F.count(F.lit(1)).alias("n_stops"),
        (F.avg(F.col("stop_lat").isNotNull().cast("int")) * 100).alias("coverage_pct"),
    )


# -------------------------------------------------------------------- times of the day
# First and last hour of each period.
PERIODS = {"morning": (6, 10), "midday": (11, 15), "evening": (16, 20), "whole_day": (0, 23)}


def period_flows(flows: DataFrame, key: list[str], flow: str, how: str = "sum",
                 periods: dict[str, tuple[int, int]] = PERIODS) -> DataFrame:
    """Flow per edge and period, one row for each period the edge has hours in."""
    fold = {"sum": F.sum, "mean": F.avg}[how]
    wide = []
    for name, (first, last) in periods.items():
        inside = F.col("hour").between(first, last)
        total = fold(F.when(inside, F.col(flow)))
        total = F.coalesce(total, F.lit(0.0)) if how == "sum" else total
        wide.append(F.when(F.count_if(inside) > 0, F.struct(F.lit(name).alias("period"), total.alias(flow))).alias(name))
    grouped = flows.groupBy(*key).agg(*wide)
    return grouped.select(*key, F.explode(F.array_compact(F.array(*periods))).alias("_p")).select(*key, "_p.*")


def line_widths(by_period: DataFrame, flow: str, base: float = 0.2, extra: float = 3.0) -> DataFrame:
    """Relative weight ``base + extra * flow / max`` over all periods of the table."""
    top = by_period.agg(F.max(flow)).scalar()
    return by_period.withColumn("weight", F.lit(base) + F.lit(extra) * F.col(flow) / top)
