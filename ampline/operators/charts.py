"""Chart-ready tables of ignition events and charging sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampline.config import Params
from ampline.operators.ranking import numbered, quantiles


def ignition_timeline(ignition: DataFrame) -> DataFrame:
    """Event points with the vehicle's line number (vehicles in sorted order)."""
    lines = numbered(ignition.select("vehicle_id").distinct(), ["vehicle_id"], "vehicle_index")
    return ignition.join(lines, "vehicle_id").select("event_ts", "vehicle_id", "vehicle_index", "event")


def _minutes(sessions: DataFrame) -> DataFrame:
    return sessions.selectExpr("duration_sec / 60 as minutes")


def duration_hist(sessions: DataFrame, p: Params) -> DataFrame:
    """Equal-width bins over the range; the last bin holds its right edge; empty bins stay."""
    minutes = _minutes(sessions)
    # One row, read as scalar subqueries; a single value gets a range of one around it.
    limits = minutes.selectExpr("min(minutes) as a", "max(minutes) as b").where("a is not null").selectExpr(
        "if(a = b, a - 0.5D, a) as lo", "if(a = b, b + 0.5D, b) as hi"
    )
    last = p.hist_bins - 1
    place = F.width_bucket("minutes", limits.select("lo").scalar(), limits.select("hi").scalar(), F.lit(p.hist_bins))
    counts = (
        minutes.select(place.alias("place")).selectExpr(f"cast(least(place - 1, {last}) as int) as bin")
        .groupBy("bin").agg(F.expr("count(*) as n"))
    )
    bins = limits.selectExpr("lo", f"(hi - lo) / {p.hist_bins} as step", f"explode(sequence(0, {last})) as bin")
    return bins.join(counts, "bin", "left").selectExpr(
        "bin", "lo + bin * step as bin_start", "lo + (bin + 1) * step as bin_end", "coalesce(n, 0L) as n"
    )


def duration_kde(sessions: DataFrame, p: Params) -> DataFrame:
    """Gaussian density on an even grid, scaled to the histogram's area."""
    minutes = _minutes(sessions)
    last = p.kde_points - 1
    stats = minutes.selectExpr(
        "min(minutes) as lo", "max(minutes) as hi", "count(minutes) as n", "stddev_samp(minutes) as sd"
    ).where("n >= 2 and sd > 0").selectExpr(
        f"struct(lo, (hi - lo) / {last} as step, sd * power(n, -0.2D) as width, (hi - lo) / {p.hist_bins} as bin) as s"
    )
    s = stats.scalar()
    return (
        minutes.groupBy("minutes").agg(F.expr("count(*) as copies"))
        .withColumn("s", s).where("s is not null")
        .selectExpr("minutes", "copies", "s", f"explode(sequence(0, {last})) as i")
        .selectExpr("i", "copies * exp(-0.5D * power((s.lo + i * s.step - minutes) / s.width, 2)) as kernel")
        .groupBy("i").agg(F.expr("sum(kernel) as kernels"))
        .withColumn("s", s)
        .selectExpr(
            "i", "s.lo + i * s.step as x", "kernels / (s.width * sqrt(2 * pi())) * s.bin as density"
        )
    )


def _quartiles(rows: DataFrame, column: str, reach: float) -> DataFrame:
    return quantiles(rows, column, [0.25, 0.5, 0.75]).selectExpr(
        "q[0] as q1", "q[1] as median", "q[2] as q3", f"{reach}D * (q[2] - q[0]) as reach"
    )


def _outside(rows: DataFrame, column: str, q: DataFrame) -> DataFrame:
    fences = q.selectExpr("struct(q1 - reach as low, q3 + reach as high) as fences")
    return rows.withColumn("fences", fences.scalar()).selectExpr(
        "*", f"{column} < fences.low or {column} > fences.high as outside"
    )


def box(rows: DataFrame, column: str, reach: float = 1.5) -> DataFrame:
    """Median, quartiles, whiskers at the outermost values within ``reach`` quartile ranges."""
    quartiles = _quartiles(rows, column, reach)
    return (
        _outside(rows, column, quartiles)
        .selectExpr(
            f"min(if(outside, null, {column})) as whisker_low", f"max(if(outside, null, {column})) as whisker_high", "count(*) as n"
        )
        .where("n > 0").withColumn("q", quartiles.selectExpr("struct(q1, median, q3) as q").scalar())
        .selectExpr("q.q1", "q.median", "q.q3", "whisker_low", "whisker_high", "n")
    )


def outliers(rows: DataFrame, column: str, reach: float = 1.5) -> DataFrame:
    """The rows beyond the whiskers."""
    return _outside(rows, column, _quartiles(rows, column, reach)).where("outside").drop("fences", "outside")


def gain_box(sessions: DataFrame) -> DataFrame:
    return box(sessions, "delta_battery_pct")


def gain_outliers(sessions: DataFrame, reach: float = 1.5) -> DataFrame:
    return outliers(sessions, "delta_battery_pct", reach).select("vehicle_id", "start_ts", "delta_battery_pct")


def duration_outliers(sessions: DataFrame) -> DataFrame:
    return outliers(sessions, "duration_sec").select("vehicle_id", "start_ts", "duration_sec")


def sessions_per_vehicle(sessions: DataFrame) -> DataFrame:
    return sessions.groupBy("vehicle_id").agg(F.expr("count(*) as n_sessions")).orderBy(
        F.desc("n_sessions"), "vehicle_id"
    )


def duration_vs_gain(sessions: DataFrame) -> DataFrame:
    return sessions.selectExpr("vehicle_id", "duration_sec / 60 as duration_min", "delta_battery_pct")


def hour_heatmap(sessions: DataFrame) -> DataFrame:
    """Sessions by vehicle and start hour, all 24 hours as columns h00 … h23."""
    hours = list(range(24))
    counts = sessions.selectExpr("vehicle_id", "hour(start_ts) as hour").groupBy("vehicle_id").pivot("hour", hours).count()
    return counts.selectExpr("vehicle_id", *[f"coalesce(`{h}`, 0L) as h{h:02d}" for h in hours])


def _points(sessions: DataFrame) -> DataFrame:
    point = lambda end: f"struct({end}_ts as ts, {end}_battery_pct as battery)"
    return sessions.selectExpr("vehicle_id", f"inline(array({point('start')}, {point('end')}))")


def battery_points(sessions: DataFrame) -> DataFrame:
    """Start and end level of each session, in time order."""
    return _points(sessions).orderBy("ts", "vehicle_id")


def battery_line(sessions: DataFrame) -> DataFrame:
    """Mean level per vehicle and time."""
    return _points(sessions).groupBy("vehicle_id", "ts").agg(F.expr("avg(battery) as battery"))


def chart_tables(results: dict[str, DataFrame], p: Params) -> dict[str, DataFrame]:
    """All chart tables that the result tables at hand allow, by name."""
    tables = {}
    if "IgnitionEvents" in results:
        tables["ignition_timeline"] = ignition_timeline(results["IgnitionEvents"])
    if "ChargingEvents" in results:
        sessions = results["ChargingEvents"]
        tables |= {
            "duration_hist": duration_hist(sessions, p), "duration_kde": duration_kde(sessions, p),
            "gain_box": gain_box(sessions), "gain_outliers": gain_outliers(sessions),
            "sessions_per_vehicle": sessions_per_vehicle(sessions), "duration_vs_gain": duration_vs_gain(sessions),
            "hour_heatmap": hour_heatmap(sessions), "battery_points": battery_points(sessions),
            "battery_line": battery_line(sessions),
        }
    return tables
