"""Panel queries (A7-A16, T1-T6, F17) over the enriched plays and the result tables.

Every panel takes ``minutes`` (lookback; ``None`` = all rows) and ``as_of``
(the anchor of the lookback, default: the session's current wall clock).
The lookback is a plain filter on the time column, so Catalyst pushes it to
the Parquet scan, and a table partitioned by date prunes whole folders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadence.functions import clip, lookback, mood_quadrant, skip_rate, truncate_second, weekday_label

DEFAULT_MINUTES = 30


def recent(df: DataFrame, ts: str, minutes: int | None, as_of: Column | None) -> DataFrame:
    """The lookback filter; on a date-partitioned result table also a ``dt`` bound that prunes folders."""
    if minutes is None:
        return df
    out = df.where(lookback(ts, minutes, as_of))
    if "dt" in df.columns:
        anchor = as_of if as_of is not None else F.localtimestamp()
        start = anchor - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(int(minutes)))
        out = out.where(F.col("dt") >= F.to_date(start))
    return out


def kpi(events: DataFrame, minutes: int | None = DEFAULT_MINUTES, as_of: Column | None = None) -> DataFrame:
    """One row — plays, average valence/energy/completion and skip rate."""
    e = recent(events, "timestamp", minutes, as_of)
    return e.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.avg("valence").alias("avg_valence"),
        F.avg("energy").alias("avg_energy"),
        F.avg("completion_rate").alias("avg_completion"),
        skip_rate("is_skip").alias("skip_rate"),
    )


def mood_timeline(mood_rows: DataFrame, minutes: int | None = DEFAULT_MINUTES,
                  as_of: Column | None = None) -> DataFrame:
    """Mood-metric rows inside the lookback, in time order."""
    m = recent(mood_rows, "window_start_time", minutes, as_of)
    return m.select("window_start_time", "avg_valence", "avg_energy", "total_streams").orderBy("window_start_time")


def heatmap(events: DataFrame, minutes: int | None = DEFAULT_MINUTES, as_of: Column | None = None) -> DataFrame:
    """Plays per (day_of_week, hour_of_day)."""
    e = recent(events, "timestamp", minutes, as_of)
    return e.groupBy("day_of_week", "hour_of_day").agg(F.count(F.lit(1)).alias("plays"))


HOUR_COLUMNS = [f"h{h:02d}" for h in range(24)]


def heatmap_grid(events: DataFrame, minutes: int | None = DEFAULT_MINUTES, as_of: Column | None = None) -> DataFrame:
    """Dense 7 x 24 grid, one row per weekday (1..7), columns h00..h23, zero where no plays.

    The pivot names its 24 values up front, so Spark needs no extra job to
    find them; the 7 weekdays come from a range joined to the (at most 7) pivot rows.
    """
    e = recent(events, "timestamp", minutes, as_of)
    spark: SparkSession = events.sparkSession
    piv = (e.groupBy("day_of_week").pivot("hour_of_day", list(range(24)))
           .agg(F.count(F.lit(1))))
    piv = piv.select("day_of_week", *[F.col(str(h)).alias(HOUR_COLUMNS[h]) for h in range(24)])
    days = spark.range(1, 8).select(F.col("id").cast("int").alias("day_of_week"))
    grid = days.join(piv, "day_of_week", "left")
    return grid.select(
        "day_of_week", weekday_label("day_of_week").alias("day_label"),
        *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in HOUR_COLUMNS],
    )


def skip_profile(events: DataFrame, minutes: int | None = DEFAULT_MINUTES, as_of: Column | None = None) -> DataFrame:
    """A10: per hour: danceability and acousticness of skipped vs kept plays, and skip rate."""
    e = recent(events, "timestamp", minutes, as_of)
    s = F.col("is_skip")
    return (e.groupBy("hour_of_day").agg(
        F.avg(F.when(s, F.col("danceability"))).alias("skip_danceability"),
        F.avg(F.when(~s, F.col("danceability"))).alias("keep_danceability"),
        F.avg(F.when(s, F.col("acousticness"))).alias("skip_acousticness"),
        F.avg(F.when(~s, F.col("acousticness"))).alias("keep_acousticness"),
        skip_rate("is_skip").alias("skip_rate"),
    ).orderBy("hour_of_day"))


def completion_by_hour(events: DataFrame, minutes: int | None = DEFAULT_MINUTES,
                       as_of: Column | None = None) -> DataFrame:
    """Per hour: average completion and number of plays."""
    e = recent(events, "timestamp", minutes, as_of)
    return (e.groupBy("hour_of_day")
            .agg(F.avg("completion_rate").alias("avg_completion"), F.count(F.lit(1)).alias("n"))
            .orderBy("hour_of_day"))


def artist_engagement(events: DataFrame, minutes: int | None = DEFAULT_MINUTES, as_of: Column | None = None,
                      min_plays: int = 1) -> DataFrame:
    """A12 before ranking: per artist: completion, skip rate, plays and likeability."""
    e = recent(events, "timestamp", minutes, as_of).where(F.col("artist_name").isNotNull())
    g = e.groupBy("artist_name").agg(
        F.avg("completion_rate").alias("avg_completion"),
        skip_rate("is_skip").alias("skip_rate"),
        F.count(F.lit(1)).alias("plays"),
    ).where(F.col("plays") >= min_plays)
    return g.withColumn("likeability", clip(F.col("avg_completion") - F.col("skip_rate")))


def likeability(events: DataFrame, minutes: int | None = DEFAULT_MINUTES, as_of: Column | None = None,
                k: int = 10, min_plays: int = 1) -> DataFrame:
    """A12 + T2: the ``k`` most liked artists (ties by name), shown in ascending order."""
    g = artist_engagement(events, minutes, as_of, min_plays)
    top = g.orderBy(F.col("likeability").desc(), F.col("artist_name")).limit(k)
    return top.orderBy("likeability", "artist_name")


def nostalgia(events: DataFrame, minutes: int | None = DEFAULT_MINUTES, as_of: Column | None = None,
              min_year: int = 1950) -> DataFrame:
    """Plays per release year after ``min_year``."""
    e = recent(events, "timestamp", minutes, as_of).where(F.col("year") > min_year)
    return e.groupBy("year").agg(F.count(F.lit(1)).alias("plays")).orderBy("year")


def top_tracks(leaderboard_rows: DataFrame, minutes: int | None = DEFAULT_MINUTES, as_of: Column | None = None,
               n: int = 10) -> DataFrame:
    """A14 + T1: per-batch play counts summed by (track, artist); the ``n`` most played.

    This is the final step of a two-level aggregation: each batch row is a
    partial count, and the sum merges them. Ties are broken by name.
    """
    lb = recent(leaderboard_rows, "window_start_time", minutes, as_of)
    g = lb.groupBy("track_name", "artist_name").agg(F.sum("play_count").alias("plays"))
    return g.orderBy(F.col("plays").desc(), "track_name", "artist_name").limit(n)


def events_per_second(events: DataFrame, minutes: int | None = 2, as_of: Column | None = None) -> DataFrame:
    """Plays per wall-clock second inside the lookback (default two minutes)."""
    e = recent(events, "timestamp", minutes, as_of)
    return (e.groupBy(truncate_second("timestamp").alias("sec"))
            .agg(F.count(F.lit(1)).alias("events")).orderBy("sec"))


def current_rate(eps: DataFrame, last: int = 5) -> DataFrame:
    """Mean of the last ``last`` seconds that had plays (empty seconds are not zeros); 0 when none."""
    tail = eps.orderBy(F.col("sec").desc()).limit(last)
    return tail.agg(F.coalesce(F.avg("events"), F.lit(0.0)).alias("current_rate"))


def newest_days(rows: DataFrame, n: int) -> DataFrame:
    """Of a table in ``dt`` folders, the newest days that hold ``n`` rows (all days, and rows of none, if there are fewer).

    The rows of a day are counted without reading a column (a Parquet file's footer knows them), and
    the first day that is needed reaches the scan as a subquery in its partition filter: older
    folders aren't read. One row per day goes through the window.
    """
    days = rows.where(F.col("dt").isNotNull()).groupBy("dt").agg(F.count(F.lit(1)).alias("_rows"))
    so_far = F.sum("_rows").over(Window.orderBy(F.col("dt").desc()))
    first = days.select("dt", so_far.alias("_so_far")).where(F.col("_so_far") >= n).agg(F.max("dt"))
    never = F.lit("0001-01-01").cast("date")
    return rows.where(F.coalesce("dt", never) >= F.coalesce(first.scalar(), never))


def mood_scatter(samples: DataFrame, minutes: int | None = DEFAULT_MINUTES, as_of: Column | None = None,
                 n: int = 3000) -> DataFrame:
    """The ``n`` newest scatter points (ties broken by every shown column)."""
    s = recent(samples, "timestamp", minutes, as_of)
    if "dt" in s.columns:
        s = newest_days(s, n)
    return (s.select("timestamp", "artist_name", "valence", "energy")
            .orderBy(F.col("timestamp").desc(), "artist_name", "valence", "energy").limit(n))


def mood_quadrants(events: DataFrame, minutes: int | None = DEFAULT_MINUTES, as_of: Column | None = None) -> DataFrame:
    """plays and average valence/energy per mood quadrant."""
    e = recent(events, "timestamp", minutes, as_of)
    return (e.groupBy(mood_quadrant("valence", "energy").alias("quadrant"))
            .agg(F.count(F.lit(1)).alias("plays"), F.avg("valence").alias("avg_valence"),
                 F.avg("energy").alias("avg_energy")))


__all__ = [
    "kpi", "mood_timeline", "heatmap", "heatmap_grid", "skip_profile", "completion_by_hour",
    "artist_engagement", "likeability", "nostalgia", "top_tracks", "events_per_second",
    "current_rate", "mood_scatter", "mood_quadrants", "newest_days", "recent",
]
