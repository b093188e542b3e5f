"""The dashboard's panels, read from the result tables the streaming job writes.

Each panel is one plan over one table: the lookback becomes a filter on
the table's time column plus a ``dt`` partition bound, so only the folders
of the window are read. Decimal columns (the sink's storage type) are read
back as doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadence.operators import panels


def as_doubles(df: DataFrame) -> DataFrame:
    """Decimal columns -> double (storage type -> in-flight type)."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
                       else F.col(f.name) for f in df.schema.fields])


def dashboard(spark: SparkSession, sink, minutes: int | None = panels.DEFAULT_MINUTES,
              as_of: Column | None = None, top_n: int = 10) -> dict[str, DataFrame]:
    """Every panel of the dashboard as a lazy DataFrame (nothing runs until one is acted on)."""
    events = as_doubles(sink.read(spark, "realtime_streaming_events"))
    mood = as_doubles(sink.read(spark, "realtime_mood_metrics"))
    samples = as_doubles(sink.read(spark, "mood_matrix_samples"))
    board = sink.read(spark, "realtime_leaderboard")
    eps = panels.events_per_second(events, minutes=2 if minutes is not None else None, as_of=as_of)
    return {
        "kpi": panels.kpi(events, minutes, as_of),
        "mood_timeline": panels.mood_timeline(mood, minutes, as_of),
        "heatmap": panels.heatmap(events, minutes, as_of),
        "heatmap_grid": panels.heatmap_grid(events, minutes, as_of),
        "skip_profile": panels.skip_profile(events, minutes, as_of),
        "completion_by_hour": panels.completion_by_hour(events, minutes, as_of),
        "likeability": panels.likeability(events, minutes, as_of),
        "mood_scatter": panels.mood_scatter(samples, minutes, as_of),
        "nostalgia": panels.nostalgia(events, minutes, as_of),
        "top_tracks": panels.top_tracks(board, minutes, as_of, n=top_n),
        "events_per_second": eps,
        "current_rate": panels.current_rate(eps),
    }
