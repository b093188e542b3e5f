"""Messages that a producer sent twice count once.

A producer that gets no answer sends its message again, so that one play stands in the log twice. Repeats come
soon after the first: the state holds a key of each message for a time after its arrival, and its size follows
the rate of messages. The watermark runs on the time of arrival, not on the play's own: no play is
late for it, whatever its ``ts``, and messages without a readable ``ts`` pass on to the quarantine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ARRIVAL, MESSAGE = "_arrival", "_message"


def drop_repeats(logs: DataFrame, within: str = "10 minutes", keys: list[str] | None = None, arrival: str | None = None) -> DataFrame:
    """``logs`` without the messages whose ``keys`` came in the time ``within`` before them.

    ``keys`` name what a message is known by (a message id, say); by default the whole text ``raw``, of which a
    128-bit digest is kept. ``arrival`` names the column of the time of arrival (the ``timestamp`` of a Kafka
    record); by default it is the time of the micro-batch. A null among the keys is a value like others.
    In batch the input is taken as one arrival.
    """
    columns = logs.columns
    text = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}) if keys else F.coalesce(F.col("raw"), F.lit(""))
    marked = logs.withColumn(MESSAGE, F.unhex(F.md5(text)))
    if not logs.isStreaming:
        return marked.dropDuplicates([MESSAGE]).select(*columns)
    at = F.col(arrival) if arrival else F.current_timestamp()
    return (marked.withColumn(ARRIVAL, at.cast("timestamp")).withWatermark(ARRIVAL, within)
            .dropDuplicatesWithinWatermark([MESSAGE]).select(*columns))
