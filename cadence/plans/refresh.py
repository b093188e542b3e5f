"""Batch job: refresh the dimension tables (D1-D4) in the result sink.

Each table is conformed to its contract (decimals at the sink, defaults)
and replaces the previous version. Rows that break a NOT NULL rule of the
contract (e.g. a catalog track never played has no track name) are written
to ``<table>_rejects`` instead of being dropped silently; a repeated primary
key stops the job before the table is replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from cadence.operators import profiles
from cadence.operators.prepare import assert_unique
from cadence.schemas import CONTRACTS
from cadence.sources.sinks import conform, split_violations


def refresh_dimensions(sink, events: DataFrame, clean_catalog: DataFrame) -> dict[str, DataFrame]:
    """Write artists, albums, tracks and global_fallback_metrics; return the written frames."""
    return replace_tables(sink, {
        "artists": profiles.artist_profile(events, clean_catalog),
        "albums": profiles.album_dim(events),
        "tracks": profiles.track_profile(events, clean_catalog),
        "global_fallback_metrics": profiles.global_fallback(clean_catalog),
    })


def refresh_from_states(sink, states: DataFrame, clean_catalog: DataFrame) -> dict[str, DataFrame]:
    """:func:`refresh_dimensions` from merged partial states, without reading the plays again."""
    return replace_tables(sink, {
        "artists": profiles.artists_of_states(states, clean_catalog),
        "albums": profiles.albums_of_states(states),
        "tracks": profiles.tracks_of_states(states, clean_catalog),
        "global_fallback_metrics": profiles.global_fallback(clean_catalog),
    })


def replace_tables(sink, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    out = {}
    for name, df in tables.items():
        ok, rejects = split_violations(conform(df, name), name)
        if "key" in CONTRACTS[name]:
            assert_unique(ok, CONTRACTS[name]["key"])
        sink.write(ok, name)
        sink.write(rejects, f"{name}_rejects")
        out[name] = ok
    return out
