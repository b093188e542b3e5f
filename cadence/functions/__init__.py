from cadence.functions.expressions import (  # noqa: F401
    clip,
    completion_rate,
    first_artist,
    format_ts,
    hour_of_day,
    instant_wallclock,
    is_skip,
    iso_weekday,
    lookback,
    mood_quadrant,
    normalized_artist,
    normalized_name,
    parse_ts,
    prefixed_key,
    present,
    ratio,
    read_ts,
    round4,
    skip_rate,
    to_json_row,
    truncate_second,
    truthy_text,
    wallclock_instant,
    weekday_label,
)
