"""Scalar column expressions.

All of them are built-in Catalyst expressions, so they run inside
whole-stage codegen on the executors; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed value that must equal the reference's for right results: mood
# quadrants split at valence 0.5 and energy 0.5.
QUADRANT_SPLIT = 0.5
# Labels of our own.
QUADRANT_LABELS = {
    "high_valence_high_energy": "energetic_happy",
    "low_valence_high_energy": "aggressive_tense",
    "high_valence_low_energy": "calm_happy",
    "low_valence_low_energy": "sad_still",
}
# Weekday labels for day_of_week 1..7 (Monday = 1).
WEEKDAY_LABELS = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
# ---------------------------------------------------------------------------


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Parts of a list literal, as Java patterns. A string may have the prefix u; strings beside each other are one.
_STRING = r"""[uU]?(?:'(?:[^'\\\n]++|\\.)*+'|"(?:[^"\\\n]++|\\.)*+")"""
_STRINGS = rf"(?s)(?:{_STRING}\s*)+"
_SCALAR = r"(?<![\w.])(?:None|True|False|[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)(?![\w.])"
_ESCAPE = r"(?s)\\(?:x[0-9a-fA-F]{2}|u[0-9a-fA-F]{4}|U[0-9a-fA-F]{8}|[0-7]{1,3}|.)|[^\\]+"
# Escapes that make the text no literal, or name what has no UTF-8 form; looked for when escaped backslashes are out of the way.
_NO_ESCAPE = (r"\\(?:x(?![0-9a-fA-F]{2})|u(?![0-9a-fA-F]{4})|U(?!(?:000[0-9a-fA-F]|0010)[0-9a-fA-F]{4})|N"
              r"|[uU](?:0000)?[dD][89a-fA-F][0-9a-fA-F]{2}|U0000[dD][89a-fA-F])")
_VALUE = "\u0001"
# A list of strings and scalars without a list in it; its parts are taken as above, and nothing is tried twice.
_ITEM = rf"(?:(?:{_STRING}\s*)++|{_SCALAR}\s*+)"
_PLAIN = r"""^\s*+\[\s*+[uU]?(?:'([^'\\\n]*+)'|"([^"\\\n]*+)")\s*+[,\]]"""
_FLAT = rf"(?s)^\s*+\[\s*+(?:{_ITEM}(?:,\s*+{_ITEM})*+(?:,\s*+)?+)?+\]\s*+$"
# What a backslash and one character stand for.
_ONE = {"\n": "", "\\": "\\", "'": "'", '"': '"', "a": "\a", "b": "\b", "f": "\f", "n": "\n", "r": "\r", "t": "\t", "v": "\v"}


def _unescaped(text: Column) -> Column:
    """The text that the inside of a string literal stands for."""
    ones = F.create_map(*[F.lit(x) for pair in _ONE.items() for x in pair])

    def one(token: Column) -> Column:
        kind = F.substring(token, 2, 1)
        digits = F.when(kind.rlike("[0-7]"), F.conv(F.substring(token, 2, 3), 8, 16)).otherwise(F.substring(token, 3, 8))
        point = F.decode(F.unhex(F.lpad(digits, 8, "0")), "UTF-32")
        return (F.when(~token.startswith("\\"), token).when(kind.rlike("[xuU0-7]"), point)
                .otherwise(F.coalesce(F.try_element_at(ones, kind), token)))

    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(_ESCAPE), 0), one), "")


def _is_list(shape: Column) -> Column:
    """Whether a text of values, commas and brackets is one list: a state machine over its characters.

    The state is the brackets that are open, and whether a value has just ended; an array's fold
    keeps it, so lists may be nested ever so deep.
    """
    def step(s: Column, c: Column) -> Column:
        opens, closes = c.isin("[", "("), c.isin("]", ")")
        top, inside = F.substring(s["open"], -1, 1), F.length(s["open"]) > 0
        fits = (F.when(opens, ~s["ended"]).when(closes, inside & (F.concat(top, c).isin("[]", "()")))
                .when(c == ",", s["ended"] & inside).when(c == _VALUE, ~s["ended"] & inside).otherwise(F.lit(False)))
        still = (F.when(opens, F.concat(s["open"], c))
                 .when(closes & inside, F.substring(s["open"], F.lit(1), F.length(s["open"]) - 1)).otherwise(s["open"]))
        return F.struct(still.alias("open"), (closes | (c == _VALUE)).alias("ended"), (s["fits"] & fits).alias("fits"))

    start = F.struct(F.lit("").alias("open"), F.lit(False).alias("ended"), F.lit(True).alias("fits"))
    whole = F.aggregate(F.split(shape, ""), start, step, lambda end: end["fits"] & end["ended"] & (F.length(end["open"]) == 0))
    return shape.startswith("[") & whole


def first_artist(artists: str | Column) -> Column:
    """first entry of a list literal such as ``['A', 'B']`` or ``['A',]``, its escapes decoded.

    Text that is not a list literal as a whole, or an empty list, is returned unchanged. A list may hold
    strings of both quotes, numbers, ``None``, truth values, and lists and tuples of these; strings with the
    prefixes r and b, sets and dictionaries are no such literals here, nor are escapes by a character's name. A list that starts
    with ``None`` has no first artist (null), one that starts with a number or a truth value gives its text, one that starts
    with a list or tuple is returned unchanged.
    """
    a = _c(artists)
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(a, _STRINGS, _VALUE), _SCALAR, _VALUE), r"\s+", "")
    sound = ~F.regexp_replace(a, r"\\\\", "").rlike(_NO_ESCAPE)
    run = F.regexp_extract(a, rf"(?s)^\s*\[\s*((?:{_STRING}\s*)+)", 1)
    insides = F.transform(F.regexp_extract_all(run, F.lit("(?s)" + _STRING), 0), lambda x: F.regexp_extract(x, r"(?s)^[uU]?.(.*).$", 1))
    scalar = F.regexp_extract(a, rf"^\s*\[\s*({_SCALAR})", 1)
    first = (F.when(F.length(run) > 0, F.array_join(F.transform(insides, _unescaped), ""))
             .when(scalar == "None", F.lit(None).cast("string")).when(F.length(scalar) > 0, scalar).otherwise(a))
    # most texts end in one of the first two lines, before any of this is computed; the fold is for lists in lists only
    plain = F.concat(F.regexp_extract(a, _PLAIN, 1), F.regexp_extract(a, _PLAIN, 2))
    return (F.when(~a.rlike(r"(?s)^\s*\[.*\]\s*$"), a).when(~a.contains("\\") & a.rlike(_PLAIN) & a.rlike(_FLAT), plain)
            .when((a.rlike(_FLAT) | _is_list(shape)) & sound, first).otherwise(a))


def normalized_artist(artists: str | Column) -> Column:
    """first artist, trimmed and lower-cased (loose matching key)."""
    return F.lower(F.trim(first_artist(artists)))


def normalized_name(name: str | Column) -> Column:
    """Trim + lower of a plain artist name (log side of loose matching)."""
    return F.lower(F.trim(_c(name)))


def completion_rate(ms_played: str | Column, duration_ms: str | Column) -> Column:
    """played / duration, capped at 1.0; 0.0 when duration is unknown or not positive."""
    played = F.coalesce(_c(ms_played), F.lit(0)).cast("double")
    duration = _c(duration_ms)
    return (
        F.when(duration > 0, F.least(played / duration.cast("double"), F.lit(1.0)))
        .otherwise(F.lit(0.0))
    )


def is_skip(skipped: str | Column, reason_end: str | Column) -> Column:
    """the skipped flag, or an end reason that mentions 'skip' (any case)."""
    return F.coalesce(_c(skipped), F.lit(False)) | F.coalesce(
        F.lower(_c(reason_end)).contains("skip"), F.lit(False)
    )


def parse_ts(ts: str | Column) -> Column:
    """log text ``yyyy-MM-dd HH:mm:ss`` -> wall-clock timestamp; null for any other text."""
    text = _c(ts)
    return F.when(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$"), text.try_cast("timestamp_ntz"))


def read_ts(ts: str | Column) -> Column:
    """Any ISO-like text of a raw history -> wall-clock timestamp (an offset is dropped); null when unreadable."""
    return _c(ts).try_cast("timestamp_ntz")


def hour_of_day(ts: str | Column) -> Column:
    """F6."""
    return F.hour(_c(ts))


def iso_weekday(ts: str | Column) -> Column:
    """Monday = 1 ... Sunday = 7 (``weekday`` is 0-based from Monday)."""
    return F.weekday(_c(ts)) + F.lit(1)


def truncate_second(ts: str | Column) -> Column:
    """per-second bucket of a wall-clock timestamp, staying zone-free."""
    t = _c(ts)
    second = F.extract(F.lit("SECOND"), t)
    return t - F.make_dt_interval(secs=(second - F.floor(second)).cast("decimal(18,6)"))


_EPOCH_DATE = "1970-01-01"


def wallclock_instant(ts: str | Column) -> Column:
    """Wall-clock ``timestamp_ntz`` -> the instant whose UTC reading is that wall clock.

    Built from the date and time fields by epoch arithmetic, so no session
    zone takes part (a plain cast would read the wall clock in the session
    zone). Whole seconds; used where Spark needs a zoned timestamp (watermarks).
    """
    t = _c(ts)
    days = F.datediff(F.to_date(t), F.lit(_EPOCH_DATE).cast("date")).cast("long")
    secs = days * 86400 + F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)
    return F.timestamp_seconds(secs)


def instant_wallclock(ts: str | Column) -> Column:
    """Inverse of :func:`wallclock_instant`: an instant -> its UTC wall clock as ``timestamp_ntz``."""
    secs = F.unix_seconds(_c(ts))
    return F.lit(f"{_EPOCH_DATE} 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=secs.cast("decimal(18,6)"))


def format_ts(ts: str | Column) -> Column:
    """Wall-clock timestamp -> ``yyyy-MM-dd HH:mm:ss`` text (fraction dropped), without a session zone."""
    return F.substring(_c(ts).cast("timestamp_ntz").cast("string"), 1, 19)


def ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / greatest(denominator, 1) as double."""
    return numerator.cast("double") / F.greatest(denominator, F.lit(1))


def skip_rate(skip: str | Column) -> Column:
    """Share of rows with ``skip`` true, guarded against empty groups (aggregate)."""
    return ratio(F.sum(F.when(_c(skip), 1).otherwise(0)), F.count(F.lit(1)))


def clip(x: Column, lo: float = -1.0, hi: float = 1.0) -> Column:
    """F12."""
    return F.greatest(F.lit(lo), F.least(F.lit(hi), x))


# Doubles are first rounded to this many places so that float noise from
# summation order (0.12354999999999999 for 0.12355) cannot move a decimal tie.
NOISE_PLACES = 12


def round4(x: str | Column) -> Column:
    """half-even rounding to four places of the decimal value."""
    return F.bround(F.round(_c(x), NOISE_PLACES), 4)


def present(x: str | Column, places: int = 6) -> Column:
    """Report rounding of a double: half-up to ``places`` of the decimal value."""
    return F.round(F.round(_c(x), NOISE_PLACES), places)


def truthy_text(x: str | Column) -> Column:
    """True iff the upper-cased text is 'TRUE'; null -> false."""
    return F.coalesce(F.upper(_c(x).cast("string")) == F.lit("TRUE"), F.lit(False))


def prefixed_key(prefix: str, key: str | Column) -> Column:
    """F16: ``track:<id>`` style key."""
    return F.concat(F.lit(prefix), _c(key))


def mood_quadrant(valence: str | Column, energy: str | Column) -> Column:
    """one of four mood labels split at 0.5 / 0.5."""
    v, e = _c(valence), _c(energy)
    hi_v, hi_e = v >= QUADRANT_SPLIT, e >= QUADRANT_SPLIT
    return (
        F.when(v.isNull() | e.isNull(), F.lit(None))
        .when(hi_v & hi_e, F.lit(QUADRANT_LABELS["high_valence_high_energy"]))
        .when(~hi_v & hi_e, F.lit(QUADRANT_LABELS["low_valence_high_energy"]))
        .when(hi_v & ~hi_e, F.lit(QUADRANT_LABELS["high_valence_low_energy"]))
        .otherwise(F.lit(QUADRANT_LABELS["low_valence_low_energy"]))
    )


def weekday_label(day: str | Column) -> Column:
    """1..7 -> short weekday name; other values -> null."""
    pairs = []
    for i, name in enumerate(WEEKDAY_LABELS, start=1):
        pairs += [F.lit(i), F.lit(name)]
    return F.try_element_at(F.create_map(*pairs), _c(day).cast("int"))


def to_json_row(*cols: str) -> Column:
    """the row (or the given columns) as one JSON text; nulls are omitted."""
    return F.to_json(F.struct(*(cols or ("*",))))


def lookback(ts: str | Column, minutes: int | None, as_of: Column | None = None) -> Column:
    """Rows at or after ``as_of - minutes``; ``minutes=None`` keeps every row.

    ``as_of`` defaults to the current wall clock of the session.
    """
    if minutes is None:
        return F.lit(True)
    anchor = as_of if as_of is not None else F.localtimestamp()
    return _c(ts) >= anchor - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(int(minutes)))
