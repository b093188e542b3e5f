"""Hand-made rows with known answers for the scalar functions."""

import ast
import datetime as dt
import random
import re
import warnings

from pyspark.sql import functions as F

from cadence import functions as cf


def _col(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_first_artist(spark):
    rows = [("['A', 'B']",), ('["Guns N\' Roses"]',), ("Foo",), ("[]",), (None,)]
    got = _col(spark, rows, "a string", cf.first_artist("a"))
    assert got == ["A", "Guns N' Roses", "Foo", "[]", None]


def test_normalized_artist(spark):
    got = _col(spark, [("['  Daft Punk ', 'x']",)], "a string", cf.normalized_artist("a"))
    assert got == ["daft punk"]


def test_completion_rate(spark):
    rows = [(50, 100), (200, 100), (5, 0), (None, 100), (10, None)]
    got = _col(spark, rows, "p int, d long", cf.completion_rate("p", "d"))
    assert got == [0.5, 1.0, 0.0, 0.0, 0.0]


def test_is_skip(spark):
    rows = [(True, None), (False, "ForwardSKIPbtn"), (None, None), (False, "trackdone")]
    got = _col(spark, rows, "s boolean, r string", cf.is_skip("s", "r"))
    assert got == [True, True, False, False]


def test_weekday_and_hour(spark):
    rows = [("2024-01-01 05:06:07",), ("2024-01-07 23:00:00",), ("bad",)]
    df = spark.createDataFrame(rows, "ts string").select(cf.parse_ts("ts").alias("t"))
    got = [(r[0], r[1]) for r in df.select(cf.iso_weekday("t"), cf.hour_of_day("t")).collect()]
    assert got == [(1, 5), (7, 23), (None, None)]


def test_truthy_text(spark):
    rows = [("TRUE",), ("true",), ("True",), ("false",), (None,), ("yes",)]
    assert _col(spark, rows, "x string", cf.truthy_text("x")) == [True, True, True, False, False, False]


def test_round4_half_even_on_decimal_value(spark):
    rows = [(0.12345,), (0.12355,), (0.12354999999999999,), (1.5,)]
    assert _col(spark, rows, "x double", cf.round4("x")) == [0.1234, 0.1236, 0.1236, 1.5]


def test_mood_quadrant(spark):
    rows = [(0.9, 0.9), (0.1, 0.9), (0.9, 0.1), (0.1, 0.1), (0.5, 0.5), (None, 0.3)]
    got = _col(spark, rows, "v double, e double", cf.mood_quadrant("v", "e"))
    assert got == ["energetic_happy", "aggressive_tense", "calm_happy", "sad_still", "energetic_happy", None]


def test_weekday_label(spark):
    got = _col(spark, [(1,), (7,), (8,)], "d int", cf.weekday_label("d"))
    assert got == ["Mon", "Sun", None]


def test_lookback(spark):
    rows = [(dt.datetime(2024, 1, 1, 10, 0),), (dt.datetime(2024, 1, 1, 9, 30),), (dt.datetime(2024, 1, 1, 9, 29),)]
    df = spark.createDataFrame(rows, "t timestamp_ntz")
    as_of = F.lit("2024-01-01 10:00:00").cast("timestamp_ntz")
    assert df.where(cf.lookback("t", 30, as_of)).count() == 2
    assert df.where(cf.lookback("t", None)).count() == 3


def test_truncate_second_stays_wall_clock(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 31, 2, 30, 1, 999),)], "t timestamp_ntz")
    assert df.select(cf.truncate_second("t")).first()[0] == dt.datetime(2024, 3, 31, 2, 30, 1)


def test_wallclock_instant_round_trip_in_any_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "America/New_York", "Asia/Kathmandu"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            rows = [(dt.datetime(2024, 3, 10, 2, 30, 5),), (dt.datetime(2024, 11, 3, 1, 30, 0),)]
            df = spark.createDataFrame(rows, "t timestamp_ntz").select(
                "t", F.unix_seconds(cf.wallclock_instant("t")).alias("s"),
                cf.instant_wallclock(cf.wallclock_instant("t")).alias("back"))
            for r in df.collect():
                assert r.back == r.t
                assert r.s == int(r.t.replace(tzinfo=dt.timezone.utc).timestamp())
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_first_artist_of_odd_literals(spark):
    rows = [("['A'] feat B",), ("['A',]",), ("[None, 'A']",), ("[None]",), ("['A', None]",), ("['A, None, B', 'C']",), (" ['A'] ",), ("[broken",)]
    got = _col(spark, rows, "a string", cf.first_artist("a"))
    assert got == ["['A'] feat B", "A", None, None, "A", "A, None, B", "A", "[broken"]


def test_log_ts_has_one_format(spark):
    rows = [("2024-01-01 10:00:00",), ("2024",), ("2024-01-01",), ("2024-01-01T10:00:00+09:00",), ("2024-13-01 00:00:00",), (None,)]
    got = _col(spark, rows, "t string", cf.parse_ts("t"))
    assert got == [dt.datetime(2024, 1, 1, 10)] + [None] * 5


def test_wall_clocks_without_a_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("America/New_York", "Asia/Tokyo", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            t = spark.createDataFrame([("2024-03-10 02:30:01.75",)], "x string").select(F.col("x").cast("timestamp_ntz").alias("t"))
            r = t.select(cf.format_ts("t").alias("a"), cf.truncate_second("t").cast("string").alias("b")).first()
            assert (r.a, r.b) == ("2024-03-10 02:30:01",) * 2, zone
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def _python_first(text):
    try:
        got = ast.literal_eval(text)
    except (ValueError, SyntaxError):
        return text
    if not isinstance(got, list) or not got or isinstance(got[0], (list, tuple)):
        return text
    return got[0] if got[0] is None or isinstance(got[0], str) else re.match(r"\s*\[\s*([^\s,\]]+)", text)[1]


ODD_LITERALS = [
    r"['Beyonc\xe9', 'x']", r"['İbrahim', \"a\"]".replace('\\"', '"'), r"['Sinéad O\'Connor']", r'["a \"b\" c", None]', r"['a\\', 'b']", r"['a\\\'b']",
    r"['\x4', 'a']", r"['\\x4', 'a']", r"['\101\60\7']", r"['\q\z']", r"['\U0001F600!']", r"['\U00110000']", r"['a' 'b' " + '"c"' + r", 'd']", r"[u'a', U'b']",
    "[1, 'a']", "[1.5e3]", "[True, 'a']", "[None, 'a']", "['a', 1, None, False]", "['a', ['b', (1, 2,)], ()]", "[['a'], 'b']", "['a', ['b']", "['a']]", "['a', [(])]",
    "['a'],['b']", "[,]", "['a',,]", "['a' 1]", "['a' , ]", "[ 'a'\n, 'b' ]", "('a', 'b')", "'a'", "['a'] feat. ['b']", "[a]", "[None1]", "['']", "['', 'a']", "[ ]", "",
    "['a\nb']", "['it''s']", "['[', ']']", '["\'"]', r"['a\tb\n']", "['a\\\nb']", "[-1]", "['日本', 'x']", "[" * 40 + "]" * 40, "['a', " + "[" * 40 + "]" * 40 + "]",
]


def test_first_artist_is_the_literals_first_value(spark):
    rng = random.Random(4)
    parts = ["'", '"', "\\", "[", "]", "(", ")", ", ", ",", " ", "a", "é", "None", "True", "1", "\\'", "\\x41", "\\u00e9", "'a'", '"b"', "'c\\'d'", "x4"]
    made = ["[" + "".join(rng.choice(parts) for _ in range(rng.randint(0, 7))) + "]" for _ in range(3000)]
    texts = ODD_LITERALS + made
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        want = [_python_first(t) for t in texts]
    got = _col(spark, [(t,) for t in texts], "a string", cf.first_artist("a"))
    assert [(t, g, w) for t, g, w in zip(texts, got, want) if g != w] == []
    assert sum(t != w for t, w in zip(texts, want)) > 100


def test_first_artist_folds_once_and_only_over_nested_lists(spark):
    df = spark.createDataFrame([("['A', 'B']",), ("['a', ['b']]",)], "a string").select(cf.first_artist("a").alias("f"))
    plan = df._jdf.queryExecution().analyzed().toString()
    assert plan.count("aggregate(split(") == 1
    assert [r.f for r in df.collect()] == ["A", "a"]
