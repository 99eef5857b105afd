import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barloom.functions import scalar as S
from barloom.schema import CATEGORY_DEFAULT, CATEGORY_LADDER
from helpers import at, rows


def test_non_negative_and_volume(spark):
    df = spark.createDataFrame(
        [(5, 3), (-1, 3), (None, 3), (-1, None), (None, None), (0, 0), (-2, 10)], "h long, l long")
    out = rows(df.select(S.non_negative("h"), S.traded_volume("h", "l")))
    assert out == [(5, 8), (None, 2), (None, 3), (None, None), (None, None), (0, 0), (None, 8)]


def test_spread_needs_a_positive_sum(spark):
    df = spark.createDataFrame([(110, 90), (0, 0), (None, 5)], "h long, l long")
    assert rows(df.select(S.relative_spread("h", "l"))) == [(0.2,), (None,), (None,)]


def test_category_ladder_takes_the_first_match(spark):
    names = ["Rune bar", "Oak logs", "Iron ORE", "Steel bar", "Dragon claws", "Abyssal whip", "Rune helm", "Full helm", "Torva tassets", "Lobster", None]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = [r[0] for r in rows(df.select(S.label_ladder("name", CATEGORY_LADDER, CATEGORY_DEFAULT)))]
    assert got == ["Runes", "Logs", "Ores", "Bars", "Weapons", "Weapons", "Runes", "Armor", "Armor", "Other", "Other"]


def test_trend_signal_edges(spark):
    df = spark.createDataFrame([(1.06,), (1.05,), (1.03,), (1.0,), (0.97,), (0.95,), (0.94,), (None,)], "r double")
    got = [r[0] for r in rows(df.select(S.trend_signal(F.col("r"))))]
    assert got == ["Strong_Up", "Mild_Up", "Mild_Up", "Neutral", "Mild_Down", "Mild_Down", "Strong_Down", "Neutral"]


def test_weekday_angle_starts_on_sunday(spark):
    df = spark.sql("SELECT date'2024-01-07' AS d UNION ALL SELECT date'2024-01-08'")
    assert [round(r[0], 6) for r in rows(df.select(S.weekday_angle("d")))] == [0.0, round(2 * 3.141592653589793 / 7, 6)]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 86_399), st.integers(-(2**40), 2**40)), min_size=1, max_size=12))
def test_time_value_key_finds_first_and_last(spark, points):
    data = [(at(1, 0, 0).replace(hour=s // 3600, minute=s // 60 % 60, second=s % 60), v) for s, v in points]
    df = spark.createDataFrame(data, "ts timestamp_ntz, v long").withColumn("k", S.time_value_key("ts", "v"))
    got = df.agg(F.min("k").alias("a"), F.max("k").alias("b")).select(S.key_value("a"), S.key_value("b")).first()
    assert tuple(got) == (min(points)[1], max(points)[1])


def test_humanise(spark):
    df = spark.createDataFrame([(1_234_567.0,), (4_321.0,), (999.5,), (12.4,)], "x double")
    assert [r[0] for r in rows(df.select(S.humanise("x")))] == ["1.2M", "4.3K", "1000", "12"]


def test_period_parser():
    assert S.parse_period("30d") == 30
    for bad in ("30", "d", "-3d", "0d", "xd"):
        with pytest.raises(ValueError):
            S.parse_period(bad)
    assert S.parse_period("week", strict=False) == 30
    assert S.parse_period("xd", strict=False) == 30
    assert S.parse_period("7d", strict=False) == 7


def test_item_list_parser():
    assert S.parse_item_list("1, 2,3", (9,)) == [1, 2, 3]
    assert S.parse_item_list("7", (9,)) == [7]
    assert S.parse_item_list("@conf/x.json", (9,)) == "conf/x.json"
    assert S.parse_item_list("abc", (9,)) == [9]


def test_time_value_key_does_not_depend_on_the_session_zone(spark):
    times = [dt.datetime(2024, 3, 10, 2, 30), dt.datetime(2024, 3, 10, 3, 10)]  # the first does not exist in New York
    df = spark.createDataFrame(list(zip(times, (5, 9))), "ts timestamp_ntz, v long")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        key = S.time_value_key("ts", "v")
        out = df.agg(F.min(key).alias("o"), F.max(key).alias("c"))
        assert tuple(out.select(S.key_value("o"), S.key_value("c")).first()) == (5, 9)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_time_value_key_rejects_values_it_cannot_hold(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1), 6 * 10**18)], "ts timestamp_ntz, v long")
    with pytest.raises(Exception, match="beyond 64-bit key"):
        df.select(S.time_value_key("ts", "v")).collect()
