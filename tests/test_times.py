import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chronoloom.functions import times as T
from chronoloom.operators import timestamps as S

GRAMMAR = {
    "2024年3月5日": "2024-03-05", "2024.3.5": "2024-03-05", "2024/03": "2024-03", "2024-3": "2024-03", "2024年": "2024", "2024年初": "2024-01", "2024年底": "2024-12", "2024年中": "2024-06", "2024年上半年": "2024-01",
    "2024年下半年": "2024-07", "2024年第三季度": "2024-07", "2024年冬季": "2024-12", "1990年代": "1990", "1990年代初": "1990-01", "1990年代中": "1995-06", "1990年代末": "1999-12", "2019-2021年": "2019/2021", "2019—2021": "2019/2021",
    "2024年1-3月": "2024-01/2024-03", "2023年10月至12月": "2023-10/2023-12", "2024年3月5日至8日": "2024-03-05/2024-03-08", "2024年3月5日、7日": "2024-03-05/2024-03-07", "2024年1月和2月": "2024-01/2024-02", "2022年8月以来": "2022-08",
    "2016年起": "2016", "2020年之后": "2020", "冷战前": None, "3月5日": None, "至今": None, "2024年13月": "2024-13", "2023-10/2023-12": None, "2020/2023": None, "近期": None, "2024 年 3 月": "2024-03", "": "", None: None,
}


@pytest.mark.parametrize("text", list(GRAMMAR))
def test_grammar(text):
    assert T.normalize_time_text(text) == GRAMMAR[text]


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 9999), st.integers(1, 99), st.integers(1, 99))
def test_points_keep_their_numbers(y, m, d):
    assert T.normalize_time_text(f"{y:04d}年{m}月{d}日") == f"{y:04d}-{m:02d}-{d:02d}"


def test_columns(spark):
    rows = [(t,) for t in GRAMMAR]
    df = spark.createDataFrame(rows, "t string")
    got = {r["t"]: r["n"] for r in df.select("t", T.normalized_time(F.col("t")).alias("n")).collect()}
    assert got == GRAMMAR
    points = {r["t"]: r["p"] for r in df.select("t", T.single_point(F.col("t")).alias("p")).collect()}
    assert all(p is None or p == GRAMMAR[t] for t, p in points.items()) and points["2024年底"] == "2024-12"
    sig = df.sparkSession.createDataFrame([("2024年3月5日",), ("2024-03-05",), ("2024/3",), ("近期 ",)], "t string").select(T.signature_time(F.col("t")).alias("s"))
    assert [r["s"] for r in sig.collect()] == ["2024.03.05", "2024.03.05", "2024.03", "近期"]
    a = spark.createDataFrame([("2024-03-05/2024-04",), ("2024-03",), ("x",), (None,)], "t string").select(T.time_anchor(F.col("t")).alias("a")).collect()
    assert [tuple(r["a"]) for r in a] == [(2024, 3, 5, 3), (2024, 3, None, 2), (None, None, None, 0), (None, None, None, 0)]


def norm(text, zone=None, lang="zh", ref="2024-05-10"):
    f = pd.DataFrame({"matched_text": [text], "zone": [zone], "lang": [lang], "ref_date": [ref]})
    return S.parse_rows(f, S.Shapes())["norm"].iloc[0]


@pytest.mark.parametrize(
    "args,wanted",
    [
        (("03/04/2024", None, "en-US"), "2024-03-04"),
        (("03/04/2024", None, "en-GB"), "2024-04-03"),
        (("05/13/2024", None, "en-GB"), None),
        (("２０２４－０３－０５ １０：００：００", "Asia/Tokyo"), "2024-03-05T01:00:00Z"),
        (("2024-03-05T10:00:00.999+02:00", "Asia/Tokyo"), "2024-03-05T08:00:00Z"),
        (("2024-03-05 10:00:00 [America/New_York]", "Asia/Tokyo"), "2024-03-05T15:00:00Z"),
        (("2024-03-05 10:00", None), None),
        (("2024-03-05 10:00", "Nowhere/Land"), None),
        (("2024-03-05 25:00", "UTC"), None),
        # twice: the first; skipped: the offset before the change
        (("2024-10-27 02:30", "Europe/Berlin"), "2024-10-27T00:30:00Z"),
        (("2024-03-31 02:30", "Europe/Berlin"), "2024-03-31T01:30:00Z"),
        (("2024-11-03 01:30", "America/New_York"), "2024-11-03T05:30:00Z"),
        (("1700000000", None), "2023-11-14T22:13:20Z"),
        (("1700000000999", None), "2023-11-14T22:13:20Z"),
        (("20240305", None), "2024-03-05"),
        (("20241305", None), None),
        (("Mon, 19 Apr 2021 15:00:36 +0530", None, "en"), "2021-04-19T09:30:36Z"),
        (("26 Oct 2025 01:59 JST", "-03:00", "en-GB"), "2025-10-25T16:59:00Z"),
        (("1. März 2013", None, "de"), "2013-03-01"),
        (("May 6, 2018 at 12:37 a.m.", "UTC", "en-US"), "2018-05-06T00:37:00Z"),
        (("民國113年2月29日", None), "2024-02-29"),
        (("令和元年5月1日", None), "2019-05-01"),
        (("二〇二四年十二月三十一日", None), "2024-12-31"),
        (("2024年十月", None), "2024-10"),
        (("北京时间2024年3月5日0时05分", "UTC"), "2024-03-04T16:05:00Z"),
        (("2024年3月5日下午12时13分", "UTC"), "2024-03-05T12:13:00Z"),
        (("2024年3月5日上午12时13分", "UTC"), "2024-03-05T00:13:00Z"),
        (("2024年3月5日晚7时6分", "+08:00"), "2024-03-05T11:06:00Z"),
        (("5月1日", None), "2024-05-01"),
        (("去年12月", None), "2023-12"),
        (("次日", None), "2024-05-11"),
        (("前天", None), "2024-05-08"),
        (("yesterday", None, "en"), "2024-05-09"),
        (("昨日", None, "zh", None), None),
        (("2018-2020年", None), "2018/2020"),
        (("2024年2月14日—17日", None), "2024-02-14/2024-02-17"),
        (("2024年2月14日至3日", None), None),
        (("2024年底", None), "2024-12"),
        (("2024年全年", None), "2024"),
        (("2024年2月30日", None), None),
        (("近日", None), None),
        ((" 　\n", None), None),
        ((None, None), None),
        (("x" * 100_000, None), None),
    ],
)
def test_stated_times(args, wanted):
    assert norm(*args) == wanted


def test_operator(spark, cluttered):
    rows = [(1, "2024年3月", None, "zh", "2024-01-01"), (1, "2024年3月", None, "zh", "2024-01-01"), (2, None, None, None, None), (3, "2024-03-05 10:00", "UTC", "en", None)]
    df = spark.createDataFrame(rows, "cand_id long, matched_text string, zone string, lang string, ref_date string")
    got = sorted(tuple(r) for r in S.normalize_times(cluttered(df)).collect())
    assert got == [(1, "2024-03", "month"), (3, "2024-03-05T10:00:00Z", "second")]
    assert S.normalize_times(df.where("false")).count() == 0


def test_zone_rules_far_ahead():
    """Beyond the tables the rules repeat with the calendar: the same as asking for each instant."""
    from datetime import UTC, datetime
    from zoneinfo import ZoneInfo

    import numpy as np

    from chronoloom.functions import zones

    for zone in ("America/New_York", "Europe/Berlin", "Australia/Sydney", "Asia/Shanghai"):
        local = [datetime(y, m, 15, 12) for y in (1950, 2024, 2099, 2100, 2101, 2399, 2500, 2899, 3001) for m in (1, 4, 7, 10)]
        seconds = np.array([int(t.replace(tzinfo=UTC).timestamp()) for t in local])
        assert zones.to_utc(seconds, zone).tolist() == [int(t.replace(tzinfo=ZoneInfo(zone)).timestamp()) for t in local]
