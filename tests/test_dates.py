from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from recordtrust.functions.dates import parse_date

DAY = datetime(2020, 2, 29)
NOON = DAY.replace(hour=12, minute=30)
READ = {
    "2020-02-29 12:30:00": NOON,
    "2020-02-29T12:30:00.5": NOON.replace(microsecond=500000),
    "2020-02-29T12:30": NOON,
    "2020-2-29": DAY, "2020/02/29": DAY, "2020.02.29 12:30": NOON, " 2020-02-29\n": DAY,
    "02/29/2020": DAY, "2/29/20": DAY, "2-29-2020 12:30 PM": NOON, "02/29/2020 12:30:00": NOON, "2/29/2020, 9 am": DAY.replace(hour=9),
    "29/2/2020": DAY, "12/1/2020": datetime(2020, 12, 1), "13/1/2020": datetime(2020, 1, 13),
    "Feb 29, 2020": DAY, "February 29th 2020": DAY, "FEB. 29 2020 12:30pm": NOON, "29 Feb 2020": DAY, "29-february-2020": DAY, "29-Feb-20": DAY,
    "Sept 1, 2019": datetime(2019, 9, 1), "September 1 1969": datetime(1969, 9, 1), "1 may 68": datetime(2068, 5, 1), "1 may 69": datetime(1969, 5, 1),
    "Sat, 29 Feb 2020 12:30:00 GMT": NOON, "Saturday, February 29, 2020 12:30 AM": DAY.replace(minute=30),
    "20200229": DAY, "20200229T123000": NOON, "202002291230": NOON, "20200229 1230": NOON, "20200229T123000Z": NOON,
    "2020-02-29T14:30:00+02:00": NOON, "2020-02-29 07:00 -0530": NOON, "2020-02-29T12:30:00Z": NOON, "2020-02-29 14:30 UTC+2": NOON,
    "2020-02-28T23:30:00-13": NOON, "2020 Feb 29": DAY, "2020-02": datetime(2020, 2, 1), "Feb 2020": datetime(2020, 2, 1), "2020": datetime(2020, 1, 1),
}
UNREAD = [
    "soon", "", None, "2020-02-30", "2021-02-29", "13/13/2020", "Febr 29, 2020", "2020-02-29 25:00", "2020-02-29 12:61", "2020-02-29 13:00 pm", "0:30 am",
    "12:30", "2020-02-29 x", "29 2020 Feb 1", "123456789", "+02:00",
]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_forms(spark, zone):
    """Each form is read, whatever the session's zone, and what is no date is unknown."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(t,) for t in [*READ, *UNREAD]], "t string")
        found = {r.t: r.x for r in df.select("t", parse_date(F.col("t")).alias("x")).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert found == {**READ, **dict.fromkeys(UNREAD)}


def test_every_day_round_trips(spark):
    days = spark.range(0, 36_000, 7).select(F.timestamp_add("DAY", F.col("id"), F.lit("1969-01-01 05:06:07").cast("timestamp_ntz")).alias("d"))
    for pattern in ("yyyy-MM-dd HH:mm:ss", "MMMM d, yyyy h:mm:ss a", "d MMM yy HH:mm:ss", "yyyyMMddHHmmss", "EEE, M/d/yyyy HH:mm:ss"):
        assert days.where(~parse_date(F.date_format("d", pattern)).eqNullSafe(F.col("d"))).count() == 0


def test_further_formats(spark):
    df = spark.createDataFrame([("2020|060",), ("2020-02-29",)], "t string")
    assert [r[0] for r in df.select(parse_date(F.col("t"), ["yyyy|DDD"])).collect()] == [DAY, DAY]


def test_no_python_worker(spark):
    df = spark.createDataFrame([("2020",)], "t string").select(parse_date(F.col("t")))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def test_wall_time_in_a_gap_of_the_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("2021-03-14 02:30:00",)], "t string")
        assert df.select(parse_date(F.col("t")).cast("string")).first()[0] == "2021-03-14 02:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_shared_steps_are_planned_once(spark):
    """The text without its weekday, the time's groups and the date's parts were worked out again for every use."""
    df = spark.createDataFrame([("2020",)], "t string").select(parse_date(F.col("t")))
    plan = df._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.count("regexp_replace(") < 100 and plan.count("rlike") < 50


def test_control_characters_are_no_dates(spark):
    texts = ["2020-02-29\u00019:05", "2020-02-29 9:05\u0001", "\u00012020", "2020-02-29 9:05 $1", "2020\\1"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert df.where(parse_date(F.col("t")).isNotNull()).count() == 0
