import datetime as dt

from pyspark.sql import functions as F

from jobstrata.functions import dates, links



def run_ts():
    return F.lit("2026-02-10 02:00:00").cast("timestamp")


def posted(spark, pairs):
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "id int, v string, link string")
    out = df.select("id", F.date_format(dates.posting_timestamp_or_default(F.col("v"), F.col("link"), run_ts()),
                                        "yyyy-MM-dd HH:mm:ss").alias("t")).collect()
    return [r.t for r in sorted(out)]


def test_posting_dates(spark):
    cases = [("1770000000", None, "2026-02-02 02:40:00"), ("1770000000000", "x", "2026-02-02 02:40:00"),
             ("1770000000.0", "x", "2026-02-02 02:40:00"),
             ("03/02/2026", "https://topdev.vn/a", "2026-02-02 17:00:00"), ("2026-02-03", "https://x", "2026-02-02 17:00:00"),
             ("03-02-2026", "https://studentjob.vn/a", "2026-02-02 17:00:00"),
             ("None", "x", "1990-10-10 00:00:00"), (None, None, "1990-10-10 00:00:00"), ("soon", "x", "1990-10-10 00:00:00"),
             ("2026-02-03T10:00:00+07:00", "x", "2026-02-03 03:00:00"), ("2026-02-03T10:00:00Z", "x", "2026-02-03 10:00:00"),
             ("2026-02-03T10:00:00.123+0700", "x", "2026-02-03 03:00:00"),
             ("2026-02-03 10:00:00", "x", "2026-02-03 03:00:00"), ("31/02/2026", "x", "1990-10-10 00:00:00"),
             ("3 ngày trước", "x", "2026-02-07 02:00:00"), ("2 weeks ago", "x", "2026-01-27 02:00:00"),
             ("1 tháng trước", "x", "2026-01-10 02:00:00"), ("yesterday", "x", "2026-02-09 02:00:00")]
    assert posted(spark, [(v, link) for v, link, _ in cases]) == [w for *_, w in cases]


def test_epoch_numbers(spark):
    df = spark.createDataFrame([(1770000000,), (1770000000000,)], "v bigint")
    got = [r[0] for r in df.select(F.date_format(dates.epoch_timestamp(F.col("v")), "yyyy-MM-dd HH:mm:ss")).collect()]
    assert got == ["2026-02-02 02:40:00"] * 2


def test_local_date(spark):
    df = spark.createDataFrame([("2026-01-31 18:00:00",)], "v string")
    assert df.select(dates.local_date(F.col("v").cast("timestamp"))).first()[0] == dt.date(2026, 2, 1)


def test_card_age(spark):
    texts = ["5 hours ago", "Posted\n3 days ago", "today", "200 Minutes ago", "N/A", "7 weeks"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, v string")
    got = [r[1] for r in sorted(df.select("id", dates.age_to_date(F.col("v"), run_ts())).collect())]
    day = dt.date(2026, 2, 10)
    assert got == [day - dt.timedelta(1), day - dt.timedelta(3), day, day - dt.timedelta(1), day, day]


def test_age_limit_is_strict(spark):
    df = spark.createDataFrame([(60,), (59,), (61,)], "back int")
    day = F.date_sub(F.lit("2026-02-10").cast("date"), F.col("back"))
    assert [r.back for r in df.filter(dates.is_recent(day, F.lit("2026-02-10").cast("date"))).collect()] == [59]


def test_detail_date(spark):
    df = spark.createDataFrame([(["x", "1/2/2026", "01/02/2026", "05/05/2025"],), (["none"],), (None,)], "v array<string>")
    assert [r[0] for r in df.select(dates.first_slash_date(F.col("v"))).collect()] == ["01/02/2026", None, None]


def test_links(spark):
    df = spark.createDataFrame([(0, "/a"), (1, "http://x/a"), (2, None), (3, "a")], "id int, v string")
    got = [r[1] for r in sorted(df.select("id", links.absolute_link(F.col("v"), "https://d")).collect())]
    assert got == ["https://d/a", "http://x/a", None, "https://da"]
    row = spark.createDataFrame([("HTTPS://A/b ", "https://careerviet.vn/en/j")], "a string, b string").select(
        links.url_id(F.col("a")) == F.md5(F.lit("https://a/b")), links.rewrite_locale(F.col("b")),
        links.card_id(F.lit(None)) == F.md5(F.lit("None"))).first()
    assert list(row) == [True, "https://careerviet.vn/vi/j", True]


def test_impossible_dates_are_null(spark):
    rows = [(t,) for t in ("999999999 days ago", "999999999 weeks ago", "999999999 years ago", "2000000000 hours ago",
                           "99999999999999 minutes ago", "20260231", "123", "-1700000000", "12345678901", "")]
    run = F.lit("2026-02-10 02:00:00").cast("timestamp")
    df = spark.createDataFrame(rows, "t string")
    got = df.select(dates.posting_timestamp(F.col("t"), F.lit("x"), run).alias("d")).collect()
    assert [r.d for r in got] == [None] * len(rows)
    aged = df.select(dates.age_to_date(F.col("t"), run).alias("d")).collect()
    assert {str(r.d) for r in aged} == {"2026-02-10"}


def test_digits_only_dates(spark):
    run = F.lit("2026-02-10 02:00:00").cast("timestamp")
    df = spark.createDataFrame([("20260203",), ("1700000000",), ("1700000000000",), ("1700000000.5",)], "t string")
    got = [str(r.d) for r in df.select(dates.local_date(dates.posting_timestamp(F.col("t"), F.lit("x"), run)).alias("d")).collect()]
    assert got == ["2026-02-03", "2023-11-15", "2023-11-15", "2023-11-15"]
