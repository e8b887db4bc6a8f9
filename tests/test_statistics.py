"""Aggregates, series, ranking and joins on small frames."""

import math
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tablestream.operators import aggregates, joins, ordered, ranking, series
from tablestream.schemas import EMPLOYEES

STAFF = [(1, "Alice", 30, "HR", 5000), (2, "Bob", 24, "Finance", 7000),
         (3, "Charlie", 29, "IT", 6000), (4, "David", 35, "Finance", 8000),
         (5, "Eve", 28, "HR", 5200), (6, "Frank", 31, "IT", 6400)]


def test_average_salary_of_the_older(spark):
    staff = spark.createDataFrame(STAFF, EMPLOYEES).filter("age > 25")
    means = aggregates.group_average(staff, "department", "salary", "average_salary").collect()
    assert {r.department: r.average_salary for r in means} == {
        "HR": 5100.0, "IT": 6200.0, "Finance": 8000.0,
    }


@pytest.mark.parametrize(
    ("amounts", "limit", "want"),
    [([120, 80, 50], 60, 200.0), ([50, 150, 200], 100, 350.0), ([50], 60, 0.0), ([], 60, 0.0)],
)
def test_filtered_total(spark, amounts, limit, want):
    df = spark.createDataFrame([(float(a),) for a in amounts], "amount double")
    assert aggregates.filtered_total(df, "amount", limit, "total").first().total == want


def readings(spark, rows):
    return spark.createDataFrame(
        rows, "city_name string, measurement_time timestamp, temperature double, humidity double,"
        " pressure double, wind_speed double"
    )


def daily(spark, values, city="a"):
    rows = [(city, date(2024, 1, 1) + timedelta(days=i), float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "city_name string, date date, value double")


def test_a_single_row_has_no_deviation(spark):
    df = readings(spark, [("a", datetime(2024, 1, 1), 1.0, None, 3.0, 4.0)])
    stats = {r.metric_type: r for r in
             aggregates.metric_stats(df, "city_name", "measurement_time").collect()}
    assert stats["temperature"].std_dev is None and stats["temperature"].avg_value == 1.0
    assert stats["humidity"].avg_value is None
    assert set(stats) == set(aggregates.METRICS)


def test_unknown_metric_and_missing_wind(spark):
    df = readings(spark, [("a", datetime(2024, 1, 1), 1.0, 2.0, 3.0, 4.0)])
    with pytest.raises(ValueError):
        aggregates.stats(df, "snow", "measurement_time")
    hours = spark.createDataFrame(
        [("a", datetime(2024, 1, 1), 1.0)], "city_name string, window_start timestamp,"
        " avg_temperature double"
    )
    wind = aggregates.stats(hours, "wind_speed", "window_start", prefix="avg_").first()
    assert wind.avg_value is None and wind.metric == "wind_speed"
    heat = aggregates.stats(hours, "temperature", "window_start", city="a", prefix="avg_").first()
    assert heat.avg_value == 1.0


def test_week_over_week_needs_a_week_before(spark):
    rows = series.week_over_week(daily(spark, range(10)), "city_name", "date", "value")
    trends = [r.trend for r in rows.orderBy("date").collect()]
    assert trends == ["stable"] * 7 + ["increasing"] * 3


def test_trend_labels(spark):
    def run(values):
        df = daily(spark, values).withColumn("t", F.col("date").cast("timestamp"))
        return series.trend(df, "city_name", "t", "value", 30, date(2024, 1, 31)).first()

    assert run([1, 2, 3]).trend_direction == "increasing"
    assert run([3, 2, 1]).trend_direction == "decreasing"
    assert run([1.0, 1.1]).trend_direction in ("stable", "increasing")
    assert run([1, 1, 1]).trend_direction == "stable"
    single = run([5])
    assert (single.change_rate, single.trend_direction) == (None, "stable")
    assert [p.value for p in run([1, 2, 3]).data_points] == [1.0, 2.0, 3.0]
    exact = run([0, 0.1])
    assert math.isclose(exact.change_rate, 0.1) and exact.trend_direction == "stable"


def test_forecast_takes_the_commonest_condition(spark):
    rows = [("a", datetime(2023, 2, 1, h), float(h), 50.0, c)
            for h, c in enumerate(["Rain", "Clear", "Clear", "Rain", None])]
    df = spark.createDataFrame(
        rows, "city string, t timestamp, temp double, hum double, cond string"
    )
    got = series.seasonal_forecast(
        df, "city", "t", "temp", "hum", "cond", date(2024, 1, 31), 3
    ).collect()
    assert len(got) == 1
    row = got[0]
    assert row.forecast_date == date(2024, 2, 1) and row.weather_condition == "Clear"
    assert (row.temperature_min, row.temperature_max, row.temperature_avg) == (0.0, 4.0, 2.0)
    assert math.isclose(row.precipitation_probability, 40.0)


def test_ranks_and_ties(spark):
    t = datetime(2024, 1, 1)
    rows = [("a", t, 1), ("a", t, 2), ("a", t + timedelta(1), 0), ("b", t, 3)]
    df = spark.createDataFrame(rows, "k string, t timestamp, id int")
    ranks = {(r.k, r.id): r.row_num for r in ranking.rank_newest(df, "k", "t", "id").collect()}
    assert ranks == {("a", 0): 1, ("a", 2): 2, ("a", 1): 3, ("b", 3): 1}
    newest = ranking.newest_per_key(df, ["k"], "t", "id").collect()
    assert sorted((r.k, r.id) for r in newest) == [("a", 0), ("b", 3)]
    same = ranking.newest_per_key(df.filter("id > 0"), ["k"], "t", "id").collect()
    assert sorted((r.k, r.id) for r in same) == [("a", 2), ("b", 3)]
    top = ranking.top_n_per_group(df, ["k"], [F.desc("t"), F.desc("id")], 1).collect()
    assert sorted((r.k, r.id) for r in top) == [("a", 0), ("b", 3)]


def test_one_key_with_most_rows_is_numbered_across_slices(spark):
    df = spark.range(20_000).select(
        F.when(F.col("id") % 10 < 9, "hot").otherwise("cold").alias("k"),
        (F.col("id") % 7).alias("t"), "id",
    )
    got = ordered.number_rows(df, ["k"], [F.asc("t"), F.asc("id")])
    assert got.count() == 20_000
    summary = got.groupBy("k").agg(
        F.count("*").alias("n"), F.countDistinct("row_num").alias("d"), F.max("row_num").alias("m")
    )
    for row in summary.collect():
        assert row.n == row.d == row.m
    from pyspark.sql import Window

    plain = df.withColumn("want", F.row_number().over(Window.partitionBy("k").orderBy("t", "id")))
    assert got.join(plain, "id").filter("row_num <> want").count() == 0


def test_trailing_mean_over_block_edges(spark):
    df = spark.range(500).select("id", (F.col("id") * F.col("id") % 11).cast("double").alias("v"))
    got = ordered.trailing_mean(df, [], [F.asc("id")], "v", 60, "m", block_rows=64).collect()
    values = [i * i % 11 for i in range(500)]
    for row in got:
        frame = values[max(0, row.id - 59): row.id + 1]
        assert math.isclose(row.m, sum(frame) / len(frame), abs_tol=1e-9)
    assert len(got) == 500
    with pytest.raises(ValueError):
        ordered.trailing_mean(df, [], [F.asc("id")], "v", 60, "m", block_rows=10)


def test_null_keys_are_numbered(spark):
    df = spark.createDataFrame([(None, i) for i in range(50)], "k string, id int")
    got = ordered.number_rows(df, ["k"], [F.asc("id")]).collect()
    assert sorted(r.row_num for r in got) == list(range(1, 51))


def test_availability_counts_exactly_the_days(spark):
    rows = [("a", date(2024, 1, d)) for d in (1, 2, 3, 3)] + [("b", date(2024, 1, 3))]
    df = spark.createDataFrame(rows, "city string, day date")
    got = aggregates.availability(df, "city", "day", date(2024, 1, 3), 2).collect()
    total = [r.record_count for r in got if r.level == 3]
    cities = {r.city: r.record_count for r in got if r.level == 2}
    assert total == [4] and cities == {"a": 3, "b": 1}
    gaps = joins.missing_grid(df, df, "city", "day", date(2024, 1, 3), 2).collect()
    assert [(r.date, r.city) for r in gaps] == [(date(2024, 1, 2), "b")]


def test_key_checks(spark):
    want = spark.createDataFrame([("a",), ("b",)], "city string")
    have = spark.createDataFrame([("a", 1), (None, 2)], "city string, n int")
    assert [r.city for r in joins.missing_keys(want, have, "city").collect()] == ["b"]
    with pytest.raises(ValueError, match="b"):
        joins.require_keys(want, have, "city")
    joins.require_keys(have.select("city").dropna(), have, "city")
    parent = want.withColumnRenamed("city", "name")
    assert joins.orphans(have, parent, "city", "name").count() == 0


def test_small_extracts(spark):
    long = spark.createDataFrame(
        [("a", date(2024, 1, 1), "temperature", 1.0, 0.0, 2.0, 0.5),
         ("a", date(2024, 1, 2), "temperature", 3.0, 1.0, 4.0, 0.7),
         ("b", date(2024, 1, 1), "humidity", 9.0, 8.0, 9.5, None)],
        "city_name string, date date, metric_type string, avg_value double, min_value double,"
        " max_value double, std_dev double",
    )
    assert aggregates.metric_series(long, "temperature").count() == 2
    assert aggregates.profile_of(long, "temperature").first().avg_value == 2.0
    assert aggregates.partition_rows(long, "date", "2024-01-01").first().rows == 2
    matrix = aggregates.metric_matrix(long, "temperature", ["a", "b"]).orderBy("date").collect()
    assert [(r.a, r.b) for r in matrix] == [(1.0, None), (3.0, None)]


def test_recent_windows_flattens_the_struct(spark):
    df = spark.createDataFrame([("a", datetime(2024, 1, 1, 5))], "city string, t timestamp")
    hours = df.groupBy("city", F.window("t", "1 hour")).count()
    got = aggregates.recent_windows(hours, "2024-01-01 08:00:00", 3).first()
    assert got.window_start == datetime(2024, 1, 1, 5) and got.window_end.hour == 6
    assert aggregates.recent_windows(hours, "2024-01-01 08:00:01", 3).count() == 0
