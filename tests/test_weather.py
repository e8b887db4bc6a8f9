"""The weather jobs, views and reads over managed tables."""

import json
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tablestream import schemas, weather
from tablestream.sources import writers
from tablestream.streaming.windows import hourly_readings

TABLES = [weather.BATCH, weather.STREAMING, weather.HOURLY, weather.ANALYTICS]


@pytest.fixture(autouse=True)
def clean(spark):
    _drop(spark)
    yield
    _drop(spark)


def _drop(spark):
    for name in TABLES:
        spark.catalog.dropTempView(name)
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def land(folder, day, city, hour, temp, condition="Rain"):
    moment = datetime.fromisoformat(f"{day}T{hour:02d}:00:00+00:00").timestamp()
    record = {"city_name": city, "dt": moment, "main": {"temp": temp, "humidity": 95, "pressure": 1000},
              "wind": {"speed": 3}, "weather": [{"main": condition, "description": "d"}]}
    (folder / day).mkdir(exist_ok=True)
    (folder / day / f"{city}_{hour}.json").write_text(json.dumps(record, indent=2))


def test_batch_path_from_landing_to_reads(spark, tmp_path):
    for hour, temp in ((1, 10.0), (2, 40.0)):
        land(tmp_path, "2024-01-01", "a", hour, temp)
    land(tmp_path, "2024-01-02", "a", 5, 12.0, "Clear")
    land(tmp_path, "2024-01-02", "b", 6, 1.0)
    assert weather.load_weather_day(spark, str(tmp_path), "2024-01-01") == 2
    assert weather.load_weather_day(spark, str(tmp_path), "2024-01-02") == 2
    assert weather.generate_analytics(spark, date(2024, 1, 1), "2024-01-03 00:00:00") == 4
    assert weather.generate_analytics(spark, date(2024, 1, 2), "2024-01-03 00:00:00") == 8
    assert weather.generate_analytics(spark, date(2024, 1, 2), "2024-01-04 00:00:00") == 8
    assert spark.table(weather.ANALYTICS).count() == 12

    newest = weather.weather_data(spark, "2024-01-01", "2024-01-02", limit=2).collect()
    assert [(r.city_name, r.temperature) for r in newest] == [("b", 1.0), ("a", 12.0)]
    only_a = weather.weather_data(spark, "2024-01-01", "2024-01-01", "a").collect()
    assert [r.temperature for r in only_a] == [40.0, 10.0]

    stats = weather.weather_stats(spark, "temperature", "2024-01-01", "2024-01-02", "a").collect()
    assert [(r.date.day, r.avg_value, r.metric) for r in stats] == [
        (1, 25.0, "temperature"), (2, 12.0, "temperature"),
    ]
    with pytest.raises(ValueError):
        weather.weather_stats(spark, "snow", "2024-01-01", "2024-01-02")
    (trend,) = weather.weather_trend(spark, "temperature", 7, date(2024, 1, 3), "a").collect()
    assert (trend.trend_direction, trend.change_rate) == ("decreasing", -13.0)

    found = weather.weather_alerts(spark, 24, datetime(2024, 1, 2, 6)).collect()
    assert [(r.city_name, r.alert_type) for r in found] == [
        ("b", "LOW_TEMPERATURE"), ("a", "HIGH_HUMIDITY"),
    ]
    (ahead,) = weather.weather_forecast(spark, 1, date(2024, 12, 30), "a").collect()
    assert ahead.forecast_date == date(2024, 12, 31)
    assert (ahead.temperature_max, ahead.precipitation_probability) == (40.0, 100.0)

    assert weather.create_views(spark, "2024-01-03") == [
        "latest_weather", "daily_summary", "city_comparison", "weather_trends",
    ]
    assert spark.sql("SELECT * FROM latest_weather").count() == 2
    assert spark.sql("SELECT * FROM weather_trends WHERE unit = '°C'").count() == 3
    row = spark.sql("SELECT * FROM city_comparison WHERE city_name = 'a'").first()
    assert row.avg_temperature == 18.5
    today = weather.current_weather(spark.table(weather.BATCH), date(2024, 1, 1), "city_name")
    assert sorted((r.row_num, r.temperature) for r in today.collect()) == [(1, 40.0), (2, 10.0)]


def streaming_rows(spark):
    t = datetime(2024, 1, 1)
    rows = [("a", float(h), 50.0, 1000.0, 2.0, "Rain", t + timedelta(hours=h), t) for h in (1, 2)]
    return spark.createDataFrame(rows, schemas.WEATHER_STREAMING)


def test_reads_fall_back_to_the_streaming_table(spark):
    streaming_rows(spark).createOrReplaceTempView(weather.STREAMING)
    stats = weather.weather_stats(spark, "wind_speed", "2024-01-01", "2024-01-01").first()
    assert (stats.avg_value, stats.std_dev) == (2.0, 0.0)
    assert weather.weather_data(spark, "2024-01-01", "2024-01-01").count() == 2
    assert weather.latest_weather(spark).first().temperature == 2.0
    assert weather.city_comparison(spark, "2024-01-02").first().avg_temperature == 1.5
    assert weather.daily_summary(spark).count() == 3
    assert weather.weather_trend(spark, "humidity", 3, date(2024, 1, 2)).first().metric == "humidity"
    assert weather.generate_analytics(spark, date(2024, 1, 1), "2024-01-02") == 4


def test_reads_fall_back_to_the_hourly_table(spark):
    rows = streaming_rows(spark)
    hours = hourly_readings(rows, "city_name", "timestamp").drop("avg_wind_speed")
    hours.createOrReplaceTempView(weather.HOURLY)
    wind = weather.weather_stats(spark, "wind_speed", "2024-01-01", "2024-01-01").first()
    assert wind.avg_value is None
    row = weather.weather_data(spark, "2024-01-01", "2024-01-01").first()
    assert (row.temperature, row.wind_speed, row.weather_condition) == (2.0, None, None)
    assert weather.weather_trend(spark, "wind_speed", 3, date(2024, 1, 2)).first().change_rate is None
    assert weather.city_comparison(spark, "2024-01-02").first().avg_wind_speed is None
    assert weather.daily_summary(spark).count() == 3
    assert weather.weather_alerts(spark, 24, datetime(2024, 1, 1, 12)).count() == 2


def test_nothing_to_read(spark):
    assert weather.create_views(spark, "2024-01-01") == []
    with pytest.raises(ValueError):
        weather.weather_data(spark, "2024-01-01", "2024-01-02")


def test_retention(spark):
    rows = [("a", date(2024, 1, 1), "temperature", 1.0, 1.0, 1.0, None, datetime(2024, 1, 1)),
            ("a", date(2024, 7, 1), "temperature", 1.0, 1.0, 1.0, None, datetime(2024, 1, 1))]
    df = spark.createDataFrame(rows, schemas.WEATHER_ANALYTICS)
    writers.create_layout(df, weather.ANALYTICS, ["date"], ["city_name", "metric_type"])
    days = writers.RETENTION_DAYS[weather.ANALYTICS]
    gone = writers.expire_partitions(spark, weather.ANALYTICS, "date", days, date(2024, 7, 2))
    assert gone == ["2024-01-01"] and spark.table(weather.ANALYTICS).agg(F.count("*")).first()[0] == 1
