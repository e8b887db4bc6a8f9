import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tablestream import schemas
from tablestream.functions import columns, predicates
from tablestream.operators import shape
from tablestream.sources.readers import decode_json

ARRIVAL = datetime(2024, 1, 31)


def messages(spark, *records):
    lines = [(r if isinstance(r, str) else json.dumps(r),) for r in records]
    return spark.createDataFrame(lines, "value string")


def raw(spark, *weather):
    records = [{"city_name": f"c{i}", "dt": 0, "weather": w} for i, w in enumerate(weather)]
    return decode_json(messages(spark, *records), schemas.RAW_WEATHER)


TWO = [{"main": "Rain", "description": "r"}, {"main": "Clouds", "description": "c"}]


def test_first_condition_keeps_every_record(spark):
    flat = shape.flatten_weather(raw(spark, TWO, [], None), "2024-01-01", "2024-01-01 00:00:00")
    got = {r.city_name: r.weather_condition for r in flat.collect()}
    assert got == {"c0": "Rain", "c1": None, "c2": None}
    assert len(flat.columns) == 19


def test_explode_drops_and_multiplies(spark):
    df = shape.explode_conditions(raw(spark, TWO, [], None).select("city_name", "weather"))
    assert sorted((r.city_name, r.weather_condition) for r in df.collect()) == [
        ("c0", "Clouds"), ("c0", "Rain"),
    ]


def test_two_shapes(spark):
    nested = {"city_name": "n", "main": {"temp": 1.5}, "wind": {"speed": 2}, "dt": 60,
              "temperature": 99, "weather": [{"main": "Rain"}]}
    flat = {"city_name": "f", "temperature": 3.5, "wind_speed": 4, "main": None,
            "timestamp": "2024-01-02T03:04:05.678901", "unknown": True}
    df = decode_json(
        messages(spark, nested, flat, {"temperature": 1}, {"city_name": ""}, "not json",
                 {"city_name": "t", "temperature": 1}),
        schemas.READING_MESSAGE,
    )
    rows = {r.city_name: r for r in shape.normalise_reading(df, F.lit(ARRIVAL)).collect()}
    assert set(rows) == {"n", "f", "t"}
    assert (rows["n"].temperature, rows["n"].wind_speed) == (1.5, 2.0)
    assert rows["n"].weather_condition == "Rain" and rows["n"].pressure is None
    assert rows["n"].timestamp == datetime(1970, 1, 1, 0, 1)
    assert (rows["f"].temperature, rows["f"].wind_speed) == (3.5, 4.0)
    assert rows["f"].timestamp == datetime(2024, 1, 2, 3, 4, 5, 678901)
    assert rows["t"].timestamp == ARRIVAL


def test_user_record(spark):
    record = {"id": 1, "name": "n", "username": "u", "email": "e",
              "address": {"street": "s", "suite": "t", "city": "c", "zipcode": "z"},
              "company": {"name": "co", "catchPhrase": "cp", "bs": "b"}}
    df = decode_json(messages(spark, record), schemas.USER_RECORD)
    assert tuple(shape.flatten_user(df, "2024-01-01").first()) == (
        1, "n", "u", "e", "s", "t", "c", "z", "co", "cp", "b", "2024-01-01",
    )


def test_click_defaults(spark):
    df = decode_json(
        messages(spark, {"event_id": "1"}, {"event_type": "view", "country": "VN",
                                            "duration_ms": 5, "os": "x"}),
        schemas.CLICK_V2,
    )
    rows = shape.click_row(df, F.lit(ARRIVAL)).collect()
    assert tuple(rows[0]) == (ARRIVAL, "unknown", "unknown", 1, 0.0, None, None, None)
    assert tuple(rows[1])[1:5] == ("view", "VN", 1, 5.0) and rows[1].os == "x"


def test_versions_and_small_maps(spark):
    old = spark.createDataFrame([("1",)], "event_id string")
    new = spark.createDataFrame([("2", "m")], "event_id string, device_type string")
    assert sorted(tuple(r) for r in shape.read_versions(old, new).collect()) == [
        ("1", None), ("2", "m"),
    ]
    row = new.select(
        shape.processed_text(F.col("event_id")), columns.slug(F.lit("Ho Chi Minh City")),
        columns.unit_of(F.lit("pressure")), columns.unit_of(F.lit("other")),
        columns.cents_to_units(F.lit(1250)), columns.json_number(F.lit('{"a":"x"}'), "$.a"),
    ).first()
    assert tuple(row) == ("Processed: 2", "ho_chi_minh_city", "hPa", "", 12.5, None)
    stamped = shape.stamp_lineage(new, "2024-01-02 03:00:00", "run-1").first()
    assert stamped.processing_date == date(2024, 1, 2) and stamped.run_id == "run-1"
    action = spark.createDataFrame([(1, "buy", 5)], schemas.ACTION)
    assert shape.click_action(action).columns == ["user_id", "timestamp", "action"]


def test_unknown_layout(spark):
    with pytest.raises(ValueError):
        shape.unify_readings(spark.range(1), "weekly")


DAYS = [date(2024, 1, d) for d in (1, 2, 3, 4)]


@pytest.mark.parametrize(
    ("start", "end", "want"),
    [("2024-01-02", "2024-01-03", 2), ("2024-01-02", None, 3), (None, "2024-01-03", 3),
     (None, None, 4), ("2024-01-03", "2024-01-02", 0)],
)
def test_date_range(spark, start, end, want):
    df = spark.createDataFrame([(d,) for d in DAYS], "d date")
    assert predicates.date_range(df, "d", start, end).count() == want
    stamped = df.select((F.col("d") + F.expr("INTERVAL 23 HOURS")).alias("d"))
    assert predicates.date_range(stamped, "d", start, end).count() == want


def test_filters(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "n int, s string")
    assert predicates.above(df, "n", 1).count() == 2
    assert predicates.equal_to(df, "s", "a").count() == 1
    assert predicates.present(df, "s").count() == 2
    assert [r.n for r in predicates.not_in(df, "s", ["a"]).collect()] == [3]
    stamps = spark.createDataFrame([(ARRIVAL,)], "t timestamp")
    assert predicates.last(stamps, "t", 1, "days", "2024-02-01").count() == 1
    assert predicates.last(stamps, "t", 23, "hours", "2024-02-01").count() == 0
    with pytest.raises(ValueError):
        predicates.last(stamps, "t", 1, "weeks", "2024-02-01")
    rain = spark.createDataFrame([("Light RAIN",), ("shower",), ("Clear",), (None,)], "c string")
    assert rain.filter(predicates.mentions_rain(F.col("c"))).count() == 2
