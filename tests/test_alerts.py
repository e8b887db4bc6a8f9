import json

from tablestream import schemas
from tablestream.operators import alerts, shape

SCHEMA = "id int, temperature double, wind_speed double, humidity double"


def frame(spark, *rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA)


def test_at_the_limit_is_no_alert(spark):
    df = frame(spark, (35.0, 15.0, 90.0), (5.0, 15.0, 90.0), (None, None, None))
    assert alerts.first_alert(df).count() == 0
    assert alerts.explode_alerts(df).count() == 0
    assert [r.alert_type for r in alerts.classify(df).collect()] == ["OTHER"] * 3
    assert [r.alert_level for r in alerts.classify(df).collect()] == ["info"] * 3


def test_first_rule_wins_and_all_are_listed(spark):
    df = frame(spark, (36.0, 21.0, 95.0))
    first = alerts.first_alert(df).first()
    assert (first.alert_type, first.alert_level) == ("HIGH_TEMPERATURE", "critical")
    assert (first.message, first.value, first.threshold) == ("High temperature: 36.0°C", 36.0, 35.0)
    every = {r.alert_type: r for r in alerts.explode_alerts(df).collect()}
    levels = {kind: r.alert_level for kind, r in every.items()}
    assert levels == {"HIGH_TEMPERATURE": "warning", "HIGH_WIND": "critical",
                      "HIGH_HUMIDITY": "warning"}
    assert every["HIGH_WIND"].message == "High wind speed detected: 21.0 m/s"


def test_missing_values_do_not_hide_others(spark):
    df = frame(spark, (40.0, None, None), (None, 16.0, None), (None, None, 91.0))
    kinds = [r.alert_type for r in alerts.first_alert(df).orderBy("id").collect()]
    assert kinds == ["HIGH_TEMPERATURE", "HIGH_WIND", "HIGH_HUMIDITY"]


def test_levels_of_service_and_view_differ(spark):
    df = frame(spark, (1.0, 0.0, 0.0))
    assert alerts.classify(df).first().alert_level == "critical"
    view = alerts.classify(df, critical=alerts.VIEW_LEVELS).first()
    assert view.alert_level == "warning"
    lower = alerts.Limits(temperature_low=1.5)
    assert alerts.classify(df, lower).first().alert_level == "warning"


def test_flag_and_counts(spark):
    df = frame(spark, (36.0, 0.0, 0.0), (4.0, 0.0, 0.0), (20.0, 16.0, 0.0), (20.0, 0.0, 0.0))
    flags = [r[0] for r in df.orderBy("id").select(alerts.alert_flag()).collect()]
    assert flags == ["EXTREME_HEAT", "EXTREME_COLD", "HIGH_WIND", None]
    counts = {r.alert_type: r.alerts for r in
              alerts.alert_counts(alerts.first_alert(df)).collect()}
    assert counts == {None: 3, "HIGH_TEMPERATURE": 1, "LOW_TEMPERATURE": 1, "HIGH_WIND": 1}


def test_threshold_message(spark):
    rows = [("m1", 1, (30.0, 1.0, 0.1), "2024-01-01T00:00:00+00:00"),
            ("m2", 2, (30.1, 1.0, 0.1), "2024-01-01T00:00:00+00:00")]
    df = spark.createDataFrame(rows, schemas.SENSOR_NESTED)
    (only,) = alerts.threshold_alerts(df).collect()
    assert json.loads(only.value) == {
        "message_id": "m2", "sensor_id": 2, "temperature": 30.1,
        "alert": "High temperature detected", "timestamp": "2024-01-01T00:00:00+00:00",
    }
    row = shape.sensor_row(df).first()
    assert json.loads(row.message)["temperature"] == 30.0 and row.timestamp.year == 2024
