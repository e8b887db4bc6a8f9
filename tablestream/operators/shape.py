"""Projections that change the shape of a record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablestream.functions.columns import day_length_hours, from_epoch, timestamp_of
from tablestream.schemas import CONDITIONS


def flatten_weather(df: DataFrame, processing_date, processing_time=None) -> DataFrame:
    """One flat row per raw record; the first listed condition, if any, describes it."""
    stamped = F.current_timestamp() if processing_time is None else F.lit(str(processing_time))
    df = df.withColumn("_first", F.get(F.from_json("weather", CONDITIONS), F.lit(0)))
    sunrise, sunset = from_epoch(F.col("sys.sunrise")), from_epoch(F.col("sys.sunset"))
    return df.select(
        "city_name",
        F.col("name").alias("city_original_name"),
        F.col("coord.lon").alias("longitude"),
        F.col("coord.lat").alias("latitude"),
        F.col("main.temp").alias("temperature"),
        F.col("main.feels_like").alias("feels_like"),
        F.col("main.humidity").alias("humidity"),
        F.col("main.pressure").alias("pressure"),
        F.col("wind.speed").alias("wind_speed"),
        F.col("wind.deg").alias("wind_direction"),
        F.col("clouds.all").alias("cloudiness"),
        F.col("_first.main").alias("weather_condition"),
        F.col("_first.description").alias("weather_description"),
        from_epoch(F.col("dt")).alias("measurement_time"),
        sunrise.alias("sunrise"),
        sunset.alias("sunset"),
        stamped.cast("timestamp").alias("processing_time"),
        F.lit(str(processing_date)).cast("date").alias("processing_date"),
        day_length_hours(sunrise, sunset).alias("day_length_hours"),
    )


def explode_conditions(df: DataFrame, weather: str = "weather") -> DataFrame:
    """One row per listed condition; a record without any gives no row."""
    others = [name for name in df.columns if name != weather]
    entries = F.explode(F.from_json(weather, CONDITIONS)).alias("_entry")
    return df.select(*others, entries).select(
        *others,
        F.col("_entry.main").alias("weather_condition"),
        F.col("_entry.description").alias("weather_description"),
    )


def flatten_user(df: DataFrame, as_of) -> DataFrame:
    return df.select(
        "id",
        "name",
        "username",
        "email",
        "address.street",
        "address.suite",
        "address.city",
        "address.zipcode",
        F.col("company.name").alias("company_name"),
        F.col("company.catchPhrase").alias("company_catchphrase"),
        F.col("company.bs").alias("company_bs"),
        F.lit(str(as_of)).alias("processed_at"),
    )


def scaled(df: DataFrame, source: str, target: str, factor: float) -> DataFrame:
    return df.withColumn(target, F.col(source) * factor)


def stamp_lineage(df: DataFrame, as_of, run_id: str | None = None) -> DataFrame:
    return df.withColumns(
        {
            "processing_time": F.lit(str(as_of)).cast("timestamp"),
            "processing_date": F.lit(str(as_of)).cast("timestamp").cast("date"),
            "run_id": F.lit(run_id).cast("string"),
        }
    )


def normalise_reading(df: DataFrame, arrival: Column | None = None) -> DataFrame:
    """One flat reading from either message shape.

    The record as a whole is nested when ``main`` is an object; its flat fields are then ignored.
    Records without a city are dropped and a missing timestamp becomes the arrival time.
    """
    arrival = F.current_timestamp() if arrival is None else arrival
    nested = F.col("main").isNotNull()

    def either(inner: Column, outer: str) -> Column:
        return F.when(nested, inner).otherwise(F.col(outer))

    condition = F.get("weather", F.lit(0))["main"]
    stated = timestamp_of(either(F.col("dt"), "timestamp"))
    return df.filter(F.col("city_name") != "").select(
        "city_name",
        either(F.col("main.temp"), "temperature").alias("temperature"),
        either(F.col("main.humidity"), "humidity").alias("humidity"),
        either(F.col("main.pressure"), "pressure").alias("pressure"),
        either(F.col("wind.speed"), "wind_speed").alias("wind_speed"),
        either(condition, "weather_condition").alias("weather_condition"),
        F.coalesce(stated, arrival).alias("timestamp"),
        arrival.alias("processing_time"),
    )


def click_row(df: DataFrame, arrival: Column | None = None) -> DataFrame:
    """A click message as a counted row, with defaults for missing fields."""
    arrival = F.current_timestamp() if arrival is None else arrival
    extra = [name for name in ("browser", "os", "device_type") if name in df.columns]
    return df.select(
        F.coalesce(F.col("timestamp").try_cast("timestamp"), arrival).alias("event_time"),
        F.coalesce("event_type", F.lit("unknown")).alias("event_type"),
        F.coalesce("country", F.lit("unknown")).alias("country"),
        F.lit(1).cast("long").alias("count"),
        F.coalesce(F.col("duration_ms").cast("double"), F.lit(0.0)).alias("avg_duration"),
        *extra,
    )


def click_action(df: DataFrame) -> DataFrame:
    return df.select("user_id", "timestamp", "action")


def processed_text(value: Column) -> Column:
    return F.concat(F.lit("Processed: "), value)


def sensor_row(df: DataFrame) -> DataFrame:
    """A sensor message as a table row: the nested object stays JSON text."""
    return df.select(
        "message_id",
        "sensor_id",
        F.to_json("message").alias("message"),
        F.col("timestamp").try_cast("timestamp").alias("timestamp"),
    )


# Where each table layout keeps the fields of a reading.
READING_LAYOUTS = {
    "batch": {
        "measurement_date": "processing_date",
        "measurement_time": "measurement_time",
        "temperature": "temperature",
        "humidity": "humidity",
        "pressure": "pressure",
        "wind_speed": "wind_speed",
        "weather_condition": "weather_condition",
    },
    "streaming": {
        "measurement_time": "timestamp",
        "temperature": "temperature",
        "humidity": "humidity",
        "pressure": "pressure",
        "wind_speed": "wind_speed",
        "weather_condition": "weather_condition",
    },
    "hourly": {
        "measurement_time": "window_start",
        "temperature": "avg_temperature",
        "humidity": "avg_humidity",
        "pressure": "avg_pressure",
    },
}


def unify_readings(df: DataFrame, layout: str, whole_seconds: bool = True) -> DataFrame:
    """The common reading columns of a table, whichever of the three layouts it has."""
    if layout not in READING_LAYOUTS:
        raise ValueError(f"unknown layout: {layout}")
    where = READING_LAYOUTS[layout]
    moment = F.col(where["measurement_time"])
    day = F.col(where["measurement_date"]) if "measurement_date" in where else F.to_date(moment)

    def field(name: str, kind: str) -> Column:
        return (F.col(where[name]) if name in where else F.lit(None)).cast(kind).alias(name)

    return df.select(
        "city_name",
        day.alias("measurement_date"),
        (F.date_trunc("second", moment) if whole_seconds else moment).alias("measurement_time"),
        *[field(name, "double") for name in ("temperature", "humidity", "pressure", "wind_speed")],
        field("weather_condition", "string"),
    )


def read_versions(old: DataFrame, new: DataFrame) -> DataFrame:
    """Records of two schema versions under the newer one; absent columns are NULL."""
    return old.unionByName(new, allowMissingColumns=True)
