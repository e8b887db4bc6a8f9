"""Threshold alerts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Limits:
    """A reading strictly beyond one of these raises an alert."""

    temperature_high: float = 35.0
    temperature_low: float = 5.0
    wind_speed_high: float = 15.0
    humidity_high: float = 90.0


@dataclass(frozen=True)
class Critical:
    """Strictly beyond these an alert is critical. Humidity never is."""

    temperature_high: float
    temperature_low: float
    wind_speed_high: float


LIMITS = Limits()
VIEW_LEVELS = Critical(38.0, 0.0, 20.0)


def service_levels(limits: Limits) -> Critical:
    """Fixed margins beyond the limits."""
    return Critical(
        limits.temperature_high + 3, limits.temperature_low - 3, limits.wind_speed_high + 5
    )


@dataclass(frozen=True)
class _Rule:
    alert_type: str
    column: str
    upper: bool
    limit: float
    critical: float | None
    label: str
    unit: str

    def beyond(self, limit: float) -> Column:
        value = F.col(self.column)
        return value > limit if self.upper else value < limit

    @property
    def violated(self) -> Column:
        return self.beyond(self.limit)

    def text(self, verb: str) -> Column:
        value = F.col(self.column).cast("string")
        return F.concat(F.lit(f"{self.label}{verb}: "), value, F.lit(self.unit))


def _rules(limits: Limits, critical: Critical | None = None) -> list[_Rule]:
    """In order of precedence. Without critical levels of their own, those of the service."""
    critical = critical or service_levels(limits)
    return [
        _Rule("HIGH_TEMPERATURE", "temperature", True, limits.temperature_high,
              critical.temperature_high, "High temperature", "°C"),
        _Rule("LOW_TEMPERATURE", "temperature", False, limits.temperature_low,
              critical.temperature_low, "Low temperature", "°C"),
        _Rule("HIGH_WIND", "wind_speed", True, limits.wind_speed_high,
              critical.wind_speed_high, "High wind speed", " m/s"),
        _Rule("HIGH_HUMIDITY", "humidity", True, limits.humidity_high,
              None, "High humidity", "%"),
    ]


def _first_of(pairs: list[tuple[Column, Column]], default: Column) -> Column:
    result = default
    for condition, value in reversed(pairs):
        result = F.when(condition, value).otherwise(result)
    return result


def any_violation(limits: Limits = LIMITS) -> Column:
    """True where some rule is violated; NULL metrics violate none."""
    first, *others = [r.violated for r in _rules(limits)]
    for test in others:
        first = first | test
    return first


def classify(
    df: DataFrame, limits: Limits = LIMITS, critical: Critical | None = None
) -> DataFrame:
    """Add the alert columns of the first violated rule; unalarming rows are OTHER / info."""
    rules = _rules(limits, critical)
    severe = [r.beyond(r.critical) for r in rules if r.critical is not None]
    is_critical = severe[0] | severe[1] | severe[2]
    kind = _first_of([(r.violated, F.lit(r.alert_type)) for r in rules], F.lit("OTHER"))
    level = _first_of(
        [(is_critical, F.lit("critical")), (any_violation(limits), F.lit("warning"))],
        F.lit("info"),
    )
    message = _first_of(
        [(r.violated, r.text("")) for r in rules], F.lit("Weather condition alert")
    )
    nothing = F.lit(None).cast("double")
    return df.withColumns(
        {
            "alert_type": kind,
            "alert_level": level,
            "message": message,
            "value": _first_of([(r.violated, F.col(r.column)) for r in rules], nothing),
            "threshold": _first_of([(r.violated, F.lit(r.limit)) for r in rules], nothing),
        }
    )


def first_alert(
    df: DataFrame, limits: Limits = LIMITS, critical: Critical | None = None
) -> DataFrame:
    """One alert per violating row, by the first rule it violates."""
    return classify(df.filter(any_violation(limits)), limits, critical)


def explode_alerts(
    df: DataFrame, limits: Limits = LIMITS, critical: Critical | None = None
) -> DataFrame:
    """One alert per violated rule, so none to four per row."""
    found = []
    for rule in _rules(limits, critical):
        level = F.lit("warning")
        if rule.critical is not None:
            level = F.when(rule.beyond(rule.critical), "critical").otherwise("warning")
        alert = F.struct(
            F.lit(rule.alert_type).alias("alert_type"),
            level.alias("alert_level"),
            rule.text(" detected").alias("message"),
            F.col(rule.column).alias("value"),
            F.lit(rule.limit).alias("threshold"),
        )
        found.append(F.when(rule.violated, alert))
    metrics = {"temperature", "wind_speed", "humidity", "pressure"}
    kept = [name for name in df.columns if name not in metrics]
    alerts = df.filter(any_violation(limits)).select(
        *kept, F.explode(F.array_compact(F.array(*found))).alias("_alert")
    )
    return alerts.select(*kept, "_alert.*")


def alert_flag(limits: Limits = LIMITS) -> Column:
    """Short flag put on a message at its origin; NULL where nothing is wrong."""
    return (
        F.when(F.col("temperature") > limits.temperature_high, "EXTREME_HEAT")
        .when(F.col("temperature") < limits.temperature_low, "EXTREME_COLD")
        .when(F.col("wind_speed") > limits.wind_speed_high, "HIGH_WIND")
        .when(F.col("humidity") > limits.humidity_high, "HIGH_HUMIDITY")
    )


def alert_counts(alerts: DataFrame) -> DataFrame:
    """Alerts by type and, in the row without a type, altogether."""
    by_type = alerts.groupBy("alert_type").agg(F.count(F.lit(1)).alias("alerts"))
    return by_type.rollup("alert_type").agg(F.sum("alerts").alias("alerts"))


def threshold_alerts(df: DataFrame, limit: float = 30.0) -> DataFrame:
    """Sensor messages above the limit, as alert messages in JSON."""
    temperature = F.col("message.temperature")
    alert = F.to_json(
        F.struct(
            "message_id",
            "sensor_id",
            temperature.alias("temperature"),
            F.lit("High temperature detected").alias("alert"),
            "timestamp",
        )
    )
    return df.filter(temperature > limit).select(alert.alias("value"))
