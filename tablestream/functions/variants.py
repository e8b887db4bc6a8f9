"""Raw JSON as VARIANT: parsed once, read by any number of paths."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_variant(text: Column) -> Column:
    """Parsed JSON; text that is not JSON gives NULL."""
    return F.try_parse_json(text)


def variant_values(variant: str, paths: Mapping[str, tuple[str, str]]) -> list[Column]:
    """Values of a VARIANT column: name to (path, type). A missing path, or a value that doesn't fit
    its type, gives NULL."""
    return [F.try_variant_get(variant, path, kind).alias(name) for name, (path, kind) in paths.items()]


def read_paths(df: DataFrame, text: str, paths: Mapping[str, tuple[str, str]], keep: list[str]) -> DataFrame:
    """``keep`` and the values at the paths of a JSON text column, which is parsed once a row."""
    parsed = df.select(*keep, as_variant(F.col(text)).alias("_parsed"))
    return parsed.select(*keep, *variant_values("_parsed", paths))
