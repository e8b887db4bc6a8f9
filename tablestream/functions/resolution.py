"""Rows stored under one schema, read under another.

A reader's field takes the stored field of its name or, failing that, of one of its aliases. Numbers
may be stored narrower than they are read (int, long, float, double, in that order), and text and
bytes stand for each other. A field that isn't stored takes its default. Nested records, lists and maps
are resolved in the same way. The rules are those of Avro; aliases and defaults stand in the metadata
of the reader's fields.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    ByteType,
    DataType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    ShortType,
    StringType,
    StructField,
    StructType,
)

_WIDER: list[type[DataType]] = [ByteType, ShortType, IntegerType, LongType, FloatType, DoubleType]
_TEXT = (StringType, BinaryType)
_MISSING = object()


def field(name: str, kind: DataType, nullable: bool = True, default=_MISSING, aliases: tuple[str, ...] = ()) -> StructField:
    """A field of a reader's schema."""
    metadata: dict = {"aliases": list(aliases)} if aliases else {}
    if default is not _MISSING:
        metadata["default"] = json.dumps(default)
    return StructField(name, kind, nullable, metadata)


def _stored(writer: StructType, wanted: StructField) -> StructField | None:
    have = {f.name: f for f in writer.fields}
    for name in (wanted.name, *wanted.metadata.get("aliases", ())):
        if name in have:
            return have[name]
    return None


def _promotes(stored: DataType, wanted: DataType) -> bool:
    if stored == wanted or (isinstance(stored, _TEXT) and isinstance(wanted, _TEXT)):
        return True
    kinds = [type(stored), type(wanted)]
    return all(k in _WIDER for k in kinds) and _WIDER.index(kinds[0]) <= _WIDER.index(kinds[1])


def problems(writer: DataType, reader: DataType, at: str = "") -> list[str]:
    """What keeps a reader from reading rows of a writer; empty if it can."""
    if isinstance(writer, StructType) and isinstance(reader, StructType):
        out = []
        for wanted in reader.fields:
            place = f"{at}.{wanted.name}" if at else wanted.name
            stored = _stored(writer, wanted)
            if stored is None:
                if "default" not in wanted.metadata:
                    out.append(f"{place}: not stored and without a default")
                continue
            if stored.nullable and not wanted.nullable:
                out.append(f"{place}: may be NULL where the reader allows none")
            out += problems(stored.dataType, wanted.dataType, place)
        return out
    if isinstance(writer, ArrayType) and isinstance(reader, ArrayType):
        return problems(writer.elementType, reader.elementType, f"{at}[]")
    if isinstance(writer, MapType) and isinstance(reader, MapType):
        return [
            *problems(writer.keyType, reader.keyType, f"{at}{{key}}"),
            *problems(writer.valueType, reader.valueType, f"{at}{{}}"),
        ]
    if _promotes(writer, reader):
        return []
    return [f"{at}: {writer.simpleString()} can't be read as {reader.simpleString()}"]


def compatibility(old: StructType, new: StructType) -> str:
    """``full`` if each schema can read rows of the other, ``backward`` if the new one can read old
    rows, ``forward`` if the old one can read new rows, else ``none``."""
    back, forth = not problems(old, new), not problems(new, old)
    return {(True, True): "full", (True, False): "backward", (False, True): "forward"}.get((back, forth), "none")


def _default(wanted: StructField) -> Column:
    value = json.loads(wanted.metadata["default"])
    if value is None:
        return F.lit(None).cast(wanted.dataType)
    if isinstance(wanted.dataType, (StructType, ArrayType, MapType)):
        return F.from_json(F.lit(json.dumps(value)), wanted.dataType)
    return F.lit(value).cast(wanted.dataType)


def _resolved(value: Column, stored: DataType, wanted: DataType) -> Column:
    if stored == wanted:
        return value
    if isinstance(wanted, StructType):
        return F.when(value.isNotNull(), F.struct(*_fields(value, stored, wanted)))
    if isinstance(wanted, ArrayType):
        return F.transform(value, lambda x: _resolved(x, stored.elementType, wanted.elementType))
    if isinstance(wanted, MapType):
        return F.transform_values(value, lambda _, x: _resolved(x, stored.valueType, wanted.valueType))
    return value.cast(wanted)


def _fields(row: Column | None, writer: StructType, reader: StructType) -> list[Column]:
    out = []
    for wanted in reader.fields:
        stored = _stored(writer, wanted)
        if stored is None:
            out.append(_default(wanted).alias(wanted.name))
            continue
        value = F.col(f"`{stored.name}`") if row is None else row.getField(stored.name)
        out.append(_resolved(value, stored.dataType, wanted.dataType).alias(wanted.name))
    return out


def resolve(rows: DataFrame, reader: StructType) -> DataFrame:
    """The rows under the reader's schema; a reader that can't read them is refused."""
    found = problems(rows.schema, reader)
    if found:
        raise ValueError("; ".join(found))
    return rows.select(*_fields(None, rows.schema, reader))
