"""Decoding of a topic whose messages were written with several schemas.

Every message names its schema by the id in its header. A ``Layout`` per id says how its payload reads and how its
fields become those of the contract: renamed, promoted to a wider type, or absent and given a default. One pass
without a shuffle does all ids: a payload is parsed by its own layout only. Bounded and unbounded frames alike.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commutewell.contract import ContractViolation
from commutewell.functions.wire import HEADER_BYTES, payload, schema_id

# Why a message gives no record.
NO_MESSAGE = "no message"
NO_HEADER = "no header"
UNKNOWN_SCHEMA = "unknown schema"
UNREADABLE = "unreadable payload"
INCOMPLETE = "required field missing"

# Types whose every value fits the wider one, up to the digits of a floating-point number.
_WIDER = {
    T.ByteType: (T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType),
    T.ShortType: (T.IntegerType, T.LongType, T.FloatType, T.DoubleType),
    T.IntegerType: (T.LongType, T.FloatType, T.DoubleType),
    T.LongType: (T.FloatType, T.DoubleType),
    T.FloatType: (T.DoubleType,),
    T.DateType: (T.TimestampType, T.TimestampNTZType),
}
_BROKEN = "_broken"


@dataclass(frozen=True)
class Layout:
    """How one schema's payload becomes the contract's record.

    ``codec`` turns payload bytes into a struct of ``record``'s fields, ``renames`` maps a contract field to the
    name it was written under, ``defaults`` holds values of fields that this schema lacks.
    """

    record: T.StructType
    codec: object
    renames: Mapping[str, str] = field(default_factory=dict)
    defaults: Mapping[str, object] = field(default_factory=dict)


def json_layout(record: T.StructType, renames: Mapping[str, str] = {}, defaults: Mapping[str, object] = {}) -> Layout:
    """Layout of JSON objects with ``record``'s fields; text that is no such object, or holds other types, is unreadable."""
    # Spark marks broken text only where the marking column is part of the schema.
    nullable = T.StructType([T.StructField(f.name, f.dataType) for f in record.fields])
    marked = T.StructType([*nullable.fields, T.StructField(_BROKEN, T.StringType())])
    options = {"columnNameOfCorruptRecord": _BROKEN}
    return Layout(record, lambda content: F.from_json(content.cast("string"), marked, options), renames, defaults)


def is_wider(written: T.DataType, wanted: T.DataType) -> bool:
    """Whether every value of ``written`` is one of ``wanted``."""
    return written == wanted or isinstance(wanted, _WIDER.get(type(written), ()))


def check_layout(layout: Layout, contract: T.StructType) -> None:
    """Raise ``ContractViolation`` where ``layout`` cannot fill ``contract``.

    That is: a renamed or defaulted field the contract does not have, a rename of a field that was not written, a type
    that would have to shrink, or a required field that is neither written nor given a default.
    """
    faults = [f"{name} is not in the contract" for name in {*layout.renames, *layout.defaults} - set(contract.names)]
    faults += [f"{name} was not written" for name in set(layout.renames.values()) - set(layout.record.names)]
    for f in contract.fields:
        written = layout.renames.get(f.name, f.name)
        if written in layout.record.names:
            have = layout.record[written].dataType
            if not is_wider(have, f.dataType):
                faults.append(f"{f.name}: {have.simpleString()} does not widen to {f.dataType.simpleString()}")
        elif not f.nullable and layout.defaults.get(f.name) is None:
            faults.append(f"{f.name} is required and has no default")
    if faults:
        raise ContractViolation("; ".join(sorted(faults)))


def resolve(messages: DataFrame, layouts: Mapping[int, Layout], contract: T.StructType, keep: Iterable[str] = ()) -> DataFrame:
    """One row per message: ``keep``, the contract's columns, ``schema_id``, ``problem`` and, with a problem, its ``value``.

    ``problem`` is NULL for a record and says why there is none otherwise; its contract columns are then NULL. A NULL
    message, a message without the header's five bytes or with another first byte than 0, an id without a layout, a
    payload its layout cannot read and a record without a required field are such cases. A written NULL stays NULL, it
    does not take the default: that is for fields the schema lacks.
    """
    keep = list(keep)
    for layout in layouts.values():
        check_layout(layout, contract)
    value, number = F.col("value"), F.col("schema_id")
    framed = (F.octet_length(value) >= HEADER_BYTES) & (F.substring(value, 1, 1) == F.lit(b"\x00"))
    numbered = messages.select(*keep, "value", F.when(framed, schema_id(value)).alias("schema_id"))
    # A column per layout, parsed for its own messages only; NULL elsewhere.
    parsed = numbered.select("*", *[F.when(number == i, x.codec(payload(value))).alias(f"_layout{i}") for i, x in layouts.items()])
    readable, columns = F.lit(False), {f.name: F.lit(None) for f in contract.fields}
    for i, layout in layouts.items():
        data = F.col(f"_layout{i}")
        names = parsed.schema[f"_layout{i}"].dataType.names
        whole = data.isNotNull() & (data[_BROKEN].isNull() if _BROKEN in names else F.lit(True))
        # Empty text is no object, yet not marked as broken.
        whole = whole & (F.octet_length(value) > HEADER_BYTES)
        readable = readable | F.coalesce((number == i) & whole, F.lit(False))
        for f in contract.fields:
            columns[f.name] = F.when((number == i) & whole, _field(layout, f, data)).otherwise(columns[f.name])
    missing = F.lit(False)
    for f in contract.fields:
        if not f.nullable:
            missing = missing | F.col(f.name).isNull()
    read = parsed.select(*keep, "value", "schema_id", readable.alias("_readable"), *[columns[f.name].cast(f.dataType).alias(f.name) for f in contract.fields])
    problem = (
        F.when(value.isNull(), NO_MESSAGE)
        .when(number.isNull(), NO_HEADER)
        .when(~number.isin(list(layouts)), UNKNOWN_SCHEMA)
        .when(~F.col("_readable"), UNREADABLE)
        .when(missing, INCOMPLETE)
    )
    judged = read.select("*", problem.alias("problem"))
    good = F.col("problem").isNull()
    return judged.select(
        *keep, *[F.when(good, F.col(f.name)).alias(f.name) for f in contract.fields], "schema_id", "problem", F.when(~good, value).alias("value")
    )


def _field(layout: Layout, f: T.StructField, data: Column) -> Column:
    written = layout.renames.get(f.name, f.name)
    if written in layout.record.names:
        return data[written].cast(f.dataType)
    return F.lit(layout.defaults.get(f.name)).cast(f.dataType)


def records(resolved: DataFrame, contract: T.StructType, keep: Iterable[str] = ()) -> DataFrame:
    """The records of a resolved frame."""
    return resolved.where(F.col("problem").isNull()).select(*keep, *contract.names)


def set_aside(resolved: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """The messages of a resolved frame that gave no record, with their bytes, to be decoded again once their schema is known."""
    return resolved.where(F.col("problem").isNotNull()).select(*keep, "schema_id", "problem", "value")
