"""At-least-once delivery: keep exactly one copy of each message."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftmark.functions.ids import CANONICAL, identity
from driftmark.session import fresh_name


def _plain(df: DataFrame, column: str) -> Column:
    """One column of a message's identifier in a spelling that is the same for equal values."""
    c, kind = F.col(f"`{column}`"), df.schema[column].dataType
    if isinstance(kind, T.IntegralType):
        return c.cast("long")
    return identity(c) if isinstance(kind, T.StringType) else c.cast("string") if isinstance(kind, T.AtomicType) else F.to_json(F.struct(c))


def _short(c: Column, whole_number: bool) -> Column:
    """The same as bytes: whole numbers and UUIDs at fixed width, other text with its length in front."""
    if whole_number:
        return F.unhex(F.lpad(F.hex(c), 16, "0"))
    sized = F.concat(F.lit(b"\x01"), F.unhex(F.lpad(F.hex(F.octet_length(c).cast("long")), 8, "0")), c.cast("binary"))
    return F.when((F.length(c) == 36) & c.rlike(CANONICAL), F.concat(F.lit(b"\x00"), F.unhex(F.replace(c, F.lit("-"), F.lit(""))))).otherwise(sized)


def _with_message(df: DataFrame, id_columns: Sequence[str], name: str) -> DataFrame:
    """The rows that have a whole identifier, with it in few bytes, different for different messages. The spellings
    are a projection of their own, so that they are worked out once."""
    plain = {f"{name}_{i}": _plain(df, c) for i, c in enumerate(id_columns)}
    present = df.filter(reduce(Column.__and__, [F.col(f"`{c}`").isNotNull() for c in id_columns]))
    numbers = [isinstance(df.schema[c].dataType, T.IntegralType) for c in id_columns]
    return present.withColumns(plain).withColumn(name, F.concat(*[_short(F.col(n), w) for n, w in zip(plain, numbers)])).drop(*plain)


def _holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind.fields)
    return isinstance(kind, T.MapType) or isinstance(kind, T.ArrayType) and _holds_map(kind.elementType)


def _order(df: DataFrame, order_columns: Sequence[str]) -> Column:
    """When a row was delivered, and a hash of all of it to break ties alike in every partitioning."""
    content = [F.to_json(F.struct(f"`{f.name}`")) if _holds_map(f.dataType) else F.col(f"`{f.name}`") for f in df.schema.fields]
    return F.struct(*[F.col(f"`{c}`").alias(f"o{i}") for i, c in enumerate(order_columns)], F.xxhash64(*content).alias("tie"))


def first_copies(keyed: DataFrame, message: str, order: str) -> DataFrame:
    """(``message``, ``order``): the least order of each message.

    One aggregation by the message with ``min_by`` over a struct of delivery time and tie-break. Partial
    aggregation on the map side leaves at most one row per message and task, so a message that makes up a third
    of all rows costs no more than any other.
    """
    return keyed.groupBy(message).agg(F.min_by(order, order).alias(order))


def redundant_copies(df: DataFrame, id_columns: Sequence[str], order_columns: Sequence[str]) -> DataFrame:
    """Every row that is a copy of an earlier delivery of the same message.

    Rows are copies when all ``id_columns`` are non-null and equal, text compared as UUIDs whatever the
    spelling. The first copy by ``order_columns`` (nulls first) is not redundant; of several first ones it is
    that with the least hash of its content. Rows with a null identifier are never copies. Rows equal in every
    column are one delivery recorded again: none of them is redundant if it comes first. An empty table gives an
    empty result; other columns pass through.

    The join back is on message and order together, so that the rows of a hot message are spread evenly.
    """
    message, order = fresh_name(df, "message"), fresh_name(df, "order")
    keyed = _with_message(df.withColumn(order, _order(df, order_columns)), id_columns, message)
    kept = first_copies(keyed.select(message, order), message, order)
    same = [F.col(f"l.{message}") == F.col(f"r.{message}")]
    same += [F.col(f"l.{order}.{o}").eqNullSafe(F.col(f"r.{order}.{o}")) for o in (*[f"o{i}" for i in range(len(order_columns))], "tie")]
    return keyed.alias("l").join(kept.alias("r"), reduce(Column.__and__, same), "left_anti").drop(message, order)


def deduplicate(df: DataFrame, id_columns: Sequence[str], order_columns: Sequence[str]) -> DataFrame:
    """One row per message, the first by ``order_columns``; rows without a full identifier all stay.

    The whole row travels in the ``min_by`` payload, so one shuffle of partially aggregated rows does it.
    Full ties are broken by the content of the row, so the result does not depend on the partitioning.
    """
    columns, message = [F.col(f"`{c}`") for c in df.columns], fresh_name(df, "message")
    whole = F.struct(*columns)
    tie = F.struct(_order(df, order_columns), F.to_json(whole))
    once = _with_message(df, id_columns, message).groupBy(message).agg(F.min_by(whole, tie).alias("row")).select("row.*")
    return once.unionByName(df.filter(reduce(Column.__or__, [F.col(f"`{c}`").isNull() for c in id_columns])))
