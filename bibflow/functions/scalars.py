"""Scalar column functions (all JVM-side, codegen friendly).

Spark 4 runs with ANSI mode on, where ``to_date('bad')`` and
``cast('x' as int)`` raise.  A feed of scraped text must not stop on one bad
value, so every conversion here is a ``try_*`` form that yields NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_date(c: str | Column, fmt: str | None = None) -> Column:
    """Text -> DATE; malformed text -> NULL."""
    c = col_of(c)
    return F.try_to_date(c, F.lit(fmt)) if fmt else F.try_to_date(c)


# Text that the integer cast takes: digits with an optional sign and fraction
# (fixed pattern; no exponent, no type suffix, no hexadecimal form).
_DECIMAL = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)$"


def safe_int(c: str | Column) -> Column:
    """Text -> INT as the lenient integer cast reads it.

    ``'12'``, ``'12.0'`` and ``' 7 '`` become numbers, truncated toward zero;
    junk, ``'1e3'``, ``'12d'``, ``'0x1p3'`` and what does not fit become NULL.  A
    direct ``try_cast('int')`` would reject ``'12.0'``.
    """
    text = F.trim(col_of(c).cast(T.StringType()))
    return F.when(text.rlike(_DECIMAL), text.try_cast("decimal(38,9)").try_cast(T.LongType()).try_cast(T.IntegerType()))


def concat_date_parts(year: str | Column, month: str | Column, day: str | Column,
                      sep: str = "-") -> Column:
    """Join date parts, skipping NULL parts; all NULL gives '' (P07)."""
    return F.concat_ws(sep, col_of(year), col_of(month), col_of(day))


def flag_normalize(c: str | Column) -> Column:
    """Truth-ish value -> BOOLEAN, NULL or junk -> false."""
    c = col_of(c)
    return F.coalesce(c.cast(T.StringType()).try_cast(T.BooleanType()), F.lit(False))


def flag_as_int(c: str | Column) -> Column:
    """The scraped feed's flag as the 1/0 integer of the typed relation."""
    return F.when(flag_normalize(c), F.lit(1)).otherwise(F.lit(0))


def typed_null(dtype: T.DataType | str) -> Column:
    """A NULL of a declared type, never the untyped ``void``."""
    return F.lit(None).cast(dtype)


def null_struct(struct_type: T.StructType) -> Column:
    """A struct whose fields are all typed NULLs."""
    return F.struct(*[typed_null(f.dataType).alias(f.name) for f in struct_type.fields])
