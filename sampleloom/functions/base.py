"""Small helpers shared by all expression modules."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str

# The marker of an absent label (lowest FLOAT) and of a positive one.
INVALID_LABEL = -3.4028234663852886e38
POSITIVE_LABEL = 1.0


def col_of(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lit_array(values: Sequence, element: str) -> Column:
    """Array literal of a fixed element type; also right for an empty list."""
    return F.array(*[F.lit(v) for v in values]).cast(f"array<{element}>")


def lit_map(mapping: dict, key: str, value: str) -> Column:
    flat = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.create_map(*flat).cast(f"map<{key},{value}>")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also when the body uses it per list element."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))


def u01(key: ColumnLike, salt: str | Column) -> Column:
    """Repeatable uniform number in [0, 1) from a row key; stands in for every random draw."""
    salt = F.lit(salt) if isinstance(salt, str) else salt.cast("string")
    text = F.concat_ws("|", col_of(key).cast("string"), salt)
    return u32(text).cast("double") / F.lit(4294967296.0)


def u32(text: Column) -> Column:
    """First 32 bits of the md5 of a text, as BIGINT."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")


def tail(v: Column, n: int) -> Column:
    """Array without its first ``n`` elements, however long it is."""
    return F.slice(v, n + 1, F.greatest(F.size(v) - n, F.lit(0)))
