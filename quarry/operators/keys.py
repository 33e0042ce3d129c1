"""L: key assignment.

* ``assign_identity``: dense sequence numbers (start, increment) in a stable
  order, via the distributed row number (no single-task global window);
  ``append_identity`` continues after the current maximum.
* ``uuid4_keys``: random keys; materialised once so they never change
  between reads.
* ``uuid7`` / ``uuid7_millis``: time-ordered UUID v7 text built with column
  expressions; the random fields come from an MD5 of the row id, so the key
  is repeatable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import epoch_millis
from .windows import row_number

def assign_identity(df: DataFrame, order: list[tuple[str, bool]], name: str = "id", start: int = 1,
                    increment: int = 1) -> DataFrame:
    r = row_number(df, [], order, "_id_rn")
    return r.withColumn(name, (F.col("_id_rn") - 1) * increment + start).drop("_id_rn")


def append_identity(existing: DataFrame, id_col: str, new_rows: DataFrame, order: list[tuple[str, bool]],
                    increment: int = 1) -> DataFrame:
    """New rows get ids after max(existing id) (one-row aggregate)."""
    from .relational import with_scalars

    mx = existing.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("_max_id"))
    r = row_number(new_rows, [], order, "_id_rn")
    return (with_scalars(r, mx)
            .withColumn(id_col, F.col("_max_id") + F.col("_id_rn") * increment).drop("_id_rn", "_max_id"))


def uuid4_keys(df: DataFrame, name: str = "uuid") -> DataFrame:
    return df.withColumn(name, F.expr("uuid()"))


def uuid7(ts: str, row_id: str) -> Column:
    """48-bit Unix ms, version 7, 12 random bits, variant 10, 62 random bits.

    The high 64 bits are ``ms << 16 | 7 << 12 | rand_a`` (fits a signed long
    for any date before year 6000); the variant nibble is ``8 | (r & 3)``.
    The random fields are MD5 hex digits of the row id (repeatable)."""
    h = F.md5(F.col(row_id).cast("string"))
    rand_a = F.conv(F.substring(h, 1, 3), 16, 10).cast("long")
    msb = F.shiftleft(epoch_millis(ts), 16).bitwiseOR(F.lit(7 << 12)).bitwiseOR(rand_a)
    msb_hex = F.lpad(F.lower(F.hex(msb)), 16, "0")
    r = F.conv(F.substring(h, 4, 1), 16, 10).cast("int")
    variant = F.lower(F.hex(F.lit(8).bitwiseOR(r.bitwiseAND(F.lit(3)))))
    raw = F.concat(msb_hex, variant, F.substring(h, 5, 15))
    return F.concat_ws("-", F.substring(raw, 1, 8), F.substring(raw, 9, 4), F.substring(raw, 13, 4),
                       F.substring(raw, 17, 4), F.substring(raw, 21, 12))


def uuid7_millis(u: str) -> Column:
    """Unix ms out of a UUID v7 (first 48 bits)."""
    return F.conv(F.substring(F.replace(F.col(u), F.lit("-"), F.lit("")), 1, 12), 16, 10).cast("long")
