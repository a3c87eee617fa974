"""Deterministic ids and hashes (H1-H3) as Spark expressions.

All hashes are SHA-256 hex, computed JVM-side with ``sha2``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- Fixed values: separators of the hash formulas --------------------------
UNIT_SEPARATOR = "\x1f"
NULL_SENTINEL = "\x00NULL\x00"
BATCH_SEPARATOR = "|"
# Canonical text of non-string values inside a row hash.
CANONICAL_TS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
CANONICAL_DECIMAL = "decimal(38,10)"
# ---------------------------------------------------------------------------


def payload_hash(payload: Column | str) -> Column:
    """H1: sha256 of the exact payload bytes (binary or UTF-8 text)."""
    c = F.col(payload) if isinstance(payload, str) else payload
    return F.sha2(c, 256)


def batch_id(empresa: Column | str, query_id: Column | str, dt: Column | str, p_hash: Column | str) -> Column:
    """H2: sha256('empresa|query|dt|payload_hash')."""
    parts = [F.col(x) if isinstance(x, str) else x for x in (empresa, query_id, dt, p_hash)]
    return F.sha2(F.concat_ws(BATCH_SEPARATOR, *[p.cast("string") for p in parts]), 256)


def canonical_text(field: T.StructField) -> Column:
    """One canonical string per value, independent of the engine's default casts."""
    c = F.col(field.name)
    t = field.dataType
    if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        s = F.date_format(c, CANONICAL_TS)
    elif isinstance(t, (T.FloatType, T.DoubleType, T.DecimalType, T.IntegerType, T.LongType, T.ShortType)):
        s = c.cast(CANONICAL_DECIMAL).cast("string")
    elif isinstance(t, T.DateType):
        s = F.date_format(c, "yyyy-MM-dd")
    else:
        s = c.cast("string")
    return F.coalesce(s, F.lit(NULL_SENTINEL))


def row_hash_expr(df: DataFrame, cols: list[str] | None = None) -> Column:
    """H3: sha256 of the values ordered by column name, joined by 0x1F, NULL -> sentinel.

    The order is fixed at plan time (sorted names), so the hash does not depend
    on the physical column order of the input.
    """
    names = sorted(cols if cols is not None else df.columns)
    fields = {f.name: f for f in df.schema.fields}
    return F.sha2(F.concat_ws(UNIT_SEPARATOR, *[canonical_text(fields[n]) for n in names]), 256)


def packed_hash(c: Column | str) -> Column:
    """A hash as bytes for the way through a shuffle: SHA-256 hex takes half its length (hex does not compress), any other text stays
    whole. Hashes keep their order, as do other texts among themselves; NULL stays NULL. ``unpacked_hash`` gives the text back."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.rlike(r"^[0-9a-f]{64}\z"), F.concat(F.lit(b"\x01"), F.unhex(c))).otherwise(F.concat(F.lit(b"\x00"), c.cast("binary")))


def unpacked_hash(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    rest = F.substring(c, 2, 2**31 - 1)
    return F.when(F.substring(c, 1, 1) == F.lit(b"\x01"), F.lower(F.hex(rest))).otherwise(rest.cast("string"))


def with_row_hash(df: DataFrame, cols: list[str] | None = None, name: str = "_row_hash") -> DataFrame:
    return df.withColumn(name, row_hash_expr(df, cols))
