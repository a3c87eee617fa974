"""Column-level expressions.

Every function takes and returns a ``Column`` built from ``pyspark.sql.functions``
only, so it stays inside whole-stage codegen and pushes no Python into tasks.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..contracts import SILVER_DECIMAL

ColumnOrName = Column | str

# --- Fixed values -----------------------------------------------------------
# Whitespace stripped from both ends of every string in Silver (space, tab, LF, CR, FF, VT).
WHITESPACE = " \t\n\r\f\u000b"
# GPS free-text patterns: a signed decimal latitude, then a separator
# (comma, semicolon, slash, or plain spaces), then a longitude whose sign may be
# followed by spaces.
GPS_LAT_PATTERN = r"^[+-]?\d+(?:\.\d+)?"
GPS_LON_PATTERN = r"^[+-]?\d+(?:\.\d+)?(?:\s*[,;/]\s*|\s+)([+-]?\s*\d+(?:\.\d+)?)"
# Bounding box of valid in-country points: latitude 0.6..15.7, longitude -73.5..-59.7.
GPS_BBOX = (0.6, 15.7, -73.5, -59.7)
GPS_STATES = ("NO_PARSEABLE", "VALIDO_VENEZUELA", "FUERA_VENEZUELA")
PSEUDONYM_PREFIX = "usr_"
# ---------------------------------------------------------------------------


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_str(c: ColumnOrName) -> Column:
    """Value as string with leading/trailing whitespace removed (a plain character-set
    trim, no regex engine per value)."""
    return F.btrim(_c(c).cast("string"), F.lit(WHITESPACE))


def to_ts(c: ColumnOrName) -> Column:
    """ISO text (up to 7 fractional digits) or any castable text -> timestamp, NULL when bad."""
    s = clean_str(c)
    return F.coalesce(F.try_to_timestamp(s), s.try_cast("timestamp"))


def to_date_safe(c: ColumnOrName) -> Column:
    """Safe cast to DATE (NULL when not a date)."""
    return clean_str(c).try_cast("date")


def to_num(c: ColumnOrName, dtype=SILVER_DECIMAL) -> Column:
    """Safe cast to the Silver numeric type (decimal(28,10)); NULL when bad text."""
    col = _c(c)
    return col.cast("string").try_cast(dtype) if dtype is not None else col


def first_nonblank(*cols: ColumnOrName) -> Column:
    """P5: first argument that is not NULL and not blank after trimming; last one taken as is."""
    *head, last = cols
    return F.coalesce(*[F.nullif(clean_str(c), F.lit("")) for c in head], _c(last))


def safe_ratio(a: ColumnOrName, b: ColumnOrName, scale: int | None = 2) -> Column:
    """A / b, NULL when b is 0 or NULL, rounded half-up to ``scale``."""
    q = F.try_divide(_c(a), F.nullif(_c(b), F.lit(0)))
    return F.round(q, scale) if scale is not None else q


def pseudonymize(c: ColumnOrName) -> Column:
    """``usr_`` + first 16 hex chars of sha256(lower(trim(x)))."""
    return F.concat(F.lit(PSEUDONYM_PREFIX), F.substring(F.sha2(F.lower(clean_str(c)), 256), 1, 16))


def gps_lat_lon(c: ColumnOrName) -> tuple[Column, Column]:
    """(latitude, longitude) doubles parsed from free GPS text; NULLs when absent."""
    s = clean_str(c)
    lat = F.nullif(F.regexp_extract(s, GPS_LAT_PATTERN, 0), F.lit(""))
    lon = F.nullif(F.regexp_extract(s, GPS_LON_PATTERN, 1), F.lit(""))
    lat_d = lat.try_cast("double")
    lon_d = F.regexp_replace(lon, r"\s+", "").try_cast("double")
    return lat_d, lon_d


def gps_status(lat: ColumnOrName, lon: ColumnOrName, bbox=GPS_BBOX) -> tuple[Column, Column]:
    """(gps_valido boolean, gps_estado label) by bounding box."""
    lat, lon = _c(lat), _c(lon)
    lat_lo, lat_hi, lon_lo, lon_hi = bbox
    inside = lat.between(lat_lo, lat_hi) & lon.between(lon_lo, lon_hi)
    missing = lat.isNull() | lon.isNull()
    valid = F.when(missing, F.lit(False)).when(inside, F.lit(True)).otherwise(F.lit(False))
    state = F.when(missing, F.lit(GPS_STATES[0])).when(inside, F.lit(GPS_STATES[1])).otherwise(F.lit(GPS_STATES[2]))
    return valid, state


MONEY = "decimal(18,2)"
RATE = "decimal(18,6)"


def money_columns(net: ColumnOrName, tax: ColumnOrName, rate: ColumnOrName, disc_pct: ColumnOrName) -> dict[str, Column]:
    """neto = (net + tax) * rate; neto_dcto = neto * (1 - disc/100); tasa = 1/rate.

    Computed in decimals (no float drift) and stored as decimal(18,2) money and a
    decimal(18,6) rate, wide enough that large invoices do not overflow.
    """
    d = "decimal(18,6)"
    gross = (_c(net).cast(d) + _c(tax).cast(d)) * _c(rate).cast(d)
    disc = _c(disc_pct).cast(d)
    return {
        "neto": gross.cast(MONEY),
        "dcto": disc.cast(MONEY),
        "tasa": F.try_divide(F.lit(1).cast(d), F.nullif(_c(rate).cast(d), F.lit(0))).cast(RATE),
        "neto_dcto": (gross * (F.lit(1) - disc / F.lit(100))).cast(MONEY),
    }
