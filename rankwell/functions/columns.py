"""Scalar column helpers (all JVM-side built-ins, no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Decimal places used when comparing doubles across engines.
DEC = 6
SIM_DEC = 9


def r6(c: Column | str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, DEC)


def clamp(c: Column, lo: float = 1.0, hi: float = 5.0) -> Column:
    """Clamp to [lo, hi]."""
    return F.greatest(F.lit(float(lo)), F.least(F.lit(float(hi)), c))


def parse_date(c: Column, fmt: str = "dd-MMM-yyyy") -> Column:
    """Text date, NULL when it does not parse."""
    return F.try_to_date(c, fmt)


def flag_to_bool(c: Column) -> Column:
    """P4: '0'/'1' text flag to boolean (NULL when not an integer)."""
    return c.try_cast("int") != 0


def empty_to_null(c: Column) -> Column:
    """P5: '' -> NULL (after trimming)."""
    return F.nullif(F.trim(c), F.lit(""))


def improvement_pct(base: Column, x: Column) -> Column:
    """Relative improvement of x over base in percent."""
    return (base - x) / base * 100


def md5_order_key(seed: int, *cols: str) -> Column:
    """Deterministic pseudo-random order key: md5('seed|c1|c2...')."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in cols]))


def histogram_bin(x: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Equal-width bin over [lo, hi], last bin closed; a constant column
    (lo == hi) puts everything in bin 0."""
    width = (hi - lo).cast("double")
    raw = F.floor((x - lo).cast("double") / width * bins)
    return F.when(width == 0, F.lit(0)).otherwise(F.least(F.lit(bins - 1), raw).cast("int"))
