"""Scalar ``Column`` builders shared by every operator (all JVM-side, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: 2**52 scales a 13-hex-digit md5 prefix to [0, 1) without rounding
HASH_SCALE = 4503599627370496.0


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_int24(seed, key) -> Column:
    """First 24 bits of md5("seed|key") as a long in [0, 2**24)."""
    text = F.concat(F.lit(f"{seed}|"), col(key).cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 6), 16, 10).cast("long")


def hash_uniform(seed, key) -> Column:
    """Deterministic uniform in [0, 1) from md5 — the same number DuckDB computes with
    ``cast(('0x'||substr(md5(concat('seed|', cast(key as varchar))),1,13)) as bigint)/4503599627370496.0``."""
    text = F.concat(F.lit(f"{seed}|"), col(key).cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(HASH_SCALE)


def clip(c, lo: float, hi: float) -> Column:
    """Clamp to [lo, hi]; null stays null (``greatest``/``least`` alone would skip it)."""
    c = col(c)
    return F.when(c.isNotNull(), F.greatest(F.lit(lo), F.least(F.lit(hi), c)))


def logit(p, eps: float | None = None) -> Column:
    p = col(p)
    if eps is not None:
        p = clip(p, eps, 1.0 - eps)
    return F.ln(p / (F.lit(1.0) - p))


def sigmoid(z) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-col(z)))


def as_int(pred: Column) -> Column:
    """Boolean predicate → 0/1 int; null predicate → 0 (pandas ``astype(int)`` on NaN comparisons)."""
    return F.coalesce(pred.cast("int"), F.lit(0))


def safe_div(a, b) -> Column:
    return F.try_divide(col(a), col(b))


def round_doubles(df, digits: int = 6, only=None):
    """Round double columns (all, or those named in ``only``) — oracle comparison contract."""
    out = []
    for f in df.schema.fields:
        if f.dataType.typeName() in ("double", "float") and (only is None or f.name in only):
            out.append(F.round(F.col(f.name), digits).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
