"""Scalar and aggregate column expressions shared by the operators.

All of these are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Portable hash used for seeded splits, folds and masks: three rounds of
# xor-shift and modular multiplication (multipliers of minimal standard generators), identical
# in Spark and in any SQL engine. Every product stays below 2^48.
HASH_MOD = 2147483647
HASH_SEED_STEP = 1000003
HASH_ROUNDS = [(15, 48271), (13, 69621), (16, 40692)]


def col(c) -> Column:
    """Column by name, back-ticked so names with dots work."""
    if isinstance(c, Column):
        return c
    return F.col(f"`{c}`")


def r6(c) -> Column:
    """Round late, to 6 decimals; +0.0 folds -0.0 into 0.0."""
    return F.round(col(c).cast("double"), 6) + F.lit(0.0)


def significant(c) -> Column:
    """Round to eight significant digits, whatever the magnitude; NULL stays NULL."""
    x = col(c).cast("double")
    return F.when(x.isNotNull(), F.format_string("%.7e", x).cast("double") + F.lit(0.0))


def portable_hash(key, seed: int = 42) -> Column:
    """Deterministic pseudo-random integer in [0, 2^31-1) from an integer key.

    The key is reduced modulo 2^31-1 first, so no product overflows whatever the key. The seed
    (a number, or a column) enters before the first and after the second xor-shift, so two seeds
    give unrelated orders and not a rotation of one."""
    s = seed if isinstance(seed, Column) else F.lit(seed).cast("long")
    h = F.pmod(F.pmod(col(key).cast("long"), F.lit(HASH_MOD)) + s * HASH_SEED_STEP, F.lit(HASH_MOD))
    for i, (shift, mult) in enumerate(HASH_ROUNDS):
        h = h.bitwiseXOR(F.shiftright(h, shift)) * mult
        h = F.pmod(h + s if i == 1 else h, F.lit(HASH_MOD))
    return h


def portable_hash_sql(key: str, seed: int | str = 42) -> str:
    """SQL twin of ``portable_hash`` for non-negative keys (``seed``: a number or a column)."""
    h = f"((({key}) % {HASH_MOD} + CAST({seed} AS BIGINT) * {HASH_SEED_STEP}) % {HASH_MOD})"
    for i, (shift, mult) in enumerate(HASH_ROUNDS):
        h = f"xor({h}, {h} >> {shift}) * {mult}"
        h = f"(({h} + {seed}) % {HASH_MOD})" if i == 1 else f"(({h}) % {HASH_MOD})"
    return h


def portable_unit(key, seed: int = 42) -> Column:
    """Deterministic pseudo-random double in [0, 1) from an integer key."""
    return portable_hash(key, seed) / F.lit(float(HASH_MOD))


def clean_name(name: str) -> str:
    """Column-name cleaning: strip surrounding blanks and remove double quotes."""
    return name.strip().replace('"', "")


def encode_label(c, positive: str = "ad.", negative: str = "noad.") -> Column:
    """Label text -> 1/0 after trim+lower; other values give NULL (callers check and fail)."""
    v = F.lower(F.trim(col(c)))
    return F.when(v == positive, F.lit(1)).when(v == negative, F.lit(0))


def decode_label(c, positive: str = "ad.", negative: str = "noad.") -> Column:
    """0/1 -> label text."""
    return F.when(col(c) == 1, F.lit(positive)).when(col(c) == 0, F.lit(negative))


def finite_or(c, value: float = 0.0) -> Column:
    """Replace NULL, NaN and +/-Inf by a value."""
    x = col(c).cast("double")
    bad = x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return F.when(bad, F.lit(float(value))).otherwise(x)


def nan_to_null(c) -> Column:
    """NaN -> NULL; other values as they are."""
    x = col(c)
    return F.when(F.isnan(x), F.lit(None).cast("double")).otherwise(x)


def at_threshold(score, t) -> Column:
    """Inclusive decision rule score >= t, as int."""
    return (col(score) >= (t if isinstance(t, Column) else F.lit(float(t)))).cast("int")


def safe_corr(a, b) -> Column:
    """Pearson correlation on pairwise-complete rows; NULL when either side is constant.

    ``F.corr`` raises DIVIDE_BY_ZERO under ANSI for a constant column, so this is built from
    covariance and standard deviations with ``try_divide``.
    """
    x, y = col(a).cast("double"), col(b).cast("double")
    both = x.isNotNull() & y.isNotNull()
    sx = F.stddev_samp(F.when(both, x))
    sy = F.stddev_samp(F.when(both, y))
    return F.try_divide(F.covar_samp(x, y), sx * sy)


def skew_adjusted(c) -> Column:
    """Bias-adjusted sample skewness G1 = g1*sqrt(n(n-1))/(n-2) (pandas ``skew``)."""
    n = F.count(col(c)).cast("double")
    g1 = F.skewness(col(c))
    return F.try_divide(g1 * F.sqrt(n * (n - 1)), n - 2)


def yeo_johnson(c, lmbda: float) -> Column:
    """Yeo-Johnson transform with a fixed lambda, as a column expression."""
    x = col(c).cast("double")
    lm = float(lmbda)
    if abs(lm) < 1e-12:
        pos = F.log1p(x)
    else:
        pos = (F.pow(x + 1.0, lm) - 1.0) / lm
    if abs(lm - 2.0) < 1e-12:
        neg = -F.log1p(-x)
    else:
        neg = -(F.pow(1.0 - x, 2.0 - lm) - 1.0) / (2.0 - lm)
    return F.when(x.isNull(), F.lit(None).cast("double")).when(x >= 0, pos).otherwise(neg)


def box_cox(c, lmbda: float, shift: float = 0.0) -> Column:
    """Box-Cox transform of (x + shift) with a fixed lambda."""
    x = col(c).cast("double") + F.lit(float(shift))
    lm = float(lmbda)
    if abs(lm) < 1e-12:
        return F.log(x)
    return (F.pow(x, lm) - 1.0) / lm


def clip(c, lo=None, hi=None) -> Column:
    """Clip to [lo, hi]; a missing bound means no clip on that side; NULL stays NULL."""
    x = col(c)
    out = x
    if hi is not None:
        out = F.when(out > F.lit(hi), F.lit(hi)).otherwise(out)
    if lo is not None:
        out = F.when(out < F.lit(lo), F.lit(lo)).otherwise(out)
    return out
