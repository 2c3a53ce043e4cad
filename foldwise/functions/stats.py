"""Distribution tail functions as Spark column expressions (series evaluated JVM-side)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from foldwise.functions.columns import col


#: Below this λ the dual (theta-function) series of the Kolmogorov tail converges faster.
KOLMOGOROV_SPLIT, KOLMOGOROV_TERMS = 1.18, 8


def kolmogorov_sf(lam) -> Column:
    """Asymptotic two-sided Kolmogorov tail Q(λ), in [0, 1]: 2 Σ (−1)^{k−1} exp(−2k²λ²) for large λ,
    1 − √(2π)/λ Σ exp(−(2k−1)²π²/(8λ²)) for small λ. Eight terms of either leave less than 1e-16."""
    x = col(lam)
    far, near = F.lit(0.0), F.lit(0.0)
    for k in range(1, KOLMOGOROV_TERMS + 1):
        far = far + F.lit(2.0 * (-1) ** (k - 1)) * F.exp(F.lit(-2.0 * k * k) * x * x)
        near = near + F.exp(F.lit(-((2 * k - 1) ** 2) * math.pi**2 / 8) / (x * x))
    q = F.when(x < KOLMOGOROV_SPLIT, F.lit(1.0) - F.lit(math.sqrt(2 * math.pi)) / x * near).otherwise(far)
    return F.when(x <= 0, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), q)))


def ks_pvalue(d, n1, n2) -> Column:
    """Asymptotic p-value of the two-sample KS statistic ``d`` (sample sizes ``n1``, ``n2``)."""
    en = col(n1).cast("double") * col(n2) / (col(n1) + col(n2))
    return kolmogorov_sf(F.sqrt(en) * col(d))


def ln_gamma(z: Column) -> Column:
    """ln Γ(z) for z > 0: Stirling's series at z + 8, brought back by the recurrence."""
    y = z + 8.0
    shift = z
    for k in range(1, 8):
        shift = shift * (z + float(k))
    stirling = (y - 0.5) * F.ln(y) - y + F.lit(0.5 * math.log(2 * math.pi)) + 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y)
    return stirling - F.ln(shift)


def chi2_sf(x, dof) -> Column:
    """Upper tail of the chi-square distribution, Q(dof/2, x/2): in log space, the power series of the
    lower incomplete gamma below its mean and the continued fraction of the upper one above it. The
    number of steps follows √dof, so every dof and every statistic is served alike; dof ≤ 0 gives 1."""
    s = col(dof).cast("double") / 2.0
    h = col(x).cast("double") / 2.0
    steps = F.sequence(F.lit(1), (F.ceil(F.lit(14.0) * F.sqrt(F.greatest(s, F.lit(1.0)))) + 80).cast("int"))
    front = s * F.ln(h) - h - ln_gamma(s)
    series = F.aggregate(steps, F.struct((1 / s).alias("t"), (1 / s).alias("sum")),
                         lambda a, n: F.struct((a["t"] * h / (s + n)).alias("t"), (a["sum"] + a["t"] * h / (s + n)).alias("sum")),
                         lambda a: a["sum"])
    # modified Lentz steps: b grows by 2, c and d are the running quotients, f the fraction so far
    b0 = h + 1.0 - s

    def step(a, i):
        b = a["b"] + 2.0
        an = -(i * (i - s))
        d = 1 / (an * a["d"] + b)
        c = b + an / a["c"]
        return F.struct(b.alias("b"), c.alias("c"), d.alias("d"), (a["f"] * c * d).alias("f"))

    fraction = F.aggregate(steps, F.struct(b0.alias("b"), F.lit(1e300).alias("c"), (1 / b0).alias("d"), (1 / b0).alias("f")), step, lambda a: a["f"])
    q = F.when(h < s + 1.0, 1.0 - F.exp(front) * series).otherwise(F.exp(front) * fraction)
    return F.when((h <= 0) | (s <= 0), F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), q)))
