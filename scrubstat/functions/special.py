"""Special functions: the normal CDF and its inverse as Catalyst expressions (Spark has no erf),
and scalar incomplete beta / gamma for p-values of aggregated statistics.

Column versions stay JVM-side and inside whole-stage codegen; scalar versions run on a handful
of aggregated numbers (on the driver, or inside an Arrow UDF over per-segment rows).
"""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

_STD = NormalDist()


def _poly(coefs, x: Column) -> Column:
    """Horner evaluation, coefficients from the constant term up."""
    acc = F.lit(coefs[-1])
    for c in reversed(coefs[:-1]):
        acc = acc * x + F.lit(c)
    return acc


# Hart (1968) rational approximation of the normal tail as published by
# West (2005), "Better approximations to cumulative normal functions".
_HART_NUM = [220.206867912376, 221.213596169931, 112.079291497871, 33.912866078383,
             6.37396220353165, 0.700383064443688, 3.52624965998911e-02]
_HART_DEN = [440.413735824752, 793.826512519948, 637.333633378831, 296.564248779674,
             86.7807322029461, 16.064177579207, 1.75566716318264, 8.83883476483184e-02]


def norm_tail(x: Column) -> Column:
    """P(Z <= -|x|), accurate in the far tail (no 1 - p cancellation)."""
    a = F.abs(x)
    e = F.exp(-a * a / 2.0)
    near = e * _poly(_HART_NUM, a) / _poly(_HART_DEN, a)
    b = a + F.lit(0.65)
    for k in (4.0, 3.0, 2.0, 1.0):
        b = a + F.lit(k) / b
    far = e / b / F.lit(2.506628274631)
    return (F.when(a > 37, F.lit(0.0)).when(a < 7.07106781186547, near).otherwise(far))


def norm_cdf(x: Column) -> Column:
    """Standard normal CDF."""
    t = norm_tail(x)
    return F.when(x > 0, 1.0 - t).otherwise(t)


def log_norm_cdf(x: Column) -> Column:
    """ln Phi(x), using the tail form for negative x."""
    return F.when(x > 0, F.log1p(-norm_tail(x))).otherwise(F.log(norm_tail(x)))


# Wichura (1988), algorithm AS 241, PPND16 coefficients.
_A = [3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3,
      1.3731693765509461125e4, 4.5921953931549871457e4, 6.7265770927008700853e4,
      3.3430575583588128105e4, 2.5090809287301226727e3]
_B = [1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
      2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4,
      5.2264952788528545610e3]
_C = [1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0,
      3.64784832476320460504e0, 1.27045825245236838258e0, 2.41780725177450611770e-1,
      2.27238449892691845833e-2, 7.74545014278341407640e-4]
_D = [1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
      1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4,
      1.05075007164441684324e-9]
_E = [6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0,
      2.96560571828504891230e-1, 2.65321895265761230930e-2, 1.24266094738807843860e-3,
      2.71155556874348757815e-5, 2.01033439929228813265e-7]
_F = [1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
      7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7,
      2.04426310338993978564e-15]


def norm_ppf(p: Column) -> Column:
    """Inverse standard normal CDF (AS 241); NULL outside (0, 1)."""
    q = p - 0.5
    r_c = 0.180625 - q * q
    central = q * _poly(_A, r_c) / _poly(_B, r_c)
    tail_p = F.when(q < 0, p).otherwise(1.0 - p)
    r = F.sqrt(-F.log(tail_p))
    mid = _poly(_C, r - 1.6) / _poly(_D, r - 1.6)
    far = _poly(_E, r - 5.0) / _poly(_F, r - 5.0)
    tail = F.when(r <= 5.0, mid).otherwise(far)
    tail = F.when(q < 0, -tail).otherwise(tail)
    out = F.when(F.abs(q) <= 0.425, central).otherwise(tail)
    return F.when((p > 0) & (p < 1), out)


# ---- scalar versions ----------------------------------------------------------------------

def phi(x: float) -> float:
    return _STD.cdf(x)


def phi_inv(p: float) -> float:
    return _STD.inv_cdf(p)


def _betacf(a: float, b: float, x: float) -> float:
    """Continued fraction for the incomplete beta function (modified Lentz)."""
    tiny, eps = 1e-300, 1e-15
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 10000):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < eps:
            break
    return h


def betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    lbt = (math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
           + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1.0) / (a + b + 2.0):
        return math.exp(lbt) * _betacf(a, b, x) / a
    return 1.0 - math.exp(lbt) * _betacf(b, a, 1.0 - x) / b


def gammainc_upper(a: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(a, x)."""
    if x <= 0:
        return 1.0
    if x < a + 1.0:
        term = s = 1.0 / a
        ap = a
        for _ in range(100000):
            ap += 1.0
            term *= x / ap
            s += term
            if abs(term) < abs(s) * 1e-16:
                break
        return 1.0 - s * math.exp(-x + a * math.log(x) - math.lgamma(a))
    tiny = 1e-300
    b = x + 1.0 - a
    c = 1.0 / tiny
    d = 1.0 / b
    h = d
    for i in range(1, 100000):
        an = -i * (i - a)
        b += 2.0
        d = an * d + b
        d = tiny if abs(d) < tiny else d
        c = b + an / c
        c = tiny if abs(c) < tiny else c
        d = 1.0 / d
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < 1e-16:
            break
    return math.exp(-x + a * math.log(x) - math.lgamma(a)) * h


def t_sf2(t: float, df: float) -> float:
    """Two-sided p-value of Student's t."""
    if t is None or df is None or df <= 0 or math.isnan(t):
        return float("nan")
    return betainc(df / 2.0, 0.5, df / (df + t * t))


def f_sf(f: float, d1: float, d2: float) -> float:
    """Upper tail of the F distribution."""
    if f is None or math.isnan(f) or d1 <= 0 or d2 <= 0:
        return float("nan")
    if f <= 0:
        return 1.0
    return betainc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def chi2_sf(x: float, k: float) -> float:
    return gammainc_upper(k / 2.0, x / 2.0)


# ---- array versions (whole Arrow batches) ---------------------------------------------------

def gammainc_lower_array(a: float, x: np.ndarray) -> np.ndarray:
    """Regularised lower incomplete gamma P(a, x): series below a + 1, continued fraction above."""
    x = np.asarray(x, float)
    out = np.zeros(x.shape)
    low = (x > 0) & (x < a + 1)
    if low.any():
        v = x[low]
        term = total = np.full(v.shape, 1.0 / a)
        k = a
        while (term > total * 1e-17).any():
            k += 1.0
            term = term * v / k
            total = total + term
        out[low] = total * np.exp(a * np.log(v) - v - math.lgamma(a))
    high = x >= a + 1
    if high.any():
        v = x[high]
        b = v + 1.0 - a
        c, d = np.full(v.shape, 1e300), 1.0 / b
        h = d
        for i in range(1, 100_000):
            num = -i * (i - a)
            b = b + 2.0
            d = 1.0 / (num * d + b)
            c = b + num / c
            h = h * (c * d)
            if (np.abs(c * d - 1.0) < 1e-15).all():
                break
        out[high] = 1.0 - h * np.exp(a * np.log(v) - v - math.lgamma(a))
    return out


def betainc_array(a: float, b: float, x: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta I_x(a, b) by its continued fraction (modified Lentz), on the side
    where it converges fast."""
    x = np.clip(np.asarray(x, float), 0.0, 1.0)
    swap = x > (a + 1.0) / (a + b + 2.0)
    p, q = np.where(swap, b, a), np.where(swap, a, b)
    v = np.where(swap, 1.0 - x, x)
    tiny = 1e-300
    away = lambda y: np.where(np.abs(y) < tiny, tiny, y)
    c, d = np.ones(v.shape), 1.0 / away(1.0 - (p + q) * v / (p + 1.0))
    h = d
    for m in range(1, 10_000):
        even = m * (q - m) * v / ((p + 2 * m - 1.0) * (p + 2 * m))
        odd = -(p + m) * (p + q + m) * v / ((p + 2 * m) * (p + 2 * m + 1.0))
        for step in (even, odd):
            d, c = 1.0 / away(1.0 + step * d), away(1.0 + step / c)
            h = h * (c * d)
        if (np.abs(c * d - 1.0) < 1e-15).all():
            break
    with np.errstate(divide="ignore"):
        front = np.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + p * np.log(v) + q * np.log1p(-v)) / p
    part = np.where(v <= 0.0, 0.0, front * h)
    return np.where(swap, 1.0 - part, part)
