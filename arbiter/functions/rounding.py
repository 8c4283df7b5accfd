"""Rounding with the evaluated pipeline's semantics.

Python's ``round(x, n)`` is half-to-even on the *exact binary* value of x.
Spark's ``bround`` rounds the shortest decimal representation instead, and
a plain ``x * 10**n`` loses the bit that decides a tie: 0.62315 is stored
slightly below the tie (Python: 0.6231) while 0.62315 * 1e4 rounds to
exactly 6231.5 (half-even: 0.6232).

``exact_round`` decides on the exact product: p = fl(x * 10**n) plus its
rounding error e, obtained error-free with Dekker's split/two-product using
only IEEE double operations (Java's arithmetic is strict, so this is
bit-reproducible and stays inside whole-stage codegen).  The rounded integer
r is then divided by 10**n, which — like Python — returns the double nearest
to the decimal result.  ``exact_round_sql`` is the same expression as DuckDB
SQL text for the oracles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from arbiter.functions.text import col

_SPLIT = 134217729.0  # 2**27 + 1


def _split_const(v: float) -> tuple[float, float]:
    c = _SPLIT * v
    hi = c - (c - v)
    return hi, v - hi


def exact_round(x, decimals: int) -> Column:
    """``x``: a column name or SQL expression text (built as one SQL
    expression, one round trip), or a Column (built operator by operator)."""
    if isinstance(x, str):
        return F.expr(exact_round_sql(x if x.startswith("(") else f"`{x}`", decimals))
    s = float(10 ** decimals)
    sh, sl = _split_const(s)
    xv = col(x).cast("double")
    p = xv * F.lit(s)
    c = xv * F.lit(_SPLIT)
    xh = c - (c - xv)
    xl = xv - xh
    e = (((xh * F.lit(sh) - p) + xh * F.lit(sl)) + xl * F.lit(sh)) + xl * F.lit(sl)
    f = F.floor(p).cast("double")
    frac = p - f
    odd = F.pmod(f, F.lit(2.0)) == F.lit(1.0)
    up = (frac > F.lit(0.5)) | ((frac == F.lit(0.5)) &
                                ((e > F.lit(0.0)) | ((e == F.lit(0.0)) & odd)))
    r = f + F.when(up, F.lit(1.0)).otherwise(F.lit(0.0))
    return r / F.lit(s) + F.lit(0.0)


def exact_round_sql(x: str, decimals: int) -> str:
    """DuckDB text of ``exact_round`` (x is evaluated several times; pass a
    column name or a parenthesised expression)."""
    s = float(10 ** decimals)
    sh, sl = _split_const(s)
    X = f"CAST({x} AS DOUBLE)"
    S, SH, SL, SP = (f"CAST({v!r} AS DOUBLE)" for v in (s, sh, sl, _SPLIT))
    p = f"({X} * {S})"
    c = f"({X} * {SP})"
    xh = f"({c} - ({c} - {X}))"
    xl = f"({X} - {xh})"
    e = f"(((({xh} * {SH} - {p}) + {xh} * {SL}) + {xl} * {SH}) + {xl} * {SL})"
    f = f"CAST(floor({p}) AS DOUBLE)"
    frac = f"({p} - {f})"
    up = (f"({frac} > 0.5 OR ({frac} = 0.5 AND ({e} > 0 OR ({e} = 0 AND "
          f"{f} - 2 * floor({f} / 2) = 1))))")
    return f"((({f} + CASE WHEN {up} THEN 1.0 ELSE 0.0 END) / {S}) + 0.0)"


def no_negative_zero(x) -> Column:
    """-0.0 -> 0.0 (adding +0.0 is exact for every other value)."""
    return col(x) + F.lit(0.0)
