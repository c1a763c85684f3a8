"""Exact decimal rounding and safe division as column expressions.

Spark offers HALF_UP (``round``) and HALF_EVEN (``bround``) only, and decimal
division rounds its quotient before any later rounding sees it. The helpers
here divide with an exact integer remainder so HALF_UP, HALF_DOWN and
HALF_EVEN ties are decided exactly, all inside whole-stage codegen.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Money type used throughout: wider types make Spark collapse quotient scale.
MONEY = "decimal(20,8)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_div_sql(num_sql: str, den_sql: str, scale: int = 6, mode: str = "half_up", num_scale: int = 10) -> str:
    """Spark SQL text of :func:`round_div` over SQL operands."""
    n = (f"CAST(CAST(({num_sql}) AS DECIMAL(38,{num_scale})) * CAST({10 ** (scale + num_scale)} AS DECIMAL(38,0))"
         f" AS DECIMAL(38,0))")
    d = f"CAST(CAST(({den_sql}) AS DECIMAL(38,0)) * CAST({10 ** num_scale} AS DECIMAL(38,0)) AS DECIMAL(38,0))"
    # exact floor division: non-negative remainder, then an integral divide of
    # an exact multiple (the quotient, value * 10^scale, must fit in a long)
    r = f"pmod({n}, {d})"
    q = f"(({n} - {r}) div {d})"
    tie = {"half_up": f"{q} >= 0", "half_down": f"{q} < 0", "half_even": f"pmod({q}, 2) = 1"}.get(mode)
    if tie is None:
        raise ValueError(f"unknown rounding mode {mode}")
    bump = f"CASE WHEN 2 * {r} > {d} OR (2 * {r} = {d} AND {tie}) THEN 1 ELSE 0 END"
    return (f"CASE WHEN {d} > 0 THEN CAST(CAST({q} + {bump} AS DECIMAL(19,0)) / "
            f"CAST({10 ** scale} AS DECIMAL({scale + 1},0)) AS DECIMAL(38,{scale})) END")


def round_div(num, den, scale: int = 6, mode: str = "half_up", num_scale: int = 10) -> Column:
    """``num / den`` rounded to ``scale`` decimals with an exact tie rule.

    ``num`` is any numeric column with at most ``num_scale`` decimals,
    ``den`` an integer-valued column. Returns ``decimal(38, scale)``, NULL
    when ``den`` is NULL or not positive (callers map that to their default).
    Column names compile to one SQL expression; Column operands are combined
    with the Column API.
    """
    if isinstance(num, str) and isinstance(den, str):
        return F.expr(round_div_sql(f"`{num}`", f"`{den}`", scale, mode, num_scale))
    num, den = _col(num), _col(den)
    shift = F.lit(Decimal(10 ** (scale + num_scale))).cast("decimal(38,0)")
    n = (num.cast(f"decimal(38,{num_scale})") * shift).cast("decimal(38,0)")
    d = (den.cast("decimal(38,0)") * F.lit(Decimal(10 ** num_scale)).cast("decimal(38,0)")).cast("decimal(38,0)")
    r = F.pmod(n, d)
    q = F.call_function("div", n - r, d)
    twice = r * 2
    if mode == "half_up":
        tie_up = q >= 0
    elif mode == "half_down":
        tie_up = q < 0
    elif mode == "half_even":
        tie_up = F.pmod(q, F.lit(2)) == 1
    else:
        raise ValueError(f"unknown rounding mode {mode}")
    bump = F.when((twice > d) | ((twice == d) & tie_up), 1).otherwise(0)
    unscaled = (q + bump).cast("decimal(19,0)")
    out = (unscaled / F.lit(10 ** scale).cast(f"decimal({scale + 1},0)")).cast(f"decimal(38,{scale})")
    return F.when(d > 0, out)


def div6(num, den) -> Column:
    """Report ratio: ``num/den`` HALF_UP at 6 decimals, 0 on NULL/zero den."""
    return F.coalesce(round_div(num, den, 6, "half_up"), F.lit(0).cast("decimal(38,6)"))


def ecpm(money, impr, mode: str = "half_down") -> Column:
    """``money * 1000 / impr`` at 6 decimals with the given tie rule."""
    if isinstance(money, str) and isinstance(impr, str):
        return F.expr(round_div_sql(f"CAST(`{money}` AS DECIMAL(28,10)) * 1000", f"`{impr}`", 6, mode))
    return round_div(_col(money).cast("decimal(28,10)") * F.lit(1000), impr, 6, mode)


# ---------------------------------------------------------------- DuckDB text

def duck_round_div(num_sql: str, den_sql: str, scale: int = 6, mode: str = "half_up",
                   num_scale: int = 10) -> str:
    """DuckDB SQL text computing exactly what :func:`round_div` computes,
    returned as DOUBLE (the registry compares 6-decimal values as DOUBLE)."""
    n = (f"(CAST(CAST(({num_sql}) AS DECIMAL(38,{num_scale})) * {10 ** num_scale} AS HUGEINT)"
         f" * CAST({10 ** scale} AS HUGEINT))")
    d = f"(CAST(({den_sql}) AS HUGEINT) * CAST({10 ** num_scale} AS HUGEINT))"
    q0 = f"CAST(floor(CAST({n} AS DOUBLE) / CAST({d} AS DOUBLE)) AS HUGEINT)"
    r0 = f"({n} - {q0} * {d})"
    q = f"(CASE WHEN {r0} < 0 THEN {q0} - 1 WHEN {r0} >= {d} THEN {q0} + 1 ELSE {q0} END)"
    r = f"(CASE WHEN {r0} < 0 THEN {r0} + {d} WHEN {r0} >= {d} THEN {r0} - {d} ELSE {r0} END)"
    if mode == "half_up":
        tie = f"{q} >= 0"
    elif mode == "half_down":
        tie = f"{q} < 0"
    else:
        tie = f"{q} % 2 <> 0"
    bump = f"(CASE WHEN 2 * {r} > {d} OR (2 * {r} = {d} AND {tie}) THEN 1 ELSE 0 END)"
    return (f"(CASE WHEN {d} > 0 THEN CAST({q} + {bump} AS DOUBLE) / {float(10 ** scale)!r} END)")
