"""SQL text of distribution tails for the DuckDB oracle (DuckDB has no erfc).

erfc(x), x >= 0: below 2 from the Maclaurin series of erf in Horner form
(41 terms); from 2 up by the continued fraction
``exp(-x^2)/sqrt(pi) / (x + (1/2)/(x + 1/(x + (3/2)/(x + ...))))`` unrolled
60 levels. Both are accurate to ~1e-14 relative over their ranges; the
library itself uses ``math.erfc``.
"""

from __future__ import annotations

import math

SMALLEST_NORMAL = "2.2250738585072014e-308"


def erfc_sql(x: str) -> str:
    """``x`` must be a column name (it is repeated)."""
    coeffs = [(-1) ** n / (math.factorial(n) * (2 * n + 1)) * 2 / math.sqrt(math.pi) for n in range(41)]
    horner = repr(coeffs[-1])
    for c in reversed(coeffs[:-1]):
        horner = f"({c!r} + ({x})*({x})*{horner})"
    small = f"(1.0 - ({x}) * {horner})"
    tail = f"({x})"
    for k in range(60, 0, -1):
        tail = f"(({x}) + {k / 2!r} / {tail})"
    large = f"(exp(-({x})*({x})) / {math.sqrt(math.pi)!r} / {tail})"
    return f"(CASE WHEN ({x}) < 2 THEN {small} ELSE {large} END)"


def chi2_sf_sql(chi2: str, dof: str, x: str, max_dof: int = 12) -> str:
    """Chi-square upper tail for integer dof (closed forms); ``x`` names a
    column holding ``sqrt(chi2 / 2)``."""
    h = f"(({chi2}) / 2.0)"
    cases = []
    for d in range(1, max_dof + 1):
        if d % 2 == 0:
            terms = " + ".join(f"pow({h}, {i}) / {math.factorial(i)}.0" for i in range(d // 2))
            expr = f"exp(-{h}) * ({terms})"
        else:
            expr = erfc_sql(x)
            if d > 1:
                terms = " + ".join(f"pow({h}, {i} + 0.5) / {math.gamma(i + 1.5)!r}" for i in range((d - 1) // 2))
                expr = f"({expr} + exp(-{h}) * ({terms}))"
        cases.append(f"WHEN {dof} = {d} THEN least(1.0, {expr})")
    p = f"(CASE WHEN ({chi2}) <= 0 THEN 1.0 {' '.join(cases)} END)"
    return f"(CASE WHEN {p} < {SMALLEST_NORMAL} THEN 0.0 ELSE {p} END)"


def two_sided_normal_sql(x: str) -> str:
    """``2 P(Z > |z|)`` where ``x`` names a column holding ``|z| / sqrt(2)``."""
    p = f"least(1.0, {erfc_sql(x)})"
    return f"(CASE WHEN {p} < {SMALLEST_NORMAL} THEN 0.0 ELSE {p} END)"
