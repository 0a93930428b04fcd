"""Numeric tolerance predicates.

Two flavours exist in the reference's behaviour:
* absolute: ``abs(found - expected) > tol`` is a violation, where a NaN on
  either side is *not* a violation (a NaN comparison is false in Python);
* combined: ``isclose(a, b, rel_tol=1e-9, abs_tol=tol)``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_TOL = 0.01
DEFAULT_REL_TOL = 1e-9


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def exceeds_abs_tol(found, expected, tol: float = DEFAULT_TOL) -> Column:
    """True when the gap is above tol; NaN never counts (null stays null)."""
    f, e = _c(found).cast("double"), _c(expected).cast("double")
    return F.when(F.isnan(f) | F.isnan(e), F.lit(False)).otherwise(F.abs(f - e) > F.lit(tol))


def isclose(a, b, tol: float = DEFAULT_TOL, rel_tol: float = DEFAULT_REL_TOL) -> Column:
    """math.isclose semantics on doubles (infinities equal only to themselves)."""
    x, y = _c(a).cast("double"), _c(b).cast("double")
    bound = F.greatest(F.lit(rel_tol) * F.greatest(F.abs(x), F.abs(y)), F.lit(tol))
    finite = F.greatest(F.abs(x), F.abs(y)) < F.lit(float("inf"))
    return (x == y) | (finite & (F.abs(x - y) <= bound))
