"""Scalar column expressions (JVM-side, inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from crease.fixed import OUTCOMES

# Outcome columns follow ``crease.fixed.OUTCOMES`` (5 runs has no column; its
# mass is the residual above the last cumulative value).
CUM_COLS = tuple(f"c{k}" for k in OUTCOMES)
COUNT_COLS = tuple(f"n{k}" for k in OUTCOMES)


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_ratio(num: Column | str, den: Column | str) -> Column:
    """``num / den`` as double; NULL when ``den`` is 0 or NULL (never inf/NaN)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def ratio_or_zero(num: Column | str, den: Column | str) -> Column:
    """Profile ratio stored as 0 when the denominator is 0."""
    return F.coalesce(safe_ratio(num, den), F.lit(0.0))


def soft_cast(text: Column | str) -> Column:
    """Number when the cell parses as one, else NULL (the text is kept beside it)."""
    return _c(text).try_cast("double")


def strip_brackets(text: Column | str) -> Column:
    """Drop round brackets round a team name: ``(CSK)`` -> ``CSK``."""
    return F.translate(_c(text), "()", "")


def outcome_index(cums: list[Column], u: Column | str) -> Column:
    """Inverse-CDF index: one past the last cumulative value below ``u``, else 0."""
    uu = _c(u)
    return F.greatest(F.lit(0), *[F.when(c < uu, F.lit(i + 1)).otherwise(F.lit(0))
                                  for i, c in enumerate(cums)])


def outcome_pick(cums: list[Column], u: Column | str) -> Column:
    """Runs of the ball drawn by ``u`` against cumulative outcome odds.

    A draw above the last cumulative value wraps to outcome 0 (index mod 6).
    """
    idx = F.pmod(outcome_index(cums, u), F.lit(len(OUTCOMES)))
    runs = F.lit(OUTCOMES[0])
    for i, k in enumerate(OUTCOMES[1:], start=1):
        runs = F.when(idx == i, F.lit(k)).otherwise(runs)
    return runs.cast("int")


def wicket_discount(runs: Column | str, wickets: Column | str) -> Column:
    """Runs left after wickets in an over: half-even round of runs/6*(6-w) when w != 0."""
    r, w = _c(runs), _c(wickets)
    return F.when(w != 0, F.bround(r.cast("double") / 6 * (F.lit(6) - w), 0)
                  ).otherwise(r.cast("double"))


def unit_hash(*cols: Column | str) -> Column:
    """Deterministic number in [0, 1) from the given columns: the first 52 bits of the MD5
    of their texts, joined by ``|`` (NULL as nothing).  A retried task gets the same."""
    text = F.concat_ws("|", *[F.coalesce(_c(c).cast("string"), F.lit("")) for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / float(1 << 52)


def odd(x: Column | str) -> Column:
    """1 for an odd integer, 0 for even (non-negative modulo)."""
    return F.pmod(_c(x), F.lit(2))


def flatten_features(*parts: Column) -> Column:
    """One flat feature array from scalars and arrays: [over] + a + b + c."""
    return F.flatten(F.array(*[p if p is not None else F.array() for p in parts]))
