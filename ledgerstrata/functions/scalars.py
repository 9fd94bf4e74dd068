"""Column expressions shared by the operators; all run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerstrata.schemas import STATEMENTS


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def pct(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient in percent, NULL when the denominator is zero or NULL."""
    return F.try_divide(_c(numerator), _c(denominator)) * F.lit(100)


def growth_pct(current: Column | str, prior: Column | str) -> Column:
    """Change against ``prior`` in percent, NULL when there is nothing to compare with."""
    return pct(_c(current) - _c(prior), prior)


def cagr_ratio(last: Column | str, first: Column | str, years: int) -> Column:
    """``(last/first)^(1/years) - 1``; NULL for a negative or undefined quotient.

    The exponent is a double on purpose: a SQL decimal ``1.0/3`` is cut to six
    digits and would bend the result.
    """
    quotient = F.try_divide(_c(last), _c(first))
    return F.when(quotient >= 0, F.pow(quotient, F.lit(1.0 / years)) - F.lit(1.0))


def scaled(col: Column | str, unit: float, digits: int = 2) -> Column:
    """Amount in millions/billions/..., rounded."""
    return F.round(_c(col) / F.lit(float(unit)), digits)


def band(col: Column | str, low: Column | float, high: Column | float) -> Column:
    """``low`` / ``mid`` / ``high`` against two cut points (NULL stays NULL)."""
    col = _c(col)
    return (
        F.when(col > high, F.lit("high")).when(col < low, F.lit("low")).when(col.isNotNull(), F.lit("mid"))
    )


def statement_type(
    concept: Column | str, statements: dict[str, tuple[str, ...]] | None = None
) -> Column:
    """Statement a concept belongs to, ``other`` when it is on no list."""
    concept = _c(concept)
    branch = F
    for name, concepts in (statements or STATEMENTS).items():
        branch = branch.when(concept.isin(*concepts), F.lit(name))
    return branch.otherwise(F.lit("other"))


def concept_label(concept: Column | str) -> Column:
    """``NetIncomeLoss`` -> `` Net Income Loss`` (the leading blank is kept)."""
    return F.regexp_replace(_c(concept), "([A-Z])", " $1")


def period_index(year: Column | str, period: Column | str) -> Column:
    """Running quarter number ``4*year + q``; NULL for anything but Q1..Q4."""
    period = _c(period)
    quarter = F.when(period.rlike("^Q[1-4]$"), F.substring(period, 2, 1).try_cast("int"))
    return _c(year) * F.lit(4) + quarter


def sic_division(sic: Column | str) -> Column:
    """Division of the public Standard Industrial Classification for a 4-digit code."""
    code = _c(sic).try_cast("int")
    divisions = (
        # SIC division bounds.
        (100, 999, "Agriculture, Forestry and Fishing"),
        (1000, 1499, "Mining"),
        (1500, 1799, "Construction"),
        (2000, 3999, "Manufacturing"),
        (4000, 4999, "Transportation and Public Utilities"),
        (5000, 5199, "Wholesale Trade"),
        (5200, 5999, "Retail Trade"),
        (6000, 6799, "Finance, Insurance and Real Estate"),
        (7000, 8999, "Services"),
        (9100, 9729, "Public Administration"),
    )
    branch = F
    for low, high, name in divisions:
        branch = branch.when(code.between(low, high), F.lit(name))
    return branch.otherwise(F.lit(None).cast("string"))
