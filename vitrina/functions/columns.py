"""Scalar column expressions of the job, all built-in (JVM side, codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import codes

CAMP = "AnioCampana"
CUC = "CodCUC"


def exposure_number(text: Column) -> Column:
    """Numeric part of an exposure text such as ``'EXPOSICION  50%'`` or ``'SIN EXPOSICION'``.

    Drop the no-exposure marker and ``%``, trim right, keep the last four
    characters and read them as a number; null and empty read as 0.  A text
    that is still not a plain decimal number (also ``NaN``, ``Inf``, ``50D`` or
    ``1e3``) reads as 0 here; it is counted by :func:`exposure_is_bad` and
    rejected in strict mode.
    """
    return F.coalesce(_decimal(_tail(text)), F.lit(0.0))


def exposure_is_bad(text: Column) -> Column:
    """True where the exposure text is not empty and still not a number."""
    return (F.trim(_tail(text)) != F.lit("")) & _decimal(_tail(text)).isNull()


def _tail(text: Column) -> Column:
    return F.right(F.rtrim(F.replace(F.replace(text, F.lit(codes.NO_EXPOSURE_TEXT), F.lit("")), F.lit("%"), F.lit(""))),
                   F.lit(4))


def _decimal(tail: Column) -> Column:
    """The number a plain decimal text stands for, else null."""
    return F.when(tail.rlike(r"^ *[+-]?\d*\.?\d*$"), tail.try_cast("double"))


def exposure(text: Column, pages: Column) -> Column:
    """Exposure of a tactic: percent of a page times pages (null pages -> null)."""
    return exposure_number(text) / F.lit(100.0) * pages.cast("double")


def discount(normal_price: Column, offer_price: Column) -> Column:
    """``1 - offer/normal``; 0 when the normal price is 0; null when either is null."""
    return (F.when(normal_price.cast("double") == 0, F.lit(0.0))
            .otherwise(F.lit(1.0) - offer_price.cast("double") / normal_price.cast("double")))


def guarded_inverse(x: Column) -> Column:
    """``1/x``, 0 for x = 0, null for null (the division runs only for x <> 0)."""
    return F.when(x == 0, F.lit(0.0)).otherwise(F.lit(1.0) / x)


def flag(condition: Column) -> Column:
    """1/0 integer flag; a null condition gives 0."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def channel_flags(offer_code: Column) -> dict[str, Column]:
    return {
        "FlagCatalogo": flag(offer_code.isin(*codes.OFFER_CODES_CATALOGUE)),
        "FlagRevista": flag(offer_code.isin(*codes.OFFER_CODES_MAGAZINE)),
    }


def season_flags(campaign: Column) -> dict[str, Column]:
    suffix = F.right(campaign, F.lit(2))
    return {name: flag(suffix.isin(*sfx)) for name, sfx in codes.SEASON_FLAGS}


def not_zero(x: Column) -> Column:
    """Null-safe ``NOT (x = 0)``: keeps nulls, as a ``DELETE … WHERE x = 0`` does."""
    return x.isNull() | (x != 0)


def keyed() -> Column:
    """A row takes part in (campaign, CUC) joins only with both keys present."""
    return F.col(CAMP).isNotNull() & F.col(CUC).isNotNull()
