"""Country parameter read from the country dimension (PRM-2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import codes


def recoded_country(country: DataFrame) -> DataFrame:
    """Country codes of DPais with the recodes of ``codes.COUNTRY_RECODE`` applied."""
    code = F.col("CodPais")
    expr = None
    for raw, clean in codes.COUNTRY_RECODE:
        expr = (F.when(code == raw, F.lit(clean)) if expr is None
                else expr.when(code == raw, F.lit(clean)))
    return country.select(expr.otherwise(code).alias("CodPais"))


def country_code(country: DataFrame) -> str:
    """The one country of the run.  DPais must hold exactly one row: the source
    batch would silently take an arbitrary row of several, or null for none."""
    rows = recoded_country(country).limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"DPais must hold exactly one row, found {'none' if not rows else 'several'}")
    if rows[0].CodPais is None:
        raise ValueError("DPais holds a null country code")
    return rows[0].CodPais
