"""Highest discount by channel per (campaign, CUC) (OP-19)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import CAMP, CUC, flag
from .smoothing import by_key

CHANNEL_COLUMNS = ["MaxDescuentoRevista", "MaxDescuentoCatalogo", "FactorDemoCatalogo", "FlagMaxDescuentoRevista"]
# Per-(campaign, CUC) helpers carried on offer rows: highest discount and presence per channel.
_PARTS = ("_rev", "_has_rev", "_cat", "_has_cat")


def _parts() -> dict[str, Column]:
    d = F.col("Descuento")
    return {"_rev": F.max(F.when(F.col("FlagRevista") == 1, d)),
            "_has_rev": F.max(F.col("FlagRevista")),
            "_cat": F.max(F.when(F.col("FlagCatalogo") == 1, d)),
            "_has_cat": F.max(F.col("FlagCatalogo"))}


def with_channel_parts(offers: DataFrame) -> DataFrame:
    """Channel maxima as window columns over (campaign, CUC): the offers are
    already partitioned by that key for the corrections, so no exchange."""
    return offers.withColumns({n: c.over(by_key(offers)) for n, c in _parts().items()})


def channel_parts_agg() -> list[Column]:
    """Carry the per-key window values through a finer aggregate (constant per key)."""
    return [F.max(n).alias(n) for n in _PARTS]


def channel_columns() -> dict[str, Column]:
    """OP-19 outputs from the helper columns.

    A channel without offers gives 0; a channel whose offers all lack a
    discount gives null (then the product is null and the flag 0).
    """
    rev = F.when(F.col("_has_rev") == 1, F.col("_rev")).otherwise(F.lit(0.0))
    cat = F.when(F.col("_has_cat") == 1, F.col("_cat")).otherwise(F.lit(0.0))
    return {"MaxDescuentoRevista": rev, "MaxDescuentoCatalogo": cat, "FactorDemoCatalogo": cat * rev,
            "FlagMaxDescuentoRevista": flag(rev > cat)}
