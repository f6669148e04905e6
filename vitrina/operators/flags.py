"""Existence flags of tactics per (campaign, CUC) (OP-18)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import codes
from ..functions.columns import CAMP, CUC
from .dims import CODTO


def placement_predicates() -> dict[str, Column]:
    placement = F.coalesce(F.col("DesUbicacionCatalogo"), F.lit(""))
    preds = {name: placement.isin(*values) for name, values in codes.PLACEMENT_FLAGS}
    preds.update({name: F.col("DesLadoPag") == side for name, side in codes.SIDE_FLAGS})
    preds["FotoProducto"] = F.col("FotoProducto") == "S"
    preds["FotoModelo"] = F.col("FotoModelo") == "S"
    preds["FlagDiscover"] = F.coalesce(F.col("FlagDiscover"), F.lit(0)) == 1
    return preds


def offer_type_predicates() -> dict[str, Column]:
    code = F.col(CODTO)
    preds = {"FlagRegalo": code.isin(*codes.OFFER_CODES_GIFT)}
    preds.update({name: code == value for name, value in codes.OFFER_TYPE_FLAGS})
    return preds


def tactic_class_predicates() -> dict[str, Column]:
    code = F.col(CODTO)
    return {"FlagTacticaMacro": code.isin(*codes.OFFER_CODES_MACRO),
            "FlagTacticaDetallada": code.isin(*codes.OFFER_CODES_DETAIL)}


def all_predicates() -> dict[str, Column]:
    return {**placement_predicates(), **offer_type_predicates(), **tactic_class_predicates()}


MASK = "_flag_mask"


def flag_mask(predicates: dict[str, Column]) -> Column:
    """The flags of one tactic packed into one bigint: bit i is predicate i.

    Existence over a group is then a ``bit_or`` of masks, so the 36 flags
    travel as one narrow column through joins, windows and aggregates.
    """
    bits = [F.when(c, F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint") for i, c in enumerate(predicates.values())]
    return reduce(lambda a, b: a + b, bits)


def unpack_mask(names) -> dict[str, Column]:
    """Bit i of the mask as the integer flag ``names[i]`` (0 where the mask is null)."""
    mask = F.coalesce(F.col(MASK), F.lit(0).cast("bigint"))
    return {n: F.shiftright(mask, i).bitwiseAND(F.lit(1)).cast("int") for i, n in enumerate(names)}


def spread_mask(totals_with_mask: DataFrame) -> DataFrame:
    """Replace each per-offer-key mask by the OR over its (campaign, CUC): the
    flags then ride along the offers that join to these totals.  The window
    group is one row per offer key of a CUC, bounded by the offer-type
    dimension."""
    w = Window.partitionBy(CAMP, CUC)
    return totals_with_mask.withColumn(MASK, F.bit_or(MASK).over(w))
