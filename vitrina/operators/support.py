"""Supported products (OP-13)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import codes
from ..functions.columns import CAMP, CUC
from ..params import Params
from ..sources.tables import Tables
from .dims import CODTO, PK, PKTO, Dims, gathered

#: CUC of the supported product, on support rows.
SUPPORTED_CUC = "CodCUCApoyado"


def supported_products(t: Tables, p: Params, d: Dims, scoped: bool = False) -> DataFrame:
    """OP-13: (campaign, supporter CUC, supporter offer code) groups supported by
    fewer than 10 distinct CUCs.

    The product dimension plays two roles (supporter, supported).  The pairs
    are shuffled once, to their (campaign, CUC): the exact distinct count and
    the keys made from it (``supported_keys``) need no exchange after that.
    With ``scoped``, supporters are limited to CUCs of the run category (the
    groups are only ever matched against such CUCs).
    """
    given = t.support.filter(F.col(CAMP).between(*p.span))
    pairs = d.with_cuc(given, scoped, "PKProductoApoyador")
    if SUPPORTED_CUC not in pairs.columns:
        supported = d.products.select(F.col(PK).alias("PKProductoApoyado"), F.col(CUC).alias(SUPPORTED_CUC))
        offer = d.offer_types.select(F.col(PKTO).alias("PKTipoOfertaApoyador"), CODTO)
        pairs = pairs.join(supported, "PKProductoApoyado").join(offer, "PKTipoOfertaApoyador")
    return (gathered(pairs.select(CAMP, CUC, CODTO, SUPPORTED_CUC), t.support).groupBy(CAMP, CUC, CODTO)
            .agg(F.countDistinct(SUPPORTED_CUC).alias("NroApoyados"))
            .filter(F.col("NroApoyados") < codes.SUPPORT_LIMIT))


def supported_keys(supported: DataFrame) -> DataFrame:
    """Distinct (campaign, CUC) of the supported groups."""
    return supported.select(CAMP, CUC).distinct()
