"""Estimates of the run category (OP-3, OP-4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import codes
from ..functions.columns import CAMP, CUC
from ..params import Params
from ..sources.tables import Tables
from .dims import CATEGORY, PKTO, Dims, gathered


def _estimate_rows(t: Tables, p: Params, d: Dims) -> DataFrame:
    est = t.estimates.filter((F.col(CAMP) == F.col("AnioCampanaRef"))
                             & F.col(CAMP).between(*p.span))
    return d.with_described(est)


def _by_category(p: Params) -> list[str]:
    """A run for several categories keeps the estimates of each apart."""
    return [CATEGORY] * (len(p.run_categories) > 1)


def estimate_summary(t: Tables, p: Params, d: Dims, country: str) -> DataFrame:
    """OP-3: per (campaign, CUC) the estimated units and the normal price
    (dollar normal price for the dollar country, local otherwise)."""
    normal = "PrecioNormalDol" if country == codes.DOLLAR_COUNTRY else "PrecioNormalMN"
    return (_estimate_rows(t, p, d).groupBy(CAMP, CUC, *_by_category(p))
            .agg(F.sum("EstUUVendidas").alias("NroEstimados"),
                 F.max("PrecioOfertaDol").alias("PrecioOfertaDol"),
                 F.max(normal).alias("PrecioNormalMN")))


def dollar_offer_price(t: Tables, p: Params, d: Dims) -> DataFrame:
    """OP-4: highest dollar offer price per (campaign, CUC, offer type key)."""
    keys = [CAMP, CUC, *_by_category(p), PKTO]
    rows = gathered(_estimate_rows(t, p, d).select(*keys, "PrecioOfertaDol"), t.estimates)  # as the offers it joins
    return (rows.groupBy(*keys)
            .agg(F.max("PrecioOfertaDol").alias("PrecioOfertaDol")))
