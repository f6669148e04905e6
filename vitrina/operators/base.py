"""Base rows: closed-campaign sales and open-campaign plan rows (OP-1, OP-2, OP-5, OP-6, OP-11)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import CAMP, CUC, channel_flags
from ..params import Params
from ..sources.tables import Tables
from .dims import CODTO, PK, PKTO, Dims, gathered, offer_group

DESCRIBED = ["DesMarca", "CodCategoria", "DesCategoria"]
# Grain of the offer-level base (#BASE_1): one row per these keys.
OFFER_KEYS = [CAMP, CUC, *DESCRIBED, CODTO, PKTO, "FlagCatalogo", "FlagRevista", "FlagReal"]


def _closed_sales_rows(t: Tables, p: Params, d: Dims) -> DataFrame:
    sales = t.sales.filter(F.col(CAMP).between(*p.closed)
                           & (F.col(CAMP) == F.col("AnioCampanaRef")))
    return d.with_catalogue_offer(d.with_described(sales, cosmetic=True), base=True)


def closed_sales_base(t: Tables, p: Params, d: Dims) -> DataFrame:
    """OP-1: units sold and short per campaign, product and offer type (closed window).

    Joined to the two dimensions before the aggregate, so the map-side partial
    aggregate shrinks the sales before the only exchange.
    """
    keys = [CAMP, CUC, PK, *DESCRIBED, CODTO, PKTO]
    agg = (_closed_sales_rows(t, p, d).groupBy(*keys)
           .agg(F.sum("RealUUVendidas").alias("RealUUVendidas"),
                F.sum("RealUUFaltantes").alias("RealUUFaltantes")))
    return agg.select(*keys, *[c.alias(n) for n, c in channel_flags(F.col(CODTO)).items()],
                      "RealUUVendidas", "RealUUFaltantes", F.lit(1).alias("FlagReal"))


def open_plan_base(t: Tables, p: Params, d: Dims) -> DataFrame:
    """OP-2: plan rows of the open window, one row each (not grouped), with zero units.

    Unlike closed rows, open rows are not restricted to the cosmetics unit.
    """
    plan = t.plan.filter(F.col(CAMP).between(*p.open))
    rows = d.with_catalogue_offer(d.with_described(plan), base=True)
    return rows.select(CAMP, CUC, PK, *DESCRIBED, CODTO, PKTO,
                       *[c.alias(n) for n, c in channel_flags(F.col(CODTO)).items()],
                       F.lit(0).cast("bigint").alias("RealUUVendidas"),
                       F.lit(0).cast("bigint").alias("RealUUFaltantes"),
                       F.lit(0).alias("FlagReal"))


def base_union(t: Tables, p: Params, d: Dims) -> DataFrame:
    """#BASE: closed rows with open rows appended (bag union)."""
    return closed_sales_base(t, p, d).unionByName(open_plan_base(t, p, d))


def apply_estimates(base: DataFrame, estimates: DataFrame) -> DataFrame:
    """OP-5 + OP-6 in one left join on (campaign, CUC), and the category where the estimates are kept by it.

    Drops keys whose estimate sum is 0 (no estimate row, or a null sum, keeps
    the row); sets the normal price from the estimate, 0 when there is no
    estimate row and null when the matched price is null.
    """
    on = offer_group(estimates)
    est = estimates.select(*on, F.col("NroEstimados").alias("_est"),
                           F.col("PrecioNormalMN").alias("_normal"), F.lit(True).alias("_has_est"))
    joined = base.join(est, on, "left")
    # null-safe: a null estimate sum is not 0, the row stays
    kept = joined.filter(~F.coalesce(F.col("_has_est") & (F.col("_est") == 0), F.lit(False)))
    return (kept.withColumn("PrecioNormalMN", F.when(F.col("_has_est"), F.col("_normal")).otherwise(F.lit(0.0)))
            .drop("_est", "_normal", "_has_est"))


def base_without_zero_estimates(base: DataFrame, estimates: DataFrame) -> DataFrame:
    """OP-5 alone: anti join with the keys whose estimate sum is 0."""
    on = offer_group(estimates)
    return base.join(estimates.filter(F.col("NroEstimados") == 0).select(*on), on, "left_anti")


def offer_grain_base(t: Tables, p: Params, d: Dims, estimates: DataFrame) -> DataFrame:
    """OP-11 (with OP-1, OP-2, OP-5, OP-6 fused): the base at offer grain.

    Closed sales rows and open plan rows are unioned *before* any aggregate and
    summed once at offer grain: one exchange, by (campaign, CUC), which the
    estimate join finds too, and the per-product grain of OP-1 is never materialised.  The estimate join works per
    (campaign, CUC), a prefix of the offer grain, so it commutes with the sum and
    runs on the reduced rows.  The normal price is one value per (campaign,
    CUC), so its average over the group is that value.
    """
    closed = _closed_sales_rows(t, p, d).select(
        CAMP, CUC, *DESCRIBED, CODTO, PKTO, "RealUUVendidas", "RealUUFaltantes", F.lit(1).alias("FlagReal"))
    open_ = open_plan_base(t, p, d).select(
        CAMP, CUC, *DESCRIBED, CODTO, PKTO, "RealUUVendidas", "RealUUFaltantes", "FlagReal")
    rows = gathered(closed.unionByName(open_), t.sales).withColumns(channel_flags(F.col(CODTO)))
    grain = (rows.groupBy(*OFFER_KEYS)
             .agg(F.sum("RealUUVendidas").alias("RealUUVendidas"),
                  F.sum("RealUUFaltantes").alias("RealUUFaltantes")))
    return apply_estimates(grain, estimates).select(
        *OFFER_KEYS, "RealUUVendidas", "RealUUFaltantes", "PrecioNormalMN")
