"""Data-quality metrics of a run: the places where the source batch would
silently pick, convert or fail."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import codes
from ..functions.columns import CAMP, CUC, exposure_is_bad
from ..operators.dims import CODTO, PKTO, Dims
from ..params import Params
from ..sources.tables import Tables

METRICS = ("country_rows", "bad_exposure_texts", "price_codes_with_several_keys", "zero_order_counts",
           "campaigns_with_several_order_counts")


def _metric(name: str, df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("value")).select(F.lit(name).alias("metric"), "value")


def quality_metrics(t: Tables, p: Params, d: Dims) -> DataFrame:
    """One row per metric (long format: metric, value).

    * ``country_rows``: rows of DPais (the run needs exactly one).
    * ``bad_exposure_texts``: plan rows of the run windows whose exposure text
      is not empty and still not a number after the source's clean-up (the
      source batch would abort; here they read as 0, or fail in strict mode).
    * ``price_codes_with_several_keys``: (campaign, CUC, offer code) with
      several offer keys carrying a positive price (the source update would
      pick one arbitrarily; the lowest is taken).
    * ``zero_order_counts``: order counts of 0 in the run windows (PUP would
      divide by 0; here it is null).
    * ``campaigns_with_several_order_counts``: campaigns with more than one
      order count (their result rows split).
    """
    window = F.col(CAMP).between(*p.whole)
    plan = t.plan.filter(window)
    bad = plan.filter(exposure_is_bad(F.col("DesExposicion")))
    priced = (d.with_catalogue_offer(d.with_cuc(plan)).filter((F.col("PrecioOferta") > 0) & F.col(CAMP).between(*p.closed)
                          & (F.col("CodVenta") != codes.DUMMY_SALE_CODE)
                          & F.col("DesTipoCatalogo").isin(*codes.CATALOGUES))
              .groupBy(CAMP, CUC, CODTO).agg(F.countDistinct(PKTO).alias("_keys"))
              .filter(F.col("_keys") > 1))
    orders = t.orders.filter(window)
    several = orders.groupBy(CAMP).count().filter(F.col("count") > 1)
    parts = [_metric("country_rows", t.country), _metric("bad_exposure_texts", bad),
             _metric("price_codes_with_several_keys", priced),
             _metric("zero_order_counts", orders.filter(F.col("RealNroPedidos") == 0)),
             _metric("campaigns_with_several_order_counts", several)]
    return reduce(DataFrame.unionByName, parts)
