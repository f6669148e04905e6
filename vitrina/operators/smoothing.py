"""Price and exposure corrections at offer grain (OP-14 .. OP-16).

The source builds helper tables per (campaign, CUC) and joins them back; here
each rule is a window over (campaign, CUC) without ordering or frame.  An offer
group is bounded by the offer-type dimension (one row per offer key, brand and
category of a CUC), so a window partition never grows with the facts.  Rows
with a null campaign or CUC never match a join in the source; ``keyed()``
keeps them out of every rule here too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import codes
from ..functions.columns import CAMP, CUC, discount, keyed
from .dims import CODTO, offer_group


def by_key(offers: DataFrame) -> Window:
    """Window over one (campaign, CUC) group of a category, no ordering, whole group as frame."""
    return Window.partitionBy(*offer_group(offers))


def set_price_smoothing(offers: DataFrame, supported_keys: DataFrame) -> DataFrame:
    """OP-14: in a (campaign, CUC) group whose lowest price is a set price, or
    which is supported by fewer than 10 products, the offers at the lowest
    price take the group's average price, and their discount is recomputed."""
    marks = supported_keys.select(CAMP, CUC).distinct().withColumn("_supported", F.lit(True))
    price = F.col("PrecioOferta")
    low = F.min(price).over(by_key(offers))
    low_set = F.min(F.when(F.col(CODTO).isin(*codes.OFFER_CODES_SET) & (price > 0), price)).over(by_key(offers))
    # The rows of a window arrive in shuffle order, so a plain average could differ in its last bit between runs, and a later
    # equality with it.  Over a whole-group frame in order of the price it is the same sum on every run.
    ordered = by_key(offers).orderBy(price).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    mean = F.avg(price).over(ordered)
    supported = F.coalesce(F.col("_supported"), F.lit(False))
    hit = keyed() & (price == low) & ((low == low_set) | (supported & low.isNotNull()))
    return (offers.join(marks, [CAMP, CUC], "left")
            .withColumns({"PrecioOferta": F.when(hit, mean).otherwise(price),
                          "Descuento": F.when(hit, discount(F.col("PrecioNormalMN"), mean))
                          .otherwise(F.col("Descuento"))})
            .drop("_supported"))


def zero_exposure_fill(offers: DataFrame) -> DataFrame:
    """OP-15: zero exposure takes the lowest positive exposure of its group."""
    exp = F.col("Exposicion")
    low_pos = F.min(F.when(exp > 0, exp)).over(by_key(offers))
    return offers.withColumn("Exposicion", F.when(keyed() & (exp == 0) & low_pos.isNotNull(), low_pos)
                             .otherwise(exp))


def zero_price_fill(offers: DataFrame) -> DataFrame:
    """OP-16: a zero price takes the lowest positive price of its group, and the
    discount the lowest discount among the positively priced offers."""
    price = F.col("PrecioOferta")
    positive = price > 0
    low_pos = F.min(F.when(positive, price)).over(by_key(offers))
    low_disc = F.min(F.when(positive, F.col("Descuento"))).over(by_key(offers))
    hit = keyed() & (price == 0) & low_pos.isNotNull()
    return offers.withColumns({"PrecioOferta": F.when(hit, low_pos).otherwise(price),
                               "Descuento": F.when(hit, low_disc).otherwise(F.col("Descuento"))})


def corrected_offers(offers: DataFrame, supported_keys: DataFrame) -> DataFrame:
    """OP-14, OP-15, OP-16 in this order (the price fill sees the smoothed prices)."""
    return zero_price_fill(zero_exposure_fill(set_price_smoothing(offers, supported_keys)))
