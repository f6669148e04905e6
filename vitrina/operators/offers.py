"""Offers laid out in a catalogue (OP-12)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import CAMP, CUC, discount
from .dims import PKTO, offer_group


def laid_out_offers(base: DataFrame, totals: DataFrame, dollar: DataFrame | None = None,
                    carry: tuple[str, ...] = ()) -> DataFrame:
    """OP-12: offer-grain base with price, exposure, pages and discount of its
    tactics.  The inner join drops offers without a tactic (not laid out).

    With ``dollar`` (the dollar country) the offer price is then replaced by the
    dollar price wherever one matches, also by a null one; the discount stays
    the one computed from the local price.  ``carry`` names extra columns of
    ``totals`` kept on the offers (the spread tactic flags).
    """
    tot = totals.select(CAMP, CUC, PKTO, F.col("PrecioOferta").alias("_price"),
                        F.col("Exposicion").alias("_exp"), F.col("NroPaginas").alias("_pages"), *carry)
    offers = base.join(tot, [CAMP, CUC, PKTO], "inner").withColumns({
        "PrecioOferta": F.col("_price"),
        "Exposicion": F.col("_exp"),
        "ExposicionOriginal": F.col("_exp"),
        "NroPaginas": F.col("_pages"),
        "Descuento": discount(F.col("PrecioNormalMN"), F.col("_price")),
    }).drop("_price", "_exp", "_pages")
    if dollar is not None:
        on = [*offer_group(dollar), PKTO]
        dol = dollar.select(*on, F.col("PrecioOfertaDol").alias("_dol"), F.lit(True).alias("_has_dol"))
        offers = (offers.join(dol, on, "left")
                  .withColumn("PrecioOferta", F.when(F.col("_has_dol"), F.col("_dol"))
                              .otherwise(F.col("PrecioOferta")))
                  .drop("_dol", "_has_dol"))
    return offers
