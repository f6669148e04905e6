"""Campaign x product features (OP-17)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import CAMP, CUC, flag, guarded_inverse, not_zero, season_flags
from ..functions.exact_sum import exact_avg, exact_sum
from .discounts import channel_columns, channel_parts_agg
from ..params import Params
from .dims import PKTO

FEATURE_KEYS = [CAMP, "DesMarca", CUC, "CodCategoria", "DesCategoria", "RealNroPedidos"]


def _orders_per(p: Params, units: Column, orders: Column) -> Column:
    ratio = F.try_divide(units.cast("double"), orders.cast("double"))
    if p.strict:
        return F.when(orders == 0, F.raise_error(F.lit("order count 0")).cast("double")).otherwise(ratio)
    return ratio


def campaign_product_features(offers: DataFrame, orders: DataFrame, p: Params, country: str,
                              carry: tuple[str, ...] = ()) -> DataFrame:
    """OP-17: one row per (campaign, brand, CUC, category, order count).

    A campaign without an order count drops out (inner join); results whose
    lowest price is 0 are removed.  Columns are the first 36 of the output,
    plus pages and seasonal flags; with ``channels`` the offers carry the
    per-key channel maxima (``discounts.with_channel_parts``) and the four
    channel-discount columns are produced too.  ``carry`` names per-(campaign,
    CUC) bitmask columns of the offers passed through as their OR (the
    packed tactic flags).  Sequence numbers are attached by the job.
    """
    channels = "_has_rev" in offers.columns
    joined = offers.join(orders.select(CAMP, "RealNroPedidos"), CAMP)
    agg = joined.groupBy(*FEATURE_KEYS).agg(
        exact_avg("PrecioOferta").alias("PrecioOfertaProm"),
        F.min("PrecioOferta").alias("PrecioOfertaMin"),
        F.max("PrecioOferta").alias("PrecioOfertaMax"),
        exact_avg("PrecioNormalMN").alias("PrecioNormalMN"),
        F.countDistinct(PKTO).alias("NroTipoOfertas"),
        F.sum("FlagCatalogo").alias("NroTipoOfertasCatalogo"),
        F.sum("FlagRevista").alias("NroTipoOfertasRevista"),
        F.sum(F.col("RealUUVendidas") + F.col("RealUUFaltantes")).alias("RealUUDemandadas"),
        F.min("Exposicion").alias("ExposicionMin"),
        F.max("Exposicion").alias("ExposicionMax"),
        exact_sum("ExposicionOriginal").alias("ExposicionTotal"),
        F.max("Descuento").alias("MaxDescuento"),
        F.sum(F.coalesce(F.col("NroPaginas"), F.lit(0).cast("bigint"))).alias("NroPaginas"),
        *(channel_parts_agg() if channels else []),
        *[F.bit_or(c).alias(c) for c in carry],
    ).filter(not_zero(F.col("PrecioOfertaMin")))
    pmin, pmax, dmax = F.col("PrecioOfertaMin"), F.col("PrecioOfertaMax"), F.col("MaxDescuento")
    orders_col = F.col("RealNroPedidos")
    return agg.select(
        F.lit(country).alias("CodPais"), CAMP, "DesMarca", CUC, "CodCategoria", "DesCategoria",
        flag(F.col(CAMP) <= p.development_to).alias("Development"),
        F.when(F.col(CAMP) <= p.closed_to, orders_col).otherwise(F.lit(0).cast("bigint")).alias("RealNroPedidos"),
        "PrecioOfertaProm", "PrecioOfertaMin",
        (pmin * pmin).alias("PrecioOfertaMinAlCuadrado"),
        guarded_inverse(pmin).alias("PrecioOfertaMinInverso"),
        "PrecioOfertaMax",
        (pmax * pmax).alias("PrecioOfertaMaxAlCuadrado"),
        guarded_inverse(pmax).alias("PrecioOfertaMaxInverso"),
        "PrecioNormalMN", "NroTipoOfertas", "NroTipoOfertasCatalogo", "NroTipoOfertasRevista",
        "RealUUDemandadas",
        _orders_per(p, F.col("RealUUDemandadas"), orders_col).alias("PUP"),
        "ExposicionMin", F.sqrt("ExposicionMin").alias("ExposicionMinRaizCuadrada"),
        "ExposicionMax", F.sqrt("ExposicionMax").alias("ExposicionMaxRaizCuadrada"),
        "ExposicionTotal",
        "MaxDescuento", (dmax * dmax).alias("MaxDescuentoCuadrado"),
        flag(dmax > 0.6).alias("FlagDescuentoMayor60"),
        flag(dmax > 0.7).alias("FlagDescuentoMayor70"),
        *([c.alias(n) for n, c in channel_columns().items()] if channels else []),
        "NroPaginas",
        *[c.alias(n) for n, c in season_flags(F.col(CAMP)).items()],
        *carry,
    )
