"""Catalogue tactics from the page plan (OP-7 .. OP-10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import codes
from ..functions.columns import CAMP, CUC, exposure, exposure_is_bad, exposure_number, flag, not_zero
from ..functions.exact_sum import exact_sum
from ..params import Params
from ..sources.tables import Tables
from .dims import CODTO, PK, PKTO, Dims, gathered

# One tactic = one group of these plan columns.
TACTIC_KEYS = [CAMP, CUC, PKTO, CODTO, "DesUbicacionCatalogo", "DesLadoPag", "DesTipoCatalogo",
               "DesExposicion", "NroPaginas", "PaginaCatalogo"]
# Columns of a tactic row; the raw exposure text is replaced by its number.
TACTIC_COLUMNS = [CAMP, CUC, PKTO, CODTO, "DesUbicacionCatalogo", "DesLadoPag", "DesTipoCatalogo",
                  "Exposicion", "NroPaginas", "FotoProducto", "FotoModelo", "FlagDiscover",
                  "PaginaCatalogo", "PrecioOferta"]


def _tactic_exposure(p: Params) -> Column:
    text, pages = F.col("DesExposicion"), F.col("NroPaginas")
    if p.strict:
        number = F.when(exposure_is_bad(text),
                        F.raise_error(F.concat(F.lit("unparsable exposure text: "), text)).cast("double")
                        ).otherwise(exposure_number(text))
        return number / F.lit(100.0) * pages.cast("double")
    return exposure(text, pages)


def _plan_rows(t: Tables, p: Params, d: Dims, window: tuple[str, str], scoped: bool) -> DataFrame:
    """Plan rows of a campaign window in the four catalogues, catalogue sale only.

    With ``scoped`` the rows are restricted to CUCs having a product of the run
    category: every later use joins tactics to the base by CUC, so the other
    CUCs can never match.  This cuts the plan to the category at the scan.
    The rows come gathered by (campaign, CUC): groups, code prices, distinct
    and totals follow without another exchange.
    """
    plan = t.plan.filter(F.col(CAMP).between(*window) & F.col("DesTipoCatalogo").isin(*codes.CATALOGUES))
    rows = d.with_catalogue_offer(d.with_cuc(plan, scoped))
    return gathered(rows, t.plan)


def _maxima() -> list[Column]:
    return [F.max("FotoProducto").alias("FotoProducto"), F.max("FotoModelo").alias("FotoModelo"),
            F.max("FlagDiscover").alias("FlagDiscover")]


def closed_tactic_groups(t: Tables, p: Params, d: Dims, scoped: bool = False) -> DataFrame:
    """Closed-window plan rows with a real sale code, grouped by tactic keys.

    ``_positive`` is the lowest positive price of the group: offer prices are rolled up from it, so the closed
    plan is scanned once.
    """
    rows = _plan_rows(t, p, d, p.closed, scoped).filter(
        F.col("CodVenta") != codes.DUMMY_SALE_CODE)
    price = F.col("PrecioOferta")
    return rows.groupBy(*TACTIC_KEYS).agg(*_maxima(), F.min(F.when(price > 0, price)).alias("_positive"))


def tactics_closed(groups: DataFrame, p: Params, price: Column | None = None) -> DataFrame:
    """OP-7, closed branch: tactics with a placement, at the given price (0 before prices are known)."""
    return (groups.filter(F.col("DesUbicacionCatalogo").isNotNull())
            .withColumns({"Exposicion": _tactic_exposure(p), "PrecioOferta": F.lit(0.0) if price is None else price})
            .select(*TACTIC_COLUMNS))


def tactics_open(t: Tables, p: Params, d: Dims, scoped: bool = False) -> DataFrame:
    """OP-7, open branch: every open tactic with its lowest plan price."""
    rows = _plan_rows(t, p, d, p.open, scoped)
    return (rows.groupBy(*TACTIC_KEYS).agg(*_maxima(), F.min("PrecioOferta").alias("PrecioOferta"))
            .withColumn("Exposicion", _tactic_exposure(p))
            .select(*TACTIC_COLUMNS))


def tactics_union(closed: DataFrame, open_: DataFrame) -> DataFrame:
    """OP-7: distinct union.  Groups differing only in the raw exposure text
    give equal rows, which the distinct merges (as a set union does)."""
    return closed.unionByName(open_).distinct()


def closed_offer_price(groups: DataFrame) -> DataFrame:
    """OP-8: lowest positive price per (campaign, CUC, offer key, offer code), from the closed groups."""
    return (groups.groupBy(CAMP, CUC, PKTO, CODTO).agg(F.min("_positive").alias("PrecioOferta"))
            .filter(F.col("PrecioOferta").isNotNull()))


def with_code_price(groups: DataFrame) -> DataFrame:
    """The closed groups with the offer price as it is applied: the lowest of (campaign, CUC, offer code).

    Two offer keys with one code would make the source update pick an arbitrary price; the lowest is taken, so the
    result is deterministic.  The window runs on the groups, not on plan rows: one row per layout of one offer code
    of one product in one campaign.
    """
    w = Window.partitionBy(CAMP, CUC, CODTO)
    return groups.withColumn("_price", F.min("_positive").over(w))


def _clean(priced: DataFrame) -> DataFrame:
    page = F.coalesce(F.col("PaginaCatalogo"), F.lit(0))
    bad_page = (F.col("DesTipoCatalogo") == codes.MAGAZINE) & ((page == 0) | (page >= codes.MAGAZINE_PAGE_LIMIT))
    return priced.filter(not_zero(F.col("PrecioOferta")) & ~bad_page)


def clean_tactics(t: Tables, p: Params, d: Dims, scoped: bool = False) -> DataFrame:
    """OP-7 + OP-8 + OP-9: the cleaned tactic rows, priced.

    The price depends on the key columns only, so it commutes with the distinct union and is set before it, where
    a code without a positive price keeps 0.  Closed and open windows are disjoint (checked by ``Params``), so each
    branch is made distinct by itself.  Zero-price tactics go (a null price stays), magazine tactics on page null, 0 or
    >= 100 too.
    """
    key = F.col(CUC).isNotNull()  # a null CUC matches no price
    price = F.when(key, F.coalesce(F.col("_price"), F.lit(0.0))).otherwise(F.lit(0.0))
    closed = tactics_closed(with_code_price(closed_tactic_groups(t, p, d, scoped)), p, price).distinct()
    return _clean(closed.unionByName(tactics_open(t, p, d, scoped).distinct()))


def tactic_totals(tactics: DataFrame, mask: Column | None = None) -> DataFrame:
    """OP-10: per (campaign, CUC, offer key) the lowest price and the summed
    exposure and pages, nulls counted as 0.  The exposure sum is the same for every order of the rows.

    With ``mask`` (the flags of a tactic packed into bits, ``flags.flag_mask``)
    the same aggregate also carries the OR of the masks of the group: bit i
    says whether some tactic meets flag i (OP-18).
    """
    extra = [] if mask is None else [F.bit_or(mask).alias("_flag_mask")]
    return tactics.groupBy(CAMP, CUC, PKTO).agg(
        F.min("PrecioOferta").alias("PrecioOferta"),
        exact_sum("coalesce(Exposicion, 0D)").alias("Exposicion"),
        F.sum(F.coalesce(F.col("NroPaginas"), F.lit(0).cast("bigint"))).alias("NroPaginas"),
        *extra)


def exposure_parse(t: Tables) -> DataFrame:
    """The exposure parser applied to every plan row (FN-1 .. FN-6)."""
    return t.plan.select(CAMP, PK, PKTO, "DesExposicion", "NroPaginas",
                         exposure(F.col("DesExposicion"), F.col("NroPaginas")).alias("Exposicion"),
                         flag(exposure_is_bad(F.col("DesExposicion"))).alias("BadText"))
