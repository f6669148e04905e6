"""Dimension frames of one run: the filters and projections that several operators join with.

There are no hints: Spark broadcasts a dimension that its size estimate, or
the size measured at runtime, puts below ``spark.sql.autoBroadcastJoinThreshold``.
Facts that carry their dimensions' columns (``sources.colocated``) are filtered by them instead of joined.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import codes
from ..functions.columns import CAMP, CUC
from ..functions.key_filter import KeyFilter
from ..params import Params
from ..sources.tables import Tables

PK = "PKProducto"
PKTO = "PKTipoOferta"
CODTO = "CodTipoOferta"
CATEGORY = "DesCategoria"


def offer_group(df: DataFrame) -> list[str]:
    """The key of the offers that are corrected together: campaign and CUC, in each category of the run by itself."""
    return [CAMP, CUC] + [CATEGORY] * (CATEGORY in df.columns)


def gathered(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """Rows of ``facts`` with those of one (campaign, CUC) in one partition, for the aggregates, windows and joins that follow.

    They all group by these two columns and some of the others; left to themselves they shuffle once for each set of keys.  Facts that carry
    their product's columns are stored that way (``sources.colocated``).
    """
    return rows if CUC in facts.columns else rows.repartition(CAMP, CUC)


#: On facts that carry their product's columns: the categories that products of the row's CUC have.
CUC_CATEGORIES = "CategoriasCUC"


@dataclass(frozen=True)
class Dims:
    categories: tuple[str, ...]       # of the run
    products: DataFrame               # PKProducto, CodCUC (every product)
    products_described: DataFrame     # PKProducto, CodCUC, DesMarca, CodCategoria, DesCategoria (categories of the run)
    products_cosmetic: DataFrame      # the same, cosmetics unit only
    products_in_scope: DataFrame      # PKProducto, CodCUC of every product whose CUC has a product of the category
    scope_cucs: DataFrame             # CodCUC of the category's products (with repeats)
    offer_types: DataFrame            # PKTipoOferta, CodTipoOferta (every offer type)
    offer_types_catalogue: DataFrame  # the same, catalogue sale only
    offer_types_base: DataFrame       # catalogue sale and one of the base codes
    described_keys: KeyFilter | None = None   # the keys of products_described, where the run asks for filters
    scope_keys: KeyFilter | None = None       # the keys of products_in_scope

    def described(self, facts: DataFrame) -> DataFrame:
        """The facts without most rows of other products; the join with ``products_described`` must follow."""
        return facts if self.described_keys is None else facts.filter(self.described_keys.might_hold(F.col(PK)))

    def in_scope(self, facts: DataFrame, key: str = PK) -> DataFrame:
        """The facts without most rows out of scope; the join with ``products_in_scope`` must follow."""
        return facts if self.scope_keys is None else facts.filter(self.scope_keys.might_hold(F.col(key)))

    def with_described(self, facts: DataFrame, cosmetic: bool = False) -> DataFrame:
        """The facts of the run's categories (and of the cosmetics unit) with CUC, brand and category."""
        if CUC not in facts.columns:
            return self.described(facts).join(self.products_cosmetic if cosmetic else self.products_described, PK)
        rows = facts.filter(F.col(CATEGORY).isin(*self.categories))
        return rows.filter(F.col("DesUnidadNegocio") == codes.COSMETICS_UNIT) if cosmetic else rows

    def with_cuc(self, facts: DataFrame, scoped: bool = False, key: str = PK) -> DataFrame:
        """The facts whose product exists with its CUC; ``scoped``: only CUCs that have a product of the run's categories."""
        if CUC not in facts.columns:
            products = (self.products_in_scope if scoped else self.products).withColumnRenamed(PK, key)
            return (self.in_scope(facts, key) if scoped else facts).join(products, key)
        wanted = F.arrays_overlap(CUC_CATEGORIES, F.array(*map(F.lit, self.categories)))
        return facts.filter(F.col(CUC).isNotNull() & wanted) if scoped else facts

    def with_catalogue_offer(self, facts: DataFrame, base: bool = False) -> DataFrame:
        """The facts sold by catalogue, with the offer code; ``base``: with one of the base codes."""
        if CODTO not in facts.columns:
            return facts.join(self.offer_types_base if base else self.offer_types_catalogue, PKTO)
        rows = facts.filter(F.col("CodTipoProfit") == codes.CATALOGUE_PROFIT_TYPE)
        return rows.filter(F.col(CODTO).isin(*codes.OFFER_CODES_ALL)) if base else rows


def prepare_dims(t: Tables, p: Params) -> Dims:
    product = t.product
    offer_type = t.offer_type
    wanted = p.run_categories
    described = (product.filter(F.col("DesCategoria") == wanted[0] if len(wanted) == 1 else F.col("DesCategoria").isin(*wanted))
                 .select(PK, CUC, "DesMarca", "CodCategoria", "DesCategoria", "DesUnidadNegocio"))
    # A semi join emits each product at most once, so its build side needs no
    # distinct (and no exchange for one).
    scope_cucs = described.select(CUC)
    in_scope = product.select(PK, CUC).join(scope_cucs, CUC, "left_semi")
    catalogue = offer_type.filter(F.col("CodTipoProfit") == codes.CATALOGUE_PROFIT_TYPE).select(PKTO, CODTO)
    return Dims(
        categories=wanted,
        products=product.select(PK, CUC),
        products_described=described.drop("DesUnidadNegocio"),
        products_cosmetic=described.filter(F.col("DesUnidadNegocio") == codes.COSMETICS_UNIT).drop("DesUnidadNegocio"),
        products_in_scope=in_scope,
        scope_cucs=scope_cucs,
        offer_types=offer_type.select(PKTO, CODTO),
        offer_types_catalogue=catalogue,
        offer_types_base=catalogue.filter(F.col(CODTO).isin(*codes.OFFER_CODES_ALL)),
        described_keys=p.key_filter_bits and KeyFilter(described, PK, p.key_filter_bits),
        scope_keys=p.key_filter_bits and KeyFilter(in_scope, PK, p.key_filter_bits),
    )
