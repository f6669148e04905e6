"""Co-located storage: facts that carry their dimensions' columns, bucketed by what the whole job groups by.

``store_tables`` keeps facts as the source has them, so each run joins them with products and offer types and shuffles them by (campaign, CUC).
``store_colocated`` does both once, at ingest: every fact gets the columns of its product and offer type, and catalog tables in the same number of
buckets of (AnioCampana, CodCUC).  A run over ``colocated_tables`` then filters the stored columns at the scan (the category among them), and its
aggregates, windows and joins on (campaign, CUC) find their rows in place, without an exchange.

The key holds the campaign, so a CUC that is sold everywhere is spread over its campaigns; one (campaign, CUC) is the grain whose offers the job
corrects together, and its rows are reduced by partial aggregates as they are read.  Files are sorted by campaign, so that the windows skip row groups.

Rows without a product or an offer type are not stored, since every use of a fact joins it with both (estimates: with its product).  What
is attached is as of the ingest: after a change of the product or offer-type table the facts are stored again.
"""

from __future__ import annotations

from dataclasses import fields, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import CAMP, CUC
from ..operators.dims import CATEGORY, CODTO, CUC_CATEGORIES, PK, PKTO
from ..operators.support import SUPPORTED_CUC
from .tables import PARTITIONED, SOURCE_NAMES, Tables


def attach_dimensions(t: Tables) -> Tables:
    """The normalised tables with product and offer-type columns on every fact."""
    t = t.normalised()
    categories = t.product.groupBy(CUC).agg(F.sort_array(F.collect_set(CATEGORY)).alias(CUC_CATEGORIES))
    # null-safe: products without a CUC stay, as in the joins of the job
    product = (t.product.join(categories.withColumnRenamed(CUC, "_cuc"), F.col(CUC).eqNullSafe(F.col("_cuc"))).drop("_cuc"))
    supporter = product.select(F.col(PK).alias("PKProductoApoyador"), CUC, CUC_CATEGORIES)
    supported = t.product.select(F.col(PK).alias("PKProductoApoyado"), F.col(CUC).alias(SUPPORTED_CUC))
    offer = t.offer_type.select(F.col(PKTO).alias("PKTipoOfertaApoyador"), CODTO)
    return replace(
        t,
        sales=t.sales.join(product, PK).join(t.offer_type, PKTO),
        plan=t.plan.join(product, PK).join(t.offer_type, PKTO),
        estimates=t.estimates.join(product, PK),
        support=(t.support.join(supporter, "PKProductoApoyador").join(supported, "PKProductoApoyado")
                 .join(offer, "PKTipoOfertaApoyador")))


def store_colocated(t: Tables, buckets: int, database: str | None = None, mode: str = "error") -> None:
    """Ingest into catalog tables under the source names; ``mode`` as for ``DataFrameWriter`` ("append" adds facts of new campaigns).

    ``buckets`` is the number of tasks that read a fact, the same for all: about the largest fact's size over 256 MB.
    Each bucket is written by one task as one file.
    """
    t = attach_dimensions(t)
    for name, source in SOURCE_NAMES.items():
        df: DataFrame = getattr(t, name)
        if name in PARTITIONED:
            (df.repartition(buckets, CAMP, CUC).write.format("parquet").mode(mode)
             .bucketBy(buckets, CAMP, CUC).sortBy(CAMP).saveAsTable(_name(database, source)))
        else:
            df.write.format("parquet").mode("overwrite" if mode == "append" else mode).saveAsTable(_name(database, source))


def colocated_tables(spark: SparkSession, database: str | None = None) -> Tables:
    """The tables as ``store_colocated`` wrote them; for the run's session use ``settings.job_session``."""
    t = Tables(**{f.name: spark.table(_name(database, SOURCE_NAMES[f.name])) for f in fields(Tables)})
    for name in PARTITIONED:
        if CUC not in getattr(t, name).columns:
            raise ValueError(f"{SOURCE_NAMES[name]} carries no {CUC}: store it with store_colocated")
    return t


def _name(database: str | None, source: str) -> str:
    return f"{database}.{source}" if database else source
