"""Query catalogue: name -> Spark query over the mapped test tables, and its oracle SQL.

Every query reads ``part``, ``lineitem`` and ``orders`` of an ``sf_dir`` through
the fixture mapping, so its work grows with the data.  Outputs are "tidied"
for comparison only: integers as bigint, doubles to 10 significant digits (the
summation order of the two engines differs).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import codes
from ..operators import base as base_ops
from ..codes import OUTPUT_COLUMNS
from ..operators import discounts, estimates, smoothing, support, tactics
from ..operators.base import OFFER_KEYS
from ..operators.dims import prepare_dims
from ..params import Params
from ..sources.country import country_code
from ..sources.fixtures import line_count, query_tables
from . import oracle
from .feature_job import build, finish
from .settings import job_session

DOUBLE_COLUMNS = {
    "PrecioNormalMN", "PrecioOferta", "Exposicion", "ExposicionOriginal", "Descuento", "PrecioOfertaDol",
    "PrecioOfertaProm", "PrecioOfertaMin", "PrecioOfertaMinAlCuadrado", "PrecioOfertaMinInverso",
    "PrecioOfertaMax", "PrecioOfertaMaxAlCuadrado", "PrecioOfertaMaxInverso", "PUP", "ExposicionMin",
    "ExposicionMinRaizCuadrada", "ExposicionMax", "ExposicionMaxRaizCuadrada", "ExposicionTotal",
    "MaxDescuento", "MaxDescuentoCuadrado", "MaxDescuentoRevista", "MaxDescuentoCatalogo", "FactorDemoCatalogo",
}
STRING_COLUMNS = {
    "CodPais", "AnioCampana", "CodCUC", "DesMarca", "CodCategoria", "DesCategoria", "CodTipoOferta",
    "DesUbicacionCatalogo", "DesLadoPag", "DesTipoCatalogo", "DesExposicion",
}

BASE_COLUMNS = ["AnioCampana", "CodCUC", "PKProducto", "DesMarca", "CodCategoria", "DesCategoria", "CodTipoOferta",
                "PKTipoOferta", "FlagCatalogo", "FlagRevista", "RealUUVendidas", "RealUUFaltantes", "FlagReal"]
OFFER_COLUMNS = [*OFFER_KEYS, "RealUUVendidas", "RealUUFaltantes", "PrecioNormalMN", "PrecioOferta",
                 "Exposicion", "ExposicionOriginal", "NroPaginas", "Descuento"]

def _kind(name: str, text_cols=frozenset()) -> str:
    if name in STRING_COLUMNS or name in text_cols:
        return "s"
    return "d" if name in DOUBLE_COLUMNS else "i"


#: A value below 10^k is cut to so many decimals.
_DECIMALS = [(k, oracle.DIGITS - k) for k in range(-6, oracle.DIGITS + 1)]


def significant(x: Column) -> Column:
    """``x`` to ``oracle.DIGITS`` significant digits, in doubles throughout (no integer in between).

    The two engines add up in different orders, which changes the last digits of a sum.  The scale comes from
    the same comparisons and literals as in the oracle SQL, so equal doubles give equal results there and here.
    """
    return F.transform(F.array(x), lambda v: F.call_function("coalesce", *[
        F.when(F.abs(v) < F.lit(float(f"1e{k}")), F.rint(v * F.lit(float(f"1e{n}"))) / F.lit(float(f"1e{n}"))) for k, n in _DECIMALS], v) + F.lit(0.0))[0]


def _significant(x: str) -> str:
    """The same as SQL text, which reaches the JVM in one call."""
    cases = " ".join(f"WHEN abs({x}) < 1E{k}D THEN rint({x} * 1E{n}D) / 1E{n}D" for k, n in _DECIMALS)
    return f"(CASE {cases} ELSE {x} END + 0D)"


def tidy(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns in the catalogue order; integers as bigint, doubles to significant digits.

    The digits are cut by one expression over an array of the doubles: written out for each of some 20 columns it grows beyond
    what Java compiles in one method (64 KB), and the query then runs interpreted.
    """
    out = []
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    doubles = [n for n in columns if isinstance(types[n], (T.DoubleType, T.FloatType, T.DecimalType))]
    if len(doubles) > 1:
        values = ", ".join(f"cast(`{n}` AS double)" for n in doubles)
        df = df.withColumn("_doubles", F.expr(f"transform(array({values}), x -> {_significant('x')})"))
    for name in columns:
        dt = types[name]
        if name in doubles:
            out.append((F.col("_doubles")[doubles.index(name)] if len(doubles) > 1 else F.expr(_significant(f"cast(`{name}` AS double)"))).alias(name))
        elif isinstance(dt, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
            out.append(F.col(name).cast("bigint").alias(name))
        else:
            out.append(F.col(name))
    return df.select(*out)


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    columns: list[str]
    relation: str                 # final CTE of the oracle
    country: str = "S2"
    params: Params = Params()
    text_columns: frozenset = frozenset()
    extra_ctes: tuple = ()

    def spark(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return tidy(self.run(spark, sf_dir), self.columns)

    def sql(self) -> str:
        cols = [(c, _kind(c, self.text_columns)) for c in self.columns]
        if self.params.categories:
            return oracle.categories_sql(self.relation, cols, self.params, self.country)
        return oracle.query_sql(self.relation, cols, self.params, self.country, list(self.extra_ctes))


_SESSIONS: dict[str, SparkSession] = {}


def _ctx(spark: SparkSession, sf_dir: str, country: str = "S2", p: Params | None = None):
    """The mapped tables, in one session with the job's options for all queries of an application."""
    p = p or Params()
    app = spark.sparkContext.applicationId
    _SESSIONS[app] = job_session(spark, _SESSIONS.get(app), line_count(spark, sf_dir))
    t = query_tables(_SESSIONS[app], sf_dir, country)
    return t, p, prepare_dims(t, p)


def _stages(spark, sf_dir, country="S2", p=None):
    t, p, d = _ctx(spark, sf_dir, country, p)
    return build(t, p, country_code(t.country), d)


def _q_closed(spark, sf_dir):
    return base_ops.closed_sales_base(*_ctx(spark, sf_dir))


def _q_open(spark, sf_dir):
    return base_ops.open_plan_base(*_ctx(spark, sf_dir))


def _q_union(spark, sf_dir):
    return base_ops.base_union(*_ctx(spark, sf_dir))


def _q_est(spark, sf_dir):
    t, p, d = _ctx(spark, sf_dir)
    return estimates.estimate_summary(t, p, d, country_code(t.country))


def _q_dollar(spark, sf_dir):
    return estimates.dollar_offer_price(*_ctx(spark, sf_dir))


def _q_without_zero(spark, sf_dir):
    t, p, d = _ctx(spark, sf_dir)
    return base_ops.base_without_zero_estimates(base_ops.base_union(t, p, d),
                                                estimates.estimate_summary(t, p, d, country_code(t.country)))


def _q_normal(spark, sf_dir):
    t, p, d = _ctx(spark, sf_dir)
    return base_ops.apply_estimates(base_ops.base_union(t, p, d), estimates.estimate_summary(t, p, d, country_code(t.country)))


def _q_exposure(spark, sf_dir):
    t, _, _ = _ctx(spark, sf_dir)
    return tactics.exposure_parse(t)


def _q_tac_closed(spark, sf_dir):
    t, p, d = _ctx(spark, sf_dir)
    return tactics.tactics_closed(tactics.closed_tactic_groups(t, p, d), p)


def _q_tac_open(spark, sf_dir):
    return tactics.tactics_open(*_ctx(spark, sf_dir))


def _q_tac_union(spark, sf_dir):
    t, p, d = _ctx(spark, sf_dir)
    return tactics.tactics_union(tactics.tactics_closed(tactics.closed_tactic_groups(t, p, d), p),
                                 tactics.tactics_open(t, p, d))


def _q_price(spark, sf_dir):
    return tactics.closed_offer_price(tactics.closed_tactic_groups(*_ctx(spark, sf_dir)))


def _q_clean(spark, sf_dir):
    return tactics.clean_tactics(*_ctx(spark, sf_dir))


def _q_totals(spark, sf_dir):
    return tactics.tactic_totals(tactics.clean_tactics(*_ctx(spark, sf_dir)))


def _q_offer_grain(spark, sf_dir):
    t, p, d = _ctx(spark, sf_dir)
    return base_ops.offer_grain_base(t, p, d, estimates.estimate_summary(t, p, d, country_code(t.country)))


def _q_offers(country):
    return lambda spark, sf_dir: _stages(spark, sf_dir, country).offers


def _q_supported(spark, sf_dir):
    return support.supported_products(*_ctx(spark, sf_dir))


def _q_smoothing(spark, sf_dir):
    st = _stages(spark, sf_dir)
    return smoothing.set_price_smoothing(st.offers, st.supported)


def _q_exposure_fill(spark, sf_dir):
    st = _stages(spark, sf_dir)
    return smoothing.zero_exposure_fill(smoothing.set_price_smoothing(st.offers, st.supported))


def _q_price_fill(country):
    return lambda spark, sf_dir: _stages(spark, sf_dir, country).corrected


def _q_features(spark, sf_dir):
    return _stages(spark, sf_dir).features


def _q_core(columns):
    """Columns of the job's own rows, one row for each (campaign, CUC)."""
    return lambda spark, sf_dir: _stages(spark, sf_dir).core.select(*KEYS, *columns).distinct()


def _q_quality(spark, sf_dir):
    from .quality import quality_metrics
    return quality_metrics(*_ctx(spark, sf_dir))


def _q_result_columns(columns):
    return lambda spark, sf_dir: finish(_stages(spark, sf_dir)).select(*columns).distinct()


def _q_features_full(country, p=None):
    return lambda spark, sf_dir: finish(_stages(spark, sf_dir, country, p))


PLACEMENT_FLAG_NAMES = [n for n, _ in codes.PLACEMENT_FLAGS] + [n for n, _ in codes.SIDE_FLAGS] + [
    "FotoProducto", "FotoModelo", "FlagDiscover"]
OFFER_FLAG_NAMES = ["FlagRegalo"] + [n for n, _ in codes.OFFER_TYPE_FLAGS]
CLASS_FLAG_NAMES = ["FlagTacticaMacro", "FlagTacticaDetallada"]
ALL_FLAG_NAMES = set(PLACEMENT_FLAG_NAMES + OFFER_FLAG_NAMES + CLASS_FLAG_NAMES)
FEATURE_COLUMNS = [c for c in OUTPUT_COLUMNS
                   if c not in {"N_Records_SKU", "NCampaign", *discounts.CHANNEL_COLUMNS} | ALL_FLAG_NAMES]
TACTIC_TEXT = frozenset({"FotoProducto", "FotoModelo"})
PLAN_PRICE_COLUMNS = ["AnioCampana", "CodCUC", "PKTipoOferta", "CodTipoOferta", "PrecioOferta"]
KEYS = ["AnioCampana", "CodCUC"]


def _category_slug(category: str) -> str:
    return category.lower().replace(" ", "_")


def catalogue() -> dict[str, Query]:
    q = [
        Query("closed_sales_base", _q_closed, BASE_COLUMNS, "sale"),
        Query("open_plan_base", _q_open, BASE_COLUMNS, "planned"),
        Query("base_union", _q_union, BASE_COLUMNS, "on_offer"),
        Query("estimate_summary", _q_est, ["AnioCampana", "CodCUC", "NroEstimados", "PrecioOfertaDol",
                                           "PrecioNormalMN"], "guess"),
        Query("dollar_offer_price", _q_dollar, ["AnioCampana", "CodCUC", "PKTipoOferta", "PrecioOfertaDol"],
              "guess_by_offer"),
        Query("base_without_zero_estimates", _q_without_zero, BASE_COLUMNS, "expected"),
        Query("base_with_normal_price", _q_normal, BASE_COLUMNS + ["PrecioNormalMN"], "valued"),
        Query("exposure_parse", _q_exposure, ["AnioCampana", "PKProducto", "PKTipoOferta", "DesExposicion",
                                              "NroPaginas", "Exposicion", "BadText"], "exposure",
              extra_ctes=(*oracle.exposure_ctes(),)),
        Query("tactics_closed", _q_tac_closed, tactics.TACTIC_COLUMNS, "ad_closed", text_columns=TACTIC_TEXT),
        Query("tactics_open", _q_tac_open, tactics.TACTIC_COLUMNS, "ad_open", text_columns=TACTIC_TEXT),
        Query("tactics_union", _q_tac_union, tactics.TACTIC_COLUMNS, "ad_all", text_columns=TACTIC_TEXT),
        Query("closed_offer_price", _q_price, PLAN_PRICE_COLUMNS, "offer_price"),
        Query("tactics_clean", _q_clean, tactics.TACTIC_COLUMNS, "ad_clean", text_columns=TACTIC_TEXT),
        Query("tactic_totals", _q_totals, ["AnioCampana", "CodCUC", "PKTipoOferta", "PrecioOferta", "Exposicion",
                                           "NroPaginas"], "total"),
        Query("offer_grain_base", _q_offer_grain, [*OFFER_KEYS, "RealUUVendidas", "RealUUFaltantes",
                                                   "PrecioNormalMN"], "grain"),
        Query("laid_out_offers", _q_offers("S2"), OFFER_COLUMNS, "offer"),
        Query("laid_out_offers_bo", _q_offers("BO"), OFFER_COLUMNS, "offer", country="BO"),
        Query("supported_products", _q_supported, ["AnioCampana", "CodCUC", "CodTipoOferta", "NroApoyados"],
              "helped"),
        Query("set_price_smoothing", _q_smoothing, OFFER_COLUMNS, "smoothed"),
        Query("zero_exposure_fill", _q_exposure_fill, OFFER_COLUMNS, "exposed"),
        Query("zero_price_fill_bo", _q_price_fill("BO"), OFFER_COLUMNS, "repriced", country="BO"),
        Query("campaign_product_features", _q_features, FEATURE_COLUMNS, "feature_wide"),
        Query("placement_flags", _q_core(PLACEMENT_FLAG_NAMES), KEYS + PLACEMENT_FLAG_NAMES, "flagged"),
        Query("offer_type_flags", _q_core(OFFER_FLAG_NAMES), KEYS + OFFER_FLAG_NAMES, "flagged"),
        Query("tactic_class_flags", _q_core(CLASS_FLAG_NAMES), KEYS + CLASS_FLAG_NAMES, "flagged"),
        Query("channel_discounts", _q_core(discounts.CHANNEL_COLUMNS), KEYS + discounts.CHANNEL_COLUMNS, "channel"),
        Query("campaign_sequence", _q_result_columns(["AnioCampana", "NCampaign"]), ["AnioCampana", "NCampaign"], "campaign_no"),
        Query("sku_sequence", _q_result_columns(["AnioCampana", "CodCUC", "N_Records_SKU"]), ["AnioCampana", "CodCUC", "N_Records_SKU"], "product_no"),
        Query("feature_table", _q_features_full("S2"), OUTPUT_COLUMNS, "result"),
        Query("quality_metrics", _q_quality, ["metric", "value"], "quality", text_columns=frozenset({"metric"}),
              extra_ctes=(*oracle.quality_ctes(Params()),)),
        Query("feature_table_bo", _q_features_full("BO"), OUTPUT_COLUMNS, "result", country="BO"),
    ]
    for category in codes.CATEGORIES[1:]:
        p = Params(category=category)
        q.append(Query(f"feature_table_{_category_slug(category)}", _q_features_full("S2", p), OUTPUT_COLUMNS,
                       "result", params=p))
    for name, country in (("feature_table_all_categories", "S2"), ("feature_table_all_categories_bo", "BO")):
        p = Params(categories=codes.CATEGORIES)
        q.append(Query(name, _q_features_full(country, p), OUTPUT_COLUMNS, "result", country=country, params=p))
    return {x.name: x for x in q}
