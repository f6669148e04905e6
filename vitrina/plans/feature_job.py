"""The feature table: every operator composed into one lazy Spark plan.

Data flow (each arrow is a DataFrame, no intermediate is materialised):

    sales + open plan --(offer grain, estimates)--> base ----------------.
    plan --(tactics: closed groups + open groups, distinct, price, clean)-+-> offers
    support --(supported keys)------------------------------------------ +-> corrections (windows)
    offers --> features (+ order counts) --> + channel discounts, flags, sequence numbers

Everything after the offer grain is keyed by (campaign, CUC).  The offers are
hash-partitioned on that key once (they are small: bounded per key by the
offer-type dimension); the correction windows, the feature aggregate, the
channel-discount aggregate and their joins then reuse that partitioning.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from .. import codes
from ..functions.columns import CAMP, CUC
from ..operators import base as base_ops
from ..operators import discounts, estimates, features, flags, offers, sequences, smoothing, support, tactics
from ..operators.dims import Dims, prepare_dims
from ..params import Params
from ..codes import OUTPUT_COLUMNS
from ..session import stored
from ..sources.country import country_code
from ..sources.tables import Tables

@dataclass(frozen=True)
class Stages:
    """Intermediate frames of one run (all lazy)."""

    country: str
    params: Params
    dims: Dims
    estimates: DataFrame
    base: DataFrame           # offer grain, after estimates (#BASE_1 before the layout join)
    tactics: DataFrame        # cleaned tactics of the category's CUCs
    totals: DataFrame
    offers: DataFrame         # laid out, before corrections
    supported: DataFrame      # supported (campaign, CUC) keys
    corrected: DataFrame      # offers after the three corrections
    features: DataFrame       # OP-17 rows with channel discounts
    core: DataFrame           # features with the existence flags: all columns but the sequences


def build(t: Tables, p: Params, country: str | None = None, dims: Dims | None = None) -> Stages:
    """The lazy plan of one run up to the flags (one Spark job when executed).

    The tactics feed the offer totals and the 36 existence flags.  Both come
    out of one aggregate at (campaign, CUC, offer key); the flags, packed into
    one bitmask, are OR-ed over their (campaign, CUC) there and ride along
    the offers, so the tactics have a single consumer and are computed once.
    Run it in ``settings.job_session``, whose options it is made for.
    """
    country = country if country is not None else country_code(t.country)
    d = dims if dims is not None else prepare_dims(t, p)
    est = estimates.estimate_summary(t, p, d, country)
    base = base_ops.offer_grain_base(t, p, d, est)
    clean = tactics.clean_tactics(t, p, d, scoped=True)
    predicates = flags.all_predicates()
    totals_flags = flags.spread_mask(tactics.tactic_totals(clean, flags.flag_mask(predicates)))
    names = (flags.MASK,)
    dollar = estimates.dollar_offer_price(t, p, d) if country == codes.DOLLAR_COUNTRY else None
    # Offers are bounded per (campaign, CUC) by the offer-type dimension.  The
    # base (after the estimate join) and the totals (after their window) are
    # both hash-partitioned on that key; the layout join, the correction
    # windows and the feature aggregate reuse it (settings.JOB_OPTIONS).
    laid_out = offers.laid_out_offers(base, totals_flags, dollar, carry=names)
    keys = support.supported_keys(support.supported_products(t, p, d, scoped=True))
    corrected = smoothing.corrected_offers(laid_out, keys)

    orders = t.orders.filter(t.orders[CAMP].between(*p.whole))
    feats = features.campaign_product_features(discounts.with_channel_parts(corrected), orders, p, country,
                                               carry=names)
    feats = feats.withColumns(flags.unpack_mask(list(predicates))).drop(flags.MASK)
    totals = totals_flags.select(CAMP, CUC, "PKTipoOferta", "PrecioOferta", "Exposicion", "NroPaginas")
    return Stages(country=country, params=p, dims=d, estimates=est, base=base, tactics=clean, totals=totals,
                  offers=laid_out.drop(*names), supported=keys, corrected=corrected.drop(*names),
                  features=feats.drop(*predicates), core=feats)


def finish(st: Stages) -> DataFrame:
    """Sequence numbers and final column order.

    The numbers need the finished rows twice (campaign list, ranks), so the rows are stored once as parquet in the shared folder:
    the heavy plan runs once, a lost executor does not recompute the fact scans, and the campaign
    list reads one column.
    """
    core = stored(st.core, "features")
    return sequences.attach_sequences(core, st.params.max_campaigns() * len(st.params.run_categories)).select(*OUTPUT_COLUMNS)


def feature_table(t: Tables, p: Params | None = None, country: str | None = None) -> DataFrame:
    """The 78-column feature table of the run's category, or of all its categories in one pass over the facts."""
    return finish(build(t, p or Params(), country))
