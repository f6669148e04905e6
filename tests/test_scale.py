"""What keeps shuffles and memory in proportion to the facts: lazy facts, one exchange by (campaign, CUC), partitions by rows, bounded broadcasts."""

import re
from dataclasses import replace

from pyspark.sql import functions as F

from vitrina.operators import flags, support, tactics
from vitrina.operators.base import offer_grain_base
from vitrina.operators.dims import prepare_dims
from vitrina.operators.estimates import estimate_summary
from vitrina.params import Params
from vitrina.plans.catalog import catalogue
from vitrina.plans.feature_job import build
from vitrina.plans.settings import BROADCAST_BYTES, PARTITION_ROWS, job_session

from conftest import SMALL_SF
from world import est, plan, product, sale, tables


def _world(spark):
    products = [product(k, f"{k // 2:09d}") for k in range(60)]
    supports = [("201401", 0, k, 1) for k in range(2, 18)] + [("201401", 0, 2, 1)] * 3      # 8 CUCs, one of them five times
    supports += [("201402", 0, k, 1) for k in range(2, 26)] + [("201401", 4, 6, 2)]         # 12 CUCs: beyond the limit
    plans = [plan("201401", k, 1 + k % 2, exposure="50%") for k in range(6)] * 2 + [plan("201715", k, 3, price=5.0) for k in range(4)]
    return tables(spark, products, [sale("201401", k, 1) for k in range(6)], plans, [est("201401", k, 1) for k in range(6)], supports)


def _by_campaign(df):
    """Exchanges that deal rows by the campaign and more."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"Exchange hashpartitioning\(AnioCampana#\w+, ", text))


def test_support_pairs_are_shuffled_once_by_campaign_and_cuc(spark):
    t = _world(job_session(spark))
    groups = support.supported_products(t, Params(), prepare_dims(t, Params()))
    got = {(r.AnioCampana, r.CodCUC, r.CodTipoOferta): r.NroApoyados for r in groups.collect()}
    assert got == {("201401", "000000000", "011"): 8, ("201401", "000000002", "003"): 1}
    assert _by_campaign(support.supported_keys(groups)) == 1


def test_tactics_are_shuffled_once_for_each_branch(spark):
    t = _world(job_session(spark))
    d = prepare_dims(t, Params())
    totals = flags.spread_mask(tactics.tactic_totals(tactics.clean_tactics(t, Params(), d), flags.flag_mask(flags.all_predicates())))
    assert _by_campaign(totals) == 2
    got = sorted((r.AnioCampana, r.CodCUC, r.PKTipoOferta, r.PrecioOferta, r.Exposicion, r.NroPaginas) for r in totals.collect())
    closed = [("201401", f"{c:09d}", k, 10.0, 1.0, 2) for c in range(3) for k in (1, 2)]
    assert got == closed + [("201715", f"{c:09d}", 3, 5.0, 1.0, 2) for c in range(2)]


def test_base_finds_its_estimates_without_another_exchange(spark):
    t = _world(job_session(spark))
    d = prepare_dims(t, Params())
    base = offer_grain_base(t, Params(), d, estimate_summary(t, Params(), d, "PE"))
    assert _by_campaign(base) <= 2     # one of the rows, one of the estimates
    assert sorted((r.AnioCampana, r.CodCUC, r.RealUUVendidas, r.PrecioNormalMN) for r in base.collect()) == [
        ("201401", f"{c:09d}", 20, 20.0) for c in range(3)] + [("201715", f"{c:09d}", 0, 0.0) for c in range(2)]


def test_queries_read_facts_lazily(spark):
    """No fact is written or shuffled for the mapping: a query scans the given files and the stored dimensions."""
    for name in ("supported_products", "tactic_totals"):
        read = {f.split("/")[-1] if "/sf0.001/" in f else f.split("/")[-2] for f in catalogue()[name].spark(spark, SMALL_SF).inputFiles()}
        assert "lineitem.parquet" in read and read <= {"lineitem.parquet", "part.parquet", "DPRODUCTO", "DTIPOOFERTA"}


def test_shuffle_partitions_follow_the_facts(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    partitions = lambda rows: int(job_session(spark, fact_rows=rows).conf.get("spark.sql.shuffle.partitions"))
    assert partitions(10) == int(before) and partitions(1000 * PARTITION_ROWS + 1) == 1001
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def _in_bytes(session):
    given = session.conf.get("spark.sql.autoBroadcastJoinThreshold")
    return -1 if given == "-1" else session._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(given)


def test_broadcast_limit_of_the_caller_holds_up_to_the_jobs(spark):
    key, other = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    caller = spark.newSession()
    for given, kept in (("10MB", BROADCAST_BYTES), ("1g", BROADCAST_BYTES), ("100k", 100 << 10), ("-1", -1)):
        caller.conf.set(key, given)
        assert _in_bytes(job_session(caller)) == kept and caller.conf.get(key) == given
    caller.conf.set(other, "5m")
    assert job_session(caller).conf.get(other) == str(BROADCAST_BYTES)


def test_products_beyond_the_driver_are_not_broadcast(spark, tmp_path):
    """300,000 products are a file below Spark's 10 MB, which every one of the job's product joins would build in the driver."""
    caller = spark.newSession()
    caller.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    own = job_session(caller)
    small = _world(own)
    key = F.col("id") + 1000
    cuc = F.lpad(F.floor(F.col("id") / 20).cast("string"), 9, "9")
    more = own.range(300_000).select(key.alias("PKProducto"), cuc.alias("CodCUC"), F.lit("LBEL").alias("DesMarca"), F.lit("0").alias("CodCategoria"),
                                     F.lit("CUIDADO PERSONAL").alias("DesCategoria"), F.lit("COSMETICOS").alias("DesUnidadNegocio"))
    small.product.unionByName(more).coalesce(1).write.parquet(str(tmp_path / "products"))
    t = replace(small, product=own.read.schema(small.product.schema).parquet(str(tmp_path / "products")))
    assert BROADCAST_BYTES < sum(f.stat().st_size for f in (tmp_path / "products").glob("*.parquet")) < 10 << 20
    for p in (Params(), Params(categories=("CUIDADO PERSONAL", "MAQUILLAJE"))):
        core = build(t, p, "BO").core
        assert "BroadcastExchange" not in core._jdf.queryExecution().executedPlan().toString()
    got = estimate_summary(t, Params(), prepare_dims(t, Params()), "PE").collect()
    assert sorted((r.AnioCampana, r.CodCUC, r.NroEstimados) for r in got) == [("201401", f"{c:09d}", 10) for c in range(3)]
