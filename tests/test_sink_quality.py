import re
import tempfile
import uuid

import pytest

from vitrina.operators.dims import prepare_dims
from vitrina.params import Params
from vitrina.plans.quality import quality_metrics
from vitrina.plans.settings import job_session
from vitrina.plans.sink import read_features, write_features, write_features_table
from vitrina.sources.fixtures import fixture_tables

from conftest import SMALL_SF

# hash exchanges of the planned core job, counted; a doubled shuffle must not pass
CORE_EXCHANGES = 12


def test_sink_replaces_only_written_campaigns(spark):
    path = tempfile.mkdtemp(prefix="vitrina-sink-") + "/features"
    df = spark.createDataFrame([("201401", "A", 1.0), ("201402", "A", 2.0)],
                               "AnioCampana string, CodCUC string, x double")
    write_features(df, path)
    write_features(spark.createDataFrame([("201402", "B", 3.0)], "AnioCampana string, CodCUC string, x double"),
                   path)
    back = read_features(spark, path)
    assert sorted(tuple(r) for r in back.collect()) == [("A", 1.0, "201401"), ("B", 3.0, "201402")]


def test_table_sink_keeps_other_campaigns_and_column_order(spark):
    table = f"features_{uuid.uuid4().hex}"
    schema = "CodPais string, AnioCampana string, CodCUC string, x double"
    make = lambda *rows: spark.createDataFrame(list(rows), schema)
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    read = lambda: sorted(tuple(r) for r in spark.table(table).select("CodPais", "AnioCampana", "CodCUC", "x").collect())
    try:
        write_features_table(make(("PE", "201401", "A", 1.0), ("PE", "201402", "A", 2.0)), table)
        write_features_table(make(("PE", "201403", "C", 3.0)), table)                       # disjoint
        assert read() == [("PE", "201401", "A", 1.0), ("PE", "201402", "A", 2.0), ("PE", "201403", "C", 3.0)]
        write_features_table(make(("PE", "201402", "B", 9.0), ("PE", "201404", "D", 4.0)), table)   # overlapping
        assert read() == [("PE", "201401", "A", 1.0), ("PE", "201402", "B", 9.0), ("PE", "201403", "C", 3.0),
                          ("PE", "201404", "D", 4.0)]
        with pytest.raises(ValueError):
            write_features_table(make(("PE", "201402", "B", 9.0)).drop("x"), table)
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_quality_metrics_on_fixture(spark):
    t = fixture_tables(spark, SMALL_SF)
    p = Params()
    got = {r.metric: r.value for r in quality_metrics(t, p, prepare_dims(t, p)).collect()}
    # exact counts are checked against DuckDB by the oracle test of the ``quality_metrics`` query
    assert got["country_rows"] == 1
    assert all(got[m] > 0 for m in ("bad_exposure_texts", "price_codes_with_several_keys", "zero_order_counts",
                                    "campaigns_with_several_order_counts"))


def _pushed(df):
    """The filters pushed to the scans, from the untruncated explanation."""
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return " ".join(re.findall(r"PushedFilters: .*", df._jdf.queryExecution().explainString(mode)))


def test_plan_prunes_and_pushes_down(spark):
    """Scans read only the columns they need, prune campaign partitions and get the code filters."""
    from vitrina.operators import base as base_ops
    from vitrina.operators import tactics
    t = fixture_tables(spark, SMALL_SF)
    p = Params()
    d = prepare_dims(t, p)
    plan = base_ops.closed_sales_base(t, p, d)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(AnioCampana" in plan and "201401" in plan
    assert "ReadSchema: struct<AnioCampanaRef:string,PKProducto:bigint,PKTipoOferta:bigint," in plan
    pushed = _pushed(base_ops.closed_sales_base(t, p, d))
    assert "EqualTo(DesCategoria," in pushed and "EqualTo(CodTipoProfit," in pushed and "In(CodTipoOferta," in pushed
    assert "In(DesTipoCatalogo," in _pushed(tactics.closed_tactic_groups(t, p, d, True))


def test_core_plan_shape(spark):
    """No dynamic-pruning copies; every fact is scanned a bounded number of times; the
    only shuffles of the line-item-sized facts come after partial aggregates."""
    from vitrina.plans.feature_job import build
    options = dict(spark.conf.getAll)
    t = fixture_tables(job_session(spark), SMALL_SF)
    st = build(t, Params(), "SV")
    optimized = st.core._jdf.queryExecution().optimizedPlan().toString()
    assert "dynamicpruning" not in optimized.lower()
    relations = [line for line in optimized.splitlines() if "Relation [" in line]
    # marker column of each fact -> most scans; the page plan's layout is read once per branch
    scans = [line for line in st.core._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line]
    assert relations and scans
    for marker, most in [("RealUUVendidas", 1), ("EstUUVendidas", 1), ("PKProductoApoyado:", 1), ("DesTipoCatalogo:", 2)]:
        n = sum(1 for line in scans if marker.rstrip(":") + ":" in line)
        assert 1 <= n <= most, (marker, n)
    physical = st.core._jdf.queryExecution().executedPlan().toString()
    assert physical.count("Exchange hashpartitioning") <= CORE_EXCHANGES
    assert dict(spark.conf.getAll) == options          # the caller's session stays as it was


def test_final_job_has_one_exchange(spark):
    from vitrina.operators.sequences import attach_sequences
    df = spark.createDataFrame([("201401", "A"), ("201402", "A"), ("201402", None)], "AnioCampana string, CodCUC string")
    out = attach_sequences(df, 500)
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange") <= 1
    assert sorted((r.AnioCampana, r.CodCUC or "", r.NCampaign, r.N_Records_SKU) for r in out.collect()) == [
        ("201401", "A", 1, 1), ("201402", "", 2, 0), ("201402", "A", 2, 2)]
    with pytest.raises(ValueError):
        attach_sequences(df, 1)


def test_checkpoint_folder_is_required_off_local():
    from types import SimpleNamespace

    from vitrina.session import ensure_checkpoint_dir
    context = SimpleNamespace(getCheckpointDir=lambda: None, master="yarn")
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *_: None)))
