"""The corpus pipeline against plain versions of its stages, and its registration."""

import re
from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F

from conftest import SMALL_SF
from vitrina.llm import language_id, toxicity
from vitrina.llm.common import table

from test_operators import check_layout, documents, odd_rows, plain_groups, plain_line_dedup


def test_each_stage_on_the_rows_of_the_one_before(spark):
    docs = table(spark, SMALL_SF, "documents")
    columns = docs.columns
    labels = table(spark, SMALL_SF, "labels")
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        out = stage(spark, docs, SMALL_SF).cache()
        rows = out.collect()
        if name == "toxicity":
            scores = toxicity.score(docs, toxicity.fit(docs, labels, "toxic"))
            assert {r.doc_id for r in rows} == {r.doc_id for r in scores.collect() if r.score < 0.3}
        elif name == "language_id":
            found = language_id.identify(docs, language_id.fit(docs)).collect()
            assert {r.doc_id for r in rows} == {r.doc_id for r in found if r.lang_pred != "und" and r.score >= 0.4}
            assert len(rows) > 0.95 * len(before)
        elif name == "line_dedup":
            plain = {i: (n, gone) for i, n, gone, _ in plain_line_dedup([(i, r.text) for i, r in before.items()])}
            assert {r.doc_id for r in rows} == set(before)
            for r in rows:
                n, gone = plain[r.doc_id]
                assert len(r.text.split("\n")) == max(1, n - gone) and r.n_chars == len(r.text)
                assert r.text == before[r.doc_id].text or gone
        elif name == "near_dedup":
            groups = plain_groups([(i, r.text) for i, r in before.items()])
            assert {r.doc_id for r in rows} == {i for i, _, c in groups if i == c}
        else:
            assert {r.doc_id for r in rows} == set(before)
            check_layout(rows)
        if name != "packing":
            assert out.columns == columns
        docs = out


def test_odd_rows_go_through(spark, tmp_path):
    rows = [*odd_rows(), *[(100 + i, f"the words of document number {i} are these and no others") for i in range(30)]]
    documents(spark, rows).withColumns({"row": F.lit(1), "text_length": F.lit(None).cast("int")}).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(100 + i, 1, 0) for i in range(30)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    check_layout(out)
    letters = Counter(i for i, t in rows if re.search(r"[^\W\d_]", t or ""))
    assert {r.doc_id for r in out} <= set(letters) and len({r.doc_id for r in out}) > 10


def test_empty_tables_go_through(spark, tmp_path):
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_entry_registers_every_operator():
    import __spark_entry__ as entry
    names = list(entry.queries())
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and set(entry.oracle_sql()) <= set(names)
