"""What a Python task of the word operators holds at once follows neither Spark's batch nor the vocabulary of the texts."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vitrina.llm import common, language_id, shingles, toxicity


def test_batches_of_wide_rows_are_bounded(spark):
    wide = spark.range(0, 4000, 1, 1).select(F.repeat(F.lit("x"), 4000).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["rows", "bytes"])

    found = common.map_arrow(wide, sizes, "rows bigint, bytes bigint").collect()
    assert sum(r.rows for r in found) == 4000
    assert max(r.bytes for r in found) < 1.1 * common.BATCH_BYTES


def test_a_bound_of_the_session_itself_stays(spark):
    own = spark.newSession()
    own.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "1000000")
    common.map_arrow(own.range(1), lambda batches: batches, "id bigint")
    assert int(own.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("b")) == 1_000_000


def many_words(texts=400, words=2000):
    """Texts of 6 MB together, of 200,000 different words."""
    rng = np.random.default_rng(5)
    return [" ".join(f"w{i:06d}" for i in rng.integers(0, 200_000, words)) for _ in range(texts)]


def test_scoring_holds_little_of_a_batch_at_once():
    texts = many_words()
    batch = pa.record_batch([pa.array(range(len(texts))), pa.array(texts)], names=["id", "text"])
    rng = np.random.default_rng(6)
    places = np.sort(rng.choice(1 << 20, 50_000, replace=False)).astype(np.int32)
    model = toxicity.Model(20, places, rng.normal(size=50_000).astype(np.float32), -1.0)
    tracemalloc.start()
    try:
        scores = np.concatenate([s for _, s in toxicity._scores(iter([batch]), "text", model)])
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 60e6
    few = batch.slice(137, 3)
    assert np.array_equal(scores[137:140], next(toxicity._scores(iter([few]), "text", model))[1])


@pytest.mark.parametrize("kind", ["toxicity", "language", "shingles"])
def test_remembered_words_are_bounded(kind):
    texts = many_words()
    if kind == "toxicity":
        made = toxicity.Features(20)
        call = made
    elif kind == "language":
        model = language_id.Model(["a", "b"], np.zeros((1 << 16, 2)), {}, np.zeros((3, 2)), np.zeros((2, 2)), 16)
        made = language_id.Labeller(model)
        call = made.texts
    else:
        made = shingles.ShingleSets()
        call = lambda block: made([t.encode() for t in block])
    for at in range(0, len(texts), 50):
        call(texts[at:at + 50])
        assert len(made.words) <= common.REMEMBERED_WORDS + 50 * 2000
    assert len(made.words) < 200_000 * 0.95
