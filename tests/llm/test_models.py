"""The learned operators against plain versions: all label paths for op1, per-coordinate loops for op7, thresholds for op8."""

import itertools
import math
import random
import tracemalloc

import numpy as np
import pytest
import xxhash

from vitrina.llm import language_id, quality_rules, toxicity
from vitrina.llm.common import mix64


@pytest.fixture(scope="module")
def model():
    draw = random.Random(1)
    words = {"en": ["the", "house", "with", "water"], "de": ["das", "haus", "mit", "wässer"], "hi": ["हिन्दी", "भाषा", "में", "पानी"]}
    texts = [(lang, " ".join(draw.choice(own) for _ in range(30))) for lang, own in words.items() for _ in range(20)]
    return language_id.train([t for _, t in texts], [lang for lang, _ in texts], bits=12, steps=60)


def all_paths(text, model):
    """Language and score by summing over every labelling of the words."""
    words = language_id.words_of(text)
    if not words:
        return language_id.UNKNOWN, 0.0
    emit, k = language_id.emissions(words, model), len(model.languages)
    total, hits = 0.0, np.zeros(k)
    for path in itertools.product(range(k), repeat=len(words)):
        score = emit[0][path[0]] + math.log(sum(math.exp(model.transitions[a][path[0]]) for a in range(k)))
        score += sum(emit[t][path[t]] + model.transitions[path[t - 1]][path[t]] for t in range(1, len(words)))
        weight = math.exp(score)
        total += weight
        hits += weight * np.bincount(path, minlength=k)
    return model.languages[int(hits.argmax())], hits.max() / total / len(words)


def test_language_and_score_equal_the_sum_over_all_paths(spark, model):
    draw = random.Random(4)
    pool = ["the", "haus", "mit", "water", "भाषा", "पानी", "zzz", "é", "x1y"]
    texts = [" ".join(draw.choice(pool) for _ in range(draw.randint(0, 6))) for _ in range(40)] + ["½ ² ① Ⅷ 12", None, "", "́", "한국어"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(df, model).collect()}
    for i, text in enumerate(texts):
        lang, score = all_paths(text or "", model)
        assert got[i][0] == lang and got[i][1] == pytest.approx(score, abs=1e-9), text


def test_words_are_letters_with_their_marks():
    assert language_id.words_of("हिन्दी भाषा") == ["हिन्दी", "भाषा"]
    assert language_id.words_of("½²①Ⅷ 12_ ́") == [] and language_id.words_of("Ab1c don't") == ["ab", "c", "don", "t"]
    assert language_id.words_of("été été") == ["été", "été"]
    assert "".join(language_id.words_of("語" * 100)) == "語" * 100


def test_pieces_give_the_same_probabilities(model, monkeypatch):
    draw = random.Random(5)
    texts = [" ".join(draw.choice(["the", "haus", "mit", "water", "भाषा"]) for _ in range(n)) for n in (0, 5, 400, 3, 1000, 0, 33)]
    labeller = language_id.Labeller(model)
    whole = np.concatenate([found for *_, found in labeller.pieces(texts)])
    langs, scores = labeller.texts(texts)
    monkeypatch.setattr(language_id, "PIECE", 3 * 70)
    pieces = list(labeller.pieces(texts))
    assert len(pieces) > 15 and np.allclose(np.concatenate([found for *_, found in pieces]), whole, atol=1e-12)
    again, close = labeller.texts(texts)
    assert again == langs and np.allclose(close, scores, atol=1e-12)


def test_many_languages_take_bounded_memory():
    k = 100
    draw = np.random.default_rng(0)
    big = language_id.Model([f"l{i:02}" for i in range(k)], draw.normal(size=(1 << 10, k)), {}, np.zeros((k + 1, k)), draw.normal(size=(k, k)), 10)
    labeller = language_id.Labeller(big)
    text = " ".join(f"{a}{b}" for a in "abcdefghij" for b in "klmnopqrst") + " "
    tracemalloc.start()
    labeller.texts([text * 120, text, ""])  # 12,000 words; one array of words x languages squared would take 960 MB, of segments 30 MB
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100_000_000


def plain_features(text, bits):
    words = toxicity._WORDS.findall(text.lower())
    h = [np.uint64(xxhash.xxh3_64_intdigest(w)) for w in words]
    with np.errstate(over="ignore"):
        out = {int(x >> np.uint64(64 - bits)) for x in h}
        for gap, salt in ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F)):
            for a, b in zip(h, h[gap:]):
                out.add(int(mix64(np.array([a * np.uint64(salt) + b], np.uint64))[0] >> np.uint64(64 - bits)))
    return out


def plain_ftrl(rows, epochs=5, alpha=2.0, beta=1.0, l1=3.0, l2=0.1):
    """The published update, one coordinate at a time; key None is the bias, without penalty."""
    z, n = {}, {}

    def weight(i):
        zi, ni = z.get(i, 0.0), n.get(i, 0.0)
        if i is None:
            return -zi * alpha / (beta + math.sqrt(ni))
        return 0.0 if abs(zi) <= l1 else (math.copysign(l1, zi) - zi) / ((beta + math.sqrt(ni)) / alpha + l2)

    for _ in range(epochs):
        for features, label in rows:
            w = {i: weight(i) for i in [*features, None]}
            g = 1 / (1 + math.exp(-sum(w.values()))) - label
            for i, wi in w.items():
                sigma = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / alpha
                z[i], n[i] = z.get(i, 0.0) + g - sigma * wi, n.get(i, 0.0) + g * g
    return {i: weight(i) for i in z if i is None or weight(i)}


def toxic_rows():
    draw = random.Random(6)
    words = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(200):
        text = [draw.choice(words) for _ in range(draw.randint(0, 25))]
        if i % 3 == 0:
            text.insert(draw.randrange(len(text) + 1), "vile Scum")
        rows.append((i, " ".join(text), int(i % 3 == 0)))
    return rows


def test_scores_equal_plain_ftrl(spark):
    from pyspark.sql import functions as F
    rows = toxic_rows()
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows], "doc_id bigint, text string, label string").repartition(3)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id bigint, toxic int")
    import zlib
    trained = [(i, t, y) for i, t, y in rows if zlib.crc32(str(i).encode()) % 4 != 2]
    order = {r.doc_id: r.o for r in docs.select("doc_id", F.xxhash64(F.lit("sample"), "doc_id").alias("o")).collect()}
    trained.sort(key=lambda r: order[r[0]])
    weights = plain_ftrl([(plain_features(t, 16), y) for _, t, y in trained])
    got = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.fit(docs, labels, "toxic", bits=16)).collect()}
    for i, t, _ in rows:
        total = sum(weights.get(p, 0.0) for p in plain_features(t, 16)) + weights[None]
        assert got[i] == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-5)
    assert len(weights) < len({p for _, t, _ in rows for p in plain_features(t, 16)})  # L1 leaves some at 0


def test_sample_is_bounded_by_features(spark):
    rows = toxic_rows()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id bigint, toxic int")
    seen = []
    inner = toxicity.train
    try:
        toxicity.train = lambda given, *a, **b: seen.append(sum(len(p) for p, _ in given)) or inner(given, *a, **b)
        for most in (0, 500, 10 ** 9):
            toxicity.fit(docs, labels, "toxic", sample_features=most)
    finally:
        toxicity.train = inner
    assert seen[0] == 0 and 400 < seen[1] <= 500 < seen[2]


def plain_steps(rejected, n, risk, level):
    """How many cutoffs of a sequence are admitted: by the exact tail, until the first failure."""
    tail = lambda k: sum(math.comb(n, i) * risk ** i * (1 - risk) ** (n - i) for i in range(k + 1))
    steps = 0
    for k in rejected:
        if k > n * risk or tail(k) > level:
            break
        steps += 1
    return steps


def test_thresholds_equal_plain_ones(spark):
    from pyspark.sql import functions as F
    draw = random.Random(9)
    sizes = {"a": 150, "b": 230, "c": 700, "d": 2500}
    rows = [(s, 100, draw.choice([0, 0, 0, 0, draw.randrange(0, 40)]) if s != "b" else 0, draw.randrange(1, 4)) for s, n in sizes.items() for _ in range(n)]
    good = spark.createDataFrame(rows, "stratum string, n_words bigint, n_symbols bigint, n_marks bigint").withColumns(
        {c: F.lit(0).cast("bigint") for c in ("word_chars", "n_lines", "n_dup_lines", "n_capitals", "n_repeat_words")})
    got = {r.stratum: r.asDict() for r in quality_rules.thresholds(good).collect()}
    R = quality_rules
    for s, n in sizes.items():
        own = [r for r in rows if r[0] == s]
        value = {"symbols_per_word": lambda r: r[2] / 100, "marks_per_word": lambda r: r[3] / 100}
        over = lambda r, rule, cut: rule in value and value[rule](r) > cut
        single = {rule: plain_steps([sum(over(r, rule, c) for r in own) for c in cuts], n, R.RISK / 6, (1 - R.JOINT_SHARE) * R.DELTA / (4 * 6))
                  for rule, (_, _, cuts) in R.RULES.items()}
        joint = plain_steps([sum(any(over(r, rule, cuts[i]) for rule, (_, _, cuts) in R.RULES.items()) for r in own) for i in range(8)],
                            n, R.RISK, R.JOINT_SHARE * R.DELTA / 4)
        steps = single if any(single.values()) else dict.fromkeys(R.RULES, joint)
        want = {rule: R.RULES[rule][2][k - 1] if k else None for rule, k in steps.items()}
        assert {rule: got.get(s, {}).get(rule) for rule in R.RULES} == want, s
    assert "a" not in got and "b" in got


def test_false_rejection_stays_within_the_risk():
    """Strata whose good documents really exceed a cutoff more often than allowed get it in at most DELTA of the trials."""
    R, draw = quality_rules, np.random.default_rng(3)
    for n, share, risk, level in ((300, 0.0301, R.RISK, R.JOINT_SHARE * R.DELTA), (3000, 0.00501, R.RISK / 6, (1 - R.JOINT_SHARE) * R.DELTA / 6)):
        wrong = 0
        for _ in range(2000):
            # nested cutoffs: the first rejects a tenth of what is allowed, each of the others just too much
            u = draw.random(n)
            wrong += plain_steps([int((u < s).sum()) for s in (share / 10, share, share * 1.2)], n, risk, level) > 1
        assert wrong / 2000 <= level + 3 * math.sqrt(level / 2000)
