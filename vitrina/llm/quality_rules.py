"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

Each document gets counts and a few ratios; a ratio above its stratum's cutoff rejects the document.  Cutoffs are chosen on good labelled documents
of the stratum (its language), by the exact binomial tail P(X <= rejected | n, risk), in fixed sequences from lenient to strict
that stop at the first failure, so that the cutoffs of a sequence need no correction among themselves:

* a sequence for each rule, where a cutoff may reject ``RISK / rules`` of the good documents.  Strata and rules are corrected by Bonferroni;
* one sequence of joint cutoffs, where step i of all rules together may reject ``RISK``.  It needs far fewer documents (about 200) and
  is used in strata where no rule gets a cutoff by itself.

The joint sequences get ``JOINT_SHARE`` of ``DELTA``, the rules' the rest.  Hence with probability 1 - ``DELTA`` no stratum loses more than ``RISK`` of its
good documents to these rules.  A stratum without an admitted cutoff rejects nothing.

Null text has no words; a null stratum is a stratum of its own.  Repeated rows are judged alike.  A document labelled
more than once counts as good only if all its labels say so.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrina.llm.common import SPACE_RUN, SPACES, shared_table, table

SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
#: Largest share of a stratum's good documents that the rules may reject, and the chance that this fails.
RISK, DELTA = 0.03, 0.05
#: The part of DELTA that goes to the joint cutoffs.
JOINT_SHARE = 0.125
#: Ratio, its numerator and denominator, and the cutoffs tried, from lenient to strict.
RULES = {
    "symbols_per_word": ("n_symbols", "n_words", [1.0, 0.5, 0.4, 0.3, 0.2, 0.1, 0.05, 0.02]),
    "chars_per_word": ("word_chars", "n_words", [9.0, 8.0, 7.5, 7.0, 6.5, 6.0, 5.75, 5.5]),
    "capital_share": ("n_capitals", "word_chars", [0.9, 0.7, 0.5, 0.3, 0.2, 0.15, 0.1, 0.08]),
    "marks_per_word": ("n_marks", "n_words", [1.0, 0.8, 0.5, 0.3, 0.2, 0.1, 0.05, 0.02]),
    "repeated_line_share": ("n_dup_lines", "n_lines", [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2]),
    "repeated_word_share": ("n_repeat_words", "n_words", [0.19, 0.15, 0.12, 0.1, 0.08, 0.05, 0.03, 0.01]),
}

STEPS = min(len(cutoffs) for *_, cutoffs in RULES.values())


def _bind(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, also inside other lambdas."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    bare = F.btrim(text, F.lit(SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE_RUN))


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words inside windows of ``window`` words that occur twice or more, the first occurrence included.

    Windows are compared by 64-bit hashes.
    """
    def covered(hashes: Column) -> Column:
        places = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        again = lambda s: F.filter(s, lambda x, k: F.get(s, k - 1)["h"].eqNullSafe(x["h"]) | F.get(s, k + 1)["h"].eqNullSafe(x["h"]))
        starts = _bind(places, lambda s: F.array_sort(F.transform(again(s), lambda x: x["i"])))
        return _bind(starts, lambda p: F.aggregate(
            F.transform(p, lambda at, k: F.least(F.lit(window), F.coalesce(F.get(p, k + 1) - at, F.lit(window)))),
            F.lit(0), lambda total, n: total + n))

    def windows(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - window), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(window)]))

    def count(w: Column) -> Column:
        return F.when(F.size(w) < window, 0).otherwise(_bind(
            windows(w), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(h))))

    return _bind(words, count)


def repeated_lines(text: Column) -> Column:
    """Lines with a word that are equal to an earlier line."""
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    return _bind(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def _without(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, ""))


def measures(df: DataFrame, stratum: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, stratum, counts): one narrow row for each document."""
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(stratum.cast("string"), F.lit("")).alias("stratum"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    text = F.col("text")
    both = _bind(words_of(text), lambda w: F.struct(F.size(w).alias("n"), repeated_words(w).alias("again")))
    counts = rows.select(
        "id", "stratum", both.alias("words"),
        _without(text, SPACES).alias("word_chars"),
        (F.length(text) - _without(text, SYMBOLS)).alias("n_symbols"),
        (F.length(text) - _without(text, "\n") + 1).alias("n_lines"),
        repeated_lines(text).alias("n_dup_lines"),
        (F.length(text) - _without(text, string.ascii_uppercase)).alias("n_capitals"),
        (F.length(text) - _without(text, "!?")).alias("n_marks"))
    whole = ["word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_capitals", "n_marks"]
    return counts.select("id", "stratum", F.col("words.n").cast("bigint").alias("n_words"),
                         F.col("words.again").cast("bigint").alias("n_repeat_words"), *[F.col(c).cast("bigint").alias(c) for c in whole])


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _exceeds(rule: str, cutoff) -> Column:
    above, below, _ = RULES[rule]
    return F.col(above) / F.greatest(F.col(below), F.lit(1)) > cutoff


def _log_factorial(n: Column) -> Column:
    """ln n!: Stirling's series at n + 9, brought back by the product of what lies between."""
    z = n.cast("double") + 9
    series = (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z ** 3) + 1 / (1260 * z ** 5)
    between = F.lit(1.0)
    for k in range(1, 9):
        between = between * (n + k)
    return series - F.log(between)


def log_binomial_tail(k: Column, n: Column, p: float) -> Column:
    """ln P(X <= k) for X binomial(n, p) and k <= n p, to double precision.

    The terms fall from k down at least as fast as a normal density, so those beyond 12 standard deviations don't count.
    """
    last = F.least(k, (40 + 12 * F.sqrt(n * p)).cast("bigint"))
    first = _log_factorial(n) - _log_factorial(k) - _log_factorial(n - k) + k * math.log(p) + (n - k) * math.log1p(-p)
    zero = F.struct(F.lit(1.0).alias("sum"), F.lit(1.0).alias("term"))

    def add(state: Column, t: Column) -> Column:
        term = state["term"] * (k - t + 1) * (1 - p) / ((n - k + t) * p)
        return F.struct((state["sum"] + term).alias("sum"), term.alias("term"))

    steps = F.when(last < 1, F.array().cast("array<bigint>")).otherwise(F.sequence(F.lit(1).cast("bigint"), last))
    return first + F.log(F.aggregate(steps, zero, add, lambda s: s["sum"]))


def _joint(step: int) -> Column:
    """Whether any rule rejects at its cutoff of the step."""
    out = F.lit(False)
    for rule, (_, _, cutoffs) in RULES.items():
        out = out | _exceeds(rule, cutoffs[step])
    return out


def thresholds(good: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """(stratum, one cutoff column for each rule): ``good`` holds the measures of good labelled documents.

    A null cutoff rejects nothing; a stratum without any is left out.
    """
    trials = [(rule, i, _exceeds(rule, cut)) for rule, (_, _, cutoffs) in RULES.items() for i, cut in enumerate(cutoffs)]
    trials += [("", i, _joint(i)) for i in range(STEPS)]
    counted = shared_table(good.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), *[
        F.count_if(rejected).alias(f"k{t}") for t, (_, _, rejected) in enumerate(trials)]), "rule-counts")
    strata = max(1, counted.count())
    tests = counted.select("stratum", "n", F.explode(F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.lit(i).alias("step"), F.col(f"k{t}").alias("k")) for t, (rule, i, _) in enumerate(trials)])).alias("t"))

    def admitted(share: float, level: float) -> Column:
        k, n = F.col("t.k"), F.col("n")
        return (k <= n * share) & (log_binomial_tail(F.least(k, (n * share).cast("bigint")), n, share) <= math.log(level))

    fails = F.when(F.col("t.rule") == "", ~admitted(risk, JOINT_SHARE * delta / strata)).otherwise(
        ~admitted(risk / len(RULES), (1 - JOINT_SHARE) * delta / (strata * len(RULES))))
    steps = tests.groupBy("stratum", F.col("t.rule").alias("rule")).agg(
        F.coalesce(F.min(F.when(fails, F.col("t.step"))), F.lit(STEPS)).alias("steps"))
    wide = steps.groupBy("stratum").agg(F.max(F.when(F.col("rule") == "", F.col("steps"))).alias("joint"),
                                        F.max(F.when(F.col("rule") != "", F.col("steps"))).alias("single"),
                                        *[F.max(F.when(F.col("rule") == rule, F.col("steps"))).alias(rule) for rule in RULES])
    used = lambda rule: F.when(F.col("single") > 0, F.col(rule)).otherwise(F.col("joint"))
    cutoff = lambda rule: F.get(F.array(*map(F.lit, RULES[rule][2])), used(rule) - 1)  # noqa: E731  null before the first
    return wide.where(F.greatest("joint", "single") > 0).select("stratum", *[cutoff(rule).alias(rule) for rule in RULES])


def judge(df: DataFrame, labels: DataFrame, label_col: str, stratum: Column, id_col: str = "doc_id", text_col: str = "text",
          risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """(id, counts, base_failed, kept) of every row; the counts are stored once."""
    counted = shared_table(measures(df, stratum, id_col, text_col), "measures")
    good = (labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("good"))
            .groupBy("id").agg(F.min("good").alias("good")).where(F.col("good") == 1))
    cutoffs = shared_table(thresholds(counted.where(~base_failed()).join(good, "id"), risk, delta), "cutoffs")
    rejected = F.lit(False)
    for rule in RULES:
        rejected = rejected | F.coalesce(_exceeds(rule, F.col(rule)), F.lit(False))
    return (counted.join(cutoffs, "stratum", "left")
            .select(F.col("id").alias(id_col), "stratum", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    base_failed().alias("base_failed"), (~(base_failed() | rejected)).alias("kept")))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return judge(docs, table(spark, sf_dir, "labels"), "quality", F.col("lang")).drop("stratum")


def _oracle() -> str:
    exceeds = lambda rule, cut: f"{RULES[rule][0]} / greatest({RULES[rule][1]}, 1) > {cut}"
    share, strata = RISK / len(RULES), "(SELECT count(DISTINCT stratum) FROM good)"
    rows = [(rule, i, exceeds(rule, cut), share, f"{(1 - JOINT_SHARE) * DELTA!r} / ({strata} * {len(RULES)})")
            for rule, (_, _, cutoffs) in RULES.items() for i, cut in enumerate(cutoffs)]
    rows += [("joint", i, " OR ".join(exceeds(rule, RULES[rule][2][i]) for rule in RULES), RISK, f"{JOINT_SHARE * DELTA!r} / {strata}") for i in range(STEPS)]
    trials = " UNION ALL ".join(
        f"SELECT stratum, '{rule}' AS rule, {i} AS step, {p!r}::DOUBLE AS p, {level} AS level, count(*) AS n, count(*) FILTER ({test}) AS k"
        f" FROM good GROUP BY stratum" for rule, i, test, p, level in rows)
    lists = " ".join(f"WHEN '{rule}' THEN {cutoffs!r}" for rule, (_, _, cutoffs) in RULES.items())
    rejected = " OR ".join(
        f"coalesce({above} / greatest({below}, 1) > (SELECT cutoff FROM chosen a WHERE a.stratum = m.stratum AND rule = '{rule}'), false)"
        for rule, (above, below, _) in RULES.items())
    spaces = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return rf"""
WITH docs AS (SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text FROM documents),
words AS (SELECT doc_id, unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS word,
                 generate_subscripts(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), 1) AS pos FROM docs),
windows AS (SELECT doc_id, pos, word, CASE WHEN lead(word, 4) OVER w IS NOT NULL THEN
              concat_ws(' ', word, lead(word) OVER w, lead(word, 2) OVER w, lead(word, 3) OVER w, lead(word, 4) OVER w) END AS win
            FROM words WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
twice AS (SELECT *, win IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, win) > 1 AS again FROM windows),
inside AS (SELECT doc_id, max(again::INT) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS hit FROM twice),
per_doc AS (SELECT doc_id, count(*) AS n_words, sum(hit) AS n_repeat_words FROM inside GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines WHERE trim(line, {spaces}) <> '' GROUP BY doc_id),
m AS (SELECT d.doc_id, d.stratum, coalesce(p.n_words, 0)::BIGINT AS n_words,
        length(translate(text, {spaces}, ''))::BIGINT AS word_chars,
        (length(text) - length(translate(text, '{SYMBOLS}', '')))::BIGINT AS n_symbols,
        (length(text) - length(translate(text, chr(10), '')) + 1)::BIGINT AS n_lines,
        coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
        (length(text) - length(translate(text, '{string.ascii_uppercase}', '')))::BIGINT AS n_capitals,
        (length(text) - length(translate(text, '!?', '')))::BIGINT AS n_marks,
        coalesce(p.n_repeat_words, 0)::BIGINT AS n_repeat_words
      FROM docs d LEFT JOIN per_doc p USING (doc_id) LEFT JOIN dup USING (doc_id)),
judged AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m),
good AS (SELECT * FROM judged WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM labels GROUP BY doc_id HAVING min(quality) = 1)),
trials AS ({trials}),
tails AS (SELECT t.stratum, t.rule, t.step, any_value(k <= n * p) AS few, any_value(level) AS level,
    sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(p) + (n - i) * ln(1 - p))) AS tail
  FROM trials t, generate_series(0, 100000) AS s(i) WHERE i <= k GROUP BY t.stratum, t.rule, t.step),
passed AS (SELECT stratum, rule, coalesce(min(step) FILTER (NOT (few AND tail <= level)), {STEPS}) AS steps FROM tails GROUP BY stratum, rule),
used AS (SELECT r.stratum, r.rule, CASE WHEN (SELECT max(steps) FROM passed a WHERE a.stratum = r.stratum AND a.rule <> 'joint') > 0 THEN r.steps
    ELSE j.steps END AS steps FROM passed r JOIN passed j ON j.stratum = r.stratum AND j.rule = 'joint' WHERE r.rule <> 'joint'),
chosen AS (SELECT stratum, rule, (CASE rule {lists} END)[steps] AS cutoff FROM used WHERE steps > 0)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR {rejected}) AS kept
FROM judged m
"""


OP8_SQL = _oracle()
