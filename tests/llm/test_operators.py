"""The corpus operators against plain versions, on odd rows and on the small tables."""

import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from conftest import SMALL_SF
from vitrina.llm import (binary_fuse, bpe, exact_dedup, html_main_text, html_tree, language_id, line_dedup, near_dedup,
                         packing, quality_rules, registry, resampling, shingles, toxicity)
from vitrina.llm.components import connected_components

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SPACE = r"[\x20\x09-\x0D]+"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def documents(spark, rows):
    """Rows (id, text) with the other columns of documents, in several partitions."""
    return spark.createDataFrame([(i, t, "en", "s", len(t) if t is not None else None) for i, t in rows], DOCS).repartition(3)


def odd_rows():
    """Nulls, empty and long texts, repeated rows and ids, odd white space and characters."""
    line = "This line is long enough to be counted as a line."
    words = " ".join(f"w{i % 977}" for i in range(30_000))
    return [(1, None), (2, ""), (3, " \t\n"), (4, "a"), (5, "A"), (6, "one two three four"), (7, "ONE  two\tthree four"),
            (8, line + "\nx\n" + line), (9, "  " + line.upper() + " \ny"), (10, line), (11, line), (11, line), (11, "other text"),
            (None, line), (None, None), (12, words), (13, words + " end"), (14, "İ ǅ ﬁ 𝒳 日本語    é"), (15, "\x1c\x85 a\x00b"),
            (16, "<|endoftext|> x <|startoftext|>"), (17, "don't we'll 12 ½ !!!")]


@pytest.fixture(scope="module")
def odd(spark):
    return documents(spark, odd_rows())


@pytest.fixture(scope="module")
def small():
    con = duckdb.connect()
    for name in ("documents", "labels", "pages", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SMALL_SF}/{name}.parquet')")
    return con


def write(folder, **tables):
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_sql(spark, small, name):
    got = registry.QUERIES[name](spark, SMALL_SF).toArrow()
    want = small.execute(registry.ORACLE_SQL[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(got.column_names)
    key = lambda rows: Counter(map(repr, rows))
    assert key(zip(*(got.column(c).to_pylist() for c in names), strict=True)) == key(want.fetchall())


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_empty_tables(spark, tmp_path, name):
    docs = documents(spark, [])
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    embeddings = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    conversations = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    out = registry.QUERIES[name](spark, write(tmp_path, documents=docs, labels=labels, pages=pages, embeddings=embeddings, conversations=conversations))
    assert out.count() == 0


@pytest.mark.parametrize("name", sorted(n for n in registry.QUERIES if n not in ("op4_main_text", "op9_packing", "op12_centroids", "op13_conversation_repair")))
def test_odd_rows_keep_their_number(spark, odd, tmp_path, name):
    labels = spark.createDataFrame([(4, 1, 0), (6, 1, 1), (8, 0, None), (10, None, 1), (10, 1, 0)], "doc_id bigint, quality int, toxic int")
    out = registry.QUERIES[name](spark, write(tmp_path, documents=odd, labels=labels))
    assert Counter(r[0] for r in out.select("doc_id").collect()) == Counter(i for i, _ in odd_rows())


# -- 1


def test_marginals_are_those_of_plain_forward_backward():
    rng = np.random.default_rng(0)
    counts = np.array([1, 31, 32, 33, 0, 100, 64, 5])
    scores, transitions = rng.normal(size=(counts.sum(), 3)) * 2, rng.normal(size=(3, 3))
    got, end = language_id.marginals(scores, counts, transitions), 0
    for n in counts:
        emit, alpha, before = np.exp(scores[end:end + n]), [], np.full(3, 1 / 3)
        for t in range(n):
            before = before @ np.exp(transitions) * emit[t]
            before /= before.sum()
            alpha.append(before)
        beta = np.ones(3)
        for t in range(n - 1, -1, -1):
            p = alpha[t] * beta
            assert np.allclose(p / p.sum(), got[end + t])
            beta = np.exp(transitions) @ (emit[t] * beta)
            beta /= beta.sum()
        end += n


def test_languages_of_held_out_texts(spark, small):
    got = {r.doc_id: r for r in registry.QUERIES["op1_language_id"](spark, SMALL_SF).collect()}
    rows = small.execute("SELECT doc_id, text, lang FROM documents").fetchall()
    fold = {i: zlib.crc32(str(i).encode()) % 4 == 2 for i, *_ in rows}
    assert all(got[i].held_out == f for i, f in fold.items())
    hits = [got[i].lang_pred == lang for i, _, lang in rows if fold[i]]
    assert sum(hits) / len(hits) > 0.9
    assert all(0 <= r.score <= 1 for r in got.values())


def test_code_switched_text_is_labelled_by_word(spark):
    rng = random.Random(1)
    make = {"x": lambda: "".join(rng.choice("abcd") for _ in range(5)), "y": lambda: "".join(rng.choice("wxyz") for _ in range(5))}
    texts = [(" ".join(make[lang]() for _ in range(40)), lang) for lang in ("x", "y") for _ in range(40)]
    model = language_id.train([t for t, _ in texts], [lang for _, lang in texts], steps=60)
    mixed = " ".join([make["x"]() for _ in range(10)] + [make["y"]() for _ in range(30)])
    df = spark.createDataFrame([(1, mixed), (2, "12 !"), (3, None)], "doc_id int, text string")
    spans = {r.doc_id: [tuple(s) for s in r.spans] for r in language_id.label_words(df, model).collect()}
    assert spans == {1: [("x", 10), ("y", 30)], 2: [], 3: []}
    found = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(df, model).collect()}
    assert found[1][0] == "y" and found[1][1] == pytest.approx(0.75, abs=0.05) and found[2] == found[3] == ("und", 0.0)
    assert [r.doc_id for r in language_id.with_language(df, model).collect()] == [1]


def test_long_runs_of_letters_are_read_whole(spark):
    rng = random.Random(2)
    make = lambda lang, n: "".join(rng.choice({"x": "abcd", "y": "wxyz"}[lang]) for _ in range(n))
    texts = [(" ".join(make(lang, 5) for _ in range(40)), lang) for lang in ("x", "y") for _ in range(40)]
    model = language_id.train([t for t, _ in texts], [lang for _, lang in texts], steps=60)
    rows = [(1, make("x", 24) + make("y", 480) + make("x", 24)), (2, make("x", 96) + make("y", 96))]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    assert {r.doc_id: r.lang_pred for r in language_id.identify(df, model).collect()}[1] == "y"
    spans = {r.doc_id: [tuple(s) for s in r.spans] for r in language_id.label_words(df, model).collect()}
    assert spans[2] == [("x", 2), ("y", 2)] and sum(n for _, n in spans[1]) == 11
    assert "".join(language_id.words_of(rows[0][1])) == rows[0][1] and language_id.words_of("a" * 48 + " b") == ["a" * 48, "b"]


# -- 2


def test_fuse_filters_know_their_keys():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 50, 2000, 40_000):
        keys = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        made = binary_fuse.build(np.concatenate((keys, keys[:5])))
        assert binary_fuse.contains(made, keys).all()
        others = rng.integers(1 << 63, (1 << 64) - 1, 20_000, dtype=np.uint64)
        assert binary_fuse.contains(made, others).mean() < 0.01
        assert n < 2000 or len(made) < 1.4 * n + 100


def test_exact_dedup_of_odd_rows(spark, odd):
    from pyspark.sql import functions as F
    for share in (2, 1, 1 << 40):  # both batches, all in the snapshot, all incoming
        rows = exact_dedup.deduplicate(odd, F.pmod(F.xxhash64("id"), F.lit(share)) == 0).collect()
        norm = [(i, re.sub(SPACE, " ", t or "")) for i, t in odd_rows()]
        ids = defaultdict(list)
        for i, t in norm:
            ids[t].append(i)
        want = []
        for t, own in ids.items():
            known = [i for i in own if i is not None]
            keep = min(known) if known else None
            seen = False
            for i in sorted(own, key=lambda i: (i != keep, i is None, i or 0)):
                want.append((i, keep, len(own), i == keep and not seen, hashlib.sha256(t.encode()).hexdigest()))
                seen = seen or i == keep
        assert Counter(map(tuple, rows)) == Counter(want)


# -- 3


def test_kth_largest_is_exact(spark):
    rng = random.Random(2)
    values = [rng.choice([rng.randrange(-1 << 61, 1 << 61), rng.randrange(-50, 50)]) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "v bigint").repartition(4)
    for k in (1, 2, 1500, 3000):
        assert resampling.kth_largest(df, "v", k) == sorted(values)[-k]
    assert resampling.kth_largest(df, "v", 3001) is None and resampling.kth_largest(df, "v", 0) is None


def test_resampling_weights_and_selection(spark, small):
    got = {r.doc_id: r for r in registry.QUERIES["op3_resampling"](spark, SMALL_SF).collect()}
    rows = small.execute("SELECT doc_id, text FROM documents").fetchall()
    wanted = {i for i, in small.execute("SELECT doc_id FROM labels WHERE quality = 1").fetchall() if zlib.crc32(str(i).encode()) % 4 != 2}
    grams, counts = resampling.Grams(), np.zeros((2, 1 << resampling.BITS))
    buckets = {i: grams([t or ""])[1] for i, t in rows}
    for i, b in buckets.items():
        for k in range(2):
            counts[k] += np.bincount(b, minlength=counts.shape[1]) * (k or i in wanted)
    ratios = resampling.log_ratios(*counts)
    for i, b in buckets.items():
        assert got[i].log_weight == pytest.approx(ratios[b].sum(), abs=1e-6) and got[i].n_grams == len(b)
    chosen = sorted(got, key=lambda i: -got[i].key)[:math.ceil(resampling.FRACTION * len(got))]
    assert {i for i, r in got.items() if r.selected} == set(chosen)
    quality = dict(small.execute("SELECT doc_id, quality FROM labels").fetchall())
    kept = lambda q: np.mean([got[i].selected for i, x in quality.items() if x == q])
    assert kept(1) > 0.85 and kept(1) - kept(0) > 0.3


# -- 4


def page(body, title="t"):
    return f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style><script>var a='</p>';</script></head><body>{body}</body></html>"


def test_main_text_of_single_pages():
    text = lambda html: html_main_text.main_text(html, set())
    assert text("") == "" and text("plain &amp; simple") == "plain & simple" and text("<") == "<" and text("a < b") == "a < b"
    assert text(page("<nav>menu</nav><article><h1>Head</h1><p>One <b>bo</b>ld<br>two<p>three&nbsp;&#233;</article><footer>f</footer>")) == \
        "Head One bold two three é"
    assert text(page("<header>h</header><main><p>a</p><aside>s</aside><form>q</form><div class='ad-box'>x</div><p>b</p></main>")) == "a b"
    assert text(page("<div id=comments><article>c</article></div><div role='navigation'>n</div><p>body</p>")) == "body"
    assert text(page("<article>short</article><article>the longer one</article>")) == "the longer one"
    assert text("<article><p>open<div>never closed") == "open never closed"
    assert text("<ARTICLE><P title='a>b'>Case</P><!-- gone --><SCRIPT>x</SCRIPT ></ARTICLE>") == "Case"
    assert text("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article>") == "a b c d"
    assert html_tree.parse("<" * 2000 + "<a '" * 500)


def test_parts_of_the_main_text_stay_together():
    text = lambda html: html_main_text.main_text(page(html), set())
    assert text("<main><article>first</article><aside>x</aside><section><article>and second</article></section></main><article>else</article>") == "first and second"
    assert text("<div><article>first</article><article>and second</article><article class=comment>x</article></div>") == "first and second"
    assert text("<main><p>first</p></main><p>between</p><div role=main><main>and second</main></div>") == "first and second"


def test_templates_are_counted_per_host_and_deleted(spark, tmp_path):
    banner = "<div><p>Read all about our offers today</p></div>"
    rows = [(i, f"http://a.example/{i}", page(f"{banner}<section><p>Story {i} of this page</p></section>")) for i in range(20)]
    rows += [(100 + i, f"http://B.example:80/{i}", page(f"{banner}<p>Other {i}</p>")) for i in range(3)]
    rows += [(200 + i, "http://c.example/", page("<div><p>One page many times</p></div>")) for i in range(30)]
    rows += [(300, None, None), (301, "not an address", ""), (302, None, page("<p>kept</p>")), (None, "x", "y"), (None, "x", "y")]
    got = defaultdict(list)
    folder = write(tmp_path, pages=spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(4))
    for r in registry.QUERIES["op4_main_text"](spark, folder).collect():
        got[r.page_id].append(r.text)
        assert r.n_chars == len(r.text)
    assert all(got[i] == [f"Story {i} of this page"] for i in range(20))
    assert all(got[100 + i] == [f"Read all about our offers today Other {i}"] for i in range(3))
    assert all(got[200 + i] == ["One page many times"] for i in range(30))
    assert got[300] == [""] and got[301] == [""] and got[302] == ["kept"] and got[None] == ["y", "y"]


def test_templates_in_many_variants_on_one_host(spark):
    rows = [(i, f"http://a.example/{i}", page(f"<div><p>Offer {i % 60} of today</p></div><section><p>Story {i} of this page</p></section>"))
            for i in range(60 * 9)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(4)
    assert {r.page_id: r.text for r in html_main_text.extract(df).collect()} == {i: f"Story {i} of this page" for i, *_ in rows}


def test_copies_in_differing_frames_are_no_template(spark):
    frame = lambda i, body: page(f"<nav>menu {i}</nav><div class=ad>buy {i}</div>{body}<script>f({i})</script><footer>foot {i}</footer>", f"t{i}")
    bodies = {"a": "<div><p>The copied story.</p><div>Its second part.</div></div>",
              "b": "<article><h1>Head</h1><section><p>The copied story.</p><ul><li>Its second part.</ul></section></article>",
              "c": "<p>The copied story.</p><table><tr><td>Its second part.</table>"}
    rows = [(f"{host}{i}", f"http://{host}.example/{i}", frame(i, body)) for host, body in bodies.items() for i in range(20)]
    want = {key: ("Head " if key[0] == "b" else "") + "The copied story. Its second part." for key, *_ in rows}
    # frames without telling names are templates from the host's other pages, and leave the copies alike
    for i in range(160):
        body = "<section><p>Copied story.</p></section>" if i < 20 else f"<section><p>Story {i}.</p></section>"
        rows.append((f"d{i}", f"http://d.example/{i}", page(f"<div>Offers of shop {i % 10}</div>{body}")))
        want[f"d{i}"] = "Copied story." if i < 20 else f"Story {i}."
    df = spark.createDataFrame(rows, "page_id string, url string, html string").repartition(4)
    assert {r.page_id: r.text for r in html_main_text.extract(df).collect()} == want


def test_main_text_of_the_small_pages(spark, small):
    for r in registry.QUERIES["op4_main_text"](spark, SMALL_SF).collect():
        html = small.execute("SELECT html FROM pages WHERE page_id = ?", [r.page_id]).fetchone()[0]
        inner = re.search(r"<article>(.*)</article>", html, re.S)[1]
        plain = re.sub(r"<[^>]*>", "", re.sub(r"</?(?:p|h1|br)\b[^>]*>", " ", inner))
        assert r.text == " ".join(__import__("html").unescape(plain).split())


# -- 5


def test_ids_and_text_equal_the_library(small):
    coder = bpe.PairIndexBPE(bpe.vocabulary_path(bpe.DEFAULT_VOCABULARY), remembered=500)
    rng = random.Random(4)
    pick = [lambda: rng.randrange(32, 127), lambda: rng.randrange(0, 0x180), lambda: rng.randrange(0x2010, 0x2050), lambda: rng.randrange(0, 0xD7FF)]
    texts = [t or "" for _, t in odd_rows()] + ["aaaa aaaaaaa", "hahahaha", "ΣΑΣ ẞ İ", "'S 'T", "x" * 5000]
    texts += ["".join(chr(rng.choice(pick)()) for _ in range(rng.randrange(40))) for _ in range(1500)]
    texts += [t for t, in small.execute("SELECT text FROM documents LIMIT 60").fetchall()]
    for first in range(0, len(texts), 400):
        part = texts[first:first + 400]
        ids, sizes = coder.encode(part)
        ends = np.cumsum(sizes)
        for text, end, size in zip(part, ends, sizes, strict=True):
            want = coder.library.encode(text, add_special_tokens=False).ids
            assert ids[end - size:end].tolist() == want
            assert coder.decode(ids[end - size:end]) == coder.library.decode(want, skip_special_tokens=False)


def test_round_trip_query(spark, odd, tmp_path):
    library = bpe.coder().library
    want = Counter()
    for i, t in odd_rows():
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want[i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(text.encode()).hexdigest()] += 1
    assert Counter(map(tuple, registry.QUERIES["op5_bpe_round_trip"](spark, write(tmp_path, documents=odd)).collect())) == want
    decoded = bpe.decode_documents(bpe.encode_documents(odd)).collect()
    assert Counter(hashlib.sha256(r.text.encode()).hexdigest() for r in decoded) == Counter(k[3] for k in want.elements())


# -- 6


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[k:k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


def plain_groups(rows, percent=85):
    """Component of every row, all pairs compared; rows of one id are one node."""
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    sets = [(i, shingle_set(t)) for i, t in rows if i is not None]
    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return [(i, len(shingle_set(t)), find(i) if i is not None else None) for i, t in rows]


def test_near_duplicates_equal_all_pairs(spark):
    rng = random.Random(5)
    rows, base = [], [[f"v{rng.randrange(400)}" for _ in range(60)] for _ in range(6)]
    for i in range(260):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            words[rng.randrange(60)] = f"n{rng.randrange(9999)}"
        rows.append((i * 3 % 1000, " ".join(words[:rng.choice([60, 60, 58, 4])]).swapcase() if i % 2 else " ".join(words)))
    rows += [r for r in odd_rows() if r[0] is not None]
    rows = list({i: (i, t) for i, t in rows if i != 11}.values())
    member = near_dedup.near_duplicates(documents(spark, rows)).drop("print")
    assert Counter(map(tuple, member.collect())) == Counter(plain_groups(rows))
    assert len({c for *_, c in plain_groups(rows)}) < len(rows) - 100


def test_large_families_are_compared_in_blocks(spark, monkeypatch):
    rng = random.Random(6)
    base = [f"v{k}" for k in range(80)]
    rows = []
    for i in range(120):
        words = list(base)
        for _ in range(rng.randrange(4)):
            words[rng.randrange(80)] = f"n{rng.randrange(999)}"
        rows.append((i, " ".join(words)))
    df = documents(spark, rows)
    whole = near_dedup.set_rows(df)
    classes = whole.groupBy("h1", "h2", "n").agg(__import__("pyspark.sql.functions", fromlist=["x"]).min("id").alias("id"),
                                                 __import__("pyspark.sql.functions", fromlist=["x"]).min_by("bands", "id").alias("bands"))
    links = near_dedup.confirmed_links(df, near_dedup.families(classes, block_sets=16))
    roots = {r.node: r.root for r in connected_components(links).collect()}
    want = {i: c for i, _, c in plain_groups(rows)}
    same = whole.join(classes.select("h1", "h2", "n", "id").withColumnRenamed("id", "rep"), ["h1", "h2", "n"])
    assert {r.id: roots.get(r.rep, r.rep) for r in same.collect()} == want


def test_ids_without_text_nulls_and_several_texts(spark):
    long = " ".join(f"w{i}" for i in range(40))
    rows = [(5, long), (None, long), (None, "alone alone alone"), (2, "p q r s t u v"), (5, "p q r s t u v"), (9, None), (8, ""), (8, "")]
    got = Counter(map(tuple, near_dedup.near_duplicates(documents(spark, rows)).drop("print").collect()))
    assert got == Counter([(5, 36, 2), (None, 36, 2), (None, 1, None), (2, 3, 2), (5, 3, 2), (9, 0, 9), (8, 0, 8), (8, 0, 8)])
    df = documents(spark, rows)
    kept = near_dedup.without_near_duplicates(df)
    assert kept.columns == df.columns and Counter(r.doc_id for r in kept.collect()) == Counter([None, 2, 9, 8, 8])


def test_circulant_signatures_estimate_similarity():
    rng = np.random.default_rng(7)
    pool = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    a, b = np.unique(pool[:2000]), np.unique(pool[500:2500])
    sig = shingles.circulant_signatures([a, b], 512)
    assert (sig[0] == sig[1]).mean() == pytest.approx(1500 / 2500, abs=0.08)
    assert shingles.shared(a, b) == len(np.intersect1d(a, b))
    keys = shingles.band_keys(sig, 4)
    assert keys.shape == (2, 128) and len(np.unique(keys[0])) == 128


def test_components_of_random_graphs(spark):
    rng = random.Random(8)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)] + [(7, 7)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            parent[max(find(a), find(b))] = min(find(a), find(b))
    assert got == {x: find(x) for x in list(parent)}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# -- 7


def test_toxic_texts_are_found_and_weights_are_few(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    rows, labels = [], []
    for i in range(900):
        words, bad = [word() for _ in range(rng.randrange(10, 60))], i % 8 == 0
        if bad:
            words[rng.randrange(len(words))] = rng.choice(["zzz", "yyy", "xxx"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    docs = documents(spark, [*rows, (5000, None), (5001, "")])
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"), "toxic")
    assert len(model.places) < 3000
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    held = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([(got[i] >= 0.3) == (i % 8 == 0) for i in held]) > 0.97
    assert got[5000] == got[5001] < 0.3
    clean = toxicity.without_toxic(docs, model)
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == {i for i, s in got.items() if s < 0.3}


def test_no_labels_no_toxicity(spark, odd):
    model = toxicity.fit(odd, spark.createDataFrame([(2, None)], "doc_id bigint, toxic int"), "toxic")
    assert {r.score for r in toxicity.score(odd, model).collect()} == {0.0}


# -- 8


def test_base_counts_equal_plain_ones(spark):
    from pyspark.sql import functions as F
    rng = random.Random(10)
    rows = [(i, " ".join(rng.choice("abc") for _ in range(rng.randrange(40)))) for i in range(60)]
    rows += [(100 + i, "\n".join(rng.choice(["a b", " a b", "", " ", "c#|"]) for _ in range(rng.randrange(9)))) for i in range(40)]
    rows += [(200 + k, t) for k, (_, t) in enumerate(odd_rows())]
    got = {r.id: r for r in quality_rules.measures(documents(spark, rows).withColumnRenamed("doc_id", "i"), F.col("lang"), "i").collect()}
    for i, t in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        windows = Counter(tuple(words[k:k + 5]) for k in range(len(words) - 4))
        inside = {k + j for k in range(len(words) - 4) if windows[tuple(words[k:k + 5])] > 1 for j in range(5)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(inside)), t[:60]


def test_binomial_tail_is_exact(spark):
    from fractions import Fraction

    from pyspark.sql import functions as F
    cases = [(0, 1), (0, 300), (3, 300), (5, 500), (40, 4000), (13, 2700)]
    df = spark.createDataFrame(cases, "k bigint, n bigint").select("k", "n", quality_rules.log_binomial_tail(F.col("k"), F.col("n"), 0.01).alias("p"))
    for r in df.collect():
        p = Fraction(0.01)
        want = sum(math.comb(r.n, i) * p ** i * (1 - p) ** (r.n - i) for i in range(r.k + 1))
        assert r.p == pytest.approx(math.log(want), rel=1e-9, abs=1e-9)


def test_thresholds_keep_their_promise(spark):
    """On good rows of known distribution no stratum loses more than its share, and a small stratum gets no rule."""
    from pyspark.sql import functions as F
    rng = random.Random(11)
    rows = [("big", 100, rng.randrange(0, 3) if rng.random() < 0.001 else 0) for _ in range(6000)] + [("small", 100, 0)] * 200
    rows += [("even", 100, rng.randrange(0, 120)) for _ in range(4000)]
    good = spark.createDataFrame(rows, "stratum string, n_words bigint, n_symbols bigint").withColumns(
        {c: F.lit(0).cast("bigint") for c in ("word_chars", "n_lines", "n_dup_lines", "n_capitals", "n_marks", "n_repeat_words")})
    got = {r.stratum: r for r in quality_rules.thresholds(good).collect()}
    assert "small" not in got
    assert got["big"].symbols_per_word == 0.02 and got["even"].symbols_per_word is None
    assert got["even"].marks_per_word == 0.02


# -- 9


def check_layout(rows, capacity=4096):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by)


def test_packing_query(spark, odd, tmp_path):
    library = bpe.coder().library
    rows = registry.QUERIES["op9_packing"](spark, write(tmp_path, documents=odd)).collect()
    want = Counter()
    for i, t in odd_rows():
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), 4096):
            part = ids[k:k + 4096]
            want[i, k // 4096, k, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    assert check_layout(rows) <= math.ceil(sum(k[3] * c for k, c in want.items()) / 4096) + 1


def test_small_tables_pack_tightly(spark):
    rows = registry.QUERIES["op9_packing"](spark, SMALL_SF).collect()
    assert check_layout(rows) <= math.ceil(sum(r.length for r in rows) / 4096) + 1


def test_reduction_keeps_the_optimum():
    def optimum(items, capacity):
        items, best = sorted(items, reverse=True), [len(items)]

        def go(k, bins):
            if len(bins) >= best[0]:
                return
            if k == len(items):
                best[0] = len(bins)
                return
            for b in {x: j for j, x in enumerate(bins) if x >= items[k]}.values():
                bins[b] -= items[k]
                go(k + 1, bins)
                bins[b] += items[k]
            go(k + 1, [*bins, capacity - items[k]])

        go(0, [])
        return best[0]

    rng = random.Random(12)
    for _ in range(400):
        capacity = rng.choice([10, 20, 37, 100])
        items = Counter(rng.randrange(1, capacity + 1) for _ in range(rng.randrange(1, 10)))
        slots, sequences, fixed = packing.plan_slots(dict(items), capacity)
        taken, fill = Counter(), Counter()
        for length, first_rank, copies, many, first, offset in slots.tolist():
            assert first_rank == taken[length] or any(s[0] == length for s in slots.tolist())
            taken[length] += copies * many
            for k in range(many):
                fill[first + k] += copies * length
        assert taken == items and len(fill) == sequences and max(fill.values()) <= capacity
        rest = items - Counter({n: sum(s[2] * s[3] for s in slots.tolist() if s[0] == n and s[4] < fixed) for n in items})
        assert fixed + optimum(list(rest.elements()), capacity) == optimum(list(items.elements()), capacity)
    assert packing.plan_slots({})[1] == 0 and packing.plan_slots({1: 10_000})[1] == 3


# -- 10


def plain_line_dedup(rows):
    key = lambda line: line.strip("\x20\x09\x0a\x0b\x0c\x0d").translate(LOWER)
    lines = [(i, (t or "").split("\n"), t or "") for i, t in rows]
    holders = defaultdict(set)
    for i, own, t in lines:
        for line in own:
            if len(key(line)) >= 20:
                holders[key(line)].add((i, t))
    low = lambda i: -1 if i is None else i
    gone = {k: max(low(i) for i, _ in ids) for k, ids in holders.items() if len(ids) >= 3}
    for i, own, _ in lines:
        kept = [x for x in own if key(x) not in gone or gone[key(x)] == low(i)]
        yield i, len(own), len(own) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()


@pytest.mark.parametrize("salts", [line_dedup.SALTS, 1])
def test_line_dedup_equals_plain(spark, tmp_path, monkeypatch, salts):
    monkeypatch.setattr(line_dedup, "SALTS", salts)
    rng = random.Random(13)
    pool = [f"{'Line' if k % 2 else 'line'} number {k} of the common pool É" for k in range(12)] + ["short", "", "  ", "x" * 19, "y" * 20]
    rows = [(i, "\n".join(rng.choice(pool).upper() if rng.random() < 0.2 else " " * rng.randrange(3) + rng.choice(pool)
                          for _ in range(rng.choice([0, 1, 3, 8, 200])))) for i in range(40)] + odd_rows()
    out = registry.QUERIES["op10_line_dedup"](spark, write(tmp_path, documents=documents(spark, rows))).collect()
    assert Counter(map(tuple, out)) == Counter(plain_line_dedup(rows))


def test_bitmaps_and_rewritten_rows(spark):
    common = "a line that stands in every document"
    rows = [(i, f"{common}\nown line of document {i}\n{common}") for i in range(4)] + [(9, "nothing"), (10, None)]
    df = documents(spark, rows).withColumnsRenamed({"lang": "dropped", "source": "row"})
    marks = {r.id: [tuple(d) for d in r.dropped] for r in line_dedup.keep_bitmaps(df).collect()}
    assert marks == {i: [(0, 0b101)] for i in range(3)}
    out = line_dedup.deduplicated(df)
    assert out.columns == df.columns
    got = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    assert got[0] == ("own line of document 0", 22) and got[3][0].count(common) == 2 and got[10] == (None, None) and got[9] == ("nothing", 7)
