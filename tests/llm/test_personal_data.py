"""Personal data: base spans against the contract's patterns, added spans, odd rows, time on hostile texts."""

import hashlib
import random
import re
import time

import pyarrow.parquet as pq
import pytest

from conftest import SMALL_SF
from vitrina.llm import personal_data

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    """The base spans by the contract's patterns."""
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    luhn = lambda d: sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(d[::-1])) % 10 == 0
    return ([("email", *m.span()) for m in EMAIL.finditer(text)]
            + [("ip", *m.span()) for m in IP.finditer(text) if all(len(x.lstrip("0")) < 4 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split("."))]
            + [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))]
            + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15])


@pytest.mark.parametrize("alphabet", ["a@.-+1", "0123456789 -", "0123456789.+() -", "12.", "aé@.b+9", "ab@. ", "4111 -", "01259.x"])
def test_base_spans_of_random_texts(alphabet):
    draw = random.Random(alphabet)
    for _ in range(4000):
        text = "".join(draw.choice(alphabet) for _ in range(draw.randint(0, 40)))
        assert [s for s in personal_data.spans_of(text) if s[0] in personal_data.BASE_KINDS] == plain(text), text


def texts_of(text):
    return [(kind, text[a:b]) for kind, a, b in personal_data.spans_of(text) if kind not in personal_data.BASE_KINDS]


@pytest.mark.parametrize("text, found", [
    ("see https://user:pw@host.example.org:80/x?y=1).", [("address", "https://user:pw@host.example.org:80/x?y=1")]),
    ("HTTP://Example.ORG, then", [("address", "HTTP://Example.ORG")]),
    ("xhttp://example.org http://nodots ftp:// foo://a.b http://a.b:99999999", []),
    ("IBAN: DE89 3704 0044 0532 0130 00 and more", [("account", "DE89 3704 0044 0532 0130 00")]),
    ("iban DE88 3704 0044 0532 0130 00", []),
    ("SSN 078-05-1120, ssn: 000-12-3456, Social Security number 219 09 9999", [("account", "078-05-1120"), ("account", "219 09 9999")]),
    ("routing 021000021; routing 021000022", [("account", "021000021")]),
    ("Account no. 12345678, acct 12, accounting 1234567, my account: none", [("account", "12345678")]),
    ("passport X1234567. passports 1234567", [("account", "X1234567")]),
    ("the account of 1789 and the year 2024", []),
])
def test_added_spans(text, found):
    assert texts_of(text) == found


def test_masked_rows_keep_their_columns(spark):
    rows = [(1, "mail a.b@c.de now", "x"), (2, None, "y"), (None, "", None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, spans string")
    assert sorted(map(tuple, personal_data.masked(df).collect()), key=str) == sorted(
        [(1, "mail [email] now", "x"), (2, None, "y"), (None, "", None)], key=str)
    assert personal_data._masked("http://1.2.3.4/ and 1.2.3.4") == "[address] and [ip]"


def expected(text):
    every = personal_data.spans_of(text or "")
    base = plain(text or "")
    join = lambda spans: ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
    count = lambda kind: sum(s[0] == kind for s in base)
    return (*map(count, ("email", "ip", "card", "phone")), hashlib.sha256(join(base).encode()).hexdigest(), join(every))


COLUMNS = ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")


def test_query_equals_the_patterns_on_all_documents(spark):
    docs = pq.read_table(f"{SMALL_SF}/documents.parquet")
    want = {d: expected(t) for d, t in zip(docs["doc_id"].to_pylist(), docs["text"].to_pylist(), strict=True)}
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in personal_data.op11_personal_data(spark, SMALL_SF).collect()}
    assert got == want
    assert all(sum(w[k] for w in want.values()) for k in range(4))  # each kind occurs


def test_odd_rows(spark, tmp_path):
    long = "word " * 200_000 + "z@y.xx" + " 4111-1111-1111-1111" * 3
    rows = [(1, None), (2, ""), (3, " \n"), (None, "é@é.é a@b.c"), (None, None), (4, "🙂 a@b.cc"), (4, "🙂 a@b.cc"), (5, long), (6, "9" * 5000 + ".1.1.1")]
    spark.createDataFrame([(d, t, "s", 1) for d, t in rows], "doc_id bigint, text string, spans string, n_email int").write.parquet(f"{tmp_path}/documents.parquet")
    got = [(r["doc_id"], *(r[c] for c in COLUMNS)) for r in personal_data.op11_personal_data(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted([(d, *expected(t)) for d, t in rows], key=str)


@pytest.mark.parametrize("piece", ["@", "a", "1.", "+1", "1 ", "a@", "a@b.c", "://", "http://", "account ", "+1 (", "9", "a@b."])
def test_time_in_proportion_to_the_text(piece):
    text = piece * (400_000 // len(piece))
    start = time.process_time()
    personal_data.spans_of(text + "@")
    assert time.process_time() - start < 8
