"""Personal data by anchor expansion.

An Aho-Corasick automaton passes once over each whole text and reports anchors: at-signs, digits, plus signs before a digit,
``://`` and identifier cues (IBAN, SSN, account, routing, passport).  Only around anchors do local parsers look: they expand to the left and right to
the boundary of an e-mail address, an IP address, a card or phone number, a web address or an account number, and validate what they find.
Every character is expanded over a bounded number of times, so a text takes time in proportion to its length.

Base kinds equal the leftmost matches, without overlap, of

* email ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``
* ip ``[0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+)`` with parts of 255 at most
* card ``[0-9]([\\x20-]?[0-9])+`` of 13 to 19 digits with a Luhn checksum
* phone ``\\+[0-9][\\x20().0-9-]+[0-9]`` of 9 to 15 digits

where a match that fails its check is dropped and its characters are used up.  The method adds two kinds: ``address`` (scheme://host with what follows)
and ``account`` (a valid IBAN, SSN, routing, account or passport number after its cue).  Spans of one kind never overlap; those of different kinds may.

Null text counts as empty and has no spans.  Every row is answered, repeated rows and null ids included; columns other than the id and
the text are not read.  Offsets are code points, the end exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrina.llm.common import map_arrow, table, text_blocks

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "address", "account")

Span = tuple[int, int]

_AT, _DIGIT, _PLUS, _SCHEME, _CUE = range(5)
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
SCHEMES = frozenset("http https ftp ftps sftp ssh ws wss ldap ldaps smb rtsp".split())
_SCHEME_CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-"
_ADDRESS = re.compile(r"[^\s<>\"'`{}|\\^]++")
_HOST = re.compile(r"(?:[^@/?#]*@)?(?:[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++|localhost|\[[0-9A-Fa-f:.]+\])(?::[0-9]{1,5})?(?=[/?#]|$)")

#: What may stand between a cue and its number.
_LINK = re.compile(r"(?i)(?:[ \t]?(?:number|num|no\.?|nr\.?|id|code|#))?[ \t]{0,2}(?:(?:[:=#]|is\b)[ \t]{0,2})?")
_IBAN = re.compile(r"[A-Za-z]{2}[0-9]{2}(?: ?[A-Za-z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"([0-9]{3})([ -]?)([0-9]{2})\2([0-9]{4})(?![0-9])")
_ROUTING = re.compile(r"[0-9]{9}(?![0-9])")
_ACCOUNT = re.compile(r"[0-9](?:[ -]?[0-9]){5,16}(?![0-9])")
_PASSPORT = re.compile(r"[A-Za-z]{0,2}[0-9]{6,9}(?![A-Za-z0-9])")


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _valid_iban(text: str) -> bool:
    bare = text.replace(" ", "").upper()
    return int("".join(str(int(c, 36)) for c in bare[4:] + bare[:4])) % 97 == 1


def _iban(text: str, at: int) -> int:
    """The end of the longest valid IBAN at ``at``, 0 if there is none: words may follow it after a blank."""
    found = _IBAN.match(text, at)
    end = found.end() if found else 0
    while end - at >= 15:
        if _valid_iban(text[at:end]):
            return end
        end = text.rfind(" ", at, end)
    return 0


def _ssn(text: str, at: int) -> int:
    found = _SSN.match(text, at)
    good = found and found[1] not in ("000", "666") and found[1] < "900" and found[3] != "00" and found[4] != "0000"
    return found.end() if good else 0


def _routing(text: str, at: int) -> int:
    found = _ROUTING.match(text, at)
    good = found and sum(int(c) * w for c, w in zip(found[0], (3, 7, 1) * 3, strict=True)) % 10 == 0 and int(found[0])
    return found.end() if good else 0


def _plain(pattern: re.Pattern[str]):
    def parse(text: str, at: int) -> int:
        found = pattern.match(text, at)
        return found.end() if found else 0
    return parse


CUES = {"iban": _iban, "ssn": _ssn, "social security": _ssn, "routing": _routing, "account": _plain(_ACCOUNT), "acct": _plain(_ACCOUNT),
        "a/c": _plain(_ACCOUNT), "passport": _plain(_PASSPORT)}


@lru_cache(1)
def _anchors():
    import ahocorasick

    automaton = ahocorasick.Automaton()
    automaton.add_word("@", (_AT, 1))
    automaton.add_word("://", (_SCHEME, 3))
    for digit in "0123456789":
        automaton.add_word(digit, (_DIGIT, 1))
        automaton.add_word("+" + digit, (_PLUS, 2))
    for cue, parser in CUES.items():
        for form in {cue, cue.upper(), cue.capitalize(), cue.title()}:
            automaton.add_word(form, (_CUE, (len(form), parser)))
    automaton.make_automaton()
    return automaton


def _emails(text: str, ats: list[int]) -> Iterator[Span]:
    free = 0  # where the next match may begin: after the last match, and after the last at-sign, which no local part holds
    for at in ats:
        head = text[free:at] if free <= at else ""
        local = len(head) - len(head.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if local else None
        if domain:
            yield at - local, domain.end()
        free = max(free, domain.end() if domain else at + 1)


def _digit_runs(digits: list[int]) -> list[Span]:
    runs: list[Span] = []
    start = last = -2
    for at in digits:
        if at != last + 1:
            if last >= 0:
                runs.append((start, last + 1))
            start = at
        last = at
    if last >= 0:
        runs.append((start, last + 1))
    return runs


def _chains(text: str, runs: list[Span], links: str) -> Iterator[list[Span]]:
    """The runs in groups that hang together by one character of ``links``."""
    chain: list[Span] = []
    for run in runs:
        if chain and not (run[0] == chain[-1][1] + 1 and text[chain[-1][1]] in links):
            yield chain
            chain = []
        chain.append(run)
    if chain:
        yield chain


def _byte(digits: str) -> bool:
    bare = digits.lstrip("0")
    return len(bare) <= 3 and int(bare or "0") <= 255


def _ips(text: str, runs: list[Span]) -> Iterator[Span]:
    for chain in _chains(text, runs, "."):
        for k in range(0, len(chain) - 3, 4):
            if all(_byte(text[a:b]) for a, b in chain[k:k + 4]):
                yield chain[k][0], chain[k + 3][1]


def _cards(text: str, runs: list[Span]) -> Iterator[Span]:
    for chain in _chains(text, runs, " -"):
        if 13 <= sum(b - a for a, b in chain) <= 19 and _luhn("".join(text[a:b] for a, b in chain)):
            yield chain[0][0], chain[-1][1]


def _phones(text: str, pluses: list[int], runs: list[Span]) -> Iterator[Span]:
    k = 0
    for plus in pluses:
        while runs[k][0] <= plus:
            k += 1
        digits, end = 0, plus + 1  # the run at k begins right after the plus sign
        while k < len(runs) and not text[end:runs[k][0]].strip(" ().-"):
            digits, end = digits + runs[k][1] - runs[k][0], runs[k][1]
            k += 1
        k -= 1
        if end - 1 >= plus + 3 and 9 <= digits <= 15:
            yield plus, end


def _addresses(text: str, colons: list[int]) -> Iterator[Span]:
    free = 0
    for colon in colons:
        head = text[max(free, colon - 8):colon]
        scheme = head[len(head.rstrip(_SCHEME_CHARS)):]
        start = colon - len(scheme)
        rest = _ADDRESS.match(text, colon + 3) if scheme.lower() in SCHEMES and colon >= free else None
        if not rest:
            continue
        end = colon + 3 + len(rest[0].rstrip(".,;:!?)]*"))
        if _HOST.match(text[colon + 3:end]):
            yield start, end
        free = rest.end()


def _accounts(text: str, cues: list[tuple[int, int, object]]) -> Iterator[Span]:
    free = 0
    for start, end, parser in cues:
        if start and text[start - 1].isalnum() or text[end:end + 1].isalnum():
            continue  # within a word
        at = _LINK.match(text, end).end()
        stop = parser(text, at) if at > end else 0
        if stop and at >= free:
            yield at, stop
            free = stop


def spans_of(text: str) -> list[tuple[str, int, int]]:
    """All (kind, start, end), by kind as listed in ``KINDS``, then start."""
    ats, digits, pluses, colons, cues = [], [], [], [], []
    for last, (what, more) in _anchors().iter(text):
        if what == _DIGIT:
            digits.append(last)
        elif what == _AT:
            ats.append(last)
        elif what == _PLUS:
            pluses.append(last - 1)
        elif what == _SCHEME:
            colons.append(last - 2)
        else:
            cues.append((last + 1 - more[0], last + 1, more[1]))
    runs = _digit_runs(digits)
    found = (_emails(text, ats), _ips(text, runs), _cards(text, runs), _phones(text, pluses, runs), _addresses(text, colons),
             _accounts(text, sorted(cues, key=lambda c: c[:2])))
    return [(kind, a, b) for kind, spans in zip(KINDS, found, strict=True) for a, b in spans]


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans array<struct<kind, start, end>>) of every row."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_blocks(batches, "text"):
            found = [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in spans_of(text)] for text in texts]
            yield pa.record_batch([rows.column("id"), pa.array(found, _SPANS)], names=["id", "spans"])

    kind = source.schema["id"].dataType.simpleString()
    return map_arrow(source, run, f"id {kind}, spans array<struct<kind:string,start:bigint,end:bigint>>").withColumnRenamed("id", id_col)


def masked(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span of its texts replaced by its kind in brackets; of overlapping spans the longest, then the first, counts."""
    source = docs.withColumn(text_col, F.col(text_col).cast("string"))
    at = source.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_blocks(batches, text_col):
            known = rows.column(at).is_valid().to_pylist()
            out = [_masked(text) if there else None for text, there in zip(texts, known, strict=True)]
            yield rows.set_column(at, text_col, pa.array(out, pa.string()))

    return map_arrow(source, run, source.schema)


def _masked(text: str) -> str:
    taken: list[tuple[int, int, str]] = []
    end = 0
    for start, _, stop, kind in sorted((a, a - b, b, kind) for kind, a, b in spans_of(text)):
        if start >= end:
            taken.append((start, stop, kind))
        elif stop - start > taken[-1][1] - taken[-1][0]:
            taken[-1] = (taken[-1][0], stop, kind)
        else:
            taken[-1] = (taken[-1][0], max(taken[-1][1], stop), taken[-1][2])
        end = taken[-1][1]
    parts, done = [], 0
    for start, stop, kind in taken:
        parts += [text[done:start], f"[{kind}]"]
        done = stop
    return "".join([*parts, text[done:]])


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents"))
    of = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    counts = [F.size(of(kind)).cast("bigint").alias(f"n_{kind}") for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(_joined(of(*BASE_KINDS)), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))
