import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from labelscope.llm import pii
from labelscope.llm.queries import QUERIES

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind, text):
    digits = [int(c) for c in text if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        total = sum(d if k % 2 == 0 else (2 * d if d < 5 else 2 * d - 9) for k, d in enumerate(reversed(digits)))
        return 12 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    found = [(m.start(), k, f"{kind}:{m.start()}:{m.end()}") for k, (kind, p) in enumerate(PATTERNS.items())
             for m in re.finditer(p, text) if holds(kind, m[0])]
    return ",".join(x for _, _, x in sorted(found))


ANCHORS = pii.automaton()


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet="ab.@-+ ()0123459é😀%_:/=", max_size=60))
def test_base_spans_against_regex(text):
    assert pii.joined([s for s in pii.spans_of(text, ANCHORS) if s[1] < 4]) == brute(text)


def test_whole_operator(frame):
    card = "4111 1111 1111 1111"
    texts = [
        None, "", "é mail a.b+c@x-y.co.uk, 1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.255 " + card + " +1 (487) 555-7209",
        "a@b@c.de a@b a@b..c @x.y", "+1 (487) 555-7209+49 30 1234567", "x" * 50000 + " " + card + " " + "7" * 5000,
        'token = "2abc3ff2ca8fb1e4c565a0eb63815530a948bdde" Password: hunter2 PASSWORD=0123456789abcdefX',
        "IBAN: DE89 3704 0044 0532 0130 00 and iban GB82WEST12345698765432 but IBAN DE00 3704 0044 0532 0130 00",
        "ftp://user:pass@host.org/x https://host.org/a@b.org", "4111-1111-1111-1112 411111111111 1111",
    ]
    rows = [(k, t, 0, "") for k, t in enumerate(texts)] + [(2, texts[2], 0, ""), (None, texts[3], 0, "")]
    found = pii.find(frame(rows, "doc_id long, text string, spans int, n_ip string")).collect()
    assert len(found) == len(rows)
    for r in found:
        text = texts[r.doc_id if r.doc_id is not None else 3] or ""
        base = brute(text)
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [base.count(k + ":") for k in PATTERNS]
        assert [x for x in r.spans.split(",") if x.split(":")[0] in PATTERNS] == [x for x in base.split(",") if x]
    by = {r.doc_id: r for r in found}
    assert by[6].n_secret == 3 and by[7].n_iban == 2 and by[8].n_login == 1
    assert pii.find(frame([], "doc_id long, text string")).collect() == []


def found(text, kind):
    return [text[s:e] for s, k, e in pii.spans_of(text, ANCHORS) if pii.KINDS[k] == kind]


def test_accounts_without_a_cue_and_several_of_them():
    german, british = "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"
    assert found(f"IBANs: {german}, {british}", "iban") == [german, british]
    assert found(f"pay to {british} AND OTHERS or {german}.", "iban") == [british, german]
    assert found(f"the number {'word ' * 30}{german}", "iban") == [german]
    for text in (f"X{british}", f"{british}7", "DE88 3704 0044 0532 0130 00", "AB12", "A", "12", "ZZ99 " * 9):
        assert found(text, "iban") == []


def test_short_passwords():
    assert found("password=hunter2 Passwd: 'p@ss!word' PASSWORD = x1y2z3", "secret") == ["hunter2", "p@ss!word", "x1y2z3"]
    for text in ("password: required", "the password is hunter2", "password=ab1", "password reset link", "token=short1"):
        assert found(text, "secret") == []


def test_registered_query_against_regex(spark):
    folder = "/root/testdata/sf0.001"
    texts = {x.doc_id: x.text or "" for x in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op2_pii"](spark, folder).collect()
    assert len(rows) == len(texts) and sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in rows) > 10
    for r in rows:
        assert r.base_sha256 == hashlib.sha256(brute(texts[r.doc_id]).encode()).hexdigest()
