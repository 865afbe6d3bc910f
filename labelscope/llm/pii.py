"""Personal data: anchor expansion.

An Aho-Corasick automaton finds anchors in the whole text: at-signs, plus signs, digits,
``://`` and cue words of accounts and secrets. At each anchor a local parser expands to the
left and right and validates what it found. The base kinds give, per kind, the leftmost
non-overlapping matches of their patterns; a match that fails its check is dropped without a
second try. The method adds ``secret`` (cue, ``=`` or ``:``, a value of 16 or more letters, digits and ``+/_.-``; after a password
cue any value of 6 or more signs without blanks or quotes that is not letters alone), ``iban`` (two capitals, two
check digits, 11 to 30 more characters, mod-97 check; as many as a text holds, with or without a cue) and ``login`` (user data
inside a url's authority); base spans stay as they are.

Positions are code points, end exclusive. A null or empty text has no spans. Repeated rows and
null ids come back as they are. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from labelscope.llm import tokens

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret", "iban", "login")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DIGITS = frozenset("0123456789")
ALNUM = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
ADDRESS = re.compile(r"([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
VALUE = re.compile(r"""[\x20\t]{0,4}[=:][\x20\t]{0,4}["']?([A-Za-z0-9+/_.-]{16,})""")
PASSWORD = re.compile(r"""[\x20\t]{0,4}[=:][\x20\t]{0,4}["']?([^\s"'<>]{6,})""")
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}")
AUTHORITY = re.compile(r"([^\s/?#@:\"'<>]+:[^\s/?#@\"'<>]+)@")
CUES = ("token", "secret", "api_key", "apikey", "access_key", "private_key")
PASSWORD_CUES = ("password", "passwd", "passphrase")
CAPITALS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for digit in DIGITS:
        found.add_word(digit, ("digit", 1))
    for sign, kind in (("@", "at"), ("+", "plus"), ("://", "scheme")):
        found.add_word(sign, (kind, len(sign)))
    for kind, cues in (("cue", CUES), ("password", PASSWORD_CUES)):
        for cue in cues:
            for form in {cue, cue.upper(), cue.capitalize()}:
                found.add_word(form, (kind, len(form)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    doubled = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + doubled) % 10 == 0


def iban_holds(code: str) -> bool:
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def address_holds(parts: tuple[str, ...]) -> bool:
    return all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in parts)


def spans_of(text: str, anchors: ahocorasick.Automaton) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all spans, in order of start, then kind."""
    spans, free = [], dict.fromkeys(KINDS, 0)

    def digit(at: int) -> None:
        if at >= 2 and text[at - 1] in CAPITALS:
            iban(at - 2)
        if at >= free["ip"] and (at == free["ip"] or text[at - 1] not in DIGITS) and (m := ADDRESS.match(text, at)):
            free["ip"] = m.end()
            if address_holds(m.groups()):
                spans.append((at, 1, m.end()))
        if at >= free["card"] and (m := CARD.match(text, at)):
            free["card"] = m.end()
            number = re.sub("[^0-9]", "", m[0]) if m.end() - at < 64 else ""
            if 12 <= len(number) <= 19 and luhn(number):
                spans.append((at, 2, m.end()))

    def at_sign(at: int) -> None:
        start = at
        while start > free["email"] and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            free["email"] = m.end()
            spans.append((start, 0, m.end()))

    def plus(at: int) -> None:
        if at >= free["phone"] and (m := PHONE.match(text, at)):
            free["phone"] = m.end()
            if 9 <= sum(c in DIGITS for c in m[0]) <= 15:
                spans.append((at, 3, m.end()))

    def cue(end: int, value: re.Pattern) -> None:
        m = value.match(text, end)
        if m and m.start(1) >= free["secret"] and (value is VALUE or not m[1].isalpha()):
            free["secret"] = m.end(1)
            spans.append((m.start(1), 4, m.end(1)))

    def iban(at: int) -> None:
        if at < free["iban"] or not (text[at:at + 1] in CAPITALS and text[at + 1] in CAPITALS) or at and text[at - 1] in ALNUM:
            return
        if m := IBAN.match(text, at):
            for stop in (m.end(), *(k for k in range(m.end() - 1, at + 14, -1) if text[k] == " ")):
                code = text[at:stop].replace(" ", "")
                if 15 <= len(code) <= 34 and text[stop:stop + 1] not in ALNUM and iban_holds(code):
                    free["iban"] = stop
                    spans.append((at, 5, stop))
                    break

    def scheme(end: int) -> None:
        if (m := AUTHORITY.match(text, end)):
            spans.append((m.start(1), 6, m.end(1)))

    for last, (kind, size) in anchors.iter(text):
        if kind == "digit":
            digit(last)
        elif kind == "at":
            at_sign(last)
        elif kind == "plus":
            plus(last)
        elif kind == "cue":
            cue(last + 1, VALUE)
        elif kind == "password":
            cue(last + 1, PASSWORD)
        else:
            scheme(last + 1)
    return sorted(spans)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


SCHEMA = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, "
          "n_secret long, n_iban long, n_login long")


def find(docs: DataFrame) -> DataFrame:
    """One row per document with the counts of each kind, a digest of the base spans, and all spans."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = automaton()
        for batch in batches:
            for part in tokens.text_slices(batch):
                found = [spans_of(text.as_py(), anchors) for text in part.column("text")]
                count = lambda kind: pa.array([sum(s[1] == kind for s in spans) for spans in found], pa.int64())
                base = [joined([s for s in spans if s[1] < len(BASE_KINDS)]) for spans in found]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id"), **{f"n_{kind}": count(k) for k, kind in enumerate(BASE_KINDS)},
                    "base_sha256": pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base], pa.string()),
                    "spans": pa.array([joined(spans) for spans in found], pa.string()),
                    **{f"n_{kind}": count(k) for k, kind in enumerate(KINDS) if k >= len(BASE_KINDS)},
                })

    return docs.selectExpr("cast(doc_id as bigint) as doc_id", "text").mapInArrow(task, SCHEMA)
