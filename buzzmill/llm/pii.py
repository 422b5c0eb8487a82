"""Personal data by anchor expansion.

One Aho-Corasick automaton finds anchors in a text: at-signs, digits around a dot or in a row, a plus before a digit,
schemes, and cue words of identifiers. At each anchor a deterministic local parser expands to both sides and validates
the boundary, so nothing is searched where there is no anchor.
"""

from __future__ import annotations

import hashlib
import re
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "account", "secret")
# Cues of identifiers.
ACCOUNT_CUES = ("account", "acct", "iban", "konto", "kontonummer", "compte", "cuenta", "passport", "ssn")
SECRET_CUES = ("token", "secret", "password", "passwd", "pwd", "api_key", "apikey", "access_key")
SCHEMES = ("http://", "https://", "ftp://", "sftp://", "ssh://")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DIGITS = frozenset("0123456789")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
FOUR = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
CHAIN = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
URL = re.compile(r"[a-z]+://(?P<user>[^\s/?#@\"'<>]+@)?[^\s/?#@\"'<>]+(?P<rest>[^\s\"'<>]*)")
ACCOUNT = re.compile(r"(?:[\s_-]?(?:no|number|nr|id|code))?\.?[\x20\t]*[:=#]?[\x20\t]*[\"']?([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{2,4}){3,8}\b|[A-Z0-9](?:[\x20-]?[A-Z0-9]){5,33}\b)")
SECRET = re.compile(r"[\"']?[\x20\t]*[:=][\x20\t]*[\"']?([^\s\"'<>,;]{8,})")
PERSONAL_PART = re.compile(r"[?&](?:user|username|login|email|e-mail|token|key|password|session|sid)=[^&\s]+", re.I)


@cache
def automaton() -> ahocorasick.Automaton:
    """Value of an anchor: kind, and its length."""
    found: dict[str, str] = {"@": "email"}
    digits = "0123456789"
    found |= {f"{a}.{b}": "ip" for a in digits for b in digits}
    found |= {f"{a}{s}{b}": "card" for a in digits for b in digits for s in ("", " ", "-")}
    found |= {f"+{a}": "phone" for a in digits}
    for kind, cues in (("url", SCHEMES), ("account", ACCOUNT_CUES), ("secret", SECRET_CUES)):
        found |= {form: kind for cue in cues for form in (cue, cue.upper(), cue.capitalize())}
    made = ahocorasick.Automaton()
    for word, kind in found.items():
        made.add_word(word, (kind, len(word)))
    made.make_automaton()
    return made


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if k % 2 == 0 else (2 * n if n < 5 else 2 * n - 9)
    return total % 10 == 0


def iban(value: str) -> bool:
    value = value.replace(" ", "")
    if not re.fullmatch(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", value):
        return False
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def spans_of(text: str | None) -> list[tuple[int, str, int, int]]:
    """(place of the kind in KINDS, kind, start, end) in code points, ends exclusive, sorted by kind, then start."""
    if not text:
        return []
    out: list[tuple[str, int, int]] = []
    past = dict.fromkeys(KINDS, 0)
    dull = 0
    for last, (kind, size) in automaton().iter(text):
        at = last - size + 1
        if at < past[kind]:
            continue
        if kind == "email":
            start = at
            while start > past[kind] and text[start - 1] in LOCAL:
                start -= 1
            if start < at and (m := DOMAIN.match(text, at + 1)):
                out.append((kind, start, m.end()))
                past[kind] = m.end()
        elif kind == "ip":
            start = at
            while start > past[kind] and text[start - 1] in DIGITS:
                start -= 1
            while m := FOUR.match(text, start):
                if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m.groups()):
                    out.append((kind, start, m.end()))
                start = past[kind] = m.end()
                if not (start + 1 < len(text) and text[start] == "." and text[start + 1] in DIGITS):
                    break
                start += 1
            else:
                past[kind] = max(past[kind], at + 1)
        elif kind == "card":
            m = CHAIN.match(text, at)
            past[kind] = m.end()
            digits = m.group().replace(" ", "").replace("-", "") if m.end() - at <= 40 else ""
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append((kind, at, m.end()))
        elif kind == "phone":
            if m := PHONE.match(text, at):
                past[kind] = m.end()
                if 8 <= sum(c in DIGITS for c in m.group()) <= 15:
                    out.append((kind, at, m.end()))
        elif kind == "url":
            if (m := URL.match(text, at)) and (m["user"] or PERSONAL_PART.search(m["rest"])):
                end = at + len(m.group().rstrip(".,;:!?)]}"))
                out.append((kind, at, end))
                past[kind] = end
        elif kind == "secret" and last + 2 < dull:
            continue  # its value would be the end of one that has too few digits
        elif (at == 0 or not text[at - 1].isalnum()) and (m := (ACCOUNT if kind == "account" else SECRET).match(text, last + 1)):
            value = m.group(1)
            if iban(value) if kind == "account" and "iban" in text[at : last + 1].lower() else sum(c in DIGITS for c in value) >= (6 if kind == "account" else 2):
                out.append((kind, m.start(1), m.end(1)))
                past[kind] = m.end(1)
            elif kind == "secret":
                dull = m.end(1)
    return sorted((KINDS.index(kind), kind, start, end) for kind, start, end in out)


def redacted(text: str | None) -> str | None:
    """The text with each stretch covered by spans replaced by the first span's kind in brackets."""
    found = sorted((start, end, kind) for _, kind, start, end in spans_of(text))
    if not found:
        return text
    parts, at = [], 0
    for start, end, kind in found:
        if start >= at:
            parts += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


SPANS = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def find_spans(docs: DataFrame) -> DataFrame:
    """One row for each row of docs: counts of the base kinds, sha256 of the base spans, and all spans as text.

    Null and empty texts have no spans. Rows with equal or null doc_id each get their own row. Texts of any length are
    read whole, in time that grows with their length; other columns of docs are ignored. Of candidates for one kind that overlap, the leftmost counts.
    """

    def scan(batches):
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                found = spans_of(text)
                base = [f"{k}:{a}:{b}" for n, k, a, b in found if n < len(BASE_KINDS)]
                counts = [sum(k == kind for _, k, _, _ in found) for kind in BASE_KINDS]
                rows.append((*counts, hashlib.sha256(",".join(base).encode()).hexdigest(), ",".join(f"{k}:{a}:{b}" for _, k, a, b in found)))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
            arrays = [pa.array(c, pa.int64()) for c in columns[:4]] + [pa.array(c, pa.string()) for c in columns[4:]]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    return docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(scan, SPANS)


def redact(docs: DataFrame) -> DataFrame:
    """docs with personal data in text replaced; all columns and rows stay. n_chars, if there, is counted anew."""
    names = docs.columns

    def rewrite(batches):
        for batch in batches:
            texts = [redacted(t) for t in batch.column("text").to_pylist()]
            columns = [pa.array(texts, batch.column(k).type) if n == "text" else batch.column(k) for k, n in enumerate(names)]
            if "n_chars" in names:
                old = batch.column("n_chars")
                columns[names.index("n_chars")] = pa.array([o if t is None else len(t) for t, o in zip(texts, old.to_pylist(), strict=True)], old.type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(rewrite, docs.schema)
