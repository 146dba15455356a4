"""Personal data in texts: patterns propose spans, checksums confirm them, context words adjust the score.

Four base kinds (email, ip, card, phone) are always kept when they pass their own checks.
Further kinds (short_card, iban, routing, ssn, local_phone) are kept when pattern,
checksum and nearby context words together reach `threshold`.

Defined results: a null or empty text has no spans; every input row gives one output row,
repeated rows and null ids included; other columns of the input are left out; spans of one
kind never overlap, spans of different kinds may. Every pattern runs in time linear in the
text, so very long texts and runs of one character are safe.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldmart.llm.common import text_rows

#: The kinds in their order of output; the first four are the base kinds.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "short_card", "iban", "routing", "ssn", "local_phone")

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_NUMBER = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_ROUTING = re.compile(r"(?<![0-9-])[0-9]{9}(?![0-9-])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+(])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])")

#: Words that raise a span's score when they stand within `CONTEXT` characters before it.
CONTEXT = 40
CONTEXT_WORDS = {
    "email": ("email", "mail", "contact"), "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "credit", "payment"), "phone": ("phone", "tel", "call", "mobile", "fax"),
    "short_card": ("card", "amex", "credit", "payment"), "iban": ("iban", "bank", "account"),
    "routing": ("routing", "aba", "transit"), "ssn": ("ssn", "social", "security"),
    "local_phone": ("phone", "tel", "call", "mobile", "fax"),
}
#: Score of the bare pattern; a passed checksum adds 0.4 and a context word 0.3.
PATTERN_SCORE = {"email": 0.9, "ip": 0.7, "card": 0.4, "phone": 0.7, "short_card": 0.2, "iban": 0.4,
                 "routing": 0.0, "ssn": 0.4, "local_phone": 0.4}
CHECKED, NEARBY = 0.4, 0.3

SCHEMA = "doc_id long, spans array<struct<kind:string,start:int,end:int,score:double>>"


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    for d in map(int, digits[-2::-2]):
        total += 2 * d - 9 if d > 4 else 2 * d
    return total % 10 == 0


def mod97(account: str) -> bool:
    """The account with its first four characters moved to the end, letters as 10 to 35, leaves 1."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def routing_sum(digits: str) -> bool:
    return digits != "0" * 9 and sum(w * int(d) for w, d in zip((3, 7, 1) * 3, digits, strict=True)) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each @ outwards: every start in the run before it matches alike, so the leftmost is the run's start."""
    done, at = 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        start = at
        if domain:
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
        if start < at:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _ips(text: str) -> Iterator[tuple[int, int]]:
    """Chains of dotted numbers, four parts at a time from the left."""
    for chain in _DOTTED.finditer(text):
        parts, at = chain.group().split("."), chain.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            length = sum(map(len, four)) + 3
            if all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in four):
                yield at, at + length
            at += length + 1


def _proposals(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """(kind, start, end, whether a checksum confirmed it)."""
    for start, end in _emails(text):
        yield "email", start, end, False
    for start, end in _ips(text):
        yield "ip", start, end, False
    for m in _NUMBER.finditer(text):
        if 12 < len(m.group()) and 13 <= len(digits := m.group().replace(" ", "").replace("-", "")) <= 19 and luhn(digits):
            yield "card" if len(digits) >= 16 else "short_card", m.start(), m.end(), True
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(map(str.isdigit, m.group())) <= 15:
                yield "phone", m.start(), m.end(), False
    for m in _IBAN.finditer(text):
        if 15 <= len(account := m.group().replace(" ", "")) <= 34 and mod97(account):
            yield "iban", m.start(), m.end(), True
    for m in _ROUTING.finditer(text):
        if routing_sum(m.group()):
            yield "routing", m.start(), m.end(), True
    for m in _SSN.finditer(text):
        yield "ssn", m.start(), m.end(), False
    for m in _LOCAL_PHONE.finditer(text):
        yield "local_phone", m.start(), m.end(), False


_WORDS = re.compile("[a-z]+")


def find_spans(text: str, threshold: float) -> list[dict]:
    """Confirmed spans in the order of `KINDS`, then start."""
    found = []
    for kind, start, end, checked in _proposals(text):
        near = not set(CONTEXT_WORDS[kind]).isdisjoint(_WORDS.findall(text[max(0, start - CONTEXT):start].lower()))
        score = round(min(1.0, PATTERN_SCORE[kind] + CHECKED * checked + NEARBY * near), 2)
        if kind in BASE_KINDS or score >= threshold:
            found.append({"kind": kind, "start": start, "end": end, "score": score})
    found.sort(key=lambda s: (KINDS.index(s["kind"]), s["start"]))
    return found


def pii_spans(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", threshold: float = 0.7) -> DataFrame:
    """One row per document: doc_id and its spans (kind, start, end in code points, score)."""
    spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def build(pairs):
        for ids, texts in pairs:
            yield [ids.cast(pa.int64()), pa.array([find_spans(t, threshold) for t in texts], spans)]

    return text_rows(docs, id_column, text_column, SCHEMA, build)


def redact(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; of overlapping spans the earlier one counts."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["end"], s["kind"])))
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    done = F.aggregate(ordered, start, lambda acc, s: F.when(s["start"] >= acc["at"], F.struct(
        F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit("["), s["kind"], F.lit("]")).alias("out"),
        s["end"].alias("at"))).otherwise(acc))
    return F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text)))


def digest_columns(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, the digest of the base spans, and all spans as text."""
    as_text = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    of = lambda kind: F.filter("spans", lambda s: s["kind"] == kind)
    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(as_text(base).cast("binary"), 256).alias("base_sha256"),
                        as_text(F.col("spans")).alias("spans"))
