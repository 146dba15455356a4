"""Spans against the plain patterns, and the further kinds."""

import random
import re

from fieldmart.llm import pii

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    def fine(kind, found):
        digits = re.sub("[^0-9]", "", found)
        if kind == "ip":
            return all(int(p) <= 255 for p in found.split("."))
        if kind == "card":
            return 16 <= len(digits) <= 19 and pii.luhn(digits)
        return kind == "email" or 8 <= len(digits) <= 15
    return [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text) if fine(k, m.group())]


def base_spans(text):
    return [(s["kind"], s["start"], s["end"]) for s in pii.find_spans(text, 0.7) if s["kind"] in pii.BASE_KINDS]


def test_base_kinds_equal_plain_patterns():
    rnd = random.Random(3)
    for _ in range(6000):
        signs = rnd.choice(["ab@.-1", "0125.", "4 -0", "+1(). -9", "a@b.c1+ 2-3"])
        text = "".join(rnd.choice(signs) for _ in range(rnd.randint(0, 30)))
        assert base_spans(text) == plain_spans(text), text
    for text in ["é 4111 1111 1111 1111 x", "a@b.c@d.e_f@g.h", "1.2.3.4.5.6.7.8", "256.1.1.1 0255.1.1.1", "+49 (30) 1234-5678.", "4111-1111-1111-1111"]:
        assert base_spans(text) == plain_spans(text), text


def test_long_runs_are_linear():
    assert pii.find_spans("a" * 300_000, 0.7) == pii.find_spans("1" * 300_000 + " " + "+ " * 100_000, 0.7) == []
    assert base_spans("a" * 100_000 + "@b.c") == [("email", 0, 100_004)]
    assert len(base_spans("@" * 100_000 + "1." * 100_000)) == 25_000


def kinds(text):
    return [s["kind"] for s in pii.find_spans(text, 0.7)]


def test_checksums_and_context():
    assert kinds("bank DE89 3704 0044 0532 0130 00 end") == ["iban"] and kinds("DE88370400440532013000") == []
    assert kinds("routing number 021000021") == ["routing"] and kinds("order 021000021") == [] and kinds("routing number 021000022") == []
    assert kinds("amex card 378282246310005") == ["short_card"] and kinds("number 378282246310005") == []
    assert kinds("my SSN 123-45-6789") == ["ssn"] and kinds("part 123-45-6789") == []
    assert kinds("call 212-555-0100") == ["local_phone"] and kinds("212-555-0100") == []


def test_documents(spark, awkward, nothing):
    found = pii.pii_spans(awkward).collect()
    assert len(found) == awkward.count() and all(r.spans == [] for r in found)
    docs = spark.createDataFrame([(1, "mail a@b.co or 10.0.0.1"), (None, None)], "doc_id long, text string")
    out = {r.doc_id: r for r in pii.digest_columns(pii.pii_spans(docs)).collect()}
    assert out[1].spans == "email:5:11,ip:15:23" and (out[1].n_email, out[1].n_ip, out[1].n_card) == (1, 1, 0)
    assert out[None].spans == "" and out[None].base_sha256.startswith("e3b0c442")
    hidden = docs.join(pii.pii_spans(docs), "doc_id").select(pii.redact(docs["text"], "spans").alias("t")).first().t
    assert hidden == "mail [email] or [ip]"
    assert pii.digest_columns(pii.pii_spans(nothing)).count() == 0
