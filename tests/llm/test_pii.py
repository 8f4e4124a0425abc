"""Personal data: the base against plain patterns, added spans, redaction."""

import hashlib
import random
import re

from lawloom.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")


def plain(text):
    out = [("email", m.start(), m.end()) for m in EMAIL.finditer(text)]
    out += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in pii.CARD.finditer(text):
        digits = re.sub("[ -]", "", m[0])
        if 16 <= len(digits) <= 19 and pii.luhn(digits):
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in pii.PHONE.finditer(text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


def test_base_equals_patterns():
    rng = random.Random(4)
    parts = ["a", "b.", "@", "-", ".", "1", "12", "255", "256", "+", " ", "(", ")", "4444", "4111111111111111", "é", "x@y.z", "+1 234 567 89", "00", "\n", "_", "%"]
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 16)))
        assert [(pii.KINDS[k], s, e) for k, s, e in pii.base_spans(text)] == plain(text), text
    for text in ("a" * 300_000, "1" * 300_000, "1." * 100_000, "@" * 100_000, "+1" * 100_000):
        pii.base_spans(text), pii.loose_spans(text)


def as_text(spans):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def test_find_keeps_the_base(spark, odd_docs):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(400)
    more = spark.createDataFrame(
        [(90_001, "write to jane.doe.77(at)mail7.example(dot)com or so"), (90_002, "cards 4111111111111111 5500005555555559 here"),
         (90_003, "look at home. The rest at large.text")], "doc_id long, text string")
    docs = docs.select("doc_id", "text").unionByName(more).unionByName(odd_docs.select("doc_id", "text"))
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    got = pii.find(docs).collect()
    assert len(got) == docs.count()
    added = {}
    for r in got:
        base = plain(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(as_text(base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, _, _ in base) for kind in pii.KINDS]
        spans = [tuple(x.split(":")) for x in r.spans.split(",") if x]
        spans = [(k, int(s), int(e)) for k, s, e in spans]
        assert set(base) <= set(spans) and spans == sorted(spans, key=lambda x: (pii.KINDS.index(x[0]), x[1]))
        added[r.doc_id] = [texts[r.doc_id][s:e] for k, s, e in set(spans) - set(base)]
    assert sorted(added[90_002]) == ["4111111111111111", "5500005555555559"]
    assert added[90_003] == [] and added[4] == []


def test_redaction(spark, odd_docs):
    docs = spark.createDataFrame(
        [(1, "mail a.b@c.de now, +1 (234) 555-1234.", 37, "x"), (2, None, None, None), (3, "nothing", 7, None)],
        "doc_id long, text string, n_chars long, _added string",
    ).drop("_added")
    got = {r.doc_id: r for r in pii.redact(docs).collect()}
    assert got[1].text == "mail [EMAIL] now, [PHONE]." and got[1].n_chars == len(got[1].text)
    assert got[2].text is None and got[2].n_chars is None and got[3].text == "nothing"
    out = pii.redact(odd_docs)
    assert out.schema == odd_docs.schema and sorted(map(str, out.collect())) == sorted(map(str, odd_docs.collect()))
    assert pii.redact(docs.limit(0)).count() == 0
