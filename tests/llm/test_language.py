"""Language identification against a plain model, and on held-out documents."""

import collections
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from lawloom.llm import language


def grams(text):
    """n-grams of the words, in plain Python (no hashing)."""
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    padded = f" {' '.join(words)} " if words else ""
    out = collections.Counter()
    for n in (1, 2, 3):
        for i in range(len(padded) - n + 1):
            gram = padded[i : i + n]
            if gram.strip() and " " not in gram[1:-1]:
                out[gram] += 1
    return out


def bucket_of(gram):
    owner, bucket, n = language.sparse_counts(pa.array([f"{gram}"], pa.large_string()))
    return dict(zip(bucket.tolist(), n.tolist()))


def test_counts_equal_plain_counts(monkeypatch):
    """Same number of n-grams and of distinct ones per text, whatever the size of the pieces."""
    rng = random.Random(1)
    texts = ["".join(rng.choice("abcé ß1.\n") for _ in range(rng.randrange(60))) for _ in range(80)] + ["", "  ", "a", "αβγ δ"]
    whole = language.sparse_counts(pa.array(texts, pa.large_string()))
    for k, text in enumerate(texts):
        mine = whole[2][whole[0] == k]
        plain = grams(text)
        assert sum(mine) == sum(plain.values()) and len(mine) == len(plain), text
        assert sorted(mine) == sorted(plain.values())
    for piece in (1, 7, 64):
        monkeypatch.setattr(language, "PIECE", piece)
        again = language.sparse_counts(pa.array(texts, pa.large_string()))
        assert all((x == y).all() for x, y in zip(whole, again))


def brute(rows):
    """doc_id -> (held_out, language, score), by naive Bayes over dictionaries with as many cells as buckets."""
    mod = lambda i: None if i is None else zlib.crc32(str(i).encode()) % 3
    counts, number = collections.defaultdict(collections.Counter), collections.Counter()
    for i, text, lang in rows:
        if lang is not None and i is not None and mod(i) != 1:
            number[lang] += 1
            counts[lang].update(grams(text or ""))
    out = []
    for i, text, _ in rows:
        found = grams(text or "")
        if not found or not number:
            out.append((i, mod(i) == 1, "und", 0.0))
            continue
        scores = {}
        for lang in number:
            total = sum(counts[lang].values()) + language.SMOOTH * language.BUCKETS
            scores[lang] = math.log((number[lang] + 1) / (sum(number.values()) + len(number))) + sum(
                n * math.log((counts[lang][g] + language.SMOOTH) / total) for g, n in found.items()
            )
        best = min(scores, key=lambda x: (-scores[x], x.encode()))
        out.append((i, mod(i) == 1, best, 1 / sum(math.exp(s - scores[best]) for s in scores.values())))
    return out


def test_equals_plain_model(spark):
    rng = random.Random(2)
    alphabets = {"xx": "abcdeé", "yy": "abcxyz", "zz": "klmnaé", "": "qrs"}
    rows = []
    for i in range(240):
        lang = rng.choice(list(alphabets))
        text = " ".join("".join(rng.choice(alphabets[lang]) for _ in range(rng.randrange(1, 5))) for _ in range(rng.randrange(1, 6)))
        rows.append((i, text, rng.choice([lang, lang, lang, None])))
    rows += [(300, None, "xx"), (301, "12 -", "yy"), (302, "", None), (None, "abc abc", "yy"), (303, "abc", "xx"), (303, "abc", "xx")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = sorted(map(tuple, language.identify(docs).collect()), key=str)
    want = sorted(brute(rows), key=str)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    # Log probabilities are kept as float32.
    assert np.allclose([g[3] for g in got], [w[3] for w in want], atol=1e-4)


def test_held_out_documents(spark, smoke):
    docs = smoke("documents")
    rows = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 50 and np.mean([r.lang == r.lang_pred for r in rows]) >= 0.95


def test_labels_of_held_out_documents_do_not_matter(spark, smoke):
    docs = smoke("documents").select("doc_id", "text", "lang", "source")
    other = docs.selectExpr(
        "doc_id", "text", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 3 = 1 THEN 'zz' ELSE lang END AS lang", "'q' AS source"
    )
    assert sorted(language.identify(docs).collect()) == sorted(language.identify(other).collect())


def test_odd_rows(spark, odd_docs):
    rows = language.identify(odd_docs).collect()  # no lang at all
    assert len(rows) == odd_docs.count() and {(r.lang_pred, r.score) for r in rows} == {("und", 0.0)}
    rows = language.identify(odd_docs.selectExpr("* EXCEPT (lang)", "'l' AS lang")).collect()
    by = {r.doc_id: (r.lang_pred, r.score) for r in rows}
    assert by[1] == by[2] == by[3] == ("und", 0.0) and by[4] == by[None] == ("l", 1.0)
    assert language.identify(odd_docs.limit(0)).count() == 0


def test_too_many_languages_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(language, "MOST_LANGS", 2)
    docs = spark.createDataFrame([(i, "abc", f"l{i}") for i in range(30)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="more than 2"):
        language.fit(docs)
