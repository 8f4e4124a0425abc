"""Spelling variants against all pairs of words."""

import collections
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from lawloom.llm import spelling


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows):
    count = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            if doc_id is not None:
                x = zlib.crc32(f"{doc_id}:{run}".encode())
                if x % 31 == 0:
                    run = run[: x % len(run)] + run[x % len(run) + 1 :]
            count[run] += 1
    words = {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}
    form, near = {}, {}
    for w, n in words.items():
        near[w] = sorted((-m, v) for v, m in words.items() if one_edit(w, v))
        if near[w] and -near[w][0][0] >= 10 * n:
            form[w] = near[w][0][1]
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), words[form[w]] if w in form else None))
    return sorted(out)


def found(docs):
    return sorted(map(tuple, spelling.variants(docs).collect()))


def corpus(seed, documents=120):
    """Words made of few syllables, so that many share a vector, with frequent forms and rare variants."""
    rng = random.Random(seed)
    syllables = ["on", "no", "ter", "ret", "é", "Éa", "ß", "the", "x"]
    stems = ["".join(rng.choice(syllables) for _ in range(rng.randrange(3, 6))) for _ in range(60)]
    rows = []
    for i in range(documents):
        words = [stems[int(rng.random() ** 3 * len(stems))] for _ in range(40)]
        for _ in range(4):
            w = rng.choice(words)
            at = rng.randrange(len(w))
            words.append(rng.choice([w[:at] + w[at + 1 :], w[:at] + "o" + w[at:], w[:at] + "q" + w[at + 1 :]]))
        rows.append((i, rng.choice([" ", ", ", "7"]).join(words)))
    return rows


def test_equals_all_pairs(spark):
    rows = corpus(1) + [(None, "Nullword Nullword nullwore nullwore"), (5, None), (6, ""), (7, "Nullword"), (7, "Nullword")]
    rows += [(None, "chainword " * 300 + "chainworx " * 25 + "chainwoxx " * 2)]
    want = brute(rows)
    assert any(r[1] for r in want) and any(r[1] and r[2] != r[1] for r in want)  # forms, and forms of forms
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == want


@pytest.mark.parametrize("depth", spelling.DEPTHS)
def test_every_depth_gives_the_same(spark, depth, monkeypatch):
    monkeypatch.setattr(spelling, "chosen_depth", lambda words: depth)
    rows = corpus(2, 60)
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_one_vector_for_all_words(spark, monkeypatch):
    """Permutations of the same letters cannot be parted by vectors: their part is split into blocks."""
    monkeypatch.setattr(spelling, "PART_WORDS", 20)
    rng = random.Random(3)
    words = {"".join(rng.sample("abcdefgh", 8)) for _ in range(150)}
    words |= {w[:3] + "q" + w[4:] for w in words} | {w[:5] + w[6:] for w in words} | {w + "c" for w in words}
    rows = [(None, " ".join(words)) for _ in range(2)] + [(None, f"{w} " * 30) for w in rng.sample(sorted(words), 40)]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_verification_equals_definition():
    rng = random.Random(4)
    texts = list({"".join(rng.choice("ab") for _ in range(rng.randrange(3, 8))) for _ in range(150)}) + ["a" * 5000, "a" * 2500 + "b" + "a" * 2499]
    words = spelling.Words(pa.array(texts))
    a, b = np.array([(i, j) for i in range(len(texts)) for j in range(len(texts)) if i != j and abs(len(texts[i]) - len(texts[j])) <= 1]).T
    assert spelling.one_edit(words, a, b).tolist() == [one_edit(texts[i], texts[j]) for i, j in zip(a, b)]


def test_odd_rows(spark, odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.where("length(text) < 1000 or text is null").collect()]
    assert found(odd_docs.where("length(text) < 1000 or text is null")) == brute(rows)
    long = "z" * 40_000
    rows = [(None, f"{long} {long}y {long[1:]} {long}"), (None, f"{long[1:]} {long}y " + f"{long} " * 20)]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)
    assert found(odd_docs.limit(0)) == []
