"""Near duplicates, decontamination and the pipeline."""

import collections
import hashlib
import random
import re

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lawloom.llm import decontam, pii, probminhash
from lawloom.llm.vocab import default_path
from lawloom.llm.words import hashed_words


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def shingles(text, n=5):
    w = words(text)
    return collections.Counter(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else {}


def similarity(x, y):
    x = {k: 1 + np.log(n) for k, n in x.items()}
    y = {k: 1 + np.log(n) for k, n in y.items()}
    keys = set(x) | set(y)
    return sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in keys) for i in set(x) & set(y))


def prepared(texts):
    s, w, n = probminhash.weighted_shingles(*hashed_words(pa.array(texts, pa.large_string())))
    cuts = np.r_[0, np.cumsum(n)]
    return (s, w, n), [(s[a:b], w[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]


def test_similarity_and_estimate():
    w = [f"w{i}" for i in range(120)]
    texts = [" ".join(w), " ".join(w[:100] + ["new"] * 12), " ".join(w[:30] * 3 + w[50:90]), "one two", ""]
    (s, weight, n), each = prepared(texts)
    signature = probminhash.signatures(s, weight, n, 8192)
    for i in range(3):
        for j in range(i):
            exact = similarity(shingles(texts[i]), shingles(texts[j]))
            assert abs(probminhash.probability_jaccard(each[i], each[j]) - exact) < 1e-9
            assert abs((signature[i] == signature[j]).mean() - exact) < 0.03
    assert (signature[3] == each[3][0][0]).all()


def brute_classes(rows):
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(i, t, shingles(t)) for i, t in rows]
    for k, (i, t, s) in enumerate(sets):
        for j, u, r in sets[:k]:
            same = t == u if not s or not r else s.keys() & r.keys() and similarity(s, r) >= probminhash.LEAST
            if same:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: find(i) for i in parent}


def test_classes_equal_brute_force(spark):
    rng = random.Random(6)
    vocabulary = [f"v{i}" for i in range(300)]
    base = [[rng.choice(vocabulary) for _ in range(rng.choice([3, 6, 40, 90]))] for _ in range(12)]
    rows = []
    for i in range(150):
        text = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            text[rng.randrange(len(text))] = rng.choice(vocabulary)
        rows.append((i, rng.choice([" ", "  ", ", "]).join(text)))
    rows += [(200, ""), (201, ""), (202, " "), (203, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in probminhash.classes(docs).collect()}
    assert got == brute_classes([(i, t or "") for i, t in rows])


def star(copies, middle, seed=9):
    """Copies alike to the original (0.8 and more), not to each other; the original has a middle doc_id."""
    rng = random.Random(seed)
    original = [f"s{i}" for i in range(200)]
    rows = [(middle, " ".join(original))]
    for n in range(copies):
        text = list(original)
        for k, place in enumerate(rng.sample(range(1, 20), 4)):
            text[place * 10 - rng.randrange(5)] = f"e{n}x{k}"
        rows.append((n if n < middle else n + 1, " ".join(text)))
    return rows


@pytest.mark.parametrize("copies", [320, 5_000])
def test_star_around_a_middle_doc_id(spark, copies):
    rows = star(copies, copies // 2)
    of = dict(rows)
    sets = {n: set(shingles(t)) for n, t in rows}  # no shingle repeats: plain Jaccard
    jaccard = lambda x, y: len(sets[x] & sets[y]) / len(sets[x] | sets[y])
    assert all(jaccard(copies // 2, n) >= 0.8 for n in of) and jaccard(0, 1) < 0.8
    got = probminhash.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.class_id for r in got} == {0} and len(got) == copies + 1


def components_of(rows):
    """Components of a part's texts by comparing every pair, labels joined from the start."""
    sets = {n: shingles(t) for n, _, t in rows}
    parent = {n: n for n in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, label, _ in rows:
        for m, other, _ in rows:
            if n < m and (label == other or sets[n].keys() & sets[m].keys() and similarity(sets[n], sets[m]) >= probminhash.LEAST):
                parent[find(n)] = find(m)
    return {frozenset(m for m in parent if find(m) == find(n)) for n in parent}


@pytest.mark.parametrize("repeats", [False, True])
def test_forest_connects_what_all_pairs_connect(repeats, monkeypatch):
    monkeypatch.setattr(probminhash, "RARE", 4)
    monkeypatch.setattr(probminhash, "CELLS", 1 << 9)
    rng = random.Random(12)
    vocabulary = [f"v{i}" for i in range(400)]
    base = [[rng.choice(vocabulary) for _ in range(60)] * (1 + (repeats and k % 2)) for k in range(4)]
    rows = []
    for n in range(70):
        text = list(rng.choice(base))
        for _ in range(rng.randrange(5)):
            text[rng.randrange(len(text))] = rng.choice(vocabulary)
        rows.append((n, rng.choice([n, n, 1]), " ".join(text)))
    (s, w, counts), _ = prepared([t for _, _, t in rows])
    cuts = np.r_[0, np.cumsum(counts)]
    held = []
    for (n, label, _), a, b in zip(rows, cuts[:-1], cuts[1:]):
        short = (s[a:b] >> np.uint64(probminhash.SHINGLE_BITS - 32)).astype(np.uint32)
        held.append([n, label, short.tobytes(), w[a:b].astype(np.float32).tobytes() if (w[a:b] > 1).any() else None])
    links = probminhash.forest(held)
    sets = {n: shingles(t) for n, _, t in rows}
    assert all(similarity(sets[a], sets[b]) >= probminhash.LEAST for a, b in links)
    want = components_of(rows)
    assert len(links) == len({label for _, label, _ in rows}) - len(want)
    parent = {n: {m for m, other, _ in rows if other == label} for n, label, _ in rows}
    for a, b in links:
        both = parent[a] | parent[b]
        for n in both:
            parent[n] = both
    assert {frozenset(p) for p in parent.values()} == want


def test_parts_hold_every_pair(spark, monkeypatch):
    """Small buckets are one part; of a crowded one with few texts outside its largest component these few meet all."""
    monkeypatch.setattr(probminhash, "PART", 8)
    monkeypatch.setattr(probminhash, "FEW", 3)
    rng = np.random.default_rng(3)
    bands = [[int(n % 2 == 0) * (n + 2), 500 + n % 7, *(1000 + 40 * n + k for k in range(2, probminhash.BANDS))] for n in range(50)]
    for n, m in rng.integers(0, 50, (40, 2)):
        for k in rng.integers(2, probminhash.BANDS, 3):
            bands[n][k] = bands[m][k]
    label = [0 if n % 2 and n > 5 else n for n in range(50)]
    nodes = spark.createDataFrame(list(enumerate(bands)), "node long, bands array<long>")
    labels = spark.createDataFrame(list(enumerate(label)), "node long, label long")
    texts = spark.createDataFrame([], "node long, text string")
    dealt = collections.defaultdict(set)
    for r in probminhash.parts(nodes, labels, texts).collect():
        dealt[r.part, r.block].add(r.node)
    met = {(a, b) for p in dealt.values() for a in p for b in p if a < b}
    sizes = collections.Counter((k, x) for row in bands for k, x in enumerate(row))
    for n in range(50):
        for m in range(n + 1, 50):
            shared = [k for k in range(probminhash.BANDS) if bands[n][k] == bands[m][k]]
            if label[n] != label[m] and any(sizes[k, bands[n][k]] > 2 for k in shared):
                assert (n, m) in met, (n, m, shared)
    assert max(map(len, dealt.values())) <= 8 * 2


@pytest.mark.parametrize("part", [24, 100])
def test_crowded_buckets_are_parted(spark, monkeypatch, part):
    """The star again, its buckets parted by further registers once or several times."""
    monkeypatch.setattr(probminhash, "PART", part)
    monkeypatch.setattr(probminhash, "FEW", 4)
    rows = star(320, 160)
    got = probminhash.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.class_id for r in got} == {0} and len(got) == 321


def test_one_of_each_keeps_different_texts_of_one_doc_id(spark):
    long = [" ".join(f"{c}{i}" for i in range(60)) for c in "abc"]
    rows = [(2, long[0], "x"), (2, long[1], "x"), (2, long[1], "w"), (5, long[1] + " z", "x"), (1, long[2], "x"), (2, long[2] + " z", "x"), (None, long[0], "n"), (7, None, "x"), (6, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string")
    kept = sorted(map(tuple, probminhash.one_of_each(docs).collect()), key=str)
    other = (2, long[1])
    assert sorted((k[:2] for k in kept), key=str) == sorted([(2, long[0]), other, (1, long[2]), (None, long[0]), (6, "")], key=str)
    again = probminhash.one_of_each(docs.orderBy(F.desc("key"), "text").repartition(3))
    assert sorted(map(tuple, again.collect()), key=str) == kept  # also which of the repeated rows
    got = collections.defaultdict(set)
    for r in probminhash.classes(docs).collect():
        got[r.doc_id].add(r.class_id)
    assert got == {2: {1, 2}, 5: {2}, 1: {1}, None: {None}, 7: {6}, 6: {6}}


def test_links_are_named_as_what_they_are(spark):
    """A count of links used in the search is not the number of near duplicates."""
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert probminhash.classes(docs).columns == ["doc_id", "class_id", "links_used"]


def test_odd_rows(spark, odd_docs):
    rows = probminhash.classes(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = collections.defaultdict(set)
    for r in rows:
        by[r.doc_id].add(r.class_id)
    assert by == {1: {1}, 2: {1}, 3: {3}, 4: {4}, 5: {5}, 6: {5}, None: {None}, 8: {4}}
    kept = probminhash.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(map(str, [r.doc_id for r in kept.collect()])) == sorted(map(str, [1, 3, 4, 5, None]))
    assert probminhash.classes(odd_docs.limit(0)).count() == 0


def align(x, y):
    h = np.zeros((len(x) + 1, len(y) + 1), int)
    for i in range(len(x)):
        for j in range(len(y)):
            h[i + 1, j + 1] = max(0, h[i, j] + (2 if x[i] == y[j] else -1), h[i, j + 1] - 1, h[i + 1, j] - 1)
    return h.max()


def test_alignment_equals_table():
    rng = np.random.default_rng(7)
    items = [rng.integers(0, 6, rng.integers(1, 20)) for _ in range(80)]
    spans = [rng.integers(0, 6, rng.integers(1, 40)) for _ in range(80)]
    assert decontam.local_scores(items, spans).tolist() == [align(x, y) for x, y in zip(items, spans)]


def all_scores(items, docs):
    """Scores of every item with every document as one window."""
    hashed = lambda texts: [x.view(np.int64) for x in split(*hashed_words(pa.array(texts, pa.large_string())))]
    a, b = hashed([t for _, t in items]), hashed([t or "" for _, t in docs])
    out = {}
    for (item, _), x in zip(items, a):
        if len(x) and any(map(len, b)):
            for (doc, _), score in zip(docs, decontam.local_scores([x] * len(b), b) / (2 * len(x))):
                out[doc, item] = max(score, out.get((doc, item), 0))
    return out


def split(flat, counts):
    ends = np.cumsum(counts)
    return [flat[a:b] for a, b in zip(ends - counts, ends)]


def test_pairs_equal_alignment_of_all_pairs(spark, smoke):
    rng = random.Random(18)
    items = [(r.item_id, r.text) for r in smoke("benchmark").limit(25).collect()]
    items += [(900, "quux"), (901, "lorem quux"), (902, ""), (903, None), (904, "single word item here"), (904, "another text of that id")]
    texts = [r.text for r in smoke("documents").limit(40).collect()]
    docs = []
    for n, (_, item) in enumerate(items[:25]):
        w = words(item)
        for _ in range(rng.randrange(len(w) // 6 + 1)):
            at = rng.randrange(len(w))
            w[at : at + 1] = rng.choice([[], ["other"], [w[at], "put"]])
        docs.append((n, f"{texts[n][:600]} {' '.join(w)} {texts[n][:200]}"))
    docs += [(100 + n, t[:2000]) for n, t in enumerate(texts)]
    docs += [(200, "foo lorem quux bar"), (201, "quux"), (202, "lorem"), (203, None), (204, ""), (None, docs[0][1]), (100, docs[1][1]), (None, "clean words")]
    docs += [(205, "x another text of that id y"), docs[2], docs[2]]
    table = spark.createDataFrame(items, "item_id long, text string")
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("content", F.lit("clash"))
    got = {(r.doc_id, r.item_id): r.score for r in decontam.contaminated(frame, table).collect()}
    scores = all_scores(items, docs)
    want = {p: s for p, s in scores.items() if s >= decontam.LEAST}
    # Half of two words is a score of 0.5, but no seed.
    seedless = {p for p in want if p[1] == 901 and want[p] <= 0.5}
    assert len(want) > 25 and got == {p: s for p, s in want.items() if p not in seedless}
    kept = decontam.clean(frame, table)
    judged = lambda t: all_scores(items, [(0, t)]).items()
    bad = {t for _, t in docs if any(s >= decontam.LEAST and not (p[1] == 901 and s <= 0.5) for p, s in judged(t))}
    assert sorted(map(str, [(r.doc_id, r.text) for r in kept.collect()])) == sorted(str((i, t)) for i, t in docs if t not in bad)
    assert kept.columns == frame.columns


def test_edited_copies_are_found(spark, smoke, odd_docs):
    rng = random.Random(8)
    items = smoke("benchmark").collect()
    clean = smoke("documents").limit(50).collect()
    rows, want = [], set()
    for n, item in enumerate(items[:30]):
        w = words(item.text)
        for _ in range(len(w) // 8):
            at = rng.randrange(len(w))
            w[at : at + 1] = rng.choice([[], ["other"], [w[at], "put", "in"]])
        rows.append((1000 + n, f"{clean[n].text} {' '.join(w)} {clean[n].text[:200]}"))
        want.add((1000 + n, item.item_id))
    rows += [(2000, " ".join(f"fresh{i}" for i in range(300)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").unionByName(odd_docs.select("doc_id", "text"))
    got = {(r.doc_id, r.item_id): r.score for r in decontam.contaminated(docs, smoke("benchmark")).collect()}
    assert want <= set(got)
    item_of = {i.item_id: words(i.text) for i in items}
    text_of = dict(rows)
    for (doc, item), score in list(got.items())[:12]:
        assert abs(score - align(item_of[item], words(text_of[doc])) / (2 * len(item_of[item]))) < 1e-12
    assert not any(d == 2000 for d, _ in got)
    left = decontam.clean(odd_docs, smoke("benchmark"))
    assert left.columns == odd_docs.columns and left.count() == odd_docs.count()
    assert decontam.contaminated(docs, smoke("benchmark").limit(0)).count() == 0
    assert decontam.contaminated(docs.limit(0), smoke("benchmark")).count() == 0


def test_pipeline(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = step(spark, docs, folder).cache()
        assert docs.columns == columns, name
        after = docs.count()
        assert 0 < after <= before and docs.select("doc_id").distinct().count() == after
        before = after
    assert corpus_pipeline.run(spark, folder).count() == before


def plain_pipeline(docs, items):
    """Rows of the last stage by plain means, for documents without labels and without loose personal data."""
    kept = []
    named = [(i, t or "") for i, t in docs if i is not None]
    texts = sorted(set(named))
    classes = brute_classes([(n, t) for n, (_, t) in enumerate(texts)])
    leaders = {}
    for n, (i, t) in enumerate(texts):
        leaders.setdefault(classes[n], (i, t))
    kept = list(leaders.values()) + [(i, t) for i, t in docs if i is None]
    clean = [(i, t) for i, t in kept if not any(s >= decontam.LEAST for s in all_scores(items, [(0, t)]).values())]
    encoder = Tokenizer.from_file(default_path())
    out = []
    for i, t in clean:
        for start, end, kind in sorted(((s, e, pii.KINDS[k]) for k, s, e in pii.base_spans(t or "")), reverse=True):
            t = f"{t[:start]}[{kind.upper()}]{t[end:]}"
        ids = encoder.encode(t or "", add_special_tokens=False).ids
        digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
        out.append((i, len(ids), digest(" ".join(map(str, ids))), digest(encoder.decode(ids, skip_special_tokens=False))))
    return sorted(out, key=str)


def test_run_equals_plain_stages(spark, tmp_path):
    """All stages one after another: nulls, repeated rows, shared and missing doc_ids, columns whose names clash."""
    rng = random.Random(33)
    prose = lambda n: " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "rho"]) + str(rng.randrange(400)) for _ in range(n))
    items = [(n, prose(25)) for n in range(4)]
    docs = [(i, prose(60)) for i in range(12)]
    docs += [(20, docs[3][1]), (21, docs[4][1] + " tail"), (5, docs[5][1]), (6, prose(50)), (6, prose(50)), (None, prose(30)), (None, docs[2][1])]
    docs += [(30, f"{prose(20)} {items[1][1]} {prose(10)}"), (None, items[2][1]), (7, f"{prose(5)} {items[3][1]}"), (31, None), (32, ""), (33, "  ")]
    docs += [(34, prose(20) + " write to ann.poe@example.org today"), (35, "call +1 234 567 8901 now " + prose(15))]
    extra = {n: F.lit("x") for n in ("content", "key", "node", "text_b", "words", "turn", "_row", "spans")}
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in docs]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumns(extra)
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, got), key=str) == plain_pipeline(docs, items)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_empty_tables(spark, odd_docs, name):
    step = dict(corpus_pipeline.STAGES)[name]
    assert step(spark, odd_docs.limit(0), "/root/testdata/sf0.001").count() == 0
