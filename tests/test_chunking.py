from hypothesis import given, settings, strategies as st
from lawloom.constants import SEPARATORS
from lawloom.operators import chunking as C
from pyspark.sql import functions as F


def plain_split(text, size, overlap, seps):
    """The splitting rule on lists of strings, written separately from the library's spans."""
    def go(s, seps):
        sep = next((x for x in seps if x == "" or x in s), seps[-1])
        later = seps[seps.index(sep) + 1 :] if sep else []
        if sep == "":
            parts = list(s)
        else:
            bits = s.split(sep)
            parts = [p for p in [bits[0]] + [sep + b for b in bits[1:]] if p]
        out, good = [], []
        for p in parts:
            if len(p) < size:
                good.append(p)
                continue
            out += pack(good)
            good = []
            out += go(p, later) if later else [p]
        return out + pack(good)

    def pack(parts):
        out, cur = [], []
        for p in parts:
            if cur and sum(map(len, cur)) + len(p) > size:
                out.append("".join(cur))
                while cur and (sum(map(len, cur)) > overlap or sum(map(len, cur)) + len(p) > size):
                    cur.pop(0)
            cur.append(p)
        return out + (["".join(cur)] if cur else [])

    return [c.strip() for c in go(text, list(seps)) if c.strip()]


texts = st.text(alphabet=st.sampled_from("ab \n;é\U0001f600"), max_size=200) | st.text(max_size=80)


@settings(max_examples=300, deadline=None)
@given(texts, st.integers(2, 30), st.integers(0, 29))
def test_same_chunks_as_plain_rule(text, size, overlap):
    overlap = min(overlap, size - 1)
    got = C.split_text(text, size, overlap)
    assert [c for c, _ in got] == plain_split(text, size, overlap, SEPARATORS)


@settings(max_examples=300, deadline=None)
@given(texts, st.integers(2, 30), st.integers(0, 29))
def test_invariants(text, size, overlap):
    got = C.split_text(text, size, min(overlap, size - 1))
    assert all(len(c) <= size for c, _ in got)
    assert all(text[s : s + len(c)] == c for c, s in got)
    kept = "".join(c for c, _ in got)
    assert set(kept.replace(" ", "")) >= {ch for ch in text if not ch.isspace()}


def test_starts_rise_over_repeated_text():
    got = C.split_text("ab ab ab ab", 3, 0)
    assert [s for _, s in got] == sorted({s for _, s in got})


def test_edges():
    assert C.split_text("", 10, 2) == []
    assert C.split_text(" \n ", 10, 2) == []
    assert C.split_text("x" * 10, 10, 2) == [("x" * 10, 0)]
    assert C.split_text("\n\n\n\n", 2, 1) == []
    assert C.split_text("para one\n\npara two", 10, 0) == [("para one", 0), ("para two", 10)]
    assert C.split_text("aa;bb", 4, 0) == [("aa", 0), (";bb", 2)]


def test_fixed_chunks_match_plain_rule(spark):
    texts = ["", "abc", "x" * 25, "ab cd " * 9, "\U0001f600" * 21, "   "]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    for size, overlap in ((10, 3), (5, 4), (7, 0)):
        rows = df.select("i", C.fixed_chunks(F.col("t"), size, overlap).alias("c")).orderBy("i").collect()
        for r in rows:
            assert [c["text"] for c in r["c"]] == plain_split(texts[r["i"]], size, overlap, [""])


def test_chunk_table(spark):
    docs = spark.createDataFrame(
        [("t1", "ih", "bills", "b1", 117, "hr", 1, "2020-01-01", "one two three four"), ("t2", "ih", "bills", "b2", 117, "hr", 2, None, "")],
        "tv_id string, legis_version string, legis_class string, legis_id string, congress_num int, legis_type string, legis_num int, text_date string, text string",
    )
    rows = C.chunk_table(docs, 8, 3).orderBy("chunk_id").collect()
    assert [(r["chunk_id"], r["text"], r["metadata"]["start_index"]) for r in rows] == [
        ("t1-0", "one two", 0), ("t1-1", "three", 8), ("t1-2", "four", 14)
    ]
    from lawloom.schemas import CHUNK_METADATA
    assert rows[0]["metadata"].asDict().keys() == {f.name for f in CHUNK_METADATA.fields}


def test_chunks_are_made_in_arrays_of_bounded_size(monkeypatch):
    """A batch of many texts gives many arrays, of the same chunks; nulls and empty texts keep their places."""
    import pyarrow as pa

    texts = [None, "", "a b " * 400, None] + ["one two. " * 300] * 50 + [""]
    monkeypatch.setattr(C, "SPLIT_AT_ONCE", 5_000)
    made = list(C.split_batch(pa.array(texts), 1024, 256))
    assert len(made) > 10 and max(len(m.values) for m in made) <= 10
    want = [None if t is None else [{"text": c, "start_index": s} for c, s in C.split_text(t, 1024, 256)] for t in texts]
    assert [row for m in made for row in m.to_pylist()] == want
