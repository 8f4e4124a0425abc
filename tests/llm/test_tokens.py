"""Encoding, token files and token counts against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from lawloom.llm import bpe, token_counts, tokens_out
from lawloom.llm.vocab import default_path, encoder

ALPHABET = ["a", "B", "é", "É", " ", "\n", "\t", "\x1c", " ", "'s", "!", "..", ",", "Σ", "ς", "İ", "é", "́", "1", "٣", "ǅ",
            "<|endoftext|>", "好", "ß", "ﬁ", " ", "😀", "_", "ª", "\x00", "\r\n", "aaaa", "the", "ing", "|>", "<|"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(default_path())


def random_texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 14))) for _ in range(n)] + ["", "ab" * 500 + "z" * 500]


def test_encoder_equals_library(library):
    texts = random_texts(1500)
    enc = encoder(default_path())
    for text, got in zip(texts, enc.encode(texts)):
        assert np.frombuffer(got, enc.dtype).tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_merge_rounds_equal_library(library):
    codec = bpe.codec(default_path())
    for text, (n, ids, decoded) in zip(texts := random_texts(1500, 2), codec.encode(texts)):
        want = library.encode(text, add_special_tokens=False).ids
        assert (n, ids) == (len(want), " ".join(map(str, want))), text
        assert decoded == library.decode(want, skip_special_tokens=False) == codec.decode(want)


def test_digest(library, smoke, odd_docs):
    for docs in (smoke("documents"), odd_docs, odd_docs.limit(0)):
        got = sorted(bpe.encode_digest(docs).collect(), key=str)
        want = []
        for row in docs.collect():
            ids = library.encode(row.text or "", add_special_tokens=False).ids
            texts = (" ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False))
            want.append((row.doc_id, len(ids), *[hashlib.sha256(t.encode()).hexdigest() for t in texts]))
        assert list(map(tuple, got)) == sorted(want, key=lambda r: str(r)) or sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_encode_column_keeps_columns(library, odd_docs):
    out = bpe.encode_column(odd_docs)
    assert out.columns == [*odd_docs.columns, "ids", "decoded"]
    for row in out.collect():
        assert row.ids == library.encode(row.text or "", add_special_tokens=False).ids


def expected_files(docs, library):
    rows = sorted(docs.select("doc_id", "text").collect(), key=lambda r: (r.doc_id is not None, r.doc_id, r.text is not None, r.text))
    at, out = 0, []
    for row in rows:
        ids = [*library.encode(row.text or "", add_special_tokens=False).ids, 1]
        out.append((row.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_token_files(library, smoke, odd_docs):
    for docs in (smoke("documents"), odd_docs, odd_docs.limit(0)):
        got = sorted(map(tuple, tokens_out.write_and_read(docs).collect()), key=lambda r: r[1])
        assert got == expected_files(docs, library)


def test_sequences_have_equal_length(library, smoke, tmp_path):
    docs = smoke("documents")
    manifest = tokens_out.write(docs, f"file://{tmp_path}/t", length=64).orderBy("part").collect()
    flat = [i for _, text in sorted((r.doc_id, r.text) for r in docs.collect()) for i in [*library.encode(text, add_special_tokens=False).ids, 1]]
    at = 0
    for file in manifest:
        ids, mask = tokens_out.sequence(file.file, 1)
        assert len(ids) == len(mask) == 64
        assert ids.to_pylist() == flat[at + 64 : at + 128]
        last, mask = tokens_out.sequence(file.file, (file.n_tokens - 1) // 64)
        used = (file.n_tokens - 1) % 64 + 1
        assert mask.to_pylist() == [True] * used + [False] * (64 - used)
        at += file.n_tokens
    assert at == len(flat)


@pytest.mark.parametrize("block", [7, 100, 1 << 20])
def test_separator_scan(library, smoke, tmp_path, monkeypatch, block):
    monkeypatch.setattr(token_counts, "RUN_BLOCKS", 5)
    docs = smoke("documents").limit(40).repartition(2)
    files, places = token_counts.write_flat(docs, f"file://{tmp_path}/f")
    got = token_counts.count(files, block_tokens=block).join(places, ["file", "nth"]).collect()
    want = {r.doc_id: len(library.encode(r.text, add_special_tokens=False).ids) for r in docs.collect()}
    assert {r.doc_id: r.n_tokens for r in got} == want and all(r.closed for r in got)
    by_file = {}
    for r in sorted(got, key=lambda r: (r.file, r.nth)):
        assert r.start == by_file.get(r.file, 0)
        by_file[r.file] = r.start + r.n_tokens + 1


def test_open_document_and_empty_files(spark, tmp_path):
    streams = {"a": [5, 6, 9, 9, 7], "b": [], "c": [1] * 25, "d": [9], "e": [3, 9] * 10}
    rows = []
    for name, ids in streams.items():
        (tmp_path / name).write_bytes(np.array(ids, "<u2").tobytes())
        rows.append((f"file://{tmp_path}/{name}", len(ids), 2))
    files = spark.createDataFrame(rows, "file string, n_tokens long, width int")
    got = token_counts.count(files, end=9, block_tokens=4).collect()
    by = {n: [(r.nth, r.start, r.n_tokens, r.closed) for r in sorted(got, key=lambda r: r.nth) if r.file.endswith(n)] for n in streams}
    assert by["a"] == [(0, 0, 2, True), (1, 3, 0, True), (2, 4, 1, False)]
    assert by["b"] == [] and by["c"] == [(0, 0, 25, False)] and by["d"] == [(0, 0, 0, True)]
    assert by["e"] == [(i, 2 * i, 1, True) for i in range(10)]


def test_special_text_is_no_separator(spark):
    docs = spark.createDataFrame([(1, "a <|endoftext|> b"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in token_counts.document_counts(docs).collect()}
    plain = Tokenizer.from_file(default_path())
    plain.encode_special_tokens = True
    assert got == {1: len(plain.encode("a <|endoftext|> b", add_special_tokens=False).ids), 2: 0}
