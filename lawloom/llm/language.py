"""Operator 11: language identification by multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased; runs of letters are words, each with a space before and after. Features are the
words' n-grams of one to three code points, hashed into BUCKETS. Learning counts the buckets per language
over all documents that may be learned from, in each task first, then by a shuffle of (language, bucket)
counts. The matrix of log probabilities (languages times BUCKETS) is broadcast; its size is bounded by
MOST_LANGS, and more languages than that are an error, not a silent choice among them. A text is scored
as a whole: its distinct buckets and their counts are one sparse row, multiplied with the matrix.

Learned from: rows with lang and doc_id where crc32(doc_id as text) mod 3 is not 1. lang, source and
doc_id are not looked at when a text is judged. `score` is the posterior probability of the language given.
Texts that are null or have no letters get `und` and score 0, as does every text when nothing could be
learned. Rows without doc_id have no remainder: they are judged, not learned from, and not held out.
Repeated rows count and are judged each. Equal posteriors go to the language first in byte order. The empty
string is a language like others. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lawloom.llm.common import bound_batches, mix, slices, strings

LONGEST = 3
BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
#: Languages at most: the matrix then has 8 Mi cells (32 MiB).
MOST_LANGS = 256
#: Added to the count of every bucket.
SMOOTH = 0.5
UNKNOWN = "und"
#: Code points of a slice that are looked at together.
PIECE = 1 << 18

JUDGED = "doc_id long, held_out boolean, lang_pred string, score double"


def letters(texts: pa.Array) -> list[str]:
    """Each text's words in lower case, a space before, between and after them; empty without letters."""
    plain = pc.replace_substring_regex(pc.utf8_lower(texts), r"[^\p{L}]+", " ")
    return [f" {x} " if x else "" for x in pc.utf8_trim(plain, " ").to_pylist()]


def sparse_counts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, bucket) in order of text and bucket, and how often each occurs.

    Works in pieces of bounded size, so a very long text costs no more memory than its own letters.
    """
    words = letters(texts)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    ends = np.cumsum(lengths)
    keys, times = [], []
    for a in range(0, len(points), PIECE):
        here = points[a : a + PIECE + LONGEST - 1].astype(np.uint64)
        number = min(PIECE, len(points) - a)
        owner = np.searchsorted(ends, np.arange(a, a + len(here)), side="right").astype(np.uint64)
        space = here == 32
        got, hashed = [], np.zeros(len(here), np.uint64)
        for n in range(1, LONGEST + 1):
            size = len(here) - n + 1
            if size <= 0:
                break
            # Extend every n-gram by its last code point; a space may only be its first or last one.
            hashed = mix(hashed[:size] * np.uint64(0x9E3779B97F4A7C15) + here[n - 1 :] + np.uint64(n))
            inside = np.ones(size, bool) if n > 1 else ~space
            for k in range(1, n - 1):
                inside &= ~space[k : k + size]
            if n > 1:
                inside &= owner[:size] == owner[n - 1 :]
            inside[number:] = False
            got.append((owner[:size][inside] << np.uint64(BUCKET_BITS)) | (hashed[inside] >> np.uint64(64 - BUCKET_BITS)))
        key, n = np.unique(np.concatenate(got), return_counts=True)
        keys.append(key)
        times.append(n)
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    key, at = np.unique(np.concatenate(keys), return_inverse=True)
    n = np.bincount(at, np.concatenate(times), len(key)).astype(np.int64)
    return (key >> np.uint64(BUCKET_BITS)).astype(np.int64), (key & np.uint64(BUCKETS - 1)).astype(np.int64), n


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for whole in batches:
        for batch in slices(whole):
            owner, bucket, n = sparse_counts(strings(batch.column("text")))
            coded = batch.column("lang").dictionary_encode()
            of = coded.indices.to_numpy(zero_copy_only=False)[owner] if len(owner) else owner
            for k, name in enumerate(coded.dictionary.to_pylist()):
                if len(totals) >= MOST_LANGS and name not in totals:
                    raise ValueError(f"more than {MOST_LANGS} languages")
                total = totals.setdefault(name, np.zeros(BUCKETS, np.int64))
                total += np.bincount(bucket[of == k], n[of == k], BUCKETS).astype(np.int64)
    for name, total in totals.items():
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(some), pa.string()), pa.array(some.astype(np.int32)), pa.array(total[some])],
            ["lang", "bucket", "n"],
        )


class Model:
    """Languages in byte order, log priors, and log probabilities of buckets (BUCKETS x languages)."""

    def __init__(self, langs: list[str], documents: np.ndarray, counts: np.ndarray):
        self.langs = langs
        self.prior = np.log((documents + 1) / (documents.sum() + len(langs)))
        smooth = counts + SMOOTH
        self.logs = np.ascontiguousarray(np.log(smooth / smooth.sum(axis=0)).astype(np.float32))

    def judge(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """Language and posterior of each text."""
        owner, bucket, n = sparse_counts(texts)
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not len(owner) or not self.langs:
            return names, scores
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        total = np.empty((len(starts), len(self.langs)))
        for lang in range(len(self.langs)):
            total[:, lang] = np.add.reduceat(self.logs[bucket, lang].astype(np.float64) * n, starts)
        total += self.prior
        best = total.argmax(axis=1)
        share = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        scores[owner[starts]] = share
        for text, k in zip(owner[starts].tolist(), best.tolist()):
            names[text] = self.langs[k]
        return names, scores


def fit(docs: DataFrame) -> Model:
    """The model of `docs` with lang (doc_id, text, lang); all of them are counted."""
    bound_batches(docs.sparkSession)
    learned = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (remainder(F.col("doc_id")) != 1))
    number = learned.groupBy("lang").agg(F.count("*").alias("n")).limit(MOST_LANGS + 1).collect()
    if len(number) > MOST_LANGS:
        raise ValueError(f"more than {MOST_LANGS} languages")
    documents = {r["lang"]: r["n"] for r in number}
    langs = sorted(documents, key=str.encode)
    counted = learned.select("text", "lang").mapInArrow(_count, "lang string, bucket int, n long")
    # At most MOST_LANGS x BUCKETS rows.
    table = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((BUCKETS, len(langs)))
    column = {name: k for k, name in enumerate(langs)}
    coded = table.column("lang").combine_chunks().dictionary_encode()
    of = np.array([column[x] for x in coded.dictionary.to_pylist()], np.int64)
    if table.num_rows:
        counts[table.column("bucket").to_numpy(), of[coded.indices.to_numpy()]] = table.column("n").to_numpy()
    return Model(langs, np.array([documents[x] for x in langs], float), counts)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score."""
    spark = docs.sparkSession
    bound_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                names, scores = shared.value.judge(strings(batch.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(scores)],
                    ["doc_id", "held_out", "lang_pred", "score"],
                )

    held = F.coalesce(remainder(F.col("doc_id")) == 1, F.lit(False)).alias("held_out")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held, "text").mapInArrow(run, JUDGED)


def identify(docs: DataFrame) -> DataFrame:
    """Learn from `docs` and judge all of them."""
    return predict(docs, fit(docs))
