"""Operator 10: quality classifier by importance resampling.

Two generative models of hashed n-grams, one of target text (rows labelled good) and one of raw text
(all rows), give each document the weight p_target / p_raw. Documents are then drawn without
replacement by Gumbel top-k: a document's key is its log weight plus Gumbel noise, and the k greatest
keys are the sample. The noise comes from a hash of doc_id, so a repeated run draws the same sample.

Features: words (letters, digits, or a run of marks), pairs of neighbouring words, and triples of word
shapes (case, digits, marks, repeat of the word before), each hashed to a bucket of its own family.
Weights are means over a document's features, scaled to `effective` features: long documents do not
outweigh short ones just by being long.

The target model is fitted on a bounded sample: of one half of the labelled good rows (the other half
calibrates) the `fit_rows` whose hashed doc_id is least (a documented parameter, allowed for labelled rows only). The raw model counts every document.
k is the number of documents whose log weight lies above the border that best parts the held-out good
rows from the bad ones (a lost good row counts LOST_GOOD times). The k-th key is found by counting keys
in ever narrower bins, so only bin counts reach the driver; ties at the border go to the least doc_id.

Null and empty texts have no features and log weight 0 before noise. Labels that are null, repeated or
belong to no document do not matter (a doc_id with contradicting labels counts as bad). Without any
usable label all documents are kept. Rows alike in doc_id and text share key and verdict; of rows of one doc_id
with different texts each has its own. Extra columns are ignored by `score`, kept by `keep`.

Noise is added to log weights divided by a temperature, which draws by a power of the weight. At 1, the plain
ratio, noise as large as the weights drops good documents and draws bad ones (README has figures); a filter must
do neither, so the default is a quarter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lawloom.llm.common import bound_batches, mix, offsets_of, slices, stage, strings, unit, unused

#: Buckets of each family: words, pairs, shape triples. The model's size does not depend on the data.
WORD_BUCKETS = 1 << 15
PAIR_BUCKETS = 1 << 15
SHAPES = 8
SHAPE_BUCKETS = SHAPES**3
BUCKETS = WORD_BUCKETS + PAIR_BUCKETS + SHAPE_BUCKETS
FIT_ROWS = 20_000
EFFECTIVE = 100.0
SMOOTHING = 5.0
#: Keys are whole numbers of this fraction, so that they can be counted in exact bins.
KEY_UNIT = 1e-6
#: Log weights are binned this finely when the border is sought, and held within these limits.
BORDER_STEP = 0.25
BORDER_LIMIT = 100.0
LOST_GOOD = 5
BINS = 1 << 12


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers of all features of the texts, flat, and each feature's text."""
    spaced = pc.replace_substring_regex(texts, r"([\p{L}\p{N}])([^\p{L}\p{N}\s])", r"\1 \2")
    spaced = pc.replace_substring_regex(spaced, r"([^\p{L}\p{N}\s])([\p{L}\p{N}])", r"\1 \2")
    lists = pc.utf8_split_whitespace(pc.utf8_trim_whitespace(spaced))
    first = offsets_of_list(lists)
    coded = lists.flatten().dictionary_encode()
    words = coded.dictionary
    index = coded.indices.to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    full = np.ones(len(index), bool)
    if len(words):
        full = (pc.binary_length(words).to_numpy(zero_copy_only=False) > 0)[index]
    index, owner = index[full], owner[full]
    if not len(index):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    hashes = word_hashes(words)[index]
    shape = shapes(words)[index]
    same = np.r_[False, owner[1:] == owner[:-1]]
    shape[same & np.r_[False, index[1:] == index[:-1]]] = SHAPES - 1
    pair = mix(hashes[:-1] * np.uint64(3) + hashes[1:])[same[1:]]
    third = same[2:] & same[1:-1]
    triple = (shape[:-2] * SHAPES + shape[1:-1])[third] * SHAPES + shape[2:][third]
    buckets = np.concatenate(
        [
            (hashes % np.uint64(WORD_BUCKETS)).astype(np.int64),
            (pair % np.uint64(PAIR_BUCKETS)).astype(np.int64) + WORD_BUCKETS,
            triple + WORD_BUCKETS + PAIR_BUCKETS,
        ]
    )
    return buckets, np.concatenate([owner, owner[1:][same[1:]], owner[2:][third]])


def offsets_of_list(lists: pa.ListArray) -> np.ndarray:
    return lists.offsets.to_numpy(zero_copy_only=False) - lists.offsets[0].as_py() if len(lists) else np.zeros(1, np.int64)


def word_hashes(words: pa.Array) -> np.ndarray:
    """64-bit hashes of distinct words."""
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words.to_pylist()), np.uint64, len(words))


def shapes(words: pa.Array) -> np.ndarray:
    """Shape of each word: 0 lower, 1 title, 2 upper, 3 digits, 4 one mark, 5 marks, 6 other; 7 is a repeat."""
    tests = [
        (pc.match_substring_regex(words, r"^\p{Ll}+$"), 0),
        (pc.match_substring_regex(words, r"^\p{Lu}\p{Ll}*$"), 1),
        (pc.match_substring_regex(words, r"^\p{Lu}{2,}$"), 2),
        (pc.match_substring_regex(words, r"^\p{N}+$"), 3),
        (pc.match_substring_regex(words, r"^[^\p{L}\p{N}]$"), 4),
        (pc.match_substring_regex(words, r"^[^\p{L}\p{N}]{2,}$"), 5),
    ]
    out = np.full(len(words), 6, np.int64)
    for hit, number in tests:
        out[hit.to_numpy(zero_copy_only=False)] = number
    return out


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Feature counts of a task's rows, once for target rows and once for all."""
    total = np.zeros((2, BUCKETS), np.int64)
    for whole in batches:
        for batch in slices(whole):
            buckets, owner = features(strings(batch.column("text")))
            total[0] += np.bincount(buckets, minlength=BUCKETS)
            target = batch.column("target").to_numpy(zero_copy_only=False).astype(bool)
            total[1] += np.bincount(buckets[target[owner]], minlength=BUCKETS)
    seen = np.flatnonzero(total[0])
    yield pa.RecordBatch.from_arrays(
        [pa.array(seen.astype(np.int32)), pa.array(total[0][seen]), pa.array(total[1][seen])], ["bucket", "n_raw", "n_target"]
    )


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> np.ndarray:
    """Log ratio of the two models per bucket: an array of fixed size."""
    bound_batches(docs.sparkSession)
    good = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id").agg(F.min("quality").alias("quality")).where("quality = 1").where(FITTED).select("doc_id")
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    )
    # At most fit_rows ids of eight bytes.
    marked = docs.select("doc_id", "text").join(F.broadcast(good.withColumn("target", F.lit(True))), "doc_id", "left")
    counts = (
        marked.select("text", F.coalesce("target", F.lit(False)).alias("target"))
        .mapInArrow(_counts, "bucket int, n_raw long, n_target long")
        .groupBy("bucket").agg(F.sum("n_raw").alias("n_raw"), F.sum("n_target").alias("n_target"))
    )
    table = counts.toArrow().to_pydict()  # at most BUCKETS rows
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    raw[table["bucket"]], target[table["bucket"]] = table["n_raw"], table["n_target"]
    ratio = np.zeros(BUCKETS)
    cuts = np.cumsum([0, WORD_BUCKETS, PAIR_BUCKETS, SHAPE_BUCKETS])
    for a, b in zip(cuts[:-1], cuts[1:]):
        # Raw counts are scaled to the target's total; both models then get the same added counts.
        matched = raw[a:b] * (target[a:b].sum() / max(raw[a:b].sum(), 1))
        ratio[a:b] = np.log(target[a:b] + SMOOTHING) - np.log(matched + SMOOTHING)
    return ratio


def log_weights(docs: DataFrame, ratio: np.ndarray, temperature: float, seed: int) -> DataFrame:
    """doc_id, content (hash of the text), log_weight and key (whole number, log weight over temperature plus noise)."""
    model = docs.sparkSession.sparkContext.broadcast(ratio)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                buckets, owner = features(strings(batch.column("text")))
                n = np.bincount(owner, minlength=batch.num_rows)
                total = np.bincount(owner, model.value[buckets], minlength=batch.num_rows)
                weight = total / np.maximum(n, 1) * np.minimum(n, EFFECTIVE)
                ids = batch.column("doc_id").fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
                noise = -np.log(-np.log(unit(mix(mix(ids.view(np.uint64)) ^ np.uint64(seed)))))
                key = np.rint((weight / temperature + noise) / KEY_UNIT).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("content"), pa.array(weight), pa.array(key)],
                    ["doc_id", "content", "log_weight", "key"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), content(F.col("text")).alias("content"), "text").mapInArrow(
        run, "doc_id long, content long, log_weight double, key long"
    )


def kth(rows: DataFrame, column: str, k: int) -> tuple[int, int]:
    """The k-th greatest value of a long column, and how many rows with just that value are within k.

    Each pass counts at most BINS bins of the range in which the value lies.
    """
    low, high = rows.agg(F.min(column), F.max(column)).first()
    left = k
    while low < high:
        width = -(-(high - low + 1) // BINS)
        bins = (
            rows.where(F.col(column).between(low, high))
            .groupBy(F.expr(f"({column} - ({low})) div {width}").alias("bin")).count().collect()
        )
        for b, n in sorted(bins, reverse=True):
            if left <= n:
                low, high = low + b * width, min(high, low + (b + 1) * width - 1)
                break
            left -= n
    return low, left


#: Half of the labelled rows fit the target model, the other half calibrate the border.
FITTED = "pmod(xxhash64(doc_id, 3), 2) = 0"


def border_of(scored: DataFrame, labels: DataFrame) -> float | None:
    """The log weight that parts good from bad labelled rows at least cost; None without labels."""
    bins = F.floor(F.least(F.greatest("log_weight", F.lit(-BORDER_LIMIT)), F.lit(BORDER_LIMIT)) / BORDER_STEP)
    counts = (
        scored.select("doc_id", "log_weight")
        .join(labels.where("quality IS NOT NULL").where(f"NOT ({FITTED})").groupBy("doc_id").agg(F.min("quality").alias("quality")), "doc_id")
        .groupBy("quality", bins.alias("bin")).count().collect()
    )
    if not counts:
        return None
    steps = int(BORDER_LIMIT / BORDER_STEP)
    good, bad = np.zeros(2 * steps + 1, np.int64), np.zeros(2 * steps + 1, np.int64)
    for r in counts:
        (good if r["quality"] == 1 else bad)[r["bin"] + steps] += r["count"]
    lost = np.r_[0, np.cumsum(good)]  # good rows below each border
    kept = bad.sum() - np.r_[0, np.cumsum(bad)]
    cost = LOST_GOOD * lost + kept
    best = np.flatnonzero(cost == cost.min())
    return float((best[(len(best) - 1) // 2] - steps) * BORDER_STEP)


def score(
    docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, temperature: float = 0.25, seed: int = 20
) -> DataFrame:
    """Per row: doc_id, log_weight, key, selected."""
    return drawn(docs, labels, fit_rows, temperature, seed).drop("content")


def content(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def drawn(
    docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, temperature: float = 0.25, seed: int = 20
) -> DataFrame:
    """The rows of `score` with `content`, which with doc_id names a row's text."""
    scored = stage(log_weights(docs, fit(docs, labels, fit_rows), temperature, seed), "importance")
    border = border_of(scored, labels)
    k = scored.count() if border is None else scored.where(F.col("log_weight") >= border).count()
    if k <= 0:
        return scored.withColumn("selected", F.lit(False))
    last_key, within = kth(scored, "key", k)
    turn = -F.coalesce("doc_id", F.lit(-1))
    last_turn, _ = kth(scored.where(F.col("key") == last_key).withColumn("_turn", turn), "_turn", within)
    chosen = (F.col("key") > last_key) | ((F.col("key") == last_key) & (turn >= last_turn))
    return scored.withColumn("selected", chosen)


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The drawn rows of `docs`, with all their columns."""
    # Texts that were not drawn are as a rule the fewer.
    out = drawn(docs, labels).where("NOT selected").select("doc_id", "content").distinct()
    key, text = unused(docs, "key"), unused(docs, "content")
    named = docs.withColumns({key: F.col("doc_id").cast("long"), text: content(F.col("text"))})
    same = F.col(f"d.{key}").eqNullSafe(F.col("c.doc_id")) & (F.col(f"d.{text}") == F.col("c.content"))
    return named.alias("d").join(out.alias("c"), same, "left_anti").select(*(F.col(f"d.`{c}`") for c in docs.columns))
