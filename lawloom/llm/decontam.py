"""Operator 8: benchmark decontamination by rare n-gram seeds and Smith-Waterman alignment.

1. Every three-word sequence of the test items is a possible seed. A scan of the corpus counts them all
   (a bit field of the items' hashes, of fixed size, lets other sequences pass by at once).
2. Each item keeps its rarest half, ties included, and FEW seeds at least: common phrases drop out of long
   items, but an item keeps seeds however often it was copied, since rarity is ranked within the item.
3. A second scan finds the seeds in the documents and emits the words around them, overlapping windows
   merged, once for each text. Windows meet items by an equality join on the seed.
4. Each pair of window and item is aligned by words (match +2, other -1, gap -1). The best local score
   over that of the whole item is the pair's score; pairs of at least `least` are contaminated.

One row per (doc_id, item_id) with its best score. Items shorter than a seed have one seed, all their
words, and are found by it anywhere; items without words match nothing. Null texts are empty. Texts are known
by their hashes (96 bits), not by doc_id: equal texts are aligned once, a null doc_id is a document like others
(its rows have a null doc_id), and `clean` judges rows of one doc_id each by its own text. Items of one item_id
are judged each, the best score counts. Empty tables give no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lawloom.llm.common import bound_batches, slices, stage, strings, unused
from lawloom.llm.words import hashed_words, ngrams

SEED_WORDS = 3
LEAST = 0.5
#: Seeds that an item keeps at least, if it has as many.
FEW = 16
#: What names a text.
KEY = ("content", "check")
#: Bits of the field that holds the items' seeds: 2 MiB, whatever the number of items.
FIELD_BITS = 24
SLACK = 8
MATCH, OTHER, GAP = 2, -1, -1
#: Alignments done at once: cells of the widest one times their number.
ALIGN_CELLS = 1 << 21


def item_words(items: DataFrame) -> DataFrame:
    """item_id, words (hashes), seeds (hashes) of every item with a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                words, counts = hashed_words(strings(batch.column("text")))
                seeds, owner, _ = ngrams(words, counts, SEED_WORDS)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("item_id").cast(pa.int64()), lists(words.view(np.int64), counts),
                     lists(seeds.view(np.int64), np.bincount(owner, minlength=batch.num_rows))],
                    ["item_id", "words", "seeds"],
                )

    return (
        items.select("item_id", "text").mapInArrow(run, "item_id long, words array<long>, seeds array<long>")
        .where("size(words) > 0")
    )


def lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), pa.array(values))


def bit_field(seeds: DataFrame) -> np.ndarray:
    """A field with a bit set for the low bits of every seed (column `seed`): a few bytes per task meet."""
    words = (
        seeds.select(F.expr(f"seed & {(1 << FIELD_BITS) - 1}").alias("low")).groupBy(F.expr("low >> 6").alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, CAST(low & 63 AS INT)))").alias("bits"))
    )
    table = words.toArrow()  # at most 2^(FIELD_BITS - 6) rows
    field = np.zeros(1 << (FIELD_BITS - 6), np.uint64)
    field[table.column("word").to_numpy()] = table.column("bits").to_numpy().view(np.uint64)
    return np.unpackbits(field.view(np.uint8), bitorder="little").astype(bool)


def text_key(text: Column) -> list[Column]:
    text = F.coalesce(text, F.lit(""))
    return [F.xxhash64(text).alias(KEY[0]), F.hash(text).alias(KEY[1])]


def short_grams(words: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All n-grams of fewer words than a seed, hashed as the one seed of an item of n words; text and place of each."""
    sizes = np.maximum(counts - n + 1, 0)
    owner = np.repeat(np.arange(len(counts)), sizes)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = (np.cumsum(counts) - counts)[owner] + place
    each = words[(at[:, None] + np.arange(n)).ravel()] if len(at) else np.zeros(0, np.uint64)
    return ngrams(each, np.full(len(at), n), SEED_WORDS)[0], owner, place


def _hits(batch: pa.RecordBatch, field: np.ndarray, short: tuple[int, ...]):
    """Words of the texts, and the seeds found in them: hash, text, place, in order of text and place."""
    words, counts = hashed_words(strings(batch.column("text")))
    found = [ngrams(words, counts, SEED_WORDS)]
    # A text of just n words has had its n-gram as its own seed.
    for n in short:
        grams, owner, place = short_grams(words, counts, n)
        longer = counts[owner] > n
        found.append((grams[longer], owner[longer], place[longer]))
    seeds, owner, place = (np.concatenate(x) for x in zip(*found))
    hit = np.flatnonzero(field[(seeds & np.uint64((1 << FIELD_BITS) - 1)).astype(np.int64)])
    if short:
        hit = hit[np.lexsort((place[hit], owner[hit]))]
    return words, counts, seeds[hit], owner[hit], place[hit]


def seed_counts(docs: DataFrame, field, short: tuple[int, ...]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                _, _, seeds, _, _ = _hits(batch, field.value, short)
                seed, n = np.unique(seeds, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(seed.view(np.int64)), pa.array(n)], ["seed", "n"])

    return docs.select("text").mapInArrow(run, "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n"))


def windows(docs: DataFrame, field, reach: int, short: tuple[int, ...]) -> DataFrame:
    """Merged windows around the seeds of every text: its key, at (the first word), words, seeds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                words, counts, seeds, owner, place = _hits(batch, field.value, short)
                if not len(seeds):
                    continue
                base = np.cumsum(counts) - counts
                low, high = np.maximum(place - reach, 0), np.minimum(place + SEED_WORDS + reach, counts[owner])
                new = np.r_[True, (owner[1:] != owner[:-1]) | (low[1:] > high[:-1])]
                first = np.flatnonzero(new)
                last = np.r_[first[1:], len(seeds)] - 1
                start, stop, doc = low[first], high[last], owner[first]
                size = stop - start
                at = np.repeat(base[doc] + start - (np.cumsum(size) - size), size) + np.arange(size.sum())
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).take(pa.array(doc)) for k in KEY), pa.array(start),
                     lists(words[at].view(np.int64), size), lists(seeds.view(np.int64), last - first + 1)],
                    [*KEY, "at", "words", "seeds"],
                )

    rows = docs.select(*text_key(F.col("text")), "text")
    return rows.mapInArrow(run, "content long, check int, at long, words array<long>, seeds array<long>")


def local_scores(items: list[np.ndarray], spans: list[np.ndarray]) -> np.ndarray:
    """Smith-Waterman scores of pairs, all at once: row by row over the items, padded to the longest.

    Within a row a gap along the window is the running maximum of what lies left, less a point a step.
    """
    n, m = max(map(len, items)), max(map(len, spans))
    a, b = np.zeros((len(items), n), np.int64), np.zeros((len(spans), m), np.int64)
    inside, within = np.zeros(a.shape, bool), np.zeros(b.shape, bool)
    for k, (x, y) in enumerate(zip(items, spans)):
        a[k, : len(x)], inside[k, : len(x)] = x, True
        b[k, : len(y)], within[k, : len(y)] = y, True
    step = np.arange(1, m + 1, dtype=np.int32) * -GAP
    row, best = np.zeros((len(items), m + 1), np.int32), np.zeros(len(items), np.int32)
    for i in range(n):
        same = (a[:, i : i + 1] == b) & within & inside[:, i : i + 1]
        cell = np.maximum(row[:, :-1] + np.where(same, MATCH, OTHER), row[:, 1:] + GAP)
        cell = np.maximum(cell, 0).astype(np.int32)
        cell = np.maximum.accumulate(cell + step, axis=1) - step
        row[:, 1:] = cell
        np.maximum(best, cell.max(axis=1), out=best)
    return best


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        items = [np.asarray(x, np.int64) for x in batch.column("item").to_numpy(zero_copy_only=False)]
        spans = [np.asarray(x, np.int64) for x in batch.column("words").to_numpy(zero_copy_only=False)]
        order = np.argsort([len(x) * len(y) for x, y in zip(items, spans)], kind="stable")
        score, group, widest = np.zeros(len(items)), [], [0, 0]

        def done():
            got = local_scores([items[k] for k in group], [spans[k] for k in group])
            score[group] = got / [MATCH * len(items[k]) for k in group]

        for k in order:
            wide = [max(widest[0], len(items[k])), max(widest[1], len(spans[k]))]
            if group and wide[0] * wide[1] * (len(group) + 1) > ALIGN_CELLS:
                done()
                group, wide = [], [len(items[k]), len(spans[k])]
            group.append(k)
            widest = wide
        done()
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(k) for k in KEY), batch.column("item_id"), pa.array(score)], [*KEY, "item_id", "score"]
        )


def contaminated_texts(docs: DataFrame, items: DataFrame, least: float = LEAST) -> DataFrame:
    """Key of the text, item_id, score of every contaminated pair of a text and an item."""
    spark = docs.sparkSession
    bound_batches(spark)
    items = stage(item_words(items).withColumn("item", F.monotonically_increasing_id()), "items")
    size = F.size("words")
    sizes = items.agg(F.max(size).alias("longest"), F.collect_set(F.least(size, F.lit(SEED_WORDS))).alias("short")).first()
    if sizes["longest"] is None:
        return spark.createDataFrame([], "content long, check int, item_id long, score double")
    short = tuple(sorted(n for n in sizes["short"] if n < SEED_WORDS))
    seeds = items.select("item", F.explode(F.array_distinct("seeds")).alias("seed"))
    share = spark.sparkContext.broadcast
    counted = seeds.join(stage(seed_counts(docs, share(bit_field(seeds)), short), "seed-counts"), "seed", "left")
    rarity = Window.partitionBy("item")
    rare = stage(
        counted.withColumn("n", F.coalesce("n", F.lit(0)))
        .withColumn("_rank", F.rank().over(rarity.orderBy("n")))
        .withColumn("_all", F.count("*").over(rarity))
        .where(f"2 * (_rank - 1) < _all OR _rank <= {FEW}").select("item", "seed"), "rare-seeds",
    )
    found = windows(docs, share(bit_field(rare)), sizes["longest"] + SLACK, short).dropDuplicates([*KEY, "at"])
    found = stage(found, "seed-windows")
    met = (
        found.select(*KEY, "at", F.explode(F.array_distinct("seeds")).alias("seed"))
        .join(rare, "seed").select(*KEY, "at", "item").distinct()
    )
    pairs = met.join(found.select(*KEY, "at", "words"), [*KEY, "at"]).join(
        items.select("item", "item_id", F.col("words").alias("item_words")), "item"
    )
    scored = pairs.select(*KEY, "item_id", "words", F.col("item_words").alias("item")).mapInArrow(
        _align, "content long, check int, item_id long, score double"
    )
    return scored.where(F.col("score") >= least).groupBy(*KEY, "item_id").agg(F.max("score").alias("score"))


def contaminated(docs: DataFrame, items: DataFrame, least: float = LEAST) -> DataFrame:
    """doc_id, item_id, score of every contaminated pair."""
    pairs = contaminated_texts(docs, items, least)
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *text_key(F.col("text")))
    return named.join(pairs, list(KEY)).groupBy("doc_id", "item_id").agg(F.max("score").alias("score"))


def clean(docs: DataFrame, items: DataFrame, least: float = LEAST) -> DataFrame:
    """`docs` without the contaminated ones."""
    names = [unused(docs, k) for k in KEY]
    bad = contaminated_texts(docs, items, least).select(*KEY).distinct().toDF(*names)
    keyed = docs.withColumns(dict(zip(names, text_key(F.col("text")))))
    return keyed.join(bad, names, "left_anti").select(*(f"`{c}`" for c in docs.columns))
