"""Operator 7: near duplicates by ProbMinHash signatures, banding and verification.

Shingles are five words; a shingle found t times in a text weighs 1 + ln t. Every shingle of a text is
a Poisson process with its weight as rate; each arrival falls on one of the signature's registers, and
a register keeps the shingle that arrived there first. A shingle stops as soon as its next arrival is
later than all registers. Two texts agree in a register with the probability Jaccard of their weights
(for texts without repeated shingles, the plain Jaccard).

Texts with equal word sequences are one class from the start; only the least doc_id of a class takes
part further. Bands of registers deal texts into buckets. A bucket is never expanded into all its pairs:
its texts are compared with two pivots of it, verified on the whole texts. Where the texts of a bucket are
still in several components, the bucket is parted by a second band, and again each part's texts meet its two
pivots. So large groups of copies are connected by comparisons in proportion to their texts.

Buckets that still hold several components are then compared completely, each inside one task: its texts'
shingles are put side by side, and the task gives a spanning forest of the links it verified, at most one row
for each text. A bucket of more than PART texts is dealt out first. If all but a few of its texts are in one
component, these few go along to each block of the component. If not, its texts are parted by further registers,
TABLES times by HALF of them each, and so on until the parts are small; a pair of similarity 0.8 is in none of
these parts together with probability 3e-8. Verified links (LEAST and above) are connected, and every document
gets the least doc_id of its component. (Between texts of one part shingles are compared by 32 bits of their hashes.)

With 32 bands of 6 registers a pair of similarity 0.8 shares no bucket with probability 6e-5, one of 0.85
with 3e-7. Null texts are empty. Texts without words are equal
when they are the same string; texts of one to four words are one shingle. A text is named by its words, so
rows of one doc_id with different texts are documents each: both then have their own class, named by the
least doc_id in it. Rows without doc_id get a null class. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lawloom.llm.common import bound_batches, mix, slices, stage, strings, unit, unused
from lawloom.llm.decontam import lists
from lawloom.llm.words import hashed_words, ngrams

SHINGLE = 5
LEAST = 0.8
BANDS, ROWS = 32, 6
REGISTERS = BANDS * ROWS
#: Second bands by which buckets with several components are parted, one after another.
DEPTH = 1
#: Texts that are compared completely at once in one task.
PART = 4096
#: Texts outside a bucket's largest component that may go along to each of that component's blocks.
FEW = 256
#: A crowded part is parted this many times, each time by so many further registers.
TABLES, HALF = 24, ROWS // 2
#: Shingles in so many texts of a part at most are met pair by pair, others by matrix products.
RARE = 32
#: Cells of a matrix of texts and shingles.
CELLS = 1 << 22
#: Allowance for rounding before a pair is compared exactly.
ROUNDING = 1e-4
#: Bits of a shingle's hash that are kept (the rest holds the text's number in a batch).
SHINGLE_BITS = 44


def weighted_shingles(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text, their weights, and each text's number of them."""
    grams, owner, _ = ngrams(words, counts, SHINGLE)
    keys = np.sort((owner.astype(np.uint64) << np.uint64(SHINGLE_BITS)) | (grams >> np.uint64(64 - SHINGLE_BITS)))
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    times = np.diff(np.r_[first, len(keys)])
    keys = keys[first]
    owner = (keys >> np.uint64(SHINGLE_BITS)).astype(np.int64)
    return (
        keys & np.uint64((1 << SHINGLE_BITS) - 1), 1 + np.log(times), np.bincount(owner, minlength=len(counts)),
    )


def signatures(shingles: np.ndarray, weights: np.ndarray, counts: np.ndarray, m: int = REGISTERS) -> np.ndarray:
    """The shingle that came first in each register, per text with shingles (0 elsewhere)."""
    texts = len(counts)
    first = np.full(texts * m, np.inf)
    winner = np.zeros(texts * m, np.uint64)
    latest = np.full(texts, np.inf)
    owner = np.repeat(np.arange(texts), counts)
    # A few arrivals at once where a text has few shingles.
    at_once = np.clip(2 * m // np.maximum(counts, 1), 1, 256)
    active, time, drawn = np.arange(len(shingles)), np.zeros(len(shingles)), np.zeros(len(shingles), np.int64)
    while len(active):
        reps = at_once[owner[active]]
        ends = np.cumsum(reps)
        of = np.repeat(np.arange(len(active)), reps)
        nth = drawn[of] + np.arange(len(of)) - (ends - reps)[of]
        element = active[of]
        random = mix(shingles[element] * np.uint64(0x9E3779B97F4A7C15) + mix(nth.astype(np.uint64)))
        wait = -np.log(unit(random)) / weights[element]
        if len(of) > len(active):
            total = np.cumsum(wait)
            when = time[of] + total - (total[ends - reps] - wait[ends - reps])[of]
        else:
            when = time + wait
        doc = owner[element]
        hit = when < latest[doc]
        register = doc[hit] * m + (mix(random[hit]) % np.uint64(m)).astype(np.int64)
        np.minimum.at(first, register, when[hit])
        won = when[hit] == first[register]
        winner[register[won]] = shingles[element[hit][won]]
        latest = first.reshape(texts, m).max(axis=1)
        go_on = when[ends - 1] < latest[owner[active]]
        active, time, drawn = active[go_on], when[ends - 1][go_on], (drawn + reps)[go_on]
    return winner.reshape(texts, m)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key per text and band."""
    rows = signature.reshape(len(signature), BANDS, ROWS)
    key = np.broadcast_to(mix(np.arange(1, BANDS + 1)), rows.shape[:2]).copy()
    for k in range(ROWS):
        key = mix(key * np.uint64(31) + rows[:, :, k])
    return key.view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole):
            texts = strings(batch.column("text"))
            words, counts = hashed_words(texts)
            shingles, weights, numbers = weighted_shingles(words, counts)
            signed = signatures(shingles, weights, numbers)
            keys = band_keys(signed)
            starts = np.cumsum(counts) - counts
            names = [
                xxhash.xxh3_128_digest(words[a : a + n].tobytes()) if n else xxhash.xxh3_128_digest(texts[i].as_py(), 1)
                for i, (a, n) in enumerate(zip(starts.tolist(), counts.tolist()))
            ]
            some = counts > 0
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), batch.column("content"), pa.array(names, pa.binary()),
                 lists(keys[some].ravel(), np.where(some, BANDS, 0))],
                ["doc_id", "content", "name", "bands"],
            )


def probability_jaccard(x: dict | tuple, y: tuple) -> float:
    """Probability Jaccard of two texts given as (sorted shingles, weights)."""
    (a, u), (b, v) = x, y
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(i):
        return 0.0
    shared_u, shared_v = u[i], v[j]
    ratio = shared_v / shared_u
    order = np.argsort(ratio, kind="stable")
    shared_u, shared_v, ratio = shared_u[order], shared_v[order], ratio[order]
    # Shingles of one text only have ratio 0 or infinity: they count on their own side throughout.
    below = np.cumsum(shared_u) + (u.sum() - shared_u.sum())
    above = v.sum() - np.cumsum(shared_v)
    last = np.searchsorted(ratio, ratio, side="right") - 1
    return float((1 / (below[last] / shared_u + above[last] / shared_v)).sum())


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text_b", 1 << 19):
            sides = []
            for name in ("text_a", "text_b"):
                shingles, weights, counts = weighted_shingles(*hashed_words(strings(batch.column(name))))
                cuts = np.r_[0, np.cumsum(counts)]
                sides.append([(shingles[p:q], weights[p:q]) for p, q in zip(cuts[:-1], cuts[1:])])
            sims = [probability_jaccard(x, y) for x, y in zip(*sides)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(sims, pa.float64())], ["a", "b", "sim"]
            )


def verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b, sim) of pairs, on whole texts; written."""
    rows = (
        pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
        .join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
        .select("a", "b", "text_a", "text_b")
    )
    return stage(rows.mapInArrow(_compare, "a long, b long, sim double"), "near-sims")


def components(links: DataFrame) -> DataFrame:
    """(node, label) of linked nodes: the least node of the component. Labels travel along links and jump."""
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other"))
    edges = stage(both.union(both.select("other", "node")), "near-edges")
    labels = stage(edges.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("label")), "near-labels")
    while True:
        heard = edges.join(labels.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.min("label").alias("heard"))
        jumped = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        moved = stage(
            labels.join(heard, "node").join(jumped, "label", "left")
            .select("node", F.least("label", "heard", F.coalesce("far", "label")).alias("label"), F.col("label").alias("_was")),
            "near-labels",
        )
        labels = moved.select("node", "label")
        if moved.where("label <> _was").isEmpty():
            return labels


def content(text: Column) -> Column:
    """A text's own hash: with the doc_id it names a row's text."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def classes(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, class_id (least doc_id of its class), links_used (links of its text that the search found).

    `links_used` counts links the search happened to need; it is not the number of near duplicates.
    """
    return grouped(docs).select("doc_id", F.col("lead.doc_id").alias("class_id"), "links_used")


def grouped(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, content, lead (doc_id and content of the class's first row, by doc_id and content), links_used."""
    spark = docs.sparkSession
    bound_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), content(F.col("text")).alias("content"), "text")
    signed = stage(rows.mapInArrow(_sign, "doc_id long, content long, name binary, bands array<long>"), "near-signed")
    kept = signed.where("doc_id IS NOT NULL")
    # Equal names have equal bands. The numbers are written, so they stay what they are.
    leaders = kept.groupBy("name").agg(F.min(F.struct("doc_id", "content")).alias("lead"), F.first("bands").alias("bands"))
    leaders = stage(leaders.withColumn("node", F.monotonically_increasing_id()), "near-leaders")
    placed = leaders.select("node", F.explode("bands").alias("bucket"))
    crowded = placed.groupBy("bucket").agg(F.min("node").alias("_low"), F.max("node").alias("_high")).where("_low <> _high")
    wanted = placed.join(crowded.select("bucket"), "bucket", "left_semi").select("node").distinct()
    # From here on: texts that share a bucket with another one.
    nodes = stage(leaders.join(wanted, "node", "left_semi").select("node", "lead", "bands"), "near-nodes")
    rows = rows.join(nodes.select("node", F.col("lead.doc_id").alias("doc_id"), F.col("lead.content").alias("content")), ["doc_id", "content"])
    # A row may be there several times: any of them has the text.
    texts = stage(rows.select("node", "text").dropDuplicates(["node"]), "near-texts")
    labels = nodes.select("node", F.col("node").alias("label"))
    sims = spark.createDataFrame([], "a long, b long, sim double")
    for depth in range(DEPTH + 1):
        second = F.get("bands", F.pmod(F.col("i") + depth, F.lit(BANDS)))
        dealt = nodes.join(labels, "node").select("node", "label", "bands", F.posexplode("bands").alias("i", "bucket"))
        if depth:
            dealt = dealt.withColumn("bucket", F.xxhash64("i", "bucket", second))
        dealt = dealt.select("bucket", "node", "label")
        turn = F.struct(F.xxhash64("node", F.lit(5)).alias("h"), "node", "label")
        mixed = (
            dealt.groupBy("bucket")
            .agg(F.min(F.struct("node", "label")).alias("p"), F.min(turn).alias("q"), F.min("label").alias("_low"), F.max("label").alias("_high"))
            .where("_low <> _high").select("bucket", F.array("p", F.struct("q.node", "q.label")).alias("pivots"))
        )
        met = dealt.join(mixed, "bucket").select("node", "label", F.explode("pivots").alias("p")).where("label <> p.label")
        pairs = met.select(F.least("node", "p.node").alias("a"), F.greatest("node", "p.node").alias("b")).distinct()
        if depth:
            pairs = pairs.join(sims, ["a", "b"], "left_anti")
        pairs = stage(pairs, "near-pairs")
        if depth and pairs.isEmpty():
            continue
        fresh = verify(pairs, texts)
        sims = sims.union(fresh) if depth else fresh
        labels = merged(labels, fresh.where(F.col("sim") >= LEAST))
    links = sims.where(F.col("sim") >= LEAST).select("a", "b")
    dealt = stage(parts(nodes, labels, texts), "near-parts")
    if not dealt.isEmpty():
        found = stage(compared(dealt, texts).distinct(), "near-links")
        links = links.union(found)
        labels = merged(labels, found)
    return _result(signed, leaders, links, labels)


def _halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys of every half of a band."""
    for whole in batches:
        for batch in slices(whole):
            signed = signatures(*weighted_shingles(*hashed_words(strings(batch.column("text")))))
            rows = signed.reshape(len(signed), -1, HALF)
            key = np.zeros(rows.shape[:2], np.uint64)
            for k in range(HALF):
                key = mix(key * np.uint64(31) + rows[:, :, k])
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), lists(key.view(np.int64).ravel(), np.full(len(key), key.shape[1]))], ["node", "halves"]
            )


def parts(nodes: DataFrame, labels: DataFrame, texts: DataFrame) -> DataFrame:
    """(part, block, node, label): what is left to be compared, dealt into parts of a bounded number of texts."""
    dealt = nodes.join(labels, "node").select("node", "label", F.posexplode("bands").alias("band", "part"))
    number, out, halves, used = REGISTERS // HALF, None, None, 0
    while True:
        counted = dealt.groupBy("part", "label").agg(F.count("*").alias("n")).groupBy("part").agg(
            F.sum("n").alias("n"), F.max(F.struct("n", "label")).alias("most"), F.count("*").alias("_labels")
        )
        # The texts of a part that go along to all its blocks: those outside the largest component, if they are
        # few; all of them when there are no registers left to part them by.
        few = (F.col("n") - F.col("most.n") <= FEW) | F.lit(used + TABLES > number - 2)
        # Two texts of a bucket have met as pivot and text.
        mixed = counted.where("_labels > 1 AND n > 2").select(
            "part", F.col("most.label").alias("_most"), (F.col("n") > PART).alias("_large"), few.alias("_few"),
            F.ceil(F.col("n") / PART).alias("_blocks"),
        )
        dealt = stage(dealt.join(mixed, "part"), "near-dealt")
        own = F.pmod(F.xxhash64("node", F.lit(7)), F.col("_blocks"))
        spread = F.when(F.col("label") == F.col("_most"), F.array(own)).otherwise(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1))
        ready = dealt.where("NOT _large").select("part", F.lit(0).cast("long").alias("block"), "node", "label").union(
            dealt.where("_large AND _few").select("part", F.explode(spread).alias("block"), "node", "label")
        )
        out = ready if out is None else out.union(ready)
        hot = dealt.where("_large AND NOT _few").select("node", "label", "band", "part")
        if hot.isEmpty():
            return out
        if halves is None:
            crowd = hot.select("node").distinct()
            halves = stage(texts.join(crowd, "node", "left_semi").mapInArrow(_halves, "node long, halves array<long>"), "near-halves")
        # Halves after the two of the part's own band, each used once on the way.
        turns = F.explode(F.sequence(F.lit(used), F.lit(used + TABLES - 1))).alias("t")
        half = F.get("halves", F.pmod(2 * F.col("band") + 2 + F.col("t"), F.lit(number)))
        dealt = hot.join(halves, "node").select("node", "label", "band", "part", "halves", turns).select(
            "node", "label", "band", F.xxhash64("part", "t", half).alias("part")
        )
        used += TABLES


def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per node its shingles (32 bits each) and, if any is repeated, their weights."""
    for whole in batches:
        for batch in slices(whole):
            shingles, weights, counts = weighted_shingles(*hashed_words(strings(batch.column("text"))))
            short = (shingles >> np.uint64(SHINGLE_BITS - 32)).astype(np.uint32)
            ends = np.cumsum(counts)
            cut = [slice(a, b) for a, b in zip((ends - counts).tolist(), ends.tolist())]
            heavy = [weights[c].astype(np.float32).tobytes() if (weights[c] > 1).any() else None for c in cut]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array([short[c].tobytes() for c in cut], pa.binary()), pa.array(heavy, pa.binary())],
                ["node", "shingles", "weights"],
            )


def compared(dealt: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b): in every part and block a spanning forest of the links between its components."""
    wanted = dealt.select("node").distinct()
    data = stage(
        texts.join(wanted, "node", "left_semi").select("node", "text").mapInArrow(_shingled, "node long, shingles binary, weights binary"),
        "near-shingles",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("part", "block", "node", "label", "shingles", "weights")]
            found = []
            for part, block, *row in zip(*columns):
                if (part, block) != key:
                    found += forest(held)
                    key, held = (part, block), []
                held.append(row)
            yield _pairs(found)
        yield _pairs(forest(held))

    keys = ["part", "block"]
    rows = dealt.join(data, "node").select(*keys, "node", "label", "shingles", "weights")
    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a long, b long")


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    low, high = zip(*(sorted(p) for p in found)) if found else ([], [])
    return pa.RecordBatch.from_arrays([pa.array(low, pa.int64()), pa.array(high, pa.int64())], ["a", "b"])


def closeness(sets: list[np.ndarray], roots: list[np.ndarray]) -> np.ndarray:
    """Sums of products of the roots over shared shingles, for all pairs of texts of a part."""
    n = len(sets)
    text = np.repeat(np.arange(n), [len(x) for x in sets])
    shingle = np.concatenate(sets)
    order = np.argsort(shingle, kind="stable")
    text, shingle, root = text[order], shingle[order], np.concatenate(roots)[order].astype(np.float32)
    first = np.flatnonzero(np.r_[True, shingle[1:] != shingle[:-1]])
    times = np.diff(np.r_[first, len(shingle)])
    column, often = np.repeat(np.arange(len(first)), times), np.repeat(times, times)
    out = np.zeros((n, n), np.float32)
    rare = np.flatnonzero(often <= RARE)
    for shift in range(1, RARE):
        if shift >= len(rare):
            break
        same = column[rare[shift:]] == column[rare[:-shift]]
        if not same.any():
            break
        i, j = rare[:-shift][same], rare[shift:][same]
        np.add.at(out, (text[i], text[j]), root[i] * root[j])
    out += out.T
    common = np.flatnonzero(times > RARE)
    step = max(1, CELLS // n)
    for a in range(0, len(common), step):
        some = common[a : a + step]
        place = np.full(len(first), -1)
        place[some] = np.arange(len(some))
        at = place[column]
        matrix = np.zeros((n, len(some)), np.float32)
        matrix[text[at >= 0], at[at >= 0]] = root[at >= 0]
        out += matrix @ matrix.T
    return out


def forest(rows: list[list]) -> list[tuple[int, int]]:
    """Links between the components of one part: rows are [node, label, shingles, weights].

    The sum of roots bounds the probability Jaccard from above; without repeated shingles it gives the plain
    Jaccard. Pairs that pass are compared exactly, unless their components are connected already.
    """
    if len(rows) < 2 or all(r[1] == rows[0][1] for r in rows):
        return []
    sets = [np.frombuffer(r[2], np.uint32) for r in rows]
    weights = [np.ones(len(x)) if r[3] is None else np.frombuffer(r[3], np.float32).astype(float) for x, r in zip(sets, rows)]
    total = np.array([w.sum() for w in weights])
    close = closeness(sets, [np.sqrt(w / t) for w, t in zip(weights, total)])
    plain = np.array([r[3] is None for r in rows])
    component = np.unique([r[1] for r in rows], return_inverse=True)[1]
    out = []
    for i in range(len(rows)):
        bound = close[i].astype(float)
        shared = bound * np.sqrt(total[i] * total)
        bound = np.where(plain & plain[i], shared / np.maximum(total[i] + total - shared, 1e-9), bound)
        bound[component == component[i]] = 0
        while True:
            j = int(bound.argmax())
            if bound[j] < LEAST - ROUNDING:
                break
            if _jaccard(sets[i], weights[i], sets[j], weights[j]) >= LEAST:
                out.append((rows[i][0], rows[j][0]))
                component[component == component[j]] = component[i]
                bound[component == component[i]] = 0
            else:
                bound[j] = 0
    return out


def _jaccard(a: np.ndarray, u: np.ndarray, b: np.ndarray, v: np.ndarray) -> float:
    """As `probability_jaccard`; two shingles of one text may have the same short hash."""
    a, first = np.unique(a, return_index=True)
    b, other = np.unique(b, return_index=True)
    return probability_jaccard((a, u[first]), (b, v[other]))


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after components were joined by further links."""
    for end in ("a", "b"):
        links = links.join(labels.select(F.col("node").alias(end), F.col("label").alias(f"_{end}")), end)
    across = stage(links.where("_a <> _b").select(F.col("_a").alias("a"), F.col("_b").alias("b")).distinct(), "near-across")
    if across.isEmpty():
        return labels
    joined = components(across).select(F.col("node").alias("label"), F.col("label").alias("_new"))
    return stage(labels.join(joined, "label", "left").select("node", F.coalesce("_new", "label").alias("label")), "near-labels")


def _result(signed: DataFrame, leaders: DataFrame, links: DataFrame, labels: DataFrame) -> DataFrame:
    number = links.distinct().select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("links_used"))
    # Only texts of one component with others need to look for its first row.
    first = labels.join(leaders.select("node", "lead"), "node").groupBy("label").agg(F.min("lead").alias("_first"))
    placed = labels.join(first, "label").select("node", "_first")
    named = (
        leaders.select("name", "node", "lead").join(placed, "node", "left").join(number, "node", "left")
        .select("name", F.coalesce("_first", "lead").alias("lead"), F.coalesce("links_used", F.lit(0)).cast("long").alias("links_used"))
    )
    out = signed.where("doc_id IS NOT NULL").select("doc_id", "content", "name").join(named, "name")
    nameless = signed.where("doc_id IS NULL").select(
        "doc_id", "content", F.lit(None).cast("struct<doc_id:bigint,content:bigint>").alias("lead"), F.lit(0).cast("long").alias("links_used")
    )
    return out.select("doc_id", "content", "lead", "links_used").unionByName(nameless)


def one_of_each(docs: DataFrame) -> DataFrame:
    """`docs` with one row of each class: the first by doc_id and text hash. Rows without doc_id stay.

    Of rows alike in doc_id and text the one with the least hash of its other columns stays. Different
    texts of one doc_id are documents each.
    """
    lead = grouped(docs).where("doc_id = lead.doc_id AND content = lead.content")
    key, hashed, turn = (unused(docs, name) for name in ("key", "content", "turn"))
    lead = lead.select(F.col("doc_id").alias(key), F.col("content").alias(hashed)).distinct()
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    order = Window.partitionBy(key, hashed).orderBy(F.xxhash64(F.to_json(F.struct(F.lit(0).alias("_"), *others))))
    named = docs.where("doc_id IS NOT NULL").withColumns({key: F.col("doc_id").cast("long"), hashed: content(F.col("text"))})
    kept = named.join(lead, [key, hashed], "left_semi").withColumn(turn, F.row_number().over(order)).where(F.col(turn) == 1)
    return kept.select(*(f"`{c}`" for c in docs.columns)).unionByName(docs.where("doc_id IS NULL"))
