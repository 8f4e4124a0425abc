"""Operator 5: language-model scoring by cross-entropy difference.

A target model (documents labelled good) and a background model (all documents) are bigram models over
one vocabulary, the tokenizer's, with the same smoothing; the background's counts are scaled to the
target's number of tokens, so that smoothing weighs alike in both. A document's score is the mean over
its tokens of (target loss - background loss): the lower, the more like the target.

Texts are encoded once, into a written table of token ids; both passes read that, and neither moves it for the
labels, which are joined to row numbers. Its rows are dealt into
blocks by a row number, so rows of one doc_id lie in many blocks. Each block counts its distinct bigrams; counts
are summed per bigram over all blocks by a shuffle, and each block gets back the sums of just its own bigrams, with which it scores its documents. So no model is held whole anywhere: a task holds one block's
tokens and bigrams. Only counts per token of the vocabulary are broadcast. All documents and all labels are
counted.

Null and empty texts have no tokens, and null scores. A doc_id with contradicting labels is not target, nor is a
row without doc_id. Repeated rows are scored and counted each. Without target documents both models are the
background and all scores are 0. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lawloom.llm.common import bound_batches, offsets_of, slices, stage, strings
from lawloom.llm.vocab import default_path, encoder

#: Tokens of a block, about.
BLOCK_TOKENS = 4 << 20
#: Weight of the unigram model in each context, and added to each token's count there.
CONTEXT_WEIGHT = 20.0
TOKEN_WEIGHT = 0.1

COUNTS = "block long, pair long, n_all long, n_target long"
SCORES = "doc_id long, n_tokens long, target_loss double, background_loss double, difference double"


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and token ids (bytes of the encoder's type) of every text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, ordinary_specials=True)
        for whole in batches:
            for batch in slices(whole):
                ids = enc.encode(strings(batch.column("text")).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids binary")


def bigrams(ids: pa.ChunkedArray, dtype: np.dtype, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (token before, token) of texts as numbers to `base`, and each text's number of tokens.

    The first token of a text has base - 1 before it.
    """
    column = ids.combine_chunks()
    counts = np.diff(offsets_of(column)).astype(np.int64) // dtype.itemsize
    flat = np.frombuffer(b"".join(column.to_pylist()), dtype).astype(np.int64)
    before = np.r_[base - 1, flat[:-1]] if len(flat) else flat
    before[(np.cumsum(counts) - counts)[counts > 0]] = base - 1
    return before * base + flat, counts


def score(docs: DataFrame, labels: DataFrame, path: str | None = None) -> DataFrame:
    """Per row: doc_id, n_tokens, target_loss, background_loss, difference (nats a token)."""
    path = path or default_path()
    spark = docs.sparkSession
    bound_batches(spark)
    enc = encoder(path, ordinary_specials=True)
    dtype, base = enc.dtype, len(enc.ends) + 1
    good = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("key"))
        .agg(F.min("quality").alias("quality")).where("quality = 1").select("key", F.lit(True).alias("hit"))
    )
    rows = stage(encoded(docs, path).withColumn("row", F.monotonically_increasing_id()), "lm-ids")
    size = rows.agg(F.sum(F.octet_length("ids"))).first()[0] or 0
    blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // (BLOCK_TOKENS * dtype.itemsize)))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
    # Labels meet row numbers, not tokens: those of a block's target rows come to it beside its texts.
    named = dealt.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("key"), F.col("block").alias("at"), F.col("row").alias("target"))
    wanted = named.join(good, "key").select("at", "target")

    def count(texts: pa.Table, hits: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return pa.table({c: pa.array([], pa.int64()) for c in ("block", "pair", "n_all", "n_target")})
        pairs, counts = bigrams(texts.column("ids"), dtype, base)
        target = np.repeat(np.isin(texts.column("row").to_numpy(), hits.column("target").to_numpy()), counts)
        seen, at = np.unique(pairs, return_inverse=True)
        n_all = np.bincount(at, minlength=len(seen))
        n_target = np.bincount(at[target], minlength=len(seen))
        return pa.table({"block": np.full(len(seen), texts.column("block")[0].as_py()), "pair": seen, "n_all": n_all, "n_target": n_target})

    told = dealt.select("block", "row", "ids").groupBy("block").cogroup(wanted.groupBy("at"))
    counted = stage(told.applyInArrow(count, COUNTS), "lm-counts")
    # At most one row per token of the vocabulary, and one for the start.
    of_token, of_context = np.zeros((2, base)), np.zeros((2, base))
    for name, table in (("pair % {}", of_token), ("pair div {}", of_context)):
        got = counted.groupBy(F.expr(name.format(base)).alias("token")).agg(
            F.sum("n_all").alias("n_all"), F.sum("n_target").alias("n_target")
        ).toArrow()
        table[0][got.column("token").to_numpy()] = got.column("n_all").to_numpy()
        table[1][got.column("token").to_numpy()] = got.column("n_target").to_numpy()
    if not of_token[1].any():
        of_token[1], of_context[1], use_all = of_token[0], of_context[0], True
    else:
        use_all = False
    scale = np.array([of_token[1].sum() / max(of_token[0].sum(), 1), 1.0])[:, None]
    single = of_token * scale + TOKEN_WEIGHT
    single /= single.sum(axis=1, keepdims=True)
    shared = spark.sparkContext.broadcast((single, of_context * scale, scale, use_all))
    # One shuffle for sums and rows alike; a pair has a row for each block at most.
    each = Window.partitionBy("pair")
    sums = counted.select(
        "block", "pair", F.sum("n_all").over(each).alias("n_all"), F.sum("n_target").over(each).alias("n_target")
    )

    def judge(texts: pa.Table, own: pa.Table) -> pa.Table:
        single, contexts, scale, use_all = shared.value
        pairs, counts = bigrams(texts.column("ids"), dtype, base)
        keys = own.column("pair").to_numpy()
        order = np.argsort(keys)
        at = order[np.searchsorted(keys, pairs, sorter=order)] if len(pairs) else np.zeros(0, np.int64)
        owner = np.repeat(np.arange(len(counts)), counts)
        loss = []
        for k, name in enumerate(("n_all", "n_all" if use_all else "n_target")):
            n = own.column(name).to_numpy()[at] * scale[k, 0]
            p = (n + CONTEXT_WEIGHT * single[k][pairs % base]) / (contexts[k][pairs // base] + CONTEXT_WEIGHT)
            mean = np.bincount(owner, -np.log(p), minlength=len(counts)) / np.maximum(counts, 1)
            loss.append(pa.array(mean, mask=counts == 0))
        difference = pa.array(
            np.asarray(loss[1].fill_null(0.0)) - np.asarray(loss[0].fill_null(0.0)), mask=counts == 0
        )
        return pa.table(
            {"doc_id": texts.column("doc_id"), "n_tokens": counts, "target_loss": loss[1], "background_loss": loss[0],
             "difference": difference}
        )

    return dealt.select("block", "doc_id", "ids").groupBy("block").cogroup(sums.groupBy("block")).applyInArrow(judge, SCORES)
