"""Operator 4: BPE encoding and decoding by batched merge rounds in numpy.

The words of many texts lie in one flat array of symbols. A round looks up the rank of every pair of
neighbours by binary search over the sorted pair keys, finds each word's lowest rank, and merges all
its places at once (in a run of equal symbols every second one, from the left). Words with no pair
left drop out. A word is merged once; texts are put together from the words' results, kept in a
bounded cache per Python worker.

Nulls and empty texts have no ids and decode to "". Text that spells a special token becomes that
token, as the tokenizers library does with default settings. Extra columns of the input are ignored
by the digest and kept by `encode_column`; repeated rows and ties are encoded like any other row.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from lawloom.llm.common import bound_batches, slices, strings
from lawloom.llm.vocab import WORD_END, PieceCache, as_letters, default_path, pieces_of, simple_words

#: Entries of each cache here: their values are texts, larger than plain ids.
CACHE_PIECES = 250_000
NO_RANK = np.iinfo(np.int32).max


class Merges:
    """Merge rules of a tokenizer file as arrays: sorted pair keys, their ranks and what they give."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*self.vocab.values(), *self.special.values()]) + 1
        self.tokens = [""] * size
        for token, i in [*self.vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        self.size = size
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        keys = np.array([self.vocab[a] * size + self.vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.results = np.array([self.vocab[a + b] for a, b in pairs], np.int64)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK)

    def symbols(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """First symbols of words of byte letters, flat, and each word's number of symbols."""
        flat = [self.vocab[c] for w in words for c in w]
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.array(flat, np.int64)
        last = np.cumsum(lengths) - 1
        flat[last] = [self.vocab[w[-1] + WORD_END] for w in words]
        return flat, lengths

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of non-empty words."""
        out: list[list[int]] = [[] for _ in words]
        if not words:
            return out
        flat, lengths = self.symbols(words)
        owner = np.repeat(np.arange(len(words)), lengths)
        while len(flat):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            ends = np.r_[starts[1:], len(owner)]
            rank = np.full(len(flat), NO_RANK, np.int32)  # of the pair that begins here
            rank[:-1] = self.rank_of(flat[:-1], flat[1:])
            rank[ends - 1] = NO_RANK
            least = np.minimum.reduceat(rank, starts)
            done = least == NO_RANK
            if done.any():
                for a, b in zip(starts[done].tolist(), ends[done].tolist()):
                    out[owner[a]] = flat[a:b].tolist()
                keep = np.repeat(~done, ends - starts)
                flat, owner, rank = flat[keep], owner[keep], rank[keep]
                if not len(flat):
                    break
                lengths = (ends - starts)[~done]
                least = least[~done]
            else:
                lengths = ends - starts
            hit = rank == np.repeat(least, lengths)
            # Overlapping places, as in "aaa": from the left, every second one of a run.
            begins = hit & ~np.r_[False, hit[:-1]]
            place = np.arange(len(flat))
            first = np.maximum.accumulate(np.where(begins, place, 0))
            hit &= (place - first) % 2 == 0
            flat = flat.copy()
            flat[hit] = self.results[rank[hit]]
            keep = ~np.r_[False, hit[:-1]]
            flat, owner = flat[keep], owner[keep]
        return out


class Codec:
    """Encoding and decoding of whole texts."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.merges = Merges(path)
        # Only its normalising and splitting into words are used, for pieces that are not plain.
        whole = Tokenizer.from_file(path)
        self.normalise = whole.normalizer.normalize_str
        self.split = whole.pre_tokenizer.pre_tokenize_str
        self.marked = re.compile("(" + "|".join(map(re.escape, self.merges.special)) + ")")
        self.words = PieceCache(lambda words: list(map(tuple, self.merges.encode_words(words))), CACHE_PIECES)
        self.pieces = PieceCache(self.encode_pieces, CACHE_PIECES)

    def odd_words(self, piece: str) -> list[str | int]:
        """Words of any piece, and ids of the special tokens in it."""
        out: list[str | int] = []
        for part in self.marked.split(piece):
            if part in self.merges.special:
                out.append(self.merges.special[part])
            elif part:
                out += [word for word, _ in self.split(self.normalise(part)) if word]
        return out

    def encode_pieces(self, pieces: list[str]) -> list[tuple[int, str, str]]:
        """Of each piece: number of ids, the ids as text, the decoded text (both with a space before)."""
        split = [words if (words := simple_words(p)) is not None else self.odd_words(p) for p in pieces]
        ids_of = self.words.table({w for s in split for w in s if isinstance(w, str)})
        out = []
        for words in split:
            ids = [i for w in words for i in ((w,) if isinstance(w, int) else ids_of[w])]
            out.append((len(ids), "".join([f" {i}" for i in ids]), "".join([" " + self.merges.tokens[i] for i in ids])))
        return out

    def encode(self, texts: list[str | None]) -> Iterator[tuple[int, str, str]]:
        """Of each text: number of ids, ids in decimal joined by a space, decoded text."""
        texts = [pieces_of(t) for t in texts]
        values = self.pieces.table(set().union(*texts))
        for pieces in texts:
            got = [values[p] for p in pieces]
            yield sum([g[0] for g in got]), "".join([g[1] for g in got])[1:], "".join([g[2] for g in got])[1:]

    def decode(self, ids: list[int]) -> str:
        """What the tokenizer's decode(ids, skip_special_tokens=False) gives: tokens joined by a space."""
        return " ".join([self.merges.tokens[i] for i in ids])


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """This worker's codec: one per tokenizer file, kept with its cache between tasks."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def encode_column(docs: DataFrame, path: str | None = None) -> DataFrame:
    """`docs` with its columns and `ids` (array of int) and `decoded` after them (columns of these names are replaced)."""
    path = path or default_path()
    docs = docs.drop("ids", "decoded")
    bound_batches(docs.sparkSession)
    added = [StructField("ids", ArrayType(IntegerType())), StructField("decoded", StringType())]
    schema = StructType([*docs.schema, *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                ids, decoded = [], []
                for _, numbers, text in codec(path).encode(batch.column("text").to_pylist()):
                    ids.append(np.array(numbers.split(), np.int32))
                    decoded.append(text)
                columns = [*batch.columns, pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "ids", "decoded"])

    return docs.mapInArrow(run, schema)


def encode_digest(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, n_tokens, ids_sha256, decoded_sha256."""
    path = path or default_path()
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                rows = [
                    (n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
                    for n, ids, text in codec(path).encode(strings(batch.column("text")).to_pylist())
                ]
                n, ids, text = zip(*rows)
                columns = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids), pa.array(text)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    docs = docs.select("doc_id", "text")
    return docs.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
