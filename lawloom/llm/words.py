"""Hashed words of whole texts, flat over a batch, for the operators on word n-grams.

A word is a run of letters and digits in lower case; everything else parts words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from lawloom.llm.common import mix


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of the texts (strings without nulls), and each text's number of words."""
    plain = pc.replace_substring_regex(pc.utf8_lower(texts), r"[^\p{L}\p{N}]+", " ")
    lists = pc.split_pattern(plain, " ")
    if not len(lists):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    owner_ends = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    owner_ends -= owner_ends[0]
    coded = lists.flatten().dictionary_encode()
    words = coded.dictionary.to_pylist()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))
    full = np.fromiter(map(bool, words), bool, len(words))
    index = coded.indices.to_numpy(zero_copy_only=False)
    keep = full[index]
    kept = np.r_[0, np.cumsum(keep)]
    return hashes[index[keep]], np.diff(kept[owner_ends])


def ngrams(words: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all n-grams within texts, each one's text, and its place there.

    A text of 1 to n - 1 words has one n-gram: all its words.
    """
    if not len(words):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.cumsum(counts) - counts
    sizes = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    owner = np.repeat(np.arange(len(counts)), sizes)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = starts[owner] + place
    out = np.zeros(len(owner), np.uint64)
    padded = np.concatenate([words, np.zeros(n, np.uint64)])
    ends = (starts + counts)[owner]
    for k in range(n):
        word = np.where(at + k < ends, padded[at + k], np.uint64(0))
        out = mix(out * np.uint64(31) + word)
    return out, owner, place
