"""Token ids of whole texts with a public tokenizer file, word by word through bounded caches.

The tokenizer used here (`word_bpe_49k.json`) turns white space into word breaks and never merges
across it, so a text's ids are those of its pieces between spaces and line ends, one after another.
Pieces repeat: each is encoded once and its ids are looked up afterwards. White space other than
space and line end stays inside a piece, where the tokenizer itself deals with it.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable

import numpy as np
from tokenizers import Tokenizer, pre_tokenizers

#: Entries kept by one cache of a Python worker (under 100 MB); beyond it the older half goes.
CACHE_PIECES = 500_000
#: Fixed value: the vocabulary's mark of a word's last token.
WORD_END = "</w>"
WORDS_A_LINE = 200
#: Fixed value: code points below this are stable under NFC and have a lower case of their own
#: that does not depend on their neighbours, but for the one letter below.
SIMPLE_BELOW = "̀"
DOTTED_I = "İ"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [b for b in range(256) if chr(b).isprintable() and chr(b) != " " and b != 0xAD]
    table = {b: chr(b) for b in plain}
    table |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in table)}
    return table


LETTERS = byte_letters()


def as_letters(word: str) -> str:
    """A normalised word as byte letters, the alphabet of the vocabulary."""
    return word if word.isascii() else word.encode().decode("latin-1").translate(LETTERS)


#: Fixed value: marks that the tokenizer's pattern keeps together in one word. The apostrophe is
#: not among them, since it may begin a contraction.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def simple_words(piece: str) -> tuple[str, ...] | None:
    """A piece's normalised words when they are plain: letters, marks, or letters with marks after.

    None for any other piece: its normalising and splitting are left to the tokenizer.
    """
    core = piece.rstrip(MARKS)
    tail = piece[len(core) :]
    if not core:
        return (tail,) if tail else ()
    if not core.isalpha() or not (core.isascii() or (max(core) < SIMPLE_BELOW and DOTTED_I not in core)):
        return None
    core = as_letters(core.lower())
    return (core, tail) if tail else (core,)


class PieceCache:
    """Values of pieces: looked up, or made for all missing ones of a batch at once.

    Two halves: when the newer one is full it becomes the older one, from which pieces that are
    wanted again are taken over.
    """

    def __init__(self, make: Callable[[list[str]], list], most: int = CACHE_PIECES):
        self.make, self.most = make, most
        self.new: dict = {}
        self.old: dict = {}

    def table(self, wanted: set[str]) -> dict:
        """A table that has every wanted piece."""
        missing = wanted.difference(self.new)
        if missing and len(self.new) + len(missing) > self.most // 2:
            self.old, self.new, missing = self.new, {}, wanted
        again = [p for p in missing if p in self.old]
        self.new.update(zip(again, map(self.old.get, again)))
        rest = list(missing.difference(again))
        self.new.update(zip(rest, self.make(rest)))
        return self.new


class Encoder:
    """Ids of texts as the tokenizers library gives them (no special tokens added)."""

    def __init__(self, path: str, ordinary_specials: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share the cores already
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = ordinary_specials
        # The same model over words that are already split and normalised.
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocab = self.tokenizer.get_vocab()
        self.dtype = np.dtype(np.uint16 if max(vocab.values()) < 1 << 16 else np.uint32)
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for token, i in vocab.items() if token.endswith(WORD_END)]] = True
        self.words = PieceCache(self.encode_words)
        self.pieces = PieceCache(self.encode_pieces)

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of words; the last token of each carries the mark of a word's end, and only that one."""
        lines = [" ".join(words[i : i + WORDS_A_LINE]) for i in range(0, len(words), WORDS_A_LINE)]
        got = [np.array(e.ids, self.dtype) for e in self.plain.encode_batch_fast(lines, add_special_tokens=False)]
        ids = np.concatenate([*got, np.empty(0, self.dtype)])
        cuts = ((np.flatnonzero(self.ends[ids]) + 1) * self.dtype.itemsize).tolist()
        if len(cuts) != len(words):
            raise ValueError("the tokenizer split a word that was split already")
        blob = ids.tobytes()
        return [blob[a:b] for a, b in zip([0, *cuts], cuts)]

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        split = list(map(simple_words, pieces))
        ids = self.words.table({w for s in split if s for w in s})
        odd = [p for p, s in zip(pieces, split) if s is None]
        rest = iter(self.tokenizer.encode_batch_fast(odd, add_special_tokens=False))
        return [
            np.array(next(rest).ids, self.dtype).tobytes() if s is None
            else ids[s[0]] if len(s) == 1 else b"".join([ids[w] for w in s])
            for s in split
        ]

    def encode(self, texts: Iterable[str | None], end: int | None = None) -> list[bytes]:
        """Each text's ids as bytes of `dtype`; with `end`, that id after each text. Null is empty."""
        tail = b"" if end is None else np.array([end], self.dtype).tobytes()
        texts = [pieces_of(t) for t in texts]
        ids = self.pieces.table(set().union(*texts)).__getitem__
        return [b"".join(map(ids, pieces)) + tail for pieces in texts]


def pieces_of(text: str | None) -> list[str]:
    return text.replace("\n", " ").split(" ") if text else []


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, ordinary_specials: bool = False) -> Encoder:
    """This worker's encoder: one per tokenizer file, kept with its cache between tasks."""
    key = (path, ordinary_specials)
    if key not in _encoders:
        _encoders[key] = Encoder(path, ordinary_specials)
    return _encoders[key]
