"""Operator 13: grouping spelling variants by a trie of frequency vectors.

A word's vector is its length and, for each of 16 groups of letters, how many of its code points fall into
the group. One inserted, deleted or replaced code point changes a vector by at most one more in one group
(surplus) and one less in one group (deficit). Words stand in a trie by successive entries of their vectors;
a depth-first search goes down with all words that look for partners there, each with a surplus and a
deficit of one to spend. Words that meet in a leaf are verified letter by letter. Of two words the later one
seeks: the longer, or of equally long ones that with the greater vector, then in code-point order.

The top of the trie deals words to tasks: a part is a node at a depth chosen so that the fullest holds at
most PART_WORDS words (the depth only deals work out; results are the same at every depth). If even whole
vectors are shared by more words, such a part is split into blocks and its searchers go to each. A word
searches the parts it can reach with its budget, so each near pair is found once, in the task of one of the two.
Tasks give no pairs: per word they give how many near words were found and the best of them.

Words are counted in each task first, then by a shuffle. Null texts have no words. The runs of rows without
doc_id are never altered. Repeated rows are counted each. Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lawloom.llm.common import bound_batches, mix, slices, stage

RUN = re.compile("[A-Za-zÀ-ÿ]+")
SHORTEST, LEAST_N = 7, 2
#: Words of SHORTEST letters and more that are one edit apart share so many letters at one end at least.
ENDS = (SHORTEST - 1) // 2
#: One of so many (document, run) pairs loses a letter.
ALTERED = 31
#: A word's form is at least so many times as frequent.
FORM_TIMES = 10
#: Letter groups: code point modulo 16, in the order in which the trie looks at them.
GROUPS = 16
ORDER = (5, 1, 9, 2, 4, 3, 14, 15, 12, 13, 0, 7, 8, 6, 11, 10)
MOST_IN_A_BYTE = 100
#: Candidates that are verified at once.
VERIFIED = 1 << 18
#: Depths of the trie's top that are tried, and words of a part at most.
DEPTHS = (0, 2, 4, 6, 8, 12, 16)
PART_WORDS = 60_000
#: Words of a trie node that are compared at once.
LEAF = 24
#: Cells of letters, or of vectors, that are compared at once.
CELLS = 1 << 21
#: Distinct words a task holds while it counts.
HELD_WORDS = 300_000


def altered(run: bytes, seed: int | None) -> bytes:
    """A lower-cased run (Latin-1) as it stands in a document; `seed` is the checksum of `<doc_id>:`."""
    if seed is not None:
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
        if h % ALTERED == 0:
            at = h % len(run)
            return run[:at] + run[at + 1 :]
    return run


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter[bytes] = Counter()

    def given() -> pa.RecordBatch:
        words = [w.decode("latin-1") for w in held]
        out = pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
        held.clear()
        return out

    for whole in batches:
        for batch in slices(whole):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                runs = RUN.findall(text or "")
                if not runs:
                    continue
                # Bytes are lower-cased in A-Z only.
                found = Counter("\n".join(runs).encode("latin-1").lower().split(b"\n"))
                seed = None if doc_id is None else zlib.crc32(b"%d:" % doc_id)
                for run, n in found.items():
                    if len(run) >= SHORTEST:
                        word = altered(run, seed)
                        if len(word) >= SHORTEST:
                            held[word] += n
            if len(held) > HELD_WORDS:
                yield given()
    yield given()


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n) of all words that are long and frequent enough."""
    bound_batches(docs.sparkSession)
    counted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_N)


class Words:
    """Words of a batch as flat Latin-1 codes, with their vectors."""

    def __init__(self, column: pa.Array):
        self.codes = np.frombuffer("".join(column.to_pylist()).encode("latin-1"), np.uint8)
        self.lengths = pc.utf8_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        owner = np.repeat(np.arange(len(self.lengths)), self.lengths)
        place = np.empty(GROUPS, np.int64)
        place[list(ORDER)] = np.arange(GROUPS)
        cells = owner * GROUPS + place[self.codes % GROUPS]
        counts = np.bincount(cells, minlength=len(self.lengths) * GROUPS).reshape(-1, GROUPS)
        self.vectors = np.column_stack([self.lengths, counts]).astype(np.int32)

    def ends(self) -> tuple[np.ndarray, np.ndarray]:
        """The first and the last ENDS letters of every word, as numbers. Words have at least so many."""
        step = np.arange(ENDS)
        weight = 256**step
        last = (self.starts + self.lengths)[:, None] - 1 - step
        return self.codes[self.starts[:, None] + step] @ weight, self.codes[last] @ weight

    def columns(self, rows: slice | np.ndarray) -> list[np.ndarray]:
        """The vectors of some words by columns: lengths, then counts, in one byte each where all counts allow it."""
        some = self.vectors[rows]
        kind = np.int8 if self.vectors[:, 1:].max(initial=0) <= MOST_IN_A_BYTE else np.int32
        return [np.ascontiguousarray(some[:, 0]), *np.ascontiguousarray(some[:, 1:].T).astype(kind)]


def node_key(top: np.ndarray) -> np.ndarray:
    """A 64-bit name of trie nodes, given as rows of vector entries."""
    key = np.full(len(top), top.shape[1], np.uint64)
    for column in top.T:
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + column.astype(np.uint64))
    return key.view(np.int64)


def reachable(top: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parts a word searches: (row, part key), each once.

    A letter less in one group of the top or below it, for shorter words; for equally long ones nothing
    changed in the top, a letter less in it (the new one falls below the top), or moved to a later group.
    """
    depth = top.shape[1] - 1
    rows, keys = [], []

    def add(which: np.ndarray, changed: np.ndarray) -> None:
        rows.append(which)
        keys.append(node_key(changed))

    every = np.arange(len(top))
    for shorter in (0, 1):
        base = top.copy()
        base[:, 0] -= shorter
        add(every, base)
        for i in range(1, depth + 1):
            some = np.flatnonzero(top[:, i] > 0)
            less = base[some]
            less[:, i] -= 1
            add(some, less)
            if not shorter:
                for j in range(i + 1, depth + 1):
                    moved = less.copy()
                    moved[:, j] += 1
                    add(some, moved)
    row, key = np.concatenate(rows), np.concatenate(keys)
    order = np.lexsort((key, row))
    row, key = row[order], key[order]
    first = np.r_[True, (row[1:] != row[:-1]) | (key[1:] != key[:-1])] if len(row) else np.zeros(0, bool)
    return row[first], key[first]


def candidates(homes: np.ndarray, seekers: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(seeker, home) pairs whose vectors a single edit can have made, the seeker being the later of the two.

    Both are given by columns, homes in lexicographic order, so a trie node is a range of them. The search is
    depth first; a node is visited once, with all seekers that can still afford it. Of a shorter home a seeker
    has one letter more and none less. Of an equally long one it has one more in some group and one less in a
    later group, or as many in all.
    """
    columns = len(homes)
    length = seekers[0]
    everyone = np.arange(len(length))
    stack = []
    lengths = np.flatnonzero(np.r_[True, homes[0][1:] != homes[0][:-1], True])
    for low, high in zip(lengths[:-1].tolist(), lengths[1:].tolist()):
        for shorter in (False, True):
            who = everyone[length == homes[0][low] + shorter]
            # Nothing spent yet; a deficit may be spent after the surplus only, of a shorter home never.
            stack.append((low, high, 1, who, np.zeros(len(who), bool), np.full(len(who), shorter)))
    while stack:
        low, high, depth, who, over, under = stack.pop()
        if not len(who):
            continue
        if high - low <= LEAF or depth == columns:
            step = max(1, CELLS // (high - low))
            for a in range(0, len(who), step):
                some, spent, barred = who[a : a + step], over[a : a + step, None], under[a : a + step, None]
                fits = np.ones((len(some), high - low), bool)
                plus, minus = np.broadcast_to(spent, fits.shape).copy(), np.broadcast_to(barred, fits.shape).copy()
                for column in range(depth, columns):
                    apart = seekers[column][some][:, None] - homes[column][None, low:high]
                    more, less = apart == 1, apart == -1
                    fits &= (apart == 0) | (more & ~plus) | (less & plus & ~minus)
                    plus |= more
                    minus |= less
                i, j = np.nonzero(fits)
                if len(i):
                    yield some[i], low + j
            continue
        column = homes[depth][low:high]
        cuts = np.flatnonzero(np.r_[True, column[1:] != column[:-1], True]).tolist()
        mine = seekers[depth][who]
        for a, b in zip(cuts[:-1], cuts[1:]):
            apart = mine - column[a]
            more, less = apart == 1, apart == -1
            keep = np.flatnonzero((apart == 0) | (more & ~over) | (less & over & ~under))
            if len(keep):
                stack.append((low + a, low + b, depth + 1, who[keep], (over | more)[keep], (under | less)[keep]))


def gathered(pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs in batches of about VERIFIED."""
    held, number = [], 0
    for pair in pairs:
        held.append(pair)
        number += len(pair[0])
        if number >= VERIFIED:
            yield tuple(map(np.concatenate, zip(*held)))
            held, number = [], 0
    if held:
        yield tuple(map(np.concatenate, zip(*held)))


def one_edit(words: Words, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the words a and b (different ones, lengths at most one apart) are one edit from each other.

    They are if what they share at the head and at the tail together covers all but one code point.
    """
    near = np.zeros(len(a), bool)
    longest = np.maximum(words.lengths[a], words.lengths[b])
    order = np.argsort(longest, kind="stable")
    at = 0
    while at < len(order):
        # As many pairs as fit the cells at the width of their last one.
        size = max(1, CELLS // max(1, int(longest[order[at]])))
        some = order[at : at + size]
        while len(some) > 1 and int(longest[some[-1]]) * len(some) > 2 * CELLS:
            some = some[: (len(some) + 1) // 2]
        at += len(some)
        x, y = a[some], b[some]
        n, m = words.lengths[x], words.lengths[y]
        shorter = np.minimum(n, m)
        step = np.arange(int(longest[some[-1]]))
        inside = step < shorter[:, None]
        shared = np.zeros(len(some), np.int64)
        for tail in (False, True):
            p, q = (words.starts[x] + n - 1, words.starts[y] + m - 1) if tail else (words.starts[x], words.starts[y])
            move = -step if tail else step
            last = len(words.codes) - 1
            same = words.codes[np.clip(p[:, None] + move, 0, last)] == words.codes[np.clip(q[:, None] + move, 0, last)]
            shared += np.logical_and.accumulate(same & inside, axis=1).sum(axis=1)
        near[some] = shared >= longest[some] - 1
    return near


def _search(homes: pa.Table, seekers: pa.Table) -> pa.Table:
    empty = pa.table({"word": pa.array([], pa.string()), "n_near": pa.array([], pa.int64()), "best_n": pa.array([], pa.int64()), "best": pa.array([], pa.string())})
    if not homes.num_rows or not seekers.num_rows:
        return empty
    text = pa.concat_arrays([homes.column("word").combine_chunks(), seekers.column("word").combine_chunks()])
    n = np.r_[homes.column("n").to_numpy(), seekers.column("n").to_numpy()]
    words, number = Words(text), homes.num_rows
    by_word = pc.rank(text, tiebreaker="dense").to_numpy().astype(np.int64)
    sorted_homes = np.lexsort(words.vectors[:number].T[::-1])
    head, tail = words.ends()
    ends, others = [], []
    for who, where in gathered(candidates(words.columns(sorted_homes), words.columns(slice(number, None)))):
        a, b = who + number, sorted_homes[where]
        likely = (head[a] == head[b]) | (tail[a] == tail[b])
        a, b = a[likely], b[likely]
        # Of two words with one vector the later one seeks.
        right = (by_word[a] > by_word[b]) | (words.vectors[a] != words.vectors[b]).any(axis=1)
        a, b = a[right], b[right]
        near = one_edit(words, a, b)
        ends.append(np.r_[a[near], b[near]])
        others.append(np.r_[b[near], a[near]])
    if not ends:
        return empty
    end, other = np.concatenate(ends), np.concatenate(others)
    # A word may stand here as a home and as a seeker.
    order = np.lexsort((by_word[other], -n[other], by_word[end]))
    end, other = end[order], other[order]
    first = np.flatnonzero(np.r_[True, by_word[end[1:]] != by_word[end[:-1]]]) if len(end) else np.zeros(0, np.int64)
    return pa.table(
        {"word": text.take(pa.array(end[first])), "n_near": np.diff(np.r_[first, len(end)]),
         "best_n": n[other[first]], "best": text.take(pa.array(other[first]))}
    )


def chosen_depth(words: DataFrame) -> int:
    """The least depth at which no node of the trie holds more than PART_WORDS words (else the deepest)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = Words(batch.column("word")).vectors
            for depth in DEPTHS:
                key, n = np.unique(node_key(vectors[:, : depth + 1]), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(key), depth, np.int32)), pa.array(key), pa.array(n)], ["depth", "part", "n"]
                )

    sizes = words.select("word").mapInArrow(run, "depth int, part long, n long").groupBy("depth", "part").agg(F.sum("n").alias("n"))
    fullest = {r["depth"]: r["n"] for r in sizes.groupBy("depth").agg(F.max("n").alias("n")).collect()}
    return next((d for d in DEPTHS if fullest.get(d, 0) <= PART_WORDS), DEPTHS[-1])


def near_words(words: DataFrame, depth: int | None = None) -> DataFrame:
    """(word, n_near, best, best_n) of words that have near ones; `words` has distinct words and their n."""
    bound_batches(words.sparkSession)
    depth = chosen_depth(words) if depth is None else depth

    def at_home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = node_key(Words(batch.column("word")).vectors[:, : depth + 1])
            yield pa.RecordBatch.from_arrays([pa.array(key), batch.column("word"), batch.column("n")], ["part", "word", "n"])

    def seeking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, key = reachable(Words(batch.column("word")).vectors[:, : depth + 1])
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key), batch.column("word").take(at), batch.column("n").take(at)], ["part", "word", "n"]
            )

    rows = words.select("word", "n")
    homes = rows.mapInArrow(at_home, "part long, word string, n long")
    # At most one in PART_WORDS words names such a part; none unless whole vectors are shared by so many.
    crowded = (
        homes.groupBy("part").agg(F.count("*").alias("n")).where(F.col("n") > PART_WORDS)
        .select("part", F.ceil(F.col("n") / PART_WORDS).alias("_blocks"))
    )
    crowded = stage(crowded, "spelling-crowded")
    blocks = F.coalesce("_blocks", F.lit(1))
    homes = homes.join(crowded, "part", "left").select("part", F.pmod(F.xxhash64("word"), blocks).alias("block"), "word", "n")
    seekers = (
        rows.mapInArrow(seeking, "part long, word string, n long").join(crowded, "part", "left")
        .select("part", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("block"), "word", "n")
    )
    keys = ["part", "block"]
    found = homes.groupBy(*keys).cogroup(seekers.groupBy(*keys)).applyInArrow(
        _search, "word string, n_near long, best_n long, best string"
    )
    best = F.min(F.struct((-F.col("best_n")).alias("m"), "best"))
    return (
        found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("_b"))
        .select("word", "n_near", F.col("_b.best").alias("best"), (-F.col("_b.m")).alias("best_n"))
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): forms followed to the last one, twice as far in every round.

    A form is at least FORM_TIMES as frequent as its word, so chains are short and have no rings.
    """
    known = stage(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = known.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        known = stage(
            known.select("word", "root").join(further, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")),
            "spelling-roots",
        )
        if known.where("_moved").isEmpty():
            return known.select("word", "root")
        known = known.select("word", "root")


def variants(docs: DataFrame) -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n."""
    words = stage(vocabulary(docs), "spelling-words")
    joined = words.join(near_words(words), "word", "left")
    has = F.col("best_n") >= FORM_TIMES * F.col("n")
    formed = stage(
        joined.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(has, F.col("best")).alias("form"), F.when(has, F.col("best_n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    last = roots(formed.where("form IS NOT NULL"))
    return formed.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


#: The same by deleted letters: words one edit apart agree when the letter in question is taken out.
ORACLE = """
WITH RECURSIVE crc AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i::UBIGINT, list_transform(range(8), lambda k: k::UBIGINT)),
                          lambda v, k: CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END) AS v
    FROM range(256) r(i))
), runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY 1, 2
), hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295::UBIGINT, flatten(list_transform(
           string_split(doc_id::VARCHAR || ':' || run, ''),
           lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::UBIGINT] ELSE [195::UBIGINT, (unicode(c) - 64)::UBIGINT] END))),
         lambda v, b: xor(v >> 8, t[(xor(v, b) & 255)::BIGINT + 1])), 4294967295::UBIGINT) AS h
  FROM runs, crc
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN run[1:(h % length(run))::BIGINT] || run[(h % length(run))::BIGINT + 2:] ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= 7 GROUP BY 1 HAVING sum(n) >= 2
), cut AS (
  SELECT word, n, i, word[1:i - 1] || word[i + 1:] AS less FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.i = b.i AND a.less = b.less AND a.word <> b.word
  UNION SELECT c.word, w.word, w.n FROM cut c JOIN words w ON w.word = c.less
  UNION SELECT w.word, c.word, c.n FROM cut c JOIN words w ON w.word = c.less
), best AS (
  SELECT word, count(*) AS n_near, max(other_n) AS best_n, arg_min(other, (-other_n, encode(other))) AS best FROM near GROUP BY 1
), formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 10 * w.n THEN best END AS form,
         CASE WHEN best_n >= 10 * w.n THEN best_n END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word
), walk AS (
  SELECT word, word AS root FROM formed
  UNION ALL SELECT walk.word, formed.form FROM walk JOIN formed ON formed.word = walk.root WHERE formed.form IS NOT NULL
)
SELECT f.word, f.form, w.root, f.n, f.n_near, f.form_n
FROM formed f JOIN (SELECT walk.* FROM walk JOIN formed ON formed.word = walk.root WHERE formed.form IS NULL) w ON w.word = f.word
"""
