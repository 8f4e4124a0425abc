"""The Merkle manifest against a tree built plainly in one place."""

import hashlib
import random
import zlib

import pytest

from lawloom.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(x):
    return hashlib.sha256(x.encode()).hexdigest()


def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i : i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def path(levels, pos):
    for nodes in levels[:-1]:
        a = pos // 8 * 8
        yield "".join(nodes[a:pos]), "".join(nodes[pos + 1 : a + 8])
        pos //= 8


def brute(rows):
    trees = {}
    for r in rows:
        low = None if r[4] is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])
        hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
        leaf = h("".join(map(field, r)))
        trees.setdefault(r[2], []).append(((r[0] is not None, r[0] or 0, leaf), r[0], leaf, h("".join(map(field, (*r[:4], low)))) if hit else leaf))
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built = {lang: levels_of([x[2] for x in sorted(trees[lang])]) for lang in langs}
    top = levels_of([built[lang][-1][0] for lang in langs])
    out = []
    for rank, lang in enumerate(langs):
        for pos, (_, doc_id, leaf, now) in enumerate(sorted(trees[lang])):
            sides = [*path(built[lang], pos), *path(top, rank)]
            folded = now
            for before, after in sides:
                folded = h(before + folded + after)
            out.append((doc_id, leaf, built[lang][-1][0], top[-1][0], h("".join(a + b for a, b in sides)), folded, folded == top[-1][0]))
    return sorted(out, key=str)


def found(docs):
    return sorted(map(tuple, merkle.tamper_and_audit(docs).collect()), key=str)


@pytest.mark.parametrize("languages", [["en"], [None, "", "en", "é", "z"], [f"l{i}" for i in range(70)]])
def test_equals_plain_tree(spark, languages):
    rng = random.Random(len(languages))
    rows = [(rng.randrange(900), rng.choice(["s", None]), rng.choice(languages + languages[:1] * 9), i, rng.choice(["A text", "none", None, "É À"])) for i in range(700)]
    rows += [(None, "s", languages[0], 1, "Null id"), rows[0], rows[0]]
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_sizes_around_full_runs(spark):
    rows = [(i, None, f"n{number}", i, f"Text {i}") for number in (1, 2, 8, 9, 64, 65) for i in range(number)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
    assert found(spark.createDataFrame(rows[:1], SCHEMA)) == brute(rows[:1])


def test_many_blocks(spark):
    """More leaves than one block, so that upper nodes are fetched; one language has nearly all."""
    rows = [(i, "s", "en" if i % 50 else "fr", i, f"Text {i}") for i in range(9_000)] + [(i, "s", None, 0, None) for i in range(4_096)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_missing_nodes_are_the_least_that_open_the_tree():
    rng = random.Random(4)
    for n in (1, 2, 8, 9, 70, 600):
        leaves = [h(str(i)) for i in range(n)]
        levels = levels_of(leaves)
        for _ in range(8):
            held = sorted(rng.sample(range(n), rng.randrange(1, min(n, 12) + 1)))
            wanted = merkle.missing(held, n)
            assert len(set(wanted)) == len(wanted)
            # No wanted node lies above a held leaf, so none could be made instead of fetched.
            assert not any(p // 8**level == pos for level, pos in wanted for p in held)
            opened = merkle.Opened({p: leaves[p] for p in held}, {c: levels[c[0]][c[1]] for c in wanted}, n)
            assert opened.root == levels[-1][0]
            for p in held:
                assert opened.proof(p) == list(path(levels, p)) and merkle.fold(leaves[p], opened.proof(p)) == opened.root
                assert merkle.fold(h("x"), opened.proof(p)) != opened.root


def test_odd_rows(spark, odd_docs):
    rows = [tuple(r) for r in odd_docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert found(odd_docs) == brute(rows)
    assert found(odd_docs.limit(0)) == []
