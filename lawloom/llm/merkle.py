"""Operator 12: Merkle manifest of a dataset, proved by octopus multiproofs.

A leaf is the digest of a row; the leaves of a language, by doc_id, are the lowest level of its tree. Every
ARITY consecutive nodes become one until a single one is left (a lone leaf is its own tree). The roots of
the languages, null first and then in byte order, are the leaves of one more tree, whose root stands for
the dataset. Digests are SHA-256 in lower-case hex, and enter the next one as hex text.

Leaves are numbered by ranges, so a language with most of the rows lies in many tasks. Trees grow in blocks
of ARITY ** HEIGHT nodes: a task gets one block and gives the nodes above it that others need, so every
round leaves one node in 4,096. For proofs, each leaf partition (a block of leaves) names the missing nodes:
the least set of coordinates from which, with its own leaves, the root can be made. They are fetched by one
join, the nodes inside are made once for all leaves, and every leaf's own proof is put together from them.

Rows of one doc_id are leaves each, ordered by their digest; null doc_ids come first. Null columns count as
`-`, also lang, which has a tree of its own; the empty language is another one. An empty table has no tree
and no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lawloom.llm.common import stage
from lawloom.operators.numbering import number_rows, number_within

ARITY, HEIGHT = 8, 4
BLOCK = ARITY**HEIGHT
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: The tree above the languages. A language's tree is named by "=" and the language, null's by nothing.
TOP = "top"

NODES = "tree string, level int, pos long, digest string"
AUDIT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def digest(parts: Iterable[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_digest(columns: Iterable[Column]) -> Column:
    """SHA-256 of the columns, each as its UTF-8 length, a colon and its value, or `-`."""
    parts = [F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in columns]
    return F.sha2(F.concat(*parts), 256)


def leaves_of(docs: DataFrame, tampered_text: Column | None = None, tampered: Column | None = None) -> DataFrame:
    """tree, doc_id, leaf, now: each row's digest as recorded, and as it is found later (changed where `tampered`)."""
    fields = {name: F.col(name).cast("string") for name in FIELDS}
    leaf = leaf_digest(fields.values())
    now = F.lit(None).cast("string")
    if tampered is not None:
        now = F.when(tampered, leaf_digest((fields | {"text": tampered_text}).values()))
    tree = F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")).alias("tree")
    return docs.select(tree, F.col("doc_id").cast("long").alias("doc_id"), leaf.alias("leaf"), now.alias("now"))


def height(n: int) -> int:
    """Levels above n nodes until one is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


def _grow(nodes: pa.Table) -> pa.Table:
    """The nodes above one block, up to HEIGHT levels or the root.

    Only the first block of a tree can be its only one, and then ends lower if it is small; blocks of
    trees with several blocks all end HEIGHT levels up.
    """
    order = nodes.column("pos").combine_chunks().to_numpy().argsort()
    now = nodes.column("digest").combine_chunks().take(pa.array(order)).to_pylist()
    tree, level, start = nodes.column("tree")[0].as_py(), nodes.column("level")[0].as_py(), nodes.column("pos")[int(order[0])].as_py()
    out = []
    for up in range(1, HEIGHT + 1):
        if start == 0 and len(now) == 1:
            break
        now = [digest(now[i : i + ARITY]) for i in range(0, len(now), ARITY)]
        first = start // ARITY**up
        out += [(tree, level + up, first + i, d) for i, d in enumerate(now)]
    columns = zip(*out) if out else [[]] * 4
    return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.int64(), pa.string()))], ["tree", "level", "pos", "digest"])


def grown(nodes: DataFrame, lowest: int) -> DataFrame:
    """All nodes above `nodes` (tree, level 0, pos, digest) from level `lowest` on, and the trees' roots."""
    level, out = 0, None
    while True:
        block = F.floor(F.col("pos") / BLOCK).alias("block")
        above = nodes.select("tree", "level", "pos", "digest", block).groupBy("tree", "block").applyInArrow(_grow, NODES)
        # Of the lower levels only roots of small trees are wanted, and the ones the next round starts from.
        small = (F.col("level") < lowest) & (F.col("pos") > 0)
        above = stage(above.where(~small), "merkle-nodes")
        out = above if out is None else out.unionByName(above)
        level += HEIGHT
        nodes = above.where(F.col("level") == level)
        if nodes.where("pos > 0").isEmpty():
            return out


@dataclass
class Manifest:
    """Leaves (tree, pos, doc_id, leaf, now), stored upper nodes, and one row per tree."""

    leaves: DataFrame
    nodes: DataFrame
    trees: DataFrame


def build(leaves: DataFrame) -> Manifest:
    """The manifest of leaves made by `leaves_of`; all tables are written below the shared folder."""
    leaves = stage(leaves, "merkle-digests")
    leaves = stage(number_within(leaves, ["tree"], [F.col("doc_id"), F.col("leaf")], "pos"), "merkle-leaves")
    lowest = leaves.select("tree", F.lit(0).alias("level"), "pos", F.col("leaf").alias("digest"))
    nodes = grown(lowest, HEIGHT)
    sizes = leaves.groupBy("tree").agg((F.max("pos") + 1).alias("n"))
    # A tree's root is its highest node; a lone leaf is its own.
    roots = nodes.where("pos = 0").groupBy("tree").agg(F.max(F.struct("level", "digest")).alias("r")).select("tree", F.col("r.digest").alias("up"))
    lone = lowest.where("pos = 0").select("tree", F.col("digest").alias("only"))
    trees = sizes.join(lone, "tree").join(roots, "tree", "left").select("tree", "n", F.coalesce("up", "only").alias("subroot"))
    trees = stage(number_rows(trees, [F.col("tree")], "rank"), "merkle-trees")
    top = trees.select(F.lit(TOP).alias("tree"), F.lit(0).alias("level"), F.col("rank").alias("pos"), F.col("subroot").alias("digest"))
    nodes = nodes.unionByName(top).unionByName(grown(top, 1))
    return Manifest(leaves, stage(nodes, "merkle-tree"), trees)


def missing(held: Iterable[int], n: int) -> list[tuple[int, int]]:
    """Least set of (level, pos) that, with the held leaves of a tree of n, gives its root."""
    out, level, known = [], 0, sorted(set(held))
    while n > 1:
        parents = sorted({p // ARITY for p in known})
        have = set(known)
        for p in parents:
            out += [(level, c) for c in range(p * ARITY, min((p + 1) * ARITY, n)) if c not in have]
        known, n, level = parents, -(-n // ARITY), level + 1
    return out


class Opened:
    """A tree seen from some of its leaves: the nodes above them made once, from them and the missing ones."""

    def __init__(self, held: dict[int, str], fetched: dict[tuple[int, int], str], n: int):
        self.runs: list[dict[int, list[str]]] = []
        level, known = 0, held
        while n > 1:
            runs = {}
            for p in {p // ARITY for p in known}:
                children = range(p * ARITY, min((p + 1) * ARITY, n))
                runs[p] = [known[c] if c in known else fetched[level, c] for c in children]
            self.runs.append(runs)
            known = {p: digest(r) for p, r in runs.items()}
            n, level = -(-n // ARITY), level + 1
        self.root = known[0]

    def proof(self, pos: int) -> list[tuple[str, str]]:
        """What stands before and after the node in its run, level by level."""
        out = []
        for runs in self.runs:
            pos, at = divmod(pos, ARITY)
            run = runs[pos]
            out.append(("".join(run[:at]), "".join(run[at + 1 :])))
        return out


def fold(leaf: str, proof: Iterable[tuple[str, str]]) -> str:
    for before, after in proof:
        leaf = digest((before, leaf, after))
    return leaf


def _names(blocks: Iterable[pa.RecordBatch]):
    """The missing coordinates of leaf partitions (tree, block, n, rank, trees): at, level, pos of tree `of`."""
    for batch in blocks:
        for row in batch.to_pylist():
            held = range(row["block"] * BLOCK, min((row["block"] + 1) * BLOCK, row["n"]))
            wanted = [(row["tree"], *c) for c in missing(held, row["n"])] + [(TOP, *c) for c in missing([row["rank"]], row["trees"])]
            if wanted:
                of, level, pos = zip(*wanted)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["tree"]] * len(of), pa.string()), pa.array([row["block"]] * len(of), pa.int64()),
                     pa.array(of, pa.string()), pa.array(level, pa.int32()), pa.array(pos, pa.int64())],
                    ["tree", "block", "of", "level", "pos"],
                )


def _prove(leaves: pa.Table, given: pa.Table) -> pa.Table:
    """Proofs and folded roots of the leaves of one partition."""
    about = given.to_pylist()[0]
    nodes = about["nodes"] or []
    own = {(x["level"], x["pos"]): x["digest"] for x in nodes if x["of"] != TOP}
    above = {(x["level"], x["pos"]): x["digest"] for x in nodes if x["of"] == TOP}
    rows = leaves.select(["pos", "doc_id", "leaf", "now"]).to_pydict()
    tree = Opened(dict(zip(rows["pos"], rows["leaf"])), own, about["n"])
    top = Opened({about["rank"]: tree.root}, above, about["trees"])
    over = top.proof(about["rank"])
    proofs, folded = [], []
    for pos, leaf, now in zip(rows["pos"], rows["leaf"], rows["now"]):
        proof = tree.proof(pos) + over
        proofs.append(digest(x for pair in proof for x in pair))
        # For an unchanged leaf this is what the shared nodes were made by.
        folded.append(top.root if now is None or now == leaf else fold(now, proof))
    return pa.table(
        {"doc_id": leaves.column("doc_id"), "leaf": leaves.column("leaf"), "subroot": [about["subroot"]] * len(proofs),
         "root": [about["root"]] * len(proofs), "proof_sha256": proofs, "folded_root": folded,
         "verified": [x == about["root"] for x in folded]}
    )


def audit(manifest: Manifest) -> DataFrame:
    """Per leaf: its digest, the recorded roots, its proof's digest, and the root its present form folds to."""
    leaves = manifest.leaves.withColumn("block", F.floor(F.col("pos") / BLOCK))
    trees = manifest.trees
    number = trees.count()
    top = manifest.nodes.where((F.col("tree") == TOP) & (F.col("pos") == 0)).agg(F.max(F.struct("level", "digest")).alias("r")).first()
    if not number:
        return leaves.sparkSession.createDataFrame([], AUDIT)
    blocks = trees.select(
        "*", F.lit(number).cast("long").alias("trees"), F.lit(top["r"]["digest"]).alias("root"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / BLOCK))).alias("block"),
    )
    wanted = blocks.select("tree", "block", "n", "rank", "trees").mapInArrow(_names, "tree string, block long, of string, level int, pos long")
    stored = manifest.nodes.withColumnRenamed("tree", "of")
    fetched = wanted.join(stored, ["of", "level", "pos"]).groupBy("tree", "block").agg(F.collect_list(F.struct("of", "level", "pos", "digest")).alias("nodes"))
    given = blocks.join(fetched, ["tree", "block"], "left").select("tree", "block", "n", "rank", "trees", "subroot", "root", "nodes")
    return leaves.groupBy("tree", "block").cogroup(given.groupBy("tree", "block")).applyInArrow(_prove, AUDIT)


#: Tampering in the query: one in three documents has its text's capitals lower-cased.
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def tamper_and_audit(docs: DataFrame) -> DataFrame:
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return audit(build(leaves_of(docs, F.translate("text", CAPITALS, CAPITALS.lower()), hit)))


ORACLE = """
WITH RECURSIVE crc AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i::UBIGINT, list_transform(range(8), lambda k: k::UBIGINT)),
                          lambda v, k: CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END) AS v
    FROM range(256) r(i))
), texts AS (
  SELECT doc_id, source, lang, n_chars, text, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
         xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: unicode(c)::UBIGINT)),
             lambda v, b: xor(v >> 8, t[(xor(v, b) & 255)::BIGINT + 1])), 4294967295::UBIGINT) AS h
  FROM documents, crc
), heads AS (
  SELECT doc_id, lang, h,
    coalesce(strlen(doc_id::VARCHAR)::VARCHAR || ':' || doc_id::VARCHAR, '-') || coalesce(strlen(source)::VARCHAR || ':' || source, '-')
      || coalesce(strlen(lang)::VARCHAR || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR)::VARCHAR || ':' || n_chars::VARCHAR, '-') AS head,
    coalesce(strlen(text)::VARCHAR || ':' || text, '-') AS tail, coalesce(strlen(low)::VARCHAR || ':' || low, '-') AS low_tail
  FROM texts
), digests AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, sha256(head || tail) AS leaf,
         sha256(CASE WHEN h % 3 = 0 THEN head || low_tail ELSE head || tail END) AS now
  FROM heads
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n
  FROM digests
), nodes AS (
  SELECT tree, 0 AS level, pos, n, leaf AS digest FROM leaves
  UNION ALL
  SELECT tree, level + 1, pos // 8, (any_value(n) + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos)) FROM nodes WHERE n > 1
  GROUP BY tree, level, pos // 8
), subroots AS (
  SELECT tree, digest AS subroot, row_number() OVER (ORDER BY tree) - 1 AS rank, count(*) OVER () AS n FROM nodes WHERE n = 1
), tops AS (
  SELECT 0 AS level, rank AS pos, n, subroot AS digest FROM subroots
  UNION ALL
  SELECT level + 1, pos // 8, (any_value(n) + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos)) FROM tops WHERE n > 1 GROUP BY level, pos // 8
), every AS (
  SELECT tree, level, pos, n, digest FROM nodes UNION ALL SELECT 'top', level, pos, n, digest FROM tops
), sides AS (
  SELECT a.tree, a.level, a.pos, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS before,
         coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS after
  FROM every a JOIN every b ON a.tree = b.tree AND a.level = b.level AND a.pos // 8 = b.pos // 8 WHERE a.n > 1 GROUP BY 1, 2, 3
), folds AS (
  SELECT tree, pos AS id, 0 AS level, pos, now AS digest, '' AS proof FROM leaves
  UNION ALL
  SELECT f.tree, f.id, f.level + 1, f.pos // 8, sha256(s.before || f.digest || s.after), f.proof || s.before || s.after
  FROM folds f JOIN sides s ON s.tree = f.tree AND s.level = f.level AND s.pos = f.pos
), lower_ends AS (
  SELECT tree, id, arg_max(digest, level) AS digest, arg_max(proof, level) AS proof FROM folds GROUP BY 1, 2
), upper AS (
  SELECT e.tree, e.id, 0 AS level, r.rank AS pos, e.digest, e.proof FROM lower_ends e JOIN subroots r ON r.tree = e.tree
  UNION ALL
  SELECT u.tree, u.id, u.level + 1, u.pos // 8, sha256(s.before || u.digest || s.after), u.proof || s.before || s.after
  FROM upper u JOIN sides s ON s.tree = 'top' AND s.level = u.level AND s.pos = u.pos
), ends AS (
  SELECT tree, id, arg_max(digest, level) AS folded_root, arg_max(proof, level) AS proof FROM upper GROUP BY 1, 2
)
SELECT l.doc_id, l.leaf, r.subroot, t.digest AS root, sha256(e.proof) AS proof_sha256, e.folded_root, e.folded_root = t.digest AS verified
FROM leaves l JOIN subroots r ON r.tree = l.tree JOIN ends e ON e.tree = l.tree AND e.id = l.pos JOIN (SELECT digest FROM tops WHERE n = 1) t ON true
"""
