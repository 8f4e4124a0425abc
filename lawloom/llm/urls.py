"""Operator 9: URL filters as a sort-merge range join.

A page's canonical key is its host with the labels reversed, each followed by a dot: `org.example.www.`.
A rule's host becomes the interval of keys that begin with its own key, so hosts nest as intervals do.
Pages and rules are sorted together by key and dealt out by ranges; in every range one sweep goes
through the keys in order and keeps a stack of the hosts whose interval is still open, each with its
path rules. The rules that are open where a range begins started in an earlier one: they belong to
ancestors of the range's first host and are added to the range by an equality join on those ancestors.

The longest rule (host and path together) that fits wins; no rule: rule null, verdict allow. A null url
or one without `://` has an empty host and path, which no rule fits. Repeated pages are judged each by
itself (a very frequent host or url spreads over ranges, since page_id and path belong to the order);
equal rules given twice are one, and of contradicting ones block wins. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lawloom.llm.common import bound_batches, stage

#: The production rules: (host, path, verdict).
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
DEFAULT_VERDICT = "allow"


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path of a url."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_replace(url, r"(?s)^.*?://", ""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(F.regexp_replace(rest, r"^[^/?#]*", ""), r"^[^?#]*", 0)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def host_key(host: Column) -> Column:
    """`www.example.org` as `org.example.www.`; an empty host has an empty key."""
    return F.when(host == "", "").otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


def ancestors(key: Column) -> Column:
    """The keys of all hosts above a host key, itself included."""
    labels = F.split(F.regexp_replace(key, r"\.$", ""), r"\.")
    return F.transform(labels, lambda _, i: F.concat(F.array_join(F.slice(labels, 1, i + 1), "."), F.lit(".")))


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    stack: list[tuple[str, dict[str, str], set[int]]] = []  # open hosts: key, verdict by path, lengths of paths
    current = None
    for batch in batches:
        out = []
        slots, keys, kinds = (batch.column(c).to_pylist() for c in ("slot", "key", "kind"))
        ids, hosts, paths, verdicts = (batch.column(c).to_pylist() for c in ("page_id", "host", "path", "verdict"))
        for slot, key, kind, page, host, path, verdict in zip(slots, keys, kinds, ids, hosts, paths, verdicts):
            if slot != current:
                current, stack = slot, []
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if kind == 0:
                if not stack or stack[-1][0] != key:
                    stack.append((key, {}, set()))
                if stack[-1][1].get(path) != "block":
                    stack[-1][1][path] = verdict
                stack[-1][2].add(len(path))
                continue
            best: tuple[int, int, str | None, str] = (-1, -1, None, DEFAULT_VERDICT)
            for open_key, by_path, lengths in stack:
                length = max((n for n in lengths if path[:n] in by_path), default=None)
                if length is not None:
                    name = ".".join(reversed(open_key[:-1].split("."))) + path[:length]
                    best = max(best, (len(name), len(open_key), name, by_path[path[:length]]))
            out.append((page, host, path, best[2], best[3]))
        if out:
            columns = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), *[pa.array(c, pa.string()) for c in columns[1:]]],
                ["page_id", "host", "path", "rule", "verdict"],
            )


def judge(pages: DataFrame, rules: DataFrame, ranges: int | None = None) -> DataFrame:
    """Per row of `pages` (page_id, url): page_id, host, path, rule, verdict."""
    spark = pages.sparkSession
    bound_batches(spark)
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    host, path = split_url(F.col("url"))
    page_rows = pages.select("page_id", host.alias("host"), path.alias("path")).select(
        host_key(F.col("host")).alias("key"), F.lit(1).alias("kind"), "path", "page_id", "host",
        F.lit(None).cast("string").alias("verdict"),
    )
    # One rule per host and path: block is the greater word and wins.
    rules = rules.groupBy(F.lower("host").alias("host"), "path").agg(F.max("verdict").alias("verdict"))
    rule_rows = stage(
        rules.select(
            host_key(F.col("host")).alias("key"), F.lit(0).alias("kind"), "path",
            F.lit(None).cast("long").alias("page_id"), "host", "verdict",
        ), "url-rules",
    )
    # Ranges are drawn by sampling, so they are fixed by writing them.
    order = ("key", "kind", "path", "page_id")
    dealt = stage(
        page_rows.unionByName(rule_rows).repartitionByRange(ranges, *order).withColumn("slot", F.spark_partition_id()),
        "url-ranges",
    )
    first = dealt.groupBy("slot").agg(F.min("key").alias("first"))
    open_there = (
        first.select("slot", "first", F.explode(ancestors(F.col("first"))).alias("key"))
        .join(rule_rows, "key")
        .select(*[F.col(c) for c in ("key", "kind", "path", "page_id", "host", "verdict", "slot")])
    )
    # A range may hold its first host's rules itself; the sweep takes a rule twice as one.
    rows = dealt.unionByName(open_there).repartition(ranges, "slot").sortWithinPartitions("slot", *order)
    return rows.mapInArrow(_sweep, "page_id long, host string, path string, rule string, verdict string")


#: The same by plain SQL over the fixed rules.
ORACLE = """
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
p AS (SELECT page_id,
  coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
  coalesce(regexp_extract(regexp_replace(rest, '^[^/?#]*', ''), '^[^?#]*'), '') AS path FROM u),
r(rhost, rpath, rverdict) AS (VALUES %s),
fit AS (SELECT page_id, rhost || rpath AS rule, rverdict,
    row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC, length(rhost) DESC) AS n
  FROM p JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT p.page_id, p.host, p.path, fit.rule, coalesce(fit.rverdict, '%s') AS verdict
FROM p LEFT JOIN fit ON p.page_id = fit.page_id AND fit.n = 1
""" % (", ".join(str(r) for r in RULES), DEFAULT_VERDICT)
