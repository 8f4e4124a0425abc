"""Operator 6: quality rules as a ledger of bits, in DataFrame functions only.

Every rule is evaluated once per document. The ledger holds the measurements and one bit per failed
rule; a policy is a set of bits with a version, and a document passes it when it has none of them.
Changing a policy, or asking what dropping one rule would change, reads the ledger, not the texts.

A null or empty text has no words: all measurements are 0 and the rules on shares do not fail, but it
has too few words. Long texts cost n log n in their words, inside their own row: nothing is exploded
or shuffled. Repeated rows and ties are judged each by itself; an empty table gives an empty ledger;
further columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the base: separators of words, symbols, window length.
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8

#: Rules in bit order. A rule fails where its condition holds; shares are written without division.
RULES: dict[str, str] = {
    "few_words": "n_words < 20",
    "repeated_words": "100 * n_repeat_words > 30 * n_words",
    "many_symbols": "10 * n_symbols > n_words",
    "long_words": "word_chars > 20 * n_words",
    "short_words": "2 * word_chars < 3 * n_words",
    "repeated_lines": "2 * n_dup_lines > n_lines",
    "shouting": "10 * n_upper > 4 * word_chars",
    "few_letters": "2 * n_letters < word_chars",
}
BIT = {name: 1 << i for i, name in enumerate(RULES)}

#: Policies by version: the rules a kept document must not fail.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "many_symbols", "repeated_lines"),
    "v2": tuple(RULES),
}
CURRENT = "v2"


def mask(policy: str) -> int:
    return sum(BIT[name] for name in POLICIES[policy])


def _let(value: Column, then) -> Column:
    """`then` of a value that is computed once."""
    return F.transform(F.array(value), then)[0]


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _repeated(windows: Column) -> Column:
    """Words lying in a window that occurs twice or more, given the hash of the window at each word.

    Sorted with their places, equal windows stand next to each other; the places that have an equal
    neighbour, in order, each cover up to WINDOW words, less what the next one covers.
    """
    placed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def covered(places: Column) -> Column:
        return F.aggregate(
            F.transform(places, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(places, k + 1) - p, F.lit(WINDOW)))),
            F.lit(0).cast("bigint"),
            lambda total, step: total + step,
        )

    def equal_ones(s: Column) -> Column:
        return F.transform(
            F.filter(
                F.transform(
                    s,
                    lambda e, k: F.struct(
                        e["i"].alias("i"),
                        (
                            F.coalesce(F.get(s, k - 1)["h"] == e["h"], F.lit(False))
                            | F.coalesce(F.get(s, k + 1)["h"] == e["h"], F.lit(False))
                        ).alias("twice"),
                    ),
                ),
                lambda e: e["twice"],
            ),
            lambda e: e["i"],
        )

    return _let(placed, lambda s: _let(F.array_sort(equal_ones(s)), covered))


def measure(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Measurements of every row's whole text."""
    t = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split("_t", f"[{SPACES}]+"), lambda w: w != "")
    windows = F.when(
        F.size("_words") >= WINDOW,
        F.transform(F.sequence(F.lit(1), F.size("_words") - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("_words", i, WINDOW))),
    )
    lines = F.filter(F.split("_t", "\n"), lambda line: F.length(_without(line, SPACES)) > 0)
    return (
        docs.select(F.col(key).alias("doc_id"), t.alias("_t"))
        .select("doc_id", "_t", words.alias("_words"), lines.alias("_lines"))
        .select("doc_id", "_t", F.size("_words").alias("_n"), "_lines", windows.alias("_windows"))
        .select(
            "doc_id",
            F.col("_n").cast("long").alias("n_words"),
            F.length(_without(F.col("_t"), SPACES)).cast("long").alias("word_chars"),
            (F.length("_t") - F.length(_without(F.col("_t"), SYMBOLS))).cast("long").alias("n_symbols"),
            (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
            F.when(
                F.size(F.array_distinct("_windows")) < F.size("_windows"), _repeated(F.col("_windows"))
            ).otherwise(0).cast("long").alias("n_repeat_words"),
            F.size("_lines").cast("long").alias("n_lines"),
            F.length(F.regexp_replace("_t", r"[^\p{Lu}]+", "")).cast("long").alias("n_upper"),
            F.length(F.regexp_replace("_t", r"[^\p{L}]+", "")).cast("long").alias("n_letters"),
        )
    )


def ledger(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Measurements and `failed`: the bits of all rules a document fails."""
    bits = F.lit(0)
    for name, condition in RULES.items():
        bits = bits + F.when(F.expr(condition), BIT[name]).otherwise(0)
    return measure(docs, text, key).withColumn("failed", bits.cast("int"))


def apply_policy(rows: DataFrame, policy: str = CURRENT, column: str = "kept") -> DataFrame:
    """Ledger rows with a verdict under one policy."""
    return rows.withColumn(column, F.col("failed").bitwiseAND(mask(policy)) == 0)


def ablation(rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Per rule of a policy: how many documents it fails, and how many fail it alone.

    Bit sets are counted first (at most two to the number of rules), so the counts of single bits and
    of what remains without them come from a few rows.
    """
    whole = mask(policy)
    sets = rows.groupBy(F.col("failed").bitwiseAND(whole).alias("bits")).agg(F.count("*").alias("n"))
    rules = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(BIT[n]).alias("bit")) for n in POLICIES[policy]]))
    return (
        sets.select("bits", "n", rules.alias("r"))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failing"),
            F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_only_this"),
        )
    )


def judge(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The ledger with the verdicts of the base and of a policy."""
    rows = apply_policy(apply_policy(ledger(docs), "base", "_base"), policy)
    return rows.withColumn("base_failed", ~F.col("_base")).withColumn("kept", F.col("kept") & F.col("_base")).drop("_base")


#: The digest in DuckDB's SQL, for comparison: windows unnested and counted instead of sorted in place.
ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '[ \t\n\x0b\x0c\r]+'), lambda x: x <> '') AS words,
  list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^ \t\n\x0b\x0c\r]')) AS lines FROM d),
win AS (SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS s
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 6, 1))) AS i FROM w)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS c FROM win) WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(8) AS r(k) GROUP BY doc_id),
m AS (SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
  CAST(length(regexp_replace(t, '[ \t\n\x0b\x0c\r]+', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(t) - length(regexp_replace(t, '[#*$%%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
  CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, CAST(len(lines) AS BIGINT) AS n_lines,
  CAST(length(regexp_replace(t, '[^\p{Lu}]+', '', 'g')) AS BIGINT) AS n_upper,
  CAST(length(regexp_replace(t, '[^\p{L}]+', '', 'g')) AS BIGINT) AS n_letters
  FROM w LEFT JOIN rep USING (doc_id)),
f AS (SELECT *, CAST(%s AS INTEGER) AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper, n_letters, failed,
  (failed & %d) <> 0 AS base_failed, (failed & %d) = 0 AS kept FROM f
""" % (
    " + ".join(f"(CASE WHEN {condition} THEN {BIT[name]} ELSE 0 END)" for name, condition in RULES.items()),
    mask("base"),
    mask("base") | mask(CURRENT),
)
