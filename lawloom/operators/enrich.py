"""Joins and record assembly that put bill, sponsor and member fields beside chunks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lawloom.constants import BILL_METADATA_KEYS, EXPORT_COLUMNS, EXPORT_SCORES
from lawloom.functions import fields as P
from lawloom.operators.upsert import latest_rows


def join_bills(chunks: DataFrame, bills: DataFrame, columns: Sequence[str], key: str = "legis_id") -> DataFrame:
    """Chunks with the named bill columns; chunks of unknown bills drop.

    A bill with very many chunks is split by adaptive skew handling: the bill side has one row.
    """
    return chunks.join(bills.select(key, *columns), key)


def join_rows(ids: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Rows of the given ids, such as neighbours found by a search."""
    return ids.join(rows, key)


def merge_topics(projections: DataFrame, topics: DataFrame, key: str = "chunk_id") -> DataFrame:
    """Projected points with their topics, renamed and ordered; congress is the id's first part."""
    merged = projections.join(topics, key).withColumnsRenamed({"x": "proj_x", "y": "proj_y"})
    merged = merged.withColumn("congress_num", F.split_part(key, F.lit("-"), F.lit(1)))
    return merged.select(
        key, "congress_num", "topic_depth_1", "topic_depth_2", "topic_depth_3", "proj_x", "proj_y", "vec"
    )


def topic_export(topic_rows: DataFrame, chunks: DataFrame, bills: DataFrame) -> DataFrame:
    """Topic rows with chunk text and metadata, and the bill's fields joined on its id."""
    text = chunks.select("chunk_id", "legis_id", "text", F.col("metadata").alias("chunk_metadata"))
    kept = bills.select("legis_id", F.struct(*[F.col(f"bs.{k}") for k in BILL_METADATA_KEYS]).alias("bill_metadata"))
    return topic_rows.join(text, "chunk_id").join(kept, "legis_id").drop("legis_id")


def attach_members(
    chunks: DataFrame,
    members: DataFrame,
    scores: Sequence[str] = EXPORT_SCORES,
    on: Sequence[str] = ("congress", "bioguide_id"),
    first_by: Sequence[str] = ("icpsr",),
) -> DataFrame:
    """Chunks with their sponsor's scores; one member row per key, so the row count stays.

    No broadcast is forced: the planner broadcasts the deduplicated members when they are small.
    """
    once = latest_rows(members.select(*on, *first_by, *scores), list(on), [*first_by, *scores], newest=False)
    return chunks.join(once.select(*on, *scores), list(on), "left")


def code_lookup(df: DataFrame, codes: DataFrame, key: str) -> DataFrame:
    """Left join to a code table; an unknown code gives nulls."""
    return df.join(codes, key, "left")


def export_rows(chunks: DataFrame, bills: DataFrame, with_vectors: bool = False) -> DataFrame:
    """Chunks with bill fields as the search export holds them."""
    bs = F.col("bs")
    own = ["chunk_id", "tv_id", "legis_id", "text", *(["vec"] if with_vectors else [])]
    merged = chunks.select(*own).join(
        bills.select("legis_id", "congress_num", "legis_type", "legis_num", "bs"), "legis_id"
    )
    name = P.first_field(bs["sponsors"], "full_name", "")
    return merged.withColumns(
        {
            "subjects": P.sorted_join(bs["subjects"]),
            "sponsor_url": P.member_url(P.first_field(bs["sponsors"], "bioguide_id")),
            "sponsor_name": name,
            "congress_gov_url": P.bill_url(F.col("congress_num"), F.col("legis_type"), F.col("legis_num")),
            "title": bs["title"],
            "policy_area": bs["policy_area"],
            "origin_chamber": bs["origin_chamber"],
            "sponsor_party": P.bracket_part(name, 1),
            "sponsor_state": P.bracket_part(name, 2),
            "introduced_date": bs["introduced_date"].cast("string"),
            "update_date": F.date_format(bs["update_date"], "yyyy-MM-dd"),
        }
    ).select(*EXPORT_COLUMNS, *(["vec"] if with_vectors else []))


def export_with_scores(exported: DataFrame, members: DataFrame) -> DataFrame:
    """Search export with the first sponsor's member scores."""
    keyed = exported.withColumns(
        {"congress": F.col("congress_num"), "bioguide_id": P.member_id_of_url(F.col("sponsor_url"))}
    )
    return attach_members(keyed, members).drop("congress")


def _bill_pairs(bs: Column, piped_lists: bool) -> list[tuple[str, Column]]:
    first = [(f"sponsor_{n}", P.first_field(bs["sponsors"], n)) for n in ("bioguide_id", "full_name", "party", "state")]
    dates = [
        ("introduced_date", bs["introduced_date"].cast("string")),
        ("policy_area", bs["policy_area"]),
        ("title", bs["title"]),
    ]
    if not piped_lists:
        ids = F.transform(bs["cosponsors"], lambda c: c["bioguide_id"])
        return [*first, ("cosponsor_bioguide_ids", ids), *dates, ("subjects", bs["subjects"])]
    co = bs["cosponsors"]
    return [
        *first,
        ("cosponsor_bioguide_ids", P.piped(co, "bioguide_id")),
        ("cosponsor_full_names", P.piped(co, "full_name")),
        ("cosponsor_parties", P.piped(co, "party")),
        ("cosponsor_states", P.piped(co, "state")),
        *dates,
        ("subjects", F.array_join(bs["subjects"], "|")),
    ]


def _as_map(pairs: Sequence[tuple[str, Column]]) -> Column:
    return F.map_from_arrays(
        F.array(*[F.lit(n) for n, _ in pairs]), F.array(*[c.cast("string") for _, c in pairs])
    )


def flat_record(bs: Column, chunk_fields: Sequence[tuple[str, Column]]) -> Column:
    """Map of text values: lists piped, missing values printed, chunk fields win on equal names."""
    merged = P.overlay(_as_map(_bill_pairs(bs, piped_lists=True)), _as_map(chunk_fields))
    return P.nulls_as_text(merged)


def nested_record(text: Column, bs: Column, chunk_fields: Sequence[tuple[str, Column]]) -> Column:
    """JSON record: lists kept as lists, missing values left out, the chunk's text inside."""
    over = {n for n, _ in chunk_fields}
    pairs = [("text", text), *[p for p in _bill_pairs(bs, piped_lists=False) if p[0] not in over], *chunk_fields]
    return F.to_json(F.struct(*[c.alias(n) for n, c in pairs]))


def row_metadata(bs: Column, tvs: Column, legis: Sequence[Column]) -> Column:
    """Short metadata record of a bill's first text version, null when there is none.

    `legis` gives legis_id, congress_num, legis_type and legis_num.
    """
    tv = F.get(tvs, 0)
    names = ("legis_id", "congress_num", "legis_type", "legis_num")
    return F.when(
        F.size(tvs) > 0,
        F.struct(
            tv["tv_id"].alias("tv_id"),
            tv["legis_version"].alias("legis_version"),
            tv["legis_class"].alias("legis_class"),
            *[c.alias(n) for n, c in zip(names, legis)],
            bs["origin_chamber"].alias("origin_chamber"),
            bs["update_date"].alias("update_date"),
            tv["bs_tv"]["date"].alias("text_date"),
            bs["introduced_date"].alias("introduced_date"),
            P.first_field(bs["sponsors"], "bioguide_id").alias("sponsor"),
        ),
    )
