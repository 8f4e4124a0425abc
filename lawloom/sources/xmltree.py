"""Read a tree of XML files with their last-modified side files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lawloom.constants import STATUS_FILE_NAME
from lawloom.functions import keys as K
from lawloom.functions.text import is_malformed, bill_text, strip_spaces
from lawloom.operators.decode import decode_status, root_violation
from lawloom.sources.treesource import read_tree

#: Text files; what else has their form is told by the patterns of their names.
TEXT_NAMES = "BILLS-*.xml|PLAW-*.xml"


def read_files(spark: SparkSession, root: str, glob: str) -> DataFrame:
    """One row per file below `root` whose name matches `glob`: (path, body)."""
    files = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .text(root, wholetext=True)
    )
    raw_path = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    return files.select(F.url_decode(raw_path).alias("path"), F.col("value").alias("body"))


def join_sidecar(
    files: DataFrame,
    sidecars: DataFrame,
    on: list[str],
    stamp: str = "stamp_text",
    out: str = "lastmod",
) -> DataFrame:
    """Add the side file's timestamp; null when the side file is missing or unreadable."""
    stamps = sidecars.select(*on, lastmod_of(F.col(stamp)).alias(out))
    return files.join(stamps, on, "left")


def lastmod_of(stamp: Column) -> Column:
    """A side file's text as a timestamp; null when the file is missing or unreadable."""
    return F.trim(strip_spaces(stamp)).try_cast("timestamp")


def _names(*pairs: tuple[Column, str]) -> Column:
    return F.array_compact(F.array(*[F.when(test, F.lit(name)) for test, name in pairs]))


def status_rows(pairs: DataFrame, root: str) -> DataFrame:
    """Status files (path, body, stamp_text) as billstatus rows with `bs` decoded and `violations` named.

    Rows whose path has another form, whose side file is missing or whose document breaks a rule
    stay in the result.
    """
    part = F.col("part")
    rows = (
        pairs.withColumn("lastmod", lastmod_of(F.col("stamp_text")))
        .withColumn("scrape_path", K.relative_path(F.col("path"), root))
        .withColumn("part", K.status_path_parts(F.col("scrape_path")))
        .select(
            K.dashed(part["congress_num"], part["legis_type"], part["legis_num"]).alias("legis_id"),
            part["congress_num"].alias("congress_num"),
            part["legis_type"].alias("legis_type"),
            part["legis_num"].alias("legis_num"),
            "scrape_path",
            "lastmod",
            strip_spaces(F.col("body")).alias("bs_xml"),
        )
    )
    found = _names((F.col("legis_id").isNull(), "scrape_path:form"), (F.col("lastmod").isNull(), "lastmod:missing"))
    return decode_status(rows).withColumn("violations", F.concat(found, "violations"))


def read_status(spark: SparkSession, root: str) -> DataFrame:
    return status_rows(read_tree(spark, root, STATUS_FILE_NAME), root)


def named_files(files: DataFrame) -> DataFrame:
    """Files with the keys in their names; `part` is null for a name of another form."""
    name = K.last_segment(F.col("path"))
    return files.withColumns({"file_name": name, "part": K.text_name_parts(name)})


def text_files(spark: SparkSession, root: str) -> DataFrame:
    return named_files(read_files(spark, root, "*.xml"))


def unmatched_names(named: DataFrame, name: str = "file_name", part: str = "part") -> DataFrame:
    """How often each name of another form occurs."""
    return named.where(F.col(part).isNull()).groupBy(name).agg(F.count("*").alias("n"))


def text_rows(pairs: DataFrame, root: str) -> DataFrame:
    """Text files (path, body, stamp_text) as textversion rows, reading text extracted, `violations` named."""
    matched = named_files(pairs).where(F.col("part").isNotNull())
    part = F.col("part")
    rows = (
        matched.withColumn("lastmod", lastmod_of(F.col("stamp_text")))
        .withColumn("scrape_path", K.relative_path(F.col("path"), root))
        .withColumn("xml_type", K.markup_kind(F.col("scrape_path")))
        .withColumn("tv_xml", strip_spaces(F.col("body")))
    )
    rows = rows.select(
        K.dashed(
            part["congress_num"], part["legis_type"], part["legis_num"], part["legis_version"], F.col("xml_type")
        ).alias("tv_id"),
        K.dashed(part["congress_num"], part["legis_type"], part["legis_num"]).alias("legis_id"),
        part["congress_num"].alias("congress_num"),
        part["legis_type"].alias("legis_type"),
        part["legis_num"].alias("legis_num"),
        part["legis_version"].alias("legis_version"),
        part["legis_class"].alias("legis_class"),
        "scrape_path",
        "file_name",
        "lastmod",
        "xml_type",
        K.root_tag(F.col("tv_xml")).alias("root_tag"),
        "tv_xml",
        bill_text(F.col("tv_xml")).alias("tv_txt"),
    )
    return rows.withColumn(
        "violations",
        F.array_compact(
            F.array(
                F.when(F.col("lastmod").isNull(), F.lit("lastmod:missing")),
                root_violation(F.col("root_tag")),
                F.when(is_malformed(F.col("tv_xml")), F.lit("text:malformed")),
            )
        ),
    )


def read_texts(spark: SparkSession, root: str) -> DataFrame:
    return text_rows(read_tree(spark, root, TEXT_NAMES), root)
