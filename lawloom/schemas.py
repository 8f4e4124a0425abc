"""Declared schemas of stored tables."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
    "array<float>": T.ArrayType(T.FloatType()),
}


def _struct(text: str) -> T.StructType:
    pairs = (item.split() for item in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


BILLSTATUS_KEYS = _struct(
    "legis_id string, congress_num int, legis_type string, legis_num int, "
    "scrape_path string, lastmod timestamp"
)
TEXTVERSION = _struct(
    "tv_id string, legis_id string, congress_num int, legis_type string, legis_num int, "
    "legis_version string, legis_class string, scrape_path string, file_name string, "
    "lastmod timestamp, xml_type string, root_tag string, tv_xml string, tv_txt string"
)
BS_TV = _struct("type string, date timestamp, url string")
CHUNK_METADATA = _struct(
    "chunk_id string, chunk_index int, congress_num int, legis_class string, legis_id string, "
    "legis_num int, legis_type string, legis_version string, start_index int, text_date string, tv_id string"
)
CHUNKS = (
    T.StructType()
    .add("chunk_id", "string")
    .add("tv_id", "string")
    .add("legis_id", "string")
    .add("text", "string")
    .add("metadata", CHUNK_METADATA)
)
VECTORS = T.StructType(CHUNKS.fields + [T.StructField("vec", T.ArrayType(T.FloatType()))])
TOPICS = _struct(
    "chunk_id string, congress_num string, topic_depth_1 string, topic_depth_2 string, "
    "topic_depth_3 string, proj_x float, proj_y float, vec array<float>"
)
# Columns before the scores may be extended by the source file; unknown columns are not read.
MEMBERS = _struct(
    "congress int, chamber string, icpsr int, district_code int, party_code int, bioguide_id string, "
    "nominate_dim1 double, nominate_dim2 double, nominate_log_likelihood double, "
    "nominate_geo_mean_probability double, nominate_number_of_votes double, "
    "nominate_number_of_errors double, conditional double, nokken_poole_dim1 double, "
    "nokken_poole_dim2 double"
)
