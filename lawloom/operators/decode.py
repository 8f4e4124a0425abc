"""Decode status and resolution documents into typed nested columns.

The document format is declared as data: an entity is a list of fields. From that declaration come
the text-only schema for one `from_xml` per document, the typed projection, and the rule checks. The
projection is built as SQL text: with some hundred fields that is one parse instead of thousands of
column calls.
Each broken rule adds its name to `violations`; rows with any go to quarantine.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field as dc_field

from pyspark.sql import Column, DataFrame, functions as F, types as T

from lawloom.constants import ROOT_TAGS

CORRUPT = "_corrupt"
RAW = "__raw"
XML_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
    "ignoreNamespace": "true",
    "ignoreSurroundingSpaces": "false",
}


@dataclass(frozen=True)
class Leaf:
    """A text element (or attribute, tag `_name`) cast to `type`."""

    name: str
    tag: str
    type: str = "string"
    required: bool = False


@dataclass(frozen=True)
class One:
    """A single nested entity; null when absent or empty."""

    name: str
    tag: str
    entity: "Entity"
    required: bool = False


@dataclass(frozen=True)
class Many:
    """A repeated entity under its wrapper element(s); an absent wrapper is an empty list."""

    name: str
    path: tuple[str, ...]
    entity: "Entity"
    skip_if: Callable[[str], str] | None = None


@dataclass(frozen=True)
class Entity:
    fields: tuple = ()
    # Raw leaves that only rules look at; they are parsed but not projected.
    extra_leaves: tuple[str, ...] = ()
    # (name, SQL test of the raw entity) pairs beyond the field checks.
    rules: tuple[tuple[str, Callable[[str], str]], ...] = ()
    # Fields made from several elements; a name without a maker hides a declared field.
    computed: dict[str, Callable[[str], str] | None] = dc_field(default_factory=dict)


def _dot(raw: str, *tags: str) -> str:
    return ".".join([raw, *(f"`{t}`" for t in tags)])


def _text(raw: str, tag: str) -> str:
    return f"nullif({_dot(raw, tag)}, '')"


def _cast(value: str, to: str) -> str:
    return value if to == "string" else f"try_cast(trim({value}) as {to})"


def raw_type(entity: Entity) -> T.StructType:
    """Text-only schema of an entity as it stands in the document."""
    tree: dict = {}

    def put(path: tuple[str, ...], leaf: T.DataType) -> None:
        node = tree
        for tag in path[:-1]:
            node = node.setdefault(tag, {})
        node.setdefault(path[-1], leaf)

    for f in entity.fields:
        if isinstance(f, Leaf):
            put((f.tag,), T.StringType())
        elif isinstance(f, One):
            put((f.tag,), raw_type(f.entity))
        else:
            put(f.path, T.ArrayType(raw_type(f.entity)))
    for tag in entity.extra_leaves:
        put(tuple(tag.split("/")), T.StringType())

    def build(node: dict) -> T.StructType:
        return T.StructType(
            [T.StructField(k, build(v) if isinstance(v, dict) else v) for k, v in node.items()]
        )

    return build(tree)


def _all_null(raw: str, entity: Entity, without: tuple[str, ...] = ()) -> str:
    """An absent element, or one without text and without child elements."""
    parts = [
        f"{_text(raw, f.name) if f.dataType == T.StringType() else _dot(raw, f.name)} is null"
        for f in raw_type(entity).fields
        if f.name not in without
    ]
    return f"({raw} is null or ({' and '.join(parts)}))"


def _items(raw: str, f: Many, var: str) -> str:
    items = f"coalesce({_dot(raw, *f.path)}, array())"
    return items if f.skip_if is None else f"filter({items}, {var} -> not coalesce({f.skip_if(var)}, false))"


def _struct(fields: list[tuple[str, str]]) -> str:
    return "named_struct(" + ", ".join(f"'{name}', {value}" for name, value in fields) + ")"


def _field(f, raw: str, depth: int) -> str:
    if isinstance(f, Leaf):
        return _cast(_text(raw, f.tag), f.type)
    if isinstance(f, One):
        inner = _dot(raw, f.tag)
        return f"if({_all_null(inner, f.entity)}, null, {shape(f.entity, inner, depth)})"
    var = f"x{depth}"
    return f"transform({_items(raw, f, var)}, {var} -> {shape(f.entity, var, depth + 1)})"


def shape(entity: Entity, raw: str, depth: int = 0) -> str:
    """SQL text of the typed projection of a raw entity."""
    fields = [(f.name, _field(f, raw, depth)) for f in entity.fields if f.name not in entity.computed]
    return _struct(fields + [(name, make(raw)) for name, make in entity.computed.items() if make])


def problems(entity: Entity, raw: str, where: str = "", depth: int = 0) -> str:
    """SQL text naming the rules a raw entity breaks: missing, badly typed, or its own rules."""
    single: list[tuple[str, str]] = []
    nested: list[str] = []
    for f in entity.fields:
        name = f"{where}{f.name}"
        if isinstance(f, Leaf):
            value = _text(raw, f.tag)
            if f.required:
                single.append((f"{value} is null", f"{name}:missing"))
            if f.type != "string":
                single.append((f"{value} is not null and {_cast(value, f.type)} is null", f"{name}:{f.type}"))
        elif isinstance(f, One):
            inner = _dot(raw, f.tag)
            gone = _all_null(inner, f.entity)
            if f.required:
                single.append((gone, f"{name}:missing"))
            nested.append(f"if({gone}, array(), {problems(f.entity, inner, name + '.', depth)})")
        else:
            var = f"x{depth}"
            inner = problems(f.entity, var, name + "[].", depth + 1)
            nested.append(f"flatten(transform({_items(raw, f, var)}, {var} -> {inner}))")
    single += [(broken(raw), f"{where}{rule}") for rule, broken in entity.rules]
    own = "array_compact(array(" + ", ".join(f"if({test}, '{name}', null)" for test, name in single) + "))"
    return f"concat({', '.join([own, *nested])})" if nested else own


def _req(name: str, tag: str, type: str = "string") -> Leaf:
    return Leaf(name, tag, type, required=True)


def _items_of(wrapper: str, item: str = "item") -> tuple[str, str]:
    return (wrapper, item)


ACTIVITY = Entity((_req("name", "name"), _req("date", "date", "timestamp")))
_ACTIVITIES = Many("activities", _items_of("activities"), ACTIVITY)
SUBCOMMITTEE = Entity((_req("system_code", "systemCode"), _req("name", "name"), _ACTIVITIES))
COMMITTEE = Entity(
    (
        _req("system_code", "systemCode"),
        _req("name", "name"),
        Leaf("chamber", "chamber"),
        Leaf("type", "type"),
        Many("subcommittees", _items_of("subcommittees"), SUBCOMMITTEE),
        _ACTIVITIES,
    )
)
COMMITTEE_REPORT = Entity((_req("citation", "citation"),))
SOURCE_SYSTEM = Entity((_req("name", "name"), Leaf("code", "code")))
ACTION = Entity(
    (
        _req("action_date", "actionDate", "date"),
        _req("text", "text"),
        Leaf("type", "type"),
        Leaf("action_code", "actionCode"),
        One("source_system", "sourceSystem", SOURCE_SYSTEM),
        Many("committees", _items_of("committees"), COMMITTEE),
    )
)
RELATIONSHIP = Entity((_req("type", "type"), _req("identified_by", "identifiedBy")))
RELATED_BILL = Entity(
    (
        Leaf("title", "title"),
        _req("congress", "congress", "int"),
        _req("number", "number", "int"),
        _req("type", "type"),
        One("latest_action", "latestAction", ACTION),
        Many("relationship_details", _items_of("relationshipDetails"), RELATIONSHIP),
    )
)
TITLE = Entity(
    (
        _req("title_type", "titleType"),
        _req("title", "title"),
        Leaf("chamber_code", "chamberCode"),
        Leaf("chamber_name", "chamberName"),
        Leaf("bill_text_version_name", "billTextVersionName"),
        Leaf("bill_text_version_code", "billTextVersionCode"),
    )
)
IDENTIFIERS = Entity((_req("bioguide_id", "bioguideId"), Leaf("lis_id", "lisID"), Leaf("gpo_id", "gpoId")))
_PERSON = (
    _req("bioguide_id", "bioguideId"),
    _req("full_name", "fullName"),
    _req("first_name", "firstName"),
    _req("last_name", "lastName"),
    _req("party", "party"),
    _req("state", "state"),
)
SPONSOR = Entity(
    _PERSON
    + (
        One("identifiers", "identifiers", IDENTIFIERS),
        Leaf("middle_name", "middleName"),
        Leaf("district", "district"),
        Leaf("is_by_request", "isByRequest"),
    ),
    extra_leaves=("name",),
)


def _only_name(raw: str) -> str:
    return f"{_dot(raw, 'name')} is not null and {_all_null(raw, SPONSOR, without=('name',))}"


_SPONSORS = Many("sponsors", _items_of("sponsors"), SPONSOR, skip_if=_only_name)
COSPONSOR = Entity(
    _PERSON
    + (
        Leaf("middle_name", "middleName"),
        Leaf("district", "district"),
        _req("sponsorship_date", "sponsorshipDate", "date"),
        _req("is_original_cosponsor", "isOriginalCosponsor", "boolean"),
    )
)
COST_ESTIMATE = Entity(
    (
        _req("pub_date", "pubDate", "timestamp"),
        _req("title", "title"),
        _req("url", "url"),
        Leaf("description", "description"),
    )
)
LAW = Entity((_req("type", "type"), _req("number", "number")))
LINK = Entity((_req("name", "name"), _req("url", "url")))
_LINKS = Many("links", _items_of("links", "link"), LINK)
NOTE = Entity((_req("text", "text"), _LINKS))
AMENDED_BILL = Entity(
    (
        _req("congress", "congress", "int"),
        _req("type", "type"),
        _req("origin_chamber", "originChamber"),
        _req("origin_chamber_code", "originChamberCode"),
        _req("number", "number", "int"),
        _req("title", "title"),
        Leaf("update_date_including_text", "updateDateIncludingText", "timestamp"),
    )
)
RECORDED_VOTE = Entity(
    (
        _req("roll_number", "rollNumber", "int"),
        _req("chamber", "chamber"),
        _req("congress", "congress", "int"),
        _req("date", "date", "timestamp"),
        _req("session_number", "sessionNumber", "int"),
        Leaf("url", "url"),
    )
)
AMENDMENT_ACTION = Entity(
    (
        _req("action_date", "actionDate", "date"),
        Leaf("text", "text"),
        Leaf("action_time", "actionTime"),
        _LINKS,
        Leaf("type", "type"),
        Leaf("action_code", "actionCode"),
        One("source_system", "sourceSystem", SOURCE_SYSTEM),
        Many("recorded_votes", _items_of("recordedVotes", "recordedVote"), RECORDED_VOTE),
    )
)


def _bad_count(raw: str) -> str:
    return f"{_dot(raw, 'actions')} is not null and try_cast({_dot(raw, 'actions', 'count')} as int) is null"


AMENDMENT = Entity(
    (
        _req("number", "number", "int"),
        _req("congress", "congress", "int"),
        _req("type", "type"),
        Leaf("description", "description"),
        Leaf("purpose", "purpose"),
        _req("update_date", "updateDate", "timestamp"),
        One("latest_action", "latestAction", AMENDMENT_ACTION),
        _SPONSORS,
        _req("submitted_date", "submittedDate", "timestamp"),
        _req("chamber", "chamber"),
        One("amended_bill", "amendedBill", AMENDED_BILL),
        _LINKS,
        Many("actions", ("actions", "actions", "item"), AMENDMENT_ACTION),
    ),
    extra_leaves=("actions/count",),
    rules=(("actions:count", _bad_count),),
)
FORMAT = Entity((_req("url", "url"),))


def distinct_urls(formats: str) -> str:
    """Different URLs in an array of formats, given and returned as SQL text."""
    return f"array_distinct(array_compact(transform(coalesce({formats}, array()), u -> nullif(u.url, ''))))"


def single_url(formats: str) -> str:
    """The URL when there is exactly one, else null."""
    urls = distinct_urls(formats)
    return f"if(size({urls}) = 1, get({urls}, 0), null)"


def several_urls(formats: str) -> str:
    return f"size({distinct_urls(formats)}) > 1"


def _formats(raw: str) -> str:
    return _dot(raw, "formats", "item")


def _no_version(raw: str) -> str:
    return (
        f"{_text(raw, 'type')} is null and {_text(raw, 'date')} is null "
        f"and size({distinct_urls(_formats(raw))}) = 0"
    )


TEXT_VERSION = Entity(
    (
        _req("type", "type"),
        Leaf("date", "date", "timestamp"),
        Many("formats", _items_of("formats"), FORMAT),
    ),
    rules=(("url:several", lambda raw: several_urls(_formats(raw))),),
    computed={"formats": None, "url": lambda raw: single_url(_formats(raw))},
)
SUMMARY = Entity(
    (
        _req("version_code", "versionCode"),
        _req("action_date", "actionDate", "date"),
        _req("action_desc", "actionDesc"),
        _req("update_date", "updateDate", "timestamp"),
        _req("text", "text"),
    )
)
DUBLIN_CORE = Entity(
    tuple(_req(f"dc_{n}", n) for n in ("format", "language", "rights", "contributor", "description"))
)
SUBJECT = Entity((Leaf("name", "name"),))
POLICY_AREA = Entity((Leaf("name", "name"),))


def agreed(current: str, legacy: str) -> str:
    """Value of two spellings of one field: either alone, or both when equal; else null."""
    return f"if({disagree(current, legacy)}, null, coalesce({current}, {legacy}))"


def disagree(current: str, legacy: str) -> str:
    return f"coalesce({current} <> {legacy}, false)"


def _spellings(raw: str, current: str, legacy: str) -> tuple[str, str]:
    return _text(raw, current), _text(raw, legacy)


_BILL_FIELDS = (
    _req("update_date", "updateDate", "timestamp"),
    Leaf("update_date_including_text", "updateDateIncludingText", "timestamp"),
    _req("origin_chamber", "originChamber"),
    Leaf("origin_chamber_code", "originChamberCode"),
    _req("introduced_date", "introducedDate", "date"),
    _req("congress", "congress", "int"),
    Many("committees", _items_of("committees"), COMMITTEE),
    Many("committee_reports", _items_of("committeeReports", "committeeReport"), COMMITTEE_REPORT),
    Many("related_bills", _items_of("relatedBills"), RELATED_BILL),
    Many(
        "actions",
        _items_of("actions"),
        ACTION,
        skip_if=lambda raw: _all_null(raw, ACTION),
    ),
    _SPONSORS,
    Many("cosponsors", _items_of("cosponsors"), COSPONSOR),
    Many("laws", _items_of("laws"), LAW),
    Many("notes", _items_of("notes"), NOTE),
    Many("cbo_cost_estimates", _items_of("cboCostEstimates"), COST_ESTIMATE),
    One("policy_area", "policyArea", POLICY_AREA),
    Many("subjects", ("subjects", "legislativeSubjects", "item"), SUBJECT),
    Many("summaries", _items_of("summaries", "summary"), SUMMARY),
    _req("title", "title"),
    Many("titles", _items_of("titles"), TITLE),
    Many("amendments", _items_of("amendments", "amendment"), AMENDMENT),
    Many("text_versions", _items_of("textVersions"), TEXT_VERSION, skip_if=_no_version),
    One("latest_action", "latestAction", ACTION, required=True),
)


def _number(raw: str) -> str:
    return _cast(agreed(*_spellings(raw, "number", "billNumber")), "int")


def _type(raw: str) -> str:
    return agreed(*_spellings(raw, "type", "billType"))


BILL = Entity(
    _BILL_FIELDS,
    extra_leaves=("number", "billNumber", "type", "billType"),
    rules=(
        ("number:differs", lambda r: disagree(*_spellings(r, "number", "billNumber"))),
        (
            "number:missing",
            lambda r: f"not {disagree(*_spellings(r, 'number', 'billNumber'))} and {_number(r)} is null",
        ),
        ("type:differs", lambda r: disagree(*_spellings(r, "type", "billType"))),
        ("type:missing", lambda r: f"coalesce({', '.join(_spellings(r, 'type', 'billType'))}) is null"),
    ),
    computed={
        "number": _number,
        "type": _type,
        "policy_area": lambda r: _text(r, "policyArea`.`name"),
        "subjects": lambda r: (
            f"transform(coalesce({_dot(r, 'subjects', 'legislativeSubjects', 'item')}, array()), "
            "s -> nullif(s.name, ''))"
        ),
    },
)


def _decode(df: DataFrame, xml: str, schema: T.StructType, malformed: str, record: str, found: str,
            out: str, violations: str) -> DataFrame:
    """One parse per document: the raw record is projected twice, never read again.

    The result passes through a one-element `inline`. A later filter or explode on the record stays
    above it; pushed below, it would repeat the parse for every field it mentions.
    """
    made = _struct([(out, f"if({malformed}, null, {record})"), (violations, f"if({malformed}, array('malformed'), {found})")])
    parsed = df.withColumn(RAW, F.from_xml(F.trim(xml), schema, XML_OPTIONS))
    return parsed.select(*df.columns, F.inline(F.array(F.expr(made))))


def decode_status(df: DataFrame, xml: str = "bs_xml", out: str = "bs", violations: str = "violations") -> DataFrame:
    """Add the decoded status record and the names of the rules it breaks."""
    bill, core = _dot(RAW, "bill"), _dot(RAW, "dublinCore")
    record = (
        f"transform(array({shape(BILL, bill)}), b -> "
        + _struct(
            [("version", _text(RAW, "version"))]
            + [(n, f"b.{n}") for n in ("number", "type", *[f.name for f in _BILL_FIELDS])]
            + [("dublin_core", shape(DUBLIN_CORE, core))]
        )
        + ")[0]"
    )
    return _decode(
        df,
        xml,
        T.StructType(
            [
                T.StructField("version", T.StringType()),
                T.StructField("bill", raw_type(BILL)),
                T.StructField("dublinCore", raw_type(DUBLIN_CORE)),
                T.StructField(CORRUPT, T.StringType()),
            ]
        ),
        malformed=f"({RAW} is null or {_dot(RAW, CORRUPT)} is not null or {bill} is null)",
        record=record,
        found=f"concat({problems(BILL, bill)}, {problems(DUBLIN_CORE, core, 'dublin_core.')})",
        out=out,
        violations=violations,
    )


RES_ATTRS = Entity(
    (
        _req("dms_id", "_dms-id"),
        _req("key", "_key"),
        _req("public_private", "_public-private"),
        _req("resolution_stage", "_resolution-stage"),
        _req("resolution_type", "_resolution-type"),
        Leaf("stage_count", "_stage-count", "int"),
        _req("star_print", "_star-print"),
    )
)
RES_DUBLIN_CORE = Entity(
    (
        _req("dc_title", "title"),
        _req("dc_publisher", "publisher"),
        Leaf("dc_date", "date", "date"),
        _req("dc_format", "format"),
        _req("dc_language", "language"),
        _req("dc_rights", "rights"),
    )
)
RES_FORM = Entity(
    (
        _req("distribution_code", "distribution-code"),
        _req("congress", "congress"),
        _req("session", "session"),
        _req("legis_num", "legis-num"),
        _req("current_chamber", "current-chamber"),
        _req("legis_type", "legis-type"),
        _req("official_title", "official-title"),
    )
)


def decode_resolution(
    df: DataFrame, xml: str = "tv_xml", out: str = "resolution", violations: str = "violations"
) -> DataFrame:
    """Add attributes, Dublin Core and form of resolution documents."""
    core, form = _dot(RAW, "metadata", "dublinCore"), _dot(RAW, "form")
    return _decode(
        df,
        xml,
        T.StructType(
            raw_type(RES_ATTRS).fields
            + [
                T.StructField(
                    "metadata", T.StructType([T.StructField("dublinCore", raw_type(RES_DUBLIN_CORE))])
                ),
                T.StructField("form", raw_type(RES_FORM)),
                T.StructField(CORRUPT, T.StringType()),
            ]
        ),
        malformed=f"({RAW} is null or {_dot(RAW, CORRUPT)} is not null)",
        record=_struct(
            [
                ("attrs", shape(RES_ATTRS, RAW)),
                ("dublin_core", shape(RES_DUBLIN_CORE, core)),
                ("form", shape(RES_FORM, form)),
            ]
        ),
        found=(
            f"concat({problems(RES_ATTRS, RAW, 'attrs.')}, {problems(RES_DUBLIN_CORE, core, 'dublin_core.')}, "
            f"{problems(RES_FORM, form, 'form.')})"
        ),
        out=out,
        violations=violations,
    )


def root_violation(tag: Column, allowed: tuple[str, ...] = ROOT_TAGS) -> Column:
    """Rule name when a root element is not in the allowed list."""
    return F.when(~F.coalesce(tag.isin(*allowed), F.lit(False)), F.lit("root_tag:unknown"))


def split_quarantine(df: DataFrame, violations: str = "violations") -> tuple[DataFrame, DataFrame]:
    """(rows that keep all rules, rows that break any)."""
    broken = F.size(F.coalesce(violations, F.array().cast("array<string>"))) > 0
    return df.where(~broken).drop(violations), df.where(broken)
