"""Plain text out of markup, with built-in expressions only.

A document is cut once into tokens (comments, CDATA blocks, tags, text). Text of the document, of
one element, or of each child of the root is then a selection of tokens.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, functions as F

from lawloom.constants import SECTION_TAGS

TOKEN_PATTERN = r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>|<[^>]+>|[^<]+|<"
# White space as Unicode defines it, written so that other regex engines read it the same way.
SPACES = (
    r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
)
SPACE_CHARS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + (
    "\u2028\u2029\u202f\u205f\u3000"
)
DEPTH_BLOCK = 64


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once per row and use it in `body` as often as needed."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip_spaces(text: Column) -> Column:
    """Leading and trailing white space removed, line breaks and tabs included."""
    return F.btrim(text, F.lit(SPACE_CHARS))


def singular_spaces(text: Column) -> Column:
    """Each run of white space becomes one space; none at the ends."""
    return F.trim(F.regexp_replace(text, SPACES, " "))


def tidy_spaces(text: Column) -> Column:
    """Tabs dropped, line breaks and no-break spaces turned to spaces, runs of spaces cut to one."""
    flat = F.translate(F.regexp_replace(text, "\t", ""), "\r\n\u00a0", "   ")
    return strip_spaces(F.regexp_replace(flat, " {2,}", " "))


def _from_code_point(ref: Column) -> Column:
    """Character for a numeric reference such as `&#8212;` or `&#x2014;`; no character, no change."""
    digits = F.regexp_extract(ref, r"^&#x?([0-9a-fA-F]+);$", 1)
    hexed = F.when(F.substring(ref, 3, 1) == "x", digits).otherwise(F.conv(digits, 10, 16))
    point = F.conv(hexed, 16, 10).cast("bigint")
    valid = (point > 0) & (point <= 0x10FFFF) & ~point.between(0xD800, 0xDFFF)
    return F.when(valid, F.decode(F.unhex(F.lpad(hexed, 8, "0")), "UTF-32")).otherwise(ref)


def unescape(text: Column) -> Column:
    """Numeric references and the five named entities of XML turned to characters."""
    raw = text
    refs = F.array_distinct(F.regexp_extract_all(text, F.lit(r"&#(?:x[0-9a-fA-F]{1,6}|[0-9]{1,7});"), F.lit(0)))
    text = F.when(
        F.contains(text, F.lit("&#")),
        F.aggregate(refs, text, lambda acc, r: F.replace(acc, r, _from_code_point(r))),
    ).otherwise(text)
    for name, char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'"), ("amp", "&")):
        text = F.replace(text, F.lit(f"&{name};"), F.lit(char))
    return F.when(F.contains(raw, F.lit("&")), text).otherwise(raw)


def tokens(xml: Column) -> Column:
    return F.regexp_extract_all(xml, F.lit(TOKEN_PATTERN), F.lit(0))


def _is_cdata(tok: Column) -> Column:
    return F.startswith(tok, F.lit("<![CDATA["))


def _is_markup(tok: Column) -> Column:
    return F.startswith(tok, F.lit("<")) & ~_is_cdata(tok)


def _token_text(tok: Column) -> Column:
    return F.when(_is_cdata(tok), F.substring(tok, F.lit(10), F.length(tok) - 12)).otherwise(unescape(tok))


def text_of(toks: Column) -> Column:
    """Text nodes of a token array joined by one space, ends stripped.

    A run of tags between two pieces of text is one separator; a CDATA block is part of its text.
    """
    def piece(ts: Column) -> Column:
        return F.transform(
            ts,
            lambda t, i: F.when(~_is_markup(t), _token_text(t)).when(
                (i > 0) & ~_is_markup(F.get(ts, i - 1)), F.lit(" ")
            ).otherwise(F.lit("")),
        )

    return strip_spaces(bind(toks, lambda ts: F.array_join(piece(ts), "")))


def all_text(xml: Column) -> Column:
    """Text of the whole document."""
    return text_of(tokens(xml))


def element_text(xml: Column, tag: str) -> Column:
    """Text of the first element named `tag`, null when it is absent."""
    inner = F.regexp_extract(xml, rf"(?s)<{tag}(?:\s[^>]*)?>(.*?)</{tag}\s*>", 1)
    return F.when(xml.rlike(rf"(?s)<{tag}(?:\s[^>]*)?>(.*?)</{tag}\s*>"), text_of(tokens(inner)))


def section_text(xml: Column, tags: Sequence[str] = SECTION_TAGS, singular: bool = True) -> Column:
    """Text of the named sections in the given order, absent ones left out, blank line between."""
    def one(tag: str) -> Column:
        text = element_text(xml, tag)
        return singular_spaces(text) if singular else text

    return F.array_join(F.array_compact(F.array(*[one(t) for t in tags])), "\n\n")


_OPEN, _CLOSE, _EMPTY, _OTHER = 1, -1, 9, 0


def _kind(tok: Column) -> Column:
    """What a token does to the depth."""
    def starts(prefix: str) -> Column:
        return F.startswith(tok, F.lit(prefix))

    return (
        F.when(~starts("<") | starts("<!") | starts("<?"), F.lit(_OTHER))
        .when(starts("</"), F.lit(_CLOSE))
        .when(F.endswith(tok, F.lit("/>")), F.lit(_EMPTY))
        .otherwise(F.lit(_OPEN))
    )


def _change(kind: Column) -> Column:
    return F.when(kind == _EMPTY, F.lit(0)).otherwise(kind)


def _depths(kinds: Column, block: int = DEPTH_BLOCK) -> Column:
    """Depth after each token, summed in blocks, so that cost stays linear in the token count."""
    ints = F.array().cast("array<int>")

    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), lambda a, k: a + _change(k))

    def within(part: Column, start: Column) -> Column:
        return F.aggregate(
            part,
            F.struct(start.alias("d"), ints.alias("out")),
            lambda acc, k: F.struct(
                (acc["d"] + _change(k)).alias("d"),
                F.concat(acc["out"], F.array(acc["d"] + _change(k))).alias("out"),
            ),
            lambda acc: acc["out"],
        )

    n_blocks = F.ceil(F.size(kinds) / F.lit(block)).cast("int")
    parts = F.transform(F.sequence(F.lit(0), n_blocks - 1), lambda b: F.slice(kinds, b * block + 1, F.lit(block)))
    made = bind(
        parts,
        lambda ps: bind(
            F.transform(ps, total),
            lambda sums: F.flatten(
                F.transform(
                    ps,
                    lambda p, b: within(
                        p, F.aggregate(F.slice(sums, F.lit(1), b), F.lit(0), lambda a, x: a + x)
                    ),
                )
            ),
        ),
    )
    return F.when(F.size(kinds) > 0, made).otherwise(ints)


def scanned(xml: Column, depth: int = 1) -> Column:
    """One pass over a document's tokens: struct<children, is_balanced>.

    `children` are the elements whose parent lies at `depth` (the root is at depth 1), in document order, as
    array<struct<name, text>>; elements that never close are left out, which `is_balanced` tells.
    """
    def body(tk: Column, kind: Column, dep: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(tk) - 1)

        def places(what: int, level: int) -> Column:
            return F.filter(at, lambda i: (F.get(kind, i) == what) & (F.get(dep, i) == level))

        spans = F.concat(
            F.zip_with(
                places(_OPEN, depth + 1), places(_CLOSE, depth), lambda s, e: F.struct(s.alias("s"), e.alias("e"))
            ),
            F.transform(places(_EMPTY, depth), lambda i: F.struct(i.alias("s"), i.alias("e"))),
        )
        spans = F.array_sort(F.filter(spans, lambda x: x["s"].isNotNull() & x["e"].isNotNull()))
        return F.transform(
            spans,
            lambda x: F.struct(
                F.regexp_extract(F.get(tk, x["s"]), r"^<(?:[\w.-]+:)?([^\s/>]+)", 1).alias("name"),
                text_of(F.slice(tk, x["s"] + 1, x["e"] - x["s"] + 1)).alias("text"),
            ),
        )

    def whole(tk: Column, kind: Column, dep: Column) -> Column:
        return F.struct(body(tk, kind, dep).alias("children"), (F.get(dep, F.size(dep) - 1) == 0).alias("is_balanced"))

    found = bind(
        tokens(xml),
        lambda tk: bind(F.transform(tk, _kind), lambda kind: bind(_depths(kind), lambda dep: whole(tk, kind, dep))),
    )
    none = F.array().cast("array<struct<name:string,text:string>>").alias("children")
    return F.when(F.length(xml) > 0, found).otherwise(F.struct(none, F.when(xml.isNotNull(), True).alias("is_balanced")))


def children(xml: Column, depth: int = 1) -> Column:
    """The children that `scanned` gives."""
    return scanned(xml, depth)["children"]


def child_names(xml: Column, depth: int = 1) -> Column:
    """Names only of what `children` gives."""
    return F.transform(children(xml, depth), lambda c: c["name"])


def is_malformed(xml: Column) -> Column:
    """Not one well-formed document: cut short, or with tags that do not match. Nothing of it is decoded."""
    corrupt = "_corrupt"
    options = {"rowTag": "_any", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    parsed = F.from_xml(xml, F.lit(f"{corrupt} string"), options)
    return xml.isNull() | parsed.isNull() | parsed[corrupt].isNotNull()


def is_balanced(xml: Column) -> Column:
    """As many closing as opening tags."""
    return F.aggregate(tokens(xml), F.lit(0), lambda a, t: a + _change(_kind(t))) == 0


def text_of_children(kids: Column) -> Column:
    """Text of a document given its root's children: metadata and blank ones left out."""
    kept = F.filter(kids, lambda c: (c["name"] != "metadata") & (F.length(c["text"]) > 0))
    return F.array_join(F.transform(kept, lambda c: tidy_spaces(c["text"])), "\n\n")


def bill_text(xml: Column) -> Column:
    """Reading text of a bill: one paragraph per child of the root."""
    return text_of_children(children(xml))
