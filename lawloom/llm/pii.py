"""Operator 1: personal data by candidate generators and boosted trees.

Generators with high recall propose spans that may overlap: exact forms of e-mail, IP, card and phone
(the base, always kept), and looser ones (obfuscated e-mail, bracketed or spaced IP, cards with other
separators or lengths, phones without a plus). Each candidate has features of its format and of the
words around it. Gradient boosted trees (MLlib), trained on base spans of a bounded sample together
with rewritten (still personal) and broken (no longer personal) variants of them, give a probability;
thresholds per kind are calibrated on held-out spans to reach PRECISION; accepted candidates that
overlap no span of any kind are added, the most probable first.

Training data: at most FIT_ROWS different base spans with their contexts, those with the least hashes (a
documented bound of the fit; the search itself covers every text). Equal spans are all held out or all
learned from. Null and empty texts have no spans. Long texts are searched whole,
in linear time. Repeated rows get the same spans each; other columns are kept by `redact`, ignored by
`find`. Without any base span to learn from nothing is added.
"""

from __future__ import annotations

import bisect
import random
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from lawloom.llm.common import bound_batches, slices, stage, strings

KINDS = ("email", "ip", "card", "phone")
FIT_ROWS = 4_000
CONTEXT = 40
PRECISION = 0.98

#: Fixed patterns of the base.
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]+")

#: Looser e-mail: what may stand for the sign, and what must follow. Searched from the sign outwards.
SIGN = re.compile(r"(?i) ?(?:@|[(\[{] ?at ?[)\]}]) ?| at ")
LOOSE_DOMAIN = re.compile(r"(?i)[a-z0-9-]+(?:(?:\.| ?[(\[{] ?dot ?[)\]}] ?| dot )[a-z0-9-]{2,})+")

#: Looser forms with digits, by kind. Bounded repeats, so that each start costs a bounded time.
LOOSE = (
    (1, re.compile(r"(?<![0-9.])[0-9]{1,3}(?: ?(?:\[\.\]|\(\.\)|\.) ?[0-9]{1,3}){3}(?![0-9])")),
    (2, re.compile(r"(?<![0-9])[0-9](?:[ ./_–-]{0,2}[0-9]){11,18}(?![0-9])")),
    (3, re.compile(r"(?<![0-9])(?:\+|00)?(?:[0-9]{1,3}[ .-]{1,2})?\(?[0-9]{2,4}\)?[ ./-]{1,3}[0-9]{2,4}(?:[ .-]{1,2}[0-9]{2,4}){1,4}(?![0-9])")),
)
NEAR_WORDS = re.compile(
    r"(?i)\b(?:e-?mail|mail|contact|phone|tel|call|fax|mobile|cell|card|visa|mastercard|amex|iban|account|ip|address|host|server|"
    r"courriel|téléphone|carte|correo|teléfono|tarjeta|telefon|handy|karte)\b"
)
DATE = re.compile(r"\d{1,4}[./-]\d{1,2}[./-]\d{1,4}$")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base: leftmost, non-overlapping per kind, failing matches dropped."""
    out, after = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > after and LOCAL.match(text[start - 1]):
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((0, start, m.end()))
        after = m.end() if m else at + 1
        at = text.find("@", after)
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = re.sub(r"[ -]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    for m in PHONE.finditer(text):
        if 8 <= sum(map(len, DIGITS.findall(m[0]))) <= 15:
            out.append((3, m.start(), m.end()))
    return out


def loose_spans(text: str) -> list[tuple[int, int, int]]:
    out = []
    for sign in SIGN.finditer(text):
        domain = LOOSE_DOMAIN.match(text, sign.end())
        start = sign.start()
        while domain and start and LOCAL.match(text[start - 1]):
            start -= 1
        if start < sign.start():
            out.append((0, start, domain.end()))
    if DIGITS.search(text):
        found = [(kind, m.start(), m.end()) for kind, form in LOOSE for m in form.finditer(text)]
        out += [c for c in found if c[0] != 3 or sum(map(len, DIGITS.findall(text[c[1] : c[2]]))) <= 15]
    return out


def span_features(text: str, kind: int, start: int, end: int) -> list[float]:
    """Format and context of a candidate. The plus and the exact separators of the base are left out."""
    span, before, after = text[start:end], text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
    groups = DIGITS.findall(span)
    digits = "".join(groups)
    domain = re.split(r"(?i)@|\bat\b", span)[-1] if kind == 0 else ""
    last = re.split(r"(?i)\.|\bdot\b", domain)[-1].strip(" ()[]{}") if domain else ""
    return [
        float(kind),
        float(len(span)),
        float(len(digits)),
        float(len(groups)),
        float(max(map(len, groups), default=0)),
        float(min(map(len, groups), default=0)),
        float(luhn(digits)) if digits else 0.0,
        float(len(groups) == 4 and all(len(g) <= 3 and int(g) <= 255 for g in groups)),
        float(len(set(re.sub(r"[0-9A-Za-z]", "", span)))),
        float(len(last) if last.isalpha() else 0),
        float(len(domain.strip())),
        float(bool(DATE.match(span))),
        float(before[-1:].isalnum() or before[-1:] in ("-", "_", "/", "=", "#", ".")),
        float(after[:1].isalnum() or after[:1] in ("-", "_", "/", "@") or bool(re.match(r"[.,]\d", after))),
        float(bool(NEAR_WORDS.search(before))),
        float(span.count(" ")),
        float(len(set(digits))),
    ]


_FIELDS = [StructField(name, IntegerType()) for name in ("k", "s", "e")]
SPANS = ArrayType(StructType(_FIELDS))
CANDIDATES = ArrayType(StructType([*_FIELDS, StructField("f", ArrayType(DoubleType()))]))
_SPAN = pa.struct([("k", pa.int32()), ("s", pa.int32()), ("e", pa.int32())])
_CANDIDATE = pa.struct([*_SPAN, ("f", pa.list_(pa.float64()))])


def _propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole):
            texts = strings(batch.column("text"))
            likely = pc.match_substring_regex(texts, r"(?i)[0-9@]| at |[(\[{] ?at").to_pylist()
            base, loose, seen = [], [], []
            for text, look in zip(texts.to_pylist(), likely):
                mine = base_spans(text) if look else []
                taken = set(mine)
                others = [c for c in loose_spans(text) if c not in taken] if look else []
                base.append([{"k": k, "s": s, "e": e} for k, s, e in mine])
                loose.append([{"k": k, "s": s, "e": e, "f": span_features(text, k, s, e)} for k, s, e in others])
                seen.append([text[max(0, s - CONTEXT) : e + CONTEXT] for _, s, e in mine])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(base, pa.list_(_SPAN)), pa.array(loose, pa.list_(_CANDIDATE)),
                 pa.array(seen, pa.list_(pa.string()))],
                [*batch.schema.names, "_base", "_loose", "_seen"],
            )


def _variants(kind: int, span: str, rng: random.Random) -> list[tuple[str, int]]:
    """Rewritten (1) and broken (0) forms of a base span."""
    digits = "".join(DIGITS.findall(span))
    wrong = digits[:-1] + str((int(digits[-1]) + rng.randint(1, 9)) % 10) if digits else ""
    if kind == 0:
        local, domain = span.rsplit("@", 1)
        at, dot = rng.choice(["(at)", " at ", "[at]", " (at) "]), rng.choice([".", "(dot)", " dot ", "[dot]"])
        word = rng.choice(["look", "met", "was", "arrive", "und", "il"])
        return [(local + at + domain.replace(".", dot), 1), (f"{word} at {rng.randint(1, 12)}.{rng.randint(10, 59)}", 0),
                (f"{word} at home. {word.title()}", 0), (f"{word} at {word}.{word}", 0)]
    if kind == 1:
        parts = span.split(".")
        high = [str(rng.randint(256, 999)), *parts[1:]]
        return [("[.]".join(parts), 1), (" . ".join(parts), 1), (".".join(high), 0), ("[.]".join(high), 0)]
    if kind == 2:
        sep = rng.choice([".", "/", "  ", "–"])
        cut = lambda d: sep.join(d[i : i + 4] for i in range(0, len(d), 4))
        return [(cut(digits), 1), (cut(wrong), 0), (wrong, 0), (digits[:13] if not luhn(digits[:13]) else wrong, 0)]
    ten = digits[-10:]
    pairs = " ".join(ten[i : i + 2] for i in range(0, len(ten), 2))
    return [(f"{ten[:3]}-{ten[3:6]}-{ten[6:]}", 1), (f"({ten[:3]}) {ten[3:6]}-{ten[6:]}", 1), (pairs, 1),
            (f"{rng.randint(1900, 2030)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}", 0),
            (f"{rng.randint(1, 28):02}.{rng.randint(1, 12):02}.{rng.randint(1900, 2030)}", 0),
            (f"{rng.randint(10, 99)} {rng.randint(10, 99)} {rng.randint(10, 99)}", 0)]


def training_rows(samples: list[tuple[int, str, str]], seed: int = 7) -> list[tuple[bool, float, list[float]]]:
    """(held out, label, features) from base spans given as (kind, span, text around it)."""
    rng, out = random.Random(seed), []
    for kind, span, around in samples:
        held = zlib.crc32(span.encode()) % 3 == 0
        at = around.find(span)
        before, after = around[:at], around[at + len(span) :]
        for form, label in [(span, 1), *_variants(kind, span, rng)]:
            features = span_features(before + form + after, kind, len(before), len(before) + len(form))
            out.append((held, float(label), features))
    return out


def fit(rows: DataFrame, fit_rows: int = FIT_ROWS):
    """The trees and the threshold of each kind, or None when there is no base span to learn from."""
    sample = (
        rows.where(F.size("_base") > 0).select(F.explode(F.arrays_zip("_base", "_seen")).alias("x"))
        .select(F.col("x._base.k").alias("k"), (F.col("x._base.e") - F.col("x._base.s")).alias("n"),
                F.least(F.col("x._base.s"), F.lit(CONTEXT)).alias("lead"), F.col("x._seen").alias("seen"))
        .distinct().orderBy(F.xxhash64("k", "seen"), "k", "seen", "lead", "n").limit(fit_rows).collect()
    )
    if not sample:
        return None
    data = training_rows([(r["k"], r["seen"][r["lead"] : r["lead"] + r["n"]], r["seen"]) for r in sample])
    if all(held for held, _, _ in data):
        return None
    spark = rows.sparkSession
    frame = spark.createDataFrame(data, "held boolean, label double, f array<double>").select(
        "held", "label", F.col("f")[0].cast("int").alias("k"), array_to_vector("f").alias("features")
    ).coalesce(2)  # a bounded sample
    model = GBTClassifier(maxIter=8, maxDepth=4, stepSize=0.3, seed=11).fit(frame.where("NOT held"))
    held = model.transform(frame.where("held")).select("k", "label", vector_to_array("probability")[1].alias("p")).collect()
    limits = {}
    for kind in range(len(KINDS)):
        scores = sorted(((r["p"], r["label"]) for r in held if r["k"] == kind), reverse=True)
        good, limits[kind] = 0.0, 2.0  # above every probability: nothing is added
        for n, (p, label) in enumerate(scores, 1):
            good += label
            if good / n >= PRECISION and (n == len(scores) or scores[n][0] < p):
                limits[kind] = max(0.5, p)
    return model, limits


def _resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Base spans and the accepted candidates that overlap none before them, the most probable first."""
    for batch in batches:
        out = []
        for base, more in zip(batch.column("_base").to_pylist(), batch.column("_added").to_pylist()):
            # Bounds of what is taken, merged where base spans of two kinds overlap.
            starts, ends = [], []
            for x in sorted(base, key=lambda x: x["s"]):
                if ends and x["s"] < ends[-1]:
                    ends[-1] = max(ends[-1], x["e"])
                else:
                    starts.append(x["s"])
                    ends.append(x["e"])
            taken = list(base)
            for x in more:
                at = bisect.bisect_left(ends, x["s"] + 1)
                if at == len(starts) or starts[at] >= x["e"]:
                    starts.insert(at, x["s"])
                    ends.insert(at, x["e"])
                    taken.append(x)
            out.append(sorted(taken, key=lambda x: (x["k"], x["s"], x["e"])))
        yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(out, pa.list_(_SPAN))], ["_row", "_spans"])


def all_spans(rows: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Staged proposals with `spans`: base spans and accepted candidates, by kind, then start."""
    fitted = fit(rows, fit_rows)
    resolved = StructType([StructField("_row", LongType()), StructField("_spans", SPANS)])
    if fitted is None:
        added = rows.sparkSession.createDataFrame([], resolved)
    else:
        model, limits = fitted
        scored = model.transform(
            rows.where(F.size("_loose") > 0).select("_row", F.explode("_loose").alias("c"))
            .select("_row", "c", array_to_vector("c.f").alias("features"))
        ).withColumn("p", vector_to_array("probability")[1])
        limit = F.element_at(F.array(*[F.lit(limits[k]) for k in range(len(KINDS))]), F.col("c.k") + 1)
        best = F.array_sort(F.collect_list(F.struct((-F.col("p")).alias("q"), "c.k", "c.s", "c.e")))
        accepted = (
            scored.where(F.col("p") >= limit).groupBy("_row")
            .agg(F.transform(best, lambda x: F.struct(x["k"].alias("k"), x["s"].alias("s"), x["e"].alias("e"))).alias("_added"))
        )
        added = stage(accepted.join(rows.select("_row", "_base"), "_row").mapInArrow(_resolve, resolved), "pii-added")
    spans = F.coalesce("_spans", F.array_sort("_base"))
    return rows.join(added, "_row", "left").withColumn("spans", spans).drop("_spans")


def _text(spans):
    name = lambda x: F.element_at(F.array(*map(F.lit, KINDS)), x["k"] + 1)
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", name(x), x["s"], x["e"])), ",")


def propose(docs: DataFrame, carry: list[str]) -> DataFrame:
    """Base spans and looser candidates of every row; `_row` numbers the rows, `doc` holds the columns carried along."""
    bound_batches(docs.sparkSession)
    numbered = docs.select(F.struct(*carry).alias("doc"), "text", F.monotonically_increasing_id().alias("_row"))
    found = [StructField("_base", SPANS), StructField("_loose", CANDIDATES), StructField("_seen", ArrayType(StringType()))]
    return numbered.mapInArrow(_propose, StructType([*numbered.schema, *found]))


def find(docs: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Per row: doc_id, counts per kind and digest of the base, and all spans."""
    rows = stage(propose(docs, ["doc_id"]).drop("text"), "pii")
    count = lambda k: F.size(F.filter("_base", lambda x: x["k"] == k)).cast("long")
    return all_spans(rows, fit_rows).select(
        "doc.doc_id",
        *[count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sha2(_text(F.col("_base")), 256).alias("base_sha256"),
        _text(F.col("spans")).alias("spans"),
    )


def _redacted(text: str | None, spans: list[dict]) -> str | None:
    if not spans:
        return text
    out, at = [], 0
    for span in sorted(spans, key=lambda x: (x["s"], -x["e"])):
        if span["s"] >= at:
            out += [text[at : span["s"]], f"[{KINDS[span['k']].upper()}]"]
        at = max(at, span["e"])
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """`docs` with every span replaced by its kind in brackets, and n_chars, if there, set anew."""
    names = docs.columns
    rows = stage(propose(docs, [c for c in names if c != "text"] or ["text"]), "pii-texts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = map(_redacted, batch.column("text").to_pylist(), batch.column("spans").to_pylist())
            new, doc = pa.array(texts, pa.string()), batch.column("doc")
            yield pa.RecordBatch.from_arrays([new if n == "text" else doc.field(n) for n in names], names)

    out = all_spans(rows, fit_rows).select("doc", "text", "spans").mapInArrow(run, docs.schema)
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out
