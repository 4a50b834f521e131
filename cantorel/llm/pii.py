"""Personal data in texts, with DataFrame functions only.

Regular expressions propose spans of each kind, checksum and range validators confirm them,
and words near a span move its score. Positions come from the pieces between the matches:
splitting a text by a pattern and extracting the pattern visit the same matches, so running
lengths of pieces and matches are the spans' bounds, in code points.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters of context on each side of a span.
NEAR = 40
#: A span of an added kind is kept from this score on; base kinds are always kept.
KEEP = 0.5
#: How far words of a kind's own context lift a score towards 1, and what is left of it beside words of other numbers alone.
LIFT, LOWERED = 0.8, 0.6
#: Words that numbers of other kinds stand beside.
AGAINST = "order|serial|sku|version|isbn|invoice"
#: Matches whose places are summed up together; see ``_places``.
BLOCK = 64


@dataclass(frozen=True)
class Kind:
    """A kind of personal data. ``base`` kinds are kept whatever their score."""

    name: str
    pattern: str
    context: str
    prior: float
    base: bool = True


# Possessive forms of the stated patterns: what follows a greedy run can never start inside it,
# so giving characters back or starting later in a run can't make a match. \G lets a match start
# where the last one ended.
KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "mail|contact|write|correo|courriel", 0.9),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "(^|[^a-z0-9])ip([^a-z0-9]|$)|host|server|address|adresse|login", 0.7),
    Kind("card", r"(?:\G|(?<![0-9]))[0-9](?:[\x20-]?[0-9])++", "card|visa|master|credit|karte|carte|tarjeta|pay", 0.8),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "phone|call|tel|fax|mobil|whatsapp", 0.7),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])", "iban|bank|account|konto|compte|cuenta|transfer", 0.6, base=False),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "(^|[^a-z0-9])ssn([^a-z0-9]|$)|social|security|taxpayer", 0.3, base=False),
)
_ORDER = {k.name: i for i, k in enumerate(KINDS)}


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(s: Column) -> Column:
    """Whether the digits of ``s`` pass the Luhn check."""
    each = F.transform(F.split(F.reverse(_digits(s)), "(?!$)"), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(2 * c.cast("int") - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(s: Column) -> Column:
    """Whether an account number passes the mod-97 check."""
    plain = F.regexp_replace(s, r"\x20", "")
    turned = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))
    step = lambda a, c: F.when(c.rlike("[0-9]"), a * 10 + F.ascii(c) - 48).otherwise(a * 100 + F.ascii(c) - 55) % 97
    return F.aggregate(F.split(turned, "(?!$)"), F.lit(0), step) == 1


def _valid(kind: Kind, s: Column) -> Column:
    n = F.length(_digits(s))
    if kind.name == "ip":
        # a part's leading zeros don't count
        return F.forall(F.split(s, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.right(F.concat(F.lit("000"), p), F.lit(3)).cast("int") <= 255))
    if kind.name == "card":
        return n.between(14, 19) & luhn(s)
    if kind.name == "phone":
        return n.between(10, 15)
    if kind.name == "iban":
        return F.length(F.regexp_replace(s, r"\x20", "")).between(15, 34) & mod97(s)
    if kind.name == "ssn":
        return ~s.rlike("^(000|666|9)") & ~s.rlike("-00-") & ~s.rlike("-0000$")
    return F.lit(True)


def _places(hits: Column, gaps: Column) -> Column:
    """Array of (start, value) of hits that each follow a gap of the given length.

    Arrays can only be copied to grow, so places are summed within blocks of BLOCK hits, and over
    the blocks: the time is linear but for the number of blocks, whose square is 4,096 times less.
    """
    each = F.zip_with(hits, F.slice(gaps, 1, F.size(hits)), lambda h, g: F.struct(h.alias("h"), g.alias("g")))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(hits) - 1) / BLOCK).cast("int")), lambda i: F.slice(each, i * BLOCK + 1, BLOCK))
    size = lambda x: x["g"] + F.length(x["h"])
    firsts = F.aggregate(
        F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda a, x: a + size(x))),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
        lambda a, n: F.struct((a["at"] + n).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")),
        lambda a: a["out"],
    )
    within = lambda b, first: F.aggregate(
        b,
        F.struct(first.alias("at"), F.array().cast("array<struct<start:int,value:string>>").alias("out")),
        lambda a, x: F.struct((a["at"] + size(x)).alias("at"), F.concat(a["out"], F.array(F.struct((a["at"] + x["g"]).alias("start"), x["h"].alias("value")))).alias("out")),
        lambda a: a["out"],
    )
    return F.flatten(F.zip_with(blocks, firsts, within))


def _found(kind: Kind, text: Column) -> Column:
    """Array of (start, end, order, kind, value, score) of one kind's confirmed spans."""
    hits = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    gaps = F.transform(F.split(text, kind.pattern, -1), lambda p: F.length(p))
    around = lambda s: F.lower(F.substr(text, F.greatest(s["start"] - NEAR, F.lit(0)) + 1, F.length(s["value"]) + 2 * NEAR))
    score = lambda s: (
        F.when(around(s).rlike(kind.context), kind.prior + LIFT * (1 - kind.prior)).when(around(s).rlike(AGAINST), LOWERED * kind.prior).otherwise(kind.prior)
    )
    spans = F.transform(
        F.filter(_places(hits, gaps), lambda s: _valid(kind, s["value"])),
        lambda s: F.struct(
            s["start"].alias("start"), F.lit(_ORDER[kind.name]).alias("order"), (s["start"] + F.length(s["value"])).alias("end"),
            F.lit(kind.name).alias("kind"), s["value"].alias("value"), score(s).alias("score"),
        ),
    )
    if not kind.base:
        spans = F.filter(spans, lambda s: s["score"] >= KEEP)
    return F.when(text.rlike(kind.pattern), spans).otherwise(F.array().cast(_SPANS))


_SPANS = "array<struct<start:int,order:int,end:int,kind:string,value:string,score:double>>"


def spans_of(text: Column) -> Column:
    """All confirmed spans of a text, ordered by start, then kind; null and empty texts have none.

    Each span is a struct (start, order, end, kind, value, score), bounds in code points of the
    whole text, end exclusive. The base kinds email, ip, card and phone are all given, with the
    score of their context; iban (mod-97) and ssn are added to them where their score is at
    least KEEP: an iban unless only words of other numbers stand near, an ssn only with words of
    its own near. Spans of different kinds can overlap. Repeated rows have the same spans, and
    texts may be of any length and hold any number of matches.
    """
    text = F.coalesce(text, F.lit(""))
    return F.array_sort(F.concat(*[_found(k, text) for k in KINDS]))


def joined(spans: Column, base_only: bool = False) -> Column:
    """kind:start:end of spans, comma-joined."""
    if base_only:
        spans = F.filter(spans, lambda s: s["order"].isin([_ORDER[k.name] for k in KINDS if k.base]))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def scores(spans: Column) -> Column:
    """Scores of spans in hundredths, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.round(s["score"] * 100).cast("int").cast("string")), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span (overlapping ones as one, named by the first) put as [KIND]."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    step = lambda a, s: F.when(
        s["start"] >= a["at"],
        F.struct(s["end"].alias("at"), F.concat(a["out"], F.substr(text, a["at"] + 1, s["start"] - a["at"]), F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("out")),
    ).otherwise(F.struct(F.greatest(a["at"], s["end"]).alias("at"), a["out"].alias("out")))
    return F.when(F.size(spans) == 0, text).otherwise(
        F.aggregate(spans, start, step, lambda a: F.concat(a["out"], F.substr(text, a["at"] + 1)))
    )


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, spans) for every row; null ids and repeated rows stay."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.withColumn("spans", spans_of(F.col("text")))


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with all spans of its texts replaced; null texts stay null, all other columns, whatever their names, as they were."""
    text = F.col(text_col)
    return docs.withColumn(text_col, F.when(text.isNotNull(), redacted(text, spans_of(text))))
