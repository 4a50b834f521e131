"""Wiki markup to headings and file attachments, and the strict rules that select files.

One Arrow-batched UDF turns a page into rows; everything after it is relational.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructField, StructType

from cantorel.functions import rules
from cantorel.session import source_id

ORIGINAL, ARRANGEMENT = "scores and parts", "arrangements and transcriptions"
#: A heading that starts so relates its parent's instruments to others.
RELATION = r"^(?:(?:and|or|with|plus)\b|[,&/+;:–—-])"

_COMMENT = re.compile(r"<!--.*?-->", re.S)
_MARK = r"(?m)^[ \t]*\|[ \t]*\*{5}%s\*{5}[ \t]*(?:=[ \t]*)?\r?$"
_FILES, _INFO = re.compile(_MARK % "FILES"), re.compile(_MARK % "WORK INFO")
_HEADING = re.compile(r"(?m)^(={2,6})[ \t]*(.*?)[ \t]*\1[ \t]*$")
_FIELD = re.compile(r"(?mi)^[ \t]*\|{1,2}[ \t]*File (Name|ID)(?:[ \t]+([1-9][0-9]*))?[ \t]*=[ \t]*([^\r\n]*)$")
# Fixed value: the name of the template that attaches files.
FILE_TEMPLATE = "#fte:imslpfile"
_TEMPLATE = re.compile(rf"(?i)\{{\{{[ \t]*{FILE_TEMPLATE}\b")


def normal_heading(s: str) -> str:
    """A heading without markup: comments dropped, templates as their last argument, links as their text, folded."""
    s = _COMMENT.sub("", unicodedata.normalize("NFC", html.unescape(s)))
    last = lambda m: m[1].rpartition("|")[2] if "|" in m[1] else ""
    n = 1
    while n:
        s, n = re.subn(r"\{\{([^{}]*)\}\}", last, s)
    s = re.sub(r"\[\[(?:[^\]|]*\|)?([^\]]+)\]\]", r"\1", s)
    s = re.sub(r"\[https?://\S+(?:\s+([^\]]+))?\]", lambda m: m[1] or "", s)
    s = re.sub(r"'{2,5}", "", re.sub(r"<[^>]+>", " ", s))
    return unicodedata.normalize("NFC", " ".join(unicodedata.normalize("NFC", s).split()).casefold())


def _blank_comments(s: str) -> str:
    return _COMMENT.sub(lambda m: re.sub(r"[^\r\n]", " ", m[0]), s)


def _spans(s: str) -> list[tuple[int, int]] | None:
    """Outermost {{...}} spans; None if one isn't closed."""
    out, opened = [], []
    for m in re.finditer(r"\{\{|\}\}", s):
        if m[0] == "{{":
            opened.append(m.start())
        elif opened:
            a = opened.pop()
            if not opened:
                out.append((a, m.end()))
    return None if opened else out


def _attachments(raw: str, a: int, b: int) -> list[dict] | str:
    ids: dict[int | None, list[str]] = {}
    names = []
    for m in _FIELD.finditer(raw):
        if m[1].lower() == "id":
            ids.setdefault(int(m[2]) if m[2] else None, []).append(m[3].strip())
        elif m[2]:
            names.append((int(m[2]), m.start(), html.unescape(m[3]).strip()))
    if not names:
        return "file_template_missing_filename"
    if not all(n[2] for n in names):
        return "file_template_empty_filename"
    out = []
    for index, _, name in sorted(names):
        own = set(ids.get(None, []) + ids.get(index, []))
        out.append({"file_id": own.pop() if len(own) == 1 else None, "filename": name, "attachment_index": index, "file_id_conflict": len(own) > 1, "span_start": a, "span_end": b, "raw": raw})
    return out


def parse_page(text: str) -> dict:
    """(error, nodes, instrumentation) of one page; nodes are headings in order, each with its attachments.

    A page without a FILES region has the error files_region_invalid. Attachments before any
    heading belong to a node of level 0.
    """
    shown = _blank_comments(text)
    start = _FILES.search(shown)
    stop = _INFO.search(shown, start.end()) if start else None
    none = {"error": None, "nodes": [], "instrumentation": None, "instrumentation_normalized": None}
    if not stop:
        return none | {"error": "files_region_invalid"}
    base = start.end()
    region, seen = text[base : stop.start()], shown[base : stop.start()]
    spans = _spans(seen)
    if spans is None:
        return none | {"error": "unbalanced_template"}
    events: list[tuple[int, int, object]] = [(a, 1, b) for a, b in spans if _TEMPLATE.match(seen, a)]
    for m in _HEADING.finditer(region):
        if seen[m.start()] == "=" and not any(a <= m.start() < b for a, b in spans):
            events.append((m.start(), 0, m))
    nodes = [{"node_ord": 0, "level": 0, "raw": None, "normalized": None, "ancestry": [], "ancestry_normalized": [], "attachments": []}]
    path: list[dict] = []
    for at, kind, what in sorted(events, key=lambda e: e[:2]):
        if kind:
            found = _attachments(region[at:what], base + at, base + what)
            if isinstance(found, str):
                return none | {"error": found}
            nodes[-1]["attachments"] += found
            continue
        level, raw = len(what[1]), what[2].strip()
        path = [p for p in path if p["level"] < level]
        node = {"node_ord": len(nodes), "level": level, "raw": raw, "normalized": normal_heading(raw), "attachments": []}
        path.append(node)
        for name, part in (("ancestry", "raw"), ("ancestry_normalized", "normalized")):
            node[name] = [p[part] for p in path]
        nodes.append(node)
    tail = text[stop.start() :]
    found = re.search(r"(?m)^\|Instrumentation=([^\r\n]*)$", shown[stop.start() :])
    scored = tail[found.start(1) : found.end(1)].strip() if found else None
    return {"error": None, "nodes": nodes, "instrumentation": scored or None, "instrumentation_normalized": normal_heading(scored) if scored else None}


_TEXT, _TEXTS = StringType(), ArrayType(StringType())
_ATTACHMENT = StructType([StructField(n, t) for n, t in (
    ("file_id", _TEXT), ("filename", _TEXT), ("attachment_index", IntegerType()), ("file_id_conflict", BooleanType()),
    ("span_start", IntegerType()), ("span_end", IntegerType()), ("raw", _TEXT),
)])
_NODE = StructType([StructField(n, t) for n, t in (
    ("node_ord", IntegerType()), ("level", IntegerType()), ("raw", _TEXT), ("normalized", _TEXT), ("ancestry", _TEXTS), ("ancestry_normalized", _TEXTS),
    ("attachments", ArrayType(_ATTACHMENT)),
)])
_PAGE = StructType([StructField(n, t) for n, t in (("error", _TEXT), ("nodes", ArrayType(_NODE)), ("instrumentation", _TEXT), ("instrumentation_normalized", _TEXT))])


#: Bytes of markup whose trees a worker holds at once; a longer page is alone.
_AT_ONCE = 1 << 20


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages with their trees instead of their markup, in small batches, as a tree is many times its markup."""
    for batch in batches:
        text = batch.column("wikitext")
        size = np.cumsum(pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        starts = np.flatnonzero(np.append(True, np.diff(size // _AT_ONCE) != 0)) if len(size) else size
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(size)]):
            part = batch.slice(a, b - a)
            trees = pa.array([parse_page(t or "") for t in part.column("wikitext").to_pylist()], to_arrow_type(_PAGE))
            names = [n for n in batch.schema.names if n != "wikitext"]
            yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), trees], [*names, "p"])


@pandas_udf(StringType())
def heading_normalized(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else normal_heading(x))


def parsed(pages: DataFrame) -> DataFrame:
    """Pages (page_id, revision_id, wikitext, ...) with their error, instrumentation and nodes instead of their markup."""
    keep = [c for c in pages.columns if c != "wikitext"]
    rows = pages.mapInArrow(_parsed, StructType([*(pages.schema[c] for c in keep), StructField("p", _PAGE)]))
    return rows.select(*keep, "p.*")


def headings(pages: DataFrame) -> DataFrame:
    """Pages (page_id, revision_id, wikitext) to one row a heading and attachment; pages with an error have one row with it."""
    keep = [c for c in pages.columns if c != "wikitext"]
    rows = parsed(pages).select(*keep, "error", "instrumentation", "instrumentation_normalized", F.explode_outer("nodes").alias("n"))
    rows = rows.select(*keep, "error", "instrumentation", "instrumentation_normalized", "n.*").withColumn("attachment", F.explode_outer("attachments")).drop("attachments")
    return rows.filter("error is not null or level > 0 or attachment is not null")


#: Deepest level of a heading.
_LEVELS = 6


def section_spans(headings: DataFrame) -> DataFrame:
    """Heading rows (page_id, revision_id, node_ord, level) with ``end_ord``, the next heading of the same or a higher rank, null at the page's end.

    One pass over each page's headings: for each level the next heading of at most that level.
    """
    after = Window.partitionBy("page_id", "revision_id").orderBy("node_ord").rowsBetween(1, Window.unboundedFollowing)
    ends = F.array(*[F.min(F.when(F.col("level") <= n, F.col("node_ord"))).over(after) for n in range(1, _LEVELS + 1)])
    return headings.withColumn("end_ord", F.get(ends, F.col("level") - 1))


def page_violations(decisions: DataFrame) -> DataFrame:
    """The pages that ``extract`` could not read, as a violation each, for a build that must have none."""
    bad = decisions.filter("disposition = 'invalid_page'").select("page_id", "revision_id", "reason_code").distinct()
    return rules.violation(bad, "invalid_page", F.concat_ws("@", "page_id", "revision_id"), F.col("reason_code"))


def associate(files: DataFrame, scores: DataFrame) -> DataFrame:
    """Attachment rows with ``file_id`` and ``metadata_reason`` from frozen score metadata, one to one.

    First by explicit id, then by a file name that is unique and not claimed.
    """
    page = ["page_id", "revision_id"]
    a = files.withColumn("explicit", F.col("attachment.file_id")).withColumn("filename", F.col("attachment.filename"))
    same_id = Window.partitionBy(*page, "explicit")
    kinds = F.size(F.collect_set(F.struct("filename", "attachment.attachment_index", "attachment.raw")).over(same_id))
    a = a.withColumn("id_conflict", ~F.col("explicit").rlike(r"^[1-9][0-9]*\z") | F.max("attachment.file_id_conflict").over(same_id) | (kinds != 1))
    plain = Window.partitionBy(*page, "explicit", "filename")
    a = a.withColumn("same_name", F.count("*").over(plain))
    s = scores.select("page_id", F.col("page_revision_id").alias("revision_id"), F.col("file_id").alias("s_id"), F.col("filename").alias("s_name"))
    by_id = s.groupBy(*page, F.col("s_id").alias("explicit")).agg(F.count("*").alias("n_id"), F.min("s_name").alias("id_name"))
    by_name = s.groupBy(*page, F.col("s_name").alias("filename")).agg(F.count("*").alias("n_name"), F.min("s_id").alias("name_id"), F.max("s_id").alias("name_id_max"))
    rows = a.join(by_id, [*page, "explicit"], "left").join(by_name, [*page, "filename"], "left")
    other = F.col("name_id").isNotNull() & ((F.col("name_id") != F.col("explicit")) | (F.col("name_id_max") != F.col("explicit")))
    bad = F.col("id_conflict") | F.coalesce(F.col("n_id") > 1, F.lit(False)) | F.coalesce(F.col("id_name") != F.col("filename"), F.lit(False)) | other
    by_explicit = rules.first_match([(bad, "file_metadata_conflict"), (F.col("n_id").isNull(), "file_metadata_missing")])
    rows = rows.withColumn("by_explicit", F.when(F.col("explicit").isNotNull(), F.coalesce(by_explicit, F.lit("ok"))))
    claimed = rows.filter("by_explicit = 'ok'").select(*page, F.col("explicit").alias("name_id"), F.lit(True).alias("claimed")).distinct()
    rows = rows.join(claimed, [*page, "name_id"], "left")
    by_plain = rules.first_match([
        (F.col("attachment.file_id_conflict"), "file_metadata_conflict"), ((F.col("same_name") > 1) | (F.col("n_name") > 1), "file_metadata_ambiguous"),
        (F.col("n_name").isNull(), "file_metadata_missing"), (F.coalesce("claimed", F.lit(False)), "file_metadata_ambiguous"),
    ])
    reason = F.when(F.col("explicit").isNull(), by_plain).otherwise(F.nullif("by_explicit", F.lit("ok")))
    rows = rows.withColumn("metadata_reason", reason)
    rows = rows.withColumn("file_id", F.when(reason.isNull(), F.coalesce("explicit", "name_id")).otherwise(F.col("explicit")))
    return rows.select(*files.columns, "file_id", "metadata_reason")


def heading_status(heading: Column, patterns: Column, rejected: Column) -> Column:
    """none, exact, or annotation where the note in parentheses names a rejected instrument.

    The first pattern that matches decides; its note is its group ``annotation``, which is its
    first one, and a pattern without that group has none.
    """
    full = lambda p: F.concat(F.lit("(?iu)^(?:"), F.regexp_replace(p, r"\(\?P<", "(?<"), F.lit(r")\z"))
    hits = F.filter(patterns, lambda p: F.rlike(heading, full(p)))
    first = F.get(hits, F.lit(0))
    note = F.when(first.contains("(?P<annotation>"), F.get(F.regexp_extract_all(heading, full(first), F.lit(1)), F.lit(0))).otherwise("")
    words = F.regexp_extract_all(note, F.lit(r"(?U)\w+"), F.lit(0))
    return F.when(F.size(hits) == 0, "none").when(F.arrays_overlap(words, rejected), "annotation").otherwise("exact")


def extract(pages: DataFrame, categories: DataFrame, scores: DataFrame | None = None, requests: DataFrame | None = None) -> DataFrame:
    """Decisions (page_id, revision_id, category_name, ord, source_id, filename, disposition, reason_code, heading, branch).

    pages (page_id, revision_id, category_names, wikitext); categories (name, kind,
    instrumentation_patterns, heading_patterns, annotation_reject_tokens). A page is decided for
    those of its own categories that are given, or for those that ``requests`` (page_id,
    category_name) asks for, in the fixed order of the gates. A page that can't be read has one
    row of disposition ``invalid_page`` with its error. Each page is parsed once; pages meet
    categories by name.
    """
    whole = parsed(pages).select(
        "page_id", "revision_id", "category_names", "error", "instrumentation", "instrumentation_normalized", "nodes",
        F.transform(F.filter("nodes", lambda n: n["level"] > 0), lambda n: F.struct(F.get(n["ancestry_normalized"], F.lit(0)).alias("branch"), n["normalized"].alias("heading"))).alias("tree"),
    )
    # a page with an error is one node without attachments, so that it takes the same way as others
    lost = F.array(F.lit(None).cast(_NODE))
    rows = whole.withColumn("n", F.explode(F.when(F.col("error").isNotNull(), lost).otherwise(F.col("nodes")))).drop("nodes")
    rows = rows.select(*[c for c in rows.columns if c != "n"], "n.*").withColumn("attachment", F.explode_outer("attachments")).drop("attachments")
    rows = rows.filter("error is not null or attachment is not null")
    if scores is not None:
        rows = associate(rows, scores)
    else:
        rows = rows.withColumn("file_id", F.col("attachment.file_id")).withColumn(
            "metadata_reason", F.when(F.col("attachment.file_id_conflict"), "file_metadata_conflict").when(F.col("attachment.file_id").isNull(), "file_metadata_missing")
        )
    first = Window.partitionBy("page_id", "revision_id", "file_id").orderBy("attachment.span_start", "attachment.attachment_index")
    rows = rows.withColumn("k", F.row_number().over(first)).filter("k = 1 or metadata_reason is not null or file_id is null")
    c = categories.select(*[F.col(x).alias(f"c_{x}") for x in ("name", "kind", "instrumentation_patterns", "heading_patterns", "annotation_reject_tokens")])
    c = c.withColumn("c_base", heading_normalized(F.regexp_replace("c_name", r" \(arr\)$", "")))
    status = lambda h: heading_status(h, F.col("c_heading_patterns"), F.col("c_annotation_reject_tokens"))
    bad = rows.filter("error is not null")
    rows = rows.filter("error is null")
    asked = rows.withColumn("c_name", F.explode(F.array_distinct("category_names"))) if requests is None else rows.join(requests.select("page_id", F.col("category_name").alias("c_name")).distinct(), "page_id")
    rows = asked.join(c, "c_name")
    rows = rows.withColumn("has_arrangement", F.exists("tree", lambda t: t["branch"] == ARRANGEMENT))
    rows = rows.withColumn("has_target", F.exists("tree", lambda t: (t["branch"] == ARRANGEMENT) & (status(t["heading"]) == "exact")))
    below = F.slice("ancestry_normalized", 2, F.greatest(F.size("ancestry_normalized") - 1, F.lit(1)))
    suffix = lambda h: F.ltrim(F.substr(h, F.length("c_base") + 1))
    mixed_target = lambda h: h.startswith(F.col("c_base")) & (suffix(h) != "") & ~suffix(h).startswith("(") & suffix(h).rlike(RELATION)
    others = F.filter("c_annotation_reject_tokens", lambda t: t != "guitar")
    mixed_other = lambda h: h.rlike(RELATION) | F.arrays_overlap(F.regexp_extract_all(h, F.lit(r"(?U)\w+"), F.lit(0)), others)
    verdict = lambda h: rules.first_match([
        (status(h) == "annotation", "annotation_contains_instrument"), (status(h) == "exact", "exact"),
        (mixed_target(h) | mixed_other(h), "mixed_instrument_heading"),
    ], "other")
    rows = rows.withColumn("verdicts", F.transform(below, verdict))
    unsafe = F.get(F.filter("verdicts", lambda v: ~v.isin("exact", "other")), F.lit(0))
    branch = F.element_at("ancestry_normalized", 1)
    original = F.col("c_kind") == "original"
    scored = F.col("instrumentation_normalized")
    matches = F.exists("c_instrumentation_patterns", lambda p: F.rlike(scored, F.concat(F.lit("(?iu)^(?:"), p, F.lit(r")\z"))))
    target = F.array_contains("verdicts", "exact")
    reason = rules.first_match([
        (~F.array_contains("category_names", F.col("c_name")), "page_not_in_category"),
        ((F.col("level") == 0) | ~F.when(original, branch == ORIGINAL).otherwise(branch.isin(ORIGINAL, ARRANGEMENT)), "branch_not_allowed"),
        (~F.lower("attachment.filename").endswith(".pdf"), "not_pdf"),
        (unsafe == "annotation_contains_instrument", "annotation_contains_instrument"), (unsafe.isNotNull(), "mixed_instrument_heading"),
        (F.col("metadata_reason") == "file_metadata_conflict", "file_metadata_conflict"), (F.col("metadata_reason") == "file_metadata_missing", "file_metadata_missing"),
        (F.col("metadata_reason").isNotNull(), "file_metadata_ambiguous"),
        (original & scored.isNull(), "instrumentation_missing"), (original & ~matches, "instrumentation_not_exact"), (original, "exact_original_instrumentation"),
        ((branch == ARRANGEMENT) & ~target, "heading_not_exact"), (branch == ARRANGEMENT, "exact_arrangement_heading"),
        (F.col("has_target"), "work_level_target_heading_present"), (F.col("has_arrangement"), "work_level_arrangement_branch_present"),
        (scored.isNull(), "work_level_instrumentation_missing"), (~matches, "work_level_instrumentation_not_exact"),
    ], "work_level_exact_instrumentation")
    rows = rows.withColumn("reason_code", reason)
    selected = ("exact_original_instrumentation", "exact_arrangement_heading", "work_level_exact_instrumentation")
    review = ("file_metadata_conflict", "file_metadata_missing", "file_metadata_ambiguous", "work_level_instrumentation_missing", "work_level_instrumentation_not_exact")
    disposition = F.when(F.col("reason_code").isin(*selected), "selected").when(F.col("reason_code").isin(*review), "manual_review").otherwise("excluded")
    order = Window.partitionBy("page_id", "revision_id", "c_name").orderBy("attachment.span_start", "attachment.attachment_index")
    decided = rows.select(
        "page_id", "revision_id", F.col("c_name").alias("category_name"), F.row_number().over(order).alias("ord"),
        F.when(F.col("file_id").rlike(r"^[1-9][0-9]*\z"), source_id(F.col("file_id"), F.col("revision_id"))).alias("source_id"),
        F.col("attachment.filename").alias("filename"), disposition.alias("disposition"), "reason_code",
        F.when(F.col("reason_code").isin(*selected), F.col("reason_code")).alias("selection_reason"),
        F.struct(F.col("raw").alias("heading_raw"), F.col("normalized").alias("heading_normalized"), F.col("ancestry").alias("heading_ancestry"), F.col("ancestry_normalized").alias("heading_ancestry_normalized"),
                 F.col("instrumentation").alias("instrumentation_raw"), "instrumentation_normalized", F.coalesce(F.get("ancestry", F.lit(0)), F.lit("FILES")).alias("branch")).alias("evidence"),
    )
    none = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in decided.schema.fields}
    none |= {"page_id": F.col("page_id"), "revision_id": F.col("revision_id"), "disposition": F.lit("invalid_page").alias("disposition"), "reason_code": F.col("error").alias("reason_code")}
    return decided.unionByName(bad.select(*none.values()))
