"""Catalogue search: exact and alias ranking, fuzzy recovery, suggestions, browsing.

Queries are a table (query_id, text, family, kind, category) and are all answered at once.
An index is four tables: docs, bridge (work to category), categories, and vocabulary, the
postings: which work holds which word or token. Terms meet the vocabulary by equal pieces of
text, and works by postings, so that only works that hold all terms of a query are scored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cantorel.functions import text as T
from cantorel.session import kept

#: Limits of fuzzy recovery: terms, length of the query, total cost.
MAX_TERMS, MAX_LENGTH, MAX_COST = 12, 160, 2
ALIAS_PENALTY = 0.5


@dataclass(frozen=True)
class Index:
    docs: DataFrame
    bridge: DataFrame
    categories: DataFrame
    vocabulary: DataFrame


def _collected(rows: DataFrame, name: str) -> DataFrame:
    """(id, value) rows to normalised field arrays; normalising on flat rows keeps the UDF batched."""
    flat = rows.select("id", T.normalize(F.col("value")).alias("f")).filter("f <> ''")
    return flat.groupBy("id").agg(F.array_sort(F.collect_set("f")).alias(name))


def create_index(works: DataFrame, categories: DataFrame, composer_aliases: DataFrame, work_aliases: DataFrame) -> Index:
    """Works (id, title_en, title_zh, composer_en, composer_zh, category_ids), categories (id, name, name_zh,
    family, kind), aliases (composer, alias) and (id, alias) to an index.

    Its documents and postings are written once, to the shared folder; searches read them."""
    bridge = works.select("id", F.explode("category_ids").alias("category_id"))
    cats = categories.select(F.col("id").alias("category_id"), "name", "name_zh")
    plain = works.select("id", F.explode(F.array("title_en", "title_zh", "composer_en", "composer_zh", "id")).alias("value"))
    named = bridge.join(cats, "category_id").select("id", F.explode(F.array("name", "name_zh")).alias("value"))
    source = plain.unionByName(named)
    aliases = works.join(composer_aliases, works.composer_en == composer_aliases.composer).select("id", F.col("alias").alias("value"))
    aliases = aliases.unionByName(work_aliases.select("id", F.col("alias").alias("value")))
    docs = works.join(_collected(source, "fields"), "id").join(_collected(source.unionByName(aliases), "all_fields"), "id")
    for fields, blob, toks in (("fields", "blob", "tokens"), ("all_fields", "all_blob", "all_tokens")):
        docs = docs.withColumn(blob, F.array_join(fields, " ")).withColumn(toks, T.tokens(F.col(blob)))
    docs = kept(docs)
    words = lambda blob: F.split(F.col(blob), " ")
    each = docs.select("id", F.explode(F.array_distinct(F.concat("all_tokens", words("all_blob")))).alias("token"), "all_tokens", "tokens", "blob")
    direct = F.array_contains("tokens", F.col("token")) | F.array_contains(words("blob"), F.col("token"))
    vocabulary = each.filter("token <> ''").select("id", "token", F.array_contains("all_tokens", F.col("token")).alias("is_token"), direct.alias("direct"))
    return Index(docs, bridge, categories, kept(vocabulary))


def facet(query: str, column: Column) -> Column:
    """A facet of a query that is absent or "all" passes everything."""
    q = F.coalesce(F.col(query).cast("string"), F.lit("all"))
    return (q == "all") | (q == "") | (q == column.cast("string"))


def _pairs(queries: DataFrame, categories: DataFrame) -> DataFrame:
    """(query_id, category_id) of the categories that pass all facets of a query; both tables are small beside the works."""
    c = categories.select(F.col("id").alias("category_id"), F.col("family").alias("c_family"), F.col("kind").alias("c_kind"))
    on = facet("family", F.col("c_family")) & facet("kind", F.col("c_kind")) & facet("category", F.col("category_id"))
    return queries.select("query_id", "family", "kind", "category").join(c, on).select("query_id", "category_id")


def eligible(queries: DataFrame, index: Index, works: DataFrame | None = None) -> DataFrame:
    """(query_id, id, categories): works with a category row that passes all facets, and those categories; of ``works`` (query_id, id) if given."""
    pairs = _pairs(queries, index.categories)
    hits = index.bridge.join(pairs, "category_id") if works is None else works.join(index.bridge, "id").join(pairs, ["query_id", "category_id"])
    return hits.groupBy("query_id", "id").agg(F.array_sort(F.collect_set("category_id")).alias("categories"))


#: Longest piece of text that terms and the vocabulary meet by.
_HEAD, _PIECE = 3, 8


def _pieces(c: Column, longest: int) -> Column:
    """Array of (piece, at) of all substrings of up to so many characters, at from 0."""
    of = lambda n: F.transform(F.sequence(F.lit(1), F.length(c) - n + 1), lambda i: F.struct(F.substr(c, i, F.lit(n)).alias("piece"), (i - 1).alias("at")))
    none = F.array().cast("array<struct<piece:string,at:int>>")
    return F.concat(*[F.when(F.length(c) >= n, of(n)).otherwise(none) for n in range(1, longest + 1)])


def holding(terms: DataFrame, index: Index) -> DataFrame:
    """(term, id, direct) of works with a distinct term in their fields, direct if not only by an alias.

    A term of digits must be a token. Any other must be within a word: it meets the words that
    have its first characters somewhere.
    """
    digits = F.col("term").rlike("^[0-9]+$")
    words = index.vocabulary.select("token").distinct()
    heads = words.withColumn("head", F.explode(F.array_distinct(F.transform(_pieces(F.col("token"), _HEAD), lambda p: p["piece"]))))
    within = terms.filter(~digits).withColumn("head", F.left("term", F.lit(_HEAD))).join(heads, "head").filter(F.contains("token", F.col("term"))).select("term", "token")
    by_word = within.join(index.vocabulary, "token").select("term", "id", "direct")
    by_token = terms.filter(digits).withColumn("token", F.col("term")).join(index.vocabulary.filter("is_token"), "token").select("term", "id", "direct")
    return by_word.unionByName(by_token).groupBy("term", "id").agg(F.bool_or("direct").alias("direct"))


def similar(terms: DataFrame, index: Index) -> DataFrame:
    """(term, token, cost) of tokens within the tolerance of a distinct term.

    An edit, also one that swaps neighbours, spoils at most two pieces of a term cut into twice its
    tolerance and one more, so a match has a piece of it unchanged and, but in Han, moved by no more
    than the tolerance. Only such pairs are compared.
    """
    term = terms.withColumn("limit", T.tolerance(F.col("term"))).filter("limit > 0").withColumn("parts", 2 * F.col("limit") + 1)
    edge = lambda i: F.floor(i * F.length("term") / F.col("parts")).cast("int")
    cut = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda i: F.struct(F.substr("term", edge(i) + 1, edge(i + 1) - edge(i)).alias("piece"), edge(i).alias("at")))
    mine = term.select("term", "limit", F.explode(cut).alias("p")).select("term", "limit", "p.piece", F.col("p.at").alias("start"))
    tokens = index.vocabulary.filter("is_token").select("token").distinct()
    theirs = tokens.select("token", F.explode(_pieces(F.col("token"), _PIECE)).alias("p")).select("token", "p.*")
    moved = (F.abs(F.col("start") - F.col("at")) <= F.col("limit")) | F.col("term").rlike(r"^\p{IsHan}+$")
    near = mine.join(theirs, "piece").filter(moved).select("term", "token", "limit").distinct().filter(T.may_match(F.col("term"), F.col("token"), F.col("limit")))
    return near.withColumn("cost", T.fuzzy_cost(F.col("term"), F.col("token"))).filter("cost <= limit").select("term", "token", "cost")


def exact_score(fields: Column, blob: Column, toks: Column, query: Column, terms: Column) -> Column:
    """Null without all terms; 4 for no query; 0, 1, 2, 3 for equal, prefix, one field, several fields."""
    in_field = lambda f: F.forall(terms, lambda t: F.when(t.rlike("^[0-9]+$"), F.array_contains(T.tokens(f), t)).otherwise(f.contains(t)))
    score = (
        F.when(query == "", 4)
        .when(F.array_contains(fields, query), 0)
        .when(F.exists(fields, lambda f: f.startswith(query)), 1)
        .when(F.exists(fields, in_field), 2)
        .otherwise(3)
    )
    return F.when(F.forall(terms, lambda t: T.contains(blob, toks, t)), score)


def prepared(queries: DataFrame) -> DataFrame:
    q = queries.withColumn("query", T.normalize(F.col("text")))
    return q.withColumn("terms", T.terms(F.col("query")))


def search(queries: DataFrame, index: Index) -> DataFrame:
    """(query_id, id, rank, score, match_type, mode, categories), best first.

    Fuzzy recovery runs only for queries without any exact or alias match; its edit distances
    are computed once for each distinct (term, token) pair that passes the cheap guards. A query
    without terms matches every work that passes its facets.
    """
    q = prepared(queries)
    asked = q.select("query_id", F.explode(F.array_distinct("terms")).alias("term"))
    held = kept(holding(asked.select("term").distinct(), index))
    size = asked.groupBy("query_id").agg(F.count("*").alias("want"))
    found = asked.join(held, "term").groupBy("query_id", "id").agg(F.count("*").alias("hit")).join(size, "query_id").filter("hit = want").select("query_id", "id")
    every = eligible(queries.join(q.filter(F.size("terms") == 0).select("query_id"), "query_id", "left_semi"), index)
    may = eligible(queries, index, found).unionByName(every)
    rows = may.join(q.select("query_id", "query", "terms"), "query_id").join(index.docs, "id")
    direct = exact_score(F.col("fields"), F.col("blob"), F.col("tokens"), F.col("query"), F.col("terms"))
    wide = exact_score(F.col("all_fields"), F.col("all_blob"), F.col("all_tokens"), F.col("query"), F.col("terms"))
    scored = rows.select("query_id", "id", "categories", direct.alias("direct"), wide.alias("wide")).filter("direct is not null or wide is not null")
    exact = scored.select(
        "query_id", "id", "categories",
        F.least(F.col("direct").cast("double"), F.col("wide") + F.lit(ALIAS_PENALTY)).alias("score"),
        F.when(F.col("direct").isNotNull(), "exact").otherwise("alias").alias("match_type"), F.lit("exact").alias("mode"),
    )
    exact = kept(exact)
    missed = q.join(exact.select("query_id").distinct(), "query_id", "left_anti")
    missed = missed.filter((F.size("terms") > 0) & (F.size("terms") <= MAX_TERMS) & (F.length("query") <= MAX_LENGTH))
    # every term in every query counts once, repeated terms as often as they stand
    weight = missed.select("query_id", F.explode("terms").alias("term")).groupBy("query_id", "term").agg(F.count("*").alias("times"))
    term = weight.select("term").distinct()
    tokens = index.vocabulary.filter("is_token").select("token", "id")
    by_token = similar(term, index).join(tokens, "token").groupBy("term", "id").agg(F.min("cost").alias("cost"))
    costs = by_token.unionByName(held.join(term, "term").select("term", "id", F.lit(0).alias("cost"))).groupBy("term", "id").agg(F.min("cost").alias("cost"))
    total = weight.join(costs, "term").groupBy("query_id", "id").agg(F.sum(F.col("cost") * F.col("times")).alias("score"), F.count("*").alias("hit"))
    want = weight.groupBy("query_id").agg(F.count("*").alias("want"))
    fuzzy = total.join(want, "query_id").filter((F.col("hit") == F.col("want")) & (F.col("score") <= MAX_COST))
    fuzzy = fuzzy.join(eligible(queries, index, fuzzy.select("query_id", "id")), ["query_id", "id"])
    fuzzy = fuzzy.select("query_id", "id", "categories", F.col("score").cast("double"), F.lit("fuzzy").alias("match_type"), F.lit("fuzzy").alias("mode"))
    every = exact.unionByName(fuzzy).join(index.docs.select("id", "title_en", "title_zh", "composer_en", "composer_zh"), "id")
    # an accent-aware order of names, as the interface language sorts them
    order = Window.partitionBy("query_id").orderBy("score", *[F.expr(f"{c} COLLATE UNICODE") for c in ("composer_en", "title_en", "id")])
    return every.withColumn("rank", F.row_number().over(order))


def page(results: DataFrame, number: int, size: int = 18) -> DataFrame:
    """One page of each query's results, from page 0."""
    return results.filter((F.col("rank") > number * size) & (F.col("rank") <= (number + 1) * size))


def suggest(queries: DataFrame, index: Index, composer_aliases: DataFrame) -> DataFrame:
    """(query_id, n, kind, label, detail, suggestion): up to three composers, then works, six in all."""
    q = prepared(queries).filter(F.length("query") >= 2)
    found = kept(search(q.select(*queries.columns), index)).join(q.select("query_id", "terms"), "query_id")
    names = index.docs.groupBy("composer_en").agg(F.min_by("composer_zh", "id").alias("zh"))
    values = names.select(F.col("composer_en").alias("id"), F.explode(F.array("composer_en", "zh")).alias("value"))
    values = values.unionByName(composer_aliases.join(names, composer_aliases.composer == names.composer_en).select(F.col("composer").alias("id"), F.col("alias").alias("value")))
    comp = _collected(values, "c_fields").withColumn("c_blob", F.array_join("c_fields", " ")).withColumn("c_tokens", T.tokens(F.col("c_blob")))
    first = found.withColumn("k", F.row_number().over(Window.partitionBy("query_id", "composer_en").orderBy("rank"))).filter("k = 1")
    rows = first.join(comp, first.composer_en == comp.id).select(first["query_id"], first["rank"], first["composer_en"], first["composer_zh"], "mode", "terms", "c_blob", "c_tokens")
    each = rows.select("*", F.posexplode("terms").alias("p", "term"))
    plain = T.contains(F.col("c_blob"), F.col("c_tokens"), F.col("term"))
    tok = each.filter(~plain & (F.col("mode") == "fuzzy")).select("query_id", "composer_en", "p", "term", F.explode("c_tokens").alias("token"))
    tok = tok.withColumn("limit", T.tolerance(F.col("term"))).filter(T.may_match(F.col("term"), F.col("token"), F.col("limit")))
    tok = tok.withColumn("cost", T.fuzzy_cost(F.col("term"), F.col("token"))).filter("cost <= limit").select("query_id", "composer_en", "p").distinct()
    ok = each.filter(plain).select("query_id", "composer_en", "p").unionByName(tok).groupBy("query_id", "composer_en").agg(F.count("*").alias("hit"))
    relevant = rows.join(ok, ["query_id", "composer_en"]).filter(F.col("hit") == F.size("terms"))
    by_rank = Window.partitionBy("query_id").orderBy("rank")
    composers = relevant.withColumn("n", F.row_number().over(by_rank)).filter("n <= 3").select(
        "query_id", F.lit(0).alias("g"), "rank", F.lit("composer").alias("kind"), F.col("composer_zh").alias("label"), F.col("composer_en").alias("detail"), F.col("composer_en").alias("suggestion")
    )
    works = found.select(
        "query_id", F.lit(1).alias("g"), "rank", F.lit("work").alias("kind"), F.regexp_replace("title_zh", "^《|》$", "").alias("label"),
        F.col("composer_zh").alias("detail"), F.concat_ws(" ", "title_en", "composer_en").alias("suggestion"),
    )
    both = composers.unionByName(works)
    once = both.withColumn("k", F.row_number().over(Window.partitionBy("query_id", "suggestion").orderBy("g", "rank"))).filter("k = 1")
    out = once.withColumn("n", F.row_number().over(Window.partitionBy("query_id").orderBy("g", "rank"))).filter("n <= 6")
    return out.select("query_id", "n", "kind", "label", "detail", "suggestion")


def browse(queries: DataFrame, index: Index) -> tuple[DataFrame, DataFrame]:
    """Ordered categories of each query, and its number of distinct works."""
    rows = index.categories.alias("c").join(queries.alias("q"), _on_aliases())
    key = T.numeric_key(F.regexp_replace("name", "^For guitar(?= |$)", "For 1 guitar"))
    order = Window.partitionBy("query_id").orderBy(F.col("kind") == "arrangement", F.expr("k COLLATE UNICODE_CI_AI"), "id")
    cats = rows.select("query_id", F.col("c.id").alias("id"), F.col("c.name").alias("name"), F.col("c.kind").alias("kind"))
    cats = cats.withColumn("k", key).withColumn("n", F.row_number().over(order)).drop("k")
    works = eligible(queries, index).groupBy("query_id").agg(F.countDistinct("id").alias("work_count"))
    return cats, works


def _on_aliases() -> Column:
    out = None
    for mine, theirs in (("family", "family"), ("kind", "kind"), ("category", "id")):
        q = F.coalesce(F.col(f"q.{mine}").cast("string"), F.lit("all"))
        part = (q == "all") | (q == "") | (q == F.col(f"c.{theirs}").cast("string"))
        out = part if out is None else out & part
    return out


def directory(queries: DataFrame, index: Index) -> DataFrame:
    """(query_id, family, categories, works): the categories that each query's facets leave, by family, and their distinct works."""
    pairs = _pairs(queries, index.categories).join(index.categories.select(F.col("id").alias("category_id"), "family"), "category_id")
    names = pairs.groupBy("query_id", "family").agg(F.array_sort(F.collect_set("category_id")).alias("categories"))
    works = pairs.join(index.bridge, "category_id").groupBy("query_id", "family").agg(F.countDistinct("id").alias("works"))
    return names.join(works, ["query_id", "family"], "left").withColumn("works", F.coalesce("works", F.lit(0)))


def kinds(index: Index) -> DataFrame:
    """(id, kinds): the kinds of all categories of a work, as its label shows them."""
    rows = index.bridge.join(index.categories.select(F.col("id").alias("category_id"), "kind"), "category_id")
    return rows.groupBy("id").agg(F.array_sort(F.collect_set("kind")).alias("kinds"))


def catalog_view(queries: DataFrame) -> DataFrame:
    """Whether a query shows categories or works."""
    q = prepared(queries)
    none = F.coalesce(F.col("category").cast("string"), F.lit("all")) == "all"
    return q.select("query_id", F.when((F.col("query") == "") & none, "categories").otherwise("works").alias("view"))
