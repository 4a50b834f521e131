"""Queries of the catalogue engine over the driver's tables, each with its DuckDB counterpart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cantorel import session as ids
from cantorel.functions import rules
from cantorel.functions import text as T
from cantorel.operators import attempts, drift, ordering, review, search, wikitext
from cantorel.plans import engine  # noqa: F401
from cantorel.plans.registry import ORACLE, QUERIES, Query
from cantorel.plans.registry import query as _query
from cantorel.plans.registry import table as _table
from cantorel.streaming import attempts as stream_attempts


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)


@_query(
    "q_rename_candidates",
    """WITH m AS (SELECT DISTINCT l_suppkey AS s, l_partkey AS p FROM lineitem), n AS (SELECT s, count(*) AS n FROM m GROUP BY s),
       o AS (SELECT a.s AS a, b.s AS b, count(*) AS overlap FROM m a JOIN m b ON a.p = b.p AND a.s < b.s GROUP BY 1, 2)
       SELECT x.s_name AS source_name, y.s_name AS candidate_name, CAST(levenshtein(lower(x.s_name), lower(y.s_name)) AS INTEGER) AS name_distance, overlap, na.n + nb.n - overlap AS union_size
       FROM o JOIN n na ON na.s = a JOIN n nb ON nb.s = b JOIN supplier x ON x.s_suppkey = a JOIN supplier y ON y.s_suppkey = b
       WHERE overlap * 100 >= 18 * (na.n + nb.n - overlap) AND levenshtein(lower(x.s_name), lower(y.s_name)) <= 6""",
)
def q_rename_candidates(spark: SparkSession, d: str) -> DataFrame:
    members = _table(spark, d, "lineitem").select(F.col("l_suppkey").alias("name_id"), F.col("l_partkey").alias("member")).distinct()
    names = _table(spark, d, "supplier").select(F.col("s_suppkey").alias("name_id"), F.col("s_name").alias("name"))
    rows = members.join(names, "name_id")
    pairs = drift.rename_candidates(rows, rows, 6, 0.18, ordered=True)
    return pairs.select("source_name", "candidate_name", "name_distance", "overlap", "union_size")


_LATEST = "SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events"


@_query("q_latest_state", f"SELECT user_id, event_id, event_type FROM ({_LATEST}) WHERE r = 1")
def q_latest_state(spark: SparkSession, d: str) -> DataFrame:
    return attempts.latest(_table(spark, d, "events"), "user_id", ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@_query(
    "q_history_violations",
    """WITH e AS (SELECT user_id, event_id, bool_or(event_type = 'error') OVER w AS dead, lag(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events
         WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
       SELECT user_id, event_id, coalesce(event_id - prev, 0) AS gap FROM e WHERE coalesce(dead, false)""",
)
def q_history_violations(spark: SparkSession, d: str) -> DataFrame:
    rows = attempts.after_terminal(_table(spark, d, "events"), "user_id", ["ts", "event_id"], F.col("event_type") == "error")
    gap = F.col("event_id") - F.lag("event_id").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return rows.withColumn("gap", F.coalesce(gap, F.lit(0))).filter("after_terminal").select("user_id", "event_id", "gap")


@_query(
    "q_circuit_breaker",
    """WITH e AS (SELECT event_id, CAST(ts AS DATE) AS day, bool_or(event_type = 'purchase') OVER w AS open FROM events
         WINDOW w AS (PARTITION BY CAST(ts AS DATE) ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
       SELECT CAST(day AS VARCHAR) AS day, count(*) FILTER (WHERE NOT coalesce(open, false)) AS started, count(*) FILTER (WHERE coalesce(open, false)) AS skipped FROM e GROUP BY day""",
)
def q_circuit_breaker(spark: SparkSession, d: str) -> DataFrame:
    rows = _table(spark, d, "events").withColumn("day", F.to_date("ts"))
    rows = attempts.after_terminal(rows, "day", ["ts", "event_id"], F.col("event_type") == "purchase")
    return rows.groupBy(F.col("day").cast("string").alias("day")).agg(F.count_if(~F.col("after_terminal")).alias("started"), F.count_if("after_terminal").alias("skipped"))


@_query("q_shard_assign", "SELECT doc_id, CAST((row_number() OVER (ORDER BY doc_id) - 1) % 3 + 1 AS INTEGER) AS shard FROM documents")
def q_shard_assign(spark: SparkSession, d: str) -> DataFrame:
    return review.deal(_table(spark, d, "documents").select("doc_id"), "doc_id", 3)


@_query(
    "q_sortedness",
    """SELECT count(*) AS violations FROM (SELECT o_custkey, o_orderkey, lag(o_custkey) OVER (ORDER BY o_orderkey) AS p, lag(o_orderkey) OVER (ORDER BY o_orderkey) AS q FROM orders)
       WHERE p > o_custkey OR (p = o_custkey AND q > o_orderkey)""",
)
def q_sortedness(spark: SparkSession, d: str) -> DataFrame:
    rows = _table(spark, d, "orders").select("o_orderkey", F.struct("o_custkey", "o_orderkey").alias("v"))
    return ordering.with_previous(rows, "o_orderkey", "v").agg(F.count_if(F.col("previous") > F.col("v")).alias("violations"))


@_query(
    "q_sort_multi",
    "SELECT p_partkey, row_number() OVER (ORDER BY lower(p_name), CASE WHEN p_type LIKE 'P%' THEN 1 ELSE 0 END, p_partkey) - 1 AS category_id FROM part",
)
def q_sort_multi(spark: SparkSession, d: str) -> DataFrame:
    rows = _table(spark, d, "part").select("p_partkey", F.struct(F.lower("p_name").alias("n"), F.when(F.col("p_type").like("P%"), 1).otherwise(0).alias("t"), "p_partkey").alias("k"))
    return ordering.numbered(rows, "k").select("p_partkey", F.col("n").alias("category_id"))


_NAMES = "WITH n AS (SELECT DISTINCT lower(p_name) AS name FROM part) "


@_query("q_theta_levenshtein", _NAMES + "SELECT a.name AS a, b.name AS b, CAST(levenshtein(a.name, b.name) AS INTEGER) AS distance FROM n a JOIN n b ON a.name < b.name WHERE levenshtein(a.name, b.name) <= 2")
def q_theta_levenshtein(spark: SparkSession, d: str) -> DataFrame:
    n = _table(spark, d, "part").select(F.lower("p_name").alias("name")).distinct()
    return drift.close_names(n, n, 2).filter("a < b")


#: Misspelt terms that the fuzzy query looks for.
_MISSPELT = ("gera", "wigdet", "bol", "glbue", "vavle", "boltt", "ca")


@_query(
    "q_fuzzy_osa",
    f"""WITH t AS (SELECT unnest({list(_MISSPELT)!r}) AS term), w AS (SELECT DISTINCT unnest(string_split(lower(p_name), ' ')) AS word FROM part)
       SELECT term, word, CAST(damerau_levenshtein(term, word) AS INTEGER) AS cost FROM t, w WHERE length(term) >= 4 AND damerau_levenshtein(term, word) <= 1""",
)
def q_fuzzy_osa(spark: SparkSession, d: str) -> DataFrame:
    asked = spark.createDataFrame([(t,) for t in _MISSPELT], "term string").withColumn("limit", F.least(T.tolerance(F.col("term")), F.lit(1)))
    words = _table(spark, d, "part").select(F.explode(T.tokens(F.lower("p_name"))).alias("word")).distinct()
    near = words.join(F.broadcast(asked), T.may_match(F.col("term"), F.col("word"), F.col("limit")))
    return near.withColumn("cost", T.fuzzy_cost(F.col("term"), F.col("word"))).filter("cost <= limit").select("term", "word", "cost")


#: Queries of the ranked search.
_ASKED = ("gear", "red gear", "blue bolt", "widget", "zz", "gear red")


@_query(
    "q_exact_rank",
    f"""WITH q AS (SELECT unnest({list(_ASKED)!r}) AS query), p AS (SELECT DISTINCT p_brand, lower(p_name) AS name, lower(p_type) AS type FROM part),
       m AS (SELECT query, p_brand, name, type, name || ' ' || type AS blob, string_split(query, ' ') AS terms FROM q, p)
       SELECT query, p_brand, name, type, CASE WHEN name = query OR type = query THEN 0 WHEN starts_with(name, query) OR starts_with(type, query) THEN 1
         WHEN len(list_filter(terms, lambda t: NOT contains(name, t))) = 0 OR len(list_filter(terms, lambda t: NOT contains(type, t))) = 0 THEN 2 ELSE 3 END AS score
       FROM m WHERE len(list_filter(terms, lambda t: NOT contains(blob, t))) = 0""",
)
def q_exact_rank(spark: SparkSession, d: str) -> DataFrame:
    q = spark.createDataFrame([(t,) for t in _ASKED], "query string").withColumn("terms", T.terms(F.col("query")))
    p = _table(spark, d, "part").select("p_brand", F.lower("p_name").alias("name"), F.lower("p_type").alias("type")).distinct()
    p = p.withColumn("fields", F.array("name", "type")).withColumn("blob", F.concat_ws(" ", "name", "type"))
    p = p.withColumn("tokens", T.tokens(F.col("blob")))
    rows = p.join(F.broadcast(q), F.forall("terms", lambda t: T.contains(F.col("blob"), F.col("tokens"), t)))
    return rows.select("query", "p_brand", "name", "type", search.exact_score(F.col("fields"), F.col("blob"), F.col("tokens"), F.col("query"), F.col("terms")).alias("score"))


@_query(
    "q_token_index",
    "SELECT token, count(*) AS doc_frequency FROM (SELECT doc_id, unnest(list_distinct(regexp_extract_all(lower(text), '[a-z]+|[0-9]+'))) AS token FROM documents) GROUP BY token",
)
def q_token_index(spark: SparkSession, d: str) -> DataFrame:
    rows = _table(spark, d, "documents").select(F.explode(T.tokens(F.lower("text"))).alias("token"))
    return rows.groupBy("token").agg(F.count("*").alias("doc_frequency"))


@_query(
    "q_regex_flags",
    """SELECT flag, count(*) AS n FROM (
       SELECT unnest(list_filter([CASE WHEN regexp_matches(text, '[A-Z]{4,}') THEN 'shouting' END, CASE WHEN regexp_matches(text, '[%&*#$]{3}') THEN 'symbols' END,
         CASE WHEN regexp_matches(text, ' \\| ') THEN 'pipes' END, CASE WHEN regexp_matches(text, '[0-9]{4}') THEN 'digits' END], lambda x: x IS NOT NULL)) AS flag FROM documents) GROUP BY flag""",
)
def q_regex_flags(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    found = rules.flags([(t.rlike("[A-Z]{4,}"), "shouting"), (t.rlike("[%&*#$]{3}"), "symbols"), (t.rlike(r" \| "), "pipes"), (t.rlike("[0-9]{4}"), "digits")])
    return _table(spark, d, "documents").select(F.explode(found).alias("flag")).groupBy("flag").agg(F.count("*").alias("n"))


@_query(
    "q_url_checks",
    """SELECT page_id, lower(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)) AS host, regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1) AS path,
       coalesce(starts_with(url, 'https://') AND (lower(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)) = 'example.net' OR lower(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)) LIKE '%.example.net'), false) AS allowed FROM pages""",
)
def q_url_checks(spark: SparkSession, d: str) -> DataFrame:
    url = F.col("url")
    return _table(spark, d, "pages").select(
        "page_id", F.lower(F.try_parse_url(url, F.lit("HOST"))).alias("host"), F.try_parse_url(url, F.lit("PATH")).alias("path"), T.allowed_url(url, "example.net", "").alias("allowed")
    )


@_query(
    "q_html_extract",
    """SELECT page_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title, CAST(len(regexp_extract_all(html, '<a href="')) AS BIGINT) AS n_links,
       CAST(length(regexp_replace(html, '(?s)<script>.*?</script>', '', 'g')) AS BIGINT) AS chars_without_scripts FROM pages""",
)
def q_html_extract(spark: SparkSession, d: str) -> DataFrame:
    h = F.col("html")
    return _table(spark, d, "pages").select(
        "page_id", F.regexp_extract(h, "(?s)<title>(.*?)</title>", 1).alias("title"), F.regexp_count(h, F.lit('<a href="')).cast("long").alias("n_links"),
        F.length(F.regexp_replace(h, "(?s)<script>.*?</script>", "")).cast("long").alias("chars_without_scripts"),
    )


@_query("q_json_props", "SELECT event_type, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS total FROM events GROUP BY event_type")
def q_json_props(spark: SparkSession, d: str) -> DataFrame:
    k = F.from_json("props", "k long")["k"]
    return _table(spark, d, "events").groupBy("event_type").agg(F.sum(k).alias("total"))


@_query("q_hash_bucket", "SELECT c_custkey, substr(sha256(c_name), 1, 10) AS bucket, 'membership:' || substr(sha256(c_name), 1, 10) || ':source:f' || c_custkey || '@r1' AS membership_id FROM customer")
def q_hash_bucket(spark: SparkSession, d: str) -> DataFrame:
    return _table(spark, d, "customer").select(
        "c_custkey", F.substr(F.sha2("c_name", 256), F.lit(1), F.lit(10)).alias("bucket"),
        ids.membership_id(F.col("c_name"), ids.source_id(F.col("c_custkey"), F.lit(1))).alias("membership_id"),
    )


@_query(
    "q_heading_last",
    """SELECT conv_id, turn, last_user_chars FROM (SELECT conv_id, turn, role, last_value(CASE WHEN role = 'user' THEN length(text) END IGNORE NULLS)
       OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_user_chars FROM conversations) WHERE role = 'assistant'""",
)
def q_heading_last(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    last = F.last(F.when(F.col("role") == "user", F.length("text").cast("long")), ignorenulls=True).over(w)
    return _table(spark, d, "conversations").select("conv_id", "turn", "role", last.alias("last_user_chars")).filter("role = 'assistant'").drop("role")


@_query(
    "q_role_fold",
    """SELECT conv_id, string_agg(substr(role, 1, 1), '' ORDER BY turn) AS roles, count(*) FILTER (WHERE role <> prev OR prev IS NULL) AS switches
       FROM (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS prev FROM conversations) GROUP BY conv_id""",
)
def q_role_fold(spark: SparkSession, d: str) -> DataFrame:
    rows = _table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("t"))
    start = F.struct(F.lit("").alias("roles"), F.lit("").alias("last"), F.lit(0).cast("long").alias("n"))
    fold = F.aggregate(
        "t", start,
        lambda a, x: F.struct(
            F.concat(a["roles"], F.left(x["role"], F.lit(1))).alias("roles"), x["role"].alias("last"), (a["n"] + F.when(x["role"] == a["last"], 0).otherwise(1)).alias("n")
        ),
    )
    return rows.select("conv_id", fold.alias("f")).select("conv_id", "f.roles", F.col("f.n").alias("switches"))


@_query(
    "q_constraint_report",
    """SELECT 'duplicate_line' AS rule, l_orderkey || '/' || l_linenumber AS key, CAST(count(*) AS VARCHAR) AS detail FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
       UNION ALL SELECT 'name_variants', p_name, CAST(count(DISTINCT p_type) AS VARCHAR) FROM part GROUP BY p_name HAVING count(DISTINCT p_type) > 1
       UNION ALL SELECT DISTINCT 'unknown_order', CAST(l_orderkey AS VARCHAR), 'no parent' FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
       UNION ALL SELECT DISTINCT 'unknown_part', CAST(l_partkey AS VARCHAR), 'no parent' FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)""",
)
def q_constraint_report(spark: SparkSession, d: str) -> DataFrame:
    lines, part = _table(spark, d, "lineitem"), _table(spark, d, "part")
    return rules.report([
        rules.duplicates(lines, "duplicate_line", "l_orderkey", "l_linenumber"),
        rules.variants(part, "p_name", "p_type", "name_variants"),
        rules.orphans(lines, "l_orderkey", _table(spark, d, "orders"), "o_orderkey", "unknown_order"),
        rules.orphans(lines, "l_partkey", part, "p_partkey", "unknown_part"),
    ])


@_query(
    "q_numeric_sort",
    "SELECT brand, row_number() OVER (ORDER BY k, brand) AS n FROM (SELECT DISTINCT p_brand AS brand, regexp_extract(p_brand, '^[^0-9]*') || lpad(regexp_extract(p_brand, '[0-9]+'), 6, '0') AS k FROM part)",
)
def q_numeric_sort(spark: SparkSession, d: str) -> DataFrame:
    rows = _table(spark, d, "part").select(F.col("p_brand").alias("brand")).distinct().withColumn("k", F.struct(T.numeric_key(F.col("brand")).alias("k"), "brand"))
    return ordering.numbered(rows, "k").select("brand", (F.col("n") + 1).alias("n"))


@_query("q_casefold", "SELECT doc_id, sha256(nfc_normalize(replace(lower(nfc_normalize(text)), 'ß', 'ss'))) AS folded_sha256 FROM documents")
def q_casefold(spark: SparkSession, d: str) -> DataFrame:
    return _table(spark, d, "documents").select("doc_id", F.sha2(T.nfc_casefold("text").cast("binary"), 256).alias("folded_sha256"))


@_query(
    "q_stream_state",
    """WITH e AS (SELECT user_id, event_id, event_type AS kind, count(*) FILTER (WHERE event_type = 'error') OVER w AS errors, bool_or(event_type = 'purchase') OVER w AS bought
         FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING)),
       l AS (SELECT *, coalesce(lag(bought OR errors >= 3) OVER (PARTITION BY user_id ORDER BY event_id), false) AS past FROM e)
       SELECT CAST(user_id AS VARCHAR) AS user_id, count(*) FILTER (WHERE NOT past AND kind = 'error') AS attempts,
         CASE WHEN max(errors) FILTER (WHERE NOT past) >= 3 THEN 'retry_exhausted' ELSE arg_max(kind, event_id) FILTER (WHERE NOT past) END AS status,
         count(*) FILTER (WHERE NOT past) AS accepted, count(*) FILTER (WHERE past) AS rejected FROM l GROUP BY user_id""",
)
def q_stream_state(spark: SparkSession, d: str) -> DataFrame:
    """The attempt-log state machine run as a stream over the events until they are used up."""
    return stream_attempts.replay(spark, f"{d}/events.parquet")


_FOLDED = "trim(regexp_replace(nfc_normalize(replace(lower(nfc_normalize(line)), 'ß', 'ss')), '\\s+', ' ', 'g'))"


@_query(
    "q_wikitext_parse",
    f"""WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
       l AS (SELECT doc_id, i, {_FOLDED} AS name FROM (SELECT doc_id, unnest(range(len(ls))) AS i, unnest(ls) AS line FROM d)),
       w AS (SELECT *, lag(name, 1) OVER o AS up, lag(name, 2) OVER o AS top FROM l WINDOW o AS (PARTITION BY doc_id ORDER BY i))
       SELECT CAST(doc_id AS VARCHAR) AS page_id, CAST(i + 1 AS INTEGER) AS node_ord, CAST(2 + i % 3 AS INTEGER) AS level, name AS normalized,
         CASE i % 3 WHEN 0 THEN name WHEN 1 THEN up || ' > ' || name ELSE top || ' > ' || up || ' > ' || name END AS ancestry FROM w""",
)
def q_wikitext_parse(spark: SparkSession, d: str) -> DataFrame:
    """Heading trees of pages written in wiki markup from the documents."""
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.concat(F.repeat(F.lit("="), 2 + i % 3), F.lit(" "), x, F.lit(" "), F.repeat(F.lit("="), 2 + i % 3)))
    page = F.concat(F.lit("|*****FILES***** =\n"), F.array_join(lines, "\n"), F.lit("\n|*****WORK INFO***** =\n|Instrumentation=guitar\n"))
    pages = _table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("page_id"), F.lit("1").alias("revision_id"), page.alias("wikitext"))
    return wikitext.headings(pages).select("page_id", "node_ord", "level", "normalized", F.array_join("ancestry_normalized", " > ").alias("ancestry"))
