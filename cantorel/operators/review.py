"""Title reviews: shards, corrections, ordered compare-and-set supplements, audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cantorel.functions import rules
from cantorel.operators.ordering import id_key, numbered


def deal(rows: DataFrame, key: str, n: int) -> DataFrame:
    """``rows`` dealt round-robin over shards 1 to n in the order of ``key``."""
    return numbered(rows, key, "__at").withColumn("shard", (F.col("__at") % n + 1).cast("int")).drop("__at")


def display_title(c: Column) -> Column:
    """Whether a title is a non-empty one in title marks."""
    return F.trim(c).rlike(r"^《.+》$")


# What a review can have found, and on what it can rest.
STATUSES = ("accepted", "corrected")
BASES = ("common_name", "music_terminology", "semantic_correction", "format_consistency", "corpus_review")


def table_violations(reviewed: DataFrame) -> DataFrame:
    """What is wrong in a reviewed table (work_id, title_en, title_zh, status, basis, reason, reviewer, source_refs)."""
    key = F.col("work_id")
    needed = F.filter(F.array(*[F.when(F.coalesce(F.trim(c), F.lit("")) == "", c) for c in ("work_id", "title_en", "title_zh", "status", "basis", "reason", "reviewer")]), lambda x: x.isNotNull())
    refs = F.col("source_refs").isNotNull() & F.forall("source_refs", lambda x: x.isNotNull())
    unknown = lambda c, known: reviewed.filter(~F.coalesce(F.col(c).isin(*known), F.lit(False)))
    return rules.report([
        rules.duplicates(reviewed, "duplicate_work", "work_id"), rules.violation(reviewed.filter(F.size(needed) > 0), "empty_field", key, F.array_join(needed, ",")),
        rules.violation(reviewed.filter(~F.coalesce(display_title(F.col("title_zh")), F.lit(False))), "title_not_displayable", key, F.col("title_zh")),
        rules.violation(unknown("status", STATUSES), "unknown_status", key, F.col("status")), rules.violation(unknown("basis", BASES), "unknown_basis", key, F.col("basis")),
        rules.violation(reviewed.filter(~F.coalesce(refs, F.lit(False))), "source_refs_not_a_list", key, F.lit("")),
    ])


def shard_violations(shards: DataFrame, corpus: DataFrame, corrections: DataFrame, n: int) -> DataFrame:
    """What is wrong in the headers (shard, audited_count) of n round-robin shards of a corpus (work_id) and their corrections (work_id, shard).

    There is one header for each shard, its count is that of the works dealt to it, and a correction
    is of a work of its own shard.
    """
    dealt = deal(corpus.select("work_id").distinct().withColumn("__k", id_key(F.col("work_id"))), "__k", n).select("work_id", F.col("shard").alias("own"))
    counts = dealt.groupBy(F.col("own").alias("shard")).agg(F.count("*").alias("works"))
    both = shards.join(counts, "shard", "full")
    foreign = corrections.join(dealt, "work_id").filter("shard <> own")
    return rules.report([
        rules.duplicates(shards, "duplicate_shard", "shard"), rules.violation(both.filter("audited_count is null"), "shard_missing", F.col("shard"), F.col("works")),
        rules.violation(both.filter("audited_count is not null and audited_count <> coalesce(works, 0)"), "audited_count_differs", F.col("shard"), F.col("works")),
        rules.violation(foreign, "correction_of_other_shard", F.col("work_id"), F.col("shard")),
    ])


def merge(corpus: DataFrame, corrections: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The whole corpus (work_id, title_en, title_zh) with shard corrections applied, and violations.

    Corrections (work_id, title_en, old_title_zh, new_title_zh, basis, reason) must name known
    works once, with the titles they were made against; works without one keep theirs.
    """
    new = corrections.select("work_id", F.col("title_en").alias("c_en"), "old_title_zh", "new_title_zh", "basis", "reason")
    both = corpus.join(new, "work_id")
    bad = rules.report([
        rules.duplicates(corrections, "duplicate_correction", "work_id"),
        rules.orphans(corrections, "work_id", corpus, "work_id", "unknown_work"),
        rules.violation(both.filter("not (title_en <=> c_en) or not (title_zh <=> old_title_zh)"), "stale_correction", F.col("work_id"), F.col("old_title_zh")),
        rules.violation(both.filter(~F.coalesce(display_title(F.col("new_title_zh")), F.lit(False))), "title_not_displayable", F.col("work_id"), F.col("new_title_zh")),
        rules.violation(both.filter("title_zh <=> new_title_zh"), "correction_changes_nothing", F.col("work_id"), F.col("new_title_zh")),
    ])
    out = corpus.join(new, "work_id", "left").select(
        "work_id", "title_en", F.coalesce("new_title_zh", "title_zh").alias("title_zh"), F.lit("reviewed").alias("status"),
        F.coalesce("basis", F.lit("existing_translation")).alias("basis"), F.coalesce("reason", F.lit("")).alias("reason"),
    )
    return out, bad


def supplement(table: DataFrame, changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One supplement's compare-and-set: a change (work_id, current_title_zh, new_title_zh, reviewer, reason) applies where the current title is what it expects."""
    new = changes.select("work_id", "current_title_zh", F.col("new_title_zh").alias("__new"), F.col("reason").alias("__reason"))
    both = table.join(new, "work_id")
    bad = rules.report([
        rules.duplicates(changes, "duplicate_change", "work_id"), rules.orphans(changes, "work_id", table, "work_id", "unknown_work"),
        rules.violation(both.filter("not (title_zh <=> current_title_zh)"), "current_title_differs", F.col("work_id"), F.col("title_zh")),
    ])
    out = table.join(new, "work_id", "left").withColumn("title_zh", F.coalesce("__new", "title_zh")).withColumn("reason", F.coalesce("__reason", "reason"))
    return out.drop("current_title_zh", "__new", "__reason"), bad


def apply_titles(tables: DataFrame, reviewed: DataFrame) -> DataFrame:
    """Category rows with their works' reviewed titles."""
    r = reviewed.select("work_id", F.col("title_zh").alias("__zh"))
    return tables.join(r, "work_id", "left").withColumn("title_zh", F.coalesce("__zh", "title_zh")).drop("__zh")


def title_violations(tables: DataFrame, reviewed: DataFrame) -> DataFrame:
    """Category rows whose English title isn't the one that was reviewed; rows without a review are none."""
    r = reviewed.select("work_id", F.col("title_en").alias("__en"))
    return rules.violation(tables.join(r, "work_id").filter("not (title_en <=> __en)"), "title_differs_from_review", F.col("work_id"), F.col("__en"))


def title_map(rows: DataFrame) -> DataFrame:
    """(title_en, title_zh): of equal English titles the last written wins."""
    return rows.groupBy("title_en").agg(F.max_by("title_zh", "ord").alias("title_zh"))


# Pairs of a source and a Chinese pattern that don't belong together, by the flag they raise.
MISTRANSLATIONS = (
    ("pieces_as_objects", r"\b(?:pieces?|pi[eè]ces?|piezas?|pezzi|st[uü]cke|morceaux)\b", "件"),
    ("orders_as_dishes", r"\b[oó]rdenes\b", "道菜"),
    ("prelude_as_stage_opening", r"\b(?:preludes?|preludios?|pr[eé]ludes?)\b", "序幕"),
    ("air_as_substance", r"\bairs?\b", "空气"),
    ("saltarello_as_wire", r"\bsaltarell[oi]?\b", "跳线"),
    ("suite_as_room", r"\bsuites?\b", "套房"),
    ("etude_as_research", r"\b(?:etudes?|[eé]tudes?|estudios?|studies)\b", "研究|学习"),
    ("contredanse_as_contradiction", r"\bcontredanses?\b", "矛盾"),
    ("polonaise_as_person", r"\bpolonaises?\b", "波兰人"),
    ("mass_as_crowd", r"\b(?:mass(?:es)?|missa|messe)\b", "群众|质量"),
    ("minuet_missing_qu", r"\b(?:minuets?|menuets?|minuett[oi]?)\b", "小步舞(?!曲)"),
    ("fugue_as_escape", r"\b(?:fugue|fuga|fuge|fugas)\b", "逃走|航班|逃脱"),
    ("waltz_as_wrong", r"\b(?:waltz(?:es)?|valse(?:s)?|walzer)\b", "错误|虚假|瓦尔泽"),
    ("variations_as_changes", r"\b(?:variations?|variaciones|variazioni|variationen)\b", "变化|变体"),
    ("ricercar_as_rice", r"\b(?:ricercar(?:e|i)?|ricercare)\b", "米饭|水稻|里瑟卡|莱斯卡"),
    ("courante_as_current", r"\b(?:courante|corrente)\b", "当前|现状|职务|电流"),
    ("polacca_as_polish", r"\b(?:polacca|polaca)\b", "抛光|波兰语"),
    ("bolero_as_jacket", r"\bbol[ée]ros?\b", "短上衣"),
    ("contradanza_as_contrast", r"\bcontradanza\b", "对比度"),
    ("sonatina_as_sonata", r"\bsonatina\b", "(?<!小)奏鸣曲"),
    ("duet_as_large_ensemble", r"\b(?:duos?|duets?|duettinos?|duetti)\b", r"[三六]\s*重奏|二人组|双人组|双人舞|对奏|双重奏"),
    ("minuet_as_menu", r"\b(?:minuets?|menuets?|minuett[oi]?)\b", "菜单"),
    ("gigue_as_jitter", r"\bgigue\b", "抖动"),
    ("bourree_as_brewed", r"\bbourr[ée]e?\b", "酿"),
    ("courses_as_steps", r"\b(?:[oó]rdenes|ordenes)\b", "阶"),
    ("generic_pieces_missing_noun", r"^\s*\d+\s+(?:pieces?|pi[eè]ces?|morceaux|piezas?|pezzi|st[uü]cke)\s*(?:,|$)", r"《\s*\d+\s*首\s*[，,]"),
    ("pieces_as_chunks", r"\b(?:pieces?|pi[eè]ces?|morceaux|piezas?|pezzi|st[uü]cke)\b", "小块|小片段"),
    ("progressive_as_avant_garde", r"\bprogres(?:s)?iv\w*\b", "前卫"),
    ("society_pieces_as_association", "pi[eè]ces? de soci[eé]t[eé]", "协会|社会作品"),
    ("guitar_piece_missing_form", r"\bguitar piece no\.?\s*\d+\b", r"吉他第(?:\s*\d+|[一二三四五六七八九十]+)首"),
    ("andante_as_walking", r"\bandante\b", "行走|步行|走路"),
    ("allegro_as_joy", r"\ballegro\b", "喜乐|欢乐"),
    ("andantino_not_diminutive", r"\bandantino\b", "(?<!小)行板|安丹蒂诺"),
    ("allegretto_not_diminutive", r"\ballegretto\b", "(?<!小)快板|阿勒格雷托"),
    ("larghetto_mistranslated", r"\blarghetto\b", "(?<!小)广板|慢板|拉盖托|长音"),
    ("fantasia_missing_form", r"\b(?:fantasias?|fantasies|fantaisies?|fantasien?)\b", "幻想(?=》|[，,、与和第0-9一二三四五六七八九十])"),
    ("ballet_as_troupe", r"\b(?:ballet|baletto|ballett)\b", "芭蕾舞团"),
    ("volta_literal_translation", r"^(?:la\s+)?volt[ae]s?\b|\bvoltes?\b", "电压|伏特|时间|避难所|泰晤士报|第[一二三四0-9][^》]*轮"),
    ("branle_literal_translation", r"\b(?:branle|bransle)\b", "打手枪|打飞机|同性恋|运动|布兰(?:斯)?勒"),
    ("canarie_as_canary", r"\bcanarie\b", "金丝雀"),
    ("follia_as_madness", r"\bfollia\b", "疯狂"),
    ("ground_literal_translation", r"^(?:(?:a|italian)\s+)?ground\b|greensleeves\s+to\s+a\s+ground", "地面|落地"),
    ("magnificat_wrong_name", r"\bmagnificat\b", "圣母颂|放大曲|颂赞曲|赋格颂赞|赋格颂歌|音颂扬|音颂赞"),
    ("aubade_untranslated", r"\baubade\b", "奥巴德"),
    ("almain_literal_translation", r"\balmain\b", "德国|国际金融公司"),
    ("tiento_as_tent", r"\btiento\b", "帐篷|Tenta"),
    ("danceries_as_drama", r"\bdanceries\b", "舞剧"),
    ("in_nomine_as_nomination", r"\bin\s+nomines?\b", "提名|以名义"),
)
# Chinese numerals from 1, and prefixes of catalogue numbers.
CARDINALS = ("一", "二", "三", "四", "五", "六", "七", "八", "九", "十", "十一", "十二", "十三", "十四", "十五", "十六", "十七", "十八", "十九", "二十")
CATALOGUES = r"BWV|BuxWV|TWV|Krebs-WV|WeissSW|Drexel|Cary|WoO|MS|WSW|VdGS|FVB|IFC|ZD|RV|HWV|Sz|LV|Ch|K\.Anh\.C|[KDSZPFRH]|MT"
# How English titles name a key, an opus, a number and a catalogue number.
KEY = r"(?iu)\bin\s+([A-G])(?:-?(flat|sharp)|([♭#]))?\s+(major|minor)\b"
OPUS = r"(?U)\bop\.?\s*([0-9]+[a-z]?)"
NUMBER = r"(?iU)\bno\.?\s*([0-9]+)"
CATALOGUE_NUMBER = rf"(?<![A-Za-z])((?:{CATALOGUES})\.?\s*\d+(?:[.:/][A-Za-z0-9]+)*(?:[a-z](?:/[a-z])?)?(?:[-–]\d+)?)"


def quality_flags(en: Column, zh: Column) -> Column:
    """Names of all mistranslation rules that a pair of titles meets."""
    return rules.flags([(en.rlike(f"(?iuU){a}") & zh.rlike(b), name) for name, a, b in MISTRANSLATIONS])


def format_flags(zh: Column) -> Column:
    nested = zh.startswith("《《") | zh.contains("》》") | zh.rlike("《[^》]*《")
    return rules.flags([(nested, "nested_book_titles"), (zh.contains(", "), "ascii_comma"), (zh.rlike(r"(?iU)\bfor\b"), "raw_for")])


def identity_flags(en: Column, zh: Column) -> Column:
    """Key, opus, work and catalogue numbers that the Chinese title lost; a flag for each kind at most."""
    part = lambda i: F.lower(F.regexp_extract(en, KEY, i))
    sign = F.concat(part(2), part(3))
    want = F.concat(
        F.when(sign.isin("flat", "♭"), "降").when(sign.isin("sharp", "#"), "升").otherwise(""), F.upper(part(1)), F.when(part(4) == "major", "大调").otherwise("小调")
    )
    opus = F.regexp_extract_all(F.lower(en), F.lit(OPUS), F.lit(1))
    number = F.regexp_extract_all(en, F.lit(NUMBER), F.lit(1))
    chinese = lambda x: F.coalesce(F.get(F.array(*map(F.lit, CARDINALS)), F.try_subtract(F.try_to_number(x, F.lit("999999999")).cast("int"), F.lit(1))), F.lit("~"))

    def shown(x: Column) -> Column:
        either = F.concat(F.lit("(?:"), x, F.lit("|"), chinese(x), F.lit(")"))
        forms = (F.lit(r"第\s*"), either, F.lit("|"), either, F.lit(r"\s*号|之\s*"), x, F.lit(r"(?:\D|$)|(?iU:\bno\.?\s*"), x, F.lit(r"\b)"))
        return F.rlike(zh, F.concat(*forms))

    plain = lambda c: F.lower(F.regexp_replace(c, r"[\s.:：,，\-‐-―]", ""))
    catalogue = F.regexp_extract_all(en, F.lit(CATALOGUE_NUMBER), F.lit(1))
    return rules.flags([
        (en.rlike(KEY) & ~F.contains(zh, want), "key_mismatch"), (F.exists(opus, lambda x: ~F.contains(F.lower(zh), x)), "opus_number_missing"),
        (F.exists(number, lambda x: ~shown(x)), "work_number_missing"), (F.exists(catalogue, lambda x: ~F.contains(plain(zh), plain(x))), "catalog_number_missing"),
    ])


def audit(reviewed: DataFrame, corpus: DataFrame) -> DataFrame:
    """(metric, value): coverage, mismatches, inconsistent works and titles, and a histogram of flags."""
    extra = reviewed.join(corpus, "work_id", "left_anti")
    missing = corpus.join(reviewed, "work_id", "left_anti")
    both = corpus.alias("c").join(reviewed.alias("r"), "work_id")
    mismatch = both.filter("not (c.title_en <=> r.title_en)")
    works = corpus.groupBy("work_id").agg(F.countDistinct("title_zh").alias("n")).filter("n > 1")
    titles = reviewed.groupBy("title_en").agg(F.countDistinct("title_zh").alias("n")).filter("n > 1")
    flags = F.concat(quality_flags(F.col("title_en"), F.col("title_zh")), format_flags(F.col("title_zh")), identity_flags(F.col("title_en"), F.col("title_zh")))
    hist = reviewed.select(F.explode(flags).alias("metric")).groupBy("metric").agg(F.count("*").alias("value"))
    one = lambda df, name: df.agg(F.lit(name).alias("metric"), F.count("*").alias("value"))
    parts = [(corpus, "records"), (corpus.select("work_id").distinct(), "works"), (missing, "missing"), (extra, "extra"), (mismatch, "title_mismatch"), (works, "inconsistent_works"), (titles, "inconsistent_titles")]
    out = hist
    for df, name in parts:
        out = out.unionByName(one(df, name))
    return out
