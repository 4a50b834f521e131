"""The production rule set: section extraction, headings, and file-level purity.

Kept apart from the strict rules: both classify the same pages and differ on purpose.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cantorel.functions import rules
from cantorel.functions.text import html_unescape

# Other instruments as file descriptions name them.
OTHER_INSTRUMENTS = (
    ("accordion", "accordion"), ("bass guitar", r"bass\s+guitar|electric\s+bass|bassgitarre|baixol[aã]o|\bbaixo\b"), ("bassoon", "bassoon|fagott"),
    ("bagpipe", "bagpipe|dudelsack"), ("banjo", "banjo"), ("cavaquinho", "cavaquinho"), ("cello", "cello|violoncello|violoncelle"),
    ("clarinet", "clarinet(?:te)?|klarinette|clarinete|clavinet"), ("double bass", r"double\s+bass|contrabass|string\s+bass"), ("dulcimer", "dulcimer"),
    ("ensemble", "ensemble"), ("flute", r"flute|flauta|fl[öu]te|querfl[öo]-?te|\bflo-te\b"), ("glockenspiel", "glockenspiel"), ("harp", "harp"),
    ("harpsichord", "harpsichord|cembalo"), ("horn", r"french\s+horn|franzo-sischer\s+horn|corno|\bhorn\b"), ("koto", "koto"), ("lute", "lute|theorbo"),
    ("mandolin", "mandolin|mandola|bandolim"), ("marimba", "marimba"), ("oboe", "oboe|hautbois"), ("orchestra", "orchestra"), ("organ", "organ"),
    ("percussion", r"percussion|\bpercu\b|drum(?:-set)?"), ("piano", "piano(?:forte)?|klavier"), ("recorder", "recorder"),
    ("saxophone", "sax(?:ophon|ophone)?|sassofono"), ("sitar", "sitar"), ("timpani", "timpani"), ("trombone", "trombone"), ("trumpet", "trumpet|trompete"),
    ("tuba", "tuba"), ("ukulele", "ukulele|ukelele|guitalele"), ("viola", "viola"), ("vibraphone", "vibra(?:phon|phone|fon)"),
    ("violin", "violin|violinen|violine|violino|violon|vln"), ("voice", "voice|vocal|choir|chor|ma-nnerchor|singer"), ("xylophone", "xylophon|xylophone"),
)
# Instruments of headings in mixed categories.
HEADING_INSTRUMENTS = (
    ("guitar", "guitars?|guitarre|guitare|gitarre|guitarra|harp guitar"), ("violin", "violins?"), ("viola", "violas?"), ("cello", "cellos?|violoncellos?"),
    ("double bass", "double bass(?:es)?|contrabass(?:es)?"), ("flute", "flutes?"), ("piccolo", "piccolos?"), ("recorder", "recorders?|csakan"), ("oboe", "oboes?"),
    ("clarinet", "clarinets?"), ("bassoon", "bassoons?"), ("saxophone", "saxophones?"), ("horn", "horns?"), ("trumpet", "trumpets?"), ("trombone", "trombones?"),
    ("tuba", "tubas?"), ("piano", "pianos?"), ("harpsichord", "harpsichords?"), ("organ", "organs?"), ("accordion", "accordions?|bandoneons?|concertinas?"),
    ("harmonica", "harmonicas?"), ("mandolin", "mandolins?"), ("mandola", "mandolas?"), ("mandocello", "mandocellos?|mandolon-?cellos?"), ("lute", "lutes?"),
    ("bandurria", "bandurrias?"), ("harp", "harps?"), ("ukulele", "ukuleles?"), ("percussion", "percussion|timpani|marimbas?|vibraphones?|glockenspiels?"),
    ("treble instrument", "treble instruments?"), ("bass instrument", "bass instruments?"), ("strings", "strings?"), ("continuo", "continuo"),
)
# Headings that say nothing, guitar words, and what puts a heading out of scope.
GENERIC_HEADINGS = ("scores", "scores and parts", "sheet music", "complete score", "music files", "parts", "arrangements and transcriptions")
GUITAR_WORDS = "guitar(?:re)?|guitare|gitarre|guitarra|viol[aã]o"
COMPOUND_GUITAR = "(?:harp|lyre|english|spanish|baroque|classical|steel)[ -]?guitar"
OUT_OF_SCOPE = "voices?|vocal|chorus|choir|narrators?|reciters?|speakers?|electric guitars?|bass guitars?|orchestra|synthesizers?|electronics?|tape"
SEVERAL_GUITARS = r"duets?|duos?|2\s*guitars?|two\s+guitars?|trio\s+de\s+guitares?|3\s*guitars?"
ENSEMBLE_WORDS = {2: "duos?|duets?", 3: "trios?", 4: "quartets?", 5: "quintets?", 6: "sextets?"}
COUNTED = "guitars?|violins?|violas?|cellos?|flutes?|recorders?|oboes?|clarinets?|bassoons?|saxophones?|mandolins?|mandolas?|mandocellos?"
TAG_CODES = "vn|va|vc|db|hp|lute|lyre|pf|org|fl|ob|cl|bn"
# A tag in a file name that marks another version, and what names the guitar in one.
FILE_TAG = (
    r"(?iu)(?:"
    r"\((?<parenthesized>piano|pianoforte|banjo|viola|violin|violine|vln|flute|clarinet(?:te)?|oboe|cello)\)"
    r"|[-_](?<terminal>piano|pianoforte|banjo|ensemble|lute|viola|violin|violine|vln|flute|clarinet(?:te)?|oboe|cello)\.pdf$"
    r"|_-_(?<structured>3_violinen|accordion|bassgitarre|bassoon|bagpipe|celesta|dulcimer|duett|fagott|banjo|cello|clarinet(?:te)?|klarinette|cembalo|dudelsack|flute|flo-te|glockenspiel|harfe|harp|horn|keyboard|klavier|koto|ma-nnerchor|marimba|oboe|percu|piano|querflo-te|sax|sopran-sax|sitar|timpani|trio|trombone|trompete|ukelele|viola|violin|violinen|violine|vibrafon|vibraphon|vibraphone|vln|xylophon)(?=[,._&+\-])"
    r")"
)
FILE_GUITARS = r"(?i)gitarren|guitars?|guitares?|guitarras?"
SAID_GUITARS = r"(?i)guitar|gitarre|guitare|guitarra"
# File names that say several guitars, or the guitar; descriptions that say the guitar; words of mixed scorings.
SEVERAL_IN_NAME = r"(?i)guitar[_-]duet|2[_ -]guitars?|(?:^|[_-])(?:duos?|duets?|duetti)\.pdf$|(?:^|[_-])2g(?:[_+.-]|$)"
GUITAR_IN_NAME = r"(?iu)guitar\s*(?:solo|version|part|1)|(?:solo|for)[ _-]*guitar|gitarre|guitarra|viol[aã]o|(?:^|[_-])1g(?:[_+.-]|$)"
GUITAR_SAID = r"(?i)^(?:guitar(?:\s+(?:solo|version|part|1))?|lyre\s+or\s+guitar|solo(?:\s|$))"
MIXED_WORDS = r"[,;+]|\band\b|\bwith\b|ad\s+lib|voice|vocal"
VARIOUS = r"\b(?:various|see individual|see above)\b"
MORE_GUITARS = r"(?<!\w)(?:1\s*(?:or|-)\s*2|2nd)(?:\s+guitars?)?(?!\w)|more\s+guitars?"
HARP_LUTE = r"harp[ -]?lute\s*\(type of guitar\)"


@dataclass(frozen=True)
class Target:
    """What a category collects."""

    instrument: str
    guitars: int = 1
    kind: str = "original"
    mixed: bool = False


def word(pattern: str) -> str:
    """A pattern between word bounds in the Unicode sense."""
    return rf"(?iuU)(?<!\w)(?:{pattern})(?!\w)"


def normal(c: Column) -> Column:
    """A heading trimmed, without list marks, folded, with single blanks."""
    return F.regexp_replace(F.lower(F.regexp_replace(F.trim(c), r"^\*+", "")), r"(?U)\s+", " ")


def signature(c: Column) -> Column:
    """The sorted instruments of a heading; commas and the word and separate them, or doesn't."""
    body = F.regexp_replace(F.regexp_replace(normal(c), r"^for\s+", ""), r"\s+(?:and|&)\s+", ",")
    parts = F.transform(F.split(body, ","), lambda p: F.regexp_replace(F.regexp_replace(p, r"\s+", " "), r"^[ .]+|[ .]+$", ""))
    return F.array_sort(F.filter(parts, lambda p: p != ""))


def instruments(c: Column) -> Column:
    return rules.flags([(normal(c).rlike(word(p)), name) for name, p in HEADING_INSTRUMENTS])


def contains_target(heading: Column, target: str) -> Column:
    """Whether a heading names all instruments of the target, with its numbers, and nothing out of scope."""
    want = F.lit(target)
    counts = F.regexp_extract_all(normal(want), F.lit(rf"(?<!\w)(\d+\s+(?:{COUNTED}))(?!\w)"), F.lit(1))
    same = F.forall(counts, lambda x: F.rlike(normal(heading), F.concat(F.lit(r"(?<!\w)"), F.regexp_replace(x, "s$", ""), F.lit(r"s?(?!\w)"))))
    need = instruments(want)
    return ~heading.rlike(word(OUT_OF_SCOPE)) & (F.size(need) > 0) & (F.size(F.array_except(need, instruments(heading))) == 0) & same


def target_heading(c: Column, target: Target, rejected: list[str]) -> Column:
    """Whether an arrangement heading is the target's."""
    h = normal(c)
    note = F.regexp_extract(h, r" \(([^()]*)\)$", 1)
    body = F.regexp_replace(h, r" \([^()]*\)$", "")
    clean = F.lit(True)
    for t in rejected:
        clean = clean & ~note.contains(t)
    if target.mixed:
        return body.rlike("^for .+") & clean & ((signature(body) == signature(F.lit(target.instrument))) | contains_target(body, target.instrument))
    several = target.guitars > 1 and target.instrument in (f"{target.guitars} guitars", f"{target.guitars} guitar")
    name = rf"{target.guitars}(?: \d+[- ]string)? guitars?" if several else rf"\Q{target.instrument.lower()}\E"
    return body.rlike(rf"^for {name}$") & clean


def work_level(scored: Column, target: Target, rejected: list[str]) -> Column:
    """Whether a work's instrumentation field names the target."""
    s = normal(scored)
    hit = s.rlike(word(rf"\Q{target.instrument.lower()}\E"))
    for t in [] if target.mixed else rejected:
        hit = hit & ~s.contains(t)
    return F.coalesce(hit, F.lit(False))


def others(c: Column) -> Column:
    return rules.flags([(c.rlike(word(p)), name) for name, p in OTHER_INSTRUMENTS])


def heading_state(c: Column, target: Target) -> Column:
    """target, non-target or generic."""
    h = normal(F.coalesce(c, F.lit("")))
    compound = h.rlike(COMPOUND_GUITAR) & (F.size(others(F.regexp_replace(h, COMPOUND_GUITAR, "guitar"))) == 0)
    several = F.lit(False)
    if target.guitars > 1:
        several = h.rlike(word(rf"{target.guitars}\s+guitars?"))
        if target.guitars in ENSEMBLE_WORDS:
            several = several | h.rlike(word(ENSEMBLE_WORDS[target.guitars]))
    foreign = F.size(others(h)) > 0
    return rules.first_match([
        ((h == "") | h.isin(*GENERIC_HEADINGS), "generic"), (foreign & compound, "target"), (foreign, "non-target"), (several, "target"),
        (h.rlike(word(SEVERAL_GUITARS)), "non-target"), (h.rlike(word(GUITAR_WORDS)), "target"),
    ], "generic")


def has_evidence(filename: Column, heading: Column, description: Column, target: Target, trusted: list[str] | None = None) -> Column:
    """Whether something says that a file is the target's."""
    text = F.trim(F.coalesce(description, F.lit("")))
    named = filename.rlike(GUITAR_IN_NAME)
    said = text.rlike(GUITAR_SAID)
    return filename.isin(trusted or []) | (heading_state(heading, target) == "target") | said | named


def mixed_work(scored: Column, target: Target) -> Column:
    """Whether a work's instrumentation is for more or other than the target."""
    s = F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(scored, F.lit(""))), r"''|<br\s*/?>|\{\{.*?\}\}", " "), r"\s+", " "))
    numbers = F.regexp_extract_all(s, F.lit(r"(?<!\w)(\d+)\s+guitars?(?!\w)"), F.lit(1))
    plain = F.regexp_replace(s, f"{COMPOUND_GUITAR}|{HARP_LUTE}", "guitar")
    single = plain.rlike(word(GUITAR_WORDS)) & plain.rlike(word("or")) & ~plain.rlike(MIXED_WORDS)
    return (s != "") & (
        s.rlike(VARIOUS) | s.rlike(MORE_GUITARS)
        | F.exists(numbers, lambda x: x.cast("int") != target.guitars) | (s.startswith("|tags=") & s.rlike(word(TAG_CODES))) | ((F.size(others(plain)) > 0) & ~single)
    )


def exclusion_reason(
    rows: DataFrame, target: Target, excluded_names: list[str] | None = None, exempt_names: list[str] | None = None, exempt_tags: list[str] | None = None
) -> DataFrame:
    """Files (filename, file_heading, description, section, work_instrumentation) with ``reason``, null if they stay.

    Reasons: manual, heading, several_guitars, description, file_name, file_tag. File names may be
    percent-encoded. ``excluded_names`` always go; the description of ``exempt_names`` and the tag
    of ``exempt_tags`` say nothing.
    """
    if target.mixed:
        return rows.withColumn("reason", F.lit(None).cast("string"))
    name = F.coalesce(F.try_url_decode(F.replace("filename", F.lit("+"), F.lit("%2B"))), F.col("filename"))
    said = F.trim(html_unescape(F.coalesce("description", F.lit(""))))
    rows = rows.withColumn("__said", said).withColumn("__state", heading_state(F.col("file_heading"), target)).withColumn("__name", name)
    name = F.col("__name")
    mixed = (mixed_work(F.col("work_instrumentation"), target) if target.guitars == 1 else F.lit(False))
    found = others(F.col("__said"))
    loose = (F.size(F.array_except(found, F.array(F.lit("ensemble"), F.lit("orchestra")))) == 0) & F.col("__said").rlike(SAID_GUITARS)
    own = F.lit(False)
    if target.guitars in (2, 3):
        first = F.lower(F.regexp_extract(name, FILE_TAG, 3))
        own = (first == ("duett" if target.guitars == 2 else "trio")) & name.rlike(FILE_GUITARS)
    reason = rules.first_match([
        (name.isin(excluded_names or []), "manual"), (F.col("__state") == "non-target", "heading"), (F.col("__state") == "target", ""),
        (mixed & F.col("__said").rlike(word(SEVERAL_GUITARS)), "several_guitars"),
        (~name.isin(exempt_names or []) & (F.size(found) > 0) & ~loose, "description"),
        (mixed & name.rlike(SEVERAL_IN_NAME), "file_name"),
        (~name.isin(exempt_tags or []) & name.rlike(FILE_TAG) & ~own, "file_tag"),
    ], "")
    exact = (F.lit(target.kind) == "arrangement") & (F.col("section") != "work level")
    return rows.withColumn("reason", F.nullif(F.when(exact, "").otherwise(reason), F.lit(""))).drop("__said", "__state", "__name")


def work_level_rule(rows: DataFrame, target: Target) -> DataFrame:
    """Files of works (work_id, reason, ...) where an unproven file goes only if no sibling is explicitly another instrument's."""
    foreign = F.max(F.col("reason").isNotNull()).over(Window.partitionBy("work_id"))
    proof = has_evidence(F.col("filename"), F.col("file_heading"), F.col("description"), target)
    drop = F.col("reason").isNull() & mixed_work(F.col("work_instrumentation"), target) & ~proof & ~foreign
    return rows.withColumn("reason", F.when(drop, "no_target_evidence").otherwise(F.col("reason")))


def files(sections: DataFrame) -> DataFrame:
    """First occurrence of each file name of a work: rows (work_id, filename, ord, ...)."""
    first = Window.partitionBy("work_id", "filename").orderBy("ord")
    return sections.withColumn("__r", F.row_number().over(first)).filter("__r = 1").drop("__r")


# Titles with an established translation.
KNOWN_TITLES = {
    "The Entertainer": "《演艺人》",
    "The One Horse Open Sleigh": "《一匹马拉的雪橇》（《铃儿响叮当》原题）",
    "Stille Nacht, heilige Nacht, H.145": "《平安夜》，H.145",
    "Wachet auf, ruft uns die Stimme, BWV 140": "《醒来吧，守望者的声音呼唤》，BWV 140",
    "12 Danzas españolas": "《12首西班牙舞曲》",
    "Danza mora": "《摩尔舞曲》",
    "Dolly Suite, Op.56": "《洋娃娃组曲》，Op.56",
    "French Suite No.1 in D minor, BWV 812": "D小调第1号法国组曲，BWV 812",
    "Musikalisches Opfer, BWV 1079": "《音乐的奉献》，BWV 1079",
    "Préludes, Livre 1, CD 125": "《前奏曲集》第1册，CD 125",
    "Lieder ohne Worte, Op.19b": "《无词歌》，Op.19b",
    "Mallorca, Op.202": "《马略卡》，Op.202",
    "Solace": "《慰藉》",
    "Home, Sweet Home": "《家，甜蜜的家》",
    "Ding Dong Merrily on High": "《叮咚！欢乐在高天》",
    "Pastime with Good Company": "《与良友共度时光》",
    "Sonatina, Sz.55": "《小奏鸣曲》，Sz.55",
    "Ma fin est mon commencement": "《我的终点就是我的起点》",
    "Puis qu'en oubli": "《既然我被遗忘》",
    "J'ay pris amours": "《我已选择爱情》",
    "Allez regrets": "《离去吧，悔恨》",
    "Les petits riens, K.Anh.10/299b": "《小小的无事》，K.Anh.10/299b",
    "So oft ich meine Tobackspfeife, BWV 515": "《每当我抽烟斗时》，BWV 515",
    "Pastorale in D": "D大调田园曲",
    "Pavan": "帕凡舞曲",
    "Bolero": "波莱罗舞曲",
    "Morpeth Rant": "《莫珀斯乡村舞曲》",
    "Temporal Waves": "《时间之波》",
    "Timberlake": "《林中湖》",
    "Coconut Samba": "《椰子桑巴》",
}
# Forms in titles and their Chinese names, in the order in which they are tried.
FORMS = (
    ("Prelude and Fugue", "前奏曲与赋格"), ("Trio Sonata", "三重奏鸣曲"), ("Keyboard Sonata", "键盘奏鸣曲"), ("Piano Sonata", "钢琴奏鸣曲"), ("Organ Sonata", "管风琴奏鸣曲"),
    ("Piano Trio", "钢琴三重奏"), ("String Trio", "弦乐三重奏"), ("Organ Trio", "管风琴三重奏"), ("Baryton Trio", "巴里顿琴三重奏"), ("Divertimento", "嬉游曲"),
    ("Fantasia", "幻想曲"), ("Fantasie", "幻想曲"), ("Capriccio", "随想曲"), ("Canzonetta", "小坎佐纳"), ("Canzona", "坎佐纳"), ("Canzone", "坎佐纳"), ("Canzon", "坎佐纳"),
    ("Ricercar", "利切尔卡尔"), ("Toccata", "托卡塔"), ("Tocata", "托卡塔"), ("Galliard", "加利亚德舞曲"), ("Galliarda", "加利亚德舞曲"), ("Paduana", "帕多瓦舞曲"),
    ("Sonatina", "小奏鸣曲"), ("Sonata", "奏鸣曲"), ("Sinfonia", "三部创意曲"), ("Fugue", "赋格"), ("Fuga", "赋格"), ("Suite", "组曲"), ("Ouverture", "序曲"), ("Overture", "序曲"),
    ("Serenade", "小夜曲"), ("Adagio", "柔板"), ("Andante", "行板"), ("Allemande", "阿勒曼德舞曲"), ("Almande", "阿勒曼德舞曲"), ("Menuetto", "小步舞曲"), ("Ballades", "叙事歌集"),
)
# Other instruments that a title says it is for.
WRITTEN_FOR = (("3 Violins", "为三把小提琴而作"), ("3 Viols", "为三把维奥尔琴而作"), ("Organ", "为管风琴而作"))


# Keys in titles (letters as they are) and their modes, whatever their case.
KEYS = {f"{letter}{sign}": f"{zh}{letter}" for letter in "CDEFGAB" for sign, zh in (("", ""), ("-sharp", "升"), ("-flat", "降"))}
KEY = r"(?iU)\bin\s+([A-G](?:-flat|-sharp)?)\s+(major|minor)\b"


def fallback_title(title: Column, target: Target = Target("guitar")) -> Column:
    """A Chinese title: an established one, or the first known form, the first key, all numbers and the scoring put into Chinese."""
    form = rules.first_match([(title.rlike(rf"(?iuU)\b{f}\b"), f) for f, _ in FORMS])
    zh = F.try_element_at(F.create_map(*[F.lit(x) for pair in FORMS for x in pair]), form)
    first = F.regexp_replace(title, F.concat(F.lit(r"(?iuU)^(.*?)\b"), form, F.lit(r"\b")), F.concat(F.lit("$1"), zh))
    named = F.create_map(*[F.lit(x) for pair in KEYS.items() for x in pair])

    def keyed(t: Column) -> Column:
        # a key in other letters than the table's stays as it is written
        key, mode = F.regexp_extract(t, KEY, 1), F.lower(F.regexp_extract(t, KEY, 2))
        head, tail = F.regexp_extract(t, rf"(?s)^(.*?){KEY}", 1), F.regexp_extract(t, rf"(?s)^.*?{KEY}(.*)$", 3)
        return F.when(key != "", F.concat(head, F.coalesce(F.try_element_at(named, key), key), F.when(mode == "major", "大调").otherwise("小调"), tail)).otherwise(t)

    out = F.get(F.transform(F.array(F.coalesce(first, title)), keyed), F.lit(0))
    out = F.regexp_replace(out, r"(?U)\bNo\.(\d+)", "第$1号")
    own = r"(?:1 )?Guitar" if target.guitars == 1 else rf"{target.guitars} Guitars?"
    out = F.regexp_replace(out, rf"(?iuU)\bfor {own}\b", "为吉他而作" if target.guitars == 1 else f"为{target.guitars}把吉他而作")
    for who, zh in WRITTEN_FOR:
        out = F.regexp_replace(out, rf"(?iuU)\bfor {who}\b", zh)
    made = F.when(out == title, F.concat(F.lit("暂无通行中译（原题："), title, F.lit("）"))).otherwise(out)
    known = F.create_map(*[F.lit(x) for pair in KNOWN_TITLES.items() for x in pair])
    return F.coalesce(F.try_element_at(known, title), made)


def sections(headings: DataFrame, target: Target, rejected: list[str]) -> DataFrame:
    """Attachment rows of parsed headings with ``section``, only those that the category's pages show.

    Original categories take everything before the arrangements; arrangement categories what
    stands below a target heading, or the whole page where there is none and the work itself is
    for the target.
    """
    rows = headings.filter("error is null and attachment is not null")
    arranged = F.exists("ancestry_normalized", lambda h: h == "arrangements and transcriptions")
    if target.kind == "original":
        return rows.filter(~arranged).withColumn("section", F.lit("original"))
    hits = F.filter("ancestry", lambda h: target_heading(h, target, rejected))
    rows = rows.withColumn("section", F.get(hits, F.lit(0)))
    any_hit = F.max(F.col("section").isNotNull()).over(Window.partitionBy("page_id", "revision_id"))
    rows = rows.withColumn("__any", any_hit)
    whole = ~F.col("__any") & work_level(F.col("instrumentation"), target, rejected)
    return rows.withColumn("section", F.when(whole, "work level").otherwise(F.col("section"))).filter("section is not null").drop("__any")


def filename_key(c: Column) -> Column:
    """File names as they are matched: unescaped, blanks for underscores, folded."""
    return F.lower(F.replace(F.try_url_decode(F.replace(html_unescape(c), F.lit("+"), F.lit("%2B"))), F.lit("_"), F.lit(" ")))


def download_urls(filename: Column, image_path: Column, file_id: Column, site: str) -> Column:
    """Candidate addresses of a file, best first, without repeats."""
    base = F.lit(site)
    made = F.array(
        F.when(image_path.isNotNull(), F.concat(base, F.lit("/images/"), image_path)),
        F.when(file_id.isNotNull(), F.concat(base, F.lit("/wiki/Special:ImagefromIndex/"), file_id)),
        F.concat(base, F.lit("/wiki/Special:FilePath/"), F.replace(F.url_encode(F.replace(filename, F.lit(" "), F.lit("_"))), F.lit("+"), F.lit("%20"))),
    )
    return F.array_distinct(F.array_compact(made))
