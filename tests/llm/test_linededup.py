import random
import re

from cantorel.llm import linededup as ld

from .helpers import clashing, docs, rows


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefghijklmn", k=6)) for _ in range(n))


def brute(texts, ids):
    """Spans to remove, by the stated rule, with plain strings for digests."""
    seen, out = set(), {}
    for i, t in sorted(((i, t) for i, t in zip(ids, texts) if t), key=lambda x: x[0]):
        cut = []
        at = 0
        for line in t.split("\n"):
            parts, p = [], 0
            for m in re.finditer(r"[.!?](?=[ \t\r])", line):
                parts.append((p, m.end()))
                p = m.end()
            parts.append((p, len(line)))
            for level, (a, b) in [(0, (0, len(line)))] + [(1, x) for x in parts]:
                w = re.findall(r"\w+", line[a:b].lower())
                first = re.search(r"\w", line[a:b])
                whole = level == 1 and not re.search(r"\w", line[:a]) and b == len(line)
                if whole or len(w) < (ld.MIN_WORDS_LINE, ld.MIN_WORDS_SENTENCE)[level]:
                    continue
                if tuple(w) in seen:
                    cut.append((at + a + first.start(), at + b))
                seen.add(tuple(w))
            at += len(line) + 1
        merged = []
        for a, b in sorted(cut):
            if merged and a <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
            else:
                merged.append((a, b))
        if merged:
            out[i] = merged
    return out


def test_matches_brute_force(spark):
    rng = random.Random(3)
    pool = [words(rng, n) for n in (5, 9, 12, 3, 60)]
    texts = []
    for _ in range(60):
        lines = []
        for _ in range(rng.randint(0, 6)):
            s = rng.choice([words(rng, rng.randint(1, 12)), rng.choice(pool), rng.choice(pool).upper() + ".", words(rng, 3) + ". " + rng.choice(pool) + "! " + words(rng, 2)])
            lines.append(s)
        texts.append("\n".join(lines))
    ids = list(range(60))
    out = ld.dedup(docs(spark, texts, ids)).collect()
    got = {r.doc_id: [tuple(s) for s in r.removed] for r in out if r.removed}
    assert got == brute(texts, ids) and len(got) > 10 and len(out) == 60
    for r in out:
        whole, left, at = texts[r.doc_id], "", 0
        for a, b in got.get(r.doc_id, []):
            left, at = left + whole[at:a], b
        assert r.text == left + whole[at:]


def test_passage_inside_longer_lines(spark):
    rng = random.Random(4)
    passage = ". ".join(words(rng, 15) for _ in range(5)) + "."
    texts = [f"{words(rng, 7)}. {passage} {words(rng, 6)}." for _ in range(3)]
    out = {r.doc_id: r for r in ld.dedup(clashing(docs(spark, texts))).collect()}
    assert not out[0].removed and out[0].text == texts[0]
    for i in (1, 2):
        assert sum(b - a for a, b in out[i].removed) >= 0.95 * len(passage)
        assert out[i].text.startswith(texts[i][:20])
    assert [out[i].long_passages for i in range(3)] == [0, 1, 1]


def test_long_passages_are_counted_over_spans_without_words_between(spark):
    rng = random.Random(8)
    lines = [words(rng, 30) for _ in range(4)]
    texts = ["\n".join(lines), "\n\n".join(lines[:2]) + "\nown words here\n" + lines[2], lines[3], "é " + words(rng, 3)]
    out = {r.doc_id: r.long_passages for r in ld.dedup(docs(spark, texts)).collect()}
    assert out == {0: 0, 1: 1, 2: 0, 3: 0}


def test_many_repeats_in_one_text(spark):
    rng = random.Random(9)
    pool = [words(rng, 6) for _ in range(50)]
    text = "\n".join(rng.choice(pool) for _ in range(20_000))
    r = ld.dedup(docs(spark, [text])).first()
    assert len(r.removed) == 20_000 - len(set(text.split("\n"))) and len(r.text.replace("\n", "")) == sum(map(len, set(text.split("\n"))))


def test_columns_nulls_and_repeated_rows(spark):
    rng = random.Random(5)
    line = words(rng, 8)
    df = docs(spark, [line, line, None, "", line + "\nown words of this text here"], [1, 1, 3, 4, None])
    out = ld.dedup(df)
    assert out.columns == [*df.columns, "removed", "long_passages"]
    kept = {(r.doc_id, r.text) for r in out.collect()}
    # the null id ranks first, so its occurrence stays; equal rows lose theirs alike
    assert kept == {(1, ""), (3, None), (4, ""), (None, line + "\nown words of this text here")}
    assert out.count() == 5
    assert ld.dedup(docs(spark, [])).count() == 0
