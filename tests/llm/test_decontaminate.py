import random
import re

import numpy as np
import pytest

from cantorel.llm import decontaminate as dec

from .helpers import clashing, docs, rows


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(n))


def bench(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def edited(rng, t, n):
    t = list(t)
    for _ in range(n):
        i = rng.randrange(len(t))
        t[i : i + 1] = rng.choice([[], ["q"], [t[i], "z"]])
    return "".join(t)


def plain(t):
    return re.sub(r"[^a-z0-9]+", " ", t.lower()).strip()


def least_edits(pattern, text):
    """Fewest edits of the pattern anywhere in the text, by the full table."""
    col = np.zeros(len(text) + 1, int)
    place, codes = np.arange(len(text) + 1), np.frombuffer(text.encode(), np.uint8)
    for i, c in enumerate(pattern.encode()):
        new = np.append(i + 1, np.minimum(col[:-1] + (codes != c), col[1:] + 1))
        col = np.minimum.accumulate(new - place) + place
    return int(col.min())


def allowed(n):
    return min(n // 10, n // 8 - 1) if n >= 8 else 0


def must(item, text):
    """A passage of 80 characters (or the whole item), from any start, with the edits of a stretch: it has to be found."""
    item, text = plain(item), plain(text)
    if len(item) < 80:
        return least_edits(item, text) <= allowed(min(len(item), 72))
    return any(least_edits(item[s : s + 80], text) <= 7 for s in range(len(item) - 79))


def may(item, text):
    """Only what has a stretch of 72 characters within its edits can be found."""
    item, text = plain(item), plain(text)
    w = min(len(item), 72)
    return any(least_edits(item[s : s + w], text) <= allowed(w) for s in range(len(item) - w + 1))


def test_passages_with_edits_match_brute_force(spark):
    rng = random.Random(5)
    items = [words(rng, n) for n in (40, 25, 13, 12, 6, 4, 3)]
    texts = []
    for k in range(70):
        i = k % len(items)
        a = rng.randrange(max(1, len(items[i]) - 90))
        inner = edited(rng, items[i][a : a + rng.choice([80, 84, 120, 900])], rng.choice([0, 1, 3, 5, 7, 8, 14]))
        texts.append(f"{words(rng, 12)} {inner.upper() if k % 2 else inner}!! {words(rng, 9)}")
    got = set(rows(dec.find(clashing(docs(spark, texts)), bench(spark, items)), "doc_id", "item_id"))
    for k, text in enumerate(texts):
        for j, item in enumerate(items):
            if (k, j) in got:
                assert may(item, text), (k, j)
            else:
                assert not must(item, text), (k, j)
    assert 20 < len(got) < 70


def test_verbatim_passages_of_80_characters_from_any_start():
    rng = random.Random(11)
    item = plain(words(rng, 80))
    index, *_ = index_of([item])
    for size in (80, 83):
        texts = [f"{words(rng, 5)} {item[a : a + size]} {words(rng, 5)}" for a in range(0, len(item) - size)]
        found = index.matches(*compared(texts))
        assert {d for d, _ in found} == set(range(len(texts)))


def compared(texts):
    data, _, off = dec.normalize(*dec.text_bytes(dec.pa.array(texts)))
    return data, off


def index_of(items):
    data, off = compared(items)
    return dec.Index(list(range(len(items))), data, off), data, off


def test_edits_grow_with_the_item():
    width = np.arange(0, 200)
    got = dec.edits(width)
    assert (np.diff(got) >= 0).all() and got[8:16].max() == 0 and got[16] == 1 and got[72] == 7
    bound = (width + 1 - dec.Q * (got + 1))[dec.Q : dec.STRETCH + 1]
    assert (bound >= 1).all()


def test_short_items_are_whole_words(spark):
    texts = ["say Tiny, now", "tinyish shiny", None, "the tiny-big one", "now"]
    got = rows(dec.find(docs(spark, texts), bench(spark, ["tiny", "tiny big", "!?", "tiny", "now"])), "doc_id", "item_id", "start", "end", "distance")
    assert got == [(0, 0, 4, 8, 0), (0, 3, 4, 8, 0), (0, 4, 10, 13, 0), (3, 0, 4, 8, 0), (3, 1, 4, 12, 0), (3, 3, 4, 8, 0), (4, 4, 0, 3, 0)]


def test_long_items_are_found_across_segments():
    rng = random.Random(12)
    item = plain(words(rng, 700))
    index, *_ = index_of(["other words of an item", item])
    assert len(index.of) > 4
    starts = list(range(800, 3000, 37))
    found = index.matches(*compared([f"{words(rng, 4)} {item[a : a + 80]} {words(rng, 4)}" for a in starts]))
    assert {d for d, i in found if i == 1} == set(range(len(starts)))
    whole = index.matches(*compared([f"ab {item} cd"]))
    assert whole == {(0, 1): (0, 3, 3 + len(item))}


def test_repetitive_texts_need_bounded_memory(monkeypatch):
    rng = random.Random(13)
    phrase = plain(words(rng, 6))
    items = [(phrase + " ") * 30 + w for w in ("a", "b", "c")]
    text = plain((phrase + " ") * 400)
    index, *_ = index_of([plain(t) for t in items])
    want = {k: v for k, v in index.matches(*compared([text])).items()}
    most, own = [0], dec.np.argsort
    monkeypatch.setattr(dec, "POSTINGS", 1 << 13)

    def watched(key, **kw):
        most[0] = max(most[0], len(key))
        return own(key, **kw)

    monkeypatch.setattr(dec.np, "argsort", watched)
    got = index.matches(*compared([text, "nothing of it"]))
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()} == {(0, i): 0 for i in range(3)}
    assert all(v[1] <= 8 and v[2] >= len(text) - 80 for v in got.values())
    n = len(index.shared(*compared([text]))[0])
    # far fewer than all pairs of equal q-grams are expanded at once
    assert 0 < most[0] <= 2 * dec.SLICE * dec.SEGMENT // len(phrase) < n * 40
    assert set(index.matches(*compared([text]), once=True))


def test_spans_are_code_points_of_the_original(spark):
    rng = random.Random(6)
    item = words(rng, 9)
    text = "É… " + item.title().replace(" ", ",  ") + " — ü"
    r = dec.find(docs(spark, [text]), bench(spark, [item])).first()
    assert text[r.start : r.end].lower().replace(",  ", " ") == item and r.distance == 0


def test_clean_keeps_the_rest_whole(spark):
    rng = random.Random(7)
    item = words(rng, 30)
    df = docs(spark, [item, None, "", words(rng, 30), item], [1, None, 2, 3, 1])
    kept = dec.clean(df, bench(spark, [item, item, None, "tiny"]))
    assert kept.columns == df.columns and rows(kept, "doc_id") == [(2,), (3,), (None,)]


def test_empty_tables(spark):
    assert dec.find(docs(spark, ["a b"]), bench(spark, []).limit(0)).count() == 0
    assert dec.find(docs(spark, []), bench(spark, ["some words of an item"])).count() == 0


def test_passes_over_large_benchmarks(spark, monkeypatch):
    rng = random.Random(8)
    items = [words(rng, 20) for _ in range(6)]
    monkeypatch.setattr(dec, "PASS_BYTES", 200)
    assert dec.passes(bench(spark, items))[0] > 1
    assert rows(dec.clean(docs(spark, [*items, "kept"]), bench(spark, items)), "doc_id") == [(6,)]
    got = rows(dec.find(docs(spark, items), bench(spark, items)), "doc_id", "item_id")
    assert got == [(i, i) for i in range(6)]


@pytest.mark.parametrize("text", ["a" * 3000, "abababab " * 300])
def test_repetitive_texts(spark, text):
    assert rows(dec.find(docs(spark, [text]), bench(spark, [text[:200]])), "doc_id", "item_id") == [(0, 0)]
