import hashlib
import random
import re

from pyspark.sql import functions as F

from cantorel.llm import pii

from .helpers import clashing, docs, rows

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(s):
    d = [int(c) for c in s if c.isdigit()][::-1]
    return sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(d)) % 10 == 0


def brute(text):
    out = []
    for k, (name, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text, re.ASCII):
            s, n = m.group(), sum(c.isdigit() for c in m.group())
            good = {"email": True, "ip": name == "ip" and all(int(x) <= 255 for x in s.split(".")), "card": 14 <= n <= 19 and luhn(s), "phone": 10 <= n <= 15}
            if good[name]:
                out.append((m.start(), k, m.end(), name))
    return ",".join(f"{n}:{a}:{b}" for a, _, b, n in sorted(out))


def test_base_spans_match_the_stated_patterns(spark):
    rng = random.Random(4)
    parts = ["a@b.c", "_x@y.z_q@r.s", "1.2.3.4", "255.0.0.1.9.9.9.9", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 010-9999", "+49 30", "é", "😀", ".", "@", " ", "-", "7", "00", "+", "(", "a", "%", "\n", "0001.1.1.1"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(400)]
    texts += [None, "", "1" * 5000, "1.1.1.1 " * 300, "+" + "1 " * 2000, "a." * 3000 + "@b.c" + ".d" * 3000]
    got = pii.detect(clashing(docs(spark, texts))).select("doc_id", pii.joined(F.col("spans"), base_only=True).alias("s"))
    assert dict(rows(got, "doc_id", "s")) == {i: brute(t or "") for i, t in enumerate(texts)}


def test_checksums_and_context(spark):
    texts = [
        "my IBAN is DE89 3704 0044 0532 0130 00 ok", "DE89 3704 0044 0532 0130 01", "GB82WEST12345698765432",
        "social security 123-45-6789", "part 123-45-6789", "ssn 000-45-6789",
    ]
    got = pii.detect(docs(spark, texts)).select("doc_id", F.transform("spans", lambda s: s["kind"]).alias("k"), "spans").collect()
    assert [r.k for r in sorted(got)] == [["iban"], [], ["iban"], ["ssn"], [], []]
    other = pii.detect(docs(spark, ["serial GB82WEST12345698765432", "serial GB82WEST12345698765432 of the account", "order +1 555 010 9999"])).collect()
    assert [[(s.kind, round(s.score, 2)) for s in r.spans] for r in sorted(other)] == [[], [("iban", 0.92)], [("phone", 0.42)]]
    near = pii.detect(docs(spark, ["mail a@b.c", "zz a@b.c"])).collect()
    assert near[0].spans[0].score > near[1].spans[0].score


def test_many_matches_take_linear_time(spark):
    text = "a@b.c " * 40_000
    r = pii.detect(docs(spark, [text])).select(F.size("spans").alias("n"), F.element_at("spans", -1)["start"].alias("last"), F.element_at("spans", 130)["start"].alias("some")).first()
    assert (r.n, r.last, r.some) == (40_000, 6 * 39_999, 6 * 129)


def test_redaction_keeps_columns_nulls_and_the_rest(spark):
    df = docs(spark, ["x a@b.c, +1 555 010 9999 or 10.0.0.1.", None, "", "clean é"])
    out = pii.redact(df)
    assert out.columns == df.columns
    assert [r.text for r in sorted(out.collect())] == ["x [EMAIL], [PHONE] or [IP].", None, "", "clean é"]


def test_digest_of_a_text_without_spans(spark):
    r = pii.detect(docs(spark, [None])).select(F.sha2(pii.joined(F.col("spans"), True).cast("binary"), 256).alias("h")).first()
    assert r.h == hashlib.sha256(b"").hexdigest()
    assert pii.detect(docs(spark, [])).count() == 0
