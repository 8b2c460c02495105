"""Base spans against the plain patterns, added spans, redaction, and the odd cases."""

import hashlib
import random
import re

from landrecon.llm import pii, queries

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def plain(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or "", re.ASCII):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def shown(spans):
    return [(pii.KINDS[s["kind"]], s["start"], s["end"]) for s in spans]


FIXED = [
    "", None, "a@b a@b.c@d.e x@y.z_foo@bar.com .@-.- a@b@c.de", "1.2.3.4.5 256.1.1.1 001.02.3.004 1.2.3", "12.3.4.5678.9.9.9",
    "4539 1488 0343 6467 4539-1488-0343-6467 4539148803436467 45391488034364671", "+1 (555) 123-4567 +12 +1 2 3 4 5 6 7 8 +1(.)9 +99",
    "é漢😀 a@b.co 😀 10.0.0.1 +4930123456789", "0" * 5000 + " " + "1.1.1.1" + "x" * 3000 + "@", "a@" + ".".join(["bc"] * 3000),
    "1 " * 4000, "+" + "1 " * 4000, "9" * 16 + "-" * 3 + "4111111111111111", "a(at)b.com [at] x",
]


def noise(draw):
    return "".join(draw.choice("ab@.+-() 0123456789%_é😀\n") for _ in range(draw.randint(0, 120)))


def test_base_spans_are_those_of_the_plain_patterns(spark):
    draw = random.Random(8)
    texts = FIXED + [noise(draw) for _ in range(1500)]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, base string")
    for r in pii.find(docs).collect():
        assert shown(r.base) == plain(texts[r.doc_id]), texts[r.doc_id][:100]
        assert {tuple(s) for s in r.base} <= {tuple(s) for s in r.spans} and list(r.spans) == sorted(r.spans)


def test_digits_that_all_stand_apart(spark):
    apart = ["call +4 4 2 0 7 9 4 6 now", "+1 2 3 4 5 6 7 8", "-".join("4111111111111111"), " ".join("4111111111111111"), "+1-2.3(4)5 6-7.8", "1.2.3.4"]
    docs = spark.createDataFrame(list(enumerate(apart)), "doc_id long, text string")
    for r in pii.find(docs).collect():
        assert len(r.base) == 1 and shown(r.base) == plain(apart[r.doc_id]), apart[r.doc_id]
    redacted = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert redacted == {0: "call [PHONE] now", 1: "[PHONE]", 2: "[CARD]", 3: "[CARD]", 4: "[PHONE]", 5: "[IP]"}


def test_spans_are_added_that_the_base_rules_miss(spark):
    draw = random.Random(3)

    def number(n):
        return "".join(draw.choice("0123456789") for _ in range(n))

    def card():
        body = "4" + number(14)
        return next(body + d for d in "0123456789" if luhn(body + d))

    texts = []
    for i in range(300):
        texts.append(
            f"words and mail x{i}.{number(2)}@mail{i % 9}.example.com more, +1 ({number(3)}) 555-{number(4)} then {card()} or 4{number(15)} "
            f"from {draw.randint(0, 255)}.{draw.randint(0, 255)}.3.4 and {number(8)} on 2024-0{draw.randint(1, 9)}-11 for 1{number(4)} {number(1)}"
        )
    added = {"write to name (at) corp (dot) com today": ("email", 9, 33), "call (555) 123-4567 now": ("phone", 5, 19), "paid by 4111.1111.1111.1111 now": ("card", 8, 27)}
    never = ["on 2024-03-11 08 we", "meet (at) noon", "no 4111.1111.1111.1112 now", "from 300.1.2.3 on", "row 12345678 of"]
    texts += [*added, *never]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {texts[r.doc_id]: r for r in pii.find(docs).collect()}
    for text, span in added.items():
        assert not got[text].base and shown(got[text].spans) == [span], text
    assert all(not got[text].spans for text in never)
    assert all(r.spans == r.base for t, r in got.items() if t not in added)


def test_query_against_the_plain_patterns(spark):
    folder = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = queries.QUERIES["op5_pii_boosted"](spark, folder).collect()
    assert len(got) == len(docs)
    extra = 0
    for r in got:
        want = plain(docs[r.doc_id])
        text = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(w[0] == k for w in want) for k in pii.KINDS]
        assert set(filter(None, text.split(","))) <= set(r.spans.split(","))
        extra += len(set(filter(None, r.spans.split(",")))) - len(want)
    assert extra <= 0.02 * sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in got)


def test_redaction(spark):
    rows = [(1, "é write a@b.co or +1 (555) 123-4567.", "x"), (2, None, "y"), (3, "nothing", "z"), (3, "nothing", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = pii.redact(docs)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(1, "é write [EMAIL] or [PHONE].", "x"), (2, None, "y"), (3, "nothing", "z"), (3, "nothing", "z")], key=str
    )


def test_empty_table_and_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "a@b.co"), (1, "a@b.co"), (None, "a@b.co")], "doc_id long, text string")
    assert [shown(r.base) for r in pii.find(docs).collect()] == [[("email", 0, 6)]] * 3
    assert pii.find(docs.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a@b.co")], "doc_id long, text string").coalesce(1)
    plan = pii.find(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|InArrow", plan)


def test_very_many_spans_in_one_text(spark):
    """50,000 emails and as many phones; work grows with their number, not with its square."""
    from time import monotonic

    lines = [f"n{i}@mail{i % 7}.co +4930{1000000 + i} é" for i in range(50_000)]
    text = "\n".join(lines)
    docs = spark.createDataFrame([(1, text), (2, "x@y.zz")], "doc_id long, text string")
    begin = monotonic()
    got = {r.doc_id: r for r in pii.find(docs).collect()}
    assert shown(got[1].base) == plain(text) and len(got[1].base) == 100_000
    clean = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert clean == {1: "\n".join(["[EMAIL] [PHONE] é"] * 50_000), 2: "[EMAIL]"}
    assert monotonic() - begin < 300


def test_long_local_parts_are_candidates(spark):
    text = "a" * 200 + " (at) corp (dot) com"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert pii._scan(docs).selectExpr("candidates[0].end").first()[0] == len(text)


def test_all_labelled_examples_are_fitted(spark, monkeypatch):
    from pyspark.sql import functions as F

    real, weights = pii.GBTClassifier, []

    class Recorded:
        def __init__(self, **options):
            self.trees, self.weight = real(**options), options["weightCol"]

        def fit(self, rows):
            weights.append(rows.agg(F.sum(self.weight)).first()[0])
            return self.trees.fit(rows)

    monkeypatch.setattr(pii, "GBTClassifier", Recorded)
    candidates = spark.range(30_000).selectExpr(
        "id AS doc_id", "0 AS kind", "CAST(id AS INT) AS start", "CAST(id + 5 AS INT) AS end", "0 AS variant", "id % 3 = 0 AS label",
        "array(CAST(id % 3 = 0 AS DOUBLE), CAST(id % 7 AS DOUBLE)) AS features",
    )
    model, thresholds = pii._fit(candidates)
    assert weights == [candidates.filter(pii._fold(candidates) != 0).count()] and weights[0] > 20_000
    assert thresholds.keys() == {0}
