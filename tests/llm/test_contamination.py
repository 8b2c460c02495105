"""Contamination against a plain search for every window."""

import random
import re

import pytest

from landrecon.llm import contamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, span=10):
    windows = {}
    for item, text in items:
        w = split(text)
        n = min(span, len(w))
        for i in range(len(w) - n + 1) if n else ():
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = []
    for doc, text in docs:
        w = split(text)
        hit, found = set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        listed = sorted(str(i) for i in found if i is not None)
        out.append((doc, len(w), len(hit), len(listed), ",".join(listed)))
    return sorted(out, key=str)


def run(spark, docs, items, **options):
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' as item_id", "1 as number")
    b = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "2 as copy", "'y' as window")
    got = contamination.contamination(d, b, **options)
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items"]
    return sorted(map(tuple, got.collect()), key=str)


@pytest.mark.parametrize("span,gram", [(10, 5), (4, 2), (3, 3), (5, 1)])
def test_random_texts(spark, span, gram):
    """Few different words, so that spans of all lengths are shared, repeated and overlapping."""
    draw = random.Random(span)

    def text(most):
        return draw.choice([" ", ", ", "\n"]).join(draw.choice("a B c dé 7".split()) for _ in range(draw.randrange(most)))

    items = [(i, text(3 * span)) for i in range(12)] + [(3, text(20)), (None, text(3 * span))]
    docs = [(i, text(60)) for i in range(150)] + [(i, f"{text(9)} {items[i % 12][1]} {text(9)}") for i in range(60)]
    assert run(spark, docs, items, span=span, gram=gram) == brute(docs, items, span)


def test_edges(spark):
    words = " ".join(f"w{i}" for i in range(30))
    items = [(1, words), (2, "Only five words in here"), (3, "w0"), (4, ""), (5, None), (10, words.upper()), (6, "é É ÀB"), (7, "a-b c_d")]
    docs = [
        (1, words), (1, words), (None, "W3 w4 w5 w6; w7 w8 w9 w10 w11\tw12"), (None, None), (2, ""), (3, "w3 w4 w5 w6 w7 w8 w9 w10 w11"),
        (4, "only FIVE words, in here only five words in here"), (5, "é É Àb"), (6, "é é àb"), (7, "A b C d"), (8, "--- !!"), (9, "w0" * 3),
        (10, "x " * 50_000 + words + " y" * 50_000), (11, "z" * 1_000_000), (12, f"{words} {words}"),
    ]
    assert run(spark, docs, items) == brute(docs, items)
    assert run(spark, docs, items[:0]) == brute(docs, [])
    assert run(spark, docs[:0], items) == []


def test_hot_passage(spark):
    """A passage that all items and a third of all documents share is one window and one list."""
    passage = "the following are multiple choice questions with answers about many subjects"
    items = [(i, f"{passage} number {i} of all") for i in range(300)]
    docs = [(i, f"before {passage} after" if i % 3 == 0 else f"clean text {i}") for i in range(600)]
    assert run(spark, docs, items) == brute(docs, items)


def test_texts_that_meet_no_item_are_split_once(spark, monkeypatch):
    plans, inner = {}, contamination.stage

    def recorded(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return inner(df, name)

    monkeypatch.setattr(contamination, "stage", recorded)
    words = " ".join(f"w{i}" for i in range(12))
    assert run(spark, [(1, words), (2, "clean text"), (2, "clean text")], [(1, words)]) == [(1, 12, 12, 1, "1"), (2, 2, 0, 0, ""), (2, 2, 0, 0, "")]
    assert [name for name, plan in plans.items() if "regexp_extract_all" in plan] == ["items", "places", "hits"]
    assert "Join Inner" in plans["hits"] and "LeftOuter" not in plans["hits"]


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    plan = contamination.contamination(docs, docs.withColumnRenamed("doc_id", "item_id"))._jdf.queryExecution().toString()
    assert "Arrow" not in plan and "Python" not in plan and "CartesianProduct" not in plan
