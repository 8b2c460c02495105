"""The machine on pairwise labels, held-out accuracy of the query, and the odd cases."""

import math
import random
import re
import zlib
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from landrecon.llm import queries, toxicity


def test_pairs_are_learnt_that_no_additive_weight_can_express():
    draw = random.Random(1)
    rows, labels = [], []
    for _ in range(2000):
        a, b = draw.random() < 0.5, draw.random() < 0.5
        rows.append([0] * a + [1] * b + [2])
        labels.append(float(a == b))  # both or neither
    bias, weights, factors = toxicity.fit_machine(rows, np.array(labels), 3)
    machine = toxicity.Machine([0, 1, 2], bias, weights, factors)
    assert np.mean([(machine.logit(r) > 0) == t for r, t in zip(rows, labels)]) > 0.99


def test_scores_against_the_sum_over_explicit_pairs(spark):
    """Every score of a table: bias, weights, and the product of factors for each pair of terms."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    machine = toxicity.train(docs, spark.read.parquet(f"{folder}/labels.parquet"), lambda i: toxicity.fold(i) != 0)
    got = {r.doc_id: r.score for r in toxicity.score(docs, machine).collect()}
    place = {t: i for i, t in enumerate(machine.terms)}
    for doc_id, text in docs.select("doc_id", "text").collect():
        marks = {m for w in re.findall(r"\w+", (text or "").lower()) for m in [w, *(f"{w[:n]}*" for n in (4, 5) if len(w) > n)]}
        at = sorted({place[t] for t in (zlib.crc32(m.encode()) % 2**20 for m in marks) if t in place})
        logit = machine.bias + sum(machine.weights[i] for i in at)
        logit += sum(sum(a * b for a, b in zip(machine.factors[i], machine.factors[j])) for i, j in combinations(at, 2))
        assert abs(got[doc_id] - 1 / (1 + math.exp(-max(-30, min(30, logit))))) < 1e-9


def docs_and_labels(spark):
    draw = random.Random(5)
    rows, labels = [], []
    for i in range(400):
        words = ["".join(draw.choice("abcdefgh") for _ in range(3)) for _ in range(40)]
        toxic = i % 4 == 0
        if toxic:
            words[draw.randrange(40)] = "nastyword"
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return (
        spark.createDataFrame(rows, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, toxic int"),
        dict(labels),
    )


def test_planted_word_is_found_on_held_out_rows(spark):
    docs, labels, known = docs_and_labels(spark)
    got = toxicity.score_documents(docs, labels).collect()
    assert len(got) == 400
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) == known[r.doc_id]


def test_all_labelled_rows_are_fitted_in_blocks(spark, monkeypatch):
    """Several blocks, rows of one example among them, give the machine of all rows together."""
    docs, labels, _ = docs_and_labels(spark)
    same = spark.range(500, 560).selectExpr("id AS doc_id", "'nastyword again' AS text")
    docs, labels = docs.unionByName(same), labels.unionByName(same.selectExpr("doc_id", "CAST(1 AS INT) AS toxic"))
    seen, inner = [], toxicity.fit_examples

    def recorded(examples, n, *rest):
        seen.append((examples.count(), examples.agg(F.sum("n")).first()[0], sum(n.values())))
        return inner(examples, n, *rest)

    monkeypatch.setattr(toxicity, "fit_examples", recorded)
    monkeypatch.setattr(toxicity, "STEPS", 40)
    machines = [toxicity.train(docs, labels, lambda i: i >= 0, block=block) for block in (2, 20_000)]
    assert seen[0] == seen[1] and 4 < seen[0][0] < 460 and seen[0][1:] == (460, 460)
    assert machines[0].terms == machines[1].terms
    for got, want in zip((machines[0].bias, machines[0].weights, machines[0].factors), (machines[1].bias, machines[1].weights, machines[1].factors)):
        assert np.allclose(got, want, atol=1e-9)


def test_gradients_against_explicit_pairs():
    """Rows without a term, terms of no row and repeated examples among them."""
    rows, labels, counts = [[0, 2], [], [1, 2, 4], [2]], [1, 0, 0, 1], [1, 3, 2, 5]
    draw = np.random.default_rng(3)
    bias, weights, vectors = draw.normal(size=1), draw.normal(size=6), draw.normal(size=(6, 4))

    def loss(bias, weights, vectors):
        logits = [bias[0] + sum(weights[r]) + sum(vectors[i] @ vectors[j] for i, j in combinations(r, 2)) for r in rows]
        return sum(n * (math.log1p(math.exp(z)) - y * z) for n, z, y in zip(counts, logits, labels))

    model = (bias, weights, vectors)
    for at, got in enumerate(toxicity.block_gradients(toxicity.example_block(rows, labels, counts), *model)):
        for i in np.ndindex(got.shape):
            up, down = ([p.copy() for p in model] for _ in range(2))
            up[at][i] += 1e-6
            down[at][i] -= 1e-6
            assert abs(got[i] - (loss(*up) - loss(*down)) / 2e-6) < 1e-6


def test_a_step_shuffles_nothing_and_has_one_gradient_a_task(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "STEPS", 3)
    examples = spark.range(60).selectExpr("CAST(id % 2 AS INT) AS toxic", "array(CAST(id AS INT), 60) AS terms", "1L AS n").localCheckpoint()
    context, tracker = spark.sparkContext, spark.sparkContext.statusTracker()
    inner = toxicity.descend

    def marked(*args):
        context.setJobGroup("steps", "steps")
        try:
            return inner(*args)
        finally:
            context.setLocalProperty("spark.jobGroup.id", None)

    monkeypatch.setattr(toxicity, "descend", marked)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else one partition has all these few
    try:
        toxicity.fit_examples(examples, {0: 30, 1: 30}, 61, block=2)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    jobs = tracker.getJobIdsForGroup("steps")
    assert len(jobs) == 3
    for job in jobs:
        stages = tracker.getJobInfo(job).stageIds
        assert len(stages) == 1
        assert tracker.getStageInfo(stages[0]).numTasks <= context.defaultParallelism


def test_held_out_labels_are_not_read(spark):
    docs, labels, _ = docs_and_labels(spark)
    turned = labels.withColumn("toxic", F.when(toxicity.fold(F.col("doc_id")) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one = {r.doc_id: r.score for r in toxicity.score_documents(docs, labels).collect()}
    assert one == {r.doc_id: r.score for r in toxicity.score_documents(docs, turned).collect()}


def test_nulls_empties_repeats_and_clashing_columns(spark):
    docs, labels, _ = docs_and_labels(spark)
    odd = spark.createDataFrame(
        [(None, "nastyword", 1.0), (900, None, 0.5), (901, "", 0.1), (902, "nastyword " * 30000, 0.2), (902, "nastyword " * 30000, 0.2)],
        "doc_id long, text string, score double",
    )
    noise = spark.createDataFrame([(900, None), (None, 1), (901, 7), (1, 0), (1, 1)], "doc_id long, toxic int")
    got = toxicity.score_documents(odd, labels.unionByName(noise), train_docs=docs).collect()
    found = sorted((str(r.doc_id), r.predicted, r.held_out) for r in got)
    assert [f[:2] for f in found] == [("900", 0), ("901", 0), ("902", 1), ("902", 1), ("None", 1)]
    assert dict(f[::2] for f in found)["None"] is False
    assert toxicity.score_documents(odd.limit(0), labels).count() == 0


def test_without_both_classes_the_score_is_zero(spark):
    docs, labels, _ = docs_and_labels(spark)
    got = toxicity.score_documents(docs, labels.filter("toxic = 1")).agg(F.max("score"), F.count("score")).first()
    assert tuple(got) == (0.0, 400)


@pytest.mark.parametrize("sf,least", [("sf0.1", 0.97)])
def test_held_out_accuracy_of_the_query(spark, sf, least):
    folder = f"/root/testdata/{sf}"
    scored = queries.QUERIES["op9_toxicity"](spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    right, clean = (
        scored.join(labels, "doc_id").filter("held_out")
        .agg(F.avg((F.col("predicted") == F.col("toxic")).cast("int")), F.avg(F.when(F.col("toxic") == 0, F.col("predicted"))))
        .first()
    )
    assert right >= least and clean <= 0.01


@pytest.mark.parametrize("characters", [1, 60, 1 << 18])
def test_terms_of_a_batch_against_words_one_by_one(monkeypatch, characters):
    """Letters of one to four bytes, digits and marks between words, long words, repeats, and texts without a word; in
    pieces of one text and of several."""
    monkeypatch.setattr(toxicity, "CHARACTERS", characters)
    scripts = " ".join(chr(c) + "abc" + chr(c) * 3 for c in [*range(0x7D, 0x900), 0xFFFD, 0x10000, 0x1D518, 0x20000, 0x10FFFF])
    texts = ["", "\n", "a", "ΑΣ ΟΔΟΣ İstanbul ÉCOLE École", "x" * 24 + " " + "y" * 25 + " " + "é" * 300, "ab*c abcd abcde abcdef abcdé", "_ 5 ١٢٣", scripts, "日本語のテキスト", ""]
    want = [sorted({t for w in re.findall(r"\w+", x.lower()) for t in toxicity.word_terms(w)}) for x in texts]
    kept = sorted({t for terms in want for t in terms[::3]}, reverse=True)
    for some, expected in ((texts, want), ([], []), ([""], [[]])):
        lengths, found = toxicity.text_terms(some, toxicity._Terms())
        assert toxicity.lists(lengths, found).to_pylist() == expected
        lengths, found = toxicity.text_terms(some, toxicity._Terms(), toxicity.places(kept))
        assert toxicity.lists(lengths, found).to_pylist() == [sorted(kept.index(t) for t in terms if t in kept) for terms in expected]


def test_short_words_are_not_hashed_one_by_one(monkeypatch):
    """Else a text's time goes with its new words."""
    seen, inner = [], toxicity.word_terms
    monkeypatch.setattr(toxicity, "word_terms", lambda word: seen.append(word) or inner(word))
    lengths, _ = toxicity.text_terms([f"wörter{i} words{i} {'w' * 40}" for i in range(50)], toxicity._Terms())
    assert len(lengths) == 50 and seen == ["w" * 40]


def test_terms_that_come_together_are_summed_once():
    """Patterns of an example are far fewer than its terms, and have these and no others."""
    draw = random.Random(4)
    rows = [[t for t in draw.sample(range(40), 40) if draw.random() < 0.4] for _ in range(300)] + [[], [45]]
    lengths, col, copies, row, sizes, members, uses, patterns, *_ = toxicity.example_block(rows, [0] * 302)
    assert len(col) == len(row) < 0.5 * sum(map(len, rows))
    of_patterns = np.split(members, np.cumsum(sizes)[:-1])
    got = [[*np.concatenate([of_patterns[c] for c in cols])] if len(cols) else [] for cols in np.split(col, np.cumsum(lengths)[:-1])]
    assert [sorted(g) for g in got] == [sorted(r) for r in rows]
    assert copies.sum() == len(col) and uses.sum() == len(members) == len(patterns)


def test_a_task_of_a_step_holds_more_than_one_block(spark, monkeypatch):
    """To begin it costs as much as a block's gradient, in every step."""
    monkeypatch.setattr(toxicity, "STEPS", 2)
    examples = spark.range(60).selectExpr("CAST(id % 2 AS INT) AS toxic", "array(CAST(id AS INT), 60) AS terms", "1L AS n").localCheckpoint()
    context, inner = spark.sparkContext, toxicity.descend

    def marked(*args):
        context.setJobGroup("pairs", "pairs")
        try:
            return inner(*args)
        finally:
            context.setLocalProperty("spark.jobGroup.id", None)

    monkeypatch.setattr(toxicity, "descend", marked)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else one partition has all these few
    try:
        toxicity.fit_examples(examples, {0: 30, 1: 30}, 61, block=15)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    tracker = context.statusTracker()
    assert [tracker.getStageInfo(s).numTasks for j in tracker.getJobIdsForGroup("pairs") for s in tracker.getJobInfo(j).stageIds] == [2, 2]
