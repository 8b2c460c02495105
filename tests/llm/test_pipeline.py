"""The pipeline's stages, each on its own input, against brute force; and the odd rows."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
import corpus_pipeline as pipeline
from landrecon.llm import queries
from landrecon.llm.common import table
from landrecon.session import stage
from test_pii import plain
from test_simhash import by_definition, groups
from test_substrings import brute

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output rows of every stage."""
    docs, out = table(spark, FOLDER, "documents"), []
    for name, function in pipeline.STAGES:
        made = stage(function(spark, docs, FOLDER), name)
        out.append((docs.collect(), made.collect(), made.columns))
        docs = made
    return out


def test_all_but_the_last_stage_return_the_columns_of_documents(spark, stages):
    columns = table(spark, FOLDER, "documents").columns
    assert all(s[2] == columns for s in stages[:-1])
    assert len(pipeline.STAGES) == 5 and entry_points.queries()["pipeline"] is pipeline.run


def test_toxic_documents_go(spark, stages):
    before, after, _ = stages[0]
    toxic = {r.doc_id for r in queries.QUERIES["op9_toxicity"](spark, FOLDER).collect() if r.predicted}
    assert sorted(map(tuple, after)) == sorted(tuple(r) for r in before if r.doc_id not in toxic)


def test_one_of_each_group_stays(stages):
    before, after, _ = stages[1]
    prints = {r.doc_id: by_definition(r.text) for r in before}
    first = groups(sorted(prints), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 2)
    assert sorted(map(tuple, after)) == sorted(tuple(r) for r in before if first[r.doc_id] == r.doc_id)
    assert len(after) < len(before)


def test_repeats_are_cut(stages):
    before, after, _ = stages[2]
    want = {i: kept.decode("utf-8", "ignore") for i, kept, *_ in brute([(r.doc_id, r.text.encode()) for r in before])}
    assert {r.doc_id: r.text for r in after} == want and len(after) == len(before)
    assert all(r.n_chars == len(r.text) for r in after)


def test_personal_data_is_redacted(stages):
    before, after, _ = stages[3]
    found = {r.doc_id: plain(r.text) for r in before}
    assert any(found.values()) and len(after) == len(before)
    texts = {r.doc_id: r.text for r in before}
    for r in after:
        assert not plain(r.text)
        if not found[r.doc_id]:
            assert r.text == texts[r.doc_id]


def test_everything_left_is_packed(stages):
    before, after, _ = stages[4]
    library = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    library.encode_special_tokens = True
    whole = {r.doc_id: library.encode(r.text, add_special_tokens=False).ids + [1] for r in before}
    used = defaultdict(int)
    for r in after:
        ids = np.array(whole[r.doc_id][r.start : r.start + r.length], "<u4")
        assert len(ids) == r.length and zlib.crc32(ids.tobytes()) == r.ids_crc32
        used[r.sequence_id] += r.length
    assert sum(used.values()) == sum(map(len, whole.values())) and max(used.values()) <= 4096


def test_run_gives_the_last_stage(spark, stages):
    assert sorted(r.ids_crc32 for r in pipeline.run(spark, FOLDER).collect()) == sorted(r.ids_crc32 for r in stages[-1][1])


def test_nulls_empties_repeats_and_extra_columns(spark):
    long = "some long words here " * 4000
    rows = [
        (1, None, None, None, None), (2, "", "en", "s", 0), (3, "unique words of the third text", "en", "s", 30),
        (3, "unique words of the third text", "en", "s", 30), (None, "a text without an id of its own", "de", None, 9),
        (None, "another text that has none either", None, "t", 9), (4, long, "en", "s", 1), (5, "é" * 40 + " mail a@b.co", "fr", "s", 1),
    ]
    docs = spark.createDataFrame(
        [(*r, "k", 7) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, kept string, row int"
    )
    kept = docs
    sizes = []
    for name, function in pipeline.STAGES[:-1]:
        kept = stage(function(spark, kept, FOLDER), name)
        sizes.append(kept.count())
    by = {(r.doc_id, r.lang): r for r in kept.collect()}
    assert sizes == [8, 6, 6, 6]  # the empty and the NULL text are near-duplicates, the repeated rows one document
    assert by[1, None].text is None and by[None, "de"].text == rows[4][1] and by[None, None].text == rows[5][1]
    assert by[5, "fr"].text == "é" * 40 + " mail [EMAIL]" and by[5, "fr"].n_chars == 53
    assert pipeline.pack(spark, kept, FOLDER).count() >= 6
    empty = docs.limit(0)
    for name, function in pipeline.STAGES[:-1]:
        empty = stage(function(spark, empty, FOLDER), name)
    assert pipeline.pack(spark, empty, FOLDER).count() == 0
