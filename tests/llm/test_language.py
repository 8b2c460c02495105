"""Language identification: held-out accuracy, rejection, and the odd cases."""

import math
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from landrecon.llm import language, queries


def test_held_out_accuracy_of_the_query(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = queries.QUERIES["op4_language_id"](spark, folder)
    rows = got.join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    assert np.mean([r.lang_pred == r.lang for r in held]) >= 0.98


ENGLISH = "the house stands where the river bends and nobody goes there in winter"
GERMAN = "das haus steht wo der fluss sich biegt und niemand geht im winter dorthin"


def small(spark, extra=()):
    rows = [(i, f"{ENGLISH} {i % 7}", "en") for i in range(30)] + [(100 + i, f"{GERMAN} {i % 7}", "de") for i in range(30)]
    return spark.createDataFrame([*rows, *extra], "doc_id long, text string, lang string")


def test_odd_rows(spark):
    extra = [
        (500, None, "en"), (501, "", "de"), (502, "123 !?", None), (503, "der fluss im winter", None), (None, "the river bends", None),
        (504, "漢字仮名交じり文", None), (505, GERMAN * 5000, "en"), (505, GERMAN * 5000, "en"),
    ]
    got = language.identify(small(spark, extra).withColumn("score", F.lit("clash"))).collect()
    assert len(got) == 68
    by = {r.doc_id: r for r in got if r.doc_id is None or r.doc_id >= 500}
    for i in (500, 501, 502):
        assert (by[i].lang_pred, by[i].score, by[i].rejected) == ("und", 0.0, True)
    assert by[503].lang_pred == "de" and by[None].lang_pred == "en" and not by[None].held_out
    assert by[504].lang_pred in ("de", "en") and by[504].rejected
    assert sum(r.doc_id == 505 for r in got) == 2


def test_predictions_against_a_plain_nearest_centroid(spark):
    """Every prediction of a table, by dictionaries of n-grams, from the same fitted centroids."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    model = language.fit(docs, language.fold(F.col("doc_id")) != 1)
    languages, centres, least, idf = model
    got = {r.doc_id: r for r in language.predict(docs, model).collect()}
    for doc_id, text, _ in docs.collect():
        words = re.findall(r"[^\W\d_]+", (text or "").lower())
        if not words:
            assert (got[doc_id].lang_pred, got[doc_id].score) == ("und", 0.0)
            continue
        data = f" {' '.join(words)} ".encode()
        counts = {}
        for n in (2, 3):
            for i in range(len(data) - n + 1):
                code = (int.from_bytes(data[i : i + n], "big") + n) * 2654435761 % 2**32 >> 32 - 13
                counts[code] = counts.get(code, 0) + 1
        weights = {c: k * idf[c] for c, k in counts.items()}
        norm = math.sqrt(sum(w * w for w in weights.values()))
        cosines = [sum(w * centre[c] for c, w in weights.items()) / norm for centre in centres]
        best = max(cosines)
        assert abs(got[doc_id].score - best) < 1e-9
        near = [i for i, c in enumerate(cosines) if c > best - 1e-9]
        assert got[doc_id].lang_pred in [languages[i] for i in near]
        if all(abs(best - least[i]) > 1e-9 for i in near):
            assert got[doc_id].rejected in [best < least[i] for i in near]


def test_held_out_rows_teach_nothing(spark):
    turned = small(spark).withColumn("lang", F.when(language.fold(F.col("doc_id")) == 1, "xx").otherwise(F.col("lang")))
    plain = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(small(spark)).collect()}
    assert plain == {r.doc_id: (r.lang_pred, r.score) for r in language.identify(turned).collect()}


def test_empty_table_and_nothing_to_learn(spark):
    assert language.identify(small(spark).limit(0)).count() == 0
    got = language.identify(small(spark).withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.rejected) for r in got} == {("und", True)}


def test_counts_do_not_depend_on_segments(monkeypatch):
    text = "ab cd ef gh " * 50
    whole = language.ngram_counts(text)
    monkeypatch.setattr(language, "SEGMENT", 7)
    assert (language.ngram_counts(text) == whole).all()
