"""Language identification by nearest centroids of normalised TF-IDF n-gram vectors.

A text is the vector of its hashed byte n-grams, counts times inverse document frequency, of
length one. Each language has several centroids, clustered from a sample; a text takes the language
of the centroid nearest by cosine. It is marked as rejected if it lies further off than that
centroid's own members do.

Document frequencies are counted over all rows to learn from. Centroids are clustered from at most
``sample`` ids a language, the first by a hash; where ids are repeated, from at most twice as many texts,
the first in order. What reaches the driver is ``CENTROIDS`` vectors of ``BUCKETS`` numbers a language,
so there should be no more than some hundreds of languages. Prediction reads nothing but the text.
NULL texts and texts without a letter are ``und`` with score 0 and rejected, as is everything if
there is no row to learn from. Rows with NULL language or id teach nothing. Repeated rows give one
result each; columns other than those named are left out.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from landrecon.llm.common import batches
from landrecon.operators.lookups import attach

SAMPLE = 800
CENTROIDS = 4
BUCKETS = 1 << 13
NGRAMS = (2, 3)
ROUNDS = 10
# A text is rejected below a centroid's mean cosine less this many standard deviations of its members.
REJECT = 4.0
SEGMENT = 1 << 20
UNDETERMINED = "und"

_no_letters = re.compile(r"[\W\d_]+").sub


def ngram_counts(text: str, buckets: int = BUCKETS) -> np.ndarray:
    """Counts of the hashed byte n-grams of the lower-case words, a space at either end of each."""
    data = np.frombuffer(_no_letters(" ", f" {text.lower()} ").encode(), dtype=np.uint8)
    shift = np.uint32(32 - int(buckets).bit_length() + 1)
    counts = np.zeros(buckets, dtype=np.int64)
    for n in NGRAMS:
        for at in range(0, max(1, len(data) - n + 1), SEGMENT):
            part = data[at : at + SEGMENT + n - 1].astype(np.uint32)
            if len(part) >= n:
                code = part[: len(part) - n + 1].copy()
                for k in range(1, n):
                    code = code << np.uint32(8) | part[k : len(part) - n + 1 + k]
                code = (code + np.uint32(n)) * np.uint32(2654435761) >> shift
                counts += np.bincount(code, minlength=buckets)
    return counts


def vector(text: str, idf: np.ndarray) -> np.ndarray:
    weighted = ngram_counts(text, len(idf)) * idf
    norm = np.sqrt(weighted @ weighted)
    return weighted / norm if norm else weighted


def document_frequencies(docs: DataFrame, buckets: int = BUCKETS) -> tuple[np.ndarray, int]:
    """In how many texts each hashed n-gram occurs, and the number of texts."""

    def count_all(part):
        found, n = np.zeros(buckets, dtype=np.int64), 0
        for batch in part:
            for text in batch["text"].to_pylist():
                found += ngram_counts(text, buckets) > 0
                n += 1
        bucket = np.append(np.flatnonzero(found), -1)
        yield pa.RecordBatch.from_pydict(
            {"bucket": pa.array(bucket, pa.int32()), "n": pa.array(np.append(found[bucket[:-1]], n), pa.int64())}
        )

    counted = docs.select("text").mapInArrow(count_all, "bucket int, n long")
    df = np.zeros(buckets, dtype=np.int64)
    total = 0
    # One row per bucket.
    for bucket, n in counted.groupBy("bucket").agg(F.sum("n")).collect():
        if bucket < 0:
            total = n
        else:
            df[bucket] = n
    return df, total


def cluster(vectors: np.ndarray, k: int = CENTROIDS) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from far-apart rows; (centroids, least cosine a member is allowed)."""
    chosen = [0]
    nearest = vectors @ vectors[0]
    while len(chosen) < min(k, len(vectors)):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, vectors @ vectors[chosen[-1]])
    centres = vectors[chosen]
    for _ in range(ROUNDS):
        own = (vectors @ centres.T).argmax(axis=1)
        sums = np.stack([vectors[own == c].sum(axis=0) for c in range(len(centres))])
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norm > 0, sums / np.where(norm > 0, norm, 1), centres)
    cosine = vectors @ centres.T
    own = cosine.argmax(axis=1)
    used = np.unique(own)
    members = [cosine[own == c, c] for c in used]
    return centres[used], np.array([m.mean() - REJECT * m.std() for m in members])


def fit(docs: DataFrame, learn_from: Column, sample: int = SAMPLE, k: int = CENTROIDS):
    """(languages, centroids, least cosines, idf) from rows with doc_id, text and lang."""
    known = docs.filter(
        learn_from & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")
    ).select("doc_id", "text", "lang")
    df, n = document_frequencies(known)
    idf = np.log((1 + n) / (1 + df)) + 1
    draw = F.xxhash64("doc_id")
    listed = docs.filter(learn_from & F.col("lang").isNotNull()).select("doc_id", "lang").distinct()
    # A language's rows are thinned by their hash to some more than the sample before they meet.
    size = listed.groupBy("lang").agg(F.count(F.lit(1)).alias("_rows"))
    share = F.lit(1.5 * sample) / F.col("_rows")
    thin = attach(listed, size, ["lang"]).filter((draw / 2.0**64 + 0.5) <= share).drop("_rows")
    order = Window.partitionBy("lang").orderBy(draw, "doc_id")
    first = thin.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= sample).drop("_n")
    # At most ``sample`` ids a language.
    chosen = known.join(F.broadcast(first), ["doc_id", "lang"]).select("lang", "text")

    def cluster_all(rows: pd.DataFrame) -> pd.DataFrame:
        vectors = np.stack([vector(t, idf) for t in sorted(rows["text"])[: 2 * sample]])
        centres, least = cluster(vectors, k)
        return pd.DataFrame(
            {"lang": rows["lang"].iloc[0], "n": range(len(centres)), "least": least, "centre": [c.tobytes() for c in centres]}
        )

    found = chosen.groupBy("lang").applyInPandas(cluster_all, "lang string, n int, least double, centre binary")
    rows = sorted(found.collect(), key=lambda r: (r["lang"], r["n"]))  # ``k`` rows a language
    centres = np.array([np.frombuffer(r["centre"]) for r in rows])
    return [r["lang"] for r in rows], centres, np.array([r["least"] for r in rows]), idf


def predict(docs: DataFrame, model) -> DataFrame:
    """doc_id, lang_pred, score and rejected per row."""
    languages, centres, least, idf = model
    kind = dict(docs.dtypes)["doc_id"]

    def run_all(part):
        def run(batch):
            names, scores, rejected = [], [], []
            for text, letters in zip(batch["text"].to_pylist(), batch["letters"].to_pylist()):
                if not letters or not languages:
                    names.append(UNDETERMINED), scores.append(0.0), rejected.append(True)
                    continue
                cosine = centres @ vector(text, idf)
                best = int(cosine.argmax())
                names.append(languages[best])
                scores.append(float(min(1.0, max(0.0, cosine[best]))))
                rejected.append(bool(cosine[best] < least[best]))
            return pa.RecordBatch.from_pydict(
                {"doc_id": batch["doc_id"], "lang_pred": names, "score": pa.array(scores, pa.float64()), "rejected": rejected}
            )

        return batches(part, run)

    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters")
    return docs.select("doc_id", "text", letters).mapInArrow(
        run_all, f"doc_id {kind}, lang_pred string, score double, rejected boolean"
    )


def fold(doc_id: Column, folds: int = 3) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(folds))


def identify(docs: DataFrame, held_out: Callable[[Column], Column] = lambda i: fold(i) == 1) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected per row; learnt from the rows not held out."""
    narrow = docs.select("doc_id", "text", "lang")
    found = predict(narrow, fit(narrow, ~held_out(F.col("doc_id"))))
    return found.withColumn("held_out", F.coalesce(held_out(F.col("doc_id")), F.lit(False))).select(
        "doc_id", "held_out", "lang_pred", "score", "rejected"
    )
