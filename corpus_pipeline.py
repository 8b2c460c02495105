"""A training corpus from raw documents, in five stages.

Each stage reads what its predecessor kept, as a written table, and returns rows with the columns
of ``documents``; the last one returns the packed pieces. Documents predicted toxic go; of each
group of SimHash near-duplicates the document with the smallest id stays; byte strings of 50 and
more that also start in an earlier document are cut out; personal data gives way to the name of its
kind; what is left is packed into sequences of 4096 ids.

NULL texts stay NULL up to packing, which reads them as empty. A row with NULL id is the document
that stays only if no row of its group has an id; rows repeated as a whole count as one document.
What the third stage leaves of a character cut in two is dropped; a document of which all is
repeated stays with an empty text. ``n_chars`` follows the text. Other columns are left out.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from landrecon.llm import packing, pii, simhash, substrings, toxicity
from landrecon.llm.common import prepare, table
from landrecon.session import stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Score every text by the machine fitted on the labelled documents; predicted toxic ones go."""
    labels = table(spark, sf_dir, "labels")
    machine = toxicity.train(docs, labels, lambda i: toxicity.fold(i) != 0)
    return toxicity.score(docs, machine, COLUMNS).filter("score < 0.5").select(COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near-duplicates the document with the smallest id stays."""
    prepare(spark)
    groups = simhash.near_duplicates(docs)
    first = groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_id")).distinct()
    stay = docs.select(*COLUMNS, F.xxhash64("text").alias("_print")).join(first, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    return stay.dropDuplicates(["doc_id", "_print"]).select(COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut out the byte strings that also start in an earlier document."""
    prepare(spark)
    named = docs.select(*COLUMNS, F.col("text").isNull().alias("_none"))
    cut = substrings.remove_repeats(named, carry=["doc_id", "lang", "source", "_none"])
    text = F.when(~F.col("carried._none"), substrings.readable("kept"))
    return cut.select("carried.doc_id", text.alias("text"), "carried.lang", "carried.source").select(
        "doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars")
    )


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by the name of its kind."""
    prepare(spark)
    return pii.redact(docs.select(COLUMNS)).withColumn("n_chars", F.length("text").cast("long"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the ids of the texts into sequences."""
    prepare(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("suffix_dedup", cut_repeats),
    ("pii", redact),
    ("packing", pack),
]

# A fitted model and a search for packings decide rows here, so the result is tested by parts
# against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
