"""Benchmark decontamination by winnowing, in DataFrame functions only.

Texts are split into words. A window is ``span`` consecutive words of a benchmark item, or the whole
item if it has fewer. Fingerprints are hashes of k words; of every ``span - k + 1`` consecutive ones the
smallest is kept, wherever it occurs. A document and an item that share ``span`` words share all hashes
of them and so keep a common one; documents and items meet by these fingerprints. The places where they
meet are extended to all windows around them, and these are compared as texts, so every hit is exact. An
item of fewer words is its own single fingerprint; for the lengths that such items have, and only those,
documents keep all fingerprints.

The fingerprints of the documents meet the distinct ones of the benchmark in a lookup; only the
places that are found, and one row with its number of words for each document, travel on. Each distinct window has a number, and a document finds a window at most
once a place, however many items have it. Lists of items are made once for every distinct set of windows
and not for each document. All lookups are ``attach`` joins: a fingerprint or window that a third of the
documents hold can be split over tasks, and a benchmark that Spark measures as small is broadcast.

NULL texts have no words; a document without words is not contaminated. Rows with NULL doc_id and
repeated rows give one result each. Of an item id that is repeated all texts count; an item with NULL id
makes hits but is on no list. Other columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from landrecon.llm.common import let
from landrecon.operators.lookups import attach
from landrecon.session import stage
from landrecon.sources.ids import number_rows

# The characters of a word, after lower-casing A to Z.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPAN = 10
# Words of a fingerprint of a whole span.
GRAM = 5
# A place is its first word's position times this, plus its length in words.
LENGTHS = 1 << 10


def words(text: str | Column) -> Column:
    """The lower-case words of a text; none of NULL."""
    lowered = F.translate(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def _starts(n: Column, length: int | Column) -> Column:
    """First positions, from 0, of all runs of so many words; none if there are fewer."""
    none = F.array().cast("array<int>")
    return F.when(n >= length, F.sequence(F.lit(0), n - length)).otherwise(none)


def _place(start: Column, length: int | Column) -> Column:
    return start.cast("long") * LENGTHS + length


def _print(place: Column, value: Column) -> Column:
    return F.struct(place.alias("place"), value.alias("print"))


def winnowed(w: Column, span: int, gram: int) -> Column:
    """(place, print) of the smallest k-gram hashes of all runs of ``span`` words."""
    reach = span - gram + 1
    hashes = F.transform(w, lambda x: F.xxhash64(x))

    def grams(h: Column) -> Column:
        return F.transform(_starts(F.size(h), gram), lambda i: F.xxhash64(F.lit(span), *[F.get(h, i + j) for j in range(gram)]))

    def least(g: Column) -> Column:
        return F.transform(_starts(F.size(g), reach), lambda i: F.array_min(F.array(*[F.get(g, i + j) for j in range(reach)])))

    def kept(g: Column, m: Column) -> Column:
        # A hash is the least of some run if it is the greatest of the least hashes of its runs.
        mark = lambda x, i: F.when(x == F.array_max(F.array(*[F.get(m, i - j) for j in range(reach)])), _print(_place(i, span), x))
        return F.filter(F.transform(g, mark), lambda p: p.isNotNull())

    found = let(hashes, lambda h: let(grams(h), lambda g: let(least(g), lambda m: kept(g, m))))
    none = F.array().cast("array<struct<place:bigint,print:bigint>>")
    return F.when(F.size(w) >= span, found).otherwise(none)


def whole_prints(w: Column, length: int) -> Column:
    """(place, print) of all runs of ``length`` words."""
    return F.transform(
        _starts(F.size(w), length), lambda i: _print(_place(i, length), F.xxhash64(F.lit(length), F.slice(w, i + 1, length)))
    )


def _text_at(w: Column, place: Column) -> Column:
    start = F.floor(place / LENGTHS).cast("int")
    return F.concat_ws(" ", F.slice(w, start + 1, F.pmod(place, F.lit(LENGTHS)).cast("int")))


def _windows_around(w: Column, places: Column, span: int, gram: int) -> Column:
    """(place, window) of all windows that contain a fingerprint at one of the places."""
    last = F.size(w) - span

    def around(place: Column) -> Column:
        start, length = F.floor(place / LENGTHS).cast("int"), F.pmod(place, F.lit(LENGTHS))
        first = F.greatest(start - (span - gram), F.lit(0))
        run = F.transform(F.sequence(first, F.least(start, last)), lambda s: _place(s, span))
        return F.when(length < span, F.array(place)).otherwise(run)

    wanted = F.array_distinct(F.flatten(F.transform(places, around)))
    return F.transform(wanted, lambda p: F.struct(p.alias("place"), _text_at(w, p).alias("window")))


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", item_col: str = "item_id",
    text_col: str = "text", span: int = SPAN, gram: int = GRAM,
) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items (their ids as one text, sorted, comma-joined) per document."""
    if not 1 <= gram <= span < LENGTHS:
        raise ValueError("gram must be at least 1 and at most span, span below LENGTHS")
    docs = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    docs = docs.withColumn("copy", F.xxhash64("text"))
    key = ["doc_id", "copy"]

    items = stage(benchmark.select(F.col(item_col).alias("item_id"), words(text_col).alias("w")).distinct(), "items")
    lengths = items.select(F.size("w").alias("n")).filter(f"n > 0 and n < {span}").distinct().collect()  # below span
    short = sorted(r.n for r in lengths)
    size = F.size("w")
    of_item = F.when(size >= span, winnowed(F.col("w"), span, gram)).when(
        size > 0, F.array(_print(_place(F.lit(0), size), F.xxhash64(size, F.col("w"))))
    )
    prints = stage(items.select(F.explode(of_item).alias("p")).select("p.print").distinct(), "prints")
    length = F.least(size, F.lit(span))
    all_windows = F.transform(_starts(size, length), lambda s: F.concat_ws(" ", F.slice("w", s + 1, length)))
    members = stage(
        items.filter(size > 0).select("item_id", F.explode(all_windows).alias("window"), length.alias("length")).distinct(), "members"
    )
    numbered = stage(number_rows(members.select("window", "length").distinct(), ["window", "length"], "number"), "windows")

    def all_prints(w: Column) -> Column:
        # Beside the fingerprints, one entry for the document itself: its place tells its number of words, its
        # print only spreads it.
        itself = F.array(_print(-1 - F.size(w).cast("long"), F.xxhash64(*key)))
        return F.concat(itself, winnowed(w, span, gram), *[whole_prints(w, n) for n in short])

    met = attach(
        docs.select(*key, F.explode(let(words("text"), all_prints)).alias("p")).select(*key, "p.place", "p.print"),
        prints.withColumn("met", F.lit(True)), ["print"],
    )
    seen = stage(met.filter("met or place < 0").select(*key, "place"), "places")
    base = seen.filter("place < 0").select(*key, (-1 - F.col("place")).alias("n_words"))
    places = stage(seen.filter("place >= 0").groupBy(*key).agg(F.collect_set("place").alias("places")), "met")
    # Only documents that meet the benchmark are split into words again.
    read = attach(docs, places, key, "inner", null_safe=True).select(
        *key, let(words("text"), lambda w: _windows_around(w, F.col("places"), span, gram)).alias("windows")
    )

    found = (
        read.select(*key, F.explode("windows").alias("o"))
        .select(*key, "o.place", "o.window", F.pmod("o.place", F.lit(LENGTHS)).cast("int").alias("length")).distinct()
    )
    hits = attach(found, numbered, ["window", "length"], "inner")
    start = F.floor(F.col("place") / LENGTHS)
    spans = F.sort_array(F.collect_list(F.struct(start.alias("start"), (start + F.col("length")).alias("end"))))
    by_document = stage(
        hits.groupBy(*key).agg(spans.alias("spans"), F.sort_array(F.collect_set("number")).alias("numbers"))
        .select(*key, covered("spans").alias("n_hit"), "numbers"), "hits",
    )
    sets = by_document.select("numbers").distinct().select("numbers", F.explode("numbers").alias("number"))
    of_window = attach(members.filter("item_id is not null"), numbered, ["window", "length"], "inner").select("number", "item_id")
    listed = (
        sets.join(of_window, "number").select("numbers", F.col("item_id").cast("string").alias("item")).distinct()
        .groupBy("numbers").agg(F.count(F.lit(1)).alias("n_items"), F.array_join(F.sort_array(F.collect_list("item")), ",").alias("items"))
    )
    known = attach(by_document, stage(listed, "lists"), ["numbers"]).drop("numbers")
    zero = F.lit(0).cast("long")
    return attach(base, known, key, null_safe=True).select(
        "doc_id", "n_words", F.coalesce("n_hit", zero).alias("n_hit"), F.coalesce("n_items", zero).alias("n_items"),
        F.coalesce("items", F.lit("")).alias("items"),
    )


def covered(spans: str) -> Column:
    """How many positions the spans, sorted by start, cover together."""
    begin = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("reach"))

    def add(state: Column, span: Column) -> Column:
        new = F.greatest(span["end"] - F.greatest(span["start"], state["reach"]), F.lit(0).cast("long"))
        return F.struct((state["n"] + new).alias("n"), F.greatest(state["reach"], span["end"]).alias("reach"))

    return F.aggregate(spans, begin, add, lambda s: s["n"])
