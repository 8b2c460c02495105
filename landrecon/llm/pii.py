"""Personal data by candidate gradient boosting, in DataFrame functions throughout.

Generators with high recall propose spans of four kinds, which may overlap between kinds. Boosted
trees score each by its format (separators, obfuscation) and its context (the
characters and words around it). There are no labelled spans, so the labels are made: positive are
the base spans and variants of them as people write them (obfuscated emails, cards with dots,
phones without the plus sign), in the context of the span; negative are candidates that cannot be
of their kind however they are written (``_impossible``). Other candidates, which no rule decides,
have no label: they take no part in the fit, and they alone are open to addition. The fit takes all
labelled examples: those with equal features, label and fold are counted and bear their number as a
weight, which gives the trees that the single examples would. Per kind, the threshold is the smallest at
which the precision on examples left out of the fit, all of them too, reaches ``PRECISION``. Base spans always stay;
an open candidate at or over its threshold is added unless it overlaps a base span of its kind.
The check digit, number ranges and digit counts that decide labels are no features, nor is the
length, which tells the digit count. Every IP
address in plain form is a base span, so that kind has no open candidates.

Base rules, leftmost without overlap, are written with possessive quantifiers and guarded starts,
so that they match just what the plain patterns match in time linear in the text and without
recursion. Positions are code points; ends are exclusive.

NULL text is read as empty and has no spans. Repeated rows give one result each. Columns other than
id and text are left out of ``find`` and kept by ``redact``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from landrecon.llm.common import let, scan
from landrecon.session import stage

KINDS = ["email", "ip", "card", "phone"]

BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9]){15,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What every match contains, so that other texts need not be tried.
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:@|\((?:at|AT)\)|\[(?:at|AT)\]) ?"
    r"[A-Za-z0-9-]++(?:(?:\.| ?\((?:dot|DOT)\) ?| ?\[(?:dot|DOT)\] ?)[A-Za-z0-9-]++)*+",
    "ip": r"(?<![0-9.])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])[0-9](?:[\x20.-]?[0-9]){11,}+",
    "phone": r"[+(]?[0-9][\x20().0-9-]{5,}[0-9]",
}
WIDE_NEEDS = {
    "email": r"@|\((?:at|AT)\)|\[(?:at|AT)\]", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20.-]?[0-9]", "phone": r"[0-9][\x20().0-9-]{5}",
}
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
AT = r"\x20?(?:@|\((?:at|AT)\)|\[(?:at|AT)\])\x20?"
DOT = r"\x20?(?:\((?:dot|DOT)\)|\[(?:dot|DOT)\])\x20?"
DATE = r"^\(?(?:19|20)[0-9]{2}[-./\x20](?:0?[1-9]|1[0-2])[-./\x20](?:0?[1-9]|[12][0-9]|3[01])(?![0-9])"
HINTS = r"(?i)\b(?:call|tel|phone|fax|mobile|mail|e-mail|contact|card|visa|pay|ip|host|server|address)\b"
AROUND = 24
# Code points in which a text is cut up to be put together again without its spans.
BLOCK = 1024

PRECISION = 0.99
ROUNDS = 10
DEPTH = 3


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Check digit rule for up to 40 digits; false for more."""
    back = F.reverse(F.substring(digits, 1, 40))

    def value(i: Column) -> Column:
        doubled = F.substring(back, i, F.lit(1)).try_cast("int") * (F.lit(2) - F.pmod(i, F.lit(2)))
        return F.when(doubled > 9, doubled - 9).otherwise(doubled)

    places = F.sequence(F.lit(1), F.greatest(F.length(back), F.lit(1)))
    total = F.aggregate(places, F.lit(0), lambda acc, i: acc + F.coalesce(value(i), F.lit(0)))
    return (F.length(digits) <= 40) & (total % 10 == 0)


def _valid(kind: str, text: Column) -> Column:
    n = F.length(_digits(text))
    if kind == "ip":
        return text.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        return n.between(16, 19) & _luhn(_digits(text))
    if kind == "phone":
        return n.between(8, 15)
    return F.lit(True)


def matches(text: Column, pattern: str, needs: str) -> tuple[Column, Column]:
    """(found, gaps): the matches of a pattern and what lies around them, one piece more."""
    found = F.when(text.rlike(needs), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    return found, F.split(text, pattern, -1)


SPAN = "array<struct<start:int,end:int,text:string,before:string,after:string>>"


def _placed(found: str, gaps: str) -> Column:
    """Matches with their places: (start, end, text, before, after). Places are running sums of the
    lengths of gaps and matches."""

    def place(f: Column, g: Column) -> Column:
        steps = F.transform(f, lambda text, i: F.length(F.get(g, i)) + F.length(text))
        return let(
            scan(steps, lambda x, before: x + F.coalesce(before, F.lit(0))),
            lambda ends: F.transform(
                f,
                lambda text, i: F.struct(
                    (F.get(ends, i) - F.length(text)).alias("start"), F.get(ends, i).alias("end"), text.alias("text"),
                    F.right(F.get(g, i), F.lit(AROUND)).alias("before"), F.left(F.get(g, i + 1), F.lit(AROUND)).alias("after"),
                ),
            ),
        )

    placed = let(F.col(found), lambda f: let(F.col(gaps), lambda g: place(f, g)))
    return F.when(F.size(found) > 0, placed).otherwise(F.array().cast(SPAN))


def _spans(rows: DataFrame, patterns: dict[str, str], needs: dict[str, str], prefix: str) -> DataFrame:
    """Add for each kind an array of its placed matches, named by the prefix."""
    found, gaps = {}, {}
    for kind in KINDS:
        f, _ = matches(F.col("text"), patterns[kind], needs[kind])
        found[f"{prefix}_found_{kind}"] = f
    rows = rows.withColumns(found)
    for kind in KINDS:
        has = F.size(f"{prefix}_found_{kind}") > 0
        gaps[f"{prefix}_gaps_{kind}"] = F.when(has, F.split("text", patterns[kind], -1))
    rows = rows.withColumns(gaps)
    placed = {f"{prefix}_{k}": _placed(f"{prefix}_found_{k}", f"{prefix}_gaps_{k}") for k in KINDS}
    return rows.withColumns(placed).drop(*found, *gaps)


def _impossible(kind: str, text: Column) -> Column:
    """Whether a candidate cannot be of its kind, even if it is an obfuscated or reformatted one."""
    if kind == "email":
        return ~F.regexp_replace(F.regexp_replace(text, AT, "@"), DOT, ".").rlike(
            r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++$"
        )
    if kind == "phone":
        return ~_valid(kind, text) | text.rlike(DATE)
    return ~_valid(kind, text)


def _variants(kind: str, text: Column) -> list[Column]:
    """Other ways to write a base span."""
    if kind == "email":
        halves = F.split(text, "@", 2)
        name, host = F.get(halves, F.lit(0)), F.get(halves, F.lit(1))

        def spelled(at: str, dot: str) -> Column:
            return F.concat(name, F.lit(at), F.regexp_replace(host, r"\.", dot))

        return [spelled(" (at) ", " (dot) "), spelled(" [at] ", " [dot] "), spelled("(at)", "."), spelled(" @ ", "."), spelled("@", "(dot)")]
    if kind == "card":
        groups = F.regexp_replace(_digits(text), "([0-9]{4})(?=[0-9])", "$1#")
        return [F.regexp_replace(groups, "#", "."), F.regexp_replace(text, r"[\x20-]", ".")]
    if kind == "phone":
        local = F.regexp_replace(text, r"^\+(?:[0-9]{1,3}[\x20.-]+)?", "")
        parts = F.regexp_replace(local, r"[\x20().-]+", "#")
        parts = F.regexp_replace(parts, "^#|#$", "")
        return [F.substring(text, 2, 1 << 20), local, F.regexp_replace(parts, "#", "-"), F.regexp_replace(parts, "#", "."), F.regexp_replace(parts, "#", " ")]
    return []


def _features(kind: str, span: Column) -> Column:
    """Numbers on format and context of one candidate; none tells what decides a label."""
    text, before, after = span["text"], span["before"], span["after"]
    last, first = F.right(before, F.lit(1)), F.left(after, F.lit(1))
    flags = [
        *[F.lit(kind == k) for k in KINDS],
        text.startswith("+"), text.startswith("("), text.contains("@"), text.contains(" "), text.contains("-"),
        text.rlike(r"\((?:at|AT)\)|\[(?:at|AT)\]"), text.rlike(DOT), text.rlike(r"[.)\]]\x20?[A-Za-z]{2,}$"),
        last.rlike("[A-Za-z0-9]"), last.rlike(r"[.,/:=_-]"), first.rlike("[A-Za-z0-9]"), first.rlike(r"[./:=_-]"),
        before.rlike(HINTS),
    ]
    # separators among digits; how many parts an email has tells nothing
    counted = [F.length(F.regexp_replace(text, r"[^.]", "")), F.length(F.regexp_replace(text, r"[^\x20()-]", ""))]
    numbers = [F.lit(0)] * len(counted) if kind == "email" else counted
    return F.array(*[F.coalesce(c, F.lit(False)).cast("double") for c in flags], *[c.cast("double") for c in numbers])


def _kept(spans: Column, kind: str) -> Column:
    """Spans as (kind number, start, end)."""
    return F.transform(
        spans,
        lambda s: F.struct(F.lit(KINDS.index(kind)).alias("kind"), s["start"].alias("start"), s["end"].alias("end")),
    )


def equals(value):
    """Condition for array functions: the element is this value."""
    return lambda element: element == value


def _accepts(kind: str):
    return lambda span: _valid(kind, span["text"])


def _written_otherwise(kind: str):
    """Of a base span, the spans that stand for its variants: those that the wide pattern takes whole."""
    whole = rf"^(?:{WIDE[kind]})$"

    def spans(s: Column) -> Column:
        texts = F.filter(F.array_distinct(F.array(*_variants(kind, s["text"]))), lambda t: t.rlike(whole) & (t != s["text"]))
        separate = texts if kind == "email" else F.filter(texts, lambda t: t.rlike(r"[\x20().-]"))
        unlike = F.filter(separate, lambda t: ~_impossible(kind, t))
        return F.transform(
            unlike,
            lambda t: F.struct(
                s["start"].alias("start"), s["end"].alias("end"), t.alias("text"), s["before"].alias("before"), s["after"].alias("after")
            ),
        )

    return spans


def _met(spans: Column, s: Column) -> Column:
    """Of spans in order that do not overlap each other, the first that ends after ``s`` starts, by
    halving; NULL if there is none. It is the only one that can be ``s``, and overlaps ``s`` if any does."""

    def halve(state: Column, _) -> Column:
        middle = F.floor((state["low"] + state["high"]) / 2).cast("int")
        after = (F.get(spans, middle)["end"] > s["start"]) | (state["low"] >= state["high"])
        return F.struct(
            F.when(after, state["low"]).otherwise(middle + 1).alias("low"),
            F.when(after, F.least(middle, state["high"])).otherwise(state["high"]).alias("high"),
        )

    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.size(spans) + 1)).cast("int"))
    begin = F.struct(F.lit(0).alias("low"), F.size(spans).alias("high"))
    return F.when(F.size(spans) > 0, F.get(spans, F.aggregate(rounds, begin, halve, lambda state: state["low"])))


def _candidate(kind: str, base: dict[str, Column]):
    """A candidate with its label: true for a base span, false for an impossible one, else NULL."""

    def describe(s: Column) -> Column:
        hits = F.struct(*[_met(base[k], s).alias(k) for k in KINDS])

        def told(hit: Column) -> Column:
            def overlaps(k: str) -> Column:
                return F.coalesce(hit[k]["start"] < s["end"], F.lit(False))

            same = F.coalesce((hit[kind]["start"] == s["start"]) & (hit[kind]["end"] == s["end"]), F.lit(False))
            # digits of a card or address are no phone, and so on
            other = reduce(lambda a, b: a | b, [overlaps(k) for k in KINDS if k != kind])
            return F.struct(
                F.lit(KINDS.index(kind)).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                F.lit(0).alias("variant"),
                F.when(same, True).when(overlaps(kind), F.lit(None))
                .when(other | _impossible(kind, s["text"]), False).alias("label"),
                overlaps(kind).alias("covered"),
                _features(kind, s).alias("features"),
            )

        return let(hits, told)

    return describe


def _positive(kind: str):
    def describe(s: Column, i: Column) -> Column:
        return F.struct(
            F.lit(KINDS.index(kind)).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
            (i + 1).alias("variant"), F.lit(True).alias("label"), F.lit(True).alias("covered"),
            _features(kind, s).alias("features"),
        )

    return describe


def _scan(rows: DataFrame) -> DataFrame:
    """Per row: ``base`` spans and ``candidates`` with features and label, the variants among them."""
    rows = _spans(_spans(rows, BASE, NEEDS, "base"), WIDE, WIDE_NEEDS, "wide")
    rows = rows.withColumns({f"base_{k}": F.filter(f"base_{k}", _accepts(k)) for k in KINDS})
    varied = [k for k in KINDS if k != "ip"]

    def all_of(base: Column) -> Column:
        """Base spans and candidates of a row, from the base spans of each kind."""
        proposed = [F.transform(f"wide_{k}", _candidate(k, {n: base[n] for n in KINDS})) for k in KINDS]
        proposed += [F.transform(F.flatten(F.transform(base[k], _written_otherwise(k))), _positive(k)) for k in varied]
        return F.struct(F.concat(*[_kept(base[k], k) for k in KINDS]).alias("base"), F.concat(*proposed).alias("candidates"))

    found = rows.withColumn("_all", let(F.struct(*[F.col(f"base_{k}").alias(k) for k in KINDS]), all_of))
    return found.withColumns({"base": F.col("_all.base"), "candidates": F.col("_all.candidates")})


def _fold(frame: DataFrame) -> Column:
    return F.pmod(F.xxhash64("doc_id", "kind", "start", "end"), F.lit(4))


def _fit(candidates: DataFrame):
    """(model, threshold per kind), or None where there are not both classes."""
    labelled = candidates.filter("label IS NOT NULL")
    cells = stage(
        labelled.select("kind", F.col("label").cast("double").alias("label"), "features", (_fold(labelled) == 0).alias("rest"))
        .groupBy("kind", "label", "features", "rest").agg(F.count(F.lit(1)).cast("double").alias("n")),
        "pii-cells",
    ).withColumn("x", array_to_vector("features"))
    learn, rest = cells.filter("NOT rest"), cells.filter("rest")
    classes = learn.agg(F.count_distinct("label")).first()[0]
    if classes < 2:
        return None
    trees = GBTClassifier(featuresCol="x", labelCol="label", weightCol="n", maxIter=ROUNDS, maxDepth=DEPTH, stepSize=0.3, seed=1)
    model = trees.fit(learn)
    scored = model.transform(rest).select("kind", "label", "n", F.floor(vector_to_array("probability")[1] * 100).alias("score"))
    # At most a hundred rows a kind.
    table = scored.groupBy("kind", "score").agg(F.sum(F.col("label") * F.col("n")).alias("good"), F.sum("n").alias("n")).collect()
    thresholds = {}
    for number in range(len(KINDS)):
        own = [r for r in table if r["kind"] == number]
        for level in range(50, 101):
            over = [r for r in own if r["score"] >= level]
            if over and sum(r["good"] for r in over) >= PRECISION * sum(r["n"] for r in over):
                thresholds[number] = level / 100
                break
    return (model, thresholds) if thresholds else None


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """doc_id, base and spans per row, both arrays of (kind number, start, end) in order."""
    carry = carry or []
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        *([F.struct(*carry).alias("_carried")] if carry else []),
    )
    extra = ["_carried"] if carry else []
    scanned = stage(
        _scan(rows).select(F.monotonically_increasing_id().alias("row"), "doc_id", "base", "candidates", *extra), "pii"
    )
    candidates = scanned.select("row", "doc_id", F.explode("candidates").alias("c")).select("row", "doc_id", "c.*")
    fitted = _fit(candidates)
    order = F.array_sort(F.col("base"))
    if fitted is None:
        return scanned.select("doc_id", order.alias("base"), order.alias("spans"), *extra)
    model, thresholds = fitted
    least = reduce(lambda c, k: F.when(F.col("kind") == k, thresholds[k]).otherwise(c), thresholds, F.lit(2.0))
    added = (
        model.transform(candidates.filter("label IS NULL AND NOT covered").withColumn("x", array_to_vector("features")))
        .filter(vector_to_array("probability")[1] >= least)
        .groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("added"))
    )
    every = F.array_sort(F.concat("base", F.coalesce("added", F.array().cast("array<struct<kind:int,start:int,end:int>>"))))
    return scanned.join(added, "row", "left").select("doc_id", order.alias("base"), every.alias("spans"), *extra)


def span_text(spans: str | Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows with every span replaced by the name of its kind in brackets; overlapping spans
    are replaced as one, by the name of the first. NULL text stays NULL."""
    found = find(docs, docs.columns[0], text_col, carry=docs.columns)
    ordered = F.array_sort(
        F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    )
    found = found.withColumn("_in_order", ordered)
    text = F.col(f"_carried.{text_col}")
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def cut(blocks: Column, start: Column, end: Column) -> Column:
        """The text between two places, from its blocks."""
        first = F.floor(start / BLOCK).cast("int")
        some = F.slice(blocks, first + 1, F.floor((end - 1) / BLOCK).cast("int") - first + 1)
        return F.when(end > start, F.substring(F.array_join(some, ""), start - first * BLOCK + 1, end - start)).otherwise("")

    def rewrite(spans: Column, reached: Column, blocks: Column) -> Column:
        """``reached`` has the largest end up to each span."""

        def piece(s: Column, i: Column) -> Column:
            before = F.coalesce(F.get(reached, i - 1), F.lit(0))
            return F.when(s["start"] >= before, F.concat(cut(blocks, before, s["start"]), F.get(names, s["kind"]))).otherwise("")

        rest = cut(blocks, F.element_at(reached, -1), F.length(text))
        return F.concat(F.array_join(F.transform(spans, piece), ""), rest)

    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))
    ends = scan(F.transform("_in_order", lambda s: s["end"]), lambda x, before: F.greatest(x, before))
    written = let(ends, lambda reached: let(blocks, lambda cells: rewrite(F.col("_in_order"), reached, cells)))
    clean = F.when(F.size("_in_order") > 0, written).otherwise(text)
    return found.select(*[clean.alias(c) if c == text_col else F.col(f"_carried.{c}").alias(c) for c in docs.columns])
