"""Provenance notes: text columns that record each repair or defect on the row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from landrecon.functions.text import first_chars, pg_concat, strip_non_digits, to_text


def noted(note: str | Column, cond: Column, text: str | Column) -> Column:
    """The note column with ``text`` appended where ``cond`` holds."""
    current = F.col(note) if isinstance(note, str) else note
    added = F.lit(text) if isinstance(text, str) else text
    return F.when(cond, pg_concat(current, added)).otherwise(current)


def noted_all(note: str | Column, entries: list[tuple[Column, str | Column]]) -> Column:
    """The note column with every text appended whose condition holds, in order."""
    current = F.col(note) if isinstance(note, str) else note
    texts = [F.when(cond, F.lit(t) if isinstance(t, str) else t) for cond, t in entries]
    added = F.concat_ws("", *texts)
    return F.when(added != "", pg_concat(current, added)).otherwise(current)


def append_note(df: DataFrame, note: str, cond: Column, text: str | Column) -> DataFrame:
    return df.withColumn(note, noted(note, cond, text))


def amount_note(before: str, amount: Column, after: str) -> Column:
    """Note text around an amount."""
    return F.concat(F.lit(before), to_text(F.abs(amount)), F.lit(after))


def merge_notes(label: str | Column, owner_note: Column, user_note: Column) -> Column:
    """Label, then both sides' notes; a missing note counts as empty."""
    head = F.lit(label) if isinstance(label, str) else label
    return pg_concat(head, owner_note, user_note)


def has_note(note: str, pattern: str) -> Column:
    return F.col(note).like(pattern)


def note_digits_exceed(note: str, repeated: str = "%;%;%", digits: int = 7) -> Column:
    """Whether the note holds several entries and its digits, run together, form a number of
    more than ``digits`` digits that does not begin with 0."""
    numbers = strip_non_digits(F.col(note))
    return (
        F.col(note).like(repeated)
        & (first_chars(numbers, 1) != "0")
        & (F.length(numbers) > digits)
    )


def note_frequency(df: DataFrame, note: str, k: int | None = None) -> DataFrame:
    """Each combination of notes with its count and share of all rows; the k most frequent."""
    counts = df.groupBy(note).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1)).alias("total")).scalar()
    shares = counts.withColumn("percent", F.round(F.col("n") * 100.0 / total, 1))
    if k is None:
        return shares
    return shares.orderBy(F.desc("n"), F.col(note).asc_nulls_first()).limit(k)


# A structured entry beside a note's text: which rule changed which column, from what to what.
CHANGE = "struct<rule:string,column:string,before:decimal(18,2),after:decimal(18,2),amount:decimal(18,2)>"


def change(rule: str, column: str | None = None, before: Column | None = None, after: Column | None = None) -> Column:
    """An entry of a change log; its amount is the absolute difference."""
    none = F.lit(None)
    old, new = none if before is None else before, none if after is None else after
    amount = none if before is None else F.abs(old - new)
    fields = (F.lit(rule), F.lit(column), old, new, amount)
    return F.struct(*[f.alias(n) for f, n in zip(fields, ("rule", "column", "before", "after", "amount"))]).cast(CHANGE)


def logged(log: str, cond: Column, entry: Column) -> Column:
    """The log column with the entry appended where ``cond`` holds."""
    return F.when(cond, F.concat(F.coalesce(log, F.array().cast(f"array<{CHANGE}>")), F.array(entry))).otherwise(F.col(log))


def rendered(log: str, texts: dict[str, str | tuple[str, str]]) -> Column:
    """The note that a log stands for: each entry's text by its rule, or what is written before and after
    its amount; NULL if there is none."""

    def text(entry: Column) -> Column:
        out = F.lit(None).cast("string")
        for rule, words in texts.items():
            whole = F.lit(words) if isinstance(words, str) else amount_note(words[0], entry["amount"], words[1])
            out = F.when(entry["rule"] == rule, whole).otherwise(out)
        return out

    return F.when(F.size(log) > 0, F.concat_ws("", F.transform(log, text)))


def logged_amount(log: str) -> Column:
    """The sum of the amounts of a log; NULL if it has none."""
    amounts = F.filter(F.col(log)["amount"], lambda a: a.isNotNull())
    total = F.aggregate(amounts, F.lit(0).cast("decimal(28,2)"), lambda a, b: (a + b).cast("decimal(28,2)"))
    return F.when(F.size(amounts) > 0, total)
