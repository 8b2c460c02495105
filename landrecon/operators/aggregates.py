"""Group aggregates. Copies are counted before anything is collected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from landrecon.functions.numbers import percent
from landrecon.functions.rings import area_hectares
from landrecon.functions.text import pg_concat
from landrecon.operators.lookups import attach
from landrecon.session import stage
from landrecon.sources.ids import number_rows


def group_agg(
    df: DataFrame, keys: list[str], aggs: dict[str, Column], having: Column | None = None
) -> DataFrame:
    out = df.groupBy(*keys).agg(*[agg.alias(name) for name, agg in aggs.items()])
    return out if having is None else out.filter(having)


def distinct_per_group(df: DataFrame, keys: list[str], col: str, name: str = "n_distinct") -> DataFrame:
    return df.groupBy(*keys).agg(F.countDistinct(col).alias(name))


def group_spread(df: DataFrame, keys: list[str], col: str) -> DataFrame:
    out = df.groupBy(*keys).agg(F.max(col).alias("max_value"), F.min(col).alias("min_value"))
    return out.withColumn("spread", F.col("max_value") - F.col("min_value"))


def value_copies(df: DataFrame, keys: list[str], col: str, name: str = "copies") -> DataFrame:
    """The known values of each group as rows, with the number of their copies.

    This stands for the sorted list of a group's values, as text or array: the list is the rows in
    order, each as often as it has copies, and no task has to build it.
    """
    known = df.filter(F.col(col).isNotNull())
    return known.groupBy(*keys, col).agg(F.count(F.lit(1)).alias(name))


def ordered_chunks(
    df: DataFrame, keys: list[str], value: str, order_by: list[str], size: int = 10_000, chunk: str = "chunk", name: str = "values"
) -> DataFrame:
    """The known values of each group in order, as lists of at most ``size`` numbered from 0: the group's
    list is its chunks one after the other, and no task has to build more than one of them.

    ``order_by`` should tell a group's rows apart up to equal values. A value's place is its place among
    all rows less that of its group's first row; all rows are numbered by range partitions.
    """
    columns = list(dict.fromkeys([*keys, *order_by, value]))
    known = df.filter(F.col(value).isNotNull()).select(*columns)
    numbered = stage(number_rows(known, columns, "_place"), "numbered")
    first = numbered.groupBy(*keys).agg(F.min("_place").alias("_first"))
    placed = attach(numbered, first, keys, null_safe=True).withColumn(chunk, F.floor((F.col("_place") - F.col("_first")) / size))
    listed = F.sort_array(F.collect_list(F.struct("_place", value)))
    return placed.groupBy(*keys, chunk).agg(listed.getField(value).alias(name))


def text_chunks(df: DataFrame, keys: list[str], value: str, order_by: list[str], separator: str, **options) -> DataFrame:
    """The same as text: a group's text is its chunks' texts with the separator between them."""
    name = options.get("name", "values")
    listed = ordered_chunks(df.withColumn(value, F.col(value).cast("string")), keys, value, order_by, **options)
    return listed.withColumn(name, F.array_join(name, separator))


def distinct_values(df: DataFrame, keys: list[str], col: str) -> DataFrame:
    """The distinct known values of each group, as rows."""
    return df.filter(F.col(col).isNotNull()).select(*keys, col).distinct()


def distinct_elements(df: DataFrame, keys: list[str], col: str, name: str) -> DataFrame:
    """The distinct elements of all arrays of a group, as rows."""
    return distinct_values(df.select(*keys, F.explode(col).alias(name)), keys, name)


def sum_if(cond: Column) -> Column:
    """Number of rows that meet the condition; NULL, not 0, if there are none."""
    return F.sum(F.when(cond, 1))


def total(df: DataFrame, col: str, name: str = "total") -> DataFrame:
    return df.agg(F.sum(col).alias(name))


def pct(df: DataFrame, keys: list[str], part: str, whole: str, name: str = "percent") -> DataFrame:
    """Sum over sum per group, as a percentage."""
    return df.groupBy(*keys).agg(percent(F.sum(part), F.sum(whole)).alias(name))


def bucket_count(df: DataFrame, bucket: Column, name: str = "bucket") -> DataFrame:
    return df.groupBy(bucket.alias(name)).agg(F.count(F.lit(1)).alias("n"))


def dup_codes(df: DataFrame, keys: list[str], code: str, measure: str) -> DataFrame:
    """Groups in which a code occurs more than once.

    Codes are counted per group first, so that the distinct count needs no extra expansion.
    """
    cells = df.groupBy(*keys, code).agg(
        F.count(code).alias("_n"), F.sum(measure).alias("_m")
    )
    out = cells.groupBy(*keys).agg(
        F.count(code).alias("n_distinct"),
        F.sum("_n").alias("n_codes"),
        F.sum("_m").alias("total"),
    )
    return out.filter(F.col("n_distinct") != F.col("n_codes"))


def multi_value(df: DataFrame, keys: list[str], within: list[str], col: str) -> DataFrame:
    """Keys with several distinct (within, value) combinations."""
    distinct = df.select(*keys, *within, col).distinct()
    return distinct.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def any_flag(df: DataFrame, keys: list[str], cond: Column) -> DataFrame:
    """Keys of the groups that hold at least one row meeting the condition."""
    return df.filter(cond).select(*keys).distinct()


def holding_area(shapes: DataFrame, keys: list[str], ring: str = "ring", name: str = "digi_area") -> DataFrame:
    """Area per holding in hectares: the plain sum over its polygons."""
    return shapes.groupBy(*keys).agg(F.sum(area_hectares(F.col(ring))).alias(name))


def claim_balance(
    df: DataFrame, keys: list[str], cap: str, claim: str, over: bool = True
) -> DataFrame:
    """Groups that claim more (or less) than their cap, with the difference."""
    sums = df.groupBy(*keys, cap).agg(F.sum(claim).alias("total_claim"))
    diff = F.col("total_claim") - F.col(cap)
    kept = sums.filter(diff > 0 if over else diff < 0)
    return kept.withColumn("diff", F.abs(diff))


def consolidate(
    df: DataFrame, keys: list[str], sums: list[str], row_id: str, note: str, text: str,
    constants: dict[str, str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Merge the rows that agree on the keys; measures are summed, a note is added.

    A row with a NULL key is never merged. Columns that are neither keys, sums nor constants
    must agree as well. A merged row bears the smallest id of its members and their number,
    ``n_members``. The second frame has the membership as rows: (``row_id``, ``member_id``) of
    every member of a merged row, grouped by just the same columns.
    """
    constants = constants or {}
    carried = [c for c in df.columns if c not in {*keys, *sums, row_id, *constants}]
    group = [*keys, *carried]
    complete = F.lit(True)
    for k in keys:
        complete = complete & F.col(k).isNotNull()
    keyed = df.filter(complete)
    merged = keyed.groupBy(*group).agg(
        *[F.sum(c).cast(df.schema[c].dataType).alias(c) for c in sums],
        *[F.max(c).alias(c) for c in constants],
        F.min(row_id).alias(row_id),
        F.count(F.lit(1)).alias("n_members"),
    )
    many = F.col("n_members") > 1
    firsts = merged.filter(many).select(*group, F.col(row_id).alias("_first"))
    members = attach(keyed.select(*group, row_id), firsts, group, how="inner", null_safe=True).select(
        F.col("_first").alias(row_id), F.col(row_id).alias("member_id")
    )
    out = merged.withColumns(
        {
            note: F.when(many, pg_concat(F.col(note), F.lit(text))).otherwise(F.col(note)),
            **{c: F.when(many, F.lit(v)).otherwise(F.col(c)) for c, v in constants.items()},
        }
    ).select(*df.columns, "n_members")
    alone = df.filter(~complete).withColumn("n_members", F.lit(1).cast("bigint"))
    return out.unionByName(alone), members
