"""Helpers shared by the operators: table access, per-process caches, Arrow loops."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from landrecon.session import tune

_CACHE = "_landrecon_worker_cache"


# What one Arrow batch may hold, so that a Python task's memory does not depend on text lengths.
BATCH_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Set what the operators rely on: adaptive execution, as everywhere, and small batches."""
    for key, value in BATCH_SETTINGS.items():
        spark.conf.set(key, value)
    return tune(spark)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text), with NULL text read as empty; all other columns are left out."""
    return docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )


def cached(key: tuple, make: Callable):
    """A value made once per Python process; functions shipped by value have no globals that last."""
    store = sys.modules.setdefault(_CACHE, types.ModuleType(_CACHE)).__dict__
    if key not in store:
        store[key] = make()
    return store[key]


def give_back() -> None:
    """Return freed memory to the system. A Python worker lives on for later tasks and stages, and
    would keep what its largest task needed, beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the GNU C library's
    if trim is not None:
        trim(0)


def batches(rows: Iterator[pa.RecordBatch], fn: Callable[[pa.RecordBatch], pa.RecordBatch]):
    """Apply ``fn`` to every batch that has rows."""
    for batch in rows:
        if batch.num_rows:
            yield fn(batch)
    give_back()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def whole_groups(rows: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """From a partition sorted by integer keys: tables of complete groups, and where each begins."""
    held: list[pa.RecordBatch] = []

    def changes(block: pa.Table) -> np.ndarray:
        new = np.zeros(block.num_rows, dtype=bool)
        new[0] = True
        for key in keys:
            column = block[key].to_numpy()
            new[1:] |= column[1:] != column[:-1]
        return np.flatnonzero(new)

    for batch in rows:
        if not batch.num_rows:
            continue
        held.append(batch)
        first, last = held[0], batch
        if all(first[k][0] == last[k][last.num_rows - 1] for k in keys):
            continue  # still one group
        block = pa.Table.from_batches(held)
        begin = changes(block)
        cut = int(begin[-1])
        yield block.slice(0, cut), begin[:-1]
        held = block.slice(cut).combine_chunks().to_batches()
    if held:
        block = pa.Table.from_batches(held)
        yield block, changes(block)


def nullable(column):
    """A struct column whose fields admit NULL, as declared schemas do."""
    fields = [column.type.field(i).with_nullable(True) for i in range(column.type.num_fields)]
    return column.cast(pa.struct(fields))


def finite(vector: str) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    infinity = F.lit(float("inf"))
    return F.coalesce(F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < infinity)), F.lit(False))


def grid(vector: str, steps: int = 256) -> Column:
    """Components rounded down to whole steps, as long; those beyond its range become its ends."""
    return F.transform(vector, lambda v: F.floor(v.cast("double") * steps))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


# Elements of a block of a running result.
SCAN_BLOCK = 512


def scan(values: Column, join: Callable[[Column, Column], Column], kind: str = "int") -> Column:
    """Running results over an array, of an associative ``join(value, what is before it or NULL)``. Made
    in blocks, then over the blocks' last results, so that no long array grows element by element."""

    def running(some: Column, of: Callable[[Column], Column] = lambda x: x) -> Column:
        none = F.array().cast(f"array<{kind}>")
        return F.aggregate(some, none, lambda acc, x: F.concat(acc, F.array(join(of(x), F.get(acc, F.size(acc) - 1)))))

    def carried(blocks: Column) -> Column:
        return let(
            running(blocks, lambda b: F.element_at(b, -1)),
            lambda ends: F.flatten(F.transform(blocks, lambda b, i: F.transform(b, lambda x: join(x, F.get(ends, i - 1))))),
        )

    def cut(v: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.size(v) - 1) / SCAN_BLOCK).cast("int"))
        return F.transform(starts, lambda b: running(F.slice(v, b * SCAN_BLOCK + 1, SCAN_BLOCK)))

    return let(values, lambda v: F.when(F.size(v) > 0, let(cut(v), carried)).otherwise(v))


def meet_blocks(
    held: DataFrame, asked: DataFrame, blocks: int, build: Callable[[pa.Table], object], answer: Callable, schema: str
) -> DataFrame:
    """What ``answer(built, batch)`` yields for the rows asked, against the held rows of their block.

    Both frames have a column ``block``. A block's held rows come first in its task and are built into
    one thing; the rows asked follow as a stream of any length. Rows asked of a block without held rows
    give nothing.
    """
    both = held.withColumn("kind", F.lit(0)).unionByName(asked.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    dealt = both.repartition(blocks, "block").sortWithinPartitions("block", "kind")

    def run_all(part):
        current, rows, built = None, [], None
        for batch in part:
            if not batch.num_rows:
                continue
            number, kind = batch["block"].to_numpy(), batch["kind"].to_numpy()
            starts = np.flatnonzero(np.r_[True, (number[1:] != number[:-1]) | (kind[1:] != kind[:-1])])
            for lo, hi in zip(starts, np.append(starts[1:], len(number))):
                if number[lo] != current:
                    current, rows, built = number[lo], [], None
                run = batch.slice(lo, hi - lo)
                if kind[lo] == 0:
                    rows.append(run)
                    continue
                if rows:
                    built, rows = build(pa.Table.from_batches(rows)), []
                if built is not None:
                    yield from answer(built, run)
        give_back()

    return dealt.mapInArrow(run_all, schema)
