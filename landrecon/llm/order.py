"""Materialisation of token sequences in training order.

Documents are encoded and cut into sequences of a fixed number of ids, the last one padded, and
stored once. The stored sequences are numbered densely: a task's first number is the count of the
sequences of the tasks before it. A keyed Feistel permutation of the numbers, with cycle-walking to
stay within them, gives each sequence its global slot: a shuffled order without a sort, which can
be computed and inverted anywhere from the key. Ranges of slots are the shards; ids travel once,
to the range of shards that theirs is in, and are written there, one file per shard, in order of
slot. Every record has the same stride, so slot, shard and record number follow from each
other, and a reader starts or resumes at any slot (``read_from``).

Ids are unsigned and little-endian, of ``width`` bytes; padding is the end id. NULL text is read as
empty and gives one sequence, the end id. Repeated rows give sequences of their own. Columns other
than id and text are left out.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.functions import pandas_udf

from landrecon.llm.common import texts
from landrecon.session import new_path

LENGTH = 512
SHARD = 2048
ROUNDS = 6


def _scramble(x: np.ndarray, key: int) -> np.ndarray:
    h = x ^ np.uint64(key)
    for _ in range(2):
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Permutation:
    """A keyed bijection of the numbers below n."""

    def __init__(self, n: int, key: int, rounds: int = ROUNDS):
        self.n = n
        self.half = max(1, ((n - 1).bit_length() + 1) // 2) if n > 1 else 1
        self.keys = np.random.default_rng(key).integers(1, 1 << 63, rounds).tolist()

    def _pass(self, x: np.ndarray, back: bool) -> np.ndarray:
        half, mask = np.uint64(self.half), np.uint64((1 << self.half) - 1)
        left, right = x >> half, x & mask
        for key in reversed(self.keys) if back else self.keys:
            if back:
                left, right = right ^ (_scramble(left, key) & mask), left
            else:
                left, right = right, left ^ (_scramble(right, key) & mask)
        return left << half | right

    def _walk(self, x, back: bool) -> np.ndarray:
        out = np.asarray(x, dtype=np.uint64).copy()
        outside = np.arange(len(out))
        while len(outside):  # a number that falls outside goes round again
            out[outside] = self._pass(out[outside], back)
            outside = outside[out[outside] >= self.n]
        return out.astype(np.int64)

    def slot(self, number) -> np.ndarray:
        return self._walk(number, False)

    def number(self, slot) -> np.ndarray:
        return self._walk(slot, True)


def sequences(
    docs: DataFrame, encoder: Callable[[], Callable[[str], list[int]]], end_id: int, width: int = 2,
    length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """part, nth, doc_id, piece, n_ids and ids (binary) per sequence, stored in the shared folder.

    ``encoder`` is called in each task and returns the function from a text to its ids."""
    rows = texts(docs, id_col, text_col)
    kind = dict(rows.dtypes)["doc_id"]

    def cut(part):
        encode = encoder()
        stride = length * width
        fill = np.array([end_id], dtype=f"<u{width}").tobytes()
        number, count = TaskContext.get().partitionId(), 0
        for batch in part:
            doc, piece, used, ids = [], [], [], []
            for i, text in enumerate(batch["text"].to_pylist()):
                data = np.append(np.asarray(encode(text), dtype=np.int64), end_id).astype(f"<u{width}").tobytes()
                for n, at in enumerate(range(0, len(data), stride)):
                    record = data[at : at + stride]
                    doc.append(i)
                    piece.append(n)
                    used.append(len(record) // width)
                    ids.append(record + fill * (length - len(record) // width))
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([number] * len(doc), pa.int32()), "nth": pa.array(range(count, count + len(doc)), pa.int64()),
                    "doc_id": batch["doc_id"].take(pa.array(doc, pa.int64())), "piece": pa.array(piece, pa.int32()),
                    "n_ids": pa.array(used, pa.int32()), "ids": pa.array(ids, pa.binary()),
                }
            )
            count += len(doc)

    schema = f"part int, nth long, doc_id {kind}, piece int, n_ids int, ids binary"
    path = new_path(docs.sparkSession, "sequences")
    rows.mapInArrow(cut, schema).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(schema).parquet(path)


def slot_column(number: Column, n: int, key: int) -> Column:
    @pandas_udf("long")
    def slot(numbers: pd.Series) -> pd.Series:
        return pd.Series(Permutation(n, key).slot(numbers.to_numpy()))

    return slot(number)


def in_training_order(stored: DataFrame, key: int, shard: int = SHARD) -> DataFrame:
    """slot, shard, record, doc_id, piece, n_ids and ids, each shard in one partition and in order."""
    sizes = sorted(map(tuple, stored.groupBy("part").count().collect()))  # one row per task that wrote
    firsts, total = [], 0
    for part, n in sizes:
        firsts.append((part, total))
        total += n
    first = stored.sparkSession.createDataFrame(firsts, "part int, first long")
    numbered = stored.join(F.broadcast(first), "part").withColumn("slot", slot_column(F.col("first") + F.col("nth"), total, key))
    return (
        numbered.select(
            "slot", F.floor(F.col("slot") / shard).alias("shard"), F.pmod("slot", F.lit(shard)).cast("int").alias("record"),
            "doc_id", "piece", "n_ids", "ids",
        )
        .repartitionByRange("shard").sortWithinPartitions("shard", "slot")
    )


def write_shards(ordered: DataFrame, path: str) -> None:
    """One folder per shard, with one file in order of slot. A repeated call after an interruption
    writes the same records again."""
    ordered.write.mode("overwrite").option("compression", "zstd").partitionBy("shard").parquet(path)


def materialised(ordered: DataFrame) -> DataFrame:
    """The records read back from shards written into the shared folder, each file in order."""
    path = new_path(ordered.sparkSession, "shards")
    write_shards(ordered, path)
    return ordered.sparkSession.read.schema(ordered.schema).parquet(path).select(ordered.columns)


def read_from(spark: SparkSession, path: str, slot: int = 0, shard: int = SHARD) -> DataFrame:
    """The written records from a slot on; earlier shards are not opened."""
    kept = spark.read.parquet(path).filter((F.col("shard") >= slot // shard) & (F.col("slot") >= slot))
    return kept.sort("slot")
