"""Near-duplicate vectors by cross-polytope hashing with verified links.

A vector is rotated by three rounds of random signs and fast Hadamard transforms; its hash is the
axis, with sign, that the result lies nearest to. A table's bucket joins ``functions`` such hashes.
Multiprobe adds for each table the bucket in which the least certain hash gives way to its
runner-up. Vectors that share a bucket are compared in double precision.

Exact copies under one label enter once, with their number. A bucket of more than ``BLOCK`` members
is laid out as a grid of blocks against blocks, so no task gets a whole large bucket. Pairs are
counted where they are verified: out of a block come one row per vector with its number of links
there, and a link to the first vector of its group. A pair that meets in several buckets counts in
the first of them only. Rows that move grow with the vectors and not with the pairs.

Vectors that are NULL, zero or hold NULL or non-finite components, and rows with NULL label or id,
link with nothing: no links, their own component, kept. Vectors of different length do not link.
Repeated rows give one result each. An id that stands for several vectors has their links together.
Columns other than id, vector and label are left out.
"""

from __future__ import annotations

from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from landrecon.llm.common import whole_groups
from landrecon.llm.components import components
from landrecon.operators.lookups import attach
from landrecon.session import stage

COSINE = 0.93
TABLES = 10
FUNCTIONS = 2
SEED = 17
BLOCK = 1024


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows; their length is a power of two."""
    n, width = x.shape
    half = 1
    while half < width:
        pair = x.reshape(n, -1, 2, half)
        x = np.stack([pair[:, :, 0] + pair[:, :, 1], pair[:, :, 0] - pair[:, :, 1]], axis=2).reshape(n, width)
        half *= 2
    return x / np.sqrt(width)


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def bucket_keys(x: np.ndarray, tables: int = TABLES, functions: int = FUNCTIONS) -> np.ndarray:
    """Main and probe bucket of every row in every table, as numbers that also tell the table."""
    width = 1 << max(1, int(np.ceil(log2(x.shape[1]))))
    padded = np.zeros((len(x), width))
    padded[:, : x.shape[1]] = x
    draw = np.random.default_rng(SEED)
    keys = []
    for table in range(tables):
        main = np.full(len(x), table, dtype=np.int64)
        gaps, digits = [], []
        for _ in range(functions):
            turned = padded
            for _ in range(3):
                turned = hadamard(turned * draw.choice([-1.0, 1.0], width))
            size = np.abs(turned)
            row = np.arange(len(x))
            top = size.argmax(axis=1)
            best = size[row, top]
            size[row, top] = -1
            second = size.argmax(axis=1)
            gaps.append(best - size[row, second])
            digits.append([2 * axis + (turned[row, axis] < 0) for axis in (top, second)])
        for first, _ in digits:
            main = main * (2 * width) + first
        unsure = np.argmin(gaps, axis=0)
        probe = np.full(len(x), table, dtype=np.int64)
        for f, (first, second) in enumerate(digits):
            probe = probe * (2 * width) + np.where(unsure == f, second, first)
        keys += [main, probe]
    return np.stack(keys, axis=1)


def _matrix(column) -> np.ndarray:
    """A column of lists of one length as a matrix."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def _first_of_group(near: np.ndarray) -> np.ndarray:
    label = np.arange(len(near))
    while True:
        new = np.where(near, label[None, :], len(near)).min(axis=1)
        if (new == label).all():
            return label
        label = new


def _compare(x, keys, size, side, here, cosine):
    """Of one block: links per member, and the first member of its group. Where two blocks meet,
    ``side`` tells which of them each member comes from; in a block by itself it is None."""
    near = x @ x.T >= cosine
    np.fill_diagonal(near, True)
    if side is not None:
        near &= (side[:, None] != side[None, :]) | np.eye(len(x), dtype=bool)
    a, b = np.nonzero(np.triu(near, 1))
    first = np.full(len(a), np.iinfo(np.int64).max)
    for i in range(0, keys.shape[1], 2):  # the buckets of one table against each other
        for j in (i, i + 1):
            for k in (i, i + 1):
                shared = keys[a, j] == keys[b, k]
                first = np.where(shared, np.minimum(first, keys[a, j]), first)
    own = first == here
    links = np.bincount(a[own], size[b[own]], len(x)) + np.bincount(b[own], size[a[own]], len(x))
    return links.astype(np.int64), _first_of_group(near)


def near_vectors(
    table: DataFrame, cosine: float = COSINE, tables: int = TABLES, functions: int = FUNCTIONS, block: int = BLOCK
) -> DataFrame:
    """vec_id, n_links, component_id and kept per row."""
    rows = table.select("vec_id", "embedding", "label")
    infinity = F.lit(float("inf"))
    usable = F.coalesce(
        F.col("label").isNotNull() & F.col("vec_id").isNotNull()
        & F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < infinity))
        & F.exists("embedding", lambda v: v != 0),
        F.lit(False),
    )
    classes = stage(
        rows.filter(usable).groupBy("label", "embedding").agg(F.min("vec_id").alias("cid"), F.count(F.lit(1)).alias("n")),
        "vectors",
    ).withColumn("dim", F.size("embedding"))
    kinds = dict(classes.dtypes)

    def hash_all(part):
        for batch in part:
            dims = batch["dim"].to_numpy()
            for dim in np.unique(dims).tolist():
                own = batch.take(pa.array(np.flatnonzero(dims == dim)))
                keys = bucket_keys(unit(_matrix(own["embedding"]).astype(np.float64)), tables, functions)
                listed = pa.ListArray.from_arrays(np.arange(len(keys) + 1) * keys.shape[1], keys.ravel())
                yield pa.RecordBatch.from_arrays([*own.columns, listed], [*own.schema.names, "keys"])

    fields = ", ".join(f"`{c}` {kinds[c]}" for c in ("cid", "label", "dim", "n", "embedding"))
    hashed = stage(
        classes.select("cid", "label", "dim", "n", "embedding").mapInArrow(hash_all, fields + ", keys array<long>"), "hashes"
    )
    bucket = ["label", "dim", "key"]
    entries = hashed.withColumn("key", F.explode(F.array_distinct("keys")))
    crowded = (
        hashed.select("label", "dim", F.explode(F.array_distinct("keys")).alias("key")).groupBy(*bucket).count()
        .filter(F.col("count") > block).select(*bucket, F.ceil(F.col("count") / block).cast("int").alias("blocks"))
    )
    own = F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")
    cells = (
        attach(entries, crowded, bucket)
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            F.xxhash64("label").alias("group"), "dim", "key",
            F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"),
            F.col("own").alias("side"), "cid", "n", "keys", "embedding", "label",
        )
    )
    place = ["group", "dim", "key", "lo", "hi"]

    def verify(part):
        for block_rows, begin in whole_groups(part, place):
            begin = np.append(begin, block_rows.num_rows)
            cid = block_rows["cid"].to_numpy()
            size = block_rows["n"].to_numpy()
            side = block_rows["side"].to_numpy()
            key = block_rows["key"].to_numpy()
            meet = block_rows["lo"].to_numpy() != block_rows["hi"].to_numpy()
            out = ([], [], [])
            for g in np.flatnonzero(np.diff(begin) > 1):
                lo, hi = int(begin[g]), int(begin[g + 1])
                own_rows = block_rows.slice(lo, hi - lo)
                x = unit(_matrix(own_rows["embedding"]).astype(np.float64))
                half = side[lo:hi] if meet[lo] else None
                links, first = _compare(x, _matrix(own_rows["keys"]), size[lo:hi], half, key[lo], cosine)
                linked = (links > 0) | (first != np.arange(hi - lo))
                out[0].append(cid[lo:hi][linked])
                out[1].append(links[linked])
                out[2].append(cid[lo:hi][first[linked]])
            if out[0]:
                yield pa.RecordBatch.from_pydict(
                    {k: pa.array(np.concatenate(v), pa.int64()) for k, v in zip(("cid", "links", "first"), out)}
                )

    found = stage(
        cells.repartition(*place).sortWithinPartitions(*place).mapInArrow(verify, "cid long, links long, first long"),
        "found",
    )
    linked = found.groupBy("cid").agg(F.sum("links").alias("links"))
    groups = components(found.select("cid", "first"), "cid", "first")
    members = attach(
        attach(classes.select("label", "embedding", "cid", "n"), linked, ["cid"]),
        groups.withColumnRenamed("node", "cid"), ["cid"],
    ).select(
        "label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("component", "cid").alias("component_id"),
    )
    good = attach(rows.filter(usable), members, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    bad = rows.filter(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return good.unionByName(bad).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
