"""Hard negatives by angular triangle filtering.

Vectors are integers, a pair's score is their inner product. Every row stores its norm and its angles
to a few reference directions. By the triangle inequality two such angles bound the angle of a pair
from below and above, hence its cosine, and times both norms its score. The bounds are widened by more
than any rounding of angles, cosines and norms can amount to, so no pair is lost; only pairs whose
bounds overlap what is looked for are scored, in exact integers.

Rows are numbered by length, label, nearest direction and the angle to it, and cut into blocks of equal
size, so neither a frequent label nor a frequent vector makes a large task. Runs of blocks have bounds
of their own: an anchor travels only to the runs it can find something in, the rows to one task each.
A task holds one block and reads the anchors as a stream. Two searches are made: the positives of every
anchor (a row is scored if its upper bound reaches the n-th best lower bound), then, with the windows
these open, the negatives. Either gives at most the asked number per anchor and block.

Rows that are equal but for their ids enter with their smallest ids only, as many as can be among the
first of any answer. The directions are fitted on at most ``SAMPLE`` rows; any choice gives the same
result. Rows with NULL id, label or vector, or with a NULL component, take no part; repeated rows count
once. Vectors of different length do not meet. An anchor id that stands for several vectors is several
anchors. Other columns are left out. Scores must fit in 64 bits; beyond 2**53 they are added up as
Python integers.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from landrecon.llm.common import give_back, meet_blocks, partitions
from landrecon.session import stage
from landrecon.sources.ids import number_rows

DIRECTIONS = 16
SAMPLE = 4096
ROUNDS = 6
# Rows of a block, at least and at most, and the number of runs of blocks with bounds of their own.
LEAST, MOST = 1024, 1 << 16
RUNS = 4096
# More than the error of an angle from a double-precision arc cosine, which is below 1e-7 rad.
SLACK = 1e-6
CELLS = 1 << 20


def _matrix(column, dtype) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(len(flat), -1)


def directions(x: np.ndarray, count: int = DIRECTIONS, rounds: int = ROUNDS) -> np.ndarray:
    """Unit reference directions: the row sum's, then the farthest rows one by one, moved to the
    means of the rows nearest to them."""
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    x = (x / np.where(norm > 0, norm, 1))[norm[:, 0] > 0]
    count = min(count, len(x))
    if not count:
        return np.zeros((0, x.shape[1]))
    chosen = [int(np.argmax(x @ x.sum(axis=0)))]
    nearest = x @ x[chosen[0]]
    while len(chosen) < count:
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, x @ x[chosen[-1]])
    found = x[chosen]
    for _ in range(rounds):
        own = np.argmax(x @ found.T, axis=1)
        for i in range(count):
            total = x[own == i].sum(axis=0)
            size = np.linalg.norm(total)
            if size > 0:
                found[i] = total / size
    return found


def angles_to(x: np.ndarray, refs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms, and angles to the directions; a zero vector has right angles."""
    x = x.astype(np.float64)
    norm = np.sqrt((x * x).sum(axis=1))
    cosine = (x @ refs.T) / np.where(norm > 0, norm, 1)[:, None]
    return norm, np.arccos(np.clip(cosine, -1, 1))


def _scores(size, nearest, farthest):
    """Score bounds from the product of the norms (a pair of bounds of it) and bounds of the angle."""
    least, most = size
    upper = np.cos(np.clip(nearest - 2 * SLACK, 0, np.pi))
    lower = np.cos(np.clip(farthest + 2 * SLACK, 0, np.pi))
    room = most * 1e-9 + 1
    return lower * np.where(lower > 0, least, most) - room, upper * np.where(upper > 0, most, least) + room


def pair_bounds(norm_a, angle_a, norm_x, angle_x):
    """Bounds of the scores of every row of ``a`` with every row of ``x``."""
    nearest = np.zeros((len(norm_a), len(norm_x)))
    farthest = np.full(nearest.shape, np.pi)
    for i in range(angle_a.shape[1]):
        a, x = angle_a[:, i, None], angle_x[None, :, i]
        np.maximum(nearest, np.abs(a - x), out=nearest)
        total = a + x
        np.minimum(farthest, np.minimum(total, 2 * np.pi - total), out=farthest)
    size = norm_a[:, None] * norm_x[None, :]
    return _scores((size, size), nearest, farthest)


def run_bounds(norm_a, angle_a, norms, least, most):
    """The same against runs of rows, of which norms and angles are known to lie in intervals."""
    nearest = np.zeros((len(norm_a), len(least)))
    farthest = np.full(nearest.shape, np.pi)
    for i in range(angle_a.shape[1]):
        a, lo, hi = angle_a[:, i, None], least[None, :, i], most[None, :, i]
        np.maximum(nearest, np.maximum(lo - a, a - hi), out=nearest)
        ends = [np.minimum(a + end, 2 * np.pi - a - end) for end in (lo, hi)]
        top = np.where((a + lo <= np.pi) & (a + hi >= np.pi), np.pi, np.maximum(*ends))
        np.minimum(farthest, top, out=farthest)
    return _scores((norm_a[:, None] * norms[None, :, 0], norm_a[:, None] * norms[None, :, 1]), nearest, farthest)


def exact_scores(a: np.ndarray, x: np.ndarray, largest: float) -> np.ndarray:
    """Inner products of integer rows. No partial sum is above the product of the norms, so doubles
    are exact below 2**53."""
    if largest < 2**52:
        return (a.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    return (a.astype(object) @ x.astype(object).T).astype(np.int64)


class _Block:
    """The rows of a block, by length."""

    def __init__(self, rows: pa.Table):
        dims = rows["dim"].to_numpy()
        self.by_dim = {}
        for dim in np.unique(dims).tolist():
            own = rows.take(pa.array(np.flatnonzero(dims == dim)))
            self.by_dim[dim] = (
                own["id"].to_numpy(), own["label"].to_numpy(), _matrix(own["x"], np.int64),
                own["norm"].to_numpy(), _matrix(own["angles"], np.float64),
            )


def _groups(block: _Block, anchors: pa.RecordBatch):
    """Anchors of one length, few enough for a matrix against the block's rows of that length."""
    dims = anchors["dim"].to_numpy()
    for dim in np.unique(dims).tolist():
        if dim not in block.by_dim:
            continue
        rows = block.by_dim[dim]
        own = np.flatnonzero(dims == dim)
        step = max(1, CELLS // max(1, len(rows[0])))
        for at in range(0, len(own), step):
            yield rows, anchors.take(pa.array(own[at : at + step]))


def _table(parts: list[tuple], names: list[str]):
    if parts:
        yield pa.RecordBatch.from_pydict({n: pa.array(np.concatenate(v), pa.int64()) for n, v in zip(names, zip(*parts))})


def _positives(count: int):
    """Of one label, the first ``count`` rows of a block by score, then id."""

    def answer(block, anchors):
        out = []
        for (ids, labels, x, norm, angles), own in _groups(block, anchors):
            a, a_norm, a_angles = _matrix(own["x"], np.int64), own["norm"].to_numpy(), _matrix(own["angles"], np.float64)
            open_ = own["label"].to_numpy(zero_copy_only=False)[:, None] == labels[None, :]
            itself = (own["id"].to_numpy()[:, None] == ids[None, :]) & open_
            for g, i in zip(*np.nonzero(itself)):
                if (a[g] == x[i]).all():
                    open_[g, i] = False
            lower, upper = pair_bounds(a_norm, a_angles, norm, angles)
            if len(ids) > count:
                reach = np.partition(np.where(open_, lower, -np.inf), len(ids) - count, axis=1)[:, len(ids) - count]
                open_ &= upper >= reach[:, None]
            some = np.flatnonzero(open_.any(axis=0))
            score = exact_scores(a, x[some], a_norm.max() * norm.max())
            for g, aid in enumerate(own["aid"].to_numpy()):
                near = np.flatnonzero(open_[g, some])
                best = near[np.lexsort((ids[some[near]], -score[g, near]))[:count]]
                out.append((np.full(len(best), aid), ids[some[best]], score[g, best]))
        yield from _table(out, ["aid", "id", "score"])

    return answer


def _negatives(count: int, low: int, high: int, base: int):
    """Of other labels, the first ``count`` rows of a block within each positive's window."""

    def answer(block, anchors):
        out = []
        for (ids, labels, x, norm, angles), own in _groups(block, anchors):
            a, a_norm, a_angles = _matrix(own["x"], np.int64), own["norm"].to_numpy(), _matrix(own["angles"], np.float64)
            windows = [window_list(scores, low, high, base) for scores in own["positives"].to_pylist()]
            open_ = own["label"].to_numpy(zero_copy_only=False)[:, None] != labels[None, :]
            lower, upper = pair_bounds(a_norm, a_angles, norm, angles)
            overlap = np.zeros(open_.shape, dtype=bool)
            for g, own_windows in enumerate(windows):
                for _, lo, hi in own_windows:
                    overlap[g] |= (upper[g] >= lo) & (lower[g] <= hi)
            open_ &= overlap
            some = np.flatnonzero(open_.any(axis=0))
            score = exact_scores(a, x[some], a_norm.max() * norm.max())
            for g, aid in enumerate(own["aid"].to_numpy()):
                near = np.flatnonzero(open_[g, some])
                near = near[np.lexsort((ids[some[near]], -score[g, near]))]
                own_score = score[g, near]
                for slot, lo, hi in windows[g]:
                    best = near[np.searchsorted(-own_score, -hi) : np.searchsorted(-own_score, -lo, side="right")][:count]
                    out.append((np.full(len(best), aid), np.full(len(best), slot), ids[some[best]], score[g, best]))
        yield from _table(out, ["aid", "slot", "id", "score"])

    return answer


def window_list(scores: list[int], low: int, high: int, base: int) -> list[tuple[int, int, int]]:
    """(slot, least, greatest) score with low * p <= base * score <= high * p, where there is one."""
    found = [(slot, -(-low * p // base), high * p // base) for slot, p in enumerate(scores)]
    return [w for w in found if w[1] <= w[2]]


def mine(
    table: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 10,
    low: int = 30, high: int = 90, base: int = 100, least: int = LEAST, most: int = MOST,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    Both frames have id (long), label (long) and x (array of long); the anchors are rows of the table.
    """
    spark = table.sparkSession

    def usable(df: DataFrame) -> DataFrame:
        whole = F.col("id").isNotNull() & F.col("label").isNotNull() & F.forall("x", lambda v: v.isNotNull())
        known = df.select("id", F.col("label").cast("long").alias("label"), F.col("x").cast("array<bigint>").alias("x"))
        return known.filter(F.coalesce(whole, F.lit(False))).distinct()

    # The limit is applied in every map task before equal vectors meet.
    copies = Window.partitionBy("label", "x").orderBy("id")
    rows = stage(
        usable(table).withColumn("_n", F.row_number().over(copies))
        .filter(F.col("_n") <= max(negatives, positives + 1)).drop("_n"), "rows",
    )
    sample: dict[int, list] = {}
    for r in rows.select("x").orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect():
        sample.setdefault(len(r.x), []).append(r.x)
    refs = {dim: directions(np.array(x, dtype=np.float64)) for dim, x in sample.items() if dim}

    def measure(part):
        for batch in part:
            x = batch["x"]
            dims = np.diff(x.offsets.to_numpy())
            for dim in np.unique(dims).tolist():
                own = batch.take(pa.array(np.flatnonzero(dims == dim)))
                values = _matrix(own["x"], np.int64) if dim else np.zeros((own.num_rows, 0), dtype=np.int64)
                norm, angle = angles_to(values, refs.get(dim, np.zeros((0, dim))))
                padded = np.full((len(norm), DIRECTIONS), np.pi / 2)
                padded[:, : angle.shape[1]] = angle
                if angle.shape[1] < DIRECTIONS and angle.shape[1]:
                    padded[:, angle.shape[1] :] = angle[:, :1]
                cell = padded.argmin(axis=1)
                listed = pa.ListArray.from_arrays(np.arange(len(norm) + 1) * DIRECTIONS, padded.ravel())
                near = padded[np.arange(len(norm)), cell]
                arrays = [*own.columns, pa.array(np.full(len(norm), dim), pa.int32()), pa.array(norm), listed, pa.array(cell, pa.int32()), pa.array(near)]
                yield pa.RecordBatch.from_arrays(arrays, [*own.schema.names, "dim", "norm", "angles", "cell", "near"])
        give_back()

    measured_schema = "id long, label long, x array<bigint>, dim int, norm double, angles array<double>, cell int, near double"
    order = ["dim", "label", "cell", "near", "id", "x"]
    numbered = stage(number_rows(rows.mapInArrow(measure, measured_schema), order, "number"), "numbered")
    n = numbered.count()
    size = min(most, max(least, -(-n // (2 * partitions(spark)))))
    blocks = max(1, -(-n // size))
    step = -(-blocks // RUNS)
    indexed = numbered.withColumn("block", F.floor((F.col("number") - 1) / size).cast("int"))

    # At most RUNS rows, and one more for each change of length within a run.
    angle = [F.col("angles")[i] for i in range(DIRECTIONS)]
    runs = (
        indexed.groupBy((F.col("block") / step).cast("int").alias("run"), "dim")
        .agg(
            F.min("label").alias("first"), F.max("label").alias("last"), F.min("norm").alias("least"), F.max("norm").alias("most"),
            F.array(*[F.min(a) for a in angle]).alias("lo"), F.array(*[F.max(a) for a in angle]).alias("hi"),
        )
        .collect()
    )
    run = {k: np.array([r[k] for r in runs]) for k in ("run", "dim", "first", "last")}
    norms = np.array([(r.least, r.most) for r in runs]).reshape(-1, 2)
    lo, hi = (np.array([r[k] for r in runs]).reshape(-1, DIRECTIONS) for k in ("lo", "hi"))

    asked_columns = ["aid", "id", "label", "x", "dim", "norm", "angles"]
    asked = stage(
        number_rows(usable(anchors).mapInArrow(measure, measured_schema), order, "aid").select(*asked_columns), "anchors"
    )

    def visit(windows: bool):
        def choose(part):
            for batch in part:
                if not batch.num_rows:
                    continue
                label, dim = batch["label"].to_numpy(), batch["dim"].to_numpy()
                go = dim[:, None] == run["dim"][None, :]
                same = (label[:, None] >= run["first"][None, :]) & (label[:, None] <= run["last"][None, :])
                if windows:
                    lower, upper = run_bounds(batch["norm"].to_numpy(), _matrix(batch["angles"], np.float64), norms, lo, hi)
                    overlap = np.zeros(go.shape, dtype=bool)
                    for g, scores in enumerate(batch["positives"].to_pylist()):
                        for _, least_score, greatest in window_list(scores, low, high, base):
                            overlap[g] |= (upper[g] >= least_score) & (lower[g] <= greatest)
                    only = (run["first"] == run["last"])[None, :] & same  # nothing of another label there
                    go &= overlap & ~only
                else:
                    go &= same
                lists = [np.unique(run["run"][g]) for g in go]
                offsets = np.append(0, np.cumsum([len(v) for v in lists]))
                flat = np.concatenate(lists) if len(lists) else np.zeros(0)
                visits = pa.ListArray.from_arrays(offsets.astype(np.int32), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([*batch.columns, visits], [*batch.schema.names, "visits"])

        return choose

    def meet(anchors: DataFrame, windows: bool, answer, schema: str) -> DataFrame:
        """Send the anchors to the blocks they can find something in, and search there."""
        kinds = ", ".join(f"{c} {k}" for c, k in anchors.dtypes)
        sent = (
            anchors.mapInArrow(visit(windows), f"{kinds}, visits array<int>")
            .withColumn("run", F.explode("visits"))
            .withColumn("block", F.explode(F.sequence(F.col("run") * step, F.least((F.col("run") + 1) * step, F.lit(blocks)) - 1)))
            .drop("visits", "run")
        )
        held = indexed.select("id", "label", "x", "dim", "norm", "angles", "block")
        return meet_blocks(held, sent, blocks, _Block, answer, schema)

    first = Window.partitionBy("aid").orderBy(F.col("score").desc(), "id")
    best = (
        meet(asked, False, _positives(positives), "aid long, id long, score long")
        .withColumn("slot", F.row_number().over(first) - 1).filter(F.col("slot") < positives)
    )
    best = stage(best, "positives")
    listed = best.groupBy("aid").agg(F.transform(F.array_sort(F.collect_list(F.struct("slot", "score"))), lambda s: s["score"]).alias("positives"))
    opened = stage(asked.join(listed, "aid").select(*asked_columns, "positives"), "windows")
    found = meet(opened, True, _negatives(negatives, low, high, base), "aid long, slot long, id long, score long")
    order_by = Window.partitionBy("aid", "slot").orderBy(F.col("score").desc(), "id")
    ranked = found.withColumn("rank", F.row_number().over(order_by)).filter(F.col("rank") <= negatives)
    named = ranked.select("aid", "slot", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    given = [
        asked.select("aid", F.col("id").alias("anchor_id")),
        best.select("aid", F.col("slot").cast("long").alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")),
    ]
    joined = reduce(lambda df, other: df.join(other, [c for c in ("aid", "slot") if c in other.columns]), given, named)
    return joined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
