"""Packing of documents into few sequences by bin completion.

What decides a packing is only how many pieces there are of each length, at most ``capacity``
numbers whatever the size of the corpus. The search therefore runs on that histogram: a filling
is found around the largest length left and used as often as its lengths last, so each use
exhausts a length and the plan has at most about ``capacity`` fillings. The pieces, numbered in
order of length, then look up their places in the plan; no piece passes the driver.

Bin completion: around the largest length, enumerate lazily all fillings that no other filling is
found to dominate (a few exact fits and the best fit first, then the others by growing waste), each
as often as its lengths last; if no such plan meets the bound, each also less often. Keep the plan of plain best-fit fillings as
incumbent, and give up a branch as soon as its waste is more than a better plan could have. Only
the budget of ``nodes`` fillings looked at, dominated ones included, ends the search before a plan
meets the lower bound or all are tried; the incumbent is the result then.

NULL text is read as empty and packs as the end id alone. Repeated rows are packed one by one.
Columns other than id and text are left out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from landrecon.llm.common import batches, give_back, texts
from landrecon.llm.word_bpe import word_ids
from landrecon.session import stage
from landrecon.sources.ids import number_rows

CAPACITY = 4096
NODES = 5_000
WIDTH = 3
GROUP = 64


def pieces(
    docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 1,
    id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, if asked for, ids (binary)."""
    rows = texts(docs, id_col, text_col)
    kind = dict(rows.dtypes)["doc_id"]

    def cut(part):
        words = word_ids(tokenizer_path)
        end = np.array([end_id], dtype=np.uint32)

        def run(batch):
            names = ("doc", "piece", "start", "length", "crc", "ids")
            found: dict[str, list] = {n: [] for n in names}
            all_texts = batch["text"].to_pylist()
            for first in range(0, len(all_texts), GROUP):
                for i, ids in enumerate(words.encode_all(all_texts[first : first + GROUP])):
                    whole = np.concatenate([ids, end]).astype("<u4")
                    for n, start in enumerate(range(0, len(whole), capacity)):
                        own = whole[start : start + capacity].tobytes()
                        row = (first + i, n, start, len(own) // 4, zlib.crc32(own), own if with_ids else None)
                        for name, value in zip(names, row):
                            found[name].append(value)
            columns = {
                "doc_id": batch["doc_id"].take(pa.array(found["doc"], pa.int64())),
                "piece": pa.array(found["piece"], pa.int32()),
                "start": pa.array(found["start"], pa.int64()),
                "length": pa.array(found["length"], pa.int64()),
                "ids_crc32": pa.array(found["crc"], pa.int64()),
            }
            if with_ids:
                columns["ids"] = pa.array(found["ids"], pa.binary())
            return pa.RecordBatch.from_pydict(columns)

        yield from batches(part, run)
        words.forget()
        give_back()

    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    return rows.mapInArrow(cut, schema + (", ids binary" if with_ids else ""))


Filling = tuple[tuple[int, int], ...]  # (length, how many of it), largest first


def _filling(lengths: list[int]) -> Filling:
    return tuple((n, lengths.count(n)) for n in sorted(set(lengths), reverse=True))


def _best_fit(left: np.ndarray, capacity: int) -> Filling:
    """The largest length left, then again and again the largest that still fits."""
    room, taken = capacity, []
    lengths = np.flatnonzero(left)[::-1]
    for length in lengths.tolist():
        if length <= room:
            use = min(int(left[length]), room // length)
            taken.append((length, use))
            room -= use * length
    return tuple(taken)


def _likely(left: np.ndarray, capacity: int, width: int) -> list[Filling]:
    """The fillings around the largest length to try first, least waste first.

    A single piece that fills the room exactly dominates every other filling. Otherwise exact
    fits by two and three pieces are taken with their largest piece as large as possible, then
    the best-fit filling, which has the least waste that its largest pieces allow.
    """
    largest = int(np.flatnonzero(left)[-1])
    room = capacity - largest
    rest = left.copy()
    rest[largest] -= 1
    if room == 0:
        return [((largest, 1),)]
    if room < len(rest) and rest[room]:
        return [_filling([largest, room])]
    found: list[list[int]] = []

    def pairs(total: int, most: int, least: int = 1) -> list[list[int]]:
        """Two pieces of ``total`` together, none over ``most``, with the largest first."""
        if total < 2:
            return []
        large = np.arange(min(most, total - 1, len(rest) - 1), (total + 1) // 2 - 1, -1)
        small = total - large
        ok = (rest[large] > 0) & (rest[small] > (large == small)) & (small >= least)
        return [[int(a), total - int(a)] for a in large[ok][:width]]

    found += pairs(room, room)
    if len(found) < width:
        for third in np.flatnonzero(rest[: min(room, len(rest))])[::-1].tolist():
            rest[third] -= 1
            found += [[third, *p] for p in pairs(room - third, third)]
            rest[third] += 1
            if len(found) >= width or third * 3 < room:
                break
    greedy = [n for n, k in _best_fit(rest, room) for _ in range(k)]
    if len(found) < width:  # exact fits that end the best-fit filling with another pair
        for keep in range(len(greedy) - 1, 0, -1):
            head = greedy[:keep]
            for n in head:
                rest[n] -= 1
            tail = pairs(room - sum(head), head[-1])
            for n in head:
                rest[n] += 1
            found += [head + p for p in tail]
            if len(found) >= width:
                break
    fillings = [_filling([largest, *f]) for f in found[:width]] + [_filling([largest, *greedy])]
    return sorted(dict.fromkeys(fillings), key=lambda f: capacity - sum(n * k for n, k in f))


def _every(left: np.ndarray, capacity: int) -> Iterator[list[int]]:
    """What can lie beside the largest length left, by growing waste."""
    largest = int(np.flatnonzero(left)[-1])
    room = capacity - largest
    counts = {n: int(left[n]) - (n == largest) for n in np.flatnonzero(left[: room + 1]).tolist()}
    lengths = [n for n, k in counts.items() if k]
    inside = (1 << (room + 1)) - 1
    sums = [1]  # bit s: the lengths so far have a choice of sum s
    for n in lengths:
        reach, more, step = sums[-1], min(counts[n], room // n), 1
        while more:
            use = min(step, more)
            reach |= (reach << (use * n)) & inside
            more, step = more - use, 2 * step
        sums.append(reach)

    def choose(i: int, total: int) -> Iterator[list[int]]:
        """From the first ``i`` lengths, large ones first."""
        if not total:
            yield []
            return
        while i and sums[i] >> total & 1:
            i -= 1
            for k in range(min(counts[lengths[i]], total // lengths[i]), 0, -1):
                if sums[i] >> (total - k * lengths[i]) & 1:
                    for rest in choose(i, total - k * lengths[i]):
                        yield [lengths[i]] * k + rest

    for total in range(room, -1, -1):
        yield from choose(len(lengths), total)


def _dominated(left: np.ndarray, filling: list[int], capacity: int) -> bool:
    """Whether a single unused piece could stand for some of the pieces but the first, and be no
    smaller; or be added."""
    waste = capacity - sum(filling)
    unused = left.copy()
    for n in filling:
        unused[n] -= 1
    one, several = {0}, set()
    sums = {0}
    for n in filling[1:]:
        several |= {s + n for s in sums if s}
        one.add(n)
        sums |= {s + n for s in sums}
    # in place of one piece, the unused one must be larger
    return any(unused[s : s + waste + 1].any() for s in several) or any(unused[s + 1 : s + waste + 1].any() for s in one)


def _completions(left: np.ndarray, capacity: int, width: int, fewer: bool) -> Iterator[tuple[Filling, int] | None]:
    """Fillings around the largest length left with how often to use them; None for one that is
    passed over. When it is asked for more, ``left`` must be as it was at first."""
    tried = {}
    for filling in _likely(left, capacity, width):
        tried[filling] = _times(left, filling)
        yield filling, tried[filling]
    largest = int(np.flatnonzero(left)[-1])
    exact = any(len(f) <= 2 and sum(k for _, k in f) <= 2 and sum(n * k for n, k in f) == capacity for f in tried)
    if not exact:  # a single piece in the whole room dominates all else
        for beside in _every(left, capacity):
            pieces_of = [largest, *beside]
            filling = _filling(pieces_of)
            if filling in tried or _dominated(left, pieces_of, capacity):
                yield None
                continue
            tried[filling] = _times(left, filling)
            yield filling, tried[filling]
    for filling, most in tried.items():
        for times in range(most - 1 if fewer else 0, 0, -1):
            yield filling, times


def _times(left: np.ndarray, filling: Filling) -> int:
    return min(int(left[n]) // k for n, k in filling)


def plan_packing(
    counts: dict[int, int], capacity: int, nodes: int = NODES, width: int = WIDTH
) -> list[tuple[Filling, int]]:
    """Fillings and how often each is used, for a histogram of lengths."""
    start = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        start[length] = n
    total = int((start * np.arange(capacity + 1)).sum())
    bound = ceil(total / capacity)

    incumbent: list[tuple[Filling, int]] = []
    left = start.copy()
    while left.any():
        filling = _best_fit(left, capacity)
        times = _times(left, filling)
        incumbent.append((filling, times))
        for n, k in filling:
            left[n] -= times * k
    fewest = sum(t for _, t in incumbent)

    for fewer in (False, True):  # whether a filling may be used less often than its lengths last
        left, path, used = start.copy(), [], 0
        open_choices = [_completions(left, capacity, width, fewer)] if left.any() else []
        while open_choices and nodes and fewest > bound:
            choice = next(open_choices[-1], False)
            if choice is False:  # back to the filling before
                open_choices.pop()
                if path:
                    filling, times = path.pop()
                    used -= times
                    for n, k in filling:
                        left[n] += times * k
                continue
            nodes -= 1
            if choice is None:
                continue
            filling, times = choice
            for n, k in filling:
                left[n] -= times * k
            path.append((filling, times))
            used += times
            rest = int((left * np.arange(capacity + 1)).sum())
            if used + ceil(rest / capacity) >= fewest:  # its waste is too much for a better plan
                open_choices.append(iter(()))
            elif rest == 0:
                fewest, incumbent = used, list(path)
                open_choices.append(iter(()))
            else:
                open_choices.append(_completions(left, capacity, width, fewer))
    return incumbent


def runs(plan: list[tuple[Filling, int]], counts: dict[int, int]) -> list[tuple[int, ...]]:
    """Where the numbered pieces go: (length, first number, last number, first sequence, pieces
    of this length per sequence, offset of the first). Pieces are numbered from 1 by length."""
    next_number, at = {}, 1
    for length in sorted(counts):
        next_number[length], at = at, at + counts[length]
    out, sequence = [], 0
    for filling, times in plan:
        offset = 0
        for length, per in filling:
            first = next_number[length]
            next_number[length] = first + times * per
            out.append((length, first, next_number[length] - 1, sequence, per, offset))
            offset += length * per
        sequence += times
    return out


def pack(cut: DataFrame, capacity: int = CAPACITY, nodes: int = NODES) -> DataFrame:
    """The pieces with sequence_id and offset; ``cut`` is read several times and should be a table."""
    spark = cut.sparkSession
    # At most one row per length, so at most ``capacity`` rows.
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    places = runs(plan_packing(counts, capacity, nodes), counts)
    schema = "length long, _from long, _to long, _sequence long, _per long, _offset long"
    lookup = spark.createDataFrame(places, schema)
    keys = ["doc_id", "piece", "start", "length", "ids_crc32"]
    numbered = number_rows(cut.select(keys), ["length", "doc_id", "piece", "start", "ids_crc32"], "_n")
    nth = F.col("_n") - F.col("_from")
    inside = (numbered["length"] == lookup["length"]) & F.col("_n").between(F.col("_from"), F.col("_to"))
    # The lookup has a few rows per length, bounded by the plan and not by the corpus.
    return numbered.join(F.broadcast(lookup), inside).select(
        *[numbered[k] for k in keys],
        (F.col("_sequence") + F.floor(nth / F.col("_per"))).cast("long").alias("sequence_id"),
        (F.col("_offset") + F.pmod(nth, F.col("_per")) * numbered["length"]).cast("long").alias("offset"),
    )


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    return pack(stage(pieces(docs, tokenizer_path, capacity), "pieces"), capacity)
