"""Removal of byte strings that also start in an earlier document, by blockwise suffix sorting.

Every suffix matters only through its first ``length`` bytes. Suffixes are dealt to buckets by a
fingerprint, each bucket is sorted by itself, and memory is bounded by a block of texts or by one
bucket. What would fill the buckets are long ties: copies share nearly all their suffixes. They are
settled by the ranks of a sampled cover before any suffix of theirs is sorted:

* Cover. In every window of ``length`` bytes the substring of ``anchor`` bytes with the smallest
  hash is sampled. Like a difference cover, the sample has a member in every window at the same
  place of equal windows; unlike an arithmetic one it is found from the content, so equal windows
  of any two texts agree on it, and it is a third as dense.
* Ranks. Consecutive windows with one sample form a run of bytes. Equal runs get the same class,
  and the earliest document with a class keeps it: all other members' windows are repeated, however
  long the tie is. A run whose sample occurs in one class alone is unique or already settled.
* Buckets. What is left are the earliest runs whose sample also occurs in other classes, that is the
  ends of matches. Only their suffixes are sorted, bucket by bucket.

Blocks are ranges of ids, so "an earlier document in another block" is a smaller block number and
need not be sent along. Within a block a string enters its bucket once, however often it occurs;
buckets and answers are arrays in one row per block and bucket. The texts are shuffled once.

Equality of strings is by fingerprints of 64 bits; runs are told apart by 64 bits of the sample and
64 bits of the class. NULL text is read as empty; texts under
``length`` bytes stay whole. A NULL id counts as later than all others; rows with equal ids, such
as repeated rows, and rows without an id do not remove each other's bytes. They are therefore dealt
by their texts over as many blocks of one rank as their bytes ask for. Columns other than id and text are left out.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from math import ceil, log2

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from landrecon.llm.common import cached, give_back, nullable
from landrecon.session import stage

LENGTH = 50
ANCHOR = 20
BLOCK_BYTES = 1 << 20
BUCKET_ENTRIES = 1 << 20
# Samples per byte of text, for the number of buckets only.
DENSITY = 1 / 16

BASE = 0x9E3779B97F4A7C15
LAST_ID = np.iinfo(np.int64).max
# What a row takes beside its text, where rows of one id are many.
ROW_BYTES = 16


def _mixed(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values in place, one to one."""
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of each."""
    held = cached(("powers",), dict)  # one pair of tables, as long as the longest block so far
    if len(held.get("up", ())) < n:
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            steps = np.full(n, base, dtype=np.uint64)
            steps[0] = 1
            np.cumprod(steps, out=steps)
            held[name] = steps
    return held["up"], held["down"]


def _byte_values() -> np.ndarray:
    return np.random.default_rng(50).integers(0, 1 << 64, 256, dtype=np.uint64)


@dataclass
class Runs:
    """The runs of windows with one sample, of a block of texts in order of id."""

    first: np.ndarray  # first window of each run
    last: np.ndarray  # last window
    rank: np.ndarray  # rank of the id of its text in the block
    order: np.ndarray  # runs sorted by entry, in order of rank within an entry
    start: np.ndarray  # where each distinct entry begins in ``order``
    bucket: np.ndarray  # of each distinct entry
    entry: np.ndarray  # sample and class, 64 bits each, in two columns


class Block:
    def __init__(self, ids: np.ndarray, column: pa.ChunkedArray, length: int, anchor: int, bits: int):
        self.length, self.anchor, self.bits = length, anchor, bits
        self.row_order = np.argsort(ids, kind="stable")
        self.ids = ids[self.row_order]
        text = pa.concat_arrays(column.cast(pa.large_binary()).chunks).take(pa.array(self.row_order))
        _, offsets, data = text.buffers()
        n = len(text)
        self.offsets = np.frombuffer(offsets, np.int64, n + 1, text.offset * 8)
        base = int(self.offsets[0])
        self.offsets = self.offsets - base
        total = int(self.offsets[-1])
        self.data = np.frombuffer(data, np.uint8, total, base) if total else np.zeros(0, np.uint8)
        sizes = np.diff(self.offsets)
        self.text_rank = np.cumsum(np.r_[0, self.ids[1:] != self.ids[:-1]])[: len(ids)]
        power, self.inverse = _powers(total + 1)
        terms = _byte_values()[self.data]
        terms *= power[:total]
        self.sums = np.zeros(total + 1, dtype=np.uint64)
        np.cumsum(terms, out=self.sums[1:])
        del terms
        # windows: positions from which ``length`` bytes fit into the text
        room = np.maximum(sizes - length + 1, 0)
        edge = np.zeros(total + 1, dtype=np.int8)
        has = room > 0
        np.add.at(edge, self.offsets[:-1][has], 1)
        np.add.at(edge, (self.offsets[:-1] + room)[has], -1)
        self.windows = np.cumsum(edge[:total], dtype=np.int8).astype(bool)

    def prints(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """64-bit fingerprints of the strings between positions."""
        h = self.sums[stop] - self.sums[start]
        h *= self.inverse[start]
        return _mixed(h)

    def runs(self) -> Runs:
        total, width = len(self.data), self.length - self.anchor + 1
        n = max(0, total - self.anchor + 1)
        h = self.sums[self.anchor : self.anchor + n] - self.sums[:n]
        h *= self.inverse[:n]
        sample = _mixed(h)
        # smallest hash, then leftmost: hash in the high half, position in the low half
        least = (sample & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
        step = 1
        while 2 * step <= width:
            least = np.minimum(least[: len(least) - step], least[step:])
            step *= 2
        if width > step:
            least = np.minimum(least[: len(least) - (width - step)], least[width - step :])
        at = np.flatnonzero(self.windows[: len(least)])
        where = (least[at] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        del least
        new = np.ones(len(at), dtype=bool)
        new[1:] = (where[1:] != where[:-1]) | (at[1:] != at[:-1] + 1)
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(at)) - 1
        first, last, place = at[begin], at[end[: len(begin)]], where[begin]
        # the smallest of many hashes are all small: scramble them again, or few buckets get most
        chosen = _mixed(sample[place] + np.uint64(BASE))
        shape = (place - first).astype(np.uint64) << np.uint64(32) | (last - first).astype(np.uint64)
        kind = _mixed(self.prints(first, last + self.length) + shape)
        text = np.searchsorted(self.offsets, first, side="right") - 1
        rank = self.text_rank[text] if len(text) else np.zeros(0, np.int64)
        bucket = _bucket(chosen, self.bits)
        order = np.lexsort((kind, chosen))  # buckets are ranges of ``chosen``
        c, k = chosen[order], kind[order]
        start = _starts(c, k)
        return Runs(first, last, rank, order, start, bucket[order[start]], np.stack([c[start], k[start]], axis=1))

    def settle(self, runs: Runs, answer: np.ndarray):
        """By the answers to the runs' entries: which runs are repeated, and which are open."""
        counts = np.diff(np.append(runs.start, len(runs.order)))
        earliest = np.repeat(runs.rank[runs.order[runs.start]], counts)
        rank = runs.rank[runs.order]
        bits = np.repeat(answer, counts)
        repeated = np.zeros(len(runs.order), dtype=bool)
        repeated[runs.order] = (bits & 1).astype(bool) | (rank > earliest)
        unsure = np.zeros(len(runs.order), dtype=bool)
        unsure[runs.order] = (bits & 2).astype(bool)
        return repeated, unsure & ~repeated

    def open_windows(self, runs: Runs, unsure: np.ndarray):
        """The windows of the open runs sorted by fingerprint, in order of rank within equal ones."""
        sizes = (runs.last - runs.first + 1)[unsure]
        shift = np.cumsum(sizes) - sizes
        at = np.arange(int(sizes.sum())) + np.repeat(runs.first[unsure] - shift, sizes)
        rank = np.repeat(runs.rank[unsure], sizes)
        mark = self.prints(at, at + self.length)
        order = np.argsort(mark, kind="stable")
        at, rank, mark = at[order], rank[order], mark[order]
        return at, rank, mark, _starts(mark)

    def answers(self, table: pa.Table, kind: int, bucket: np.ndarray) -> np.ndarray:
        """The answers of one kind for sorted entries, put together from the buckets' rows."""
        out = np.zeros(len(bucket), dtype=np.uint8)
        own = table.filter(pa.compute.equal(table["kind"], kind))
        for b, data in zip(own["bucket"].to_pylist(), own["payload"].to_pylist()):
            lo, hi = np.searchsorted(bucket, [b, b + 1])
            out[lo:hi] = np.unpackbits(np.frombuffer(data, np.uint8), count=2 * (hi - lo)).reshape(-1, 2) @ [2, 1]
        return out

    def remove(self, starts: np.ndarray):
        """Kept bytes, number of removed bytes and of removed spans, per row in the given order."""
        edge = np.zeros(len(self.data) + 1, dtype=np.int32)
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + self.length, -1)
        gone = np.cumsum(edge[:-1]) > 0
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        inside = self.offsets[:-1][np.diff(self.offsets) > 0]
        begins[inside] = gone[inside]
        total_gone, total_begins = np.r_[0, np.cumsum(gone)], np.r_[0, np.cumsum(begins)]
        removed, spans = np.diff(total_gone[self.offsets]), np.diff(total_begins[self.offsets])
        kept = self.data[~gone]
        ends = self.offsets - total_gone[self.offsets]
        return kept, ends, removed, spans


def _bucket(prints: np.ndarray, bits: int) -> np.ndarray:
    if not bits:
        return np.zeros(len(prints), dtype=np.int32)
    return (prints >> np.uint64(64 - bits)).astype(np.int32)


def _starts(*columns: np.ndarray) -> np.ndarray:
    new = np.zeros(len(columns[0]), dtype=bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _by_bucket(block: int, bucket: np.ndarray, entries: np.ndarray, kind: int) -> dict[str, list]:
    begin = _starts(bucket)
    parts = np.split(entries, begin[1:]) if len(begin) else []
    return {
        "bucket": bucket[begin].tolist(), "block": [block] * len(begin), "kind": [kind] * len(begin),
        "payload": [p.tobytes() for p in parts],
    }


class Layout:
    """Which block a row is in. Block numbers rise with the ids; blocks of one id share a rank."""

    def __init__(self, bounds: list[int], heavy: dict[int, int] | None = None, without: int = 1):
        self.bounds = np.array(bounds, dtype=np.int64)  # upper ids of the ranges but the last
        self.widths = np.ones(len(bounds) + 2, dtype=np.int64)  # blocks of each range; NULL ids come last
        for one, blocks in (heavy or {}).items():
            self.widths[np.searchsorted(self.bounds, one)] = blocks
        self.widths[-1] = without
        self.first = np.cumsum(self.widths) - self.widths

    def rank(self, block: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, block, side="right")

    def column(self, doc_id: Column, draw: Column) -> Column:
        @pandas_udf("int")
        def locate(known: pd.Series, none: pd.Series, draws: pd.Series) -> pd.Series:
            own = np.searchsorted(self.bounds, known.to_numpy())
            own[none.to_numpy()] = len(self.widths) - 1
            return pd.Series((self.first[own] + draws.to_numpy() % self.widths[own]).astype("int32"))

        # a column with NULLs would come as floating-point numbers, which do not hold every id
        return locate(F.coalesce(doc_id, F.lit(0).cast("long")), doc_id.isNull(), draw)


_ROW = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("kind", pa.int8()), ("payload", pa.binary())])
_ROW_DDL = "bucket int, block int, kind byte, payload binary"
RUN, WINDOW, SETTLED = 1, 2, 3


def _answer(table: pa.Table, rank_of: Callable[[np.ndarray], np.ndarray] = lambda blocks: blocks) -> pa.Table:
    """Sort one bucket: for every entry of every block, has a block of lower rank the same one (low bit),
    and has its sample another class (high bit, for runs). Answers of an earlier round pass through."""
    give_back()
    passing = table.filter(pa.compute.equal(table["kind"], SETTLED))
    asked = table.filter(pa.compute.not_equal(table["kind"], SETTLED)).sort_by("block")
    if not asked.num_rows:
        return passing
    columns = 2 if asked["kind"][0].as_py() == RUN else 1
    parts = [np.frombuffer(p, np.uint64).reshape(-1, columns) for p in asked["payload"].to_pylist()]
    sizes = np.array([len(p) for p in parts])
    entry = np.concatenate(parts)
    part = np.repeat(np.arange(len(parts), dtype=np.int32), sizes)
    rank = rank_of(asked["block"].to_numpy())[part]
    order = np.lexsort(entry.T[::-1])
    e = entry[order]
    start = _starts(*e.T)
    counts = np.diff(np.append(start, len(e)))
    first = np.repeat(rank[order[start]], counts)
    bits = np.zeros((len(e), 2), dtype=np.uint8)
    bits[order, 1] = rank[order] > first
    sample = e[start, 0]
    alone = np.ones(len(start), dtype=bool)
    same = sample[1:] == sample[:-1]
    alone[1:] &= ~same
    alone[:-1] &= ~same
    bits[order, 0] = np.repeat(~alone, counts)
    answers = [np.packbits(b).tobytes() for b in np.split(bits, np.cumsum(sizes)[:-1])]
    asked = asked.set_column(3, "payload", pa.array(answers, pa.binary()))
    return pa.concat_tables([asked, passing]) if passing.num_rows else asked


def _lay_out(lengths: DataFrame, block_bytes: int) -> tuple[Layout, int]:
    """Ranges of ids that are the blocks, and the bytes in all. Quantiles of the ids are joined
    until a block has its bytes; there are some four of them per block. An id whose rows are more
    than a block is a range by itself, in several blocks; there are fewer such ids than blocks."""
    total, n = lengths.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("doc_id")).first()
    by_id = lengths.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("size") + ROW_BYTES).alias("size"))
    heavy = {r[0]: ceil(r[1] / block_bytes) for r in by_id.filter((F.col("n") > 1) & (F.col("size") > block_bytes)).select("doc_id", "size").collect()}
    without = heavy.pop(None, 1)
    fine = min(4 * ceil(total / block_bytes), n)
    bounds = []
    if fine >= 2:
        steps = [i / fine for i in range(1, fine)]
        # as many numbers as four times the blocks
        marks = sorted(set(lengths.agg(F.percentile_approx("doc_id", steps, max(10_000, 20 * fine))).first()[0]))
        within = Layout(marks).column(F.col("doc_id"), F.lit(0).cast("long"))
        sizes = {r[0]: r[1] for r in lengths.groupBy(within).agg(F.sum("size")).collect()}
        held = 0
        for i, mark in enumerate(marks):
            held += sizes.get(i, 0)
            if held >= block_bytes * 3 // 4:
                bounds.append(mark)
                held = 0
    alone = {b for h in heavy for b in (h - 1, h) if b >= -LAST_ID}
    bounds = sorted({*bounds, *alone})
    return Layout(bounds, {h: heavy[h] for h in sorted(heavy)}, without), total


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, block_bytes: int = BLOCK_BYTES,
    bucket_entries: int = BUCKET_ENTRIES, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None,
) -> DataFrame:
    """doc_id, kept (binary), n_bytes, n_removed and n_spans per row, and ``carried``, a struct of
    the columns to carry along if there are any."""
    extra = [F.struct(*carry).alias("carried")] if carry else []
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *extra
    )
    lengths = stage(rows.select("doc_id", F.octet_length("text").cast("long").alias("size")), "lengths")
    lay, total = _lay_out(lengths, block_bytes)
    bits = max(0, ceil(log2(max(1.0, total * DENSITY / bucket_entries))))
    located = rows.withColumns(
        {"text": F.col("text").cast("binary"), "block": lay.column(F.col("doc_id"), F.xxhash64("text"))}
    )
    blocks = located.groupBy("block")
    along = ["carried"] if carry else []

    def read(table: pa.Table) -> Block:
        give_back()
        ids = table["doc_id"].fill_null(LAST_ID).to_numpy()
        return Block(ids, table["text"], length, anchor, bits)

    def rows_of(*parts: dict[str, list]) -> pa.Table:
        return pa.concat_tables([pa.table(p, schema=_ROW) for p in parts])

    def list_runs(table: pa.Table) -> pa.Table:
        runs = read(table).runs()
        return rows_of(_by_bucket(table["block"][0].as_py(), runs.bucket, runs.entry, RUN))

    def list_windows(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _ROW.empty_table()
        number = table["block"][0].as_py()
        block = read(table)
        runs = block.runs()
        _, unsure = block.settle(runs, block.answers(answers, RUN, runs.bucket))
        _, _, mark, start = block.open_windows(runs, unsure)
        own = mark[start]
        settled = answers.set_column(2, _ROW.field("kind"), pa.array([SETTLED] * answers.num_rows, pa.int8()))
        return pa.concat_tables([rows_of(_by_bucket(number, _bucket(own, bits), own, WINDOW)), settled.cast(_ROW)])

    def cut(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            whole = pa.schema([*_OUT, *[pa.field(c, nullable(table[c]).type) for c in along]])
            return whole.empty_table()
        block = read(table)
        runs = block.runs()
        repeated, unsure = block.settle(runs, block.answers(answers, SETTLED, runs.bucket))
        at, rank, mark, start = block.open_windows(runs, unsure)
        counts = np.diff(np.append(start, len(mark)))
        earlier = np.repeat(block.answers(answers, WINDOW, _bucket(mark[start], bits)) & 1, counts).astype(bool)
        earlier |= rank > np.repeat(rank[start], counts)
        sizes = (runs.last - runs.first + 1)[repeated]
        shift = np.cumsum(sizes) - sizes
        settled = np.arange(int(sizes.sum())) + np.repeat(runs.first[repeated] - shift, sizes)
        kept, ends, removed, spans = block.remove(np.concatenate([settled, at[earlier]]))
        text = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(block.ids), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(kept)]
        )
        moved = table.select(["doc_id", *along]).take(pa.array(block.row_order))
        out = pa.table(
            [
                moved["doc_id"], text.cast(pa.binary()),
                pa.array(np.diff(block.offsets)), pa.array(removed.astype(np.int64)), pa.array(spans.astype(np.int64)),
            ],
            schema=_OUT,
        )
        return out.append_column("carried", nullable(moved["carried"])) if along else out

    def answer(table: pa.Table) -> pa.Table:
        return _answer(table, lay.rank)

    asked = blocks.applyInArrow(list_runs, _ROW_DDL)
    answered = asked.groupBy("bucket").applyInArrow(answer, _ROW_DDL)
    open_asked = blocks.cogroup(answered.groupBy("block")).applyInArrow(list_windows, _ROW_DDL)
    settled = open_asked.groupBy("bucket").applyInArrow(answer, _ROW_DDL)
    schema = "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long"
    if carry:
        schema += f", carried {dict(rows.dtypes)['carried']}"
    return blocks.cogroup(settled.groupBy("block")).applyInArrow(cut, schema)


@pandas_udf(StringType())
def readable(data: pd.Series) -> pd.Series:
    """Bytes as text; what is left of a character that was cut in two is dropped."""
    return data.map(lambda b: b.decode("utf-8", "ignore"))


_OUT = pa.schema(
    [("doc_id", pa.int64()), ("kept", pa.binary()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64())]
)
