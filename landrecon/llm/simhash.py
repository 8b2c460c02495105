"""SimHash near-duplicates by a byte-position inverted index with count filtering.

Two fingerprints that differ in at most ``max_bits`` bits differ in at most that many of their
eight bytes, so they share at least 8 - ``max_bits`` bytes at the same positions: the guaranteed
minimum. The positions are taken in four twos, of which such a pair shares at least
4 - ``max_bits`` whole. The inverted index has a posting list for every choice of that many twos
and their bytes (6 lists of four bytes per fingerprint at two bits), so the pair meets in one.
Lists of single bytes would hold 1/256 of the corpus each, and their pairs would grow with its square.

In a list the positional bytes that a pair shares are tallied; pairs with fewer than the minimum go,
those left are verified by their Hamming distance. Lists of more than ``SMALL_LIST`` fingerprints are
counted beforehand and split, so that no list is too large for a task: they are laid out anew by all the
bytes of the minimum, once each way to choose them. A pair with the minimum meets there too, its tally
is the number of the list's bytes, and such a list has at most 256 ** ``max_bits`` distinct fingerprints
however many documents there are.

Only a link from each member to the first of its group leaves a list: links grow with the number of
fingerprints and not with the pairs. Copies share a fingerprint and enter once.

NULL and empty texts have no words and fingerprint zero; they link like any other. Rows with a
NULL id take part and get their group's id. Repeated rows give one result each. Columns other than
id and text are left out.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from landrecon.llm.common import batches, partitions, texts, whole_groups
from landrecon.llm.components import components
from landrecon.operators.lookups import attach
from landrecon.session import stage

SEED = 42
SHINGLE = 3
MAX_BITS = 2
BLOCK = 1 << 16
TWOS = [{0, 1}, {2, 3}, {4, 5}, {6, 7}]
# Lists up to this size are tallied pair by pair, larger ones split and compared bit by bit.
SMALL_LIST = 256


def fingerprint(text: str, width: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles of a text, as an unsigned number."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda end, n: end + 1 + n))
    starts = [0, *(e + 1 for e in ends[:-1])]
    spans = zip(starts, ends[min(width, len(words)) - 1 :])
    digest = xxhash.xxh64_intdigest
    n = max(1, len(words) - width + 1)
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), dtype="<u8", count=n)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, BLOCK):
        bits = np.unpackbits(hashes[at : at + BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) per row; fp is the fingerprint as a signed 64-bit number."""
    rows = texts(docs, id_col, text_col)

    def run_all(part):
        def run(batch):
            found = np.array([fingerprint(t, width) for t in batch["text"].to_pylist()], dtype=np.uint64)
            return pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"], "fp": pa.array(found.view(np.int64))})

        return batches(part, run)

    return rows.mapInArrow(run_all, f"doc_id {dict(rows.dtypes)['doc_id']}, fp long")


def _near(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    """Which pairs share the minimum of positional bytes and are verified; of arrays of one shape, or
    of shapes that go together."""
    differ = a ^ b
    shared = (differ[..., None].view(np.uint8) == 0).sum(axis=-1)
    near = shared >= 8 - max_bits
    near[near] = np.bitwise_count(differ[near]) <= max_bits
    return near


def _firsts_small(values: np.ndarray, max_bits: int) -> np.ndarray:
    near = _near(values[:, None], values[None, :], max_bits)
    label = np.arange(len(values))
    while True:
        new = np.where(near, label[None, :], len(values)).min(axis=1)
        if (new == label).all():
            return label
        label = new


def _firsts_large(values: np.ndarray, free: list[int], max_bits: int) -> np.ndarray:
    """As above through a table over the free bytes, one step per pattern of flipped bits."""
    code = np.zeros(len(values), dtype=np.int64)
    for k, byte in enumerate(free):
        code |= ((values >> np.uint64(8 * byte)) & np.uint64(255)).astype(np.int64) << (8 * k)
    width = 8 * len(free)
    flips = [sum(1 << b for b in c) for n in range(1, max_bits + 1) for c in combinations(range(width), n)]
    table = np.full(1 << width, len(values), dtype=np.int64)
    label = np.arange(len(values))
    while True:
        table[code] = label
        new = label.copy()
        for flip in flips:
            np.minimum(new, table[code ^ flip], out=new)
        if (new == label).all():
            return label
        label = new


def _mask(positions: set[int]) -> int:
    mask = sum(255 << (8 * b) for b in positions)
    return mask - (1 << 64) if mask >> 63 else mask


def _postings(fp: Column, lists: list[tuple[int, set[int]]]) -> Column:
    """(positions, bytes) of a fingerprint, for numbered choices of byte positions."""
    return F.array(
        *[
            F.struct(F.lit(n).cast("int").alias("positions"), fp.bitwiseAND(F.lit(_mask(chosen))).alias("bytes"))
            for n, chosen in lists
        ]
    )


def posting_lists(distinct: DataFrame, max_bits: int = MAX_BITS, small: int = SMALL_LIST) -> tuple[DataFrame, list[set[int]]]:
    """(positions, bytes, fp), one row per list and member, and the byte positions by number. Lists by
    twos come first; those with more than ``small`` members are replaced by lists of all bytes of the minimum."""
    if not 0 <= max_bits < len(TWOS):
        raise ValueError(f"max_bits must be 0 to {len(TWOS) - 1}")
    short = [set().union(*c) for c in combinations(TWOS, len(TWOS) - max_bits)]
    long = [set(c) for c in combinations(range(8), 8 - max_bits)]
    choices = short + long
    # All members of a long list are in every short list of its bytes; the first of these makes it.
    made = [[(n, c) for n, c in enumerate(long, len(short)) if next(s for s in short if s <= c) is own] for own in short]
    keys = ["positions", "bytes"]
    fp = F.col("fp")
    spread = distinct.select("fp").repartition(partitions(distinct.sparkSession), "fp")
    listed = spread.select("fp", F.inline(_postings(fp, list(enumerate(short)))))
    crowded = listed.groupBy(*keys).count().filter(F.col("count") > small).select(*keys)
    kept = attach(listed, crowded, keys, "left_anti")
    again = F.element_at(F.array(*[_postings(fp, m) for m in made]), F.col("positions") + 1)
    split = attach(listed, crowded, keys, "left_semi").select("fp", F.inline(again))
    return kept.unionByName(split).select(*keys, "fp"), choices


def links(distinct: DataFrame, max_bits: int = MAX_BITS, small: int = SMALL_LIST) -> DataFrame:
    """(a, b): verified links that join the distinct fingerprints ``fp`` into their groups."""
    lists, choices = posting_lists(distinct, max_bits, small)
    free = [sorted(set(range(8)) - c) for c in choices]
    dealt = lists.repartition("positions", "bytes").sortWithinPartitions("positions", "bytes", "fp")

    def verify(part):
        for table, begin in whole_groups(part, ["positions", "bytes"]):
            fps = table["fp"].to_numpy()
            values = fps.view(np.uint64)
            sizes = np.diff(np.append(begin, len(fps)))
            two = begin[sizes == 2]
            near = two[_near(values[two], values[two + 1], max_bits)]
            a, b = [fps[near + 1]], [fps[near]]
            positions = table["positions"].to_numpy()
            for lo, n in zip(begin[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
                own = values[lo : lo + n]
                first = _firsts_small(own, max_bits) if n <= small else _firsts_large(own, free[positions[lo]], max_bits)
                linked = np.flatnonzero(first != np.arange(n))
                a.append(fps[lo + linked])
                b.append(fps[lo + first[linked]])
            yield pa.RecordBatch.from_pydict(
                {"a": pa.array(np.concatenate(a), pa.int64()), "b": pa.array(np.concatenate(b), pa.int64())}
            )

    return dealt.mapInArrow(verify, "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits) and component_id, the smallest id of its group."""
    printed = stage(fingerprints(docs, id_col, text_col, width), "fingerprints")
    distinct = stage(printed.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    groups = components(links(distinct.select("fp"), max_bits))
    rooted = attach(distinct, groups.withColumnRenamed("node", "fp"), ["fp"]).select(
        "fp", "first_id", F.coalesce("component", "fp").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_print = attach(rooted, smallest, ["root"]).select("fp", "component_id")
    return attach(printed, by_print, ["fp"]).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
