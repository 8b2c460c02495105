"""Toxicity by a factorization machine over hashed terms.

A text's terms are its lower-case words and the first letters of the longer ones, hashed. Screening
keeps the terms whose presence goes with the label (likelihood ratio), of those in three or more fitted
texts, and of these the ``TERMS`` with the largest ratio; the machine learns a weight per kept term and a factor vector whose products are the pairwise interactions, so that two terms
together can weigh more, or less, than apart.

The model is fitted on the rows of all labelled ids. Equal examples (the same kept terms and label) are counted and
dealt to blocks; every step sums the gradients of the blocks, which stay with the executors, so that only the model
and one gradient a task travel, and nothing is shuffled. What fits one block is fitted by the driver. Whole texts are read, in fitting and in scoring; scoring reads nothing but the text. NULL and empty
texts get the score of a text without any kept term. A document with several labels counts as
toxic if one of them says so; labels other than 0 and 1 and NULL ids teach nothing. Without a
labelled row of each class the score is 0. Repeated rows give one result each; columns other than
those named are left out.
"""

from __future__ import annotations

import math
import re
import sys
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F

from landrecon.llm.common import batches, cached, nullable, texts
from landrecon.session import stage

# Different examples of a block, about.
BLOCK = 20_000
# Terms of which an example's are summed once for all examples that have the same.
TOGETHER = 6
# Places summed at a time.
PIECE = 1 << 15
BUCKETS = 1 << 20
PREFIXES = (4, 5)
# Terms must be this many times likelier (as a log-likelihood ratio) to depend on the label than not.
SCREEN = 16.0
TERMS = 4096
FACTORS = 4
STEPS = 600
RATE = 0.05
PENALTY = 1e-5
REMEMBERED_WORDS = 300_000
# Words of no more letters than this are hashed side by side, of about so many characters of text at a time.
SHORT = 24
CHARACTERS = 1 << 18

_gap = re.compile(r"\W").search


def word_terms(word: str, buckets: int = BUCKETS) -> list[int]:
    """The hashed terms of a word: itself and its beginnings."""
    marked = [word] + [f"{word[:n]}*" for n in PREFIXES if len(word) > n]
    return [zlib.crc32(m.encode()) % buckets for m in marked]


class _Terms(dict):
    """word -> its terms; forgets when it grows large."""

    def __missing__(self, word):
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        self[word] = found = word_terms(word)
        return found


def _letters() -> np.ndarray:
    """Of every code point whether it stands in words."""
    inside = np.zeros(sys.maxunicode + 1, dtype=bool)
    for run in re.finditer(r"\w+", "".join(map(chr, range(sys.maxunicode + 1)))):
        inside[run.start() : run.end()] = True
    return inside


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


def _spell(state: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """CRC-32 states (not yet inverted) after one more letter each, as UTF-8 has it."""
    table = cached(("toxicity-crc",), _crc_table)

    def step(state, byte):
        return table.take((state ^ byte) & 255) ^ (state >> 8)

    wide = np.flatnonzero(letters > 127)
    if not len(wide):
        return step(state, letters)
    first, of = letters.copy(), letters[wide]
    first[wide] = np.where(of < 0x800, 0xC0 | of >> 6, np.where(of < 0x10000, 0xE0 | of >> 12, 0xF0 | of >> 18))
    state = step(state, first)
    for least, shift in ((0x10000, 12), (0x800, 6), (0x80, 0)):
        more = wide[of >= least]
        state[more] = step(state[more], 0x80 | letters[more] >> shift & 63)
    return state


def _marked(lowered: list[str], terms: _Terms) -> tuple[np.ndarray, np.ndarray]:
    """The terms of all words of the texts, with repeats, and the text that each stands in. Short words are hashed
    letter by letter, all at a time; the others one by one."""
    joined = "\n".join(["", *lowered, ""])
    points = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
    inside = cached(("toxicity-letters",), _letters).take(points)
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    begins = np.cumsum([1, *(len(t) + 1 for t in lowered)])
    text = np.repeat(np.arange(len(lowered)), np.diff(np.searchsorted(starts, begins)))

    long, short = np.flatnonzero(sizes > SHORT), np.flatnonzero(sizes <= SHORT)
    short = short[np.argsort(SHORT - sizes[short].astype(np.uint8), kind="stable")]  # longest first
    at, size, state = starts[short], sizes[short], np.full(len(short), 0xFFFFFFFF, dtype=np.uint32)
    words, hashes = [], []
    for n in range(size.max(initial=0)):
        longer = np.count_nonzero(size > n)
        if n in PREFIXES:
            words.append(short[:longer])
            hashes.append(~_spell(state[:longer], np.full(longer, ord("*"), dtype=np.uint32)))
        state[:longer] = _spell(state[:longer], points.take(at[:longer] + n))
    others = [terms[joined[i : i + n]] for i, n in zip(starts[long].tolist(), sizes[long].tolist())]
    words += [short, np.repeat(long, [len(o) for o in others])]
    hashes = np.concatenate([*hashes, ~state]) % BUCKETS
    hashes = np.append(hashes.astype(np.int64), np.fromiter(chain.from_iterable(others), np.int64))
    return hashes, text[np.concatenate(words)]


def _pieces(texts: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """The texts in lower case, some at a time, long ones cut between words; and which text each piece is of."""
    which, some, size = [], [], 0
    for i, text in enumerate(texts):
        text, end = text.lower(), 0
        while end < len(text):
            begin, gap = end, _gap(text, end + CHARACTERS)
            end = gap.start() if gap else len(text)
            which.append(i)
            some.append(text[begin:end])
            size += end - begin
            if size >= CHARACTERS:
                yield which, some
                which, some, size = [], [], 0
    if some:
        yield which, some


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])[: len(values)]]


def places(kept: list[int]) -> np.ndarray:
    """Of every term its position in those kept, -1 for none."""
    place = np.full(BUCKETS, -1, dtype=np.int32)
    place[np.array(kept, dtype=np.int64)] = np.arange(len(kept))
    return place


def text_terms(texts: list[str], terms: _Terms, place: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """How many different terms each text has, and these in order, text by text; of the kept terms the positions, if
    places are given."""
    found = [np.zeros(0, dtype=np.int64)]
    for which, some in _pieces(texts):
        hashes, piece = _marked(some, terms)
        if place is not None:
            hashes = place.take(hashes)
            piece, hashes = piece[hashes >= 0], hashes[hashes >= 0]
        found.append(_distinct(np.array(which)[piece] * BUCKETS + hashes))
    each = _distinct(np.concatenate(found))
    return np.bincount(each // BUCKETS, minlength=len(texts)), (each % BUCKETS).astype(np.int32)


def lists(lengths: np.ndarray, values: np.ndarray) -> pa.ListArray:
    """Values as lists of so many each."""
    offsets = np.append(0, np.cumsum(lengths)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))


@dataclass
class Machine:
    terms: list[int]
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def logit(self, positions: list[int]) -> float:
        total = self.factors[positions].sum(axis=0)
        pairs = (total**2).sum() - (self.factors[positions] ** 2).sum()
        return float(self.bias + self.weights[positions].sum() + pairs / 2)


def _both_ways(lengths: np.ndarray, col: np.ndarray) -> tuple[np.ndarray, ...]:
    """How many entries each row has and their positions; the same in order of position, by how many rows have it and
    which. Every step reads them: types are short."""
    col = col.astype(np.min_scalar_type(col.max(initial=0)))
    row = np.repeat(np.arange(len(lengths), dtype=np.min_scalar_type(len(lengths))), lengths)[np.argsort(col, kind="stable")]
    return lengths.astype(np.int32), col, np.bincount(col).astype(np.int32), row


def example_block(rows: list[list[int]], labels, counts=None) -> tuple[np.ndarray, ...]:
    """Examples, of different terms each, as arrays: their patterns both ways, the patterns' terms both ways, labels, and
    how often each row counts. A pattern is what an example has of some terms that are about as frequent."""
    lengths = np.array([len(r) for r in rows], dtype=np.int64)
    term = np.fromiter(chain.from_iterable(rows), np.int64, lengths.sum())
    often = np.argsort(-np.bincount(term), kind="stable")
    rank, n_terms = np.argsort(often), max(1, len(often))
    row, place = divmod(np.sort(np.repeat(np.arange(len(rows)), lengths) * n_terms + rank[term]), n_terms)
    first = np.flatnonzero(np.diff(row * n_terms + place // TOGETHER, prepend=-1))
    has = np.add.reduceat(1 << place % TOGETHER, first)
    patterns, col = np.unique((place[first] // TOGETHER << TOGETHER) + has, return_inverse=True)
    at, bit = np.nonzero(patterns[:, None] >> np.arange(TOGETHER) & 1)
    member = often[(patterns[at] >> TOGETHER) * TOGETHER + bit]
    counts = np.ones(len(rows)) if counts is None else np.array(counts, dtype=float)
    return (
        *_both_ways(np.bincount(row[first], minlength=len(rows)), col),
        *_both_ways(np.bincount(at, minlength=len(patterns)), member),
        np.array(labels, dtype=float), counts,
    )


def _sums(tables: np.ndarray, at: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Of each table the sums of its values at so many places each, one after the other; 0 for none. Done in pieces
    that stay in a core's cache, two tables at a time as the two parts of a complex number."""
    pairs = np.zeros((-(-len(tables) // 2), tables.shape[1]), dtype=complex)
    pairs.real, pairs.imag[: len(tables) // 2] = tables[::2], tables[1::2]
    found, some = np.zeros((len(pairs), len(lengths)), dtype=complex), np.flatnonzero(lengths)
    starts = np.append((np.cumsum(lengths, dtype=np.int64) - lengths)[some], len(at))
    cuts = np.unique(np.append(np.searchsorted(starts[:-1], np.arange(0, len(at), PIECE)), len(some)))
    for first, last in zip(cuts[:-1], cuts[1:]):
        here = at[starts[first] : starts[last]].astype(np.intp)
        for values, sums in zip(pairs, found):
            sums[some[first:last]] = np.add.reduceat(values.take(here), starts[first:last] - starts[first])
    return np.stack([found.real, found.imag], axis=1).reshape(2 * len(found), len(lengths))[: len(tables)]


def logits(add: Callable[[np.ndarray], np.ndarray], bias, weights: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, list]:
    """Of examples, given what adds up tables by term for each; and the sums of their terms' factors."""
    # The products of all pairs, less those of a factor with itself, which go with the weights.
    alone, *total = add(np.vstack([weights - (vectors**2).sum(axis=1) / 2, vectors.T]))
    return bias + alone + sum(t**2 for t in total) / 2, total


def block_gradients(block: tuple, bias: np.ndarray, weights: np.ndarray, vectors: np.ndarray) -> list[np.ndarray]:
    """Gradients of the log loss, summed over the block, by bias, weights and factors."""
    lengths, col, copies, row, sizes, members, uses, patterns, labels, counts = block
    logit, total = logits(lambda tables: _sums(_sums(tables, members, sizes), col, lengths), bias, weights, vectors)
    error = counts * (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels)
    pull = np.zeros((1 + len(total), len(weights)))
    of_patterns = _sums(error * np.vstack([np.ones_like(error), *total]), row, copies)
    pull[:, : len(uses)] = _sums(of_patterns, patterns, uses)
    return [np.array([error.sum()]), pull[0], (pull[1:] - vectors.T * pull[0]).T]


def descend(gradients: Callable[..., list[np.ndarray]], n: int, rate: float, n_terms: int, factors: int = FACTORS):
    """Bias, weights and factors by full-batch Adam, from the gradients summed over all ``n`` examples."""
    bias = np.array([np.log(rate / (1 - rate))])
    weights = np.zeros(n_terms)
    vectors = np.random.default_rng(0).normal(0, 0.05, (n_terms, factors))
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (bias, weights, vectors)]
    for step in range(1, STEPS + 1):
        grads = [g / n for g in gradients(bias, weights, vectors)]
        grads[1] += PENALTY * weights
        grads[2] += PENALTY * vectors
        for param, grad, m in zip((bias, weights, vectors), grads, moments):
            m[0] += 0.1 * (grad - m[0])
            m[1] += 0.001 * (grad**2 - m[1])
            param -= RATE * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.999**step)) + 1e-8)
    return float(bias[0]), weights, vectors


def fit_machine(rows: list[list[int]], labels: np.ndarray, n_terms: int, factors: int = FACTORS):
    """Bias, weights and factors for rows of term positions, on the log loss."""
    block = example_block(rows, labels)
    return descend(lambda *model: block_gradients(block, *model), len(rows), labels.mean(), n_terms, factors)


def fit_examples(examples: DataFrame, n: dict[int, int], n_terms: int, block: int = BLOCK):
    """The same for a table of toxic, terms and n, how often the example occurs; ``n`` by label."""
    blocks = max(1, math.ceil(examples.count() / block))
    dealt = (
        examples.withColumn("block", F.pmod(F.xxhash64("toxic", "terms"), F.lit(blocks)))
        .groupBy("block").agg(F.sort_array(F.collect_list(F.struct("toxic", "terms", "n"))).alias("rows"))
    )

    def unpack(row):
        return example_block(*[[r[c] for r in row["rows"]] for c in ("terms", "toxic", "n")])

    size, rate = n[0] + n[1], n[1] / (n[0] + n[1])
    if blocks == 1:
        only = unpack(dealt.first())
        return descend(lambda *model: block_gradients(only, *model), size, rate, n_terms)
    written = stage(dealt, "toxicity-blocks")
    # A task sums the blocks it holds, so that a step sends no more than one gradient a core. To begin a task costs
    # about as much as a block's gradient, in every step; so none has a single block where there are more.
    tasks = min(math.ceil(blocks / 2), examples.sparkSession.sparkContext.defaultParallelism)
    held = written.rdd.map(unpack).coalesce(tasks).persist(StorageLevel.MEMORY_AND_DISK_DESER)

    def gradients(*model):
        of_blocks = held.map(lambda part: block_gradients(part, *model))
        return of_blocks.reduce(lambda a, b: [x + y for x, y in zip(a, b)])

    try:
        return descend(gradients, size, rate, n_terms)
    finally:
        held.unpersist()


def _likelihood_ratio(pos, neg, n_pos, n_neg):
    """G statistic of presence against label, per term."""
    table = np.array([[pos, n_pos - pos], [neg, n_neg - neg]], dtype=float)
    expected = table.sum(axis=0)[None] * np.array([n_pos, n_neg])[:, None, None] / (n_pos + n_neg)
    with np.errstate(divide="ignore", invalid="ignore"):
        return 2 * np.nansum(np.where(table > 0, table * np.log(table / expected), 0), axis=(0, 1))


def train(docs: DataFrame, labels: DataFrame, learn_from: Callable[[Column], Column], block: int = BLOCK) -> Machine | None:
    """Fit on the labelled rows that ``learn_from`` (a condition on the id) admits."""
    rated = (
        labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
        .filter(F.col("toxic").isin(0, 1) & learn_from(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )

    def read(part):
        terms = _Terms()

        def run(batch):
            found = lists(*text_terms(batch["text"].to_pylist(), terms))
            return pa.RecordBatch.from_pydict({"toxic": batch["toxic"], "terms": found})

        return batches(part, run)

    # Without the hint the labels would be broadcast or not by their size, which grows with the texts.
    labelled = texts(docs).join(rated.hint("merge"), "doc_id").select("text", "toxic")
    rows = stage(labelled.mapInArrow(read, "toxic int, terms array<int>"), "toxicity-terms")
    n = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if not n.get(0) or not n.get(1):
        return None
    counts = (
        rows.select("toxic", F.explode("terms").alias("term"))
        .groupBy("term").agg(F.sum("toxic").alias("pos"), F.sum(1 - F.col("toxic")).alias("neg"))
        .filter((F.col("pos") + F.col("neg") > 2) & (F.col("pos") * n[0] != F.col("neg") * n[1]))
    )

    def screen(part):
        def run(batch):
            pos, neg = (batch[c].to_numpy() for c in ("pos", "neg"))
            ratio = _likelihood_ratio(pos, neg, n[1], n[0])
            kept = pa.array(np.flatnonzero(ratio >= SCREEN))
            return pa.RecordBatch.from_pydict(
                {"term": batch["term"].take(kept), "ratio": pa.array(ratio).take(kept)}
            )

        return batches(part, run)

    best = counts.mapInArrow(screen, "term int, ratio double").orderBy(F.desc("ratio"), "term").limit(TERMS)
    terms = [r["term"] for r in best.collect()]  # at most TERMS

    def reduce_terms(part):
        place = places(terms)

        def run(batch):
            lengths = batch["terms"].value_lengths().to_numpy()
            found = place[batch["terms"].flatten().to_numpy()]
            row = np.repeat(np.arange(len(lengths)), lengths)[found >= 0]
            found = lists(np.bincount(row, minlength=len(lengths)), found[found >= 0])
            return pa.RecordBatch.from_pydict({"toxic": batch["toxic"], "terms": found})

        return batches(part, run)

    kept = rows.mapInArrow(reduce_terms, "toxic int, terms array<int>")
    examples = stage(kept.groupBy("toxic", "terms").agg(F.count(F.lit(1)).alias("n")), "toxicity-examples")
    return Machine(terms, *fit_examples(examples, n, len(terms), block))


def score(docs: DataFrame, machine: Machine | None, keep: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """The columns to keep, as they are, and score, per row."""
    keep = ["doc_id"] if keep is None else keep
    if machine is None:
        return docs.select(*keep, F.lit(0.0).alias("score"))
    rows = docs.select(F.struct(*keep).alias("kept"), F.coalesce(text_col, F.lit("")).alias("text"))

    def run_all(part):
        terms, place = _Terms(), places(machine.terms)

        def run(batch):
            lengths, positions = text_terms(batch["text"].to_pylist(), terms, place)
            logit, _ = logits(lambda t: _sums(t, positions, lengths), machine.bias, machine.weights, machine.factors)
            scores = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
            return pa.RecordBatch.from_pydict({"kept": nullable(batch["kept"]), "score": pa.array(scores, pa.float64())})

        return batches(part, run)

    return rows.mapInArrow(run_all, f"kept {dict(rows.dtypes)['kept']}, score double").select("kept.*", "score")


def fold(doc_id: Column, folds: int = 5) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(folds))


def score_documents(docs: DataFrame, labels: DataFrame, train_docs: DataFrame | None = None) -> DataFrame:
    """doc_id, held_out, score and predicted per row; fitted on folds other than 0."""
    machine = train(docs if train_docs is None else train_docs, labels, lambda i: fold(i) != 0)
    return score(docs, machine).select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
