"""Byte-level BPE encoding and decoding of whole texts, in overlapping chunks.

A text longer than ``chunk`` code points is cut into chunks that reach ``overlap`` code points
into their successor. Chunks are pre-tokenised in parallel. The pattern never looks back, so two
pre-tokenisations that share one boundary agree from there on: the cut between two chunks is the
first boundary in the overlap that both have. Only boundaries after a character other than white
space serve, because the pattern's look-ahead concerns white space alone; a piece between two cuts
then splits by itself just as it does within the whole text. The pieces are encoded in parallel and
their ids joined in order. A text of which some overlap has no common boundary (one word longer
than the overlap) is put together again and encoded in one task, pre-token by pre-token where they are
long: the library's own pattern, which runs out of stack on very long white space, never gets more than
``2 * CHUNK`` code points at once (``encode_text``).

NULL text is read as empty; an empty text has no ids. Rows are kept apart by position, so repeated
rows and repeated ids give one result each. Columns other than id and text are left out.
"""

from __future__ import annotations

import base64

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window, functions as F

from landrecon.llm.common import batches, cached, texts

CHUNK = 1 << 15
OVERLAP = 1 << 10
# Longest look-ahead of the pattern past the start of a match ('re, 've, 'll).
REACH = 3


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _encoding(path: str, pattern: str):
    def make():
        import tiktoken

        return tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={}
        )

    return cached(("encoding", path, pattern), make)


def _token_bytes(path: str) -> list[bytes]:
    def make():
        ranks = read_ranks(path)
        table = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            table[rank] = token
        return table

    return cached(("token bytes", path), make)


def encode_text(encoding, text: str, pattern: str, most: int = CHUNK) -> list[int]:
    """Ids of a text of any length. A long one is cut after pre-tokens that do not end in white space,
    as chunks are; a pre-token longer than ``most``, and white space right before it, goes singly."""
    if len(text) <= most:
        return encoding.encode_ordinary(text)
    rule = cached(("pattern", pattern), lambda: regex.compile(pattern))
    ids: list[int] = []
    begin = sure = 0  # text up to ``begin`` is encoded, up to ``sure`` it may be cut
    blank: list[str] = []  # white space since then
    for m in rule.finditer(text):
        start, end = m.span()
        if end - start > most:
            ids += encoding.encode_ordinary(text[begin:sure])
            for piece in (*blank, m.group()):
                ids += encoding._encode_single_piece(piece)
            begin, sure, blank = end, end, []
        elif text[end - 1].isspace():
            blank.append(m.group())
        else:
            if end - begin > most:
                ids += encoding.encode_ordinary(text[begin:sure])
                begin = sure
            sure, blank = end, []
    ids += encoding.encode_ordinary(text[begin:sure])
    for piece in blank:
        ids += encoding._encode_single_piece(piece)
    return ids


def _encode(encoding, text: str, pattern: str) -> bytes:
    return np.asarray(encode_text(encoding, text, pattern), dtype="<u4").tobytes()


def _boundaries(pattern, text: str) -> np.ndarray:
    """Ends of the pre-tokens whose last character is not white space."""
    ends = [m.end() for m in pattern.finditer(text)]
    return np.array([e for e in ends if not text[e - 1].isspace()], dtype=np.int64)


def encode(
    docs: DataFrame, ranks_path: str, pattern: str = public_tokenizers.PATTERN,
    id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP,
) -> DataFrame:
    """doc_id, n_tokens and ids (binary: little-endian unsigned 32-bit) per row."""
    rows = texts(docs, id_col, text_col)
    kind = dict(rows.dtypes)["doc_id"]
    length = F.length("text")

    def whole(part):
        encoding = _encoding(ranks_path, pattern)

        def run(batch):
            ids = [_encode(encoding, t, pattern) for t in batch["text"].to_pylist()]
            return pa.RecordBatch.from_pydict(
                {"doc_id": batch["doc_id"], "ids": pa.array(ids, pa.binary())}
            )

        return batches(part, run)

    short = rows.filter(length <= chunk).mapInArrow(whole, f"doc_id {kind}, ids binary")

    def pre_tokenise(part):
        rule = cached(("pattern", pattern), lambda: regex.compile(pattern))

        def run(batch):
            heads, tails = [], []
            for start, last, text in zip(*(batch[c].to_pylist() for c in ("start", "last", "piece"))):
                ends = _boundaries(rule, text)
                heads.append(ends[ends <= overlap] + start)
                sure = ends[(ends >= chunk) & (last | (ends <= len(text) - REACH))]
                tails.append(sure + start)
            return pa.RecordBatch.from_pydict(
                {
                    **{c: batch[c] for c in ("row", "doc_id", "chunk", "start", "last", "piece")},
                    "head": pa.array(heads, pa.list_(pa.int64())),
                    "tail": pa.array(tails, pa.list_(pa.int64())),
                }
            )

        return batches(part, run)

    starts = F.sequence(F.lit(0), F.floor((length - 1) / chunk).cast("int"))
    chunks = (
        rows.filter(length > chunk)
        .select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
        .select("row", "doc_id", "text", length.alias("n"), F.explode(starts).alias("chunk"))
        .select(
            "row", "doc_id", "chunk", (F.col("chunk").cast("long") * chunk).alias("start"),
            ((F.col("chunk") + 1) * chunk >= F.col("n")).alias("last"),
            F.substring("text", F.col("chunk") * chunk + 1, F.lit(chunk + overlap)).alias("piece"),
        )
        .repartition("row", "chunk")
        .mapInArrow(
            pre_tokenise,
            f"row long, doc_id {kind}, chunk int, start long, last boolean, piece string, "
            "head array<long>, tail array<long>",
        )
    )
    order = Window.partitionBy("row").orderBy("chunk")
    common = F.array_min(F.array_intersect(F.lag("tail").over(order), F.col("head")))
    stitched = (
        chunks.withColumn("cut", F.when(F.col("chunk") == 0, F.lit(0)).otherwise(common))
        .withColumn("until", F.lead("cut").over(order))
        .withColumn("apart", F.max(F.col("cut").isNull()).over(Window.partitionBy("row")))
    )

    def encode_pieces(part):
        encoding = _encoding(ranks_path, pattern)

        def run(batch):
            out = []
            for start, cut, until, apart, text in zip(
                *(batch[c].to_pylist() for c in ("start", "cut", "until", "apart", "piece"))
            ):
                if apart:  # the chunk's own text, to be put together again
                    out.append(text[:chunk].encode())
                else:
                    out.append(_encode(encoding, text[cut - start : None if until is None else until - start], pattern))
            return pa.RecordBatch.from_pydict(
                {**{c: batch[c] for c in ("row", "doc_id", "chunk", "apart")}, "part": pa.array(out, pa.binary())}
            )

        return batches(part, run)

    pieces = stitched.select("row", "doc_id", "chunk", "start", "cut", "until", "apart", "piece").mapInArrow(
        encode_pieces, f"row long, doc_id {kind}, chunk int, apart boolean, part binary"
    )
    joined = pieces.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("apart").alias("apart"),
        F.sort_array(F.collect_list(F.struct("chunk", "part"))).getField("part").alias("parts"),
    )

    def join_parts(part):
        encoding = _encoding(ranks_path, pattern)

        def run(batch):
            out = []
            for apart, parts in zip(batch["apart"].to_pylist(), batch["parts"].to_pylist()):
                whole_part = b"".join(parts)
                out.append(_encode(encoding, whole_part.decode(), pattern) if apart else whole_part)
            return pa.RecordBatch.from_pydict(
                {"doc_id": batch["doc_id"], "ids": pa.array(out, pa.binary())}
            )

        return batches(part, run)

    long = joined.select("doc_id", "apart", "parts").mapInArrow(join_parts, f"doc_id {kind}, ids binary")
    return short.unionByName(long).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids"
    )


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """The encoded rows with the raw bytes of their ids as ``decoded``; an unknown id is an error."""
    fields = ", ".join(f"`{n}` {t}" for n, t in encoded.dtypes)

    def run_all(part):
        table = _token_bytes(ranks_path)

        def run(batch):
            out = [
                b"".join([table[i] for i in np.frombuffer(ids, "<u4").tolist()])
                for ids in batch["ids"].to_pylist()
            ]
            return pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(out, pa.binary())], [*batch.schema.names, "decoded"]
            )

        return batches(part, run)

    return encoded.mapInArrow(run_all, f"{fields}, decoded binary")


def encoder(ranks_path: str, pattern: str = public_tokenizers.PATTERN):
    """For use in a task: gives the function from a whole text to its ids."""
    def make():
        encoding = _encoding(ranks_path, pattern)
        return lambda text: encode_text(encoding, text, pattern)

    return make
