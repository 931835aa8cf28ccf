"""Token ids of a whole corpus by a public byte-level BPE tokenizer.

Method: overlapping chunk encoding, for texts of any length. A text is cut into overlapping chunks, each pre-tokenised on
its own. Pre-token boundaries depend on what comes before only up to the last change from anything but white space to
white space, which no pre-token spans; so a chunk's boundaries are the text's own from its first such place on. Where a
chunk and the one before it have a boundary in common in their overlap they are stitched; where they have none (a word
longer than the overlap) they form one piece. The pieces between the stitches are then encoded. Merges never cross
pre-tokens, so the ids are those of the whole text. Decoding concatenates raw bytes.

The chunks of a text are worked on where the text is; those of a very long one are spread over tasks. Both use the same
functions.
"""

from __future__ import annotations

import base64
import hashlib
import os
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut

TOKENIZERS = os.environ.get("PULSEGRID_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k.tiktoken"
# Fixed value: the pattern that splits text into pre-tokens before the merges of this vocabulary.
PRE_TOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CHUNK, OVERLAP = 1024, 64  # characters
SPREAD = 256  # chunks from which on a text is spread over tasks
EDGE = 2  # boundaries next to a chunk's end may still move, as the text goes on


def load_vocabulary(spark: SparkSession, folder: str = TOKENIZERS, name: str = VOCABULARY) -> Broadcast:
    """The rank file (under 1 MB, fixed) for all executors; they need no copy of their own."""
    with open(os.path.join(folder, name), "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def _encoding(ranks: bytes):
    """The encoder, built once per Python worker."""
    import tiktoken

    held = sys.__dict__.setdefault("_pulsegrid_encodings", {})
    key = hashlib.md5(ranks).hexdigest()
    if key not in held:
        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        held[key] = tiktoken.Encoding(key, pat_str=PRE_TOKEN, mergeable_ranks=merges, special_tokens={})
    return held[key]


def _patterns():
    """The patterns of pre-tokens and of sure boundaries; classes are spelled out, as libraries differ in what counts as white space."""
    import regex

    held = sys.__dict__.setdefault("_pulsegrid_patterns", {})
    if not held:
        space = r"\p{White_Space}"
        held[0] = regex.compile(PRE_TOKEN.replace(r"[^\s", rf"[^{space}").replace(r"\s", space).replace(r"\S", r"\P{White_Space}"))
        held[1] = regex.compile(r"\P{White_Space}\p{White_Space}")
    return held[0], held[1]


def boundaries(text: str, start: int = 0) -> list[int]:
    """Where pre-tokens begin in ``text``, scanned from ``start``."""
    return [m.start() for m in _patterns()[0].finditer(text, start)]


def chunk_span(k: int, n: int, chunk: int, overlap: int) -> tuple[int, int]:
    """Where chunk ``k`` of a text of ``n`` characters begins and ends, overlaps included."""
    return max(0, k * chunk - overlap), min(n, (k + 1) * chunk + overlap)


def mark(piece: str, k: int, n: int, chunk: int, overlap: int) -> tuple[list[int], list[int]]:
    """A chunk's boundaries in the overlap with the chunk before and, if they are sure, in that with the next one.

    Positions count from the text's beginning.
    """
    at, _ = chunk_span(k, n, chunk, overlap)
    found = boundaries(piece)
    # a piece must not end in white space: how that is split depends on what follows it
    sure = [b for b in found[: len(found) - EDGE] if b and not piece[b - 1].isspace()]
    left = [at + b for b in sure if at + b < k * chunk + overlap] if k else [0]
    first = _patterns()[1].search(piece)
    known = 0 if not k else (first.start() + 1 if first else len(piece))
    right = [at + b for b in sure if b >= known and at + b >= (k + 1) * chunk - overlap]
    return left, right


def n_chunks(n: int, chunk: int) -> int:
    return max(1, -(-n // chunk))


def _in_place(text: str, chunk: int, overlap: int) -> list[str]:
    """The pieces of a text."""
    n = len(text)
    if n <= chunk:
        return [text] if text else []
    starts, before = [0], None
    for k in range(n_chunks(n, chunk)):
        a, b = chunk_span(k, n, chunk, overlap)
        left, right = mark(text[a:b], k, n, chunk, overlap)
        if before is not None and (common := set(left) & before):
            starts.append(min(common))
        before = set(right)
    return [text[a:b] for a, b in zip(starts, [*starts[1:], n], strict=True)]


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays).astype(np.int32) if arrays else np.zeros(0, np.int32)))


def _encode_texts(vocabulary: Broadcast, chunk: int, overlap: int):
    """(key, text) to (key, ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoding(vocabulary.value)
        for batch in batches:
            ids = []
            for text in batch.column(1).to_pylist():
                parts = [enc.encode_to_numpy(p, disallowed_special=()) for p in _in_place(text, chunk, overlap)]
                ids.append(parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.zeros(0, np.uint32))
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(ids)], names=[batch.schema.names[0], "ids"])

    return run


def _cut_rows(chunk: int, overlap: int):
    """(row, text) to (row, k, n, piece): every chunk once."""
    schema = pa.schema([("row", pa.int64()), ("k", pa.int32()), ("n", pa.int32()), ("piece", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                n = len(text)
                for first in range(0, n_chunks(n, chunk), 4096):
                    rows = [{"row": row, "k": k, "n": n, "piece": text[slice(*chunk_span(k, n, chunk, overlap))]} for k in range(first, min(first + 4096, n_chunks(n, chunk)))]
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return run


def _mark_rows(chunk: int, overlap: int):
    """Adds ``left`` and ``right`` to (row, k, n, piece)."""
    places = pa.list_(pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [mark(p, k, n, chunk, overlap) for k, n, p in zip(*(batch.column(c).to_pylist() for c in (1, 2, 3)), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([x[0] for x in found], places), pa.array([x[1] for x in found], places)], names=["row", "k", "n", "piece", "left", "right"])

    return run


def _encode_pieces(vocabulary: Broadcast, chunk: int, overlap: int):
    """(row, g, begin, end, parts): the ids of a text from ``begin`` to ``end``; ``parts`` are the chunks from g on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoding(vocabulary.value)
        for batch in batches:
            ids = []
            for r in batch.to_pylist():
                at = max(0, r["g"] * chunk - overlap)
                whole = r["parts"][0] + "".join(p[2 * overlap :] for p in r["parts"][1:])
                ids.append(enc.encode_to_numpy(whole[r["begin"] - at : r["end"] - at], disallowed_special=()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _lists(ids)], names=["row", "g", "ids"])

    return run


def encode_corpus(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", folder: str = TOKENIZERS, vocabulary: str = VOCABULARY, chunk: int = CHUNK, overlap: int = OVERLAP, spread: int = SPREAD
) -> DataFrame:
    """Columns ``doc_id`` and ``ids`` (array of int), one row per row of ``docs``; no special tokens.

    Null and empty texts have an empty list of ids. Repeated rows and null ids stay as they are. Positions count
    characters. Texts of more than ``spread`` chunks are encoded by many tasks; their ids are the same.
    """
    if chunk < 4 * overlap:
        raise ValueError("a chunk must span at least four overlaps")
    bc = load_vocabulary(docs.sparkSession, folder, vocabulary)
    id_type = dict(docs.dtypes)[doc_id]
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    is_long = F.length("text") > spread * chunk
    near = rows.filter(~is_long).mapInArrow(_encode_texts(bc, chunk, overlap), f"doc_id {id_type}, ids array<int>")

    # very long texts are few: set aside they spare further scans, and a row number set down tells equal rows apart
    long = cut(rows.filter(is_long).withColumn("row", F.monotonically_increasing_id()))
    chunks = long.select("row", "text").mapInArrow(_cut_rows(chunk, overlap), "row long, k int, n int, piece string").repartition("row", "k")
    marks = cut(chunks.mapInArrow(_mark_rows(chunk, overlap), "row long, k int, n int, piece string, left array<int>, right array<int>"))
    before = marks.select("row", (F.col("k") + 1).alias("k"), F.col("right").alias("before"))
    met = marks.select("row", "k", "left").join(before, ["row", "k"], "left")
    begins = met.select("row", "k", F.when(F.col("k") == 0, F.lit(0)).otherwise(F.array_min(F.array_intersect("left", "before"))).alias("begin"))
    # chunks without a stitch belong to the piece of the last one that has; these rows are numbers only
    w = Window.partitionBy("row").orderBy("k")
    grouped = begins.withColumn("g", F.max(F.when(F.col("begin").isNotNull(), F.col("k"))).over(w))
    ends = begins.filter("begin is not null").select("row", F.col("k").alias("g"), "begin", F.lead("begin").over(w).alias("end"))
    parts = marks.select("row", "k", "n", "piece").join(grouped.select("row", "k", "g"), ["row", "k"]).groupBy("row", "g").agg(F.max("n").alias("n"), F.transform(F.array_sort(F.collect_list(F.struct("k", "piece"))), lambda x: x["piece"]).alias("parts"))
    pieces = parts.join(ends, ["row", "g"]).select("row", "g", "begin", F.coalesce("end", "n").alias("end"), "parts")
    encoded = pieces.mapInArrow(_encode_pieces(bc, chunk, overlap), "row long, g int, ids array<int>").groupBy("row").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("g", "ids"))), lambda x: x["ids"])).alias("ids"))
    return near.unionByName(long.select("doc_id", "row").join(encoded, "row").select("doc_id", "ids")).withColumnRenamed("doc_id", doc_id)


def decode_ids(encoded: DataFrame, *, ids: str = "ids", folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """Replace ``ids`` by ``text``: the tokens' raw bytes put together, then read as UTF-8. No ids give ''."""
    bc = load_vocabulary(encoded.sparkSession, folder, vocabulary)
    rest = [c for c in encoded.columns if c != ids]
    schema = ", ".join(f"`{c}` {t}" for c, t in encoded.select(*rest).dtypes) + ", text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoding(bc.value)
        for batch in batches:
            texts = pa.array([enc.decode_bytes(x or []).decode("utf-8", "replace") for x in batch.column(batch.num_columns - 1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], texts], names=[*rest, "text"])

    return encoded.select(*rest, ids).mapInArrow(run, schema)
