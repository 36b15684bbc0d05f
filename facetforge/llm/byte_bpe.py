"""Byte-level BPE with a local rank file, by the tiktoken library.

Long texts are cut before they are encoded, at places where no match of the
splitting pattern can reach across, so the ids are those of the whole text.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator, Sequence

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from facetforge.llm.common import map_in_arrow, quoted, without

RANK_FILE = "byte_bpe_50k.tiktoken"
# Texts above this many characters are cut into pieces of about this length.
PIECE_CHARS = 16_384
# Rows are handed on when their ids and bytes reach this size.
OUTPUT_BYTES = 4 << 20

# A single space between two characters that are no white space: what stands
# before it ends there, and the space can only begin the next match.
_SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")


def rank_bytes(path: str | None = None) -> bytes:
    """The rank file, read on the driver and sent to the tasks (under 1 MB)."""
    with open(path or public_tokenizers.path(RANK_FILE), "rb") as file:
        return file.read()


def encoding_of(ranks: bytes, pattern: str = public_tokenizers.PATTERN) -> tiktoken.Encoding:
    pairs = (line.split() for line in ranks.splitlines() if line)
    table = {base64.b64decode(token): int(rank) for token, rank in pairs}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def safe_pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """The text in pieces of at least ``size`` characters that tokenise apart
    exactly as together. A text without a safe place stays whole."""
    start = 0
    while len(text) - start > size:
        cut = _SAFE_CUT.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def encode(encoding: tiktoken.Encoding, text: str) -> list[int]:
    """The ids of the whole text, without special tokens."""
    if len(text) <= PIECE_CHARS:
        return encoding.encode_ordinary(text)
    return [i for piece in safe_pieces(text) for i in encoding.encode_ordinary(piece)]


def encode_compact(encoding: tiktoken.Encoding, text: str) -> np.ndarray:
    """The same ids, four bytes each."""
    parts = [
        encoding.encode_to_numpy(piece, disallowed_special=()).astype(np.int32)
        for piece in ([text] if len(text) <= PIECE_CHARS else safe_pieces(text))
    ]
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def _lists(values: list[np.ndarray]) -> pa.Array:
    """Arrays of numbers as one list array."""
    ends = np.cumsum([0, *map(len, values)], dtype=np.int32)
    flat = np.concatenate(values) if values else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()))


def _slices(rows: Iterator[tuple[int, tuple, int]]) -> Iterator[list[tuple[int, tuple]]]:
    """Consecutive rows in lists of about OUTPUT_BYTES."""
    held, size = [], 0
    for place, row, weight in rows:
        held.append((place, row))
        size += weight
        if size >= OUTPUT_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def _map_rows(
    df: DataFrame, source: str, fields: list[T.StructField], row_of, keep: Sequence[str] | None = None
) -> DataFrame:
    """Add ``fields`` computed from one column by ``row_of(values)``, an iterator
    of (row, bytes). The output leaves in small batches whatever the input's. Of
    the input, the columns in ``keep`` come back, all without it."""
    kept = without(df.schema, [f.name for f in fields])
    if keep is not None:
        kept = [f for f in kept if f.name in set(keep)]
    schema = T.StructType([*kept, *fields])
    df = df.select(*[quoted(f.name) for f in kept], quoted(source))
    names, place = schema.names, len(kept)
    keep_places = range(len(kept))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = row_of()
        for batch in batches:
            rows = ((i, *make(v)) for i, v in enumerate(batch.column(place)))
            for held in _slices(rows):
                first = held[0][0]
                old = [batch.column(k).slice(first, len(held)) for k in keep_places]
                columns = [list(values) for values in zip(*(r for _, r in held), strict=True)]
                new = [
                    _lists(values) if kind is None else pa.array(values, kind)
                    for values, kind in zip(columns, kinds, strict=True)
                ]
                yield pa.RecordBatch.from_arrays([*old, *new], names=names)

    arrow = {
        T.StringType(): pa.string(),
        T.LongType(): pa.int64(),
        T.BinaryType(): pa.binary(),
        T.ArrayType(T.IntegerType()): None,
    }
    kinds = [arrow[f.dataType] for f in fields]
    return map_in_arrow(df, run, schema)


def encode_documents(
    docs: DataFrame,
    text_column: str = "text",
    ids_column: str = "ids",
    rank_file: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """The rows with the ids of their text as array<int> in ``ids_column``; with
    ``keep``, only these columns of the input, so that texts need not come back.

    Every match of the pattern is encoded by itself; texts like ``<|name|>`` are
    ordinary text. NULL and empty texts have no ids. A column already named
    like the new one is replaced. Rows, ties and repeats are kept as they are.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(rank_bytes(rank_file))

    def row_of():
        encoding = encoding_of(ranks.value, pattern)

        def make(value):
            ids = encode_compact(encoding, value.as_py() or "")
            return (ids,), 4 * len(ids) + 64

        return make

    field = T.StructField(ids_column, T.ArrayType(T.IntegerType()))
    return _map_rows(docs, text_column, [field], row_of, keep)


def decode_documents(
    rows: DataFrame,
    ids_column: str = "ids",
    bytes_column: str = "decoded",
    rank_file: str | None = None,
) -> DataFrame:
    """The rows with the raw bytes of their ids in ``bytes_column``.

    Bytes need not be valid UTF-8 when ids were cut in the middle of a
    character, so they stay bytes. NULL ids decode to no bytes; an id outside
    the rank file is an error.
    """
    ranks = rows.sparkSession.sparkContext.broadcast(rank_bytes(rank_file))

    def row_of():
        encoding = encoding_of(ranks.value)

        def make(value):
            raw = encoding.decode_bytes(value.as_py() or [])
            return (raw,), len(raw)

        return make

    return _map_rows(rows, ids_column, [T.StructField(bytes_column, T.BinaryType())], row_of)


def round_trip(
    docs: DataFrame,
    text_column: str = "text",
    rank_file: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """The rows with n_tokens, ids_sha256 and decoded_sha256: ids and decoded
    bytes as of encode_documents and decode_documents, digested in the task that
    makes them, so that neither travels through Spark.

    ids_sha256 digests the ids in decimals, joined by a space.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(rank_bytes(rank_file))

    def row_of():
        encoding = encoding_of(ranks.value, pattern)
        decimals = [str(i) for i in range(encoding.n_vocab)]

        def make(value):
            ids = encode(encoding, value.as_py() or "")
            written = " ".join([decimals[i] for i in ids]).encode()
            raw = encoding.decode_bytes(ids)
            row = (len(ids), hashlib.sha256(written).hexdigest(), hashlib.sha256(raw).hexdigest())
            return row, 200

        return make

    fields = [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
    return _map_rows(docs, text_column, fields, row_of)
