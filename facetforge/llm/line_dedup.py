"""Drop lines that many documents repeat.

Two Bloom filters say which line keys may occur in two documents or more. Only
the lines they suspect are shuffled; a count over those is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facetforge.llm.common import (
    SPACE_BYTES,
    as_bytes,
    map_in_arrow,
    plain_text,
    quoted,
    spare_name,
    without,
)
from facetforge.storage import materialise

# Bits of a filter for each line, and the bits that a key sets.
BITS_PER_LINE = 12
BITS_PER_KEY = 4
# Filters never exceed this (32 MB); beyond it more lines are suspected and
# shuffled, and the result stays exact.
MAX_FILTER_BITS = 1 << 28
_SEGMENT_WORDS = 1024


def line_key(line: bytes) -> bytes:
    """The line without white space at its ends, A-Z in lower case."""
    return line.strip(SPACE_BYTES).lower()


def long_enough(key: bytes, min_chars: int) -> bool:
    """Whether the key has ``min_chars`` code points."""
    if len(key) < min_chars:
        return False
    return len(key) >= 4 * min_chars or len(key.decode("utf-8", "replace")) >= min_chars


def _keys(text: bytes, min_chars: int) -> set[bytes]:
    keys = {line_key(line) for line in text.split(b"\n")}
    return {k for k in keys if long_enough(k, min_chars)}


class RepeatFilter:
    """Which keys were seen once, and which may have been seen twice.

    A key sets BITS_PER_KEY bits in one 64-bit word. ``add`` takes the keys of
    different documents; equal keys in one call count as seen twice.
    """

    def __init__(self, words: int):
        self.once = np.zeros(words, np.uint64)
        self.twice = np.zeros(words, np.uint64)

    @staticmethod
    def places(hashes: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
        """The word and the bits of each key."""
        word = ((hashes >> np.uint64(24)) % np.uint64(words)).astype(np.int64)
        bits = np.zeros(len(hashes), np.uint64)
        for i in range(BITS_PER_KEY):
            bits |= np.uint64(1) << ((hashes >> np.uint64(6 * i)) & np.uint64(63))
        return word, bits

    def add(self, hashes: np.ndarray) -> None:
        keys, counts = np.unique(hashes, return_counts=True)
        word, bits = self.places(keys, len(self.once))
        again = (counts > 1) | ((self.once[word] & bits) == bits)
        np.bitwise_or.at(self.twice, word[again], bits[again])
        np.bitwise_or.at(self.once, word, bits)


def may_contain(filter_words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    word, bits = RepeatFilter.places(hashes, len(filter_words))
    return (filter_words[word] & bits) == bits


def merge_filters(once: np.ndarray, twice: np.ndarray, more_once: np.ndarray, more_twice: np.ndarray):
    """What is seen once on both sides is seen twice."""
    return once | more_once, twice | more_twice | (once & more_once)


def _pack(words: np.ndarray) -> bytes:
    return pa.compress(words.tobytes(), codec="zstd", asbytes=True)


def _unpack(packed: bytes) -> np.ndarray:
    raw = pa.decompress(packed, decompressed_size=8 * _SEGMENT_WORDS, codec="zstd", asbytes=True)
    return np.frombuffer(raw, np.uint64)


_SEGMENTS = "segment int, once binary, twice binary"


def _twice_filter(texts: DataFrame, words: int, min_chars: int) -> np.ndarray:
    """The filter of keys that may occur in two documents. Every task fills a
    filter of its own; the pieces are merged segment by segment, one segment of
    a few kilobytes in memory at a time."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = RepeatFilter(words)
        for batch in batches:
            hashes = [
                xxhash.xxh3_64_intdigest(k)
                for text in as_bytes(batch.column(0))
                for k in _keys(text, min_chars)
            ]
            seen.add(np.array(hashes, np.uint64))
        for first in range(0, words, _SEGMENT_WORDS):
            once = seen.once[first : first + _SEGMENT_WORDS]
            if once.any():
                twice = seen.twice[first : first + _SEGMENT_WORDS]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([first // _SEGMENT_WORDS], pa.int32()),
                        pa.array([_pack(once)], pa.binary()),
                        pa.array([_pack(twice)], pa.binary()),
                    ],
                    names=["segment", "once", "twice"],
                )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(segment, once, twice):
            return pa.RecordBatch.from_arrays(
                [pa.array([segment], pa.int32()), *(pa.array([_pack(x)], pa.binary()) for x in (once, twice))],
                names=["segment", "once", "twice"],
            )

        current, state = None, None
        for batch in batches:
            for segment, once, twice in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if segment != current:
                    if state is not None:
                        yield done(current, *state)
                    current, state = segment, (_unpack(once), _unpack(twice))
                else:
                    state = merge_filters(*state, _unpack(once), _unpack(twice))
        if state is not None:
            yield done(current, *state)

    pieces = texts.mapInArrow(build, _SEGMENTS)
    merged = (
        pieces.repartition(F.col("segment")).sortWithinPartitions("segment").mapInArrow(merge, _SEGMENTS)
    )
    # At most MAX_FILTER_BITS reach the driver.
    twice = np.zeros(words, np.uint64)
    for row in merged.select("segment", "twice").toLocalIterator():
        first = row["segment"] * _SEGMENT_WORDS
        twice[first : first + _SEGMENT_WORDS] = _unpack(row["twice"])
    return twice


def repeated_lines(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_docs: int = 3,
    min_chars: int = 20,
    max_filter_bits: int = MAX_FILTER_BITS,
) -> tuple[DataFrame, DataFrame]:
    """(suspects, repeated): ``suspects`` has (id, key) once for every document
    and suspected key, ``repeated`` has (key, keeper) for the keys that at
    least ``min_docs`` ids hold, with the largest of these ids."""
    if min_docs < 2:
        raise ValueError("a repeated line needs two documents at least")
    spark = docs.sparkSession
    rows = docs.select(quoted(id_column).alias("id"), plain_text(text_column).alias("text"))
    newline = F.lit("\n")
    lines = rows.agg(
        F.sum(F.length("text") - F.length(F.replace("text", newline, F.lit(""))) + 1)
    ).first()[0]
    bits = min(max_filter_bits, BITS_PER_LINE * (lines or 1))
    words = -(-bits // (64 * _SEGMENT_WORDS)) * _SEGMENT_WORDS
    shared = spark.sparkContext.broadcast(_twice_filter(rows.select("text"), words, min_chars))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = shared.value
        for batch in batches:
            row, hashes, digests = [], [], []
            for i, text in enumerate(as_bytes(batch.column(1))):
                keys = list(_keys(text, min_chars))
                row.extend([i] * len(keys))
                hashes.extend(map(xxhash.xxh3_64_intdigest, keys))
                digests.extend(keys)
            hit = np.flatnonzero(may_contain(twice, np.array(hashes, np.uint64)))
            ids = batch.column(0).take(pa.array(np.array(row, np.int64)[hit]))
            found = pa.array([hashlib.sha256(digests[i]).digest() for i in hit], pa.binary())
            yield pa.RecordBatch.from_arrays([ids, found], names=["id", "key"])

    schema = T.StructType([rows.schema["id"], T.StructField("key", T.BinaryType())])
    suspects = materialise(rows.mapInArrow(probe, schema), "line-suspects")
    counts = suspects.groupBy("key").agg(
        F.count_distinct("id").alias("n"), F.max("id").alias("keeper")
    )
    # Written out, so that the join below reads both sides plainly and a key
    # held by very many documents can be split.
    repeated = counts.filter(F.col("n") >= min_docs).select("key", "keeper")
    return suspects, materialise(repeated, "repeated-lines")


def dedup_lines(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_docs: int = 3,
    min_chars: int = 20,
    max_filter_bits: int = MAX_FILTER_BITS,
) -> DataFrame:
    """The documents with repeated lines removed from their texts, and two more
    columns: n_lines (before) and n_dropped.

    Texts are split at ``\\n``. A line's key is the line without white space at
    both ends, A-Z in lower case. Keys with at least ``min_chars`` code points
    that at least ``min_docs`` documents hold keep their lines only in the
    largest id that holds them (all of them there).

    NULL and empty texts have one empty line and stay empty. A line repeated
    within one document counts once. Rows with the same id are one document; a
    row without id counts for no line and keeps none of the repeated ones.
    Columns of the input named n_lines or n_dropped are replaced. An empty table
    gives an empty table.
    """
    suspects, repeated = repeated_lines(
        docs, id_column, text_column, min_docs, min_chars, max_filter_bits
    )
    kept = without(docs.schema, ["n_lines", "n_dropped"])
    key, drop = spare_name(docs, "_line_id"), spare_name(docs, "_line_drop")
    gone = (
        suspects.join(repeated, "key")
        .filter(~F.col("id").eqNullSafe(F.col("keeper")))
        .groupBy(F.col("id").alias(key))
        .agg(F.collect_set("key").alias(drop))
    )
    columns = [quoted(f.name) for f in kept]
    marked = (
        docs.select(*columns)
        .join(gone, quoted(id_column).eqNullSafe(F.col(key)), "left")
        .select(*columns, F.col(drop))
    )
    place = [f.name for f in kept].index(text_column)

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, before, dropped = [], [], []
            for text, drops in zip(as_bytes(batch.column(place)), batch.column(len(kept)).to_pylist(), strict=True):
                lines = text.split(b"\n")
                before.append(len(lines))
                if drops:
                    drops = set(drops)
                    lines = [
                        x
                        for x in lines
                        if not (
                            long_enough(k := line_key(x), min_chars)
                            and hashlib.sha256(k).digest() in drops
                        )
                    ]
                dropped.append(before[-1] - len(lines))
                texts.append(b"\n".join(lines))
            arrays = batch.columns[: len(kept)]
            arrays[place] = pa.array(texts, pa.binary()).cast(pa.string(), safe=False)
            arrays += [pa.array(before, pa.int64()), pa.array(dropped, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    out = T.StructType(
        [
            *(T.StructField(f.name, T.StringType()) if i == place else f for i, f in enumerate(kept)),
            T.StructField("n_lines", T.LongType()),
            T.StructField("n_dropped", T.LongType()),
        ]
    )
    names = out.names
    return map_in_arrow(marked, rebuild, out)
