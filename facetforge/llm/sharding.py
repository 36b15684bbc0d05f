"""Records in random order, in shards of equal numbers of records.

A two-pass external shuffle. The first pass scatters the records by seeded
hashes over buckets that fit in memory. The second one shuffles each bucket by
Fisher-Yates and writes it. Buckets stand one after another in the new order, so
a shard is a run of it: a bucket goes to one shard, or to two neighbours.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetforge.llm.common import plain_text, quoted, spare_name
from facetforge.storage import fresh_path

LAW = "rows"
SHARDS = 8
# Bytes of text in a bucket. Tables of more than MAX_BUCKETS such buckets get
# larger ones: a bucket is a task of the second pass and is held in its memory.
BUCKET_BYTES = 16 << 20
MAX_BUCKETS = 1 << 16
# Hash values told apart when records are counted; buckets are ranges of them.
CELLS = 1 << 16
# A cell is hot, and its records are scattered once more, if it holds a bucket's
# bytes and so many times the mean.
HOT_TIMES = 8
# Bytes that a record takes besides its text.
RECORD_BYTES = 64


def _scatter(id_column: str, text_column: str, seed: int, *more: Column) -> Column:
    """A hash of what tells records apart."""
    return F.xxhash64(F.lit(seed), quoted(id_column), plain_text(text_column), *more)


def _cell(hashed: Column) -> Column:
    return F.pmod(hashed, F.lit(CELLS)).cast("int")


def _count_cells(docs: DataFrame, hashed: Column, text_column: str) -> list:
    """(cell, records, bytes) of all cells: CELLS numbers at most reach the driver."""
    size = F.octet_length(plain_text(text_column)) + F.lit(RECORD_BYTES)
    counted = docs.select(_cell(hashed).alias("cell"), size.alias("size"))
    return (
        counted.groupBy("cell")
        .agg(F.count("*").alias("records"), F.sum("size").alias("bytes"))
        .orderBy("cell")
        .collect()
    )


def shuffle_records(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shards: int = SHARDS,
    seed: int = 13,
    bucket_bytes: int = BUCKET_BYTES,
    shard_column: str = "shard",
    slot_column: str = "slot",
) -> DataFrame:
    """The rows with shard (0 to ``shards`` - 1) and slot, their place in it, 0
    first and without gaps. Numbers of rows in the shards differ by one at most.

    The order depends on ids, texts and the seed. Equal ids and texts, of which
    there may be any number, are scattered by their place in the input besides;
    such an input should be a stored table, so that repeated tasks find the same
    places. NULL ids and NULL, empty and long texts are records like others; a
    record is never split, so a bucket is as large as its longest record at
    least. Columns named like the new ones are replaced. An empty table gives an
    empty table.
    """
    gone = {shard_column.lower(), slot_column.lower()}
    kept = [c for c in docs.columns if c.lower() not in gone]
    rows = docs.select(*[quoted(c) for c in kept])
    if {id_column.lower(), text_column.lower()} & gone:
        raise ValueError("id and text cannot have the names of the new columns")
    hashed = _scatter(id_column, text_column, seed)
    cells = _count_cells(rows, hashed, text_column)
    records = sum(c["records"] for c in cells)
    total = sum(c["bytes"] for c in cells)
    hot = [c["cell"] for c in cells if c["bytes"] > max(bucket_bytes, HOT_TIMES * total // CELLS)]
    if hot:
        # Only the records of few cells need their place.
        place = _scatter(id_column, text_column, seed, F.monotonically_increasing_id())
        hashed = F.when(_cell(hashed).isin(hot), place).otherwise(hashed)
        cells = _count_cells(rows, hashed, text_column)
    buckets = max(1, min(MAX_BUCKETS, -(-total // bucket_bytes)))

    # Records before each bucket.
    sizes = [0] * buckets
    for c in cells:
        sizes[c["cell"] * buckets // CELLS] += c["records"]
    starts, before = [], 0
    for size in sizes:
        starts.append(before)
        before += size
    bucket_name = spare_name(docs, "_bucket", kept)
    hash_name = spare_name(docs, "_hash", kept)
    # One constant array, so that no table has to be joined.
    first_of = F.split(F.lit(",".join(map(str, starts))), ",").cast("array<bigint>")

    # First pass. A partition is a bucket, so the seed of a bucket's shuffle,
    # which Spark adds the number of the partition to, is its own.
    scattered = rows.withColumn(hash_name, hashed)
    bucket = F.floor(_cell(F.col(hash_name)).cast("long") * F.lit(buckets) / F.lit(CELLS)).cast("int")
    scattered = scattered.withColumn(bucket_name, bucket).repartitionById(
        buckets, F.col(bucket_name)
    )
    # Second pass: one order for all runs, then Fisher-Yates (F.shuffle).
    record = F.struct(F.col(hash_name).alias("hash"), F.struct(*[quoted(c) for c in kept]).alias("row"))
    by_hash = F.array_sort(
        F.collect_list(record),
        lambda a, b: F.when(a["hash"] < b["hash"], -1).when(a["hash"] > b["hash"], 1).otherwise(0),
    )
    shuffled = scattered.groupBy(bucket_name).agg(by_hash.alias("records"))
    placed = shuffled.select(
        bucket_name, F.posexplode(F.shuffle("records", F.lit(seed))).alias("place", "record")
    )
    number = F.get(first_of, F.col(bucket_name)) + F.col("place")
    shard = F.floor(((number + 1) * F.lit(shards) - 1) / F.lit(max(1, records))).cast("int")
    first = F.floor(shard.cast("long") * F.lit(records) / F.lit(shards)).cast("long")
    return placed.select(
        *[F.col("record.row").getField(c).alias(c) for c in kept],
        shard.alias(shard_column),
        (number - first).alias(slot_column),
    )


def write_shards(shuffled: DataFrame, path: str, shard_column: str = "shard") -> None:
    """One folder for each shard. A task writes one bucket, so it opens a file
    for one shard or two."""
    shuffled.write.partitionBy(shard_column).parquet(path)


def shard_documents(docs: DataFrame, shards: int = SHARDS, seed: int = 13, **names) -> DataFrame:
    """Shuffle, write the shards to the shared folder and read them back: the
    rows of ``shuffle_records``."""
    shuffled = shuffle_records(docs, shards=shards, seed=seed, **names)
    column = names.get("shard_column", "shard")
    path = fresh_path(docs.sparkSession, "shards")
    write_shards(shuffled, path, column)
    schema = shuffled.schema
    return docs.sparkSession.read.schema(schema).parquet(path).select(
        *[quoted(c) for c in shuffled.columns]
    )
