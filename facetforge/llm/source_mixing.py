"""Mix the documents of several sources to target weights.

Tokens are summed per source; each source gets a target and so a repetition
rate. A document is taken floor(rate) times, and once more if a hash of its id
falls below the fraction of the rate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetforge.llm.common import WORD_PATTERN, plain_text, quoted, spare_name
from facetforge.operators.ordering import number_rows
from facetforge.storage import materialise

# Hex digits of the hash that make the random number: 52 bits, exact as double.
_HASH_DIGITS = 13


def word_count(text_column: str) -> Column:
    """Number of words between white space; 0 for NULL."""
    return F.regexp_count(plain_text(text_column), F.lit(WORD_PATTERN)).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """(source, source_size, target) for a table of (source, size).

    Sources in code-point order, NULL last, weigh ``weights``, repeating. Their
    targets share ``share`` times all sizes. No target exceeds ``most`` times
    the size of its source; what is over is reshared by weight among the others
    until none is above.
    """
    if not 0 < share <= most:
        raise ValueError("the share must be above 0 and not above the most a source may give")
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = number_rows(totals, [F.col("source").asc_nulls_last()], "rank")
    wheel = F.array(*[F.lit(w) for w in weights])
    place = (F.col("rank") - 1) % F.lit(len(weights)) + 1
    table = materialise(
        ranked.select("source", "source_size", F.element_at(wheel, place.cast("int")).alias("weight")),
        "mix-sources",
    )
    # Resharing raises the common level (target by weight) from round to round;
    # sources once at their limit stay there. Only sums come to the driver.
    limit = F.lit(most) * F.col("source_size")
    total, weight = table.agg(F.sum("source_size"), F.sum("weight")).first()
    level, capped = (share * total / weight if weight else 0.0), 0
    while True:
        over = F.lit(level) * F.col("weight") > limit
        count, size, free = table.agg(
            F.count_if(over),
            F.coalesce(F.sum(F.when(over, F.col("source_size"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)),
        ).first()
        if count == capped or not free:
            break
        capped, level = count, (share * total - most * size) / free
    return table.select(
        "source",
        "source_size",
        F.least(F.lit(level) * F.col("weight"), limit).cast("double").alias("target"),
    )


def draw(id_column: str, text_column: str, seed: int) -> Column:
    """A number in [0, 1) from the hash of the id; rows without id use their
    text."""
    key = F.coalesce(quoted(id_column).cast("string"), plain_text(text_column))
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key).cast("binary")), 1, _HASH_DIGITS)
    return F.conv(digits, 16, 10).cast("long") / F.lit(float(16**_HASH_DIGITS))


def mix_sources(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 7,
) -> DataFrame:
    """The documents with size, source_size, target (of their source) and
    copies: how often the mix takes the document.

    A document is taken floor(rate) times plus once with the fraction of the
    rate as probability, where rate = target / source_size of its source. The
    draw depends on the id and the seed only, so reruns agree.

    NULL texts have size 0. NULL is a source of its own. A source without words
    has rate 0. Repeated ids draw alike; rows without id draw by their text.
    Input columns named like the new ones are replaced. An empty table gives an
    empty table.
    """
    kept = [
        c for c in docs.columns if c.lower() not in ("size", "source_size", "target", "copies")
    ]
    columns = [quoted(c) for c in kept]
    sized = docs.select(*columns, word_count(text_column).alias("size"))
    targets = source_targets(
        sized.select(quoted(source_column).alias("source"), "size"), weights, share, most
    )
    key = spare_name(docs, "_mix_source")
    named = targets.withColumnRenamed("source", key)
    rate = F.when(
        F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(most))
    ).otherwise(0.0)
    whole = F.floor(rate)
    extra = F.when(draw(id_column, text_column, seed) < rate - whole, 1).otherwise(0)
    return sized.join(named, quoted(source_column).eqNullSafe(F.col(key))).select(
        *columns, "size", "source_size", "target", (whole + extra).cast("long").alias("copies")
    )


def repeat_by_copies(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """Every document as often as ``copies`` says, with the given columns."""
    times = F.explode(F.array_repeat(F.lit(True), F.col("copies").cast("int")))
    again = spare_name(mixed, "_again", columns)
    return mixed.select(*[quoted(c) for c in columns], times.alias(again)).drop(again)
