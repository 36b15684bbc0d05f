"""Maximal periodic runs of words, by recompression.

The words of many texts, as numbers, stand in one sequence with a mark of its own
after each text. Rounds of block compression (equal neighbours become one symbol
with a length) and pair compression (two neighbours become one symbol) turn it
into a run-length grammar. Equal stretches are parsed alike but for their edges,
so how far two places agree is found by climbing the levels and coming down
again, a few symbols on each. Every run of period p covers two neighbours of the
grid 0, p, 2p, …; the grid's pairs with equal words are extended to both sides.

Each text is worked on by itself, in the task that reads it: nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from facetforge.llm.common import map_in_arrow, quoted, without

MIN_WORDS = 12  # in a run
# Words compressed together; a longer text is compressed alone.
SLICE_WORDS = 1 << 18
# Pairs of places extended together.
PAIRS_AT_ONCE = 1 << 20
# Texts of up to so many words share one table of grid pairs.
_TABLE_WORDS = 1 << 15


@dataclass
class Level:
    """One sequence of the grammar. ``parent`` is the place on the next level,
    ``opens`` says whether the symbol is the first of its parent, ``first`` is
    the place of the symbol's first child on the level below. ``left`` counts the
    symbols up to the end of the block, this one included (blocks only)."""

    symbols: np.ndarray
    is_block: bool = False
    parent: np.ndarray | None = None
    opens: np.ndarray | None = None
    left: np.ndarray | None = None
    first: np.ndarray | None = None


def _names(keys: np.ndarray, free: int) -> tuple[np.ndarray, int]:
    """Equal keys get one new symbol, different keys different ones."""
    different, number = np.unique(keys, return_inverse=True)
    return number + free, free + len(different)


def _blocks(symbols: np.ndarray, free: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Where blocks begin, the symbols of the next level, and the next free one."""
    opens = np.ones(len(symbols), bool)
    np.not_equal(symbols[1:], symbols[:-1], out=opens[1:])
    starts = np.flatnonzero(opens)
    lengths = np.diff(np.append(starts, len(symbols)))
    upper = symbols[starts].copy()
    long = np.flatnonzero(lengths > 1)
    if len(long):
        # Symbols and lengths stay below 2^31 in a sequence that fits in memory.
        upper[long], free = _names((upper[long] << 31) | lengths[long], free)
    return opens, upper, free


def _pairs(symbols: np.ndarray, free: int, level: int) -> tuple[np.ndarray, np.ndarray, int]:
    """As ``_blocks``, for neighbours of which the first is a left and the second
    a right symbol. A hash of the symbol and the level decides which it is."""
    mixed = (symbols.astype(np.uint64) + np.uint64(level)) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    right = (mixed >> np.uint64(40)) & np.uint64(1) == 1
    opens = np.ones(len(symbols), bool)
    np.logical_not(~right[:-1] & right[1:], out=opens[1:])
    starts = np.flatnonzero(opens)
    upper = symbols[starts].copy()
    paired = np.flatnonzero(np.diff(np.append(starts, len(symbols))) == 2)
    if len(paired):
        at = starts[paired]
        upper[paired], free = _names((symbols[at] << 31) | symbols[at + 1], free)
    return opens, upper, free


def recompress(symbols: np.ndarray, longest: int) -> list[Level]:
    """The levels of the grammar of a sequence of numbers below 2^31, of whose
    parts between marks none has more than ``longest`` symbols."""
    levels = [Level(np.asarray(symbols, np.int64))]
    free = int(levels[0].symbols.max()) + 1 if len(symbols) else 0
    # A round of both leaves less than nine tenths of a part, hardly ever more.
    rounds = 2 + int(np.log(max(2, longest)) / np.log(4 / 3))
    for number in range(rounds):
        for is_block in (True, False):
            here = levels[-1]
            if is_block:
                opens, upper, free = _blocks(here.symbols, free)
            else:
                opens, upper, free = _pairs(here.symbols, free, number)
            if opens.all():
                continue
            here.is_block, here.opens = is_block, opens
            here.parent = np.cumsum(opens) - 1
            starts = np.flatnonzero(opens)
            if is_block:
                ends = np.append(starts[1:], len(opens))
                here.left = ends[here.parent] - np.arange(len(opens))
            levels.append(Level(upper, first=starts))
    return levels


def mirrored(levels: list[Level]) -> list[Level]:
    """The levels read from the end: extensions to the right of these are
    extensions to the left of the others."""
    out = []
    for lower, here in zip([None, *levels], levels):
        n = len(here.symbols)
        turned = Level(here.symbols[::-1], here.is_block)
        if here.parent is not None:
            last = np.ones(n, bool)
            last[:-1] = here.opens[1:]
            turned.opens = last[::-1]
            turned.parent = (here.parent[-1] - here.parent)[::-1]
            if here.is_block:
                starts = np.flatnonzero(here.opens)
                turned.left = (np.arange(n) - starts[here.parent] + 1)[::-1]
        if lower is not None:
            ends = np.append(here.first[1:], len(lower.symbols)) - 1
            turned.first = (len(lower.symbols) - 1 - ends)[::-1]
        out.append(turned)
    return out


def extend(levels: list[Level], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many symbols from ``x`` and from ``y`` on agree, for arrays of
    different places. The sequence ends in symbols that stand nowhere else."""
    top = len(levels) - 1
    origin = x
    found = np.zeros(len(x), np.int64)
    # Places that differ on a level, to be taken down from there.
    stopped: list[list[tuple[np.ndarray, ...]]] = [[] for _ in levels]
    number, x, y = np.arange(len(x)), x.copy(), y.copy()
    for depth, level in enumerate(levels):
        if not len(number):
            break
        same = level.symbols[x] == level.symbols[y]
        if depth == top:
            while True:
                stopped[top].append((number[~same], x[~same], y[~same]))
                number, x, y = number[same], x[same] + 1, y[same] + 1
                if not len(number):
                    break
                same = level.symbols[x] == level.symbols[y]
            break
        # Both at the beginning of a parent: the next level decides.
        rises = level.opens[x] & level.opens[y]
        if level.is_block:
            left_x, left_y = level.left[x], level.left[y]
            step = np.where(same & ~rises, np.minimum(left_x, left_y), 0)
            ends = ~rises & (~same | (left_x != left_y))
        else:
            step = np.where(same & ~rises, 1, 0)
            ends = ~rises & ~same
        x, y = x + step, y + step
        stopped[depth].append((number[ends], x[ends], y[ends]))
        goes = ~ends
        number, x, y = number[goes], level.parent[x[goes]], level.parent[y[goes]]
    number = x = y = np.zeros(0, np.int64)
    for depth in range(top, -1, -1):
        level = levels[depth]
        number, x, y = (
            np.concatenate([a, *b]) for a, b in zip((number, x, y), zip(*stopped[depth]) if stopped[depth] else ((), (), ()))
        )
        if not len(number):
            continue
        # The parents differ; what their first children share comes before.
        same = level.symbols[x] == level.symbols[y]
        while same.any():
            if level.is_block:
                step = np.minimum(level.left[x], level.left[y])
            else:
                step = 1
            x, y = np.where(same, x + step, x), np.where(same, y + step, y)
            same = level.symbols[x] == level.symbols[y]
        if depth:
            x, y = level.first[x], level.first[y]
    found[number] = x - origin[number]
    return found


_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _grid_table(words: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) of the grid pairs of a text of so many words, by their
    second place: those of a shorter text stand first."""
    if words not in _TABLES:
        places = [np.arange(0, words - p, p, dtype=np.int32) for p in range(1, words // 2 + 1)]
        periods = np.repeat(
            np.arange(1, len(places) + 1, dtype=np.int32), [len(a) for a in places]
        )
        place = np.concatenate(places) if places else np.zeros(0, np.int32)
        order = np.argsort(place + periods, kind="stable")
        _TABLES[words] = place[order], periods[order]
    return _TABLES[words]


def grid_pairs(words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period) for all periods up to half the text and all multiples of
    each, where the words a period apart are equal."""
    n = len(words)
    if n <= _TABLE_WORDS:
        size = max(64, 1 << (n - 1).bit_length())
        place, period = _grid_table(size)
        end = np.searchsorted(place + period, n) if n < size else len(place)
        place, period = place[:end], period[:end]
        hit = np.flatnonzero(words[place] == words[place + period])
        hit = hit[period[hit] <= n // 2]
        yield place[hit].astype(np.int64), period[hit].astype(np.int64)
        return
    held, size = [], 0
    for p in range(1, n // 2 + 1):
        grid = words[::p]
        hit = np.flatnonzero(grid[1:] == grid[:-1])
        if len(hit):
            held.append((hit * p, np.full(len(hit), p)))
            size += len(hit)
        if size >= PAIRS_AT_ONCE:
            yield tuple(np.concatenate(a) for a in zip(*held))
            held, size = [], 0
    if held:
        yield tuple(np.concatenate(a) for a in zip(*held))


def runs_of(texts: list[np.ndarray], min_words: int = MIN_WORDS) -> list[np.ndarray]:
    """The runs of each text, rows of (start, length, period) by start and
    period. Texts are arrays of numbers below 2^30, equal for equal words."""
    out = [np.zeros((0, 3), np.int64) for _ in texts]
    whole = [i for i, t in enumerate(texts) if len(t) >= min_words]
    if not whole:
        return out
    # A mark in front and one behind each text.
    marks = np.arange(len(whole) + 1, dtype=np.int64) + (1 << 30)
    sequence = np.concatenate([marks[:1], *(a for i, m in zip(whole, marks[1:]) for a in (texts[i], [m]))])
    starts = 1 + np.cumsum([0, *(len(texts[i]) + 1 for i in whole)])[:-1]
    levels = recompress(_small(sequence), max(len(texts[i]) for i in whole))
    turned = mirrored(levels)
    end = len(sequence) - 1
    found: list[list[np.ndarray]] = [[] for _ in whole]
    held, size = [], 0

    def settle() -> None:
        own, place, period = (np.concatenate(a) for a in zip(*held))
        held.clear()
        at = starts[own] + place
        ahead = extend(levels, at, at + period)
        behind = extend(turned, end - at + 1, end - at - period + 1)
        length = behind + period + ahead
        good = (length >= min_words) & (length >= 2 * period)
        rows = np.stack([own, place - behind, length, period], axis=1)[good]
        rows = np.unique(rows, axis=0)
        # One stretch, several periods: the smallest comes first.
        fresh = np.ones(len(rows), bool)
        fresh[1:] = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)
        rows = rows[fresh]
        for k, some in zip(*_split(rows)):
            found[k].append(some)

    for k, i in enumerate(whole):
        for place, period in grid_pairs(texts[i]):
            held.append((np.full(len(place), k), place, period))
            size += len(place)
            if size >= PAIRS_AT_ONCE:
                settle()
                size = 0
    if held:
        settle()
    for k, i in enumerate(whole):
        if found[k]:
            rows = np.unique(np.concatenate(found[k]), axis=0)
            fresh = np.ones(len(rows), bool)
            fresh[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
            rows = rows[fresh]
            out[i] = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
    return out


def _small(sequence: np.ndarray) -> np.ndarray:
    """The same sequence in numbers from 0 on."""
    return np.unique(sequence, return_inverse=True)[1].astype(np.int64)


def _split(rows: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    """Rows by their first column, which goes."""
    if not len(rows):
        return [], []
    begins = np.flatnonzero(np.append(True, rows[1:, 0] != rows[:-1, 0]))
    return rows[begins, 0].tolist(), np.split(rows[:, 1:], begins[1:])


def dropped_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Whether a run contains the word after the run's first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:-1]) > 0


RUN_FIELDS = [
    T.StructField("n_runs", T.LongType()),
    T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()),
    T.StructField("period", T.LongType()),
    T.StructField("exponent_milli", T.LongType()),
    T.StructField("runs", T.StringType()),
    T.StructField("collapsed", T.StringType()),
]


def find_runs(
    docs: DataFrame,
    text_column: str = "text",
    min_words: int = MIN_WORDS,
    digests: bool = False,
    edit: tuple[str, Callable[[list[bytes], object], list[bytes]]] | None = None,
) -> DataFrame:
    """The rows with n_runs, the longest run (start, length, period,
    exponent_milli), runs and collapsed.

    Words are separated by the six ASCII white space characters. A run is a
    longest stretch of at least ``min_words`` words and two periods in which words
    one period apart are equal; its period is the smallest. Of equally long runs
    the first one by start and period is named. runs lists ``start,length,period``
    of all, a line each, by start and period. collapsed has the words, one space
    between two, without those that a run contains after its first period. With
    ``digests`` these two are the SHA-256 of that.

    NULL and empty texts, and texts without a run, have no run: 0, four NULLs, and
    the words themselves. Rows, ties and repeats stay as they are; columns named
    like the new ones are replaced. An empty table gives an empty table.

    ``edit``, a column and a function of words and its value, changes the words
    before runs are looked for.
    """
    kept = without(docs.schema, [f.name for f in RUN_FIELDS])
    rows = docs.select(
        *[quoted(f.name) for f in kept],
        quoted(text_column).cast("string"),
        *([quoted(edit[0])] if edit else []),
    )
    text_place = len(kept)
    change = edit[1] if edit else None
    schema = T.StructType([*kept, *RUN_FIELDS])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = 0
            while first < batch.num_rows:
                words, size, stop = [], 0, first
                while stop < batch.num_rows and size < SLICE_WORDS:
                    text = batch.column(text_place)[stop].as_buffer()
                    own = text.to_pybytes().split() if text is not None else []
                    if change is not None:
                        own = change(own, batch.column(text_place + 1)[stop].as_py())
                    words.append(own)
                    size += len(own)
                    stop += 1
                new = _describe(words, min_words, digests)
                old = [batch.column(i).slice(first, stop - first) for i in range(len(kept))]
                arrays = [pa.array(a, pa.int64()) for a in new[:5]]
                arrays += [pa.array(a, pa.string()) for a in new[5:]]
                yield pa.RecordBatch.from_arrays([*old, *arrays], names=names)
                first = stop

    return map_in_arrow(rows, run, schema)


def _describe(words: list[list[bytes]], min_words: int, digests: bool) -> list[list]:
    number: dict[bytes, int] = {}
    texts = []
    for own in words:
        for w in own:
            if w not in number:
                number[w] = len(number)
        texts.append(np.fromiter(map(number.__getitem__, own), np.int64, len(own)))
    out: list[list] = [[] for _ in RUN_FIELDS]
    for own, runs in zip(words, runs_of(texts, min_words), strict=True):
        if len(runs):
            start, length, period = runs[np.argmax(runs[:, 1])].tolist()
            longest = start, length, period, 1000 * length // period
            gone = dropped_words(len(own), runs)
            own = [own[i] for i in np.flatnonzero(~gone).tolist()]
        else:
            longest = (None,) * 4
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs.tolist()).encode()
        texts_of = lines, b" ".join(own)
        if digests:
            texts_of = tuple(hashlib.sha256(t).hexdigest() for t in texts_of)
        else:
            texts_of = tuple(t.decode() for t in texts_of)
        for column, value in zip(out, (len(runs), *longest, *texts_of), strict=True):
            column.append(value)
    return out


def plant_tail(words: list, key: object) -> list:
    """The words; for a tenth of the keys, by the CRC-32 of the key in decimals,
    the words from some place on repeat with some period. NULL changes nothing."""
    if key is None or not words:
        return words
    h = zlib.crc32(str(key).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    start = g % n
    unit = words[start : start + 1 + (n - start) // (3 + g % 8)]
    return words[:start] + (unit * ((n - start) // len(unit) + 1))[: n - start]
