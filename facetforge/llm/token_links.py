"""Which tokens of one tokenizer cover the text of which tokens of another.

Both tokenizers cut the same bytes. Where both end a token, a group ends; tokens
of one group are linked. Two passes over the documents:

1. align, and count in how many documents each pair of ids is linked. Tasks
   write partial counts. Over the different pairs a minimal perfect hash is
   built; each task adds its counts to a dense vector with one place a pair, and
   the vectors are summed in a tree;
2. align again and look every link's count up: the hash gives the place, and the
   pair stored there must be the one asked for.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facetforge.llm.common import as_text, map_in_arrow, quoted, without
from facetforge.storage import fresh_path, materialise

BYTE_FILE, PIECE_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
# Pairs whose hash, keys and counts are with the tasks at once: 16 bytes each.
# More pairs take more passes.
BLOCK_PAIRS = 1 << 22
# Keys hashed by one small function, and places that are summed as one piece.
PART_PAIRS = 1 << 16
# Partial counts that a task holds before it writes them.
HELD_PAIRS = 1 << 20
# Chunks of text that a task remembers, and the longest that it does.
HELD_CHUNKS, HELD_CHARS = 300_000, 48
# Documents looked up together, and new chunks aligned together.
SLICE_ROWS, ALIGNED_CHUNKS = 512, 20_000
# Links that are listed at once.
LISTED_LINKS = 1 << 20

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


# -- tokens ------------------------------------------------------------------


def _byte_letters() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable
    ones stand for themselves, the others for those from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class TokenizerPair:
    """The byte-level tokenizer A and the piece tokenizer B, on chunks of text.

    A's file lists its merges in the order of the ids that they make; a library
    that merges by ranks then gives the ids of the file. Texts are cut into
    chunks at a single space or newline between other characters: no match of
    A's pattern reaches across, and no piece of B has a space, or a newline
    anywhere, after another character. Both facts are checked here.
    """

    def __init__(self, byte_file: bytes, piece_file: bytes, pattern: str):
        listed = json.loads(byte_file)["model"]
        letters = _byte_letters()
        special = {t["id"] for t in json.loads(byte_file).get("added_tokens", [])}
        vocabulary = {i: t for t, i in listed["vocab"].items() if i not in special}
        self.a_bytes = {i: bytes(letters[c] for c in t) for i, t in vocabulary.items()}
        merged = [m if isinstance(m, list) else m.split(" ") for m in listed["merges"]]
        made = [listed["vocab"]["".join(m)] for m in merged]
        if made != sorted(made):
            raise ValueError("the merges are not in the order of their ids")
        ranks = {raw: i for i, raw in self.a_bytes.items()}
        self._a = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._b = sentencepiece.SentencePieceProcessor(model_proto=piece_file)
        pieces = [self._b.id_to_piece(i) for i in range(self._b.get_piece_size())]
        self.n_b = len(pieces)
        byte = re.compile(r"<0x([0-9A-F]{2})>")
        self.b_bytes = [
            bytes([int(m[1], 16)]) if (m := byte.fullmatch(p)) else p.replace("▁", " ").encode()
            for p in pieces
        ]
        size = max(max(self.a_bytes), self.n_b - 1) + 1
        self._a_long = [len(self.a_bytes.get(i, b"")) for i in range(size)]
        self._b_long = [len(raw) for raw in self.b_bytes]
        self._a_width, self._b_width = np.array(self._a_long), np.array(self._b_long)
        self._names = [str(i) for i in range(size)]
        apart = not any(re.search("[^▁]▁|\n", p) for p in pieces)
        self._chunk = re.compile(r"(?<=\S)(?=[ \n]\S)") if apart else None
        self._simple = re.compile(r"[ \n]\S+")

    def chunks(self, text: str) -> list[str]:
        """Space and text in chunks that both tokenizers treat apart."""
        text = " " + text
        if self._chunk is None:
            return [text]
        found = self._simple.findall(text)
        # Chunks of one space or newline and other characters, if nothing else
        # is there; the lengths tell.
        if sum(map(len, found)) == len(text):
            return found
        return self._chunk.split(text)

    def tokens_of(self, text: str) -> tuple[np.ndarray, list[int], bytes]:
        """The ids of A and of B for a text that begins with a space, and its bytes."""
        a = self._a.encode_to_numpy(text, disallowed_special=())
        return a, self._b.encode(text[1:], num_threads=1), text.encode()

    def tokens(self, chunks: list[str]) -> list[tuple[list[int], list[int]]]:
        """The ids of A and of B for every chunk; none if the bytes differ."""
        encode = self._a.encode_ordinary
        spaced = [c[0] == " " for c in chunks]
        # B puts a space before every text. Where there is none, the piece of it
        # goes again: a newline is never in one piece with it.
        b_ids = self._b.encode([c[1:] if s else c for c, s in zip(chunks, spaced)], num_threads=1)
        out = []
        for chunk, space, b in zip(chunks, spaced, b_ids):
            if not space:
                b = b[1:]
            a = encode(chunk)
            raw = chunk.encode()
            if b"".join([self.b_bytes[i] for i in b]) != raw or b"".join(
                [self.a_bytes[i] for i in a]
            ) != raw:
                a = b = None
            out.append((a, b))
        return out

    def cuts(self, a: list[int], b: list[int]) -> list[tuple[int, int, int, int]]:
        """For each group, where its ids of A begin and end, and those of B."""
        long, wide, out = self._a_long, self._b_long, []
        i = j = 1
        first_i = first_j = 0
        at, other, n = long[a[0]], wide[b[0]], len(a)
        while True:
            if at == other:
                out.append((first_i, i, first_j, j))
                if i == n:
                    return out
                first_i, first_j = i, j
                at, other = at + long[a[i]], other + wide[b[j]]
                i, j = i + 1, j + 1
            elif at < other:
                at, i = at + long[a[i]], i + 1
            else:
                other, j = other + wide[b[j]], j + 1

    def links(self, a: list[int], b: list[int], cuts: list[tuple]) -> Iterator[list[int] | np.ndarray]:
        """The keys of all links, in pieces of bounded length."""
        n, small = self.n_b, []
        for i, k, j, m in cuts:
            if k - i == 1 == m - j:
                small.append(a[i] * n + b[j])
            elif (k - i) * (m - j) <= 256:
                small += [x * n + y for x in a[i:k] for y in b[j:m]]
            else:
                right = np.array(b[j:m], np.int64)
                step = max(1, LISTED_LINKS // len(right))
                for first in range(i, k, step):
                    left = np.array(a[first : min(k, first + step)], np.int64)
                    yield (left[:, None] * n + right[None, :]).ravel()
            if len(small) >= LISTED_LINKS:
                yield small
                small = []
        if small:
            yield small

    def written(self, a: list[int], b: list[int], cuts: list[tuple]) -> str:
        """The ids of all groups, as ``a1,a2|b1;a3|b2,b3``."""
        name = self._names
        return ";".join(
            [
                name[a[i]] + "|" + name[b[j]]
                if k - i == 1 == m - j
                else ",".join([name[x] for x in a[i:k]]) + "|" + ",".join([name[y] for y in b[j:m]])
                for i, k, j, m in cuts
            ]
        )


def _is_plain(chunk: str) -> bool:
    """Whether the chunk may stand between other such chunks in one text."""
    return (
        1 < len(chunk) <= HELD_CHARS
        and chunk[0] in " \n"
        and not chunk[1].isspace()
        and not chunk[-1].isspace()
    )


@dataclass
class Aligned:
    """Chunks and their links: in each row of ``counts`` n_a (-1 if the bytes
    differ), n_b, n_groups and n_links; the keys of chunk i, and how often it has
    them, stand from ``starts[i]`` on. ``written`` lists the groups if asked for."""

    counts: np.ndarray
    starts: np.ndarray
    keys: np.ndarray
    times: np.ndarray
    written: list[str]

    @classmethod
    def none(cls) -> Aligned:
        empty = np.zeros(0, np.int64)
        return cls(np.zeros((0, 4), np.int64), np.zeros(1, np.int64), empty, empty, [])

    def and_more(self, other: Aligned) -> Aligned:
        return Aligned(
            np.concatenate([self.counts, other.counts]),
            np.concatenate([self.starts, other.starts[1:] + self.starts[-1]]),
            np.concatenate([self.keys, other.keys]),
            np.concatenate([self.times, other.times]),
            self.written + other.written,
        )


def align(pair: TokenizerPair, chunks: list[str], written: bool) -> Aligned:
    """Tokens, groups and links of the chunks."""
    together = [i for i, c in enumerate(chunks) if _is_plain(c)]
    found = _align_together(pair, [chunks[i] for i in together], written) if together else None
    if found is not None and len(together) == len(chunks):
        return found
    # Chunks that do not go with others, or that have a large group.
    apart = range(len(chunks))
    if found is not None:
        apart = sorted(set(apart).difference(together))
    counts, texts = np.zeros((len(chunks), 4), np.int64), [""] * len(chunks)
    owner, keys, times = [], [], []
    if found is not None:
        counts[together] = found.counts
        for i, text in zip(together, found.written):
            texts[i] = text
        owner.append(np.repeat(np.array(together, np.int64), np.diff(found.starts)))
        keys.append(found.keys)
        times.append(found.times)
    for i, (a, b) in zip(apart, pair.tokens([chunks[i] for i in apart]), strict=True):
        if a is None:
            counts[i, 0] = -1
            continue
        cuts = pair.cuts(a, b)
        texts[i] = pair.written(a, b, cuts) if written else ""
        for some in pair.links(a, b, cuts):
            different, n = np.unique(np.asarray(some, np.int64), return_counts=True)
            owner.append(np.full(len(different), i))
            keys.append(different)
            times.append(n)
            counts[i, 3] += len(some)
        counts[i, :3] = len(a), len(b), len(cuts)
    flat = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (owner, keys, times)]
    order = np.argsort(flat[0], kind="stable")
    starts = np.searchsorted(flat[0][order], np.arange(len(chunks) + 1))
    return Aligned(counts, starts, flat[1][order], flat[2][order], texts if written else [])


def _align_together(pair: TokenizerPair, chunks: list[str], written: bool) -> Aligned | None:
    """Plain chunks as one text, cut by both tokenizers at once; None if they must
    be looked at one by one."""
    # The first chunk takes the space that B puts before every text.
    text = " a" + "".join(chunks)
    a, b, raw = pair.tokens_of(text)
    if b"".join(map(pair.b_bytes.__getitem__, b)) != raw:
        return None
    ends_a = np.cumsum(pair._a_width[a])
    ids_b = np.array(b, np.int64)
    ends_b = np.cumsum(pair._b_width[ids_b])
    if ends_a[-1] != len(raw):
        return None
    sizes = [2, *(len(c) if c.isascii() else len(c.encode()) for c in chunks)]
    chunk_ends = np.cumsum(sizes)
    place = np.searchsorted(ends_b, ends_a)
    shared = ends_b[place] == ends_a
    stop_a, stop_b = np.flatnonzero(shared) + 1, place[shared] + 1
    ends = ends_a[shared]
    at = np.searchsorted(ends, chunk_ends)
    if (ends[at] != chunk_ends).any():
        return None
    # Groups of the chunks; those of the first go.
    skip = at[0] + 1
    start_a, start_b = stop_a[skip - 1 : -1], stop_b[skip - 1 : -1]
    wide_a, wide_b = stop_a[skip:] - start_a, stop_b[skip:] - start_b
    n_links = wide_a * wide_b
    if len(n_links) and n_links.max() > 256:
        return None
    n_groups = np.diff(at)
    first_group = np.concatenate([[0], np.cumsum(n_groups)])
    group = np.repeat(np.arange(len(n_links)), n_links)
    ahead = np.concatenate([[0], np.cumsum(n_links)])
    k = np.arange(ahead[-1]) - ahead[group]
    i, j = start_a[group] + k // wide_b[group], start_b[group] + k % wide_b[group]
    keys = a[i].astype(np.int64) * pair.n_b + ids_b[j]

    def per_chunk(values: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values)])
        return total[first_group[1:]] - total[first_group[:-1]]

    counts = np.stack(
        [per_chunk(wide_a), per_chunk(wide_b), n_groups, per_chunk(n_links)], axis=1
    )
    texts: list[str] = []
    if written:
        name, listed = pair._names, a.tolist()
        groups = [
            name[listed[x]] + "|" + name[b[y]]
            if n == 1 == m
            else ",".join([name[q] for q in listed[x : x + n]])
            + "|"
            + ",".join([name[q] for q in b[y : y + m]])
            for x, n, y, m in zip(
                start_a.tolist(), wide_a.tolist(), start_b.tolist(), wide_b.tolist(), strict=True
            )
        ]
        bounds = first_group.tolist()
        texts = [";".join(groups[x:y]) for x, y in zip(bounds, bounds[1:])]
    return Aligned(counts, ahead[first_group], keys, np.ones(len(keys), np.int64), texts)


def _read(path: str | None, name: str) -> bytes:
    with open(path or public_tokenizers.path(name), "rb") as file:
        return file.read()


def pair_maker(
    spark: SparkSession,
    byte_file: str | None = None,
    piece_file: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
) -> Callable[[], TokenizerPair]:
    """A function that tasks call for the tokenizers. The files (2 MB) are read
    here and travel with it."""
    files = spark.sparkContext.broadcast(
        (_read(byte_file, BYTE_FILE), _read(piece_file, PIECE_FILE))
    )
    return lambda: TokenizerPair(*files.value, pattern)


# -- first pass --------------------------------------------------------------


def _remember(
    pair: TokenizerPair, split: list[list[str]], number: dict[str, int], known: Aligned, written: bool
) -> Aligned:
    """Align the chunks that have no number yet, and number them."""
    new = list({c for s in split for c in s if c not in number})
    for first in range(0, len(new), ALIGNED_CHUNKS):
        some = new[first : first + ALIGNED_CHUNKS]
        number.update((c, len(known.counts) + i) for i, c in enumerate(some))
        known = known.and_more(align(pair, some, written))
    return known


def _places_of(split: list[list[str]], number: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """(text, number of the chunk) of all chunks in order."""
    sizes = [len(s) for s in split]
    chunk = np.fromiter((number[c] for s in split for c in s), np.int64, sum(sizes))
    return np.repeat(np.arange(len(split)), sizes), chunk


def _forget_long(split: list[list[str]], number: dict[str, int]) -> None:
    """Long chunks hardly come again; their texts need not be kept."""
    for s in split:
        for c in s:
            if len(c) > HELD_CHARS:
                number.pop(c, None)


def partial_counts(texts: DataFrame, make: Callable[[], TokenizerPair]) -> DataFrame:
    """(key, n): in how many texts each pair is linked, by parts of tasks. The
    key is the id of A times B's number of ids, plus the id of B."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, counts = make(), Counter()
        number, known = {}, Aligned.none()

        def counted() -> Iterator[pa.RecordBatch]:
            keys = np.fromiter(counts.keys(), np.int64, len(counts))
            n = np.fromiter(counts.values(), np.int64, len(counts))
            order = np.argsort(keys)
            for first in range(0, len(order), 1 << 16):
                some = order[first : first + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[some]), pa.array(n[some])], names=["key", "n"]
                )
            counts.clear()

        for batch in batches:
            texts = as_text(batch.column(0))
            for first in range(0, len(texts), SLICE_ROWS):
                split = [pair.chunks(t) if t else [] for t in texts[first : first + SLICE_ROWS]]
                if len(known.counts) > HELD_CHUNKS:
                    number, known = {}, Aligned.none()
                known = _remember(pair, split, number, known, False)
                doc, chunk = _places_of(split, number)
                bad = np.bincount(doc, weights=known.counts[chunk, 0] < 0, minlength=len(split)) > 0
                good = ~bad[doc]
                # Different chunks of each text, then the different keys of each.
                once = np.unique((doc[good] << 32) | chunk[good])
                doc, chunk = once >> 32, once & 0xFFFFFFFF
                n = known.starts[chunk + 1] - known.starts[chunk]
                ahead = np.concatenate([[0], np.cumsum(n)])
                at = np.repeat(known.starts[chunk] - ahead[:-1], n) + np.arange(ahead[-1])
                links = np.unique((np.repeat(doc, n) << 32) | known.keys[at])
                keys, n = np.unique(links & 0xFFFFFFFF, return_counts=True)
                for key, more in zip(keys.tolist(), n.tolist()):
                    counts[key] += more
                _forget_long(split, number)
                if len(counts) >= HELD_PAIRS:
                    yield from counted()
        yield from counted()

    return texts.mapInArrow(run, "key long, n long")


# -- minimal perfect hash ----------------------------------------------------


class PerfectHash:
    """Places 0 to n - 1 for n different keys, about 3.7 bits a key.

    A level has twice as many bits as keys. A key whose bit no other key claims
    takes it; the others go to the next level. The place is the number of taken
    bits before the key's own.
    """

    def __init__(self, sizes: list[int], words: np.ndarray):
        self.sizes, self.words = sizes, words
        taken = np.bitwise_count(words).astype(np.int64)
        self._before = np.concatenate([np.zeros(1, np.int64), np.cumsum(taken)])

    @staticmethod
    def _bit(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        seed = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        return (_mix(keys + seed) % np.uint64(size)).astype(np.int64)

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        """The hash of different uint64 keys."""
        sizes, levels = [], []
        while len(keys):
            size = -(-2 * len(keys) // 64) * 64
            bit = cls._bit(keys, len(sizes), size)
            alone = np.bincount(bit, minlength=size) == 1
            sizes.append(size)
            levels.append(np.packbits(alone, bitorder="little").view(np.uint64))
            keys = keys[~alone[bit]]
        return cls(sizes, np.concatenate(levels) if levels else np.zeros(0, np.uint64))

    def places(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key; a key that was never put in gets any, or -1."""
        out = np.full(len(keys), -1, np.int64)
        left, first = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            if not len(left):
                break
            bit = first + self._bit(keys[left], level, size)
            word, low = bit >> 6, (bit & 63).astype(np.uint64)
            mask = self.words[word]
            taken = (mask >> low) & np.uint64(1) == 1
            below = np.bitwise_count(mask & ((np.uint64(1) << low) - np.uint64(1)))
            out[left[taken]] = (self._before[word] + below)[taken]
            left, first = left[~taken], first + size
        return out


def _part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return (_mix(keys.astype(np.uint64) ^ _STEP) % np.uint64(parts)).astype(np.int64)


def _pack(values: np.ndarray) -> bytes:
    return values.tobytes()


def hash_parts(keys: DataFrame, parts: int) -> DataFrame:
    """(part, n, sizes, words, keys) of different keys: the perfect hash of each
    part, and its keys in the order of their places."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = _part_of(batch.column(0).to_numpy(), parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), batch.column(0)], names=["part", "key"]
            )

    def build(group: pa.Table) -> pa.Table:
        keys = group["key"].to_numpy().astype(np.uint64)
        hashed = PerfectHash.of(keys)
        ordered = np.empty(len(keys), np.int64)
        ordered[hashed.places(keys)] = keys.view(np.int64)
        return pa.table(
            {
                "part": pa.array([group["part"][0].as_py()], pa.int64()),
                "n": pa.array([len(keys)], pa.int64()),
                "sizes": pa.array([hashed.sizes], pa.list_(pa.int64())),
                "words": pa.array([_pack(hashed.words)], pa.binary()),
                "keys": pa.array([_pack(ordered)], pa.binary()),
            }
        )

    # A part has PART_PAIRS keys on average, so a group is small whatever the
    # number of keys.
    numbered = keys.mapInArrow(number, "part long, key long")
    return numbered.groupBy("part").applyInArrow(
        build, "part long, n long, sizes array<long>, words binary, keys binary"
    )


class PairPlaces:
    """The perfect hash of consecutive parts, with verified keys."""

    def __init__(self, parts: int, first: int, rows: list[tuple]):
        """Rows are (part, n, sizes, words, keys); an absent part is empty."""
        self.parts, self.first = parts, first
        self.last = first + len(rows)
        self._hashes = [
            PerfectHash(list(sizes), np.frombuffer(words, np.uint64)) for _, _, sizes, words, _ in rows
        ]
        self.starts = np.cumsum([0, *[n for _, n, *_ in rows]]).astype(np.int64)
        self.keys = np.frombuffer(b"".join(k for *_, k in rows), np.int64)

    def places(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key; -1 for keys of other parts, -2 for keys of
        these parts that were never hashed."""
        out = np.full(len(keys), -1, np.int64)
        part = _part_of(keys, self.parts)
        here = np.flatnonzero((part >= self.first) & (part < self.last))
        order = here[np.argsort(part[here], kind="stable")]
        numbers, begins = np.unique(part[order], return_index=True)
        for number, begin, end in zip(numbers, begins, [*begins[1:], len(order)]):
            rows = order[begin:end]
            local = int(number) - self.first
            found = self._hashes[local].places(keys[rows].astype(np.uint64))
            out[rows] = np.where(found < 0, -1, self.starts[local] + found)
        known = out[here] >= 0
        known[known] = self.keys[out[here[known]]] == keys[here[known]]
        out[here[~known]] = -2
        return out


# -- dense vectors -----------------------------------------------------------


def _sum_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the pieces with one number; those of a task are held."""
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for piece, values in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            more = np.frombuffer(values.as_py(), np.int64)
            held[piece] = held[piece] + more if piece in held else more
    for piece in sorted(held):
        yield pa.RecordBatch.from_arrays(
            [pa.array([piece], pa.int64()), pa.array([_pack(held[piece])], pa.binary())],
            names=["piece", "counts"],
        )


def summed_counts(partials: DataFrame, places, size: int) -> np.ndarray:
    """The dense count vector of one block of pairs.

    ``places`` is a broadcast PairPlaces maker. Each task adds its part of the
    partial counts to a vector of ``size``; its pieces are summed over groups of
    tasks first and then over these, so nobody adds up more than the square root
    of their number. The sums, ``size`` numbers, go to the driver.
    """
    spark = partials.sparkSession
    piece = min(PART_PAIRS, max(1, size))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup, counts = places(), np.zeros(size, np.int64)
        for batch in batches:
            at = lookup.places(batch.column(0).to_numpy())
            if (at == -2).any():
                raise ValueError("a pair that was not hashed")
            np.add.at(counts, at[at >= 0], batch.column(1).to_numpy()[at >= 0])
        for first in range(0, size, piece):
            some = counts[first : first + piece]
            if some.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([first // piece], pa.int64()), pa.array([_pack(some)], pa.binary())],
                    names=["piece", "counts"],
                )

    kind = "piece long, counts binary"
    pieces = -(-size // piece)
    vectors = partials.mapInArrow(fill, kind).withColumn("task", F.spark_partition_id())
    branches = max(1, int(partials.rdd.getNumPartitions() ** 0.5))
    width = max(1, min(4 * spark.sparkContext.defaultParallelism, pieces * branches))
    level = vectors.repartition(width, F.col("piece"), F.col("task") % branches)
    level = level.select("piece", "counts").mapInArrow(_sum_pieces, kind)
    width = max(1, min(4 * spark.sparkContext.defaultParallelism, pieces))
    total = level.repartition(width, "piece").mapInArrow(_sum_pieces, kind)
    out = np.zeros(size, np.int64)
    for row in total.collect():
        some = np.frombuffer(row["counts"], np.int64)
        out[row["piece"] * piece : row["piece"] * piece + len(some)] = some
    return out


# -- second pass -------------------------------------------------------------

LINK_FIELDS = [
    *[
        T.StructField(name, T.LongType())
        for name in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    ],
    T.StructField("groups", T.StringType()),
]


def _look_up(
    docs: DataFrame, text_place: int, make, places, counts, best, digests: bool, again: bool
) -> DataFrame:
    """Align the texts and add what the pairs of this block contribute to n_best
    and count_sum; the first time also the other columns, which stand last."""
    old = docs.schema.fields
    keep_places = range(len(old) - len(LINK_FIELDS) if again else len(old))
    old_places = range(len(keep_places), len(old))
    schema = T.StructType([*[old[i] for i in keep_places], *LINK_FIELDS])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, lookup = make(), places()
        count_of, best_of = counts.value, best.value
        number, known = {}, Aligned.none()
        # Per chunk n_a, n_b, n_groups, n_links, n_best, count_sum, and links that
        # were not counted: their chunks stand in texts only that have no tokens.
        sums = np.zeros((0, 7), np.int64)

        def looked_up(first: int) -> np.ndarray:
            """The sums of the chunks from number ``first`` on."""
            begin = known.starts[first]
            rows = np.zeros((len(known.counts) - first, 7), np.int64)
            rows[:, :4] = known.counts[first:]
            keys, times = known.keys[begin:], known.times[begin:]
            who = np.repeat(np.arange(len(rows)), np.diff(known.starts[first:]))
            at = lookup.places(keys)
            np.add.at(rows[:, 6], who, at == -2)
            here = at >= 0
            n, who, keys, times = count_of[at[here]], who[here], keys[here], times[here]
            np.add.at(rows[:, 4], who, times * (n == best_of[keys // pair.n_b]))
            np.add.at(rows[:, 5], who, times * n)
            return rows

        for batch in batches:
            for first in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(first, SLICE_ROWS)
                split = [pair.chunks(t) if t else [] for t in as_text(part.column(text_place))]
                if len(known.counts) > HELD_CHUNKS:
                    number, known, sums = {}, Aligned.none(), sums[:0]
                known = _remember(pair, split, number, known, True)
                sums = np.concatenate([sums, looked_up(len(sums))])
                doc, chunk = _places_of(split, number)
                bad = np.bincount(doc, weights=sums[chunk, 0] < 0, minlength=len(split)) > 0
                out = np.zeros((len(split), 7), np.int64)
                if len(chunk):
                    begins = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
                    out[doc[begins]] = np.add.reduceat(sums[chunk], begins)
                out[bad] = 0
                if out[:, 6].any():
                    raise ValueError("a link that was not counted")
                written, places_in_order, listed, at = known.written, chunk.tolist(), [], 0
                for chunks, is_bad in zip(split, bad.tolist(), strict=True):
                    own = places_in_order[at : at + len(chunks)]
                    at += len(chunks)
                    if is_bad or not own:
                        listed.append("")
                        continue
                    text = ";".join([written[i] for i in own])
                    listed.append(hashlib.sha256(text.encode()).hexdigest() if digests else text)
                _forget_long(split, number)
                columns = [part.column(i) for i in keep_places]
                if again:
                    old = [part.column(i) for i in old_places]
                    out[:, :4] = np.stack([o.to_numpy() for o in old[:4]], axis=1)
                    for i in (4, 5):
                        out[:, i] += old[i].to_numpy()
                    listed = old[6]
                yield pa.RecordBatch.from_arrays(
                    [
                        *columns,
                        *[pa.array(out[:, i]) for i in range(6)],
                        listed if again else pa.array(listed, pa.string()),
                    ],
                    names=names,
                )

    return map_in_arrow(docs, run, schema)


def link_tokens(
    docs: DataFrame,
    text_column: str = "text",
    byte_file: str | None = None,
    piece_file: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
    digests: bool = False,
    block_pairs: int = BLOCK_PAIRS,
) -> DataFrame:
    """The rows with n_a, n_b (tokens), n_groups, n_links, n_best, count_sum and
    groups, for a space and the text.

    The count of a pair of ids is the number of rows whose text links it. n_best
    counts the links whose count is the highest of all pairs with their id of A,
    ties included; count_sum adds the counts of all links. groups lists the ids
    as ``a1,a2|b1;a3|b2,b3``, or with ``digests`` the SHA-256 of that.

    NULL and empty texts, and texts whose bytes a tokenizer does not give back,
    have no tokens: zeros and an empty string. Strings of special tokens are
    plain text. Repeated rows count each. Columns named like the new ones are
    replaced. An empty table gives an empty table.

    The hash, keys and counts of ``block_pairs`` pairs are with the tasks at
    once; with more pairs than that, the second pass is made once for each block
    and adds to the table that the one before has written.
    """
    spark = docs.sparkSession
    kept = [f.name for f in without(docs.schema, [f.name for f in LINK_FIELDS])]
    rows = docs.select(*[quoted(c) for c in kept])
    text_place = kept.index(text_column)
    make = pair_maker(spark, byte_file, piece_file, pattern)
    n_b = make().n_b

    texts = rows.select(quoted(text_column).cast("string").alias("text"))
    partials = materialise(partial_counts(texts, make), "pair-counts")
    keys = materialise(partials.select("key").distinct(), "pairs")
    parts = max(1, -(-keys.count() // PART_PAIRS))
    hashed = materialise(hash_parts(keys, parts), "pair-hashes")

    # Counts of one block after the other; the best of each id of A (as many
    # numbers as A has ids) is known after the last.
    step = max(1, block_pairs // PART_PAIRS)
    starts = range(0, parts, step)
    best = np.zeros(0, np.int64)
    kept_counts = []

    def block(first: int):
        last = min(parts, first + step)
        found = {
            r["part"]: tuple(r) for r in hashed.filter(F.col("part").between(first, last - 1)).collect()
        }
        held = [found.get(p, (p, 0, [], b"", b"")) for p in range(first, last)]
        sent = spark.sparkContext.broadcast([(p, n, list(s), bytes(w), bytes(k)) for p, n, s, w, k in held])
        return sent, lambda: PairPlaces(parts, first, sent.value)

    for first in starts:
        sent, places = block(first)
        local = places()
        counts = summed_counts(partials, places, len(local.keys))
        a = local.keys // n_b
        if len(a):
            best = np.concatenate([best, np.zeros(max(0, a.max() + 1 - len(best)), np.int64)])
            np.maximum.at(best, a, counts)
        path = fresh_path(spark, "block-counts")
        spark.createDataFrame([(bytearray(counts.tobytes()),)], "counts binary").write.parquet(path)
        kept_counts.append(path)
        sent.unpersist()

    best_sent = spark.sparkContext.broadcast(best)
    for number, (first, path) in enumerate(zip(starts, kept_counts, strict=True)):
        sent, places = block(first)
        stored = spark.read.schema("counts binary").parquet(path).first()["counts"]
        counts = spark.sparkContext.broadcast(np.frombuffer(bytes(stored), np.int64))
        rows = _look_up(rows, text_place, make, places, counts, best_sent, digests, number > 0)
        if number + 1 < len(kept_counts):
            rows = materialise(rows, "linked")
    return rows
