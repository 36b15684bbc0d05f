"""Language of a text by unigrams of word pieces, summed over segmentations.

The pieces are those of a fixed public vocabulary. Each language has a
probability for every piece; a word's probability is the sum over all ways to
cut it into pieces, found by a forward pass over its bytes.
"""

from __future__ import annotations

import base64
import re
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from facetforge.llm.common import as_text, map_in_arrow, plain_text, quoted, without

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
UNDETERMINED = "und"
# Count added to every piece of every language.
SMOOTHING = 0.1
# Distinct words remembered by a task, in training and in scoring; older ones
# are computed again.
REMEMBERED_WORDS = 200_000
# Bytes of the table of languages and pieces, which the driver and tasks hold.
MAX_TABLE_BYTES = 256 << 20

_WORD = re.compile(r"[^\W\d_]+")
# Texts scored together, in characters, and numbers in a table of words.
GROUP_CHARS = 2_000_000
_CELLS = 1 << 21


def words_of(text: str) -> list[str]:
    """Runs of letters, in lower case."""
    found = _WORD.findall(text.lower())
    if text.isascii():
        return found
    return [w for w in found if w.isascii() or any(map(str.isalpha, w))]


def read_vocabulary(path: str | None = None) -> dict[bytes, int]:
    """The pieces and their numbers, read on the driver (under 1 MB)."""
    with open(path or public_tokenizers.path(VOCABULARY), "rb") as file:
        pairs = (line.split() for line in file if line.strip())
        return {base64.b64decode(piece): int(number) for piece, number in pairs}


@dataclass(frozen=True)
class LanguageModel:
    """languages in order; pieces[i] has the probabilities of one piece, by
    language. Its size is languages x vocabulary, whatever the corpus."""

    languages: tuple[str, ...]
    pieces: Mapping[bytes, Sequence[float]]

    def plain(self) -> tuple[tuple[str, ...], list[bytes], np.ndarray]:
        """The model in values that need none of this package to be read."""
        table = np.array(list(self.pieces.values()), np.float64)
        return self.languages, list(self.pieces), table.reshape(len(self.pieces), len(self.languages))

    @classmethod
    def of(cls, languages: tuple[str, ...], pieces: list[bytes], table: np.ndarray) -> LanguageModel:
        return cls(languages, dict(zip(pieces, table, strict=True)))


class PieceTable:
    """Pieces, and beginnings of pieces, by a 64-bit hash of their bytes that can
    be carried on byte by byte for many words at once."""

    _SLOT_BITS = 20
    _START, _PRIME = np.uint64(0xCBF29CE484222325), np.uint64(0x100000001B3)
    _SPREAD = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, pieces: Mapping[bytes, Sequence[float]], languages: int):
        self.longest = max(map(len, pieces), default=1)
        begins = {piece[:end] for piece in pieces for end in range(1, len(piece) + 1)}
        listed = sorted(begins, key=lambda x: (len(x), x))
        codes = self._codes_of(listed)
        slots = self._slot(codes)
        order = np.argsort(slots, kind="stable")
        # Of each slot, where its codes begin; after the last come those that
        # match nothing.
        self.codes = np.append(codes[order], np.zeros(8, np.uint64))
        self.first = np.searchsorted(slots[order], np.arange(1 << self._SLOT_BITS)).astype(np.int32)
        counts = np.bincount(slots.astype(np.int64), minlength=1)
        self.deepest = int(counts.max()) if len(listed) else 0
        # Row 0 is no piece.
        known = [pieces.get(listed[i]) for i in order]
        rows = np.cumsum([x is not None for x in known], dtype=np.int64)
        self.row = np.where([x is not None for x in known], rows, 0)
        self.chance = np.zeros((int(rows[-1]) + 1 if len(rows) else 1, languages))
        self.chance[1:] = [x for x in known if x is not None] or np.zeros((0, languages))

    def _codes_of(self, listed: list[bytes]) -> np.ndarray:
        codes = np.empty(len(listed), np.uint64)
        at = 0
        while at < len(listed):
            size, end = len(listed[at]), at
            while end < len(listed) and len(listed[end]) == size:
                end += 1
            block = np.frombuffer(b"".join(listed[at:end]), np.uint8).reshape(-1, size)
            code = np.full(end - at, self._START)
            for i in range(size):
                code = self.carry_on(code, block[:, i])
            codes[at:end] = code
            at = end
        return codes

    @classmethod
    def carry_on(cls, code: np.ndarray, byte: np.ndarray) -> np.ndarray:
        return (code ^ byte) * cls._PRIME

    @classmethod
    def _slot(cls, codes: np.ndarray) -> np.ndarray:
        return (codes * cls._SPREAD) >> np.uint64(64 - cls._SLOT_BITS)

    def find(self, codes: np.ndarray) -> np.ndarray:
        """Places of the codes in the table, -1 where they begin no piece."""
        at = self.first[self._slot(codes)]
        found = np.where(self.codes[at] == codes, at, -1)
        for k in range(1, self.deepest):
            missing = np.flatnonzero(found < 0)
            there = at[missing] + k
            inside = there < len(self.codes)
            missing, there = missing[inside], there[inside]
            hit = self.codes[there] == codes[missing]
            found[missing[hit]] = there[hit]
        return np.where(found < len(self.row), found, -1)


class WordScorer:
    """Log-probabilities of words under every language, with a bounded memory
    of words already seen."""

    _RESCALE = 8  # bytes between two rescalings

    def __init__(self, model: LanguageModel):
        self.count = len(model.languages)
        self.table = PieceTable(model.pieces, self.count)
        self.known: dict[str, int] = {}
        self.logs = np.zeros((0, self.count))

    def learn(self, words: Iterable[str]) -> None:
        """Make sure that all these words are known."""
        fresh = [w for w in dict.fromkeys(words) if w not in self.known]
        if not fresh:
            return
        by_size: dict[int, list[tuple[int, bytes]]] = {}
        for i, word in enumerate(fresh):
            raw = b" " + word.encode("utf-8", "replace")
            by_size.setdefault(len(raw), []).append((i, raw))
        logs = np.empty((len(fresh), self.count))
        for size, listed in by_size.items():
            # So many words at once that their table stays small.
            step = max(1, _CELLS // (size * max(self.count, 1)))
            for first in range(0, len(listed), step):
                part = listed[first : first + step]
                block = np.frombuffer(b"".join(raw for _, raw in part), np.uint8)
                logs[[i for i, _ in part]] = self.forward(block.reshape(len(part), size))
        start = len(self.logs)
        self.logs = np.concatenate([self.logs, logs])
        self.known.update(zip(fresh, range(start, start + len(fresh))))

    def forward(self, block: np.ndarray) -> np.ndarray:
        """For words of one length, a row each: logs of the sums over all
        segmentations of the products of their pieces' probabilities."""
        many, size = block.shape
        table = self.table
        ahead = np.zeros((size + 1, many, self.count))
        ahead[0] = 1.0
        scaled = np.zeros((many, self.count))
        for i in range(size):
            if i and i % self._RESCALE == 0:
                factor = np.where(ahead[i] > 0, ahead[i], 1.0)
                scaled += np.log(factor)
                ahead[i : i + table.longest + 1] /= factor
            alive = np.arange(many)
            code = np.full(many, table._START)
            for j in range(i, min(size, i + table.longest)):
                code = table.carry_on(code, block[alive, j])
                place = table.find(code)
                goes_on = place >= 0
                if not goes_on.all():
                    alive, code, place = alive[goes_on], code[goes_on], place[goes_on]
                if not len(alive):
                    break
                row = table.row[place]
                ahead[j + 1, alive] += ahead[i, alive] * table.chance[row]
        return np.log(np.maximum(ahead[size], 5e-324)) + scaled

    def texts(self, texts: list[str]) -> list[np.ndarray | None]:
        """Log-probabilities of the texts; None for those without a letter."""
        counts = [Counter(words_of(t)) for t in texts]
        if len(self.known) > REMEMBERED_WORDS:
            self.known.clear()
            self.logs = np.zeros((0, self.count))
        self.learn(w for c in counts for w in c)
        found: list[np.ndarray | None] = []
        for counted in counts:
            if not counted:
                found.append(None)
                continue
            places = np.fromiter((self.known[w] for w in counted), np.int64, len(counted))
            times = np.fromiter(counted.values(), np.float64, len(counted))
            found.append(times @ self.logs[places])
        return found


def has_letter(text_column: str = "text") -> Column:
    """Whether the text has a letter, so that its language can be told."""
    return plain_text(text_column).rlike(r"\p{L}")


def fit_languages(
    docs: DataFrame,
    text_column: str = "text",
    lang_column: str = "lang",
    vocabulary: str | None = None,
    smoothing: float = SMOOTHING,
) -> LanguageModel:
    """Piece probabilities of each language from labelled rows.

    Every row with a language counts, whole. Pieces are counted inside the
    tasks; only (language, piece) totals are shuffled and brought to the driver,
    at most languages x vocabulary of them. Rows without text or language teach
    nothing. Without labelled rows the model has no language.
    """
    numbers = read_vocabulary(vocabulary)
    shared = docs.sparkSession.sparkContext.broadcast(numbers)
    rows = docs.select(
        quoted(lang_column).cast("string").alias("lang"), plain_text(text_column).alias("text")
    ).filter("lang IS NOT NULL")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = tiktoken.Encoding(
            "vocabulary",
            pat_str=public_tokenizers.PATTERN,
            mergeable_ranks=shared.value,
            special_tokens={},
        )
        pieces: dict[str, np.ndarray] = {}
        words: dict[str, Counter] = {}

        def settle() -> None:
            for lang, counted in words.items():
                totals = pieces.setdefault(lang, np.zeros(encoding.n_vocab, np.int64))
                for word, n in counted.items():
                    for piece in encoding.encode_ordinary(" " + word):
                        totals[piece] += n
            words.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), as_text(batch.column(1)), strict=True):
                words.setdefault(lang, Counter()).update(words_of(text))
                if sum(map(len, words.values())) > REMEMBERED_WORDS:
                    settle()
        settle()
        for lang, totals in pieces.items():
            used = np.flatnonzero(totals)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(used), pa.string()),
                    pa.array(used.astype(np.int32)),
                    pa.array(totals[used]),
                ],
                names=["lang", "piece", "n"],
            )

    counted = rows.mapInArrow(count, "lang string, piece int, n bigint")
    totals = counted.groupBy("lang", "piece").agg({"n": "sum"}).toArrow().to_pydict()
    lang_of, piece_of, n_of = totals.values()
    languages = tuple(sorted(set(lang_of)))
    size = max(numbers.values()) + 1
    if 8 * size * len(languages) > MAX_TABLE_BYTES:
        raise ValueError(f"{len(languages)} languages are too many for a table of {MAX_TABLE_BYTES} bytes")
    table = np.full((size, len(languages)), smoothing)
    place = {lang: i for i, lang in enumerate(languages)}
    for lang, piece, n in zip(lang_of, piece_of, n_of, strict=True):
        table[piece, place[lang]] += n
    table /= table.sum(axis=0, keepdims=True) if languages else 1.0
    return LanguageModel(languages, {piece: table[i] for piece, i in numbers.items()})


def _groups(column: pa.Array) -> Iterator[list[str]]:
    """The texts in lists of about GROUP_CHARS characters."""
    held, size = [], 0
    for value in column:
        held.append(value.as_py() or "")
        size += len(held[-1])
        if size >= GROUP_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def identify_languages(docs: DataFrame, model: LanguageModel, text_column: str = "text") -> DataFrame:
    """The rows with lang_pred and score.

    lang_pred is the language under which the whole text is most probable, the
    first by name on a tie; score is its share of the probability, all languages
    being equally likely beforehand. Texts that are NULL or have no letter are
    ``und`` with score 0, and so is every text if the model has no language.
    Columns already named lang_pred or score are replaced; no other column
    but the text is looked at.
    """
    kept = without(docs.schema, ["lang_pred", "score"])
    shared = docs.sparkSession.sparkContext.broadcast(model.plain())
    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    schema = T.StructType([*kept, *fields])
    names = schema.names
    place = [f.name for f in kept].index(text_column)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = LanguageModel.of(*shared.value)
        scorer = WordScorer(model) if model.languages else None
        for batch in batches:
            found, scores = [], []
            for group in _groups(batch.column(place)):
                for logs in scorer.texts(group) if scorer else [None] * len(group):
                    if logs is None:
                        found.append(UNDETERMINED)
                        scores.append(0.0)
                        continue
                    best = int(np.argmax(logs))
                    found.append(model.languages[best])
                    scores.append(float(1.0 / np.exp(logs - logs[best]).sum()))
            arrays = [*batch.columns, pa.array(found, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return map_in_arrow(docs.select(*[quoted(f.name) for f in kept]), predict, schema)
