"""Secrets in texts, with weak parts of a credential linked to each other.

Strong patterns are reported wherever they stand. Weak parts (a bare key-like
word, an account name, an endpoint) say little alone; they are reported only
when parts that complement them lie within the same scope.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from facetforge.llm.common import map_in_arrow, quoted, without

# Characters on either side of a part that belong to its scope.
SCOPE_CHARS = 200


def _either_case(words: str) -> str:
    return re.sub("[a-z]", lambda m: f"[{m[0]}{m[0].upper()}]", words)


_NAMES = _either_case("password|passwd|secret|token|api_?key")
# The strong patterns and the length below which a match is
# dropped. Runs of hex digits are searched with their length, which finds the
# same runs.
_ASSIGN = re.compile(rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_ASSIGN_CHARS, _ACCESS_CHARS = 6, 20

# Weak parts.
_ACCOUNT = re.compile(
    rf"""(?<![A-Za-z0-9_])({_either_case("user|username|login|client_?id|account")})"""
    r"""["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.@=-]{3,}"""
)
_KEYLIKE = re.compile(r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/]{32,64}={0,2}(?![A-Za-z0-9+/=_-])")
_ENDPOINT = re.compile(
    r"[a-z][a-z0-9+]{1,9}://[A-Za-z0-9.-]+(?::[0-9]{1,5})?"
    r"|(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?::[0-9]{1,5})?(?![0-9.])"
)

KINDS = ("assign", "access", "hex", "linked_account", "linked_secret", "linked_endpoint")
BASE_KINDS = KINDS[:3]

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) of the strong patterns, in code points."""
    spans: list[Span] = []
    if ":" in text or "=" in text:
        for m in _ASSIGN.finditer(text):
            if len(m[2]) >= _ASSIGN_CHARS:
                spans.append(("assign", *m.span()))
    if "AKIA" in text:
        for m in _ACCESS.finditer(text):
            if m.end() - m.start() >= _ACCESS_CHARS:
                spans.append(("access", *m.span()))
    spans.extend(("hex", *m.span()) for m in _HEX.finditer(text))
    return spans


def _mixed(word: str) -> bool:
    return (
        any("a" <= c <= "z" for c in word)
        and any("A" <= c <= "Z" for c in word)
        and any("0" <= c <= "9" for c in word)
    )


class _Scopes:
    """Which of the given spans lie within a distance of another span."""

    def __init__(self, spans: list[Span], scope: int):
        # Spans of one pattern do not overlap; of several they may, so the ends
        # are made monotone for the search.
        self.spans = sorted(spans, key=lambda s: s[2])
        self.ends = [s[2] for s in self.spans]
        self.scope = scope
        self.first_start: list[int] = []
        low = None
        for s in reversed(self.spans):
            low = s[1] if low is None else min(low, s[1])
            self.first_start.append(low)
        self.first_start.reverse()

    def near(self, span: Span) -> bool:
        """Whether any span but this one ends after this scope begins and
        starts before it ends."""
        at = bisect_left(self.ends, span[1] - self.scope)
        while at < len(self.spans) and self.first_start[at] <= span[2] + self.scope:
            other = self.spans[at]
            if other[1] <= span[2] + self.scope and other[1:] != span[1:]:
                return True
            at += 1
        return False


def linked_spans(text: str, base: list[Span], scope: int = SCOPE_CHARS) -> list[Span]:
    """Weak parts whose complement co-occurs within the scope.

    A key-like word needs an access identifier or an account; an account needs
    a secret (strong, or key-like); an endpoint needs both an identifier and a
    secret. Weak parts inside strong spans are the strong spans' own.
    """
    accounts = [("linked_account", *m.span()) for m in _ACCOUNT.finditer(text)] if (
        ":" in text or "=" in text
    ) else []
    identifiers = [s for s in base if s[0] == "access"] + accounts
    if not identifiers:
        return []
    strong = [s for s in base if s[0] != "access"]
    taken: list[list[int]] = []
    for _, start, end in sorted(base, key=lambda s: s[1]):
        if taken and start < taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], end)
        else:
            taken.append([start, end])
    taken_ends = [end for _, end in taken]

    def free(start: int, end: int) -> bool:
        at = bisect_left(taken_ends, start + 1)
        return at == len(taken) or taken[at][0] >= end

    keylike = [
        ("linked_secret", *m.span())
        for m in _KEYLIKE.finditer(text)
        if _mixed(m[0]) and free(*m.span())
    ]
    by_identifier = _Scopes(identifiers, scope)
    secrets = [s for s in keylike if by_identifier.near(s)]
    by_secret = _Scopes(strong + secrets, scope)
    found = [s for s in accounts if free(*s[1:]) and by_secret.near(s)] + secrets
    if strong or secrets:
        for m in _ENDPOINT.finditer(text):
            span = ("linked_endpoint", *m.span())
            if free(*m.span()) and by_identifier.near(span) and by_secret.near(span):
                found.append(span)
    return found


_SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
        ]
    )
)
_ARROW_SPANS = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
)


def find_secrets(
    docs: DataFrame,
    text_column: str = "text",
    spans_column: str = "spans",
    scope: int = SCOPE_CHARS,
) -> DataFrame:
    """The rows with all spans (kind, start, end) of their text in
    ``spans_column``, by start, then by kind in the order of KINDS. Positions
    count code points; the end is exclusive.

    Scopes lie within one text, so texts are handled apart and nothing is
    shuffled; within a text, parts are joined by sorted intervals. NULL and
    empty texts have no spans. A column already named like the new one is
    replaced. Rows and repeats are kept as they are.
    """
    kept = without(docs.schema, [spans_column])
    schema = T.StructType([*kept, T.StructField(spans_column, _SPANS)])
    names, place = schema.names, [f.name for f in kept].index(text_column)
    order = {kind: i for i, kind in enumerate(KINDS)}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column(place):
                text = value.as_py() or ""
                spans = base_spans(text)
                spans += linked_spans(text, spans, scope)
                spans.sort(key=lambda s: (s[1], order[s[0]], s[2]))
                rows.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(rows, _ARROW_SPANS)], names=names
            )

    return map_in_arrow(docs.select(*[quoted(f.name) for f in kept]), scan, schema)
