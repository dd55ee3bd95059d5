"""Secret scan over a trigram inverted index.

Each rule's regular expression is turned into a Boolean query on trigrams: what
a match must contain, derived from the expression's structure. A task indexes
its documents batch by batch: the postings of every trigram that some query
names, over ASCII-lower-cased bytes. A rule's candidates come from unions and
intersections of postings, and only they are verified with the expression. A
rule without mandatory trigrams scans every document. Index segments live and
die with their batch, so memory is bounded and nothing is shuffled.

Defined cases: null text is empty text and has no span. Rows with a null or
repeated ``doc_id`` are scanned like any other. An empty table gives an empty
result. Texts of any length are scanned whole. Rules of one kind give leftmost
non-overlapping matches; spans of different kinds may overlap.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from re import _constants as op
from re import _parser as parser

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from crownlake.llm.common import prepare, texts, utf8_bytes

# A query is True (no condition), a trigram, or ("and"/"or", parts).
Query = bool | str | tuple
# Sets of strings that a part of an expression can be are followed up to this size; beyond it they become a query.
MOST_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """``minimum``: characters that a match, or its group ``group``, must have; shorter matches are dropped.

    ``begin``: the group at which the span starts (0: the whole match).
    """

    kind: str
    pattern: str
    group: int = 0
    minimum: int = 0
    base: bool = False
    begin: int = 0


# The base kinds in their listed order, then formats of well-known credentials.
RULES = [
    Rule("assign", r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, True),
    Rule("hex", r"[0-9a-f]+", 0, 24, True),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    # From the first letter of a run of scheme characters; the run is walked once, however long it is.
    Rule("url_login", r"(?<![a-z0-9+.-])[0-9+.-]*+([a-z][a-z0-9+.-]++)://[^\s:/@]*+:[^\s:/@]{3,}+@", begin=1),
    Rule("bearer", r"(?ai:authorization: ?bearer) [A-Za-z0-9._~+/-]{16,}"),
    Rule("hosting_token", r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("payment_key", r"[sr]k_(?:live|test)_[A-Za-z0-9]{16,}"),
]


def every(parts: list[Query]) -> Query:
    parts = [p for p in dict.fromkeys(parts) if p is not True]
    return True if not parts else parts[0] if len(parts) == 1 else ("and", *parts)


def some(parts: list[Query]) -> Query:
    parts = list(dict.fromkeys(parts))
    return True if not parts or True in parts else parts[0] if len(parts) == 1 else ("or", *parts)


def contains(strings: set[str]) -> Query:
    """What a text that has one of the strings must contain."""
    return some([every([s[i : i + 3] for i in range(len(s) - 2)]) for s in sorted(strings)])


@dataclass
class Part:
    """Facts about a piece of an expression: all strings it can be (None: too many), and a query that its matches fulfil."""

    strings: set[str] | None
    query: Query = True


def _spell(node: tuple) -> Part:
    """Facts about one parsed node; letters are folded to lower case."""
    kind, value = node
    if kind is op.LITERAL:
        return Part({chr(value).lower()}) if value < 128 else Part(None)
    if kind is op.IN:
        found: set[str] = set()
        for what, v in value:
            if what is op.LITERAL and v < 128:
                found.add(chr(v).lower())
            elif what is op.RANGE and v[1] < 128 and v[1] - v[0] < 8:
                found |= {chr(c).lower() for c in range(v[0], v[1] + 1)}
            else:
                return Part(None)
        return Part(found) if len(found) <= 8 else Part(None)
    if kind is op.SUBPATTERN:
        return spell(value[3])
    if kind is op.BRANCH:
        parts = [spell(b) for b in value[1]]
        query = some([p.query if p.strings is None else every([p.query, contains(p.strings)]) for p in parts])
        strings = set().union(*(p.strings for p in parts if p.strings)) if all(p.strings is not None for p in parts) else None
        return Part(strings, query if strings is None else True)
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT):
        low, high, inner = value
        part = spell(inner)
        if (low, high) == (0, 1) and part.strings is not None:
            return Part(part.strings | {""})
        if low == high == 1:
            return part
        # The strings of one round are within each match with at least one.
        return Part(None, every([part.query, contains(part.strings)]) if low and part.strings else part.query if low else True)
    return Part(None)


def spell(nodes) -> Part:
    """Facts about a sequence: strings that can be joined are, and become a query where they cannot."""
    run: set[str] | None = {""}
    queries: list[Query] = []
    whole = True
    for node in nodes:
        part = _spell(node)
        queries.append(part.query)
        joined = {a + b for a in run for b in part.strings} if part.strings is not None and len(run) * len(part.strings) <= MOST_STRINGS else None
        if joined is None:
            queries.append(contains(run))
            whole, run = False, part.strings if part.strings is not None else {""}
        else:
            run = joined
    return Part(run, every(queries)) if whole else Part(None, every([*queries, contains(run)]))


def trigram_query(pattern: str) -> Query:
    """A Boolean trigram query that every text with a match of the pattern fulfils; True if nothing is mandatory."""
    part = spell(parser.parse(pattern))
    return every([part.query, contains(part.strings)]) if part.strings is not None else part.query


def trigrams(query: Query) -> set[str]:
    return {query} if isinstance(query, str) else set() if query is True else set().union(*map(trigrams, query[1:]))


class Segment:
    """Inverted index of a batch: sorted rows of each trigram of a vocabulary."""

    def __init__(self, batch: pa.Array, vocabulary: list[str], table: np.ndarray) -> None:
        data, offsets = utf8_bytes(pc.ascii_lower(batch))
        self.rows = len(batch)
        x = data.astype(np.uint32)
        names = table[(x[:-2] << 16) | (x[1:-1] << 8) | x[2:]] if len(x) > 2 else np.zeros(0, table.dtype)
        at = np.flatnonzero(names)
        of = np.searchsorted(offsets, at, side="right") - 1
        inside = at + 3 <= offsets[of + 1]
        pairs = np.unique(names[at][inside].astype(np.int64) * max(1, self.rows) + of[inside])
        ids, rows = pairs // max(1, self.rows), pairs % max(1, self.rows)
        edges = np.searchsorted(ids, np.arange(1, len(vocabulary) + 2))
        self.postings = {t: rows[edges[i] : edges[i + 1]] for i, t in enumerate(vocabulary)}

    def candidates(self, query: Query) -> np.ndarray:
        if query is True:
            return np.arange(self.rows)
        if isinstance(query, str):
            return self.postings[query]
        join = np.intersect1d if query[0] == "and" else np.union1d
        return reduce(join, (self.candidates(q) for q in query[1:]))


class Scanner:
    """Compiled rules, their queries and the table that numbers the trigrams they name."""

    def __init__(self, rules: list[Rule]) -> None:
        self.rules = [(r, re.compile(r.pattern), trigram_query(r.pattern)) for r in rules]
        self.vocabulary = sorted(set().union(*(trigrams(q) for _, _, q in self.rules)))
        self.table = np.zeros(1 << 24, np.uint16)
        for i, t in enumerate(self.vocabulary):
            a, b, c = t.encode()
            self.table[a << 16 | b << 8 | c] = i + 1

    def spans(self, batch: pa.Array) -> list[list[tuple[int, int, int]]]:
        """(start, end, rule) of every span of each text, in code points, ordered by start, then rule."""
        segment = Segment(batch, self.vocabulary, self.table)
        out: list[list[tuple[int, int, int]]] = [[] for _ in range(len(batch))]
        wholes: dict[int, str] = {}
        for number, (rule, expression, query) in enumerate(self.rules):
            for row in segment.candidates(query):
                if (row := int(row)) not in wholes:
                    wholes[row] = batch[row].as_py()
                for m in expression.finditer(wholes[row]):
                    if len(m[rule.group]) >= rule.minimum:
                        out[row].append((m.start(rule.begin), m.end(), number))
        for found in out:
            found.sort(key=lambda s: (s[0], s[2]))
        return out


def written(spans: list[tuple[int, int, int]], rules: list[Rule]) -> str:
    return ",".join(f"{rules[n].kind}:{start}:{end}" for start, end, n in spans)


def _scan(rules: list[Rule]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for batch in batches:
            found = scanner.spans(batch.column("text"))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "kinds": pa.array([[rules[n].kind for _, _, n in f] for f in found], pa.list_(pa.string())),
                    "base": pa.array([written([s for s in f if rules[s[2]].base], rules) for f in found], pa.string()),
                    "spans": pa.array([written(f, rules) for f in found], pa.string()),
                }
            )

    return run


def find_secrets(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """``doc_id, kinds, base, spans`` of every row: kinds of all spans in order, base spans and all spans as ``kind:start:end``."""
    prepare(docs.sparkSession)
    return texts(docs).mapInArrow(_scan(rules), "doc_id bigint, kinds array<string>, base string, spans string")
