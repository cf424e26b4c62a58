"""Secret scans with a trigram inverted index.

From each rule's regular expression a Boolean query over trigrams is derived: every match holds, for
each clause, all trigrams of one of its alternatives. Documents are indexed in blocks: the block's
bytes, in lower case, give for each trigram that some rule asks for the posting list of the documents
that hold it. A rule's query intersects and unites posting lists, and only the candidates left are
matched. A rule without mandatory trigrams, such as a run of hexadecimal digits, scans all texts.
The work is a narrow transformation: no shuffle, and one block in memory at a time.

Defined results: null text counts as empty and has no span; spans are code points of the whole match,
end exclusive; overlapping spans of different kinds are all reported; repeated rows, null ids and
further columns pass through.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from re import _constants as op
from re import _parser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierlake.llm.common import whole_text

BLOCK_BYTES = 2 << 20
#: Longer lists of possible strings are not followed; the query only gets weaker by that.
MAX_STRINGS = 64
MASK = "[SECRET]"


@dataclass(frozen=True)
class Rule:
    """A kind of secret. Matches whose ``group`` is shorter than ``least`` are dropped."""

    kind: str
    pattern: str
    flags: int = 0
    group: int = 0
    least: int = 0

    def spans(self, text: str) -> list[tuple[int, int]]:
        found = _compiled(self.pattern, self.flags).finditer(text)
        return [m.span() for m in found if m.end(self.group) - m.start(self.group) >= self.least]


@lru_cache(maxsize=64)
def _compiled(pattern: str, flags: int) -> re.Pattern:
    return re.compile(pattern, flags | re.ASCII)


# The base rules, in the order in which kinds are listed.
BASE = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        re.IGNORECASE,
        group=2,
        least=12,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=18),
    Rule("hex", r"[0-9a-f]+", least=16),
)
#: Formats of further credentials that their issuers document.
FURTHER = (
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("forge_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
)
RULES = BASE + FURTHER

Clause = frozenset[frozenset[str]]


def _product(left: set[str], right: set[str]) -> set[str] | None:
    return {a + b for a in left for b in right} if len(left) * len(right) <= MAX_STRINGS else None


def _class(items: list) -> set[str] | None:
    """The characters of a small class, in lower case."""
    out: set[str] = set()
    for kind, value in items:
        if kind is op.LITERAL:
            out.add(chr(value).lower())
        elif kind is op.RANGE and value[1] - value[0] < MAX_STRINGS:
            out |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return out if len(out) <= 8 else None


def _clause(strings: set[str]) -> Clause | None:
    """What any text with one of the strings holds."""
    if min(map(len, strings)) < 3:
        return None
    return frozenset(frozenset(s[k : k + 3] for k in range(len(s) - 2)) for s in strings)


def _analyse(parsed) -> tuple[set[str] | None, set[Clause]]:
    """All strings that the expression matches, if few, and else the clauses of its matches."""
    strings, exact, clauses = {""}, True, set()

    def close() -> None:
        nonlocal strings, exact
        if clause := _clause(strings):
            clauses.add(clause)
        strings, exact = {""}, False

    for kind, value in parsed:
        part: set[str] | None = None
        inner: set[Clause] = set()
        if kind is op.LITERAL:
            part = {chr(value).lower()}
        elif kind is op.IN:
            part = _class(value)
        elif kind is op.AT:
            part = {""}
        elif kind is op.SUBPATTERN:
            part, inner = _analyse(value[3])
        elif kind is op.BRANCH:
            found = [_analyse(branch) for branch in value[1]]
            if all(s is not None for s, _ in found):
                part = set().union(*(s for s, _ in found))
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT):
            least, most, body = value
            once, inside = _analyse(body)
            if most == 1 and once is not None:
                part = once | {""} if least == 0 else once
            elif least:
                inner = inside if once is None else {c} if (c := _clause(once)) else set()
        joined = _product(strings, part) if part is not None else None
        if joined is not None:
            strings = joined
            continue
        close()
        clauses |= inner
        if part is not None:
            strings = part
    if exact:
        return strings, clauses
    close()
    return None, clauses


@lru_cache(maxsize=64)
def trigram_query(pattern: str, flags: int = 0) -> tuple[Clause, ...]:
    """Clauses that hold for every match; none means that the rule scans fully."""
    strings, clauses = _analyse(_parser.parse(pattern, flags | re.ASCII))
    if strings is not None and (clause := _clause(strings)):
        clauses = clauses | {clause}
    return tuple(sorted(clauses, key=lambda c: sorted(map(sorted, c))))


class Block:
    """The inverted index of some documents, for the trigrams that the rules ask for."""

    def __init__(self, texts: list[bytes], wanted: list[str], codes: np.ndarray):
        self.size = len(texts)
        data = np.frombuffer(b"\x00\x00".join(texts).lower() + b"\x00\x00", dtype=np.uint8)
        code = data[:-2].astype(np.int32)
        code <<= 8
        code |= data[1:-1]
        code <<= 8
        code |= data[2:]
        number = codes[code]
        at = np.flatnonzero(number)
        starts = np.cumsum([0] + [len(t) + 2 for t in texts[:-1]])
        pairs = np.unique(number[at].astype(np.int64) * self.size + np.searchsorted(starts, at, "right") - 1)
        bounds = np.searchsorted(pairs, np.arange(1, len(wanted) + 2) * self.size)
        self.postings = {
            t: pairs[bounds[k] : bounds[k + 1]] % self.size for k, t in enumerate(wanted)
        }

    def candidates(self, query: tuple[Clause, ...]) -> np.ndarray:
        left = np.arange(self.size)
        for clause in query:
            held = [self._all(alternative) for alternative in clause]
            left = np.intersect1d(left, np.unique(np.concatenate(held)), assume_unique=True)
        return left

    def _all(self, trigrams: frozenset[str]) -> np.ndarray:
        lists = sorted((self.postings[t] for t in trigrams), key=len)
        left = lists[0]
        for more in lists[1:]:
            left = np.intersect1d(left, more, assume_unique=True)
        return left


@lru_cache(maxsize=4)
def _wanted(rules: tuple[Rule, ...]) -> tuple[list[str], np.ndarray]:
    """The trigrams in use, and the table from three bytes to their numbers from 1."""
    asked = {t for r in rules for c in trigram_query(r.pattern, r.flags) for a in c for t in a}
    wanted = sorted(t for t in asked if t.isascii())
    codes = np.zeros(1 << 24, dtype=np.uint16)
    for k, t in enumerate(wanted):
        a, b, c = t.encode()
        codes[a << 16 | b << 8 | c] = k + 1
    return wanted, codes


def scan_block(texts: list[str], rules: tuple[Rule, ...] = RULES) -> list[list[tuple[int, int, int]]]:
    """For each text its spans (start, number of the rule, end), sorted."""
    wanted, codes = _wanted(rules)
    block = Block([t.encode() for t in texts], wanted, codes)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for k, rule in enumerate(rules):
        for d in block.candidates(trigram_query(rule.pattern, rule.flags)):
            out[d] += [(start, k, end) for start, end in rule.spans(texts[d])]
    return [sorted(spans) for spans in out]


def _blocks(texts: pd.Series) -> Iterator[list[str]]:
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= BLOCK_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def with_spans(
    docs: DataFrame, text: str = "text", into: str = "spans", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """``docs`` with an array of (kind, start, end) for each whole text in column ``into``."""

    @F.pandas_udf("array<struct<kind: string, start: int, end: int>>")
    def spans(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            found = [s for block in _blocks(batch) for s in scan_block(block, rules)]
            yield pd.Series(
                [[{"kind": rules[k].kind, "start": a, "end": b} for a, k, b in s] for s in found],
                dtype=object,
            )

    return docs.withColumn(into, spans(whole_text(F.col(text))))


def secret_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) for every row of ``docs``."""
    found = with_spans(docs.select("doc_id", "text"), into="found").select("doc_id", "found")
    base = [r.kind for r in BASE]
    shown = "concat_ws(',', transform({}, s -> concat_ws(':', s.kind, s.start, s.end)))"
    only = "filter(found, s -> s.kind in ({}))".format(", ".join(f"'{k}'" for k in base))
    return found.select(
        "doc_id",
        *(
            F.expr(f"cast(size(filter(found, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}")
            for k in base
        ),
        F.sha2(F.expr(shown.format(only)), 256).alias("base_sha256"),
        F.expr(shown.format("found")).alias("spans"),
    )


def mask_text(text: str, spans: list[tuple[int, int]]) -> str:
    """The text with each maximal run of overlapping or touching spans replaced by the mask."""
    out, at = [], 0
    start = end = -1
    for a, b in sorted(spans):
        if a > end:
            if end >= 0:
                out += [text[at:start], MASK]
                at = end
            start, end = a, b
        end = max(end, b)
    if end >= 0:
        out += [text[at:start], MASK]
        at = end
    return "".join(out) + text[at:]


def mask_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with the secrets of ``text`` masked and ``n_chars``, if there, brought in line.

    All rows stay; rows without a secret stay exactly as they are, null texts included.
    """

    @F.pandas_udf("string")
    def masked(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = []
            for block in _blocks(batch):
                for text, spans in zip(block, scan_block(block, rules), strict=True):
                    out.append(mask_text(text, [(a, b) for a, _, b in spans]) if spans else None)
            yield pd.Series(out, dtype=object)

    rows = docs.select(F.struct("*").alias("__row"), masked(whole_text(F.col("text"))).alias("__new"))
    values = {c: F.col("__row")[c] for c in docs.columns}
    values["text"] = F.coalesce("__new", F.col("__row")["text"])
    if "n_chars" in values:
        kind = docs.schema["n_chars"].dataType
        values["n_chars"] = F.coalesce(F.char_length("__new").cast(kind), F.col("__row")["n_chars"])
    return rows.select(*(v.alias(c) for c, v in values.items()))
