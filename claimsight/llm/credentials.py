"""Secret scan: known forms by pattern, others by automata inferred from the known ones.

The values that the patterns find are labelled credentials. From a bounded sample of them one
probabilistic automaton per kind is inferred (``grammars``), and one from ordinary short runs
of the same letters. Every longer run outside the known spans is then scored: how much likelier
is it as a credential of some kind than as an ordinary run.
"""

from __future__ import annotations

import heapq
import math
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from claimsight.llm.blocks import blocks
from claimsight.llm.grammars import Automaton

# Kinds in the order in which spans of one start are listed, and their forms.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 12, 18, 16

INFERRED = "grammar"
ORDINARY = "ordinary"
#: Letters of a run that is scored, how many there are, and how long such a run is at least.
RUN = re.compile(r"[A-Za-z0-9+/_.=-]+")
ALPHABET = 68
LEAST_RUN = 16
#: Ordinary runs that the background is learned from have 8 letters up to the length above.
LEAST_ORDINARY = 8

#: Examples per kind: the values with the smallest hash among all distinct ones of the corpus.
EXAMPLES = 500
#: Longer values are scored like others, but not learned from.
LONGEST_EXAMPLE = 256
#: A run is a secret if it is e^14 (a million) times likelier as a credential.
ODDS = 14.0
#: And its log likelihood per letter is at most this below the least of the kind's examples.
SLACK = 0.5

Span = tuple[int, int, int, str]


def known_spans(text: str) -> list[Span]:
    """Spans of the fixed forms as (start, place of the kind, end, value).

    Matches are the leftmost ones that do not overlap, per kind; too short ones are dropped
    after that, so what they cover is not searched again.
    """
    found = []
    for m in ASSIGN.finditer(text):
        if m.end(2) - m.start(2) >= LEAST_ASSIGN:
            found.append((m.start(), 0, m.end(), m[2]))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= LEAST_ACCESS:
                found.append((m.start(), 1, m.end(), m[0]))
    for m in _LONG_HEX.finditer(text):
        found.append((m.start(), 2, m.end(), m[0]))
    found.sort(key=lambda s: s[:3])
    return found


# The same as HEX with its length, as nothing stands between two letters of a run.
_LONG_HEX = re.compile(rf"(?<![0-9a-f])[0-9a-f]{{{LEAST_HEX},}}")
_ANY_RUN = rf"[A-Za-z0-9+/_.=-]{{{LEAST_RUN}}}"
_ANY_NAME = r"(?i:password|passwd|secret|token|api_?key)"
_LONG_RUN = re.compile(rf"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{{{LEAST_RUN},}}")
_ORDINARY_RUN = re.compile(
    rf"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{{{LEAST_ORDINARY},{LEAST_RUN - 1}}}(?![A-Za-z0-9+/_.=-])"
)


def may_hold(texts: pa.Array) -> pa.Array:
    """Whether a text holds a run or a name at all: the others need no closer look."""
    texts = pc.fill_null(texts, "")
    return pc.or_(pc.match_substring_regex(texts, _ANY_RUN), pc.match_substring_regex(texts, _ANY_NAME))


def free_runs(text: str, spans: list[Span], runs: re.Pattern) -> Iterator[tuple[int, int, str]]:
    """Runs that touch no span. Spans are sorted by their start."""
    k, reach = 0, 0
    for m in runs.finditer(text):
        while k < len(spans) and spans[k][0] < m.end():
            reach = max(reach, spans[k][2])
            k += 1
        if m.start() >= reach:
            yield m.start(), m.end(), m[0]


class _Smallest:
    """The ``size`` distinct values with the smallest hash, in bounded memory."""

    def __init__(self, size: int):
        self.size = size
        self.heap: list[tuple[int, str]] = []
        self.held: set[str] = set()

    def add(self, value: str) -> None:
        if value in self.held:
            return
        entry = (-zlib.crc32(value.encode()), value)
        if len(self.heap) < self.size:
            heapq.heappush(self.heap, entry)
        elif entry > self.heap[0]:
            self.held.discard(heapq.heapreplace(self.heap, entry)[1])
        else:
            return
        self.held.add(value)


def examples(docs: DataFrame, text: str, size: int) -> dict[str, list[str]]:
    """Labelled credentials by kind and ordinary runs, ``size`` distinct values of each.

    Every text is read; ordinary runs are those of texts with a credential. A task keeps its ``size`` smallest hashes per kind, and the driver
    receives ``size`` values per kind, however large the corpus is.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = {kind: _Smallest(size) for kind in (*KINDS, ORDINARY)}
        for block in blocks(batches, "text"):
            texts = block.column("text")
            for x in texts.filter(may_hold(texts)).to_pylist():
                spans = known_spans(x)
                if not spans:
                    continue
                for _, kind, _, value in spans:
                    if len(value) <= LONGEST_EXAMPLE:
                        kept[KINDS[kind]].add(value)
                for _, _, value in free_runs(x, spans, _ORDINARY_RUN):
                    kept[ORDINARY].add(value)
        rows = [(k, v, -h) for k, s in kept.items() for h, v in s.heap]
        kinds, values, hashes = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(kinds, pa.string()), pa.array(values, pa.string()), pa.array(hashes, pa.int64())],
            names=["kind", "value", "hash"],
        )

    lean = docs.select(F.col(text).alias("text")).filter(F.col("text").isNotNull())
    found = lean.mapInArrow(run, "kind string, value string, hash long").distinct().persist()
    try:
        return {
            kind: [
                r.value
                for r in found.filter(F.col("kind") == kind).orderBy("hash", "value").limit(size).collect()
            ]
            for kind in (*KINDS, ORDINARY)
        }
    finally:
        found.unpersist()


class Scorer:
    """Log odds of a run being a credential of the likeliest kind."""

    def __init__(self, learned: dict[str, list[str]]):
        self.formats = []
        for kind in KINDS:
            values = learned.get(kind)
            if values:
                grammar = Automaton(values, ALPHABET)
                least = min(self._per_letter(grammar, v) for v in values)
                self.formats.append((grammar, least - SLACK))
        self.ordinary = Automaton(learned.get(ORDINARY, []), ALPHABET)

    @staticmethod
    def _per_letter(grammar: Automaton, run: str) -> float:
        return grammar.log_likelihood(run) / (len(run) + 1)

    def odds(self, run: str) -> float:
        """Kinds count whose grammar finds the run about as likely as its own examples."""
        fits = [g.log_likelihood(run) for g, least in self.formats if self._per_letter(g, run) >= least]
        return max(fits) - self.ordinary.log_likelihood(run) if fits else -math.inf


SPANS = ArrayType(
    StructType().add("kind", "string").add("start", "long").add("end", "long").add("odds", "double")
)


def find(
    docs: DataFrame, text: str = "text", *, size: int = EXAMPLES, odds: float = ODDS, spans: str = "spans"
) -> DataFrame:
    """Every row with the spans of its secrets, in the order of start and kind.

    Spans are in code points, the end excluded. Those of the fixed forms have the kinds of
    ``KINDS`` and no odds. Runs of 16 letters or more that touch none of them are added as
    ``grammar`` if their log odds reach ``odds``. Automata are learned from ``size`` distinct
    values per kind; without any known value nothing is added.

    Null and empty texts have no spans. Texts are read whole. Repeated rows stay and get equal
    spans, an empty table stays empty. Other columns pass; one named like ``spans`` is replaced.
    """
    scorer = Scorer(examples(docs, text, size))
    keep = docs.select(*[c for c in docs.columns if c != spans])
    out = StructType([*keep.schema.fields]).add(spans, SPANS)
    kind = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("odds", pa.float64())])
    )

    def of_text(x: str) -> list[dict]:
        known = known_spans(x)
        rows = [(s, k, e, None) for s, k, e, _ in known]
        for s, e, run in free_runs(x, known, _LONG_RUN):
            score = scorer.odds(run)
            if score >= odds:
                rows.append((s, len(KINDS), e, score))
        rows.sort(key=lambda r: r[:3])
        names = (*KINDS, INFERRED)
        return [{"kind": names[k], "start": s, "end": e, "odds": score} for s, k, e, score in rows]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text):
            texts = block.column(text)
            todo = may_hold(texts).to_numpy(zero_copy_only=False)
            held = iter(texts.filter(pa.array(todo)).to_pylist())
            found = pa.array([of_text(next(held)) if k else [] for k in todo], kind)
            yield pa.RecordBatch.from_arrays([*block.columns, found], names=out.fieldNames())

    return keep.mapInArrow(run, out)


def _listed(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


def _of_kinds(*kinds: str) -> Column:
    return F.filter("spans", lambda s: s.kind.isin(*kinds))


def digest(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Per row: key, spans by kind, a digest of the fixed ones, and all spans as text."""
    lean = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    found = find(lean, **options)
    counts = [F.size(_of_kinds(k)).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(_listed(_of_kinds(*KINDS)), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )
