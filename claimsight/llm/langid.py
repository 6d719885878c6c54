"""Language identification with bit-sliced Bloom filters over character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimsight.llm.blocks import blocks, texts_of

#: Length of the n-grams, slots of the filter, hash functions.
GRAM = 4
SLOTS = 1 << 19
HASHES = 3
#: Texts of each language that are learned from, whole.
TEXTS_PER_LANGUAGE = 2000
#: A language's filter takes n-grams with at least this share of its n-grams.
LEAST_SHARE = 2e-5

_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


@dataclass(frozen=True)
class Filters:
    """Slots hold one bit per language; 64 languages fill a word."""

    languages: list[str]
    slots: np.ndarray  # (SLOTS, words) of uint64

    def rates(self) -> np.ndarray:
        """False positive rate per language: share of its set bits to the power of hashes."""
        return np.array([self._bit(self.slots, i).mean() ** HASHES for i in range(len(self.languages))])

    @staticmethod
    def _bit(masks: np.ndarray, i: int) -> np.ndarray:
        return (masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)


def _letter_table() -> np.ndarray:
    """Code point to itself if a letter (category L), else to a blank."""
    table = np.full(0x110000, 32, np.uint32)
    for c in range(0x110000):
        if chr(c).isalpha():
            table[c] = c
    return table


_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    if not _letters:
        _letters.append(_letter_table())
    return _letters[0]


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of all texts and the text that each is from.

    Texts are lower-cased, what is no letter becomes one blank, and a blank stands before
    and after each text. N-grams over a text's end do not count, nor those of one letter
    or less.
    """
    joined = "\n".join(texts).lower() if "\n" not in "".join(texts) else None
    if joined is None:
        joined = "\n".join(t.replace("\n", " ") for t in texts).lower()
    points = np.frombuffer(("\n" + joined + "\n").encode("utf-32-le", "replace"), np.uint32)
    breaks = points == 10
    points = letters()[points]
    points[breaks] = 10
    blank = points == 32
    near = np.concatenate([[True], (blank | breaks)[:-1]])
    keep = ~(blank & near)
    points, breaks = points[keep], breaks[keep]
    # One blank at each end of a text: the break itself, which is in two texts' n-grams.
    owner = np.cumsum(breaks) - 1
    n = len(points) - GRAM + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    code = np.where(points == 10, 32, points).astype(np.uint64)
    h = np.zeros(n, np.uint64)
    inner = np.zeros(n, np.int64)
    for k in range(GRAM):
        part = code[k : k + n]
        h = (h ^ part) * _M[0]
        h ^= h >> np.uint64(29)
        inner += part != 32
        if 0 < k < GRAM - 1:
            inner[breaks[k : k + n]] = -GRAM
    ok = inner >= 2
    return h[ok], owner[:n][ok]


def positions(h: np.ndarray, k: int) -> np.ndarray:
    x = (h + np.uint64(k)) * _M[1 + k % 2]
    x ^= x >> np.uint64(31)
    return (x * _M[0]) >> np.uint64(64 - SLOTS.bit_length() + 1)


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> Filters:
    """Fit one filter per language on a bounded sample of labelled texts.

    At most about TEXTS_PER_LANGUAGE texts of each language, chosen by a hash of key and text,
    are learned from, whole. N-grams are counted
    on Spark; the driver gets the frequent ones, at most 1 / LEAST_SHARE per language.
    """
    rows = labelled.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = {r[lang]: r["n"] for r in rows.groupBy(lang).agg(F.count("*").alias("n")).collect()}
    languages = sorted(counts)
    if not languages:
        return Filters([], np.zeros((SLOTS, 1), np.uint64))
    share = F.create_map(
        *[F.lit(x) for v in languages for x in (v, min(1.0, TEXTS_PER_LANGUAGE / counts[v]))]
    )
    draw = F.pmod(F.xxhash64(F.col(key).cast("string"), F.col(text)), F.lit(1 << 20)) / float(1 << 20)
    sample = rows.filter(draw < share[F.col(lang)]).select(lang, F.col(text).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            names, values = np.array(block.column(0).to_pylist(), object), texts_of(block.column(1)).to_pylist()
            h, owner = grams(values)
            for name in dict.fromkeys(names):
                found, n = np.unique(h[names[owner] == name], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(found), pa.string()), pa.array(found.view(np.int64)), pa.array(n)],
                    names=["lang", "gram", "n"],
                )

    table = (
        sample.mapInArrow(count, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    totals = {r["lang"]: r["n"] for r in table.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    least = F.create_map(*[F.lit(x) for v in languages for x in (v, max(2.0, LEAST_SHARE * totals.get(v, 0)))])
    slots = np.zeros((SLOTS, -(-len(languages) // 64)), np.uint64)
    frequent = table.filter(F.col("n") >= least[F.col("lang")]).select("lang", "gram").toArrow()
    names, values = np.array(frequent["lang"].to_pylist(), object), frequent["gram"].to_numpy()
    for i, name in enumerate(languages):
        h = values[names == name].astype(np.int64).view(np.uint64)
        for k in range(HASHES):
            slots[positions(h, k), i // 64] |= np.uint64(1 << (i % 64))
    return Filters(languages, slots)


def decide(model: Filters, rates: np.ndarray, texts: list[str]) -> tuple[list[str], np.ndarray]:
    """Language and score of each text.

    A lookup gives the languages that have an n-gram. A language's hits, less those that
    false positives explain, are its estimate of known n-grams; the largest share wins, ties
    go to the first name. The score is the winner's share of its lead and itself.
    """
    n = len(texts)
    h, owner = grams(texts)
    masks = np.full((len(h), model.slots.shape[1]), np.uint64(0xFFFFFFFFFFFFFFFF))
    for k in range(HASHES):
        masks &= model.slots[positions(h, k)]
    total = np.bincount(owner, minlength=n)
    share = np.zeros((n, len(model.languages)))
    for i in range(len(model.languages)):
        hits = np.bincount(owner, weights=model._bit(masks, i), minlength=n)
        with np.errstate(divide="ignore", invalid="ignore"):
            share[:, i] = np.where(total > 0, (hits / np.maximum(total, 1) - rates[i]) / (1 - rates[i]), 0)
    share = np.clip(share, 0, 1)
    best = share.argmax(axis=1)
    top = share[np.arange(n), best]
    whole = share.sum(axis=1)
    score = np.where(whole > 0, top / np.where(whole > 0, whole, 1), 0.0)
    return [model.languages[i] for i in best], score


def predict(docs: DataFrame, model: Filters, text: str = "text") -> DataFrame:
    """Adds ``lang_pred`` and ``score`` to ``doc_id``; whole texts are read.

    ``und`` with score 0 if the text is null or has no letter. A text of letters without
    any known n-gram gets the first learned language with score 0. The filter has a fixed
    size of SLOTS words per 64 languages and travels with the task.
    """
    rates = model.rates() if model.languages else np.empty(0)
    shared = docs.sparkSession.sparkContext.broadcast((model, rates))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters, fpr = shared.value
        for block in blocks(batches, text):
            texts = texts_of(block.column(text)).to_pylist()
            known = [bool(filters.languages) and _has_letter(t) for t in texts]
            names, scores = decide(filters, fpr, texts) if filters.languages else ([], [])
            yield pa.RecordBatch.from_arrays(
                [
                    *[c for c, name in zip(block.columns, block.schema.names) if name != text],
                    pa.array([names[i] if ok else "und" for i, ok in enumerate(known)], pa.string()),
                    pa.array([float(scores[i]) if ok else 0.0 for i, ok in enumerate(known)], pa.float64()),
                ],
                names=[*[x for x in block.schema.names if x != text], "lang_pred", "score"],
            )

    out = docs.drop(text, "lang_pred", "score").schema
    kept = docs.drop("lang_pred", "score")
    return kept.mapInArrow(run, out.add("lang_pred", "string").add("score", "double"))


def _has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def held_out(key: str = "doc_id") -> Column:
    """A quarter of the documents by the checksum of their id; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> DataFrame:
    """Learn from the labelled documents that are not held out; predict all.

    Result: ``doc_id``, ``held_out``, ``lang_pred``, ``score``. Null or empty texts and texts
    without letters are ``und``. Rows without a language are predicted, not learned from;
    with no labelled row at all everything is ``und``. Repeated rows and null ids stay; an
    empty table gives no rows; other columns are ignored.
    """
    model = learn(docs.filter(~held_out(key)), text, lang, key)
    rows = docs.select(F.col(key).alias("doc_id"), held_out(key).alias("held_out"), F.col(text).alias("text"))
    return predict(rows, model, "text")
