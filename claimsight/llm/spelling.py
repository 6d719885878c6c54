"""Spelling variants: words within one edit of a more frequent word.

The vocabulary is cut into sorted lists whose words are equal outside a region of their
letters. A list is scanned with dynamic programming: each word walks down the list, keeps the
banded rows of the edit matrix over the letters that neighbours share, and skips the range of
words whose shared letters already are more than one edit away.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimsight.llm.blocks import blocks, split_words, texts_of
from claimsight.session import materialize

#: A list with more words is cut into two by halving its region.
LIST_WORDS = 500
LIST = ["m", "i", "j", "head", "tail"]
TOO_FAR = 2


# Words -------------------------------------------------------------------------------------


def letter_runs(texts: pa.LargeStringArray) -> pa.LargeStringArray:
    """Texts with A-Z in lower case and a blank for every byte that is in no letter.

    Letters are A-Z, a-z and U+00C0 to U+00FF, in UTF-8 the byte C3 and the byte after it.
    """
    n = len(texts)
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64, n + 1)
    if data is None or ends[-1] == 0:
        return texts
    raw = np.frombuffer(data, np.uint8, int(ends[-1]))
    out = np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint8)
    lead = raw == 0xC3
    letter = (out >= 97) & (out <= 122) | lead
    letter[1:] |= lead[:-1]
    out[~letter] = 32
    return pa.LargeStringArray.from_buffers(n, pa.py_buffer(ends), pa.py_buffer(out))


def word_counts(docs: DataFrame, key: str, text: str, min_chars: int, one_in: int) -> DataFrame:
    """Words of ``min_chars`` or more with their occurrences ``n``, over all texts.

    A run of letters whose crc32 (of ``<key>:<run>``) ``one_in`` divides loses a letter.
    Tasks count block by block; only their distinct words are shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            codes, starts, words = split_words(letter_runs(texts_of(block.column("text"))))
            doc = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
            long = pc.utf8_length(words).to_numpy(zero_copy_only=False) >= min_chars
            keep = long[codes]
            pairs, times = np.unique(doc[keep] * len(words) + codes[keep], return_counts=True)
            of, code = np.divmod(pairs, max(1, len(words)))
            keys = ["" if k is None else k for k in block.column("key").to_pylist()]
            seeds = [zlib.crc32(f"{k}:".encode()) for k in keys]
            raw = words.cast(pa.large_binary()).to_pylist()
            hashes = np.array(
                [zlib.crc32(raw[c], seeds[d]) for d, c in zip(of.tolist(), code.tolist(), strict=True)],
                np.int64,
            )
            cut = np.flatnonzero(hashes % one_in == 0)
            total = np.bincount(code, times, len(words)).astype(np.int64)
            found, counts = [], []
            for k in cut:
                w = raw[code[k]].decode()
                at = int(hashes[k]) % len(w)
                total[code[k]] -= times[k]
                if len(w) > min_chars:
                    found.append(w[:at] + w[at + 1 :])
                    counts.append(int(times[k]))
            whole = np.flatnonzero(total)
            for w, c in (
                (words.take(pa.array(whole)).cast(pa.string()), pa.array(total[whole])),
                (pa.array(found, pa.string()), pa.array(counts, pa.int64())),
            ):
                yield pa.RecordBatch.from_arrays([w, c], names=["word", "n"])

    lean = docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"))
    counted = lean.filter(F.col("text").isNotNull()).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


# Lists -------------------------------------------------------------------------------------


def _in_region(words: DataFrame) -> DataFrame:
    """Words of class ``m`` as head, middle and tail of the region from ``i`` to ``j``.

    A class holds words of ``m`` and ``m + 1`` letters, the longer with one letter more in the
    region. Words of one class that are one edit apart inside the region have the same head
    and tail.
    """
    before = F.expr("left(word, i)")
    after = F.expr("right(word, m - j)")
    middle = F.expr("substr(word, i + 1, char_length(word) - i - (m - j))")
    return words.select(
        "m", "i", "j", before.alias("head"), after.alias("tail"), middle.alias("middle"), "word", "n"
    )


def _halves(rows: DataFrame, first: str, last: str) -> DataFrame:
    """The region cut into two; one edit lies in one of the halves."""
    mid = f"({first} + {last}) div 2"
    both = f"array(struct({first} AS i, {mid} AS j), struct({mid} AS i, {last} AS j))"
    return _in_region(rows.select("m", F.explode(F.expr(both)).alias("r"), "word", "n").select("m", "r.*", "word", "n"))


def lists(words: DataFrame, min_chars: int, list_words: int = LIST_WORDS) -> DataFrame:
    """Every word in the lists in which words one edit away from it can be.

    A word enters the class of its length and the next lower one, with two halves each. Lists
    longer than ``list_words`` are halved again. That ends: when one letter is left in the
    region, a list holds no more words than there are ways to fill it.
    """
    classes = F.expr(f"filter(array(char_length(word), char_length(word) - 1), x -> x >= {min_chars})")
    rows = _halves(words.select(F.explode(classes).alias("m"), "word", "n"), "0", "m")
    done = None
    while True:
        sizes = rows.groupBy(*LIST).agg(F.count(F.lit(1)).alias("words"))
        long = materialize(sizes.filter((F.col("words") > list_words) & (F.col("j") - F.col("i") > 1)), "long-lists")
        if long.isEmpty():
            return rows if done is None else done.unionByName(rows)
        # Joined to the sizes, not broadcast by a hint: Spark knows the size of the table.
        short = rows.join(long.drop("words"), LIST, "left_anti").select(rows.columns)
        done = short if done is None else done.unionByName(short)
        hot = rows.join(long.drop("words"), LIST, "left_semi").select("m", "i", "j", "word", "n")
        rows = materialize(_halves(hot, "i", "j"), "halved-lists")


# Edit matrix -------------------------------------------------------------------------------


def _row_steps() -> list[list[int]]:
    """The band after one more letter, for each band and each three bits of equal letters.

    A band is the three cells of a row beside the diagonal, each 0, 1 or TOO_FAR, as a number
    in base 3. The last band, with all cells TOO_FAR, is the dead one.
    """
    steps = []
    for band in range(27):
        left, mid, right = band % 3, band // 3 % 3, band // 9
        row = []
        for same in range(8):
            a = min(left + 1 - (same & 1), mid + 1, TOO_FAR)
            b = min(mid + 1 - (same >> 1 & 1), right + 1, a + 1, TOO_FAR)
            c = min(right + 1 - (same >> 2 & 1), b + 1, TOO_FAR)
            row.append(a + 3 * b + 9 * c)
        steps.append(row)
    return steps


STEPS = _row_steps()
FIRST_BAND = TOO_FAR + 3 * 0 + 9 * 1
DEAD_BAND = TOO_FAR * 13


def shared_letters(a: str, b: str) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    for k in range(n):
        if a[k] != b[k]:
            return k
    return n


def near_in_list(middles: list[str]) -> Iterator[tuple[int, int]]:
    """Places of all pairs of a sorted list that are exactly one edit apart, each once.

    Rows of the matrix are kept on a stack by depth. The next word of the list keeps as many
    of them as it shares letters with the one before; a dead band at some depth rules out all
    words that share that many letters.
    """
    n = len(middles)
    shared = [0] + [shared_letters(middles[k - 1], middles[k]) for k in range(1, n)] + [0]
    steps, dead = STEPS, DEAD_BAND
    for s in range(n - 1):
        own = middles[s]
        size = len(own)
        at: dict[str, int] = {}
        for p, letter in enumerate(own):
            at[letter] = at.get(letter, 0) | 4 << p
        get = at.get
        rows = [FIRST_BAND]
        t = s + 1
        while t < n:
            other = middles[t]
            depth = shared[t]
            if depth < len(rows) - 1:
                del rows[depth + 1 :]
            else:
                depth = len(rows) - 1
            band = rows[depth]
            for letter in other[depth:]:
                depth += 1
                band = steps[band][get(letter, 0) >> depth & 7]
                if band == dead:
                    t += 1
                    while shared[t] >= depth:
                        t += 1
                    break
                rows.append(band)
            else:
                gap = size - len(other)
                if -1 <= gap <= 1 and band // (3, 9, 1)[gap] % 3 == 1:
                    yield s, t
                t += 1


# Scan --------------------------------------------------------------------------------------


def _scan(rows: list[tuple]) -> Iterator[tuple[str, int, int, str]]:
    """Each word of a list with its near words: how many, and the best one with its count.

    A pair belongs to the list with the last place at which its edit can lie, so it is found
    once; and to the class of the shorter word.
    """
    m, _, j, head, tail = rows[0][:5]
    size = j - rows[0][1]
    middles = [r[5] for r in rows]
    rests = [x + tail for x in middles]
    counts = [r[6] for r in rows]
    near = [0] * len(rows)
    best: list[int | None] = [None] * len(rows)
    for s, t in near_in_list(middles):
        a, b = middles[s], middles[t]
        if len(a) > size and len(b) > size:
            continue
        if j < m and (b.startswith(a) if len(a) < len(b) else a.startswith(b)):
            continue
        for x, y in ((s, t), (t, s)):
            near[x] += 1
            z = best[x]
            if z is None or (counts[y], rests[z]) > (counts[z], rests[y]):
                best[x] = y
    for x, k in enumerate(near):
        if k:
            y = best[x]
            yield head + rests[x], k, counts[y], head + rests[y]


def near_words(listed: DataFrame) -> DataFrame:
    """Near words of every word by list: ``word, n_near, near_n, near``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        found: list[tuple] = []

        def out() -> pa.RecordBatch:
            cols = list(zip(*found, strict=True)) or [(), (), (), ()]
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
            found.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                names=["word", "n_near", "near_n", "near"],
            )

        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if held and row[:5] != held[0][:5]:
                    if len(held) > 1:
                        found.extend(_scan(held))
                    held = []
                held.append(row)
            yield out()
        if len(held) > 1:
            found.extend(_scan(held))
        yield out()

    in_order = listed.select(*LIST, "middle", "n").repartition(*LIST).sortWithinPartitions(*LIST, "middle")
    return in_order.mapInArrow(run, "word string, n_near long, near_n long, near string")


def roots(forms: DataFrame) -> DataFrame:
    """Last word of each chain of forms: ``word, root`` (words with a form only).

    Counts at least double along a chain, so chains are short and have no circle. Every round
    doubles the way that each word looks ahead.
    """
    now = forms.select("word", F.col("form").alias("root"))
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = materialize(
            now.join(ahead, "root", "left").select(
                "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
            ),
            "spelling-roots",
        )
        now = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return now


def variants(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    *,
    min_chars: int = 5,
    min_count: int = 3,
    one_in: int = 97,
    list_words: int = LIST_WORDS,
) -> DataFrame:
    """Vocabulary of the texts with the form that each word is a variant of.

    Gives ``word, n, n_near, form, form_n, root``: occurrences, near words (one letter
    inserted, deleted or replaced), the near word with the most occurrences if it has at least
    twice as many (ties: the smallest), and the end of the chain of forms.

    Null and empty texts have no words; a null key counts as an empty one. Repeated rows count
    each. An empty table has no words. Other columns are not read, whatever their names.
    """
    counted = word_counts(docs, key, text, min_chars, one_in)
    words = materialize(counted.filter(F.col("n") >= min_count), "vocabulary")
    none = F.lit(None).cast("struct<less:bigint,form:string>")
    found = near_words(lists(words, min_chars, list_words)).select(
        "word",
        F.lit(None).cast("long").alias("n"),
        "n_near",
        F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form")).alias("best"),
    )
    own = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), none.alias("best"))
    merged = own.unionByName(found).groupBy("word").agg(
        F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("best").alias("best")
    )
    chosen = -F.col("best.less") >= 2 * F.col("n")
    known = materialize(
        merged.select(
            "word",
            "n",
            "n_near",
            F.when(chosen, F.col("best.form")).alias("form"),
            F.when(chosen, -F.col("best.less")).alias("form_n"),
        ),
        "spelling-forms",
    )
    ends = roots(known.filter(F.col("form").isNotNull()))
    return known.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
