"""Packing documents into token windows by multiway differencing."""

from __future__ import annotations

import heapq
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimsight.llm.blocks import blocks, byte_table, mapped, split_words, sums, texts_of
from claimsight.session import materialize

#: Tokens of a window, longest piece that is packed with others, pieces of a group.
CAPACITY = 2048
LONGEST_PIECE = 512
GROUP_PIECES = 1500
#: Distinct words that a worker remembers, and the longest it remembers.
CACHE_WORDS = 500_000
#: Bytes of text that are taken apart at once: the more, the fewer words are looked up twice.
TEXT_BYTES = 12 << 20
CACHE_CHARS = 64
#: Words that are encoded as one text, and the sign that parts them there.
RUN_WORDS = 128
MARK = "|"

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "task long, row long, full boolean"
)

_encoders: dict[str, WordIds] = {}


class WordIds:
    """Ids of texts from the ids of their words.

    The tokenizer turns white space into one blank and drops it, and none of its pieces
    crosses a blank, so the ids of a text are those of its words one after the other.
    """

    def __init__(self, path: str):
        self.tokenizer = tokenizers.Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        mark = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None

    def _encoded(self, words: list[str]) -> list[bytes]:
        """Ids of each word as unsigned 32-bit numbers.

        Many words are encoded as one text with a mark between them, whose id then parts
        their ids. Words that hold the mark's sign are encoded alone, special strings among
        them, and so are all if the marks do not come back as sent.
        """
        out: list[bytes | None] = [None] * len(words)
        plain = [i for i, w in enumerate(words) if MARK not in w] if self.mark is not None else []
        runs = [
            "".join([f"{words[i]} {MARK} " for i in plain[lo : lo + RUN_WORDS]])
            for lo in range(0, len(plain), RUN_WORDS)
        ]
        made = self.tokenizer.encode_batch_fast(runs, add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, np.uint32) for e in made]) if made else np.empty(0, np.uint32)
        ends = np.flatnonzero(ids == self.mark)
        if len(ends) == len(plain):
            raw, start = ids.tobytes(), 0
            for i, end in zip(plain, (4 * ends).tolist()):
                out[i] = raw[start:end]
                start = end + 4
        alone = [i for i, x in enumerate(out) if x is None]
        made = self.tokenizer.encode_batch_fast([words[i] for i in alone], add_special_tokens=False)
        for i, e in zip(alone, made, strict=True):
            out[i] = array("I", e.ids).tobytes()
        return out

    def _of_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the words end to end, with the start and the number of each word's."""
        if len(self.known) > CACHE_WORDS:
            self.known = {}
        known = self.known
        found = [known.get(w) for w in words]
        new = [i for i, x in enumerate(found) if x is None]
        for lo in range(0, len(new), 20_000):
            part = new[lo : lo + 20_000]
            for i, ids in zip(part, self._encoded([words[i] for i in part]), strict=True):
                found[i] = ids
                if len(words[i]) <= CACHE_CHARS:
                    known[words[i]] = ids
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        return np.frombuffer(b"".join(found), np.uint32), np.cumsum(size) - size, size

    def of_texts(self, texts: pa.LargeStringArray, end_id: int):
        """Ids of all texts end to end, ``end_id`` after each, and where each text starts."""
        codes, starts, words = split_words(mapped(texts, byte_table(lower=False)))
        flat, first, size = self._of_words(words.to_pylist())
        # The end is one more word, at the end of every text.
        codes = np.insert(codes, starts[1:], len(size))
        starts = starts + np.arange(len(starts))
        flat = np.append(flat, np.uint32(end_id))
        first, size = np.append(first, len(flat) - 1), np.append(size, 1)
        length = size[codes]
        tokens = sums(length, starts)
        total = int(tokens.sum())
        kind = np.int32 if max(total, len(flat)) < 1 << 31 else np.int64
        shift = first.astype(kind)[codes] - (np.cumsum(length, dtype=kind) - length.astype(kind))
        at = np.repeat(shift, length)
        at += np.arange(total, dtype=kind)
        return flat[at], np.concatenate([[0], np.cumsum(tokens)])


def encoder(path: str) -> WordIds:
    if path not in _encoders:
        _encoders[path] = WordIds(path)
    return _encoders[path]


def cuts(tokens: int, capacity: int, longest: int) -> list[int]:
    """Lengths of a document's pieces: full windows, then even parts of the rest."""
    full, rest = divmod(tokens, capacity)
    parts = -(-rest // longest)
    return [capacity] * full + [rest // parts + (i < rest % parts) for i in range(parts)]


def document_pieces(
    docs: DataFrame, text: str, path: str, end_id: int, capacity: int, longest: int
) -> DataFrame:
    """One row per piece with the checksum of its ids. ``task`` and ``row`` name it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, task, row = encoder(path), TaskContext.get().partitionId(), 0
        for block in blocks(batches, text, TEXT_BYTES):
            ids, bounds = ids_of.of_texts(texts_of(block.column(text)), end_id)
            data = memoryview(ids.astype("<u4", copy=False)).cast("B")
            doc, start, length, crc, tokens = [], [], [], [], []
            for d, (lo, hi) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                at = lo
                for n in cuts(hi - lo, capacity, longest):
                    doc.append(d)
                    start.append(at - lo)
                    length.append(n)
                    crc.append(zlib.crc32(data[4 * at : 4 * (at + n)]))
                    tokens.append(hi - lo)
                    at += n
            n = len(doc)
            lengths = pa.array(length, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pc.take(block.column("doc_id").cast(pa.int64()), pa.array(doc, pa.int64())),
                    pa.array(start, pa.int64()),
                    lengths,
                    pa.array(crc, pa.int64()),
                    pa.array(tokens, pa.int64()),
                    pa.array(np.full(n, task, np.int64)),
                    pa.array(np.arange(row, row + n, dtype=np.int64)),
                    pc.equal(lengths, capacity),
                ],
                names="doc_id start length ids_crc32 doc_tokens task row full".split(),
            )
            row += n

    return docs.select("doc_id", text).mapInArrow(run, PIECES)


def differencing(sizes: list[int], windows: int) -> list[list[int]]:
    """Karmarkar-Karp partition of the sizes into ``windows`` sets of near-equal sums.

    A partial partition is its non-empty sets by falling sum. The two with the largest
    imbalance (largest minus smallest sum) are merged: the largest set of one joins the
    smallest of the other. Sets are trees of pairs until the end.
    """
    heap = [(-s, i, np.array([s]), [i]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    name = len(heap)
    while len(heap) > 1:
        _, _, sums_a, sets_a = heapq.heappop(heap)
        _, _, sums_b, sets_b = heapq.heappop(heap)
        # Empty sets of one meet the largest of the other; then the smallest meet the next.
        free = windows - len(sums_a)
        sums = np.concatenate([sums_a, sums_b[:free]])
        sets = sets_a + sets_b[:free]
        for i, j in enumerate(range(free, len(sums_b))):
            at = len(sums_a) - 1 - i
            sums[at] += sums_b[j]
            sets[at] = (sets[at], sets_b[j])
        order = np.argsort(-sums, kind="stable")
        sums = sums[order]
        gap = int(sums[0]) - (int(sums[-1]) if len(sums) == windows else 0)
        heapq.heappush(heap, (-gap, name, sums, [sets[i] for i in order.tolist()]))
        name += 1
    return [_flat(s) for s in heap[0][3]] if heap else []


def _flat(tree) -> list[int]:
    out, todo = [], [tree]
    while todo:
        x = todo.pop()
        if isinstance(x, tuple):
            todo += x
        else:
            out.append(x)
    return out


def windows_of(sizes: list[int], capacity: int) -> list[list[int]]:
    """Near-equal windows; one more window whenever the fullest exceeds the capacity."""
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        sets = differencing(sizes, k)
        if max(sum(sizes[i] for i in s) for s in sets) <= capacity:
            return sets
        k += 1


def pack(
    docs: DataFrame,
    text: str = "text",
    tokenizer: str | None = None,
    end_id: int = 1,
    capacity: int = CAPACITY,
    longest_piece: int = LONGEST_PIECE,
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """Pieces of all documents with their place in sequences of at most ``capacity`` ids.

    A document's ids are those of its text and then ``end_id``. Runs of ``capacity`` ids
    become sequences of their own; the rest is cut evenly into pieces of at most
    ``longest_piece``. Pieces are dealt by a hash of their task and row into groups of about
    ``group_pieces``, which is independent of document ids, so copies and repeated ids
    cannot fill a group. Each group is packed by multiway differencing: merging partial
    partitions with opposing imbalances gives near-equal windows, and the number of windows
    rises while one exceeds the capacity.

    Result: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. A null or
    empty text is the end id alone. Null and repeated doc_ids are packed like others; an
    empty table gives no rows; other columns are ignored.
    """
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    pieces = materialize(
        document_pieces(docs, text, path, end_id, capacity, longest_piece), "pieces"
    )
    groups = max(1, -(-pieces.filter("NOT full").count() // group_pieces))
    done = pieces.filter("full").select(
        *_RESULT[:5],
        (F.lit(1 << 62) + F.shiftleft(F.col("task"), 36) + F.col("row")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["task", "row"], kind="stable")
        sizes = group["length"].tolist()
        sequence = np.zeros(len(sizes), np.int64)
        offset = np.zeros(len(sizes), np.int64)
        base = int(group["group"].iloc[0]) << 24
        for w, members in enumerate(windows_of(sizes, capacity)):
            at = 0
            for i in sorted(members):
                sequence[i], offset[i] = base + w, at
                at += sizes[i]
        return group[_RESULT[:5]].assign(sequence_id=sequence, offset=offset)

    packed = (
        pieces.filter("NOT full")
        .withColumn("group", F.pmod(F.xxhash64("task", "row"), F.lit(groups)))
        .groupBy("group")
        .applyInPandas(
            run,
            "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
            "sequence_id long, offset long",
        )
    )
    return done.unionByName(packed)


_RESULT = "doc_id start length ids_crc32 doc_tokens sequence_id offset".split()
