"""Arrow helpers for tasks that work on blocks of whole texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 4 << 20


def texts_of(column) -> pa.LargeStringArray:
    """The column as large strings that start at offset 0; null counts as empty."""
    texts = pc.fill_null(column.cast(pa.large_string()), "")
    if texts.offset:
        texts = pa.concat_arrays([texts, pa.array([], pa.large_string())])
    if texts.offset:
        texts = pa.array(texts.to_pylist(), pa.large_string())
    return texts


def blocks(
    batches: Iterator[pa.RecordBatch], text: str = "text", size: int = BLOCK_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows of about ``size`` bytes of text; a longer text stands alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + size, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def mapped(texts: pa.LargeStringArray, table: np.ndarray) -> pa.LargeStringArray:
    """Every byte replaced through a table of 256 bytes (ASCII to ASCII only)."""
    n = len(texts)
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64, n + 1)
    if data is None or ends[-1] == 0:
        return texts
    out = table[np.frombuffer(data, np.uint8, int(ends[-1]))]
    return pa.LargeStringArray.from_buffers(n, pa.py_buffer(ends), pa.py_buffer(out))


def byte_table(lower: bool) -> np.ndarray:
    """White space (9 to 13) to a blank and, if asked, A-Z to a-z."""
    table = np.arange(256, dtype=np.uint8)
    table[9:14] = 32
    if lower:
        table[65:91] += 32
    return table


def split_words(texts: pa.LargeStringArray, keep_empty: bool = False):
    """Codes of all words in order, where each text's codes start, and the distinct words.

    Words are what stands between blanks. With ``keep_empty`` the empty strings between
    two blanks stay.
    """
    lists = pc.split_pattern(texts, " ")
    flat = lists.flatten().dictionary_encode()
    codes = flat.indices.to_numpy(zero_copy_only=False)
    starts = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    empty = pc.index(flat.dictionary, pa.scalar("", flat.dictionary.type)).as_py()
    if empty >= 0 and not keep_empty:
        keep = codes != empty
        starts = np.concatenate([[0], np.cumsum(keep)])[starts]
        codes = codes[keep]
    return codes, starts, flat.dictionary


def sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of the values of each text."""
    totals = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return totals[starts[1:]] - totals[starts[:-1]]
