"""Token counts: pieces counted once per distinct pre-token, summed over each text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from claimsight.llm.blocks import blocks, split_words, sums, texts_of

#: Distinct pre-tokens that a worker remembers, and the longest it remembers.
CACHE_WORDS = 400_000
CACHE_CHARS = 64

_models: dict[str, PieceCounter] = {}


class PieceCounter:
    """Piece counts of pre-tokens: blanks followed by what is no blank.

    No piece of the model holds a blank after another character, so no merge crosses from
    a word into the blank after it, and the count of a text is the sum over its pre-tokens.
    The model itself puts one blank before a text, so a pre-token is handed over without
    its first blank.
    """

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            if "▁" in piece.lstrip("▁"):
                raise ValueError(f"{path}: piece {piece!r} crosses a blank")
        self.known: dict[str, int] = {}

    def count(self, words: list[str]) -> np.ndarray:
        """Pieces of each word with one blank before it; an empty word is that blank."""
        out = np.empty(len(words), np.int64)
        new = []
        known = self.known
        for i, w in enumerate(words):
            n = known.get(w)
            if n is None:
                new.append(i)
            else:
                out[i] = n
        if new:
            if len(known) + len(new) > CACHE_WORDS:
                known.clear()
            found = self.model.encode([words[i] for i in new], num_threads=1)
            for i, ids in zip(new, found, strict=True):
                n = len(ids) if words[i] else 1
                out[i] = n
                if len(words[i]) <= CACHE_CHARS and len(known) < CACHE_WORDS:
                    known[words[i]] = n
        return out

    def of_texts(self, texts: pa.LargeStringArray) -> np.ndarray:
        """Pieces of each text. The model takes the sign ▁ for a blank, and so does this."""
        codes, starts, words = split_words(
            pc.replace_substring(texts, "▁", " "), keep_empty=True
        )
        words = words.to_pylist()
        counts = self.count(words)
        total = sums(counts[codes], starts)
        empty = words.index("") if "" in words else -1
        if empty >= 0:
            self._mend_runs(codes == empty, starts, codes, words, counts, total)
        total[np.asarray(pc.binary_length(texts)) == 0] = 0
        return total

    def _mend_runs(self, blank, starts, codes, words, counts, total):
        """Several blanks in a row make pieces of their own with the word after them."""
        text_of = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        at = np.flatnonzero(blank)
        first = at[(at == 0) | ~blank[at - 1] | (text_of[at] != text_of[at - 1])]
        for i in first:
            d = text_of[i]
            j = i
            while j < starts[d + 1] and blank[j]:
                j += 1
            word = words[codes[j]] if j < starts[d + 1] else ""
            run = j - i if word else j - i - 1
            before = counts[codes[i:j]].sum() + (counts[codes[j]] if word else 0)
            total[d] += self.count([" " * run + word])[0] - before


def counter(path: str) -> PieceCounter:
    """The counter of this worker, made once per file."""
    if path not in _models:
        _models[path] = PieceCounter(path)
    return _models[path]


def count_tokens(
    docs: DataFrame,
    text: str = "text",
    model: str | None = None,
    limit: int = 4096,
) -> DataFrame:
    """Adds ``n_bytes``, ``n_tokens`` and ``over_limit`` to every row.

    Tokens are those of a sentencepiece model without begin or end tokens. A worker splits
    its texts into pre-tokens, counts the pieces of each distinct one once, joins the counts
    to the pre-tokens of each text by code and sums them; ids are never kept. Nothing is
    shuffled: a join across the cluster would move every pair of text and pre-token.

    Null and empty texts have 0 bytes and 0 tokens. Texts are never cut. Repeated rows stay,
    an empty table gives an empty result; other columns pass, and columns that are named like
    the three results are replaced.
    """
    path = model or public_tokenizers.path("piece_bpe_32k.model")
    keep = docs.select(
        *[c for c in docs.columns if c not in ("n_bytes", "n_tokens", "over_limit")]
    )
    out = StructType(list(keep.schema.fields))
    for name, kind in (("n_bytes", "long"), ("n_tokens", "long"), ("over_limit", "boolean")):
        out = out.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = counter(path)
        for block in blocks(batches, text):
            texts = texts_of(block.column(text))
            tokens = pieces.of_texts(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    *block.columns,
                    pc.binary_length(texts).cast(pa.int64()),
                    pa.array(tokens, pa.int64()),
                    pa.array(tokens > limit),
                ],
                names=out.fieldNames(),
            )

    return keep.mapInArrow(run, out)


def token_counts(docs: DataFrame, **options) -> DataFrame:
    """The counts with the ids only: texts do not travel back."""
    text = options.get("text", "text")
    lean = docs.select("doc_id", F.col(text))
    return count_tokens(lean, **options).drop(text)
