import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tokenizers

from claimsight.llm import packing, token_counts


def test_counts_equal_the_library(odd_docs, no_docs):
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows = token_counts.count_tokens(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert r.n_tokens == len(model.encode(r.text or ""))
        assert r.n_bytes == len((r.text or "").encode())
        assert r.over_limit == (r.n_tokens > 4096)
    assert token_counts.token_counts(no_docs).count() == 0


def test_pieces_cover_all_ids_without_gaps(odd_docs, no_docs):
    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = defaultdict(int)
    ids = {}
    for r in odd_docs.collect():
        x = library.encode(r.text or "", add_special_tokens=False).ids + [1]
        want[r.doc_id] += len(x)
        ids[r.doc_id] = np.array(x, "<u4")
    rows = packing.pack(odd_docs).collect()
    got, windows = defaultdict(int), defaultdict(list)
    for r in rows:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert zlib.crc32(part.tobytes()) == r.ids_crc32 and len(part) == r.length
        assert r.doc_tokens == len(ids[r.doc_id])
        got[r.doc_id] += r.length
        windows[r.sequence_id].append((r.offset, r.length))
    assert got == want
    for pieces in windows.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack(no_docs).count() == 0


def test_ids_of_words_equal_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    library = tokenizers.Tokenizer.from_file(path)
    words = ["a|b", "|", "||", "<|endoftext|>", "x<|EndOfText|>y", "it's,", "\u0301a", "\u00a0", "\u3000b", "É!", "x" * 500, "\u037e"]
    words += [f"w{i}ort." for i in range(300)]
    ids, bounds = packing.WordIds(path).of_texts(pa.array([" ".join(words), *words, ""], pa.large_string()), 1)
    for i, text in enumerate([" ".join(words), *words, ""]):
        want = library.encode(text, add_special_tokens=False).ids + [1]
        assert ids[bounds[i] : bounds[i + 1]].tolist() == want, text


def test_differencing_is_near_equal():
    rng = np.random.default_rng(1)
    sizes = rng.integers(100, 513, 400).tolist()
    sets = packing.differencing(sizes, 60)
    assert sorted(i for s in sets for i in s) == list(range(400))
    sums = [sum(sizes[i] for i in s) for s in sets]
    assert max(sums) - min(sums) < 40
    assert all(sum(sizes[i] for i in s) <= 2048 for s in packing.windows_of(sizes, 2048))
