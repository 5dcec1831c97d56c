import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
import public_tokenizers as tokenizers
from tokenizers import Tokenizer

from quillgrid.llm.packing import BestFit, best_fit, op4_best_fit_packing, pack_documents, sequences, token_pieces

from .common import AWKWARD, as_table, docs_frame

PATH = tokenizers.path("byte_bpe_50k.tiktoken")


def slow_best_fit(lengths, capacity, open_bins):
    bins, out, made = [], [], 0
    for n in lengths:
        fits = [b for b in bins if b[1] >= n]
        if fits:
            least = min(b[1] for b in fits)
            b = [b for b in fits if b[1] == least][-1]
        else:
            if len(bins) >= open_bins:
                least = min(x[1] for x in bins)
                bins.remove([x for x in bins if x[1] == least][-1])
            b = [made, capacity]
            made += 1
        bins = [x for x in bins if x is not b]
        out.append((b[0], capacity - b[1]))
        b[1] -= n
        if b[1]:
            bins.append(b)
    return out


@pytest.mark.parametrize("open_bins", [1, 3, 50])
def test_against_a_slow_packer(open_bins):
    rng = random.Random(open_bins)
    lengths = [rng.randint(1, 32) for _ in range(800)]
    packer = BestFit(32, open_bins)
    assert [packer.put(n) for n in lengths] == slow_best_fit(lengths, 32, open_bins)


def whole(rows):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    return len(by)


def test_pieces_are_those_of_the_library_and_fill_sequences(spark):
    rng = random.Random(3)
    rows = [*enumerate(AWKWARD), *((100 + i, " ".join(rng.choice(["the", "house", "éa", "x<|endoftext|>y", "\n"]) for _ in range(rng.randint(0, 1500)))) for i in range(120)), (None, "x"), (None, "x")]
    got = pack_documents(docs_frame(spark, rows)).collect()
    n = whole(got)
    lower = -(-sum(r.length for r in got) // 1024)
    assert n <= lower * 1.05 + 1
    library = Tokenizer.from_file(tokenizers.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    assert len(by[None]) == 2
    for i, text in rows:
        if i is None:
            continue
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        parts = sorted(by[i], key=lambda r: r.piece)
        assert [r.piece for r in parts] == list(range(len(parts)))
        assert len(ids) > 1024 or len(parts) == 1
        at = 0
        for r in parts:
            assert r.start == at and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)


def test_sequences_and_empty_table(spark):
    rows = docs_frame(spark, [(1, "a b c"), (2, "d e")]).selectExpr("*", "'clash' AS offset", "0 AS piece")
    packed = best_fit(token_pieces(rows, PATH, tokenizers.PATTERN, keep_ids=True))
    (made,) = sequences(packed).collect()
    assert made.pieces == 2 and len(made.tokens) == 7
    assert pack_documents(docs_frame(spark, [])).count() == 0


def test_wrong_length_is_an_error(spark):
    with pytest.raises(Exception, match="a piece must have"):
        best_fit(spark.createDataFrame([(0,)], "length long")).collect()


def test_only_the_first_piece_is_shorter_and_long_blanks_are_whole(spark, tmp_path):
    texts = ["x", "a b " * 900, " the" * 1023, " the" * 1024, " the" * 2047, " " * 1_500_000 + "x", "x" + "\n" * 1_500_000, "a" + "\u3000 \t" * 20_000 + "é", "a" + " " * 20_000 + "\x1fb"]
    as_table(spark, docs_frame(spark, list(enumerate(texts))), tmp_path)
    library = Tokenizer.from_file(tokenizers.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    want = []
    for i, text in enumerate(texts):
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 2], "<u4")
        cuts = list(range(len(ids), 0, -1024))[::-1]
        want += [(i, k, s, e - s, zlib.crc32(ids[s:e].tobytes())) for k, (s, e) in enumerate(zip([0, *cuts], cuts))]
    got = op4_best_fit_packing(spark, str(tmp_path)).collect()
    assert sorted(tuple(r[:5]) for r in got) == want
    whole(got)
