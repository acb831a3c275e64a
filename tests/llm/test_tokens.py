"""Token counts, prefix BPE and token files against the tokenizers library."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from textree.llm import prefix_bpe, token_counts, token_files

WORD, BYTE = (public_tokenizers.path(x) for x in ("word_bpe_49k.json", "byte_bpe_50k.json"))
ODD = [
    "", " ", "  ", "a  b", "a\n b", "a \nb", "\t x\n\n y ", "aaaaaaaaaaaa aaa", "<|endoftext|>", "x <|endoftext|> y<|startoftext|>Z",
    "<|end", "it's 's ' s we'LL", "\U0001f600\U0001f600 z", "İSTANBUL ΣΊΣΥΦΟΣ ſ", "é é", "漢字 テスト", "a\x1cb \x1d c", "ha" * 5000,
    "1234 ² ½", "x" * 3000 + " y",
]


def texts(n=60):
    draw = random.Random(3)
    pool = "abcdefgh éßñ'.,!?\n\t0123 -_ЖЯ"
    return ODD + ["".join(draw.choice(pool) for _ in range(draw.randrange(200))) for _ in range(n)]


def frame(spark, rows):
    schema = "doc_id long, text string, n_tokens string, ids string"
    return spark.createDataFrame([(i, x, "other", "other") for i, x in rows], schema).repartition(3)


def test_counts_match_the_library(spark):
    rows = list(enumerate(texts()))
    library = Tokenizer.from_file(BYTE)
    got = {r.doc_id: r for r in token_counts.count_tokens(frame(spark, rows), BYTE, limit=20).collect()}
    for i, x in rows:
        want = len(library.encode(x, add_special_tokens=False).ids)
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len(x.encode()), want, want > 20)


def test_every_character_below_0x600_is_counted_alike():
    library, counter = Tokenizer.from_file(BYTE), token_counts.Counter(BYTE)
    rows = ["A%sb 1%s2 %s%s ' %ss" % ((chr(i),) * 5) for i in range(0x600)]
    assert counter.count(rows) == [len(e.ids) for e in library.encode_batch(rows, add_special_tokens=False)]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_prefix_bpe_gives_the_ids_and_texts_of_the_library(path):
    library = Tokenizer.from_file(path)
    encoder, decoder = prefix_bpe.codec(path)
    rows = texts() + ["A%sb 1%s2 %s%s ' %ss" % ((chr(i),) * 5) for i in range(0, 0x3000, 5)]
    for x in rows:
        ids = np.frombuffer(encoder.encode(x), "<i4")
        assert ids.tolist() == library.encode(x, add_special_tokens=False).ids, repr(x[:80])
        assert decoder.decode(ids) == library.decode(ids.tolist(), skip_special_tokens=False)


def test_encode_decode_rows(spark):
    rows = [(1, "Hello world"), (1, "Hello world"), (None, "x"), (2, None), (3, "")]
    got = prefix_bpe.encode_decode(frame(spark, rows), WORD).collect()
    assert len(got) == 5
    assert sorted(len(r.ids) for r in got) == [0, 0, 1, 2, 2]
    assert {r.decoded for r in got if not r.ids} == {""}
    assert prefix_bpe.encode_decode(frame(spark, []), WORD).count() == 0


def test_codes_give_random_access_and_all_ids():
    draw = np.random.default_rng(0)
    ids = np.r_[draw.integers(0, 50_000, 3000), draw.integers(0, 200, 2000), [0, 255, 256, 65535, 65536, 2**24, 2**32 - 1]].astype(np.uint32)
    data = token_files.write_segment(4, [7, None], [len(ids) - 5, 5], ids)
    (segment,) = token_files.segments(data + token_files.END)
    assert (segment.file, segment.doc_ids, segment.lengths.tolist()) == (4, [7, None], [len(ids) - 5, 5])
    assert (segment.ids() == ids).all()
    for place in [0, 1, 511, 512, 513, 2999, 3000, len(ids) - 1, *draw.integers(0, len(ids), 300)]:
        assert segment.access(int(place)) == ids[place]
    with pytest.raises(ValueError):
        next(token_files.segments(data[:-1]))


def test_index_is_read_back_from_the_files(spark, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT_IDS", 500)
    rows = [(i * 3, x) for i, x in enumerate(texts())] + [(400, None)]
    library = Tokenizer.from_file(WORD)
    got = sorted(token_files.token_index(frame(spark, rows), WORD, 2, files=4).collect(), key=lambda r: r.doc_id)
    start = 0
    for (i, x), r in zip(sorted(rows), got, strict=True):
        ids = np.array([*library.encode(x or "", add_special_tokens=False).ids, 2], "<u4")
        assert tuple(r) == (i, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_index_edges(spark):
    assert token_files.token_index(frame(spark, []), WORD, 2).count() == 0
    got = token_files.token_index(frame(spark, [(5, "a b"), (5, "a b"), (None, "c")]), WORD, 2).collect()
    assert sorted((r.doc_id or -1, r.start, r.n_tokens) for r in got) == [(-1, 0, 2), (5, 2, 3), (5, 5, 3)]
