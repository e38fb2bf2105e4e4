import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from chronogrid.llm import token_records as R
from chronogrid.llm.common import work_dir
from chronogrid.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(tokenizer_path())
    t.encode_special_tokens = True
    return t


@pytest.fixture(scope="module")
def encoder():
    return R.Encoder(tokenizer_path(), 16)


def test_round_trip(docs, corpus, tokenizer):
    got = [tuple(r) for r in R.round_trip(docs, tokenizer_path()).collect()]
    want, start = {}, 0
    for i, t in sorted(corpus, key=lambda r: r[0]):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        want.setdefault(i, []).append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(got) == sorted(x for v in want.values() for x in v)


def test_null_ids_come_first(spark, tokenizer):
    rows = R.round_trip(spark.createDataFrame([(2, "b"), (None, "a"), (1, None)], "doc_id long, text string"), tokenizer_path()).collect()
    assert sorted((r.start, r.doc_id, r.n_tokens) for r in rows) == [(0, None, 2), (2, 1, 1), (3, 2, 2)]


def test_empty_table(empty):
    assert R.round_trip(empty, tokenizer_path()).collect() == []


def test_damage_is_found():
    raw = R.frame(b"some ids")
    assert R.unframe(raw) == b"some ids"
    for k in range(len(raw)):
        with pytest.raises(ValueError):
            R.unframe(raw[:k] + bytes([raw[k] ^ 1]) + raw[k + 1 :])


def test_wide_vocabulary_takes_32_bits(spark, tokenizer):
    folder = work_dir(spark, "t")
    df = spark.createDataFrame([(1, "hello there")], "doc_id long, text string")
    rows = R.read_records(R.write_records(df, folder, tokenizer_path(), end_id=70_000), folder).collect()
    ids = [*tokenizer.encode("hello there").ids, 70_000]
    assert rows[0].ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())


marks = st.lists(st.sampled_from([" ", "  ", "\n", "\t", "\xa0", "\u2009", "\u3000", "\x1c", "a", "Bc", "'s", "'re", "'", "12", "é", "ß", "!", ".,", "...", "<|endoftext|>", "\x85", "日", "😀", "\r\n", "\u200b", "_", "ǅ", "ª", "²", "\x00"]), max_size=20).map("".join)


def pieced(encoder, texts):
    ids, bounds = encoder.encode(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def whole(tokenizer, texts):
    return [e.ids for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@settings(max_examples=500, deadline=None)
@given(st.lists(marks, max_size=4))
def test_pieces_have_the_text_s_ids(encoder, tokenizer, texts):
    assert pieced(encoder, texts) == whole(tokenizer, texts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=4))
def test_any_text_has_its_ids(encoder, tokenizer, texts):
    assert pieced(encoder, texts) == whole(tokenizer, texts)


def test_many_random_texts_have_their_ids(encoder, tokenizer):
    rng = random.Random(4)
    parts = [" ", " ", " ", "  ", "\n", "\n\n", "\t", "\xa0", "\x85", "\x1f", "'t", "'ll", "!", "?!", "a", "Zz", "the", "éa", "日本", "٣", "7", "-", "\u0301", "\U0001f600", "|"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(14))) for _ in range(20_000)]
    for a in range(0, len(texts), 2500):
        assert pieced(encoder, texts[a : a + 2500]) == whole(tokenizer, texts[a : a + 2500])


def test_memory_may_be_full(tokenizer, words):
    small = R.Encoder(tokenizer_path(), 16)
    small.memory = 40
    rng = random.Random(1)
    for _ in range(30):
        texts = [" ".join(rng.choice(words) for _ in range(50)), None, "", rng.choice(words)]
        assert pieced(small, texts) == whole(tokenizer, texts)
    assert len(small.known) <= 40 and small.entries <= 3 * 40 + 200


def test_ids_that_do_not_fit_are_refused(encoder):
    with pytest.raises(ValueError):
        encoder._raw([70_000])


def test_shuffled_reads_by_offset(spark, docs, corpus, tokenizer):
    folder = work_dir(spark, "t")
    index = R.offset_index(R.write_records(docs, folder, tokenizer_path()), folder)
    assert index.count() == len(corpus)
    one, same, other = ([(r.doc_id, *r.ids) for r in R.shuffled(index, folder, seed).collect()] for seed in (1, 1, 2))
    assert one == same and one != other
    want = sorted((i, *tokenizer.encode(t or "", add_special_tokens=False).ids, 0) for i, t in corpus)
    assert sorted(one) == sorted(other) == want and one != want
    some = [tuple(r) for r in R.shuffled(index.where("doc_id = 108"), folder, 3).collect()]
    assert some == [(108, [*tokenizer.encode(dict(corpus)[108], add_special_tokens=False).ids, 0])]
