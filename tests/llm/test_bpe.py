import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from basketflow.llm import bpe
from llm_helpers import rows_by_id

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.load(PATH))


HARD = ["", "ΣΑΣ ΟΔΟΣ", "İstanbul Ǆ", "a<|endoftext|>b <|startoftext|><|endoftext|>", "<|endoftext",
        "don't WE'LL '' 'S", "é ﬁ ½ 12345", "日本語 テスト 🎉🎉 x‍y", "a" * 5000,
        "\x85\xa0  \x1c a\x00b", "ſ K Å ẞ", "hello world! the fox's jumps_over 100% <<>>##"]


def test_hard_texts(reference, encoder):
    for text in HARD:
        want = reference.encode(text, add_special_tokens=False).ids
        assert encoder.encode_text(text) == (want, reference.decode(want, skip_special_tokens=False))


def test_random_words(reference, encoder):
    rng = random.Random(2)
    words = ["".join(rng.choice("etaoinshrdlué'1!") for _ in range(rng.randint(1, 80)))
             for _ in range(6000)]
    text = " ".join(words)
    assert encoder.encode_text(text)[0] == reference.encode(text, add_special_tokens=False).ids


def test_vectorised_merging_equals_the_heap(encoder):
    rng = random.Random(4)
    v = encoder.v
    parts = [[v.inner[rng.choice(b"thearing")] for _ in range(rng.randint(2, 16))] for _ in range(500)]
    matrix = np.array([p + [-1] * (16 - len(p)) for p in parts])
    for own, row in zip(parts, v.merge_many(matrix)):
        assert v.merge([int(x) for x in own]) == [x for x in row.tolist() if x >= 0]


def test_small_table_matches_the_library(spark, sf_dir, reference):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = rows_by_id(bpe.digested(docs, PATH))
    for r in docs.collect():
        ids = reference.encode(r.text or "", add_special_tokens=False).ids
        text = reference.decode(ids, skip_special_tokens=False)
        row = got[r.doc_id][0]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_full_cache_changes_nothing(reference, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 10)
    small = bpe.Encoder(bpe.load(PATH))
    for k in range(5):
        text = " ".join(f"word{i}x{k}" for i in range(40))
        assert small.encode_text(text)[0] == reference.encode(text, add_special_tokens=False).ids


def test_odd_rows(odd, nothing):
    got = rows_by_id(bpe.encoded(odd, PATH))
    assert [(list(r.ids), r.decoded) for r in got[1]] == [([], "")]
    assert len(got[5]) == 2 and got[5][0].ids == got[5][1].ids
    assert bpe.encoded(nothing, PATH).count() == 0
