import math
import re
import zlib
from collections import Counter

import pytest

from basketflow.llm import lm
from llm_helpers import rows_by_id


def tokens(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x20\x09-\x0d]+", lower) + [None]


def fold(i):
    return zlib.crc32(str("" if i is None else i).encode()) % 10


def check(docs):
    rows = docs.select("doc_id", "text").collect()
    count = Counter(t for r in rows if fold(r.doc_id) for t in tokens(r.text))
    n, v = sum(count.values()), len(count)
    got = rows_by_id(lm.scored(docs))
    assert sum(map(len, got.values())) == len(rows)
    for i in {r.doc_id for r in rows}:
        want = sorted(
            (len(t), sum(count[x] > 0 for x in t),
             sum(math.log10((count[x] + .1) / (n + .1 * (v + 1))) for x in t))
            for t in (tokens(r.text) for r in rows if r.doc_id == i))
        have = sorted((r.n_tokens, r.n_known, r.base_score) for r in got[i])
        for (a, b, c), (x, y, z) in zip(want, have):
            assert (a, b) == (x, y) and z == pytest.approx(c, rel=1e-9, abs=1e-9)
        assert all(r.train_tokens == n and r.held_out == (fold(i) == 0) for r in got[i])
    return got


def test_base_matches_brute_force_and_score_beats_it(spark, sf_dir):
    got = check(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    held = [r for rows in got.values() for r in rows if r.held_out]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)


def test_interpolation_by_hand(make, monkeypatch):
    """Weights fixed at a half for every seen context."""
    import numpy as np
    monkeypatch.setattr(lm, "mixture_weights", lambda rows: np.full(70, 0.5))
    docs = make((1, "a b a b c"), (2, "b a b"), (3, "a c"))
    rows = {r.doc_id: r for r in lm.scored(docs).collect()}
    seen = [tokens(r.text) for r in docs.collect() if fold(r.doc_id)]
    count = Counter(t for d in seen for t in d)
    pair = Counter((v, w) for d in seen for v, w in zip(["BOS", *d], d))
    context = Counter(v for v, _ in pair.elements())
    n, v = sum(count.values()), len(count)
    for r in docs.collect():
        d = tokens(r.text)
        want = 0.0
        for before, w in zip(["BOS", *d], d):
            base = (count[w] + .1) / (n + .1 * (v + 1))
            c = context[before]
            want += math.log10(.5 * pair[before, w] / c + .5 * base if c else base)
        assert rows[r.doc_id].score == pytest.approx(want, abs=1e-9) or not any(
            context[b] for b in ["BOS", *d])


def test_slices_and_chunks_do_not_matter(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    whole = {r.doc_id: r.base_score for r in lm.scored(docs).collect()}
    monkeypatch.setattr(lm, "CHUNK_BYTES", 50_000)
    monkeypatch.setattr(lm, "SLICE_BYTES", 20_000)
    for r in lm.scored(docs.repartition(3)).collect():
        assert r.base_score == pytest.approx(whole[r.doc_id], rel=1e-12)


def test_weights_follow_the_better_estimate():
    from collections import namedtuple
    row = namedtuple("row", "bucket bin n")
    good = lm.mixture_weights([row(3, 5 * lm.BINS, 100)])[3]
    bad = lm.mixture_weights([row(3, -lm.REACH * lm.BINS - 1, 100)])[3]
    assert good > 0.9 and bad < 1e-6


def test_odd_rows(odd, nothing):
    got = check(odd)
    assert got[1][0].n_tokens == 1
    assert lm.scored(nothing).count() == 0
