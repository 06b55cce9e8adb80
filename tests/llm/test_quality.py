import re
from collections import Counter

import pytest

from basketflow.llm import quality
from llm_helpers import rows_by_id


def brute(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(3)}
    n = len(words)
    failed = n < 50 or 100 * len(covered) > 50 * n
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed)


def check(docs):
    want = {r.doc_id: brute(r.text) for r in docs.select("doc_id", "text").collect()}
    got = quality.judged(docs, quality.references(docs)).collect()
    assert len(got) == docs.count()
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
                r.base_failed) == want[r.doc_id]
        assert not (r.base_failed and r.kept)
    return got


def test_counts_match_brute_force(spark):
    check(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_verdict_follows_the_quality_labels(spark):
    read = lambda t: spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet")
    docs = read("documents")
    got = quality.judged(docs, quality.references(docs)).filter("NOT base_failed") \
        .join(read("labels"), "doc_id").groupBy("quality", "kept").count().collect()
    n = {(r.quality, r.kept): r["count"] for r in got}
    assert n.get((1, False), 0) <= 0.005 * n[1, True]
    assert n[0, False] >= 0.5 * (n[0, False] + n.get((0, True), 0))


def test_odd_rows(odd):
    got = rows_by_id(quality.judged(odd, quality.references(odd)))
    assert got[1][0].n_words == 0 and got[1][0].base_failed and not got[1][0].kept
    assert len(got[5]) == 2


def test_no_rows_and_no_language(nothing, make):
    assert quality.judged(nothing, quality.references(nothing)).count() == 0
    docs = make((1, " ".join(f"w{i}" for i in range(80)), None))
    row = quality.judged(docs, quality.references(docs)).first()
    assert row.kept and row.nearest_lang is None


def test_distance_of_equal_and_disjoint_histograms():
    import numpy as np
    p, q = np.array([[0.5, 0.5, 0.0]]), np.array([0.0, 0.0, 1.0])
    assert quality.js_distance(p, p[0])[0] == pytest.approx(0)
    assert quality.js_distance(p, q)[0] == pytest.approx(1)
