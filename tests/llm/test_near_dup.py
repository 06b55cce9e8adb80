import random
import re

import numpy as np
import pytest

from basketflow.llm import near_dup
from llm_helpers import rows_by_id


def shingles(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) >= 5:
        return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}
    return {tuple(words)} if words else set()


def brute(docs, percent=85):
    """Component of every id by comparing all pairs."""
    sets = {i: shingles(t) for i, t in docs if i is not None}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                ra, rb = sorted((root(a), root(b)))
                parent[rb] = ra
    return {i: (len(sets[i]), root(i)) for i in ids}


def check(df):
    want = brute([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])
    got = rows_by_id(near_dup.link(df))
    for i, (n, root) in want.items():
        for r in got[i]:
            assert (r.n_shingles, r.component_id, r.kept) == (n, root, root == i)
    return got


def test_matches_all_pairs_on_the_small_table(spark, sf_dir):
    check(spark.read.parquet(f"{sf_dir}/documents.parquet"))


@pytest.mark.parametrize("length", [6, 12, 40, 300])
def test_edited_copies_and_chains(make, length):
    """Copies of copies: neighbours are linked, ends are not, the chain is one component."""
    rng = random.Random(length)
    words = [f"w{rng.randrange(10**6)}" for _ in range(length)]
    rows, at = [], 0
    for k in range(25):
        rows.append((100 - k, " ".join(words)))
        if k % 3 == 2:
            rows.append((200 + k, " ".join(words).upper()))
        words = list(words)
        for _ in range(max(1, length // 120)):
            words[at % length] = f"x{rng.randrange(10**6)}"
            at += 7
    check(make(*rows))


def test_large_bucket_is_cut_into_cells(make, monkeypatch):
    """Near copies of one text that are no near copies of each other, some only linked in pairs."""
    monkeypatch.setattr(near_dup, "CELL", 8)
    rng = random.Random(5)
    base = [f"b{i}" for i in range(200)]
    rows = []
    for k in range(60):
        own = list(base)
        for at in rng.sample(range(200), 3 if k % 2 else 5):
            own[at] = f"v{rng.randrange(10**6)}"
        rows.append((k, " ".join(own)))
    check(make(*rows))


def test_odd_rows(odd):
    got = check(odd)
    assert [(r.n_shingles, r.component_id, r.kept) for r in got[2]] == [(0, 2, True)]
    assert [(r.component_id, r.kept) for r in got[6]] == [(5, False)]
    assert [(r.component_id, r.kept) for r in got[None]] == [(None, True)]
    assert len(got[5]) == 2


def test_no_rows(nothing):
    assert near_dup.link(nothing).count() == 0


def test_registers_estimate_jaccard():
    rng = np.random.default_rng(3)
    x = np.unique(rng.integers(0, 2**64, 4000, dtype=np.uint64))
    y = np.unique(np.concatenate([x[:3600], rng.integers(0, 2**64, 400, dtype=np.uint64)]))
    true = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
    regs = near_dup.registers([x, y])
    j, used = near_dup.estimate(regs[:1], regs[1:])
    assert used[0] == near_dup.REGISTERS and abs(j[0] - true) < 0.12


def test_keep_one_keeps_the_smallest_id(make):
    text = "a b c d e f g h"
    docs = make((3, text), (1, text), (2, text + " i"), (4, "other words stand here"), (5, None))
    assert sorted(r.doc_id for r in near_dup.keep_one(docs).collect()) == [1, 2, 4, 5]


@pytest.mark.parametrize("copies,edits", [(110, 5), (60, 8)])
def test_many_copies_around_the_threshold(make, copies, edits):
    """Groups whose members resemble each other by about 0.75 to 0.9: some pairs link, most do not."""
    rng = random.Random(edits)
    base = [f"b{i}" for i in range(400)]
    rows = []
    for k in range(copies):
        own = list(base)
        for at in rng.sample(range(400), edits):
            own[at] = f"v{rng.randrange(10**6)}"
        rows.append((k, " ".join(own)))
    check(make(*rows))


def test_groups_across_clusters_name_classes_and_no_pairs(make, monkeypatch):
    """Rows of a bucket come out once each, however many of them are apart."""
    rng = np.random.default_rng(1)
    base = np.unique(rng.integers(0, 2**64, 600, dtype=np.uint64))
    sets = [np.unique(np.concatenate([base[rng.random(len(base)) > 0.1],
                                      rng.integers(0, 2**64, 40, dtype=np.uint64)])) for _ in range(500)]
    regs = near_dup.registers(sets)
    node = np.arange(500)
    batch = near_dup.pa.record_batch({
        "cell": np.zeros(500, np.int64), "pair": np.zeros(500, bool), "home": np.zeros(500, np.int64),
        "node": node, "cluster": node, "n": np.array([len(s) for s in sets]),
        "regs": near_dup.pa.array([r.tobytes() for r in regs], near_dup.pa.binary())})
    out = list(near_dup._reachable(85)(iter([batch])))
    assert sum(b.num_rows for b in out) <= 500 and len({g for b in out for g in b.column("group").to_pylist()}) == 1


def test_keep_one_drops_rows_and_not_ids(make, spark):
    a, b, c = "a b c d e f g", "other words that stand in here", "third text of its own kind"
    docs = make((1, a), (2, a), (2, b), (3, c), (3, a), (4, b)).selectExpr("*", "1 AS node", "'x' AS kept")
    got = near_dup.keep_one(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in got.collect()) == [(1, a), (2, b), (3, c)]
