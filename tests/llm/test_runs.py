import hashlib
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from basketflow.llm import runs
from llm_helpers import rows_by_id

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(words):
    """Every lag, every stretch; smallest period by trying all smaller ones."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            end = j + q
            if j > i and end - i >= max(6, 4 * q) and not any(
                    all(words[x] == words[x + d] for x in range(i, end - d)) for d in range(1, q)):
                out.append((i, end - i, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def planted(doc, words):
    h = zlib.crc32(str(doc).encode())
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def report(doc, text):
    words = planted(doc, WORD.findall(text or ""))
    found = brute(words)
    gone = {x for s, n, q in found for x in range(s + q, s + n)}
    best = None
    for r in found:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in found)),
            sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def columns(r):
    return (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256)


def find(*docs):
    first = np.cumsum([0, *map(len, docs)])
    codes = np.array([w for d in docs for w in d], np.int64)
    out = [[] for _ in docs]
    for d, s, e, q in runs.find(codes, first).tolist():
        out[d].append((s - first[d], e - s, q))
    return out


def test_whole_query(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = {r.doc_id: report(r.doc_id, r.text) for r in docs.collect()
            if len(WORD.findall(r.text or "")) < 1500}
    got = {r.doc_id: columns(r) for r in runs.reported(docs, planted=True).collect()}
    assert len(got) == docs.count() and len(want) > 150
    assert {k: got[k] for k in want} == want
    assert sum(w[0] for w in want.values()) > 10


block = st.builds(lambda base, times, more: base * times + base[:more],
                  st.lists(st.integers(0, 2), min_size=1, max_size=40), st.integers(1, 6),
                  st.integers(0, 39))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(block, max_size=4).map(lambda x: sum(x, [])), min_size=1, max_size=4))
def test_finds_every_run_of_any_scale(docs):
    assert find(*docs) == [brute(d) for d in docs]


def test_long_periods_and_runs_within_runs():
    words = np.arange(3000) % 701
    assert find(words.tolist()) == [[(0, 3000, 701)]]
    inner = [0] * 9 + list(range(1, 60))
    assert find(inner * 5) == [brute(inner * 5)]
    assert find([7] * 5, [7] * 6, [7] * 2 + [8] * 6) == [[], [(0, 6, 1)], [(2, 6, 1)]]


def test_thue_morse_and_fibonacci_words():
    tm = [bin(i).count("1") % 2 for i in range(5000)]
    a, b = [0], [0, 1]
    while len(b) < 2000:
        a, b = b, b + a
    assert find(tm) == [[]] and find(b) == [brute(b)]       # cubes at most, no fourth powers


def test_strongest_is_compared_exactly():
    assert runs.strongest([(0, 10 ** 9 + 1, 10 ** 8), (5, 20, 2)]) == (0, 10 ** 9 + 1, 10 ** 8)
    assert runs.strongest([(1, 8, 2), (4, 12, 3)]) == (1, 8, 2)
    assert runs.strongest([]) is None


def test_odd_rows(odd, nothing):
    got = rows_by_id(runs.reported(odd, planted=True))
    empty = hashlib.sha256(b"").hexdigest()
    for doc in (1, 2, 3, 7):
        assert columns(got[doc][0]) == (0, None, None, None, None, empty, empty)
    assert len(got[5]) == 2 and columns(got[5][0]) == columns(got[5][1])
    assert got[None][0].n_runs == 0
    plain = rows_by_id(runs.reported(odd))
    assert (plain[4][0].n_runs, plain[4][0].period, plain[4][0].length) == (1, 977, 60_000)
    assert runs.reported(nothing).count() == 0


def test_listed_and_collapsed(make, odd):
    docs = make((1, "a b  a b\na b a b c"), (2, "x x x x x"), (3, None), (4, "y y\ty y y y y!"))
    assert [tuple(r) for r in runs.listed(docs).collect()] == [(1, 0, 8, 2), (4, 0, 6, 1)]
    left = rows_by_id(runs.collapsed(docs))
    assert [left[i][0].text for i in (1, 2, 3, 4)] == ["a b c", "x x x x x", None, "y y!"]
    assert runs.collapsed(odd).columns == odd.columns and runs.collapsed(odd).count() == odd.count()
