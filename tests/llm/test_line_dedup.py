import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from basketflow.llm import line_dedup
from llm_helpers import rows_by_id

PASSAGE = "\n".join(" ".join(f"p{i}x{j}" for j in range(15)) for i in range(4))
LONG = " ".join(f"l{i}" for i in range(60))


def texts(df):
    return {i: [r.text for r in rows] for i, rows in rows_by_id(line_dedup.deduplicated(df)).items()}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=12), st.lists(st.integers(0, 5), max_size=12))
def test_patience_aligns_equal_lines_in_order(a, b):
    pairs = line_dedup.patience(np.array(a, np.uint64), np.array(b, np.uint64))
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
    if a == b:
        assert len(pairs) == len(a)


def test_repeated_passage_leaves_the_later_documents_only(make):
    docs = make((1, f"alpha start\n{PASSAGE}\nalpha end"), (2, f"beta start\n{PASSAGE}\nbeta end"),
                (3, f"{LONG}\ngamma"), (4, f"delta\n{LONG}\ndelta end"), (5, f"{LONG} changed"))
    got = texts(docs)
    assert got[1] == [f"alpha start\n{PASSAGE}\nalpha end"]
    assert got[2] == ["beta start\nbeta end"]
    assert got[3] == [f"{LONG}\ngamma"]
    assert got[4] == ["delta\ndelta end"]
    assert got[5] == [f"{LONG} changed"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=14), st.lists(st.integers(0, 3), max_size=14))
def test_every_held_run_of_lines_is_found(own, other):
    want = set()
    for low in range(len(own)):
        for high in range(low + 1, len(own) + 1):
            if 10 * (high - low) >= line_dedup.MIN_WORDS and any(
                    own[low:high] == other[k:k + high - low] for k in range(len(other))):
                want.update(range(low, high))
    got = line_dedup.repeated_lines(np.array(own, np.uint64), np.full(len(own), 10),
                                    np.array(other, np.uint64))
    assert got.tolist() == sorted(want)


def test_passages_held_twice_or_in_another_order_go(make):
    other = "\n".join(" ".join(f"q{i}x{j}" for j in range(15)) for i in range(5))
    docs = make((1, f"a1\n{PASSAGE}\na2\n{PASSAGE}\na3\n{other}\na4"),
                (2, f"b1\n{PASSAGE}\nb2"), (3, f"c1\n{PASSAGE}\nc2\n{PASSAGE}\nc3"),
                (4, f"d1\n{other}\nd2\n{PASSAGE}\nd3"))
    got = texts(docs)
    assert got[1] == [f"a1\n{PASSAGE}\na2\n{PASSAGE}\na3\n{other}\na4"]
    assert (got[2], got[3], got[4]) == (["b1\nb2"], ["c1\nc2\nc3"], ["d1\nd2\nd3"])


def test_short_shared_lines_stay(make):
    docs = make((1, "Common heading line\nfirst body"), (2, "Common heading line\nsecond body"))
    assert texts(docs) == {1: ["Common heading line\nfirst body"],
                           2: ["Common heading line\nsecond body"]}


def test_whole_copies_become_empty_and_many_sharers_all_lose_it(make):
    docs = make(*[(k, f"own line {k}\n{LONG}\n{PASSAGE}") for k in range(40)],
                (50, f"own line 0\n{LONG}\n{PASSAGE}"))
    got = texts(docs)
    assert got[0] == [f"own line 0\n{LONG}\n{PASSAGE}"]
    assert all(got[k] == [f"own line {k}"] for k in range(1, 40))
    assert got[50] == [""]


def test_partners_are_named(make):
    docs = make((7, f"x\n{LONG}"), (9, f"y\n{LONG}"))
    rows = rows_by_id(line_dedup.deduplicated(docs))
    assert rows[9][0].partners == [7] and rows[9][0].deleted_words == 60 and rows[7][0].partners is None


def test_odd_rows(odd):
    got = line_dedup.deduplicated(odd.drop("deleted"))
    assert got.count() == odd.count()
    by = rows_by_id(got)
    before = rows_by_id(odd)
    assert all(sorted((r.text or "") for r in by[i]) == sorted((r.text or "") for r in before[i])
               for i in before)
    assert by[1][0].text is None


def test_no_rows(nothing):
    assert line_dedup.deduplicated(nothing).count() == 0
