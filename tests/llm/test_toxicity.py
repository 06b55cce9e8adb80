import numpy as np
import pytest

from basketflow.llm import texts as tx
from basketflow.llm import toxicity
from basketflow.llm.toxicity import Model, score_rows
from llm_helpers import rows_by_id

MODEL = Model(["disgusting", "idiot", "scum", "lowei"], [False, False, False, True],
              [0.98, 0.97, 0.96, 0.95], frozenset({"idiom"}))


def score(*texts):
    raw = [t.encode() for t in texts]
    bounds = np.cumsum([0] + [len(r) for r in raw])
    return score_rows(MODEL, np.frombuffer(b"".join(raw), np.uint8), bounds)[0]


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[-1] + 1))
        row = new
    return row[-1]


def test_exact_misspelled_and_stem_hits():
    got = score("you idiot", "you idi0t", "you iddiot", "you idot", "an idiom", "scam", "loweischaft",
                "xlowei", "IDIOT!", "a calm text", "")
    assert (got[[0, 6, 8]] > 0.9).all()
    assert (got[[1, 2, 3]] > 0.7).all()
    assert (got[[4, 5, 7, 9, 10]] < 0.01).all()


def test_quotation_lowers_the_score():
    bare, quoted = score("he is an idiot today", 'they wrote "what an idiot" in the report')
    assert quoted < 0.7 < bare


def test_automaton_agrees_with_edit_distance():
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("disgutnabc"), rng.integers(1, 14))) for _ in range(3000)]
    words += ["disgusting", "disgustng", "dsgustin", "idiot", "diiot", "idiots", "scum"]
    width = MODEL.width
    codes = np.array([[ord(c) for c in w[:width]] + [0] * (width - len(w)) for w in words], np.uint32)
    entry, distance = MODEL.match(codes, np.array([len(w) for w in words]))
    for w, e, d in zip(words, entry, distance):
        want = min(((edits(w, t), i) for i, t in enumerate(MODEL.words[:3])
                    if edits(w, t) <= MODEL.allowed(i)), default=(None, -1))
        assert (e >= 0) == (want[1] >= 0) and (e < 0 or d == want[0]), w


def test_held_out_rows_are_told_apart(spark):
    read = lambda t: spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet")
    docs, labels = read("documents"), read("labels")
    model = toxicity.learn(docs, labels)
    held = (toxicity.scored(docs, model).filter(tx.id_bucket(3) == 1).join(labels, "doc_id"))
    hits = {(r.toxic, r.p): r["count"] for r in held.selectExpr(
        "toxic", "score >= 0.7 AS p").groupBy("toxic", "p").count().collect()}
    wrong = hits.get((0, True), 0)
    assert wrong <= 0.01 * hits[0, False]
    assert hits[1, True] >= 0.75 * (hits[1, True] + hits.get((1, False), 0))


def test_scores_do_not_read_the_label_columns(make):
    docs = make((1, "an idiot speaks", "xx", "zz"), (2, "an idiot speaks", None, None))
    a, b = toxicity.scored(docs, MODEL).collect()
    assert a.score == b.score


def test_odd_rows(spark, odd):
    labels = spark.createDataFrame([(5, 1), (6, 0), (None, 1), (99, 1), (4, None), (8, 7)],
                                   "doc_id long, toxic int")
    model = toxicity.learn(odd, labels)
    got = rows_by_id(toxicity.scored(odd, model))
    assert sum(map(len, got.values())) == odd.count()
    assert all(0 <= r.score <= 1 for rows in got.values() for r in rows)
    assert toxicity.keep_clean(odd, model).columns == odd.columns


def test_no_rows_and_no_labels(spark, nothing, make):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.learn(nothing, labels)
    assert toxicity.scored(nothing, model).count() == 0
    assert [r.score for r in toxicity.scored(make((1, "idiot")), model).collect()] == [0.0]


@pytest.mark.parametrize("threshold,left", [(0.7, [2]), (1.1, [1, 2])])
def test_keep_clean_drops_at_the_threshold(make, threshold, left):
    docs = make((1, "idiot"), (2, "fine"))
    assert sorted(r.doc_id for r in toxicity.keep_clean(docs, MODEL, threshold).collect()) == left
