from basketflow.llm import language
from basketflow.llm import texts as tx
from llm_helpers import rows_by_id


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    got = language.predicted(docs, language.learn(docs)).filter(tx.id_bucket(3) == 1)
    right = got.join(docs.select("doc_id", "lang"), "doc_id").selectExpr(
        "avg(CAST(lang = lang_pred AS int)) AS share").first().share
    assert right >= 0.97


def test_odd_rows(odd):
    got = rows_by_id(language.predicted(odd, language.learn(odd)))
    assert sum(map(len, got.values())) == odd.count()
    for i in (1, 2, 3, 7, 9):
        assert [(r.lang_pred, r.score) for r in got[i]] == [("und", 0.0)]
    known = {r.lang for r in odd.select("lang").collect()} - {None}
    assert all(r.lang_pred in known for i in (4, 5, 6, 8) for r in got[i])
    assert all(0 <= r.score <= 1 for rows in got.values() for r in rows)


def test_labels_of_the_row_do_not_matter(make):
    docs = make(*[(k, "the cat and the dog went out " * 3, "en") for k in range(12)],
                *[(20 + k, "der hund und die katze gehen aus " * 3, "de") for k in range(12)])
    model = language.learn(docs)
    asked = make((100, "the dog and the cat", "de", "x"), (101, "die katze und der hund", None, None))
    got = {r.doc_id: r.lang_pred for r in language.predicted(asked, model).collect()}
    assert got == {100: "en", 101: "de"}


def test_nothing_to_learn_from(nothing, make):
    assert language.learn(nothing) is None
    row = language.predicted(make((1, "some words")), None).first()
    assert (row.lang_pred, row.score) == ("und", 0.0)
    assert language.predicted(nothing, None).count() == 0
