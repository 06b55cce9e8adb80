import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from test_line_dedup import LONG
from test_near_dup import brute


@pytest.fixture
def stage(spark, sf_dir):
    found = dict(corpus_pipeline.STAGES)
    return lambda name, docs: found[name](spark, docs, sf_dir)


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line dedup", "near duplicates", "source mixing", "bpe"]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_columns_and_odd_rows_survive(stage, odd, nothing, name):
    odd = odd.drop("deleted")
    got = stage(name, odd)
    assert got.columns == odd.columns
    got.collect()
    assert stage(name, nothing).count() == 0


def test_bpe_stage_takes_odd_rows(stage, odd, nothing):
    got = stage("bpe", odd).collect()
    assert len(got) == odd.count()
    assert {r.n_tokens for r in got if r.doc_id in (1, 2, 3, 7)} == {0}
    assert stage("bpe", nothing).count() == 0


def test_near_stage_loses_no_text(stage, make):
    """Ids that stand at several texts: every text is still there once the copies have gone."""
    a, b, c = "a b c d e f g", "other words that stand in here", "third text of its own kind"
    rows = [(1, a), (2, a), (2, b), (3, c), (3, a), (4, b), (4, c)]
    got = [r.text for r in stage("near duplicates", make(*rows)).collect()]
    assert sorted(got) == sorted([a, b, c])


def test_line_stage_drops_copies_and_keeps_the_rest(stage, make):
    docs = make((1, f"first\n{LONG}"), (2, f"first\n{LONG}"), (3, f"third\n{LONG}"), (4, ""), (5, None))
    got = {r.doc_id: (r.text, r.n_chars) for r in stage("line dedup", docs).collect()}
    assert got == {1: (f"first\n{LONG}", len(LONG) + 6), 3: ("third", 5), 4: ("", 0), 5: (None, None)}


def test_near_stage_matches_all_pairs(spark, sf_dir, stage):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = {i for i, (_, root) in brute([(r.doc_id, r.text) for r in docs.collect()]).items()
            if root == i}
    assert {r.doc_id for r in stage("near duplicates", docs).collect()} == want


def test_run(spark, sf_dir):
    got = corpus_pipeline.run(spark, sf_dir)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert 0 < got.count() and "pipeline" in contract.queries()


def test_every_operator_is_registered():
    names = contract.queries()
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1


def test_encode_counts_tokens(stage, make):
    text = "Hello world, it's 12:30"
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    row = stage("bpe", make((1, text))).first()
    assert row.n_tokens == len(t.encode(text, add_special_tokens=False).ids)
