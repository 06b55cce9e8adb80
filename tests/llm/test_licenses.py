import re

import pytest

from basketflow.llm import licenses
from llm_helpers import rows_by_id


def brute(text):
    out = []
    for no, line in enumerate((text or "").split("\n")):
        grams = licenses.template_bigrams(line)
        best = max((2 * len(set(grams) & set(own)) / (len(grams) + len(own)), name)
                   for name, own in ((n, licenses.template_bigrams(t))
                                     for n, t in licenses.TEMPLATES.items()))
        if best[0] >= licenses.THRESHOLD:
            out.append((no, best[1], pytest.approx(best[0])))
    return out


def check(docs):
    got = {}
    for r in licenses.matches(docs).collect():
        got.setdefault(r.doc_id, []).append((r.line_no, r.template, r.dice))
    for r in docs.select("doc_id", "text").dropDuplicates().collect():
        assert sorted(set(got.get(r.doc_id, []))) == sorted(brute(r.text))


def test_matches_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    check(docs)
    found = licenses.scanned(docs).filter("n_notices > 0").count()
    named = sum(bool(re.search("(?i)licen[sc]ed? |mit license", r.text)) for r in docs.collect())
    assert found == named > 0


def test_near_notices(make):
    docs = make((1, "x\nReleased under the MIT license\ny"),
                (2, "This work is licensed under the GNU General Public License version 2."),
                (3, "Released at last under nobody's license or whatever else"),
                (4, licenses.TEMPLATES["MIT-grant"].upper()))
    check(docs)
    names = {r.doc_id: r.templates for r in licenses.scanned(docs).collect()}
    assert names == {1: "MIT", 2: "GPL-3.0", 3: "", 4: "MIT-grant"}


def test_odd_rows(odd, nothing):
    got = rows_by_id(licenses.scanned(odd))
    assert sum(map(len, got.values())) == odd.count()
    assert all(r.n_notices == 0 for rows in got.values() for r in rows)
    assert licenses.scanned(nothing).count() == 0


def test_no_python_on_the_main_path(odd):
    plan = licenses.scanned(odd)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_matches_sql(spark, sf_dir):
    import __spark_entry__ as contract
    from compare import connect, mismatch
    name = "op9_license_scan"
    assert mismatch(spark, connect(sf_dir), sf_dir, contract.queries()[name],
                    contract.oracle_sql()[name]) is None
