import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

import __spark_entry__ as E  # noqa: E402
import check_oracle as CO  # noqa: E402
import corpus_pipeline as P  # noqa: E402
from plotwise.llm import catalog, mixing, ngram_join, toxicity  # noqa: E402
from plotwise.llm.tables import fresh, read  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_registered():
    names = E.queries()
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and set(catalog.ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_queries_match_their_sql(spark, name):
    got = CO.spark_pandas(catalog.QUERIES[name](spark, SF))
    assert CO.compare(got, CO.duck(SF).execute(catalog.ORACLE[name]).df()) == []


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE)))
def test_other_queries_run(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0


def test_stages_in_turn(spark, tmp_path):
    docs = read(spark, SF, "documents")
    seen = [docs]
    for i, (_, stage) in enumerate(P.STAGES):
        stage(spark, seen[-1], SF).write.parquet(str(tmp_path / str(i)))
        seen.append(spark.read.parquet(str(tmp_path / str(i))))
    ids = [{r.doc_id for r in d.select("doc_id").collect()} for d in seen[:-1]]
    assert all(d.columns == docs.columns for d in seen[:-1]) and all(b <= a for a, b in zip(ids, ids[1:], strict=False))
    model = toxicity.learn(docs, read(spark, SF, "labels"))
    assert ids[1] == {r.doc_id for r in toxicity.score(docs, model).collect() if not r.predicted}
    groups = {r.doc_id: r for r in ngram_join.link(seen[1], 5, 80).collect()}
    assert ids[2] == {i for i, r in groups.items() if r.component_id == i}
    bench = [r.text for r in read(spark, SF, "benchmark").collect()]
    held = {r.doc_id for r in seen[2].collect() if any(b in (r.text or "") for b in bench)}
    assert held and not held & ids[3] and len(ids[2] - held - ids[3]) == 0
    assert seen[4].count() == sum(r.copies for r in mixing.mix_counts(seen[3]).collect())
    packed = {d.doc_id for r in seen[5].collect() for d in r.docs}
    assert packed == ids[4]


def test_fresh_names(spark):
    assert fresh(spark.range(1).selectExpr("id as _Size", "id as __size"), "_size", "_size") == ["___size", "____size"]
