"""The registered queries over the small driver tables, and the pipeline."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from fieldstat.llm.queries import llm_oracles, llm_queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def test_registered():
    assert [n.split("_")[0] for n in llm_queries()] == [f"op{i}" for i in range(1, 14)]
    assert {"pipeline", *llm_queries()} <= set(E.queries())


@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in "documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(llm_oracles()[name]).df()
    got = llm_queries()[name](spark, SF).toPandas()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)

    def plain(v):
        return None if v is None or pd.isna(v) else int(v) if isinstance(v, float) and v.is_integer() else v

    def tuples(p):
        return sorted((tuple(map(plain, r)) for r in p[cols].itertuples(index=False, name=None)),
                      key=lambda r: [(v is None, v if v is not None else 0) for v in r])

    assert tuples(got) == tuples(want)


def test_pipeline(spark, tmp_path):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs.count()
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns, name
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != "source_mix":
            assert 0 < docs.count() <= before
            before = docs.count()
    assert docs.count() > 0


def tables(spark, path, rows):
    """A corpus folder of awkward documents with labels, benchmark, pages and vectors."""
    from tests.llm.helpers import docs
    d = docs(spark, rows)
    d.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (4, 1, None), (None, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(0, "same text here now indeed"), (1, None), (None, "x")], "item_id long, text string").write.parquet(
        f"{path}/benchmark.parquet")
    spark.createDataFrame([(1, "u", None), (None, None, "<p>Text here. Yes.</p>")], "page_id long, url string, html string").write.parquet(
        f"{path}/pages.parquet")
    spark.createDataFrame([(0, [1.0, 2.0]), (1, None), (None, [1.0, 1.0]), (2, [])], "vec_id long, embedding array<float>").write.parquet(
        f"{path}/embeddings.parquet")
    spark.createDataFrame([(1, 0, "user", None), (1, None, None, "b."), (None, 1, "assistant", ""), (2, 5, "system", "c.")],
                          "conv_id long, turn long, role string, text string").write.parquet(f"{path}/conversations.parquet")
    return d


def test_awkward_rows_pass_every_query_and_stage(spark, tmp_path):
    import corpus_pipeline
    from tests.llm.helpers import AWKWARD
    rows = [(*r, None, None) for r in AWKWARD] + [(50, "\u0000 odd", "", ""), (51, "a\nb", "s", "en")]
    d = tables(spark, str(tmp_path), rows)
    for name, query in llm_queries().items():
        n = query(spark, str(tmp_path)).count()
        if name.split("_")[0] in ("op3", "op4", "op6", "op7", "op9", "op10", "op12"):
            assert n == len(rows), name
    clashing = d.withColumns({c: d["n_chars"] for c in ("id", "k1", "row", "line", "toxicity", "gap")})
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, clashing, str(tmp_path)).count() >= 0
        assert stage(spark, clashing.limit(0), str(tmp_path)).count() == 0, name
    assert corpus_pipeline.run(spark, str(tmp_path)).where("doc_id = 51").count() >= 0


def test_empty_tables(spark, tmp_path):
    tables(spark, str(tmp_path / "full"), [(1, "a b c", "s", "en")])
    for t in ("documents", "labels", "benchmark", "pages", "embeddings", "conversations"):
        spark.read.parquet(str(tmp_path / "full" / f"{t}.parquet")).limit(0).write.parquet(str(tmp_path / "none" / f"{t}.parquet"))
    for name, query in llm_queries().items():
        assert query(spark, str(tmp_path / "none")).count() == 0, name
