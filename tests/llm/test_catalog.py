import re

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from agrolens.llm import catalog, quality
from agrolens.plans.oracle_check import TABLES, table_hash
from tests.conftest import SF_SMALL
from tests.llm import brute


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in {*TABLES, "documents", "pages", "benchmark", "labels", "conversations", "embeddings"}:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_equals_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(cols) and len(rows) == len(want)
    assert table_hash(df.columns, rows)[0] == table_hash(cols, want)[0]


def test_one_query_per_operator():
    ours = [k for k in E.queries() if re.match(r"op\d+_", k)]
    assert sorted(int(k[2:].split("_")[0]) for k in ours) == list(range(1, 14)) and "pipeline" in E.queries()


@pytest.mark.parametrize("name", ["op1_quality_rules", "op5_chat_format", "op10_licence_scan"])
def test_native_operators_run_no_python(spark, name):
    plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_pipeline_equals_brute_force(spark):
    docs = sorted(spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect(), key=lambda r: r.doc_id)
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    trusted = {r.doc_id for r in labels if r.quality == 1 and r.toxic == 0}
    verdict = brute.quality([(r.doc_id, r.text) for r in docs], trusted, quality.BUCKETS, quality.SMOOTHING, quality.MIN_SCORE)
    left = [(r.doc_id, r.text) for r in docs if verdict[r.doc_id][1]]
    comps = brute.components([(i, brute.fingerprint(t)) for i, t in left])
    left = [x for x, c in zip(left, comps) if x[0] == c]
    cut = []
    for (i, t), gone in zip(left, brute.removed([t for _, t in left])):
        cut.append((i, " ".join(w for w, g in zip(brute.spaced(t), gone) if not g) if any(gone) else t))
    left = [(i, t) for i, t in cut if not brute.contaminated(t, items)[1]]
    from agrolens.llm import bpe
    import hashlib
    tok = bpe.Bpe(bpe.read_ranks(catalog.RANKS), catalog.PATTERN)
    want = sorted((i, len(tok.encode(t)) // 4, hashlib.sha256(tok.encode(t)).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
                  for i, t in left)
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF_SMALL).collect())) == want
    assert 0 < len(want) < len(docs)


def test_stages_return_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_SMALL).columns == docs.columns


def test_stages_take_nulls_repeats_and_empty_tables(spark, make_docs):
    rows = [(1, None), (2, ""), (None, "a b c " * 20), (3, "x y z w " * 9), (3, "x y z w " * 9), (4, "l\n" * 3000)]
    for docs in (make_docs(rows), make_docs([])):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, docs, SF_SMALL).count() <= len(rows)
