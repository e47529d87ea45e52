"""The registered queries against their SQL, and the pipeline against plain Python."""

from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from clientele.llm.gray_index import simhash
from clientele.llm.queries import ORACLES, QUERIES
from tests.llm.data import SF_DIR, awkward, crc, groups, nothing, shingles, tokens
from tests.llm.test_line_dedup import plain as plain_lines


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    result, expected = QUERIES[name](spark, SF_DIR), duck.execute(ORACLES[name])
    names = [d[0] for d in expected.description]
    assert sorted(names) == sorted(result.columns)
    rows = Counter(expected.fetchall())
    assert rows and Counter(map(tuple, result.select(*names).collect())) == rows


@pytest.mark.parametrize("name, table", [("op1_site_tree", "pages"), ("op2_best_fit_packing", "documents"), ("op3_range_coding", "documents"),
    ("op5_gray_index", "documents"), ("op7_role_repair", "conversations"), ("op8_bilstm_crf", "documents"), ("op10_license_scan", "documents"), ("op11_two_stage_suffixes", "documents"),
    ("op12_fragment_monoid", "documents")])
def test_query_runs_over_its_whole_table(spark, duck, name, table):
    n = QUERIES[name](spark, SF_DIR).count()
    rows = duck.execute(f"SELECT count(*) FROM {table}").fetchone()[0]
    assert 0 < n < rows if name == "op10_license_scan" else n >= rows


def test_pipeline(spark, duck):
    kept = {r[0] for r in duck.execute(f"SELECT doc_id FROM ({ORACLES['op4_line_frequency']}) WHERE kept").fetchall()}
    docs = [r for r in duck.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall() if r[0] in kept]
    docs = [(i, "\n".join(lines)) for (i, _), lines in zip(docs, plain_lines(docs))]
    prints = [simhash(t.encode()) for _, t in docs]
    root = groups(len(docs), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    docs = [d for i, d in enumerate(docs) if root[i] == i]
    items = [set(shingles(t, 5)) for (t,) in duck.execute("SELECT text FROM benchmark").fetchall()]
    docs = [(i, t) for i, t in docs if not any(len(x & set(shingles(t, 5))) >= 0.8 * len(x) for x in items)]
    expected = set()
    for i, t in docs:
        ids = tokens("byte_bpe_50k.json", t)
        at, piece, n = 0, 0, len(ids) % 1024 or 1024
        while at < len(ids):
            expected.add((i, piece, at, n, crc(ids[at : at + n])))
            at, piece, n = at + n, piece + 1, 1024
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {tuple(r)[:5] for r in rows} == expected and len(rows) == len(expected)


def test_stages_take_awkward_and_empty_tables(spark):
    for docs in (awkward(spark), nothing(spark)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF_DIR)
            if name != "best-fit packing":
                assert out.columns == docs.columns
                assert [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
                docs = spark.createDataFrame(out.collect(), out.schema)
        out.collect()


def test_stage_keeps_clean_documents(spark, duck):
    """Texts of distinct prose pass all filtering stages."""
    rows = [(i, " ".join(f"q{i}z{k}" for k in range(80)), "en", f"src{i % 3}", 9) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_DIR).count() == 120, name
