import pytest

SF = "/root/testdata/sf0.001"


def test_stages_run_and_keep_the_columns(spark):
    import corpus_pipeline
    from catlens.llm.shared import saved, table

    docs = table(spark, SF, "documents")
    n = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = saved(stage(spark, docs, SF), "stage")
        assert out.columns == docs.columns and 0 < out.count() <= 2 * n, name
        docs = out
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert out.count() == docs.count() and out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_stages_take_empty_tables_and_clashing_columns(spark):
    import corpus_pipeline
    from catlens.llm.shared import saved

    rows = [(1, "a b c d e f g", "en", "src0", 13, "x", 1), (None, None, None, None, None, None, 2), (1, "a b c d e f g", "en", "src0", 13, "x", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, node string, k1 int"
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for name, stage in corpus_pipeline.STAGES:
            docs = saved(stage(spark, docs, SF), "stage")
            if name != corpus_pipeline.STAGES[-1][0]:
                assert docs.columns == [c.split()[0] for c in schema.split(", ")]


@pytest.mark.parametrize("name", ["op3_ngram_join", "op5_hierarchical_mixing", "op7_fm_index_dedup", "op10_warc_index"])
def test_queries_equal_their_sql(spark, name):
    import duckdb
    from catlens.llm.oracle import ORACLE_SQL
    from catlens.llm.queries import QUERIES

    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLE_SQL[name]})").fetchall()
    assert sorted((tuple(r) for r in got.select(columns).collect()), key=str) == sorted(want, key=str)
