"""All six separators of words mean the same to the queries and to their SQL."""

import duckdb

from leafray.llm import queries


def test_vertical_tab_form_feed_and_carriage_return(spark, tmp_path):
    w = [f"w{i}" for i in range(120)]
    data = [(i, sep.join(w)) for i, sep in enumerate([" ", "\t", "\n", "\v", "\f", "\r", "\r\n", "\x1c", "\x0e", " "])]
    data += [(20, "\v\f".join(w[:60]) + "\r" + "\f".join(w[20:])), (21, "\v"), (22, "a\vb\fc\rd\x0be"), (23, None), (24, "")]
    spark.createDataFrame(data, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    engine = duckdb.connect()
    engine.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    for name in ("op2_minhash", "op8_substring_dedup"):
        got = queries.QUERIES[name](spark, str(tmp_path))
        want = engine.execute(queries.ORACLES[name])
        names = [d[0] for d in want.description]
        assert sorted(map(str, (tuple(x) for x in got.select(*names).collect()))) == sorted(map(str, want.fetchall()))
