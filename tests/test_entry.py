"""The entry module with and without the optional subpackage, and core queries against their SQL."""

import os
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_imports_without_the_subpackage(tmp_path):
    shutil.copytree(f"{ROOT}/docloom", tmp_path / "docloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; assert not any(q.startswith('op') for q in e.queries()) and 'pipeline' not in e.queries(); assert e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")
@pytest.mark.parametrize("name", ["consensus", "dealer_match", "cost_summary", "calibration_bins", "al_sample", "verify_detection"])
def test_queries_match_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    plain = lambda v: round(v, 9) if isinstance(v, float) else v
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=str)
    rel = con.sql(entry.oracle_sql()[name])
    at = [rel.columns.index(c) for c in cols]
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in rel.fetchall()), key=str)


def test_streaming(spark, tmp_path):
    from docloom.streaming import costs

    log = spark.sql("SELECT 1L doc_id, 'tier3_vlm' component, 1D latency, timestamp'2024-01-01 00:10:00' ts UNION ALL SELECT 2L, 'paddle_ocr', 2D, timestamp'2024-01-01 00:50:00'")
    log.write.parquet(str(tmp_path / "log"))
    stream = costs.rolling(costs.arriving(spark, str(tmp_path / "log"), log.schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")))
    q = stream.writeStream.outputMode("complete").format("memory").queryName("rolled").start()
    q.processAllAvailable()
    q.stop()
    row = spark.sql("SELECT * FROM rolled").first()
    assert (row["calls"], row["vlm_calls"], row["vlm_share"]) == (2, 1, 0.5)
