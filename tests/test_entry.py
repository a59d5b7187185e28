import glob
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SAMPLE = ["hybrid_retrieve", "mention_merge", "relation_aggregate", "lexical_hits", "candidate_concepts", "shortest_paths", "p5_found", "p6_found", "import_contract_violations", "anchor_scores", "upsert_mentions", "section_compat"]


def test_import_needs_no_session():
    code = "import __spark_entry__ as e; assert set(e.oracle_sql()) <= set(e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def plain(v):
    return "" if v is None else str(round(float(v), 5)) if isinstance(v, float) or type(v).__name__ == "Decimal" else str(v)


@pytest.mark.parametrize("name", SAMPLE)
def test_queries_equal_their_sql(spark, smallest, name):
    con = duckdb.connect()
    for path in glob.glob(f"{smallest}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    cursor = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    want = sorted(tuple(map(plain, r)) for r in cursor.fetchall())
    df = entry.queries()[name](spark, smallest)
    assert sorted(df.columns) == sorted(names)
    assert sorted(tuple(plain(r[c]) for c in names) for r in df.collect()) == want
