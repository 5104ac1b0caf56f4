"""The registered queries as a whole."""

import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as registry

SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def test_every_query_has_sql_with_the_same_columns(spark):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    assert set(registry.QUERIES) - set(registry.ORACLES) == {"embedding_index_search"}  # approximate; its recall has a query of its own
    assert set(registry.oracle_sql()) <= set(registry.queries())
    for name, sql in registry.oracle_sql().items():
        columns = [d[0] for d in db.execute(f"SELECT * FROM ({sql}) LIMIT 0").description]
        assert len(columns) == len(set(columns)), name


@pytest.mark.parametrize("name", ["patient_summary", "payer_gap_by_condition", "manifest_ingest", "gps_latest"])
def test_a_few_run_on_the_smallest_tables(spark, name):
    assert registry.queries()[name](spark, SMALL).count() > 0


def test_entry(spark):
    assert registry.entry(spark).count() == registry.queries()["omop_person"](spark, SMALL).count()


def test_the_rest_works_without_the_optional_subpackage():
    """The entry module imports, and knows its other queries, where the subpackage is gone."""
    code = "import sys; sys.modules['ledgerloom.llm'] = None; import __spark_entry__ as e; print(len(e.queries()), set(e.queries()) == set(e.QUERIES))"
    done = subprocess.run([sys.executable, "-c", code], cwd=os.path.dirname(registry.__file__), capture_output=True, text=True, check=True)
    assert done.stdout.split() == [str(len(registry.QUERIES)), "True"]
