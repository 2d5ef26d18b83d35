"""The registered queries: names, SQL twins, and agreement on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as registry
from check import TABLES, compare
from fraclake.plans import registered

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")

FAST = ("text_sketch dna_kmer_sketch dna_murmur_sketch splitmix_partition diff_both_ways diff_rollup_k set_compare_jaccard"
        " diff_limited archive_roundtrip archive_status bin_vectors load_meta diff_report ledger_upsert stream_unique").split()


@pytest.fixture(scope="module")
def connection():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return c


def test_every_query_has_a_sql_twin():
    queries, oracles = registered()
    assert set(queries) == set(oracles)
    assert set(queries) <= set(registry.queries()) and set(oracles) <= set(registry.oracle_sql()) <= set(registry.queries())


def test_entry(spark):
    row = registry.entry(spark).first()
    assert row.a_not_b > 0 and row.b_not_a >= 0


@pytest.mark.parametrize("name", FAST)
def test_agreement(spark, connection, name):
    good, note = compare(spark, connection, SF_DIR, name, registry.queries()[name], registry.oracle_sql()[name])
    assert good, note
