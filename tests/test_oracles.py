"""Every query with DuckDB SQL gives the same rows as the SQL on the smallest driver tables."""

import math
import os

import duckdb
import pytest

from chatloom import catalog
from chatloom.session import TABLES

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ORACLES = catalog.oracle_sql()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def value(v):
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return int(v) if isinstance(v, bool) else v


def rows(columns, found):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(value(r[i]) for i in order) for r in found), key=str)


#: Ways in which adaptive execution deals partitions out: no result may depend on them.
SETTINGS = {
    "default": {},
    "16 partitions, none folded": {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"},
    "no exchange reused": {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.exchange.reuse": "false"},
    "folded to 64 KB": {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"},
}


@pytest.fixture(params=sorted(SETTINGS))
def settings(spark, request):
    before = {k: spark.conf.get(k, None) for k in SETTINGS[request.param]}
    for k, v in SETTINGS[request.param].items():
        spark.conf.set(k, v)
    yield request.param
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def same_rows(spark, db, name, data):
    df = catalog.queries()[name](spark, data)
    cur = db.execute(ORACLES[name])
    columns = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(columns, cur.fetchall())


#: Queries that write and format files, half a minute each: they run under two of the settings.
LONG = ("tree_formatted", "tree_record_counts", "corpus_manifest")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, db, settings, name):
    if name in LONG and settings not in ("default", "folded to 64 KB"):
        pytest.skip("runs under two settings")
    same_rows(spark, db, name, DATA)


@pytest.mark.parametrize("name", ["mix_order", "mix_conservation", "doc_byte_budget", "doc_exact_dedup", "doc_max_records_head"])
def test_order_holds_over_many_partitions(spark, settings, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.1/{t}.parquet'")
    same_rows(spark, con, name, "/root/testdata/sf0.1")


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(ORACLES)))
def test_query_runs(spark, name):
    assert catalog.queries()[name](spark, DATA).count() > 0


def test_flagship(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_ordered_digest_of_a_language_of_more_than_three_levels_of_64(spark, tmp_path):
    con = duckdb.connect()
    con.execute(f"COPY (SELECT i AS doc_id, 't' || i AS text, CASE WHEN i % 70000 < 3 THEN 'de' ELSE 'en' END AS lang FROM range({64**3 + 100}) r(i)) TO '{tmp_path}/documents.parquet'")
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet'")
    same_rows(spark, con, "doc_ordered_digest", str(tmp_path))


@pytest.mark.parametrize("doc_id", ["i", "i // 9", "CASE WHEN i % 5 > 0 THEN i END"])
@pytest.mark.parametrize("text_is_null", ["FALSE", "i % 5 = 0", "i % 900 < 500", "i % 3 = 0"])
def test_ordered_digest_of_nulls(spark, tmp_path, doc_id, text_is_null):
    con = duckdb.connect()
    con.execute(f"COPY (SELECT {doc_id} AS doc_id, CASE WHEN NOT ({text_is_null}) THEN 't' || i END AS text, ['en', 'de', NULL][1 + i % 3] AS lang FROM range(3000) r(i)) TO '{tmp_path}/documents.parquet'")
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet'")
    same_rows(spark, con, "doc_ordered_digest", str(tmp_path))


@pytest.mark.parametrize("name", ["plan_decisions", "skip_histogram"])
def test_sizes_near_the_limits(spark, tmp_path, name):
    prices = "[19999.4, 19999.5, 19999.99, 20000.0, 20000.01, 299999.5, 300000.0, 300000.01, 300000.49, 300000.5, 300000.99, NULL]"
    con = duckdb.connect()
    con.execute(f"COPY (SELECT i AS o_orderkey, CASE WHEN i % 13 > 0 THEN i % 101 END AS o_custkey, [NULL, '1-URGENT', '2-HIGH'][1 + i % 3] AS o_orderpriority, unnest({prices})::DOUBLE AS o_totalprice FROM range(200) r(i)) TO '{tmp_path}/orders.parquet'")
    con.execute(f"CREATE VIEW orders AS SELECT * FROM '{tmp_path}/orders.parquet'")
    same_rows(spark, con, name, str(tmp_path))
