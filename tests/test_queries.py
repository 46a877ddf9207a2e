"""Named queries against their checking SQL in DuckDB.

By default a selection runs; EBBTIDE_ALL=1 runs every query that has SQL.
"""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF
from ebbtide.schemas import TABLE_NAMES
from tools.check_oracles import rows_of

SOME = ("join_left_features", "join_left_ratio", "metric_ticket", "drift_psi", "roc_curve", "vector_topk",
        "retention_action", "citation_join", "parse_document", "eval_score", "synth_customers", "tool_ticket_history")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in TABLE_NAMES:
        con.execute(f"create view {name} as select * from read_parquet('{SF}/{name}.parquet')")
    return con


def test_inventory():
    named, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(named) and set(SOME) <= set(oracles)


def test_entry(spark):
    assert entry.entry(spark).count() == 150


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()) if os.environ.get("EBBTIDE_ALL") else SOME)
def test_query_equals_sql(spark, db, name):
    df = entry.queries()[name](spark, SF)
    cur = db.execute(entry.oracle_sql()[name])
    want = rows_of([d[0] for d in cur.description], cur.fetchall())
    assert rows_of(df.columns, df.collect()) == want


def test_binary_files_are_read(spark, db, tmp_path):
    """All files, those in folders too."""
    for name in ("region.parquet", "customer.parquet"):
        spark.read.parquet(f"{SF}/{name}").repartition(2).write.parquet(f"{tmp_path}/{name}")
    for folder in (SF, str(tmp_path)):
        got = [tuple(r) for r in entry.queries()["scan_binary_files"](spark, folder).collect()]
        want = db.execute(f"""select parse_filename(filename), size, octet_length(content), md5(content)
 from read_blob('{folder}/**/*.parquet')""").fetchall()
        assert sorted(got) == sorted(want) and len(got) > 0


def test_large_files_are_read_in_order(spark, tmp_path, monkeypatch):
    """Files that are no single value: many splits, with and without a last line break, a byte order mark, odd names."""
    import hashlib
    import random

    from ebbtide.sources import tables

    monkeypatch.setattr(tables, "WHOLE_BYTES", 1000)
    monkeypatch.setattr(tables, "FILES_AT_ONCE", 3)
    draw = random.Random(3)
    noise = draw.randbytes(300_000)
    files = {"a.bin": noise, "b [1]{x}*.bin": noise + b"\n", "c.bin": b"\xef\xbb\xbf" + noise, "d.bin": b"\xef\xbb\xbf" + noise + b"\n\n",
             "e.bin": b"\r\n" * 4000, "f.bin": bytes(5000), "g.bin": noise[:900], "i%20j k.bin": noise[:7000], "k.gz": noise[:3000]}
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7001")
    try:
        got = tables.file_digests(tables.scan_binary_files(spark, str(tmp_path), "*", content=True)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = sorted((len(d), len(d), hashlib.md5(d).hexdigest()) for d in files.values())
    assert sorted((r.length, r.content_length, r.content_md5) for r in got) == want
