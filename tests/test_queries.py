"""Every registered query of the engine on the smallest tables, against its SQL in DuckDB."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
import tessera.plans.stand_ins  # noqa: F401  registers its queries
from tessera.plans.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        connection.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name, tmp_path):
    QUERIES[name](spark, SF).write.parquet(str(tmp_path / "out"))
    found = duck.execute(f"select * from '{tmp_path}/out/*.parquet'")
    columns = sorted(c[0] for c in found.description)
    if name not in ORACLE_SQL:
        assert found.fetchall()
        return
    listed = ", ".join(f'"{c}"' for c in columns)
    expected = duck.execute(f"select * from ({ORACLE_SQL[name]})")
    assert sorted(c[0] for c in expected.description) == columns
    left, right = (sorted(map(str, duck.execute(f"select {listed} from ({q})").fetchall())) for q in (f"select * from '{tmp_path}/out/*.parquet'", ORACLE_SQL[name]))
    assert left == right


def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() > 0 and set(entry.oracle_sql()) <= set(entry.queries())


def test_shared_folder(spark, tmp_path):
    from tessera.sources.staging import qualified, shared_folder

    conf = spark.sparkContext._jsc.hadoopConfiguration()
    try:
        # a path without a scheme lies in the default file system, whichever that is
        conf.set("fs.viewfs.mounttable.stub.link./data", f"file://{tmp_path}")
        conf.set("fs.defaultFS", "viewfs://stub/")
        assert qualified(spark, "/data/shared/") == "viewfs://stub/data/shared"
        spark.range(3).write.parquet(qualified(spark, "/data/shared/t"))
        assert (tmp_path / "shared/t/_SUCCESS").exists()
        assert qualified(spark, "file:///a/b") == "file:///a/b"
    finally:
        conf.set("fs.defaultFS", "file:///")
    assert qualified(spark, "/a/b") == "file:///a/b" and shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
