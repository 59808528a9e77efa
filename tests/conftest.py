import pytest
from pyspark.sql import SparkSession

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    conf = {"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g"}
    session = SparkSession.builder.master("local[*]").config(map=conf).getOrCreate()
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def plain(rows) -> list[str]:
    """Rows as sorted text, numbers rounded, so that two engines' results compare."""
    one = lambda v: "~" if v is None or v != v else repr(round(float(v), 5) + 0.0) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    return sorted("|".join(map(one, r)) for r in rows)


def against_sql(spark, query, sql: str, folder: str = SMALL) -> tuple[list[str], list[str]]:
    import glob
    import os

    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{files}'")
    got, want = query(spark, folder), con.execute(f"SELECT * FROM ({sql}) t")
    names = sorted(got.columns)
    there = [c[0] for c in want.description]
    assert names == sorted(there)
    at = [there.index(n) for n in names]
    return plain(got.select(*names).collect()), plain([[r[i] for i in at] for r in want.fetchall()])
