import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = os.pathsep.join([sys.path[0], os.environ.get("PYTHONPATH", "")])

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def check_against_sql(spark, queries, sql, names, folder=DATA):
    """Each query's rows equal those of its SQL."""
    import duckdb

    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for f in os.listdir(folder):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{folder}/{f}'")

    def plain(v):
        return round(v, 9) if isinstance(v, float) else v

    for name in names:
        df = queries[name](spark, folder)
        columns = sorted(df.columns)
        got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
        result = con.execute(sql[name])
        order = [x[0] for x in result.description]
        assert sorted(order) == columns, name
        want = sorted((tuple(plain(r[order.index(c)]) for c in columns) for r in result.fetchall()), key=repr)
        assert got == want, name
