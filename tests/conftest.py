import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = os.pathsep.join([sys.path[0], os.environ.get("PYTHONPATH", "")])

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "4g").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return con


@pytest.fixture(scope="session")
def same(spark, duck):
    """Holds a query's rows against its SQL as multisets."""
    from collections import Counter

    def norm(v):
        if isinstance(v, float):
            return float(f"{v:.9g}")
        return tuple(map(norm, v)) if isinstance(v, (list, tuple)) else v

    def check(query, sql):
        df = query(spark, SF)
        cols = sorted(df.columns)
        rows = df.collect()  # as it comes: a select of columns beneath can hide what pruning does
        order = [df.columns.index(c) for c in cols]
        got = Counter(tuple(norm(r[i]) for i in order) for r in rows)
        res = duck.execute(sql)
        names = [d[0] for d in res.description]
        assert sorted(names) == cols
        at = [names.index(c) for c in cols]
        want = Counter(tuple(norm(r[i]) for i in at) for r in res.fetchall())
        assert got == want, (list((got - want).elements())[:3], list((want - got).elements())[:3])

    return check
