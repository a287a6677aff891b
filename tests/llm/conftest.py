import duckdb
import pytest

SF = "/root/testdata/sf0.001"


class Tables:
    """Runs a query on the smallest tables against its SQL."""

    def __init__(self, spark):
        self.spark = spark
        self.con = duckdb.connect()
        for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
            self.con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")

    def query(self, name):
        import __spark_entry__ as E
        return E.queries()[name](self.spark, SF)

    def check(self, name, sql):
        got = self.query(name)
        cols = sorted(got.columns)
        rows = self.con.execute(f"SELECT {', '.join(cols)} FROM ({sql})").fetchall()
        assert rows and sorted(map(repr, (tuple(r[c] for c in cols) for r in got.collect()))) == sorted(map(repr, rows))


@pytest.fixture(scope="session")
def sf_tables(spark):
    return Tables(spark)
