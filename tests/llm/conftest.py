import glob
import os

import duckdb
import pytest


def plain(v):
    return f"{v:.6g}" if isinstance(v, float) else str(v)


@pytest.fixture
def against_oracle(spark):
    """Compares a registered query with its SQL over a folder of tables."""

    def compare(name, folder):
        from judgeset.llm.registry import ORACLES, QUERIES

        con = duckdb.connect()
        for path in glob.glob(f"{folder}/*.parquet"):
            con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
        want, df = con.sql(ORACLES[name]), QUERIES[name](spark, folder)
        cols = sorted(df.columns)
        assert cols == sorted(want.columns)
        at = [want.columns.index(c) for c in cols]
        got = sorted("|".join(plain(r[c]) for c in cols) for r in df.collect())
        assert got == sorted("|".join(plain(r[i]) for i in at) for r in want.fetchall())

    return compare
