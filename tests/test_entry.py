"""Driver contract: entry, queries and oracles (small scale)."""
import math

import duckdb

import __spark_entry__ as E
from panelspark.plans.views import TABLES

SF = "/root/testdata/sf0.001"
NO_ORACLE: set[str] = set()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["holder", "end_date", "n_symbols", "holdings"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    q, o = E.queries(), E.oracle_sql()
    own = {k for k in q if k != "pipeline" and not (k.startswith("op") and k[2:3].isdigit())}
    assert own - set(o) == NO_ORACLE
    assert set(o) <= set(q)


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{round(v, 6):.6f}"
    return str(v)[:10] if type(v).__name__ == "date" else ("∅" if v is None else str(v))


def test_sample_of_queries_match_oracle_small(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    q, o = E.queries(), E.oracle_sql()
    for name in ["hld_flagship_baskets", "lay03_stock_files_wide", "pan08_reindex_dense", "tok06_vocabulary",
                 "mlm08_training_rows", "sta03_running", "emb03_matrix", "aln05_side_by_side"]:
        df = q[name](spark, SF)
        cols = sorted(df.columns)
        a = sorted(tuple(norm(r[c]) for c in cols) for r in df.collect())
        cur = con.execute(o[name])
        oc = [d[0] for d in cur.description]
        assert sorted(oc) == cols, name
        idx = [oc.index(c) for c in cols]
        b = sorted(tuple(norm(r[i]) for i in idx) for r in cur.fetchall())
        assert a == b, name
