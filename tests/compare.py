"""Run registered queries beside their SQL counterparts and compare the rows.

As a script: ``python tests/compare.py SF_DIR [query ...]``.
"""

import math
import os
import sys
import time

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def canonical(names, rows):
    """Rows as sorted tuples with columns in name order; NaN and NULL comparable."""
    order = sorted(range(len(names)), key=lambda i: names[i])

    def cell(v):
        if isinstance(v, float) and math.isnan(v):
            return "nan"
        return (type(v).__name__, v)

    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name, query, sql, sf_dir):
    df = query(spark, sf_dir)
    spark_rows = canonical(df.columns, [tuple(r) for r in df.collect()])
    result = con.sql(sql)
    sql_rows = canonical(result.columns, result.fetchall())
    assert sorted(df.columns) == sorted(result.columns), (name, df.columns, result.columns)
    assert len(spark_rows) == len(sql_rows), (name, len(spark_rows), len(sql_rows))
    for ours, theirs in zip(spark_rows, sql_rows):
        assert ours == theirs, (name, ours, theirs)
    return len(spark_rows)


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from marquee.session import local_session

    session = local_session("compare")
    session.sparkContext.setLogLevel("ERROR")
    folder, wanted = sys.argv[1], sys.argv[2:]
    connection = duck(folder)
    oracles = entry.oracle_sql()
    for key, run in entry.queries().items():
        if wanted and key not in wanted:
            continue
        began = time.time()
        try:
            if key in oracles:
                n = compare(session, connection, key, run, oracles[key], folder)
                verdict = "match"
            else:
                n, verdict = run(session, folder).count(), "no oracle"
            print(f"RESULT {key:24s} {n:8d} rows {time.time() - began:7.2f}s {verdict}", flush=True)
        except Exception as error:
            print(f"RESULT {key:24s} FAIL {str(error)[:900]}", flush=True)
