"""Rows of a query and of its SQL on DuckDB, made comparable."""

from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return None if v != v else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def spark_rows(df):
    names = sorted(df.columns)
    return names, Counter(tuple(plain(r[n]) for n in names) for r in df.collect())


def sql_rows(sql, sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    names = sorted(con.sql(sql).columns)
    listed = ", ".join(f'"{n}"' for n in names)
    return names, Counter(tuple(plain(v) for v in r) for r in con.sql(f"SELECT {listed} FROM ({sql.strip()})").fetchall())
