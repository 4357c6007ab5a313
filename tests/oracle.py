"""Compares a query's rows with those of DuckDB SQL over the same tables."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
DATA = "/root/testdata/sf0.001"


def connection(folder=DATA):
    out = duckdb.connect()
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        out.execute(f"create view {name} as select * from '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return out


def plain(value):
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, list | tuple):
        return tuple(map(plain, value))
    return value


def same(df, sql, folder=DATA):
    rows, cursor = df.collect(), connection(folder).execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    order = sorted(names)
    ours = sorted(repr([plain(r[c]) for c in order]) for r in rows)
    theirs = sorted(repr([plain(r[names.index(c)]) for c in order]) for r in cursor.fetchall())
    assert ours == theirs
    return len(ours)
