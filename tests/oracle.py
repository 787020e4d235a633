"""Runs the SQL of registered queries in DuckDB over the same tables."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows_of(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    found = con.execute(sql)
    columns = [d[0] for d in found.description]
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(columns), sorted(tuple(map(str, (r[k] for k in order))) for r in found.fetchall())


def rows_of_frame(df) -> tuple[list[str], list[tuple]]:
    columns = sorted(df.columns)
    return columns, sorted(tuple(str(r[c]) for c in columns) for r in df.collect())
