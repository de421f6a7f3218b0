"""Compare a query with its oracle."""

import os

DATA = "/root/testdata"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf: str):
    import duckdb

    c = duckdb.connect()
    for t in TABLES:
        if os.path.exists(p := f"{DATA}/{sf}/{t}.parquet"):
            c.execute(f"create view {t} as from '{p}'")
    return c


def rows(names, found):
    """Rows as sorted tuples in the order of names."""
    key = lambda r: tuple((x is not None, str(type(x)), x) if not isinstance(x, (int, float)) else (True, "n", x) for x in r)
    return sorted((tuple(r) for r in found), key=key)


def same(spark_frame, connection, sql: str) -> None:
    relation = connection.sql(sql)
    names = sorted(relation.columns)
    assert names == sorted(spark_frame.columns)
    expected = rows(names, relation.select(*[f'"{n}"' for n in names]).fetchall())
    found = rows(names, spark_frame.select(*names).collect())
    assert len(found) == len(expected)
    assert found == expected
