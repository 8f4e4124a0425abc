"""Compare a Spark result with DuckDB's over the same parquet tables."""

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    return v.item() if hasattr(v, "item") else v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


SPARK_TO_DUCK = {
    "int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "float": "FLOAT",
}


def differences(df, con, sql):
    """Empty when schema, row count and every value agree."""
    rel = con.sql(sql)
    want_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    got_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    out = [] if got_types == want_types else [f"schema: spark {got_types} oracle {want_types}"]
    want = _rows(rel.columns, rel.fetchall())
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if len(want) != len(got):
        out.append(f"rows: spark {len(got)} oracle {len(want)}")
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        out.append(f"{len(bad)} rows differ; first: spark {str(bad[0][0])[:600]} oracle {str(bad[0][1])[:600]}")
    return out
