"""Compare a Spark query with its DuckDB statement (names, types, rows, values).

Used by the test-suite and by ``check_oracle.py``; mirrors the correctness
gate: columns sorted by name, row count, and an order-insensitive hash of
the values.
"""

from __future__ import annotations

import hashlib
import os

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

_SPARK_TO_SQL = {
    "tinyint": "TINYINT", "smallint": "SMALLINT", "int": "INTEGER", "bigint": "BIGINT",
    "float": "FLOAT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP WITH TIME ZONE", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def spark_type(dt) -> str:
    s = dt.simpleString()
    if s.startswith("array<"):
        return spark_type(dt.elementType) + "[]"
    if s.startswith("decimal"):
        return s.upper()
    return _SPARK_TO_SQL.get(s, s.upper())


def duck_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    """Exact text of a value (floats by ``repr``: no tolerance, like a value
    hash)."""
    if v is None:
        return "∅"
    if isinstance(v, float):
        return "nan" if v != v else repr(v)
    return str(v)


def table_digest(columns, rows) -> tuple[list, int, str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return [columns[i] for i in order], len(lines), h


def compare(spark, name: str, fn, sql: str, sf_dir: str, con=None) -> dict:
    con = con or duck_connection(sf_dir)
    sdf = fn(spark, sf_dir)
    s_types = {f.name: spark_type(f.dataType) for f in sdf.schema.fields}
    s_rows = [tuple(r) for r in sdf.collect()]
    rel = con.sql(sql)
    d_cols = rel.columns
    d_types = {c: str(t) for c, t in zip(d_cols, rel.types)}
    d_rows = rel.fetchall()
    s_cols, s_n, s_h = table_digest(list(sdf.columns), s_rows)
    d_cols_sorted, d_n, d_h = table_digest(list(d_cols), d_rows)
    out = {
        "query": name,
        "names": s_cols == d_cols_sorted,
        "types": s_types == d_types,
        "rows": s_n == d_n,
        "values": s_h == d_h,
        "spark_rows": s_n,
        "oracle_rows": d_n,
    }
    if not out["types"]:
        out["type_diff"] = {k: (s_types.get(k), d_types.get(k))
                            for k in set(s_types) | set(d_types) if s_types.get(k) != d_types.get(k)}
    if not out["values"]:
        sl = set(table_digest_lines(sdf.columns, s_rows))
        dl = set(table_digest_lines(d_cols, d_rows))
        out["only_spark"] = sorted(sl - dl)[:3]
        out["only_oracle"] = sorted(dl - sl)[:3]
    out["ok"] = all(out[k] for k in ("names", "types", "rows", "values"))
    return out


def table_digest_lines(columns, rows):
    columns = list(columns)
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return ["|".join(_norm(r[i]) for i in order) for r in rows]
