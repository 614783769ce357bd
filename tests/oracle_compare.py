"""Run a registered Spark query and its DuckDB oracle; compare names, types and rows.

Usable from pytest and from the command line:

    python tests/oracle_compare.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Spark simpleString prefix -> DuckDB type name prefix.
_TYPE_MAP = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
    "double": "DOUBLE",
}


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if glob.glob(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm_value(v):
    if isinstance(v, decimal.Decimal):
        return ("dec", str(v.normalize()))
    if isinstance(v, float):
        return ("num", round(v, 6))
    if isinstance(v, bool):
        return ("bool", v)
    if isinstance(v, int):
        return ("num", v)
    if isinstance(v, dt.datetime):
        return ("ts", v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return ("date", v.isoformat())
    return ("s", v)


def _rows_key(rows):
    return sorted(tuple(repr(_norm_value(v)) for v in r) for r in rows)


def spark_types(df) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in df.schema.fields}


def types_agree(spark_type: str, duck_type: str) -> bool:
    if spark_type.startswith("decimal"):
        return duck_type.replace(" ", "").upper() == spark_type.replace(" ", "").upper()
    want = _TYPE_MAP.get(spark_type)
    return want is not None and duck_type.upper().startswith(want)


def compare(spark, con, name: str, sf_dir: str) -> dict:
    from cartwheel.plans.oracles import ORACLES
    from cartwheel.plans.registry import QUERIES

    t0 = time.time()
    df = QUERIES[name](spark, sf_dir)
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    rel = con.execute(ORACLES[name])
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    d_types = {c: str(t) for c, t in zip(d_cols, [d[1] for d in rel.description])}
    s_types = spark_types(df)
    out = {
        "query": name,
        "spark_sec": round(t1 - t0, 3),
        "rows_spark": len(s_rows),
        "rows_oracle": len(d_rows),
        "names_match": sorted(df.columns) == sorted(d_cols),
    }
    type_issues = {
        c: (s_types[c], d_types.get(c))
        for c in df.columns
        if c in d_types and not types_agree(s_types[c], d_types[c])
    }
    out["type_issues"] = type_issues
    if out["names_match"]:
        order = sorted(df.columns)
        si = [df.columns.index(c) for c in order]
        di = [d_cols.index(c) for c in order]
        out["values_match"] = _rows_key([[r[i] for i in si] for r in s_rows]) == _rows_key(
            [[r[i] for i in di] for r in d_rows]
        )
    else:
        out["values_match"] = False
        out["columns"] = (df.columns, d_cols)
    out["ok"] = out["names_match"] and out["values_match"] and out["rows_spark"] == out["rows_oracle"]
    return out


def main(argv):
    from cartwheel.plans.registry import QUERIES
    from cartwheel.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(QUERIES)
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb_connection(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, con, n, sf_dir)
        except Exception as exc:  # report and go on
            r = {"query": n, "ok": False, "error": f"{type(exc).__name__}: {str(exc)[:300]}"}
        bad += not r["ok"]
        print(r, flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
