"""Run registered queries and their SQL side by side: ``python tests/compare.py sf_dir [name …]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(df: pd.DataFrame) -> list[tuple]:
    def cell(v):
        if v is None or v is pd.NA or (isinstance(v, float) and pd.isna(v)):
            return None
        if hasattr(v, "item"):
            v = v.item()
        return v
    df = df[sorted(df.columns)]
    return sorted((tuple(cell(v) for v in row) for row in df.itertuples(index=False)), key=repr)


def differences(spark_df, sql_df: pd.DataFrame) -> list[str]:
    """What differs between a Spark result and a SQL result; empty if nothing."""
    mine = spark_df.toPandas()
    # Whole numbers with nulls stay whole numbers.
    whole = {f.name for f in spark_df.schema if f.dataType.typeName() in ("byte", "short", "integer", "long")}
    mine = mine.astype({k: "Int64" for k in whole if mine[k].dtype.kind in "fO"})
    out = []
    if sorted(mine.columns) != sorted(sql_df.columns):
        return [f"columns {sorted(mine.columns)} vs {sorted(sql_df.columns)}"]
    sql_df = sql_df.astype({k: "Int64" for k in sql_df if sql_df[k].dtype.kind == "O" and k in whole})
    kinds = {k: (mine[k].dtype.kind, sql_df[k].dtype.kind) for k in mine.columns}
    out += [f"type of {k}: {a} vs {b}" for k, (a, b) in kinds.items() if a != b and len(mine)]
    if len(mine) != len(sql_df):
        out.append(f"rows {len(mine)} vs {len(sql_df)}")
    a, b = canonical(mine), canonical(sql_df)
    if a != b:
        only_a = [r for r in a if r not in set(b)][:2]
        only_b = [r for r in b if r not in set(a)][:2]
        out.append(f"values\n   spark {only_a}\n   sql   {only_b}")
    return out


def main(sf_dir: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from causeway.session import build_session
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g",
                                                   "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(sf_dir), 0
    queries, oracles = entry.queries(), entry.oracle_sql()
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracles:
                found = differences(df, con.execute(oracles[name]).df())
                kind = "ok" if not found else "DIFFERENT"
            else:
                found, kind = [f"{df.count()} rows"], "rows"
        except Exception as err:  # noqa: BLE001 - reported
            found, kind = [str(err)[:600]], "FAILED"
        bad += kind in ("DIFFERENT", "FAILED")
        print(f"{kind:10s} {name:28s} {time.time() - start:6.1f}s {'; '.join(found)}", flush=True)
        spark.catalog.clearCache()
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
