"""Runs a registered query and its SQL oracle on the same tables.

``python tests/oracle.py SF_DIR [query ...]`` prints one line per query.
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def connect(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)]
    for c in df.columns:
        if df[c].dtype == object:
            df = df.assign(**{c: df[c].map(lambda v: str(list(v)) if hasattr(v, "__len__")
                                           and not isinstance(v, str) else v)})
    return df.sort_values(list(df.columns), ignore_index=True)


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    got, want = canonical(got), canonical(want)
    for c in got.columns:
        if got[c].dtype.kind != want[c].dtype.kind:
            return f"type of {c}: {got[c].dtype} != {want[c].dtype}"
        same = (got[c] == want[c]) | (got[c].isna() & want[c].isna())
        if not same.all():
            k = (~same).idxmax()
            return f"{(~same).sum()} values of {c}, e.g. {got.loc[k].to_dict()} != {want.loc[k].to_dict()}"
    return None


def check(spark, con, name: str, fn, sql: str | None, sf: str) -> str:
    start = time.time()
    got = fn(spark, sf).toPandas()
    took = time.time() - start
    if sql is None:
        return f"rows {len(got)} {took:.1f}s"
    start = time.time()
    want = con.execute(sql).df()
    other = time.time() - start
    bad = difference(got, want)
    return f"{'ok' if bad is None else 'FAIL ' + bad} ({len(got)} rows, {took:.1f}s, sql {other:.1f}s)"


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from pyspark.sql import SparkSession

    from quillrank.plans.catalog import ORACLES, QUERIES

    sf, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.driver.memory", "16g").config("spark.ui.enabled", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    for name in names:
        try:
            print(name, check(spark, con, name, QUERIES[name], ORACLES.get(name), sf), flush=True)
        except Exception as e:  # noqa: BLE001
            print(name, "ERROR", str(e)[:1500], flush=True)
