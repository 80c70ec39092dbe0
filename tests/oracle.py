"""Compare a registered query with its SQL on the same files.

Run as a script: python -m tests.oracle [folder] [name ...]; NO_BROADCAST=1 shuffles every join.
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def cell(value: object) -> object:
    if value is None or (isinstance(value, float) and value != value) or value is pd.NaT or value is pd.NA:
        return None
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, float) and value.is_integer():
        return int(value)
    return value


def rows(frame: pd.DataFrame) -> Counter:
    frame = frame[sorted(frame.columns)]
    return Counter(tuple(cell(v) for v in row) for row in frame.itertuples(index=False, name=None))


def differences(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} != {sorted(sql_frame.columns)}"
    kinds = {
        c: (spark_frame[c].dtype.kind, sql_frame[c].dtype.kind)
        for c in spark_frame.columns
        # columns with nulls change their pandas type, so only full ones are compared
        if len(spark_frame) and spark_frame[c].notna().all() and spark_frame[c].dtype != sql_frame[c].dtype
    }
    ours, theirs = rows(spark_frame), rows(sql_frame)
    if ours != theirs:
        return (
            f"{sum(ours.values())} vs {sum(theirs.values())} rows; only ours {list((ours - theirs).items())[:3]}; "
            f"only SQL {list((theirs - ours).items())[:3]}"
        )
    return f"types differ: {kinds}" if kinds else None


def main() -> None:
    import __spark_entry__ as entry

    from tallyloom.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    if os.environ.get("NO_BROADCAST"):  # as on tables too large to broadcast
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    con, sql, bad = database(folder), entry.oracle_sql(), 0
    for name in names:
        started = time.time()
        try:
            frame = entry.queries()[name](spark, folder).toPandas()
            took = time.time() - started
            if name in sql:
                started = time.time()
                found = differences(frame, con.execute(sql[name]).df())
                note = "ok" if found is None else f"DIFFERENT {found}"
                note += f" (sql {time.time() - started:.1f}s)"
            else:
                note = "rows only"
        except Exception as error:  # report and go on with the next query
            took, note = time.time() - started, f"FAILED {type(error).__name__}: {str(error)[:600]}"
            frame = pd.DataFrame()
        bad += note.startswith(("DIFF", "FAIL"))
        print(f"{name:32s} {len(frame):7d} rows {took:6.2f}s {note}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
