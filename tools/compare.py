"""Run registered queries next to their SQL in an embedded engine and compare rows.

    python tools/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime
import math
import sys
import time
import traceback
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from placeweave.queries import QUERIES, SQL  # noqa: E402
from placeweave.session import local_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return repr(value) if not value.is_integer() else int(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, connection, name, sf_dir):
    start = time.time()
    df = QUERIES[name](spark, sf_dir)
    spark_rows = [tuple(r) for r in df.collect()]
    seconds = time.time() - start
    columns, ours = rows_of(df.columns, spark_rows)
    if name not in SQL:
        return f"rows-only {len(spark_rows)}", seconds, df
    relation = connection.execute(SQL[name])
    names = [d[0] for d in relation.description]
    types = {d[0]: str(d[1]) for d in relation.description}
    expected_columns, theirs = rows_of(names, relation.fetchall())
    if columns != expected_columns:
        return f"COLUMNS {columns} != {expected_columns}", seconds, df
    if ours != theirs:
        return (f"ROWS {sum(ours.values())} vs {sum(theirs.values())}; "
                f"only ours {list((ours - theirs).items())[:3]}; only SQL {list((theirs - ours).items())[:3]}"), seconds, df
    ours_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    names_of = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
    odd = [(c, t, types[c]) for c, t in ours_types.items() if names_of.get(t, t) != types[c]]
    return f"ok {sum(ours.values())}" + (f" types {odd}" if odd else ""), seconds, df


def main():
    arguments = sys.argv[1:]
    sf_dir = arguments[0] if arguments else "/root/testdata/sf0.01"
    chosen = arguments[1:] or list(QUERIES)
    spark = local_session(8, **{"spark.driver.memory": "8g"})
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    bad = []
    for name in chosen:
        try:
            verdict, seconds, _ = compare(spark, connection, name, sf_dir)
        except Exception as error:  # report and go on
            verdict, seconds = f"ERROR {type(error).__name__} {str(error)[:600]}", 0.0
            if len(chosen) == 1:
                traceback.print_exc()
        print(f"{name:28s} {seconds:6.2f}s {verdict}", flush=True)
        if not verdict.startswith(("ok", "rows-only")):
            bad.append(name)
    print(f"{len(chosen) - len(bad)} of {len(chosen)} agree; differing: {bad}")


if __name__ == "__main__":
    main()
