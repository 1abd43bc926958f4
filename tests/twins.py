"""Run a registered query and its SQL twin and compare them row by row.

    python tests/twins.py [sf dir] [query ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from __spark_entry__ import oracle_sql, queries  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def normal(rows: list[tuple], names: list[str]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])

    def cell(value):
        if value is None or (isinstance(value, float) and value != value):
            return ""
        if isinstance(value, pd.Timestamp):
            value = value.to_pydatetime()
        return repr(value)

    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


def family(type_name: str) -> str:
    text = type_name.upper()
    for key, names in {
        "int": ("TINYINT", "SMALLINT", "INT", "BIGINT", "HUGEINT", "LONG"),
        "float": ("DOUBLE", "FLOAT"),
        "text": ("VARCHAR", "STRING"),
        "time": ("TIMESTAMP",),
        "date": ("DATE",),
        "bool": ("BOOL",),
        "decimal": ("DECIMAL",),
    }.items():
        if any(text.startswith(n) for n in names):
            return key
    return text


def compare(spark, con, name: str, sf_dir: str) -> list[str]:
    df = queries()[name](spark, sf_dir)
    got = [tuple(row) for row in df.collect()]
    cursor = con.execute(oracle_sql()[name])
    want_names = [d[0] for d in cursor.description]
    want_types = dict(zip(want_names, [str(d[1]) for d in cursor.description]))
    want = cursor.fetchall()
    problems = []
    if sorted(df.columns) != sorted(want_names):
        return [f"columns {sorted(df.columns)} vs {sorted(want_names)}"]
    for column, kind in df.dtypes:
        if family(kind) != family(want_types[column]):
            problems.append(f"type of {column}: {kind} vs {want_types[column]}")
    if len(got) != len(want):
        problems.append(f"rows {len(got)} vs {len(want)}")
    a, b = normal(got, df.columns), normal(want, want_names)
    if a != b:
        only_a = sorted(set(a) - set(b))[:3]
        only_b = sorted(set(b) - set(a))[:3]
        problems.append(f"values ({sorted(df.columns)})\n   spark {only_a}\n   sql   {only_b}")
    if not got:
        problems.append("no rows")
    return problems


def main(argv: list[str]) -> int:
    from orderloom.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(queries())
    spark = local_session()
    con = connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            if name in oracle_sql():
                problems = compare(spark, con, name, sf_dir)
                kind = "twin"
            else:
                rows = queries()[name](spark, sf_dir).count()
                problems, kind = ([] if rows else ["no rows"]), f"rows {rows}"
        except Exception as error:  # report and go on with the next query
            problems, kind = [f"{type(error).__name__}: {str(error)[:1500]}"], "error"
        bad += bool(problems)
        print(f"{'BAD' if problems else 'ok '} {name} {kind} {time.time() - start:.1f}s", flush=True)
        for problem in problems:
            print("   ", problem, flush=True)
    print(f"{len(names) - bad} of {len(names)} good")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
