"""Run the registered queries beside their SQL in DuckDB and report differences.

usage: python tools/check.py [--sf DIR] [--only PREFIX[,PREFIX]] [--times]
"""

from __future__ import annotations

import argparse
import decimal
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from weekmart.catalog import load  # noqa: E402
from weekmart.session import local_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, list):
        return tuple(plain(v) for v in value)
    if isinstance(value, float) and value == 0:
        return 0.0
    return value


def ordered(rows, columns, names):
    index = [names.index(c) for c in columns]
    return sorted((tuple(plain(r[i]) for i in index) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


KIND = {"int": "integer", "bigint": "integer", "integer": "integer", "hugeint": "integer", "smallint": "integer",
        "double": "double", "string": "text", "varchar": "text", "date": "date", "boolean": "boolean",
        "timestamp": "timestamp"}


def kind(name: str) -> str:
    name = name.lower()
    return "decimal" if name.startswith("decimal") else KIND.get(name, name)


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("--only", default="")
    parser.add_argument("--traceback", action="store_true")
    args = parser.parse_args()
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{args.sf}/{t}.parquet'")
    wanted = [p for p in args.only.split(",") if p]
    bad = 0
    for name, q in load().items():
        if wanted and not any(name == p or name.startswith(p.rstrip("*")) for p in wanted):
            continue
        start = time.time()
        try:
            df = q.run(spark, args.sf)
            got = [tuple(r) for r in df.collect()]
            took = time.time() - start
            if q.sql is None:
                print(f"ROWS  {name}: {len(got)} rows {took:.1f}s")
                continue
            rel = con.execute(q.sql)
            names = [x[0] for x in rel.description]
            types = {x[0]: kind(str(x[1])) for x in rel.description}
            want = rel.fetchall()
        except Exception as error:  # noqa: BLE001
            bad += 1
            print(f"ERROR {name}: {type(error).__name__} {str(error)[:600]}")
            if args.traceback:
                raise
            continue
        notes = []
        if sorted(df.columns) != sorted(names):
            notes.append(f"columns {sorted(set(df.columns) ^ set(names))}")
        else:
            columns = sorted(names)
            ours = {f.name: kind(f.dataType.simpleString()) for f in df.schema}
            notes += [f"type {c}: {ours[c]} / {types[c]}" for c in columns if ours[c] != types[c]]
            a, b = ordered(got, columns, df.columns), ordered(want, columns, names)
            if len(a) != len(b):
                notes.append(f"rows {len(a)} / {len(b)}")
            if a != b:
                seen = set(b)
                first = next((r for r in a if r not in seen), None)
                seen = set(a)
                other = next((r for r in b if r not in seen), None)
                notes.append(f"values: ours {first} theirs {other} ({columns})")
        bad += bool(notes)
        print(f"{'DIFF ' if notes else 'OK   '} {name}: {len(got)} rows {took:.1f}s {' | '.join(notes)[:700]}")
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main())
