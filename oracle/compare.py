"""Run checks on both engines and report differences.

    python -m oracle.compare [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import time

import duckdb
import numpy as np
import pandas as pd

from oracle import all_checks
from oracle.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def spelled(value) -> str:
    """The plain spelling of a value; everything that pandas takes for missing is spelled alike."""
    missing = pd.isna(value)
    return "missing" if isinstance(missing, bool) and missing else str(value)


def differences(names: list[str], spark_rows, duck_names: list[str], duck_rows) -> str:
    """Compare rows in any order, columns by name, values by their plain spelling."""
    if sorted(names) != sorted(duck_names):
        return f"columns {sorted(names)} vs {sorted(duck_names)}"
    order, duck_order = np.argsort(names), np.argsort(duck_names)
    a = sorted(tuple(spelled(row[i]) for i in order) for row in spark_rows)
    b = sorted(tuple(spelled(row[i]) for i in duck_order) for row in duck_rows)
    if a == b:
        return ""
    only_a, only_b = sorted(set(a) - set(b))[:2], sorted(set(b) - set(a))[:2]
    return f"rows {len(a)} vs {len(b)}; only Spark {only_a}; only DuckDB {only_b}"


def needs_plain(frame: pd.DataFrame, types: dict[str, str]) -> str:
    texts = [c for c, t in types.items() if t == "date"]
    doubles = [c for c, t in types.items() if t.startswith("decimal")]
    doubles += [c for c, t in types.items() if t in ("int", "bigint", "smallint") and frame[c].isna().any()]
    lists = [c for c, t in types.items() if t.startswith("array")]
    found = {"TEXTS": texts, "DOUBLES": doubles, "LISTS": lists}
    return " ".join(f"{k}={' '.join(v)!r}" for k, v in found.items() if v)


def types_of(spark_types: dict[str, str], duck_frame: duckdb.DuckDBPyRelation) -> str:
    alike = {
        "int": "INTEGER", "bigint": "BIGINT", "smallint": "SMALLINT", "double": "DOUBLE",
        "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN",
        "array<double>": "DOUBLE[]", "array<string>": "VARCHAR[]",
    }
    found = dict(zip(duck_frame.columns, [str(x) for x in duck_frame.types]))
    odd = {
        c: (s, found.get(c))
        for c, s in spark_types.items()
        if alike.get(s, s.upper()).replace(" ", "") != str(found.get(c)).replace(" ", "")
    }
    return f"types {odd}" if odd else ""


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    queries, oracles = all_checks()
    spark = local_session()
    con = connect(args.sf)
    bad = 0
    for name in args.names or queries:
        began = time.time()
        try:
            frame = queries[name](spark, args.sf)
            got = frame.toPandas()
            took = time.time() - began
            if name not in oracles:
                print(f"{name:32} {took:6.2f}s rows only: {len(got)}", flush=True)
                bad += got.empty
                continue
            began = time.time()
            relation = con.sql(oracles[name])
            expected = relation.df()
            names, types = list(got.columns), dict(frame.dtypes)
            problem = differences(
                names, got.itertuples(index=False), list(expected.columns), expected.itertuples(index=False)
            )
            notes = f"{types_of(types, relation)} {needs_plain(got, types)}"
            verdict = "ok" if not problem else f"DIFFERS {problem}"
            print(f"{name:32} {took:6.2f}s {time.time() - began:5.2f}s {len(got):7} {verdict} {notes}", flush=True)
            bad += bool(problem)
        except Exception as error:  # noqa: BLE001 - report every check
            bad += 1
            print(f"{name:32} ERROR {type(error).__name__}: {str(error)[:600]}", flush=True)
    print(f"{bad} bad of {len(args.names or queries)}")


if __name__ == "__main__":
    main()
