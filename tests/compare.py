"""Side-by-side comparison of registered queries and their DuckDB twins.

Run as ``python -m tests.compare [sf_dir] [query ...]``.
"""

from __future__ import annotations

import sys
import tempfile
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

TESTDATA = Path("/root/testdata")


def session(cores: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="pubwatch-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    return con


def _rows(table) -> tuple[list[str], list[str], Counter]:
    names = sorted(table.column_names)
    table = table.select(names)
    kinds = [str(t).replace("large_string", "string").replace("[ns]", "[us]") for t in table.schema.types]
    return names, kinds, Counter(zip(*[c.to_pylist() for c in table.columns], strict=True))


def differences(spark_df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs in columns, types, row count and values, order of rows aside."""
    names, kinds, rows = _rows(spark_df.toArrow())
    want_names, want_kinds, want_rows = _rows(con.sql(sql).to_arrow_table())
    if names != want_names:
        return [f"columns {names} != {want_names}"]
    found = []
    if kinds != want_kinds:
        found += [f"{n}: {a} != {b}" for n, a, b in zip(names, kinds, want_kinds, strict=True) if a != b]
    if rows != want_rows:
        extra, lost = rows - want_rows, want_rows - rows
        found.append(
            f"rows {rows.total()} != {want_rows.total()}; only Spark {extra.total()}, "
            f"e.g. {next(iter(extra), None)}; only DuckDB {lost.total()}, e.g. {next(iter(lost), None)}"
        )
    return found


def main(args: list[str]) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as entry

    sf_dir = args[0] if args else str(TESTDATA / "sf0.01")
    spark, con, oracles = session(), connect(sf_dir), entry.oracle_sql()
    wrong = 0
    for name, fn in entry.queries().items():
        if args[1:] and name not in args[1:]:
            continue
        start = time.monotonic()
        try:
            found = differences(fn(spark, sf_dir), con, oracles[name])
        except Exception as error:  # report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:1500]}"]
        wrong += bool(found)
        print(f"{'BAD' if found else 'ok '} {name} {time.monotonic() - start:.2f}s", *found, sep="\n    ")
    print(f"{wrong} wrong")
    return wrong


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
