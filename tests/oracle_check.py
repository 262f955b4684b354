"""Compare registered queries with their SQL oracles at a scale factor.

    python tests/oracle_check.py /root/testdata/sf0.01 [name ...] [spark.some.setting=value ...]
"""

from __future__ import annotations

import pathlib
import sys
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402
import pyarrow as pa  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from tillroll import session  # noqa: E402


CONF = {"spark.sql.shuffle.partitions": "8", "spark.ui.showConsoleProgress": "false"}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in pathlib.Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(table: pa.Table) -> list[tuple]:
    """Rows with columns sorted by name, order-insensitive, doubles at full precision."""
    names = sorted(table.column_names)
    columns = [table.column(name).to_pylist() for name in names]
    return sorted(zip(*columns), key=repr)


KINDS = {"int": "int32", "bigint": "int64", "double": "float64", "string": "string", "date": "date"}
DUCK = {"INTEGER": "int32", "BIGINT": "int64", "DOUBLE": "float64", "VARCHAR": "string", "DATE": "date", "BOOLEAN": "boolean"}


def compare(spark, con, name: str, folder: str) -> str:
    """Empty when the query and its oracle agree on schema and rows."""
    df = entry.queries()[name](spark, folder)
    relation = con.sql(entry.oracle_sql()[name])
    kinds = {c: KINDS.get(t.split("(")[0].replace("varchar", "string"), t) for c, t in df.dtypes}
    expected = {c: DUCK.get(str(t), str(t)) for c, t in zip(relation.columns, relation.types)}
    if kinds != expected:
        return f"schema {kinds} != {expected}"
    got, want = canonical(df.toArrow()), canonical(relation.to_arrow_table())
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else ""


def main() -> int:
    folder, *rest = sys.argv[1:]
    names = [word for word in rest if "=" not in word]
    conf = dict(word.split("=", 1) for word in rest if "=" in word)
    spark = session.build_session("oracle-check", "local[8]", {**CONF, **conf})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failures = 0
    for name in names or entry.queries():
        started = time.time()
        problem = compare(spark, con, name, folder)
        failures += bool(problem)
        print(f"{name:32s} {time.time() - started:6.2f}s  {problem or 'ok'}", flush=True)
    return failures


if __name__ == "__main__":
    sys.exit(main())
