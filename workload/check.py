"""Compare every query with its SQL text: ``python -m workload.check [folder] [name ...]``."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
import traceback

import duckdb

from paperloom.session import build_session, discard_all
from workload.catalog import QUERIES
from workload.views import TABLES

FAMILY = {
    "string": "text", "bigint": "int64", "int": "int32", "double": "real", "boolean": "flag", "VARCHAR": "text",
    "BIGINT": "int64", "INTEGER": "int32", "DOUBLE": "real", "BOOLEAN": "flag", "timestamp": "time", "timestamp_ntz": "time",
    "TIMESTAMP": "time", "date": "date", "DATE": "date",
}


def shown(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, (datetime.datetime, datetime.date, decimal.Decimal)):
        return str(value)
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(shown(r[i]) for i in order) for r in rows)


def compare(spark, engine, query, folder) -> str:
    start = time.time()
    df = query.run(spark, folder)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - start
    kinds = {f.name: FAMILY.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    if query.sql is None:
        return f"rows {len(got)}  {took:.1f}s"
    wanted = engine.sql(query.sql)
    check = {n: FAMILY.get(str(t), str(t)) for n, t in zip(wanted.columns, wanted.types)}
    if check != kinds:
        return f"SCHEMA {dict(set(kinds.items()) - set(check.items()))} / {dict(set(check.items()) - set(kinds.items()))}"
    left, right = rows_of(df.columns, got), rows_of(wanted.columns, wanted.fetchall())
    if left != right:
        only_left = [r for r in left if r not in set(right)][:2]
        only_right = [r for r in right if r not in set(left)][:2]
        return f"VALUES {len(left)}/{len(right)} {sorted(df.columns)}\n   got    {only_left}\n   wanted {only_right}"
    return f"ok {len(left)}  {took:.1f}s"


def main(folder: str, names: list[str]) -> int:
    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    engine = duckdb.connect()
    for t in TABLES:
        engine.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    bad = 0
    for query in QUERIES:
        if names and not any(query.name.startswith(n) for n in names):
            continue
        try:
            result = compare(spark, engine, query, folder)
        except Exception as error:  # noqa: BLE001
            result = "ERROR " + "".join(traceback.format_exception_only(error))[:1500]
            if names:
                traceback.print_exc()
        bad += not result.startswith(("ok", "rows"))
        discard_all(spark)
        print(f"{query.name:34s} {result}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:]))
