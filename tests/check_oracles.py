"""Run every query against its SQL: python tests/check_oracles.py FOLDER [NAME ...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parent), str(Path(__file__).resolve().parents[1])]

from compare import difference, oracle_connection  # noqa: E402

import __spark_entry__ as driver  # noqa: E402
from millrace.session import local_session  # noqa: E402


def main(folder: str, names: list[str]) -> int:
    spark = local_session("check", "8")
    spark.sparkContext.setLogLevel("ERROR")
    connection, sql = oracle_connection(folder), driver.oracle_sql()
    failed = 0
    for name, build in driver.queries().items():
        if names and name not in names:
            continue
        start = built = time.time()
        try:
            result = build(spark, folder)
            built = time.time()
            result.write.format("noop").mode("overwrite").save()
            ran = time.time()
            verdict = difference(result, connection, sql[name])
        except Exception as error:  # noqa: BLE001
            verdict, ran = f"{type(error).__name__}: {str(error)[:600]}", time.time()
        failed += verdict is not None
        print(f"build {built - start:6.2f}s  run {ran - built:6.2f}s  {name:32s} {verdict or 'equal'}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
