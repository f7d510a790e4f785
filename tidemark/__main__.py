"""One full load of a folder of exported sheets, from the command line.

    python -m tidemark sales_test /data/exports --format csv

Each sheet is a file or folder named after it, such as ``Sales Order_data.csv``. The database name selects the
environment, and tables live under the session's ``spark.checkpoint.dir`` or ``--folder``.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
from collections.abc import Sequence
from dataclasses import asdict

from pyspark.sql import SparkSession

from tidemark.operators.changes import ANY, LATEST
from tidemark.plans.run import run
from tidemark.schemas import SHEET_ORDER
from tidemark.session import configure
from tidemark.sources.audit import ERROR, utc_now
from tidemark.sources.store import Store


def main(arguments: Sequence[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tidemark", description="Load all sheets and refresh the sales mart.")
    parser.add_argument("database")
    parser.add_argument("sheets", help="folder with one export per sheet")
    parser.add_argument("--format", default="csv")
    parser.add_argument("--folder", help="shared folder for the tables")
    parser.add_argument("--load-ts", type=dt.datetime.fromisoformat, help="stamp of this load, default now (UTC)")
    parser.add_argument("--min-changed", type=int, default=2)
    parser.add_argument("--against", choices=(ANY, LATEST), default=ANY, help="versions a staged row is compared with")
    parser.add_argument("--option", action="append", default=[], metavar="NAME=VALUE", help="reader option")
    parser.add_argument("--rejects", action="store_true", help="set bad rows of CSV sheets aside")
    options = parser.parse_args(arguments)

    spark = configure(SparkSession.builder.appName("tidemark")).getOrCreate()
    sheets = {
        e.sheet: (
            f"{options.sheets.rstrip('/')}/{e.sheet}.{options.format}", options.format,
            dict(o.split("=", 1) for o in options.option))
        for e in SHEET_ORDER
    }
    store = Store(spark, options.database, options.folder).create()
    result = run(
        store, sheets, options.load_ts or utc_now(), min_changed=options.min_changed, against=options.against,
        rejects=options.rejects)
    print(json.dumps(asdict(result)))
    return int(ERROR in (result.status, result.mart_status))


if __name__ == "__main__":
    raise SystemExit(main())
