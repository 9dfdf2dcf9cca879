"""Command line: build and write one report.

    python -m scorecast usage     --tables DIR --out DIR [--as-of YYYY-MM-DD]
    python -m scorecast benchmark --tables DIR --out DIR [--district N]
    python -m scorecast parcc     --tables DIR --out DIR [--district N]
    python -m scorecast status    --tables DIR --out DIR --district N --form A|B|C

``--tables`` is a folder of Parquet tables named after the logical tables
(TestResult, Student, ...); ``--jdbc URL`` reads them from a database
instead (``--jdbc-user``, the password from the environment variable that
``--jdbc-password-env`` names, ``--jdbc-partition Table:column:lower:upper:n`` for
every fact, ``--jdbc-name Table=schema.table``); ``--database DB`` reads tables registered in the session catalog
(e.g. facts bucketed by ``sources.layout.write_bucketed``); ``--binding
SF_DIR`` projects them from the TPC-H-style test data.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import os

from .config import DEFAULT
from .plans import reports
from .session import get_session
from .sources.binding import binding_config
from .sources.catalog import BindingCatalog, JdbcCatalog, ParquetCatalog
from .sources.layout import TableCatalog


def jdbc_catalog(spark, a) -> JdbcCatalog:
    """The catalog that the ``--jdbc`` options describe."""
    properties = {k: v for k, v in (("user", a.jdbc_user), ("password", os.environ.get(a.jdbc_password_env))) if v}
    partitioning = {}
    for text in a.jdbc_partition:
        table, column, *bounds = text.split(":")
        partitioning[table] = (column, *(int(x) for x in bounds))
    return JdbcCatalog(spark, a.jdbc, properties, partitioning, names=dict(x.split("=", 1) for x in a.jdbc_name))


def main(argv=None):
    ap = argparse.ArgumentParser(prog="scorecast")
    ap.add_argument("report", choices=["usage", "benchmark", "parcc", "status"])
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--tables")
    src.add_argument("--jdbc")
    src.add_argument("--binding")
    src.add_argument("--database", help="tables registered in the session catalog (e.g. bucketed facts)")
    ap.add_argument("--jdbc-user")
    ap.add_argument("--jdbc-password-env", default="SCORECAST_JDBC_PASSWORD")
    ap.add_argument("--jdbc-partition", action="append", default=[], metavar="TABLE:COLUMN:LOWER:UPPER:N")
    ap.add_argument("--jdbc-name", action="append", default=[], metavar="TABLE=NAME")
    ap.add_argument("--out", required=True)
    ap.add_argument("--district", type=int)
    ap.add_argument("--form", default="B")
    ap.add_argument("--as-of", type=dt.date.fromisoformat)
    ap.add_argument("--format", default="parquet", choices=["parquet", "csv", "xlsx"])
    ap.add_argument("--versioned", action="store_true", help="keep the report below versions/ and switch to it in one step")
    ap.add_argument("--master")
    a = ap.parse_args(argv)

    spark = get_session(a.master)
    cfg = DEFAULT
    if a.tables:
        cat = ParquetCatalog(spark, a.tables)
    elif a.jdbc:
        cat = jdbc_catalog(spark, a)
    elif a.database:
        cat = TableCatalog(spark, a.database)
    else:
        cat, cfg = BindingCatalog(spark, a.binding), binding_config()
    if a.report == "status" and a.district is None:
        ap.error("status needs --district")
    written = reports.run(a.report, cat, a.out, district_id=a.district, as_of=a.as_of, form=a.form,
                          cfg=cfg, fmt=a.format, versioned=a.versioned)
    print(json.dumps(written, indent=1))


if __name__ == "__main__":
    main()
