"""Command line: the whole load (C7) from raw CSV files to warehouse tables,
then the row count of every stored table (S8).

    python -m stardw --raw-dir DIR --warehouse DIR [--file customers=customers_dataset.csv ...]
        [--input-gb N] [--jdbc-url URL --jdbc-table-prefix schema.]

With ``--jdbc-url`` the stored tables are also appended to a database
(dimensions first, then facts), 2,000 rows per insert batch.
"""

from __future__ import annotations

import argparse
import os

from stardw.params import DEFAULT_PARAMS
from stardw.plans.audit import row_count_audit
from stardw.plans.load import load_warehouse
from stardw.session import build_session, scale_conf
from stardw.sources.csv import read_raw_csv
from stardw.sources.warehouse_io import write_jdbc


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="stardw", description=__doc__.splitlines()[0])
    ap.add_argument("--raw-dir", required=True)
    ap.add_argument("--warehouse", required=True)
    ap.add_argument("--file", action="append", default=[], help="table=file name override")
    ap.add_argument("--jdbc-url")
    ap.add_argument("--jdbc-table-prefix", default="")
    ap.add_argument("--jdbc-user")
    # the password is read from the environment, not from the command line
    ap.add_argument("--jdbc-password-env", default="STARDW_JDBC_PASSWORD", help="variable that holds the password")
    ap.add_argument("--input-gb", type=float,
                    help="raw input volume: sizes shuffle partitions, scan splits and skew thresholds")
    args = ap.parse_args(argv)

    spark = build_session()
    if args.input_gb:
        for k, v in scale_conf(int(args.input_gb * (1 << 30))).items():
            spark.conf.set(k, v)
    files = dict(kv.split("=", 1) for kv in args.file)
    wh = load_warehouse(read_raw_csv(spark, args.raw_dir, files), DEFAULT_PARAMS, args.warehouse)
    if args.jdbc_url:
        props = {k: v for k, v in {"user": args.jdbc_user, "password": os.environ.get(args.jdbc_password_env)}.items() if v}
        for name, df in wh.tables().items():
            write_jdbc(df, name, args.jdbc_url, args.jdbc_table_prefix + name, props)
    for r in row_count_audit(wh).collect():
        print(f"  {r['table_name']:<35} {r['rows']:>12,}")


if __name__ == "__main__":
    main()
