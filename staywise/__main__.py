"""Command line: run the medallion jobs, or one registered query.

  python -m staywise layers --sf-dir DIR --out DIR [--parity]
  python -m staywise query NAME --sf-dir DIR [--out DIR]
"""

from __future__ import annotations

import argparse
import json
import sys


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="staywise")
    sub = p.add_subparsers(dest="cmd", required=True)
    lay = sub.add_parser("layers", help="write bronze-derived silver and gold tables")
    lay.add_argument("--sf-dir", required=True)
    lay.add_argument("--out", required=True, help="shared output folder")
    lay.add_argument("--parity", action="store_true", help="reproduce the original quirks")
    job = sub.add_parser("job", help="from landed files (CSV, event JSON, API JSON) to gold")
    job.add_argument("--out", required=True, help="shared output folder")
    job.add_argument("--batch", required=True, help="CSV folder")
    job.add_argument("--stream", required=True, help="folder of booking events as JSON")
    job.add_argument("--weather", nargs=2, metavar=("GEOCODE", "FORECAST"), help="folders of landed JSON")
    job.add_argument("--rates", help="folder of landed JSON")
    job.add_argument("--database", help="also register the tables under this database")
    job.add_argument("--parity", action="store_true")
    qry = sub.add_parser("query", help="run one registered query")
    qry.add_argument("name")
    qry.add_argument("--sf-dir", required=True)
    qry.add_argument("--out", help="write the result as parquet here (else: row count)")
    for s in (lay, job, qry):
        s.add_argument("--master", default=None)
    a = p.parse_args(argv)

    from .session import get_session
    spark = get_session(a.master)
    if a.cmd == "layers":
        from .plans.medallion import run_layers
        print(json.dumps(run_layers(spark, a.sf_dir, a.out, parity=a.parity)))
    elif a.cmd == "job":
        from .plans.medallion import run_job
        tables = run_job(spark, a.out, a.batch, a.stream, a.weather and tuple(a.weather), a.rates, a.database,
                         parity=a.parity)
        print(json.dumps({k: v.count() for k, v in tables.items()}))
    else:
        from .plans.keys import REGISTRY
        df = REGISTRY[a.name][0](spark, a.sf_dir)
        if a.out:
            df.write.mode("overwrite").parquet(a.out)
        else:
            print(df.count())
    return 0


if __name__ == "__main__":
    sys.exit(main())
