"""Command line: ``python -m hearth <command> [options]``.

  list                                 registered queries and the survey ids they cover
  query NAME --sf-dir D [--out P]      run one query; print it or write parquet to P
  refresh --sf-dir D [--out P]         full silver + gold refresh with run audit
  allocation --sf-dir D [--out P]      allocation recommendations and per-scenario CSVs
"""

from __future__ import annotations

import argparse
import json
import sys


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="hearth")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list")
    q = sub.add_parser("query")
    q.add_argument("name")
    for p in (q, sub.add_parser("refresh"), sub.add_parser("allocation")):
        p.add_argument("--sf-dir", required=True)
        p.add_argument("--out")
        p.add_argument("--master")
    args = ap.parse_args(argv)

    from .plans import registry
    if args.cmd == "list":
        for name, spec in registry.load_all().items():
            print(f"{name:32s} {spec.ops}")
        return 0

    from .session import build_session
    spark = build_session(args.master)
    if args.cmd == "query":
        registry.load_all()
        df = registry.build(args.name, spark, args.sf_dir)
        if args.out:
            df.write.mode("overwrite").parquet(args.out)
        else:
            df.show(50, truncate=False)
        return 0
    if args.cmd == "refresh":
        from .plans import refresh
        result = refresh.run(spark, args.sf_dir, args.out)
    else:
        from .plans import allocation_report
        result = allocation_report.run(spark, args.sf_dir, args.out)
    print(json.dumps(result, default=str))
    return 0 if result.get("success", True) else 1


if __name__ == "__main__":
    sys.exit(main())
