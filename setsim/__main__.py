"""Command line: run the full refresh (E1) and print its row-count report.

    python -m setsim --sf-dir /root/testdata/sf0.01 [--out URI] [--fk-mode drop]
    python -m setsim --release-dir /data/release   [--out URI] [--count 100 --k 10]

``--sf-dir`` binds the driver's test tables; ``--release-dir`` reads one
Parquet dataset per extract (``chembl_id_lookup.parquet``, …).  On a cluster,
leave ``--master`` unset and submit a script that calls ``setsim.__main__.main``
with ``spark-submit``; outputs go to ``--out`` or the shared checkpoint folder.
"""

from __future__ import annotations

import argparse
import json

from setsim import fixtures
from setsim.plans.refresh import full_refresh
from setsim.session import get_spark
from setsim.sources import readers


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="setsim", description=__doc__.split("\n\n")[0])
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--sf-dir", help="directory of the driver's test tables (fixture bindings)")
    src.add_argument("--release-dir", help="directory of Parquet extracts, one per table")
    ap.add_argument("--out", default=None, help="output URI (default: shared checkpoint folder)")
    ap.add_argument("--master", default=None, help="e.g. local[8]; unset on a cluster")
    ap.add_argument("--count", type=int, default=100, help="number of source records")
    ap.add_argument("--k", type=int, default=10, help="matches kept per source")
    ap.add_argument("--radius", type=int, default=2)
    ap.add_argument("--n-bits", type=int, default=2048)
    ap.add_argument("--fk-mode", choices=["fail", "drop", "report"], default="fail")
    ap.add_argument("--on-violation", choices=["fail", "drop", "report"], default="fail")
    ap.add_argument("--valid-pattern", default=None, help="regular expression that a usable structure matches")
    ap.add_argument("--method", choices=["md5", "xxhash64", "rolling"], default="md5", help="hash of the fingerprint windows")
    ap.add_argument("--limit", type=int, default=None, help="first rows of each extract only (trial run)")
    ap.add_argument("--resume", action="store_true", help="take up the unfinished run below --out")
    ap.add_argument("--no-full-tables", action="store_true", help="skip the full score tables")
    args = ap.parse_args(argv)

    spark = get_spark(args.master)
    release = (fixtures.raw_release(spark, args.sf_dir) if args.sf_dir
               else readers.read_release(spark, args.release_dir))
    res = full_refresh(spark, release, out_dir=args.out, count=args.count, k=args.k, radius=args.radius,
                       n_bits=args.n_bits, on_violation=args.on_violation, fk_mode=args.fk_mode,
                       full_tables=not args.no_full_tables, method=args.method,
                       valid_pattern=args.valid_pattern, limit=args.limit, resume=args.resume)
    print(json.dumps({"out": res.out_dir, "rows": res.counts, "seconds": res.seconds, "resumed": res.resumed,
                      "fingerprint_failures": res.fingerprint_failures, "fk_violations": res.fk_violations}))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
