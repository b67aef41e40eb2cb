"""Command line: run the bordereau pipeline as a batch or as an arrival stream.

  python -m bdxguard.cli batch  --landing DIR --warehouse DIR --meta DIR --run-id ID
  python -m bdxguard.cli stream --landing DIR --warehouse DIR --meta DIR --checkpoint DIR [--continuous]
  python -m bdxguard.cli queries

``--meta`` holds Parquet tables ``column_mapping``, ``treaty_benefit_config``,
``soa_entries`` and optionally ``rate_tables`` (any source works when the
library is called from Python: operators take DataFrames).
"""

from __future__ import annotations

import argparse
import os
import sys

from .session import get_spark


def _metadata(spark, meta_dir: str):
    from .plans.pipeline import Metadata
    from .sources.tables import try_read

    def need(name):
        df = try_read(spark, os.path.join(meta_dir, name))
        if df is None:
            raise SystemExit(f"missing metadata table: {os.path.join(meta_dir, name)}")
        return df

    return Metadata(mapping=need("column_mapping"), treaty=need("treaty_benefit_config"),
                    rates=try_read(spark, os.path.join(meta_dir, "rate_tables")), soa=need("soa_entries"))


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="bdxguard")
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name in ("batch", "stream"):
        p = sub.add_parser(name)
        p.add_argument("--landing", required=True)
        p.add_argument("--warehouse", required=True)
        p.add_argument("--meta", required=True)
        p.add_argument("--master", default=None)
        if name == "batch":
            p.add_argument("--run-id", required=True)
        else:
            p.add_argument("--checkpoint", required=True)
            p.add_argument("--continuous", action="store_true", help="poll every 60 s instead of availableNow")
    sub.add_parser("queries")
    a = ap.parse_args(argv)

    if a.cmd == "queries":
        from .plans.catalog import ORACLE, QUERIES
        for n, fn in QUERIES.items():
            doc = ((fn.__doc__ or "").strip().splitlines() or [""])[0]
            print(f"{n:26s} {'oracle' if n in ORACLE else '      '}  {doc}")
        return 0

    spark = get_spark(a.master)
    meta = _metadata(spark, a.meta)
    if a.cmd == "batch":
        from .plans.pipeline import run_batch
        out = run_batch(spark, a.landing, a.warehouse, meta, a.run_id)
        gate = out["gate"].groupBy("status").count().collect()
        print({r["status"]: r["count"] for r in gate})
        if "recon" in out:
            print({r["status"]: r["count"] for r in out["recon"].groupBy("status").count().collect()})
    else:
        from .streaming.arrival import landing_stream
        q, runs = landing_stream(spark, a.landing, a.warehouse, meta, a.checkpoint, available_now=not a.continuous)
        if a.continuous:
            q.awaitTermination()
        print(f"micro-batches: {len(runs)}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
