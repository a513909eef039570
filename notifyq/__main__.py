"""Command line: run the stages over landing files, or show stored results.

    python -m notifyq run   --landing DIR_OR_GLOB --root TABLES --key-file KEY [--as-of TS]
    python -m notifyq watch --landing DIR --root TABLES --key-file KEY   # each new file once
    python -m notifyq kpis  --root TABLES                                # latest KPI report
    python -m notifyq stage clean-validate --landing L --root T --run-id R  # one stage on
    python -m notifyq stage load --root T --run-id R --key-file KEY         #   stored inputs
    python -m notifyq stage kpis --root T --run-id R
    python -m notifyq new-key                                            # print a Fernet key

``--master`` is only for local use; under spark-submit the cluster's settings apply.
"""

from __future__ import annotations

import argparse
import sys


def _key(args) -> str:
    with open(args.key_file, encoding="utf-8") as f:
        return f.read().strip()


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="notifyq")
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name in ("run", "watch"):
        p = sub.add_parser(name)
        p.add_argument("--landing", required=True)
        p.add_argument("--root", required=True)
        p.add_argument("--key-file", required=True)
        p.add_argument("--as-of", default=None, help="'now' for the future-timestamp rule")
        p.add_argument("--run-id", default=None)
        p.add_argument("--newest", action="store_true", help="run: only the newest landing batch")
        p.add_argument("--master", default=None)
    p = sub.add_parser("kpis")
    p.add_argument("--root", required=True)
    p.add_argument("--master", default=None)
    p = sub.add_parser("stage")
    p.add_argument("name", choices=["clean-validate", "load", "kpis"])
    p.add_argument("--root", required=True)
    p.add_argument("--run-id", required=True)
    p.add_argument("--landing", default=None)
    p.add_argument("--key-file", default=None)
    p.add_argument("--as-of", default=None)
    p.add_argument("--master", default=None)
    sub.add_parser("new-key")
    args = ap.parse_args(argv)

    if args.cmd == "new-key":
        from notifyq.functions.protect import generate_key

        print(generate_key())
        return 0

    from notifyq.session import build_session

    spark = build_session(args.master)
    if args.cmd == "kpis":
        from notifyq.plans.runner import latest_kpis

        latest_kpis(spark, args.root).orderBy("kpi_order").show(truncate=False)
        return 0

    as_of = args.as_of  # unset: the clock at the start of the run
    if args.cmd == "stage":
        from notifyq.plans import runner

        if args.name == "clean-validate":
            from notifyq.sources.files import read_raw_csv

            _, st = runner.stage_clean_validate(spark, read_raw_csv(spark, args.landing), args.root, args.run_id, as_of=as_of)
            print({k: v for k, v in st.items() if k != "batches"})
        elif args.name == "load":
            print(runner.stage_load(spark, args.root, args.run_id, _key(args)).asDict())
        else:
            for r in runner.stage_kpis(spark, args.root, args.run_id):
                print(r.asDict())
        return 0
    if args.cmd == "run":
        from notifyq.plans.runner import new_run_id, run_batch, stage_ingest

        run_id = args.run_id or new_run_id()
        raw = stage_ingest(spark, args.landing, args.root, run_id, newest_only=args.newest)
        summary = run_batch(spark, raw, args.root, _key(args), run_id=run_id, as_of=as_of)
        for k, v in summary.asDict().items():
            print(f"{k:>22}: {v}")
        return 0

    from notifyq.streaming.incremental import start_incremental_runs

    start_incremental_runs(spark, args.landing, args.root, _key(args), as_of=as_of).awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
