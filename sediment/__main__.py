"""Command line: the layer steps on your own directories.

  python -m sediment bronze --landing landing --bronze bronze [--layout document|lines]
  python -m sediment silver --bronze bronze --silver silver [--schema silver] [--tables ...]
  python -m sediment run    --landing landing --work out [--layout ...]
  python -m sediment check  --landing landing --work out [--layout ...]
  python -m sediment daily  --landing landing --work out [--layout ...]
  python -m sediment incremental --landing landing --log log --checkpoint ckpt --feed issues

``--skip-errors`` logs a failing feed / table and goes on (the interactive scripts' behaviour);
by default any failure stops the run (the scheduled behaviour).  Results of ``run`` and
``check`` are printed as tables.
"""

from __future__ import annotations

import argparse
import sys

from sediment.schemas import BRONZE_TABLES, FEEDS, SILVER_TABLES


def _print(checks) -> None:
    """Every row: there is one per expected table or check."""
    print("\t".join(checks.columns))
    for row in checks.collect():
        print("\t".join("" if v is None else str(v) for v in row))


def main(argv: list[str] | None = None, spark=None) -> int:
    ap = argparse.ArgumentParser(prog="sediment")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("bronze")
    b.add_argument("--landing", required=True)
    b.add_argument("--bronze", required=True)
    s = sub.add_parser("silver")
    s.add_argument("--bronze", required=True)
    s.add_argument("--silver", required=True)
    s.add_argument("--schema", default=None)
    s.add_argument("--tables", nargs="*", default=list(SILVER_TABLES))
    for name in ("run", "check", "daily"):
        p = sub.add_parser(name)
        p.add_argument("--landing", required=True)
        p.add_argument("--work", required=True)
    i = sub.add_parser("incremental")
    i.add_argument("--landing", required=True)
    i.add_argument("--log", required=True)
    i.add_argument("--checkpoint", required=True)
    i.add_argument("--feed", choices=FEEDS, required=True)
    for p in (b, i, *[sub.choices[n] for n in ("run", "check", "daily")]):
        p.add_argument("--layout", choices=("document", "lines"), default="document")
    for p in sub.choices.values():
        p.add_argument("--skip-errors", action="store_true")
        p.add_argument("--master", default=None)
    args = ap.parse_args(argv)
    on_error = "skip" if args.skip_errors else "raise"

    from sediment.session import get_session
    own = spark is None
    if own:
        spark = get_session("sediment-" + args.cmd, master=args.master)
    if args.cmd == "bronze":
        from sediment.plans.bronze import build_bronze
        out = build_bronze(spark, args.landing, args.bronze, args.layout, on_error=on_error,
                           require_input=True)
        print("\n".join(f"{t}\t{p}" for t, p in out.items()))
    elif args.cmd == "silver":
        from sediment.plans.run import build_silver
        names = BRONZE_TABLES
        if on_error == "skip":
            from sediment.plans.run import existing_tables
            names = list(existing_tables(spark, args.bronze, BRONZE_TABLES))
        frames = {t: spark.read.parquet(f"{args.bronze.rstrip('/')}/{t}") for t in names}
        out = build_silver(spark, frames, args.silver, args.tables, args.schema, on_error)
        print("\n".join(f"{t}\t{p}" for t, p in out.items()))
    elif args.cmd == "run":
        from sediment.plans.run import run_layers
        _print(run_layers(spark, args.landing, args.work, args.layout, on_error=on_error))
    elif args.cmd == "check":
        from sediment.plans.run import layer_checks
        _print(layer_checks(spark, args.landing, args.work, args.layout))
    elif args.cmd == "daily":
        from sediment.streaming.tables import daily
        out = daily(spark, args.landing, args.work, args.layout)
        print("\n".join(f"{t}\t{p}" for t, p in out.items()))
    elif args.cmd == "incremental":
        from sediment.streaming.incremental import ingest_new_landing
        ingest_new_landing(spark, args.landing, args.log, args.checkpoint, args.feed,
                           args.layout).awaitTermination()
    if own:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
