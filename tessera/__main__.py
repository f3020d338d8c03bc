"""Command line: ``python -m tessera <command> ...`` (works under spark-submit).

    zones   --listings DIR --housing DIR --income DIR --out DIR
    train   --features DIR --label price --run-log DIR [--parallelism 4] [--split key --key _id]
            [--grids '{"LR": {"regParam": [0.1, 0.01]}}']
    ingest  --source DIR --target DIR --checkpoint DIR --schema DDL --key COL --order -COL ...
"""

from __future__ import annotations

import argparse
import json

from tessera.session import get_session


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="tessera")
    sub = ap.add_subparsers(dest="cmd", required=True)
    z = sub.add_parser("zones", help="formatted, clean and feature tables")
    z.add_argument("--listings", required=True)
    z.add_argument("--housing", required=True)
    z.add_argument("--income", required=True)
    z.add_argument("--out", required=True)
    t = sub.add_parser("train", help="correlation selection + hold-out grid search")
    t.add_argument("--features", required=True)
    t.add_argument("--label", default="price")
    t.add_argument("--run-log", required=True)
    t.add_argument("--models", default=None)
    t.add_argument("--parallelism", type=int, default=1)
    t.add_argument("--split", default="random", choices=["random", "key"])
    t.add_argument("--key", default=None)
    t.add_argument("--grids", default=None,
                   help='JSON {family: {param: [values]}}; default: the full reference grids')
    i = sub.add_parser("ingest", help="process new snapshots into the keyed table")
    i.add_argument("--source", required=True)
    i.add_argument("--target", required=True)
    i.add_argument("--checkpoint", required=True)
    i.add_argument("--schema", required=True, help="DDL, e.g. 'k string, ts timestamp, v double'")
    i.add_argument("--key", action="append", required=True)
    i.add_argument("--order", action="append", default=[], help="column, '-col' for descending")
    i.add_argument("--format", default="json")
    args = ap.parse_args(argv)
    spark = get_session()

    if args.cmd == "zones":
        from tessera.plans.zones import build_zones
        paths = build_zones(spark, args.listings, args.housing, args.income, args.out)
        print(json.dumps(paths, indent=2))
    elif args.cmd == "train":
        from tessera.models import append_run_log
        from tessera.plans.training import train_and_validate
        from tessera.plans.zones import MODEL_FEATURES
        grids = json.loads(args.grids) if args.grids else None
        res = train_and_validate(spark.read.parquet(args.features), MODEL_FEATURES, args.label,
                                 grids=grids, split_how=args.split, key=args.key,
                                 parallelism=args.parallelism, save_dir=args.models)
        append_run_log(res.log, args.run_log).filter("is_best").show(truncate=False)
    elif args.cmd == "ingest":
        from tessera.streaming import ingest_available
        schema = spark.createDataFrame([], args.schema).schema
        out = ingest_available(spark, args.source, args.target, args.checkpoint, schema,
                               args.key, args.order, fmt=args.format)
        print(out.count())


if __name__ == "__main__":
    main()
