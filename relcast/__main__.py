"""Command line: load published feeds into tables.

    python -m relcast feeds                              # list the declared feeds and their load mode
    python -m relcast run FEED SRC_ROOT TABLE_ROOT       # one feed (or "all")
    python -m relcast crosswalk TABLE_ROOT [--remapped]  # npi ↔ CCN crosswalk from the facility tables
    python -m relcast catalog CATALOG_JSON TABLE_ROOT    # flatten the release catalogue
    python -m relcast downloads CATALOG_JSON SRC_ROOT    # folder, file name and URL of the files still to fetch
    python -m relcast infer FOLDER [GLOB ...]            # column types and date formats of the files of a feed without a spec
    python -m relcast stream FEED SRC_ROOT TABLE_ROOT    # incremental ingest as a stream (availableNow)

The master and every other setting come from spark-submit / the cluster's
defaults; the checkpoint folder must be shared storage on a cluster.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession


def _spark() -> SparkSession:
    from relcast.session import DEFAULT_CONF

    builder = SparkSession.builder.appName("relcast")
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def main(argv: list[str] | None = None) -> int:
    from relcast.specs import FEEDS, run_crosswalk, run_feed, source_folder

    ap = argparse.ArgumentParser(prog="relcast")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("feeds")
    r = sub.add_parser("run")
    r.add_argument("feed")
    r.add_argument("src_root")
    r.add_argument("table_root")
    c = sub.add_parser("crosswalk")
    c.add_argument("table_root")
    c.add_argument("--remapped", action="store_true")
    g = sub.add_parser("catalog")
    g.add_argument("catalog_json")
    g.add_argument("table_root")
    d = sub.add_parser("downloads")
    d.add_argument("catalog_json")
    d.add_argument("src_root")
    i = sub.add_parser("infer")
    i.add_argument("folder")
    i.add_argument("globs", nargs="*", default=["*"])
    i.add_argument("--encoding", default="UTF-8")
    i.add_argument("--multi-line", action="store_true")
    s = sub.add_parser("stream")
    s.add_argument("--checkpoint")
    s.add_argument("feed")
    s.add_argument("src_root")
    s.add_argument("table_root")
    args = ap.parse_args(argv)

    if args.cmd == "feeds":
        for name, spec in FEEDS.items():
            print(f"{name:28s} {spec.load:7s} {source_folder(name)}/{{{','.join(spec.globs)}}}")
        return 0
    spark = _spark()
    if args.cmd == "run":
        names = list(FEEDS) if args.feed == "all" else [args.feed]
        for name in names:
            n = run_feed(spark, name, args.src_root, args.table_root).count()
            print(f"{name}: {n} rows")
    elif args.cmd == "crosswalk":
        print(f"otherid_ccn_se: {run_crosswalk(spark, args.table_root, args.remapped).count()} rows")
    elif args.cmd == "catalog":
        from relcast.plans.jobs import ingest_catalog

        print(f"datacatalog: {ingest_catalog(spark, args.catalog_json, args.table_root.rstrip('/') + '/datacatalog').count()} rows")
    elif args.cmd == "downloads":
        from relcast.sources.catalog import flatten_catalog, read_catalog
        from relcast.specs.downloads import run_release_selection

        plan = run_release_selection(spark, flatten_catalog(read_catalog(spark, args.catalog_json)), args.src_root)
        for row in plan.orderBy("folder", "file_name").toLocalIterator():
            print(f"{row['folder']}\t{row['file_name']}\t{row['downloadURL']}")
    elif args.cmd == "infer":
        from relcast.sources.csv import FILE_PATH, scan_csv
        from relcast.sources.files import list_releases
        from relcast.sources.infer import infer_types

        raw = scan_csv(spark, list_releases(spark, args.folder, args.globs), encoding=args.encoding, multi_line=args.multi_line).drop(FILE_PATH)
        found = {r["column"]: r for r in infer_types(raw).collect()}
        for column in raw.columns:
            r = found.get(column)
            print(f"{column}\t{r and r['type'] or '-'}\t{r and (r['format'] or ' or '.join(r['rivals'])) or '-'}\t{r['n_values'] if r else 0}")
    elif args.cmd == "stream":
        from relcast.streaming.file_ingest import stream_ingest

        spec = FEEDS[args.feed]
        q = stream_ingest(spark, spec, f"{args.src_root.rstrip('/')}/{source_folder(args.feed)}",
                          f"{args.table_root.rstrip('/')}/{args.feed}", args.checkpoint)
        q.awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
