"""python -m vellum: passes over a folder of tables, reporting only unless told to write."""

from __future__ import annotations

import argparse
import json
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from vellum.operators import recognition, sidecar
from vellum.plans import library
from vellum.session import local_session


def now() -> str:
    """The time in the library's zone, to the second."""
    return datetime.now(timezone(timedelta(hours=7))).isoformat(timespec="seconds")


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="vellum", description=__doc__)
    parser.add_argument("command", choices=("inbox", "intake", "repair", "slides", "validate", "lexicon"))
    parser.add_argument("--library", action="append", default=[], help="root of a library with an _inbox; may be given again")
    parser.add_argument("--tables", help="folder with sidecars, doc_lines, doc_pages and units")
    parser.add_argument("--out", help="folder to write to")
    parser.add_argument("--apply", action="store_true", help="write; without it only a report is made")
    parser.add_argument("--master", default="*", help="cores of a local session")
    args = parser.parse_args(argv)
    if bool(args.library) != (args.command == "inbox") or not args.library and not args.tables:
        parser.error("inbox takes --library, the other commands take --tables")
    spark = local_session(args.master)
    if args.command == "inbox":
        print(json.dumps(library.inbox_passes(spark, args.library, now(), apply=args.apply), ensure_ascii=False))
        return 0
    read = lambda name: spark.read.parquet(f"{args.tables}/{name}.parquet")
    units = read("units").dropDuplicates(["unit_id"])
    heads = read("sidecars")
    heads = heads.groupBy("doc").agg(F.min_by(F.struct(*[c for c in heads.columns if c != "doc"]), "ingested_at").alias("r")).select("doc", "r.*")
    history = None
    if args.command == "intake":
        files = heads.where("title is not null").select("doc", F.concat(F.lit("["), F.coalesce("subject", F.lit("")), F.lit("] "), "title", F.lit(".pdf")).alias("name"))
        done = library.intake(files, read("doc_lines").dropDuplicates(["line_id"]), read("doc_pages"), now())
        result, report = done.published, done.report
    elif args.command == "repair":
        result, history, per_doc = library.repair_pass(units)
        report = per_doc.agg(F.count_if((F.col("changed") > 0) & F.col("safe")).alias("rewritten"), F.count_if(~F.col("safe")).alias("unsafe"), F.sum("changed").alias("units"), F.sum("residue").alias("residue"))
    elif args.command == "slides":
        result, history = library.slide_pass(heads, units)
        report = result.agg(F.count_distinct("doc").alias("rewritten"), F.count("*").alias("slides"))
    elif args.command == "validate":
        result = sidecar.validation_errors(sidecar.sidecar_json(heads, units)).where("size(errors) > 0").select("doc", "errors")
        report = result.agg(F.count("*").alias("invalid"))
    else:
        result = recognition.lexicon(units).orderBy("word")
        report = result.agg(F.count("*").alias("words"))
    if args.apply and args.out:
        if history is not None:
            history.write.mode("overwrite").parquet(f"{args.out}/history")
        result.write.mode("overwrite").parquet(f"{args.out}/{args.command}")
    print(json.dumps(report.first().asDict(), default=str))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
