"""The stages for the command line: python -m tamarack.cli STAGE ... reads and writes Parquet tables."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarack.functions.text import word_count
from tamarack.operators import chunks, clean, corpus, dedupe, labels, qa, sampling, splits
from tamarack.plans.shipping import ship
from tamarack.sources import files, html, sinks


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tamarack", description=__doc__)
    stages = parser.add_subparsers(dest="stage", required=True)

    def stage(name: str, text: str, *inputs: str, out: bool = True) -> argparse.ArgumentParser:
        sub = stages.add_parser(name, help=text)
        for i in inputs:
            sub.add_argument(f"--{i}", required=True, help=f"table of {i}")
        if out:
            sub.add_argument("--out", help="where to write; without it only counts are printed")
        sub.add_argument("--limit", type=int, help="first rows by doc_id only")
        sub.add_argument("--dry-run", action="store_true", help="print counts, write nothing")
        return sub

    stage("extract", "structured text of HTML pages (doc_id, html)", "pages")
    stage("clean", "clean and mask documents (doc_id, text, organization, source_type)", "documents")
    stage("dedupe", "mark exact duplicates (doc_id, text)", "documents")
    build = stage("corpus", "one labelled card per kept brief", "manifest", "texts", "lookup")
    build.add_argument("--card", choices=("simple", "tiered"), default="simple")
    build.add_argument("--rules", help="YAML file of topic rules")
    build.add_argument("--compare", action="store_true", help="print label changes between the two labelling orders")
    cut = stage("chunk", "cut documents into chunks, as JSON lines", "documents")
    cut.add_argument("--rebuild", action="store_true", help="write all chunks anew")
    split = stage("split", "train and dev without leaks", "corpus", "gold", "manifest")
    split.add_argument("--seed", type=int, default=42)
    split.add_argument("--check", action="store_true", help="exit with 1 if a rule is broken")
    gold = stage("gold", "sheet to label by hand", "corpus")
    gold.add_argument("--seed", type=int, default=42)
    stage("report", "quality figures of a corpus", "corpus", out=False)
    return parser


def _finish(df: DataFrame, args: argparse.Namespace, write=sinks.write_snapshot) -> int:
    if args.limit is not None:
        df = df.orderBy("doc_id").limit(args.limit)
    if args.dry_run or not args.out:
        print(f"{args.stage}: {df.count()} rows")
    else:
        write(df, args.out)
    return 0


def run(spark: SparkSession, argv: list[str]) -> int:
    args = _parser().parse_args(argv)
    ship(spark)
    read = lambda name: spark.read.parquet(getattr(args, name))
    if args.stage == "extract":
        return _finish(html.extract_pages(read("pages"), "doc_id", "html"), args)
    if args.stage == "clean":
        return _finish(clean.clean_documents(read("documents")), args)
    if args.stage == "dedupe":
        return _finish(dedupe.mark_exact(read("documents"), "doc_id", F.col("text")), args)
    if args.stage == "corpus":
        rules, fallback, exempt = labels.rules_from(files.read_rules(args.rules)) if args.rules else (labels.HEALTH_TOPICS, labels.FALLBACK, labels.EXEMPT_TITLES)
        out = corpus.build_corpus(read("manifest"), read("texts"), read("lookup"), rules, exempt, fallback, args.card == "tiered")
        if args.compare:
            both = labels.with_topics(out, "card_text", "study_title", rules, exempt, fallback, None, "title_first")
            labels.label_deltas(both, "title_first", "topic_seed").orderBy("topic").show(100, False)
            return 0
        return _finish(out, args, sinks.write_corpus)
    if args.stage == "chunk":
        return _finish(chunks.chunk_documents(read("documents")), args, lambda df, path: sinks.write_chunks(df, path, args.rebuild))
    if args.stage == "split":
        table, gold = read("corpus"), read("gold").select(F.trim("doc_id").alias("doc_id")).distinct()
        dups = read("manifest").filter(F.length("duplicate_of") > 0).select("doc_id").distinct()
        out = splits.train_dev(splits.eligible(table, gold, dups), args.seed)
        if args.check:
            rows = splits.checks(out, table, gold, dups).orderBy("rule").collect()
            print("\n".join(f"{r['rule']}: {r['n_broken']}" for r in rows))
            return int(any(r["n_broken"] for r in rows))
        return _finish(out, args, sinks.write_splits)
    if args.stage == "gold":
        return _finish(sinks.labelling_sheet(sampling.gold_sample(read("corpus"), args.seed)), args, sinks.write_csv)
    table = read("corpus")
    qa.corpus_report(table).orderBy(F.desc("n_docs"), "topic").show(100, False)
    qa.value_counts(table, "stakeholder_type", "language").orderBy("field", F.desc("n_rows"), "value").show(200, False)
    qa.distribution(table, word_count(F.col("card_text"))).show()
    qa.cluster_stats(table).show()
    return 0


def main() -> None:
    spark = SparkSession.builder.appName("tamarack").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    sys.exit(run(spark, sys.argv[1:]))


if __name__ == "__main__":
    main()
