"""Command line: ``spark-submit bookpipe/__main__.py 1000 20 --captures … --store …``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from bookpipe.config import RunConfig
from bookpipe.plans.increment import run_and_publish
from bookpipe.sinks.stores import FileStore, TableStore
from bookpipe.sources.pages import read_captures


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser("bookpipe")
    parser.add_argument("num_books", type=int, nargs="?", default=5)
    parser.add_argument("num_reviews", type=int, nargs="?", default=5)
    parser.add_argument("--captures", required=True, help="folder of captured pages")
    parser.add_argument("--store", required=True, help="folder of the raw store")
    parser.add_argument("--tree", help="existing JSON tree that counts as saved")
    parser.add_argument("--tables", action="store_true", help="also keep catalog tables")
    parser.add_argument("--banned", action="append", default=[], help="banned title phrase")
    parser.add_argument("--language", default="English", help="language a book must be in")
    parser.add_argument("--count-mode", choices=("rows", "users"), default="rows", help="what counts as a saved review")
    parser.add_argument("--sort-by", choices=("listing", "reviews"), default="listing", help="which listed books come first")
    parser.add_argument("--reviews-per-page", type=int, default=1, help="reviews to expect on a page")
    parser.add_argument("--follow-pager", action="store_true", help="a book's pages end where the pager does")
    parser.add_argument("--dedup-first", action="store_true", help="count each user once in a quota")
    parser.add_argument("--on-error", choices=("quarantine", "fail"), default="quarantine", help="what a bad page does")
    parser.add_argument("--batch", help="name of the run; by default it follows from pages, parameters and stored batches")
    return parser.parse_args(argv)


def config_of(args: argparse.Namespace) -> RunConfig:
    return RunConfig(
        args.num_books,
        args.num_reviews,
        tuple(args.banned),
        language=args.language,
        count_mode=args.count_mode,
        dedup_first=args.dedup_first,
        on_error=args.on_error,
        sort_by=args.sort_by,
        reviews_per_page=args.reviews_per_page,
        follow_pager=args.follow_pager,
    )


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = SparkSession.builder.appName("bookpipe").getOrCreate()
    increment = run_and_publish(
        read_captures(spark, args.captures),
        FileStore(spark, args.store, tree=args.tree),
        TableStore(spark) if args.tables else None,
        config_of(args),
        batch=args.batch,
    )
    p = increment.progress
    print(f"target {p.target}, accepted {p.accepted}, rejected {p.rejected}, remaining {p.remaining}")


if __name__ == "__main__":
    main()
