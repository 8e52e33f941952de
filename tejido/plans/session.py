"""A harvest as a whole: discover, populate, run a session of micro-batches, report; and a command line for it.

It starts from landed pages; fetching, browsers and notifications are outside of the engine.
"""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import html, scoring, text, urls
from ..operators import corpus, frontier
from ..operators.store import Conflict, Store
from ..schemas import FRONTIER, TARGET_TOKENS
from ..sources import readers


class HarvestError(Exception):
    """What a harvest can't go on from; kind tells the stage."""

    def __init__(self, kind: str, message: str):
        super().__init__(f"{kind}: {message}")
        self.kind = kind


#: How long rows may be under work before another session takes them up.
LEASE = "1 HOUR"


@dataclass
class Harvest:
    """Tables of a harvest under one root folder: the frontier, which later harvests on that root go on with, texts and snapshots by round."""

    spark: SparkSession
    root: str
    batch: int = 32

    def __post_init__(self) -> None:
        self.store = Store(self.spark, f"{self.root.rstrip('/')}/frontier", FRONTIER)

    @property
    def version(self) -> int:
        return self.store.version

    def frontier(self) -> DataFrame:
        """The frontier's newest version."""
        self.store.refresh()
        return self.store.read()

    def texts(self) -> DataFrame:
        """The texts that completed rows of the frontier stand for; what a broken round has left behind is not among them."""
        kept = self.frontier().filter("status = 'completed' and file_path is not null").select("content_hash", "file_path")
        if kept.isEmpty():
            return self.spark.createDataFrame([], "content_hash string, file_name string, text string, source string, domain string")
        saved = corpus.read_texts(self.spark, f"{self.root}/texts").withColumn("file_path", F.concat(F.lit("texts/round="), F.col("round").cast("string")))
        return saved.join(kept, ["content_hash", "file_path"], "left_semi").select("content_hash", "file_name", "text", "source", "domain")

    def discover(self, catalog: DataFrame | None = None, domains: DataFrame | None = None, entries: DataFrame | None = None, items: DataFrame | None = None) -> DataFrame:
        """url and source of all branches: configured seeds, ranked domains by category, feed entries, forum and video items."""
        branches = []
        if catalog is not None:
            branches.append(readers.seeds(catalog).select("url", F.col("name").alias("source")))
        if domains is not None:
            kept = domains.filter(urls.mexican_domain(F.col("domain"))).withColumn("i", urls.domain_indicators(F.col("domain")))
            best = kept.withColumn("score", urls.domain_score(F.col("domain"), F.col("rank"), F.col("i"))).orderBy(F.col("score").desc(), "rank").limit(10_000)
            branches.append(best.select(F.concat(F.lit("https://"), "domain").alias("url"), F.concat(F.lit("tranco_"), urls.domain_category(F.col("domain"), F.col("i"))).alias("source")))
        branches += [b.select("url", "source") for b in (entries, items) if b is not None]
        if not branches:
            raise HarvestError("discovery", "no branch was given")
        out = branches[0]
        for b in branches[1:]:
            out = out.unionByName(b)
        return out

    def populate(self, found: DataFrame, as_of: str) -> None:
        self.store.insert(frontier.new_rows(found, F.lit(as_of).cast("timestamp")))

    def claim(self, as_of: str) -> DataFrame | None:
        """The best pending rows, marked as under work in one commit, so that no other session takes them; rows whose lease is over come again. None if there are none."""
        now, taken = F.lit(as_of).cast("timestamp"), []

        def rows(store: Store) -> DataFrame:
            free = frontier.released(store.read(), now, LEASE)
            best = frontier.dequeue(free, self.batch).withColumn("status", F.lit("processing")).withColumn("updated_at", now)
            taken[:] = best.collect()  # a batch
            return self.spark.createDataFrame(taken, FRONTIER)

        self.store.transact(rows)
        return self.spark.createDataFrame(taken, FRONTIER) if taken else None

    def process(self, taken: DataFrame, pages: DataFrame) -> DataFrame:
        """One row a taken URL: text, key, tokens, score, links; status and error in place of exceptions."""
        joined = taken.select("url_hash", "url", "source").join(pages.select("url", "html"), "url", "left").withColumn("text", text.strip(html.main_text("html")))
        cleaned = joined.withColumn("clean", text.clean(F.col("text"))).withColumn("quality", text.quality(F.col("text")))
        error = F.when(F.col("html").isNull(), "not landed").when(F.length("clean") < 20, "No content extracted").when(F.col("quality.is_binary"), "binary")
        return cleaned.select(
            "url_hash", "url", "source", "html", F.col("clean").alias("text"), F.when(error.isNull(), "completed").otherwise("failed").alias("status"), error.alias("error_message"),
            text.content_key(F.col("text")).alias("content_hash"), text.token_estimate(F.col("clean")).alias("token_count"), F.length("clean").cast("long").alias("content_size"),
            scoring.geography(F.col("clean"))["score"].cast("double").alias("mexican_score"), F.lit("enhanced_basic").alias("extraction_method"),
        )

    def session(self, pages: DataFrame, as_of: str, rounds: int, target_tokens: int = TARGET_TOKENS, grow: bool = True) -> DataFrame:
        """Micro-batches until nothing is pending, the rounds are over or the tokens reached; the frontier's report.

        Texts that were completed before, by this session or an earlier one, are failed as duplicates. Links above the threshold are put into the
        frontier. A round writes its batch's rows and files, and nothing of the rest; it counts once its rows are committed.
        """
        now = F.lit(as_of).cast("timestamp")
        for _ in range(rounds):
            base = self.frontier()
            if (base.agg(F.sum("token_count")).first()[0] or 0) >= target_tokens:
                break
            taken = self.claim(as_of)
            if taken is None:
                break
            n = self.version  # no other round has this number
            path = f"{self.root}/results/round={n}"
            self.process(taken, pages).write.mode("overwrite").parquet(path)
            done = self.spark.read.parquet(path)
            before = self.frontier().filter("status = 'completed' and content_hash is not null").select("content_hash").distinct()
            good = frontier.first_of(done.filter("status = 'completed'"), ["content_hash"], F.col("url_hash")).join(before, "content_hash", "left_anti")
            good = good.withColumn("domain", text.path_domain(urls.host(F.col("url")))).withColumn("file_name", text.file_name(F.col("source"), now, F.col("content_hash")))
            kept = f"{self.root}/kept/round={n}"
            good.write.mode("overwrite").parquet(kept)
            good = self.spark.read.parquet(kept)
            corpus.write_texts(good, f"{self.root}/texts/round={n}")
            corpus.write_snapshots(good, f"{self.root}/snapshots/round={n}")
            saved = good.select("url_hash", F.lit(f"texts/round={n}").alias("file_path"))
            lost = (F.col("status") == "completed") & F.col("file_path").isNull()
            changes = done.join(saved, "url_hash", "left").withColumn("error_message", F.when(lost, "duplicate").otherwise(F.col("error_message"))).withColumn("status", F.when(lost, "failed").otherwise(F.col("status"))).withColumn("updated_at", now)
            names = ["status", "updated_at", "error_message", "content_hash", "file_path", "token_count", "content_size", "mexican_score", "extraction_method"]
            links = frontier.new_rows(self.found_links(good), now, "dynamic_recursion") if grow else None

            def rows(store: Store, changes=changes, names=names, links=links) -> DataFrame:
                out = frontier.update(store.read(store.touched(changes)).join(changes.select("url_hash"), "url_hash", "left_semi"), changes, names)
                return out if links is None else out.unionByName(frontier.absent(links, store.read(store.touched(links))), allowMissingColumns=True)

            self.store.transact(rows)
        return frontier.progress_report(self.frontier())

    def found_links(self, done: DataFrame, least: float = 3.0) -> DataFrame:
        links = done.select("url", "source", F.explode(html.html_links("html")).alias("l")).select("source", F.col("url").alias("parent"), urls.resolve(F.col("url"), F.col("l.href")).alias("url"), F.col("l.anchor").alias("anchor"))
        kept = links.filter(F.col("url").isNotNull() & ~urls.skip_link(F.col("url"), F.col("parent")) & (urls.link_score(F.col("url"), F.col("anchor")) > least))
        return kept.select("url", F.concat("source", F.lit("_discovered")).alias("source"))

    def status(self) -> dict[str, list[dict]]:
        f = self.frontier()
        return {"overall": _rows(frontier.progress_report(f)), "sources": _rows(frontier.by_source(f).orderBy(F.col("tokens").desc(), "source").limit(10)), "domains": _rows(frontier.domain_yield(f))}


def _rows(df: DataFrame) -> list[dict]:
    return [r.asDict() for r in df.collect()]  # reports of a bounded number of rows


def main(arguments: list[str] | None = None, make: Callable[[], SparkSession] | None = None) -> int:
    """0 after success, 1 after an error, 130 after an interruption."""
    parser = argparse.ArgumentParser(prog="tejido", description=__doc__)
    parser.add_argument("root")
    parser.add_argument("--pages", required=True, help="landed pages: Parquet with url and html")
    parser.add_argument("--sources", help="YAML list of sources")
    parser.add_argument("--as-of", default="2024-01-01 00:00:00")
    parser.add_argument("--rounds", type=int, default=10)
    parser.add_argument("--target-tokens", type=int, default=TARGET_TOKENS)
    parser.add_argument("--discovery-only", action="store_true")
    options = parser.parse_args(arguments)
    spark = (make or (lambda: SparkSession.builder.appName("tejido").getOrCreate()))()
    try:
        harvest = Harvest(spark, options.root)
        pages = spark.read.parquet(options.pages)
        catalog = readers.source_catalog(spark, open(options.sources).read()) if options.sources else None
        found = harvest.discover(catalog, items=pages.select("url", F.lit("landed").alias("source")))
        if options.discovery_only:
            found.groupBy("source").agg(F.count("*").alias("urls")).orderBy(F.col("urls").desc()).show(truncate=False)
            return 0
        harvest.populate(found, options.as_of)
        harvest.session(pages, options.as_of, options.rounds, options.target_tokens)
        print(json.dumps(harvest.status(), default=str))
        return 0
    except KeyboardInterrupt:
        return 130
    except (HarvestError, Conflict, readers.ConfigError, OSError) as error:
        print(error, file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
