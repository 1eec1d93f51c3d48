"""One object for a site's catalogue, and a thin command line."""

from __future__ import annotations

import argparse
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions import text as T
from tagloom.operators import decide, pool, report, review, store
from tagloom.plans.session import checkpointed
from tagloom.sources import catalogue


@dataclass
class Engine:
    """Items, brand list, aliases, links and decision log of a site; each method returns DataFrames.

    Aliases are frozen at the start of a run: what a run teaches is returned by `learned`, for the next one.
    """

    spark: SparkSession
    items: DataFrame
    pool: DataFrame
    aliases: DataFrame
    links: DataFrame
    log: DataFrame
    site: str = "site"

    def index(self) -> pool.Index:
        return pool.build_index(self.pool, self.aliases, self.links)

    def categories(self, names: list[str] | None = None) -> DataFrame:
        """Items of the named categories; unknown names are an error."""
        if not names:
            return self.items
        known = {r["l1"] for r in self.items.select("l1").distinct().where(F.col("l1").isin(names)).collect()}
        if missing := [n for n in names if n not in known]:
            raise ValueError(f"unknown categories: {missing}")
        return self.items.where(F.col("l1").isin(names))

    def tag(self, names: list[str] | None = None) -> DataFrame:
        rules, overrides = store.latest(self.log, "brand"), store.latest(self.log, "item").where(F.col("site") == self.site)
        out = decide.tag_items(self.categories(names), self.index(), rules, overrides.drop("site"))
        return out.withColumns({"site": F.lit(self.site), "level1": F.col("l1"), "raw_brand": F.col("brand")})

    def learned(self, results: DataFrame) -> DataFrame:
        """The aliases with what confident results teach."""
        return store.promote_aliases(self.aliases, store.automatic_aliases(results, self.index().keys))

    def review(self, results: DataFrame, sample: int = 30) -> DataFrame:
        """Each category's work-list: a row for each key, in the order to decide, with empty fields for people's decisions."""
        fields = ["raw_brand", "title", "confidence", "candidate1", "candidate2", "candidate3", "suggested_name", "suggested_id", "new_name", "no_brand_reason", "path", "explanation", "outcome", "brand_id"]
        keys = results.groupBy("level1", "key").agg(F.min_by(F.struct(*fields), "item_id").alias("r"), F.count("*").alias("goods")).select("level1", "key", "r.*", "goods")
        rules = store.latest(self.log, "brand").select(F.col("rule_key").alias("key"), F.col("decision").alias("d"), F.col("brand_id").alias("b"), F.col("brand_name").alias("n"), F.col("nobrand_reason").alias("reason"), F.col("note"), F.col("log_id").cast("string").alias("rule_version"))
        keys = keys.join(rules, "key", "left").withColumns({"ruled": F.col("d").isNotNull(), "agreed": F.coalesce((F.col("d") == F.col("outcome")) & F.col("b").eqNullSafe(F.col("brand_id")), F.lit(False)), "pick": review.prefill(F.col("d"), F.col("b"), F.col("n"))})
        drawn = review.review_sample(keys.select("level1", "key", "confidence", "goods", "ruled"), sample).select("level1", "key", F.lit(True).alias("sampled"))
        keys = keys.join(drawn, ["level1", "key"], "left").na.fill(False, ["sampled"]).na.fill("", ["reason", "note", "rule_version"])
        keys = keys.withColumns({"state": review.review_state(keys), "ambiguous": review.ambiguous(keys), "bracket": T.extract_bracket(F.col("title"))})
        open_ = keys.where(F.col("state").rlike("^[①②]")).select("key", F.when(F.trim(F.coalesce("raw_brand", F.lit(""))) != "", F.col("raw_brand")).otherwise(F.col("bracket")).alias("text")).where("text <> ''")
        groups = review.cluster_keys(open_.groupBy("key").agg(F.min("text").alias("text")))
        listed = review.work_list(keys.join(groups, "key", "left").na.fill("", ["grp"]), within="level1")
        return listed.withColumn("sampled", F.when(F.col("sampled"), "★").otherwise("")).drop("d", "b", "n", "ruled", "agreed")

    def read_back(self, sheet: DataFrame, items: DataFrame | None = None, level1: str = "ALL", actor: str = "review") -> tuple[int, int]:
        """Records what people typed into a review sheet (and an item sheet) and learns their aliases; (recorded, agreed).

        Any error stops the whole sheet.
        """
        entries = review.collect_decisions(sheet, self.index().parts, items)
        if bad := entries.where("error is not null").select("rule_key", "error").orderBy("rule_key").limit(20).collect():
            raise store.BatchError("\n".join(f"{r['rule_key']}: {r['error']}" for r in bad))
        return self._take(entries.drop("error"), level1, actor)

    def _take(self, entries: DataFrame, level1: str, actor: str) -> tuple[int, int]:
        entries = checkpointed(entries.withColumn("pos", F.struct("scope", "rule_key")))
        new = checkpointed(store.new_entries(self.log, entries, self.site))
        counts = store.batch_counts(new)
        self.log = checkpointed(store.record(self.log, entries, self.site, level1, actor))
        self.aliases = checkpointed(store.promote_aliases(self.aliases, store.human_aliases(entries.where("scope = 'brand'"))))
        return counts

    def bundle(self, sheet: DataFrame) -> DataFrame:
        """All categories' work-lists as one list for people: a row for each key, conflicts between categories first."""
        merged = review.merge_sheets(sheet.withColumn("category", F.col("level1")).withColumn("url", F.lit("")))
        extra = ["raw_brand", "confidence", "candidate1", "candidate2", "candidate3", "path", "explanation", "bracket", "pick", "reason", "note", "rule_version"]
        first = sheet.groupBy("key").agg(F.min_by(F.struct(*extra), "level1").alias("x"))
        rows = review.triage(review.fill_samples(merged, self.items)).join(first, "key").select("*", "x.*").drop("x")
        conflict = F.startswith("triage", F.lit("A"))
        return rows.withColumns({c: F.when(conflict, "").otherwise(F.col(c)) for c in ("pick", "reason", "note")})

    def import_bundle(self, rows: DataFrame, actor: str = "bundle") -> tuple[int, int]:
        """Records a filled-in bundle and learns its aliases; (recorded, agreed). Any error stops all of it."""
        return self._take(review.import_bundle(rows, self.index().parts), "ALL", actor)

    def curate(self, rows: DataFrame, link_rows: DataFrame) -> DataFrame:
        """Takes a curated list of aliases and links; returns the rows that were rejected, with reasons."""
        aliases, links, rejected = catalogue.curated(rows, link_rows, self.pool)
        self.aliases = checkpointed(store.promote_aliases(self.aliases, aliases))
        known = self.links if "source" in self.links.columns else self.links.withColumn("source", F.lit("curated"))
        self.links = checkpointed(store.insert_links(known, links))
        return rejected

    def status(self, runs: DataFrame) -> DataFrame:
        """Every category with its last run."""
        return report.run_status(catalogue.list_categories(self.items), runs.where(F.col("site") == self.site))

    def record(self, entries: DataFrame, level1: str, actor: str) -> DataFrame:
        return store.record(self.log, entries, self.site, level1, actor)

    def export(self, results: DataFrame, names: list[str] | None = None) -> DataFrame:
        return catalogue.export_items(self.items, results, names)

    def new_brands(self, results: DataFrame) -> DataFrame:
        return report.backlog(results)

    def summary(self, results: DataFrame) -> DataFrame:
        return report.executive_overview(results)

    def summary_tables(self, results: DataFrame) -> dict[str, DataFrame]:
        """The overview, the categories, what deciding pays, and the names most worth deciding."""
        return {"overview": report.executive_overview(results), "categories": report.category_overview(results), "payoff": report.payoff_curve(results), "top_names": report.backlog(results).where("rank <= 200")}

    def history(self, key: str | None = None, limit: int = 20) -> DataFrame:
        return store.history(self.log, key, limit)


SHEET_COLUMNS = ["level1", "position", "key", "state", "sampled", "grp", "raw_brand", "goods", "title", "suggested_name", "confidence", "candidate1", "candidate2", "candidate3", "pick", "reason", "note", "path", "explanation", "bracket", "suggested_id", "new_name", "no_brand_reason", "rule_version", "coverage"]


def main(argv: list[str] | None = None) -> None:
    """Works on tables below a folder: items, pool, aliases, links, decision_log, run_log, results (Parquet), review and bundle (CSV).

    tag reads the review sheet back, decides, learns, writes results and a new sheet, and logs the run.
    """
    p = argparse.ArgumentParser(prog="tagloom")
    p.add_argument("command", choices=["status", "tag", "history", "newbrands", "summary", "export", "review", "bundle-export", "bundle-import", "curate"])
    p.add_argument("--folder", required=True)
    p.add_argument("--config", help="TOML file with site, sample and columns")
    p.add_argument("--site")
    p.add_argument("--l1", nargs="*")
    p.add_argument("--key")
    p.add_argument("--file", help="curate: list of aliases; bundle-import: the filled-in bundle")
    p.add_argument("--links", help="curate: list of links")
    p.add_argument("--limit", type=int, default=20)
    a = p.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    config = catalogue.Config.read(a.config) if a.config else catalogue.Config()
    site, at = a.site or config.site, lambda t: f"{a.folder}/{t}"
    read = lambda t: catalogue.read_table(spark, at(t))
    e = Engine(spark, read("items"), read("pool"), read("aliases"), read("links"), read("decision_log"), site)
    runs = catalogue.read_table(spark, at("run_log"), ", ".join(f"{c} {t}" for c, t in store.RUN_COLUMNS.items()))
    keep = lambda: [catalogue.replace_table(df, at(t)) for t, df in (("decision_log", e.log), ("aliases", e.aliases))]
    if a.command == "tag":
        _tag(e, runs, a, config, at, keep)
    elif a.command == "status":
        e.status(runs).orderBy("l1").show(1000, truncate=False)
    elif a.command == "history":
        e.history(a.key, a.limit).show(a.limit, truncate=False)
    elif a.command == "curate":
        lists = [spark.read.csv(f, header=True) if f else spark.createDataFrame([], s) for f, s in ((a.file, "alias_text string, brand_id string, same_as string"), (a.links, "brand_id_a string, brand_id_b string"))]
        e.curate(*lists).show(1000, truncate=False)
        catalogue.replace_table(e.aliases, at("aliases"))
        catalogue.replace_table(e.links, at("links"))
    elif a.command == "bundle-import":
        print(e.import_bundle(_sheet(spark, a.file or at("bundle"))))
        keep()
    else:
        results = read("results").where(F.col("site") == site)
        if a.command == "bundle-export":
            catalogue.write_csv(e.bundle(e.review(results, config.sample)), at("bundle"))
        elif a.command == "summary":
            for name, df in e.summary_tables(results).items():
                catalogue.write_csv(df, at(f"summary/{name}"))
        else:
            out = {"newbrands": e.new_brands, "export": lambda r: e.export(r, a.l1), "review": lambda r: e.review(r, config.sample).select(*SHEET_COLUMNS)}[a.command](results)
            catalogue.write_csv(out, at(a.command))


def _sheet(spark: SparkSession, path: str) -> DataFrame | None:
    sheet = catalogue.read_review_sheet(spark, path)
    return None if sheet is None else sheet.na.fill("")


def _tag(e: Engine, runs: DataFrame, a: argparse.Namespace, config: catalogue.Config, at, keep) -> None:
    began, sheet = time.time(), _sheet(e.spark, at("review"))
    counts = (0, 0)
    if sheet is not None:
        chosen = sheet.where(F.col("level1").isin(a.l1)) if a.l1 else sheet
        # A key stands in several categories' lists; what is typed in one of them counts, unless two differ.
        counts = e.read_back(chosen.where("trim(pick) <> '' or trim(reason) <> ''").dropDuplicates(["key", "pick", "reason", "note"]))
        keep()
    results = checkpointed(e.tag(a.l1))
    e.aliases = checkpointed(e.learned(results))
    catalogue.upsert_results(results, at("results"))
    catalogue.write_csv(e.review(e.spark.read.parquet(at("results")).where(F.col("site") == e.site), config.sample).select(*SHEET_COLUMNS), at("review"))
    keep()
    catalogue.replace_table(store.log_run(runs, results, e.site, F.current_timestamp(), *counts, round(time.time() - began, 1)), at("run_log"))
    print(f"recorded {counts[0]}, agreed {counts[1]}")


if __name__ == "__main__":
    main()
