"""The decision log: append-only rows, current state derived from it, alias and link upserts, learning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.functions import fixed
from tagloom.functions import text as T

FIELDS = ["scope", "rule_key", "decision", "brand_id", "brand_name", "nobrand_reason", "note"]


def latest(log: DataFrame, scope: str) -> DataFrame:
    """The last row of each key, without those revoked by it. Items are kept apart by site.

    One aggregate with map-side combining; a key with very many rows is no hot spot.
    """
    keys = ["rule_key"] if scope == "brand" else ["site", "rule_key"]
    rows = log.where(F.col("scope") == scope)
    rest = [c for c in log.columns if c not in keys]
    g = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "log_id").alias("r")).select(*keys, "r.*")
    return g.where(F.col("decision") != fixed.REVOKED)


def entry_fingerprint() -> Column:
    return T.fingerprint(*(F.col(c) for c in FIELDS))


class BatchError(ValueError):
    """A batch that may not be recorded; nothing of it is."""


def new_entries(log: DataFrame, entries: DataFrame, site: str) -> DataFrame:
    """The entries that change something, in their order `pos`; the whole batch is checked first.

    Raises BatchError for two different decisions on a key, or for an entry made against an older state.
    """
    e = entries.withColumn("fp", entry_fingerprint())
    clash = e.groupBy("scope", "rule_key").agg(F.countDistinct("fp").alias("n")).where("n > 1").select("rule_key").limit(1).collect()
    if clash:
        raise BatchError(f"{clash[0][0]}: conflicting decisions in one batch")
    state = latest(log, "brand").select("scope", "rule_key", "log_id", entry_fingerprint().alias("prev_fp"))
    state = state.unionByName(latest(log, "item").where(F.col("site") == site).select("scope", "rule_key", "log_id", entry_fingerprint().alias("prev_fp")))
    seen = e.join(state, ["scope", "rule_key"], "left")
    if "expected_log_id" in e.columns:
        stale = seen.where((F.col("expected_log_id") != F.col("log_id")) & (F.col("fp") != F.col("prev_fp"))).select("rule_key").limit(1).collect()
        if stale:
            raise BatchError(f"{stale[0][0]}: decided meanwhile; refresh the sheet")
    changed = seen.where(F.when(F.col("prev_fp").isNull(), F.col("decision") != fixed.REVOKED).otherwise(F.col("fp") != F.col("prev_fp")))
    first = Window.partitionBy("scope", "rule_key").orderBy("pos")
    return changed.withColumn("k", F.row_number().over(first)).where("k = 1").select(*e.columns)


def record(log: DataFrame, entries: DataFrame, site: str, level1: str, actor: str, at: Column | None = None) -> DataFrame:
    """The log with the batch appended; log ids go on from the last."""
    rows = new_entries(log, entries, site)
    top = log.agg(F.coalesce(F.max("log_id"), F.lit(0)).alias("m")).first()["m"]
    number = F.row_number().over(Window.orderBy("pos"))  # a batch is what one person typed into a sheet
    extra = {"log_id": F.lit(top).cast("long") + number, "site": F.lit(site), "level1": F.lit(level1), "actor": F.lit(actor), "logged_at": at if at is not None else F.current_timestamp()}
    rows = rows.withColumns({k: v for k, v in extra.items() if k in log.columns})
    return log.unionByName(rows.select(*(F.col(c) for c in log.columns if c in rows.columns)), allowMissingColumns=True)


def batch_counts(entries: DataFrame) -> tuple[int, int]:
    """How many entries were recorded, and in how many people agreed with the system."""
    agree = F.count_if(F.col("agree") == 1) if "agree" in entries.columns else F.lit(0)
    r = entries.agg(F.count("*").alias("n"), agree.alias("a")).first()
    return r["n"], r["a"]


RUN_COLUMNS = {"run_id": "long", "site": "string", "level1": "string", "ran_at": "timestamp", "goods": "long", "n_keys": "long", "imported": "long", "agreed": "long", "pending_keys": "long", "pending_goods": "long", "pool_goods": "long", "new_goods": "long", "none_goods": "long", "seconds": "double"}


def log_run(runs: DataFrame, results: DataFrame, site: str, ran_at: Column, imported: int = 0, agreed: int = 0, seconds: float | None = None) -> DataFrame:
    """The run log with a row for each category of the results; run ids go on from the last, by category."""
    key_confidence = F.min_by("confidence", "item_id")
    keys = results.groupBy("level1", "key").agg(F.count("*").alias("n"), key_confidence.alias("c"), *(F.count_if(F.col("outcome") == kind).alias(name) for name, kind in (("pool", fixed.POOL), ("new", fixed.NEW), ("none", fixed.NONE))))
    pending = F.coalesce(F.col("c"), F.lit(0)) < fixed.REVIEW_BELOW
    g = keys.groupBy("level1").agg(
        F.sum("n").alias("goods"), F.count("*").alias("n_keys"), F.count_if(pending).alias("pending_keys"), F.sum(F.when(pending, F.col("n")).otherwise(0)).alias("pending_goods"),
        F.sum("pool").alias("pool_goods"), F.sum("new").alias("new_goods"), F.sum("none").alias("none_goods"),
    )
    top = runs.agg(F.coalesce(F.max("run_id"), F.lit(0)).alias("m")).first()["m"]
    number = F.row_number().over(Window.orderBy("level1"))  # a row for each category
    extra = {"run_id": F.lit(top) + number, "site": F.lit(site), "ran_at": ran_at, "imported": F.lit(imported), "agreed": F.lit(agreed), "seconds": F.lit(seconds)}
    rows = g.withColumns(extra).select(*(F.col(c).cast(t).alias(c) for c, t in RUN_COLUMNS.items()))
    return runs.unionByName(rows, allowMissingColumns=True)


def alias_priority(source: Column) -> Column:
    out = F.lit(0)
    for name, p in fixed.ALIAS_PRIORITY.items():
        out = F.when(source == name, p).otherwise(out)
    return out


def promote_aliases(aliases: DataFrame, pairs: DataFrame) -> DataFrame:
    """(alias, brand_id, source): new pairs added, sources only ever raised."""
    both = aliases.select("alias", "brand_id", "source").unionByName(pairs.where("alias <> '' and brand_id is not null").select("alias", "brand_id", "source"))
    return both.groupBy("alias", "brand_id").agg(F.max_by("source", alias_priority(F.col("source"))).alias("source"))


def count_alias_changes(aliases: DataFrame, pairs: DataFrame) -> DataFrame:
    after, before = promote_aliases(aliases, pairs), aliases.select("alias", "brand_id", F.col("source").alias("old"))
    return after.join(before, ["alias", "brand_id"], "left").agg(F.count_if(F.col("old").isNull() | (F.col("old") != F.col("source"))).alias("changes"))


def insert_links(links: DataFrame, pairs: DataFrame) -> DataFrame:
    """Unordered pairs kept once, smaller id first; self links ignored."""
    new = pairs.select(F.least("a", "b").alias("brand_id_a"), F.greatest("a", "b").alias("brand_id_b")).where("brand_id_a < brand_id_b").distinct()
    new = new.join(links.select("brand_id_a", "brand_id_b"), ["brand_id_a", "brand_id_b"], "left_anti").withColumn("source", F.lit("curated"))
    return links.select("brand_id_a", "brand_id_b", "source").unionByName(new)


def history(log: DataFrame, key: str | None = None, limit: int = 20) -> DataFrame:
    return log.where(F.col("rule_key") == key).orderBy("log_id") if key else log.orderBy(F.desc("log_id")).limit(limit)


def migrate_legacy(old: DataFrame) -> DataFrame:
    """Rules of the earlier store as log rows, with today's outcome names."""
    return old.withColumn("decision", T.legacy_type(F.col("decision")))


def human_aliases(decisions: DataFrame) -> DataFrame:
    """(alias, brand_id, source) that people's confirmed pool decisions teach, from (raw_brand, decision, brand_id)."""
    rows = decisions.where((F.col("decision") == fixed.POOL) & F.col("brand_id").isNotNull() & ~T.blank(F.col("raw_brand"))).withColumn("full", T.normalize(T.clean_raw(F.col("raw_brand"))))
    lat, cjk = T.latin_part(F.col("full")), T.cjk_part(F.col("full"))
    names = F.array_distinct(F.filter(F.array("full", F.when(F.length(lat) >= 4, lat), F.when(F.length(cjk) >= 2, cjk)), lambda a: a.isNotNull() & (a != "")))
    return rows.select(F.explode(names).alias("alias"), F.col("brand_id").cast("long").alias("brand_id"), F.lit("human").alias("source")).distinct()


def automatic_aliases(results: DataFrame, keys: DataFrame) -> DataFrame:
    """(alias, brand_id, source) from confident bilingual results (raw_brand, confidence, outcome, brand_id); short initials teach nothing."""
    rows = results.where((F.col("confidence") >= 90) & (F.col("outcome") == fixed.POOL) & F.col("brand_id").isNotNull()).withColumn("raw", T.clean_raw(F.col("raw_brand"))).where(T.is_bilingual(F.col("raw")))
    rows = rows.withColumn("full", T.normalize(F.col("raw")))
    rows = rows.withColumns({"lat": T.latin_part(F.col("full")), "cjk": T.cjk_part(F.col("full"))}).where("not (cjk <> '' and length(lat) <= 3)")
    names = F.filter(F.array(F.when(F.length("lat") >= 4, F.col("lat")), F.when(F.length("cjk") >= 2, F.col("cjk"))), lambda a: a.isNotNull())
    pairs = rows.select(F.explode(names).alias("alias"), F.col("brand_id").cast("long").alias("brand_id")).distinct()
    return pairs.join(keys.select(F.col("key").alias("alias")).distinct(), "alias", "left_anti").withColumn("source", F.lit("auto"))
