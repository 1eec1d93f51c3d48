"""Analytics over tagged items, review sheets, logs and runs. Numbers stay numbers; formatting belongs to the edge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.functions import fixed
from tagloom.functions import text as T
from tagloom.operators.order import running


def rate(condition: Column) -> Column:
    return F.avg(F.when(condition, 1.0).otherwise(0.0))


def _share_of_all(df: DataFrame, value: str) -> Column:
    """Share of a small grouped table's total."""
    return F.col(value) / F.greatest(F.sum(value).over(Window.partitionBy()), F.lit(1))


def type_by_band(items: DataFrame) -> DataFrame:
    g = items.groupBy(T.outcome_type(F.col("suggested_name")).alias("kind"), T.band(F.coalesce("confidence", F.lit(0))).alias("band")).agg(F.count("*").alias("goods"))
    return g.withColumn("share", _share_of_all(g, "goods"))


def path_distribution(keys: DataFrame) -> DataFrame:
    g = keys.groupBy("path").agg(F.count("*").alias("n_keys"), F.sum("goods").alias("goods"))
    return g.select("path", "n_keys", "goods", _share_of_all(g, "goods").alias("share")).orderBy(F.desc("goods"), "path")


def category_breakdown(items: DataFrame, dims: tuple[str, ...] = ("l2", "l3")) -> DataFrame:
    """One scan for all dimensions: rows are repeated for each and grouped once."""
    kind = T.outcome_type(F.col("suggested_name"))
    rows = items.select(kind.alias("kind"), "confidence", F.inline(F.array(*(F.struct(F.lit(d).alias("dim"), F.col(d).cast("string").alias("value")) for d in dims)))).where("value is not null")
    return rows.groupBy("dim", "value").agg(
        F.count("*").alias("goods"), rate(F.col("kind") == fixed.POOL).alias("pool_rate"), rate(F.col("kind") == fixed.NEW).alias("new_rate"), rate(F.col("kind") == fixed.NONE).alias("none_rate"),
        F.avg(F.col("confidence").cast("double")).alias("mean_confidence"), rate(F.col("confidence") < fixed.REVIEW_BELOW).alias("pending_rate"),
    )


def system_accuracy(log: DataFrame) -> DataFrame:
    """Agreement of people with the system by path, band, sample and category; plain and weighted by goods."""
    rows = log.where("scope = 'brand' and agree is not null")
    conf = F.coalesce(F.expr("try_cast(sys_conf as double)"), F.lit(0.0))
    dims = F.array(
        F.struct(F.lit("path").alias("dim"), F.nullif("sys_path", F.lit("")).alias("value")), F.struct(F.lit("band").alias("dim"), T.band(conf).alias("value")),
        F.struct(F.lit("sample").alias("dim"), F.when(F.col("sampled") == 1, "high/mid").alias("value")), F.struct(F.lit("l1").alias("dim"), F.coalesce("level1", F.lit("")).alias("value")),
    )
    rows = rows.select("agree", "goods", F.inline(dims)).where("value is not null")
    weighted = F.sum(F.col("agree") * F.col("goods")) / F.greatest(F.sum("goods"), F.lit(1))
    return rows.groupBy("dim", "value").agg(F.count("*").alias("reviewed"), F.sum("agree").alias("correct"), F.avg("agree").alias("accuracy"), weighted.alias("weighted_accuracy"))


def run_status(categories: DataFrame, runs: DataFrame) -> DataFrame:
    last = runs.groupBy("level1").agg(F.max_by(F.struct("ran_at", "n_keys", "pending_keys", "pending_goods", "goods", "pool_goods"), "run_id").alias("r"))
    g = F.greatest(F.col("r.goods"), F.lit(1))
    return categories.join(last, F.col("l1") == F.col("level1"), "left").select(
        "l1", F.col("goods"), F.col("skus"), F.date_format("r.ran_at", "yyyy-MM-dd HH:mm").alias("ran_at"), F.col("r.n_keys").alias("n_keys"), F.col("r.pending_keys").alias("pending_keys"),
        (F.col("r.pending_goods") / g).alias("pending_share"), (F.col("r.pool_goods") / g).alias("pool_share"),
    )


def backlog(items: DataFrame) -> DataFrame:
    """Names waiting for a decision over all categories, most goods first, with rank, cumulative share and proposed action."""
    new = F.col("suggested_name") == fixed.NEW
    rows = items.where((F.coalesce(F.col("confidence"), F.lit(0)) < fixed.REVIEW_BELOW) | new)
    name = F.trim(F.when(F.trim(F.coalesce("new_name", F.lit(""))) != "", F.col("new_name")).otherwise(F.coalesce("raw_brand", F.lit(""))))
    rows = rows.withColumn("name", name).where("name <> ''")
    mode = rows.groupBy("name", "suggested_name").agg(F.count("*").alias("n")).groupBy("name").agg(F.min_by("suggested_name", F.struct(-F.col("n"), "suggested_name")).alias("verdict"))
    by_item = lambda c: F.min_by(c, "item_id")
    g = rows.groupBy("name").agg(
        F.count("*").alias("goods"), F.count_distinct("level1").alias("n_l1"), F.array_join(F.slice(F.array_sort(F.collect_set("level1")), 1, 6), "、").alias("l1_list"),
        F.coalesce(F.min_by(F.when(F.trim("candidate1") != "", F.col("candidate1")), F.when(F.trim("candidate1") != "", F.col("item_id"))), F.lit("")).alias("nearest"),
        T.half_even(F.avg("confidence")).alias("mean_confidence"), by_item("title").alias("sample_title"),
    )
    g = g.join(mode, "name")
    g = g.join(ranked_shares(g.select("name", "goods")), ["name", "goods"])
    lang = T.language(F.col("name"))
    action = F.when(F.col("nearest") != "", fixed.ACTION_CHECK).when(lang == fixed.LANG_CJK, fixed.ACTION_PAIR).otherwise(fixed.ACTION_ADD)
    return g.select("rank", "name", "goods", "cumulative_share", "n_l1", "l1_list", lang.alias("lang"), action.alias("action"), "nearest", "verdict", "mean_confidence", "sample_title")


def ranked_shares(g: DataFrame) -> DataFrame:
    """Adds rank and cumulative_share by goods (desc), name. Ranges of this order are summed each in a task of its own."""
    out = running(g.withColumn("__o", -F.col("goods")), ["__o", "name"], "goods", add={"rank": "count", "__s": "sum"})
    return out.select("name", "goods", "rank", (F.col("__s") / F.col("total")).alias("cumulative_share"))


def backlog_summary(b: DataFrame) -> DataFrame:
    g = b.groupBy("action").agg(F.count("*").alias("brands"), F.sum("goods").alias("goods"))
    return g.select("action", "brands", "goods", _share_of_all(g, "goods").alias("share"))


def coverage_at(b: DataFrame, steps: tuple[int, ...] = fixed.STEPS[:5]) -> DataFrame:
    return b.where(F.col("rank").isin(list(steps))).select(F.col("rank").alias("n"), "cumulative_share")


def executive_overview(items: DataFrame) -> DataFrame:
    conf, kind = F.coalesce("confidence", F.lit(0)), T.outcome_type(F.col("suggested_name"))
    tests = {"all": F.lit(True), "automatic": conf >= 75, "pending": conf < 75, "pool": kind == fixed.POOL, "new": kind == fixed.NEW, "none": kind == fixed.NONE, "conf_90": conf >= 90, "conf_75_89": conf.between(75, 89)}
    one = items.agg(F.count("*").alias("t"), F.avg(conf.cast("double")).alias("m"), *(F.count_if(v).alias(f"c_{k}") for k, v in tests.items()))
    rows = [F.struct(F.lit(k).alias("label"), F.col(f"c_{k}").cast("double").alias("value"), (F.col(f"c_{k}") / F.greatest("t", F.lit(1))).alias("share")) for k in tests]
    rows.append(F.struct(F.lit("mean_confidence").alias("label"), F.col("m").alias("value"), F.lit(None).cast("double").alias("share")))
    return one.select(F.inline(F.array(*rows)))


def category_overview(items: DataFrame) -> DataFrame:
    kind, conf = T.outcome_type(F.col("suggested_name")), F.coalesce("confidence", F.lit(0))
    g = items.groupBy("level1").agg(F.count("*").alias("goods"), rate(conf >= 75).alias("automatic"), rate(kind == fixed.POOL).alias("pool"), rate(kind == fixed.NEW).alias("new"), rate(kind == fixed.NONE).alias("none"), F.count_if(conf < 75).alias("pending"))
    return g.orderBy(F.desc("goods"), "level1")


def payoff_curve(items: DataFrame, steps: tuple[int, ...] = fixed.STEPS) -> DataFrame:
    """Goods solved by deciding the n names with most pending goods."""
    conf = F.coalesce("confidence", F.lit(0))
    name = F.trim(F.when(F.trim(F.coalesce("new_name", F.lit(""))) != "", F.col("new_name")).otherwise(F.coalesce("raw_brand", F.lit(""))))
    totals = items.agg(F.count("*").alias("t"), F.count_if(conf >= 75).alias("auto"), F.count_if(conf < 75).alias("pending")).first()
    g = items.where(conf < 75).groupBy(name.alias("name")).agg(F.count("*").alias("goods")).where("name <> ''")
    r = ranked_shares(g)
    all_goods = g.agg(F.sum("goods").alias("n")).first()["n"] or 0
    r = r.where(F.col("rank").isin(list(steps))).withColumn("covered", F.round(F.col("cumulative_share") * all_goods, 0).cast("long"))
    return r.select(F.col("rank").cast("long").alias("n"), "covered", (F.col("covered") / max(totals["pending"], 1)).alias("of_pending"), ((F.lit(totals["auto"]) + F.col("covered")) / max(totals["t"], 1)).alias("of_all"))


def new_suggestions(keys: DataFrame) -> DataFrame:
    rows = keys.where(F.col("suggested_name") == fixed.NEW)
    return rows.select("new_name", "raw_brand", "goods", "confidence", "path", F.col("candidate1").alias("nearest"), "title").orderBy(F.desc("goods"), "raw_brand")


def store_audit(items: DataFrame, results: DataFrame, log: DataFrame) -> DataFrame:
    """Labelled counts: coverage, missing and orphan rows, decisions."""
    r = results.agg(F.count("*").alias("results"), F.count_distinct("item_id").alias("distinct_items"), F.count_distinct("level1").alias("categories"))
    missing = items.join(results.select("item_id").distinct(), "item_id", "left_anti").agg(F.count("*").alias("missing_results"))
    orphan = results.join(items.select("item_id").distinct(), "item_id", "left_anti").agg(F.count("*").alias("orphan_results"))
    one = [r, items.agg(F.count("*").alias("source_rows")), missing, orphan, log.agg(F.count("*").alias("decisions"))]
    out = [df.select(F.explode(F.array(*(F.struct(F.lit(c).alias("label"), F.col(c).cast("long").alias("value")) for c in df.columns))).alias("x")).select("x.*") for df in one]
    for df in out[1:]:
        out[0] = out[0].unionByName(df)
    return out[0]


def short_abbreviation_risk(items: DataFrame, parts: DataFrame, aliases: DataFrame) -> DataFrame:
    """Groups of items with CJK and one to three Latin characters, matched to a brand of equal Latin and other CJK name without human support."""
    raw = T.clean_raw(F.col("raw_brand"))
    df = items.withColumn("source_name", F.when(raw != "", raw).otherwise(T.extract_bracket(F.col("title")))).withColumn("norm", T.normalize(F.col("source_name")))
    df = df.withColumns({"latin": T.latin_part(F.col("norm")), "chinese": T.cjk_part(F.col("norm"))}).where("length(latin) between 1 and 3 and chinese <> ''")
    p = parts.select("brand_id", F.col("lat").alias("pl"), F.col("cjk").alias("pc"), F.col("name").alias("matched_name"))
    df = df.join(p, "brand_id").where(~F.col("brand_id").isin(fixed.SPECIAL_IDS) & (F.col("latin") == F.col("pl")) & (F.col("chinese") != F.col("pc")))
    trusted = aliases.where(F.col("source").isin("human", "curated")).select(F.col("alias"), "brand_id")
    df = df.join(trusted.withColumnRenamed("alias", "norm"), ["norm", "brand_id"], "left_anti").join(trusted.withColumnRenamed("alias", "chinese"), ["chinese", "brand_id"], "left_anti")
    return df.groupBy("norm", "brand_id").agg(
        F.min("latin").alias("latin"), F.min("chinese").alias("chinese"), F.min("matched_name").alias("matched_name"), F.count("*").alias("goods"),
        F.array_join(F.array_sort(F.collect_set("level1")), "|").alias("categories"), F.min("confidence").alias("confidence_min"), F.max("confidence").alias("confidence_max"),
    )


def run_totals(runs: DataFrame) -> DataFrame:
    s = runs.agg(*(F.sum(c).alias(c) for c in ("goods", "n_keys", "pending_keys", "pending_goods", "pool_goods")))
    return s.select("*", (F.col("pending_goods") / F.greatest("goods", F.lit(1))).alias("pending_share"), (F.col("pool_goods") / F.greatest("goods", F.lit(1))).alias("pool_share"))
