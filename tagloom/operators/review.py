"""The human review loop: typed decisions, work-list, clusters, cross-category merge."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.functions import fixed
from tagloom.functions import text as T
from tagloom.operators.order import global_row_number, running
from tagloom.operators.pool import resolve_input


def parse_human(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """Adds h_decision, h_brand_id, h_brand_name, h_reason, h_note, h_error, h_raw to review rows.

    rows: pick, reason, note, suggested_name, suggested_id, new_name, no_brand_reason, candidate1 to candidate3, raw_brand, bracket.
    A row that nobody filled in has neither a decision nor an error.
    """
    text = lambda c: F.when(T.blank(F.col(c)), F.lit("")).otherwise(F.trim(F.col(c).cast("string")))
    df = rows.withColumns({"__v": text("pick"), "__why": text("reason"), "h_note": text("note")})
    df = df.withColumn("__filled", (F.col("__v") != "") | (F.col("__why") != ""))
    number = F.when(F.col("__v").rlike(r"^[123](\.0)?$"), F.substring("__v", 1, 1).cast("int"))
    df = df.withColumn("__n", number)
    df = df.withColumn("__cand", F.when(F.col("__n").isNotNull(), F.get(F.array(*(text(f"candidate{k}") for k in (1, 2, 3))), F.col("__n") - 1)))
    df = df.withColumn("__t", F.when(F.col("__n").isNotNull(), F.col("__cand")).otherwise(F.col("__v")))
    t, v = F.col("__t"), F.lower("__v")
    suggested = F.when(text("suggested_name").isin(fixed.NONE, fixed.NEW), text("suggested_name")).otherwise(fixed.POOL)
    after_colon = F.trim(F.regexp_extract(t, r"(?s)^[^:：]*[:：](.*)$", 1))
    fallback = F.coalesce(*(F.when(~T.blank(F.col(c)), F.nullif(T.clean_raw(F.col(c)), F.lit(""))) for c in ("new_name", "raw_brand", "bracket")), F.lit(""))
    begins_new = functools.reduce(lambda a, b: a | b, (F.startswith(t, F.lit(p)) for p in fixed.NEW_PREFIXES))
    kind = (
        F.when(~F.col("__filled"), F.lit(None))
        .when(v.isin(fixed.REVOKE_WORDS), "revoke")
        .when(v.isin(fixed.ACCEPT_WORDS), F.when(suggested == fixed.POOL, F.when(text("suggested_id") == "", "no_id").otherwise("accept_pool")).when(suggested == fixed.NEW, "accept_new").otherwise("accept_none"))
        .when(F.col("__n").isNotNull() & (F.col("__cand") == ""), "no_candidate")
        .when((t == "") | T.normalize(t).isin(fixed.NO_BRAND_WORDS) | (t == fixed.NONE), "none")
        .when(begins_new, F.when(F.coalesce(F.nullif(after_colon, F.lit("")), fallback) == "", "no_name").otherwise("new"))
        .otherwise("resolve")
    )
    df = df.withColumn("__kind", kind).withColumn("__typed", F.when(F.col("__kind") == "resolve", t))
    found = resolve_input(df.where("__typed is not null").select("__typed").distinct(), parts, "__typed").select(F.col("__typed").alias("__r"), F.col("brand_id").alias("__rid"), F.col("error").alias("__err"))
    names = parts.select(F.col("brand_id").alias("__rid"), F.col("name").alias("__rname"))
    df = df.join(found.join(names, "__rid", "left"), F.col("__typed") == F.col("__r"), "left")
    k = F.col("__kind")
    decision = F.when(k == "revoke", fixed.REVOKED).when(k.isin("accept_pool"), fixed.POOL).when(k.isin("accept_new", "new"), fixed.NEW).when(k.isin("accept_none", "none"), fixed.NONE).when((k == "resolve") & F.col("__err").isNull(), fixed.POOL)
    brand = F.when(k == "accept_pool", F.expr("try_cast(suggested_id as double)").cast("long")).when(k.isin("accept_none", "none"), F.lit(0).cast("long")).when(k == "resolve", F.col("__rid"))
    name = (
        F.when(k == "revoke", "").when(k == "accept_pool", text("suggested_name")).when(k == "accept_new", text("new_name")).when(k.isin("accept_none", "none"), fixed.NONE)
        .when(k == "new", F.coalesce(F.nullif(after_colon, F.lit("")), fallback)).when((k == "resolve") & F.col("__err").isNull(), F.col("__rname"))
    )
    why = F.when(k == "accept_none", F.coalesce(F.nullif("__why", F.lit("")), text("no_brand_reason"))).when(k == "none", F.coalesce(F.nullif("__why", F.lit("")), F.lit(fixed.HUMAN_REASON))).when(decision.isNotNull(), "")
    error = (
        F.when(k == "no_id", "系統沒有建議 brand id，請直接填品牌名或 brand_id")
        .when(k == "no_candidate", F.concat(F.lit("沒有第 "), F.col("__n").cast("string"), F.lit(" 個候選")))
        .when(k == "no_name", "請寫成「新增:品牌名」")
        .when(k == "resolve", F.col("__err"))
    )
    raw = F.when(F.col("__filled"), F.when(F.col("__v") != "", F.col("__v")).otherwise(F.col("__why")))
    return df.select(*rows.columns, decision.alias("h_decision"), brand.alias("h_brand_id"), name.alias("h_brand_name"), why.alias("h_reason"), "h_note", error.alias("h_error"), raw.alias("h_raw"))


def collect_decisions(sheet: DataFrame, parts: DataFrame, items: DataFrame | None = None) -> DataFrame:
    """Log entries from a review sheet (and a sheet of single items): scope, key, decision, what the system had said, agreement."""
    df = parse_human(sheet, parts).where("h_decision is not null or h_error is not null")
    kind = T.outcome_type(F.coalesce("suggested_name", F.lit("")))
    system_id = F.expr("try_cast(suggested_id as double)").cast("long")
    agree = (F.col("h_decision") == kind) & ((F.col("h_decision") != fixed.POOL) | F.col("h_brand_id").eqNullSafe(system_id))
    out = df.select(
        F.lit("brand").alias("scope"), F.trim("key").alias("rule_key"), F.col("h_decision").alias("decision"), F.col("h_brand_id").alias("brand_id"), F.col("h_brand_name").alias("brand_name"),
        F.col("h_reason").alias("nobrand_reason"), F.col("h_note").alias("note"), "raw_brand", kind.alias("sys_decision"), system_id.alias("sys_brand_id"), T.path_code(F.col("path")).alias("sys_path"),
        F.col("confidence").cast("string").alias("sys_conf"), (F.col("sampled") == "★").cast("int").alias("sampled"), F.col("goods").cast("long").alias("goods"), agree.cast("int").alias("agree"), F.col("h_error").alias("error"),
    )
    if items is None:
        return out
    one = parse_human(items, parts).where("h_decision is not null or h_error is not null")
    null = lambda t: F.lit(None).cast(t)
    single = one.select(
        F.lit("item").alias("scope"), F.trim("item_id").alias("rule_key"), F.col("h_decision").alias("decision"), F.col("h_brand_id").alias("brand_id"), F.col("h_brand_name").alias("brand_name"),
        F.col("h_reason").alias("nobrand_reason"), F.col("h_note").alias("note"), "raw_brand", null("string").alias("sys_decision"), null("long").alias("sys_brand_id"), F.lit("").alias("sys_path"),
        F.lit("").alias("sys_conf"), F.lit(0).alias("sampled"), F.lit(1).cast("long").alias("goods"), null("int").alias("agree"), F.col("h_error").alias("error"),
    )
    return out.unionByName(single)


def prefill(decision: Column, brand_id: Column, brand_name: Column) -> Column:
    """A recorded decision as people would type it."""
    named = F.when(brand_name != "", F.concat(F.lit(f"{fixed.NEW}:"), brand_name)).otherwise(fixed.NEW)
    return F.when(decision.isNull(), "").when(decision == fixed.POOL, T.label(brand_name, brand_id)).when(decision == fixed.NEW, named).otherwise(fixed.NONE)


def review_sample(keys: DataFrame, n: int = 30, seed: int = 42, within: str = "level1") -> DataFrame:
    """Keys (within, key, confidence, goods, ruled) drawn for a check: up to n in each of two confidence strata of each category,
    without replacement, weighted by the root of goods.

    The n smallest of -ln(u) / weight have this law; u comes from a hash of the key, so reruns agree. The first n of a
    stratum are found in each task before any exchange.
    """
    rows = keys.where((F.col("confidence") >= fixed.REVIEW_BELOW) & ~F.col("ruled") & (F.col("goods") >= 3)).withColumn("stratum", F.when(F.col("confidence") < 90, 75).otherwise(90))
    u = (F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), "key")), 1, 13), 16, 10).cast("long") + 0.5) / 2**52
    first = Window.partitionBy(within, "stratum").orderBy("draw", "key")
    return rows.withColumn("draw", -F.log(u) / F.sqrt("goods")).withColumn("k", F.row_number().over(first)).where(F.col("k") <= n).drop("draw", "k")


def review_state(df: DataFrame) -> Column:
    """State of rows with ruled, agreed, confidence, sampled."""
    return (
        F.when(F.col("ruled") & F.col("agreed"), fixed.STATE_AGREED).when(F.col("ruled"), fixed.STATE_FIXED)
        .when(F.col("confidence") < fixed.REVIEW_BELOW, fixed.STATE_PENDING).when(F.col("sampled"), fixed.STATE_SAMPLE).otherwise(fixed.STATE_AUTO)
    )


def ambiguous(df: DataFrame) -> Column:
    return (F.col("confidence") >= 90) & (F.trim(F.coalesce("candidate2", F.lit(""))) != "")


def work_list(rows: DataFrame, within: str | None = None) -> DataFrame:
    """Adds position and running coverage (in each category, if `within` names its column): by state, the group's largest
    count, the group, the count, the key.

    Positions and sums run over ranges of this order, each range in a task of its own; groups give only their largest counts.
    """
    state = F.array_position(F.array(*map(F.lit, fixed.STATE_ORDER)), F.col("state"))
    single = F.col("grp") == ""
    block = F.when(single, F.concat(F.lit("k"), "key")).otherwise(F.concat(F.lit("g"), "grp"))
    own = F.coalesce(F.col(within).cast("string"), F.lit("")) if within else F.lit("")
    df = rows.withColumn("o0", own)
    tops = df.where("grp <> ''").groupBy("o0", "grp").agg(F.max("goods").alias("__top"))
    most = df.where("grp <> ''").groupBy("o0", "state", "grp").agg(F.max("goods").alias("__most"))
    df = df.join(tops, ["o0", "grp"], "left").join(most, ["o0", "state", "grp"], "left")
    df = df.withColumns({"o1": state, "o2": -F.coalesce("__top", "goods"), "o3": F.col("grp"), "o4": -F.coalesce("__most", "goods"), "o5": block, "o6": -F.col("goods"), "o7": F.col("key")})
    out = running(df, [f"o{k}" for k in range(8)], "goods", add={"position": "count", "covered": "sum"}).drop("total")
    before = Window.orderBy("o0").rowsBetween(Window.unboundedPreceding, -1)  # a row for each category
    per = df.groupBy("o0").agg(F.count("*").alias("n"), F.sum("goods").alias("total"))
    per = per.select("o0", "total", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("n", "total")))
    out = out.join(per, "o0").withColumns({"position": F.col("position") - F.col("n_before"), "coverage": (F.col("covered") - F.col("total_before")) / F.greatest("total", F.lit(1))})
    return out.select(*rows.columns, "position", "coverage")


def block_edges(texts: DataFrame, least: int = 70, most: int = 60) -> DataFrame:
    """(a, b): keys that are alike, each block's first key with its other members. texts: (key, text)."""
    df = texts.withColumn("full", T.normalize(T.clean_raw(F.col("text"))))
    df = df.withColumns({"lat": T.latin_part(F.col("full")), "cjk": T.cjk_part(F.col("full"))})
    source = F.when(F.col("lat") != "", F.col("lat")).otherwise(F.col("full"))
    latin = F.transform(F.filter(F.regexp_extract_all(source, F.lit("[a-z0-9]+"), F.lit(0)), lambda t: (F.length(t) >= 4) & ~t.isin(fixed.STOP_TOKENS)), lambda t: F.concat(F.lit("L:"), t))
    ends = F.filter(F.array(F.substring("cjk", 1, 2), F.expr("right(cjk, 2)")), lambda p: (F.length("cjk") >= 2) & ~p.isin(fixed.CLUSTER_STOP))
    df = df.select("key", "full", F.explode(F.array_distinct(F.concat(latin, F.transform(ends, lambda p: F.concat(F.lit("C:"), p))))).alias("block"))
    first = df.groupBy("block").agg(F.min_by(F.struct("key", "full"), "key").alias("f"), F.count("*").alias("n")).where(F.col("n").between(2, most))
    pairs = df.join(first, "block").where(F.col("key") != F.col("f.key"))
    return pairs.where(T.indel_ratio(F.col("f.full"), F.col("full")) >= least).select(F.col("f.key").alias("a"), F.col("key").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(key, root) by repeated minimum labels with pointer jumping; checkpoints keep plans short."""
    from tagloom.plans.session import checkpointed

    both = checkpointed(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = both.groupBy(F.col("a").alias("key")).agg(F.least(F.min("b"), F.first("a")).alias("root"))
    while True:
        near = both.join(labels.withColumnRenamed("key", "b"), "b").groupBy(F.col("a").alias("key")).agg(F.min("root").alias("near"))
        jump = labels.select(F.col("key").alias("root"), F.col("root").alias("up"))
        moved = labels.join(near, "key").join(jump, "root", "left").select("key", F.least("root", "near", F.coalesce("up", "root")).alias("new"), "root")
        moved = checkpointed(moved)
        done = moved.where("new <> root").isEmpty()
        labels = moved.select("key", F.col("new").alias("root"))
        if done:
            return labels


def cluster_keys(texts: DataFrame) -> DataFrame:
    """(key, grp): groups of alike keys, numbered by size (then first key); keys that stand alone are left out."""
    labels = components(block_edges(texts))
    sizes, _ = global_row_number(labels.groupBy("root").agg((-F.count("*")).alias("n")), "n", "root")
    return labels.join(sizes, "root").select("key", F.format_string("G%04d", "row").alias("grp"))


def override_sheet(items: DataFrame, overrides: DataFrame) -> DataFrame:
    o = overrides.select(F.col("rule_key").alias("item_id"), prefill(F.col("decision"), F.col("brand_id"), F.col("brand_name")).alias("pick"), F.coalesce("nobrand_reason", F.lit("")).alias("reason"), F.coalesce("note", F.lit("")).alias("note"))
    return items.select("item_id", F.col("brand").alias("raw_brand"), "title", "suggested_name", "suggested_id").join(o, "item_id")


def merge_sheets(sheets: DataFrame) -> DataFrame:
    """One row for each key over all categories' sheets: (category, key, state, sampled, goods, outcome fields, title, url).

    Display columns come from the first category by name. Everything is combined on the map side.
    """
    outcome = F.struct(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("suggested_name", "suggested_id", "new_name", "no_brand_reason")))
    advice = F.concat("category", F.lit(": "), outcome["suggested_name"], F.lit(" ["), outcome["suggested_id"], F.lit("] "), outcome["new_name"])
    has = lambda mark: F.bool_or(F.startswith("state", F.lit(mark)))
    g = sheets.where(F.trim(F.coalesce("key", F.lit(""))) != "").groupBy(F.trim("key").alias("key")).agg(
        F.min_by(F.struct(outcome.alias("o"), "title", "url"), "category").alias("f"), F.sum("goods").alias("goods"), F.array_join(F.array_sort(F.collect_set("category")), "、").alias("categories"),
        has("①").alias("pending"), has("②").alias("sample"), has("③").alias("done"), F.bool_or(F.coalesce(F.col("sampled") == "★", F.lit(False))).alias("starred"),
        (F.count_distinct(outcome) > 1).alias("conflict"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("category", advice.alias("a")))), lambda x: x["a"]), "；").alias("advice"),
    )
    return g.select("key", "f.o.*", F.col("f.title").alias("title"), F.col("f.url").alias("url"), *(c for c in g.columns if c not in ("key", "f")))


def fill_samples(merged: DataFrame, goods: DataFrame, url_pattern: str = "https://example.org/item/%s") -> DataFrame:
    """Titles and links for keys without, from their first item (item_id order)."""
    keyed = goods.withColumn("key", T.brand_key(F.col("brand"), F.col("title"), F.col("item_id")))
    first = keyed.groupBy("key").agg(F.min_by(F.struct(F.coalesce("title", F.lit("")).alias("t"), F.coalesce(F.nullif("url", F.lit("")), F.format_string(url_pattern, "item_id")).alias("u")), "item_id").alias("s"))
    use = lambda c, k: F.coalesce(F.nullif(F.col(c), F.lit("")), F.col("s")[k])
    return merged.join(first, "key", "left").withColumns({"title": use("title", "t"), "url": use("url", "u")}).drop("s")


def triage(merged: DataFrame) -> DataFrame:
    """Adds class, state and scope: conflicts first, then new brands, single items, no brand, known brands."""
    new, none = F.col("suggested_name") == fixed.NEW, F.col("suggested_name") == fixed.NONE
    kind = F.when(F.col("conflict"), "A").when(new, "B").when(F.startswith("key", F.lit("I:")), "C").when(none, "D").otherwise("E")
    state = F.when(F.col("pending"), fixed.STATE_PENDING).when(F.col("sample"), fixed.STATE_SAMPLE).when(F.col("done"), fixed.STATE_AGREED).otherwise(fixed.STATE_AUTO)
    forced = F.col("conflict") | (new & ~F.startswith(state, F.lit("③")))
    label = F.lit(None).cast("string")
    for k, v in fixed.TRIAGE.items():
        label = F.when(kind == k, v).otherwise(label)
    scope = F.when(F.startswith("key", F.lit("I:")), F.concat(F.lit("僅此品號 "), F.expr("substring(key, 3)"))).otherwise("全站相同 key；不同商品品牌須改用單品覆蓋")
    return merged.withColumns({"triage": label, "state": F.when(forced, fixed.STATE_PENDING).otherwise(state), "scope_note": scope, "starred": F.when(F.col("starred"), "★").otherwise("")}).drop("pending", "sample", "done")


def import_bundle(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """Log entries from a filled-in bundle, with what the system had said; raises BatchError for any error, a lost key, or a
    decision on a conflict row, and then nothing of it is recorded."""
    from tagloom.operators.store import BatchError

    df = parse_human(rows, parts)
    filled = F.col("h_decision").isNotNull() | F.col("h_error").isNotNull()
    error = F.coalesce("h_error", F.when(T.blank(F.col("key")), F.lit(fixed.LOST_KEY)), F.when(F.startswith("triage", F.lit("A")), F.lit(fixed.CONFLICT_ROW)))
    bad = df.where(filled & error.isNotNull()).select(F.coalesce("key", F.lit("")).alias("key"), error.alias("e")).orderBy("key").limit(20).collect()
    if bad:
        raise BatchError("\n".join(f"{r['key']}: {r['e']}" for r in bad))
    kind = T.outcome_type(F.coalesce("suggested_name", F.lit("")))
    system_id = F.expr("try_cast(suggested_id as double)").cast("long")
    agree = (F.col("h_decision") == kind) & ((F.col("h_decision") != fixed.POOL) | F.col("h_brand_id").eqNullSafe(system_id))
    own = {"expected_log_id": F.coalesce(F.expr("try_cast(rule_version as double)").cast("long"), F.lit(0)) if "rule_version" in rows.columns else None, "goods": F.col("goods").cast("long") if "goods" in rows.columns else None}
    entries = df.where("h_decision is not null").select(
        F.lit("brand").alias("scope"), F.trim("key").alias("rule_key"), F.col("h_decision").alias("decision"), F.col("h_brand_id").alias("brand_id"), F.col("h_brand_name").alias("brand_name"), F.col("h_reason").alias("nobrand_reason"),
        F.col("h_note").alias("note"), "raw_brand", kind.alias("sys_decision"), system_id.alias("sys_brand_id"), agree.cast("int").alias("agree"), *(v.alias(k) for k, v in own.items() if v is not None),
    )
    return entries
