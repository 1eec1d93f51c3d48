"""The brand list as tables: typed brands, keys with provenance, links, tokens, and lookup of what people type."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.functions import fixed
from tagloom.functions import text as T
from tagloom.plans.session import checkpointed


def typed_pool(raw: DataFrame, category_col: str | None = "category") -> DataFrame:
    """(brand_id, name, category, adg) from a table of strings with brand_id and brand_name.

    Rows without a numeric id are dropped, names trimmed, thousands separators removed, bad sales set to 0;
    of equal ids the first row stays (by `pos` if there is one, else by the row's content).
    """
    number = F.expr("try_cast(brand_id as double)").cast("long")
    adg = F.coalesce(F.expr("try_cast(replace(adg, ',', '') as double)"), F.lit(0.0)) if "adg" in raw.columns else F.lit(0.0)
    category = F.coalesce(F.col(category_col), F.lit("")) if category_col in raw.columns else F.lit("")
    order = F.col("pos") if "pos" in raw.columns else F.struct("brand_name", category, adg)
    rows = raw.select(number.alias("brand_id"), F.trim("brand_name").alias("name"), category.alias("category"), adg.alias("adg"), order.alias("o")).where("brand_id is not null")
    return rows.groupBy("brand_id").agg(F.min_by(F.struct("name", "category", "adg"), "o").alias("r")).select("brand_id", "r.*")


def not_special(c: Column) -> Column:
    return ~c.isin(fixed.SPECIAL_IDS)


def with_parts(pool: DataFrame) -> DataFrame:
    """Adds full, lat, cjk and surface keys, and the product-line flags."""
    df = pool.withColumn("full", T.normalize(F.col("name")))
    df = df.withColumns({"lat": T.latin_part(F.col("full")), "cjk": T.cjk_part(F.col("full")), "surface": T.surface_key(F.col("name"))})
    return df.withColumns({"is_apple": F.col("full").isin(fixed.APPLE_NAMES), "is_line": F.col("full").rlike(f"^(?:{fixed.APPLE_PRODUCT})$")})


def natural_keys(parts: DataFrame) -> DataFrame:
    """(key, brand_id): full, Latin and CJK names of two characters or more, or whole names of one."""
    keys = F.array_distinct(F.filter(F.array("full", "lat", "cjk"), lambda a: (F.length(a) >= 2) | ((a != "") & (a == F.col("full")))))
    return parts.where(not_special(F.col("brand_id"))).select(F.explode(keys).alias("key"), "brand_id")


def key_index(parts: DataFrame, aliases: DataFrame) -> DataFrame:
    """(key, brand_id, human, curated, auto, natural): automatic aliases count only where no name gives the key."""
    valid = aliases.join(parts.where(not_special(F.col("brand_id"))).select("brand_id"), "brand_id", "left_semi")
    named = natural_keys(parts).select("key", "brand_id", F.lit("natural").alias("source"))
    rows = named.unionByName(valid.select(F.col("alias").alias("key"), "brand_id", "source"))
    has = lambda s: F.bool_or(F.col("source") == s)
    return rows.groupBy("key", "brand_id").agg(has("human").alias("human"), has("curated").alias("curated"), (has("auto") & ~has("natural")).alias("auto"), has("natural").alias("natural"))


def entity_links(parts: DataFrame, links: DataFrame) -> DataFrame:
    """(brand_id, peer) in both directions, for links between two different known brands."""
    ids = parts.select("brand_id")
    known = links.where("brand_id_a <> brand_id_b").join(ids.withColumnRenamed("brand_id", "brand_id_a"), "brand_id_a", "left_semi").join(ids.withColumnRenamed("brand_id", "brand_id_b"), "brand_id_b", "left_semi")
    one = known.select(F.col("brand_id_a").alias("brand_id"), F.col("brand_id_b").alias("peer"))
    return one.unionByName(one.select(F.col("peer").alias("brand_id"), F.col("brand_id").alias("peer"))).distinct()


def token_index(parts: DataFrame) -> DataFrame:
    return parts.where(not_special(F.col("brand_id"))).select(F.explode(T.latin_tokens(F.col("name"))).alias("token"), "brand_id")


def long_keys(keys: DataFrame) -> DataFrame:
    """Keys that may be found inside a text."""
    return keys.where(T.long_enough(F.col("key")) & ~F.col("key").isin([*fixed.GENERIC_KEYS, *fixed.STOP_TOKENS]))


def prefix_buckets(parts: DataFrame) -> DataFrame:
    return parts.where(not_special(F.col("brand_id")) & (F.length("cjk") >= 3)).select(F.substring("cjk", 1, 2).alias("bucket"), "cjk", "brand_id")


@dataclass(frozen=True)
class Index:
    """The brand list's tables. Joins against them are planned by size: small ones are broadcast by Catalyst, large ones shuffled."""

    parts: DataFrame
    keys: DataFrame
    links: DataFrame
    tokens: DataFrame
    long: DataFrame


def build_index(pool: DataFrame, aliases: DataFrame, links: DataFrame) -> Index:
    # The tables serve many joins; they are computed once.
    parts = checkpointed(with_parts(pool))
    keys = checkpointed(key_index(parts, aliases))
    return Index(parts, keys, entity_links(parts, links), token_index(parts), long_keys(keys))


def resolve_input(typed: DataFrame, parts: DataFrame, col: str = "typed") -> DataFrame:
    """Adds brand_id or error to what people typed: `name [id]`, an id, or a unique name."""
    t = F.trim(F.col(col))
    inside = F.regexp_extract(t, r"\[(\d+)\]\s*$", 1)
    df = typed.withColumn("__t", F.when(inside != "", inside).otherwise(t))
    df = df.withColumn("__id", F.when(F.col("__t").rlike(r"^\d+(\.0)?$"), F.expr("try_cast(__t as double)").cast("long")))
    df = df.withColumn("__n", F.when(F.col("__id").isNull(), T.normalize(F.col("__t"))))
    by_id = parts.select(F.col("brand_id").alias("__known"))
    by_name = parts.groupBy(F.col("full").alias("__n2")).agg(F.array_sort(F.collect_list("brand_id")).alias("__ids"))
    df = df.join(by_id, F.col("__id") == F.col("__known"), "left").join(by_name, F.col("__n") == F.col("__n2"), "left")
    n = F.coalesce(F.size("__ids"), F.lit(0))
    found = F.when(F.col("__id").isNotNull(), F.col("__known")).when(n == 1, F.get("__ids", F.lit(0)))
    error = (
        F.when(F.col("__id").isNotNull() & F.col("__known").isNull(), F.concat(F.lit("brand_id "), F.col("__id").cast("string"), F.lit(" 不在品牌庫")))
        .when(F.col("__id").isNull() & (n > 1), F.concat(F.lit("「"), "__t", F.lit("」在品牌庫有多筆 ("), F.array_join(F.col("__ids").cast("array<string>"), ", "), F.lit(")，請改填 brand_id")))
        .when(F.col("__id").isNull() & (n < 1), F.concat(F.lit("品牌庫找不到「"), "__t", F.lit(f"」（品牌庫沒有的品牌請選：{fixed.NEW}）")))
    )
    return df.select(*typed.columns, found.alias("brand_id"), error.alias("error"))


def compatible_half(a: Column, b: Column) -> Column:
    return (a == "") | (b == "") | (a == b)


def same_entity(a: str, b: str, linked: Column, ratio: Column | None = None) -> Column:
    """Whether two brands (columns with prefixes a and b) are registrations of one brand."""
    full_a, full_b, lat_a, lat_b, cjk_a, cjk_b = (F.col(f"{p}_{c}") for c in ("full", "lat", "cjk") for p in (a, b))
    short = F.when(F.length(full_a) <= F.length(full_b), full_a).otherwise(full_b)
    long = F.when(F.length(full_a) <= F.length(full_b), full_b).otherwise(full_a)
    tail = F.expr(f"substring(case when length({a}_full) <= length({b}_full) then {b}_full else {a}_full end, least(length({a}_full), length({b}_full)) + 1)")
    suffix = (F.length(short) >= 2) & F.startswith(long, short) & tail.isin(fixed.CORPORATE_SUFFIXES)
    by_latin = (F.length(lat_a) >= 4) & (lat_a == lat_b) & compatible_half(cjk_a, cjk_b)
    by_cjk = (cjk_a != "") & (cjk_a == cjk_b) & compatible_half(lat_a, lat_b)
    alike = (ratio if ratio is not None else T.indel_ratio(full_a, full_b)) >= 95
    return (F.col(f"{a}_id") == F.col(f"{b}_id")) | linked | (full_a == full_b) | suffix | by_latin | by_cjk | alike


def names_close(a: Column, b: Column, near: int = 85) -> Column:
    """Equal, one inside the other (three characters or more), or alike."""
    inside = (F.least(F.length(a), F.length(b)) >= 3) & (F.contains(a, b) | F.contains(b, a))
    return (a == b) | inside | (T.indel_ratio(a, b) >= near)


def same_entity_pairs(parts: DataFrame, links: DataFrame) -> DataFrame:
    """(a, b), a < b: pairs within blocks of equal name beginnings (or linked) that are one brand.

    Blocks have 2 to 200 brands, as in `duplicate_groups`; a linked pair needs no block.
    """
    rows = parts.where(not_special(F.col("brand_id")) & (F.col("full") != "")).withColumn("block", F.when(F.col("lat") != "", F.substring("lat", 1, 6)).otherwise(F.substring("cjk", 1, 2)))
    rows = rows.withColumn("n", F.count("*").over(Window.partitionBy("block"))).where("n between 2 and 200")
    side = lambda p: rows.select("block", F.col("brand_id").alias(f"{p}_id"), *(F.col(c).alias(f"{p}_{c}") for c in ("full", "lat", "cjk")))
    pairs = side("a").join(side("b"), "block").where("a_id < b_id").where(same_entity("a", "b", F.lit(False)))
    return pairs.select(F.col("a_id").alias("a"), F.col("b_id").alias("b")).unionByName(links.where("brand_id < peer").select(F.col("brand_id").alias("a"), F.col("peer").alias("b"))).distinct()


def duplicate_groups(parts: DataFrame, links: DataFrame) -> DataFrame:
    """(group, brand_id, position): greedy groups around the first member of a block, best sales first.

    Blocks have 200 brands at most, so one block fits a task.
    """
    rows = parts.where(not_special(F.col("brand_id")) & (F.col("full") != "")).withColumn("block", F.when(F.col("lat") != "", F.substring("lat", 1, 6)).otherwise(F.substring("cjk", 1, 2)))
    rows = rows.withColumn("n", F.count("*").over(Window.partitionBy("block"))).where("n between 2 and 200").select("block", "brand_id", "adg")
    pairs = same_entity_pairs(parts, links)
    near = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).groupBy("a").agg(F.collect_list("b").alias("near"))
    rows = rows.join(near, rows["brand_id"] == near["a"], "left").drop("a")

    def greedy(block):
        import pandas as pd

        block, used, out = block.sort_values("brand_id"), set(), []
        members = list(zip(block["brand_id"], block["adg"], block["near"], strict=True))
        for k, (first, _, near, *_) in enumerate(members):
            if first in used:
                continue
            near = set(near) if near is not None else set()
            group = [(first, members[k][1])] + [(b, adg) for b, adg, _ in members[k + 1 :] if b not in used and b in near]
            if len(group) > 1:
                used.update(b for b, _ in group)
                out += [(first, b, i + 1) for i, (b, _) in enumerate(sorted(group, key=lambda x: (-x[1], x[0])))]
        return pd.DataFrame(out, columns=["group", "brand_id", "position"])

    return rows.groupBy("block").applyInPandas(greedy, "group long, brand_id long, position int")
