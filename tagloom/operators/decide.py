"""From candidates to one outcome for each decision key: ranking, resolution, confidence, decision tree, rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.functions import fixed
from tagloom.functions import text as T
from tagloom.operators import match as M
from tagloom.operators.pool import Index, same_entity
from tagloom.plans.session import checkpointed

CANDIDATE = ["brand_id", "score", "descr", "alias_len", "is_human", "via", "source", "weak_short"]


def ranked(candidates: DataFrame, index: Index) -> DataFrame:
    """candidates of cases (case_id, cat, cat_check, ...) with names, parts and `rank`: category, score, trust, length, sales, id."""
    p = index.parts.select("brand_id", "name", "adg", F.col("category").alias("brand_cat"), F.col("full").alias("b_full"), F.col("lat").alias("b_lat"), F.col("cjk").alias("b_cjk"))
    df = candidates.join(p, "brand_id")
    in_cat = F.col("cat_check") & (F.col("cat") != "") & (F.col("brand_cat") == F.col("cat"))
    df = df.withColumn("in_cat", F.coalesce(in_cat, F.lit(False)))
    order = [F.desc("in_cat"), F.desc("score"), M.trust(F.col("source")).desc(), F.desc("alias_len"), F.desc("adg"), "brand_id"]
    return df.withColumn("rank", F.row_number().over(Window.partitionBy("case_id").orderBy(*order)))


def resolved(rows: DataFrame, index: Index) -> DataFrame:
    """(case_id, pick, path, note, adjust) from ranked rows with a strong candidate; `comp` is the normalised text."""
    strong = rows.where(F.col("score") >= fixed.MATCH)
    w = Window.partitionBy("case_id")
    top = lambda c: F.min_by(c, "rank").over(w)
    df = strong.withColumns({"a_id": F.col("brand_id"), "a_full": F.col("b_full"), "a_lat": F.col("b_lat"), "a_cjk": F.col("b_cjk")})
    df = df.withColumns({f"t_{k}": top(v) for k, v in (("id", "brand_id"), ("full", "b_full"), ("lat", "b_lat"), ("cjk", "b_cjk"), ("score", "score"), ("source", "source"), ("descr", "descr"))})
    links = index.links.select(F.col("brand_id").alias("l_a"), F.col("peer").alias("l_b"))
    df = df.join(links, (F.col("a_id") == F.col("l_a")) & (F.col("t_id") == F.col("l_b")), "left")
    df = df.withColumn("same", F.coalesce(same_entity("a", "t", F.col("l_a").isNotNull(), T.indel_ratio(F.col("a_full"), F.col("t_full"))), F.lit(False)))
    df = df.withColumn("rival", ~F.col("same") & (F.col("score") >= F.col("t_score") - fixed.TIE_GAP))
    # A child brand: among the top and its rivals, in the case's category if any is, named in the text.
    tied = F.col("rival") | (F.col("brand_id") == F.col("t_id"))
    df = df.withColumn("tied_in_cat", tied & F.col("in_cat"))
    df = df.withColumn("tied", F.when(F.bool_or("tied_in_cat").over(w), F.col("tied_in_cat")).otherwise(tied))
    piece = F.get(F.filter(F.array("b_full", "b_lat", "b_cjk"), lambda x: (x != "") & F.contains(F.col("comp"), x)), F.lit(0))
    df = df.withColumn("piece", F.when(F.col("tied"), piece))
    df = df.withColumn("inside", F.collect_set(F.when(F.col("piece").isNotNull(), F.col("b_lat"))).over(w))
    child = F.lit(False)
    for parent, kid in fixed.CHILD_BRANDS:
        child = child | ((F.col("b_lat") == kid) & F.array_contains("inside", parent))
    df = df.withColumn("child", F.col("piece").isNotNull() & child)
    by_sales = F.struct("adg", -F.col("rank"))
    g = df.groupBy("case_id").agg(
        F.first("t_id").alias("t_id"), F.first("t_source").alias("t_source"), F.first("t_descr").alias("t_descr"),
        F.count_if("same").alias("n_same"), F.count_if("rival").alias("n_rival"),
        F.max_by(F.when(F.col("same"), F.struct("brand_id", "name")), F.when(F.col("same"), by_sales)).alias("best_same"),
        F.max_by(F.when(F.col("child"), F.struct("brand_id", "name")), F.when(F.col("child"), F.struct(F.length("piece"), "adg", -F.col("rank")))).alias("best_child"),
        F.array_sort(F.collect_list(F.when(F.col("same"), F.struct("rank", "name")))).alias("same_names"),
        F.array_sort(F.collect_list(F.when(F.col("piece").isNotNull(), F.struct("rank", "brand_id", "name")))).alias("inside_names"),
        F.array_sort(F.collect_list(F.when(F.col("rival") | (F.col("brand_id") == F.col("t_id")), F.struct("rank", "name")))).alias("rival_names"),
    )
    names = lambda c: F.array_join(F.array_distinct(F.col(c)["name"]), "、")
    merged = (F.col("n_same") > 1) & (F.col("n_rival") == 0)
    human, curated = F.col("t_source") == "human", F.col("t_source") == "curated"
    child = ~human & ~curated & (F.col("n_rival") > 0) & F.col("best_child").isNotNull()
    others = F.array_join(F.transform(F.filter("inside_names", lambda x: x["brand_id"] != F.col("best_child")["brand_id"]), lambda x: x["name"]), "、")
    pick = F.when(human, F.col("t_id")).when(merged, F.col("best_same")["brand_id"]).when(child, F.col("best_child")["brand_id"]).otherwise(F.col("t_id"))
    path = F.when(human, "1.3").when(merged, "1.4").when(curated | (F.col("n_rival") == 0) | child, "1.3").otherwise("1.5")
    note = (
        F.when(human, "人工確認過的別名")
        .when(curated & merged, F.concat(F.lit("人工查證為同一品牌實體（"), names("same_names"), F.lit("），依業績取 "), F.col("best_same")["name"]))
        .when(curated, "人工整理並查證的品牌對照")
        .when(merged, F.concat(F.lit("品牌庫有 "), F.col("n_same").cast("string"), F.lit(" 筆近似登錄（"), names("same_names"), F.lit("），依業績取 "), F.col("best_same")["name"]))
        .when(F.col("n_rival") == 0, F.col("t_descr"))
        .when(child, F.concat(others, F.lit(" 也出現在品牌字串中，依子品牌優先取較具體的 "), F.col("best_child")["name"]))
        .otherwise(F.concat(F.array_join(F.transform(F.slice("rival_names", 1, 3), lambda x: x["name"]), "、"), F.lit(" 同樣符合，名稱不同無法自動決定")))
    )
    return g.select("case_id", pick.alias("pick"), path.alias("path"), note.alias("note"), F.when(child, -5).otherwise(0).alias("adjust"))


def best(cases: DataFrame, candidates: DataFrame, index: Index) -> DataFrame:
    """(case_id, pick, path, conf, note, top, labels) of every case: pick is null without a hit.

    cases: case_id, s (what candidates are joined on), comp, cat, cat_check, scale, odd (only exact candidates count).
    top: the first ranked candidate's description and score; labels: the first three, the pick before all others.
    """
    rows = checkpointed(ranked(cases.join(candidates, "s").where("not odd or (via in ('surface', 'full') and score >= 95)"), index))
    choice = resolved(rows, index)
    picked = rows.join(choice, "case_id").where(F.col("brand_id") == F.col("pick"))
    base = F.lit(0.0)
    for code in ("1.3", "1.4", "1.5"):
        base = F.when(F.col("path") == code, float(fixed.BASE[code])).otherwise(base)
    conf = base * F.col("scale") - F.greatest(F.lit(0.0), 95 - F.col("score")) * 0.6 + F.col("adjust")
    conf = F.when(F.col("weak_short"), F.least(conf, F.lit(74.0))).otherwise(conf)
    partial = F.col("via").isin("word", "sub", "tok", "fuzzy", "cjkpre")
    stray = F.coalesce(F.col("cat_check") & (F.col("cat") != "") & (F.col("brand_cat") != "") & (F.col("brand_cat") != F.col("cat")), F.lit(False))
    lowered = conf - F.when(stray & partial, 30).when(stray, 10).otherwise(0)
    note = F.concat("note", F.when(F.col("weak_short"), "；只有 1–3 字元英數縮寫相符，中文名稱未被獨立證實，需人工確認").otherwise(""), F.when(stray, F.concat(F.lit("；品牌類目（"), "brand_cat", F.lit("）與商品類目（"), "cat", F.lit("）不同"))).otherwise(""))
    picked = picked.select("case_id", "pick", "path", lowered.alias("conf"), note.alias("note"), F.col("score").alias("pick_score"), (stray & partial & (lowered < fixed.MATCH)).alias("rejected")).where("not rejected")
    order = F.struct("rank", T.label(F.col("name"), F.col("brand_id")).alias("label"), F.col("brand_id").alias("id"), "descr", "score")
    tops = rows.where("rank <= 4").groupBy("case_id").agg(F.array_sort(F.collect_list(order)).alias("tops"))
    pick_label = rows.select("case_id", "brand_id", T.label(F.col("name"), F.col("brand_id")).alias("pick_label"))
    out = cases.select("case_id").join(tops, "case_id", "left").join(picked.drop("rejected"), "case_id", "left")
    out = out.join(pick_label.withColumnRenamed("brand_id", "pick"), ["case_id", "pick"], "left")
    rest = F.transform(F.filter("tops", lambda x: F.col("pick").isNull() | (x["id"] != F.col("pick"))), lambda x: x["label"])
    labels = F.coalesce(F.concat(F.when(F.col("pick").isNotNull(), F.array("pick_label")).otherwise(F.array().cast("array<string>")), rest), F.array().cast("array<string>"))
    return out.select("case_id", "pick", "path", "conf", "note", "pick_score", F.get("tops", F.lit(0)).alias("top"), F.slice(labels, 1, 3).alias("labels"))


def tag(cases: DataFrame, index: Index) -> DataFrame:
    """One outcome for each case: (case_id, raw_brand, title, cat, cat_check) to the result columns.

    Every case reaches exactly one node. Matching runs once for each distinct text, whatever number of cases has it.
    """
    c = cases.withColumns({"rb": T.clean_raw(F.col("raw_brand")), "t": F.when(T.blank(F.col("title")), F.lit("")).otherwise(F.col("title"))})
    c = c.withColumns({"bracket": T.extract_bracket(F.col("t")), "rb_n": T.normalize(F.col("rb"))})
    c = c.withColumns({"br_n": T.normalize(F.col("bracket")), "t_compat": T.compatible(F.col("t")), "t_access": T.accessory(F.col("t")), "rb_why": T.why_not_brand(F.col("rb")), "br_why": T.why_not_brand(F.col("bracket"))})
    has = F.col("rb") != ""
    early = (
        F.when(has & F.col("rb_n").isin(fixed.NO_BRAND_WORDS), "1.1")
        .when(has & T.compatible(F.col("rb")), "1.2")
        .when(has & T.host_brand(F.col("rb")) & (F.col("t_compat") | (F.startswith(F.col("rb_n"), F.lit("iphone")) & F.col("t_access"))), "1.2h")
        .when(~has & (F.col("bracket") != "") & (F.col("br_n").isin(fixed.NO_BRAND_WORDS) | T.compatible(F.col("bracket"))), "2.1b")
    )
    c = checkpointed(c.withColumn("early", early))
    texts = c.where("rb <> '' and early is null").select(F.col("rb").alias("s")).unionByName(c.where("bracket <> ''").select(F.col("bracket").alias("s"))).distinct()
    found = checkpointed(M.match(texts, index))
    # A case is decided by its brand text, or by its bracket if it has none. A bracket that does not read like a brand counts only where it is one exactly.
    has = F.col("rb") != ""
    one = lambda brand, bracket: F.when(has, brand).otherwise(bracket)
    cases = c.where("early is null and (rb <> '' or bracket <> '')").select(
        "case_id", one(F.col("rb"), F.col("bracket")).alias("s"), one(F.col("rb_n"), F.col("br_n")).alias("comp"), "cat", "cat_check", one(F.lit(1.0), F.lit(0.95)).alias("scale"), (~has & F.col("br_why").isNotNull()).alias("odd"),
    )
    found_here = best(cases, found.select("s", *CANDIDATE), index)
    strong_brackets = found.where(F.col("score") >= 95).groupBy(F.col("s").alias("bracket")).agg(F.collect_set("brand_id").alias("bracket_ids"))
    sides = [F.when(side, F.col(f"x_{k}")).alias(f"{p}_{k}") for p, side in (("a", has), ("b", ~has)) for k in found_here.columns if k != "case_id"]
    out = c.join(_named(found_here, "x"), "case_id", "left").select(*(F.col(k) for k in c.columns), *sides)
    out = checkpointed(out.join(strong_brackets, "bracket", "left"))
    to_scan = out.where("rb = '' and early is null and b_pick is null and not (bracket <> '' and br_why is null) and not t_compat and not t_access").select("case_id", F.col("t").alias("s"), T.normalize(F.col("t")).alias("comp"), "cat", "cat_check", F.lit(1.0).alias("scale"), F.lit(False).alias("odd"))
    scanned = M.scan_titles(to_scan.select("s"), index).where(T.distinctive(F.col("alias")))
    out = out.join(_named(best(to_scan, scanned.select("s", *CANDIDATE), index), "d"), "case_id", "left")
    return _outcome(out, index)


def _named(df: DataFrame, prefix: str) -> DataFrame:
    return df.select("case_id", *(F.col(c).alias(f"{prefix}_{c}") for c in df.columns if c != "case_id"))


def _outcome(df: DataFrame, index: Index) -> DataFrame:
    has = F.col("rb") != ""
    host = F.col("br_n").isin(fixed.HOST_PLATFORMS) | F.col("br_n").rlike("|".join(fixed.HOST_INSIDE))
    fits = F.col("t_compat") | F.col("t_access")
    node = (
        F.when(F.col("early").isNotNull(), F.col("early"))
        .when(has & F.col("a_pick").isNotNull(), F.col("a_path"))
        .when(has & F.col("rb_why").isNull(), "1.6")
        .when(has, "1.7")
        .when((F.col("bracket") != "") & F.col("b_pick").isNotNull() & fits & host, "2.1h")
        .when((F.col("bracket") != "") & F.col("b_pick").isNotNull(), "2.2")
        .when((F.col("bracket") != "") & F.col("br_why").isNull() & fits & host, "2.1i")
        .when((F.col("bracket") != "") & F.col("br_why").isNull(), "2.3")
        .when(fits, "2.1")
        .when(F.col("d_pick").isNotNull(), "2.4")
        .otherwise("2.5")
    )
    df = df.withColumn("node", node).withColumn("path_code", F.substring("node", 1, 3))
    astray = (F.col("bracket") != "") & (F.col("br_n") != F.col("rb_n")) & (F.size("bracket_ids") > 0) & ~F.array_contains("bracket_ids", F.col("a_pick"))
    astray = F.coalesce(astray, F.lit(False))
    weak = F.coalesce(F.col("a_top")["score"] >= 55, F.lit(False))
    n = F.col("node")
    base = lambda code: F.lit(float(fixed.BASE[code]))
    conf = (
        F.when(n.isin("1.2h", "2.1h", "2.1i"), 65.0).when(n == "1.1", base("1.1")).when(n == "1.2", base("1.2"))
        .when(n.isin("1.3", "1.4", "1.5"), F.col("a_conf") - F.when(astray, 20).otherwise(0)).when(n == "1.6", base("1.6") - F.when(weak, 20).otherwise(0)).when(n == "1.7", base("1.7"))
        .when(n.isin("2.1", "2.1b"), base("2.1")).when(n == "2.2", F.col("b_conf")).when(n == "2.3", base("2.3"))
        .when(n == "2.4", base("2.4") - F.greatest(F.lit(0.0), 95 - F.col("d_pick_score")) * 0.3).otherwise(base("2.5"))
    )
    bracket = F.col("bracket")
    note = (
        F.when(n == "1.1", "品牌欄明確寫明無品牌").when(n == "1.2", "品牌欄為相容/副廠描述").when(n == "1.2h", "主機品牌出現在相容配件，需確認實際製造商品牌")
        .when(n.isin("1.3", "1.4", "1.5"), F.concat("a_note", F.when(astray, "；品牌欄與商品名稱【】指向不同品牌").otherwise("")))
        .when((n == "1.6") & weak, F.concat(F.lit("品牌庫只有相似但不夠像的候選（"), F.col("a_top")["descr"], F.lit("），依最小顆粒度不採用"))).when(n == "1.6", "品牌庫查無相符品牌")
        .when(n == "1.7", F.concat(F.lit("品牌欄內容不是品牌："), "rb_why"))
        .when(n == "2.1b", F.concat(F.lit("商品名稱【】標示為相容描述或無品牌（"), bracket, F.lit("）")))
        .when(n == "2.1h", F.concat(F.lit("商品為配件，【】中之品牌（"), bracket, F.lit("）可能是相容主機，需確認製造商")))
        .when(n == "2.1i", F.concat(F.lit("商品為配件，【】中之描述（"), bracket, F.lit("）可能是相容主機，需確認製造商")))
        .when(n == "2.1", "商品為配件/相容品且無獨立品牌，標題中的品牌為其相容對象")
        .when(n == "2.2", F.concat("b_note", F.lit("（依商品名稱【】判斷）"))).when(n == "2.3", "商品名稱【】看起來是品牌，但品牌庫查無")
        .when(n == "2.4", F.concat("d_note", F.lit("（於商品名稱內文比對）")))
        .when(bracket != "", "品牌欄空白，商品名稱【】為描述、內文也找不到品牌").otherwise("品牌欄空白，商品名稱也找不到品牌")
    )
    bid = F.when(n.isin("1.3", "1.4", "1.5"), F.col("a_pick")).when(n == "2.2", F.col("b_pick")).when(n == "2.4", F.col("d_pick"))
    labels = F.when(n.isin("1.3", "1.4", "1.5", "1.6", "1.7"), F.col("a_labels")).when(n.isin("2.1h", "2.2", "2.1i", "2.3"), F.col("b_labels")).when(n == "2.4", F.col("d_labels"))
    reason = (
        F.when(n == "1.1", fixed.REASON_WORD).when(F.col("path_code").isin("1.2", "2.1"), fixed.REASON_COMPATIBLE).when(n == "1.7", fixed.REASON_STORE)
        .when((n == "2.5") & (bracket != ""), fixed.REASON_DESCRIPTION).when(n == "2.5", fixed.REASON_EMPTY).otherwise("")
    )
    df = df.withColumns({"conf": conf, "explanation": note, "bid": bid, "labels": F.coalesce(labels, F.array().cast("array<string>")), "no_brand_reason": reason})
    df = df.join(index.parts.select(F.col("brand_id").alias("bid"), F.col("name").alias("pool_name")), "bid", "left")
    outcome, title = F.lit(None).cast("string"), F.lit(None).cast("string")
    for code, (name, kind) in fixed.NODES.items():
        outcome = F.when(F.col("path_code") == code, kind).otherwise(outcome)
        title = F.when(F.col("path_code") == code, f"{code} {name}").otherwise(title)
    candidate = lambda k: F.coalesce(F.get("labels", F.lit(k)), F.lit("")).alias(f"candidate{k + 1}")
    df = df.withColumn("outcome", outcome)
    return df.select(
        "case_id", candidate(0), candidate(1), candidate(2),
        F.when(F.col("outcome") == fixed.POOL, F.col("pool_name")).otherwise(F.col("outcome")).alias("suggested_name"),
        F.when(F.col("outcome") == fixed.POOL, F.col("bid").cast("string")).when(F.col("outcome") == fixed.NONE, "0").otherwise("").alias("suggested_id"),
        F.when(n == "1.6", F.col("rb")).when(n == "2.3", bracket).otherwise("").alias("new_name"), "no_brand_reason",
        T.clamp_confidence(F.col("conf")).alias("confidence"), title.alias("path"), "explanation", "outcome",
        F.when(F.col("outcome") == fixed.POOL, F.col("bid")).when(F.col("outcome") == fixed.NONE, F.lit(0)).cast("long").alias("brand_id"),
    )


RESULT = ["candidate1", "candidate2", "candidate3", "suggested_name", "suggested_id", "new_name", "no_brand_reason", "confidence", "path", "explanation", "outcome", "brand_id"]


def key_table(items: DataFrame) -> DataFrame:
    """Items by category and decision key: first raw brand and title (by item id), item count, most frequent l2 (the smallest of equal ones).

    A key is decided in each category on its own, so results do not depend on which categories run together.
    """
    return _key_table(with_keys(items))


def with_keys(items: DataFrame) -> DataFrame:
    return items.withColumn("key", T.brand_key(F.col("brand"), F.col("title"), F.col("item_id")))


def _key_table(rows: DataFrame) -> DataFrame:
    rows = rows.withColumn("l1", F.coalesce("l1", F.lit("")))
    # Counts by l2 first, so that a common key costs a row for each l2 and task.
    per = rows.groupBy("l1", "key", "l2").agg(F.min_by(F.struct("item_id", "brand", "title"), "item_id").alias("f"), F.count("*").alias("n"))
    g = per.groupBy("l1", "key").agg(F.min_by("f", "f.item_id").alias("f"), F.sum("n").alias("goods"), F.min_by("l2", F.struct(-F.col("n"), "l2")).alias("main_l2"))
    return g.select("key", F.col("f.brand").alias("raw_brand"), F.col("f.title").alias("title"), "l1", "goods", "main_l2")


def tag_items(items: DataFrame, index: Index, rules: DataFrame | None = None, overrides: DataFrame | None = None) -> DataFrame:
    """Every item with its key's outcome: decided once for each category and key, rules on keys, then overrides on items."""
    categories = index.parts.where("category <> ''").select(F.col("category").alias("l1")).distinct().withColumn("cat_check", F.lit(True))
    rows = with_keys(items)
    case = F.concat("l1", F.lit("\n"), "key")
    keys = _key_table(rows).join(categories, "l1", "left").withColumn("case_id", case)
    result = tag(keys.select("case_id", "raw_brand", "title", F.col("l1").alias("cat"), F.coalesce("cat_check", F.lit(False)).alias("cat_check")), index)
    if rules is not None:
        key = F.regexp_extract("case_id", r"(?s)^[^\n]*\n(.*)$", 1)
        result = apply_rules(result.withColumn("key", key), rules.withColumnRenamed("rule_key", "key"), "key", "3.1", index).drop("key")
    out = rows.withColumn("case_id", F.concat(F.coalesce("l1", F.lit("")), F.lit("\n"), "key")).join(result, "case_id").drop("case_id")
    if overrides is not None:
        out = apply_rules(out, overrides.withColumnRenamed("rule_key", "item_id"), "item_id", "3.2", index)
    return out


def apply_rules(rows: DataFrame, rules: DataFrame, on: str, code: str, index: Index) -> DataFrame:
    """Lay people's decisions (on, decision, brand_id, brand_name, nobrand_reason) over results."""
    r = rules.select(F.col(on).cast(rows.schema[on].dataType), F.col("decision").alias("r_decision"), F.col("brand_id").cast("long").alias("r_id"), F.col("brand_name").alias("r_name"), F.col("nobrand_reason").alias("r_reason"))
    r = r.join(index.parts.select(F.col("brand_id").alias("r_id"), F.col("name").alias("r_pool")), "r_id", "left")
    df = rows.join(r, on, "left")
    d, ruled = F.col("r_decision"), F.col("r_decision").isNotNull()
    value = {
        "suggested_name": F.when((d == fixed.POOL) & F.col("r_id").isNotNull(), F.coalesce("r_pool", "r_name")).otherwise(d),
        "suggested_id": F.when(d == fixed.POOL, T.id_str(F.col("r_id"))).when(d == fixed.NONE, "0").otherwise(""),
        "new_name": F.when(d == fixed.NEW, F.col("r_name")).otherwise(""),
        "no_brand_reason": F.when(d == fixed.NONE, F.coalesce("r_reason", F.lit(""))).otherwise(""),
        "confidence": F.lit(100), "path": F.lit(f"{code} {fixed.NODES[code][0]}"), "explanation": F.lit(fixed.NODES[code][0]), "outcome": d,
        "brand_id": F.when(d == fixed.POOL, F.col("r_id")).when(d == fixed.NONE, F.lit(0).cast("long")),
    }
    return df.withColumns({k: F.when(ruled, v).otherwise(F.col(k)) for k, v in value.items()}).select(*rows.columns)
