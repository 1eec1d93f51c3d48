"""Candidates of a brand text: generators as equi-joins, evidence merge, penalties, product lines.

`match` works on distinct texts. Containment becomes n-grams joined on keys, prefixes become buckets, and similarity
becomes blocks of first character and length, so nothing compares all texts with all brands.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.functions import fixed
from tagloom.functions import text as T
from tagloom.operators.pool import Index, not_special
from tagloom.plans.session import checkpointed

#: Order in which generators add evidence; on full ties the earlier one stays.
ORDER = ["surface", "entity", "exact", "part", "both", "lat", "cjk", "sub", "word", "cjkpre", "tok", "fuzzy"]
EVIDENCE = ["s", "brand_id", "score", "descr", "alias", "via", "forced", "step", "pos"]


def with_query_parts(texts: DataFrame) -> DataFrame:
    """From distinct texts `s`: full, lat, cjk, surface, bilingual."""
    df = texts.select("s").distinct().withColumn("full", T.normalize(F.col("s"))).where("full <> ''")
    return df.withColumns({"lat": T.latin_part(F.col("full")), "cjk": T.cjk_part(F.col("full")), "surface": T.surface_key(F.col("s")), "bilingual": T.is_bilingual(T.clean_raw(F.col("s")))})


def _rows(df: DataFrame, score: Column, descr: Column, alias: Column, via: Column, step: str, pos: Column | None = None, forced: Column | None = None) -> DataFrame:
    values = {"s": F.col("s"), "brand_id": F.col("brand_id"), "score": score.cast("double"), "descr": descr, "alias": alias, "via": via, "forced": forced if forced is not None else F.lit(None).cast("string"), "step": F.lit(ORDER.index(step)), "pos": pos if pos is not None else F.lit(0)}
    return df.select(*(v.alias(k) for k, v in values.items()))


def exact_candidates(q: DataFrame, index: Index) -> DataFrame:
    """Whole-text evidence: original spelling, linked entities, normalised names and aliases."""
    hit = q.join(index.parts.select("surface", "brand_id"), "surface")
    out = [_rows(hit, F.lit(100), F.lit("品牌原始名稱（含標點）完全相符"), F.col("full"), F.lit("surface"), "surface")]
    peers = hit.join(index.links, "brand_id").select("s", "full", F.col("peer").alias("brand_id")).distinct()
    out.append(_rows(peers, F.lit(100), F.lit("人工查證為同一品牌實體"), F.col("full"), F.lit("entity"), "entity", forced=F.lit("curated")))
    rest = q.join(hit.select("s").distinct(), "s", "left_anti").join(index.keys, F.col("full") == F.col("key"))
    rest = rest.join(index.parts.select("brand_id", F.col("full").alias("own")), "brand_id")
    whole = (F.col("own") == F.col("full")) | F.col("human") | F.col("curated")
    cjk = F.col("full").rlike(f"[{T.CJK}]")
    out.append(_rows(rest.where(whole), F.lit(100), F.lit("品牌名完全相符"), F.col("full"), F.lit("full"), "exact"))
    out.append(_rows(rest.where(~whole), F.lit(95), F.when(cjk, "與品牌庫品牌的中文名相符").otherwise("與品牌庫品牌的英文名相符"), F.col("full"), F.when(cjk, "cjk").otherwise("lat"), "part"))
    return functools.reduce(DataFrame.unionByName, out)


def part_candidates(q: DataFrame, index: Index) -> DataFrame:
    """Evidence from the Latin and the CJK half, and from both together."""
    keys = index.keys.select("key", "brand_id", "auto")
    half = lambda c: q.where((F.length(c) >= 2) & (F.col(c) != F.col("full"))).join(keys, F.col(c) == F.col("key")).drop("key")
    sides = half("lat").withColumn("side", F.lit("lat")).unionByName(half("cjk").withColumn("side", F.lit("cjk")))
    w = Window.partitionBy("s", "brand_id")
    sides = sides.withColumn("both", (F.count("*").over(w) == 2) & ~F.bool_or("auto").over(w))
    has_cjk, short = F.col("cjk") != "", F.length("lat")
    weak_l, weak_c = (short <= 3) & has_cjk & ~F.col("bilingual"), (F.length("cjk") <= 2) & (short >= 4) & ~F.col("bilingual")
    initials = (short <= 2) & has_cjk
    lat, cjk, both = sides.where("side = 'lat' and not both"), sides.where("side = 'cjk' and not both"), sides.where("side = 'lat' and both")
    out = [
        _rows(both, F.lit(100), F.lit("中英文名皆相符"), F.col("full"), F.lit("full"), "both"),
        _rows(lat, F.when(weak_l, 70).when(initials, 85).otherwise(95), F.when(weak_l, "英文縮寫過短且黏著中文（可能是集團/公司名）").when(initials, "英文縮寫相符（僅兩個字母，證據較弱）").otherwise("英文名相符"), F.col("lat"), F.lit("lat"), "lat"),
        _rows(cjk, F.when(weak_c, 70).otherwise(95), F.when(weak_c, "中文名過短（可能是泛用詞）").otherwise("中文名相符"), F.col("cjk"), F.lit("cjk"), "cjk"),
    ]
    return functools.reduce(DataFrame.unionByName, out)


def grams(c: str, shortest: int, longest: int) -> Column:
    """Array of (pos, gram): all substrings of a column with these lengths, in order of place and length."""
    n = F.length(c)
    starts = F.sequence(F.lit(1), F.greatest(n - shortest + 1, F.lit(1)))
    each = F.transform(starts, lambda i: F.transform(F.sequence(F.lit(shortest), F.greatest(F.least(n - i + 1, F.lit(longest)), F.lit(shortest))), lambda k: F.struct((i * 100 + k).alias("pos"), F.substring(F.col(c), i, k).alias("gram"))))
    return F.when(n >= shortest, F.flatten(each))


def substring_candidates(q: DataFrame, index: Index) -> DataFrame:
    probe = q.select("s", "full", F.inline(grams("full", 3, 25))).where("gram <> full")
    hit = probe.join(index.long.select("key", "brand_id"), F.col("gram") == F.col("key"))
    return _rows(hit, F.lit(75), F.concat(F.lit("品牌名包含「"), "gram", F.lit("」")), F.col("gram"), F.lit("sub"), "sub", F.col("pos"))


def word_candidates(q: DataFrame, index: Index) -> DataFrame:
    words = F.transform(F.split(T.clean_raw(F.col("s")), r"[\s/|｜]+"), T.normalize)
    probe = q.select("s", "full", words.alias("w")).where(F.size("w") > 1).select("s", "full", F.posexplode("w").alias("pos", "word"))
    usable = (F.length("word") >= 3) | ((F.length("word") >= 2) & F.col("word").rlike(f"[{T.CJK}]"))
    probe = probe.where((F.col("word") != "") & (F.col("word") != F.col("full")) & ~F.col("word").isin([*fixed.STOP_TOKENS, *fixed.GENERIC_KEYS]) & usable)
    hit = probe.drop("full").join(index.keys.select("key", "brand_id"), F.col("word") == F.col("key")).join(index.parts.select("brand_id", "full", "lat", "cjk"), "brand_id")
    hit = hit.where(F.col("word").isin(F.col("full"), F.col("lat"), F.col("cjk")))
    return _rows(hit, F.lit(85), F.concat(F.lit("品牌名中的「"), "word", F.lit("」與品牌庫品牌相同")), F.col("word"), F.lit("word"), "word", F.col("pos"))


def prefix_candidates(q: DataFrame, index: Index) -> DataFrame:
    """The text's CJK name begins a registered one: few hits only, two characters need a corporate ending."""
    probe = q.where(F.length("cjk") >= 2).join(index.keys.select(F.col("key").alias("cjk")).distinct(), "cjk", "left_anti").withColumn("bucket", F.substring("cjk", 1, 2))
    own = index.parts.where(not_special(F.col("brand_id")) & (F.length("cjk") >= 3)).select(F.substring("cjk", 1, 2).alias("bucket"), F.col("cjk").alias("own"), "brand_id", "name")
    hit = probe.join(own, "bucket").where((F.col("own") != F.col("cjk")) & F.startswith(F.col("own"), F.col("cjk")))
    hit = hit.withColumn("hits", F.count("*").over(Window.partitionBy("s"))).withColumn("tail", F.expr("substring(own, length(cjk) + 1)"))
    suffix, short = F.col("tail").isin(fixed.CORPORATE_SUFFIXES), F.length("cjk") == 2
    hit = hit.where((F.col("hits") <= F.when(short, 2).otherwise(3)) & (~short | suffix))
    sure = (F.col("hits") == 1) & (suffix | (F.length("tail") <= 2))
    descr = F.concat(F.lit("品牌庫登記為「"), "name", F.lit("」（競網少了「"), "tail", F.lit("」）"))
    return _rows(hit, F.when(sure, 95).when(suffix, 85).otherwise(82), descr, F.col("cjk"), F.lit("cjkpre"), "cjkpre")


def token_candidates(q: DataFrame, index: Index) -> DataFrame:
    hit = q.select("s", F.posexplode(T.latin_tokens(F.col("s"))).alias("pos", "token")).join(index.tokens, "token")
    return _rows(hit, F.lit(65), F.concat(F.lit("英文單字「"), "token", F.lit("」相同")), F.col("token"), F.lit("tok"), "tok", F.col("pos"))


def similar_keys(probes: DataFrame, keys: DataFrame, ratio=T.indel_ratio, cutoff: int = fixed.FUZZY_CUTOFF, limit: int = 3) -> DataFrame:
    """(probe, key, similarity): the most similar keys with the same first character and a near length.

    Each probe is repeated for the lengths a key may have, so the join is on (first character, length).
    """
    low, high = F.floor(F.length("probe") * 0.78).cast("int"), (F.floor(F.length("probe") / 0.78) + 1).cast("int")
    probe = probes.select("probe").distinct().where(F.length("probe") >= 5).select("probe", F.substring("probe", 1, 1).alias("c"), F.explode(F.sequence(low, high)).alias("n"))
    key = keys.select("key").distinct().where(F.length("key") >= 5).select("key", F.substring("key", 1, 1).alias("c"), F.length("key").alias("n"))
    hit = probe.join(key, ["c", "n"]).withColumn("similarity", ratio(F.col("probe"), F.col("key"))).where(F.col("similarity") >= cutoff)
    best = Window.partitionBy("probe").orderBy(F.desc("similarity"), "key")
    return hit.withColumn("k", F.row_number().over(best)).where((F.col("k") <= limit) & (F.col("key") != F.col("probe"))).select("probe", "key", "similarity")


def fuzzy_candidates(q: DataFrame, index: Index) -> DataFrame:
    probe = q.select("s", F.explode(F.array_distinct(F.array("full", "lat"))).alias("probe")).where(F.length("probe") >= 5)
    found = similar_keys(probe, index.keys, T.indel_ratio)
    hit = probe.join(found, "probe").join(index.keys.select("key", "brand_id"), "key")
    score = T.half_even(60 + (F.col("similarity") - fixed.FUZZY_CUTOFF) / (100 - fixed.FUZZY_CUTOFF) * 14)
    return _rows(hit, score, F.format_string("拼字相似(%.0f%%)", F.bround("similarity", 0)), F.col("key"), F.lit("fuzzy"), "fuzzy")


def merged(evidence: DataFrame, index: Index) -> DataFrame:
    """One row for each text and brand: the strongest evidence by score, trust and matched length, with its provenance."""
    flags = index.keys.select(F.col("key").alias("alias"), "brand_id", "human", "curated", "auto")
    df = evidence.join(flags, ["alias", "brand_id"], "left")
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    source = F.coalesce(F.col("forced"), F.when(yes("human"), "human").when(yes("curated"), "curated").when(yes("auto"), "auto").otherwise("natural"))
    df = df.withColumn("source", source).withColumn("is_human", yes("human"))
    told = F.when(F.col("source") == "human", "人工確認過的別名").when(F.col("source") == "curated", F.concat(F.lit("人工整理並查證的品牌對照「"), "alias", F.lit("」"))).when(F.col("source") == "auto", F.concat(F.lit("自動學習的別名「"), "alias", F.lit("」")))
    df = df.withColumn("descr", F.when((F.col("score") >= fixed.AUTO) & told.isNotNull(), told).otherwise(F.col("descr")))
    value = F.struct("score", "descr", F.length("alias").alias("alias_len"), "is_human", "via", "source", "alias")
    best = F.struct("score", trust(F.col("source")).alias("t"), F.length("alias").alias("l"), (-F.col("step")).alias("o"), (-F.col("pos")).alias("p"), "alias")
    return df.groupBy("s", "brand_id").agg(F.max_by(value, best).alias("v")).select("s", "brand_id", "v.*")


def trust(source: Column) -> Column:
    out = F.lit(0)
    for name, value in fixed.TRUST.items():
        out = F.when(source == name, value).otherwise(out)
    return out


def penalised(best: DataFrame, q: DataFrame, index: Index) -> DataFrame:
    """Adds weak_short and lowers scores that other parts of the names contradict."""
    p = index.parts.select("brand_id", F.col("lat").alias("pl"), F.col("cjk").alias("pc"))
    df = best.join(q.select("s", "lat", "cjk"), "s").join(p, "brand_id")
    via, source = F.col("via"), F.col("source")
    checked = source.isin("human", "curated")
    weak = (F.col("cjk") != "") & F.length("lat").between(1, 3) & (F.col("pc") != F.col("cjk")) & ~checked & via.isin("lat", "cjk", "full")
    same_cjk = (via == "cjk") & (F.col("pc") == F.col("cjk")) & (F.length("cjk") >= 3) & (F.length("lat") <= 2)
    df = df.withColumn("weak_short", weak).withColumn("same_cjk", same_cjk).withColumn("rivalled", F.bool_or("same_cjk").over(Window.partitionBy("s")))
    demoted = F.col("rivalled") & ~F.col("same_cjk") & (via == "lat")
    note = F.concat("descr", F.lit("；但另有品牌的中文名「"), "cjk", F.lit("」完全相符，此英文縮寫證據較弱"))
    df = df.withColumns({"score": F.when(demoted, F.least("score", F.lit(65.0))).otherwise(F.col("score")), "descr": F.when(demoted, note).otherwise(F.col("descr"))})
    apart = lambda a, b: ~F.contains(F.col(a), F.col(b)) & ~F.contains(F.col(b), F.col(a))
    cjk_conflict = (F.col("cjk") != "") & (F.col("pc") != "") & apart("cjk", "pc")
    lat_conflict = (F.length("lat") >= 2) & (F.length("pl") >= 2) & apart("lat", "pl")
    partial = via.isin("word", "sub", "tok", "fuzzy")
    cases = [
        (((via == "full") & (source == "natural")) | checked, None, None),
        ((F.col("cjk") != "") & (F.col("pc") == "") & partial & (F.col("lat") != F.col("pl")), 55, F.concat(F.lit("，但競網品牌另有中文名「"), "cjk", F.lit("」而品牌庫此品牌沒有"))),
        (cjk_conflict & (via != "cjk"), 60, F.concat(F.lit("，但中文名不同（"), "pc", F.lit("≠"), "cjk", F.lit("）"))),
        (lat_conflict & (via == "cjk") & (F.length("cjk") <= 2), 60, F.concat(F.lit("，但英文名不同（"), "pl", F.lit("≠"), "lat", F.lit("）"))),
        (lat_conflict & (via == "cjk"), 88, F.concat(F.lit("（英文拼法不同："), "pl", F.lit(" / "), "lat", F.lit("）"))),
        ((F.col("lat") == "") & (F.length("cjk") <= 2) & (F.length("pl") >= 4) & (via == "cjk"), 65, F.concat(F.lit("；但競網僅二字中文且無英文名，而品牌庫此品牌另有英文名「"), "pl", F.lit("」，證據較弱"))),
    ]
    cap, added = F.lit(1000.0), F.lit("")
    for condition, limit, words in reversed(cases):
        cap = F.when(condition, float(limit if limit is not None else 1000)).otherwise(cap)
        added = F.when(condition, words if words is not None else F.lit("")).otherwise(added)
    return df.withColumns({"score": F.least("score", cap), "descr": F.concat("descr", added)}).drop("lat", "cjk", "pl", "pc", "same_cjk", "rivalled")


def fold_products(candidates: DataFrame, index: Index) -> DataFrame:
    """A product line's and its brand's registrations become the registration with the best sales."""
    family = index.parts.where("is_apple or is_line").select("brand_id", F.lit(True).alias("family"))
    pick = index.parts.where("is_apple").agg(F.max_by(F.struct("brand_id", "name"), F.struct("adg", -F.col("brand_id"))).alias("p")).first()["p"]
    df = candidates.join(family, "brand_id", "left")
    rest = df.where("family is null").drop("family")
    if pick is None:
        return rest
    value = F.struct(*(c for c in rest.columns if c not in ("s", "brand_id")))
    one = df.where("family").groupBy("s").agg(F.max_by(value, F.struct("score", -F.col("brand_id"))).alias("v")).select("s", F.lit(pick["brand_id"]).cast("long").alias("brand_id"), "v.*")
    note = f"；iPhone 為產品線，Apple 同實體依 adg 取 {pick['name']} [{pick['brand_id']}]"
    return rest.unionByName(one.withColumn("descr", F.concat("descr", F.lit(note))).select(*rest.columns))


def match(texts: DataFrame, index: Index) -> DataFrame:
    """Candidates of each distinct text `s`: brand_id, score, descr, alias_len, is_human, via, source, alias, weak_short."""
    q = checkpointed(with_query_parts(texts))
    first = checkpointed(functools.reduce(DataFrame.unionByName, [f(q, index) for f in (exact_candidates, part_candidates, substring_candidates, word_candidates, prefix_candidates, token_candidates)]))
    # Similarity is searched only for texts without strong evidence, before any penalty.
    strong = first.where(F.col("score") >= fixed.AUTO).select("s").distinct()
    evidence = first.unionByName(fuzzy_candidates(q.join(strong, "s", "left_anti"), index))
    return fold_products(checkpointed(penalised(merged(evidence, index), q, index)), index)


def scan_titles(titles: DataFrame, index: Index) -> DataFrame:
    """Candidates of each distinct title `s` from the keys inside the whole of it; a brand's longest key counts."""
    q = titles.select("s").distinct().withColumn("full", T.normalize(F.col("s")))
    hit = q.select("s", F.inline(grams("full", 3, 20))).join(index.long, F.col("gram") == F.col("key"))
    source = F.when(F.col("human"), "human").when(F.col("curated"), "curated").when(F.col("auto"), "auto").otherwise("natural")
    value = F.struct(F.lit(75.0).alias("score"), F.concat(F.lit("商品名稱內含「"), "gram", F.lit("」")).alias("descr"), F.length("gram").alias("alias_len"), F.col("human").alias("is_human"), F.lit("scan").alias("via"), source.alias("source"), F.col("gram").alias("alias"), F.lit(False).alias("weak_short"))
    best = hit.groupBy("s", "brand_id").agg(F.max_by(value, F.struct(F.length("gram"), -F.col("pos"))).alias("v")).select("s", "brand_id", "v.*")
    return fold_products(best, index)
