"""Queries by name, each with the SQL that gives the same rows where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions import fixed
from tagloom.functions import text as T
from tagloom.operators import decide, match, pool, report, review, store
from tagloom.plans import inputs as I
from tagloom.sources import catalogue

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# --- SQL spellings of the text layer, for the other side of the comparison -------------------------------
CJK = r"\x{3400}-\x{9FFF}\x{F900}-\x{FAFF}"
q = lambda words: "(" + ", ".join(map(I.literal, words)) + ")"


def s_blank(x: str) -> str:
    return f"({x} IS NULL OR trim({x}) IN ('', 'nan', 'None', '<NA>'))"


def s_clean(x: str) -> str:
    out = f"trim(coalesce({x}, ''))"
    for w in fixed.NOISE_WORDS:
        out = f"replace({out}, '{w}', ' ')"
    return f"CASE WHEN {s_blank(x)} THEN '' ELSE trim(regexp_replace({out}, '[\\s\\x{{3000}}]+', ' ', 'g')) END"


def s_norm(x: str) -> str:
    return f"regexp_replace(regexp_replace(lower(CASE WHEN {s_blank(x)} THEN '' ELSE {x} END), '[’''`]', '', 'g'), '[^\\p{{L}}\\p{{N}}{CJK}]', '', 'g')"


def s_lat(x: str) -> str:
    return f"regexp_replace({x}, '[^a-z0-9]', '', 'g')"


def s_cjk(x: str) -> str:
    return f"regexp_replace({x}, '[^{CJK}]', '', 'g')"


def s_tokens(x: str) -> str:
    return f"list_sort(list_distinct(list_filter(regexp_extract_all(regexp_replace(lower(coalesce({x}, '')), '[’'']', '', 'g'), '[a-z0-9]+'), lambda t: length(t) >= 4 AND t NOT IN {q(fixed.STOP_TOKENS)})))"


def s_bracket(x: str) -> str:
    found = f"regexp_extract_all(CASE WHEN {s_blank(x)} THEN '' ELSE {x} END, '【[^】]*】|\\[[^\\]]*\\]')"
    cleaned = f"list_filter(list_transform({found}, lambda b: {s_clean('substr(b, 2, length(b) - 2)')}), lambda b: b <> '')"
    return f"coalesce({cleaned}[1], '')"


def s_bracket_rows(source: str, x: str) -> str:
    """The source with `bracket`: prefixes are stripped one after the other."""
    out = f"(SELECT *, {s_bracket(x)} AS b0 FROM {source})"
    for k, p in enumerate(fixed.ORIGIN_PREFIXES):
        out = f"(SELECT *, CASE WHEN starts_with(b{k}, '{p}') AND length(b{k}) > {len(p)} THEN substr(b{k}, {len(p) + 1}) ELSE b{k} END AS b{k + 1} FROM {out})"
    return f"(SELECT *, trim(b{len(fixed.ORIGIN_PREFIXES)}) AS bracket FROM {out})"


def s_why(raw: str) -> str:
    """raw: cleaned text."""
    n = s_norm(raw)
    category = f"list_filter({list(fixed.CATEGORY_WORDS)!r}, lambda w: contains({raw}, w))[1]"
    return f"""CASE WHEN {raw} = '' THEN '空白' WHEN {n} = '' THEN '沒有可辨識的文字'
      WHEN {n} IN {q(fixed.NOT_BRAND_WORDS)} OR lower({raw}) IN {q(fixed.NOT_BRAND_WORDS)} THEN '通用詞，非特定品牌'
      WHEN regexp_matches({raw}, '{fixed.PROMOTION}') THEN '促銷或販售描述，非品牌證據' WHEN regexp_matches({n}, '^\\p{{Nd}}+$') THEN '純數字'
      WHEN {category} IS NOT NULL THEN '含品類詞「' || {category} || '」，屬商品描述' WHEN regexp_matches({raw}, '{fixed.SPECIFICATION}') THEN '含規格或數量，屬商品描述'
      WHEN {s_cjk(n)} = '' AND length({n}) <= 1 THEN '過短' WHEN length({n}) > 25 THEN '過長，不像品牌名' END"""


def s_generic(x: str) -> str:
    return f"({x} = '' OR regexp_matches({x}, '{'|'.join(fixed.GENERIC_WORDS)}') OR length({s_norm(x)}) > 14)"


def s_host(n: str) -> str:
    return f"({n} IN {q(fixed.HOST_NAMES)} OR regexp_full_match({n}, '{fixed.HOST_FAMILY}'))"


def s_compat(x: str) -> str:
    return f"regexp_matches(coalesce({x}, ''), '{fixed.COMPATIBLE}', 'i')"


def s_access(x: str) -> str:
    return f"regexp_matches(coalesce({x}, ''), '{fixed.ACCESSORY}', 'i')"


def s_key(source: str, brand: str, title: str, item: str) -> str:
    """The source with bracket and key."""
    rows = s_bracket_rows(source, title)
    name = s_norm(s_clean(brand))
    host = s_host(s_norm(f"(CASE WHEN coalesce({brand}, '') <> '' THEN {brand} ELSE bracket END)"))
    return f"""(SELECT *, CASE WHEN {host} AND {s_access(title)} THEN 'I:' || {item} WHEN {name} <> '' THEN 'B:' || {name}
      WHEN bracket <> '' AND ({s_why(s_clean('bracket'))}) IS NULL AND NOT {s_generic('bracket')} THEN 'T:' || {s_norm('bracket')} ELSE 'I:' || {item} END AS key FROM {rows})"""


def s_band(x: str) -> str:
    return "CASE " + " ".join(f"WHEN {x} >= {low} THEN '{label}'" for low, label in fixed.BANDS) + f" ELSE '{fixed.BANDS[-1][1]}' END"


def s_type(x: str) -> str:
    return f"CASE WHEN {x} IN ('{I.NONE}', '{I.NEW}') THEN {x} ELSE '{I.POOL}' END"


def s_ratios(pairs: str) -> str:
    """(a, b, ratio) of pairs (a, b): the table of longest common subsequences, a row for each character of a."""
    cell = "CASE WHEN substr(b, x[1], 1) = substr(a, i + 1, 1) THEN r[x[1]] + 1 ELSE greatest(r[x[1] + 1], acc[len(acc)]) END"
    step = f"list_reduce(list_concat([[0]], list_transform(range(1, length(b) + 1), lambda j: [CAST(j AS INT)])), lambda acc, x: list_append(acc, {cell}))"
    return f"""(WITH RECURSIVE t AS (SELECT a, b, 0 AS i, list_transform(range(0, length(b) + 1), lambda x: 0) AS r FROM {pairs} UNION ALL SELECT a, b, i + 1, {step} FROM t WHERE i < length(a))
    SELECT a, b, 200.0::DOUBLE * r[len(r)] / (length(a) + length(b)) AS ratio FROM t WHERE i = length(a))"""


ITEMS, RESULTS, LOG, RUNS = (I.sql(*x) for x in (("part", I.ITEMS), ("part", I.RESULTS), ("events", I.LOG), ("orders", I.RUNS)))
V = I.TEXTS.sql
STRINGS = I.STRINGS_SQL
items = lambda s, d: I.derived(s, d, "part", I.ITEMS)
results = lambda s, d: I.derived(s, d, "part", I.RESULTS)
log = lambda s, d: I.derived(s, d, "events", I.LOG)
runs = lambda s, d: I.derived(s, d, "orders", I.RUNS)


def _latest(scope: str, keys: str) -> str:
    return f"SELECT * FROM {LOG} WHERE scope = '{scope}' QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY log_id DESC) = 1"


def index(spark: SparkSession) -> pool.Index:
    return pool.build_index(I.BRANDS.df(spark), I.ALIASES.df(spark), I.LINKS.df(spark))


# --- Text functions ---------------------------------------------------------------------------------------
@query(f"SELECT id, {s_clean('s')} AS clean FROM {STRINGS}")
def text_clean(spark, sf_dir):
    return I.strings(spark, sf_dir).select("id", T.clean_raw(F.col("s")).alias("clean"))


# Half-width, square, ligature, full-width and folding forms, worked out from the Unicode data.
_FORMS = I.Values(
    {"s": "VARCHAR", "clean": "VARCHAR", "normal": "VARCHAR", "surface": "VARCHAR"},
    [
        ("ｶﾞｼﾞｪ", "ガジェ", "ガジェ", "ガジェ"), ("ﾌﾟﾗｻﾞ", "プラザ", "プラザ", "プラザ"), ("㌔½ﬁ", "キロ1⁄2fi", "キロ12fi", "キロ1⁄2fi"), ("Ｈ＆Ｈ", "H&H", "hh", "h&h"), ("Cafe\u0301 ①", "Café 1", "café1", "café1"), ("ＳＴＲＡẞＥ", "STRAẞE", "straße", "strasse"),
        ("ΣΊΣΥΦΟΣ", "ΣΊΣΥΦΟΣ", "σίσυφος", "σίσυφοσ"), ("한글", "한글", "한글", "한글"), ("ŉ x", "ʼn x", "ʼnx", "ʼnx"), ("plain Text", "plain Text", "plaintext", "plaintext"), (None, "", "", ""),
    ],
)


@query(_FORMS.sql)
def text_compatibility(spark, sf_dir):
    """Compatibility forms and full case folding."""
    s = F.col("s")
    return _FORMS.df(spark).select("s", T.clean_raw(s).alias("clean"), T.normalize(s).alias("normal"), T.surface_key(s).alias("surface"))


@query(f"SELECT item_id, {s_norm('title')} AS normal FROM {ITEMS}")
def text_normalize(spark, sf_dir):
    return items(spark, sf_dir).select("item_id", T.normalize(F.col("title")).alias("normal"))


@query(f"WITH n AS (SELECT id, {s_norm('s')} AS n FROM {STRINGS}) SELECT id, n AS full_text, {s_lat('n')} AS lat, {s_cjk('n')} AS cjk FROM n")
def text_parts(spark, sf_dir):
    n = F.col("full_text")
    return I.strings(spark, sf_dir).select("id", T.normalize(F.col("s")).alias("full_text")).select("id", n, T.latin_part(n).alias("lat"), T.cjk_part(n).alias("cjk"))


@query(f"SELECT case_id AS id, array_to_string({s_tokens('s')}, ' ') AS tokens FROM {V} UNION ALL SELECT CAST(doc_id AS INT) + 1000, array_to_string({s_tokens('text')}, ' ') FROM documents")
def text_tokens(spark, sf_dir):
    one = I.TEXTS.df(spark).select(F.col("case_id").alias("id"), "s")
    two = I.table(spark, sf_dir, "documents").select((F.col("doc_id") + 1000).cast("int").alias("id"), F.col("text").alias("s"))
    return one.unionByName(two).select("id", F.array_join(F.sort_array(T.latin_tokens(F.col("s"))), " ").alias("tokens"))


@query(f"SELECT id, regexp_replace(replace(lower({s_clean('s')}), 'ß', 'ss'), '\\s+', '', 'g') AS surface FROM {STRINGS}")
def text_surface_key(spark, sf_dir):
    return I.strings(spark, sf_dir).select("id", T.surface_key(F.col("s")).alias("surface"))


@query(rf"SELECT id, regexp_full_match({s_clean('s')}, '[^\x{{3400}}-\x{{9FFF}}]*[A-Za-z0-9][^\x{{3400}}-\x{{9FFF}}]*\s+[\x{{3400}}-\x{{9FFF}}].*') OR regexp_full_match({s_clean('s')}, '[\x{{3400}}-\x{{9FFF}}][^A-Za-z]*\s+[A-Za-z].*') AS bilingual FROM {STRINGS}")
def text_bilingual(spark, sf_dir):
    return I.strings(spark, sf_dir).select("id", T.is_bilingual(T.clean_raw(F.col("s"))).alias("bilingual"))


@query(f"SELECT id, bracket FROM {s_bracket_rows(STRINGS, 's')}")
def text_bracket(spark, sf_dir):
    return I.strings(spark, sf_dir).select("id", T.extract_bracket(F.col("s")).alias("bracket"))


@query(f"WITH c AS (SELECT id, {s_clean('s')} AS c FROM {STRINGS}) SELECT id, {s_generic('c')} AS generic, (length({s_cjk('c')}) = 0 AND length(c) >= 5) OR length({s_cjk('c')}) >= 3 AS long_enough FROM c")
def text_generic(spark, sf_dir):
    return I.strings(spark, sf_dir).select("id", T.clean_raw(F.col("s")).alias("c")).select("id", T.is_generic(F.col("c")).alias("generic"), T.long_enough(F.col("c")).alias("long_enough"))


@query(f"WITH c AS (SELECT CAST(case_id AS VARCHAR) AS id, {s_clean('s')} AS c FROM {V} UNION ALL SELECT s_name, {s_clean('s_name')} FROM supplier UNION ALL SELECT item_id, {s_clean('brand')} FROM {ITEMS}) SELECT id, {s_why('c')} AS why FROM c")
def brand_plausibility(spark, sf_dir):
    one = I.TEXTS.df(spark).select(F.col("case_id").cast("string").alias("id"), "s")
    two = I.table(spark, sf_dir, "supplier").select(F.col("s_name").alias("id"), F.col("s_name").alias("s"))
    three = items(spark, sf_dir).select(F.col("item_id").alias("id"), F.col("brand").alias("s"))
    return one.unionByName(two).unionByName(three).select("id", T.why_not_brand(F.col("s")).alias("why"))


@query(f"SELECT CAST(case_id AS VARCHAR) AS id, {s_compat('s')} AS compatible, {s_access('s')} AS accessory FROM {V} UNION ALL SELECT item_id, {s_compat('brand')}, {s_access('title')} FROM {ITEMS}")
def compat_accessory_flags(spark, sf_dir):
    one = I.TEXTS.df(spark).select(F.col("case_id").cast("string").alias("id"), T.compatible(F.col("s")).alias("compatible"), T.accessory(F.col("s")).alias("accessory"))
    return one.unionByName(items(spark, sf_dir).select(F.col("item_id").alias("id"), T.compatible(F.col("brand")).alias("compatible"), T.accessory(F.col("title")).alias("accessory")))


@query(f"WITH n AS (SELECT id, {s_norm('s')} AS n FROM {STRINGS}) SELECT id, {s_host('n')} AS host FROM n")
def host_platform_flags(spark, sf_dir):
    return I.strings(spark, sf_dir).select("id", T.host_brand(F.col("s")).alias("host"))


_MIXED = f"(SELECT item_id, brand, title FROM {ITEMS} UNION ALL SELECT 'v' || case_id, NULL, s FROM {V} UNION ALL SELECT 'w' || case_id, s, s FROM {V})"


def _mixed(spark, sf_dir):
    v = I.TEXTS.df(spark)
    return items(spark, sf_dir).select("item_id", "brand", "title").unionByName(v.select(F.concat(F.lit("v"), "case_id").alias("item_id"), F.lit(None).cast("string").alias("brand"), F.col("s").alias("title"))).unionByName(v.select(F.concat(F.lit("w"), "case_id").alias("item_id"), F.col("s").alias("brand"), F.col("s").alias("title")))


@query(f"SELECT item_id, key FROM {s_key(_MIXED, 'brand', 'title', 'item_id')}")
def brand_key_assign(spark, sf_dir):
    return _mixed(spark, sf_dir).select("item_id", T.brand_key(F.col("brand"), F.col("title"), F.col("item_id")).alias("key"))


_NAMES = "(SELECT DISTINCT replace(p_name, ' ', '') AS n FROM part UNION SELECT 'brand' || regexp_extract(p_brand, '(\\d+)', 1) FROM part)"
_PAIRS = f"(SELECT x.n AS a, y.n AS b FROM {_NAMES} AS x JOIN {_NAMES} AS y ON substr(x.n, 1, 1) = substr(y.n, 1, 1) AND length(y.n) BETWEEN CAST(floor(length(x.n) * 0.78) AS INT) AND CAST(floor(length(x.n) / 0.78) AS INT) + 1 WHERE length(x.n) >= 5 AND length(y.n) >= 5)"


@query(f"SELECT a, b, round(ratio, 6) AS ratio FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY ratio DESC, b) AS n FROM {s_ratios(_PAIRS)} WHERE ratio >= 40) WHERE n <= 6 AND a <> b")
def similarity_ratio(spark, sf_dir):
    """Each name's most similar ones within its block of first character and length, by the similarity in the JVM."""
    part = I.table(spark, sf_dir, "part")
    names = part.select(F.regexp_replace("p_name", " ", "").alias("key")).union(part.select(F.concat(F.lit("brand"), F.regexp_extract("p_brand", r"(\d+)", 1)))).distinct()
    found = match.similar_keys(names.withColumnRenamed("key", "probe"), names, T.indel_ratio, 40, 6)
    return found.select(F.col("probe").alias("a"), F.col("key").alias("b"), F.round("similarity", 6).alias("ratio"))


@query(f"SELECT log_id, substr(sha1(scope || '|' || rule_key || '|' || decision || '|' || coalesce(CASE WHEN brand_id <> 0 THEN CAST(brand_id AS VARCHAR) END, '') || '|' || brand_name || '|' || nobrand_reason || '|' || note), 1, 16) AS fp FROM {LOG}")
def fingerprint(spark, sf_dir):
    return log(spark, sf_dir).select("log_id", store.entry_fingerprint().alias("fp"))


@query(f"SELECT event_id, {s_band('value')} AS band, CAST(least(greatest(round_even(value, 0), 0), 100) AS INT) AS confidence FROM events")
def confidence_bands(spark, sf_dir):
    return I.table(spark, sf_dir, "events").select("event_id", T.band(F.col("value")).alias("band"), T.clamp_confidence(F.col("value")).alias("confidence"))


@query(f"""SELECT case_id, regexp_replace(trim(regexp_replace(coalesce(s, ''), '[\\\\/:*?"<>|]+', '_', 'g')), '^$', 'L1') AS safe, split_part(coalesce(s, ''), ' ', 1) AS code, coalesce(s, '?') || ' [' || case_id || ']' AS label,
CASE WHEN {s_cjk(s_norm('s'))} <> '' AND {s_lat(s_norm('s'))} <> '' THEN '{fixed.LANG_BOTH}' WHEN {s_cjk(s_norm('s'))} <> '' THEN '{fixed.LANG_CJK}' ELSE '{fixed.LANG_LATIN}' END AS lang,
CASE WHEN length({s_cjk("coalesce(s, '')")}) > 0 THEN length({s_cjk("coalesce(s, '')")}) >= 4 ELSE length(coalesce(s, '')) >= 6 END AS is_distinctive, CASE WHEN case_id % 3 = 0 THEN '{I.NONE}' WHEN case_id % 3 = 1 THEN '{I.POOL}' ELSE 'x' END AS kind,
CASE WHEN s IN ('', 'nan') OR s IS NULL THEN '' ELSE CAST(case_id AS VARCHAR) END AS id_text FROM {V}""")
def text_small_functions(spark, sf_dir):
    s, k = F.col("s"), F.col("case_id")
    legacy = F.when(k % 3 == 0, "NoBrand").when(k % 3 == 1, "品牌池品牌").otherwise("x")
    return I.TEXTS.df(spark).select(
        "case_id", T.safe_name(F.coalesce(s, F.lit(""))).alias("safe"), T.path_code(s).alias("code"), T.label(s, k).alias("label"), T.language(s).alias("lang"), T.distinctive(F.coalesce(s, F.lit(""))).alias("is_distinctive"),
        T.legacy_type(legacy).alias("kind"), T.id_str(F.when(~T.blank(s), k.cast("double"))).alias("id_text"),
    )


# --- Sources and sinks -------------------------------------------------------------------------------------
_LINE = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@query(f"""WITH j AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY {', '.join(_LINE)}) AS rn, count(*) OVER (PARTITION BY p_partkey) AS n FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT CAST(p_partkey AS VARCHAR) AS item_id, p_type AS l1, p_brand AS brand, p_name AS title, CASE WHEN l_linenumber = 0 THEN '' ELSE CAST(l_linenumber AS VARCHAR) END AS price, n AS sku_count FROM j WHERE rn = 1""")
def sku_to_item(spark, sf_dir):
    rows = I.table(spark, sf_dir, "lineitem").join(I.table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    rows = rows.select(F.to_json(F.struct("p_partkey", "p_type", "p_brand", "p_name", "l_linenumber")).alias("payload"), F.struct(*_LINE).alias("o"))
    skus = catalogue.read_sku_json(rows, {"item_id": "p_partkey", "l1": "p_type", "brand": "p_brand", "title": "p_name", "price": "l_linenumber"}, pos=F.col("o"))
    return catalogue.items_from_skus(skus).select("item_id", "l1", "brand", "title", "price", "sku_count")


@query(f"SELECT l1, min(cluster) AS cluster, count(*) AS goods, CAST(sum(sku_count) AS BIGINT) AS skus FROM {ITEMS} GROUP BY l1")
def category_listing(spark, sf_dir):
    return catalogue.list_categories(items(spark, sf_dir))


@query(f"SELECT * FROM {ITEMS} WHERE l1 = 'PROMO'")
def category_scan(spark, sf_dir):
    return catalogue.scan_category(items(spark, sf_dir), "PROMO")


_RAW_ROWS = I.Values({"pos": "BIGINT", "brand_id": "VARCHAR", "brand_name": "VARCHAR", "category": "VARCHAR", "adg": "VARCHAR"}, [(1, "1", " A ", "x", "1,234.5"), (2, "2.0", "B", None, "bad"), (3, "x", "C", "y", "1"), (4, "1", "D", "z", "2"), (5, None, "E", "z", "2"), (6, "7", "F", "", "12,000,000")])


_RAW_POOL = f"(SELECT * FROM {_RAW_ROWS.sql} UNION ALL SELECT 100 + p_partkey, CAST(1000 + p_partkey // 2 AS VARCHAR) || '.0', ' ' || p_name, CASE WHEN p_size > 25 THEN p_type END, CAST(CAST(floor(p_retailprice) AS BIGINT) AS VARCHAR) || ',000' FROM part)"


@query(f"SELECT CAST(TRY_CAST(brand_id AS DOUBLE) AS BIGINT) AS brand_id, trim(brand_name) AS name, coalesce(category, '') AS category, coalesce(TRY_CAST(replace(adg, ',', '') AS DOUBLE), 0) AS adg FROM {_RAW_POOL} WHERE TRY_CAST(brand_id AS DOUBLE) IS NOT NULL QUALIFY row_number() OVER (PARTITION BY TRY_CAST(brand_id AS DOUBLE) ORDER BY pos) = 1")
def pool_typed(spark, sf_dir):
    rows = I.table(spark, sf_dir, "part").selectExpr("100 + p_partkey as pos", "concat(1000 + p_partkey div 2, '.0') as brand_id", "concat(' ', p_name) as brand_name", "case when p_size > 25 then p_type end as category", "concat(cast(floor(p_retailprice) as bigint), ',000') as adg")
    return pool.typed_pool(_RAW_ROWS.df(spark).unionByName(rows))


_CURATED = I.Values({"alias_text": "VARCHAR", "brand_id": "BIGINT"}, [("綠鐘 GB", 1), ("莉婕", 15), ("無此", 500), (" ", 3), ("Kate!", 4)])


_ALIAS_ROWS = f"(SELECT * FROM {_CURATED.sql} UNION ALL SELECT '品 ' || s_name, 1000000 + CAST(s_suppkey AS BIGINT) * 2 FROM supplier)"


@query(f"WITH a AS (SELECT *, {s_norm('alias_text')} AS alias FROM {_ALIAS_ROWS}) SELECT alias_text, brand_id, alias, true AS valid FROM a WHERE brand_id IN (SELECT brand_id FROM {I.WIDE_BRANDS_SQL}) AND alias <> '' UNION ALL SELECT alias_text, brand_id, alias, false FROM a WHERE brand_id NOT IN (SELECT brand_id FROM {I.WIDE_BRANDS_SQL})")
def alias_curation_split(spark, sf_dir):
    rows = I.table(spark, sf_dir, "supplier").selectExpr("concat('品 ', s_name) as alias_text", "1000000 + cast(s_suppkey as bigint) * 2 as brand_id")
    good, bad = catalogue.curated_aliases(_CURATED.df(spark).unionByName(rows), I.wide_brands(spark, sf_dir))
    return good.withColumn("valid", F.lit(True)).unionByName(bad.withColumn("valid", F.lit(False)))


_EXPORT = f"""SELECT i.item_id, i.cluster, i.l1, i.l2, i.l3, i.brand, i.title, candidate1, candidate2, candidate3, CASE WHEN suggested_name = '{I.NEW}' AND new_name <> '' THEN new_name ELSE suggested_name END AS tagged_brand, confidence,
CASE WHEN confidence < 75 OR suggested_name = '{I.NEW}' THEN '是' ELSE '否' END AS needs_human, path FROM {ITEMS} AS i JOIN {RESULTS} AS r ON i.item_id = r.item_id"""


@query(f"{_EXPORT} WHERE r.level1 IN ('PROMO', 'SMALL')")
def export_items(spark, sf_dir):
    return catalogue.export_items(items(spark, sf_dir), results(spark, sf_dir), ["PROMO", "SMALL"])


@query(f"SELECT CASE WHEN row_number() OVER (ORDER BY item_id) <= count(*) OVER () // 2 THEN 1 ELSE 2 END AS half, item_id, cluster, l1, l2, l3, brand, title, tagged_brand, confidence, needs_human, split_part(path, ' ', 1) AS path_code FROM ({_EXPORT})")
def export_slim(spark, sf_dir):
    return catalogue.slim_export(catalogue.export_items(items(spark, sf_dir), results(spark, sf_dir)))


# --- Brand index ---------------------------------------------------------------------------------------------
_PARTS = f"(SELECT *, {s_lat('full_')} AS lat, {s_cjk('full_')} AS cjk FROM (SELECT *, {s_norm('name')} AS full_, regexp_replace(replace(lower({s_clean('name')}), 'ß', 'ss'), '\\s+', '', 'g') AS surface FROM {I.WIDE_BRANDS_SQL}))"
_REAL = f"(SELECT * FROM {_PARTS} WHERE brand_id NOT IN (0, 99999999))"
_NATURAL = f"(SELECT DISTINCT key, brand_id FROM (SELECT unnest([full_, lat, cjk]) AS key, brand_id, full_ FROM {_REAL}) WHERE length(key) >= 2 OR (key <> '' AND key = full_))"
_KEYS = f"""(SELECT key, brand_id, bool_or(source = 'human') AS human, bool_or(source = 'curated') AS curated, bool_or(source = 'auto') AND NOT bool_or(source = 'natural') AS auto, bool_or(source = 'natural') AS "natural"
FROM (SELECT key, brand_id, 'natural' AS source FROM {_NATURAL} UNION ALL SELECT alias, brand_id, source FROM {I.ALIASES.sql} WHERE brand_id IN (SELECT brand_id FROM {_REAL})) GROUP BY key, brand_id)"""
_LONG = f"(SELECT * FROM {_KEYS} WHERE ((length({s_cjk('key')}) = 0 AND length(key) >= 5) OR length({s_cjk('key')}) >= 3) AND key NOT IN {q([*fixed.GENERIC_KEYS, *fixed.STOP_TOKENS])})"
_Q = f"(SELECT *, {s_lat('full_')} AS lat, {s_cjk('full_')} AS cjk FROM (SELECT DISTINCT s, {s_norm('s')} AS full_, regexp_replace(replace(lower({s_clean('s')}), 'ß', 'ss'), '\\s+', '', 'g') AS surface, {s_clean('s')} AS clean FROM {STRINGS}) WHERE full_ <> '')"


def _parts(spark):
    return pool.with_parts(I.BRANDS.df(spark))


def _wide_parts(spark, sf_dir):
    return pool.with_parts(I.wide_brands(spark, sf_dir))


def wide_index(spark, sf_dir):
    return pool.build_index(I.wide_brands(spark, sf_dir), I.ALIASES.df(spark), I.LINKS.df(spark))


@query(f"SELECT * FROM {_KEYS}")
def pool_key_index(spark, sf_dir):
    return pool.key_index(_wide_parts(spark, sf_dir), I.ALIASES.df(spark))


@query(f"SELECT unnest({s_tokens('name')}) AS token, brand_id FROM {_REAL}")
def pool_token_index(spark, sf_dir):
    return pool.token_index(_wide_parts(spark, sf_dir))


@query(f"SELECT substr(cjk, 1, 2) AS bucket, cjk, brand_id FROM {_REAL} WHERE length(cjk) >= 3")
def pool_prefix_bucket(spark, sf_dir):
    return pool.prefix_buckets(_wide_parts(spark, sf_dir))


@query(f"WITH l AS (SELECT * FROM {I.LINKS.sql} WHERE brand_id_a <> brand_id_b AND brand_id_a IN (SELECT brand_id FROM {_PARTS}) AND brand_id_b IN (SELECT brand_id FROM {_PARTS})) SELECT brand_id_a AS brand_id, brand_id_b AS peer FROM l UNION SELECT brand_id_b, brand_id_a FROM l")
def pool_entity_links(spark, sf_dir):
    return pool.entity_links(_wide_parts(spark, sf_dir), I.LINKS.df(spark))


_TYPED = I.Values({"typed": "VARCHAR"}, [("KATE 凱婷 [4]",), ("13",), ("13.0",), ("555",), ("sony",), ("H&H",), ("nothing",), ("Liese",)])


@query(f"""WITH t AS (SELECT typed, CASE WHEN regexp_matches(trim(typed), '\\[(\\d+)\\]\\s*$') THEN regexp_extract(trim(typed), '\\[(\\d+)\\]\\s*$', 1) ELSE trim(typed) END AS t FROM (SELECT typed FROM {_TYPED.sql} UNION SELECT s FROM {STRINGS} WHERE trim(coalesce(s, '')) <> '')),
n AS (SELECT *, CASE WHEN regexp_full_match(t, '\\d+(\\.0)?') THEN CAST(CAST(t AS DOUBLE) AS BIGINT) END AS id FROM t),
u AS (SELECT *, CASE WHEN id IS NULL THEN {s_norm('t')} END AS norm FROM n), b AS (SELECT full_, list_sort(list(brand_id)) AS ids FROM {_PARTS} GROUP BY full_),
f AS (SELECT u.*, (SELECT count(*) FROM {I.WIDE_BRANDS_SQL} AS x WHERE x.brand_id = u.id) AS known, b.ids FROM u LEFT JOIN b ON b.full_ = u.norm)
SELECT typed, CASE WHEN id IS NOT NULL THEN CASE WHEN known > 0 THEN id END WHEN len(ids) = 1 THEN ids[1] END AS brand_id,
CASE WHEN id IS NOT NULL AND known = 0 THEN 'brand_id ' || id || ' 不在品牌庫' WHEN id IS NULL AND coalesce(len(ids), 0) > 1 THEN '「' || t || '」在品牌庫有多筆 (' || array_to_string(ids, ', ') || ')，請改填 brand_id'
WHEN id IS NULL AND coalesce(len(ids), 0) < 1 THEN '品牌庫找不到「' || t || '」（品牌庫沒有的品牌請選：{I.NEW}）' END AS error FROM f""")
def resolve_input(spark, sf_dir):
    names = I.strings(spark, sf_dir).where("trim(coalesce(s, '')) <> ''").select(F.col("s").alias("typed")).distinct()
    return pool.resolve_input(_TYPED.df(spark).unionByName(names).distinct(), _wide_parts(spark, sf_dir))


# --- Candidates -----------------------------------------------------------------------------------------------
def _texts(spark):
    return match.with_query_parts(I.TEXTS.df(spark).where("s is not null"))


def _wide_texts(spark, sf_dir):
    return match.with_query_parts(I.strings(spark, sf_dir).where("s is not null"))


def _short(df):
    return df.select("s", "brand_id", "score", "via", "alias")


@query(f"""WITH q AS (SELECT * FROM {_Q}), c1 AS (SELECT q.s, q.full_, p.brand_id FROM q JOIN {_PARTS} AS p ON q.surface = p.surface),
l AS (SELECT brand_id_a AS a, brand_id_b AS b FROM {I.LINKS.sql} WHERE brand_id_a IN (SELECT brand_id FROM {_PARTS}) AND brand_id_b IN (SELECT brand_id FROM {_PARTS}) AND brand_id_a <> brand_id_b), peers AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT q.s, q.full_, k.brand_id, p.full_ = q.full_ OR human OR curated AS whole FROM q JOIN {_KEYS} AS k ON k.key = q.full_ JOIN {_PARTS} AS p ON p.brand_id = k.brand_id WHERE q.s NOT IN (SELECT s FROM c1))
SELECT s, brand_id, 100.0::DOUBLE AS score, 'surface' AS via, full_ AS alias FROM c1 UNION ALL SELECT DISTINCT s, b, 100.0::DOUBLE, 'entity', full_ FROM c1 JOIN peers ON a = brand_id
UNION ALL SELECT s, brand_id, CASE WHEN whole THEN 100.0::DOUBLE ELSE 95.0::DOUBLE END, CASE WHEN whole THEN 'full' WHEN regexp_matches(full_, '[{CJK}]') THEN 'cjk' ELSE 'lat' END, full_ FROM r""")
def match_exact(spark, sf_dir):
    return _short(match.exact_candidates(_wide_texts(spark, sf_dir), wide_index(spark, sf_dir)))


@query(f"""WITH q AS (SELECT *, regexp_full_match(clean, '[^\\x{{3400}}-\\x{{9FFF}}]*[A-Za-z0-9][^\\x{{3400}}-\\x{{9FFF}}]*\\s+[\\x{{3400}}-\\x{{9FFF}}].*') OR regexp_full_match(clean, '[\\x{{3400}}-\\x{{9FFF}}][^A-Za-z]*\\s+[A-Za-z].*') AS bil FROM {_Q}),
hl AS (SELECT q.*, k.brand_id, k.auto FROM q JOIN {_KEYS} AS k ON k.key = q.lat WHERE length(lat) >= 2 AND lat <> full_), hc AS (SELECT q.*, k.brand_id, k.auto FROM q JOIN {_KEYS} AS k ON k.key = q.cjk WHERE length(cjk) >= 2 AND cjk <> full_),
b AS (SELECT hl.s, hl.brand_id, hl.full_ FROM hl JOIN hc ON hl.s = hc.s AND hl.brand_id = hc.brand_id WHERE NOT hl.auto AND NOT hc.auto)
SELECT s, brand_id, 100.0::DOUBLE AS score, 'full' AS via, full_ AS alias FROM b
UNION ALL SELECT s, brand_id, CASE WHEN length(lat) <= 3 AND cjk <> '' AND NOT bil THEN 70.0::DOUBLE WHEN length(lat) <= 2 AND cjk <> '' THEN 85.0::DOUBLE ELSE 95.0::DOUBLE END, 'lat', lat FROM hl WHERE (s, brand_id) NOT IN (SELECT (s, brand_id) FROM b)
UNION ALL SELECT s, brand_id, CASE WHEN length(cjk) <= 2 AND length(lat) >= 4 AND NOT bil THEN 70.0::DOUBLE ELSE 95.0::DOUBLE END, 'cjk', cjk FROM hc WHERE (s, brand_id) NOT IN (SELECT (s, brand_id) FROM b)""")
def match_parts(spark, sf_dir):
    return _short(match.part_candidates(_wide_texts(spark, sf_dir), wide_index(spark, sf_dir)))


@query(f"""WITH w AS (SELECT s, full_, {s_norm('word')} AS word FROM (SELECT s, full_, unnest(regexp_split_to_array(clean, '[\\s/|｜]+')) AS word FROM {_Q} WHERE len(regexp_split_to_array(clean, '[\\s/|｜]+')) > 1))
SELECT w.s, k.brand_id, 85.0::DOUBLE AS score, 'word' AS via, w.word AS alias FROM w JOIN {_KEYS} AS k ON k.key = w.word JOIN {_PARTS} AS p ON p.brand_id = k.brand_id
WHERE word <> '' AND word <> w.full_ AND word NOT IN {q([*fixed.STOP_TOKENS, *fixed.GENERIC_KEYS])} AND (length(word) >= 3 OR (length(word) >= 2 AND regexp_matches(word, '[{CJK}]'))) AND word IN (p.full_, p.lat, p.cjk)""")
def match_word(spark, sf_dir):
    return _short(match.word_candidates(_wide_texts(spark, sf_dir), wide_index(spark, sf_dir)))


@query(f"WITH t AS (SELECT s, unnest({s_tokens('s')}) AS token FROM {_Q}), p AS (SELECT unnest({s_tokens('name')}) AS token, brand_id FROM {_REAL}) SELECT s, brand_id, 65.0::DOUBLE AS score, 'tok' AS via, t.token AS alias FROM t JOIN p ON t.token = p.token")
def match_token(spark, sf_dir):
    return _short(match.token_candidates(_wide_texts(spark, sf_dir), wide_index(spark, sf_dir)))


@query(f"SELECT DISTINCT s, brand_id, 75.0::DOUBLE AS score, 'sub' AS via, key AS alias FROM {_Q} JOIN {_LONG} ON contains(full_, key) AND key <> full_ AND length(key) BETWEEN 3 AND 25")
def match_substring(spark, sf_dir):
    return _short(match.substring_candidates(_wide_texts(spark, sf_dir), wide_index(spark, sf_dir))).distinct()


@query(f"""WITH q AS (SELECT * FROM {_Q} WHERE length(cjk) >= 2 AND cjk NOT IN (SELECT key FROM {_KEYS})), h AS (SELECT q.s, q.cjk, p.brand_id, substr(p.cjk, length(q.cjk) + 1) AS tail, count(*) OVER (PARTITION BY q.s) AS n FROM q JOIN {_REAL} AS p ON length(p.cjk) >= 3 AND p.cjk <> q.cjk AND starts_with(p.cjk, q.cjk))
SELECT s, brand_id, CASE WHEN n = 1 AND (tail IN {q(fixed.CORPORATE_SUFFIXES)} OR length(tail) <= 2) THEN 95.0::DOUBLE WHEN tail IN {q(fixed.CORPORATE_SUFFIXES)} THEN 85.0::DOUBLE ELSE 82.0::DOUBLE END AS score, 'cjkpre' AS via, cjk AS alias
FROM h WHERE n <= CASE WHEN length(cjk) = 2 THEN 2 ELSE 3 END AND (length(cjk) > 2 OR tail IN {q(fixed.CORPORATE_SUFFIXES)})""")
def match_prefix(spark, sf_dir):
    return _short(match.prefix_candidates(_wide_texts(spark, sf_dir), wide_index(spark, sf_dir)))


_PROBES = "(SELECT DISTINCT replace(substr(p_name, 1, 5) || 'x' || substr(p_name, 7), ' ', '') AS p FROM part)"
_PLAIN = "(SELECT DISTINCT replace(p_name, ' ', '') AS k FROM part)"
_NEAR = f"(SELECT p AS a, k AS b FROM {_PROBES} JOIN {_PLAIN} ON substr(p, 1, 1) = substr(k, 1, 1) AND length(k) BETWEEN CAST(floor(length(p) * 0.78) AS INT) AND CAST(floor(length(p) / 0.78) AS INT) + 1 WHERE length(p) >= 5 AND length(k) >= 5)"


@query(f"SELECT a AS probe, b AS key, round(ratio, 6) AS similarity FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY ratio DESC, b) AS n FROM {s_ratios(_NEAR)} WHERE ratio >= 80) WHERE n <= 3 AND a <> b")
def match_fuzzy(spark, sf_dir):
    probes = I.table(spark, sf_dir, "part").select(F.concat(F.substring("p_name", 1, 5), F.lit("x"), F.expr("substring(p_name, 7)")).alias("probe"))
    found = match.similar_keys(probes.select(F.regexp_replace("probe", " ", "").alias("probe")), I.table(spark, sf_dir, "part").select(F.regexp_replace("p_name", " ", "").alias("key")), T.indel_ratio, 80)
    return found.select("probe", "key", F.round("similarity", 6).alias("similarity"))


@query(f"""WITH t AS (SELECT DISTINCT title AS s, {s_norm('title')} AS n FROM {ITEMS} UNION SELECT s, {s_norm('s')} FROM {V} WHERE s IS NOT NULL), h AS (SELECT DISTINCT s, brand_id, key FROM t JOIN {_LONG} ON contains(n, key) AND length(key) BETWEEN 3 AND 20)
SELECT s, brand_id, CAST(max(length(key)) AS INT) AS alias_len FROM h WHERE brand_id NOT IN (10, 11, 12) GROUP BY s, brand_id UNION ALL SELECT s, 11, NULL FROM h WHERE brand_id IN (10, 11, 12) GROUP BY s""")
def scan_title(spark, sf_dir):
    titles = items(spark, sf_dir).select(F.col("title").alias("s")).unionByName(I.TEXTS.df(spark).where("s is not null").select("s"))
    found = match.scan_titles(titles, wide_index(spark, sf_dir))
    return found.select("s", "brand_id", F.when(F.col("brand_id") != 11, F.col("alias_len")).alias("alias_len"))


# Worked out by hand from the generators', penalties' and product lines' definitions.
_CANDIDATES = I.Values(
    {"s": "VARCHAR", "brand_id": "BIGINT", "score": "DOUBLE", "via": "VARCHAR", "source": "VARCHAR", "weak_short": "BOOLEAN"},
    [
        ("  官方旗艦店 Dove 多芬 ", 8, 100.0, "surface", "natural", False), ("ASUS/ROG", 17, 85.0, "word", "natural", False), ("ASUS/ROG", 18, 85.0, "word", "natural", False), ("GB 綠鐘", 1, 100.0, "full", "curated", False), ("GB 綠鐘", 2, 95.0, "cjk", "auto", True),
        ("H&H", 5, 100.0, "surface", "natural", False), ("H&H", 7, 100.0, "entity", "curated", False), ("Kanebo 佳麗寶 KATE 凱婷", 3, 55.0, "word", "natural", False), ("Kanebo 佳麗寶 KATE 凱婷", 4, 85.0, "word", "natural", False), ("LG生活健康", 23, 70.0, "lat", "natural", True),
        ("MUK 潮嘜", 22, 100.0, "surface", "natural", False), ("iPhone15", 11, 75.0, "sub", "natural", False), ("【】[Samsung] 手機", 13, 95.0, "lat", "natural", False), ("【日本 Sony】 相機", 9, 95.0, "lat", "natural", False), ("日本 韓國 Liese 莉婕", 15, 95.0, "lat", "natural", False),
        ("日本 韓國 Liese 莉婕", 16, 95.0, "lat", "natural", False), ("葡萄王", 14, 95.0, "cjkpre", "natural", False), ("適用 iPhone 15 保護殼", 11, 55.0, "tok", "natural", False),
    ],
)


@query(_CANDIDATES.sql)
def match_candidates(spark, sf_dir):
    """Evidence merge, penalties and product lines over all generators."""
    return match.match(_texts(spark).select("s"), index(spark)).select("s", "brand_id", "score", "via", "source", "weak_short")


_BLOCKED = f"(SELECT *, count(*) OVER (PARTITION BY block) AS n FROM (SELECT *, CASE WHEN lat <> '' THEN substr(lat, 1, 6) ELSE substr(cjk, 1, 2) END AS block FROM {_REAL} WHERE full_ <> ''))"
_BESIDE = f"(SELECT a.brand_id AS a_id, b.brand_id AS b_id, a.full_ AS af, b.full_ AS bf, a.lat AS al, b.lat AS bl, a.cjk AS ac, b.cjk AS bc FROM {_BLOCKED} AS a JOIN {_BLOCKED} AS b ON a.block = b.block AND a.brand_id < b.brand_id WHERE a.n <= 200)"


@query(f"""WITH p AS (SELECT * FROM {_BESIDE}), r AS (SELECT a, b FROM {s_ratios(f'(SELECT DISTINCT af AS a, bf AS b FROM {_BESIDE})')} WHERE ratio >= 95)
SELECT a_id AS a, b_id AS b FROM p WHERE af = bf OR EXISTS (SELECT 1 FROM r WHERE r.a = af AND r.b = bf)
OR (starts_with(bf, af) AND length(af) >= 2 AND substr(bf, length(af) + 1) IN {q(fixed.CORPORATE_SUFFIXES)}) OR (starts_with(af, bf) AND length(bf) >= 2 AND substr(af, length(bf) + 1) IN {q(fixed.CORPORATE_SUFFIXES)})
OR (length(al) >= 4 AND al = bl AND (ac = '' OR bc = '' OR ac = bc)) OR (ac <> '' AND ac = bc AND (al = '' OR bl = '' OR al = bl))
UNION SELECT 5, 7""")
def same_entity_pairs(spark, sf_dir):
    ix = wide_index(spark, sf_dir)
    return pool.same_entity_pairs(ix.parts, ix.links)


@query("SELECT * FROM (VALUES (5::BIGINT, 5::BIGINT, 1), (5, 6, 2), (15, 15, 2), (15, 16, 1), (19, 19, 2), (19, 20, 1)) AS t(\"group\", brand_id, position)")
def duplicate_groups(spark, sf_dir):
    """Groups among all brands; those named by the tables' rows have no registration twice."""
    ix = wide_index(spark, sf_dir)
    return pool.duplicate_groups(ix.parts, ix.links)


_NAME_PAIRS = f"(SELECT x.n AS a, y.n AS b FROM {_NAMES} AS x JOIN {_NAMES} AS y ON substr(x.n, 1, 3) = substr(y.n, 1, 3))"


@query(f"SELECT a, b, a = b OR (least(length(a), length(b)) >= 3 AND (contains(a, b) OR contains(b, a))) OR ratio >= 85 AS is_close FROM {s_ratios(_NAME_PAIRS)}")
def names_close(spark, sf_dir):
    part = I.table(spark, sf_dir, "part")
    names = part.select(F.regexp_replace("p_name", " ", "").alias("a")).union(part.select(F.concat(F.lit("brand"), F.regexp_extract("p_brand", r"(\d+)", 1)))).distinct().withColumn("c", F.substring("a", 1, 3))
    pairs = names.join(names.withColumnRenamed("a", "b"), "c").drop("c")
    return pairs.select("a", "b", pool.names_close(F.col("a"), F.col("b")).alias("is_close"))


# --- Decisions --------------------------------------------------------------------------------------------------
CASES = I.Values(
    {"case_id": "VARCHAR", "raw_brand": "VARCHAR", "title": "VARCHAR", "cat": "VARCHAR", "cat_check": "BOOLEAN"},
    [
        ("a1", "GB 綠鐘", "", "Beauty", False), ("a2", "H&H", "", "", False), ("a3", "Kanebo 佳麗寶 KATE 凱婷", "", "", False), ("a4", "iPhone 15", "", "", False), ("a5", "OEM", "", "", False), ("a6", "適用 iPhone", "", "", False), ("a7", "收納用品", "", "", False), ("a8", "茉家", "", "", False),
        ("a9", "", "【Samsung】 手機", "", False), ("b1", "", "【Apple】 iPhone 15 保護殼", "", False), ("b2", "", "【MEIDIAN】 東西", "", False), ("b3", "", "手機 保護殼", "", False), ("b4", "", "東西 Samsung 手機", "", False), ("b5", "", "【買一送一】 東西", "", False), ("b6", None, None, "", False),
    ],
)
_EXPECTED = [
    ("a1", 1, "1.3", 98), ("a2", 7, "1.4", 93), ("a3", 4, "1.3", 92), ("a4", 11, "1.3", 92), ("a5", 0, "1.1", 97), ("a6", 0, "1.2", 90), ("a7", 0, "1.7", 80), ("a8", None, "1.6", 85),
    ("a9", 13, "2.2", 93), ("b1", 0, "2.1", 65), ("b2", None, "2.3", 72), ("b3", 0, "2.1", 88), ("b4", 13, "2.4", 52), ("b5", 0, "2.5", 85), ("b6", 0, "2.5", 85),
]


@query(I.Values({"case_id": "VARCHAR", "brand_id": "BIGINT", "node": "VARCHAR", "confidence": "INT"}, _EXPECTED).sql)
def tag_reference_cases(spark, sf_dir):
    got = decide.tag(CASES.df(spark), index(spark))
    return got.select("case_id", "brand_id", T.path_code(F.col("path")).alias("node"), "confidence")


def part_pool(spark, sf_dir):
    """Brands named by the parts' brand column; the sales figure is their retail value."""
    p = I.table(spark, sf_dir, "part").groupBy("p_brand").agg(F.sum(F.floor("p_retailprice")).cast("double").alias("adg"))
    return p.select((F.lit(100) + F.regexp_extract("p_brand", r"(\d+)", 1).cast("long")).alias("brand_id"), F.col("p_brand").alias("name"), F.lit("").alias("category"), "adg")


def part_index(spark, sf_dir):
    none = spark.createDataFrame([], "alias string, brand_id long, source string"), spark.createDataFrame([], "brand_id_a long, brand_id_b long")
    return pool.build_index(part_pool(spark, sf_dir), *none)


# The leaf of each brand text of the derived items, by the rules: the digits decide whether one or two brand names are inside "Zed...".
_LEAVES = f"""(SELECT *, CAST(item_id AS BIGINT) % 7 AS m, CAST(regexp_extract(l3, '(\\d+)', 1) AS BIGINT) AS no FROM {s_key(ITEMS, 'brand', 'title', 'item_id')})"""


_OUTCOMES = f"""(SELECT CASE m WHEN 0 THEN '2.2' WHEN 1 THEN '1.1' WHEN 2 THEN '1.2' WHEN 3 THEN '1.3' WHEN 4 THEN CASE WHEN no < 10 THEN '1.3' ELSE '1.5' END ELSE '1.6' END AS node, CASE WHEN m IN (1, 2) THEN '{I.NONE}' WHEN m > 4 THEN '{I.NEW}' ELSE '{I.POOL}' END AS outcome,
CASE m WHEN 0 THEN 93 WHEN 1 THEN 97 WHEN 2 THEN 90 WHEN 3 THEN 98 WHEN 4 THEN CASE WHEN no < 10 THEN 86 ELSE 33 END ELSE 85 END AS c FROM {_LEAVES})"""


@query(f"SELECT node, outcome, count(*) AS goods, CAST(min(c) AS INT) AS confidence_min, CAST(max(c) AS INT) AS confidence_max FROM {_OUTCOMES} GROUP BY node, outcome")
def brand_distribution(spark, sf_dir):
    """Flagship: all items, tagged and counted by node."""
    got = decide.tag_items(items(spark, sf_dir), part_index(spark, sf_dir))
    return got.groupBy(T.path_code(F.col("path")).alias("node"), "outcome").agg(F.count("*").alias("goods"), F.min("confidence").alias("confidence_min"), F.max("confidence").alias("confidence_max"))


@query(f"""SELECT item_id, key, CASE m WHEN 0 THEN '2.2' WHEN 1 THEN '1.1' WHEN 2 THEN '1.2' WHEN 3 THEN '1.3' WHEN 4 THEN CASE WHEN no < 10 THEN '1.3' ELSE '1.5' END ELSE '1.6' END AS node, CASE WHEN m IN (1, 2) THEN '0' WHEN m > 4 THEN '' ELSE CAST(100 + no AS VARCHAR) END AS suggested_id,
CASE WHEN m > 4 THEN brand ELSE '' END AS new_name, CASE m WHEN 1 THEN '{fixed.REASON_WORD}' WHEN 2 THEN '{fixed.REASON_COMPATIBLE}' ELSE '' END AS no_brand_reason, CASE m WHEN 0 THEN 93 WHEN 1 THEN 97 WHEN 2 THEN 90 WHEN 3 THEN 98 WHEN 4 THEN CASE WHEN no < 10 THEN 86 ELSE 33 END ELSE 85 END AS confidence FROM {_LEAVES}""")
def tag_items(spark, sf_dir):
    """Every item with its outcome."""
    got = decide.tag_items(items(spark, sf_dir), part_index(spark, sf_dir))
    return got.select("item_id", "key", T.path_code(F.col("path")).alias("node"), "suggested_id", "new_name", "no_brand_reason", "confidence")


@query(f"""WITH r AS (SELECT 'B:brand' || substr(rule_key, 3) AS key, decision, brand_id, brand_name FROM ({_latest('brand', 'rule_key')}) WHERE decision <> '{fixed.REVOKED}')
SELECT t.item_id, t.key, CASE WHEN decision IS NULL THEN CASE WHEN m IN (1, 2) THEN '{I.NONE}' WHEN m > 4 THEN '{I.NEW}' ELSE l3 END WHEN decision = '{I.POOL}' THEN brand_name ELSE decision END AS suggested_name,
CASE WHEN decision IS NULL THEN CASE WHEN m IN (1, 2) THEN '0' WHEN m > 4 THEN '' ELSE CAST(100 + no AS VARCHAR) END WHEN decision = '{I.POOL}' THEN CAST(brand_id AS VARCHAR) WHEN decision = '{I.NONE}' THEN '0' ELSE '' END AS suggested_id,
CASE WHEN decision IS NULL THEN CASE WHEN m > 4 THEN brand ELSE '' END WHEN decision = '{I.NEW}' THEN brand_name ELSE '' END AS new_name, CASE WHEN decision IS NOT NULL THEN '' WHEN m = 1 THEN '{fixed.REASON_WORD}' WHEN m = 2 THEN '{fixed.REASON_COMPATIBLE}' ELSE '' END AS no_brand_reason,
CASE WHEN decision IS NOT NULL THEN 100 WHEN m = 0 THEN 93 WHEN m = 1 THEN 97 WHEN m = 2 THEN 90 WHEN m = 3 THEN 98 WHEN m = 4 THEN CASE WHEN no < 10 THEN 86 ELSE 33 END ELSE 85 END AS confidence,
CASE WHEN decision IS NOT NULL THEN '3.1' WHEN m = 0 THEN '2.2' WHEN m = 1 THEN '1.1' WHEN m = 2 THEN '1.2' WHEN m = 3 THEN '1.3' WHEN m = 4 THEN CASE WHEN no < 10 THEN '1.3' ELSE '1.5' END ELSE '1.6' END AS node FROM {_LEAVES} AS t LEFT JOIN r ON r.key = t.key""")
def tag_with_rules(spark, sf_dir):
    """Every item, with rules from the decision log laid over."""
    rules = store.latest(log(spark, sf_dir), "brand").withColumn("rule_key", F.concat(F.lit("B:brand"), F.expr("substring(rule_key, 3)")))
    got = decide.tag_items(items(spark, sf_dir), part_index(spark, sf_dir), rules)
    return got.select("item_id", "key", "suggested_name", "suggested_id", "new_name", "no_brand_reason", "confidence", T.path_code(F.col("path")).alias("node"))


@query(f"""WITH k AS (SELECT * FROM {s_key(ITEMS, 'brand', 'title', 'item_id')}), f AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY l1, key ORDER BY item_id) = 1),
m AS (SELECT l1, key, l2 FROM (SELECT l1, key, l2, count(*) AS n FROM k GROUP BY l1, key, l2) QUALIFY row_number() OVER (PARTITION BY l1, key ORDER BY n DESC, l2) = 1), c AS (SELECT l1, key, count(*) AS goods FROM k GROUP BY l1, key)
SELECT f.key, f.brand AS raw_brand, f.title, f.l1, goods, m.l2 AS main_l2 FROM f JOIN m ON m.key = f.key AND m.l1 = f.l1 JOIN c ON c.key = f.key AND c.l1 = f.l1""")
def key_aggregate(spark, sf_dir):
    return decide.key_table(items(spark, sf_dir))


@query("SELECT * FROM (VALUES ('a1', 1::BIGINT, 98, 2::BIGINT, 74)) AS t(case_id, brand_id, confidence, other_id, other_confidence)")
def scenario_comparison(spark, sf_dir):
    """Cases whose outcome changes when aliases that people checked are left out."""
    cases = CASES.df(spark)
    now = decide.tag(cases, index(spark)).select("case_id", "brand_id", "confidence")
    without = pool.build_index(I.BRANDS.df(spark), I.ALIASES.df(spark).where("source = 'auto'"), I.LINKS.df(spark))
    then = decide.tag(cases, without).select("case_id", F.col("brand_id").alias("other_id"), F.col("confidence").alias("other_confidence"))
    return now.join(then, "case_id").where(~F.col("brand_id").eqNullSafe(F.col("other_id")) | (F.col("confidence") != F.col("other_confidence")))


# --- Decision log ---------------------------------------------------------------------------------------------------
@query(f"SELECT rule_key, decision, brand_id, brand_name, log_id FROM ({_latest('brand', 'rule_key')}) WHERE decision <> '{fixed.REVOKED}'")
def latest_rules(spark, sf_dir):
    return store.latest(log(spark, sf_dir), "brand").select("rule_key", "decision", "brand_id", "brand_name", "log_id")


@query(f"SELECT site, rule_key, decision, brand_id, log_id FROM ({_latest('item', 'site, rule_key')}) WHERE decision <> '{fixed.REVOKED}'")
def latest_overrides(spark, sf_dir):
    return store.latest(log(spark, sf_dir), "item").select("site", "rule_key", "decision", "brand_id", "log_id")


@query(f"SELECT log_id, rule_key, decision FROM {LOG} WHERE rule_key = 'B:8'")
def decision_history(spark, sf_dir):
    return store.history(log(spark, sf_dir), "B:8").select("log_id", "rule_key", "decision")


@query(f"SELECT log_id, rule_key, decision FROM {LOG} ORDER BY log_id DESC LIMIT 25")
def recent_history(spark, sf_dir):
    return store.history(log(spark, sf_dir), limit=25).select("log_id", "rule_key", "decision")


def _batch(spark, sf_dir):
    """Each key's second last decision typed in again."""
    rows = log(spark, sf_dir).where("scope = 'brand'")
    last = rows.groupBy(F.col("rule_key").alias("k")).agg(F.max("log_id").alias("last"))
    rest = [c for c in rows.columns if c != "rule_key"]
    before = rows.join(last, F.col("rule_key") == F.col("k")).where("log_id < last")
    return before.groupBy("rule_key").agg(F.max_by(F.struct(*rest), "log_id").alias("r")).select("rule_key", "r.*").withColumnRenamed("log_id", "pos").withColumn("scope", F.lit("brand"))


_FP = "coalesce(CASE WHEN {0}brand_id <> 0 THEN CAST({0}brand_id AS VARCHAR) END, '') || '|' || {0}decision || '|' || {0}brand_name || '|' || {0}note"


@query(f"""WITH e AS (SELECT * FROM {LOG} WHERE scope = 'brand' QUALIFY row_number() OVER (PARTITION BY rule_key ORDER BY log_id DESC) = 2), c AS (SELECT * FROM ({_latest('brand', 'rule_key')}) WHERE decision <> '{fixed.REVOKED}')
SELECT e.rule_key, e.decision, e.log_id AS pos FROM e LEFT JOIN c ON c.rule_key = e.rule_key WHERE CASE WHEN c.rule_key IS NULL THEN e.decision <> '{fixed.REVOKED}' ELSE {_FP.format('e.')} <> {_FP.format('c.')} END""")
def idempotent_append(spark, sf_dir):
    return store.new_entries(log(spark, sf_dir), _batch(spark, sf_dir), "s0").select("rule_key", "decision", "pos")


_NEW_ALIASES = I.Values({"alias": "VARCHAR", "brand_id": "BIGINT", "source": "VARCHAR"}, [("綠鐘", 2, "curated"), ("莉婕", 15, "auto"), ("新", 3, "auto"), ("", 3, "human"), ("y", None, "human")])


_PART_ALIASES = "SELECT p_name AS alias, CAST(p_size AS BIGINT) AS brand_id, CASE p_partkey % 3 WHEN 0 THEN 'auto' WHEN 1 THEN 'curated' ELSE 'human' END AS source FROM part"


@query(f"""WITH a AS (SELECT * FROM {I.ALIASES.sql} UNION ALL SELECT * FROM (SELECT * FROM {_NEW_ALIASES.sql} UNION ALL {_PART_ALIASES}) WHERE alias <> '' AND brand_id IS NOT NULL)
SELECT alias, brand_id, arg_max(source, CASE source WHEN 'auto' THEN 1 WHEN 'curated' THEN 2 ELSE 3 END) AS source FROM a GROUP BY alias, brand_id""")
def alias_promotion(spark, sf_dir):
    rows = I.table(spark, sf_dir, "part").selectExpr("p_name as alias", "cast(p_size as bigint) as brand_id", "case p_partkey % 3 when 0 then 'auto' when 1 then 'curated' else 'human' end as source")
    return store.promote_aliases(I.ALIASES.df(spark), _NEW_ALIASES.df(spark).unionByName(rows))


@query("SELECT DISTINCT least(user_id % 9, event_id % 9) AS brand_id_a, greatest(user_id % 9, event_id % 9) AS brand_id_b FROM events WHERE user_id % 9 <> event_id % 9")
def entity_link_insert(spark, sf_dir):
    none = spark.createDataFrame([], "brand_id_a long, brand_id_b long, source string")
    return store.insert_links(none, I.table(spark, sf_dir, "events").selectExpr("user_id % 9 as a", "event_id % 9 as b")).select("brand_id_a", "brand_id_b")


_RULES = I.Values({"item_id": "VARCHAR", "decision": "VARCHAR", "brand_id": "BIGINT", "brand_name": "VARCHAR", "nobrand_reason": "VARCHAR"}, [("3", I.POOL, 9, "?", ""), ("5", I.NEW, None, "Fresh", ""), ("10", I.NONE, None, "", "why"), ("12", I.POOL, 777, "Gone", None)])


@query(f"""SELECT r.item_id, CASE WHEN u.decision IS NULL THEN r.suggested_name WHEN u.decision = '{I.POOL}' THEN coalesce(p.name, u.brand_name) ELSE u.decision END AS suggested_name,
CASE WHEN u.decision IS NULL THEN r.suggested_id WHEN u.decision = '{I.POOL}' THEN CAST(u.brand_id AS VARCHAR) WHEN u.decision = '{I.NONE}' THEN '0' ELSE '' END AS suggested_id,
CASE WHEN u.decision IS NULL THEN r.new_name WHEN u.decision = '{I.NEW}' THEN u.brand_name ELSE '' END AS new_name, CASE WHEN u.decision IS NULL THEN r.no_brand_reason WHEN u.decision = '{I.NONE}' THEN coalesce(u.nobrand_reason, '') ELSE '' END AS no_brand_reason,
CASE WHEN u.decision IS NULL THEN r.confidence ELSE 100 END AS confidence FROM {RESULTS} AS r LEFT JOIN {_RULES.sql} AS u ON u.item_id = r.item_id LEFT JOIN {I.BRANDS.sql} AS p ON p.brand_id = u.brand_id""")
def apply_rules(spark, sf_dir):
    rows = results(spark, sf_dir).withColumns({"explanation": F.lit(""), "outcome": T.outcome_type(F.col("suggested_name")), "brand_id": F.lit(None).cast("long")})
    got = decide.apply_rules(rows, _RULES.df(spark), "item_id", "3.2", index(spark))
    return got.select("item_id", "suggested_name", "suggested_id", "new_name", "no_brand_reason", "confidence")


_LEARN = I.Values({"raw_brand": "VARCHAR", "decision": "VARCHAR", "brand_id": "BIGINT"}, [("Liese 莉婕", I.POOL, 16), ("GB 綠鐘", I.POOL, 1), ("x", I.NEW, None), (None, I.POOL, 3), ("MUK 潮嘜", I.POOL, 22)])


@query(f"""WITH n AS (SELECT brand_id, {s_norm(s_clean('raw_brand'))} AS f FROM (SELECT * FROM {_LEARN.sql} UNION ALL SELECT raw_brand, CASE WHEN suggested_id = '7' THEN '{I.POOL}' ELSE suggested_name END, goods FROM {RESULTS}) WHERE decision = '{I.POOL}' AND brand_id IS NOT NULL AND NOT {s_blank('raw_brand')})
SELECT f AS alias, brand_id, 'human' AS source FROM n UNION SELECT {s_lat('f')}, brand_id, 'human' FROM n WHERE length({s_lat('f')}) >= 4 UNION SELECT {s_cjk('f')}, brand_id, 'human' FROM n WHERE length({s_cjk('f')}) >= 2""")
def human_alias_learning(spark, sf_dir):
    rows = results(spark, sf_dir).select("raw_brand", F.when(F.col("suggested_id") == "7", I.POOL).otherwise(F.col("suggested_name")).alias("decision"), F.col("goods").alias("brand_id"))
    return store.human_aliases(_LEARN.df(spark).unionByName(rows))


_AUTO = I.Values({"raw_brand": "VARCHAR", "confidence": "INT", "outcome": "VARCHAR", "brand_id": "BIGINT"}, [("Dove 多芬芳", 98, I.POOL, 8), ("MSI 微星", 95, I.POOL, 9), ("Sonya 索尼", 80, I.POOL, 9), ("Sonyx 索尼", 92, I.POOL, 9), ("LG生活", 99, I.POOL, 23)])


@query("SELECT * FROM (VALUES ('多芬芳', 8::BIGINT, 'auto'), ('sonyx', 9, 'auto'), ('索尼', 9, 'auto')) AS t(alias, brand_id, source)")
def auto_alias_learning(spark, sf_dir):
    return store.automatic_aliases(_AUTO.df(spark), index(spark).keys)


# --- Review ------------------------------------------------------------------------------------------------------------
_TEXT_COLUMNS = ["key", "pick", "reason", "note", "suggested_name", "suggested_id", "new_name", "no_brand_reason", "candidate1", "candidate2", "candidate3", "raw_brand", "bracket"]
_SHEET = I.Values(
    dict.fromkeys(_TEXT_COLUMNS, "VARCHAR"),
    [
        ("1", "", "", "", "Sony", "9", "", "", "", "", "", "", ""), ("2", "v", "", "n", "Sony", "9", "", "", "", "", "", "", ""), ("3", "-", "", "", "Sony", "9", "", "", "", "", "", "", ""), ("4", "OK", "", "", "Sony", "", "", "", "", "", "", "", ""),
        ("5", "2", "", "", "Sony", "9", "", "", "", "KATE 凱婷 [4]", "", "", ""), ("6", "3.0", "", "", "Sony", "9", "", "", "a", "b", "", "", ""), ("7", None, "because", "", "Sony", "9", "", "", "", "", "", "", ""), ("8", "新增:Fresh", "", "", "Sony", "9", "", "", "", "", "", "", ""),
        ("9", "新品牌", "", "", "Sony", "9", "", "", "", "", "", " 茉家 ", ""), ("10", "新增", "", "", "Sony", "9", "", "", "", "", "", "", ""), ("11", "dove多芬", "", "", "Sony", "9", "", "", "", "", "", "", ""), ("12", "zzz", "", "", "Sony", "9", "", "", "", "", "", "", ""),
        ("13", "y", "", "", I.NEW, "", "Neu", "", "", "", "", "", ""), ("14", "yes", "", "", I.NONE, "0", "", "r0", "", "", "", "", ""), ("15", "副廠", "", "", "Sony", "9", "", "", "", "", "", "", ""),
    ],
)
_PARSED = [
    ("1", None, None, None, None), ("2", I.POOL, 9, "Sony", None), ("3", fixed.REVOKED, None, "", None), ("4", None, None, None, "系統沒有建議 brand id，請直接填品牌名或 brand_id"), ("5", I.POOL, 4, "KATE 凱婷", None), ("6", None, None, None, "沒有第 3 個候選"),
    ("7", I.NONE, 0, I.NONE, None), ("8", I.NEW, None, "Fresh", None), ("9", I.NEW, None, "茉家", None), ("10", None, None, None, "請寫成「新增:品牌名」"), ("11", I.POOL, 8, "Dove 多芬", None), ("12", None, None, None, f"品牌庫找不到「zzz」（品牌庫沒有的品牌請選：{I.NEW}）"),
    ("13", I.NEW, None, "Neu", None), ("14", I.NONE, 0, I.NONE, None), ("15", I.NONE, 0, I.NONE, None),
]


@query(I.Values({"key": "VARCHAR", "h_decision": "VARCHAR", "h_brand_id": "BIGINT", "h_brand_name": "VARCHAR", "h_error": "VARCHAR"}, _PARSED).sql)
def parse_human_input(spark, sf_dir):
    return review.parse_human(_SHEET.df(spark), _parts(spark)).select("key", "h_decision", "h_brand_id", "h_brand_name", "h_error")


@query(f"""WITH k AS (SELECT item_id AS key, level1, confidence, goods, ruled, CASE WHEN confidence < 90 THEN 75 ELSE 90 END AS stratum, -ln((('0x' || substr(md5('42:' || item_id), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE) / sqrt(goods) AS draw FROM {RESULTS} WHERE confidence >= 75 AND NOT ruled AND goods >= 3)
SELECT key, level1, confidence, goods, ruled, stratum FROM k QUALIFY row_number() OVER (PARTITION BY level1, stratum ORDER BY draw, key) <= 30""")
def review_sample(spark, sf_dir):
    return review.review_sample(results(spark, sf_dir).select(F.col("item_id").alias("key"), "level1", "confidence", "goods", "ruled"))


_STATE = f"CASE WHEN ruled AND agreed THEN '{fixed.STATE_AGREED}' WHEN ruled THEN '{fixed.STATE_FIXED}' WHEN confidence < 75 THEN '{fixed.STATE_PENDING}' WHEN sampled THEN '{fixed.STATE_SAMPLE}' ELSE '{fixed.STATE_AUTO}' END"


@query(f"SELECT item_id, {_STATE} AS state, confidence >= 90 AND trim(candidate2) <> '' AS ambiguous FROM {RESULTS}")
def review_states(spark, sf_dir):
    r = results(spark, sf_dir)
    return r.select("item_id", review.review_state(r).alias("state"), review.ambiguous(r).alias("ambiguous"))


_ORDER = "CASE state " + " ".join(f"WHEN '{s}' THEN {k}" for k, s in enumerate(fixed.STATE_ORDER)) + " END"


@query(f"""WITH r AS (SELECT item_id AS key, goods, grp, {_STATE} AS state FROM {RESULTS}), t AS (SELECT *, {_ORDER} AS o, CASE WHEN grp = '' THEN goods ELSE max(goods) OVER (PARTITION BY grp) END AS top, CASE WHEN grp = '' THEN 'k' || key ELSE 'g' || grp END AS block FROM r),
m AS (SELECT *, max(goods) OVER (PARTITION BY o, block) AS most FROM t)
SELECT key, goods, grp, state, row_number() OVER w AS position, CAST(sum(goods) OVER (w ROWS UNBOUNDED PRECEDING) AS BIGINT) / greatest(CAST(sum(goods) OVER () AS BIGINT), 1) AS coverage FROM m WINDOW w AS (ORDER BY o, top DESC, grp, most DESC, block, goods DESC, key)""")
def review_coverage(spark, sf_dir):
    r = results(spark, sf_dir)
    return review.work_list(r.select(F.col("item_id").alias("key"), "goods", "grp", review.review_state(r).alias("state")))


_CLUSTER = f"(SELECT DISTINCT 'B:' || replace(p_name, ' ', '') AS key, replace(p_name, ' ', '') AS text FROM part UNION ALL SELECT CAST(case_id AS VARCHAR), s FROM {V} WHERE s IS NOT NULL AND s <> '')"
_BLOCKS = f"""(WITH n AS (SELECT key, {s_norm(s_clean('text'))} AS full_ FROM {_CLUSTER}), p AS (SELECT *, {s_lat('full_')} AS lat, {s_cjk('full_')} AS cjk FROM n),
b AS (SELECT DISTINCT key, full_, block FROM (SELECT key, full_, 'L:' || unnest(list_filter(regexp_extract_all(CASE WHEN lat <> '' THEN lat ELSE full_ END, '[a-z0-9]+'), lambda t: length(t) >= 4 AND t NOT IN {q(fixed.STOP_TOKENS)})) AS block FROM p
UNION ALL SELECT key, full_, 'C:' || unnest(list_filter([substr(cjk, 1, 2), right(cjk, 2)], lambda e: e NOT IN {q(fixed.CLUSTER_STOP)})) FROM p WHERE length(cjk) >= 2)),
f AS (SELECT block, min(key) AS first_key, arg_min(full_, key) AS first_full FROM b GROUP BY block HAVING count(*) BETWEEN 2 AND 60)
SELECT first_key, first_full, key, full_ FROM b JOIN f ON f.block = b.block WHERE key <> first_key)"""


_EDGES = f"SELECT DISTINCT p.first_key AS a, p.key AS b FROM {_BLOCKS} AS p JOIN {s_ratios(f'(SELECT DISTINCT first_full AS a, full_ AS b FROM {_BLOCKS})')} AS r ON r.a = p.first_full AND r.b = p.full_ WHERE ratio >= 70"


@query(_EDGES)
def cluster_edges(spark, sf_dir):
    return review.block_edges(_cluster_texts(spark, sf_dir))


@query(f"""WITH RECURSIVE e AS ({_EDGES}), both_ AS (SELECT a, b FROM e UNION SELECT b, a FROM e), reach AS (SELECT a, a AS b FROM both_ UNION SELECT r.a, x.b FROM reach AS r JOIN both_ AS x ON x.a = r.b), c AS (SELECT a AS key, min(b) AS root FROM reach GROUP BY a),
n AS (SELECT root, row_number() OVER (ORDER BY count(*) DESC, root) AS k FROM c GROUP BY root) SELECT key, 'G' || lpad(CAST(k AS VARCHAR), 4, '0') AS grp FROM c JOIN n ON n.root = c.root""")
def cluster_keys(spark, sf_dir):
    return review.cluster_keys(_cluster_texts(spark, sf_dir))


def _cluster_texts(spark, sf_dir):
    names = I.table(spark, sf_dir, "part").select(F.concat(F.lit("B:"), F.regexp_replace("p_name", " ", "")).alias("key"), F.regexp_replace("p_name", " ", "").alias("text")).distinct()
    v = I.TEXTS.df(spark).where("s is not null and s <> ''").select(F.col("case_id").cast("string").alias("key"), F.col("s").alias("text"))
    return names.unionByName(v)


_OUTCOME = "suggested_name || chr(1) || suggested_id || chr(1) || new_name || chr(1) || no_brand_reason"
_MERGED = f"""(SELECT key, arg_min(suggested_name, category) AS suggested_name, arg_min(suggested_id, category) AS suggested_id, CAST(sum(goods) AS BIGINT) AS goods, string_agg(category, '、' ORDER BY category) AS categories, bool_or(starts_with(state, '①')) AS pending,
bool_or(starts_with(state, '②')) AS sample, bool_or(starts_with(state, '③')) AS done, bool_or(sampled = '★') AS starred, count(DISTINCT {_OUTCOME}) > 1 AS conflict, string_agg(category || ': ' || suggested_name || ' [' || suggested_id || '] ' || new_name, '；' ORDER BY category) AS advice FROM {I.SHEETS_SQL} GROUP BY key)"""


@query(f"SELECT * FROM {_MERGED}")
def bundle_merge(spark, sf_dir):
    return review.merge_sheets(I.sheets(spark, sf_dir)).select("key", "suggested_name", "suggested_id", "goods", "categories", "pending", "sample", "done", "starred", "conflict", "advice")


@query(f"""SELECT key, CASE WHEN conflict THEN '{fixed.TRIAGE['A']}' WHEN suggested_name = '{I.NEW}' THEN '{fixed.TRIAGE['B']}' WHEN starts_with(key, 'I:') THEN '{fixed.TRIAGE['C']}' WHEN suggested_name = '{I.NONE}' THEN '{fixed.TRIAGE['D']}' ELSE '{fixed.TRIAGE['E']}' END AS triage,
CASE WHEN conflict OR pending THEN '{fixed.STATE_PENDING}' WHEN suggested_name = '{I.NEW}' AND (sample OR NOT done) THEN '{fixed.STATE_PENDING}' WHEN sample THEN '{fixed.STATE_SAMPLE}' WHEN done THEN '{fixed.STATE_AGREED}' ELSE '{fixed.STATE_AUTO}' END AS state FROM {_MERGED}""")
def bundle_triage(spark, sf_dir):
    return review.triage(review.merge_sheets(I.sheets(spark, sf_dir))).select("key", "triage", "state")


@query(f"""SELECT rule_key, CASE WHEN decision = '{I.POOL}' THEN brand_name || ' [' || brand_id || ']' WHEN decision = '{I.NEW}' THEN CASE WHEN brand_name <> '' THEN '{I.NEW}:' || brand_name ELSE '{I.NEW}' END ELSE '{I.NONE}' END AS pick
FROM ({_latest('brand', 'rule_key')}) WHERE decision <> '{fixed.REVOKED}'""")
def review_prefill(spark, sf_dir):
    r = store.latest(log(spark, sf_dir), "brand")
    return r.select("rule_key", review.prefill(F.col("decision"), F.col("brand_id"), F.col("brand_name")).alias("pick"))


@query(f"""WITH o AS (SELECT * FROM ({_latest('item', 'site, rule_key')}) WHERE decision <> '{fixed.REVOKED}' AND site = 's0')
SELECT r.item_id, r.raw_brand, title, suggested_name, suggested_id, CASE WHEN decision = '{I.POOL}' THEN brand_name || ' [' || o.brand_id || ']' WHEN decision = '{I.NEW}' THEN '{I.NEW}:' || brand_name ELSE '{I.NONE}' END AS pick, nobrand_reason AS reason, note
FROM {RESULTS} AS r JOIN o ON substr(o.rule_key, 3) = r.item_id""")
def override_sheet(spark, sf_dir):
    o = store.latest(log(spark, sf_dir), "item").where("site = 's0'").withColumn("rule_key", F.expr("substring(rule_key, 3)"))
    return review.override_sheet(results(spark, sf_dir).withColumnRenamed("raw_brand", "brand"), o)


@query(f"""WITH k AS (SELECT * FROM {s_key(ITEMS, 'brand', 'title', 'item_id')}), f AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY key ORDER BY item_id) = 1)
SELECT key, title, 'https://example.org/item/' || item_id AS url FROM f UNION ALL SELECT 'B:nobody', 'kept', 'https://kept'""")
def review_fill_samples(spark, sf_dir):
    g = items(spark, sf_dir)
    keys = g.select(T.brand_key(F.col("brand"), F.col("title"), F.col("item_id")).alias("key")).distinct().select("key", F.lit("").alias("title"), F.lit("").alias("url"))
    return review.fill_samples(keys.unionByName(spark.range(1).select(F.lit("B:nobody").alias("key"), F.lit("kept").alias("title"), F.lit("https://kept").alias("url"))), g)


_COLLECTED = [("2", I.POOL, 9, 1), ("3", fixed.REVOKED, None, 0), ("4", None, None, None), ("5", I.POOL, 4, 0), ("6", None, None, None), ("7", I.NONE, 0, 0), ("8", I.NEW, None, 0), ("9", I.NEW, None, 0), ("10", None, None, None), ("11", I.POOL, 8, 0), ("12", None, None, None), ("13", I.NEW, None, 1), ("14", I.NONE, 0, 1), ("15", I.NONE, 0, 0)]


@query(I.Values({"rule_key": "VARCHAR", "decision": "VARCHAR", "brand_id": "BIGINT", "agree": "INT"}, _COLLECTED).sql)
def review_collect(spark, sf_dir):
    """Typed decisions as log entries, with agreement between people and the system."""
    sheet = _SHEET.df(spark).withColumns({"path": F.lit("1.3 x"), "confidence": F.lit("80"), "sampled": F.lit("★"), "goods": F.lit("3")})
    return review.collect_decisions(sheet, _parts(spark)).select("rule_key", "decision", "brand_id", "agree")


_TYPED_PICK = f"CASE WHEN conflict THEN '' WHEN goods % 3 = 0 THEN 'v' WHEN goods % 3 = 1 THEN '{I.NEW}:Neu ' || key ELSE '' END"


@query(f"""SELECT key AS rule_key, CASE WHEN goods % 3 = 1 THEN '{I.NEW}' ELSE {s_type('suggested_name')} END AS decision, CASE WHEN goods % 3 = 1 OR suggested_name = '{I.NEW}' THEN NULL WHEN suggested_name = '{I.NONE}' THEN 0 ELSE CAST(suggested_id AS BIGINT) END AS brand_id,
CASE WHEN goods % 3 = 1 THEN 'Neu ' || key WHEN suggested_name = '{I.NEW}' THEN '' ELSE suggested_name END AS brand_name, CAST(CASE WHEN goods % 3 = 1 THEN suggested_name = '{I.NEW}' ELSE true END AS INT) AS agree FROM {_MERGED} WHERE NOT conflict AND goods % 3 < 2""")
def bundle_import(spark, sf_dir):
    """A bundle in which people have accepted every third row and named a new brand in another third."""
    merged = review.triage(review.merge_sheets(I.sheets(spark, sf_dir)))
    typed = F.when(F.startswith("triage", F.lit("A")), "").when(F.col("goods") % 3 == 0, "v").when(F.col("goods") % 3 == 1, F.concat(F.lit(f"{I.NEW}:Neu "), "key")).otherwise("")
    rows = merged.withColumns({"pick": typed, **{c: F.lit("") for c in ("reason", "note", "candidate1", "candidate2", "candidate3", "raw_brand", "bracket")}})
    return review.import_bundle(rows, _wide_parts(spark, sf_dir)).select("rule_key", "decision", "brand_id", "brand_name", "agree")


@query(f"""WITH r AS (SELECT *, {s_type('suggested_name')} AS outcome FROM {RESULTS}), k AS (SELECT level1, key, count(*) AS n, arg_min(confidence, item_id) AS c, count(*) FILTER (outcome = '{I.POOL}') AS p, count(*) FILTER (outcome = '{I.NEW}') AS w, count(*) FILTER (outcome = '{I.NONE}') AS z FROM r GROUP BY level1, key),
g AS (SELECT level1, CAST(sum(n) AS BIGINT) AS goods, count(*) AS n_keys, count(*) FILTER (c < 75) AS pending_keys, CAST(coalesce(sum(n) FILTER (c < 75), 0) AS BIGINT) AS pending_goods, CAST(sum(p) AS BIGINT) AS pool_goods, CAST(sum(w) AS BIGINT) AS new_goods, CAST(sum(z) AS BIGINT) AS none_goods FROM k GROUP BY level1)
SELECT CAST((SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY level1) AS BIGINT) AS run_id, level1, goods, n_keys, pending_keys, pending_goods, pool_goods, new_goods, none_goods FROM g
UNION ALL SELECT CAST(run_id AS BIGINT), level1, goods, CAST(n_keys AS BIGINT), CAST(pending_keys AS BIGINT), pending_goods, pool_goods, NULL, NULL FROM {RUNS}""")
def run_log_append(spark, sf_dir):
    """The run log after a run over all categories."""
    done = results(spark, sf_dir).withColumn("outcome", T.outcome_type(F.col("suggested_name")))
    before = runs(spark, sf_dir).withColumns({c: F.col(c).cast("long") for c in ("run_id", "n_keys", "pending_keys")})
    out = store.log_run(before, done, "site", F.lit(None).cast("timestamp"))
    return out.select("run_id", "level1", "goods", "n_keys", "pending_keys", "pending_goods", "pool_goods", "new_goods", "none_goods")


# --- Analytics -----------------------------------------------------------------------------------------------------------
@query(f"SELECT {s_type('suggested_name')} AS kind, {s_band('confidence')} AS band, count(*) AS goods, count(*) / (SELECT count(*) FROM {RESULTS}) AS share FROM {RESULTS} GROUP BY 1, 2")
def type_by_band(spark, sf_dir):
    return report.type_by_band(results(spark, sf_dir))


@query(f"SELECT path, count(*) AS n_keys, CAST(sum(goods) AS BIGINT) AS goods, CAST(sum(goods) AS BIGINT) / (SELECT CAST(sum(goods) AS BIGINT) FROM {RESULTS}) AS share FROM {RESULTS} GROUP BY path")
def path_distribution(spark, sf_dir):
    return report.path_distribution(results(spark, sf_dir))


_RATES = f"count(*) AS goods, avg(CASE WHEN {s_type('suggested_name')} = '{I.POOL}' THEN 1.0::DOUBLE ELSE 0 END) AS pool_rate, avg(CASE WHEN suggested_name = '{I.NEW}' THEN 1.0::DOUBLE ELSE 0 END) AS new_rate, avg(CASE WHEN suggested_name = '{I.NONE}' THEN 1.0::DOUBLE ELSE 0 END) AS none_rate, avg(confidence) AS mean_confidence, avg(CASE WHEN confidence < 75 THEN 1.0::DOUBLE ELSE 0 END) AS pending_rate"


@query(f"SELECT 'l2' AS dim, l2 AS value, {_RATES} FROM {RESULTS} GROUP BY l2 UNION ALL SELECT 'l3', l3, {_RATES} FROM {RESULTS} GROUP BY l3")
def category_breakdown(spark, sf_dir):
    return report.category_breakdown(results(spark, sf_dir))


_ACC = "count(*) AS reviewed, CAST(sum(agree) AS BIGINT) AS correct, avg(agree) AS accuracy, CAST(sum(agree * goods) AS BIGINT) / greatest(CAST(sum(goods) AS BIGINT), 1) AS weighted_accuracy"


@query(f"""WITH r AS (SELECT * FROM {LOG} WHERE scope = 'brand' AND agree IS NOT NULL) SELECT 'path' AS dim, sys_path AS value, {_ACC} FROM r WHERE sys_path <> '' GROUP BY 2 UNION ALL SELECT 'band', {s_band('CAST(sys_conf AS DOUBLE)')}, {_ACC} FROM r GROUP BY 2
UNION ALL SELECT 'sample', 'high/mid', {_ACC} FROM r WHERE sampled = 1 UNION ALL SELECT 'l1', level1, {_ACC} FROM r GROUP BY 2""")
def system_accuracy(spark, sf_dir):
    return report.system_accuracy(log(spark, sf_dir))


@query(f"""WITH c AS (SELECT DISTINCT o_orderpriority AS l1 FROM orders UNION ALL SELECT 'never'), l AS (SELECT * FROM {RUNS} QUALIFY row_number() OVER (PARTITION BY level1 ORDER BY run_id DESC) = 1)
SELECT c.l1, 1::BIGINT AS goods, 2::BIGINT AS skus, strftime(ran_at, '%Y-%m-%d %H:%M') AS ran_at, n_keys, pending_keys, pending_goods / greatest(l.goods, 1) AS pending_share, pool_goods / greatest(l.goods, 1) AS pool_share FROM c LEFT JOIN l ON c.l1 = l.level1""")
def run_status(spark, sf_dir):
    cats = I.table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("l1")).distinct().unionByName(spark.range(1).select(F.lit("never").alias("l1")))
    return report.run_status(cats.select("l1", F.lit(1).cast("long").alias("goods"), F.lit(2).cast("long").alias("skus")), runs(spark, sf_dir))


_B = f"""(SELECT *, row_number() OVER (ORDER BY goods DESC, name) AS rank, CAST(sum(goods) OVER (ORDER BY goods DESC, name ROWS UNBOUNDED PRECEDING) AS BIGINT) / CAST(sum(goods) OVER () AS BIGINT) AS cumulative_share FROM (
SELECT name, count(*) AS goods, count(DISTINCT level1) AS n_l1, array_to_string(list_sort(list(DISTINCT level1))[1:6], '、') AS l1_list, coalesce(arg_min(candidate1, item_id) FILTER (trim(candidate1) <> ''), '') AS nearest, round_even(avg(confidence), 0) AS mean_confidence, arg_min(title, item_id) AS sample_title
FROM (SELECT *, trim(CASE WHEN trim(new_name) <> '' THEN new_name ELSE raw_brand END) AS name FROM {RESULTS} WHERE confidence < 75 OR suggested_name = '{I.NEW}') WHERE name <> '' GROUP BY name))"""
_BL = f"(SELECT *, CASE WHEN nearest <> '' THEN '{fixed.ACTION_CHECK}' ELSE '{fixed.ACTION_ADD}' END AS action FROM {_B})"
_MODE = f"(SELECT name, suggested_name AS verdict FROM (SELECT trim(CASE WHEN trim(new_name) <> '' THEN new_name ELSE raw_brand END) AS name, suggested_name, count(*) AS n FROM {RESULTS} WHERE confidence < 75 OR suggested_name = '{I.NEW}' GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY name ORDER BY n DESC, suggested_name) = 1)"


@query(f"SELECT rank, b.name, goods, cumulative_share, n_l1, l1_list, '{fixed.LANG_LATIN}' AS lang, action, nearest, verdict, mean_confidence, sample_title FROM {_BL} AS b JOIN {_MODE} AS m ON m.name = b.name")
def brand_backlog(spark, sf_dir):
    return report.backlog(results(spark, sf_dir))


@query(f"SELECT action, count(*) AS brands, CAST(sum(goods) AS BIGINT) AS goods, CAST(sum(goods) AS BIGINT) / (SELECT CAST(sum(goods) AS BIGINT) FROM {_BL}) AS share FROM {_BL} GROUP BY action")
def backlog_summary(spark, sf_dir):
    return report.backlog_summary(report.backlog(results(spark, sf_dir)))


@query(f"SELECT rank AS n, cumulative_share FROM {_BL} WHERE rank IN (10, 20, 50, 100)")
def coverage_at_n(spark, sf_dir):
    return report.coverage_at(report.backlog(results(spark, sf_dir)), (10, 20, 50, 100))


_TESTS = {"all": "true", "automatic": "confidence >= 75", "pending": "confidence < 75", "pool": f"{s_type('suggested_name')} = '{I.POOL}'", "new": f"suggested_name = '{I.NEW}'", "none": f"suggested_name = '{I.NONE}'", "conf_90": "confidence >= 90", "conf_75_89": "confidence BETWEEN 75 AND 89"}


@query(" UNION ALL ".join(f"SELECT '{k}' AS label, CAST(count(*) FILTER ({t}) AS DOUBLE) AS value, count(*) FILTER ({t}) / count(*) AS share FROM {RESULTS}" for k, t in _TESTS.items()) + f" UNION ALL SELECT 'mean_confidence', avg(confidence), NULL FROM {RESULTS}")
def executive_overview(spark, sf_dir):
    return report.executive_overview(results(spark, sf_dir))


@query(f"SELECT level1, count(*) AS goods, avg(CASE WHEN confidence >= 75 THEN 1.0::DOUBLE ELSE 0 END) AS automatic, avg(CASE WHEN {s_type('suggested_name')} = '{I.POOL}' THEN 1.0::DOUBLE ELSE 0 END) AS pool, avg(CASE WHEN suggested_name = '{I.NEW}' THEN 1.0::DOUBLE ELSE 0 END) AS new, avg(CASE WHEN suggested_name = '{I.NONE}' THEN 1.0::DOUBLE ELSE 0 END) AS none, count(*) FILTER (confidence < 75) AS pending FROM {RESULTS} GROUP BY level1")
def category_overview(spark, sf_dir):
    return report.category_overview(results(spark, sf_dir))


@query(f"""WITH g AS (SELECT name, count(*) AS goods FROM (SELECT trim(CASE WHEN trim(new_name) <> '' THEN new_name ELSE raw_brand END) AS name FROM {RESULTS} WHERE confidence < 75) WHERE name <> '' GROUP BY name),
c AS (SELECT row_number() OVER w AS n, CAST(sum(goods) OVER (w ROWS UNBOUNDED PRECEDING) AS BIGINT) AS covered FROM g WINDOW w AS (ORDER BY goods DESC, name)), t AS (SELECT count(*) AS t, count(*) FILTER (confidence >= 75) AS a FROM {RESULTS})
SELECT n, covered, covered / greatest(t - a, 1) AS of_pending, (a + covered) / t AS of_all FROM c, t WHERE n IN (10, 50, 100)""")
def payoff_curve(spark, sf_dir):
    return report.payoff_curve(results(spark, sf_dir), (10, 50, 100))


@query(f"SELECT new_name, raw_brand, goods, confidence, path, candidate1 AS nearest, title FROM {RESULTS} WHERE suggested_name = '{I.NEW}'")
def new_suggestions(spark, sf_dir):
    return report.new_suggestions(results(spark, sf_dir))


@query(f"""WITH r AS (SELECT * FROM {RESULTS} WHERE confidence > 20) SELECT 'results' AS label, count(*) AS value FROM r UNION ALL SELECT 'distinct_items', count(DISTINCT item_id) FROM r UNION ALL SELECT 'categories', count(DISTINCT level1) FROM r UNION ALL SELECT 'source_rows', count(*) FROM part
UNION ALL SELECT 'missing_results', count(*) FROM {ITEMS} AS i WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.item_id = i.item_id) UNION ALL SELECT 'orphan_results', 0 UNION ALL SELECT 'decisions', count(*) FROM events""")
def store_audit(spark, sf_dir):
    return report.store_audit(items(spark, sf_dir), results(spark, sf_dir).where("confidence > 20"), log(spark, sf_dir))


_RISK = I.Values(
    {"item_id": "VARCHAR", "raw_brand": "VARCHAR", "title": "VARCHAR", "brand_id": "BIGINT", "level1": "VARCHAR", "confidence": "INT"},
    [("1", "GB 別家", "", 2, "A", 90), ("2", "GB別家", "", 2, "B", 70), ("3", "GB 綠鐘", "", 2, "A", 95), ("4", "", "【LG 生活】 x", 23, "A", 60), ("5", "MUK 潮嘜", "", 22, "A", 98), ("6", "HH 草本", "", 6, "C", 50)],
)


@query("SELECT * FROM (VALUES ('gb別家', 2::BIGINT, 'gb', '別家', 'gb', 2::BIGINT, 'A|B', 70, 90), ('gb綠鐘', 2, 'gb', '綠鐘', 'gb', 1, 'A', 95, 95), ('lg生活', 23, 'lg', '生活', 'LG', 1, 'A', 60, 60), ('hh草本', 6, 'hh', '草本', 'HH', 1, 'C', 50, 50)) AS t(norm, brand_id, latin, chinese, matched_name, goods, categories, confidence_min, confidence_max)")
def short_abbreviation_risk(spark, sf_dir):
    return report.short_abbreviation_risk(_RISK.df(spark), _parts(spark), I.ALIASES.df(spark))


@query(f"WITH s AS (SELECT CAST(sum(goods) AS BIGINT) AS goods, CAST(sum(n_keys) AS BIGINT) AS n_keys, CAST(sum(pending_keys) AS BIGINT) AS pending_keys, CAST(sum(pending_goods) AS BIGINT) AS pending_goods, CAST(sum(pool_goods) AS BIGINT) AS pool_goods FROM {RUNS}) SELECT *, pending_goods / greatest(goods, 1) AS pending_share, pool_goods / greatest(goods, 1) AS pool_share FROM s")
def run_totals(spark, sf_dir):
    return report.run_totals(runs(spark, sf_dir))
