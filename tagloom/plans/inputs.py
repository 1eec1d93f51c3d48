"""Inputs of the registered queries: expressions that Spark and the SQL side share, over the given tables."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions import fixed

POOL, NEW, NONE = fixed.POOL, fixed.NEW, fixed.NONE

ITEMS = [
    "cast(p_partkey as varchar(20)) AS item_id", "'C' || cast(p_size % 3 as varchar(9)) AS cluster", "p_type AS l1", "'S' || cast(cast(floor(p_size / 10) as int) as varchar(9)) AS l2", "p_brand AS l3",
    "CASE p_partkey % 7 WHEN 0 THEN '' WHEN 1 THEN 'OEM' WHEN 2 THEN 'for iPhone' WHEN 3 THEN p_brand WHEN 4 THEN 'Zed' || p_brand ELSE p_name END AS brand",
    "'【' || p_brand || '】 ' || p_name AS title", "'' AS url", "cast(p_size as bigint) AS sku_count",
]
RESULTS = [
    "cast(p_partkey as varchar(20)) AS item_id", "p_type AS level1", "p_brand AS l3", "'S' || cast(cast(floor(p_size / 10) as int) as varchar(9)) AS l2", "CASE WHEN p_partkey % 4 = 0 THEN p_name ELSE p_brand END AS raw_brand",
    "'【' || p_brand || '】 ' || p_name AS title", f"CASE p_partkey % 5 WHEN 0 THEN '{NEW}' WHEN 1 THEN '{NONE}' ELSE p_brand END AS suggested_name", "CASE WHEN p_partkey % 5 > 1 THEN '7' WHEN p_partkey % 5 = 1 THEN '0' ELSE '' END AS suggested_id",
    "CASE WHEN p_partkey % 10 = 0 THEN p_name ELSE '' END AS new_name", "CASE WHEN p_partkey % 5 = 1 THEN 'r' ELSE '' END AS no_brand_reason", "cast((p_partkey * 37) % 101 as int) AS confidence",
    "CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_brand || ' [1]' END AS candidate1", "CASE WHEN p_partkey % 6 = 1 THEN p_name || ' [2]' ELSE '' END AS candidate2", "'' AS candidate3",
    "CASE p_partkey % 5 WHEN 0 THEN '1.6 n' WHEN 1 THEN '1.1 w' ELSE '1.3 e' END AS path", "cast(p_size as bigint) AS goods", "'B:' || p_name || p_brand AS key", "p_partkey % 9 = 0 AS ruled", "p_partkey % 2 = 0 AS agreed", "p_partkey % 8 = 3 AS sampled",
    "CASE WHEN p_partkey % 11 = 0 THEN 'G' || cast(p_size % 4 as varchar(9)) ELSE '' END AS grp",
]
LOG = [
    "event_id AS log_id", "CASE WHEN event_id % 4 = 0 THEN 'item' ELSE 'brand' END AS scope", "'s' || cast(user_id % 2 as varchar(9)) AS site", "'B:' || cast(user_id as varchar(20)) AS rule_key",
    f"CASE event_type WHEN 'error' THEN '{fixed.REVOKED}' WHEN 'view' THEN '{NONE}' WHEN 'signup' THEN '{NEW}' ELSE '{POOL}' END AS decision", "CASE WHEN event_type IN ('click', 'purchase') THEN user_id % 20 END AS brand_id",
    "CASE WHEN event_type = 'signup' THEN 'N' || cast(user_id as varchar(20)) ELSE '' END AS brand_name", "'' AS nobrand_reason", "props AS note", "event_type AS level1", "'raw ' || cast(user_id as varchar(20)) AS raw_brand",
    "CASE WHEN event_id % 6 = 0 THEN '' ELSE '1.' || cast(event_id % 7 + 1 as varchar(9)) END AS sys_path", "cast(cast(floor(value) as int) % 101 as varchar(9)) AS sys_conf", "cast(event_id % 2 as int) AS sampled", "event_id % 50 AS goods",
    "CASE WHEN event_id % 3 = 0 THEN NULL ELSE cast(event_id % 5 % 2 as int) END AS agree",
]
RUNS = ["o_orderkey AS run_id", "o_orderpriority AS level1", "o_orderdate AS ran_at", "cast(floor(o_totalprice) as bigint) AS goods", "o_custkey AS n_keys", "o_custkey % 97 AS pending_keys", "cast(floor(o_totalprice / 7) as bigint) AS pending_goods", "cast(floor(o_totalprice / 2) as bigint) AS pool_goods"]
SHEETS = [
    "event_type AS category", "'B:' || cast(user_id as varchar(20)) AS key", "CASE event_id % 5 WHEN 0 THEN '① 待審' WHEN 1 THEN '② 抽查' WHEN 2 THEN '③ 已審(同意)' ELSE '④ 自動' END AS state", "CASE WHEN event_id % 9 = 0 THEN '★' ELSE '' END AS sampled", "event_id % 40 AS goods",
    f"CASE user_id % 4 WHEN 0 THEN '{NEW}' WHEN 1 THEN '{NONE}' ELSE 'Brand ' || cast(user_id % 7 as varchar(9)) END AS suggested_name", "CASE WHEN user_id % 4 > 1 THEN cast((user_id + CASE WHEN event_id % 31 = 0 THEN 1 ELSE 0 END) % 7 as varchar(9)) ELSE '' END AS suggested_id", "'' AS new_name", "'' AS no_brand_reason",
    "'t' || cast(event_id as varchar(20)) AS title", "'' AS url", "event_id",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derived(spark: SparkSession, sf_dir: str, name: str, expressions: list[str]) -> DataFrame:
    return table(spark, sf_dir, name).selectExpr(*expressions)


def sql(name: str, expressions: list[str]) -> str:
    return f"(SELECT {', '.join(expressions)} FROM {name})"


def sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each (key, category): that of its last event."""
    rows = derived(spark, sf_dir, "events", SHEETS)
    rest = [c for c in rows.columns if c not in ("key", "category")]
    return rows.groupBy("key", "category").agg(F.max_by(F.struct(*rest), "event_id").alias("r")).select("key", "category", "r.*").drop("event_id")


SHEETS_SQL = f"(SELECT * EXCLUDE (event_id, rn) FROM (SELECT *, row_number() OVER (PARTITION BY key, category ORDER BY event_id DESC) AS rn FROM {sql('events', SHEETS)}) WHERE rn = 1)"


def literal(v: object) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)


class Values:
    """A small table written out, for both sides."""

    def __init__(self, columns: dict[str, str], rows: list[tuple]) -> None:
        self.columns, self.rows = columns, rows

    @property
    def sql(self) -> str:
        cast = ", ".join(f"CAST({c} AS {t}) AS {c}" for c, t in self.columns.items())
        body = ", ".join("(" + ", ".join(map(literal, r)) + ")" for r in self.rows)
        return f"(SELECT {cast} FROM (VALUES {body}) AS v({', '.join(self.columns)}))"

    def df(self, spark: SparkSession) -> DataFrame:
        kinds = {"VARCHAR": "string", "BIGINT": "long", "INT": "int", "DOUBLE": "double", "BOOLEAN": "boolean"}
        return spark.createDataFrame(self.rows, ", ".join(f"{c} {kinds[t]}" for c, t in self.columns.items()))


TEXTS = Values(
    {"case_id": "INT", "s": "VARCHAR"},
    [
        (1, "GB 綠鐘"), (2, "H&H"), (3, "Kanebo 佳麗寶 KATE 凱婷"), (4, "  官方旗艦店 Dove 多芬 "), (5, "【日本 Sony】 相機"), (6, "[Nike] shoes"), (7, "買一送一 超值組合"), (8, None), (9, ""), (10, "nan"), (11, "LG生活健康"), (12, "MUK 潮嘜"), (13, "O'Brien’s"), (14, "Straße 12"),
        (15, "適用 iPhone 15 保護殼"), (16, "for  iPad case"), (17, "收納用品"), (18, "5入組"), (19, "12345"), (20, "general"), (21, "a"), (22, "iPhone15"), (23, "Galaxy S24"), (24, "PS5"), (25, "【】[Samsung] 手機"), (26, "OEM"), (27, "無品牌"), (28, "Balance Western Tech Plus Nutrition"),
        (29, "葡萄王"), (30, "Brand#12 ultra-long-name-that-goes-beyond"), (31, "日本 韓國 Liese 莉婕"), (32, "【日本】 東西"), (33, "ASUS/ROG"),
    ],
)
BRANDS = Values(
    {"brand_id": "BIGINT", "name": "VARCHAR", "category": "VARCHAR", "adg": "DOUBLE"},
    [
        (1, "GREEN BELL", "Beauty", 10.0), (2, "gb", "Baby", 500.0), (3, "Kanebo", "Beauty", 900.0), (4, "KATE 凱婷", "Beauty", 80.0), (5, "H&H", "", 30.0), (6, "HH", "", 20.0), (7, "Herb & Health", "Health", 50.0), (8, "Dove 多芬", "Beauty", 400.0), (9, "Sony", "Phones", 700.0),
        (10, "Apple", "Phones", 1000.0), (11, "iPhone Apple", "Phones", 2000.0), (12, "iphone", "Phones", 9999.0), (13, "Samsung", "Phones", 900.0), (14, "GRAPE KING BIO 葡萄王生技", "Health", 60.0), (15, "Liese", "Beauty", 5.0), (16, "Liese 莉婕", "Beauty", 7.0), (17, "ASUS", "Phones", 70.0),
        (18, "ROG", "Phones", 60.0), (19, "小熊出版", "Books", 3.0), (20, "小熊出版社", "Books", 4.0), (0, "NoBrand", "", 0.0), (99999999, "nodata", "", 0.0), (21, "Nutrition Western", "", 8.0), (22, "MUK 潮嘜", "", 12.0), (23, "LG", "", 90.0),
    ],
)
ALIASES = Values({"alias": "VARCHAR", "brand_id": "BIGINT", "source": "VARCHAR"}, [("綠鐘", 2, "auto"), ("gb綠鐘", 1, "curated"), ("莉婕", 15, "human"), ("gb", 2, "auto"), ("x", 0, "human"), ("unknown", 777, "human")])
LINKS = Values({"brand_id_a": "BIGINT", "brand_id_b": "BIGINT"}, [(5, 7), (7, 5), (9, 9), (1, 888)])


#: Strings of the data folder beside the written-out ones: what shops type, as far as the tables have it.
STRINGS_SQL = f"(SELECT 'v' || case_id AS id, s FROM {TEXTS.sql} UNION ALL SELECT 't' || item_id, title FROM {sql('part', ITEMS)} UNION ALL SELECT 'b' || item_id, brand FROM {sql('part', ITEMS)} UNION ALL SELECT 's' || s_suppkey, replace(s_name, '#', '') FROM supplier UNION ALL SELECT 'c' || c_custkey, replace(c_name, '#', '') FROM customer)"

#: The written-out brands united with names from the tables.
WIDE_BRANDS_SQL = f"""(SELECT * FROM {BRANDS.sql} UNION ALL SELECT 100000 + CAST(regexp_extract(p_brand, '(\\d+)', 1) AS BIGINT), p_brand, '', CAST(sum(floor(p_retailprice)) AS DOUBLE) FROM part GROUP BY p_brand
UNION ALL SELECT 300000 + CAST(min(p_partkey) AS BIGINT), p_name, min(p_type), CAST(max(p_size) AS DOUBLE) FROM part GROUP BY p_name UNION ALL SELECT 1000000 + CAST(s_suppkey AS BIGINT), replace(s_name, '#', ''), '', CAST(s_nationkey AS DOUBLE) FROM supplier
UNION ALL SELECT 100000000 + CAST(c_custkey AS BIGINT), replace(c_name, '#', ''), c_mktsegment, CAST(c_nationkey AS DOUBLE) FROM customer)"""


def strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = derived(spark, sf_dir, "part", ITEMS)
    rows = [
        TEXTS.df(spark).selectExpr("concat('v', case_id) as id", "s"), items.selectExpr("concat('t', item_id) as id", "title as s"), items.selectExpr("concat('b', item_id) as id", "brand as s"),
        table(spark, sf_dir, "supplier").selectExpr("concat('s', s_suppkey) as id", "replace(s_name, '#', '') as s"), table(spark, sf_dir, "customer").selectExpr("concat('c', c_custkey) as id", "replace(c_name, '#', '') as s"),
    ]
    return functools.reduce(DataFrame.unionByName, rows)


def wide_brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    rows = [
        BRANDS.df(spark), part.groupBy("p_brand").agg(F.sum(F.floor("p_retailprice")).cast("double").alias("adg")).select((100000 + F.regexp_extract("p_brand", r"(\d+)", 1).cast("long")).alias("brand_id"), F.col("p_brand").alias("name"), F.lit("").alias("category"), "adg"),
        part.groupBy("p_name").agg((300000 + F.min("p_partkey").cast("long")).alias("brand_id"), F.min("p_type").alias("category"), F.max("p_size").cast("double").alias("adg")).withColumnRenamed("p_name", "name"),
        table(spark, sf_dir, "supplier").selectExpr("1000000 + cast(s_suppkey as long) as brand_id", "replace(s_name, '#', '') as name", "'' as category", "cast(s_nationkey as double) as adg"),
        table(spark, sf_dir, "customer").selectExpr("100000000 + cast(c_custkey as long) as brand_id", "replace(c_name, '#', '') as name", "c_mktsegment as category", "cast(c_nationkey as double) as adg"),
    ]
    return functools.reduce(DataFrame.unionByName, rows)
