"""Catalogue sources and sinks: SKU rows in JSON, items, brand lists, review sheets, results, exports."""

from __future__ import annotations

import csv
import io
import tomllib
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions import fixed
from tagloom.functions import text as T

ITEM_COLUMNS = ["cluster", "l1", "l2", "l3", "brand", "title", "url", "price", "reviews", "sales", "site_l1", "site_l2", "site_l3"]
#: Values that count as absent when written as text: JSON's 0 as well.
_FALSY_ZERO = {"price", "reviews", "sales"}


@dataclass
class Config:
    """Settings of a site; read from TOML, with defaults."""

    site: str = "site"
    pool: str = ""
    aliases: str = ""
    links: str = ""
    columns: dict[str, str] = field(default_factory=dict)
    sample: int = 30

    @classmethod
    def read(cls, path: str) -> Config:
        p = Path(path)
        data = tomllib.loads(p.read_text(encoding="utf-8"))
        known = {k: data[k] for k in cls.__dataclass_fields__ if k in data}
        for k in ("pool", "aliases", "links"):
            if known.get(k) and not known[k].startswith("/") and "://" not in known[k]:
                known[k] = str(p.parent / known[k])
        return cls(**known)


def read_sku_json(rows: DataFrame, columns: dict[str, str], payload: str = "payload", pos: Column | None = None) -> DataFrame:
    """SKU rows from one JSON object a row: item_id, the item columns as text, and the scan position.

    columns: our name to the JSON field. Absent fields are empty; a 0 for price, reviews or sales is absent.
    """
    schema = ", ".join(f"`{name}` string" for name in columns.values())
    parsed = rows.withColumn("__j", F.from_json(payload, schema))
    value = lambda c: F.coalesce(F.col("__j").getField(columns[c]), F.lit("")) if c in columns else F.lit("")
    cleaned = lambda c: F.when(value(c).isin("0", "0.0"), "").otherwise(value(c)) if c in _FALSY_ZERO else value(c)
    return parsed.select(value("item_id").alias("item_id"), *(cleaned(c).alias(c) for c in ITEM_COLUMNS), (pos if pos is not None else F.lit(0)).alias("pos"))


def items_from_skus(skus: DataFrame) -> DataFrame:
    """One row for each item: attributes of its first SKU, and the number of SKUs. Blank ids are skipped.

    Combined on the map side, so an item with very many SKUs costs one row for each task.
    """
    rows = skus.where(~T.blank(F.col("item_id"))).withColumn("item_id", F.trim("item_id"))
    g = rows.groupBy("item_id").agg(F.min_by(F.struct(*ITEM_COLUMNS), "pos").alias("f"), F.count("*").alias("sku_count"))
    return g.select("item_id", "f.*", "sku_count")


def list_categories(items: DataFrame) -> DataFrame:
    return items.groupBy("l1").agg(F.min("cluster").alias("cluster"), F.count("*").alias("goods"), F.sum("sku_count").alias("skus"))


def scan_category(items: DataFrame, l1: str) -> DataFrame:
    return items.where(F.col("l1") == l1).na.fill("")


def input_stamp(spark: SparkSession, path: str) -> str:
    """size:modified of an input, through Spark's own file system; a cache with another stamp is rebuilt."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    status = jpath.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(jpath)
    total = jpath.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(jpath).getLength()
    return f"{total}:{status.getModificationTime()}"


def replace_table(df: DataFrame, path: str, *partitions: str) -> None:
    """Writes df beside the table and then swaps the names, so that readers see the old table or the new one.

    df may be computed from the table itself. A run that dies before the swap leaves the table as it was; one that dies between the two
    renames leaves the old table under `path__old`, from where the next call or `read_table` brings it back.
    """
    spark = df.sparkSession
    fs, at = _files(spark, path)
    df.write.mode("overwrite").partitionBy(*partitions).parquet(f"{path}__new")
    restore_table(spark, path)
    if fs.exists(at(path)):
        fs.rename(at(path), at(f"{path}__old"))
    fs.rename(at(f"{path}__new"), at(path))
    fs.delete(at(f"{path}__old"), True)


def restore_table(spark: SparkSession, path: str) -> None:
    """Ends a swap that died half way."""
    fs, at = _files(spark, path)
    if fs.exists(at(f"{path}__old")):
        if fs.exists(at(path)):
            fs.delete(at(f"{path}__old"), True)
        else:
            fs.rename(at(f"{path}__old"), at(path))


def read_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A table that `replace_table` keeps; empty with the schema if there is none yet."""
    restore_table(spark, path)
    fs, at = _files(spark, path)
    if schema and not fs.exists(at(path)):
        return spark.createDataFrame([], schema)
    return spark.read.parquet(path)


def _files(spark: SparkSession, path: str):
    """Spark's file system of a path, and its path type."""
    at = spark._jvm.org.apache.hadoop.fs.Path
    return at(path).getFileSystem(spark._jsc.hadoopConfiguration()), at


def write_items(items: DataFrame, path: str) -> None:
    """Partitioned by category; readers see the old items or the new ones."""
    replace_table(items, path, "l1")


def fresh_items(spark: SparkSession, source: str, cache: str, build) -> DataFrame:
    """The items in `cache`, rebuilt by build(source rows) where the source's stamp is not the one they were built from."""
    stamp = input_stamp(spark, source)
    fs, at = _files(spark, cache)
    known = spark.read.parquet(f"{cache}__stamp").first()["stamp"] if fs.exists(at(f"{cache}__stamp")) and fs.exists(at(cache)) else None
    if known != stamp:
        write_items(build(spark.read.parquet(source)), cache)
        spark.createDataFrame([(stamp,)], "stamp string").coalesce(1).write.mode("overwrite").parquet(f"{cache}__stamp")
    return spark.read.parquet(cache)


def read_brand_list(spark: SparkSession, path: str, required: tuple[str, ...] = ("brand_id", "brand_name")) -> DataFrame:
    """A brand list from CSV or TSV (UTF-8 with or without mark, else cp950) whose header is in the first ten rows, or from Parquet.

    A brand list is a curated file of bounded size; its text is decoded on the driver because Spark's reader lacks cp950.
    """
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path).select(*(F.col(f.name).cast("string") for f in spark.read.parquet(path).schema))
    raw = bytes(spark.read.format("binaryFile").load(path).first()["content"])
    for encoding in ("utf-8-sig", "cp950"):
        try:
            text = raw.decode(encoding)
            break
        except UnicodeDecodeError:
            continue
    else:
        raise ValueError(f"{path}: neither utf-8 nor cp950")
    rows = list(csv.reader(io.StringIO(text), delimiter="\t" if path.endswith(".tsv") else ","))
    for i, row in enumerate(rows[:10]):
        header = [x.strip() for x in row]
        if all(c in header for c in required):
            body = [(k, *(r + [""] * len(header))[: len(header)]) for k, r in enumerate(rows[i + 1 :])]
            return spark.createDataFrame(body, "pos long, " + ", ".join(f"`{h}` string" for h in header))
    raise ValueError(f"{path}: no header with {required} in the first 10 rows")


def curated_aliases(rows: DataFrame, pool: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid): aliases whose brand is in the pool, keyed by normalised text, and those whose brand is not."""
    df = rows.withColumn("alias", T.normalize(F.col("alias_text")))
    ids = pool.select("brand_id")
    return df.join(ids, "brand_id", "left_semi").where("alias <> ''"), df.join(ids, "brand_id", "left_anti")


def curated(rows: DataFrame, link_rows: DataFrame, pool: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(aliases, links, rejected) of a curated list (alias_text, brand_id, same_as) and a list of links (brand_id_a, brand_id_b), all texts.

    Rows without a text or an id are skipped; ids that are no numbers or not in the pool are rejected with a reason.
    """
    ids = pool.select(F.col("brand_id").cast("string").alias("known")).distinct()
    text = lambda c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit("")))
    valid = lambda df, c: df.join(ids, F.col(c) == F.col("known"), "left").withColumn(f"{c}_ok", F.col("known").isNotNull()).drop("known")
    a = rows.select(text("alias_text").alias("alias_text"), text("brand_id").alias("a"), text("same_as").alias("b")).where("alias_text <> '' and a <> ''")
    a = valid(valid(a, "a"), "b")
    own = valid(valid(link_rows.select(text("brand_id_a").alias("a"), text("brand_id_b").alias("b")), "a"), "b")
    aliases = a.where("a_ok").select(T.normalize(F.col("alias_text")).alias("alias"), F.col("a").cast("long").alias("brand_id"), F.lit("curated").alias("source")).where("alias <> ''").distinct()
    both = a.where("a_ok and b <> ''").select("a", "b", "a_ok", "b_ok").unionByName(own)
    links = both.where("a_ok and b_ok and a <> b").select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).distinct()
    why = lambda c: F.concat(F.lit("brand_id "), F.col(c), F.lit(" 不在品牌庫"))
    rejected = a.where("not a_ok").select("alias_text", why("a").alias("reason")).unionByName(a.where("a_ok and b <> '' and not b_ok").select("alias_text", why("b").alias("reason")))
    return aliases, links, rejected.unionByName(own.where("not (a_ok and b_ok)").select(F.concat("a", F.lit(" ↔ "), "b").alias("alias_text"), F.lit("brand_id 不在品牌庫").alias("reason")))


def read_review_sheet(spark: SparkSession, path: str) -> DataFrame | None:
    """All columns as text; None if there is no sheet."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath):
        return None
    return spark.read.parquet(path).select("*") if path.endswith(".parquet") else spark.read.csv(path, header=True, multiLine=True, escape='"')


def upsert_results(results: DataFrame, path: str) -> None:
    """Replaces the (site, level1) slices that results has, and no others."""
    results.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("site", "level1").parquet(path)


def export_items(items: DataFrame, results: DataFrame, categories: list[str] | None = None) -> DataFrame:
    """Items with their results, 14 columns; optionally of some categories."""
    r = results.where(F.col("level1").isin(categories)) if categories else results
    new = F.col("suggested_name") == fixed.NEW
    tagged = F.when(new & (F.col("new_name") != ""), F.col("new_name")).otherwise(F.col("suggested_name"))
    human = F.when((F.col("confidence").cast("int") < fixed.REVIEW_BELOW) | new, "是").otherwise("否")
    own = items.select("item_id", "cluster", "l1", "l2", "l3", "brand", "title")
    return own.join(r.select("item_id", "candidate1", "candidate2", "candidate3", "suggested_name", "new_name", "confidence", "path"), "item_id").select(
        "item_id", "cluster", "l1", "l2", "l3", "brand", "title", "candidate1", "candidate2", "candidate3", tagged.alias("tagged_brand"), "confidence", human.alias("needs_human"), "path"
    )


def slim_export(exported: DataFrame) -> DataFrame:
    """Two halves by row position, without the candidates and with short paths.

    The position comes from counts of ranges of ids, not from one sort in a task.
    """
    from tagloom.operators.order import global_row_number

    numbered, total = global_row_number(exported, "item_id")
    half = F.when(F.col("row") <= F.floor(F.lit(total) / 2), 1).otherwise(2)
    return numbered.select(half.alias("half"), "item_id", "cluster", "l1", "l2", "l3", "brand", "title", "tagged_brand", "confidence", "needs_human", T.path_code(F.col("path")).alias("path_code"))


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
