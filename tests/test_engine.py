"""The facade over a small catalogue, sources and sinks, and the streaming fold."""

import os

import pytest
from pyspark.sql import functions as F

from tagloom.engine import Engine
from tagloom.functions import fixed
from tagloom.operators import order
from tagloom.sources import catalogue
from tagloom.streaming import decisions

LOG = "log_id long, site string, scope string, rule_key string, decision string, brand_id long, brand_name string, nobrand_reason string, note string"


@pytest.fixture(scope="module")
def engine(spark):
    columns = ["item_id", "cluster", "l1", "l2", "l3", "brand", "title", "url", "sku_count"]
    names = ["Sony", "", "OEM", "茉家", "Sony"]
    items = spark.createDataFrame([(str(k), "c", "A" if k % 2 else "B", "x", "y", names[k % 5], f"【Samsung】 t{k}", "", 1) for k in range(20)], columns)
    pool = spark.createDataFrame([(1, "Sony", "A", 5.0), (2, "Samsung", "B", 7.0)], "brand_id long, name string, category string, adg double")
    log = spark.createDataFrame([(1, "site", "brand", "B:茉家", fixed.NEW, None, "茉家", "", ""), (2, "site", "item", "0", fixed.NONE, 0, "", "r", "")], LOG)
    none = spark.createDataFrame([], "alias string, brand_id long, source string"), spark.createDataFrame([], "brand_id_a long, brand_id_b long")
    return Engine(spark, items, pool, *none, log)


def test_engine(engine, spark, tmp_path):
    got = engine.tag()
    rows = {r["item_id"]: r for r in got.collect()}
    assert len(rows) == 20
    assert rows["0"]["path"].startswith("3.2") and rows["3"]["path"].startswith("3.1") and rows["5"]["brand_id"] == 1 and rows["1"]["path"].startswith("2.2")
    catalogue.upsert_results(got, f"{tmp_path}/results")
    catalogue.upsert_results(engine.tag(["A"]), f"{tmp_path}/results")
    kept = spark.read.parquet(f"{tmp_path}/results")
    assert kept.count() == 20
    for l1 in "AB":
        listed = engine.review(kept).where(F.col("level1") == l1).orderBy("position").collect()
        assert [r["position"] for r in listed] == list(range(1, len(listed) + 1)) and abs(listed[-1]["coverage"] - 1) < 1e-9
    assert engine.export(kept, ["A"]).count() == 10 and engine.summary(kept).count() == 9
    with pytest.raises(ValueError, match="unknown"):
        engine.categories(["Z"])


def test_sku_rows(spark):
    rows = spark.createDataFrame([('{"品號": "1", "售價 元": 0, "名": "a"}', 2), ('{"品號": "1", "售價 元": 5, "名": "b"}', 1), ('{"品號": " "}', 3), ('{"品號": 7}', 4)], "payload string, k int")
    skus = catalogue.read_sku_json(rows, {"item_id": "品號", "price": "售價 元", "title": "名"}, pos=F.col("k"))
    got = sorted((r["item_id"], r["price"], r["title"], r["sku_count"]) for r in catalogue.items_from_skus(skus).collect())
    assert got == [("1", "5", "b", 2), ("7", "", "", 1)]


def test_brand_lists(spark, tmp_path):
    text = "report\nbrand_id,brand_name,adg\n1,品牌,\"1,000\"\n"
    for k, encoding in enumerate(("utf-8-sig", "cp950")):
        (tmp_path / f"{k}.csv").write_bytes(text.encode(encoding))
        assert [tuple(r) for r in catalogue.read_brand_list(spark, str(tmp_path / f"{k}.csv")).collect()] == [(0, "1", "品牌", "1,000")]
    (tmp_path / "bad.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="no header"):
        catalogue.read_brand_list(spark, str(tmp_path / "bad.csv"))
    assert catalogue.read_review_sheet(spark, str(tmp_path / "none.csv")) is None
    assert catalogue.input_stamp(spark, str(tmp_path / "0.csv")).split(":")[0].isdigit()


def test_global_positions(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).cast("string").alias("k")).repartition(5)
    got, n = order.global_row_number(df, "k")
    rows = got.collect()
    assert n == 5000 and [r["k"] for r in sorted(rows, key=lambda r: r["row"])] == sorted(r["k"] for r in rows)


def test_folding_a_stream(spark, tmp_path):
    rows = [(k, "s", "brand", f"B:{k % 3}", fixed.REVOKED if k == 8 else fixed.NEW, None, f"n{k}", "", "") for k in range(9)]
    spark.createDataFrame(rows, LOG).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(LOG).parquet(f"{tmp_path}/in")
    q = decisions.fold_decisions(stream, f"{tmp_path}/state", f"{tmp_path}/checkpoint")
    q.processAllAvailable()
    q.stop()
    state = decisions.current_state(spark.read.parquet(f"{tmp_path}/state/version=0"))
    assert sorted((r["rule_key"], r["brand_name"]) for r in state.collect()) == [("B:0", "n6"), ("B:1", "n7")]


def test_keys_are_decided_by_category(spark):
    """Results do not depend on which categories run together, though a brand's category decides about partial matches."""
    columns = ["item_id", "cluster", "l1", "l2", "l3", "brand", "title", "url", "sku_count"]
    items = spark.createDataFrame([(str(k), "c", "Books" if k % 2 else "Motors", "x", "y", "KING GOLF", "t", "", 1) for k in range(6)], columns)
    pool = spark.createDataFrame([(1, "GOLF", "Motors", 5.0), (2, "Else", "Books", 5.0)], "brand_id long, name string, category string, adg double")
    none = spark.createDataFrame([], "alias string, brand_id long, source string"), spark.createDataFrame([], "brand_id_a long, brand_id_b long")
    e = Engine(spark, items, pool, *none, spark.createDataFrame([], LOG))
    rows = lambda df: sorted((r["item_id"], r["path"], r["confidence"], r["suggested_id"]) for r in df.collect())
    both, one, two = rows(e.tag()), rows(e.tag(["Books"])), rows(e.tag(["Motors"]))
    assert both == sorted(one + two) and {r[1:] for r in one} != {r[1:] for r in two}


@pytest.fixture
def folder(spark, engine, tmp_path):
    full = "actor string, level1 string, logged_at timestamp, raw_brand string, sys_decision string, sys_brand_id long, agree int, goods long"
    log = spark.createDataFrame([], f"{LOG}, {full}")
    for name, df in (("items", engine.items), ("pool", engine.pool), ("aliases", engine.aliases), ("links", engine.links.withColumn("source", F.lit("curated"))), ("decision_log", log)):
        df.write.parquet(f"{tmp_path}/{name}")
    return str(tmp_path)


def test_command_line(spark, folder, capsys):
    """tag, a filled-in sheet, tag again, bundle out and in, curate, status: what people decide holds in the next run."""
    import csv
    import glob

    from tagloom.engine import main

    table = lambda t: sorted((r.asDict() for r in spark.read.parquet(f"{folder}/{t}").collect()), key=lambda r: r.get("log_id") or 0)

    def fill(name, decide):
        rows = [r for f in glob.glob(f"{folder}/{name}/*.csv") for r in csv.DictReader(open(f, encoding="utf-8"))]
        for r in rows:
            r["pick"] = decide(r) or r["pick"]
        for f in glob.glob(f"{folder}/{name}/*"):
            os.remove(f)
        with open(f"{folder}/{name}/sheet.csv", "w", encoding="utf-8", newline="") as f:
            w = csv.DictWriter(f, rows[0].keys())
            w.writeheader()
            w.writerows(rows)

    main(["tag", "--folder", folder])
    assert len(table("results")) == 20 and len(table("run_log")) == 2 and table("decision_log") == []
    fill("review", lambda r: "Sony" if r["key"] == "B:茉家" else "")
    main(["tag", "--folder", folder])
    assert "recorded 1" in capsys.readouterr().out
    assert [(r["rule_key"], r["brand_id"], r["agree"]) for r in table("decision_log")] == [("B:茉家", 1, 0)]
    assert {(r["alias"], r["brand_id"], r["source"]) for r in table("aliases")} == {("茉家", 1, "human")}
    assert {r["path"][:3] for r in table("results") if r["key"] == "B:茉家"} == {"3.1"}
    assert sorted(r["run_id"] for r in table("run_log")) == [1, 2, 3, 4] and sum(r["imported"] for r in table("run_log")) == 2
    main(["bundle-export", "--folder", folder])
    fill("bundle", lambda r: "No brand" if r["key"] == "B:oem" and not r["triage"].startswith("A") else "")
    main(["bundle-import", "--folder", folder])
    assert [(r["rule_key"], r["decision"], r["level1"]) for r in table("decision_log")][1:] == [("B:oem", fixed.NONE, "ALL")]
    with open(f"{folder}/list.csv", "w", encoding="utf-8") as f:
        f.write("alias_text,brand_id,same_as\n索尼,1,2\n無,9,\n,1,\n")
    main(["curate", "--folder", folder, "--file", f"{folder}/list.csv"])
    assert "brand_id 9" in capsys.readouterr().out
    assert ("索尼", 1, "curated") in {(r["alias"], r["brand_id"], r["source"]) for r in table("aliases")} and [(r["brand_id_a"], r["brand_id_b"]) for r in table("links")] == [(1, 2)]
    main(["status", "--folder", folder])
    shown = capsys.readouterr().out
    assert "20" in shown and "A" in shown and "pending_share" in shown
    main(["history", "--folder", folder, "--key", "B:oem"])
    for command in ("newbrands", "summary", "export", "review"):
        main([command, "--folder", folder])
    assert len(glob.glob(f"{folder}/summary/*/*.csv")) >= 4


def test_bundles_are_all_or_nothing(spark, engine):
    from tagloom.operators import review, store

    columns = ["key", "triage", "pick", "reason", "note", "suggested_name", "suggested_id", "new_name", "no_brand_reason", "candidate1", "candidate2", "candidate3", "raw_brand", "bracket"]
    row = lambda key, triage, pick: (key, triage, pick, "", "", "Sony", "1", "", "", "", "", "", "Sony 索尼", "")
    parts = engine.index().parts
    good = review.import_bundle(spark.createDataFrame([row("B:a", "E x", "v"), row("B:b", "E x", "")], columns), parts)
    assert [(r["rule_key"], r["brand_id"], r["agree"]) for r in good.collect()] == [("B:a", 1, 1)]
    for bad in (row("B:c", "A x", "v"), row("", "E x", "v"), row("B:d", "E x", "nobody")):
        with pytest.raises(store.BatchError):
            review.import_bundle(spark.createDataFrame([row("B:a", "E x", "v"), bad], columns), parts)


def test_swapped_tables_and_fresh_items(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.range(3).write.parquet(path)
    catalogue.replace_table(spark.read.parquet(path).where("id > 0"), path)  # from itself
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [1, 2]
    os.rename(path, f"{path}__old")  # a swap that died between its renames
    assert catalogue.read_table(spark, path).count() == 2
    assert catalogue.read_table(spark, f"{tmp_path}/none", "a long").count() == 0
    built = []

    def build(rows):
        built.append(1)
        return rows.withColumn("l1", F.lit("A"))

    for expected in (1, 1):
        assert catalogue.fresh_items(spark, path, f"{tmp_path}/cache", build).count() == 2 and len(built) == expected
    spark.range(5).write.mode("append").parquet(path)
    assert catalogue.fresh_items(spark, path, f"{tmp_path}/cache", build).count() == 7 and len(built) == 2


def test_ranges_split_common_beginnings(spark, monkeypatch):
    """Ids with one beginning, and counts that are nearly all 1, are dealt to many tasks, and positions are right."""
    monkeypatch.setattr(order, "RANGE", 500)
    df = spark.range(4000).select(F.format_string("SKU-%08d", "id").alias("k"), F.lit(1).alias("goods"))
    per = [r["n"] for r in order.ranges(df, "k").groupBy("__r").agg(F.count("*").alias("n")).collect()]
    assert len(per) >= 7 and max(per) < 1200
    got, n = order.global_row_number(df, "k")
    assert n == 4000 and got.where(F.col("row") != F.substring("k", 5, 8).cast("long") + 1).count() == 0
    out = order.running(df, ["goods", "k"], "goods", add={"rank": "count", "sum": "sum"})
    assert out.where("rank <> sum or total <> 4000").count() == 0 and out.agg(F.max("rank")).first()[0] == 4000


def test_no_temporary_folder_on_a_cluster():
    from types import SimpleNamespace

    from tagloom.plans.session import checkpointed

    conf = SimpleNamespace(get=lambda name, default: default)
    session = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpointed(SimpleNamespace(sparkSession=session))
