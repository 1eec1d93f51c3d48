"""Behaviour of tagging on small pools, one case for each rule."""

import pytest
from pyspark.sql import functions as F

from tagloom.functions import fixed
from tagloom.functions import text as T
from tagloom.operators import decide, pool, store
from tagloom.operators.review import merge_sheets, triage
from tagloom.plans.session import checkpointed

POOL = "brand_id long, name string, category string, adg double"
NAMES = ["case_id", "raw_brand", "title", "cat", "cat_check"]


def index(spark, brands, aliases=(), links=()):
    p = spark.createDataFrame([(b, n, c, float(a)) for b, n, c, a in brands], POOL)
    return pool.build_index(p, spark.createDataFrame(list(aliases), "alias string, brand_id long, source string"), spark.createDataFrame(list(links), "brand_id_a long, brand_id_b long"))


def tag(spark, ix, *cases):
    rows = [(str(k), *c, *("", False)[len(c) - 2 :]) for k, c in enumerate(cases)]
    got = {r["case_id"]: r for r in decide.tag(spark.createDataFrame(rows, "case_id string, raw_brand string, title string, cat string, cat_check boolean"), ix).collect()}
    assert len(got) == len(cases)
    return [got[str(k)] for k in range(len(cases))]


def test_curated_alias_beats_automatic(spark):
    ix = index(spark, [(1, "gb", "Baby", 99999), (2, "GREEN BELL", "Beauty", 10)], [("綠鐘", 1, "auto"), ("gb綠鐘", 2, "curated")])
    (r,) = tag(spark, ix, ("GB 綠鐘", "", "Beauty"))
    assert (r["brand_id"], r["confidence"]) == (2, 98)


def test_short_initials_need_confirmation(spark):
    ix = index(spark, [(1, "MSI", "", 10)], [("微星", 1, "auto")])
    (r,) = tag(spark, ix, ("MSI 微星", ""))
    assert r["brand_id"] == 1 and r["confidence"] < 75 and "未被獨立證實" in r["explanation"]


def test_links_join_registrations(spark):
    brands = [(1, "H&H", "", 10), (2, "Herb & Health 草本新淨界", "", 500)]
    ix = index(spark, brands, [("hh草本新淨界", 2, "curated")], [(1, 2)])
    a, b = tag(spark, ix, ("HH 草本新淨界", ""), ("H&H", ""))
    assert a["brand_id"] == b["brand_id"] == 2 and b["path"].startswith("1.4")
    ix = index(spark, [*brands, (3, "HH", "", 5)], [("hh草本新淨界", 2, "curated")], [(1, 2)])
    (r,) = tag(spark, ix, ("HH", ""))
    assert r["brand_id"] == 3


def test_full_bilingual_name_wins(spark):
    ix = index(spark, [(1, "H&R", "", 100000), (2, "H&R 安室家", "", 300)])
    (r,) = tag(spark, ix, ("H&R 安室家", ""))
    assert (r["brand_id"], r["confidence"]) == (2, 98)
    assert pool.same_entity_pairs(ix.parts, ix.links).isEmpty()


def test_same_entity(spark):
    ix = index(spark, [(1, "Liese", "", 1), (2, "Liese 莉婕", "", 2), (3, "GB 綠鐘", "", 1), (4, "gb", "", 1)])
    assert [tuple(r) for r in pool.same_entity_pairs(ix.parts, ix.links).collect()] == [(1, 2)]
    assert sorted(tuple(r) for r in pool.duplicate_groups(ix.parts, ix.links).collect()) == [(1, 1, 2), (1, 2, 1)]


def test_automatic_learning(spark):
    ix = index(spark, [(1, "MSI", "", 1), (2, "Liese", "", 1)])
    rows = spark.createDataFrame([("MSI 微星", 93, fixed.POOL, 1), ("Liese 莉婕", 98, fixed.POOL, 2)], "raw_brand string, confidence int, outcome string, brand_id long")
    assert [tuple(r) for r in store.automatic_aliases(rows, ix.keys).collect()] == [("莉婕", 2, "auto")]


def test_alias_promotion_and_links(spark):
    old = spark.createDataFrame([("a", 1, "auto")], "alias string, brand_id long, source string")
    new = spark.createDataFrame([("a", 1, "curated")], "alias string, brand_id long, source string")
    assert [tuple(r) for r in store.promote_aliases(old, new).collect()] == [("a", 1, "curated")]
    assert store.count_alias_changes(old, new).first()["changes"] == 1
    none = spark.createDataFrame([], "brand_id_a long, brand_id_b long, source string")
    assert [tuple(r)[:2] for r in store.insert_links(none, spark.createDataFrame([(2, 1), (1, 2), (3, 3)], "a long, b long")).collect()] == [(1, 2)]


def test_child_brand(spark):
    ix = index(spark, [(1, "Kanebo", "", 900), (2, "KATE 凱婷", "", 100)])
    (r,) = tag(spark, ix, ("Kanebo 佳麗寶 KATE 凱婷", ""))
    assert r["brand_id"] == 2


def test_product_line(spark):
    a = index(spark, [(1, "Apple", "", 10), (2, "iphone", "", 999)])
    b = index(spark, [(1, "Apple", "", 10)])
    assert tag(spark, a, ("Apple iPhone 15 Pro Max 256G", ""))[0]["brand_id"] == 1
    assert tag(spark, b, ("Apple iPad Air 5 64G", ""))[0]["brand_id"] == 1


def test_partial_match_in_other_category(spark):
    ix = index(spark, [(1, "GOLF", "Motors", 10), (2, "WAHEI FREIZ 和平", "Home", 10)])
    a, b = tag(spark, ix, ("KING GOLF 漫畫 第1集", "", "Books", True), ("和平的日常生活", "", "Books", True))
    for r in (a, b):
        assert r["outcome"] == fixed.NEW and r["path"].startswith("1.6") and r["suggested_id"] == ""


BASIC = [(10, "Apple", "Phones", 1000), (11, "iPhone Apple", "Phones", 2000), (12, "iphone", "Phones", 9999), (13, "APPLE HOUSE 蘋果屋", "Books", 999999), (14, "RHINOSHIELD 犀牛盾", "Phones", 100), (15, "Samsung", "Phones", 900)]


def test_safety_rules(spark):
    ix = index(spark, BASIC)
    promos = ["買一送一", "超抗刮", "洗衣機過濾網", "台灣製造", "運動相機通用"]
    cases = [
        *((s, "") for s in ("Apple", "iphone", "Apple iPhone 15", "iPhone Apple")), *((None, f"【{p}】商品") for p in promos), ("", "【】[Samsung] 手機"), ("", "很長" * 45 + " Samsung 手機"),
        ("", "【RHINOSHIELD 犀牛盾】iPhone 15 保護殼"), ("", "【Apple】iPhone 15 保護殼"), ("iphone", "iPhone 15 保護殼"), ("Apple Samsung", ""),
    ]
    got = tag(spark, ix, *cases)
    assert [r["brand_id"] for r in got[:4]] == [11] * 4
    assert all(r["outcome"] != fixed.NEW for r in got[4:9])
    assert [r["brand_id"] for r in got[9:12]] == [15, 15, 14]
    assert all(r["outcome"] == fixed.NONE and r["confidence"] < 75 for r in got[12:14])
    assert got[14]["confidence"] < 75
    assert all(0 <= r["confidence"] <= 100 for r in got)


def test_keys(spark):
    rows = [("", "【Apple】iPhone 15 保護殼", "123"), ("", "【Apple】iPhone 15 手機", "123"), ("", "【買一送一】東西", "5"), (" GB 綠鐘", "", "1"), (" ", "【Apple】 保護殼", "9")]
    df = spark.createDataFrame(rows, "b string, t string, i string")
    assert [r[0] for r in df.select(T.brand_key(F.col("b"), F.col("t"), F.col("i"))).collect()] == ["I:123", "T:apple", "I:5", "B:gb綠鐘", "T:apple"]


def test_conflict_between_categories(spark):
    rows = [("Home", "B:x", "④ 自動", 2, "X", "1"), ("Food", "B:x", "④ 自動", 4, "Y", "2")]
    df = spark.createDataFrame(rows, "category string, key string, state string, goods long, suggested_name string, suggested_id string").withColumns({c: F.lit("") for c in ("sampled", "new_name", "no_brand_reason", "title", "url")})
    r = triage(merge_sheets(df)).first()
    assert r["conflict"] and r["goods"] == 6 and r["state"] == fixed.STATE_PENDING and "Home" in r["advice"] and "Food" in r["advice"]


LOG = "log_id long, site string, scope string, rule_key string, decision string, brand_id long, brand_name string, nobrand_reason string, note string"
ENTRY = "pos int, scope string, rule_key string, decision string, brand_id long, brand_name string, nobrand_reason string, note string, expected_log_id long"


def entry(decision, brand, expected, pos=0):
    return (pos, "brand", "B:x", decision, brand, "X", "", "", expected)


def test_log(spark):
    empty = spark.createDataFrame([], LOG)
    batch = lambda *e: spark.createDataFrame(list(e), ENTRY)
    log = store.record(empty, batch(entry(fixed.POOL, 1, 0), entry(fixed.POOL, 1, 0, 1)), "s", "L", "me")
    assert log.count() == 1
    log = checkpointed(log)
    assert store.record(log, batch(entry(fixed.POOL, 1, 1)), "s", "L", "me").count() == 1
    with pytest.raises(store.BatchError):
        store.record(log, batch(entry(fixed.NEW, None, 0)), "s", "L", "me")
    with pytest.raises(store.BatchError):
        store.record(empty, batch(entry(fixed.POOL, 1, 0), entry(fixed.NEW, None, 0, 1)), "s", "L", "me")
    gone = store.record(log, batch(entry(fixed.REVOKED, None, 1)), "s", "L", "me")
    assert gone.count() == 2 and store.latest(gone, "brand").isEmpty()


def test_similarity_agrees(spark):
    df = spark.createDataFrame([("brandname", "brandnmae"), ("", ""), ("abc", "xyz"), ("a", ""), ("kitten", "sitting")], "a string, b string")
    rows = df.select(T.indel_ratio(F.col("a"), F.col("b")).alias("x"), T.indel_ratio("a", "b").alias("y")).collect()
    assert all(abs(r["x"] - r["y"]) < 1e-9 for r in rows) and round(rows[4]["x"], 2) == 61.54
