"""The Jaccard join, the substring removal and SimHash against brute force."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tagloom.llm import jaccard_join, simhash, suffix_dedup

SPACE = b" \t\n\x0b\x0c\r"


def corpus(seed: int, n: int = 90) -> list[tuple]:
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdefgé") for _ in range(r.randrange(1, 7))) for _ in range(400)]
    passage = " ".join(r.choice(vocabulary) for _ in range(60))
    rows = []
    for i in range(n):
        kind = r.random()
        if rows and kind < 0.2:
            text = r.choice(rows)[1]
        elif rows and kind < 0.5:
            w = (r.choice(rows)[1] or "x").split(" ")
            for _ in range(r.randrange(1, 3)):
                w[r.randrange(len(w))] = r.choice(vocabulary)
            text = " ".join(w)
        elif kind < 0.6:
            text = r.choice(["", None, " \n", "A", "one two", "a b c d", "aaaa" * 80, "A b C d E f", "a\x1cb c d e f"])
        else:
            text = r.choice(["", passage + "\n"]) + " ".join(r.choice(vocabulary) for _ in range(r.randrange(1, 150)))
        rows.append((i * 50 if i % 3 else i, text, "x", r.choice(["a", None])))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, sig string, __t string").repartition(3)


def sets(text):
    w = bytes((text or ""), "utf-8").translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256)))
    for c in SPACE:
        w = w.replace(bytes([c]), b" ")
    w = [x for x in w.split(b" ") if x]
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def linked(rows):
    s = [sets(r[1]) for r in rows]
    links = {i: [j for j in range(len(rows)) if i != j and s[i] and 100 * len(s[i] & s[j]) >= 75 * len(s[i] | s[j])] for i in range(len(rows))}
    out = []
    for i, r in enumerate(rows):
        reach, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in reach:
                    reach.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in reach if rows[j][0] is not None]
        out.append((r[0], len(s[i]), min(ids, default=None), len(links[i])))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_join(spark, seed, monkeypatch):
    rows = [*corpus(seed), (None, "null id with words enough here", "x", None)]
    got = jaccard_join.ngram_jaccard_join(frame(spark, rows)).collect()
    assert sorted(map(tuple, got), key=repr) == linked(rows)


def test_jaccard_join_in_blocks(spark, monkeypatch):
    """Hot components go through pairs of blocks; the result is the same."""
    rows = corpus(3)
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 3)
    got = jaccard_join.ngram_jaccard_join(frame(spark, rows)).collect()
    assert sorted(map(tuple, got), key=repr) == linked(rows)


def test_jaccard_join_of_one_hot_component(spark, monkeypatch):
    """Sets of many lengths that all share rare shingles: blocks of neighbouring length classes find every link."""
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 4)
    r = random.Random(13)
    base = [str(r.random()) for _ in range(400)]
    rows = [(k, " ".join(base[: r.randrange(8, 400)] + [str(k)] * r.randrange(2)), "x", None) for k in range(70)]
    got = jaccard_join.ngram_jaccard_join(frame(spark, rows)).collect()
    assert sorted(map(tuple, got), key=repr) == linked(rows)


def test_jaccard_join_of_a_chain(spark, monkeypatch):
    """A chain of groups is one component; blocks meet only where they share a shingle, and every link is found."""
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 5)
    r = random.Random(17)
    word = lambda: str(r.random())
    bridges = [[word() for _ in range(5)] for _ in range(13)]
    rows = []
    for g in range(12):
        base = [word() for _ in range(60)]
        ends = [bridges[g], bridges[g + 1], [word()], [], [word(), word()], base[:2]]  # rare shingles, shared with the groups beside
        rows += [(len(rows) + k, " ".join(base + e), "x", None) for k, e in enumerate(ends)]
    got = jaccard_join.ngram_jaccard_join(frame(spark, rows)).collect()
    assert sorted(map(tuple, got), key=repr) == linked(rows)


def test_blocks_meet_where_they_share(spark):
    """Blocks 1 to 4 of a chain meet their neighbours, not all others; far length classes do not meet."""
    packed = lambda *t: bytearray(jaccard_join.pack(np.array(t, np.uint64), np.ones(len(t), np.uint32)))
    held = [(1, 0, 1, 2, packed(10, 11, 13)), (1, 0, 2, 2, packed(11, 12)), (1, 0, 2, 1, packed(12, 13)), (1, 1, 3, 2, packed(12, 13)), (1, 3, 4, 2, packed(13, 14)), (2, 0, 1, 1, packed(10))]
    hot = spark.createDataFrame(held, "component long, c long, b long, prefix int, shared binary")
    got = {tuple(x) for x in jaccard_join._meetings(hot).collect()}
    assert got == {(1, 1, 1), (1, 1, 2), (1, 2, 1), (1, 2, 2), (1, 2, 3), (1, 3, 2), (1, 3, 3), (1, 4, 4), (2, 1, 1)}


def test_one_row_of_each_component(spark):
    """Null ids stay, copies of one id become one row, and an id with two texts keeps only what is first of its group."""
    r = random.Random(11)
    one, two, three, four = (" ".join(str(r.random()) for _ in range(40)) for _ in range(4))
    near = lambda t: t + " end"
    rows = [
        (None, one, "x", "a"), (None, two, "x", "a"), (None, two, "x", "a"), (None, near(two), "x", "a"), (3, three, "x", "a"), (3, three, "x", "a"), (3, three, "x", None),
        (5, near(three), "x", "a"), (5, four, "x", "a"), (None, four, "x", "a"), (None, "", "x", "a"), (None, None, "x", "a"), (7, "", "x", "a"), (7, "", "x", "a"),
    ]
    out = jaccard_join.one_of_each(frame(spark, rows))
    assert out.columns == ["doc_id", "text", "sig", "__t"]
    got = [(x["doc_id"], x["text"]) for x in out.collect()]
    twos = [x for x in got if x[1] in (two, near(two))]
    assert len(twos) == 1 and twos[0][0] is None
    rest = [(None, one), (3, three), (5, four), (None, ""), (None, None), (7, ""), (7, "")]
    assert sorted((x for x in got if x not in twos), key=repr) == sorted(rest, key=repr)
    assert jaccard_join.one_of_each(frame(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_one_row_of_each_component_of_many(spark, seed):
    rows = corpus(seed)
    got = [x["doc_id"] for x in jaccard_join.one_of_each(frame(spark, rows)).collect()]
    assert sorted(got) == sorted({component for _, _, component, _ in linked(rows)})


def test_pipeline_stage_drops_copies_that_share_an_id(spark):
    import corpus_pipeline

    text = " ".join(str(k) for k in range(40))
    rows = [(1, text, "x", "a"), (1, text, "x", "a"), (None, " ".join(str(-k) for k in range(40)), "x", "a")]
    got = corpus_pipeline.drop_near_duplicates(spark, frame(spark, rows), "")
    assert sorted((r["doc_id"] or 0) for r in got.collect()) == [0, 1]


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard_join.ngram_jaccard_join(docs).count() == 0
    assert suffix_dedup.repeated_substrings(docs).count() == 0
    assert suffix_dedup.dedup_documents(docs).count() == 0
    assert simhash.simhash_edited(docs).count() == 0


def removal(rows, length):
    """By the definition: a string's first start in (doc_id, offset) order stays."""
    seen, out = set(), []
    for doc, text, *_ in sorted(rows, key=lambda r: r[0]):
        b = (text or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            s = b[p : p + length]
            if s in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(s)
        spans = sum(1 for k in range(len(b)) if gone[k] and (not k or not gone[k - 1]))
        out.append((doc, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize(("seed", "length"), [(4, 100), (5, 64), (6, 117)])
def test_repeated_substrings(spark, seed, length, monkeypatch):
    rows = corpus(seed)
    assert len({r[0] for r in rows}) == len(rows)
    rows.append((99_999, "".join(r[1] or "" for r in rows[10:30]), "x", None))
    got = suffix_dedup.repeated_substrings(frame(spark, rows), length=length).drop("span_from", "span_to").collect()
    assert sorted(map(tuple, got)) == removal(rows, length)


def test_long_texts_go_in_pieces():
    import numpy as np

    b = np.frombuffer(bytes(random.Random(1).choices(b"abc ", k=5000)), np.uint8)
    whole = suffix_dedup.runs(b, 100)
    old, suffix_dedup.PIECE = suffix_dedup.PIECE, 700
    try:
        pieces = suffix_dedup.runs(b, 100)
    finally:
        suffix_dedup.PIECE = old
    per_window = lambda r: [(a, p) for a, f, z in zip(r[0].tolist(), r[2].tolist(), r[3].tolist()) for p in range(f, z + 1)]
    assert per_window(whole) == per_window(pieces)


def test_copies_spread_over_buckets():
    """What is found about 5,000 copies of one text is dealt by document, so no bucket has them all."""
    import numpy as np

    home = suffix_dedup._home(np.arange(5000), np.full(5000, -7), 400)
    counts = np.bincount(home, minlength=400)
    assert (counts > 0).sum() > 390 and counts.max() < 40


def test_slices_are_bounded_by_bytes():
    import pyarrow as pa

    from tagloom.llm.common import slices

    texts = ["x" * n for n in (10, 5000, 20_000, 3, 0, 9000, 9000)] + ["y"] * 900 + [None]
    whole = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["a", "b"])
    for batch in (whole, whole.slice(2)):
        got = list(slices(iter([batch]), rows=500, size=10_000))
        assert [x for g in got for x in g.column(1).to_pylist()] == batch.column(1).to_pylist()
        assert all(g.num_rows <= 500 and (g.num_rows == 1 or sum(len(x or "") for x in g.column(1).to_pylist()) <= 10_000) for g in got)
    assert list(slices(iter([whole.slice(0, 0)]))) == []


def test_substrings_on_given_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = suffix_dedup.repeated_substrings(docs).drop("span_from", "span_to").collect()
    assert sorted(map(tuple, got)) == removal([(r["doc_id"], r["text"]) for r in docs.collect()], 100)


def test_repeated_rows_and_clashing_columns(spark):
    long = "".join(random.Random(8).choices("abcdefgh ", k=350))
    rows = [(1, long, "x", None), (1, long, "x", None), (2, "é" * 5 + long + "ß", "y", "t"), (None, long, "z", None)]
    got = {(r["doc_id"], r["n_removed"]) for r in suffix_dedup.repeated_substrings(frame(spark, rows)).collect()}
    n = len(long)
    assert got == {(1, 0), (2, n), (None, n)}
    kept = suffix_dedup.dedup_documents(frame(spark, rows))
    assert kept.columns == ["doc_id", "text", "sig", "__t"]
    assert sorted((r["doc_id"] or 9, r["text"], r["__t"]) for r in kept.collect()) == [(1, long, None), (1, long, None), (2, "éééééß", "t"), (9, "", None)]


def spark_xxhash(values, seed=42):
    for v in values:
        seed = xxhash.xxh64_intdigest(v.to_bytes(8, "little", signed=True) if isinstance(v, int) else v, seed=seed)
    return seed - (1 << 64) if seed >> 63 else seed


def simhash_by_hand(text):
    import re

    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text) if x]
    h = [spark_xxhash([x.encode()]) for x in w]
    terms = [spark_xxhash(h[k : k + 5]) for k in range(len(h) - 4)] if len(h) >= 5 else [spark_xxhash(h)] if h else []
    bits = 0
    for k in range(64):
        if 2 * sum(t >> k & 1 for t in terms) > len(terms):
            bits |= 1 << k
    return bits


def test_simhash(spark, monkeypatch):
    monkeypatch.setattr(simhash, "RANGE", 20)
    rows = corpus(7)
    texts = {r[0]: r[1] or "" for r in rows}
    order = sorted(texts, reverse=True)
    follow = dict(zip(order, [*order[1:], order[0]]))
    want = {}
    for i, t in texts.items():
        third = len(t) // 3
        e = t[: len(t) - third] + texts[follow[i]][:third]
        own, edited, other = (simhash_by_hand(x) for x in (t, e, texts[follow[i]]))
        near = sum((simhash_by_hand(x) ^ own).bit_count() <= 3 for x in texts.values()) - 1
        want[i] = (len(t), hashlib.sha256(e.encode()).hexdigest(), f"{own:016x}", f"{edited:016x}", 1 - (own ^ edited).bit_count() / 64, 1 - (own ^ other).bit_count() / 64, near if i % 100 == 0 else None)
    got = {r["doc_id"]: tuple(r)[1:] for r in simhash.simhash_edited(frame(spark, rows)).collect()}
    assert got == want


def test_simhash_of_odd_rows(spark):
    rows = [(5, "a b c d e f g", "x", None), (5, "a b c d e f g", "x", None), (None, None, "x", None), (5, "other words", "x", None)]
    got = simhash.simhash_edited(frame(spark, rows)).collect()
    assert len(got) == 4
    assert len({r["fingerprint"] for r in got if r["n_chars"] == 13}) == 1
    one = simhash.simhash_edited(frame(spark, rows[:1])).first()
    assert one["near_next"] == 1.0


def test_near_documents(spark, monkeypatch):
    """Pairs of fingerprints with membership give the documents within the radius; copies are members, not pairs."""
    rows = corpus(8) + [(700, "copy of one text", "x", None)] * 3
    pairs, members = simhash.near_documents(frame(spark, rows), radius=3)
    got = pairs.join(members.withColumnsRenamed({"fingerprint": "found", "doc_id": "near"}), "found").join(members, "fingerprint").where("doc_id % 100 = 0")
    own = [(r[0], simhash_by_hand(r[1] or "")) for r in rows]
    want = sorted((i, j, (a ^ b).bit_count()) for i, a in own if i % 100 == 0 for j, b in own if (a ^ b).bit_count() <= 3)
    assert sorted((r["doc_id"], r["near"], r["distance"]) for r in got.collect()) == want


def test_rows_without_ids_are_in_ranges(spark, monkeypatch):
    """Many rows without an id: ordered by their texts' hashes after all ids, in several ranges."""
    monkeypatch.setattr(simhash, "RANGE", 15)
    r = random.Random(10)
    rows = [(None if k % 2 else k, " ".join(str(r.random()) for _ in range(9)), "x", None) for k in range(120)]
    found = simhash.with_next(frame(spark, rows).select("doc_id", "text").withColumn("__th", F.xxhash64("text"))).collect()
    order = sorted(found, key=lambda x: (x["doc_id"] is None, -(x["doc_id"] or 0), x["__th"]))
    assert len(order) == 120
    for a, b in zip(order, [*order[1:], order[0]], strict=True):
        assert (a["next_id"], a["next_th"], a["next_text"]) == (b["doc_id"], b["__th"], b["text"])


def test_radius_against_all_pairs(spark):
    r = random.Random(9)
    base = [r.getrandbits(64) for _ in range(12)]
    values = [b ^ sum(1 << k for k in r.sample(range(64), r.randrange(6))) for b in base for _ in range(8)]
    rows = [(k, v - (1 << 64) if v >> 63 else v, 1 + k % 2) for k, v in enumerate(values)]
    df = spark.createDataFrame(rows, "doc_id long, own long, __rows long")
    for radius in (0, 2, 3):
        got = {x["own"]: x["n_rows"] for x in simhash.within_radius(df, radius, radius + 2, F.lit(True)).collect()}
        assert got == {v: sum(m for _, u, m in rows if ((u ^ v) & (1 << 64) - 1).bit_count() <= radius) for _, v, _ in rows}


def test_no_temporary_folder_on_a_cluster():
    """A machine's own folder serves only Spark in one process."""
    from types import SimpleNamespace

    from tagloom.llm.common import shared_folder

    conf = SimpleNamespace(get=lambda name, default: default)
    for master in ("spark://host:7077", "local-cluster[2,1,1024]", "yarn"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_folder(SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None)))
