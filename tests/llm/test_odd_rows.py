"""One table of odd rows through every operator and every pipeline stage, and brute force for the two classifiers."""

import hashlib
import json
import math
import random

import numpy as np
import public_tokenizers
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tagloom.llm import bpe, chat_format, jaccard_join, language_id, mixing, quality_model, quality_rules, simhash, suffix_dedup, token_counts
from tests.llm.test_pairs_and_spans import linked, removal

PATH = public_tokenizers.path("byte_bpe_50k.json")
#: Names that the operators use inside.
CLASHES = ["__text", "__doc", "__th", "__keys", "__n_words", "sig", "key", "bucket", "component", "row", "place", "stratum", "own", "n", "__c0", "copies", "size", "label", "h"]
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows():
    r = random.Random(21)
    prose = lambda n: " ".join(r.choice(["alpha", "beta", "gamma", "delta", "eta", "theta", "iota"]) + str(r.randrange(50)) for _ in range(n))
    one, two, unsplit = prose(80), prose(300), "".join(r.choice("abcdefgh") for _ in range(200_000))
    out = [
        (1, one, "en", "web", 1), (1, one, "en", "web", 1), (2, one + " end", "en", "web", 2), (None, two, None, None, None), (None, two, None, None, None), (None, None, None, None, None), (3, None, "de", "web", 0),
        (4, "", "de", "", 0), (5, " \n\t ", "", "web", 3), (6, unsplit, "en", "books", 200_000), (7, prose(60_000), "en", "books", 1), (8, "日本語" * 400, "ja", "web", 1200), (9, "one two", "en", "web", 7), (9, "other words", "en", "web", 7), (-5, two[100:1500], "en", "web", 5),
    ]
    return out


def table(spark):
    df = spark.createDataFrame(rows(), "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    return df.withColumns({c: F.lit(None).cast("string") if k % 2 else F.lit("x") for k, c in enumerate(CLASHES)})


def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, None), (3, None, 1), (4, 0, 0), (7, 1, 0), (99, 1, 0)], "doc_id long, quality int, toxic int")


def plain(x):
    return sorted((tuple(r) for r in x), key=repr)


def test_jaccard_join(spark):
    mine = [(r[0], r[1] if r[0] != 7 else "") for r in rows()]  # brute force on the long text would take minutes
    docs = table(spark).withColumn("text", F.when(F.col("doc_id") == 7, "").otherwise(F.col("text")))
    assert plain(jaccard_join.ngram_jaccard_join(docs).collect()) == linked(mine)
    assert jaccard_join.ngram_jaccard_join(table(spark)).count() == len(mine)
    kept = jaccard_join.one_of_each(table(spark))
    assert kept.columns == table(spark).columns
    assert plain((r["doc_id"], r["text"] and len(r["text"])) for r in kept.collect()) == plain((r[0], r[1] and len(r[1])) for k, r in enumerate(rows()) if k not in (1, 2, 4))


def test_language(spark):
    docs = table(spark)
    model = language_id.train(docs, per_lang=3)
    got = language_id.identify_language(docs, model).collect()
    assert len(got) == len(rows()) and all(0 <= r["score"] <= 1 for r in got)
    assert {r["lang_pred"] for r in got if r["doc_id"] in (3, 4, 5)} == {"und"}
    assert language_id.identify_language(docs.limit(0), language_id.train(docs.limit(0))).count() == 0
    assert language_id.identify_language(docs, model, keep=("doc_id", "__th", "n")).columns == ["doc_id", "__th", "n", "lang_pred", "score"]


def test_quality_model(spark):
    docs = table(spark)
    model = quality_model.train(docs, labels(spark))
    got = quality_model.score_quality(docs, model).collect()
    assert len(got) == len(rows()) and all(0 <= r["score"] <= 1 for r in got)
    assert quality_model.score_quality(docs.limit(0), quality_model.train(docs.limit(0), labels(spark))).count() == 0
    repeated = docs.unionByName(docs)
    assert quality_model.score_quality(repeated, quality_model.train(repeated, labels(spark).unionByName(labels(spark)))).count() == 2 * len(rows())


def test_tokens(spark):
    whole = Tokenizer.from_file(PATH)
    ids = [whole.encode(r[1] or "", add_special_tokens=False).ids for r in rows()]
    digest = lambda x: hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest()
    got = bpe.bpe_round_trip(table(spark), PATH)
    assert plain((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded"]) for r in got.collect()) == plain((r[0], len(x), digest(x), r[1] or "") for r, x in zip(rows(), ids, strict=True))
    counted = token_counts.token_counts(table(spark), PATH, budget=100, store=False)
    assert plain((r["doc_id"], r["n_tokens"], r["over_limit"]) for r in counted.collect()) == plain((r[0], len(x), len(x) > 100) for r, x in zip(rows(), ids, strict=True))
    assert token_counts.token_counts(table(spark).limit(0), PATH).count() == bpe.bpe_round_trip(table(spark).limit(0), PATH).count() == 0


def test_mixing(spark):
    mixed = mixing.mix(table(spark)).collect()
    sizes = lambda s: sum(len((r[1] or "").split()) for r in rows() if r[3] == s)
    assert len(mixed) == len(rows()) and all(r["source_size"] == sizes(r["source"]) and 0 <= r["copies"] <= 3 for r in mixed)
    out = mixing.mixed_documents(table(spark))
    assert out.columns == table(spark).columns and out.count() == sum(r["copies"] for r in mixed)
    assert mixing.mixed_documents(table(spark).limit(0)).count() == 0


def test_rules(spark):
    got = quality_rules.quality_rules(table(spark), labels(spark)).collect()
    assert len(got) == len(rows()) and {r["doc_id"] for r in got if r["kept"]} <= {1, 2, 7, None, -5}
    kept = quality_rules.keep_good(table(spark), labels(spark))
    assert kept.columns == table(spark).columns and kept.count() == sum(r["kept"] for r in got)
    assert quality_rules.keep_good(table(spark).limit(0), labels(spark).limit(0)).count() == 0


def test_substrings(spark):
    mine = [(r[0] if r[0] is not None else 2**63 - 1, r[1]) for r in rows() if r[0] not in (6, 7, 9)]
    docs = table(spark).where("doc_id is null or doc_id not in (6, 7, 9)")
    got = {tuple(r) for r in suffix_dedup.repeated_substrings(docs).drop("span_from", "span_to").collect()}
    # Rows with equal id and text are one document.
    want = {(None if d == 2**63 - 1 else d, *rest) for d, *rest in removal(list(dict.fromkeys(mine)), 100)}
    assert got == want
    out = suffix_dedup.dedup_documents(table(spark))
    assert out.columns == table(spark).columns and out.count() == len(rows())
    assert suffix_dedup.dedup_documents(table(spark).limit(0)).count() == 0


def test_fingerprints(spark):
    got = simhash.simhash_edited(table(spark)).collect()
    assert sorted(r["n_chars"] for r in got) == sorted(len(r[1] or "") for r in rows())
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    pairs, members = simhash.near_documents(table(spark))
    assert members.count() == len(rows()) and pairs.count() == 0  # no id is divisible by 100
    assert simhash.simhash_edited(table(spark).limit(0)).count() == 0


def test_layouts_of_odd_json(spark):
    """Null, empty and mixed lists, other fields, values that are no objects, and what is not JSON at all."""
    odd = [
        ({"id": 1, "messages": []}, "messages", []), ({"id": 2, "messages": None}, "messages", []), ({"id": 3, "messages": [{"role": "user", "content": "u", "name": "n"}, {"role": None}]}, "messages", [("user", "u"), ("", "")]),
        ({"id": 4, "prompt": "p", "response": "r", "source": "s", "meta": {"k": [1]}}, "prompt_response", [("user", "p"), ("assistant", "r")]), ([1, 2], None, []), ("text", None, []), (None, None, []), ({}, None, []),
        ({"id": 5, "messages": ["u"]}, None, []), ({"id": 6, "messages": [{"role": "user", "content": "u"}], "prompt": "p"}, None, []), ({"id": 7, "question": "q"}, None, []), ({"id": 8, "prompt": 5, "response": {"a": 1}}, None, []), ({"id": 9, "prompt": 5, "response": None}, "prompt_response", [("user", "5"), ("assistant", "")]),
    ]
    texts = [(str(k), json.dumps(v)) for k, (v, _, _) in enumerate(odd)] + [("bad", "{"), ("none", None), ("deep", "[" * 5000)]
    df = spark.createDataFrame(texts, "id string, j string").withColumn("layout", F.lit("x"))
    got = {r["conv_id"]: (r["layout"], r["n_turns"]) for r in chat_format.layouts_of_json(df, "id", "j").collect()}
    assert got == {**{str(k): (name, len(turns)) for k, (_, name, turns) in enumerate(odd)}, "bad": (None, 0), "none": (None, 0), "deep": (None, 0)}
    turns = sorted((r["conv_id"], r["turn"], r["role"], r["text"]) for r in chat_format.canonical_turns_of_json(df, "id", "j").collect())
    assert turns == sorted((str(k), n, role, text) for k, (_, _, ts) in enumerate(odd) for n, (role, text) in enumerate(ts))
    extra = spark.createDataFrame([(1, 0, "user", "a", "b")], "conv_id long, turn long, role string, text string, head string")
    assert chat_format.format_chats(chat_format.canonical_turns(extra)).count() == 1


@pytest.mark.parametrize("k", range(5))
def test_pipeline_stages(spark, tmp_path, k):
    labels(spark).write.parquet(f"{tmp_path}/labels.parquet")
    docs = table(spark)
    _, stage = corpus_pipeline.STAGES[k]
    out = stage(spark, docs, str(tmp_path))
    if k < 4:
        assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
    n = out.count()
    assert n == {0: 7, 1: len(rows()) - 3, 2: len(rows()), 4: len(rows())}.get(k, n)
    if k == 0:  # clean rows without an id or a language stay
        assert sum(r["doc_id"] is None for r in out.collect()) == 2
    assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_pipeline_goes_on(spark, tmp_path):
    """A run that ended after a stage goes on there, and leaves its last output only."""
    import os

    docs = spark.createDataFrame(rows(), "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels(spark).write.parquet(f"{tmp_path}/labels.parquet")
    whole = corpus_pipeline.run(spark, str(tmp_path), f"{tmp_path}/one")
    want = plain((r["doc_id"], r["ids_sha256"]) for r in whole.collect())
    assert os.listdir(f"{tmp_path}/one") == ["4"]
    kept = corpus_pipeline.drop_near_duplicates(spark, corpus_pipeline.filter_quality(spark, docs, str(tmp_path)), str(tmp_path))
    kept.write.parquet(f"{tmp_path}/two/1")
    again = corpus_pipeline.run(spark, str(tmp_path), f"{tmp_path}/two")
    assert plain((r["doc_id"], r["ids_sha256"]) for r in again.collect()) == want


def grams_by_hand(text):
    """Buckets of the 1- to 3-grams of letters, other characters as spaces."""
    s = [ord(c) if c.isalpha() else 32 for c in (text or "").lower()]
    padded, out = [32, *s, 32], []
    for k in range(1, len(padded) - 1):
        a, b, c = padded[k - 1 : k + 2]
        uni = b * 0x9E3779B97F4A7C15
        bi = a * 0xC2B2AE3D27D4EB4F + uni
        tri = bi + c * 0x165667B19E3779F9
        out += [h % 2**64 >> 48 for h, use in ((uni, b != 32), (bi, b != 32 or a != 32), (tri, b != 32 or a != 32 or c != 32)) if use]
    return out


def test_language_against_brute_force(spark, monkeypatch):
    """Multinomial naive Bayes by loops; texts cut into pieces of 16 characters give the same."""
    r = random.Random(30)
    word = {"a": "banana lama", "b": "trotz plötzlich", "c": "où été ça"}
    train = [(k, " ".join(r.choice(word[x].split()) for _ in range(r.randrange(1, 40))), x) for k, x in enumerate("aaaabbbbbbcc")]
    tests = [(100 + k, t) for k, t in enumerate(["banana plötzlich", "ÉTÉ été où", None, "12", "x", "lama " * 300 + "trotz " * 299, "trotz trotz lama", "İ banana"])]
    df = spark.createDataFrame(train, "doc_id long, text string, lang string")
    counts = {x: np.zeros(language_id.BUCKETS) for x in "abc"}
    for _, t, x in train:
        for g in grams_by_hand(t):
            counts[x][g] += 1
    log_p = {x: np.log((c + 0.5) / (c + 0.5).sum()).astype(np.float32).astype(float) for x, c in counts.items()}
    prior = {x: math.log(sum(row[2] == x for row in train) / len(train)) for x in "abc"}
    want = {}
    for i, t in tests:
        g = grams_by_hand(t)
        logit = {x: prior[x] + sum(log_p[x][k] for k in g) for x in "abc"}
        best = max("abc", key=lambda x: logit[x])
        tempered = [math.exp((v - logit[best]) * min(1, 60 / max(len(g), 1))) for v in logit.values()]
        want[i] = (best, 1 / sum(tempered)) if any(c.isalpha() for c in t or "") else ("und", 0.0)
    asked = spark.createDataFrame(tests, "doc_id long, text string")
    for slab in (1 << 19, 16):
        monkeypatch.setattr(language_id, "SLAB", slab)
        model = language_id.train(df)
        names, scores = model.predict([t for _, t in tests])
        for (i, _), name, score in zip(tests, names, scores, strict=True):
            assert name == want[i][0] and abs(score - want[i][1]) < 1e-6
    assert {r["doc_id"]: r["lang_pred"] for r in language_id.identify_language(asked, model).collect()} == {i: w[0] for i, w in want.items()}


def test_quality_model_against_brute_force(spark):
    """Dictionaries, normalised differences and the curve from the definition; every label drawn."""
    r = random.Random(31)
    word = {1: [f"good{k}" for k in range(40)], 0: [f"bad{k}" for k in range(40)]}
    docs = [(k, " ".join(r.choice(word[k % 2]) for _ in range(r.randrange(5, 400)))) for k in range(80)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    marks = spark.createDataFrame([(k, k % 2) for k, _ in docs], "doc_id long, quality int")
    model = quality_model.train(df, marks)
    parity = {x["doc_id"]: x["p"] for x in df.select("doc_id", (F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(5)), F.lit(1 << 30)) % 2).alias("p")).collect()}
    import xxhash

    dictionaries = {}
    for y in (0, 1):
        pieces = [(xxhash.xxh64_intdigest(f"{k}:{a}") >> 1, t.encode()[a : a + 512]) for k, t in docs if k % 2 == y and parity[k] == 0 for a in range(0, len(t.encode()), 512)]
        dictionaries[y] = b"".join(p for _, p in sorted(pieces))
    assert (model.good, model.bad) == (dictionaries[1], dictionaries[0])

    def size(blob, y):
        d = zstandard.ZstdCompressionDict(dictionaries[y], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        press = zstandard.ZstdCompressor(dict_data=d, level=3, write_checksum=False, write_content_size=False, write_dict_id=False)
        return sum(len(press.compress(blob[a : a + 1024])) - 6 for a in range(0, len(blob), 1024))

    x = {k: (size(t.encode(), 0) - size(t.encode(), 1)) / (size(t.encode(), 0) + size(t.encode(), 1)) for k, t in docs}
    assert all(abs(model.difference(t) - x[k]) < 1e-12 for k, t in docs)
    # The curve is where the ridge-penalised likelihood of the other half is flat.
    held = [(x[k], k % 2) for k, _ in docs if parity[k] == 1]
    scale = float(np.std([v for v, _ in held]))
    p = [1 / (1 + math.exp(-max(-30, min(30, model.slope * v + model.offset)))) for v, _ in held]
    assert abs(sum((y - q) * v / scale for (v, y), q in zip(held, p, strict=True)) - 1e-3 * model.slope * scale) < 1e-6
    assert abs(sum(y - q for (_, y), q in zip(held, p, strict=True)) - 1e-3 * model.offset) < 1e-6
    assert model.score(None) == model.score("") == 1 / (1 + math.exp(-model.offset))
