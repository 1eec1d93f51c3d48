"""Tokens, classifiers, rules, mixing and chats against brute force, exact round trips and held-out accuracy."""

import json
import math
import random
import re
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tagloom.llm import bpe, chat_format, language_id, mixing, quality_model, quality_rules, queries, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.01"


def odd_texts():
    r = random.Random(1)
    pick = lambda chars, n: "".join(r.choice(chars) for _ in range(n))
    fixed = ["", "a", " " * 999, "a" * 5000, "I'll don't 've  \n\n x<|endoftext|> <|endoftext|>y", "Ü, Ü, ß€ 12345678901", "日本語 テスト 𝒳 é́", "thetheandthe" * 300, "\n" * 301 + "x", "-" * 4097, "\x00\x01<|endoftext", "é" * 700]
    return [*fixed, pick("abcdeéß", 3000), pick("01", 1777), pick("  \n\ta.'sz\x85\xa0\x1c\x1f　", 3000), *(pick("abcé '\n\x1c-1 !", r.randrange(60)) for _ in range(300))]


def test_bpe_is_that_of_the_library(spark):
    whole, own, counter = Tokenizer.from_file(PATH), bpe.ByteBpe(PATH), token_counts.PrefixCounter(bpe.ByteBpe(PATH))
    texts = odd_texts()
    for t in texts:
        ids = whole.encode(t, add_special_tokens=False).ids
        assert own.encode(t) == ids
        assert own.decode(ids) == whole.decode(ids, skip_special_tokens=False)
        assert counter.count(t) == len(ids)
    assert all(own.pieces(t) == [t[a:z] for _, (a, z) in whole.pre_tokenizer.pre_tokenize_str(t)] for t in texts)
    own.ranks = None  # the way for vocabularies whose ids are not in merge order
    assert all(own.encode(t) == whole.encode(t, add_special_tokens=False).ids for t in texts[:40])
    df = spark.createDataFrame([(k, t, "x") for k, t in enumerate([*texts, None])], "doc_id long, text string, ids string")
    got = {r["doc_id"]: r for r in bpe.bpe_round_trip(df, PATH).collect()}
    assert all(got[k]["ids"] == whole.encode(t, add_special_tokens=False).ids and got[k]["decoded"] == t for k, t in enumerate(texts))
    assert got[len(texts)]["n_tokens"] == 0
    assert bpe.bpe_round_trip(df.limit(0), PATH).count() == 0


@pytest.mark.parametrize("leaf", [1, 2, 3, 7, 64])
def test_tree_of_small_leaves(leaf, monkeypatch):
    """Texts parted at every few characters come out as the library encodes them whole."""
    monkeypatch.setattr(bpe, "TEXT_LEAF", leaf)
    whole, own = Tokenizer.from_file(PATH), bpe.ByteBpe(PATH)
    r = random.Random(leaf)
    bits = ["'", "'l", "ll", "'re", "r", "e", " ", "  ", "\n", "\t ", "a", "the", "été", "12", "3", "!", "''", "…", "日本", "д", "x́", "😀", "\xa0", "　", "<|endoftext|>"]
    texts = ["".join(r.choice(bits) for _ in range(r.randrange(1, 60))) for _ in range(400)] + ["a" * 700, " " * 300 + "x", "日本語" * 150, "don't" * 90]
    for t, ids in zip(texts, own.encode_all(texts), strict=True):
        assert ids == whole.encode(t, add_special_tokens=False).ids, t


def test_tree_runs_on_given_documents(spark, monkeypatch):
    """Every document longer than a leaf goes through joins, in any script, and all ids are the library's."""
    joins, concat = [], bpe.ByteBpe.concat
    monkeypatch.setattr(bpe.ByteBpe, "concat", lambda self, a, b: joins.append(1) or concat(self, a, b))
    whole, own = Tokenizer.from_file(PATH), bpe.ByteBpe(PATH)
    texts = [r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    texts += ["".join(chr(0x4E00 + (k * k) % 9000) for k in range(n)) for n in (3000, 20_000)] + ["привет" * 2000, "😀" * 3000]
    assert list(own.encode_all(texts)) == [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]
    assert len(joins) == sum(max(0, -(-len(t) // bpe.TEXT_LEAF) - 1) for t in texts) > 100


def test_long_unsplit_texts():
    own = bpe.ByteBpe(PATH)
    r = random.Random(4)
    text = "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(400_000))
    ids = own.encode(text)
    assert own.decode(ids) == text
    assert ids[:500] == own.encode(text[:4000])[:500]


def test_joins_of_halves():
    own = bpe.ByteBpe(PATH)
    r = random.Random(3)
    for _ in range(400):
        s = "".join(r.choice("theandinghatoer") for _ in range(r.randrange(2, 80))).encode()
        k = r.randrange(1, len(s))
        assert own.join(*own.units([s[:k], s[k:]])) == own.units([s])[0]


def test_counts_of_prefixes(spark):
    """Every prefix of odd texts, and every cut of every pre-token, against the library."""
    whole, counter = Tokenizer.from_file(PATH), token_counts.PrefixCounter(bpe.ByteBpe(PATH))
    counts = lambda texts: [len(e.ids) for e in whole.encode_batch(texts, add_special_tokens=False)]
    texts = [t[:400] for t in odd_texts()] + ["x  y", "a\n\n b", "we'll they're I've 'll", "q  \n<|endoftext|> x\n\ny<|endoftext|><|endoftext|>z", "日本語  語<|endoftext|>é\u3000 é"]
    for t in texts:
        assert counter.table(t).tolist() == counts([t[:k] for k in range(len(t) + 1)]), t
        for budget in (0, 1, 5, 50):
            cut = counter.fits(t, budget)
            assert counts([t[:cut]])[0] <= budget and (cut == len(t) or counts([t[: cut + 1]])[0] > budget)
    blob = b"unbelievablythesame"
    assert counter.unit_counts(blob)[1:] == [len(counter.bpe.units([blob[:k]])[0]) for k in range(1, len(blob) + 1)]
    rows = spark.createDataFrame([(1, "one two three", 5), (1, "one two three", 5), (None, None, 6), (2, "", 7)], "doc_id long, text string, n_tokens int")
    got = token_counts.token_counts(rows, PATH, budget=2)
    assert got.where("doc_id = 1").count() == 2
    row = got.where("doc_id = 1").first()
    assert (row["n_tokens"], row["over_limit"], row["fits_chars"]) == (3, True, 7)
    assert row["prefix_tokens"] == counts(["one two three"[:k] for k in range(14)])
    assert [(r["n_bytes"], r["n_tokens"], r["prefix_tokens"]) for r in got.where("doc_id is null or doc_id = 2").collect()] == [(0, 0, [0])] * 2
    asked = got.select(token_counts.fits_chars(F.col("prefix_tokens"), 1).alias("c"), token_counts.tokens_of_prefix(F.col("prefix_tokens"), 7).alias("n")).first()
    assert tuple(asked) == (3, 2)
    assert token_counts.token_counts(rows.limit(0), PATH).count() == 0


def test_budget_inside_one_long_pre_token():
    """An unsplit text is cut where the budget ends, not at its beginning."""
    counter, r = token_counts.PrefixCounter(bpe.ByteBpe(PATH)), random.Random(6)
    whole = Tokenizer.from_file(PATH)
    for text in ("".join(r.choice("abcdefgh") for _ in range(30_000)), "日本語" * 3000, "=" * 40_000):
        cut = counter.fits(text, 100)
        n = [len(whole.encode(text[:k], add_special_tokens=False).ids) for k in range(cut, cut + 40)]
        assert n[0] <= 100 and min(n[1:], default=101) > 100


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = queries.op2_language_id(spark, SF).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) / len(got) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_of_odd_rows(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "der Hund und die Katze", "de"), (3, None, "de"), (4, "12 !!", None), (5, "the dog and", None), (6, "und die", None), (6, "und die", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.train(docs)
    got = sorted((r["doc_id"], r["lang_pred"]) for r in language_id.identify_language(docs, model).collect())
    assert got == [(1, "en"), (2, "de"), (3, "und"), (4, "und"), (5, "en"), (6, "de"), (6, "de")]
    none = language_id.train(docs.limit(0))
    assert {r["lang_pred"] for r in language_id.identify_language(docs, none).collect()} == {"und"}
    assert language_id.identify_language(docs.limit(0), model).count() == 0


def test_quality_on_held_out_rows(spark):
    got = queries.op3_quality_classifier(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").collect()
    good, bad = ([r["score"] for r in got if r["quality"] == y] for y in (1, 0))
    above = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert above > 0.85
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got)


def test_quality_without_evidence(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "abc")], "doc_id long, text string")
    labels = spark.createDataFrame([(3, 1)], "doc_id long, quality int")
    model = quality_model.train(docs, labels)
    assert all(r["score"] > 0.9 for r in quality_model.score_quality(docs, model).collect())
    nothing = quality_model.train(docs, labels.limit(0))
    assert all(abs(r["score"] - 0.5) < 1e-9 for r in quality_model.score_quality(docs, nothing).collect())


def words_of(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def base_counts(text):
    w = words_of(text)
    windows = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    covered = {j for k in range(len(w) - 2) if windows[tuple(w[k : k + 3])] > 1 for j in (k, k + 1, k + 2)}
    lines = [x for x in (text or "").split("\n") if words_of(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def rule_texts():
    r = random.Random(5)
    out = [None, "", "   \n\t", "a", "a b", "a b c", "a b c a b c", "x " * 400, "a\n\na\n a\na", "#*# | <b>\r\n#*#", "é\x0bü\x0cß\x1ca", "a b c d " * 30 + "z y x a b"]
    for _ in range(60):
        out.append("".join(r.choice(["ab ", "cd ", "e ", "f\n", "g\t", "#", "*! "]) for _ in range(r.randrange(1, 300))))
    return out


def test_rule_counts(spark):
    texts = rule_texts()
    df = spark.createDataFrame([(k, t, None if k % 3 else "en") for k, t in enumerate(texts)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    for r in quality_rules.quality_rules(df, labels).collect():
        want = base_counts(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert (r["base_failed"], r["kept"]) == (failed, not failed)  # without labels no cutoff is safe
    assert quality_rules.quality_rules(df.limit(0), labels).count() == 0


def tail(k, n, p):
    """P(X <= k), by exact terms."""
    log = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
    return min(1.0, math.fsum(math.exp(x) for x in log))


def cutoffs_by_hand(rows, risk=0.05, delta=0.05):
    """{language: {rule: cutoff}} from (id, language, label, base failed, the four measures), by loops over the definition."""
    import zlib

    grid, rules = quality_rules.GRID, list(quality_rules.MEASURES)
    rows = [r for r in rows if not r[3] and r[2] in (0, 1)]
    half = lambda r: zlib.crc32(str(r[0]).encode()) % 3 == 0
    strata = ["*", *sorted({r[1] for r in rows}, key=str)] if rows else []
    member = lambda s, r: s == "*" or r[1] == s
    chosen, out = {}, {}
    for s in strata:
        mine = [r for r in rows if member(s, r) and half(r)]
        bad, good = ([r for r in mine if r[2] == y] for y in (0, 1))
        found = []
        for j in range(len(rules)):
            best = None
            for k in range(len(grid) - 1, -1, -1):
                b, g = (sum(r[4 + j] > grid[k] for r in x) for x in (bad, good))
                gain = b / max(1, len(bad)) - 5.0 * (g / max(1, len(good)))
                if g <= risk * len(good) and gain > 0 and (best is None or gain > best[0]):
                    best = (gain, k)
            if best:
                found.append((-best[0], j, best[1]))
        chosen[s] = [(j, k) for _, j, k in sorted(found)]
    for s in strata:
        order = chosen[s] + [(j, k) for j, k in chosen["*"] if j not in [x for x, _ in chosen[s]]]
        good = [r for r in rows if member(s, r) and r[2] == 1]
        test = [r for r in good if not half(r)]
        for m, (j, least) in enumerate(order):
            lost = sum(any(r[4 + i] > grid[k] for i, k in order[: m + 1]) for r in test)
            if not test or lost >= risk * len(test) or tail(lost, len(test), risk) > delta / len(strata):
                break
            for k in range(least, len(grid)):
                lost = sum(r[4 + j] > grid[k] for r in good)
                if lost < risk * len(good) and tail(lost, len(good), risk) <= delta / (len(strata) * len(rules) * len(grid)):
                    out.setdefault(s, {})[rules[j]] = grid[k]
                    break
    return out


def learnt(cutoffs):
    """{stratum: {rule: cutoff}} of a table of cutoffs."""
    name = lambda s: None if s == "null" else s.removeprefix("=")
    return {name(r["stratum"]): {k: r[k] for k in quality_rules.MEASURES if r[k] is not None} for r in cutoffs.collect()}


def upper(text):
    import unicodedata

    return sum(unicodedata.category(c) == "Lu" for c in text or "")


def test_verdicts_against_brute_force(spark):
    """kept of every document, from counts, cutoffs and tests worked out by hand."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    label = {r["doc_id"]: r["quality"] for r in labels.collect()}
    rows = []
    for d in docs.select("doc_id", "lang", "text").collect():
        n_words, chars, symbols, doubled, repeats = base_counts(d["text"])
        lines = [x for x in (d["text"] or "").split("\n") if words_of(x)]
        failed = n_words < 50 or 100 * repeats > 50 * n_words
        rows.append((d["doc_id"], d["lang"], label.get(d["doc_id"]), failed, symbols / max(chars, 1), doubled / max(len(lines), 1), repeats / max(n_words, 1), upper(d["text"]) / max(chars, 1)))
    cutoffs = cutoffs_by_hand(rows)
    assert any(s != "*" for s in cutoffs)
    want = {r[0]: not r[3] and all(r[4 + j] <= cutoffs.get(r[1], {}).get(rule, 9) for j, rule in enumerate(quality_rules.MEASURES)) for r in rows}
    got = {r["doc_id"]: r["kept"] for r in quality_rules.quality_rules(docs, labels).collect()}
    assert got == want
    good = [want[i] for i, y in label.items() if y == 1 and not next(r[3] for r in rows if r[0] == i)]
    assert sum(good) / len(good) > 0.95
    kept = quality_rules.keep_good(docs, labels)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, k in want.items() if k)


def counted_rows(spark, rows):
    """(lang, quality, symbols, doubled lines, repeats, capitals), in thousandths, as measured rows and labels."""
    columns = "doc_id long, lang string, __n_words long, __word_chars long, __n_symbols long, __n_lines long, __n_dup_lines long, __n_repeat_words long, __n_upper long"
    counted = spark.createDataFrame([(k, lang, 1000, 1000, a, 1000, b, c, d) for k, (lang, _, a, b, c, d) in enumerate(rows)], columns)
    return counted, spark.createDataFrame([(k, r[1]) for k, r in enumerate(rows)], "doc_id long, quality int")


def by_hand(rows):
    return cutoffs_by_hand([(k, r[0], r[1], False, *(x / 1000 for x in r[2:])) for k, r in enumerate(rows)])


def test_common_cutoff_rests_where_it_is_not_safe(spark):
    """'*' is safe although it would reject all of a small language, and one without labels."""
    rows = [*[("en", 1, 0, 0, 0, 0)] * 3000, *[("en", 0, 500, 0, 0, 0)] * 300, *[("xx", 1, 500, 0, 0, 0)] * 6]
    counted, labels = counted_rows(spark, rows)
    cutoffs = quality_rules.learn_cutoffs(counted, labels)
    assert learnt(cutoffs) == by_hand(rows) and learnt(cutoffs)["*"]["symbols"] < 0.5
    kept = quality_rules.judged(counted.unionByName(counted.where("lang = 'xx'").withColumn("lang", F.lit("unseen"))), cutoffs).where("__kept")
    assert {r["lang"]: r["count"] for r in kept.groupBy("lang").count().collect()} == {"en": 3000, "xx": 6, "unseen": 6}


def test_common_cutoff_holds_where_it_is_safe(spark):
    rows = [*[("en", 1, 0, 0, 0, 0)] * 3000, *[("en", 0, 500, 0, 0, 0)] * 300, *[("de", 1, 0, 0, 0, 0)] * 3000]
    cutoffs = learnt(quality_rules.learn_cutoffs(*counted_rows(spark, rows)))
    assert cutoffs == by_hand(rows) and cutoffs["de"] == {"symbols": cutoffs["*"]["symbols"]}


def test_rules_together_keep_the_risk(spark):
    """Four rules that each reject another 2 % of the good rows are safe one by one, but not together."""
    one = lambda k, v: tuple(v if j == k else 0 for j in range(4))
    rows = [*[("en", 1, 0, 0, 0, 0)] * 2760, *(("en", 1, *one(k, 400)) for k in range(4) for _ in range(60)), *(("en", 0, *one(k, 300)) for k in range(4) for _ in range(100))]
    counted, labels = counted_rows(spark, rows)
    cutoffs = quality_rules.learn_cutoffs(counted, labels)
    assert learnt(cutoffs) == by_hand(rows)
    good = counted.join(labels.where("quality = 1"), "doc_id")
    assert quality_rules.judged(good, cutoffs).where("not __kept").count() < quality_rules.RISK * 3000


def test_many_languages_have_their_own_cutoffs(spark, monkeypatch):
    """300 languages, none dropped; the last with the fewest labels is judged like the first, broadcast or not."""
    rows = []
    for s in range(300):
        rows += [(f"l{s:03}", 1, 0, 0, 0, 0)] * (330 - s // 10) + [(f"l{s:03}", 0, 200, 0, 0, 0)] * 20
    counted, labels = counted_rows(spark, rows)
    cutoffs = quality_rules.learn_cutoffs(counted, labels)
    assert len(learnt(cutoffs)) == 301
    for most in (10_000, 0):
        monkeypatch.setattr(quality_rules, "BROADCAST_STRATA", most)
        assert quality_rules.judged(counted, cutoffs).where("__kept").join(labels, "doc_id").where("quality = 0").count() == 0


def test_joint_rejection_stays_below_the_risk(spark):
    """Simulated labels whose good rows a rule rejects with a chance just above the risk: hardly any draw lets it pass."""
    r, wrong = random.Random(12), 0
    rows, draws = [], 60
    for s in range(draws):
        rows += [(f"s{s:02}", 1, 400 if r.random() < 0.055 else 0, 0, 0, 0) for _ in range(200)] + [(f"s{s:02}", 0, 500, 0, 0, 0)] * 60
    cutoffs = learnt(quality_rules.learn_cutoffs(*counted_rows(spark, rows)))
    for s, rules in cutoffs.items():
        wrong += s != "*" and rules.get("symbols", 9) < 0.4
    assert wrong <= 0.05 * draws


def test_clashing_names_and_odd_rows(spark):
    docs = spark.createDataFrame([(1, "a b c " * 40, "en", "k", 7), (None, None, None, "", 0), (1, "", None, None, None)], "doc_id long, text string, lang string, __keys string, __n_words long").withColumn("__kept", F.lit("x"))
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1)], "doc_id long, quality int")
    assert quality_rules.keep_good(docs, labels).columns == docs.columns
    assert quality_rules.keep_good(docs, labels).count() == 0
    assert quality_rules.keep_good(docs.limit(0), labels).count() == quality_rules.quality_rules(docs.limit(0), labels.limit(0)).count() == 0


def test_binomial_tail(spark):
    cases = [(k, n, p) for n, p in ((10, 0.3), (50, 0.05), (1000, 0.05), (40_000, 0.05)) for k in sorted({0, 1, int(n * p / 2), int(n * p) - 1}) if k < n * p]
    for p in {c[2] for c in cases}:
        mine = [c for c in cases if c[2] == p]
        got = spark.createDataFrame([c[:2] for c in mine], "k long, n long").select("k", "n", quality_rules.binomial_tail(F.col("k"), F.col("n"), p).alias("t")).collect()
        for r in got:
            want = tail(r["k"], r["n"], p)
            assert abs(r["t"] - want) <= 1e-9 * want + 1e-300


def targets_by_hand(sizes):
    """Share by weight; stop at three times the size; share the excess again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    fixed, total = {}, sum(sizes.values())
    while True:
        open_ = [s for s in order if s not in fixed]
        rest = total - sum(fixed.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] >= 3 * sizes[s]]
        if not over:
            return {**fixed, **share}
        fixed |= {s: 3 * sizes[s] for s in over}


@pytest.mark.parametrize("buckets", [4096, 3])
def test_mixing(spark, buckets, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKETS", buckets)
    r = random.Random(2)
    rows = [(k // 2 if k % 10 == 0 else k, "w " * int(r.paretovariate(1) * 5) if k % 17 else None, r.choice(["a", "b", "c", "d", None, "é"]) if k % 3 else "a", "x") for k in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size string")
    got = mixing.mix(df).collect()
    sizes = Counter()
    for _, text, source, _ in rows:
        sizes[source] += len(words_of(text))
    want = targets_by_hand(sizes)
    assert len(got) == len(rows)
    for s, target in want.items():
        mine = [x for x in got if x["source"] == s]
        assert all(abs(x["target"] - target) < 1e-6 and x["source_size"] == sizes[s] and x["copies"] <= 3 for x in mine)
        taken = sum(x["copies"] * x["size"] for x in mine)
        assert abs(taken - target) <= 2 * max(x["size"] for x in mine)
    key = lambda rs: sorted((x["doc_id"], x["size"], x["source"] or "", x["copies"]) for x in rs)
    assert key(mixing.mix(df.repartition(7)).collect()) == key(got)
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns and out.count() == sum(x["copies"] for x in got)
    assert mixing.mix(df.limit(0)).count() == 0


def test_chats_round_trip(spark):
    texts = ["", None, "</s>[INST] ok [/INST]", "<|end|>\n<|user|>\nx", "&lt;|end|&gt; &amp;amp; &lsqb;", "a|b>c\\n", "é😀\n\n", "<|im_start|>assistant"]
    rows = [(k % 3 if k % 5 else None, 10 - k, role, t) for k, (role, t) in enumerate((role, t) for t in texts for role in ("user", "assistant", "a|b>", None))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    back = {r["conv_id"]: r for r in chat_format.read_back(chat_format.format_chats(chat_format.canonical_turns(df))).collect()}
    for c in {r[0] for r in rows}:
        mine = sorted((t, r or "", x or "") for i, t, r, x in rows if i == c)
        assert [(t["role"], t["text"]) for t in back[c]["turns"]] == [m[1:] for m in mine]
        assert back[c]["loss_text"] == "".join(x for _, r, x in mine if r == "assistant")
    assert chat_format.format_chats(df.limit(0)).count() == 0


def test_layouts(spark):
    values = [
        {"id": 1, "prompt": "p", "response": "r"}, {"id": 2, "instruction": "i", "input": "", "output": "o"}, {"id": 3, "messages": [{"role": "system", "content": "s"}, {"role": "user", "content": "u"}]},
        {"id": 4, "conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}]},
    ]
    df = spark.createDataFrame([(str(v["id"]), json.dumps(v)) for v in values], "id string, j string")
    got = sorted((r["conv_id"], r["turn"], r["role"], r["text"]) for r in chat_format.canonical_turns_of_json(df, "id", "j").collect())
    want = [("1", 0, "user", "p"), ("1", 1, "assistant", "r"), ("2", 0, "user", "i"), ("2", 1, "assistant", "o"), ("3", 0, "system", "s"), ("3", 1, "user", "u"), ("4", 0, "user", "h"), ("4", 1, "assistant", "g")]
    assert got == want
    for v in values:
        schema = spark.range(1).select(F.schema_of_json(F.lit(json.dumps(v)))).first()[0]
        one = spark.createDataFrame([(json.dumps(v),)], "value string").selectExpr(f"inline(array(from_json(value, '{schema}')))")
        turns = [(r["role"], r["text"]) for r in chat_format.canonical_turns(one).orderBy("turn").collect()]
        assert turns == [(r, t) for c, _, r, t in want if c == str(v["id"])]
    with pytest.raises(ValueError, match="no mapping"):
        chat_format.mapping_for(["id", "question"])
