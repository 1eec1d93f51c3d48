"""Quality rules with risk-controlled thresholds, in DataFrame operations only.

Each rule rejects a document whose measure exceeds a cutoff. Cutoffs come from a fixed grid. Labelled documents decide
which are used in a stratum (a language, and all languages together). A third of their ids chooses, for each rule, the
cutoff that parts bad from good best, the more lenient of equal ones; a rule without such a cutoff in a stratum tries that
of all languages. The other ids test the chosen rules together, the best rule first and then one more at a time: an
exact binomial test at level DELTA / strata has to reject that a share RISK or more of the stratum's good documents
go by any of them, and the first failure ends the stratum's list. A fixed sequence needs no further correction, so
with probability 1 - DELTA the rules of no stratum reject together RISK or more of its good documents. Each cutoff is
then raised as far as a test of it alone on all labelled documents asks (DELTA / (strata x rules x cutoffs)); what
passes no test rests.

Measures are computed within the row from whole texts. All choices and tests are DataFrame aggregates by stratum over counts of
(stratum, rule, cutoff), whatever the number of strata; the cutoffs are a table with a row for each stratum that has any, joined
to the measured rows as Catalyst sees fit. In strata without labels, or with too few to pass a test, all rules but the base rule rest.

Null, empty and word-less texts have measures 0 and fail the base rule. A null language is a stratum like others
without labels. Repeated rows are rows of their own; labels apply to all rows of an id, the lower label if they differ.
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import checkpointed, crc_fold, words

RISK, DELTA = 0.05, 0.05
#: Rows of the table of cutoffs up to which it is broadcast.
BROADCAST_STRATA = 10_000
#: How much a point of good documents' share counts against a point of bad ones'.
GOOD_WEIGHT = 5.0
GRID = tuple(round(0.01 * 1.2**k, 4) for k in range(25))
#: Each rule's measure, from 0 (fine) up.
MEASURES = {
    "symbols": "n_symbols / greatest(word_chars, 1)",
    "dup_lines": "n_dup_lines / greatest(n_lines, 1)",
    "repeats": "n_repeat_words / greatest(n_words, 1)",
    "shouting": "n_upper / greatest(word_chars, 1)",
}
ALL = "*"


def measured(docs: DataFrame, text: Column) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_upper, prefixed by two underscores."""
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = docs.withColumns({"__words": words(text), "__lines": lines})
    df = df.withColumns(
        {
            "__n_words": F.size("__words").cast("long"),
            "__word_chars": F.length(F.translate(t, " \t\n\x0b\x0c\r", "")).cast("long"),
            "__n_symbols": (F.length(t) - F.length(F.translate(t, "#*$%&|<>", ""))).cast("long"),
            "__n_lines": F.size("__lines").cast("long"),
            "__n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
            "__n_upper": F.regexp_count(t, F.lit(r"\p{Lu}")).cast("long"),
            "__h": F.transform("__words", lambda w: F.xxhash64(w)),
            # Low bits of a key hold the window's place, high bits its hash.
            "__m": F.expr("shiftleft(1L, length(bin(size(__words)))) - 1"),
        }
    ).drop("__words", "__lines")
    key = "(xxhash64({0}get(__h, i), get(__h, i + 1), get(__h, i + 2)) & ~__m) | i"
    twice = "filter({0}, (x, j) -> (x & ~__m) <=> (get({0}, j - 1) & ~__m) or (x & ~__m) <=> (get({0}, j + 1) & ~__m))"
    places = F.expr(f"if(size(__h) < 3, array(), transform(sequence(0, size(__h) - 3), i -> {key.format('')}))")
    df = df.withColumn("__keys", F.sort_array(places.cast("array<long>")))
    df = df.withColumn("__found", F.expr(f"transform({twice.format('__keys')}, x -> x & __m)"))
    # A second hash settles what the shortened first one has found.
    df = df.withColumn("__again", F.sort_array(F.expr(f"transform(transform(__found, x -> cast(x as int)), i -> {key.format('17, ')})").cast("array<long>")))
    df = df.withColumn("__at", F.sort_array(F.expr(f"transform({twice.format('__again')}, x -> cast(x & __m as int))")))
    covered = F.expr("aggregate(transform(__at, (p, j) -> least(3, coalesce(get(__at, j + 1) - p, 3))), 0L, (a, b) -> a + b)")
    return df.withColumn("__n_repeat_words", covered).drop("__h", "__m", "__keys", "__found", "__again", "__at")


COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper")


def base_failed() -> Column:
    return (F.col("__n_words") < 50) | (100 * F.col("__n_repeat_words") > 50 * F.col("__n_words"))


def _log_gamma(x: Column) -> Column:
    """log of the gamma function for x of 1 or more: Stirling's series eight steps up, and back down; exact to double precision."""
    z = x + 8
    series = 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * z * z * z * z * z)
    up = (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + series
    return up - functools.reduce(lambda a, k: a + F.log(x + k), range(1, 8), F.log(x))


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p) and k below n * p.

    The terms are summed from k down, each from the one before; 12 standard deviations further down they are no longer seen in a double.
    """
    x, m = k.cast("double"), n.cast("double")
    top = _log_gamma(m + 1) - _log_gamma(x + 1) - _log_gamma(m - x + 1) + x * math.log(p) + (m - x) * math.log1p(-p)
    steps = F.least(k, F.ceil(12 * F.sqrt(m * p) + 50)).cast("int")
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))

    def down(acc: Column, i: Column) -> Column:
        at = x - i
        term = acc["term"] * at / (m - at + 1) * ((1 - p) / p)
        return F.struct(term.alias("term"), (acc["sum"] + term).alias("sum"))

    total = F.aggregate(F.when(steps > 0, F.sequence(F.lit(0), steps - 1)).otherwise(F.array().cast("array<int>")), start, down)["sum"]
    return F.exp(top) * total


def measure(rule: str) -> Column:
    text = MEASURES[rule]
    for c in sorted(COUNTS, key=len, reverse=True):
        text = text.replace(f"{c} ", f"__{c} ").replace(f"{c},", f"__{c},")
    return F.expr(text)


def stratum(lang: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), lang.cast("string")), F.lit("null"))


def learn_cutoffs(counted: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", lang_col: str = "lang", label_col: str = "quality", risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """(stratum, a cutoff or null for each rule) of the strata that have any; `counted` has the columns of `measured`.

    Rows that fail the base rule teach nothing.
    """
    rules = list(MEASURES)
    marked = labels.where(F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("__id")).agg(F.min(label_col).alias("y"))
    rows = counted.where(~base_failed()).join(marked, F.col(id_col) == F.col("__id"))
    grid = F.array(*map(F.lit, GRID))
    below = lambda value: F.size(F.filter(grid, lambda g: value > g))
    above = [below(measure(r)).alias(f"a{j}") for j, r in enumerate(rules)]
    chooses = (crc_fold(F.col("__id"), 3) == 0).alias("chooses")
    # Everything below works on these counts: rows of a stratum, label and half with the same cutoffs exceeded.
    alike = rows.select(stratum(F.col(lang_col)).alias("own"), "y", chooses, *above).groupBy("own", "y", "chooses", *(f"a{j}" for j in range(len(rules)))).agg(F.count("*").alias("n"))
    alike = checkpointed(alike.select(F.explode(F.array("own", F.lit(ALL))).alias("stratum"), "y", "chooses", *(f"a{j}" for j in range(len(rules))), "n"))

    over = lambda test, k: F.sum(F.when(test & (F.col("above") > k), F.col("n")).otherwise(0))
    all_of = lambda test: F.sum(F.when(test, F.col("n")).otherwise(0))
    bad, good = (F.col("y") == 0) & F.col("chooses"), (F.col("y") == 1) & F.col("chooses")
    each = alike.select("stratum", "y", "chooses", "n", F.inline(F.array(*(F.struct(F.lit(j).alias("rule"), F.col(f"a{j}").alias("above")) for j in range(len(rules))))))
    per_rule = each.groupBy("stratum", "rule").agg(
        all_of(bad).alias("n_bad"), all_of(good).alias("n_good"), all_of(F.col("y") == 1).alias("total"),
        *(F.array(*(over(test, k) for k in range(len(GRID)))).alias(c) for c, test in (("bad", bad), ("good", good), ("gone", F.col("y") == 1))),
    )
    share = lambda c, k, n: F.get(c, k) / F.greatest(F.lit(1), n)
    gain = lambda k: share(F.col("bad"), k, F.col("n_bad")) - GOOD_WEIGHT * share(F.col("good"), k, F.col("n_good"))
    options = F.transform(F.sequence(F.lit(0), F.lit(len(GRID) - 1)), lambda k: F.when((F.get("good", k) <= risk * F.col("n_good")) & (gain(k) > 0), F.struct(gain(k).alias("gain"), k.alias("k"))))
    per_rule = per_rule.withColumn("best", F.array_max(F.filter(options, lambda o: o.isNotNull())))  # the more lenient of equal gains
    listed = F.array_sort(F.collect_list(F.when(F.col("best").isNotNull(), F.struct((-F.col("best.gain")).alias("loss"), "rule", F.col("best.k").alias("k")))))
    chosen = checkpointed(per_rule.groupBy("stratum").agg(listed.alias("own"), F.array_sort(F.collect_list(F.struct("rule", "gone", "total"))).alias("rules")))
    strata = max(1, chosen.count())
    found = chosen.where(F.col("stratum") == ALL).first()
    common = F.array(*(F.struct(F.lit(x["loss"]).alias("loss"), F.lit(x["rule"]).alias("rule"), F.lit(x["k"]).alias("k")) for x in found["own"])) if found and found["own"] else F.filter("own", lambda x: F.lit(False))
    # A stratum's list: its own choices, the best first, then those of all languages for the other rules.
    chosen = chosen.withColumn("list", F.concat("own", F.filter(common, lambda x: ~F.exists("own", lambda y: y["rule"] == x["rule"]))))

    # Of the good rows that test, how many the first rules of the list reject together.
    tests = alike.where("y = 1 and not chooses").join(chosen.select("stratum", "list"), "stratum")
    exceeded = F.array(*(F.col(f"a{j}") for j in range(len(rules))))
    by_first = lambda j: F.exists(F.slice("list", 1, j), lambda x: F.get(exceeded, x["rule"]) > x["k"])
    together = tests.groupBy("stratum").agg(F.sum("n").alias("tested"), F.array(*(F.sum(F.when(by_first(j), F.col("n")).otherwise(0)) for j in range(1, len(rules) + 1))).alias("rejected"))
    n, gone = F.col("tested"), lambda j: F.get("rejected", F.lit(j))
    held = [(F.size("list") > j) & (gone(j) < risk * n) & F.when(gone(j) < risk * n, binomial_tail(gone(j), n, risk) <= delta / strata).otherwise(False) for j in range(len(rules))]
    held = F.array(*(F.coalesce(x, F.lit(False)) for x in held))
    passed = F.coalesce(F.nullif(F.array_position(held, F.lit(False)), F.lit(0)), F.lit(len(rules) + 1)).cast("int") - 1  # the first failure ends the list
    level = delta / (strata * len(rules) * len(GRID))
    ready = together.join(chosen, "stratum").withColumn("passed", passed).where("passed > 0")
    ready = ready.select("stratum", "rules", F.inline(F.slice("list", F.lit(1), F.col("passed")))).withColumn("r", F.get("rules", F.col("rule")))
    ready = ready.select("stratum", "rule", F.explode(F.sequence(F.col("k"), F.lit(len(GRID) - 1))).alias("k"), "r.gone", "r.total").withColumn("lost", F.get("gone", F.col("k")))
    safe = ready.where((F.col("lost") < risk * F.col("total")) & F.when(F.col("lost") < risk * F.col("total"), binomial_tail(F.col("lost"), F.col("total"), risk) <= level).otherwise(False))
    cut = safe.groupBy("stratum", "rule").agg(F.get(grid, F.min("k")).alias("cut"))
    return checkpointed(cut.groupBy("stratum").agg(*(F.max(F.when(F.col("rule") == j, F.col("cut"))).alias(r) for j, r in enumerate(rules))))


def judged(counted: DataFrame, cutoffs: DataFrame, lang_col: str = "lang") -> DataFrame:
    """counted with __kept: whether a measured row passes the base rule and every cutoff of its stratum."""
    table = cutoffs.where(F.col("stratum") != ALL).select(F.col("stratum").alias("__stratum"), *(F.col(r).alias(f"__cut_{r}") for r in MEASURES))
    if table.count() <= BROADCAST_STRATA:
        table = F.broadcast(table)  # else Catalyst shuffles, and splits the partitions of common languages
    out = counted.join(table, stratum(F.col(lang_col)) == F.col("__stratum"), "left")
    fails = functools.reduce(lambda a, b: a | b, (F.coalesce(measure(r) > F.col(f"__cut_{r}"), F.lit(False)) for r in MEASURES))
    # One comparison of both parts: a filter on it needs both sides of the join, and so is never pushed below the measures, which it would repeat.
    return out.withColumn("__kept", F.greatest(base_failed().cast("int"), fails.cast("int")) == 0).drop("__stratum", *(f"__cut_{r}" for r in MEASURES))


def quality_rules(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, counts..., base_failed, kept) of every row."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("__text"))
    counted = checkpointed(measured(slim, F.col("__text")).drop("__text"))
    cutoffs = learn_cutoffs(counted, labels.select(F.col(id_col).alias("doc_id"), "quality"))
    return judged(counted, cutoffs).select("doc_id", *(F.col(f"__{c}").alias(c) for c in COUNTS), base_failed().alias("base_failed"), F.col("__kept").alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of docs that pass, with their columns, whatever these are called.

    The labelled rows are measured for the cutoffs, and all rows once more as they are filtered; texts are not written in between.
    """
    own = [F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("__text")]
    marked = labels.where(F.col("quality").isin(0, 1)).select(F.col(id_col).alias("doc_id"), "quality")
    taught = docs.select(*own).join(marked.select("doc_id").distinct(), "doc_id", "left_semi")
    cutoffs = learn_cutoffs(checkpointed(measured(taught, F.col("__text")).drop("__text")), marked)
    rows = measured(docs.select(F.struct(*docs.columns).alias("row"), *own), F.col("__text"))
    return judged(rows, cutoffs).where("__kept").select("row.*")
