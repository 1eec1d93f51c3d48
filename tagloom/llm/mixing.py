"""Mixing sources to target weights by systematic sampling.

Each source has a target in words (see `source_targets`). A document's expected number of copies is its source's
target divided by its source's size. Within a source the expected copies are summed in a fixed order, one random
offset is added, and a document is emitted once for each integer that its step crosses. The order goes by
size, so what a source takes stays near its target.

The order is (size class, hash bucket, doc_id, size, text hash). A document's place in it is the number of rows in earlier
(class, bucket) groups of its source, from a table of counts, plus its place in its own group. A source has BUCKETS groups
for each size class, so none is gathered in one task; running sums go over a source's classes and a class's buckets. Texts are
shuffled once, by group, for the join with the counts and the places alike. Nothing is random at run time: reruns agree.

Null texts have size 0. A null source is a source of its own, the last one. Rows with equal doc_id are rows of their own;
only wholly equal rows are interchangeable. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.common import WORD, checkpointed

#: Weights of the sources by rank (repeating), how often a source may be repeated, hash buckets of a size class.
WEIGHTS, MOST, BUCKETS = (5, 2, 1), 3, 4096


def source_targets(sizes: DataFrame) -> DataFrame:
    """From (source, source_size): the target of each source.

    All sizes are shared by weight; a target stops at MOST times its source's size and the excess goes to the
    others by weight. The stopped sources are the first in the order of limit / weight, so two running sums replace
    the iteration.
    """
    by_name, all_rows = Window.orderBy(F.col("source").asc_nulls_last()), Window.partitionBy()
    w = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.row_number().over(by_name) - 1) % len(WEIGHTS) + 1).cast("int")).cast("long")
    t = sizes.withColumn("w", w).withColumn("limit_", F.col("source_size") * MOST)
    by_ratio = Window.orderBy(F.col("limit_") / F.col("w"), F.col("source").asc_nulls_last())
    before, after = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    t = t.withColumn("total", F.sum("source_size").over(all_rows))
    wide = lambda c: F.col(c).cast("decimal(38,0)") if isinstance(c, str) else c.cast("decimal(38,0)")
    rest = wide(F.col("total") - F.coalesce(F.sum("limit_").over(before), F.lit(0)))
    t = t.withColumn("stopped", wide("limit_") * wide(F.sum("w").over(after)) <= wide("w") * rest)
    taken, open_w = F.sum(F.when(F.col("stopped"), F.col("limit_")).otherwise(0)).over(all_rows), F.sum(F.when(F.col("stopped"), 0).otherwise(F.col("w"))).over(all_rows)
    level = (F.col("total") - taken).cast("double") / F.nullif(open_w, F.lit(0)).cast("double")
    return t.select("source", "source_size", F.when(F.col("stopped"), F.col("limit_").cast("double")).otherwise(F.col("w") * level).alias("target"))


def size_class(size: Column) -> Column:
    """Sizes that share their five leading binary digits."""
    shift = F.greatest(F.length(F.bin(size)) - 5, F.lit(0))
    return F.call_function("shiftright", size, shift) + 32 * shift.cast("long")


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 0, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, *keep) of every row; copies is how often the mix has it."""
    text = F.col(text_col).cast("string")
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"), F.xxhash64(text).alias("__h"), *(F.col(k) for k in keep if k not in (id_col, source_col)))
    bucket = F.pmod(_hex(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), 8), F.lit(BUCKETS))
    return _placed(base.withColumns({"__class": size_class(F.col("size")), "__b": bucket}), seed)


def _placed(base: DataFrame, seed: int) -> DataFrame:
    # Plain equality on these keys serves the join and the window with one exchange; nulls are a source of their own.
    keys = ["__name", "__null", "__class", "__b"]
    base = base.withColumns({"__name": F.coalesce(F.col("source").cast("string"), F.lit("")), "__null": F.col("source").isNull()})
    counts = checkpointed(base.groupBy("source", *keys).agg(F.count("*").alias("n"), F.sum("size").alias("s")))
    targets = source_targets(counts.groupBy("source").agg(F.sum("s").alias("source_size")))
    offset = _hex(F.concat(F.lit(f"{seed}:"), F.coalesce("source", F.lit(""))), 4) / 65536
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    targets = targets.select(F.coalesce("source", F.lit("")).alias("__name"), F.col("source").isNull().alias("__null"), "source_size", "target", offset.alias("__u"), rate.alias("__rate"))
    # Rows in earlier size classes, a row for each class; and in earlier buckets of the class, at most BUCKETS rows in a task.
    earlier = lambda c, *w: F.coalesce(F.sum(c).over(Window.partitionBy(*w[:-1]).orderBy(w[-1]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    classes = counts.groupBy("__name", "__null", "__class").agg(F.sum("n").alias("n"))
    classes = classes.select("__name", "__null", "__class", earlier("n", "__name", "__null", "__class").alias("__lower")).join(targets, ["__name", "__null"])
    groups = counts.select(*keys, earlier("n", *keys).alias("__in")).join(classes, ["__name", "__null", "__class"]).withColumn("__before", F.col("__lower") + F.col("__in")).drop("__lower", "__in")
    place = F.col("__before") + F.row_number().over(Window.partitionBy(*keys).orderBy("doc_id", "size", "__h"))
    placed = base.join(groups, keys).withColumn("__place", place)
    steps = lambda k: F.floor(F.col("__u") + F.col("__rate") * k)
    copies = F.least(steps(F.col("__place")) - steps(F.col("__place") - 1), F.lit(MOST)).cast("long")
    return placed.withColumn("copies", copies).drop(*keys, "__h", "__before", "__place", "__u", "__rate")


def _hex(c: Column, digits: int) -> Column:
    return F.conv(F.substring(F.md5(c), 1, digits), 16, 10).cast("long")


def mixed_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 0) -> DataFrame:
    """The rows of docs, each as often as the mix has it; columns as in docs."""
    names = {c: f"__c{k}" for k, c in enumerate(docs.columns)}
    renamed = docs.select(*(F.col(c).alias(n) for c, n in names.items()))
    out = mix(renamed, id_col=names[id_col], text_col=names[text_col], source_col=names[source_col], seed=seed, keep=tuple(names.values()))
    out = out.withColumns({names[id_col]: F.col("doc_id"), names[source_col]: F.col("source")}).where("copies > 0")
    return out.withColumn("__i", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*(F.col(n).alias(c) for c, n in names.items()))
