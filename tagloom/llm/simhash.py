"""Document fingerprints by SimHash, in DataFrame operations only.

Terms are the five-word shingles of a text (all its words as one term if it has fewer, nothing if it has none), weighted
by their counts. Each term's 64-bit hash votes on the 64 bits; a bit is set if more than half of the weight
votes for it. Two votes are counted at once in the halves of a long, so 32 sums make a fingerprint; the sums are
combined on the map side and no text takes part in a shuffle for them.

`within_radius` finds all fingerprints within a Hamming radius: bits are cut into blocks, and for each choice of
blocks that must agree if at most `radius` of them differ there is a table keyed by those blocks' bits. Equal
fingerprints are looked up once.

The next document comes from ranges of doc_id (cut points by quantiles; rows without an id by their text's hash), sorted
one by one; only the first row of each range is looked up apart. Null texts are empty. Null doc_ids come last in the descending order;
rows with equal doc_id are ordered by a hash of their text. One row alone is its own next document.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.common import checkpointed, words

SHINGLE, RADIUS, BLOCKS = 5, 3, 5
#: Rows of a range of doc_ids, and the most ranges.
RANGE, RANGES = 2000, 10_000
_LANES = 0x0000000100000001


def term_hashes(text: Column) -> Column:
    """Hashes of a text's terms; one null for none, so that every text keeps a row when exploded."""
    h = F.transform(words(text), lambda w: F.xxhash64(w))
    # Bound once through a one-element array: the hashes are read five times for each term.
    gather = lambda a: F.transform(F.sequence(F.lit(0), F.size(a) - SHINGLE), lambda i: F.xxhash64(*(F.get(a, i + k) for k in range(SHINGLE))))
    few = lambda a: F.when(F.size(a) == 0, F.array(F.lit(None).cast("long"))).otherwise(F.array(F.xxhash64(a)))
    return F.transform(F.array(h), lambda a: F.when(F.size(a) >= SHINGLE, gather(a)).otherwise(few(a)))[0]


def _votes(term: Column) -> list[Column]:
    return [F.sum(F.shiftrightunsigned(term, k).bitwiseAND(F.lit(_LANES))) for k in range(32)]


def _bits(sums: list[Column], n: Column) -> Column:
    """The fingerprint from the vote sums: bit k from the low half of sum k, bit k + 32 from the high half."""
    out = F.lit(0).cast("long")
    for k, s in enumerate(sums):
        low, high = s.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(s, 32)
        out = out.bitwiseOR(F.when(2 * low > n, F.lit(1 << k)).otherwise(F.lit(0)).cast("long"))
        out = out.bitwiseOR(F.when(2 * high > n, F.lit((1 << (k + 32)) - (1 << 64 if k == 31 else 0))).otherwise(F.lit(0)).cast("long"))
    return out


def fingerprints(df: DataFrame, keys: list[str], terms: str, bits: str) -> DataFrame:
    """(keys, bits): keys must tell rows apart; `terms` is an array of term hashes."""
    votes = df.select(*keys, F.explode(terms).alias("__t"))
    summed = votes.groupBy(*keys).agg(F.count("__t").alias("__n"), *(v.alias(f"__s{k}") for k, v in enumerate(_votes(F.col("__t")))))
    return summed.select(*keys, F.when(F.col("__n") == 0, F.lit(0).cast("long")).otherwise(_bits([F.col(f"__s{k}") for k in range(32)], F.col("__n"))).alias(bits))


def hex64(bits: Column) -> Column:
    return F.lower(F.lpad(F.hex(bits), 16, "0"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / 64


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, __th) with next_id, next_text, next_th: the next row in descending doc_id, after the last the first."""
    stats = docs.agg(F.count("*").alias("n"), F.count_if(F.col("doc_id").isNull()).alias("nulls")).first()
    ranges = max(1, min(RANGES, stats["n"] // RANGE))
    null_ranges = max(1, min(RANGES, stats["nulls"] // RANGE))
    cuts = docs.agg(F.percentile_approx("doc_id", [k / ranges for k in range(1, ranges)] or [0.5], 20_000).alias("c")).first()["c"] or []
    cuts = sorted({c for c in cuts if c is not None})
    spots = F.array(*map(F.lit, cuts)).cast("array<bigint>") if cuts else F.array().cast("array<bigint>")
    # Ranges from 0 down hold the nulls by their texts' hashes, the others the ids from one cut point to the next.
    part = F.least(F.floor((F.col("__th") / 2.0**64 + 0.5) * null_ranges), F.lit(null_ranges - 1)).cast("int")
    docs = docs.withColumn("__r", F.when(F.col("doc_id").isNull(), -part).otherwise(_position(spots, F.col("doc_id"), len(cuts)) + 1))
    inner = Window.partitionBy("__r").orderBy(F.col("doc_id").desc_nulls_last(), "__th")
    lead = docs.select("*", *(F.lead(c).over(inner).alias(n) for c, n in (("doc_id", "next_id"), ("text", "next_text"), ("__th", "next_th"))), F.lead(F.lit(True)).over(inner).alias("__more"))
    done = lead.where("__more").drop("__more")
    # The last row of each range is followed by the first of the next range below that has rows. Those rows, one or two
    # of each range (RANGES at most), are found by their ids and fetched by a broadcast of these.
    spot = F.struct("doc_id", "__th")
    low = F.struct(F.coalesce("doc_id", F.lit(-(2**63))).alias("k"), (-F.col("__th").cast("decimal(20,0)")).alias("t"))
    bounds = docs.groupBy("__r").agg(F.max_by(spot, low).alias("first"), F.min_by(spot, low).alias("last"))
    order = Window.orderBy(F.col("__r").desc())
    bounds = checkpointed(bounds.withColumns({"to": F.coalesce(F.lead("first").over(order), F.max_by("first", "__r").over(Window.partitionBy()))}))
    fetched = lambda c: docs.join(F.broadcast(bounds.select(F.col(f"{c}.doc_id").alias("i"), F.col(f"{c}.__th").alias("h"), "__r", "to").withColumnRenamed("__r", "r")), F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("__th") == F.col("h")))
    ends = fetched("last").dropDuplicates(["r"]).select("doc_id", "text", "__th", "to")
    firsts = fetched("first").dropDuplicates(["r"]).select(F.struct("doc_id", "__th").alias("to"), F.col("text").alias("next_text"))
    ends = ends.join(firsts, "to").select("doc_id", "text", "__th", F.col("to.doc_id").alias("next_id"), "next_text", F.col("to.__th").alias("next_th"))
    return done.drop("__r").unionByName(ends)


def _position(sorted_values: Column, value: Column, n: int) -> Column:
    """How many of the sorted values are not above the value, by binary search."""
    low = F.lit(0)
    step = 1 << max(0, n.bit_length() - 1)
    while step:
        low = F.transform(F.array(low), _stride(sorted_values, value, n, step))[0]
        step >>= 1
    return low


def _stride(sorted_values: Column, value: Column, n: int, step: int) -> Callable[[Column], Column]:
    return lambda a: F.when((a + step <= n) & (F.get(sorted_values, a + (step - 1)) <= value), a + step).otherwise(a)


def edited_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, __own, __th, next_id, next_th, __edited): the last third replaced by the next document's beginning."""
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    base = with_next(base.withColumn("__th", F.xxhash64("text")))
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    base = base.withColumn("edited", F.concat(F.substring("text", F.lit(1), n - third), F.substring("next_text", F.lit(1), third)))
    return base.select("doc_id", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), "__th", "next_id", "next_th", F.array(F.struct(F.lit(0).alias("v"), term_hashes(F.col("text")).alias("t")), F.struct(F.lit(1).alias("v"), term_hashes(F.col("edited")).alias("t"))).alias("__both"))


def simhash_edited(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_within) of every row.

    n_within: for the rows whose doc_id is divisible by 100, how many other rows have a fingerprint within the radius.
    """
    keys = ["doc_id", "n_chars", "edited_sha256", "__th", "next_id", "next_th"]
    votes = edited_documents(docs, id_col=id_col, text_col=text_col).select(*keys, F.inline("__both"))
    # Wholly equal rows share a key: they are counted by their first terms and given back at the end.
    votes = votes.select(*keys, "v", F.posexplode("t").alias("p", "t"))
    one = votes.groupBy(*keys, "v").agg(F.count("t").alias("__n"), F.count_if(F.col("p") == 0).alias("__rows"), *(s.alias(f"__s{k}") for k, s in enumerate(_votes(F.col("t")))))
    bits = F.when(F.col("__n") == 0, F.lit(0).cast("long")).otherwise(_bits([F.col(f"__s{k}") for k in range(32)], F.col("__n")))
    both = one.select(*keys, "v", "__rows", bits.alias("b")).groupBy(*keys).agg(F.max("__rows").alias("__rows"), F.max(F.when(F.col("v") == 0, F.col("b"))).alias("own"), F.max(F.when(F.col("v") == 1, F.col("b"))).alias("edited"))
    both = checkpointed(both)
    other = both.groupBy(F.col("doc_id").alias("next_id_"), F.col("__th").alias("next_th_")).agg(F.first("own").alias("next"))
    out = both.join(other, both["next_id"].eqNullSafe(other["next_id_"]) & (both["next_th"] == other["next_th_"]), "left")
    near = within_radius(both, radius)
    out = out.join(near, "own", "left")
    out = out.withColumn("__i", F.explode(F.sequence(F.lit(1), F.col("__rows"))))
    count = F.when(F.col("doc_id") % 100 == 0, F.col("n_rows") - 1)
    return out.select("doc_id", "n_chars", "edited_sha256", hex64(F.col("own")).alias("fingerprint"), hex64(F.col("edited")).alias("edited_fingerprint"), likeness(F.col("own"), F.col("edited")).alias("near_edited"), likeness(F.col("own"), F.col("next")).alias("near_next"), count.alias("n_within"))


def near_pairs(rows: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, queries: Column | None = None) -> DataFrame:
    """(own, found, distance, w): for each queried fingerprint every fingerprint within the radius, itself included, with the
    rows that have it.

    rows: own (fingerprint), doc_id, __rows (how many rows this one stands for). By default the query set is every
    doc_id divisible by 100. A pair within the radius agrees on some choice of blocks; it comes from the first
    choice it agrees on, so pairs need not be made distinct.
    """
    if radius >= blocks:
        raise ValueError("more blocks than the radius are needed")
    weight = rows.groupBy("own").agg(F.sum("__rows").alias("w"), F.max(queries if queries is not None else F.coalesce(F.col("doc_id") % 100 == 0, F.lit(False))).alias("q"))
    edges = [64 * k // blocks for k in range(blocks + 1)]
    masks = []
    for choice in combinations(range(blocks), blocks - radius):
        m = sum(((1 << (edges[c + 1] - edges[c])) - 1) << edges[c] for c in choice)
        masks.append(m - (1 << 64) if m >= 1 << 63 else m)
    table = F.explode(F.array(*(F.struct(F.lit(k).alias("k"), F.col("own").bitwiseAND(F.lit(m)).alias("key")) for k, m in enumerate(masks))))
    keyed = weight.select("own", "w", "q", table.alias("t")).select("own", "w", "q", "t.k", "t.key")
    left = keyed.where("q").select("k", "key", F.col("own").alias("a"))
    right = keyed.select("k", "key", F.col("own").alias("b"), "w")
    x = F.col("a").bitwiseXOR(F.col("b"))
    first = F.coalesce(*(F.when(x.bitwiseAND(F.lit(m)) == 0, F.lit(k)) for k, m in enumerate(masks)))
    hits = left.join(right, ["k", "key"]).where((F.bit_count(x) <= radius) & (first == F.col("k")))
    return hits.select(F.col("a").alias("own"), F.col("b").alias("found"), F.bit_count(x).alias("distance"), "w")


def within_radius(rows: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, queries: Column | None = None) -> DataFrame:
    """(own, n_rows): for each queried fingerprint, the rows within the radius, itself included."""
    return near_pairs(rows, radius, blocks, queries).groupBy("own").agg(F.sum("w").alias("n_rows"))


def near_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> tuple[DataFrame, DataFrame]:
    """Near documents as pairs of fingerprints and membership, so that copies are not expanded into all pairs.

    (fingerprint, found, distance) for the fingerprints of rows whose doc_id is divisible by 100, against all; and
    (doc_id, fingerprint) of every row. Joined on `found`, the second gives the documents. Repeated rows are members each.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    keyed = rows.select("doc_id", F.xxhash64("text").alias("__th"), term_hashes(F.col("text")).alias("__t"))
    votes = keyed.select("doc_id", "__th", F.posexplode("__t").alias("p", "t"))
    one = votes.groupBy("doc_id", "__th").agg(F.count("t").alias("__n"), F.count_if(F.col("p") == 0).alias("__rows"), *(s.alias(f"__s{k}") for k, s in enumerate(_votes(F.col("t")))))
    bits = F.when(F.col("__n") == 0, F.lit(0).cast("long")).otherwise(_bits([F.col(f"__s{k}") for k in range(32)], F.col("__n")))
    own = checkpointed(one.select("doc_id", "__rows", bits.alias("own")))
    pairs = near_pairs(own, radius).select(hex64(F.col("own")).alias("fingerprint"), hex64(F.col("found")).alias("found"), "distance")
    members = own.withColumn("__i", F.explode(F.sequence(F.lit(1), F.col("__rows")))).select("doc_id", hex64(F.col("own")).alias("fingerprint"))
    return pairs, members
