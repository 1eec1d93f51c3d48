"""N-gram Jaccard join over prefix trees.

Shingle sets are ordered globally, rare shingles first. Two sets whose Jaccard similarity reaches the
threshold share a shingle of their prefixes, so sets that share none never meet. The sets that do meet
are put into a trie; one walk carries the overlaps of all sets at once along shared beginnings and
leaves a subtree when the lengths that remain cannot reach the threshold.

How it scales: sets of equal content become one class. Shingles travel as packed arrays, hot shingles
(found by counts within tasks, a list of bounded length) are held back from that exchange. Shingles of
one class alone take part in nothing after their count. A hot component is split by length, since linked sets are of
nearly one length, and each length class into blocks by the sets' smallest shingle, which near copies mostly share. Two
blocks of one class or of neighbouring ones are a task if a prefix shingle occurs in both; others never meet. Nothing
emits pairs of sets: a task returns link counts and a spanning forest.

Nulls, empty texts and texts without words have an empty set and link with nothing. Repeated rows are
rows of one class each. doc_id may be null (then component_id is null unless another member has one).
Other columns of the input are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.common import MIX, block_rows, bucket_count, checkpointed, connected_components, pack, packed_exchange, slices, starts, table_fn, unpack

#: Shingles in a flush, words kept in the hash cache, length of the list of hot shingles, and the
#: share of a flush's sets that makes a shingle a candidate for that list.
FLUSH, CACHE, HOT_LIST, HOT_SHARE = 800_000, 300_000, 100_000, 0.004
#: Prefix shingles of a bucket in the search for sets that meet.
STAR_ENTRIES = 400_000
#: Sets and shingles of a block in the verification.
BLOCK_SETS, BLOCK_SHINGLES = 2048, 4_000_000


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHE:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def shingles(text: str | None, n: int, hashes: dict) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles of a text; A-Z in lower case."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(hashes.__getitem__, found), dtype=np.uint64, count=len(found))
    width = min(n, len(h))
    out = np.full(len(h) - width + 1, width, dtype=np.uint64)
    for k in range(width):
        out = (out ^ (out >> np.uint64(31))) * MIX[k % 5] + h[k : len(h) - width + 1 + k]
    out ^= out >> np.uint64(29)
    out *= MIX[0]
    return np.unique(out ^ (out >> np.uint64(32)))


def _signature(s: np.ndarray) -> int:
    return int(np.frombuffer(xxhash.xxh64_digest(s.tobytes()), np.int64)[0]) if len(s) else 0


def _sets(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[list, list[np.ndarray], pa.Array]]:
    hashes = _Hashes()
    for b in slices(batches):
        yield b.column(0).to_pylist(), [shingles(t, n, hashes) for t in b.column(1).to_pylist()], b.column(2)


def _sign(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """A row for each document and, with kind 1, a row for each locally hot shingle."""
    schema = pa.schema([("kind", pa.int8()), ("doc_id", pa.int64()), ("n", pa.int64()), ("sig", pa.int64()), ("text_hash", pa.int64())])

    def hot(held: list[np.ndarray]) -> pa.RecordBatch:
        tokens, counts = np.unique(np.concatenate(held), return_counts=True)
        tokens, counts = (x[counts >= max(16, HOT_SHARE * len(held))] for x in (tokens, counts))
        return pa.RecordBatch.from_arrays([pa.array(np.ones(len(tokens), np.int8)), pa.nulls(len(tokens), pa.int64()), pa.array(counts.astype(np.int64)), pa.array(tokens.view(np.int64)), pa.nulls(len(tokens), pa.int64())], schema=schema)

    held, size, seen = [], 0, set()
    for ids, sets, hashes in _sets(batches, n):
        sigs = [_signature(s) for s in sets]
        yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(ids), np.int8)), pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(sigs, pa.int64()), hashes], schema=schema)
        for sig, s in zip(sigs, sets, strict=True):
            if len(s) and sig not in seen:
                seen.add(sig)
                held.append(s)
                size += len(s)
                if size >= FLUSH:
                    yield hot(held)
                    held, size, seen = [], 0, set()
    if held:
        yield hot(held)


def _by_set(key: np.ndarray, sig: np.ndarray, n: np.ndarray, *rest: np.ndarray) -> list[tuple[int, bytes]]:
    """Entries as (bucket, payload); a run of one set's entries shares its signature and length."""
    order = np.lexsort((sig, key))
    key, sig, n, rest = key[order], sig[order], n[order], [r[order] for r in rest]
    out, cuts = [], np.append(starts(key), len(key))
    for a, z in zip(cuts[:-1], cuts[1:], strict=True):
        s = starts(sig[a:z])
        out.append((int(key[a]), pack(sig[a:z][s], n[a:z][s], np.diff(np.append(s, z - a)).astype(np.uint32), *(r[a:z] for r in rest))))
    return out


def _spread(batches: Iterator[pa.RecordBatch], n: int, buckets: int, hot: np.ndarray, hot_df: np.ndarray) -> Iterator[pa.RecordBatch]:
    def flush() -> pa.RecordBatch:
        sig, size = np.array([x[0] for x in held], np.int64), np.array([len(x[1]) for x in held], np.uint32)
        tokens, at = np.concatenate([x[1] for x in held]), np.repeat(np.arange(len(held)), size)
        sig, size = sig[at], size[at]
        place = np.searchsorted(hot, tokens)
        is_hot = (place < len(hot)) & (hot[np.minimum(place, len(hot) - 1)] == tokens) if len(hot) else np.zeros(len(tokens), bool)
        cold = ~is_hot
        rows = [(b, b"\0" + p) for b, p in _by_set((tokens[cold] % np.uint64(buckets)).astype(np.int64), sig[cold], size[cold], tokens[cold])]
        if is_hot.any():  # these need no count: they go where their set's shingles meet
            rows += [(b, b"\1" + p) for b, p in _by_set(sig[is_hot].view(np.uint64).astype(np.uint64) % np.uint64(buckets), sig[is_hot], size[is_hot], tokens[is_hot], hot_df[place[is_hot]])]
        return block_rows(rows)

    held, total, seen = [], 0, set()
    for _, sets, _ in _sets(batches, n):
        for s in sets:
            if len(s) and (sig := _signature(s)) not in seen:
                seen.add(sig)
                held.append((sig, s))
                total += len(s)
                if total >= FLUSH:
                    yield flush()
                    held, total, seen = [], 0, set()
    if held:
        yield flush()


def _count(table: pa.Table, buckets: int) -> pa.Table:
    """Set counts of a bucket's shingles; those of two sets or more go on to their sets."""
    rows, parts = [], []
    for bucket, p in zip(table.column(0).to_pylist(), table.column(1).to_pylist(), strict=True):
        if p[0]:
            rows.append((bucket, p[1:]))
        else:
            sig, n, runs, tokens = unpack(p[1:], np.int64, np.uint32, np.uint32, np.uint64)
            parts.append((np.repeat(sig, runs), np.repeat(n, runs), tokens))
    if parts:
        sig, n, tokens = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((sig, tokens))
        sig, n, tokens = sig[order], n[order], tokens[order]
        once = starts(tokens, sig)
        sig, n, tokens = sig[once], n[once], tokens[once]
        runs = np.diff(np.append(starts(tokens), len(tokens)))
        df = np.repeat(runs, runs).astype(np.uint32)
        more = df > 1
        rows += _by_set((sig[more].view(np.uint64) % np.uint64(buckets)).astype(np.int64), sig[more], n[more], tokens[more], df[more])
    return pa.Table.from_batches([block_rows(rows)])


def _activate(table: pa.Table, percent: int) -> pa.Table:
    """The sets of a bucket whose prefix holds a shared shingle, with their shared shingles in global order."""
    parts = []
    for p in table.column(1).to_pylist():
        sig, n, runs, tokens, df = unpack(p, np.int64, np.uint32, np.uint32, np.uint64, np.uint32)
        parts.append((np.repeat(sig, runs), np.repeat(n, runs), tokens, df))
    out: list[tuple] = []
    if parts:
        sig, n, tokens, df = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((tokens, df, sig))
        sig, n, tokens, df = sig[order], n[order], tokens[order], df[order]
        once = starts(sig, tokens, df)
        sig, n, tokens, df = sig[once], n[once], tokens[once], df[once]
        cuts = np.append(starts(sig), len(sig))
        for a, z in zip(cuts[:-1], cuts[1:], strict=True):
            size = int(n[a])
            prefix = size - -(-percent * size // 100) + 1 - (size - (z - a))
            if prefix > 0:
                out.append((int(sig[a]), size, min(int(prefix), z - a), int(tokens[a:z].min().view(np.int64)), pack(tokens[a:z], df[a:z])))
    return pa.Table.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()))], ["sig", "n", "prefix", "mark", "shared"])


def _prefixes(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if not b.num_rows:
            continue
        sigs, heads = b.column(0).to_numpy(), [unpack(s, np.uint64, np.uint32)[0][:p] for p, s in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
        tokens, sig = np.concatenate(heads), np.repeat(sigs, [len(h) for h in heads])
        key = (tokens % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((sig, tokens, key))
        tokens, sig, key = tokens[order], sig[order], key[order]
        # Within the batch every set joins the first set of the shingle; only the first goes on.
        first = starts(tokens)
        lead = np.repeat(sig[first], np.diff(np.append(first, len(tokens))))
        u, v = _forest(sig[sig != lead], lead[sig != lead])
        home = u.view(np.uint64) % np.uint64(buckets)
        rows = [(int(k), pack(np.zeros(0, np.uint64), u[home == k], v[home == k])) for k in np.unique(home)]
        cuts = np.append(starts(key[first]), len(first))
        for a, z in zip(cuts[:-1], cuts[1:], strict=True):
            rows.append((int(key[first[a]]), pack(tokens[first[a:z]], sig[first[a:z]], np.zeros(0, np.int64))))
        yield block_rows(rows)


def _forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each node to the smallest one it is connected with; as many as nodes, whatever the number of edges."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b, label = at[: len(u)], at[len(u) :], np.arange(len(nodes))
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = new[new]
        if (new == label).all():
            break
        label = new
    low = label != np.arange(len(nodes))
    return nodes[low], nodes[label[low]]


def _stars(table: pa.Table) -> pa.Table:
    """A spanning forest of the sets that share a shingle of the bucket."""
    us, vs, tokens, sigs = [], [], [], []
    for p in table.column(1).to_pylist():
        t, u, v = unpack(p, np.uint64, np.int64, np.int64)
        if len(t):
            tokens.append(t)
            sigs.append(u)
        else:
            us.append(u)
            vs.append(v)
    if tokens:
        t, s = np.concatenate(tokens), np.concatenate(sigs)
        order = np.lexsort((s, t))
        t, s = t[order], s[order]
        first = starts(t)
        us.append(s)
        vs.append(np.repeat(s[first], np.diff(np.append(first, len(t)))))
    u, v = _forest(np.concatenate(us), np.concatenate(vs)) if us else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    return pa.Table.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])


def _holders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The blocks that hold each prefix shingle, once for a batch."""
    for b in slices(batches):
        heads = [unpack(s, np.uint64, np.uint32)[0][:p] for p, s in zip(b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True)]
        if not heads:
            continue
        runs = [len(h) for h in heads]
        comp, c, block = (np.repeat(b.column(k).to_numpy(), runs) for k in range(3))
        token = np.concatenate(heads).view(np.int64)
        order = np.lexsort((block, c, token, comp))
        once = order[starts(comp[order], token[order], c[order], block[order])]
        yield pa.RecordBatch.from_arrays([pa.array(x[once]) for x in (comp, token, c, block)], ["component", "token", "c", "b"])


def _meetings(hot: DataFrame) -> DataFrame:
    """(component, b, o): the blocks of hot components that can hold linked sets, both ways, a block and itself included.

    Linked sets share a prefix shingle and lie in one length class or in neighbouring ones. Shingles that occur in the
    same blocks are taken as one, so the pairs of blocks are listed once for each list of blocks and not for each shingle.
    """
    held = hot.select("component", "c", "b", "prefix", "shared").mapInArrow(_holders, "component long, token long, c long, b long").distinct()
    lists = held.groupBy("component", "token").agg(F.array_sort(F.collect_list(F.struct("c", "b"))).alias("all")).select("component", "all").distinct()
    each = lists.select("component", "all", F.explode("all").alias("one"))
    near = F.filter("all", lambda o: F.abs(o["c"] - F.col("one.c")) <= 1)
    return each.select("component", F.col("one.b").alias("b"), F.explode(F.transform(near, lambda o: o["b"])).alias("o")).distinct()


class _Trie:
    """Path-compressed trie of sorted rank arrays; node k has its edge's ranks, children and the sets that end there."""

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray) -> None:
        self.sets, self.sizes = sets, sizes
        self.order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u4").tobytes())

    def children(self, group: list[int], depth: int) -> Iterator[tuple[np.ndarray, list[int], list[int]]]:
        """From sets (in order) that agree up to depth: the edge, the sets that go on, the sets that end after it."""
        a = 0
        while a < len(group):
            head, z = self.sets[group[a]][depth], a + 1
            while z < len(group) and self.sets[group[z]][depth] == head:
                z += 1
            one, two = self.sets[group[a]][depth:], self.sets[group[z - 1]][depth:]
            m = min(len(one), len(two))  # first and last of an ordered group agree as far as all do
            differ = np.flatnonzero(one[:m] != two[:m])
            edge = one[: int(differ[0]) if len(differ) else m]
            end = depth + len(edge)
            yield edge, [i for i in group[a:z] if len(self.sets[i]) > end], [i for i in group[a:z] if len(self.sets[i]) == end]
            a = z


def trie_links(sets: list[np.ndarray], sizes: np.ndarray, queries: list[np.ndarray], q_sizes: np.ndarray, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """(i, the queries linked with set i) for the sets in the trie; ranks are positions in the global order."""
    universe = int(max([0, *(int(s[-1]) + 1 for s in (*sets, *queries) if len(s))]))
    flat, owner = np.concatenate([*queries, np.zeros(0, np.int64)]).astype(np.int64), np.repeat(np.arange(len(queries)), [len(q) for q in queries])
    by = np.argsort(flat, kind="stable")
    owner, offset = owner[by], np.searchsorted(flat[by], np.arange(universe + 1))
    lengths = np.array([len(q) for q in queries])
    trie = _Trie(sets, sizes)
    stack = [([i for i in trie.order if len(sets[i])], 0, np.zeros(len(queries), np.int64))]
    while stack:
        group, depth, overlap = stack.pop()
        for edge, on, ended in trie.children(group, depth):
            hits = [owner[offset[t] : offset[t + 1]] for t in edge]
            here = overlap + np.bincount(np.concatenate(hits), minlength=len(queries))
            for i in ended:
                yield i, np.flatnonzero((100 + percent) * here >= percent * (q_sizes + sizes[i]))
            if on:
                rest = max(len(sets[i]) for i in on) - depth - len(edge)
                least = min(int(sizes[i]) for i in on)
                if ((100 + percent) * (here + np.minimum(rest, lengths - here)) >= percent * (q_sizes + least)).any():
                    stack.append((on, depth + len(edge), here))


def _ranked(blobs: list[bytes]) -> list[np.ndarray]:
    pairs = [unpack(b, np.uint64, np.uint32) for b in blobs]
    t, d = np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])
    order = np.lexsort((t, d))
    rank = np.empty(len(t), np.int64)
    new = np.zeros(len(t), np.int64)
    new[starts(t[order], d[order])] = 1
    rank[order] = np.cumsum(new) - 1
    return np.split(rank, np.cumsum([len(p[0]) for p in pairs])[:-1])


def _verify(table: pa.Table, percent: int) -> pa.Table:
    """Of each (component, block, block) in the bin: the sets' linked documents, and a spanning forest."""
    comp, i, j, side, sig, n, mult = (table.column(c).to_numpy() for c in ("component", "i", "j", "side", "sig", "n", "mult"))
    blobs = table.column("shared").to_pylist()
    out_sig, out_root, out_links = [], [], []
    order = np.lexsort((sig, side, j, i, comp))
    cuts = np.append(starts(comp[order], i[order], j[order]), len(order))
    for a, z in zip(cuts[:-1], cuts[1:], strict=True):
        rows = order[a:z]
        ranks = _ranked([blobs[r] for r in rows])
        same = i[rows[0]] == j[rows[0]]
        left = np.arange(len(rows)) if same else np.flatnonzero(side[rows] == 0)
        right = left if same else np.flatnonzero(side[rows] == 1)
        root, links = np.arange(len(rows)), np.zeros(len(rows), np.int64)
        pick = lambda at: ([ranks[k] for k in at], n[rows[at]])
        if len(left) and len(right):
            for k, found in trie_links(*pick(left), *pick(right), percent):
                me, them = left[k], right[found]
                them = them[them != me]
                if not len(them):
                    continue
                links[me] += mult[rows[them]].sum()
                if not same:
                    links[them] += mult[rows[me]]
                joined = np.unique(root[np.append(them, me)])
                if len(joined) > 1:
                    root[np.isin(root, joined[1:])] = joined[0]
        out_sig.append(sig[rows])
        out_root.append(sig[rows][root])
        out_links.append(links)
    cat = lambda x: pa.array(np.concatenate(x) if x else np.zeros(0, np.int64))
    return pa.Table.from_arrays([cat(out_sig), cat(out_root), cat(out_links)], ["sig", "root", "links"])


def _dealt(slim: DataFrame) -> DataFrame:
    """(sig, component, n, mult, c, hot, b): sets of components that fit a task have block 0, the others one of bounded size."""
    blocks_of = lambda sets, b: F.greatest(F.ceil(F.sum(sets) / BLOCK_SETS), F.ceil(F.sum(b) / (12 * BLOCK_SHINGLES))).cast("long")
    per_class = slim.groupBy("component", "c").agg(F.count("*").alias("sets"), F.sum("bytes").alias("bytes"))
    hot = per_class.groupBy("component").agg(blocks_of("sets", "bytes").alias("all")).where("all > 1").select("component")
    classes = per_class.join(hot, "component").groupBy("component", "c").agg(blocks_of("sets", "bytes").alias("m"))
    near = slim.join(classes, ["component", "c"], "left").withColumn("near", F.pmod(F.xxhash64("mark"), "m")).drop("m")
    # Sets with one smallest shingle may be many: what is too much for a block is split by signature.
    parts = near.where("near is not null").groupBy("component", "c", "near").agg(blocks_of(F.lit(1), "bytes").alias("parts"))
    out = near.join(parts, ["component", "c", "near"], "left")
    block = F.when(F.col("parts").isNull(), F.lit(0).cast("long")).otherwise(F.xxhash64("c", "near", F.pmod(F.xxhash64("sig"), "parts")))
    return out.select("sig", "component", "n", "mult", "c", F.col("parts").isNotNull().alias("hot"), block.alias("b"))


def _linked(docs: DataFrame, id_col: str, text_col: str, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, sig, text_hash) of every row, and (sig, component, component_id, n_links) of every set but the empty one."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn("text_hash", F.xxhash64("text"))
    buckets = bucket_count(docs)
    signed = checkpointed(docs.mapInArrow(functools.partial(_sign, n=n), "kind tinyint, doc_id long, n long, sig long, text_hash long"))
    rows = signed.where("kind = 0").select("doc_id", "n", "sig", "text_hash")
    listed = signed.where("kind = 1").groupBy("sig").agg(F.sum("n").alias("c")).orderBy(F.desc("c"), "sig").limit(HOT_LIST).collect()
    listed = sorted((np.int64(r["sig"]).astype(np.uint64), min(r["c"], 2**32 - 1)) for r in listed)
    hot, hot_df = np.array([x[0] for x in listed], np.uint64), np.array([max(2, x[1]) for x in listed], np.uint32)

    shared = packed_exchange(docs, functools.partial(_spread, n=n, buckets=buckets, hot=hot, hot_df=hot_df), table_fn(_count, buckets=buckets), "bucket int, payload binary")
    active = checkpointed(shared.groupBy("bucket").applyInArrow(table_fn(_activate, percent=percent), "sig long, n long, prefix int, mark long, shared binary"))
    # Few large buckets: each returns an edge for a set at most, so edges stay in proportion to the sets.
    few = (active.agg(F.sum("prefix").alias("p")).first()["p"] or 0) // STAR_ENTRIES + 1
    stars = packed_exchange(active.select("sig", "prefix", "shared"), functools.partial(_prefixes, buckets=few), table_fn(_stars), "u long, v long")
    comps = connected_components(stars.distinct())

    classes = rows.where("n > 0").groupBy("sig").agg(F.first("n").alias("size"), F.min("doc_id").alias("rep"), F.count("*").alias("mult"))
    slim = active.select("sig", "n", "mark", F.length("shared").alias("bytes")).join(comps.withColumnRenamed("node", "sig"), "sig").join(classes.select("sig", "mult"), "sig")
    # Two linked sets' lengths differ by a factor of 100 / percent at most, so their classes are the same or neighbours.
    width = math.log(100 / percent) * 1.02 + 1e-6
    slim = checkpointed(slim.withColumn("c", F.floor(F.log("n") / width)))
    total = slim.agg(F.sum(F.col("bytes") / 12).alias("s")).first()["s"] or 0
    bins = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / (BLOCK_SHINGLES / 4)))
    member = checkpointed(active.drop("n", "mark").join(_dealt(slim), "sig"))
    hot = member.where("hot")
    blocks = member.where("not hot").withColumn("o", F.col("b")).unionByName(hot.join(_meetings(hot), ["component", "b"]))
    blocks = blocks.select("component", F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j"), F.when(F.col("b") <= F.col("o"), 0).otherwise(1).cast("long").alias("side"), "sig", "n", "mult", "shared")
    blocks = blocks.withColumn("bin", F.pmod(F.xxhash64("component", "i", "j"), F.lit(bins)).cast("int"))
    links = checkpointed(blocks.groupBy("bin").applyInArrow(table_fn(_verify, percent=percent), "sig long, root long, links long"))
    final = connected_components(links.select(F.col("sig").alias("u"), F.col("root").alias("v")).where("u != v").distinct()).withColumnRenamed("node", "sig")

    counted = links.groupBy("sig").agg(F.sum("links").alias("links"))
    named = classes.join(final, "sig", "left").join(counted, "sig", "left").withColumn("component", F.coalesce("component", "sig"))
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    return rows, named.join(least, "component").select("sig", "component", "component_id", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links"))


def ngram_jaccard_join(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 75) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) for every row: set size, smallest id reachable by links, linked rows.

    Two rows link when 100 * |intersection| >= percent * |union|; no link is lost and none is approximate
    (64-bit hashes stand for shingles and sets).
    """
    rows, named = _linked(docs, id_col, text_col, n, percent)
    full = rows.where("n > 0").join(named, "sig").select("doc_id", F.col("n").alias("n_shingles"), "component_id", "n_links")
    empty = rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links"))
    return full.unionByName(empty)


def one_of_each(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 75) -> DataFrame:
    """The rows of docs without near copies: of the rows of a component, one stays.

    It is the first in the order of id (nulls last), hash of the text and hash of all columns; rows equal in all of
    them are alike, and one of them stays. Rows with an empty set link with nothing and stay, repeated or not.
    """
    rows, named = _linked(docs, id_col, text_col, n, percent)
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("text_hash").alias("hash"))
    first = rows.where("n > 0").join(named.select("sig", "component"), "sig").groupBy("component").agg(F.min(place).alias("p")).select("p.*", F.lit(False).alias("all"))
    empty = rows.where("n = 0").select(F.inline(F.array(place))).distinct().withColumn("all", F.lit(True))
    key = ["no_id", "id", "hash"]
    own_id = F.col(id_col).cast("long")
    mine = docs.select(own_id.isNull().alias("no_id"), F.coalesce(own_id, F.lit(0)).alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("hash"), F.struct(*docs.columns).alias("row"))
    # Rows that share id and text share all keys; the window finds them where the join has put them.
    order = Window.partitionBy(*key).orderBy(F.xxhash64("row"))
    found = mine.join(first.unionByName(empty), key).withColumn("k", F.row_number().over(order))
    return found.where("all or k = 1").select("row.*")
