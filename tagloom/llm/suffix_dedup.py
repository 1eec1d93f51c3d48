"""Removal of repeated substrings by distributed prefix doubling with early discarding.

A byte goes when it lies in a string of `length` bytes that also starts earlier (in a smaller doc_id, or
in the same document before). Positions are named by pair hashing: the name of 2h bytes at p is the hash of
the names of h bytes at p and p+h. The offsets grow 1, 2, 4 ... 32 inside a document for every position;
then position-name pairs are exchanged, sorted and reranked, and whatever is unique leaves:

1. Of all windows of `length` bytes that share their smallest 32-byte name (their anchor) one row is sent: the
   anchor's name, the name of the whole run of windows, and its place. Anchors seen once leave. Runs that are
   equal to an earlier run are repeats as a whole; what remains are first runs whose anchor occurs elsewhere.
2. Those runs send their bytes; the names of their single windows, doubled up to `length`, are sorted, and
   each window that is not the first with its name is a repeat.

Windows that are equal have the same anchor at the same offset, so no repeat is lost. Runs repeated within a
task are reduced to their first before the exchange, so a passage that a third of all documents share costs
a row for each task.

Null and empty texts have no bytes. A null doc_id counts as larger than all others. Rows with equal doc_id and
equal text are one document, each row getting its result; with equal doc_id and unequal texts they are ordered
by a hash of the text. Other columns pass through `dedup_documents` untouched.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.llm.common import MIX, block_rows, bucket_count, checkpointed, pack, packed_exchange, slices, starts, table_fn, unpack

#: Bytes of an anchor's name, and text bytes of a flush.
GRAM, FLUSH = 32, 16_000_000
#: Windows of a piece of a long text; a place within a piece and the overlap fits into _PLACE.
PIECE, _PLACE = 1 << 19, np.uint64((1 << 20) - 1)
_BYTE = np.random.default_rng(20).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def names(b: np.ndarray, size: int) -> np.ndarray:
    """The names of the `size` bytes at each position; doubling, the last step overlapping."""
    h, s = _BYTE[b], 1
    while s < size:
        step = min(s, size - s)
        if len(h) <= step:
            return np.zeros(0, np.uint64)
        h = h[:-step] * MIX[s % 5] + h[step:]
        h ^= h >> np.uint64(29)
        s += step
    return h


def runs(b: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor's name, run's name, first and last window of each run of windows with the same anchor.

    Long texts are taken in overlapping pieces, which only splits runs.
    """
    parts = [(o, _piece(b[o : o + PIECE + length - 1], length)) for o in range(0, len(b) - length + 1, PIECE)]
    return tuple(np.concatenate([x[k] + (o if k > 1 else np.uint64(0)) for o, x in parts]) for k in range(4))


def _piece(b: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    width, h = length - GRAM + 1, names(b, GRAM)
    # The smallest name of each window, the leftmost of equal ones: a function of the window's bytes alone.
    least, s = (h * MIX[2]) & ~_PLACE | np.arange(len(h), dtype=np.uint64), 1
    while 2 * s <= width:
        least = np.minimum(least[:-s], least[s:])
        s *= 2
    if width > s:
        least = np.minimum(least[: len(least) - (width - s)], least[width - s :])
    a = (least & _PLACE).astype(np.int64)
    first = starts(a)
    last = np.append(first[1:], len(a)) - 1
    whole = h[first]
    for o in range(GRAM, 2 * length - GRAM, GRAM):
        whole = (whole ^ (whole >> np.uint64(31))) * MIX[1] + h[np.minimum(first + o, last + length - GRAM)]
    whole = whole * MIX[2] + (a[first] - first).astype(np.uint64) * MIX[3] + (last - first).astype(np.uint64)
    return h[a[first]], whole, first, last


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, bytes]]:
    for b in slices(batches):
        for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            blob = (text or "").encode("utf-8", "surrogatepass")
            yield (2**63 - 1 if doc is None else doc), int(np.frombuffer(xxhash.xxh64_digest(blob), np.int64)[0]), blob


def _per_doc(key: np.ndarray, doc: np.ndarray, text: np.ndarray, *rest: np.ndarray) -> list[tuple[int, bytes]]:
    order = np.lexsort((text, doc, key))
    key, doc, text, rest = key[order], doc[order], text[order], [r[order] for r in rest]
    out, cuts = [], np.append(starts(key), len(key))
    for a, z in zip(cuts[:-1], cuts[1:], strict=True):
        s = starts(doc[a:z], text[a:z])
        out.append((int(key[a]), pack(doc[a:z][s], text[a:z][s], np.diff(np.append(s, z - a)).astype(np.uint32), *(r[a:z] for r in rest))))
    return out


def _home(doc: np.ndarray, text: np.ndarray, buckets: int) -> np.ndarray:
    """A document's bucket; copies of one text are spread by their ids."""
    mixed = doc.view(np.uint64) * MIX[0] + text.view(np.uint64)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * MIX[1]
    return ((mixed >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)


def _send_runs(batches: Iterator[pa.RecordBatch], length: int, buckets: int) -> Iterator[pa.RecordBatch]:
    def flush() -> pa.RecordBatch:
        anchor, whole, first, last = (np.concatenate([h[2][k] for h in held]) for k in range(4))
        count = [len(h[2][0]) for h in held]
        doc, text = np.repeat(np.array([h[0] for h in held], np.int64), count), np.repeat(np.array([h[1] for h in held], np.int64), count)
        order = np.lexsort((first, text, doc, whole, anchor))
        anchor, whole, first, last, doc, text = (x[order] for x in (anchor, whole, first, last, doc, text))
        lead = np.zeros(len(anchor), bool)
        lead[starts(anchor, whole)] = True
        first, last = first.astype(np.uint32), last.astype(np.uint32)
        rows = [(k, b"\0" + p) for k, p in _per_doc((anchor[lead] % np.uint64(buckets)).astype(np.int64), doc[lead], text[lead], anchor[lead], whole[lead], first[lead], (last - first)[lead].astype(np.uint16))]
        again = ~lead
        rows += [(k, b"\1" + p) for k, p in _per_doc(_home(doc[again], text[again], buckets), doc[again], text[again], first[again], last[again], np.ones(int(again.sum()), np.uint8))]
        return block_rows(rows)

    held, size, seen = [], 0, set()
    for doc, text, blob in _documents(batches):
        if len(blob) >= length and (doc, text) not in seen:
            seen.add((doc, text))
            held.append((doc, text, runs(np.frombuffer(blob, np.uint8), length)))
            size += len(blob)
            if size >= FLUSH:
                yield flush()
                held, size, seen = [], 0, set()
    if held:
        yield flush()


def _rerank(table: pa.Table, buckets: int) -> pa.Table:
    """Per document: runs that repeat (1) and runs to look into (0)."""
    rows, parts = [], []
    for bucket, p in zip(table.column(0).to_pylist(), table.column(1).to_pylist(), strict=True):
        if p[0]:
            rows.append((bucket, p[1:]))
        else:
            doc, text, n, *rest = unpack(p[1:], np.int64, np.int64, np.uint32, np.uint64, np.uint64, np.uint32, np.uint16)
            parts.append((np.repeat(doc, n), np.repeat(text, n), *rest))
    if parts:
        doc, text, anchor, whole, first, more = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(anchor)
        count = np.diff(np.append(starts(anchor[order]), len(order)))
        order = order[np.repeat(count, count) > 1]
        doc, text, anchor, whole, first, more = (x[order] for x in (doc, text, anchor, whole, first, more))
        order = np.lexsort((first, text, doc, whole, anchor))
        doc, text, anchor, whole, first, more = (x[order] for x in (doc, text, anchor, whole, first, more))
        lead = np.zeros(len(doc), np.int64)
        lead[starts(anchor, whole)] = 1
        at = starts(anchor)
        kinds = np.add.reduceat(lead, at) if len(at) else lead
        several = np.repeat(kinds, np.diff(np.append(at, len(doc)))) > 1
        # The same document twice (in two tasks) is no repeat of itself.
        same = np.zeros(len(doc), bool)
        same[1:] = (doc[1:] == doc[:-1]) & (text[1:] == text[:-1]) & (first[1:] == first[:-1]) & (anchor[1:] == anchor[:-1]) & (whole[1:] == whole[:-1])
        keep = ((lead == 0) | several) & ~same
        rows += _per_doc(_home(doc[keep], text[keep], buckets), doc[keep], text[keep], first[keep], first[keep] + more[keep], (lead[keep] == 0).astype(np.uint8))
    return pa.Table.from_batches([block_rows(rows)])


def _gather(table: pa.Table) -> pa.Table:
    """A row for each document: the places of its repeating and of its open runs."""
    parts = []
    for p in table.column(1).to_pylist():
        doc, text, n, first, last, kind = unpack(p, np.int64, np.int64, np.uint32, np.uint32, np.uint32, np.uint8)
        parts.append((np.repeat(doc, n), np.repeat(text, n), first, last, kind))
    out = []
    if parts:
        doc, text, first, last, kind = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((first, text, doc))
        doc, text, first, last, kind = (x[order] for x in (doc, text, first, last, kind))
        cuts = np.append(starts(doc, text), len(doc))
        for a, z in zip(cuts[:-1], cuts[1:], strict=True):
            f, l, k = first[a:z], last[a:z], kind[a:z] == 1  # noqa: E741
            out.append((int(doc[a]), int(text[a]), pack(*_merged(f[k], l[k])), pack(f[~k], l[~k]) if (~k).any() else None))
    return pa.Table.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.binary(), pa.binary()))], ["doc", "th", "gone", "open"])


def _merged(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges of window starts, sorted by start, with overlapping and adjacent ones joined."""
    if not len(first):
        return first.astype(np.uint32), last.astype(np.uint32)
    reach = np.maximum.accumulate(last.astype(np.int64))
    new = np.append(True, first[1:].astype(np.int64) > reach[:-1] + 1)
    at = np.flatnonzero(new)
    return first[at].astype(np.uint32), reach[np.append(at[1:], len(first)) - 1].astype(np.uint32)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, th, body): texts for the joins, compressed, since they are what the shuffle carries."""
    press = zstandard.ZstdCompressor(level=1)
    for b in slices(batches):
        rows = [(d, t, press.compress(x)) for d, t, x in _documents(iter([b]))]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.binary()))], ["doc", "th", "body"])


def _send_open(batches: Iterator[pa.RecordBatch], length: int, buckets: int) -> Iterator[pa.RecordBatch]:
    def flush() -> pa.RecordBatch:
        key, doc, text, first, size = (np.concatenate([h[k] for h in held]) for k in range(5))
        blob = [x for h in held for x in h[5]]
        order = np.argsort(key, kind="stable")
        cuts, rows = np.append(starts(key[order]), len(order)), []
        for a, z in zip(cuts[:-1], cuts[1:], strict=True):
            o = order[a:z]
            rows.append((int(key[o[0]]), pack(doc[o], text[o], first[o], size[o], np.frombuffer(b"".join(blob[i] for i in o), np.uint8))))
        return block_rows(rows)

    press, held, total = zstandard.ZstdDecompressor(), [], 0
    for b in slices(batches):
        for doc, text, body, spans in zip(*(c.to_pylist() for c in b.columns[:4]), strict=True):
            data = press.decompress(body)
            first, last = unpack(spans, np.uint32, np.uint32)
            anchor, _, at, _ = runs(np.frombuffer(data, np.uint8), length)
            key = (anchor[np.searchsorted(at, first)] % np.uint64(buckets)).astype(np.int64)
            size = (last - first + length).astype(np.uint32)
            held.append((key, np.full(len(key), doc), np.full(len(key), text), first, size, [data[int(f) : int(f) + int(s)] for f, s in zip(first, size, strict=True)]))
            total += int(size.sum())
            if total >= FLUSH:
                yield flush()
                held, total = [], 0
    if held:
        yield flush()


def _rank_windows(table: pa.Table, length: int, buckets: int) -> pa.Table:
    parts = [unpack(p, np.int64, np.int64, np.uint32, np.uint32, np.uint8) for p in table.column(1).to_pylist()]
    if not parts:
        return pa.Table.from_batches([block_rows([])])
    doc, text, first, size, data = (np.concatenate(x) for x in zip(*parts, strict=True))
    h = names(data, length)
    begin = np.append(0, np.cumsum(size.astype(np.int64))[:-1])
    per = (size - length + 1).astype(np.int64)
    owner = np.repeat(np.arange(len(size)), per)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)
    name = h[begin[owner] + offset]
    order = np.argsort(name, kind="stable")
    count = np.diff(np.append(starts(name[order]), len(order)))
    order = order[np.repeat(count, count) > 1]
    d, t, p, name = doc[owner[order]], text[owner[order]], first[owner[order]] + offset[order].astype(np.uint32), name[order]
    again = np.lexsort((p, t, d, name))
    d, t, p, name = d[again], t[again], p[again], name[again]
    late = np.ones(len(d), bool)
    head = starts(name)
    lead = np.repeat(head, np.diff(np.append(head, len(d))))
    late &= (d != d[lead]) | (t != t[lead]) | (p != p[lead])
    d, t, p = d[late], t[late], p[late]
    order = np.lexsort((p, t, d))
    d, t, p = d[order], t[order], p[order]
    at = starts(d, t, p.astype(np.int64) - np.arange(len(p))) if len(p) else np.zeros(0, np.int64)
    end = p[np.append(at[1:], len(p)) - 1] if len(p) else p
    return pa.Table.from_batches([block_rows(_per_doc(_home(d[at], t[at], buckets), d[at], t[at], p[at], end, np.ones(len(at), np.uint8)))])


def removed_runs(blob: bytes, length: int, *ranges: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of bytes to remove (from, to), given packed ranges of window starts."""
    spans = [unpack(r, np.uint32, np.uint32) for r in ranges if r]
    first, last = (np.concatenate([s[k] for s in spans]).astype(np.int64) if spans else np.zeros(0, np.int64) for k in (0, 1))
    order = np.argsort(first)
    f, l = _merged(first[order], last[order] + length - 1)  # noqa: E741
    return f.astype(np.int64), l.astype(np.int64) + 1


def _cut(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdDecompressor()
    for b in slices(batches):
        rows = []
        for doc, body, one, two in zip(*(c.to_pylist() for c in b.columns[:4]), strict=True):
            data = press.decompress(body)
            a, z = removed_runs(data, length, one, two)
            keep, at = [], 0
            for x, y in zip(a.tolist(), z.tolist(), strict=True):
                keep.append(data[at:x])
                at = y
            keep.append(data[at:])
            rows.append((None if doc == 2**63 - 1 else doc, len(data), int((z - a).sum()), len(a), hashlib.sha256(b"".join(keep)).hexdigest(), a.tolist(), z.tolist()))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "span_from", "span_to"])


def _repeats(docs: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """Texts by key, and per key the packed ranges of repeating windows found in either step."""
    if length < 2 * GRAM:
        raise ValueError(f"length must be {2 * GRAM} or more")
    buckets = bucket_count(docs)
    found = packed_exchange(docs, functools.partial(_send_runs, length=length, buckets=buckets), table_fn(_rerank, buckets=buckets), "bucket int, payload binary")
    lists = found.groupBy("bucket").applyInArrow(table_fn(_gather), "doc long, th long, gone binary, open binary")
    lists = checkpointed(lists)
    texts = docs.mapInArrow(_keyed, "doc long, th long, body binary")
    to_open = texts.join(lists.where("open is not null").select("doc", "th", "open"), ["doc", "th"]).dropDuplicates(["doc", "th"]).select("doc", "th", "body", "open")
    more = packed_exchange(to_open, functools.partial(_send_open, length=length, buckets=buckets), table_fn(_rank_windows, length=length, buckets=buckets), "bucket int, payload binary")
    more = more.groupBy("bucket").applyInArrow(table_fn(_gather), "doc long, th long, gone binary, open binary").select("doc", "th", F.col("gone").alias("late"))
    return texts, lists.select("doc", "th", "gone").join(more, ["doc", "th"], "full")


def repeated_substrings(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = 100) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, span_from, span_to) for every row; spans are byte offsets."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    texts, lists = _repeats(docs, length)
    joined = texts.join(lists, ["doc", "th"], "left").select("doc", "body", "gone", "late")
    return joined.mapInArrow(functools.partial(_cut, length=length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, span_from array<long>, span_to array<long>")


def _clean(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        rows = []
        for text, one, two in zip(*(c.to_pylist() for c in b.columns[-3:]), strict=True):
            data = (text or "").encode("utf-8", "surrogatepass")
            keep, at = [], 0
            for x, y in zip(*(v.tolist() for v in removed_runs(data, length, one, two)), strict=True):
                # A character goes only as a whole.
                while x < y and data[x] & 0xC0 == 0x80:
                    x += 1
                while y > x and y < len(data) and data[y] & 0xC0 == 0x80:
                    y -= 1
                keep.append(data[at:x])
                at = y
            keep.append(data[at:])
            rows.append(text if text is None else b"".join(keep).decode("utf-8", "surrogatepass"))
        yield pa.RecordBatch.from_arrays([*b.columns[:-3], pa.array(rows, pa.string())], [*b.schema.names[:-3], "clean"])


def dedup_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = 100) -> DataFrame:
    """The rows with repeated substrings cut out of the text; all other columns as they are.

    Characters are removed whole: one that is repeated only in part stays.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    _, lists = _repeats(slim, length)
    # The input's columns go by their numbers, so that no name of theirs can clash.
    number = {c: f"c{k}" for k, c in enumerate(docs.columns)}
    rows = docs.select(*(F.col(c).alias(n) for c, n in number.items()))
    key = rows.mapInArrow(functools.partial(_with_key, id_col=number[id_col], text_col=number[text_col]), T.StructType([*rows.schema.fields, T.StructField("doc", T.LongType()), T.StructField("th", T.LongType())]))
    joined = key.join(lists, ["doc", "th"], "left").select(*number.values(), F.col(number[text_col]).cast("string").alias("text"), "gone", "late")
    out = joined.mapInArrow(functools.partial(_clean, length=length), T.StructType([*rows.schema.fields, T.StructField("clean", T.StringType())]))
    return out.select(*(F.col("clean" if c == text_col else n).alias(c) for c, n in number.items()))


def _with_key(batches: Iterator[pa.RecordBatch], id_col: str, text_col: str) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        at = b.schema.names.index
        keys = [(d, t) for d, t, _ in _documents(iter([b.select([at(id_col), at(text_col)])]))]
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64())], [*b.schema.names, "doc", "th"])
