"""Exact token counts of all prefixes by dynamic programming.

Within a pre-token, the encoding of the first i bytes ends in exactly one token: the one that covers all i
bytes, or one that follows the last token of the bytes before it without merging with it. So the count at i
is the count before that token plus one, and one pass gives the counts of all prefixes.

A text's table holds the exact count of tokens of each of its prefixes, a number for each character: running sums over
its pre-tokens' counts. Where a prefix is split otherwise than the text is, the table has the prefix's own count: a run of
white space whose last character belongs to the next word, a contraction of three characters, and a special token, whose
inside is ordinary text. Counts of prefixes, truncation to a budget and the query's totals are looked up in it; nothing is encoded again.

Null counts as empty. A prefix ends between characters. Each distinct short pre-token is computed once in a task.
"""

from __future__ import annotations

import functools
from array import array
from collections.abc import Iterator
from operator import sub

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.bpe import BLANKS, CACHE, WHITE, ByteBpe, load
from tagloom.llm.common import slices


#: White space of two characters or more before something else: its last character is not in the pre-token of the others.
_RUN = regex.compile(rf"[{WHITE}]{{2,}}(?=[^{WHITE}])")
#: Pre-tokens that a cut inside would split otherwise.
_CONTRACTIONS = ("'re", "'ve", "'ll")


class _Steps(dict):
    """For each pre-token the change of the count at each of its characters, packed."""

    def __init__(self, counter: PrefixCounter) -> None:
        self.counter = counter

    def __missing__(self, piece: str) -> bytes:
        out = self.counter.steps_of(piece)
        if len(piece) <= 64:
            if len(self) >= CACHE:
                self.clear()
            self[piece] = out
        return out


class PrefixCounter:
    def __init__(self, bpe: ByteBpe) -> None:
        self.bpe = bpe
        # Special tokens never come out of a pre-token, nor does a token that encodes differently when alone.
        alone = [(t, i) for t, i in bpe.ids.items() if i not in bpe.special.values()]
        self.ids = {t: i for (t, i), own in zip(alone, bpe.units([t for t, _ in alone]), strict=True) if own == [i]}
        # Lengths of the tokens by their last two bytes, so that only lengths that exist are tried.
        lengths: dict[bytes, set[int]] = {}
        for t in self.ids:
            lengths.setdefault(t[-2:], {1}).add(len(t))
        self.lengths = {end: sorted(x) for end, x in lengths.items()}
        self.longest = max(map(len, self.ids))
        self.steps = _Steps(self)
        self.pairs: dict[int, bool] = {}

    def _apart(self, a: int, b: int) -> bool:
        """Whether token b can follow token a in an encoding; remembered in `pairs`."""
        if len(self.pairs) > CACHE:
            self.pairs.clear()
        known = self.pairs[a << 32 | b] = self.bpe.unit(self.bpe.tokens[a] + self.bpe.tokens[b]) == [a, b]
        return known

    def unit_counts(self, blob: bytes) -> list[int]:
        """counts[i]: tokens of the first i bytes of one pre-token."""
        last, counts, ids, lengths, pairs, longest = [-1], [0], self.ids, self.lengths, self.pairs, self.longest
        for i in range(1, len(blob) + 1):
            t = ids.get(blob[:i]) if i <= longest else None
            if t is not None:
                last.append(t)
                counts.append(1)
                continue
            # One token only ends the encoding of i bytes, so the order of the trials does not matter.
            for n in lengths.get(blob[i - 2 : i], (1,)):
                if n < i and (t := ids.get(blob[i - n : i])) is not None:
                    before = last[i - n]
                    apart = pairs.get(before << 32 | t)
                    if self._apart(before, t) if apart is None else apart:
                        last.append(t)
                        counts.append(counts[i - n] + 1)
                        break
        return counts

    def steps_of(self, piece: str) -> bytes:
        blob = piece.encode("utf-8", "surrogatepass")
        counts = self.unit_counts(blob)
        at = counts if len(blob) == len(piece) else [counts[i] for i in _ends(blob)]
        if piece in _CONTRACTIONS:  # cut inside, it is an apostrophe and a letter
            at = [0, at[1], at[1] + self.unit_counts(blob[1:2])[-1], at[3]]
        return array("i", map(sub, at[1:], at)).tobytes()

    def table(self, text: str | None) -> np.ndarray:
        """table[k]: tokens of the first k characters, for k from 0 to the text's length."""
        text, steps, fixes, at = text or "", [], [], 0
        for stop in [*(self.bpe.stop.finditer(text) if self.bpe.stop else ()), None]:
            part = text[at : stop.start() if stop else len(text)]
            if part:
                steps.extend(map(self.steps.__getitem__, self.bpe.pieces(part)))
                fixes += [(at + m.start(), at + m.end()) for m in _RUN.finditer(part)]
            if stop:
                steps.append(np.array([1, *[0] * (len(stop[0]) - 1)], np.intc).tobytes())
                fixes.append((stop.start(), stop[0]))
                at = stop.end()
        sums = np.append(0, np.cumsum(np.frombuffer(b"".join(steps), np.intc), dtype=np.int64))
        out = sums.copy()
        for begin, what in fixes:
            if isinstance(what, str):
                self._inside(out, sums, text, begin, what)
            else:  # a run of white space that the prefix ends with is one pre-token
                out[what] = sums[begin] + self.unit_counts(text[begin:what].encode())[-1]
        return out

    def _inside(self, out: np.ndarray, sums: np.ndarray, text: str, begin: int, special: str) -> None:
        """Counts of prefixes that end inside a special token, whose characters are ordinary text there.

        The split holds up to the last pre-token that ends two characters or more before it.
        """
        back = 64
        while True:
            known = max((m.end() for m in self.bpe.stop.finditer(text, max(0, begin - back), begin)), default=-1)
            start = known if known >= 0 else max(0, begin - back)
            cuts = [start]
            for p in self.bpe.pieces(text[start:begin]):
                cuts.append(cuts[-1] + len(p))
            # Unless it begins at a known place, the split is sure only after white space that follows something else.
            if known < 0 and start:
                sure = next((k for k in range(start + 1, begin) if text[k] in BLANKS and text[k - 1] not in BLANKS), None)
                cuts = [c for c in cuts if sure is not None and c >= sure]
            cuts = [c for c in cuts if c <= begin - 2 or c in (0, known)]
            if cuts:
                break
            back *= 4
        for k in range(1, len(special)):
            out[begin + k] = sums[cuts[-1]] + self.count(text[cuts[-1] : begin + k])

    def count(self, text: str | None) -> int:
        return int(self.table(text)[-1])

    def fits(self, text: str | None, budget: int, table: np.ndarray | None = None) -> int:
        """The most characters whose tokens, as a text of their own, are `budget` at most."""
        table = self.table(text) if table is None else table
        return int(np.flatnonzero(table <= budget)[-1]) if budget >= 0 else 0


def _ends(blob: bytes) -> list[int]:
    """Where characters begin, and the end."""
    return [i for i in range(len(blob)) if blob[i] & 0xC0 != 0x80] + [len(blob)]


@functools.cache
def _counter(path: str) -> PrefixCounter:
    return PrefixCounter(load(path))


def _count(batches: Iterator[pa.RecordBatch], path: str, budget: int, store: bool) -> Iterator[pa.RecordBatch]:
    counter = _counter(path)
    names = ["doc_id", "n_bytes", "n_tokens", "over_limit", "fits_chars", "prefix_tokens"]
    kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.list_(pa.int32()))
    for b in slices(batches):
        rows = []
        for text in b.column(1).to_pylist():
            table = counter.table(text)
            n = int(table[-1])
            rows.append((len((text or "").encode("utf-8", "surrogatepass")), n, n > budget, counter.fits(text, budget, table), table.astype(np.int32) if store else None))
        arrays = [b.column(0), *(pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds))]
        yield pa.RecordBatch.from_arrays(arrays if store else arrays[:5], names if store else names[:5])


def token_counts(docs: DataFrame, path: str, *, budget: int = 1024, store: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit, fits_chars[, prefix_tokens]) of each row, all from the text's table.

    fits_chars: the characters of the longest prefix that has `budget` tokens at most. With store, prefix_tokens is the
    table: its entry k (from 0) is the count of the first k characters. Repeated rows give repeated results; other columns
    are not read; an empty table gives an empty result.
    """
    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fits_chars long" + (", prefix_tokens array<int>" if store else "")
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(functools.partial(_count, path=path, budget=budget, store=store), schema)


def fits_chars(prefix_tokens: Column, budget: int) -> Column:
    """The characters that fit another budget, from a stored table."""
    return F.aggregate(F.transform(prefix_tokens, lambda n, k: F.when(n <= budget, k)), F.lit(0), lambda a, k: F.coalesce(k, a)).cast("long")


def tokens_of_prefix(prefix_tokens: Column, chars: Column | int) -> Column:
    """Tokens of the first `chars` characters, from a stored table."""
    return F.get(prefix_tokens, chars if isinstance(chars, Column) else F.lit(chars)).cast("long")
