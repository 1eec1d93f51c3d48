"""Byte-level BPE encoding and decoding with exact tree concatenation.

A text is halved down to leaves, at any character. The leaves of many texts are encoded in parallel batches (tasks take
different texts, threads different leaves), and neighbours are concatenated up the tree: a window around the join is split
and encoded anew, and grows until both sides agree.

* On the left the window begins where a pre-token of the left half begins, SURE bytes (two characters or more) before its
  end. A pre-token's end is decided by what stands up to the character after its run, and by the two characters after an
  apostrophe; so the split of the whole is that of the half up to there.
* On the right it has to reach a place where a pre-token of the right half begins, SURE bytes before its own end (or the
  end of the text). How a text is split from a place on depends on nothing before it, so both agree from there on.
* Inside a pre-token that both halves share (a long unsplit text), the window grows token by token until its first and
  last token are those of the two sides: a token sequence is the encoding of its bytes if each pair of neighbours is.

A long text costs work in proportion to its length (times the levels of the tree where nothing splits it), and
memory in proportion to its tokens. Special tokens in texts are matched first, as the library does by default. Vocabulary
files that normalise or split otherwise are left to the library as a whole.

Leaves of ASCII and Latin letters are encoded by ranks over the same vocabulary (if its ids are in merge order), all others by
the tokenizers library, so that its own Unicode tables decide about their characters.

Null encodes as the empty text.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from tagloom.llm.common import give_back, slices

#: Characters of a leaf of a text, leaves in a batch, threads for a batch, bytes before an end that the split does not depend on.
TEXT_LEAF, BATCH, THREADS, SURE = 1024, 512, 2, 8
#: Bytes of a leaf of a pre-token; longer pre-tokens are split. Distinct pre-tokens kept in a task.
LEAF, CACHE = 256, 400_000
#: The white space of the library's pattern.
WHITE = r"\t-\r \x85\xa0  -     　"
_SPLIT = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE}\p{{L}}\p{{N}}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
BLANKS = "".join(filter(regex.compile(f"[{WHITE}]").match, map(chr, range(0x3001))))
#: Up to here all Unicode versions agree about letters, digits and white space.
_PLAIN = regex.compile(r"[\x00-ɏ‐-‧€]*")
#: A pre-token ends wherever white space follows something else, whatever stands around. Characters at each end of a leaf that are split at least.
_FIRST, _LAST, EDGE = regex.compile(rf"(?<=[^{WHITE}])[{WHITE}]"), regex.compile(rf"(?r)(?<=[^{WHITE}])[{WHITE}]"), 24


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return [chr(b) if b in shown else chr(256 + b - sum(x < b for x in shown)) for b in range(256)]


class Part(NamedTuple):
    """An encoding, and tokens with which pre-tokens begin: all near its ends, and two or more of the others' places."""

    ids: list[int]
    cuts: list[int]


class ByteBpe:
    """Encoder and decoder for a byte-level vocabulary file of the tokenizers library."""

    def __init__(self, path: str) -> None:
        self.path = path
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        self.letters = _byte_letters()
        back = {c: b for b, c in enumerate(self.letters)}
        self.special = {t["content"]: t["id"] for t in data["added_tokens"] if t["special"]}
        self.tokens: list[bytes] = [b""] * (max([*data["model"]["vocab"].values(), *self.special.values()]) + 1)
        for token, i in data["model"]["vocab"].items():
            self.tokens[i] = bytes(back[c] for c in token)
        for token, i in self.special.items():
            self.tokens[i] = token.encode()
        self.size = list(map(len, self.tokens))
        self.ids = {b: i for i, b in enumerate(self.tokens) if b}
        plain = data["normalizer"] is None and data["post_processor"] is None and data["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        plain = plain and all(not t[k] for t in data["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
        self.plain = plain and not data["model"].get("ignore_merges")
        self.stop = regex.compile("|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True))) if self.special else None
        # With ids in the order of the merges, a rank encoder over the same vocabulary gives the same tokens faster.
        made = [data["model"]["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in data["model"]["merges"]]
        self.ranks = None
        if self.plain and made == sorted(made) and all(len(self.tokens[i]) == 1 for i in range(min(made, default=0))):
            ranks = {t: i for i, t in enumerate(self.tokens) if t and i not in self.special.values()}
            self.ranks = tiktoken.Encoding("own", pat_str=_SPLIT.pattern, mergeable_ranks=ranks, special_tokens={})

    @functools.cached_property
    def whole(self) -> Tokenizer:
        """The library's encoder."""
        return Tokenizer.from_file(self.path)

    @functools.cached_property
    def leaves(self) -> Tokenizer:
        """The library's encoder without special tokens."""
        with open(self.path, encoding="utf-8") as f:
            return Tokenizer.from_str(json.dumps({**json.load(f), "added_tokens": [], "truncation": None, "padding": None}))

    @functools.cached_property
    def bare(self) -> Tokenizer:
        """The library's merges alone: texts come as byte letters already, and unsplit."""
        with open(self.path, encoding="utf-8") as f:
            data = json.load(f)
        one = Tokenizer.from_str(json.dumps({**data, "added_tokens": [], "normalizer": None, "post_processor": None, "truncation": None, "padding": None}))
        one.pre_tokenizer = pre_tokenizers.Sequence([])
        return one

    def units(self, blobs: list[bytes]) -> list[list[int]]:
        """Each blob as one pre-token, in a parallel batch."""
        table = self.letters
        return [e.ids for e in self.bare.encode_batch(["".join([table[b] for b in x]) for x in blobs], add_special_tokens=False)]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the concatenated bytes of two encodings."""
        if not left or not right:
            return left + right
        i = j = 1
        while True:
            i, j = min(i, len(left)), min(j, len(right))
            window = left[len(left) - i :] + right[:j]
            blob = b"".join(self.tokens[t] for t in window)
            new = self.unit(blob) if len(blob) <= LEAF else self.units([blob])[0]
            # A side is settled if its outermost token came out again, or if nothing stands beyond it.
            at_left = i == len(left) or new[0] == window[0]
            at_right = j == len(right) or new[-1] == window[-1]
            if at_left and at_right and (len(new) > 1 or (i == len(left) and j == len(right))):
                return left[: len(left) - i] + new + right[j:]
            i, j = i if at_left and at_right is False else 2 * i, j if at_right and at_left is False else 2 * j

    def tree(self, blob: bytes) -> list[int]:
        """One long pre-token: leaves in parallel, then joins level by level."""
        count = -(-len(blob) // LEAF)
        level = self.units([blob[k * len(blob) // count : (k + 1) * len(blob) // count] for k in range(count)])
        while len(level) > 1:
            level = [self.join(*level[k : k + 2]) if k + 1 < len(level) else level[k] for k in range(0, len(level), 2)]
        return level[0] if level else []

    def unit(self, blob: bytes) -> list[int]:
        """One pre-token."""
        if len(blob) > LEAF:
            return self.tree(blob)
        return self.ranks._encode_single_piece(blob) if self.ranks else self.units([blob])[0]

    def pieces(self, text: str) -> list[str]:
        """Pre-tokens of a text without special tokens; the library decides about characters that Unicode versions may class differently."""
        if self.plain and _PLAIN.fullmatch(text):
            return _SPLIT.findall(text)
        return [text[a:z] for _, (a, z) in self.whole.pre_tokenizer.pre_tokenize_str(text)]

    def concat(self, left: Part, right: Part) -> Part:
        """The encoding of two halves of a text without special tokens, from the encodings of both."""
        if not left.ids or not right.ids:
            return left if left.ids else right
        size, i, j = self.size, 2, 2
        while True:
            begin = left.cuts[-i] if i < len(left.cuts) else 0
            a = sum(size[t] for t in left.ids[begin:])
            if begin and a < SURE:
                i *= 2
                continue
            stop = right.cuts[j] if j < len(right.cuts) else len(right.ids)
            known = {**self._places(left, begin, len(left.ids), 0), **self._places(right, 0, stop, a)}
            window = b"".join(self.tokens[t] for t in left.ids[begin:] + right.ids[:stop])
            sure = len(window) - (SURE if stop < len(right.ids) else 0)
            meets = {a: 0, **{place: token for (_, place), (side, _, token) in known.items() if side is right}}
            ids, cuts, at = [], [], 0
            for piece in self.pieces(window.decode("utf-8", "surrogatepass")):
                end = at + len(piece.encode("utf-8", "surrogatepass"))
                if end > sure:
                    break
                cuts.append(begin + len(ids))
                ids += self._piece(window[at:end], at, end, a, known)
                at = end
                if at in meets:
                    here, there = begin + len(ids), meets[at]
                    new = [here + c - there for c in right.cuts if c >= there]
                    return Part(left.ids[:begin] + ids + right.ids[there:], [c for c in left.cuts if c < begin] + cuts + new)
            j *= 2

    def _places(self, part: Part, first: int, last: int, at: int) -> dict[tuple[int, int], tuple[Part, int, int]]:
        """(from, to) in bytes of each pre-token between two tokens, with its part and tokens."""
        out, cuts = {}, [c for c in part.cuts if first <= c < last] + [last]
        for k, m in zip(cuts[:-1], cuts[1:], strict=True):
            end = at + sum(self.size[t] for t in part.ids[k:m])
            out[at, end] = (part, k, m)
            at = end
        return out

    def _piece(self, blob: bytes, start: int, end: int, middle: int, known: dict) -> list[int]:
        """One pre-token of a window: as either side has it, or from the two pieces that the join has parted, or anew."""
        if (same := known.get((start, end))) is not None:
            return same[0].ids[same[1] : same[2]]
        one, two = known.get((start, middle)), known.get((middle, end))
        if one is not None and two is not None:
            return self.join(one[0].ids[one[1] : one[2]], two[0].ids[two[1] : two[2]])
        return self.unit(blob)

    def edges(self, leaf: str, ids: list[int]) -> Part:
        """A leaf's encoding; the middle, from one sure end of a pre-token to another, is not split again."""
        first, last = _FIRST.search(leaf, EDGE), _LAST.search(leaf, 0, max(0, len(leaf) - EDGE))
        if not first or not last or first.start() >= last.start():
            spans = [leaf]
        else:
            spans = [leaf[: first.start()], None, leaf[last.start() :]]
        cuts, token, size = [], 0, self.size
        for piece in self.pieces(spans[0]):
            cuts.append(token)
            token = self._after(ids, token, len(piece.encode("utf-8", "surrogatepass")))
        if len(spans) > 1:
            cuts.append(token)
            back, token = [], len(ids)
            for piece in reversed(self.pieces(spans[2])):
                left = len(piece.encode("utf-8", "surrogatepass"))
                while left > 0:
                    token -= 1
                    left -= size[ids[token]]
                back.append(token)
            cuts += reversed(back)
        return Part(ids, cuts)

    def _after(self, ids: list[int], token: int, count: int) -> int:
        while count > 0:
            count -= self.size[ids[token]]
            token += 1
        return token

    def _batches(self, leaves: list[str]) -> Iterator[tuple[str, list[int], list[int] | None]]:
        """Each leaf with its ids, and the library's numbers of the pre-tokens where it has encoded it."""
        for a in range(0, len(leaves), BATCH):
            batch = leaves[a : a + BATCH]
            own = [bool(self.ranks and _PLAIN.fullmatch(x)) for x in batch]
            fast = iter(self.ranks.encode_ordinary_batch([x for x, o in zip(batch, own, strict=True) if o], num_threads=THREADS) if any(own) else ())
            slow = iter(self.leaves.encode_batch([x for x, o in zip(batch, own, strict=True) if not o], add_special_tokens=False))
            for x, o in zip(batch, own, strict=True):
                if o:
                    yield x, next(fast), None
                else:
                    e = next(slow)
                    yield x, e.ids, e.word_ids

    def part(self, leaf: str, ids: list[int], words: list[int] | None) -> Part:
        return self.edges(leaf, ids) if words is None else Part(ids, [k for k, w in enumerate(words) if not k or w != words[k - 1]])

    def encode_all(self, texts: list[str | None]) -> Iterator[list[int]]:
        """The ids of each text; the leaves of all texts are encoded in parallel batches."""
        if not self.plain:
            yield from (e.ids for e in self.whole.encode_batch([t or "" for t in texts], add_special_tokens=False))
            return
        plans, leaves = [], []
        for text in texts:
            text, plan, at = text or "", [], 0
            for stop in [*(self.stop.finditer(text) if self.stop else ()), None]:
                part = text[at : stop.start() if stop else len(text)]
                count = -(-len(part) // TEXT_LEAF)
                leaves += [part[k * len(part) // count : (k + 1) * len(part) // count] for k in range(count)]
                plan.append((count, self.special[stop[0]] if stop else None))
                at = stop.end() if stop else at
            plans.append(plan)
        found = self._batches(leaves)
        for plan in plans:
            ids: list[int] = []
            for count, special in plan:
                if count == 1:
                    ids += next(found)[1]
                elif count:
                    ids += self.up([self.part(*next(found)) for _ in range(count)]).ids
                if special is not None:
                    ids.append(special)
            yield ids

    def up(self, level: list[Part]) -> Part:
        while len(level) > 1:
            level = [self.concat(*level[k : k + 2]) if k + 1 < len(level) else level[k] for k in range(0, len(level), 2)]
        return level[0]

    def encode(self, text: str | None) -> list[int]:
        return next(self.encode_all([text]))

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.tokens.__getitem__, ids)).decode("utf-8", "replace")


@functools.cache
def load(path: str) -> ByteBpe:
    """One codec for each worker process."""
    out = ByteBpe(path)
    give_back()
    return out


def _codec(batches: Iterator[pa.RecordBatch], path: str, keep: bool) -> Iterator[pa.RecordBatch]:
    bpe = load(path)
    for b in slices(batches, 200):
        cols: list[list] = [[], [], [], [], []]
        for ids in bpe.encode_all(b.column(1).to_pylist()):
            back = bpe.decode(ids)
            packed = np.array(ids, dtype="<u4")
            row = (len(ids), hashlib.sha256(packed.tobytes()).hexdigest(), hashlib.sha256(back.encode("utf-8", "surrogatepass")).hexdigest(), packed.astype(np.int32) if keep else None, back if keep else None)
            for c, v in zip(cols, row, strict=True):
                c.append(v)
        kinds = (pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.string())
        arrays = [b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))]
        names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"]
        yield pa.RecordBatch.from_arrays(arrays if keep else arrays[:4], names if keep else names[:4])


def bpe_round_trip(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", keep: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids, decoded]) of each row; without keep, digests only.

    The file at path must be readable on every worker. Repeated rows give repeated results; other columns
    are not read; an empty table gives an empty result.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded string" if keep else "")
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(functools.partial(_codec, path=path, keep=keep), schema)
