"""Language identification: multinomial naive Bayes over hashed character n-grams.

Letters are lower-cased, everything else becomes a space, and the n-grams of 1 to 3 code points are hashed into
a fixed number of buckets. The matrix of log-probabilities (buckets x languages) goes to the
workers; documents are scored in batches with numpy gathers and segment sums. Texts are cut into pieces of bounded size whose
sums are added up; each n-gram belongs to the piece that holds its middle, so the cuts change nothing.

The predicted language has the largest posterior. The score is its probability after the log posterior is scaled to
EVIDENCE n-grams at most, which keeps long texts off exactly 1 and does not change the order.

Training reads the rows that `train` marks and whose language is known, at most about `per_lang` of each
language: rows are taken by a hash of their id, with a share chosen from the exact row counts. Every
language with a training row can be predicted.

Null texts and texts without a letter give `und` with score 0. Ties go to the language that comes first in
code point order. Without any training row everything is `und`. Other columns are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import slices, table_fn

#: Buckets of n-grams, code points scored at once, n-grams that count as independent evidence in the score.
BUCKETS, SLAB, EVIDENCE = 1 << 16, 1 << 19, 60


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


def _slabs(texts: list[str | None]) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Groups of pieces of SLAB code points at most, with each piece's text; a piece has one character more on each side."""
    owners, held, size = [], [], 0
    for i, t in enumerate(texts):
        low = (t or "").lower()
        for a in range(0, len(low), SLAB):
            piece = (low[a - 1] if a else " ") + low[a : a + SLAB] + (low[a + SLAB : a + SLAB + 1] or " ")
            if held and size + len(piece) > SLAB:
                yield np.array(owners), held
                owners, held, size = [], [], 0
            owners.append(i)
            held.append(piece)
            size += len(piece)
    if held:
        yield np.array(owners), held


def grams(owners: np.ndarray, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all n-grams of the pieces, the text of each, and the texts that have a letter."""
    size = np.array(list(map(len, pieces)))
    cp = np.frombuffer("".join(pieces).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = _letters()[cp]
    cp = np.where(letter, cp, np.uint32(32)).astype(np.uint64)
    # Places of n-grams: all characters but the first and the last of each piece.
    place = np.ones(len(cp), dtype=bool)
    ends = np.cumsum(size)
    place[ends - 1] = place[ends - size] = False
    k = np.flatnonzero(place)
    own = np.repeat(owners, size)[k]
    here, before, after = letter[k], letter[k - 1], letter[k + 1]
    uni = cp[k] * np.uint64(0x9E3779B97F4A7C15)
    bi = cp[k - 1] * np.uint64(0xC2B2AE3D27D4EB4F) + uni
    tri = bi + cp[k + 1] * np.uint64(0x165667B19E3779F9)
    two, three = here | before, here | before | after
    out = np.concatenate([(uni >> np.uint64(48))[here], (bi >> np.uint64(48))[two], (tri >> np.uint64(48))[three]])
    return out.astype(np.int64), np.concatenate([own[here], own[two], own[three]]), np.unique(own[here])


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for b in slices(batches):
        langs, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
        for lang in dict.fromkeys(langs):
            mine = [t for t, x in zip(texts, langs, strict=True) if x == lang]
            total = counts.setdefault(lang, np.zeros(BUCKETS, np.int64))
            for slab in _slabs(mine):
                total += np.bincount(grams(*slab)[0], minlength=BUCKETS)
    for lang, c in counts.items():
        yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([c.tobytes()], pa.binary())], ["lang", "counts"])


def _add(table: pa.Table) -> pa.Table:
    total = np.zeros(BUCKETS, np.int64)
    for x in table.column("counts").to_pylist():
        total += np.frombuffer(x, np.int64)
    return pa.table({"lang": table.column("lang").combine_chunks()[:1], "counts": pa.array([total.tobytes()], pa.binary())})


class NaiveBayes:
    def __init__(self, langs: list[str], counts: np.ndarray, rows: np.ndarray) -> None:
        """counts: languages x buckets; rows: training rows of each language."""
        self.langs = langs
        smooth = counts + 0.5
        self.log_p = np.ascontiguousarray(np.log(smooth / smooth.sum(1, keepdims=True)).T.astype(np.float32))
        self.prior = np.log(rows / rows.sum())

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        m = len(texts)
        if not self.langs:
            return ["und"] * m, np.zeros(m)
        n, sums, has = np.zeros(m), np.zeros((m, len(self.langs))), np.zeros(m, dtype=bool)
        for slab in _slabs(texts):
            bucket, owner, lettered = grams(*slab)
            has[lettered] = True
            n += np.bincount(owner, minlength=m)
            for k in range(len(self.langs)):
                sums[:, k] += np.bincount(owner, weights=self.log_p[:, k][bucket], minlength=m)
        logits = self.prior + sums
        best = logits.argmax(1)
        tempered = (logits - logits.max(1, keepdims=True)) * np.minimum(1, EVIDENCE / np.maximum(n, 1))[:, None]
        score = 1 / np.exp(tempered).sum(1)
        return [self.langs[k] if h else "und" for k, h in zip(best, has, strict=True)], np.where(has, score, 0.0)


def train(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", where: Column | None = None, per_lang: int = 5000) -> NaiveBayes:
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & (where if where is not None else F.lit(True)))
    count = {r["lang"]: r["n"] for r in rows.groupBy(F.col(lang_col).alias("lang")).agg(F.count("*").alias("n")).orderBy("lang").collect()}
    if not count:
        return NaiveBayes([], np.zeros((0, BUCKETS)), np.zeros(0))
    share = F.create_map(*(F.lit(v) for k, n in count.items() for v in (k, min(1.0, per_lang / n))))
    drawn = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit(11)), F.lit(1 << 30)) < share[F.col(lang_col)] * (1 << 30)
    parts = rows.where(drawn).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).mapInArrow(_learn, "lang string, counts binary")
    got = {r["lang"]: np.frombuffer(r["counts"], np.int64) for r in parts.groupBy("lang").applyInArrow(table_fn(_add), "lang string, counts binary").collect()}
    langs = sorted(count)
    return NaiveBayes(langs, np.stack([got.get(x, np.zeros(BUCKETS, np.int64)) for x in langs]), np.array([count[x] for x in langs], float))


def _predict(batches: Iterator[pa.RecordBatch], model: object) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        names, scores = model.value.predict(b.column(b.num_columns - 1).to_pylist())
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(names, pa.string()), pa.array(scores, pa.float64())], [*b.schema.names[:-1], "lang_pred", "score"])


def identify_language(docs: DataFrame, model: NaiveBayes, *, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns of every row with lang_pred and score (0 to 1)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    slim = docs.select(*keep, F.col(text_col).cast("string").alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema.fields[:-1])
    return slim.mapInArrow(functools.partial(_predict, model=shared), f"{schema}, lang_pred string, score double")
