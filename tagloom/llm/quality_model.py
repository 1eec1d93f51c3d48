"""Quality classifier by compression with two dictionaries.

One zstandard dictionary is built from good and one from bad labelled text. A text is compressed piece by piece
with each (pieces keep the dictionary in reach over whole long texts); the difference of the compressed sizes,
normalised by their sum, goes through a logistic curve fitted to other labelled rows.

The dictionaries are built from at most `pieces` pieces of each label, drawn by hash from about as many whole texts;
the curve is fitted on about `calibrate` labelled rows. Both bounds are parameters. Empty and null texts have
difference 0 and so the score of no evidence. With one label only, the score is that label's share.
Other columns are not read.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import checkpointed, slices

#: Bytes of a scored piece, bytes of a piece of a dictionary, bytes of a dictionary, compression level.
PIECE, SAMPLE, DICTIONARY, LEVEL = 1024, 512, 1_000_000, 3


class CompressionClassifier:
    def __init__(self, good: bytes, bad: bytes, slope: float = 1.0, offset: float = 0.0) -> None:
        self.good, self.bad, self.slope, self.offset = good, bad, slope, offset
        self._tools: list | None = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_tools": None}

    def difference(self, text: str | None) -> float:
        """Above 0: the good dictionary compresses better."""
        if self._tools is None:
            self._tools = []
            for d in (self.good, self.bad):
                made = zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                made.precompute_compress(level=LEVEL)
                self._tools.append(zstandard.ZstdCompressor(dict_data=made, level=LEVEL, write_checksum=False, write_content_size=False, write_dict_id=False).compress)
        blob = (text or "").encode("utf-8", "surrogatepass")
        good = bad = 0
        for a in range(0, len(blob), PIECE):
            good += len(self._tools[0](blob[a : a + PIECE])) - 6
            bad += len(self._tools[1](blob[a : a + PIECE])) - 6
        return (bad - good) / max(1, bad + good)

    def score(self, text: str | None) -> float:
        z = self.slope * self.difference(text) + self.offset
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def dictionary(pieces: list[bytes]) -> bytes:
    """The pieces end to end, as many as fit."""
    return b"".join(pieces)[:DICTIONARY]


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton steps, with a small ridge."""
    scale = float(np.std(x)) or 1.0
    a = np.stack([x / scale, np.ones(len(x))], 1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2), a.T @ (y - p) - 1e-3 * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / scale), float(w[1])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        rows = []
        for label, doc, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
            blob = (text or "").encode("utf-8", "surrogatepass")
            rows += [(label, xxhash.xxh64_intdigest(f"{doc}:{a}") >> 1, blob[a : a + SAMPLE]) for a in range(0, len(blob), SAMPLE)]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int32(), pa.int64(), pa.binary()))], ["label", "h", "piece"])


def _differences(batches: Iterator[pa.RecordBatch], model: CompressionClassifier) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        x = [model.difference(t) for t in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.float64())], ["label", "x"])


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", where: Column | None = None, pieces: int = 2000, calibrate: int = 8000) -> CompressionClassifier:
    """`where` is a condition on the labelled rows' ids. A document with several labels counts once for each."""
    marked = labels.where(F.col(label_col).isin(0, 1)).select(id_col, F.col(label_col).cast("int").alias("label"))
    marked = marked.where(where) if where is not None else marked
    h = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit(5)), F.lit(1 << 30))
    n = {r["label"]: r["n"] for r in marked.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        share = 1.0 if 1 in n else 0.0 if n else 0.5
        return CompressionClassifier(b"none", b"none", 0.0, math.log((share + 1e-3) / (1 - share + 1e-3)))
    total = sum(n.values())
    texts = docs.select(id_col, F.col(text_col).cast("string").alias("text"))
    # Dictionary rows and calibration rows are disjoint by parity of the hash.
    even = marked.where(h % 2 == 0)
    share = F.create_map(*(F.lit(v) for k, c in n.items() for v in (k, min(1.0, pieces / c))))
    drawn = even.where(h < share[F.col("label")] * (1 << 30))
    # The drawn ids are bounded by the parameters, so they go to the texts and no text is shuffled.
    with_text = lambda ids: texts.join(F.broadcast(ids.select("label", id_col)), id_col)
    cut = checkpointed(with_text(drawn).select("label", id_col, "text").mapInArrow(_pieces, "label int, h long, piece binary").repartition(8))
    per = [[bytes(r["piece"]) for r in cut.where(F.col("label") == k).orderBy("h", "piece").limit(pieces).collect()] for k in (1, 0)]
    model = CompressionClassifier(dictionary(per[0]) or b"none", dictionary(per[1]) or b"none")
    odd = marked.where((h % 2 == 1) & (h < min(1.0, 2 * calibrate / total) * (1 << 30)))
    seen = with_text(odd).select("label", "text").mapInArrow(functools.partial(_differences, model=model), "label int, x double").toPandas()
    if seen["label"].nunique() == 2:
        model.slope, model.offset = logistic(seen["x"].to_numpy(), seen["label"].to_numpy(float))
    return model


def _score(batches: Iterator[pa.RecordBatch], model: object) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        scores = [model.value.score(t) for t in b.column(b.num_columns - 1).to_pylist()]
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(scores, pa.float64())], [*b.schema.names[:-1], "score"])


def score_quality(docs: DataFrame, model: CompressionClassifier, *, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns of every row with score: 0 to 1, higher when label 1 is likelier."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    slim = docs.select(*keep, F.col(text_col).cast("string").alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema.fields[:-1])
    return slim.mapInArrow(functools.partial(_score, model=shared), f"{schema}, score double")
