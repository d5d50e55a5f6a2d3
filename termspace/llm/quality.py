"""Quality of a text by how well it compresses with a good and a bad dictionary.

Zstandard dictionaries are built from labelled texts of either kind. A text that
compresses better with the good one resembles good texts; the difference of the
compressed sizes, over their sum, is calibrated to a probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termspace.llm.common import Sent, columns_as, text_bytes, texts_of
from termspace.llm.labelled import labelled_sample
from termspace.session import scratch_path

# Bound of the labelled sample, for each label.
SAMPLE_ROWS = 2_000
SAMPLE_BYTES = 8 * 2**20
THRESHOLD = 0.3
# Texts are compressed in blocks, so that a long text does not become its own dictionary.
BLOCK = 1_024
DICTIONARY = 112_640
LEVEL = 3
# Of the sample, every third text calibrates and the others make the dictionaries.
CALIBRATION = 3


@dataclass
class QualityModel:
    """Dictionaries and calibration; without two labels the share of good ones is every score."""

    good: bytes
    bad: bytes
    slope: float
    offset: float

    def compressors(self) -> list:
        made = []
        for data in (self.good, self.bad):
            # As raw content where too little text was there to train on.
            dictionary = zstandard.ZstdCompressionDict(data)
            dictionary.precompute_compress(level=LEVEL)
            made.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_content_size=False, write_dict_id=False))
        return made

    def differences(self, texts: pa.Array, compressors: list) -> np.ndarray:
        data, offsets = text_bytes(texts)
        data = data.tobytes()
        found = np.zeros(len(texts))
        for i, (first, last) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
            good = bad = 0
            for start in range(first, last, BLOCK):
                block = data[start : min(last, start + BLOCK)]
                good += len(compressors[0].compress(block))
                bad += len(compressors[1].compress(block))
            if last > first:
                found[i] = (bad - good) / (bad + good)
        return found

    def scores(self, differences: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * differences + self.offset, -30, 30)))


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label_id: str = "doc_id",
    label: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
    sample_bytes: int = SAMPLE_BYTES,
    work: str | None = None,
) -> QualityModel:
    """A model from (label_id, label 0 or 1) of the rows of ``docs``.

    Fitted on at most ``sample_rows`` whole texts and ``sample_bytes`` bytes per
    label. Null labels and ids and empty texts teach nothing; a text labelled
    both ways counts for both. With less than two labels scores are constant.
    """
    work = work or scratch_path(docs.sparkSession, "quality")
    texts = columns_as(docs, _id=doc_id, _text=text)
    marks = columns_as(labels, _id=label_id, _label=label).filter("_label IN (0, 1)")
    rows = labelled_sample(texts, marks, sample_rows, sample_bytes, work)
    by_label = {x: [r[2].encode() for r in rows if r[0] == x] for x in (0, 1)}
    if not (by_label[0] and by_label[1]):
        share = (len(by_label[1]) + 1) / (len(rows) + 2)
        return QualityModel(b" " * 16, b" " * 16, 0.0, float(np.log(share / (1 - share))))
    made = {x: _dictionary([t for i, t in enumerate(by_label[x]) if i % CALIBRATION or len(by_label[x]) < CALIBRATION]) for x in (0, 1)}
    model = QualityModel(made[1], made[0], 0.0, 0.0)
    held = {x: by_label[x][::CALIBRATION] for x in (0, 1)}
    # Classes are weighed as they occur among the labels, not as they were sampled.
    counts = {r["_label"]: r["count"] for r in marks.dropna().distinct().groupBy("_label").count().collect()}
    x = model.differences(texts_of(pa.array([t.decode() for k in (0, 1) for t in held[k]])), model.compressors())
    y = np.repeat([0.0, 1.0], [len(held[0]), len(held[1])])
    weight = np.repeat([counts[k] / len(held[k]) for k in (0, 1)], [len(held[0]), len(held[1])])
    model.slope, model.offset = _logistic(x, y, weight * len(y) / weight.sum())
    return model


def _dictionary(texts: list[bytes]) -> bytes:
    blocks = [t[i : i + BLOCK] for t in texts for i in range(0, len(t), BLOCK)]
    size = min(DICTIONARY, sum(map(len, blocks)) // 10)
    if size >= 1_024 and len(blocks) >= 16:
        try:
            return zstandard.train_dictionary(size, blocks, k=64, d=8, level=LEVEL).as_bytes()
        except zstandard.ZstdError:  # too little variety to train on
            pass
    return b"".join(blocks)[-DICTIONARY:].rjust(16)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton steps, with a weak prior that keeps separable classes finite."""
    scale = x.std() or 1.0
    design = np.stack([x / scale, np.ones_like(x)], axis=1)
    prior = np.diag([0.05, 1e-6])
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (weight * (y - p)) - prior @ beta
        hessian = (design * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ design + prior
        step = np.linalg.solve(hessian, gradient)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0] / scale), float(beta[1])


def quality_score(model: QualityModel, docs: DataFrame, text: str):
    """Score column (0 to 1) of a text column; null and empty texts get the score of no difference."""
    sent = Sent(docs.sparkSession, model)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = sent.get()
        compressors = model.compressors()
        for batch in batches:
            yield pa.array(model.scores(model.differences(texts_of(batch), compressors)))

    return score(F.col(text))


def drop_low_quality(docs: DataFrame, model: QualityModel, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, that score at least ``threshold``."""
    return docs.filter(quality_score(model, docs, text) >= threshold)
