"""Language of a text by prediction by partial matching.

Per language, byte contexts of up to three bytes with the counts of what
followed them. A byte is coded in the longest context that is known; a context
that has not seen it codes an escape, at the cost of its novelty, and hands on
to the next shorter one, in the end to equal chances. The language with the
shortest code for the whole text wins. Statistics stay as they were learned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termspace.llm.common import Sent, columns_as, sums_of, text_bytes, texts_of
from termspace.llm.labelled import labelled_sample
from termspace.session import scratch_path

# Bound of the labelled sample, for each language.
SAMPLE_ROWS = 1_000
SAMPLE_BYTES = 2 * 2**20
ORDER = 3
UNKNOWN = "und"
# Bytes that are coded at a time, whatever texts they are of.
_SLICE_BYTES = 2 * 2**20


def byte_codes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per byte the byte itself and the three before it in its text, as one number; zeros before the text.

    ``offsets`` may begin before ``data`` and end after it.
    """
    lowered = np.where((data >= 0x41) & (data <= 0x5A), data + 0x20, data).astype(np.uint32)
    codes = lowered.copy()
    for back in range(1, ORDER + 1):
        shifted = np.zeros_like(lowered)
        shifted[back:] = lowered[:-back] if back < len(lowered) else lowered[:0]
        # What stands before a text's beginning is another text's.
        for place in range(back):
            at = offsets[:-1] + place
            shifted[at[(at >= 0) & (at < np.minimum(offsets[1:], len(data)))]] = 0
        codes |= shifted << np.uint32(8 * back)
    return codes


@dataclass
class ContextTree:
    """Of each order: known (context, byte) codes with counts, contexts with totals and number of followers."""

    orders: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]

    @classmethod
    def learn(cls, texts: pa.Array) -> ContextTree:
        codes, counts = np.unique(byte_codes(*text_bytes(texts)), return_counts=True)
        orders = []
        for order in range(ORDER + 1):
            mask = np.uint32((1 << (8 * (order + 1))) - 1)
            seen, back = np.unique(codes & mask, return_inverse=True)
            n = np.bincount(back, weights=counts, minlength=len(seen))
            contexts, back = np.unique(seen >> np.uint32(8), return_inverse=True)
            total = np.bincount(back, weights=n, minlength=len(contexts))
            orders.append((seen, n, contexts, total, np.bincount(back, minlength=len(contexts)).astype(float)))
        return cls(orders)

    def bits(self, codes: np.ndarray) -> np.ndarray:
        """Code length of each code's last byte after its first three."""
        spent = np.zeros(len(codes))
        open_ = np.arange(len(codes))
        for order in range(ORDER, -1, -1):
            seen, n, contexts, total, followers = self.orders[order]
            mask = np.uint32((1 << (8 * (order + 1))) - 1)
            code = codes[open_] & mask
            at, context_known = _find(contexts, code >> np.uint32(8))
            place, known = _find(seen, code)
            room = total[at] + followers[at]
            spent[open_[known]] -= np.log2(n[place[known]] / room[known])
            escape = context_known & ~known
            spent[open_[escape]] -= np.log2(followers[at[escape]] / room[escape])
            open_ = open_[~known]
        spent[open_] += 8.0
        return spent


def _find(sorted_values: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(sorted_values, values), len(sorted_values) - 1)
    return at, sorted_values[at] == values


@dataclass
class LanguageModel:
    """A context tree per language, languages in order of their names."""

    languages: list[str]
    trees: list[ContextTree]

    def code_lengths(self, texts: pa.Array) -> np.ndarray:
        """Bits of each whole text (rows) in each language (columns); a text may span several slices."""
        data, offsets = text_bytes(texts)
        spent = np.zeros((len(texts), len(self.languages)))
        for low in range(0, len(data), _SLICE_BYTES):
            high, before = min(len(data), low + _SLICE_BYTES), min(low, ORDER)
            # The texts with a byte in the slice.
            first = int(np.searchsorted(offsets, low, side="right")) - 1
            last = int(np.searchsorted(offsets, high, side="left"))
            bounds = offsets[first : last + 1]
            codes = byte_codes(data[low - before : high], bounds - (low - before))[before:]
            codes = pa.array(codes).dictionary_encode()
            distinct, place = codes.dictionary.to_numpy(), codes.indices.to_numpy()
            inside = np.clip(bounds, low, high) - low
            for column, tree in enumerate(self.trees):
                spent[first:last, column] += sums_of(tree.bits(distinct)[place], inside)
        return spent


def fit_languages(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    sample_rows: int = SAMPLE_ROWS,
    sample_bytes: int = SAMPLE_BYTES,
    work: str | None = None,
) -> LanguageModel:
    """Context trees of every language among the rows of ``docs``.

    Each is learned from at most ``sample_rows`` whole texts and ``sample_bytes``
    bytes, so a tree has at most that many entries per order. Rows without
    language or id, and null or empty texts, teach nothing.
    """
    work = work or scratch_path(docs.sparkSession, "language")
    texts = columns_as(docs, _id=doc_id, _text=text, _label=lang)
    rows = labelled_sample(texts, None, sample_rows, sample_bytes, work)
    languages = sorted({r[0] for r in rows})
    trees = [ContextTree.learn(texts_of(pa.array([r[2] for r in rows if r[0] == x]))) for x in languages]
    return LanguageModel(languages, trees)


def language_of(model: LanguageModel, docs: DataFrame, text: str = "text") -> Column:
    """struct<lang, score> of a text column.

    ``score`` is the chance of the language among the learned ones, by the code
    lengths of the whole text. A null text, one without letters, and any text if
    nothing was learned, is ``und`` with score 0. Equal lengths: first by name.
    """
    sent = Sent(docs.sparkSession, model)

    @F.pandas_udf("lang string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = sent.get()
        names = np.array(model.languages, dtype=object)
        for batch in batches:
            texts = texts_of(pa.Array.from_pandas(batch, type=pa.large_string()))
            letters = pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False)
            if not len(names):
                yield pd.DataFrame({"lang": [UNKNOWN] * len(texts), "score": np.zeros(len(texts))})
                continue
            lengths = model.code_lengths(texts)
            best = lengths.argmin(axis=1)
            chances = np.exp2(-np.clip(lengths - lengths.min(axis=1, keepdims=True), 0, 1_000))
            score = 1.0 / chances.sum(axis=1)
            yield pd.DataFrame({"lang": np.where(letters, names[best], UNKNOWN), "score": np.where(letters, score, 0.0)})

    return predict(F.col(text))
