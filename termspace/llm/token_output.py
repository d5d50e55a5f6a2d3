"""Token ids as flat binary files, in order of the documents.

A folder holds, for each part in order, three files: ``.tokens`` (little-endian
unsigned integers, 16 bits if the vocabulary allows, else 32), ``.offsets``
(unsigned 64-bit: where each document begins in the part, and the end), and
``.ids`` (signed 64-bit document ids). The table ``manifest`` lists the parts
with their base: the number of tokens in the parts before, so that base plus
offset is a document's place in the whole.
"""

from __future__ import annotations

import string
import sys
import types
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from termspace.llm.common import bounded_slices, columns_as, text_bytes, texts_of

_SLICE_BYTES = 4 * 2**20
_READ_TOKENS = 4 * 2**20
_BATCH = 1_000
# Encoded words that a worker remembers between slices and tasks; more are encoded anew each time.
_REMEMBERED = 200_000
_WORKER = "termspace_token_encoders"
# Stands for a null id in the ``.ids`` files.
NULL_ID = -(2**63)

_MANIFEST = "part int, name string, width int, docs long, tokens long"


class Encoder:
    """Token ids of whole texts; each distinct word of a slice is encoded once.

    Fit for tokenizers that drop white space and never join what it parts, as
    those of ``word_bpe_49k.json``: a text's ids are those of its words in turn.
    """

    # A run of these after a letter or digit is a piece of its own: the pattern
    # that parts words ends there. Not the apostrophe, which begins suffixes, nor
    # the end of a special token's name.
    _MARKS = "".join(c for c in string.punctuation if c not in "'>")
    # Letters that stay one character each when lower-cased, and are not normalised further.
    _LATIN = "À-ÖØ-öø-ÿ"
    # Never parted: the merges alone decide the ids.
    _PLAIN = rf"^[a-z{_LATIN}]+\z"
    _LETTER_OR_DIGIT_LAST = rf"[A-Za-z0-9{_LATIN}]\z"

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.end_id = end_id
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.width = 2 if max(size, end_id + 1) <= 2**16 else 4
        # How the merges spell letters beyond a-z, which they know as bytes.
        spelt = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.spelling = {c: spelt(chr(c).lower())[0][0] for c in range(0xC0, 0x100) if chr(c).isalpha()}
        # Remembered pieces, their ids one after the other, and the number of ids of each.
        self.known = pa.array([], pa.large_string())
        self.known_ids, self.known_n = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    @classmethod
    def of_worker(cls, path: str, end_id: int) -> Encoder:
        """The worker process's own encoder, which outlives a task with what it remembers."""
        kept = sys.modules.setdefault(_WORKER, types.ModuleType(_WORKER)).__dict__
        if (path, end_id) not in kept:
            kept[path, end_id] = cls(path, end_id)
        return kept[path, end_id]

    def _parts(self, words: pa.Array) -> tuple[pa.Array, pa.Array]:
        """Each word as two pieces that are encoded apart; the second may be empty."""
        head = pc.ascii_rtrim(words, characters=self._MARKS)
        whole = pc.or_(pc.match_substring(words, "<"), pc.invert(pc.match_substring_regex(head, self._LETTER_OR_DIGIT_LAST)))
        cut = pc.subtract(pc.binary_length(words), pc.binary_length(head)).to_numpy()
        cut = np.where(whole.to_numpy(zero_copy_only=False), 0, cut)
        tail = np.full(len(words), "", dtype=object)
        for n in np.unique(cut[cut > 0]).tolist():
            same = np.flatnonzero(cut == n)
            tail[same] = pc.utf8_slice_codeunits(words.take(pa.array(same)), start=-n).to_pylist()
        return pc.if_else(whole, words, pc.ascii_lower(head)), pa.array(tail, pa.large_string())

    def _encoded(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces in turn, number of ids of each)."""
        place = pc.index_in(pieces, value_set=self.known)
        new = np.flatnonzero(place.is_null().to_numpy(zero_copy_only=False))
        fresh = pieces.take(pa.array(new))
        plain = pc.match_substring_regex(fresh, self._PLAIN).to_numpy(zero_copy_only=False)
        plain, rest = np.flatnonzero(plain), np.flatnonzero(~plain)
        merge = self.tokenizer.model.tokenize
        words = fresh.take(pa.array(plain)).to_pylist()
        spelt = (word if word.isascii() else word.translate(self.spelling) for word in words)
        found = [[token.id for token in merge(word)] for word in spelt]
        for first in range(0, len(rest), _BATCH):
            words = fresh.take(pa.array(rest[first : first + _BATCH])).to_pylist()
            found += [coded.ids for coded in self.tokenizer.encode_batch(words, add_special_tokens=False)]
        order = np.concatenate([plain, rest])
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        ids = np.fromiter(chain.from_iterable(found), dtype=np.uint32, count=int(sizes.sum()))
        # Behind the remembered pieces stand the new ones, in the order in which they were encoded.
        all_ids, all_n = np.concatenate([self.known_ids, ids]), np.concatenate([self.known_n, sizes])
        asked = place.fill_null(0).to_numpy().astype(np.int64)
        asked[new[order]] = len(self.known) + np.arange(len(order))
        room = _REMEMBERED - len(self.known)
        if room > 0 and len(order):
            self.known = pa.concat_arrays([self.known, fresh.take(pa.array(order[:room]))])
            self.known_n = all_n[: len(self.known)].copy()
            self.known_ids = all_ids[: int(self.known_n.sum())].copy()
        return _taken(all_ids, all_n, asked), all_n[asked]

    def encode(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, ids per text, the end id included) of consecutive slices of the texts."""
        _, offsets = text_bytes(texts)
        for first, last in bounded_slices(offsets, _SLICE_BYTES):
            words = pc.ascii_split_whitespace(texts[first:last])
            bounds = np.asarray(words.offsets, dtype=np.int64)
            coded = words.flatten().dictionary_encode()
            # White space at either end of a text gives an empty word, which has no ids.
            n_words = len(coded.dictionary)
            pieces = pa.concat_arrays(self._parts(coded.dictionary)).dictionary_encode()
            ids, n = self._encoded(pieces.dictionary)
            # Ids of each distinct word, then those of all words.
            asked = pieces.indices.to_numpy().reshape(2, n_words).T
            ids, n = _taken(ids, n, asked.ravel()), n[asked].sum(axis=1)
            place = coded.indices.to_numpy()
            found = _taken(ids, n, place)
            upto = np.concatenate([np.zeros(1, np.int64), np.cumsum(n[place])])
            ends = upto[bounds[1:] - bounds[0]]
            yield np.insert(found, ends, self.end_id), np.diff(ends, prepend=0) + 1


def _taken(ids: np.ndarray, n: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """The ids of the asked entries in turn; ``n`` is the number of ids of each entry."""
    n_asked = n[asked]
    ends = np.cumsum(n_asked)
    # Where each entry's ids stand, minus where they go.
    shift = (np.cumsum(n) - n)[asked] - (ends - n_asked)
    return ids[np.repeat(shift, n_asked) + np.arange(n_asked.sum())]


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def write_tokens(
    docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Encode every whole text, end it with ``end_id``, and write the files; gives the manifest.

    Documents stand in ascending order of their id, those without one first;
    rows of one id in order of their texts. Null and empty texts are the end id
    alone. An empty table gives no parts. Only id and text are read. ``folder``
    must be one that all executors reach.

    Rows are range-partitioned by id and each part is written by one task,
    slice by slice. File names carry a token of the attempt and the manifest
    lists those of the attempts that succeeded, so a repeated task harms nothing.
    """
    given = columns_as(docs, _id=doc_id, _text=text).withColumn("_id", F.col("_id").cast("long"))
    ordered = given.repartitionByRange("_id").sortWithinPartitions("_id", "_text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encoder, files = None, []
        docs = tokens = 0
        name = f"part-{part:06d}-{uuid.uuid4().hex}"
        for batch in batches:
            if not batch.num_rows:
                continue
            if encoder is None:
                encoder = Encoder.of_worker(tokenizer_path, end_id)
                system, path = _open(folder)
                system.create_dir(path, recursive=True)
                files = [system.open_output_stream(f"{path}/{name}.{kind}") for kind in ("tokens", "offsets", "ids")]
            for ids, sizes in encoder.encode(texts_of(batch.column(1))):
                files[0].write(ids.astype(f"<u{encoder.width}").tobytes())
                files[1].write((tokens + np.cumsum(sizes) - sizes).astype("<u8").tobytes())
                tokens += int(sizes.sum())
            files[2].write(pc.fill_null(batch.column(0), NULL_ID).to_numpy().astype("<i8").tobytes())
            docs += batch.num_rows
        if encoder is None:
            return
        files[1].write(np.array([tokens], dtype="<u8").tobytes())
        for file in files:
            file.close()
        row = {"part": [part], "name": [name], "width": [encoder.width], "docs": [docs], "tokens": [tokens]}
        types = [("part", pa.int32()), ("name", pa.string()), ("width", pa.int32()), ("docs", pa.int64()), ("tokens", pa.int64())]
        yield pa.RecordBatch.from_pydict(row, schema=pa.schema(types))

    spark = docs.sparkSession
    ordered.mapInArrow(write, _MANIFEST).write.parquet(f"{folder}/parts")
    parts = spark.read.schema(_MANIFEST).parquet(f"{folder}/parts")
    # One row per file.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    based = parts.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    based.write.parquet(f"{folder}/manifest")
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(f"{_MANIFEST}, base long").parquet(f"{folder}/manifest")


def _mapped(system: fs.FileSystem, path: str, kind: str) -> np.ndarray:
    """A file as numbers: memory-mapped where it is local."""
    local = isinstance(system, fs.LocalFileSystem)
    with pa.memory_map(path) if local else system.open_input_file(path) as file:
        return np.frombuffer(file.read_buffer(), dtype=kind)


def read_documents(spark: SparkSession, folder: str, doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files.

    ``start`` counts the ids of all documents before; the checksum is of the
    document's ids as little-endian unsigned 32-bit integers. One task per part.
    """
    manifest = read_manifest(spark, folder)
    schema = f"{doc_id} long, start long, n_tokens long, ids_crc32 long"
    types = [(doc_id, pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, path = _open(folder)
                file = f"{path}/{row['name']}"
                tokens = _mapped(system, f"{file}.tokens", f"<u{row['width']}")
                offsets = _mapped(system, f"{file}.offsets", "<u8").astype(np.int64)
                ids = _mapped(system, f"{file}.ids", "<i8")
                for first, last in bounded_slices(offsets, _READ_TOKENS):
                    part = tokens[offsets[first] : offsets[last]].astype("<u4").tobytes()
                    at = ((offsets[first : last + 1] - offsets[first]) * 4).tolist()
                    crc = [zlib.crc32(part[a:b]) for a, b in zip(at[:-1], at[1:])]
                    found = pa.array(ids[first:last], mask=ids[first:last] == NULL_ID)
                    start, size = row["base"] + offsets[first:last], np.diff(offsets[first : last + 1])
                    columns = [found, pa.array(start), pa.array(size), pa.array(crc, pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(types))

    parts = max(1, manifest.count())
    return manifest.repartition(parts, "part").mapInArrow(read, schema)
