"""Scientific-article XML: raw articles from collections, single files and archives."""

from __future__ import annotations

import re
import tarfile
from collections.abc import Iterator
from xml.etree import ElementTree

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from termspace.schemas import DOI_PATH, FILES, JATS_STYLE, TEXT_COLUMNS, article_schema, metadata_columns
from termspace.sources.streams import Broken, Stream, gunzipped, parted, pieces_of, tasks_can_open

ARTICLE_END = "</article>"
# Names that do not end in .gz, as a glob.
NOT_GZIP = "{*[!z],*[!g]z,*[!.]gz,z,gz}"
# Article text that is handed on at once.
BATCH_BYTES = 4 * 2**20
# Article text that is parsed at once.
PARSED_BYTES = 2**20


def read_article_collection(spark: SparkSession, path: str | list[str], spread: int | None = None) -> DataFrame:
    """(source_file, xml, broken): the articles of collection files, plain or compressed.

    Texts are parted after each closing tag, so a file is never held whole.
    Plain files are split among tasks; a gzip file is decompressed piece by piece
    by one task, and ``spread`` shuffles the articles to that many partitions
    before they are parsed. A gzip file that is cut or damaged gives every
    article before the break, then one row that says in ``broken`` where and why
    it breaks, with the open article as ``xml``. A read that fails fails the
    task, which is tried again.
    """
    first = path if isinstance(path, str) else path[0]
    return collection_articles(spark, spark.read, path, tasks_can_open(spark, first), spread)


def collection_articles(
    spark: SparkSession, reader: DataFrameReader | DataStreamReader, path: str | list[str], by_path: bool, spread: int | None = None
) -> DataFrame:
    """The articles below ``path`` by a batch or stream reader; ``by_path``: tasks open gzip files themselves."""
    plain = reader.option("lineSep", ARTICLE_END).option("pathGlobFilter", NOT_GZIP).format("text").load(path)
    plain = plain.select(
        F.col("_metadata.file_path").alias("source_file"),
        F.regexp_extract("value", r"(?s)<article[\s>].*", 0).alias("article"),
    ).filter("article <> ''")
    plain = plain.select("source_file", F.concat("article", F.lit(ARTICLE_END)).alias("xml"), F.lit(None).cast("string").alias("broken"))
    files = (spark.readStream if isinstance(reader, DataStreamReader) else spark.read).format("binaryFile").schema(FILES)
    files = files.option("pathGlobFilter", "*.gz").load(path)
    # Without the content Spark only lists the files.
    content = F.lit(None).cast("binary") if by_path else F.col("content")
    files = files.select(F.col("_metadata.file_path").alias("source_file"), "path", content.alias("content"))
    articles = plain.unionByName(files.mapInArrow(_gzip_articles, "source_file string, xml string, broken string"))
    return articles.repartition(spread) if spread else articles


def _gzip_articles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, path, content in zip(batch["source_file"].to_pylist(), batch["path"].to_pylist(), batch["content"]):
            pieces = iter([content.as_buffer().to_pybytes()]) if content.is_valid else pieces_of(path)
            rows, size, last = [], 0, None
            try:
                for article, closed in parted(gunzipped(pieces), rb"<article[\s>]", ARTICLE_END.encode()):
                    text = article.decode("utf-8", "replace")
                    if not closed:
                        last = text
                        continue
                    rows.append((name, text, None))
                    size += len(article)
                    if size > BATCH_BYTES:
                        yield _article_batch(rows)
                        rows, size = [], 0
                if last is not None:
                    rows.append((name, last + ARTICLE_END, None))
            except Broken as problem:
                rows.append((name, last, str(problem)))
            if rows:
                yield _article_batch(rows)


def _article_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(column, pa.string()) for column in zip(*rows)]
    return pa.RecordBatch.from_arrays(columns, ["source_file", "xml", "broken"])


def read_article_files(
    spark: SparkSession, path: str | list[str], compressed: str | None = None, spread: int | None = None
) -> DataFrame:
    """(source_file, xml, broken): one article per file, or per member of a ``tar.gz`` archive.

    Whatever stands before the line that begins with the article tag is dropped.
    A file without such a line has an empty ``xml``. An archive of any size is
    read piece by piece by one task that holds a member at a time; ``spread``
    shuffles the articles to that many partitions before they are parsed. An
    archive that is cut or damaged gives every member before the break, then one
    row that says in ``broken`` where and why it breaks. A read that fails fails
    the task, which is tried again.
    """
    first = path if isinstance(path, str) else path[0]
    return file_articles(spark.read.format("binaryFile").load(path), compressed, tasks_can_open(spark, first), spread)


def file_articles(files: DataFrame, compressed: str | None = None, by_path: bool = False, spread: int | None = None) -> DataFrame:
    """The articles of listed files; ``by_path``: tasks open archives themselves."""
    if compressed not in (None, "gz"):
        raise ValueError(f"compressed: gz or None, not {compressed!r}")
    texts = _archive_texts if compressed else _file_texts
    # Without the content Spark only lists the files.
    content = F.lit(None).cast("binary") if compressed and by_path else F.col("content")
    rows = files.select("path", content.alias("content")).mapInArrow(texts, "source_file string, xml string, broken string")
    return rows.repartition(spread) if spread else rows


def article_block(text: Column | str) -> Column:
    """The text from the line that begins with the article tag on."""
    return F.regexp_extract(text, r"(?ms)^<article.*", 0)


def _file_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [_block(_decoded(content.as_buffer().to_pybytes())) for content in batch["content"]]
        yield _article_batch([(path, text, None) for path, text in zip(batch["path"].to_pylist(), texts)])


def _archive_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch["path"].to_pylist(), batch["content"]):
            pieces = iter([content.as_buffer().to_pybytes()]) if content.is_valid else pieces_of(path)
            rows, size = [], 0
            try:
                for name, data in archive_members(gunzipped(pieces)):
                    rows.append((f"{path}!{name}", _block(_decoded(data)), None))
                    size += len(data)
                    if size > BATCH_BYTES:
                        yield _article_batch(rows)
                        rows, size = [], 0
            except (Broken, tarfile.TarError) as problem:
                rows.append((path, None, str(problem)))
            if rows:
                yield _article_batch(rows)


def _block(text: str) -> str:
    """As ``article_block``, where the text is read."""
    start = re.search(r"^<article", text, re.MULTILINE)
    return text[start.start() :] if start else ""


class _Member(tarfile.TarInfo):
    """A header that must be one: tar readers take a damaged header for the end of the archive."""

    @classmethod
    def fromtarfile(cls, archive: tarfile.TarFile) -> tarfile.TarInfo:
        try:
            return super().fromtarfile(archive)
        except (tarfile.InvalidHeaderError, tarfile.TruncatedHeaderError) as problem:
            raise tarfile.ReadError(str(problem)) from None


def archive_members(pieces: Iterator[bytes]) -> Iterator[tuple[str, bytes]]:
    """(name, data) of the files of a tar stream, in order. Raises at a break, after all members before it."""
    with tarfile.open(fileobj=Stream(pieces), mode="r|", tarinfo=_Member) as archive:
        while (member := archive.next()) is not None:
            # The archive would hold the headers of all members.
            archive.members = []
            if member.isfile():
                yield member.name, archive.extractfile(member).read()
    # What follows the last member must be whole too.
    for _ in pieces:
        pass


def _decoded(data: bytes) -> str:
    """Text by the encoding that the XML header declares, UTF-8 without one."""
    declared = re.search(rb"""encoding=["']([A-Za-z0-9._-]+)["']""", data[:1000])
    try:
        return data.decode(declared.group(1).decode() if declared else "utf-8", "replace")
    except LookupError:
        return data.decode("utf-8", "replace")


def extract_articles(
    df: DataFrame, style: dict[str, str] = JATS_STYLE, nested: str = "repeat", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Article rows from (source_file, xml): metadata by path, texts, and ``error``/``xml`` of bad input.

    A row whose column ``broken``, if there is one, is not null has that as its error.

    Each metadata column lists the texts of the elements its path finds; a path
    that cannot be evaluated gives null. The text columns join the paragraphs of
    body and abstract by a space. ``nested``: a paragraph inside a paragraph is
    repeated on its own ("repeat") or only stands in the outer one ("once").
    ``keep`` names columns of ``df`` to carry along. Each article is parsed once.
    """
    if nested not in ("repeat", "once"):
        raise ValueError(f"nested: repeat or once, not {nested!r}")
    names = [name for name in metadata_columns(style) if name != "doi"]
    paths = {name: style[name] for name in names}
    paths["doi"] = style.get("doi", DOI_PATH)
    fields = article_schema(style).fields
    extra = [T.StructField("error", T.StringType()), T.StructField("xml", T.StringType())]
    schema = T.StructType([df.schema[c] for c in keep] + fields + extra)
    columns = schema.fieldNames()
    lists = [f.name for f in schema.fields if f.name not in keep and isinstance(f.dataType, T.ArrayType)]

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _text_slices(batch, "xml"):
                texts = part["xml"].to_pylist()
                broken = part["broken"].to_pylist() if "broken" in part.schema.names else [None] * len(texts)
                rows = [article_values(xml, paths, nested, why) for xml, why in zip(texts, broken)]
                found = {name: part[name] for name in ("source_file", *keep)}
                for name in set(columns) - set(found):
                    kind = pa.list_(pa.string()) if name in lists else pa.string()
                    values = [xml if row["error"] is not None else None for xml, row in zip(texts, rows)] if name == "xml" else [row[name] for row in rows]
                    found[name] = pa.array(values, kind)
                yield pa.RecordBatch.from_arrays([found[name] for name in columns], columns)

    given = [c for c in ("broken",) if c in df.columns and c not in keep]
    return df.select("source_file", "xml", *given, *keep).mapInArrow(extract, schema)


def _text_slices(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """A batch in parts of about ``PARSED_BYTES`` of text; a longer text is a part of its own."""
    before = np.append(0, np.cumsum(pc.fill_null(pc.binary_length(batch[text]), 0).to_numpy().astype(np.int64)))
    first = 0
    while first < len(batch):
        last = max(first + 1, int(np.searchsorted(before, before[first] + PARSED_BYTES, side="right")) - 1)
        yield batch.slice(first, last - first)
        first = last


# Prefixes that XML reserves; they are not declared by a document.
_RESERVED_PREFIXES = {"xml", "xmlns"}


def _parse(xml: str) -> ElementTree.Element:
    """Element tree of one article; prefixes its collection declared are declared again."""
    # Most articles have no prefixes, which the marks alone tell soonest.
    marked = re.search(":[A-Za-z_]", xml)
    used = set(re.findall(r"[<\s]([A-Za-z_][A-Za-z0-9_.-]*):[A-Za-z_]", xml)) - _RESERVED_PREFIXES if marked else set()
    declared = "".join(f' xmlns:{prefix}="urn:{prefix}"' for prefix in sorted(used))
    return ElementTree.fromstring(f"<collection{declared}>{xml}</collection>")[0]


def article_values(xml: str | None, paths: dict[str, str], nested: str = "repeat", broken: str | None = None) -> dict:
    """Column values of one article, or its error, which ``broken`` is if given."""
    values = dict.fromkeys([*paths, *TEXT_COLUMNS, "error"])
    if broken is not None:
        return {**values, "error": broken}
    if not xml:
        return {**values, "error": "no article"}
    try:
        article = _parse(xml)
    except ElementTree.ParseError as problem:
        return {**values, "error": str(problem)}
    for name, path in paths.items():
        try:
            values[name] = [element.text for element in article.iterfind(path)]
        except (SyntaxError, KeyError):
            values[name] = None
    values["doi"] = next(iter(values["doi"] or []), None)
    values["fulltext"] = _paragraphs(article, ".//body//p", nested)
    values["abstract"] = _paragraphs(article, ".//abstract//p", nested)
    return values


def _paragraphs(article: ElementTree.Element, path: str, nested: str) -> str:
    found = list(article.iterfind(path))
    if nested == "once":
        inner = {p for outer in found for p in outer.iterfind(".//p")}
        found = [p for p in found if p not in inner]
    texts = ("".join(p.itertext()) for p in found)
    return " ".join(texts)


def split_quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(articles, quarantine): rows without and with an error."""
    good = df.filter(F.col("error").isNull()).drop("error", "xml")
    bad = df.filter(F.col("error").isNotNull()).select("source_file", "error", "xml")
    return good, bad
