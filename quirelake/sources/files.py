"""Reading files of documents from folders, and dispatching them to parsers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelake.functions import text as fx
from quirelake.operators.segments import text_segments
from quirelake.sources import ooxml

# The document type of each extension.
EXTENSIONS = {"pdf": "pdf", "docx": "docx", "doc": "docx", "xlsx": "xlsx", "xls": "xlsx", "pptx": "pptx", "ppt": "pptx", "txt": "txt", "md": "txt"}

Parser = Callable[[DataFrame], DataFrame]
_PARSERS: dict[str, Parser] = {}


def document_type(path: Column) -> Column:
    """The document type by extension; ``unknown`` for others."""
    table = F.create_map(*(F.lit(x) for pair in EXTENSIONS.items() for x in pair))
    return F.coalesce(F.try_element_at(table, F.lower(F.regexp_extract(path, r"\.([^./\\]+)$", 1))), F.lit("unknown"))


def scan(spark: SparkSession, folder: str, pattern: str = "*", recursive: bool = True) -> DataFrame:
    """``(document_id, source_path, document_type, title, file_size, modified_at, content)`` of the readable documents below a folder.

    Files whose name begins with a dot and files of other types are left out
    before their bytes are read. ``document_id`` is the MD5 of the path.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).option("pathGlobFilter", pattern).load(folder)
    return _described(files)


def read_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """As ``scan`` for listed paths; those that do not exist are left out."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found = [p for p in paths if (path := hadoop.Path(p)).getFileSystem(conf).exists(path)]
    if not found:
        return _described(spark.createDataFrame([], "path string, modificationTime timestamp, length bigint, content binary"))
    return _described(spark.read.format("binaryFile").load(found))


def check_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``(path, error)`` of listed paths: null for a file that can be read, else what is wrong with it."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    rows = []
    for text in paths:
        path = hadoop.Path(text)
        system = path.getFileSystem(conf)
        if not system.exists(path):
            error = "no such file"
        elif not system.getFileStatus(path).isFile():
            error = "not a file"
        else:
            try:
                system.open(path).close()
                error = None
            except Exception as raised:
                error = f"cannot be read: {type(raised).__name__}"
        rows.append((text, error))
    return spark.createDataFrame(rows, "path string, error string")


def in_order(files: DataFrame) -> DataFrame:
    """``files`` in the order of their paths, by a range partition rather than in one place."""
    return files.orderBy("source_path")


def _described(files: DataFrame) -> DataFrame:
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    rows = files.where(~F.startswith(name, F.lit(".")) & (document_type(F.col("path")) != "unknown"))
    return rows.select(
        F.md5("path").alias("document_id"), F.col("path").alias("source_path"), document_type(F.col("path")).alias("document_type"), F.regexp_extract(name, r"^(.*)\.[^.]*$", 1).alias("title"),
        F.col("length").alias("file_size"), F.col("modificationTime").alias("modified_at"), "content",
    )


def text_metadata(files: DataFrame) -> DataFrame:
    """``files`` of text with ``text``, ``page_count`` (3000 characters each, at least 1) and the title by the first line."""
    text = F.decode("content", "UTF-8")
    first = fx.strip(F.element_at(F.split(text, "\n"), 1))
    title = F.when(F.startswith(first, F.lit("#")) | ((F.length(first) < 100) & (first != "")), fx.strip(F.ltrim(first, F.lit("#")))).otherwise(F.col("title"))
    return files.withColumns({"text": text, "page_count": F.greatest(F.lit(1), F.floor(F.length(text) / 3000).cast("int")), "title": title})


def parse_text(files: DataFrame) -> DataFrame:
    """Segments of text and Markdown files."""
    rows = text_segments(text_metadata(files), "document_id", "text")
    return rows.select("document_id", "segment_index", F.lit(1).alias("page_number"), F.lit("text").alias("segment_type"), "segment_subtype", "content")


def register(kind: str, parser: Parser) -> None:
    """Registers the parser ``files -> segments`` of a document type, in place of one registered before."""
    _PARSERS[kind] = parser


def unregister(kind: str) -> None:
    _PARSERS.pop(kind, None)


def parse(files: DataFrame) -> DataFrame:
    """Segments of all files by the registered parser of their type; files of types without parser give none."""
    out = None
    for kind, parser in sorted(_PARSERS.items()):
        segments = parser(files.where(F.col("document_type") == kind))
        out = segments if out is None else out.unionByName(segments)
    if out is None:
        raise ValueError("no parser is registered")
    return out


register("txt", parse_text)
register("docx", ooxml.parse_docx)
register("xlsx", ooxml.parse_xlsx)
register("pptx", ooxml.parse_pptx)
