"""Delimited text: encoding probe, delimiter sniffing, and scans that keep every column a string."""

from __future__ import annotations

import codecs
import csv
import fnmatch
import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators.state import durable

#: Files up to this size have their digest made from one cell; larger ones are streamed.
WHOLE_BYTES = 256 << 20
DELIMITERS = ",;\t|"
SNIFFED = 8192


def head(spark: SparkSession, path: str, length: int = SNIFFED) -> bytes:
    """The first bytes of one file, wherever Spark can read it."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    stream = place.getFileSystem(conf).open(place)
    try:
        limited = jvm.org.apache.commons.io.IOUtils.toByteArray(jvm.org.apache.commons.io.input.BoundedInputStream(stream, length))
        return bytes(limited)
    finally:
        stream.close()


def detect_delimiter(text: str) -> str:
    """The sniffed delimiter among the known ones; a comma where none can be told."""
    try:
        return csv.Sniffer().sniff(text, delimiters=DELIMITERS).delimiter
    except csv.Error:
        return ","


def plain_path(uri: Column | str) -> Column:
    """A file's path as the listing names it, from the URI that a scan gives for it."""
    decoded = F.url_decode(F.regexp_replace(uri, "\\+", "%2B"))
    return F.regexp_replace(decoded, "^([a-z0-9]+):/{2,}(?=/)", "$1:")


def lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(uri, size, block, at, line): the lines of files between line feeds, untouched, read in splits; at runs on within a block."""
    read = spark.read.text(paths, lineSep="\n")
    meta = F.col("_metadata")
    return read.select(meta["file_path"].alias("uri"), meta["file_size"].alias("size"), meta["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))


def probe(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(uri, file_path, utf8, split, header): one row a file that has a line, from one pass over all of them in splits.

    utf8: whether all of it can be decoded; a line feed is part of no longer sequence, so lines can be tried one by one.
    split: whether its records can be told apart line by line. A line break stands within quotes only if some line has an odd
    number of them before it; a file without such a line, a lone carriage return, a line of blanks or an empty first line
    is read alike in splits and as a whole.
    """
    each, line = lines(spark, paths), F.col("line")
    quotes = F.octet_length("line") - F.octet_length(F.replace("line", F.lit('"'), F.lit("")))
    turn = F.instr(line, "\r")
    odd = (quotes % 2 == 1) | ((turn > 0) & (turn < F.length("line"))) | ((F.trim(F.rtrim(line, F.lit("\r"))) == "") & ~line.isin("", "\r"))
    first = F.min_by("line", F.struct("block", "at"))
    told = each.groupBy("uri").agg(F.bool_and(F.is_valid_utf8("line")).alias("utf8"), (~F.bool_or(odd)).alias("split"), first.cast("binary").alias("header"))
    fair = ~F.hex("header").isin("", "0D")
    return told.select("uri", plain_path("uri").alias("file_path"), "utf8", (F.col("split") & fair).alias("split"), "header")


def digests(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file_path, sha256, size) of each file, as the listing names it.

    Up to WHOLE_BYTES a file is one cell. Of a larger one the lines are sent to one task in their order, which reads
    them as a stream and keeps none: the digest is of one run of bytes, and files differ in their tasks.
    """
    listed = spark.read.format("binaryFile").load(paths)
    small = listed.where(F.col("length") <= WHOLE_BYTES).select(F.col("path").alias("file_path"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("size"))
    large = [r.path for r in listed.where(F.col("length") > WHOLE_BYTES).select("path").collect()]
    if not large:
        return small

    marks = {path: mark for path in large if (mark := head(spark, path, 3)) == codecs.BOM_UTF8}  # scans leave them out

    def run(batches):
        path, digest, size, left = None, None, 0, 0
        for batch in batches:
            for r in zip(*(batch.column(c).to_pylist() for c in ("file_path", "size", "line")), strict=True):
                if r[0] != path:
                    if path is not None:
                        yield _digest_row(path, digest, size, left)
                    path, size, mark = r[0], r[1], marks.get(r[0], b"")
                    digest, left = hashlib.sha256(mark), size - len(mark)
                else:
                    digest.update(b"\n")
                    left -= 1
                digest.update(r[2])
                left -= len(r[2])
        if path is not None:
            yield _digest_row(path, digest, size, left)

    ordered = lines(spark, large).withColumns({"line": F.col("line").cast("binary"), "file_path": plain_path("uri")}).repartition(len(large), "file_path").sortWithinPartitions("file_path", "block", "at")
    return small.unionByName(ordered.select("file_path", "size", "line").mapInArrow(run, "file_path string, sha256 string, size long"))


def _digest_row(path: str, digest, size: int, left: int) -> pa.RecordBatch:
    if left:  # the line feed at the end
        digest.update(b"\n")
    return pa.RecordBatch.from_pydict({"file_path": [path], "sha256": [digest.hexdigest()], "size": [size]})


def is_encoded(spark: SparkSession, path: str, encoding: str = "utf-8") -> bool:
    """Whether all of a file can be decoded, tested where the file is read: UTF-8 line by line, others as a whole."""
    from pyspark.sql.types import BooleanType

    if encoding.lower().replace("-", "") == "utf8":
        return lines(spark, [path]).where(~F.is_valid_utf8("line")).isEmpty()

    @F.udf(BooleanType())
    def decodes(content):
        try:
            bytes(content).decode(encoding)
        except UnicodeDecodeError:
            return False
        return True

    return spark.read.format("binaryFile").load(path).where(~decodes("content")).limit(1).count() == 0


@dataclass(frozen=True)
class Layout:
    """What files have to have in common to be read by one scan."""

    header: bytes
    delimiter: str
    encoding: str
    split: bool


def layouts(spark: SparkSession, paths: list[str], delimiter: str | None = ",", encoding: str = "utf-8") -> dict[Layout, list[tuple[str, str]]]:
    """(path, uri) of the files by layout. A file that isn't in the encoding asked for is latin-1; without a delimiter it's sniffed from the file's beginning."""
    out: dict[Layout, list[tuple[str, str]]] = {}
    for r in probe(spark, paths).orderBy("file_path").collect():  # one row a file
        own = encoding if (r.utf8 if encoding.lower().replace("-", "") == "utf8" else is_encoded(spark, r.file_path, encoding)) else "latin-1"
        sep = delimiter or detect_delimiter(head(spark, r.file_path).decode(own, "replace"))
        out.setdefault(Layout(bytes(r.header).rstrip(b"\r"), sep, own, r.split), []).append((r.file_path, r.uri))
    return out


def read_layout(spark: SparkSession, layout: Layout, paths: list[str]) -> DataFrame:
    """All columns as strings, with _file and _row_number (from 1, in the order of each file) added.

    Quoted fields may hold delimiters and line breaks; files with breaks are read a task each, others in splits.
    """
    encoding = "ISO-8859-1" if layout.encoding == "latin-1" else layout.encoding
    return numbered(spark.read.csv(paths, header=True, sep=layout.delimiter, encoding=encoding, inferSchema=False, multiLine=not layout.split, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False))


def load_csv(spark: SparkSession, path: str, delimiter: str | None = ",", encoding: str = "utf-8") -> DataFrame:
    """One file, as read_layout() reads it; see layouts() for its encoding and delimiter."""
    ((layout, _),) = layouts(spark, [path], delimiter, encoding).items() or [(Layout(b"", delimiter or ",", encoding, False), [])]
    return read_layout(spark, layout, [path])


def numbered(rows: DataFrame) -> DataFrame:
    """Rows of a scan numbered from 1 within each file, in the file's order: by their place in a block, and the rows of the blocks before."""
    placed = durable(rows.withColumns({"_file": F.col("_metadata.file_path"), "_block": F.col("_metadata.file_block_start"), "_at": F.monotonically_increasing_id()}))
    blocks = placed.groupBy("_file", "_block").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    shifts = blocks.select("_file", "_block", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift"))
    out = placed.join(shifts, ["_file", "_block"]).withColumn("_row_number", F.col("_at") + F.col("_shift"))
    return out.select(*[F.col(f"`{c}`") for c in rows.columns], "_file", "_row_number")


# The delimiters of the sources that come as delimited files.
SOURCE_DELIMITERS = {"SCIMAGO": ";", "ABS": ",", "REPEC": ",", "FT50": ","}


def read_scimago_csv(spark: SparkSession, path: str) -> DataFrame:
    return load_csv(spark, path, SOURCE_DELIMITERS["SCIMAGO"])


def read_abs_csv(spark: SparkSession, path: str) -> DataFrame:
    return load_csv(spark, path, SOURCE_DELIMITERS["ABS"])


def read_repec_csv(spark: SparkSession, path: str) -> DataFrame:
    return load_csv(spark, path, SOURCE_DELIMITERS["REPEC"])


# The columns of this file, in their order.
FT50_COLUMNS = ["rank", "journal_name", "ft50_year"]


def read_ft50_csv(spark: SparkSession, path: str) -> DataFrame:
    return require_ft50(load_csv(spark, path, SOURCE_DELIMITERS["FT50"]))


def require_ft50(rows: DataFrame) -> DataFrame:
    found = [c for c in rows.columns if not c.startswith("_")]
    if found != FT50_COLUMNS:
        raise ValueError(f"the columns have to be {FT50_COLUMNS}, they are {found}")
    return rows


#: `scimagojr <year>  Subject Area - <area>.csv`, whatever the case; other names are no such file.
SCIMAGO_NAME = "(?i)^scimagojr\\s+([0-9]{4})\\s+Subject Area\\s*-\\s*(.+)\\.csv$"


def parse_file_name(name) -> dict[str, F.Column]:
    """year and subject_area from a file's name, both null for another kind of name; %20 in a path counts as a space."""
    base = F.url_decode(F.regexp_replace(F.element_at(F.split(name, "/"), -1), "\\+", "%2B"))
    area = F.trim(F.regexp_extract(base, SCIMAGO_NAME, 2))
    return {"year": F.regexp_extract(base, SCIMAGO_NAME, 1).try_cast("int"), "subject_area": S.or_null(area)}


def empty_files(spark: SparkSession, paths: list[str]) -> list[str]:
    """Those of the paths that are files without a byte, which no scan shows, as the listing would name them."""
    make, conf, out = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration(), []
    for path in paths:
        fs = make(path).getFileSystem(conf)
        if fs.exists(make(path)) and (status := fs.getFileStatus(make(path))).isFile() and not status.getLen():
            out.append(status.getPath().toString())
    return out


def discover(spark: SparkSession, folder: str, pattern: str = "*.csv") -> list[str]:
    """Paths below a folder whose name fits, sorted."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(folder)
    files, out = place.getFileSystem(conf).listFiles(place, True), []
    while files.hasNext():
        path = files.next().getPath()
        if fnmatch.fnmatch(path.getName(), pattern):
            out.append(path.toString())
    return sorted(out)


def require_columns(rows: DataFrame, needed) -> DataFrame:
    """rows, if it has all the columns; more are allowed."""
    if missing := sorted(set(needed) - set(rows.columns)):
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return rows


# The columns of an exported review queue that decisions need.
REVIEW_COLUMNS = ("candidate_id", "source", "source_record_id", "candidate_journal_id", "decision")


def read_review_csv(spark: SparkSession, path: str) -> DataFrame:
    return require_columns(load_csv(spark, path), REVIEW_COLUMNS)


def read_conflict_csv(spark: SparkSession, path: str) -> DataFrame:
    """(identifier, journal_ids, message) from either form of the conflict report: listed ids, or a message that names them."""
    rows = load_csv(spark, path)
    column = lambda *names: S.first_non_empty(names, rows.columns)
    return rows.select(column("normalized_issn", "identifier", "issn").alias("identifier"), S.journal_ids_of(column("journal_ids"), column("message", "conflict")).alias("journal_ids"), column("message", "conflict").alias("message"))
