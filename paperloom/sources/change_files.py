"""Citation change files (gzipped XML) as change rows, batch or stream.

A gzip file is read by one task; records are cut at their end tag, so a task
holds one record at a time. One scan gives both the articles and the deletes.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.functions import xml
from paperloom.schemas import ARTICLE_COLUMNS

FILE_GLOB = "*.xml.gz"
# Compressed bytes of the files that one micro-batch takes unless a number of files is asked for.
BATCH_BYTES = 512 << 20


def list_change_files(spark: SparkSession, folder: str) -> DataFrame:
    """Change files of a folder in the order they apply."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", FILE_GLOB).load(folder)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "length").orderBy(
        "file_name"
    )


def read_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """``file_name, pos, chunk``: text up to the end of each record."""
    reader = spark.read.option("lineSep", xml.RECORD_END).option("pathGlobFilter", FILE_GLOB)
    return number_chunks(reader.text(folder).select("value", "_metadata.file_name"))


def read_text_stream(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """``value, file_name`` of new files; ``number_chunks`` runs per micro-batch.

    A micro-batch has a cost of its own, so by default it takes files by their size:
    many small ones, or a few large ones.
    """
    reader = spark.readStream.option("lineSep", xml.RECORD_END).option("pathGlobFilter", FILE_GLOB)
    if files_per_batch is None:
        reader = reader.option("maxBytesPerTrigger", str(BATCH_BYTES))
    else:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(folder).select("value", "_metadata.file_name")


def number_chunks(text: DataFrame) -> DataFrame:
    # Ids grow within a task, and a gzip file is never split between tasks.
    return text.select(
        "file_name",
        F.monotonically_increasing_id().alias("pos"),
        xml.clean_record(F.col("value")).alias("chunk"),
    )


def record_of_chunk(chunk: Column) -> Column:
    """The article record a chunk ends with, NULL when it has none."""
    pieces = F.split(chunk, xml.RECORD_START_PATTERN)
    return F.when(F.size(pieces) > 1, F.concat(F.lit(xml.RECORD_START), F.element_at(pieces, -1)))


def parse_articles(chunks: DataFrame, text_mode: str = "leading") -> DataFrame:
    """Article rows of the kept version, with ``file_name``, ``pos`` and ``error``."""
    records = chunks.select("file_name", "pos", record_of_chunk(F.col("chunk")).alias("record"))
    parsed = xml.with_article_columns(records.filter(F.col("record").isNotNull()), text_mode)
    return parsed.filter(_kept()).select(
        "pmid", "file_name", F.lit(0).alias("is_delete"), "pos", *ARTICLE_COLUMNS, "error"
    )


def _kept() -> Column:
    """The kept version; records without an id stay in to be reported."""
    return (F.col("version") == xml.KEPT_VERSION) | F.col("pmid").isNull()


def parse_deletes(chunks: DataFrame, first_only: bool = False) -> DataFrame:
    """One row per deleted id."""
    found = chunks.filter(F.col("chunk").contains("<DeleteCitation"))
    return found.select(
        F.explode(xml.deleted_ids(F.col("chunk"), first_only)).alias("pmid"),
        "file_name",
        F.lit(1).alias("is_delete"),
        "pos",
    )


def parse_changes(
    chunks: DataFrame, text_mode: str = "leading", first_delete_only: bool = False
) -> DataFrame:
    """Upserts and deletes of one scan; ``error`` is set on unreadable records."""
    columns = [*ARTICLE_COLUMNS, "error"]
    cut = chunks.select(
        "file_name",
        "pos",
        record_of_chunk(F.col("chunk")).alias("record"),
        F.when(
            F.col("chunk").contains("<DeleteCitation"),
            xml.deleted_ids(F.col("chunk"), first_delete_only),
        ).alias("deletes"),
    )
    parsed = xml.with_article_columns(cut.withColumn("is_record", F.col("record").isNotNull()), text_mode)
    upsert = F.struct("pmid", F.lit(0).alias("is_delete"), *columns)
    types = {f.name: f.dataType for f in parsed.schema.fields}
    tombstones = F.transform(
        F.coalesce("deletes", F.array().cast("array<bigint>")),
        lambda i: F.struct(
            i.alias("pmid"),
            F.lit(1).alias("is_delete"),
            *[F.lit(None).cast(types[n]).alias(n) for n in columns],
        ),
    )
    upserts = F.when(F.col("is_record") & _kept(), F.array(upsert)).otherwise(F.slice(F.array(upsert), 1, 0))
    rows = parsed.select("file_name", "pos", F.explode(F.concat(upserts, tombstones)).alias("c"))
    return rows.select("c.pmid", "file_name", "c.is_delete", "pos", *[f"c.{n}" for n in columns])


def split_errors(changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Readable change rows, and the quarantined ones."""
    return changes.filter(F.col("error").isNull()).drop("error"), changes.filter(
        F.col("error").isNotNull()
    )


def fail_on_errors(changes: DataFrame) -> DataFrame:
    """The change rows; the job fails at the first unreadable record."""
    message = F.concat(
        F.col("error"), F.lit(": "), F.coalesce(F.col("pmid").cast("string"), F.lit("?")),
        F.lit(" in "), F.col("file_name"),
    )
    checked = F.when(F.col("error").isNotNull(), F.raise_error(message).cast("bigint")).otherwise(F.col("pmid"))
    return changes.withColumn("pmid", checked).drop("error")


def read_changes(
    spark: SparkSession,
    folder: str,
    text_mode: str = "leading",
    first_delete_only: bool = False,
    on_error: str = "fail",
) -> DataFrame:
    """Change rows of all files in a folder; see ``schemas.CHANGES``.

    ``on_error='fail'`` stops at an unreadable record, ``'quarantine'`` keeps
    it as a row with ``error`` for ``split_errors``.
    """
    if on_error not in ("fail", "quarantine"):
        raise ValueError("on_error is 'fail' or 'quarantine'")
    changes = parse_changes(read_chunks(spark, folder), text_mode, first_delete_only)
    return fail_on_errors(changes) if on_error == "fail" else changes


def write_change_files(rows: DataFrame, folder: str) -> None:
    """``rows(file_name, place, text)`` as one gzip file per name, its texts in the order of their places.

    Files are written beside the folder and appear in it whole, by a rename.
    """
    spark = rows.sparkSession
    staging = f"{folder.rstrip('/')}-staging-{uuid.uuid4().hex}"
    ordered = rows.repartition("file_name").sortWithinPartitions("file_name", "place")
    writer = ordered.select("file_name", "text").write.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
    writer.partitionBy("file_name").text(staging)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path(folder))
    # One listing for all files, without the owners and rights that a recursive one would look up file by file.
    literal = re.sub(r"([\\{}\[\]*?])", r"\\\1", staging)
    written = {}
    for status in fs.globStatus(path(f"{literal}/file_name=*/*")):
        part = status.getPath()
        name = part.getParent().getName()
        if name in written:
            raise ValueError(f"{name} was written in two parts")
        written[name] = part
    for name, part in written.items():
        fs.rename(part, path(f"{folder}/{name.split('=', 1)[1]}"))
