"""Sinks: JSON lines, routed splits, frozen splits, tables, dictionaries, manifests."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable
from xml.sax.saxutils import escape

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.shared import file_system, put


def json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def routed(df: DataFrame, route: Column, folder: str) -> None:
    """One pass over the rows, one subfolder ``route=<name>`` for each route."""
    df.withColumn("route", route).write.mode("overwrite").partitionBy("route").json(folder)


def frozen(df: DataFrame, path: str) -> None:
    """Written once; a later call leaves the files as they are."""
    df.write.mode("ignore").json(path)


def tab_separated(df: DataFrame, path: str, *order: Column | str) -> None:
    df.orderBy(*order).write.mode("overwrite").option("header", True).option("sep", "\t").csv(path)


def report(df: DataFrame, path: str) -> None:
    """One row as one JSON object."""
    df.select(F.to_json(F.struct("*"))).coalesce(1).write.mode("overwrite").text(path)


def appended(stream: DataFrame, path: str, checkpoint: str, each: Callable[[DataFrame], DataFrame] = lambda x: x):
    """Streaming append by micro-batch; a batch that runs again replaces its own folder, so results are written once."""

    def write(batch: DataFrame, number: int) -> None:
        each(batch).write.mode("overwrite").json(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def dictionary_lines(df: DataFrame) -> DataFrame:
    """Export lines of ``word``, ``freq``, ``locale``, ``shortcut``; a null locale is printed, a null shortcut is not."""
    shortcut = F.when(F.col("shortcut").isNotNull(), F.concat(F.lit(";s="), F.col("shortcut"))).otherwise("")
    return df.select(F.concat(F.lit(" w="), "word", F.lit(";f="), F.col("freq").cast("string"), F.lit(";l="), F.coalesce("locale", F.lit("null")), shortcut).alias("value"))


def saved_table(df: DataFrame, name: str) -> None:
    df.write.mode("overwrite").saveAsTable(name)


def single_file(df: DataFrame, path: str, kind: str = "json") -> None:
    """One file with a name of its own, as lists and reports have it: a small result, written by one task and renamed.

    What grows with the corpus is written as a folder of that name; readers take its parts as one file.
    """
    spark = df.sparkSession
    aside, files = file_system(spark, f"{path}.parts")
    df.coalesce(1).write.mode("overwrite").format(kind).save(f"{path}.parts")
    (part,) = [s.getPath() for s in files.listStatus(aside) if s.getPath().getName().startswith("part-")]
    target, _ = file_system(spark, path)
    files.delete(target, False)
    if not files.rename(part, target):
        raise OSError(f"{path} was not written")
    files.delete(aside, True)


#: The parts of a workbook with one sheet, as the file format names them.
WORKBOOK = {
    "[Content_Types].xml": '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>',
    "_rels/.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>',
    "xl/workbook.xml": '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="sheet" sheetId="1" r:id="r1"/></sheets></workbook>',
    "xl/_rels/workbook.xml.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
}
SHEET = '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{}</sheetData></worksheet>'


def spreadsheet(df: DataFrame, path: str, *order: Column | str, most: int = 10_000) -> None:
    """A review sheet for people: one workbook of at most ``most`` rows (more are an error), with a header; all cells are text."""
    rows = df.orderBy(*order).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a review sheet has at most {most} rows")
    cell = lambda v: f'<c t="inlineStr"><is><t xml:space="preserve">{escape("" if v is None else str(v))}</t></is></c>'
    lines = "".join(f"<row>{''.join(map(cell, row))}</row>" for row in [df.columns, *rows])
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for name, part in [*WORKBOOK.items(), ("xl/worksheets/sheet1.xml", SHEET.format(lines))]:
            z.writestr(name, '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>' + part)
    put(df.sparkSession, path, packed.getvalue())


def file_manifest(spark: SparkSession, path: str, tier: Column, version: str) -> DataFrame:
    """Tier, name, version, size and SHA-256 of each file; two files of a tier are an error.

    ``tier`` may read ``_metadata.file_name``. Model files have gigabytes: each is digested as a stream, a few of them in all, and never held as a row.
    """
    pattern, files = file_system(spark, path)
    found = [s for s in files.globStatus(pattern) or [] if s.isFile()]
    digest = spark.sparkContext._jvm.org.apache.commons.codec.digest.DigestUtils

    def sha256(status) -> str:
        stream = files.open(status.getPath())
        try:
            return digest.sha256Hex(stream)
        finally:
            stream.close()

    rows = [(s.getPath().getName(), version, s.getLen(), sha256(s)) for s in found]
    made = spark.createDataFrame(rows, "file string, version string, bytes bigint, sha256 string")
    made = made.withColumn("_metadata", F.struct(F.col("file").alias("file_name"))).select(tier.alias("tier"), "file", "version", "bytes", "sha256")
    if made.groupBy("tier").count().where("count > 1").limit(1).count():
        raise ValueError("more than one file of a tier")
    return made


def without_ids(df: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """Rows left after a delete by key; write it to a new folder and switch over."""
    return df.join(gone.select(key).distinct(), key, "left_anti")


def with_updates(df: DataFrame, news: DataFrame, key: str) -> DataFrame:
    """Rows after an update by key: rows of ``news`` replace those of the same key, unknown keys change nothing."""
    rows = df.alias("o").join(news.alias("n"), key, "left")
    hit = F.col(f"n.{next(c for c in news.columns if c != key)}").isNotNull()
    return rows.select(key, *[F.when(hit, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) if c in news.columns else F.col(f"o.{c}") for c in df.columns if c != key])
