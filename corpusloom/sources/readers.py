"""Sources: JSON lines, text lines, line-aligned archives, subtitles, sectioned tables, key-value dictionaries."""

from __future__ import annotations

import io
import re
import zipfile
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from corpusloom.functions import text as T
from corpusloom.functions import udfs
from corpusloom.shared import file_system


def json_lines(spark: SparkSession, path: str | list[str], schema: str, strict: bool = True) -> DataFrame:
    """JSON lines. A malformed line raises, or is skipped unless ``strict``; blank lines never count."""
    return spark.read.schema(schema).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path)


#: Path of a part that one Spark task wrote: its folder is the file, so called and with an extension.
PART = r"^(.*/([^/]+\.[^/.]+))/part-\d{5,}-[0-9a-f-]{36}[^/]*$"


def whole_file(group: int = 2) -> Column:
    """Name (or path: 1) of the file that a row comes from; a folder of parts, as several tasks write it, counts as one file."""
    whole = F.regexp_extract(F.col("_metadata.file_path"), PART, group)
    plain = F.url_decode(F.replace(whole, F.lit("+"), F.lit("%2B")))
    return F.when(whole != "", plain if group == 2 else whole).otherwise(F.col(f"_metadata.file_{'name' if group == 2 else 'path'}"))


def with_file(df: DataFrame, column: str = "_batch_file") -> DataFrame:
    """Adds the name of the file that a row comes from."""
    return df.withColumn(column, whole_file())


#: Fixed value: names of intermediate files that are no final batches.
INTERMEDIATE = "cowork|prefilter|dropped|resolved|before_gap|repolished"


def final_batches(df: DataFrame, column: str = "_batch_file") -> DataFrame:
    return df.where(~F.col(column).rlike(INTERMEDIATE))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file``, ``line`` (from 1) and ``value`` of text files.

    Files are read in blocks like any other text: lines are numbered within their block, and a prefix sum over the
    blocks' counts, one row for each block, gives the number in the file. The parts of a folder follow each other.
    """
    rows = spark.read.text(path).select(whole_file(1).alias("_whole"), whole_file().alias("file"), F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at"), "value")
    rows = rows.withColumn("_in", F.row_number().over(Window.partitionBy("_path", "_block").orderBy("_at")))
    counts = rows.groupBy("_whole", "_path", "_block").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("_whole").orderBy(F.length("_path"), "_path", "_block").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("_path", "_block", F.coalesce(before, F.lit(0)).alias("_start"))
    return rows.join(starts, ["_path", "_block"]).select("file", (F.col("_start") + F.col("_in")).alias("line"), "value")


def seeds(spark: SparkSession, path: str | list[str], limit: int | None = None) -> DataFrame:
    """Trimmed lines that are not empty, in order, repeated ones kept; the first ``limit`` if given."""
    lines = numbered_lines(spark, path).withColumn("seed", F.trim("value")).where("seed <> ''").select("file", "line", "seed")
    return lines.orderBy("file", "line").limit(limit) if limit else lines


def distinct_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The set of trimmed lines of all files that exist."""
    have = [p for p in paths if _exists(spark, p)]
    lines = spark.read.text(have) if have else spark.createDataFrame([], "value string")
    return lines.select(F.trim("value").alias("seed")).where("seed <> ''").distinct()


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop, files = file_system(spark, path)
    found = files.globStatus(hadoop)
    return found is not None and len(found) > 0


def saved_state(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of a state that an earlier run saved as JSON lines; none before the first run."""
    return json_lines(spark, path, schema) if _exists(spark, path) else spark.createDataFrame([], schema)


def aligned_zip(spark: SparkSession, path: str, most: int | None = None) -> DataFrame:
    """``line``, ``ru``, ``en``, ``film`` of archives with line-aligned ``.ru``, ``.en`` and perhaps ``.ids`` members.

    An archive is one row for a worker, so it must be smaller than 2 GB (larger ones come as several); its members are
    streamed line by line, and lines leave in batches.
    """

    def read(batches):
        for batch in batches:
            for content in batch["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    member = lambda end: next((n for n in z.namelist() if n.endswith(end)), None)  # noqa: B023, E731
                    if not (member(".ru") and member(".en")):
                        raise ValueError("the archive has no .ru and .en members")
                    opened = [io.TextIOWrapper(z.open(member(e)), encoding="utf-8", errors="replace") if member(e) else None for e in (".ru", ".en", ".ids")]
                    rows = []
                    for i, (ru, en) in enumerate(zip(opened[0], opened[1], strict=False)):
                        if most is not None and i >= most:
                            break
                        ids = opened[2].readline().rstrip("\n") if opened[2] else None
                        rows.append((i, ru.rstrip("\n"), en.rstrip("\n"), ids))
                        if len(rows) == 10_000:
                            yield pd.DataFrame(rows, columns=["line", "ru", "en", "ids"])
                            rows = []
                    yield pd.DataFrame(rows, columns=["line", "ru", "en", "ids"])

    files = spark.read.format("binaryFile").load(path).select("content")
    lines = files.mapInPandas(read, "line long, ru string, en string, ids string")
    return lines.select("line", "ru", "en", T.film_key(F.col("ids")).alias("film"))


def spreadsheets(spark: SparkSession, path: str) -> DataFrame:
    """``file``, ``line`` (the header is 1) and ``cells`` (texts) of the first sheet of each workbook with inline or shared texts."""

    def read(batches):
        space = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
        for batch in batches:
            out = []
            for name, content in zip(batch["file"], batch["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    texts = lambda node: "".join(t.text or "" for t in node.iter(f"{space}t"))
                    shared = [texts(s) for s in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in z.namelist() else []
                    for no, row in enumerate(ElementTree.fromstring(z.read("xl/worksheets/sheet1.xml")).iter(f"{space}row"), 1):
                        value = lambda c: texts(c) if c.get("t") == "inlineStr" else c.findtext(f"{space}v", "")  # noqa: B023, E731
                        out.append((name, no, [shared[int(value(c))] if c.get("t") == "s" else value(c) for c in row]))
            yield pd.DataFrame(out, columns=["file", "line", "cells"])

    files = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_name").alias("file"), "content")
    return files.mapInPandas(read, "file string, line long, cells array<string>")


TIME = r"(\d+:\d{2}:\d{2}[,.]\d{1,3})\s*-->\s*(\d+:\d{2}:\d{2}[,.]\d{1,3})"


def cues(content: Column) -> Column:
    """Array of ``start``, ``end``, ``body`` (raw) of subtitle text: in each block the first time line counts."""
    blocks = F.split(F.btrim(content, F.lit("﻿ \r\n\t")), r"\r?\n\s*\r?\n")
    at = lambda b, g: F.regexp_extract(b, TIME, g)
    made = F.transform(blocks, lambda b: F.struct(at(b, 1).alias("s"), at(b, 2).alias("e"), F.regexp_replace(F.regexp_replace(b, rf"(?s)^.*?{TIME}[^\n]*", ""), r"\s*\n\s*", " ").alias("body")))
    return F.transform(F.filter(made, lambda c: c["s"] != ""), lambda c: F.struct(T.seconds(c["s"]).alias("start"), T.seconds(c["e"]).alias("end"), c["body"].alias("body")))


@F.pandas_udf(StringType())
def decoded(content: pd.Series) -> pd.Series:
    """Bytes as text: UTF-8 with or without a mark, else a Cyrillic code page, else Latin-1."""

    def of(raw):
        for name in ("utf-8-sig", "cp1251", "latin-1"):
            try:
                return raw.decode(name)
            except UnicodeDecodeError:
                continue

    return content.map(of)


def subtitles(spark: SparkSession, path: str) -> DataFrame:
    """``file``, ``start``, ``end``, ``text`` of subtitle files, cleaned; cues without text go."""
    files = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_name").alias("file"), decoded("content").alias("raw"))
    return cue_rows(files, "file", "raw")


def cue_rows(df: DataFrame, key: str, content: str) -> DataFrame:
    rows = df.select(key, F.explode(cues(F.col(content))).alias("c")).select(key, "c.start", "c.end", T.subtitle_clean(udfs.composed_form("c.body")).alias("text"))
    return rows.where("text <> ''")


def numbered_cues(df: DataFrame, key: str, content: str) -> DataFrame:
    """Strict reading for alignment: cues without words go, the rest is numbered from 1 in order."""
    rows = df.select(key, F.posexplode(cues(F.col(content))).alias("at", "c")).select(key, "at", "c.start", "c.end", T.cue_clean(F.col("c.body")).alias("text"))
    rows = rows.where((F.col("text") != "") & ~F.col("text").rlike(r"^[\d.,:\s]+$"))
    return rows.withColumn("id", F.row_number().over(Window.partitionBy(key).orderBy("at"))).drop("at")


def with_section(lines: DataFrame, header: Column, *, file: str = "file", line: str = "line") -> DataFrame:
    """Adds ``section``: the last header at or before a line of its file; header lines go."""
    w = Window.partitionBy(file).orderBy(line).rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn("_header", header).withColumn("section", F.last("_header", ignorenulls=True).over(w)).where("_header is null").drop("_header")


def table_sections(lines: DataFrame) -> DataFrame:
    """``section``, ``key``, ``value`` of a table with ``[Section]`` headers and ``;`` comments; rows split at the first blank."""
    name = F.nullif(F.regexp_extract("value", r"^\s*\[([^\]]+)\]\s*$", 1), F.lit(""))
    rows = with_section(lines.where(~F.col("value").rlike(r"^\s*;") & (F.trim("value") != "")), name)
    return rows.select("file", "line", "section", F.regexp_extract("value", r"^(\S+)[ \t]+(.*)$", 1).alias("key"), F.regexp_extract("value", r"^(\S+)[ \t]+(.*)$", 2).alias("value"))


def emoji_table(lines: DataFrame) -> DataFrame:
    """``category``, ``value``, ``name``, ``keywords``, ``base``: an indented line varies the base before it and has its name."""
    rows = with_section(lines.where(~F.col("value").rlike("^#") & (F.trim("value") != "")), F.nullif(F.regexp_extract("value", r"^\[([^\]]+)\]", 1), F.lit("")))
    parts = F.split("value", ";")
    rows = rows.select("file", "line", F.col("section").alias("category"), F.col("value").startswith("\t").alias("varies"), F.btrim(F.get(parts, 0), F.lit(" \t")).alias("value"), F.trim(F.get(parts, 1)).alias("name"), F.filter(F.split(F.coalesce(F.get(parts, 2), F.lit("")), r"\|"), lambda k: k != "").alias("keywords"))
    w = Window.partitionBy("file", "category").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    base = F.last(F.when(~F.col("varies"), F.struct("value", "name", "keywords")), ignorenulls=True).over(w)
    rows = rows.withColumn("_base", base)
    pick = lambda c: F.when(F.col("varies"), F.col(f"_base.{c}")).otherwise(F.col(c)).alias(c)
    return rows.select("file", "line", "category", "value", pick("name"), pick("keywords"), F.when(F.col("varies"), F.col("_base.value")).alias("base"))


def dictionary_entries(lines: DataFrame) -> DataFrame:
    """``word``, ``freq``, ``locale``, ``shortcut`` of ``w=..;f=..;l=..;s=..`` lines; frequencies outside 1..255 go."""
    clean = F.trim("value")
    entry = F.str_to_map(F.regexp_replace(clean, r"\s*;\s*", ";"), F.lit(";"), F.lit("="))
    rows = lines.where(clean.startswith("w=")).withColumn("_e", entry)
    get = lambda k: F.nullif(F.trim(F.try_element_at("_e", F.lit(k))), F.lit(""))
    rows = rows.select("line", get("w").alias("word"), get("f").try_cast("int").alias("freq"), F.nullif(get("l"), F.lit("null")).alias("locale"), get("s").alias("shortcut"))
    return rows.where("word is not null and freq between 1 and 255")


def idiom_list(lines: DataFrame) -> DataFrame:
    """``split``, ``kind``, ``lang`` of the section and ``key``, ``idiom``, ``meaning``, ``literal`` of rows with 3 or 4 fields."""
    rows = with_section(lines.where(F.trim("value") != ""), F.nullif(F.regexp_extract("value", "^## (.*)$", 1), F.lit(""))).where(~F.col("value").startswith("#"))
    p, head = F.split("value", r" \| "), F.split("section", " ")
    part = lambda i: F.trim(F.get(p, i))
    rows = rows.where(F.size(p).isin(3, 4))
    return rows.select("line", F.get(head, 0).alias("split"), F.get(head, 1).alias("kind"), F.get(head, 2).alias("lang"), F.translate(part(0), "ё/", "е|").alias("key"), part(1).alias("idiom"), part(2).alias("meaning"), F.coalesce(part(3) == "L", F.lit(False)).alias("literal"))


def lexicon(spark: SparkSession, path: str) -> DataFrame:
    """Entries of a JSON lexicon; a missing file has none."""
    schema = "entries array<struct<ru: string, literal_en: string, idiomatic_en: string, literal_survives: boolean, note: string>>"
    if not _exists(spark, path):
        return spark.createDataFrame([], schema).select(F.explode("entries").alias("e")).select("e.*")
    return spark.read.schema(schema).json(path, multiLine=True).select(F.explode("entries").alias("e")).select("e.*")


def manifest_models(df: DataFrame, content: str) -> DataFrame:
    """Models of a manifest: unknown tiers are left out, a file name with a path is an error."""
    schema = "struct<models: array<struct<tier: string, file: string, version: string, bytes: bigint, sha256: string>>>"
    rows = df.select(F.explode(F.from_json(content, schema)["models"]).alias("m")).select("m.*").where(F.col("tier").isin("small", "int4", "int8"))
    safe = F.col("file").rlike(r"^[A-Za-z0-9._-]+$") & ~F.col("file").startswith(".")
    return rows.withColumn("file", F.when(safe, F.col("file")).otherwise(F.raise_error(F.concat(F.lit("unsafe file name: "), F.col("file")))))


def paired_files(listing: DataFrame, extensions: list[str]) -> DataFrame:
    """Recordings and transcripts of the same stem; of several recordings the first extension wins. ``listing``: ``name``."""
    stem, ext = F.regexp_extract("name", r"^(.*)\.([^.]+)$", 1), F.regexp_extract("name", r"^(.*)\.([^.]+)$", 2)
    files = listing.select("name", stem.alias("stem"), ext.alias("ext"))
    audio = files.withColumn("rank", F.array_position(F.lit(extensions), F.col("ext"))).where("rank > 0").groupBy("stem").agg(F.min_by("name", "rank").alias("recording"))
    return files.where("ext = 'txt'").select("stem", F.col("name").alias("transcript")).join(audio, "stem").select("recording", "transcript")
