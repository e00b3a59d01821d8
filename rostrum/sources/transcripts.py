"""Nested JSON transcripts: scan, decode, bad-record routing, speech rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..plans.stage import stage

# The columns of a speech table.
SPEECH_COLUMNS = ("Speaker_Bioguide_ID", "Speaker_Name", "Text", "Date", "Legislative Body")


def list_files(spark: SparkSession, root: str, pattern: str = "*.json") -> DataFrame:
    """Paths under ``root`` whose file name matches; only the listing is read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True)
            .option("pathGlobFilter", pattern).load(root).select(F.col("path").alias("file_path")))


def first_files(files: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` paths in path order (folder by folder, as path parts compare)."""
    return files.orderBy(F.split("file_path", "/")).limit(limit)


def scan_json(spark: SparkSession, root: str, pattern: str = "*.json", limit: int = 0,
              lines: bool = False) -> DataFrame:
    """``(file_path, record, raw)`` for every matching file below ``root``; raises where there is none.

    One document per file by default. ``lines=True`` reads one document per line, the layout to use
    for large corpora since such files split and do not burden the listing. ``record`` tells the
    documents of a file apart: the start of the block that was read, and the place within it. It
    sorts in file order.
    """
    paths: str | list[str] = root
    if limit > 0:
        # The caller's own sample size bounds this list of paths.
        paths = [r.file_path for r in first_files(list_files(spark, root, pattern), limit).collect()]
    if not paths or list_files(spark, root, pattern).isEmpty():
        raise FileNotFoundError(f"no files match {pattern!r} under {root}")
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    return (reader.text(paths, wholetext=not lines)
            .select(F.col("_metadata.file_path").alias("file_path"),
                    F.format_string("%015d-%010d", F.col("_metadata.file_block_start"), place).alias("record"),
                    F.col("value").alias("raw")))


def _keys(raw: DataFrame) -> list[str]:
    """What identifies a record; tables that hold one document per path may leave ``record`` out."""
    return [c for c in ("file_path", "record") if c in raw.columns]


def _lenient(raw: Column) -> Column:
    """A second reading for objects that the strict parser refuses: repeated keys (the last wins), NaN and
    infinities, very long strings. Only the fields of a transcript are read, as text."""
    options = {"allowNonNumericNumbers": "true", "maxStringLen": str(2**31 - 1), "columnNameOfCorruptRecord": "broken"}
    top = F.from_json(raw, "header string, content string, broken string", options)
    items = F.from_json(top["content"], "array<string>", options)
    fields = lambda c, names: F.from_json(c, ", ".join(f"{n} string" for n in names), options)
    head = fields(top["header"], ("year", "month", "day", "chamber"))
    content = F.transform(items, lambda x: fields(x, ("kind", "speaker", "speaker_bioguide", "text")))
    is_object = raw.rlike(r"^\s*\{") & top.isNotNull() & top["broken"].isNull()
    is_list = raw.rlike(r"^\s*\[") & F.from_json(raw, "array<string>", options).isNotNull()  # well formed, but no object
    return (F.when(is_object, F.to_variant_object(F.struct(head.alias("header"), content.alias("content"))))
            .when(is_list, F.to_variant_object(F.array(F.lit("")))))


def _decode(raw: Column) -> Column:
    return F.coalesce(F.try_parse_json(raw), _lenient(raw))


def _is_object(doc: Column) -> Column:
    return F.coalesce(F.schema_of_variant(doc).startswith("OBJECT"), F.lit(False))


def good_records(raw: DataFrame) -> DataFrame:
    """Records whose text parses to an object, with ``doc`` (VARIANT).

    The parsed value is tested inside a one-element array, so each text is parsed once; a filter on
    ``doc`` would be pushed below the projection and parse again.
    """
    return raw.select("*", F.explode(F.filter(F.array(_decode(F.col("raw"))), _is_object)).alias("doc"))


def bad_records(raw: DataFrame) -> DataFrame:
    """Records for the failure list: broken text, or a top level that is not an object."""
    why = lambda doc: F.when(doc.isNull(), F.lit("not valid JSON")).when(
        ~_is_object(doc), F.lit("top level is not an object"))
    reason = F.array_compact(F.transform(F.array(_decode(F.col("raw"))), why))
    return raw.select(*_keys(raw), F.explode(reason).alias("reason"))


def _leaf(doc: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(doc, path, kind)


def _month(doc: Column) -> Column:
    kind = F.schema_of_variant(_leaf(doc, "$.header.month", "variant"))
    text = _leaf(doc, "$.header.month")
    as_bool = F.when(text == "true", F.lit(1))
    return (F.when(kind == "BOOLEAN", as_bool)
            .when(kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT"), F.lit(None).cast("int"))
            .otherwise(T.parse_month(text)))


def speech_rows(raw: DataFrame) -> DataFrame:
    """One row per non-empty speech item of each good document.

    ``file_path``, ``record`` and the item position ``pos`` identify a row. Wrong-typed headers, content and
    items are skipped field by field, never failing the document.
    """
    doc = F.col("doc")
    keys = _keys(raw)
    head = good_records(raw).select(
        *keys, "doc",
        T.header_date(_leaf(doc, "$.header.year", "bigint"), _month(doc),
                      _leaf(doc, "$.header.day", "bigint")).alias("Date"),
        T.safe_str(_leaf(doc, "$.header.chamber")).alias("Legislative Body"),
    )
    items = head.select(*keys, "Date", "Legislative Body",
                        F.posexplode(_leaf(doc, "$.content", "array<variant>")).alias("pos", "item"))
    item = F.col("item")
    text = _leaf(item, "$.text")
    rows = items.filter((T.trim_ws(_leaf(item, "$.kind")) == "speech") & ~text.rlike(f"^{T.WS}*(?i:none)?{T.WS}*$"))
    return rows.select(
        *keys, "pos",
        T.safe_str(_leaf(item, "$.speaker_bioguide")).alias("Speaker_Bioguide_ID"),
        T.safe_str(_leaf(item, "$.speaker")).alias("Speaker_Name"),
        T.normalize_ws(text).alias("Text"), "Date", "Legislative Body")


def with_doc_id(rows: DataFrame) -> DataFrame:
    """Dense 64-bit ids, unique by construction: rows are written once, and numbered by their place within
    the task that wrote them plus the rows of all tasks before it. Tasks are ordered by the first record
    they hold, so a file's rows stay in order. The only small table is one row per task.
    """
    low = (1 << 33) - 1
    kept = stage(rows.withColumn("_place", F.monotonically_increasing_id()), "speech-rows")
    task = F.shiftright("_place", 33)
    first = F.min(F.struct(*_keys(rows), "pos"))
    tasks = kept.groupBy(task.alias("_task")).agg(F.count("*").alias("n"), first.alias("first"))
    before = Window.partitionBy().orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    starts = stage(tasks.select("_task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start")), "speech-starts")
    numbered = kept.withColumn("_task", task).join(starts, "_task")
    return numbered.withColumn("doc_id", F.col("_start") + F.col("_place").bitwiseAND(low)).drop("_task", "_start", "_place")
