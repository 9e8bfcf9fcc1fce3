"""CSV and JSON intake files."""

import csv
import functools
import re
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pacewell.errors import ValidationError
from pacewell.operators.intake import CORRUPT, coerce, require_batch_size, require_columns
from pacewell.schemas import RECORD_COLUMNS, REQUIRED
from pacewell.settings import MAX_BATCH_RECORDS

SOURCE_FILE = "_source_file"
LINE = "_line"
CSV_GLOB = "*.[cC][sS][vV]"


def header_names(line: str) -> list[str]:
    """Column names of a header line; a byte order mark is no part of the first one."""
    return next(csv.reader([line.removeprefix("\ufeff")]), [])


def unreadable(names: list[str]) -> str | None:
    """Why records cannot be found under a header, or None."""
    lacking = sorted(set(REQUIRED) - set(names))
    if lacking:
        return f"missing required columns: {', '.join(lacking)}"
    folded = [n.lower() for n in names]
    twice = sorted({n for n in folded if folded.count(n) > 1 or n in (CORRUPT, SOURCE_FILE)})
    return f"unusable column names: {', '.join(twice)}" if twice else None


def csv_lines(reader, path, recursive: bool = False) -> DataFrame:
    """Lines of CSV files with their file; blank lines are left out.

    ``_first`` marks the lines among which a file's header is: those of its first block.
    """
    lines = reader.option("pathGlobFilter", CSV_GLOB).option("recursiveFileLookup", recursive).text(path)
    return lines.select(
        F.col("value").alias(LINE), F.col("_metadata.file_path").alias(SOURCE_FILE),
        (F.col("_metadata.file_block_start") == 0).alias("_first"),
    ).filter(F.trim(LINE) != "")


def numbered(lines: DataFrame) -> DataFrame:
    """Adds a number that grows along each file, as a scan reads blocks in order."""
    return lines.withColumn("_at", F.monotonically_increasing_id())


def _headers(spark: SparkSession, path, recursive: bool) -> dict[str, list[str]]:
    """Files by their header line.

    One pass over the lines finds the hash of each file's first one in a hash
    aggregate; of files with the same hash, only one is looked into for the
    line itself. What reaches the driver is a row per file, as a listing has.
    """
    by_hash: dict[int, list[str]] = {}
    try:
        lines = numbered(csv_lines(spark.read, path, recursive))
        firsts = lines.filter("_first").groupBy(SOURCE_FILE).agg(F.min_by(F.xxhash64(LINE), "_at").alias("header"))
        found = firsts.collect()
    except Exception as failure:
        raise ValidationError(f"cannot read CSV files at {path}: {failure}") from failure
    for row in found:
        by_hash.setdefault(row["header"], []).append(unquote(row[SOURCE_FILE]))
    groups: dict[str, list[str]] = {}
    for files in sorted(map(sorted, by_hash.values())):
        head = spark.read.text(_literal(files[0])).filter(F.trim("value") != "").head()
        groups.setdefault(head["value"], []).extend(files)
    return groups


def _literal(path: str) -> str:
    """The path with the characters escaped that a reader takes for a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def csv_text(spark: SparkSession, path, recursive: bool = False, strict: bool = True,
             header: list[str] | None = None) -> DataFrame:
    """Raw CSV records as text, plus the damaged line and the file.

    Only files named ``.csv`` are read, as UTF-8, each by its own header line:
    files with the same one are scanned together, and scans are united by
    column name. A file that lacks an optional column has NULL there. One whose
    header lacks a required column, or names one twice, fails a strict read; in
    a lenient read each of its lines is a damaged record.

    The headers cost a pass over the lines. Give ``header`` where all files
    are known to have the same one: then there is no such pass, and a file with
    another header fails.
    """
    if header is not None:
        return require_columns(_scan(spark, path, header, recursive))
    groups = _headers(spark, path, recursive)
    if not groups:
        raise ValidationError(f"no CSV records at {path}")
    wrong = {line: why for line in groups if (why := unreadable(header_names(line)))}
    if strict and wrong:
        line, why = next(iter(wrong.items()))
        raise ValidationError(f"{why} (in {groups[line][0]})")
    scans = []
    for line, files in groups.items():
        # All files together need no list of paths.
        where = path if len(groups) == 1 else [_literal(f) for f in files]
        if line in wrong:
            text = csv_lines(spark.read, where, recursive and len(groups) == 1)
            scans.append(_damaged_lines(text.filter(F.col(LINE) != line)))
        else:
            scans.append(_scan(spark, where, header_names(line), recursive and len(groups) == 1, line.startswith("\ufeff")))
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def _scan(spark: SparkSession, path, names: list[str], recursive: bool, marked: bool = False) -> DataFrame:
    reader = csv_reader(spark.read, names, recursive).option("enforceSchema", marked)
    return flag_undecodable(reader.csv(path), names).withColumn(SOURCE_FILE, F.input_file_name())


def _damaged_lines(lines: DataFrame) -> DataFrame:
    nothing = F.lit(None).cast("string")
    return lines.select(*[nothing.alias(c) for c in RECORD_COLUMNS], F.col(LINE).alias(CORRUPT), SOURCE_FILE)


def records_of_lines(lines: DataFrame) -> DataFrame:
    """``csv_text`` in its lenient form, from the ``numbered`` lines of whole files, as a micro-batch has them.

    Lines are read several times: keep them. There is one projection for each
    distinct header; the headers themselves are as many rows as files, and go
    to the lines: moved by their file, all lines of one would be in one task.
    """
    firsts = lines.filter("_first").groupBy(SOURCE_FILE).agg(F.min("_at").alias("_at"))
    headers = lines.join(F.broadcast(firsts), [SOURCE_FILE, "_at"]).select(SOURCE_FILE, F.col(LINE).alias("_header"), F.col("_at").alias("_header_at"))
    rows = lines.join(F.broadcast(headers), SOURCE_FILE).filter(F.col("_at") != F.col("_header_at"))
    parsed = []
    for found in headers.select("_header").distinct().collect():
        line, own = found["_header"], rows.filter(F.col("_header") == found["_header"])
        names = header_names(line)
        if unreadable(names):
            parsed.append(_damaged_lines(own))
            continue
        schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])
        fields = F.from_csv(LINE, schema.toDDL(), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
        record = own.select(fields.alias("_record"), SOURCE_FILE).select("_record.*", SOURCE_FILE)
        parsed.append(flag_undecodable(record, names))
    if not parsed:
        return _damaged_lines(rows)
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parsed)


def flag_undecodable(df: DataFrame, names=RECORD_COLUMNS) -> DataFrame:
    """Marks lines that are not UTF-8 as damaged.

    The scan replaces such bytes by U+FFFD, which no record has a use for.
    """
    line = F.concat_ws(",", *names)
    return df.withColumn(CORRUPT, F.coalesce(CORRUPT, F.when(F.contains(line, F.lit("\ufffd")), line)))


def csv_reader(reader, names=RECORD_COLUMNS, recursive: bool = False):
    """Options shared by the batch and the streaming CSV scan.

    Every field is read as text: coercion decides what a bad value means, and
    a file whose header differs from ``names`` fails instead of shifting columns.
    """
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])
    return (
        reader.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("encoding", "UTF-8")
        .option("mode", "PERMISSIVE")
        # Pruned parsing would judge a line by the columns a query happens to use.
        .option("columnPruning", False)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("pathGlobFilter", CSV_GLOB)
        .option("recursiveFileLookup", recursive)
    )


def read_csv(spark: SparkSession, path, strict: bool = True, recursive: bool = False,
             max_rows_per_file: int | None = None, header: list[str] | None = None) -> DataFrame:
    """Typed records, each file read by its own header (see ``csv_text``). Strict reading fails on the first damaged value or line;
    otherwise ``parse_failed`` and ``_corrupt`` say what is wrong with a row."""
    text = csv_text(spark, path, recursive, strict, header)
    require_batch_size(text.select(SOURCE_FILE), [SOURCE_FILE], max_rows_per_file)
    if strict:
        broken = F.raise_error(F.concat(F.lit("damaged CSV line: "), F.col(CORRUPT)))
        text = text.withColumn("athlete_id", F.when(F.col(CORRUPT).isNotNull(), broken)
                               .otherwise(F.col("athlete_id"))).drop(CORRUPT)
    return coerce(text, strict)


def json_reader(reader, multi_line: bool = False):
    """Options shared by the batch and the streaming JSON scan.

    Every field is read as text, so that coercion judges it; a document that is
    not well-formed, or has no list of records, keeps its text in ``_corrupt``.
    """
    fields = T.StructType([T.StructField(n, T.StringType()) for n in RECORD_COLUMNS])
    schema = T.StructType([T.StructField("records", T.ArrayType(fields)), T.StructField(CORRUPT, T.StringType())])
    return (
        reader.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("multiLine", multi_line)
    )


def json_records(documents: DataFrame) -> DataFrame:
    """One row per record as text; a damaged document is one row with its text.

    A document without a list of records is damaged too; one with an empty list
    has no rows, and a null among the records is a record without values.
    """
    whole = F.when(F.col(CORRUPT).isNotNull() | F.col("records").isNull(),
                   F.coalesce(F.col(CORRUPT), F.lit("{}")))
    nothing = F.array(F.lit(None).cast(documents.schema["records"].dataType.elementType))
    rows = documents.select(
        whole.alias(CORRUPT),
        F.explode(F.when(whole.isNotNull(), nothing).otherwise(F.col("records"))).alias("record"))
    return rows.select(*[F.col(f"record.{c}").alias(c) for c in RECORD_COLUMNS], CORRUPT)


def read_json_batches(spark: SparkSession, path, max_records: int | None = None, strict: bool = True,
                      multi_line: bool = False) -> DataFrame:
    """Records of ``{"records": [...]}`` documents, one per line or, with ``multi_line``, one per file.

    Strict reading fails on the first damaged document or mistyped field;
    otherwise ``parse_failed`` and ``_corrupt`` say what is wrong with a row.
    ``max_records`` also refuses batches without records.
    """
    documents = json_reader(spark.read, multi_line).json(path)
    if max_records is not None:
        size = F.when(F.col(CORRUPT).isNull(), F.size("records"))
        wrong = documents.select(size.alias("n")).filter(~F.col("n").between(1, max_records)).take(1)
        if wrong:
            raise ValidationError(f"a batch has {wrong[0]['n']} records, 1 to {max_records} allowed")
    records = json_records(documents)
    if strict:
        broken = F.raise_error(F.concat(F.lit("damaged JSON document: "), F.col(CORRUPT)))
        records = records.withColumn("athlete_id", F.when(F.col(CORRUPT).isNotNull(), broken)
                                     .otherwise(F.col("athlete_id"))).drop(CORRUPT)
    return coerce(records, strict)


def write_csv(df: DataFrame, path: str) -> None:
    df.select(*RECORD_COLUMNS).write.mode("errorifexists").option("header", True).csv(path)


def write_json_batches(df: DataFrame, path: str, batch_size: int = MAX_BATCH_RECORDS) -> None:
    """Documents of at most ``batch_size`` records; missing values are omitted.

    Spark renders the records; a task only joins consecutive ones into
    documents. Nothing is shuffled, and no value of the data can make a
    document larger than asked for.
    """

    def documents(frames):
        for frame in frames:
            for start in range(0, len(frame), batch_size):
                records = ",".join(frame["record"].iloc[start:start + batch_size])
                yield pd.DataFrame({"value": [f'{{"records":[{records}]}}']})

    record = F.to_json(F.struct(*RECORD_COLUMNS), {"ignoreNullFields": "true"})
    rendered = df.select(record.alias("record"))
    rendered.mapInPandas(documents, "value string").write.mode("errorifexists").text(path)
