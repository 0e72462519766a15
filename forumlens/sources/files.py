"""File sources and sinks: commented/gzipped CSV, plain CSV, XML dumps.

All readers take an explicit schema: inference costs a full extra pass over
the input and guesses types per file. Large plain files are read by many tasks.
Gzip is not splittable, so one ``.gz`` file is read by one task; the writers bound such files, and
``partitions=`` spreads the rows afterwards (one shuffle) when few large files feed a wide job.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from .splits import attribute_names, csv_records, decoded, xml_elements

# Stands for a quoted empty value while a record is parsed, so that it is told from a missing one.
_EMPTY = "\x00"

# A gzip file is one task when it is read, so a writing task goes on in a new file after this many rows.
GZIP_ROWS = 1 << 18

# What asks for the CSV parser: quotes, line ends, and characters that it may treat on its own.
_NOT_PLAIN = r'["\x00-\x08\x0A-\x1F\uFEFF\uFFFD]'


def _spread(df: DataFrame, partitions: int | None) -> DataFrame:
    return df.repartition(partitions) if partitions else df


def as_struct(schema: T.StructType | str) -> T.StructType:
    """A schema given as a StructType or in short as text (``Id long, Title string``)."""
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _csv(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | str, comment: str | None,
         bad_values: Observation | None = None, of_file: tuple[str, DataFrame] | None = None) -> DataFrame:
    """The columns of ``schema`` by name; ``of_file`` adds a column that a table (file, value) gives per file."""
    schema = as_struct(schema)
    records, header = csv_records(spark, paths, comment)
    names = next(csv.reader(io.StringIO(header, newline="")), []) if header else []
    place = {}
    for field in schema.fields:
        found = ([i for i, n in enumerate(names) if n == field.name]
                 or [i for i, n in enumerate(names) if n.lower() == field.name.lower()])
        if len(found) > 1:
            raise ValueError(f"column {field.name} stands {len(found)} times in the header")
        place.update({field.name: i for i in found})
    if names and len(place) < len(schema.fields):
        raise ValueError(f"columns missing in the header: {[n for n in schema.names if n not in place]}")
    columns = ", ".join(f"c{i} string" for i in range(len(names))) or "c0 string"
    parsed = F.from_csv("record", columns, {"escape": '"', "multiLine": "true", "mode": "FAILFAST", "emptyValue": _EMPTY})
    # a record without quotes is its values with commas between them; the others, and those of another length, are parsed
    values = F.split("record", ",", -1)
    plain = ~F.col("record").rlike(_NOT_PLAIN) & (F.size(values) == len(names)) & (F.trim("record") != "")
    rows = records.select("file", "record", F.when(plain, values).alias("v")).select(
        "file", "v", F.when(F.col("v").isNull(), parsed).alias("r"))
    raw = {}
    for field in schema.fields:
        if names:
            i = place[field.name]
            c, v = F.col(f"r.c{i}"), F.col("v").getItem(i)
            raw[field.name] = F.when(F.col("v").isNotNull(), F.when(v != "", v)).when(c == _EMPTY, F.lit("")).otherwise(c)
        else:
            raw[field.name] = F.lit(None).cast("string")
    typed = {f.name: raw[f.name].try_cast(f.dataType) for f in schema.fields}
    if bad_values is not None:
        rows = rows.observe(bad_values, *(F.count_if(
            raw[n].isNotNull() & (raw[n] != "") & typed[n].isNull()).alias(n) for n in schema.names))
    kept = [typed[n].alias(n) for n in schema.names]
    if of_file is None:
        return rows.select(*kept)
    name, table = of_file
    # one row a file, which the driver lists to plan the scan
    return rows.join(F.broadcast(table), "file").select(*kept, F.col("value").alias(name))


def read_commented_csv(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | str,
                       comment: str = "#", partitions: int | None = None, bad_values: Observation | None = None) -> DataFrame:
    """CSV with a header, lines starting with ``comment`` skipped.

    Columns are found by their names in the header, in any order; files whose headers differ
    raise. Only lines that *start* with the comment character, between records, are skipped; a ``#``
    inside a value (``C# lang``) is data. Values in quotes may hold line ends and doubled quotes; a
    large plain file is still read by many tasks (see :mod:`.splits`). Compression follows the
    extension; a gzip file is one task. Text ``""`` is empty, nothing between two commas is missing.

    A value that is not of its column's type is NULL. With ``bad_values`` (an ``Observation``) the reading
    job itself counts them, one number a column: ``bad_values.get`` after the first action.
    """
    return _spread(_csv(spark, paths, schema, comment, bad_values), partitions)


def read_csv(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | str,
             partitions: int | None = None, bad_values: Observation | None = None) -> DataFrame:
    """Plain CSV with a header, columns by name; else as :func:`read_commented_csv`."""
    return _spread(_csv(spark, paths, schema, None, bad_values), partitions)


def _rows_of(elements: DataFrame, schema: T.StructType) -> DataFrame:
    """Attributes by name; an element that is not well formed raises, a value of another type is NULL.

    Most elements of a dump are plain with their attributes in a known order: their ``values`` are there already, in the
    order of ``schema``, if ``elements`` has them. Attributes of other plain ones are found by splitting at the quotes. All
    others go through the XML parser, and so do those that name an attribute twice or a column in other letters.
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    alone = F.regexp_replace("element", "/?>$", "/>")
    # ' name' + control character + value for each attribute, with a quote behind, and the end of the tag as one more key
    pairs = F.replace(F.substr("element", F.locate(" ", "element")), F.lit('="'), F.lit("\x02"))
    quotes = F.length("element") - F.length(F.replace("element", F.lit('"')))
    exact, lower = {f.name for f in schema.fields}, {f.name.lower() for f in schema.fields}
    other_case = F.col("element").rlike(rf' (?!(?:{"|".join(map(re.escape, sorted(exact)))})=")(?i:{"|".join(map(re.escape, sorted(lower)))})="')
    values = F.col("values") if "values" in elements.columns else F.lit(None).cast("array<string>")
    plain = F.col("plain") & ~other_case if len(lower) == len(schema.fields) else F.lit(False)
    split = elements.select("element", values.alias("values"), F.when(plain, F.str_to_map(pairs, F.lit('"'), F.lit("\x02"))).alias("m"), quotes.alias("quotes"))
    plain = F.col("m").isNotNull() & (2 * F.size("m") == F.col("quotes") + 2)
    named = F.when(F.contains("element", F.lit("&")), F.transform_values("m", lambda _, v: decoded(v))).otherwise(F.col("m"))
    parsed = split.select("values", F.when(plain, named).alias("m"), F.when(F.col("values").isNull() & ~plain, F.from_xml(alone, text, {
        "attributePrefix": "", "mode": "FAILFAST", "ignoreSurroundingSpaces": "false"})).alias("r"))

    def value(i: int, name: str):
        v = F.col("values").getItem(i + 1)
        other = F.when(F.col("m").isNull(), F.col("r").getField(name)).otherwise(F.col("m").getItem(f" {name}"))
        return F.when(F.col("values").isNull(), other).when(v != "", F.substring(v, 2, 2 ** 31 - 1))

    return parsed.select(*(value(i, f.name).try_cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)))


def read_xml_rows(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | str,
                  row_tag: str = "row", partitions: int | None = None, rows_span_lines: bool = False) -> DataFrame:
    """S3: one row per ``<row .../>`` element, attributes become columns.

    A missing attribute is a missing value; entities are decoded. A large file is read by many
    tasks. Dumps have one row a line; for rows over several lines set ``rows_span_lines`` (without
    it such a row raises, nothing is lost). An element that is not well formed raises; a value
    that is not of its column's type is NULL. Rows inside comments count as rows.
    """
    schema = as_struct(schema)
    return _spread(_rows_of(xml_elements(spark, paths, row_tag, rows_span_lines, schema.names, schema.names), schema), partitions)


def write_csv(df: DataFrame, path: str, gzip: bool = True, mode: str = "errorifexists",
              partition_by: Sequence[str] = ()) -> str:
    """CSV sink with a header and no index column; one file per task, with ``gzip`` one per
    ``GZIP_ROWS`` rows of it (and per value of ``partition_by``, one folder ``col=value`` each).
    Quotes inside values are doubled; edge spaces and line ends are kept;
    empty text is written as ``""``, a missing value as nothing."""
    w = (df.write.mode(mode).option("header", True).option("escape", '"')
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    if gzip:
        w = w.option("compression", "gzip").option("maxRecordsPerFile", GZIP_ROWS)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)
    return path


# Fixed value of the dump format: timestamps are ISO text with milliseconds,
# for example 2009-03-11T12:51:01.480.
DUMP_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS"


def _dump_text(field: T.StructField):
    c = F.col(field.name)
    if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(c, DUMP_TIMESTAMP_FORMAT)
    if isinstance(field.dataType, T.DateType):
        return F.date_format(c, "yyyy-MM-dd")
    return c


def write_xml_rows(df: DataFrame, path: str, root_tag: str = "dump", row_tag: str = "row",
                   mode: str = "errorifexists", gzip: bool = False) -> str:
    """Write rows in the dump's shape: ``<row A="..." B="..."/>`` with every
    column as an attribute (missing values leave the attribute out).

    The names repeat in every row, so a dump takes many times the space of its values; with ``gzip``
    about a tenth of that, in files of at most ``GZIP_ROWS`` rows, as each is read by one task.

    Timestamps are written as the dump's ISO text; left to the XML writer,
    a timestamp attribute would come out as raw epoch microseconds.
    """
    attrs = df.select(*[_dump_text(f).alias(f"_{f.name}") for f in df.schema.fields])
    w = (attrs.write.mode(mode).format("xml").option("rootTag", root_tag).option("rowTag", row_tag)
         .option("attributePrefix", "_"))
    if gzip:
        w = w.option("compression", "gzip").option("maxRecordsPerFile", GZIP_ROWS)
    w.save(path)
    return path


def convert_dump(spark: SparkSession, xml_paths: Mapping[str, str], out_dir: str,
                 schemas: Mapping[str, T.StructType] | None = None,
                 drop: Mapping[str, Sequence[str]] = S.DUMP_DROP_COLUMNS,
                 gzip: bool = True, partitions: int | None = None, rows_span_lines: bool = False) -> dict[str, str]:
    """XML dump tables to CSV, dropping the listed columns per table.

    One Spark job per table, each file read by many tasks; attribute values pass as they
    stand, dates too. ``schemas`` names the columns per table (dropped ones included, types do not
    matter); without it one more pass finds the attribute names, in alphabetical order.
    """
    out = {}
    for name, path in xml_paths.items():
        names = (as_struct(schemas[name]).names if schemas and name in schemas
                 else attribute_names(xml_elements(spark, path, "row", rows_span_lines)))
        gone = {c.lower() for c in drop.get(name, [])}
        kept = T.StructType([T.StructField(n, T.StringType()) for n in names if n.lower() not in gone])
        elements = xml_elements(spark, path, "row", rows_span_lines, names, kept.names)
        out[name] = write_csv(_spread(_rows_of(elements, kept), partitions), f"{out_dir.rstrip('/')}/{name}", gzip=gzip)
    return out


def read_topics(spark: SparkSession, topic_paths: Mapping[str, str | Sequence[str]],
                schema: T.StructType | str = S.ACTIVITY, topic_col: str = "Topic") -> DataFrame:
    """Several topic files as one frame with a ``Topic`` column, so one
    grouped job serves every topic instead of one program copy per topic.

    All files are read in one scan; a row's topic is looked up by its file in the table of files that
    the driver lists anyway. Files that stand under several topics raise.
    """
    if not topic_paths:
        raise ValueError("read_topics needs at least one topic")
    files: dict[str, str] = {}
    for topic, paths in topic_paths.items():
        for file in spark.read.text([paths] if isinstance(paths, str) else list(paths)).inputFiles():
            if files.setdefault(file, topic) != topic:
                raise ValueError(f"{file} stands under the topics {files[file]} and {topic}")
    # a file's own name has one slash behind the scheme, the listed one three
    table = spark.createDataFrame([(f, t) for f, t in files.items()], "path string, value string").select(
        F.xxhash64(F.regexp_replace("path", "^file:/+", "file:/")).alias("file"), "value")
    everything = [p for paths in topic_paths.values() for p in ([paths] if isinstance(paths, str) else paths)]
    return _csv(spark, everything, schema, None, of_file=(topic_col, table))
