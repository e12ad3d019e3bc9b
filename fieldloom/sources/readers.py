"""Readers. All return DataFrames of text columns unless types are asked for."""

from __future__ import annotations

import csv
from collections.abc import Callable, Iterable
from functools import reduce
from itertools import count

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldloom.operators.splits import closed_records, quoted_records, split_lines
from fieldloom.operators.storage import settled
from fieldloom.operators.windows import number_rows

_SPARE = "_beyond_the_header"


def _text_schema(names: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _options(reader, sep: str, encoding: str, header: bool, multi_line: bool):
    return reader.option("sep", sep).option("encoding", encoding).option("header", header).option("quote", '"').option("escape", '"').option("multiLine", multi_line)


def read_csv(
    spark: SparkSession, path: str | list[str], sep: str = ",", encoding: str = "utf-8", header_line: int = 0, columns: list[str] | None = None,
    nrows: int | None = None, on_bad_lines: str = "error", infer: bool = False, dates: Iterable[str] = (), keep_na: bool = False,
    names: list[str] | None = None, skip_rows: Callable[[int], bool] | None = None, multi_line: bool = True, split: bool = False,
) -> DataFrame:
    """Delimited files (S01, S02, S07-S15, S17, S18, S25-S27); .gz and .bz2 are read as they are.

    Each file's fields are placed by its own header, so files may have columns in other orders, more of them or fewer; the
    result has all columns in first-seen order, files taken by name. header_line: which line of each file names the columns;
    lines before it are dropped. skip_rows: which line numbers of each file to leave out. multi_line: quoted fields may hold
    line breaks; without split one task reads such a file. split: many tasks read it, which asks for quotes that are even in
    each record and lines that end in \\n or \\r\\n. on_bad_lines='skip' drops rows with more fields than their file's header; short rows are padded with nulls.
    keep_na keeps blanks as empty text. infer: each column gets the narrowest type that all its values have. Spark needs
    spark.sql.legacy.javaCharsets for charsets such as windows-1252.
    """
    if header_line or skip_rows or (split and multi_line and not names):
        df = _from_lines(spark, path, sep, encoding, header_line, skip_rows, multi_line, on_bad_lines)
        df = inferred(df) if infer else df
    else:
        headers = None if names or _is_file(spark, path) else _first_lines(spark, path, encoding)
        heads = _distinct(headers, sep) if headers is not None else []
        if len(heads) > 1:
            wide = max(len(h) for _, h in heads)
            positions = [f"c{i}" for i in range(wide)]
            rows = _options(spark.read, sep, encoding, True, multi_line).option("enforceSchema", True).schema(_text_schema([*positions, _SPARE])).option("mode", "PERMISSIVE").csv(path)
            rows = rows.select(F.col("_metadata.file_path").alias("file"), F.array(*positions, _SPARE).alias("fields"))
            df = _placed(rows, headers, heads, on_bad_lines)
            df = inferred(df) if infer else df
        else:
            found = names or _options(spark.read, sep, encoding, True, multi_line).csv(path).columns
            reader = _options(spark.read, sep, encoding, names is None, multi_line)
            if infer and on_bad_lines != "skip":
                df = reader.option("inferSchema", True).csv(path).toDF(*found)
            else:
                # A spare column catches what goes beyond the header; short rows are padded by the reader.
                df = reader.schema(_text_schema([*found, _SPARE])).option("mode", "PERMISSIVE").csv(path)
                df = (df.filter(F.col(_SPARE).isNull()) if on_bad_lines == "skip" else df).drop(_SPARE)
                df = inferred(df) if infer else df
    if columns is not None:
        df = df.select(*[F.col(f"`{c}`") for c in columns])
    if keep_na:
        df = df.na.fill("")
    dates = set(dates)
    if dates:
        df = df.withColumns({c: F.try_to_timestamp(F.col(c)) for c in dates})
    return df.limit(nrows) if nrows is not None else df


def inferred(df: DataFrame, types: Iterable[str] = ("int", "bigint", "double", "boolean", "date", "timestamp")) -> DataFrame:
    """Columns of text as the first of the types that all their values have; one aggregation over the table. A column without values stays text."""
    types = list(types)
    fails = [F.count_if(F.col(f"`{c}`").isNotNull() & F.col(f"`{c}`").try_cast(t).isNull()) for c in df.columns for t in types]
    told = df.agg(F.array(*fails, F.lit(0)), F.array(*[F.count(F.col(f"`{c}`")) for c in df.columns], F.lit(0))).first()
    kinds = {c: next((t for j, t in enumerate(types) if told[1][i] and not told[0][i * len(types) + j]), "string") for i, c in enumerate(df.columns)}
    return df.select(*[F.col(f"`{c}`").cast(t).alias(c) for c, t in kinds.items()])


def _is_file(spark: SparkSession, path: str | list[str]) -> bool:
    """Whether the path names one file, so that there is one header."""
    paths = [path] if isinstance(path, str) else path
    if len(paths) != 1 or any(c in paths[0] for c in "*?[{"):
        return False
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(paths[0])
    system = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.exists(at) and system.getFileStatus(at).isFile()


def _first_lines(spark: SparkSession, path: str | list[str], encoding: str) -> DataFrame:
    """file, header: the first line of each file that isn't blank, found where a file's first block is read; one row a file."""
    lines = spark.read.option("encoding", encoding).text(path).filter(F.col("_metadata.file_block_start") == 0).filter(F.trim("value") != "")
    placed = lines.select(F.col("_metadata.file_path").alias("file"), "value", F.monotonically_increasing_id().alias("place"))
    return settled(placed.groupBy("file").agg(F.min_by("value", "place").alias("header")), "headers")


def _names(header: str, sep: str) -> list[str]:
    """Names in a header line; empty and repeated ones are numbered, as Spark does."""
    header = header.lstrip("\ufeff")
    found = next(csv.reader([header], delimiter=sep), []) if len(sep) == 1 else header.split(sep)
    return [n if n and found.count(n) == 1 else f"{n or '_c'}{i}" for i, n in enumerate(found)]


def _distinct(headers: DataFrame, sep: str, clean: Callable[[list[str]], list[str]] = lambda names: names) -> list[tuple[str, list[str]]]:
    """Header lines, each once, by the first file that has it, with their names. A header is a schema: they are few, however many files."""
    rows = headers.groupBy("header").agg(F.min("file").alias("first")).orderBy("first").collect()
    return [(r["header"], clean(_names(r["header"], sep))) for r in rows]


def _placed(rows: DataFrame, headers: DataFrame, heads: list[tuple[str, list[str]]], on_bad_lines: str) -> DataFrame:
    """Rows (file, fields) with each field under the name that its file's header gives it.

    A header becomes an array: for each column of the result its place in the file. Files meet their array in a join of
    one row a file, which Spark broadcasts while it is small.
    """
    every = list(dict.fromkeys(n for _, names in heads for n in names))
    spark = rows.sparkSession
    places = spark.createDataFrame([(h, [names.index(c) if c in names else None for c in every], len(names)) for h, names in heads], "header string, places array<int>, width int")
    of_file = settled(headers.join(places, "header").select(F.col("file").alias("of"), "places", "width"), "places")
    found = rows.join(of_file, F.col("file") == F.col("of"))
    if on_bad_lines == "skip":
        found = found.filter(~F.exists(F.slice("fields", F.col("width") + 1, F.greatest(F.size("fields") - F.col("width"), F.lit(0))), lambda x: x.isNotNull()))
    return found.select(*[F.get("fields", F.get("places", F.lit(i))).alias(c) for i, c in enumerate(every)])


def numbered_lines(spark: SparkSession, path: str | list[str], encoding: str = "utf-8", line_sep: str | None = None, with_split: bool = False) -> DataFrame:
    """file, no (0-based, within the file), value: lines of text files; with_split adds start and place.

    A line's place within its split is known where it is read; what is joined to it is one count for each split.
    """
    lines = split_lines(spark, path, encoding, line_sep)
    splits = lines.groupBy("file", "start").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("file").orderBy("start").rowsBetween(W.unboundedPreceding, -1)  # one row a split
    base = splits.select(F.col("file").alias("f"), F.col("start").alias("s"), (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("base"))
    base = settled(base, "splits")  # of a known size, so that Spark sends it to the lines instead of moving them
    found = lines.join(base, (F.col("file") == F.col("f")) & (F.col("start") == F.col("s")))
    return found.select("file", (F.col("place") + F.col("base")).alias("no"), "value", *(["start", "place"] if with_split else []))


def _from_lines(
    spark: SparkSession, path: str | list[str], sep: str, encoding: str, header_line: int, skip_rows: Callable[[int], bool] | None, multi_line: bool, on_bad_lines: str
) -> DataFrame:
    """Lines are numbered in each file, those that are left out go, the rest are put together to records and parsed."""
    lines = numbered_lines(spark, path, encoding, "\n", with_split=True)
    if skip_rows:

        @F.pandas_udf("boolean")
        def skipped(numbers: pd.Series) -> pd.Series:
            return numbers.map(lambda k: bool(skip_rows(int(k)))).astype(bool)

        lines = lines.filter(~skipped("no"))
        header_at = next(k for k in count() if not skip_rows(k))
    else:
        header_at = header_line
    headers = settled(lines.filter(F.col("no") == header_at).select("file", F.regexp_replace("value", "\r$", "").alias("header")), "headers")
    heads = _distinct(headers, sep, lambda names: [n.strip().lstrip("#").strip() for n in names])
    body = lines.filter(F.col("no") > header_at)
    if multi_line:
        body = quoted_records(body.select("file", "start", "place", "value"))
    body = body.withColumn("value", F.regexp_replace("value", "\r$", ""))
    positions = [f"c{i}" for i in range(max((len(names) for _, names in heads), default=0) + 1)]
    parsed = F.from_csv("value", ", ".join(f"{c} string" for c in positions), {"sep": sep, "quote": '"', "escape": '"'})
    body = body.filter(F.trim("value") != "").select("file", parsed.alias("r")).select("file", F.array(*[f"r.{c}" for c in positions]).alias("fields"))
    return _placed(body, headers, heads, on_bad_lines)


def read_tsv(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_csv(spark, path, **({"sep": "\t"} | options))


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_kv(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """A TSV without a header whose column names are given."""
    return read_csv(spark, path, sep="\t", names=names)


def read_stacked(spark: SparkSession, sections: dict[str, str], **options) -> DataFrame:
    """Files of equal length, one an event, side by side as a struct column each (S04, J22); the shortest one decides."""

    def numbered(event: str, path: str) -> DataFrame:
        df = read_csv(spark, path, **options)
        return number_rows(df.select(F.struct(*df.columns).alias(event)), "_row")

    return reduce(lambda a, b: a.join(b, "_row"), [numbered(e, p) for e, p in sections.items()]).drop("_row")


def read_files(spark: SparkSession, paths: list[str], **options) -> DataFrame:
    """CSV and TSV files, columns united in first-seen order; one scan of each kind, whatever headers they have."""
    groups: dict[str, list[str]] = {}
    for p in paths:
        groups.setdefault("\t" if p.endswith(".tsv") else options.get("sep", ","), []).append(p)
    frames = [read_csv(spark, group, **(options | {"sep": sep})) for sep, group in groups.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_dir(spark: SparkSession, path: str, patterns: dict[str, str] | None = None, **options) -> DataFrame:
    """Every supported file below a folder; columns are united in first-seen order."""
    listed = list_files(spark, path).select("path").orderBy("path")
    if patterns:
        listed = listed.filter(reduce(lambda a, b: a | b, [F.col("path").rlike(x) for x in patterns]))
    paths = [r["path"] for r in listed.collect()]  # names of files, not their rows
    text, parquet = [p for p in paths if p.endswith((".csv", ".tsv"))], [p for p in paths if p.endswith(".parquet")]
    frames = [read_files(spark, text, **options)] if text else []
    frames += [spark.read.option("mergeSchema", True).parquet(*parquet)] if parquet else []
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_dmp(spark: SparkSession, path: str, headings: list[str]) -> DataFrame:
    """Taxonomy dump lines: fields between tab-bar-tab, closed by tab-bar."""
    fields = F.split(F.regexp_replace("value", r"\t\|$", ""), r"\t\|\t", -1)
    return spark.read.text(path).select(*[F.try_element_at(fields, F.lit(i + 1)).alias(n) for i, n in enumerate(headings)])


def read_json_array(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """One JSON document that holds an array of records."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def read_pages(spark: SparkSession, path: str, array_path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Records of landed result pages; array_path names the array in a page."""
    return read_json_array(spark, path, schema).select(F.inline(F.col(array_path)))


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Row elements of XML documents."""
    reader = spark.read.format("xml").option("rowTag", row_tag).option("ignoreSurroundingSpaces", True)
    return (reader.schema(schema) if schema else reader).load(path)


#: Fixed value: where the sequence files lie.
SEQUENCE_FILES = "https://ftp.ncbi.nlm.nih.gov/genbank/"


def read_flat_headers(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file, filename, release_num, seq_file: what stands in front of the first record of each flat file."""
    head = numbered_lines(spark, path).filter("no < 4")
    name, release = F.substring_index(F.min_by("value", "no"), " ", 1), F.substring_index(F.max_by("value", "no"), " ", -1)
    return head.groupBy("file").agg(F.lower(name).alias("filename"), release.alias("release_num"), F.concat(F.lit(SEQUENCE_FILES), name, F.lit(".gz")).alias("seq_file"))


def read_flat_records(spark: SparkSession, path: str | list[str], with_file: bool = False) -> DataFrame:
    """Records closed by a // line, as (record, sections): sections start at lines without a leading blank, the sequence body is left out.

    with_file adds the columns of read_flat_headers.
    """
    lines = split_lines(spark, path, line_sep="\n").withColumn("value", F.regexp_replace("value", "\r$", ""))
    found = closed_records(lines).select("file", F.array_join("lines", "\n").alias("record"))
    started = F.regexp_replace("record", r"(?s)^.*?(?=(?:^|(?<=\n))LOCUS )", "")  # a file header stands before the first record
    out = found.select(started.alias("record"), *(["file"] if with_file else [])).withColumn("sections", F.split("record", r"\n(?=\S)"))
    return out.join(read_flat_headers(spark, path), "file").drop("file") if with_file else out


def extract_script_json(pages: DataFrame, schema: str, column: str = "html", start: str = "var data =", end: str = "var checklist;") -> DataFrame:
    """The JSON array that stands between two marks of a page's script, as rows."""
    between = F.regexp_extract(column, rf"(?s){start}(.*?){end}", 1)
    json = F.regexp_extract(between, r"(?s)(\[.*\])", 1)
    return pages.select("*", F.inline(F.from_json(json, f"array<{schema}>")))


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """Path and size of every file below root; contents aren't read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", F.col("length").alias("size"))
