"""Registered queries of readers and writers: the test tables are written in each format and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.operators import aggregates, mapping, records
from fieldloom.operators.columns import q
from fieldloom.plans import occurrences
from fieldloom.plans.registry import landing, query, table
from fieldloom.sources import commits, readers, writers
from fieldloom.streaming import incremental


def _by_nation(rows: DataFrame, path: str) -> str:
    """Lines (nation, at, line) as a text file for each nation, in order; the pattern that names the files."""
    rows.repartition("nation").sortWithinPartitions("nation", "at").select("nation", q("line").alias("value")).write.partitionBy("nation").text(path)
    return f"{path}/nation=*"


def _lines(df: DataFrame, *parts: tuple[int | Column, Column]) -> DataFrame:
    """(nation, at, line): several lines for each row, each with its place."""
    return df.select(q("c_nationkey").alias("nation"), F.inline(F.array(*[F.struct((F.lit(a) if isinstance(a, int) else a).cast("long").alias("at"), line.alias("line")) for a, line in parts])))


# ---- delimited text ----

_NOTE = """c_name || chr(10) || '"' || c_mktsegment || '", x'"""


@query(f"SELECT {_NOTE} AS note, CAST(c_custkey AS VARCHAR) AS key, CAST(NULL AS VARCHAR) AS empty FROM customer")
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes, separators and line breaks within fields; columns in a given order, a missing one empty."""
    path = landing(spark, "csv")
    note = F.concat("c_name", F.lit('\n"'), "c_mktsegment", F.lit('", x'))
    writers.write_csv(table(spark, sf_dir, "customer").select(q("c_custkey").alias("key"), note.alias("note")), path, ["note", "key", "empty"])
    return readers.read_csv(spark, path)


@query("SELECT CAST(o_orderkey AS INT) AS o_orderkey, o_totalprice, o_orderdate FROM orders")
def tsv_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types inferred, some columns taken, dates parsed."""
    path = landing(spark, "tsv")
    orders = table(spark, sf_dir, "orders").withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))
    writers.write_csv(orders, path, sep="\t")
    typed = readers.read_tsv(spark, path, columns=["o_orderkey", "o_totalprice"], infer=True)
    dated = readers.read_tsv(spark, path, columns=["o_orderkey", "o_orderdate"], dates=["o_orderdate"]).withColumn("o_orderkey", q("o_orderkey").cast("int"))
    return typed.join(dated, "o_orderkey")


@query("SELECT least(count(*), 50) AS n FROM orders")
def scan_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = landing(spark, "head")
    writers.write_csv(table(spark, sf_dir, "orders"), path)
    return readers.read_csv(spark, path, nrows=50).agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT CAST(c_custkey AS VARCHAR) AS key, {_NOTE} AS note FROM customer")
def header_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file for each nation, with a banner before the header in each of them; records go over several lines."""
    path = landing(spark, "banner")
    customers = table(spark, sf_dir, "customer")
    note = F.concat(F.lit('"'), "c_name", F.lit('\n""'), "c_mktsegment", F.lit('"", x"'))
    head = _lines(customers.select("c_nationkey").distinct(), (-2, F.lit("# banner of the file")), (-1, F.lit("#key,note")))
    files = _by_nation(head.unionByName(_lines(customers, (q("c_custkey"), F.concat("c_custkey", F.lit(","), note)))), path)
    return readers.read_csv(spark, files, header_line=1)


@query("SELECT CAST(c_custkey AS VARCHAR) AS key, c_name AS name FROM customer")
def skipped_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every second line below the header is a remark, in files of any length."""
    path = landing(spark, "remarks")
    customers = table(spark, sf_dir, "customer")
    head = _lines(customers.select("c_nationkey").distinct(), (-1, F.lit("key\tname")))
    rows = _lines(customers, (2 * q("c_custkey"), F.concat("c_custkey", F.lit("\t"), "c_name")), (2 * q("c_custkey") + 1, F.lit("-- remark")))
    return readers.read_csv(spark, _by_nation(head.unionByName(rows), path), sep="\t", skip_rows=lambda k: k > 0 and k % 2 == 0)


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS key, CASE WHEN c_custkey % 7 = 2 THEN NULL ELSE c_name END AS name FROM customer WHERE c_custkey % 7 <> 1
""")
def bad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with too many fields go, short ones are padded."""
    path = landing(spark, "bad")
    customers = table(spark, sf_dir, "customer")
    line = F.when(q("c_custkey") % 7 == 1, F.concat("c_custkey", F.lit(",x,y"))).when(q("c_custkey") % 7 == 2, q("c_custkey").cast("string")).otherwise(F.concat("c_custkey", F.lit(","), "c_name"))
    head = _lines(customers.select("c_nationkey").distinct(), (-1, F.lit("key,name")))
    return readers.read_csv(spark, _by_nation(head.unionByName(_lines(customers, (q("c_custkey"), line))), path), on_bad_lines="skip", multi_line=False)


@query("SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, coalesce(nullif(o_orderstatus, 'O'), '') AS o_orderstatus FROM orders")
def kept_blanks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All text, blanks as empty text; compressed."""
    path = landing(spark, "blank")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.nullif("o_orderstatus", F.lit("O")).alias("o_orderstatus"))
    orders.write.option("header", True).option("compression", "gzip").csv(path)
    return readers.read_csv(spark, path, keep_na=True)


@query("SELECT CAST(s_suppkey AS VARCHAR) AS key, 'Näme é ' || s_name AS name, CAST(s_nationkey AS VARCHAR) AS nation FROM supplier")
def latin_pipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields parted by tab, bar, tab, in another charset."""
    path = landing(spark, "latin")
    rows = table(spark, sf_dir, "supplier").select(q("s_suppkey").alias("key"), F.concat(F.lit("Näme é "), "s_name").alias("name"), q("s_nationkey").alias("nation"))
    rows.write.option("header", True).option("sep", "\t|\t").option("encoding", "ISO-8859-1").csv(path)
    return readers.read_csv(spark, path, sep="\t|\t", encoding="ISO-8859-1")


@query("SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, '' AS blank, p_brand AS brand FROM part")
def taxonomy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = landing(spark, "dmp")
    table(spark, sf_dir, "part").select(F.concat_ws("\t|\t", q("p_partkey").cast("string"), "p_name", F.lit(""), F.concat("p_brand", F.lit("\t|")))).write.text(path)
    return readers.read_dmp(spark, path, ["id", "name", "blank", "brand"])


@query("SELECT CAST(s_suppkey AS VARCHAR) AS key, s_name AS value FROM supplier")
def headless_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = landing(spark, "pairs")
    table(spark, sf_dir, "supplier").select(F.concat_ws("\t", q("s_suppkey").cast("string"), "s_name")).write.text(path)
    return readers.read_kv(spark, path, ["key", "value"])


@query("""
SELECT a.s_suppkey, a.s_name AS name, b.s_nationkey AS nation FROM (SELECT *, row_number() OVER (ORDER BY s_suppkey) AS i FROM supplier) a
JOIN (SELECT *, row_number() OVER (ORDER BY s_suppkey) AS i FROM supplier WHERE s_suppkey % 3 <> 0) b ON a.i = b.i
""")
def stacked_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two files side by side, row by row; the shorter one decides. A file that is aligned by row is one file."""
    path = landing(spark, "stacked")
    suppliers = table(spark, sf_dir, "supplier")
    writers.write_csv(suppliers.orderBy("s_suppkey").coalesce(1).select("s_suppkey", "s_name"), f"{path}/a")
    writers.write_csv(suppliers.filter("s_suppkey % 3 <> 0").orderBy("s_suppkey").coalesce(1).select("s_nationkey"), f"{path}/b")
    found = readers.read_stacked(spark, {"collection": f"{path}/a", "assembly": f"{path}/b"})
    return found.select(q("collection")["s_suppkey"].cast("long").alias("s_suppkey"), q("collection")["s_name"].alias("name"), q("assembly")["s_nationkey"].cast("int").alias("nation"))


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS key, c_name AS name, NULL AS balance, NULL AS size FROM customer
UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name, CAST(CAST(round(s_acctbal) AS BIGINT) AS VARCHAR), NULL FROM supplier
UNION ALL SELECT CAST(p_partkey AS VARCHAR), NULL, NULL, p_size FROM part
""")
def folder_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file below a folder, of different formats and columns."""
    path = landing(spark, "folder")
    writers.write_csv(table(spark, sf_dir, "customer").select(q("c_custkey").alias("key"), q("c_name").alias("name")), f"{path}/a")
    balance = F.round("s_acctbal").cast("long").alias("balance")
    writers.write_csv(table(spark, sf_dir, "supplier").select(q("s_name").alias("name"), balance, q("s_suppkey").alias("key")), f"{path}/b")
    table(spark, sf_dir, "part").select(q("p_partkey").cast("string").alias("key"), q("p_size").alias("size")).write.parquet(f"{path}/c")
    return readers.read_dir(spark, path).select("key", "name", "balance", "size")


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS key, c_name AS name, CAST(NULL AS VARCHAR) AS segment, CASE WHEN c_nationkey % 3 = 1 THEN c_nationkey END AS nation FROM customer WHERE c_nationkey % 3 < 2
UNION ALL SELECT CAST(c_custkey AS VARCHAR), NULL, c_mktsegment, c_nationkey FROM customer WHERE c_nationkey % 3 = 2
""")
def folder_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files whose columns stand in other orders, more in some and fewer in others, in one scan; a type inferred."""
    path = landing(spark, "orders")
    customers = table(spark, sf_dir, "customer").select(q("c_custkey").cast("string").alias("key"), q("c_name").alias("name"), q("c_mktsegment").alias("segment"), q("c_nationkey").alias("nation"))
    for part, columns in (("a", ["key", "name"]), ("b", ["name", "nation", "key"]), ("c", ["nation", "segment", "key"])):
        writers.write_csv(customers.filter(q("nation") % 3 == "abc".index(part)).select(columns), f"{path}/{part}")
    found = readers.read_csv(spark, [f"{path}/{part}" for part in "abc"], infer=True)
    return found.select(q("key").cast("string").alias("key"), "name", "segment", "nation")


@query(f"SELECT {_NOTE} AS note, CAST(c_custkey AS VARCHAR) AS key FROM customer")
def split_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields with line breaks in one file that many tasks read."""
    path = landing(spark, "split")
    note = F.concat("c_name", F.lit('\n"'), "c_mktsegment", F.lit('", x'))
    writers.write_csv(table(spark, sf_dir, "customer").select(note.alias("note"), q("c_custkey").alias("key")).coalesce(1), path)
    return readers.read_csv(spark, path, split=True)


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS key, c_name AS name, NULL AS nation FROM customer UNION ALL SELECT CAST(s_suppkey AS VARCHAR), NULL, CAST(s_nationkey AS VARCHAR) FROM supplier
""")
def merged_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed files of two formats into one CSV, columns in first-seen order."""
    path = landing(spark, "merge")
    writers.write_csv(table(spark, sf_dir, "customer").select(q("c_custkey").alias("key"), q("c_name").alias("name")), f"{path}/a.csv")
    table(spark, sf_dir, "supplier").select(q("s_suppkey").cast("string").alias("key"), q("s_nationkey").cast("string").alias("nation")).write.parquet(f"{path}/b.parquet")
    writers.merge_files(spark, [f"{path}/a.csv", f"{path}/b.parquet"], f"{path}/out")
    return readers.read_csv(spark, f"{path}/out")


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS key, c_name AS name, NULL AS segment FROM customer WHERE c_nationkey % 2 = 0
UNION ALL SELECT CAST(c_custkey AS VARCHAR), NULL, c_mktsegment FROM customer WHERE c_nationkey % 2 = 1
""")
def occurrence_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of an export without its side files."""
    path = landing(spark, "export")
    customers = table(spark, sf_dir, "customer")
    occurrences.resave(customers.filter("c_nationkey % 2 = 0").select(q("c_custkey").alias("key"), q("c_name").alias("name")), f"{path}/a")
    occurrences.resave(customers.filter("c_nationkey % 2 = 1").select(q("c_custkey").alias("key"), q("c_mktsegment").alias("segment")), f"{path}/b")
    return occurrences.biocache(spark, path).select("key", "name", "segment")


# ---- documents ----


@query("SELECT c_custkey, c_name, c_nationkey FROM customer")
def json_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file for each thousand customers, one JSON array in it."""
    path = landing(spark, "json")
    customers = table(spark, sf_dir, "customer").withColumn("page", F.expr("c_custkey div 1000"))
    pages = customers.groupBy("page").agg(F.to_json(F.collect_list(F.struct("c_custkey", "c_name", "c_nationkey"))).alias("value"))
    pages.repartition("page").write.partitionBy("page").text(path)
    return readers.read_json_array(spark, f"{path}/page=*", "c_custkey long, c_name string, c_nationkey int")


@query("SELECT c_custkey, c_name, (SELECT max(c_custkey) // 1000 + 2 FROM customer) AS next_page FROM customer")
def landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed result pages of a thousand records, and the page to ask for next."""
    path = landing(spark, "pages")
    customers = table(spark, sf_dir, "customer").withColumn("page", F.expr("c_custkey div 1000 + 1"))
    body = F.struct(q("page").alias("number"), F.struct(F.collect_list(F.struct("c_custkey", "c_name")).alias("records")).alias("result"))
    customers.groupBy("page").agg(F.to_json(body).alias("value")).repartition("page").write.partitionBy("page").text(path)
    schema = "number long, result struct<records:array<struct<c_custkey:long,c_name:string>>>"
    numbers = readers.read_json_array(spark, f"{path}/page=*", schema)
    return readers.read_pages(spark, f"{path}/page=*", "result.records", schema).withColumn("next_page", incremental.cursor(numbers, "number").scalar())


@query("SELECT c_custkey AS key, c_name AS name, CAST(c_nationkey AS BIGINT) AS nation FROM customer")
def xml_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An XML document for each nation, with other elements among its rows."""
    path = landing(spark, "xml")
    customers = table(spark, sf_dir, "customer")
    row = F.concat(F.lit("<row key='"), "c_custkey", F.lit("'><name> "), "c_name", F.lit("</name>\n  <nation>"), "c_nationkey", F.lit("</nation></row><other/>"))
    ends = _lines(customers.select("c_nationkey").distinct(), (-1, F.lit("<set>")), (1 << 62, F.lit("</set>")))
    files = _by_nation(ends.unionByName(_lines(customers, (q("c_custkey"), row))), path)
    return readers.read_xml(spark, files, "row", "_key long, name string, nation long").select(q("_key").alias("key"), "name", "nation")


@query("""
SELECT 'O' || c_custkey AS locus, 'A' || c_custkey AS accession, 4 AS sections, 'gb' || c_nationkey || '.seq' AS filename, '250.0' AS release_num,
       'https://ftp.ncbi.nlm.nih.gov/genbank/GB' || c_nationkey || '.SEQ.gz' AS seq_file FROM customer
""")
def flat_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat sequence files, one for each nation with its header in front."""
    path = landing(spark, "flat")
    customers = table(spark, sf_dir, "customer")
    head = F.concat(F.lit("GB"), "c_nationkey", F.lit(".SEQ          Genetic Sequence Data Bank\n                      August 15 2022\n\n              Flat File Release 250.0\n\n     Some Sequences\n\n   7 loci\n"))
    record = F.concat(F.lit("LOCUS       O"), "c_custkey", F.lit(" 9 bp\nDEFINITION  d\nACCESSION   A"), "c_custkey", F.lit("\nORIGIN\n        1 acgt\n//"))
    lines = _lines(customers.select("c_nationkey").distinct(), (-1, head)).unionByName(_lines(customers, (q("c_custkey"), record)))
    found = readers.read_flat_records(spark, _by_nation(lines, path), with_file=True)
    found = records.parse_record_header(found.withColumn("n", F.size("sections")))
    return found.select("locus", "accession", q("n").alias("sections"), "filename", "release_num", "seq_file")


@query("SELECT c_custkey, c_name AS k, c_nationkey AS v FROM customer")
def script_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = F.concat(F.lit("<script>var data = {\"x\": [{\"k\": \""), "c_name", F.lit("\", \"v\": "), "c_nationkey", F.lit("}]};\nvar checklist;</script>"))
    return readers.extract_script_json(table(spark, sf_dir, "customer").select("c_custkey", page.alias("html")), "struct<k:string,v:int>").select("c_custkey", "k", "v")


@query("SELECT 'nation=' || c_nationkey AS folder, CAST(sum(octet_length(CAST(c_name AS BLOB)) + 1) AS BIGINT) AS size FROM customer GROUP BY c_nationkey")
def listed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files below a folder by name and size; their sizes summed by folder."""
    path = landing(spark, "listed")
    _by_nation(table(spark, sf_dir, "customer").select(q("c_nationkey").alias("nation"), q("c_custkey").alias("at"), q("c_name").alias("line")), path)
    below = aggregates.folder_sizes(readers.list_files(spark, path).withColumn("path", F.regexp_extract("path", r"(nation=.*)$", 1)))
    return below.select("folder", "size")


# ---- sinks ----


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, coalesce(nullif(o_orderstatus, 'O'), '') AS o_orderstatus, '' AS missing FROM orders
""")
def parquet_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All text with blanks for nulls, then many parts to few."""
    path = landing(spark, "text")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.nullif("o_orderstatus", F.lit("O")).alias("o_orderstatus"))
    writers.write_parquet(orders.repartition(6, "o_orderkey"), f"{path}/many", ["o_orderkey", "o_orderstatus", "missing"], as_text=True)
    writers.compact(spark, f"{path}/many", f"{path}/few", 2)
    return readers.read_parquet(spark, f"{path}/few")


@query("SELECT c_custkey AS record, c_name AS scientific_name, c_nationkey, c_mktsegment, c_acctbal FROM customer")
def event_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table for each event of a converted table; read back and put side by side by the record."""
    path = landing(spark, "events")
    customers = table(spark, sf_dir, "customer").withColumn("again", q("c_custkey"))
    found = {"c_custkey": mapping.Target("collection", "record"), "c_name": mapping.Target("collection", "scientific_name")}
    writers.write_events(mapping.apply_map(customers, found), path, batch=0)
    writers.write_parquet(commits.read_table(spark, path, "unmapped"), f"{path}/copy", mode="overwrite")
    rest = readers.read_parquet(spark, f"{path}/copy", ["again", "c_nationkey", "c_mktsegment", "c_acctbal"])
    return commits.read_table(spark, path, "collection").join(rest, q("record") == q("again")).drop("again")


@query("SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, (SELECT count(*) FROM customer) AS rows, true AS bounded FROM customer")
def bounded_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of at most 200 rows, then another format."""
    path = landing(spark, "parts")
    writers.write_parts(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), f"{path}/csv", 200)
    lines = readers.numbered_lines(spark, f"{path}/csv").groupBy("file").agg((F.max("no")).alias("n"))  # a header and the rows
    told = lines.agg(F.sum("n").alias("rows"), (F.max("n") <= 200).alias("bounded"))
    writers.convert_format(spark, f"{path}/csv", f"{path}/parquet", "csv", "parquet")
    return spark.read.parquet(f"{path}/parquet").withColumns({c: told.select(c).scalar() for c in ("rows", "bounded")})


@query("SELECT CAST(row_number() OVER (ORDER BY s_suppkey) AS VARCHAR) AS \"Example #\", CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name FROM supplier")
def numbered_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = landing(spark, "examples")
    writers.write_examples(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name").orderBy("s_suppkey"), path)
    return readers.read_tsv(spark, path)


@query("""
SELECT o_custkey, '{"listName":"orders","listItems":[' || string_agg('{"itemName":' || o_orderkey || ',"kvpValues":[' ||
       CASE WHEN o_orderstatus = 'O' THEN '' ELSE '{"key":"status","value":"' || o_orderstatus || '"},' END || '{"key":"o_orderpriority","value":"' || o_orderpriority || '"}]}', ',' ORDER BY o_orderkey) || ']}' AS payload
FROM orders GROUP BY o_custkey
""")
def list_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("status", F.nullif("o_orderstatus", F.lit("O")))
    return writers.to_list_payload(orders, "orders", "o_orderkey", ["status", "o_orderpriority"], ["o_custkey"])


@query("SELECT o_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)")
def id_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One id a line, read again for a semi-join."""
    path = landing(spark, "ids")
    writers.write_ids(table(spark, sf_dir, "lineitem").filter("l_quantity > 45").select("l_orderkey").distinct(), "l_orderkey", path)
    ids = spark.read.text(path).select(q("value").cast("long").alias("o_orderkey"))
    return table(spark, sf_dir, "orders").select("o_orderkey").join(ids, "o_orderkey", "left_semi")


@query("""
SELECT c_custkey, CAST('2024-01-01' AS VARCHAR) AS day FROM customer WHERE c_custkey % 2 = 1 UNION ALL SELECT c_custkey, '2024-01-02' FROM customer
""")
def dated_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dated runs; the first day is written again and replaces itself alone."""
    path = landing(spark, "snapshots")
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    for df, day in ((customers, "2024-01-01"), (customers, "2024-01-02"), (customers.filter("c_custkey % 2 = 1"), "2024-01-01")):
        writers.write_snapshot(df, path, day)
    return spark.read.parquet(path).select("c_custkey", q("snapshot_date").cast("string").alias("day"))
