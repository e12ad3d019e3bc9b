"""Registered queries of table operators and functions that the first set of queries doesn't reach."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.functions import tables
from fieldloom.functions import text as X
from fieldloom.operators import aggregates, columns, filters, groups, html, joins, nested, sampling, schema, sets, windows
from fieldloom.operators.columns import q
from fieldloom.plans import genomes
from fieldloom.plans.registry import LINE, landing, query, spread, table
from fieldloom.streaming import incremental

# ---- names, casts, schemas ----


@query("""
SELECT c_custkey AS copy, c_custkey AS c_key, CAST(NULL AS VARCHAR) AS missing, c_mktsegment AS segment, CAST(trunc(c_acctbal) AS INT) AS bal, CAST(NULL AS INT) AS c_name FROM customer
""")
def names_tidy(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "customer").select(q("c_custkey").alias("C Key"), q("c_name").alias("C Name"), q("c_mktsegment").alias("Segment"), q("c_acctbal").alias("Bal"), q("c_nationkey").alias("Nation"))
    df = columns.lower_columns(columns.underscore_columns(columns.drop_strict(df, ["Nation"])))
    df = columns.cast(columns.copy_columns(df, {"copy": "c_key"}), {"bal": "int", "c_name": "int"})
    df = columns.keep(df, ["segment", "bal", "c_name", "c_key", "copy", "not there"])
    return columns.align(df, ["copy", "c_key", "missing", "segment", "bal", "c_name"])


@query("SELECT o_orderkey FROM orders")
def null_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return columns.drop_any_null_columns(orders.select("o_orderkey", F.nullif("o_orderstatus", F.lit("O")).alias("o_status"), F.lit(None).cast("string").alias("o_nothing")))


@query("""
SELECT DISTINCT nation, segment, kind, 'segment' AS left_only, 'kind' AS right_only FROM (
  SELECT c_nationkey AS nation, c_mktsegment AS segment, NULL AS kind FROM customer UNION ALL SELECT s_nationkey, NULL, 'supplier' FROM supplier)
""")
def schema_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "customer").select(q("c_nationkey").alias("nation"), q("c_mktsegment").alias("segment"))
    b = table(spark, sf_dir, "supplier").select(F.lit("supplier").alias("kind"), q("s_nationkey").alias("nation"))
    both = sets.distinct(columns.align(sets.union([a, b]), columns.union_schema([a, b])))
    left, right = sets.column_diff(a, b)
    return columns.with_constants(both, {"left_only": ",".join(left), "right_only": ",".join(right)})


@query("""
SELECT 'r_name' AS key, max(CASE r_regionkey WHEN 0 THEN r_name END) AS "0", max(CASE r_regionkey WHEN 1 THEN r_name END) AS "1", max(CASE r_regionkey WHEN 2 THEN r_name END) AS "2",
       max(CASE r_regionkey WHEN 3 THEN r_name END) AS "3", max(CASE r_regionkey WHEN 4 THEN r_name END) AS "4" FROM region
""")
def transposed_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.transposed(table(spark, sf_dir, "region").select("r_regionkey", "r_name"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey % 4 = 3")
def named_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blank, dotted and underscored names go."""
    name = F.when(q("c_custkey") % 4 == 0, " ").when(q("c_custkey") % 4 == 1, "..").when(q("c_custkey") % 4 == 2, F.concat(F.lit("_"), "c_name")).otherwise(q("c_name"))
    return filters.skip_names(table(spark, sf_dir, "customer").select("c_custkey", name.alias("c_name")), "c_name")


# ---- joins and aggregations ----


@query("""
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, d.n FROM lineitem l
LEFT JOIN (SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2) d ON l.l_partkey = d.l_partkey AND l.l_suppkey = d.l_suppkey
""")
def composite_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    returned = lines.filter("l_returnflag = 'R'").groupBy("l_partkey", "l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    return joins.join_left(lines.select(*LINE), returned, ["l_partkey", "l_suppkey"]).select(*LINE, "n")


@query("""
SELECT o_custkey, arg_max(o_orderkey, o_orderkey) FILTER (o_orderstatus = 'F') AS f, arg_max(o_orderkey, o_orderkey) FILTER (o_orderstatus = 'O') AS o FROM orders GROUP BY o_custkey
""")
def merged_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key/value pairs of each customer as a map in which the last value of a key stays."""
    pairs = F.array_sort(F.collect_list(F.struct("o_orderkey", q("o_orderstatus").alias("status"))))
    lists = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(pairs.alias("pairs"))
    merged = aggregates.merge_last(F.transform("pairs", lambda x: F.struct(x["status"].alias("key"), x["o_orderkey"].alias("value"))))
    found = lists.withColumn("m", merged)
    return found.select("o_custkey", *[F.try_element_at("m", F.lit(k)).cast("long").alias(k.lower()) for k in ("F", "O")])


@query("""
SELECT c_mktsegment, CAST((SELECT count(*) FROM orders WHERE o_orderstatus = 'O') AS INT) AS empty, CAST((SELECT count(*) FROM orders WHERE o_orderstatus <> 'O') AS INT) AS filled, -1 AS missing,
       CAST((SELECT count(*) FROM customer) AS INT) AS rows
FROM (SELECT DISTINCT c_mktsegment FROM customer)
""")
def value_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    orders = table(spark, sf_dir, "orders").select(F.nullif("o_orderstatus", F.lit("O")).alias("status"))
    counts = {"empty": aggregates.empty_count(orders, "status"), "filled": aggregates.filled_count(orders, "status"), "missing": aggregates.empty_count(orders, "none"), "rows": customers.count()}
    return columns.with_constants(aggregates.distinct_values(customers, "c_mktsegment"), counts)


# ---- order ----


@query("SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey DESC LIMIT 20")
def sorted_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.head(sampling.sort(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), "c_acctbal", "c_custkey", descending=True), 20)


@query("SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal, c_custkey LIMIT 20")
def ordered_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.head(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), 20, ["c_acctbal", "c_custkey"])


@query("""
SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'O'), nullif(o_orderpriority, '1-URGENT')) AS best FROM orders WHERE o_orderstatus <> 'O' OR o_orderpriority <> '1-URGENT'
""")
def preferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.nullif("o_orderstatus", F.lit("O")).alias("a"), F.nullif("o_orderpriority", F.lit("1-URGENT")).alias("b"))
    return sampling.prefer(orders, ["a", "b"], "best").select("o_orderkey", "best")


# ---- functions on text ----


@query("""
SELECT c_custkey, c_name AS trimmed, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END AS nulled, 'a/' || c_custkey AS without_last,
       CASE WHEN c_nationkey % 2 = 0 THEN c_mktsegment ELSE c_mktsegment || ' (' || c_nationkey || ')' END AS genus,
       CASE WHEN c_nationkey % 3 = 0 THEN '' WHEN c_nationkey % 3 = 1 THEN c_name || ', ' || c_nationkey ELSE '(' || c_name || ', ' || c_nationkey || ')' END AS authorship,
       'L. ' || c_custkey AS authority, 'a ' || c_custkey || ' b' AS squeezed, CAST(c_custkey AS VARCHAR) || '000' AS number, c_custkey % 2 = 1 AS flag,
       CAST(ceil(c_custkey / 7.0) AS BIGINT) AS pages, 'http://h/p?name=' || replace(c_name, '#', '%23') || '&on=true&x=1&x=' || c_custkey AS url,
       replace(c_name, '#', '') AS replaced, coalesce(nullif(c_mktsegment, 'BUILDING'), 'none') AS filled, c_mktsegment LIKE 'B%' AS starts
FROM customer
""")
def text_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, nation = q("c_custkey"), q("c_nationkey")
    text = key.cast("string")
    name = F.concat(F.lit("Aus c"), text)
    return table(spark, sf_dir, "customer").select(
        "c_custkey", X.trim_set(F.concat(F.lit("-_ "), "c_name", F.lit("_-")), "-_ ").alias("trimmed"), X.null_if_match("c_mktsegment", "B.*G").alias("nulled"),
        X.without_last(F.concat(F.lit("a/"), text, F.lit("/b/c")), 2).alias("without_last"),
        X.canonical_genus("c_mktsegment", F.when(nation % 2 == 0, " ").otherwise(nation.cast("string"))).alias("genus"),
        X.authorship(F.when(nation % 3 == 0, "NaN").otherwise(q("c_name")), nation.cast("string"), nation % 3 == 1).alias("authorship"),
        X.clean_authority(F.concat(name, F.lit(" (L. "), text, F.lit(")")), name, F.lit("old name")).alias("authority"),
        X.squeeze(F.concat(F.lit("a   "), text, F.lit("  b"))).alias("squeezed"), X.clean_number(F.concat(text, F.lit(",000"))).alias("number"),
        X.to_flag((key % 2).cast("string")).alias("flag"), X.pages("c_custkey", 7).alias("pages"),
        X.build_url(F.lit("http://h/p"), {"name": q("c_name"), "on": F.lit(True), "none": F.lit(None).cast("string"), "x": [F.lit(1), key]}).alias("url"),
        F.replace("c_name", F.lit("#"), F.lit("")).alias("replaced"), F.coalesce(F.nullif("c_mktsegment", F.lit("BUILDING")), F.lit("none")).alias("filled"),
        F.startswith("c_mktsegment", F.lit("B")).alias("starts"),
    )


@query("""
SELECT c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), 'no segment') AS segment, coalesce(nullif(c_name, 'x'), '') AS name FROM customer
""")
def filled_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "customer").select("c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"), F.nullif("c_name", F.lit("x")).alias("name"))
    return columns.fill(columns.fill(df, {"segment": F.lit("no segment")}), "")


# ---- nested data ----


def _nested_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.struct(q("o_orderstatus").alias("status"), F.struct(q("o_custkey").alias("key")).alias("customer"))
    tagged = F.struct(q("o_orderpriority").alias("_VALUE"), q("o_orderstatus").alias("_kind"))
    items = F.array(F.struct(F.lit("first").alias("v")), F.struct(q("o_orderpriority").alias("v")))
    return table(spark, sf_dir, "orders").select("o_orderkey", status.alias("o"), F.struct(q("o_orderkey").alias("_id"), tagged.alias("Tag"), items.alias("Items")).alias("x"))


@query("SELECT o_orderkey, o_orderstatus AS o_status, o_custkey AS key FROM orders")
def flatten_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.flatten_one(_nested_orders(spark, sf_dir).drop("x")).select("o_orderkey", "o_status", q("o_customer")["key"].alias("key"))


@query("SELECT o_orderkey AS x_id, o_orderpriority AS x_Tag, o_orderstatus AS x_Tag_kind, o_orderpriority AS x_Items_v FROM orders")
def flatten_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.flatten_xml(_nested_orders(spark, sf_dir).select("x"))


@query("SELECT o_orderkey, o_orderstatus AS o_status, o_custkey AS customer_key FROM orders")
def picked_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _nested_orders(spark, sf_dir).select("o_orderkey", "o", F.struct(F.col("o.customer.key").alias("customer")).alias("c"))
    return df.select("o_orderkey", *nested.pick(df, "o", ["status", "missing"], prefix="o"), *nested.pick(df, "c", ["customer"], suffix="key"))


@query("""
SELECT o_custkey, max(o_orderkey) FILTER (o_orderpriority = '1-URGENT') AS urgent, max(o_orderkey) FILTER (o_orderpriority = '5-LOW') AS unknown FROM orders GROUP BY o_custkey
""")
def keyed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of a list as columns by their description; those without one count as Unknown."""
    item = F.struct("o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("description"))
    lists = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(item)).alias("items"))
    found = nested.key_list(lists, "items", "description", ["1-URGENT", "Unknown"])
    return found.select("o_custkey", q("1-URGENT")["o_orderkey"].alias("urgent"), q("Unknown")["o_orderkey"].alias("unknown"))


@query("SELECT c_custkey, c_name AS trend, c_mktsegment || '|' || c_nationkey AS realms, c_mktsegment AS plain FROM customer")
def unwrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    wrap = lambda c: F.struct(F.struct(c.cast("string").alias("en"), F.lit("x").alias("fr")).alias("description"), F.lit(1).alias("code"))
    df = table(spark, sf_dir, "customer").select("c_custkey", wrap(q("c_name")).alias("trend"), F.array(wrap(q("c_mktsegment")), wrap(q("c_nationkey"))).alias("realms"), q("c_mktsegment").alias("plain"))
    return nested.unwrap_description(df, ["trend", "realms", "plain"]).withColumn("realms", F.array_join("realms", "|"))


@query("""
SELECT c_custkey, c_name || ' found None, True' AS name, c_nationkey AS n, CAST(NULL AS VARCHAR) AS empty, c_custkey % 2 = 0 AS flag FROM customer
""")
def parsed_literals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Printed records: words like None inside quoted text stay."""
    flag = F.when(q("c_custkey") % 2 == 0, "True").otherwise("False")
    printed = F.concat(F.lit("{'name': '"), "c_name", F.lit(" found None, True', \"n\": "), "c_nationkey", F.lit(", 'empty': None, 'flag': "), flag, F.lit("}"))
    return nested.parse_literal(table(spark, sf_dir, "customer").select("c_custkey", printed.alias("printed")), "printed", "name string, n int, empty string, flag boolean")


@query("""
SELECT c_custkey, '{"sex":"' || c_mktsegment || '","place":"' || c_nationkey || '"}' AS attrs, 'http://h/' || c_custkey AS url,
       CASE WHEN c_custkey % 3 = 0 THEN 'A' || c_custkey WHEN c_custkey % 3 = 1 THEN 'SAMN' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') ELSE 'none' END AS id
FROM customer
""")
def sample_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributes as JSON text, the last one of a name and harmonised names first; the last link; ids with a fallback."""
    key = q("c_custkey")
    pair = lambda n, h, v: F.struct(F.lit(n).alias("attribute_name"), (F.lit(h) if h else F.lit(None).cast("string")).alias("harmonized_name"), v.cast("string").alias("value"))
    attributes = F.array(pair("sex", None, F.lit("first")), pair("Sex of it", "sex", q("c_mktsegment")), pair("place", None, q("c_nationkey")))
    link = lambda t, v: F.struct(F.lit(t).alias("type"), v.alias("value"))
    links = F.array(link("url", F.lit("old")), link("url", F.concat(F.lit("http://h/"), key)), link("doi", F.lit("d")))
    df = table(spark, sf_dir, "customer").select("c_custkey", attributes.alias("a"), links.alias("links"))
    df = nested.pick_link(nested.attributes_to_map(df, "a", "attrs"), "links", "url")
    id_ = nested.sample_id(F.when(key % 3 == 0, F.concat(F.lit("A"), key)), F.when(key % 3 == 1, key))
    return df.select("c_custkey", "attrs", "url", id_.alias("id"))


@query("SELECT c_custkey AS key, c_name AS name, CAST(c_nationkey AS INT) AS nation, CAST(NULL AS VARCHAR) AS none FROM customer")
def projected(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "customer").select("c_custkey", F.struct(F.struct(q("c_nationkey").alias("key")).alias("nation"), q("c_name").alias("name")).alias("c"))
    return nested.project(df, {"key": "c_custkey", "name": "c.name", "nation": "c.nation.key", "none": "c.no.such"})


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS title, 'h/' || c_custkey AS link, c_mktsegment || ',' || c_nationkey AS keywords, 'P' || c_nationkey AS places, 'F ' || c_name AS authors,
       'O' AS funders, '' AS license, 'Title: ' || c_name || chr(10) || 'Abstract: ' || chr(10) || 'Keywords:' || chr(10) || '- ' || c_mktsegment || chr(10) || '- ' || c_nationkey AS summary
FROM customer
""")
def dataset_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "customer").select(
        q("c_custkey").cast("string").alias("id"), q("c_name").alias("title"), F.struct(F.struct(F.struct(F.concat(F.lit("h/"), "c_custkey").alias("href")).alias("self")).alias("self_")).alias("x"),
        F.struct(F.struct(F.concat(F.lit("h/"), "c_custkey").alias("href")).alias("self")).alias("_links"), F.array(q("c_mktsegment"), q("c_nationkey").cast("string")).alias("keywords"),
        F.array(F.struct(F.concat(F.lit("P"), "c_nationkey").alias("place"))).alias("locations"), F.array(F.struct(F.lit("F").alias("firstName"), q("c_name").alias("lastName"))).alias("authors"),
        F.array(F.struct(F.lit("O").alias("organization"))).alias("funders"),
    )
    found = nested.project_entries(df)
    return found.select("id", "title", "link", *[F.array_join(c, ",").alias(c) for c in ("keywords", "places", "authors", "funders")], "license", "summary")


# ---- pages ----


@query("""
SELECT c_custkey, 'Habitat' AS section, CAST(i AS INT) AS item_no, CASE i WHEN 0 THEN 'Where' END AS label, CASE i WHEN 0 THEN 'n ' || c_nationkey ELSE c_mktsegment END AS value FROM customer, range(2) t(i)
UNION ALL SELECT c_custkey, 'Names', 0, NULL, c_name FROM customer
""")
def page_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled sections of a page made of each customer."""
    page = F.concat(F.lit("<p>lead</p><h3>Habitat</h3><ul><li><b>Where:</b> n "), "c_nationkey", F.lit("</li><li>"), "c_mktsegment", F.lit("</li></ul><h3>Names</h3><div><p>"), "c_name", F.lit("</p></div>"))
    customers = spread(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", "c_name"))
    return html.html_sections(customers.select("c_custkey", page.alias("html")), "c_custkey", "html")


@query("SELECT c_custkey, CAST(c_custkey AS VARCHAR) || '000' AS size, 'h/' || c_nationkey AS raw_files, 'base/' || c_custkey AS page FROM customer")
def page_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A genome project's table by header rules: links by their text, prefixed addresses, plain numbers."""
    page = F.concat(
        F.lit("<table><tr><th>Size</th><th>Data</th><th>Page</th></tr><tr><td>"), "c_custkey", F.lit(",000</td><td><a href='h/"), "c_nationkey", F.lit("'>files</a></td><td><a href='"), "c_custkey",
        F.lit("'>x</a></td></tr></table>"),
    )
    pages = table(spark, sf_dir, "customer").select(q("c_custkey").alias("page_id"), page.alias("html"))
    found = genomes.vgp(pages, {"size": "Size", "raw_files": "raw_files", "page": "Page"}, {"Data": "raw_"}, {"Page": "base/"})
    return found.select(q("page_id").alias("c_custkey"), "size", "raw_files", "page")


# ---- steps ----


@query("""
SELECT 'land' AS step, CAST(c_custkey % 2 AS INT) AS index, c_custkey, c_name, n AS rows FROM customer JOIN (SELECT c_custkey % 2 AS p, count(*) AS n FROM customer GROUP BY 1) ON c_custkey % 2 = p
""")
def step_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One step over two landed tables, its runs logged with their counts and read back, the latest successful one of each."""
    folder = landing(spark, "steps")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    for k in range(2):
        customers.filter(q("c_custkey") % 2 == k).write.parquet(f"{folder}/in{k}")

    @incremental.step(inputs=1)
    def numbered(df: DataFrame) -> DataFrame:
        return df.withColumn("index", (q("c_custkey") % 2).cast("int"))

    out = incremental.map_inputs(spark, lambda df: incremental.chain(df, numbered), [f"{folder}/in{k}" for k in range(2)], lambda s, p: s.read.parquet(p))
    for k in range(2):
        n = spark.read.parquet(f"{folder}/in{k}").count()
        for day, success in (("2024-01-01", True), ("2024-01-02", True), ("2024-01-03", False)):
            from datetime import datetime

            incremental.log_run(spark, f"{folder}/log", step="land", index=k, success=success, task_started=datetime.fromisoformat(day), counts={"rows": n if day.endswith("2") else -1})
    runs = incremental.latest_runs(spark, f"{folder}/log").select("step", q("index").alias("of"), F.col("counts")["rows"].alias("rows"))
    return out.join(runs, q("index") == q("of")).select("step", "index", "c_custkey", "c_name", "rows")


@query("SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) <= 2")
def ordinal_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = windows.ordinal(table(spark, sf_dir, "orders"), ["o_custkey"], [F.desc("o_orderdate"), "o_orderkey"])
    return found.filter("ordinal <= 2").select("o_custkey", "o_orderkey")


# ---- columns that the data decide ----

_SEEN = """CASE event_type WHEN 'view' THEN '{"views": {"n": ' || event_id || ', "of": ["u' || user_id || '", "x"]}, "props": ' || props || '}' ELSE '{"' || event_type || 's": {"n": ' || event_id || '}}' END"""


@query(f"""
WITH j AS (SELECT event_id, {_SEEN} AS j FROM events), k AS (SELECT event_id, unnest(json_keys(j)) AS k, j FROM j),
top AS (SELECT k FROM k GROUP BY k ORDER BY count(*) DESC, k LIMIT 2)
SELECT j.event_id, (SELECT string_agg(k, ',' ORDER BY k) FROM top) AS columns, string_agg(CASE WHEN k.k IN (SELECT k FROM top) THEN k.k || '=' || CAST(json_extract(k.j, '$.' || k.k || '.n') AS VARCHAR) END, ',' ORDER BY k.k) AS values,
       string_agg(CASE WHEN k.k NOT IN (SELECT k FROM top) THEN k.k END, ',' ORDER BY k.k) AS rest
FROM j LEFT JOIN k ON j.event_id = k.event_id GROUP BY j.event_id
""")
def json_widened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON whose keys are values of the data: the two most frequent become columns, a map keeps the others."""
    seen = table(spark, sf_dir, "events").select("event_id", F.expr(_SEEN).alias("j"))
    wide = schema.json_columns(seen, "j", width=2)
    names = [c for c in wide.columns if c not in ("event_id", "rest")]
    number = lambda c: F.get_json_object(F.to_json(F.struct(q(c).alias("v"))), "$.v.n")
    values = F.nullif(F.concat_ws(",", *[F.when(q(c).isNotNull(), F.concat(F.lit(f"{c}="), number(c))) for c in names]), F.lit(""))
    return wide.select("event_id", F.lit(",".join(names)).alias("columns"), values.alias("values"), F.array_join(F.array_sort(F.map_keys("rest")), ",").alias("rest"))


@query("""
SELECT event_id, unnest(['u' || user_id, 'x']) AS "views|of", event_id AS "views|n", CAST(json_extract(props, '$.k') AS BIGINT) AS "props|k" FROM events WHERE event_type = 'view'
""")
def json_flattened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON without a declared schema, flattened with its arrays exploded."""
    seen = table(spark, sf_dir, "events").filter("event_type = 'view'").select("event_id", F.expr(_SEEN).alias("j"))
    return schema.flatten_json(seen, "j").drop("rest")


@query("""
WITH p AS (SELECT o_custkey, o_orderpriority AS name, o_orderstatus AS value, o_orderkey AS place FROM orders), l AS (SELECT o_custkey, name, arg_max(value, place) AS value FROM p GROUP BY ALL),
top AS (SELECT name FROM p GROUP BY name ORDER BY count(*) DESC, name LIMIT 3)
SELECT o_custkey, coalesce(string_agg(name || '=' || value, ',' ORDER BY name) FILTER (name IN (SELECT name FROM top)), '') AS shown, string_agg(name || '=' || value, ',' ORDER BY name) FILTER (name NOT IN (SELECT name FROM top)) AS rest
FROM l GROUP BY o_custkey
""")
def named_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key/value rows to columns that the most frequent names give; the other names in a map."""
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority", "o_orderstatus", "o_orderkey")
    wide = schema.key_values(rows, "o_custkey", "o_orderpriority", "o_orderstatus", ["o_orderkey"], width=3)
    shown = F.concat_ws(",", *[F.concat(F.lit(f"{c}="), q(c)) for c in wide.columns[1:-1]])
    rest = F.array_join(F.transform(F.map_entries("rest"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    return wide.select("o_custkey", shown.alias("shown"), rest.alias("rest"))


@query("""
SELECT l_orderkey, max(CASE WHEN l_returnflag = 'A' THEN l_linenumber END) AS "A", max(CASE WHEN l_returnflag = 'N' THEN l_linenumber END) AS "N", count(*) FILTER (l_returnflag = 'R') AS others
FROM lineitem GROUP BY l_orderkey
""")
def listed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of records keyed by what the data hold; 'R' is among the two most frequent only if it is."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_returnflag"))).alias("lines"))
    plain = F.transform("lines", lambda x: F.struct(x["l_returnflag"].alias("flag"), x["l_linenumber"].alias("no")))
    wide = schema.keyed_records(lines.select("l_orderkey", plain.alias("lines")), "lines", "flag")
    others = F.size(F.filter(plain, lambda x: x["flag"] == "R")).cast("long").alias("others")
    return wide.join(lines.select("l_orderkey", others), "l_orderkey").select("l_orderkey", F.col("A")["no"].alias("A"), F.col("N")["no"].alias("N"), "others")


# ---- functions of the user's own ----


@query("""
WITH g AS (SELECT o_custkey, min(k) AS a, max(k) AS b FROM (SELECT o_custkey, CAST(o_orderkey AS VARCHAR) AS k FROM orders) GROUP BY o_custkey)
SELECT o_custkey, substring(a, 1, coalesce(list_position(list_transform(range(1, least(length(a), length(b)) + 1), lambda i: a[i] = b[i]), false) - 1, least(length(a), length(b)))) AS prefix FROM g
""")
def common_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest text that all order numbers of a customer begin with, a group function that Spark lacks."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", q("o_orderkey").cast("string").alias("key"))
    return groups.common_prefix(orders, ["o_custkey"], "key")


@query("""
WITH d AS (SELECT DISTINCT l_suppkey, CAST(l_quantity AS BIGINT) AS v FROM lineitem), n AS (SELECT l_suppkey, v - lag(v) OVER (PARTITION BY l_suppkey ORDER BY v) AS gap FROM d)
SELECT l_suppkey, max(gap) AS gap FROM n GROUP BY l_suppkey
""")
def largest_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups.largest_gap(table(spark, sf_dir, "lineitem").select("l_suppkey", q("l_quantity").cast("long").alias("v")), ["l_suppkey"], "v")


@query("""
SELECT o_orderkey, unnest([0, 1, 2]) AS place, unnest(['LOCUS', 'REFERENCE', 'ORIGIN']) AS name, unnest(['O' || o_orderkey || ' 9 bp', '1', '1 acgt']) AS body,
       unnest([NULL, 'A. ' || o_orderpriority || ' and B.', NULL]) AS authors, unnest([NULL, 'On ' || o_orderstatus, NULL]) AS title FROM orders
""")
def lateral_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections of records as rows, by a table function in SQL whose columns follow its constant argument."""
    tables.register(spark)
    record = F.concat(F.lit("LOCUS       O"), "o_orderkey", F.lit(" 9 bp\nREFERENCE   1\n  AUTHORS   A. "), "o_orderpriority", F.lit("\n            and B.\n  TITLE     On "), "o_orderstatus", F.lit("\nORIGIN\n        1 acgt"))
    orders = spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus"))
    orders.select("o_orderkey", record.alias("record")).createOrReplaceTempView("flat_records")
    return spark.sql("SELECT o_orderkey, s.* FROM flat_records, LATERAL record_sections(record, 'AUTHORS,TITLE') s")


@query("""
SELECT page_id, 1 AS level, length(regexp_extract(html, '<h1>(.*?)</h1>', 1)) > 0 AS titled FROM pages WHERE regexp_matches(html, '<h1>.*?</h1>')
""")
def lateral_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headings of pages as rows, by a table function used laterally."""
    tables.register(spark)
    table(spark, sf_dir, "pages").select("page_id", "html").createOrReplaceTempView("headed_pages")
    return spark.sql("SELECT page_id, s.level, length(s.title) > 0 AS titled FROM headed_pages, LATERAL page_sections(html) s")
