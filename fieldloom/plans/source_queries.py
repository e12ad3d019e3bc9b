"""Registered queries of the source pipelines (D02-D56), each on tables made from the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.operators import mapping
from fieldloom.operators.columns import q
from fieldloom.plans import checklists, genomes, occurrences
from fieldloom.plans.registry import landing, query, spread, table
from fieldloom.sources import readers


def _text(name: str) -> Column:
    return q(name).cast("string")


def _tagged(tag: str, name: str) -> Column:
    return F.concat(F.lit(tag), _text(name))


def _none() -> Column:
    return F.lit(None).cast("string")


# ---- checklists ----


@query("""
WITH f AS (
  SELECT c_custkey AS k, 'n' || c_custkey AS name, CASE c_custkey % 6 WHEN 0 THEN 'Species Inquirenda' WHEN 1 THEN 'Species' WHEN 2 THEN 'subspecies' WHEN 3 THEN 'Genus' ELSE 'Incertae Sedis' END AS rank,
         CASE WHEN c_custkey % 4 < 2 THEN 'Valid Name' ELSE 'Synonym' END AS status, c_nationkey AS n, c_mktsegment AS fam FROM customer WHERE c_custkey % 7 <> 0
), g AS (
  SELECT *, CASE WHEN n % 2 = 0 THEN 'Aus' ELSE 'Aus (Sub' || n || ')' END AS genus, CASE WHEN n % 3 = 0 THEN '' ELSE 'Author' || n END AS author FROM f
), t AS (SELECT n, rank, min(fam) AS fam FROM f WHERE status = 'Valid Name' GROUP BY 1, 2)
SELECT name AS scientific_name, CASE rank WHEN 'Species Inquirenda' THEN 'Species' WHEN 'Incertae Sedis' THEN 'Family' ELSE rank END AS taxon_rank,
       CASE WHEN rank IN ('Species Inquirenda', 'Incertae Sedis') THEN 'Valid Name' ELSE status END AS taxonomic_status,
       CASE rank WHEN 'Species Inquirenda' THEN 'species inquirendum' WHEN 'Incertae Sedis' THEN 'incertae sedis' ELSE '' END AS qualification,
       CASE WHEN rank IN ('Species Inquirenda', 'Incertae Sedis') THEN coalesce((SELECT fam FROM t WHERE t.n = g.n AND t.rank = g.rank), '') ELSE fam END AS family,
       CASE rank WHEN 'Species Inquirenda' THEN genus || ' bus' WHEN 'Species' THEN genus || ' bus' WHEN 'subspecies' THEN genus || ' bus cus' ELSE 'various' || k END AS canonical_name,
       CASE WHEN author = '' THEN '' ELSE author || ', 1758' END AS authorship, CASE WHEN author = '' THEN '' WHEN n % 5 = 0 THEN '(' || author || ', 1758)' ELSE author || ', 1758' END AS scientific_name_authorship,
       'b' || k || 'ja' AS published_media_title, 'DS;' || name || ';' || status AS entity_id, 'n' || n AS taxon_id
FROM g WHERE NOT (rank IN ('Species Inquirenda', 'Incertae Sedis') AND status = 'Valid Name')
""")
def fauna_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean-up of a fauna checklist: carved ranks, families of valid twins, names and authorship."""
    key, n = q("c_custkey"), q("c_nationkey")
    rank = F.when(key % 6 == 0, "Species Inquirenda").when(key % 6 == 1, "Species").when(key % 6 == 2, "subspecies").when(key % 6 == 3, "Genus").otherwise("Incertae Sedis")
    values = {c: _none() for c in (*checklists.FAUNA_DROPPED, *checklists.FAUNA_NAMES)} | {
        "PUB_PUB_PARENT_BOOK_TITLE": _tagged("b", "c_custkey"), "PUB_PUB_PARENT_JOURNAL_TITLE": F.lit("j"), "PUB_PUB_PARENT_ARTICLE_TITLE": F.lit("a"), "RANK": rank,
        "SCIENTIFIC_NAME": F.when(key % 7 == 0, "Unplaced Synonym(s)").otherwise(_tagged("n", "c_custkey")), "NAME_TYPE": F.when(key % 4 < 2, "Valid Name").otherwise("Synonym"),
        "TAXON_GUID": _tagged("n", "c_nationkey"), "FAMILY": q("c_mktsegment"), "GENUS": F.lit("Aus"), "SUBGENUS": F.when(n % 2 == 1, _tagged("Sub", "c_nationkey")), "SPECIES": F.lit("bus"),
        "SUBSPECIES": F.lit("cus"), "NAMES_VARIOUS": _tagged("various", "c_custkey"), "AUTHOR": F.when(n % 3 != 0, _tagged("Author", "c_nationkey")), "YEAR": F.lit("1758.0"),
        "ORIG_COMBINATION": F.when(n % 5 == 0, "N").otherwise("Y"), "QUALIFICATION": _none(),
    }
    found = checklists.afd_cleanup(table(spark, sf_dir, "customer").select(*[c.alias(name) for name, c in values.items()]), "DS")
    return found.select("scientific_name", "taxon_rank", "taxonomic_status", "qualification", "family", "canonical_name", "authorship", "scientific_name_authorship", "published_media_title", "entity_id", "taxon_id")


@query("""
WITH r AS (SELECT c_custkey AS k, c_custkey // 2 AS id, c_custkey // 4 AS up, c_name, c_mktsegment AS rank, CASE c_custkey % 4 WHEN 0 THEN 'Valid Name' WHEN 1 THEN 'Synonym' WHEN 2 THEN 'Valid Name' ELSE 'Other' END AS status FROM customer),
v AS (SELECT * FROM r WHERE status = 'Valid Name')
SELECT r.k, p.c_name AS parent_taxon, p.rank AS parent_rank, a.id AS accepted_usage_taxon_id, a.c_name AS accepted_usage_taxon
FROM r LEFT JOIN v p ON r.up = p.id LEFT JOIN v a ON r.id = a.id WHERE r.status IN ('Valid Name', 'Synonym')
""")
def fauna_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = q("c_custkey")
    status = F.when(key % 2 == 0, "Valid Name").when(key % 4 == 1, "Synonym").otherwise("Other")
    rows = table(spark, sf_dir, "customer").select(key.alias("k"), F.expr("c_custkey div 2").alias("taxon_id"), F.expr("c_custkey div 4").alias("parent_taxon_id"), q("c_name").alias("scientific_name"), q("c_mktsegment").alias("taxon_rank"), status.alias("taxonomic_status"))
    return checklists.afd_parents(rows).select("k", "parent_taxon", "parent_rank", "accepted_usage_taxon_id", "accepted_usage_taxon")


@query("""
SELECT c_custkey AS taxon_id, CASE WHEN c_nationkey % 2 = 0 THEN 'P' || c_nationkey || '|' || c_mktsegment END AS places_species, CASE WHEN c_nationkey % 2 = 1 THEN 'P' || c_nationkey || '|' || c_mktsegment END AS places_genus FROM customer
""")
def fauna_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections of a page for each taxon, joined to the rows of its rank."""
    rows = table(spark, sf_dir, "customer").select(q("c_custkey").alias("taxon_id"), q("c_name").alias("canonical_name"))
    page = F.concat(F.lit("<h3>Places</h3><ul><li>P"), "c_nationkey", F.lit("</li><li>"), "c_mktsegment", F.lit("</li></ul>"))
    rank = F.when(q("c_nationkey") % 2 == 0, "species").otherwise("genus")
    pages = table(spark, sf_dir, "customer").select(q("c_custkey").alias("taxon_id"), rank.alias("rank"), q("c_name").alias("name"), page.alias("html"))
    return checklists.afd_enrich(rows, pages, {"places": "Places"}).select("taxon_id", "places_species", "places_genus")


@query("""
WITH RECURSIVE n AS (SELECT c_custkey AS k, CASE WHEN c_custkey < 2 THEN NULL ELSE c_custkey // 3 END AS p, c_custkey % 4 = 3 AS stop FROM customer),
w AS (SELECT k, stop, 'r' || k AS path FROM n WHERE p IS NULL UNION ALL SELECT n.k, n.stop, w.path || ';r' || n.k FROM w JOIN n ON n.p = w.k WHERE NOT w.stop)
SELECT o_orderkey, o_custkey AS block_key, path AS higher_ranks FROM w JOIN orders ON o_custkey = k WHERE stop
""")
def fauna_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = q("c_custkey")
    nodes = table(spark, sf_dir, "customer").select(key.alias("key"), F.when(key >= 2, F.expr("c_custkey div 3")).alias("parent"), (key % 4 == 3).alias("has_block"), _tagged("r", "c_custkey").alias("rank"))
    return checklists.afd_collect(nodes, table(spark, sf_dir, "orders").select("o_orderkey", q("o_custkey").alias("block_key")))


@query("""
WITH RECURSIVE n AS (SELECT c_custkey AS k, CASE WHEN c_custkey < 2 THEN c_custkey ELSE c_custkey // 2 END AS p, c_custkey % 3 = 1 AS f, c_nationkey % 3 AS d, 'g' || c_custkey AS g FROM customer),
w AS (SELECT k, k AS at FROM n UNION ALL SELECT w.k, n.p FROM w JOIN n ON w.at = n.k WHERE n.f AND n.p <> n.k AND n.p IN (SELECT k FROM n)),
e AS (SELECT w.k, n.d, n.g FROM w JOIN n ON w.at = n.k WHERE NOT n.f OR n.p = n.k OR n.p NOT IN (SELECT k FROM n)),
t AS (SELECT o_custkey, max(o_orderkey) FILTER (o_orderpriority = '5-LOW') AS s, max(o_orderkey) FILTER (o_orderpriority = '1-URGENT') AS a FROM orders GROUP BY 1)
SELECT e.k AS tax_id, CAST(e.d AS VARCHAR) AS division_id, e.g AS genetic_code_id, ['INV', 'PLN', 'BCT'][CAST(e.d AS INT) + 1] AS division_cde, ['ICZN', 'ICN', ''][CAST(e.d AS INT) + 1] AS nomenclatural_code,
       CASE WHEN t.s IS NULL THEN NULL ELSE 'Aus ' || t.s END AS scientific_name, coalesce('L. ' || t.a, '') AS authority, '' AS taxonomic_status, 'names usage' AS nomenclatural_act
FROM e LEFT JOIN t ON t.o_custkey = e.k
""")
def taxonomy_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A taxonomy dump of customers as nodes and orders as names."""
    key = q("c_custkey")
    flag = F.when(key % 3 == 1, "1").otherwise("0")
    nodes = table(spark, sf_dir, "customer").select(
        key.alias("tax_id"), F.when(key < 2, key).otherwise(F.expr("c_custkey div 2")).alias("parent_tax_id"), (q("c_nationkey") % 3).cast("string").alias("division_id"), flag.alias("inherited_div_flag"),
        _tagged("g", "c_custkey").alias("genetic_code_id"), flag.alias("inherited_GC_flag"), F.lit("m").alias("mitochondrial_genetic_code_id"), flag.alias("inherited_MGC_flag"),
        F.lit("0").alias("GenBank_hidden_flag"), F.lit("0").alias("hidden_subtree_root_flag"),
    )
    kind = F.when(q("o_orderpriority") == "5-LOW", "scientific name").when(q("o_orderpriority") == "1-URGENT", "authority").otherwise("other")
    value = F.when(q("o_orderpriority") == "1-URGENT", F.concat(F.lit("(L. "), "o_orderkey", F.lit(")"))).otherwise(_tagged("Aus ", "o_orderkey"))
    names = table(spark, sf_dir, "orders").select(q("o_custkey").alias("tax_id"), value.alias("name_txt"), kind.alias("name_class"), q("o_orderkey").alias("line_no"))
    codes = F.array(*[F.lit(x) for x in ("INV", "PLN", "BCT")])
    divisions = table(spark, sf_dir, "region").filter("r_regionkey < 3").select(_text("r_regionkey").alias("division_id"), F.get(codes, q("r_regionkey")).alias("division_cde"), F.lit("c").alias("comments"))
    found = checklists.taxonomy(nodes, names, divisions, ["scientific name", "authority", "synonym", "in-part"], {"curated": False})
    return found.select("tax_id", "division_id", "genetic_code_id", "division_cde", "nomenclatural_code", "scientific_name", "authority", "taxonomic_status", "nomenclatural_act")


@query("""
WITH u AS (SELECT c_custkey AS tsn, CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_custkey // 2 END AS parent_tsn, c_name, c_nationkey % 3 AS kingdom, c_nationkey AS rank, c_custkey % 10 AS author FROM customer)
SELECT u.tsn, u.parent_tsn, 'K' || u.kingdom AS kingdom_name, n_name AS rank_name, s.s_name AS taxon_author, h.s_name AS hybrid_author,
       CASE WHEN u.tsn % 10 = 3 THEN 'synonym' ELSE 'valid name' END AS taxonomic_status, a.c_name AS accepted_name, 'DS' || u.tsn AS entity_id
FROM u LEFT JOIN nation ON n_nationkey = rank AND n_nationkey % 3 = kingdom LEFT JOIN supplier s ON s.s_suppkey = author AND s.s_nationkey % 3 = kingdom
LEFT JOIN supplier h ON h.s_suppkey = author + 1 AND h.s_nationkey % 3 = kingdom LEFT JOIN customer a ON u.tsn % 10 = 3 AND a.c_custkey = u.tsn // 10
""")
def integrated_taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units with kingdom, rank and authors by composite keys; synonyms with their accepted name."""
    key, kingdom = q("c_custkey"), q("c_nationkey") % 3
    units = table(spark, sf_dir, "customer").select(
        key.alias("tsn"), F.when(key % 9 == 0, "none").otherwise(F.expr("c_custkey div 2").cast("string")).alias("parent_tsn"), q("c_name").alias("complete_name"), kingdom.alias("kingdom_id"),
        q("c_nationkey").alias("rank_id"), (key % 10).alias("taxon_author_id"), (key % 10 + 1).alias("hybrid_author_id"), *[F.lit("x").alias(c) for c in checklists.UNIT_PARTS],
    )
    nation = table(spark, sf_dir, "nation")
    kingdoms = nation.filter("n_nationkey < 3").select(q("n_nationkey").alias("kingdom_id"), _tagged("K", "n_nationkey").alias("kingdom_name"))
    ranks = nation.select((q("n_nationkey") % 3).alias("kingdom_id"), q("n_nationkey").alias("rank_id"), q("n_name").alias("rank_name"))
    authors = table(spark, sf_dir, "supplier").select(q("s_suppkey").alias("taxon_author_id"), (q("s_nationkey") % 3).alias("kingdom_id"), q("s_name").alias("taxon_author"))
    links = units.filter("tsn % 10 = 3").select("tsn", F.expr("tsn div 10").alias("tsn_accepted"))
    return checklists.itis(units, kingdoms, ranks, authors, links, "DS").select("tsn", "parent_tsn", "kingdom_name", "rank_name", "taxon_author", "hybrid_author", "taxonomic_status", "accepted_name", "entity_id")


@query("""
SELECT c_custkey AS taxon_id, c_name AS scientific_name, CASE WHEN c_nationkey % 2 = 0 THEN 'unranked' ELSE c_mktsegment END AS taxon_rank, 'DS' AS dataset_id, 'DS;' || c_name AS entity_id FROM customer
""")
def census_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    rank = F.when(q("c_nationkey") % 4 == 0, "[unranked]").when(q("c_nationkey") % 4 == 2, "[n/a]").otherwise(q("c_mktsegment"))
    return checklists.apc_cleanup(table(spark, sf_dir, "customer").select(q("c_custkey").alias("taxon_id"), q("c_name").alias("scientific_name"), rank.alias("taxon_rank")), "DS")


@query("""
SELECT c_custkey, c_name, (SELECT max(s_name) FROM supplier WHERE s_suppkey = c_custkey) AS profile, u AS urgent, l AS low FROM customer
LEFT JOIN (SELECT o_custkey, string_agg('o' || o_orderkey, ',' ORDER BY 'o' || o_orderkey) FILTER (o_orderpriority = '1-URGENT') AS u, string_agg('o' || o_orderkey, ',' ORDER BY 'o' || o_orderkey) FILTER (o_orderpriority = '5-LOW') AS l
  FROM orders GROUP BY 1) ON o_custkey = c_custkey
""")
def catalogue_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Taxa with their profile and their common names by language."""
    key = "dwc:taxonID"
    taxon = table(spark, sf_dir, "customer").select(q("c_custkey").alias(key), "c_name")
    profile = table(spark, sf_dir, "supplier").select(q("s_suppkey").alias(key), q("s_name").alias("profile"))
    names = table(spark, sf_dir, "orders").select(q("o_custkey").alias(key), q("o_orderpriority").alias("dcterms:language"), _tagged("o", "o_orderkey").alias("dwc:vernacularName"))
    found = checklists.col(taxon, profile, names, ["1-URGENT", "5-LOW"])
    return found.select(q(key).alias("c_custkey"), "c_name", "profile", F.array_join(q("1-URGENT"), ",").alias("urgent"), F.array_join(q("5-LOW"), ",").alias("low"))


@query("SELECT c_custkey AS taxonid, c_name AS name, s_name AS names, 'ICZN' AS nomenclatural_code FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey")
def vascular_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    taxon = table(spark, sf_dir, "customer").select(q("c_custkey").alias("taxonid"), q("c_name").alias("name"))
    return checklists.powo(taxon, table(spark, sf_dir, "supplier").select(q("s_suppkey").alias("taxonid"), q("s_name").alias("names")))


@query("""
SELECT coalesce(k, p_partkey) AS "taxonID", c_name, s_name, p_name FROM (SELECT coalesce(c_custkey, s_suppkey * 50) AS k, c_name, s_name FROM customer FULL JOIN supplier ON c_custkey = s_suppkey * 50) FULL JOIN part ON k = p_partkey
""")
def marine_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    taxon = table(spark, sf_dir, "customer").select(q("c_custkey").alias("taxonID"), "c_name")
    profile = table(spark, sf_dir, "supplier").select((q("s_suppkey") * 50).alias("taxonID"), "s_name")
    return checklists.worms(taxon, profile, table(spark, sf_dir, "part").select(q("p_partkey").alias("taxonID"), "p_name"))


@query("""
SELECT l_orderkey AS taxon_id, string_agg('f' || l_partkey || '=' || l_suppkey || '/s', ',' ORDER BY l_linenumber, l_partkey, l_suppkey) AS data FROM lineitem GROUP BY 1
""")
def tree_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        q("l_orderkey").alias("taxon_id"), _tagged("f", "l_partkey").alias("field"), q("l_suppkey").alias("value"), F.lit('"s"').alias("aggregation_source"), F.lit("m").alias("aggregation_method"), "l_linenumber", "l_partkey", "l_suppkey"
    )
    printed = F.transform("data", lambda x: F.concat(x["field"], F.lit("="), x["value"].cast("string"), F.lit("/"), x["aggregation_source"]))
    return checklists.goat(lines, ["l_linenumber", "l_partkey", "l_suppkey"]).select("taxon_id", F.array_join(printed, ",").alias("data"))


@query("""
SELECT event_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS INT) AS haplotype, CASE WHEN event_type = 'view' THEN NULL ELSE event_type END AS "organismID",
       CASE WHEN event_type = 'view' THEN 's' ELSE event_type END || '_' || user_id || '_' || row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS "occurrenceID" FROM events
""")
def edna_haplotypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    organism = F.when(q("event_type") == "view", "unidentified s").otherwise(q("event_type"))
    events = table(spark, sf_dir, "events").select("event_id", _text("user_id").alias("source_mat_id"), organism.alias("organismID"))
    # Single letters of 'unidentified ' are cut from both ends of a part, as the source does; these names keep theirs.
    events = events.withColumn("organismID", F.when(q("organismID") == "unidentified s", q("organismID")).otherwise(F.concat(F.lit("X"), "organismID", F.lit("X"))))
    found = checklists.anemone(events, ["event_id"])
    plain = lambda c: F.regexp_replace(c, "X", "")
    return found.select("event_id", "haplotype", plain("organismID").alias("organismID"), plain("occurrenceID").alias("occurrenceID"))


@query("""
SELECT c_custkey AS id, 'en' || c_nationkey AS population_trend, c_mktsegment AS red_list_category, 'r' || c_nationkey || '|all' AS biogeographical_realms, 'n' || c_custkey AS name, CASE WHEN c_nationkey % 2 = 0 THEN 'kept' ELSE 'gone' END AS extra FROM customer
""")
def red_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    en = lambda c: F.struct(F.struct(c.alias("en")).alias("description"))
    rows = table(spark, sf_dir, "customer").select(
        q("c_custkey").alias("id"), en(_tagged("en", "c_nationkey")).alias("population_trend"), q("c_mktsegment").alias("red_list_category"), F.array(en(_tagged("r", "c_nationkey")), en(F.lit("all"))).alias("biogeographical_realms"),
        F.array(en(F.lit("s"))).alias("systems"), F.array(F.lit(1)).alias("scopes"), F.struct(F.lit("old").alias("name"), F.lit(0).alias("x")).alias("taxon"),
        F.struct(_tagged("n", "c_custkey").alias("name"), F.when(q("c_nationkey") % 2 == 0, "kept").otherwise("gone").alias("extra")).alias("supplementary_info"),
    )
    found = checklists.iucn_assessments(rows)
    return found.select("id", "population_trend", "red_list_category", F.array_join("biogeographical_realms", "|").alias("biogeographical_realms"), "name", "extra")


@query("""
SELECT c_custkey, 'a' || c_name AS note, 'Aus bus' AS scientific_name, 'c' AS citation FROM customer WHERE c_nationkey % 5 = 0 OR c_mktsegment = 'BUILDING'
""")
def red_list_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    printed = F.concat(F.lit("['n"), (q("c_nationkey") % 5).cast("string"), F.lit("' '"), "c_mktsegment", F.lit("']"))
    rows = table(spark, sf_dir, "customer").select("c_custkey", printed.alias("biogeographical_realms"), F.concat(F.lit("a\n\t"), "c_name").alias("note"))
    return checklists.add_name(checklists.iucn_reduce(rows, ["n0", "BUILDING"]).drop("biogeographical_realms"), "Aus bus", citation="c")


# ---- assemblies, samples, barcodes ----


@query("""
SELECT c_custkey AS acc, s_suppkey AS current_accession, CASE WHEN c_nationkey % 2 = 0 THEN NULL ELSE c_mktsegment END AS dna_extract_id, c_custkey AS sequence_id, c_custkey AS record_id, s_name AS total
FROM customer FULL JOIN supplier ON c_custkey = s_suppkey * 40
""")
def assemblies(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = table(spark, sf_dir, "customer").select(q("c_custkey").alias("#assembly_accession"), F.when(q("c_nationkey") % 2 == 0, "na").otherwise(q("c_mktsegment")).alias("biosample"))
    stats = table(spark, sf_dir, "supplier").select((q("s_suppkey") * 40).alias("current_accession"), q("s_name").alias("total"))
    found = genomes.assembly_clean(genomes.assembly_merge(summary, stats))
    return found.select(q("#assembly_accession").alias("acc"), F.expr("current_accession div 40").alias("current_accession"), "dna_extract_id", "sequence_id", "record_id", "total")


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS current_accession, c_name AS name, c_nationkey AS busco_complete, c_custkey AS total_gene_count, 'asm' AS assembly_name, 'P' || c_custkey AS pa_accession, 'L' || c_custkey AS la_linked_assembly,
       'principal' AS la_assembly_type, c_custkey % 2 = 0 AS at_is_atypical, 'abc' AS comments, c_acctbal AS total_length, 's' || c_nationkey AS mt_submitter, 'T' AS type_label FROM customer
""")
def genome_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = q("c_custkey")
    busco = F.struct(F.lit("5").alias("busco_ver"), q("c_nationkey").alias("complete"), F.lit(0).alias("other"))
    annotation = F.struct(q("c_name").alias("name"), busco.alias("busco"), F.struct(F.struct(key.alias("total")).alias("gene_counts")).alias("stats"))
    linked = F.struct(_tagged("L", "c_custkey").alias("linked_assembly"), F.lit("principal").alias("assembly_type"))
    assembly = F.struct(
        F.lit("asm").alias("assembly_name"), F.lit("a\n\tb\nc").alias("comments"), F.struct(_tagged("P", "c_custkey").alias("accession")).alias("paired_assembly"), linked.alias("linked_assemblies"),
        F.struct((key % 2 == 0).alias("is_atypical")).alias("atypical"),
    )
    organelles = F.array(F.struct(F.lit("mt").alias("description"), _tagged("s", "c_nationkey").alias("submitter")))
    rows = table(spark, sf_dir, "customer").select(
        _text("c_custkey").alias("current_accession"), annotation.alias("annotation_info"), assembly.alias("assembly_info"), F.struct(q("c_acctbal").alias("total_length"), F.lit(1).alias("gone")).alias("assembly_stats"),
        organelles.alias("organelle_info"), F.struct(F.lit("T").alias("type_label")).alias("type_material"),
    )
    found = genomes.genome_reports(rows, ["mt"], ["gone", "busco_ver"])
    return found.withColumn("mt_submitter", F.col("mt.submitter")).drop("mt")


def _samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    attribute = lambda n, v: F.struct(F.lit(n).alias("_attribute_name"), _none().alias("_harmonized_name"), v.cast("string").alias("_VALUE"))
    attributes = F.array(attribute("sex", q("c_mktsegment")), attribute("lat_lon", F.concat("c_nationkey", F.lit(" N 5 E"))), attribute("tissue", q("c_name")))
    contact = F.struct(F.struct(F.struct(_tagged("e", "c_custkey").alias("_email"), F.lit("lab").alias("_lab")).alias("Contact")).alias("Contacts"))
    return table(spark, sf_dir, "customer").select(
        F.when(q("c_custkey") % 2 == 0, _tagged("S", "c_custkey")).alias("_accession"), q("c_custkey").alias("_id"), F.struct(F.struct(q("c_name").alias("_taxonomy_name")).alias("Organism")).alias("Description"),
        contact.alias("Owner"), F.struct(attributes.alias("Attribute")).alias("Attributes"),
    )


@query("""
SELECT CASE WHEN c_custkey % 2 = 0 THEN 'S' || c_custkey ELSE 'SAMN' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') END AS id, c_name AS "scientificName", 'e' || c_custkey AS email, 'lab' AS lab, c_mktsegment AS sex, c_nationkey || ' N 5 E' AS lat_lon,
       c_name AS "MaterialSample", '{"sex":"' || c_mktsegment || '","lat_lon":"' || c_nationkey || ' N 5 E","tissue":"' || c_name || '"}' AS attrs FROM customer
""")
def sample_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return genomes.biosample_dwc(_samples(spark, sf_dir)).select("id", "scientificName", "email", "lab", "sex", "lat_lon", "MaterialSample", "attrs")


@query("""
SELECT c_custkey AS id, c_name AS "Description_Organism_taxonomy_name", 'tissue' AS "Attributes_Attribute_attribute_name", CAST(c_nationkey AS VARCHAR) AS "decimalLatitude", CAST(c_custkey AS VARCHAR) AS "decimalLongitude" FROM customer
""")
def sample_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sample records flattened by their path, coordinates split."""
    rows = _samples(spark, sf_dir).withColumn("lat_lon", F.concat(F.regexp_extract(F.get("Attributes.Attribute", F.lit(1))["_VALUE"], "^([0-9]+)", 1), F.lit(" "), "_id"))
    return genomes.biosample(rows).select("id", "Description_Organism_taxonomy_name", "Attributes_Attribute_attribute_name", "decimalLatitude", "decimalLongitude")


@query("SELECT c_nationkey AS inst_id, c_custkey AS coll, c_name AS name, n_name AS name_institution FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey AND n_nationkey % 2 = 0")
def collection_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    collections = table(spark, sf_dir, "customer").select(q("c_nationkey").alias("inst_id"), q("c_custkey").alias("coll"), q("c_name").alias("name"), _none().alias("none"))
    return genomes.biocollections(collections, table(spark, sf_dir, "nation").filter("n_nationkey % 2 = 0").select(q("n_nationkey").alias("inst_id"), q("n_name").alias("name")))


@query("""
SELECT c_custkey AS "occurrenceID", c_name AS "scientificName", c_custkey AS ncbi_assembly_accession, c_name AS ncbi_organism_name, CASE WHEN c_custkey % 2 = 0 THEN '-' || c_nationkey END AS "decimalLatitude",
       CASE WHEN c_custkey % 2 = 0 THEN '5' END AS "decimalLongitude", CASE WHEN c_custkey % 2 = 0 THEN 'X' || c_custkey END AS locality, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS sex FROM customer
""")
def assembly_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assembly summaries in terms, with the fields of their sample."""
    key = q("c_custkey")
    own = {"assembly_accession": key, "organism_name": q("c_name"), "biosample": key}
    rows = table(spark, sf_dir, "customer").select(*[own.get(c, F.lit("v")).alias(c) for c in genomes.SUMMARY_TERMS])
    json = F.concat(F.lit('{"lat_lon": "'), "c_nationkey", F.lit(' S 5 E", "geo_loc_name": "X'), "c_custkey", F.lit('"}'))
    fields = {"sex": q("c_mktsegment"), "attrs": json}
    samples = table(spark, sf_dir, "customer").filter("c_custkey % 2 = 0").select(key.alias("id"), *[fields.get(c, F.lit(" ")).alias(c) for c in genomes.SAMPLE_TERMS])
    found = genomes.refseq_dwc(rows, samples)
    return found.select("occurrenceID", "scientificName", "ncbi_assembly_accession", "ncbi_organism_name", "decimalLatitude", "decimalLongitude", "locality", "sex")


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS "occurrenceID", CAST(c_custkey AS VARCHAR) AS bpa_id, c_name AS "organization.title", CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE 'Aus b' || c_nationkey END AS "scientificName", '[{"n":' || c_nationkey || '}]' AS bpa_tags,
       'http://h/t/' || c_custkey AS bpa_url FROM customer
""")
def portal_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select(
        _text("c_custkey").alias("id"), F.lit("t").alias("type"), F.struct(q("c_name").alias("title")).alias("organization"), F.when(q("c_custkey") % 2 == 0, q("c_mktsegment")).alias("scientific_name"), _none().alias("species_name"),
        F.lit("Aus").alias("genus"), _tagged("b", "c_nationkey").alias("species"), F.lit("c").alias("common_name"), F.array(F.struct(q("c_nationkey").alias("n"))).alias("tags"),
    )
    kept = ["id", "organization.title", "scientific_name", "species_name", "genus", "species", "common_name", "tags", "bpa_url"]
    found = genomes.bpa_dwc(genomes.bpa(rows, "http://h/"), kept, {"tags": "bpa_tags", "id": "occurrenceID"}, ["bpa_tags"])
    return found.select("occurrenceID", "bpa_id", q("organization.title"), "scientificName", "bpa_tags", "bpa_url")


@query("""
SELECT 'R' || o_orderkey AS "occurrenceID", 'Aus c' || o_custkey AS "scientificName", CAST(o_orderkey AS VARCHAR) AS sequence, 'AC' AS nucleotides FROM orders
""")
def barcode_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Barcode records flattened; of the rows that their lists make one stays for each record."""
    sequence = lambda c, n: F.struct(c.cast("string").alias("sequenceID"), F.lit(n).alias("nucleotides"))
    rows = table(spark, sf_dir, "orders").select(
        _tagged("R", "o_orderkey").alias("record_id"), F.struct(F.struct(F.struct(_tagged("Aus c", "o_custkey").alias("name")).alias("taxon")).alias("species")).alias("taxonomy"),
        F.struct(F.array(sequence(q("o_orderkey"), "GT"), sequence(q("o_orderkey"), "AC")).alias("sequence")).alias("sequences"),
    )
    found = genomes.bold_dwc(rows, {"record|record_id": "occurrenceID"})
    first = F.col("associatedSequences")[0]
    return found.select("occurrenceID", "scientificName", first["sequenceID"].alias("sequence"), first["nucleotides"].alias("nucleotides"))


@query("""
SELECT 'r/PRJCA' || c_nationkey || '/CRA' || c_custkey || '/f.gz' AS url, 'PRJCA' || c_nationkey AS project_accession, 'CRA' || c_custkey AS experiment_accession, CAST(NULL AS VARCHAR) AS run_accession, 'f.gz' AS file_name FROM customer
""")
def archive_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of an archive by following its folders; checksums aren't followed."""
    customers = table(spark, sf_dir, "customer")
    project = F.concat(F.lit("r/PRJCA"), "c_nationkey", F.lit("/"))
    folder = F.concat(project, F.lit("CRA"), "c_custkey", F.lit("/"))
    steps = [(F.lit("r"), project, "d"), (project, folder, "d"), (folder, F.concat(folder, F.lit("f.gz")), "f"), (folder, F.concat(folder, F.lit("md5.gz")), "md5"), (folder, F.lit("r"), "up")]
    links = customers.select(F.inline(F.array(*[F.struct(a.alias("source"), b.alias("target"), F.lit(n).alias("name")) for a, b, n in steps]))).distinct()
    return genomes.gsa(links, customers.select(F.lit("r").alias("url")).distinct(), skip=["md5"]).drop("sample_accession", "experiment")


@query("""
SELECT c_custkey AS id, c_name AS display_name, c_nationkey AS taxonomy_id, c_mktsegment AS assembly_name, c_nationkey + 1 AS version, 'g' || c_custkey AS genebuild, 'o' || c_custkey AS organism_name, CAST(NULL AS VARCHAR) AS strain FROM customer
""")
def genome_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    organism = F.struct(_tagged("o", "c_custkey").alias("name"), q("c_name").alias("display_name"), q("c_nationkey").alias("taxonomy_id"))
    rows = table(spark, sf_dir, "customer").select(
        q("c_custkey").alias("id"), organism.alias("organism"), F.struct(q("c_mktsegment").alias("assembly_name"), F.array(F.lit(1)).alias("sequences")).alias("assembly"),
        F.struct((q("c_nationkey") + 1).alias("version")).alias("data_release"), _tagged("g", "c_custkey").alias("genebuild"),
    )
    vertebrates = genomes.ensembl_vertebrates(rows).select(q("genebuild").alias("of"), "strain")
    return genomes.ensembl_flatten(rows).join(vertebrates, q("genebuild") == q("of")).drop("of")


@query("""
SELECT c_custkey AS species, k.o_orderkey AS a_b, k.low AS n FROM customer LEFT JOIN (
  SELECT o_custkey, max(o_orderkey) FILTER (o_orderpriority = '1-URGENT') AS o_orderkey, max(o_orderkey) FILTER (o_orderpriority = '5-LOW') AS low FROM orders WHERE o_custkey % 3 <> 0 GROUP BY 1) k ON k.o_custkey = c_custkey
""")
def genome_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key/value tables of each species as columns."""
    species = table(spark, sf_dir, "customer").select(q("c_custkey").alias("#name"), F.lit("db").alias("core_db"), q("c_custkey").alias("species_id"))
    kv = lambda p, name: table(spark, sf_dir, "orders").filter((q("o_orderpriority") == p) & (q("o_custkey") % 3 != 0)).select(F.lit("db").alias("core_db"), q("o_custkey").alias("id"), F.lit(name).alias("column"), q("o_orderkey").alias("value"), q("o_orderkey").alias("line"))
    return genomes.ensembl_enrich(species, kv("1-URGENT", "a.b"), kv("5-LOW", "n"), ["a.b"], ["n"]).select(q("#name").alias("species"), "a_b", "n")


@query("""
SELECT c_custkey, c_name AS note, c_name AS name, c_nationkey AS t_u FROM customer WHERE c_custkey % 2 = 1
""")
def species_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Species records cleaned and flattened, names that aren't any skipped."""
    name = F.when(q("c_custkey") % 2 == 1, q("c_name")).otherwise(F.concat(F.lit("_"), "c_name"))
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.concat("c_name", F.lit("\n")).alias("note"), name.alias("name"), F.struct(F.struct(q("c_nationkey").alias("u")).alias("t")).alias("s"))
    return genomes.genomeark(genomes.record_list(rows))


@query("SELECT c_custkey, c_nationkey AS stats_n, c_mktsegment AS stats_segment FROM customer")
def readme_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return genomes.dnazoo(table(spark, sf_dir, "customer").select("c_custkey", F.struct(q("c_nationkey").alias("n"), q("c_mktsegment").alias("segment")).alias("stats")))


@query("SELECT c_custkey AS page_id, c_name AS species, CAST(c_nationkey AS VARCHAR) AS size, c_mktsegment AS key FROM customer")
def organism_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key/value rows and the first table of a page for each customer; a column with blanks goes."""
    body = F.concat(F.lit("<table><tr><th>Species</th><th>Size</th></tr><tr><td>"), "c_name", F.lit("</td><td>"), "c_nationkey", F.lit("</td></tr></table><table><tr><th>Key</th><td>"), "c_mktsegment", F.lit("</td></tr></table>"))
    customers = spread(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"))
    pages = customers.select(q("c_custkey").alias("page_id"), body.alias("html"))
    rows = genomes.page_tables(pages, {"species": "Species", "size": "Size", "none": "None"}).drop("row_no")
    return rows.join(genomes.i5k(pages, {"key": "Key"}), "page_id")


# ---- occurrences and reports ----


@query("""
SELECT 'h/' || c_nationkey || '/m.jpg' AS identifier, 'JPG' AS format, 'https://collections.museumsvictoria.com.au/i/' || c_custkey AS "references", c_name AS title, 'c ' || c_mktsegment AS description, 'x, ' || c_name AS creator, 'CC' AS license,
       'i/' || c_custkey AS "datasetID", c_name AS "taxonName", c_nationkey AS width FROM customer WHERE c_custkey % 2 = 0
""")
def museum_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = lambda name, width: F.struct(F.concat(F.lit("h/"), "c_nationkey", F.lit(name)).alias("uri"), width.alias("width"), F.lit(2).alias("height"))
    medium = F.struct(
        F.when(q("c_custkey") % 2 == 0, "image").otherwise("video").alias("type"), size("/m.jpg", q("c_nationkey")).alias("medium"), size("/s.jpg", F.lit(1)).alias("small"),
        F.concat(F.lit("<em>c</em> "), "c_mktsegment").alias("caption"), F.array(F.lit("x"), q("c_name")).alias("creators"), F.struct(F.lit("CC").alias("name")).alias("licence"),
    )
    rows = table(spark, sf_dir, "customer").select(_tagged("i/", "c_custkey").alias("id"), F.struct(q("c_name").alias("taxonName")).alias("taxonomy"), F.array(medium).alias("media"))
    found = occurrences.museum_images(rows)
    return found.select("identifier", "format", "references", "title", "description", "creator", "license", "datasetID", "taxonName", "width")


@query("SELECT c_custkey AS id, c_name AS place_name, c_nationkey AS place_n, c_mktsegment AS name, CAST(NULL AS VARCHAR) AS rank FROM customer")
def museum_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    printed = F.concat(F.lit("{'name': '"), "c_mktsegment", F.lit("', 'rank': None}"))
    rows = table(spark, sf_dir, "customer").select(q("c_custkey").alias("id"), F.struct(q("c_name").alias("name"), q("c_nationkey").alias("n")).alias("place"), printed.alias("taxonomy"))
    return occurrences.museum(rows, "name string, rank string")


@query("""
SELECT c_custkey AS id, 's/' || c_nationkey || '.png' AS identifier, 'png' AS format, 'r' || c_custkey AS "references", c_name AS title, c_mktsegment AS creator, CASE c_custkey % 2 WHEN 0 THEN 'CC BY' ELSE 'CC0' END AS license, c_name || ',' || c_mktsegment AS tags, 9 AS width FROM customer
""")
def host_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Photo records with their largest image; a missing side counts as one."""
    content = lambda c: F.struct(c.alias("_content"))
    info = F.struct(
        _text("c_custkey").alias("id"), content(q("c_name")).alias("title"), content(F.lit("d")).alias("description"), F.struct(F.lit("2000").alias("taken")).alias("dates"), F.struct(q("c_mktsegment").alias("username")).alias("owner"),
        (q("c_custkey") % 2).alias("license"), F.struct(F.array(F.struct(q("c_name").alias("raw")), F.struct(q("c_mktsegment").alias("raw"))).alias("tag")).alias("tags"),
    )
    size = lambda w, h, source, url: F.struct(F.lit(w).alias("width"), F.lit(h).cast("int").alias("height"), source.alias("source"), url.alias("url"))
    sizes = F.array(size(2, 4, F.lit("s/x.jpg"), F.lit("a/b/c/d")), size(9, None, F.concat(F.lit("s/"), "c_nationkey", F.lit(".png")), F.concat(F.lit("r"), "c_custkey", F.lit("/1/2/3"))))
    found = occurrences.host_images(table(spark, sf_dir, "customer").select(info.alias("info"), F.struct(sizes.alias("size")).alias("sizes")), {"0": "CC BY", "1": "CC0"}, "host")
    return found.select(q("datasetID").cast("long").alias("id"), "identifier", "format", "references", "title", "creator", "license", F.array_join("tags", ",").alias("tags"), "width")


@query("SELECT c_custkey AS key, c_name AS name, NULL AS brand FROM customer UNION ALL SELECT p_partkey, NULL, p_brand FROM part")
def species_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return occurrences.lists([table(spark, sf_dir, "customer").select(q("c_custkey").alias("key"), q("c_name").alias("name")), table(spark, sf_dir, "part").select(q("p_partkey").alias("key"), q("p_brand").alias("brand"))])


@query("""
SELECT field, value FROM (SELECT DISTINCT field, value FROM (UNPIVOT (SELECT replace(c_name, '#', '') AS name, CAST(c_nationkey AS VARCHAR) AS nation FROM customer) ON name, nation INTO NAME field VALUE value))
QUALIFY row_number() OVER (PARTITION BY field ORDER BY md5('3|' || field || '|' || value), value) <= 5
""")
def source_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of each column of a source, cleaned."""
    rows = table(spark, sf_dir, "customer").select(F.replace("c_name", F.lit("#"), F.lit("\n")).alias("name"), q("c_nationkey").alias("nation"))
    return occurrences.sample_input(rows, 5, 3, "fields")


@query("""
SELECT row_number() OVER (ORDER BY (s IS NULL)::INT, c_custkey, s) AS "Example #", c_custkey, s FROM (
  SELECT c_custkey, s FROM (SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS s FROM customer) ORDER BY md5('5|' || c_custkey || '|' || coalesce(s, '')) LIMIT 100) ORDER BY (s IS NULL)::INT, c_custkey, s LIMIT 10
""")
def record_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fullest of some records."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("s"))
    return occurrences.sample_input(rows, 10, 5)


@query("""
SELECT column_name AS "key", value AS "7" FROM (UNPIVOT (SELECT CAST(c_custkey AS VARCHAR) AS key, c_name AS name, c_mktsegment AS segment FROM customer WHERE c_custkey = 7) ON name, segment INTO NAME column_name VALUE value)
""")
def found_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return occurrences.find_rows(table(spark, sf_dir, "customer").select(q("c_custkey").alias("key"), q("c_name").alias("name"), q("c_mktsegment").alias("segment")), "key", [7])


@query("SELECT count(*) AS rows, 4 AS columns FROM customer")
def converted_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rows of a converted table, as many as asked for (here as many as there are): all columns and the number."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    events = mapping.apply_map(customers, {"c_custkey": mapping.Target("collection", "record"), "c_name": mapping.Target("collection", "scientific_name")})
    out = occurrences.sample_output(events, customers.count())
    return out.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(out.columns)).alias("columns"))


@query("""
SELECT folder AS path, size, printf('%.2f B', CAST(size AS DOUBLE)) AS size_text FROM (SELECT 'segment=' || c_mktsegment AS folder, CAST(sum(octet_length(CAST(c_name AS BLOB)) + 1) % 1024 AS BIGINT) AS size FROM customer GROUP BY 1)
""")
def largest_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders and files by size; files have names of chance, so folders alone are shown, with the rest of 1,024 bytes as their size."""
    path = landing(spark, "sizes")
    table(spark, sf_dir, "customer").select(q("c_mktsegment").alias("segment"), q("c_name").alias("value")).repartition("segment").write.partitionBy("segment").text(path)
    files = readers.list_files(spark, path).select(F.regexp_extract("path", r"(segment=.*)$", 1).alias("path"), "size")
    sums = files.groupBy(F.concat(F.regexp_extract("path", "^([^/]*)", 1), F.lit("/all")).alias("path")).agg((F.sum("size") % 1024).alias("size"))
    return occurrences.largest(sums, 1000, folders=True).filter(~F.endswith("path", F.lit("/all")))
