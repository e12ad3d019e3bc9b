"""Checklists and taxonomies."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.functions.text import authorship, canonical_genus, clean_authority, split_part, to_flag, trim_set
from fieldloom.operators import aggregates, filters, html, joins, nested, trees, windows
from fieldloom.operators.columns import drop_strict, lower_columns, over_text, q, remove_spaces, rename, replace_values, snake_columns, underscore_columns, with_constants

#: Columns of a fauna checklist that aren't kept.
FAUNA_DROPPED = (
    "CAVS_CODE",
    "CAAB_CODE",
    "PUB_PUB_FORMATTED",
    "PUB_PUB_QUALIFICATION",
    "PUBLICATION_LAST_UPDATE",
    "PARENT_PUBLICATION_GUID",
)
#: Its columns and the names they get.
FAUNA_NAMES = {
    "NAME_TYPE": "taxonomic_status",
    "RANK": "taxon_rank",
    "NAME_GUID": "name_id",
    "TAXON_GUID": "taxon_id",
    "TAXON_LAST_UPDATE": "updated_at",
    "PARENT_TAXON_GUID": "parent_taxon_id",
    "PUB_PUB_AUTHOR": "publication_author",
    "PUB_PUB_YEAR": "publication_year",
    "PUB_PUB_TITLE": "publication_title",
    "PUB_PUB_PAGES": "publication_pages",
    "PUB_PUB_PUBLICATION_DATE": "publication_date",
    "PUB_PUB_PUBLISHER": "publisher",
    "PUB_PUB_TYPE": "publication_type",
    "PUBLICATION_GUID": "publication_id",
}
#: Titles that are joined to one.
FAUNA_TITLES = ("PUB_PUB_PARENT_BOOK_TITLE", "PUB_PUB_PARENT_JOURNAL_TITLE", "PUB_PUB_PARENT_ARTICLE_TITLE")
#: Ranks that are carved out, with the rank and qualification they get.
CARVED = {"Species Inquirenda": ("Species", "species inquirendum"), "Incertae Sedis": ("Family", "incertae sedis")}


def afd_cleanup(df: DataFrame, dataset_id: str) -> DataFrame:
    """Fauna names made uniform: titles, ids, doubtful ranks carved out, names and authorship composed."""
    df = rename(drop_strict(df, FAUNA_DROPPED), FAUNA_NAMES)
    df = df.withColumn("published_media_title", F.concat(*FAUNA_TITLES)).drop(*FAUNA_TITLES)
    df = filters.filter_ne(rename(lower_columns(df), {"qualification": "notes"}), "scientific_name", "Unplaced Synonym(s)")
    df = df.withColumns({
        "dataset_id": F.lit(dataset_id), "entity_id": F.concat(F.lit(dataset_id), F.lit(";"), "scientific_name", F.lit(";"), "taxonomic_status"),
        "nomenclatural_code": F.lit("ICZN"), "created_at": F.lit(""), "qualification": F.lit(""),
    })
    parts = []
    for rank, (new_rank, qualification) in CARVED.items():
        df, carved = filters.split_where(df, F.col("taxon_rank") == rank)
        doubtful, valid = filters.split_where(carved, F.col("taxonomic_status") == "Valid Name")
        told = with_constants(doubtful, {"taxon_rank": new_rank, "taxonomic_status": "Valid Name", "qualification": qualification})
        parts.append(joins.fetch_from_twin(told, valid, "taxon_id", "family"))
    df = reduce(lambda a, b: a.unionByName(b), parts, df).na.fill("")
    df = df.withColumn("year", split_part("year")).withColumn("canonical_genus", canonical_genus("genus", "subgenus"))
    species = F.concat_ws(" ", "canonical_genus", "species")
    name = F.when(F.col("taxon_rank") == "Species", species).when(F.col("taxon_rank") == "subspecies", F.concat_ws(" ", species, "subspecies")).otherwise(F.col("names_various"))
    known = ~F.col("author").isin("", "NaN", "nan")
    return df.withColumns({
        "canonical_name": name, "authorship": F.when(known, F.concat("author", F.lit(", "), "year")).otherwise(""),
        "scientific_name_authorship": F.when(known, authorship("author", "year", F.col("orig_combination") != "N")).otherwise(""),
    })


def afd_parents(df: DataFrame) -> DataFrame:
    """Parent and accepted usage by two self-joins; valid names and synonyms alone stay."""
    valid = df.filter("taxonomic_status = 'Valid Name' and taxon_id is not null")
    parent = valid.select(F.col("taxon_id").alias("parent_taxon_id"), F.col("scientific_name").alias("parent_taxon"), F.col("taxon_rank").alias("parent_rank"))
    out = joins.join_left(df, parent, "parent_taxon_id")
    names = {"taxon_id": "accepted_usage_taxon_id", "scientific_name": "accepted_usage_taxon", "taxon_rank": "accepted_usage_taxon_rank"}
    return joins.add_accepted(out, "taxon_id", names, F.col("taxonomic_status") == "Valid Name", ("taxonomic_status", ["Valid Name", "Synonym"]))


def afd_enrich(df: DataFrame, pages: DataFrame, names: dict[str, str]) -> DataFrame:
    """Sections of taxon pages (taxon_id, rank, name, html) joined to the rows of their rank."""
    sections = html.section_values(html.html_sections(pages, "taxon_id", "html"), "taxon_id", names)
    keyed = pages.select("taxon_id", *[F.when(F.col("rank") == r, F.col("name")).alias(r) for r in ("species", "genus")]).join(sections, "taxon_id")
    return joins.enrich_by_rank(df, keyed, "taxon_id", "canonical_name", ["species", "genus"])


def afd_collect(nodes: DataFrame, blocks: DataFrame) -> DataFrame:
    """Names of all blocks that the checklist's tree leads to, with the ranks on the way."""
    reached = trees.walk_tree(nodes, "key", "parent", "has_block", "rank")
    return blocks.join(reached.select(F.col("key").alias("block_key"), F.array_join("path", ";").alias("higher_ranks")), "block_key")


#: Code of nomenclature for each division of the taxonomy dump.
DIVISION_CODES = {
    "INV": "ICZN",
    "BCT": "",
    "MAM": "ICZN",
    "PHG": "",
    "PLN": "ICN",
    "PRI": "ICZN",
    "ROD": "ICZN",
    "SYN": "",
    "UNA": "",
    "VRL": "",
    "VRT": "ICZN",
    "ENV": "ICN",
}
#: Flags of the nodes that send a value to an ancestor's, and classes of names that become columns.
INHERITED = {
    "inherited_div_flag": "division_id", "inherited_GC_flag": "genetic_code_id", "inherited_MGC_flag": "mitochondrial_genetic_code_id",
}
HIDDEN = ("GenBank_hidden_flag", "hidden_subtree_root_flag")


def taxonomy(nodes: DataFrame, names: DataFrame, divisions: DataFrame, classes: list[str], constants: dict[str, object]) -> DataFrame:
    """The taxonomy dump as one table: inherited values, a column for each class of names, divisions, authority.

    names needs line_no, its order in the file; classes are the classes that become columns; constants are added as they are.
    """
    flagged = nodes.withColumns({f: to_flag(f) for f in INHERITED})
    df = trees.resolve_inheritance(flagged, "tax_id", "parent_tax_id", INHERITED).drop(*HIDDEN)
    named = aggregates.pivot_last(names, "tax_id", "name_class", "name_txt", ["line_no"], classes)
    df = joins.join_left(joins.join_left(df, named, "tax_id"), divisions.drop("comments"), "division_id")
    df = joins.map_codes(df, "division_cde", DIVISION_CODES, "nomenclatural_code")
    df = df.withColumn("authority", clean_authority("authority", "scientific name", "synonym"))
    df = with_constants(df, {"taxonomic_status": "", "nomenclatural_act": "names usage"} | constants)
    return underscore_columns(df.drop("in-part"))


#: Columns of the taxonomic units that aren't kept.
UNIT_PARTS = ("unit_ind1", "unit_name1", "unit_ind2", "unit_name2", "unit_ind3", "unit_name3", "unit_ind4", "unit_name4", "n_usage")


def itis(units: DataFrame, kingdoms: DataFrame, ranks: DataFrame, authors: DataFrame, links: DataFrame, dataset_id: str) -> DataFrame:
    """Units with kingdom, rank, author and hybrid author; synonyms with the accepted name."""
    df = units.drop(*UNIT_PARTS)
    df = joins.join_left(df, kingdoms.select("kingdom_id", "kingdom_name"), "kingdom_id")
    df = joins.join_left(df, ranks.select("kingdom_id", "rank_id", "rank_name"), ["kingdom_id", "rank_id"])
    df = joins.join_left(df, authors.select("taxon_author_id", "kingdom_id", "taxon_author"), ["taxon_author_id", "kingdom_id"])
    hybrid = authors.select(F.col("taxon_author_id").alias("hybrid_author_id"), "kingdom_id", F.col("taxon_author").alias("hybrid_author"))
    df = joins.join_left(df, hybrid, ["hybrid_author_id", "kingdom_id"])
    accepted = df.select(F.col("tsn").alias("tsn_accepted"), F.col("complete_name").alias("accepted_name"))
    synonyms = joins.join_left(links.select("tsn", "tsn_accepted").withColumn("taxonomic_status", F.lit("synonym")), accepted, "tsn_accepted")
    df = joins.join_left(df, synonyms, "tsn").na.fill({"taxonomic_status": "valid name"})
    return df.withColumns({"parent_tsn": F.col("parent_tsn").try_cast("long"), "dataset_id": F.lit(dataset_id), "entity_id": F.concat(F.lit(dataset_id), F.col("tsn").cast("string"))})


def apc_denormalize(df: DataFrame) -> DataFrame:
    """Names in snake case, parents by a self-join."""
    df = snake_columns(df)
    parent = df.select(F.col("taxon_id").alias("parent_taxon_id"), F.col("scientific_name").alias("parent_taxon"), F.col("taxon_rank").alias("parent_rank"))
    return joins.join_keys(df, parent, "parent_name_usage_id", "parent_taxon_id")


#: Cells in brackets and what they mean.
PLANT_VALUES = {
    "[unranked]": "unranked",
    "[n/a]": "unranked",
    "[infraspecies]": "infraspecies",
    "[infragenus]": "infragenus",
}


def apc_cleanup(df: DataFrame, dataset_id: str) -> DataFrame:
    df = replace_values(df, PLANT_VALUES)
    return df.withColumns({"dataset_id": F.lit(dataset_id), "entity_id": F.concat(F.lit(f"{dataset_id};"), "scientific_name")})


def col(taxon: DataFrame, profile: DataFrame, vernacular: DataFrame, languages: list[str]) -> DataFrame:
    """Taxa with their profile and a list of common names for each language."""
    key = "dwc:taxonID"
    lists = aggregates.pivot_lists(vernacular, key, "dcterms:language", "dwc:vernacularName", languages)
    return joins.join_left(joins.join_left(taxon, profile, key), lists, key)


def powo(taxon: DataFrame, names: DataFrame) -> DataFrame:
    return with_constants(joins.join_left(taxon, names, "taxonid"), {"nomenclatural_code": "ICZN"})


def worms(taxon: DataFrame, profile: DataFrame, identifier: DataFrame) -> DataFrame:
    return joins.join_outer_chain([taxon, profile, identifier], "taxonID")


def goat(df: DataFrame, order: list[str]) -> DataFrame:
    """One row a taxon with the list of its values."""
    plain = df.withColumn("aggregation_source", F.replace("aggregation_source", F.lit('"'), F.lit("")))
    return aggregates.collect_structs(plain, "taxon_id", ["field", "value", "aggregation_source", "aggregation_method"], order, "data")


def anemone(df: DataFrame, order: list[str]) -> DataFrame:
    """Haplotypes numbered within a sample, ids composed, unidentified cells emptied."""
    df = windows.ordinal(df, ["source_mat_id"], order, "haplotype")
    parts = [trim_set(F.coalesce(q(c).cast("string"), F.lit("")), "unidentified ") for c in ("organismID", "source_mat_id", "haplotype")]
    df = df.withColumn("occurrenceID", F.concat_ws("_", *parts))
    return over_text(df, _identified)


def _identified(c: Column) -> Column:
    """Null where the whole cell says that something is unidentified."""
    return F.when(~F.coalesce(c.rlike(r"^unidentified .*$"), F.lit(False)), c)


def iucn_assessments(df: DataFrame) -> DataFrame:
    """Assessments with descriptions unwrapped and taxon and supplementary fields beside them."""
    df = nested.unwrap_description(df, ["population_trend", "red_list_category", "biogeographical_realms", "systems"]).drop("scopes")
    rest = [c for c in df.columns if c not in ("taxon", "supplementary_info")]
    wrapped = df.select(F.struct(*rest).alias("data"), "taxon", "supplementary_info")
    return nested.merge_structs(wrapped, ["data", "taxon", "supplementary_info"])


def iucn_reduce(df: DataFrame, realms: list[str]) -> DataFrame:
    return remove_spaces(filters.filter_list_overlap(df, "biogeographical_realms", realms))


def add_name(df: DataFrame, scientific_name: str, **fields: object) -> DataFrame:
    """Single-species metadata: the name and further constants."""
    return with_constants(df, {"scientific_name": scientific_name} | fields)


