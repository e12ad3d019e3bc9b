"""Assemblies, sequences, samples and barcodes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldloom.functions.text import prefixed, signed_degrees
from fieldloom.operators import aggregates, html, joins, nested, records
from fieldloom.operators.columns import copy_columns, drop_any_null_columns, drop_empty_columns, keep, null_out, q, remove_spaces, rename, right_only
from fieldloom.operators.filters import skip_names
from fieldloom.operators.trees import crawl_frontier
from fieldloom.operators.windows import keep_first
from fieldloom.plans.registry import landing


def assembly_merge(summary: DataFrame, stats: DataFrame) -> DataFrame:
    """Assembly summary and report statistics, all rows of both."""
    return joins.join_outer(summary, stats, "#assembly_accession", "current_accession")


def assembly_clean(df: DataFrame) -> DataFrame:
    """'na' to null, two copies of the accession, one column renamed."""
    df = copy_columns(null_out(df, "na"), {"sequence_id": "#assembly_accession", "record_id": "#assembly_accession"})
    return rename(df, {"biosample": "dna_extract_id"})


#: Fields that a genome report gives, by the part they come from.
REPORT_ANNOTATION = ("method", "name", "pipeline", "provider", "release_date", "release_version", "software_version", "status")
REPORT_BUSCO = ("busco_lineage", "busco_ver", "complete")
REPORT_GENES = ("non_coding", "other", "protein_coding", "pseudogene", "total")
REPORT_ASSEMBLY = ("assembly_name", "assembly_status", "assembly_type", "description", "synonym", "diploid_role", "genome_notes", "sequencing_tech", "assembly_method", "suppression_reason")
REPORT_PAIRED = ("accession", "only_genbank", "only_refseq", "changed", "manual_diff", "status")
REPORT_LINKED = ("linked_assembly", "assembly_type")
REPORT_ATYPICAL = ("is_atypical", "warnings")
REPORT_TYPE = ("type_label", "type_display_text")
REPORT_ORGANELLE = ("description", "submitter", "total_seq_length", "bioproject")


def _struct(df: DataFrame, path: str) -> bool:
    kind: T.DataType = df.schema
    for part in path.split("."):
        if not isinstance(kind, T.StructType) or part not in kind.names:
            return False
        kind = kind[part].dataType
    return isinstance(kind, T.StructType)


def genome_reports(df: DataFrame, organelles: list[str] = (), exclude: list[str] = ()) -> DataFrame:
    """Genome reports to flat rows; of equal names the later part's value stays."""
    found: dict[str, Column] = {}

    def take(path: str, keys: tuple[str, ...], prefix: str = "", suffix: str = "") -> None:
        if _struct(df, path):
            part = df.select(F.col(path).alias("_part"))
            for c, column in zip(keys_in(part, keys), nested.pick(part, "_part", keys, prefix, suffix), strict=True):
                name = part.select(column).columns[0]
                found.pop(name, None)
                found[name] = F.col(f"{path}.`{c}`").alias(name)

    def keys_in(part: DataFrame, keys: tuple[str, ...]) -> list[str]:
        return [k for k in keys if k in part.schema["_part"].dataType.names]

    take("annotation_info", REPORT_ANNOTATION)
    take("annotation_info.busco", REPORT_BUSCO, prefix="busco")
    take("annotation_info.stats.gene_counts", REPORT_GENES, suffix="gene_count")
    take("assembly_info", REPORT_ASSEMBLY)
    if _struct(df, "assembly_info") and "comments" in df.schema["assembly_info"].dataType.names:
        found["comments"] = F.regexp_replace(F.coalesce("assembly_info.comments", F.lit("")), r"[\n\t]", "").alias("comments")
    take("assembly_info.paired_assembly", REPORT_PAIRED, prefix="pa")
    take("assembly_info.linked_assemblies", REPORT_LINKED, prefix="la")
    take("assembly_info.atypical", REPORT_ATYPICAL, prefix="at")
    if _struct(df, "assembly_stats"):
        take("assembly_stats", tuple(df.schema["assembly_stats"].dataType.names))
    if "current_accession" in df.columns:
        found["current_accession"] = F.coalesce("current_accession", F.lit("")).alias("current_accession")
    if "organelle_info" in df.columns:
        for o in organelles:
            found[o] = _organelle(o).alias(o)
    take("type_material", REPORT_TYPE)
    return df.select(*[c for n, c in found.items() if n not in exclude])


def _organelle(description: str) -> Column:
    return F.try_element_at(F.filter("organelle_info", lambda x: F.coalesce(x["description"], F.lit("Unknown")) == description), F.lit(-1))


def sequence_records(raw: DataFrame, source_columns: list[str] = ()) -> DataFrame:
    """Flat sequence records (record, sections) to one row each."""
    df = records.parse_record_header(raw)
    df = records.parse_dblinks(records.parse_comment_tags(records.parse_references(df)))
    df = records.parse_features(df, list(source_columns))
    if {"specimen_voucher", "isolate"} <= set(source_columns):
        df = records.specimen(df)
    return df.drop("record", "sections")


def biosample(df: DataFrame, lat_lon: str = "lat_lon") -> DataFrame:
    """Sample records flattened by their path; coordinates split at the blank."""
    flat = nested.flatten_xml(df)
    if lat_lon not in flat.columns:
        return flat
    parts = F.split(q(lat_lon), " ")
    return flat.withColumns({"decimalLatitude": F.try_element_at(parts, F.lit(1)), "decimalLongitude": F.try_element_at(parts, F.lit(2))}).drop(lat_lon)


#: Attributes that become fields of their own.
SAMPLE_FIELDS = {
    "EarliestDateCollected": "collection_date", "MaterialSample": "tissue", "lifeStage": "developmental_stage", "materialSampleID": "specimen_voucher",
    "otherCatalogNumbers": "isolate", "sex": "sex", "lat_lon": "lat_lon", "geo_loc_name": "geo_loc_name",
}


def biosample_dwc(df: DataFrame) -> DataFrame:
    """Sample records to fields and a JSON text of all attributes."""
    df = nested.pick_attribute(df.withColumn("attributes", F.col("Attributes.Attribute")), "attributes", SAMPLE_FIELDS)
    df = nested.attributes_to_map(df, "attributes", "attrs")
    kind = df.schema
    has = lambda path: _path(kind, path)
    email, lab = "Owner.Contacts.Contact._email", "Owner.Contacts.Contact._lab"
    return df.select(
        nested.sample_id(F.col("_accession"), F.col("_id")).alias("id"), F.col("Description.Organism._taxonomy_name").alias("scientificName"),
        (F.col(email) if has(email) else F.lit(None).cast("string")).alias("email"), (F.col(lab) if has(lab) else F.lit(None).cast("string")).alias("lab"),
        *SAMPLE_FIELDS, "attrs",
    )


def _path(kind: T.DataType, path: str) -> bool:
    for part in path.split("."):
        if not isinstance(kind, T.StructType) or part not in kind.names:
            return False
        kind = kind[part].dataType
    return True


def biocollections(collections: DataFrame, institutions: DataFrame) -> DataFrame:
    """Collection codes with their institution, without empty columns."""
    return drop_empty_columns(joins.join_left(collections, institutions, "inst_id", suffixes=("", "_institution")))


#: Columns of an assembly summary of which a copy is kept.
SUMMARY_COPIES = ("taxid", "species_taxid", "organism_name", "infraspecific_name", "isolate", "seq_rel_date", "asm_name", "submitter", "ftp_path")
#: Its columns and their terms.
SUMMARY_TERMS = {
    "assembly_accession": "occurrenceID",
    "bioproject": "ncbi_bioproject",
    "biosample": "ncbi_biosample",
    "wgs_master": "ncbi_nuccore",
    "refseq_category": "ncbi_refseq_category",
    "taxid": "taxonID",
    "species_taxid": "specific_host",
    "organism_name": "scientificName",
    "infraspecific_name": "cloneStrain",
    "isolate": "source_mat_id",
    "version_status": "ncbi_version_status",
    "assembly_level": "ncbi_assembly_level",
    "release_type": "ncbi_release_type",
    "genome_rep": "ncbi_genome_rep",
    "seq_rel_date": "eventDate",
    "asm_name": "otherCatalogNumbers",
    "submitter": "recordedBy",
    "gbrs_paired_asm": "ncbi_gbrs_paired_asm",
    "paired_asm_comp": "ncbi_paired_asm_comp",
    "ftp_path": "geneticAccessionURI",
    "excluded_from_refseq": "ncbi_excluded_from_refseq",
    "relation_to_type_material": "ncbi_relation_to_type_material",
    "asm_not_live_date": "ncbi_asm_not_live_date",
}
#: Fields of a sample that an assembly takes over, and their names there.
SAMPLE_TERMS = {
    "EarliestDateCollected": "EarliestDateCollected",
    "MaterialSample": "MaterialSample",
    "lifeStage": "lifeStage",
    "materialSampleID": "materialSampleID",
    "otherCatalogNumbers": "catalogNumber",
    "sex": "sex",
    "email": "ncbi_biosample_email",
    "lab": "ncbi_biosample_lab",
    "scientificName": "ncbi_biosample_scientificName",
    "attrs": "ncbi_biosample_attributes_json",
}


def refseq_dwc(df: DataFrame, samples: DataFrame) -> DataFrame:
    """Assembly summary in terms, with its sample's fields, coordinates and locality."""
    df = copy_columns(df, {"ncbi_assembly_accession": "assembly_accession"} | {f"ncbi_{c}": c for c in SUMMARY_COPIES})
    df = rename(df, SUMMARY_TERMS)
    named = samples.select("id", *[q(c).alias(t) for c, t in SAMPLE_TERMS.items()])
    df = joins.enrich_lookup(df, named, "ncbi_biosample", "id", list(SAMPLE_TERMS.values()))
    df = nested.json_get(df, "ncbi_biosample_attributes_json", ["lat_lon", "geo_loc_name"])
    at = signed_degrees("lat_lon")
    known = F.col("lat_lon").isNotNull()
    return df.withColumns({"decimalLatitude": F.when(known, at["latitude"]), "decimalLongitude": F.when(known, at["longitude"])}).withColumnRenamed("geo_loc_name", "locality").drop("lat_lon")


def bpa(pages: DataFrame, base_url: str) -> DataFrame:
    """Packages of landed result pages, with their address."""
    return pages.withColumn("bpa_url", F.concat(F.lit(base_url), "type", F.lit("/"), "id"))


def merge_names(df: DataFrame, into: str = "scientificName") -> DataFrame:
    """The first name there is: scientific, species name, genus and species, genus, species, common name."""
    both = F.concat("genus", F.lit(" "), "species")
    return df.withColumn(into, F.coalesce("scientific_name", "species_name", both, "genus", "species", "common_name"))


def bpa_dwc(df: DataFrame, kept: list[str], names: dict[str, str], json: list[str] = ("associatedSequences", "bpa_tags")) -> DataFrame:
    """Packages in terms: dotted names, listed columns alone, copies, a name, JSON text for lists."""
    df = keep(nested.normalize_json(df), kept)
    copies = {f"bpa_{c}": c for c in ("id", "specific_host", "species", "collection_date", "date_of_transfer") if c in df.columns}
    df = rename(merge_names(copy_columns(df, copies)), names)
    return nested.to_json_text(df, [c for c in json if c in df.columns])


#: Fields packed to lists, by the path that they stand at.
BARCODE_PACKED = {
    "associatedSequences": ("record|sequences|sequence", ("sequenceID", "genbank_accession", "markercode", "nucleotides")),
    "associatedMedia": ("record|specimen_imagery|media", ("mediaID", "image_file", "caption", "metatags", "copyright")),
    "traceFiles": ("record|tracefiles|read", ("seq_primer", "read_id", "run_date", "direction", "trace_link", "markercode")),
}


def bold_dwc(df: DataFrame, names: dict[str, str], root: str = "record") -> DataFrame:
    """Barcode records flattened, renamed, lists packed, one row a record."""
    flat = nested.fully_flatten(df.select(F.struct(*df.columns).alias(root)))
    species = "record|taxonomy|species|taxon|name"
    if species in flat.columns:
        flat = flat.withColumn("scientificName", q(species))
    flat = rename(flat, names)
    for into, (path, fields) in BARCODE_PACKED.items():
        there = {f: f"{path}|{f}" for f in fields if f"{path}|{f}" in flat.columns}
        if there:
            flat = nested.pack(flat, into, there)
    key = names.get("record|record_id", "record|record_id")
    return keep_first(flat, [key], [F.to_json(F.struct(*[q(c) for c in flat.columns]))])


def bold_augment(df: DataFrame, cluster_url: str) -> DataFrame:
    """Species named after their cluster where there is none; clusters as addresses."""
    unnamed = F.concat(F.lit("sp. {"), "bold_bin_uri", F.lit("}"))
    return df.withColumn("species", F.coalesce("species", unnamed)).withColumn("bold_bin_uri", prefixed(cluster_url, "bold_bin_uri"))


#: What folders of an archive start with.
ARCHIVE_PREFIXES = {"project_accession": "PRJCA", "sample_accession": "SAMC", "experiment": "CRX", "experiment_accession": "CRA", "run_accession": "CRR"}


def gsa(links: DataFrame, seeds: DataFrame, depth: int = -1, skip: list[str] | None = None) -> DataFrame:
    """Archive files found by following folder links, their folders as columns."""
    reached = crawl_frontier(links, seeds, depth, skip).select("url").filter("url rlike '\\\\.gz$'")
    return nested.path_to_columns(reached, "url", ARCHIVE_PREFIXES)


def ensembl_flatten(df: DataFrame) -> DataFrame:
    """Genome metadata: organism, assembly, release and record side by side, the record's fields last."""
    organism = F.col("organism").dropFields("name") if len(df.schema["organism"].dataType.names) > 1 else F.struct(F.lit(None).alias("_none"))
    rest = [c for c in df.columns if c not in ("organism", "assembly", "data_release")]
    assembly = F.col("assembly").dropFields("sequences") if "sequences" in df.schema["assembly"].dataType.names else F.col("assembly")
    record = F.struct(*rest, F.col("organism.name").alias("organism_name"))
    wrapped = df.select(organism.alias("organism"), assembly.alias("assembly"), F.col("data_release").alias("release"), record.alias("record"))
    return nested.merge_structs(wrapped, ["organism", "assembly", "release", "record"])


def ensembl_enrich(df: DataFrame, meta: DataFrame, stats: DataFrame, columns: list[str], statistics: list[str]) -> DataFrame:
    """Key/value tables (core_db, id, column, value, line) of each species as columns, all rows of both sides."""
    keys = df.select(F.col("#name").alias("name"), "core_db", F.col("species_id").alias("id")).distinct()
    own = lambda kv, names: aggregates.kv_to_columns(kv.join(keys, ["core_db", "id"]), "name", "column", "value", ["line"], names)
    both = joins.join_outer_chain([own(meta, columns), own(stats, statistics)], "name")
    return joins.join_outer(df, right_only(df, both, ["name"]), "#name", "name")


def ensembl_combine(metadata: DataFrame, stats: DataFrame) -> DataFrame:
    """Columns of the statistics that the metadata lack, joined by the displayed name."""
    return joins.join_outer(metadata, right_only(metadata, stats), "display_name", "#name")


#: Fields of a vertebrate's record.
VERTEBRATE_FIELDS = {
    "scientific_name": "organism.scientific_name", "display_name": "organism.display_name", "taxonomy_id": "organism.taxonomy_id", "strain": "organism.strain",
    "species_taxonomy_id": "organism.species_taxonomy_id", "assembly_name": "assembly.assembly_name", "assembly_accession": "assembly.assembly_accession",
    "base_count": "assembly.base_count", "genebuild": "genebuild", "release_date": "data_release.release_date",
}


def ensembl_vertebrates(df: DataFrame) -> DataFrame:
    return nested.project(df, VERTEBRATE_FIELDS)


def record_list(df: DataFrame) -> DataFrame:
    """Landed records as they are, text cleaned."""
    return remove_spaces(df)


def vgp(pages: DataFrame, names: dict[str, str], links: dict[str, str] | None = None, prefixes: dict[str, str] | None = None) -> DataFrame:
    """Rows of a genome project's table by header rules."""
    return html.cells_to_columns(html.html_table_rules(pages, "page_id", "html", links, prefixes), names)


def i5k(pages: DataFrame, names: dict[str, str], skip: list[str] = ()) -> DataFrame:
    """Key/value rows of organism pages as columns."""
    found = nested.html_kv(pages, "page_id", "html", skip)
    return found.select("page_id", *[F.try_element_at("values", F.lit(h)).alias(c) for c, h in names.items()])


def page_tables(pages: DataFrame, names: dict[str, str], heading: str | None = None) -> DataFrame:
    """Rows of a page's table, of the one below a heading if that is given; columns with blanks go."""
    rows = html.html_table_with_link(pages, "page_id", "html", heading) if heading else html.html_tables(pages, "page_id", "html")
    cells, path = html.cells_to_columns(rows, names), landing(pages.sparkSession, "page-tables")
    cells.write.parquet(path)  # parsed once: the rows are read for their blanks, then again
    return drop_any_null_columns(pages.sparkSession.read.schema(cells.schema).parquet(path))


def dnazoo(df: DataFrame) -> DataFrame:
    return nested.flatten_one(df)


def genomeark(df: DataFrame, name: str = "name") -> DataFrame:
    """Species records flattened, names that aren't any skipped."""
    return nested.flatten_nested(skip_names(df, name))
