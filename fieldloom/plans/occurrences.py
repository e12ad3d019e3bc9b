"""Occurrences, photos, traits, samples and reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.functions.text import area, human_size, last_part, without_last
from fieldloom.operators import aggregates, filters, joins, nested, sampling, windows
from fieldloom.operators.columns import q, remove_spaces, rename, transposed, with_constants
from fieldloom.sources import readers, writers


def museum(df: DataFrame, schema: str | None = None) -> DataFrame:
    """Museum records flattened one level; a printed taxonomy is expanded."""
    flat = nested.flatten_one(df)
    return nested.parse_literal(flat, "taxonomy", schema) if schema else flat


def lists(frames: list[DataFrame]) -> DataFrame:
    """Species lists united by name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


#: Files of an occurrence export that hold no occurrences.
SIDE_FILES = ("citation.csv", "headings.csv", "README.html")


def biocache(spark: SparkSession, path: str) -> DataFrame:
    """Files of an occurrence export, without its side files."""
    names = [r["path"] for r in readers.list_files(spark, path).select("path").orderBy("path").collect()]  # names of files
    return readers.read_files(spark, [n for n in names if n.endswith(".csv") and not n.endswith(SIDE_FILES)])


def resave(df: DataFrame, path: str) -> None:
    """Written anew, quoted only where it must be."""
    writers.write_csv(df, path)


def trait_list(df: DataFrame, order: list[str], taxon: str = "taxon_name", trait: str = "trait_name", value: str = "trait_value") -> DataFrame:
    """Traits of each taxon as sorted distinct values joined by a bar.

    Unknown values and unplaced species go; cells with several values become rows; blanks take the value before them.
    """
    df = filters.filter_regex(filters.filter_ne(df, value, "unknown"), taxon, r"\s+sp\.", negate=True)
    df = rename(df, {taxon: "taxon", trait: "traitName", value: "traitValue"})
    df = windows.ffill(nested.split_explode(df.select("taxon", "traitName", "traitValue", *order), "traitValue"), order, columns=["traitValue"])
    return aggregates.set_join(df, ["taxon", "traitName"], "traitValue")


def trait_payload(traits: DataFrame, name: str) -> DataFrame:
    """Trait lists as JSON texts, one a trait."""
    return writers.to_list_payload(traits, name, "taxon", ["traitValue"], ["traitName"])


def trait_coverage(df: DataFrame, trait: str = "trait_name", taxon: str = "taxon_name") -> DataFrame:
    """Taxa that have each trait, the most first."""
    return aggregates.count_by(df.select(trait, taxon).distinct(), trait, taxon, "taxa")


def species_counts(observations: DataFrame, taxa: DataFrame, ranks: list[str] = ("species", "subspecies")) -> DataFrame:
    """Observations of each taxon of some ranks (D47); counting comes before the join."""
    counts = aggregates.value_counts(observations, "taxon_id", "counts")
    return joins.join_left(counts, taxa, "taxon_id").filter(q("rank").isin(*ranks))


def photo_ids(photos: DataFrame, observations: DataFrame) -> DataFrame:
    """Photos whose observation is known."""
    return joins.semi_join(photos, observations, "observation_uuid").select("photo_uuid")


def photo_catalogue(photos: DataFrame, observations: DataFrame, taxa: DataFrame, observers: DataFrame, ids: DataFrame, order: list[str], bucket_url: str, publisher: str) -> DataFrame:
    """Photos with free licenses, one an observation, with taxon, creator, license text and address."""
    df = filters.drop_where(photos, q("license") == "CC-BY-NC-ND")
    df = windows.keep_first(windows.keep_first(df, ["photo_uuid"], order), ["observation_uuid"], order)
    df = joins.semi_join(df, ids, "photo_uuid")
    research = observations.filter("quality_grade = 'research'").select("observation_uuid", "taxon_id", "observed_on")
    df = joins.fill_from(df, research, "observation_uuid", ["taxon_id", "observed_on"], ["taxon_id", "observed_on"])
    df = df.drop("observation_uuid").withColumn("taxon_id", q("taxon_id").cast("long"))
    species = taxa.filter("rank = 'species'").select(q("taxon_id").cast("long").alias("taxon_id"), F.col("name").alias("taxonName"))
    df = joins.join_left(df, species, "taxon_id")
    people = observers.select("observer_id", F.coalesce("name", "login").alias("creator"))
    df = joins.join_left(df, people, "observer_id")
    df = df.withColumns({
        "license": F.concat(F.lit("© "), "creator", F.lit(", some rights reserved ("), "license", F.lit(")")),
        "identifier": F.concat(F.lit(bucket_url), q("photo_id").cast("string"), F.lit("/original."), "extension"),
    })
    df = rename(df.drop("position", "taxon_id", "observer_id", "photo_id"), {"extension": "format", "photo_uuid": "datasetID", "observed_on": "created"})
    return with_constants(df, {"type": "image", "source": publisher, "publisher": publisher})


def museum_images(df: DataFrame) -> DataFrame:
    return nested.media_to_images(df)


#: Fields of an image row, in order.
IMAGE_FIELDS = (
    "type", "format", "identifier", "references", "title", "description", "created", "creator", "contributor", "publisher",
    "audience", "source", "license", "rightsHolder", "datasetID", "taxonName", "width", "height",
)


def host_images(df: DataFrame, licenses: dict[str, str], source: str) -> DataFrame:
    """Photo records (info, sizes) with their largest image, tags and license."""
    best = sampling.array_argmax("_sizes", lambda x: area(x["width"].cast("long"), x["height"].cast("long")))
    df = df.withColumn("_sizes", F.col("sizes.size")).withColumn("_best", best).withColumn("_license", F.col("info.license").cast("string"))
    df = joins.map_codes(df, "_license", licenses)
    blank = lambda: F.lit("")
    fields = {
        "type": F.lit("image"), "format": last_part("_best.source", "."), "identifier": F.col("_best.source"), "references": without_last("_best.url", 3),
        "title": F.col("info.title._content"), "description": F.col("info.description._content"), "created": F.col("info.dates.taken"),
        "creator": F.col("info.owner.username"), "contributor": blank(), "publisher": F.col("info.owner.username"), "audience": blank(), "source": F.lit(source),
        "license": F.col("_license"), "rightsHolder": blank(), "datasetID": F.col("info.id").cast("string"), "taxonName": blank(),
        "width": F.col("_best.width"), "height": F.col("_best.height"),
    }
    return df.select(*[fields[n].alias(n) for n in IMAGE_FIELDS], F.transform("info.tags.tag", lambda t: t["raw"]).alias("tags"))


def find_rows(df: DataFrame, column: str, values: list[object], limit: int = 20) -> DataFrame:
    """The first rows that have one of the values, as columns."""
    return transposed(filters.filter_in(df, column, values), limit)


def sample_input(df: DataFrame, n: int, seed: int, kind: str = "records") -> DataFrame:
    """What a look at a source needs: values of each column, or the fullest of some records."""
    clean = remove_spaces(df)
    return sampling.sample_fields(clean, n, seed) if kind == "fields" else windows.number_rows(sampling.sample_records(clean, n, seed), "Example #")


def sample_output(df: DataFrame, n: int, which: str = "all", unmapped: str = "unmapped") -> DataFrame:
    """First rows of a converted table: all events, mapped ones or the unmapped."""
    events = [e for e in df.columns if which == "all" or (e == unmapped) == (which == "unmapped")]
    flat = [F.col(f"`{e}`.`{c}`").alias(f"{e}_{c}") for e in events for c in df.schema[e].dataType.names]
    return windows.number_rows(df.limit(n).select(*flat), "Example #")


def largest(files: DataFrame, k: int, folders: bool = False) -> DataFrame:
    """The largest files, or files and folders, with their size in words."""
    listed = files.select(F.col("path"), F.col("size"))
    if folders:
        listed = listed.unionByName(aggregates.folder_sizes(files).select(F.col("folder").alias("path"), "size"))
    return sampling.top_k(listed, "size", k, ["path"]).withColumn("size_text", human_size("size"))

