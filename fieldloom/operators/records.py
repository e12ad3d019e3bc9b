"""Flat sequence records (N26-N31): header fields, tagged comments, cross-references, references and features."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Where the version and the identifiers of a record lead to, and the blocks of tagged comments.
VERSION_URL = "https://www.ncbi.nlm.nih.gov/nuccore/"
LINK_URLS = {
    "BioProject": "https://www.ncbi.nlm.nih.gov/bioproject/",
    "BioSample": "https://www.ncbi.nlm.nih.gov/biosample/",
    "Sequence Read Archive": "https://www.ncbi.nlm.nih.gov/sra/",
    "ProbeDB": "https://www.ncbi.nlm.nih.gov/biosample/",
    "Assembly": "https://www.ncbi.nlm.nih.gov/assembly/",
    "Project": "https://www.ncbi.nlm.nih.gov/bioproject/",
}
FASTA_SUFFIX = "?report=fasta&format=text"
COMMENT_TAGS = (
    "Genome-Assembly-Data",
    "Genome-Annotation-Data",
    "Assembly-Data",
)


def section(name: str) -> Column:
    """Text of the first section that starts with a name, without the name; null if there is none."""
    found = F.try_element_at(F.filter("sections", lambda s: F.startswith(s, F.lit(name))), F.lit(1))
    return F.trim(F.substring(found, len(name) + 1, 1 << 30))


def bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value) with the value worked out once, however often f names it: Spark writes a column out again wherever it stands in a lambda."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _joined(c: Column) -> Column:
    """Wrapped lines to one."""
    return F.regexp_replace(c, r"\s*\n\s+", " ")


def parse_record_header(records: DataFrame) -> DataFrame:
    """LOCUS tokens, definition, accession, version with two addresses, keywords, source, organism and higher classification."""
    locus = F.split(section("LOCUS"), r"\s+")
    token = lambda i: F.try_element_at(locus, F.lit(i))
    version = F.substring_index(section("VERSION"), " ", 1)
    source = section("SOURCE")
    below = F.regexp_extract(source, r"(?s)\n  ORGANISM\s+(.*)$", 1)
    return records.withColumns({
        "locus": token(1), "base_pairs": token(2), "type": token(4), "shape": token(5), "seq_type": token(6), "date": token(7),
        "definition": _joined(section("DEFINITION")), "accession": F.substring_index(_joined(section("ACCESSION")), " ", 1), "version": version,
        "genbank_url": F.concat(F.lit(VERSION_URL), version), "fasta_url": F.concat(F.lit(VERSION_URL), version, F.lit(FASTA_SUFFIX)),
        "keywords": F.regexp_replace(_joined(section("KEYWORDS")), r"^\.$", ""),
        "source": F.regexp_extract(source, r"(?s)^(.*?)(?:\n|$)", 1), "organism": F.trim(F.regexp_extract(below, r"^([^\n]*)", 1)),
        "higher_classification": F.trim(F.regexp_replace(F.regexp_extract(below, r"(?s)\n(.*)$", 1), r"\s+", " ")),
    })


def parse_comment_tags(records: DataFrame) -> DataFrame:
    """Comment lines joined by a printed line break, and pairs of the ##tag-START## ... ##tag-END## blocks as one map.

    Keys are lower-case, blanks are underscores and round brackets go; of equal keys the last one stays.
    """

    def tags(comment: Column) -> Column:
        blocks = [F.regexp_extract(comment, rf"(?s)##{tag}-START##(.*?)##{tag}-END##", 1) for tag in COMMENT_TAGS]
        pairs = [F.transform(F.filter(F.split(_joined_pairs(b), "\n"), lambda x: F.contains(x, F.lit("::"))), _pair) for b in blocks]
        return F.map_from_entries(bound(F.concat(*pairs), _last_wins))

    def plain(comment: Column) -> Column:
        lines = F.transform(F.split(F.regexp_replace(comment, r"\n {13,}", " "), "\n"), lambda x: F.trim(x))
        return F.array_join(F.filter(lines, lambda x: x != ""), "\\n")

    both = bound(section("COMMENT"), lambda c: F.struct(plain(c).alias("comment"), tags(c).alias("comment_tags")))
    name = "_comments"
    return records.withColumn(name, both).withColumns({"comment": F.col(name)["comment"], "comment_tags": F.col(name)["comment_tags"]}).drop(name)


def _joined_pairs(block: Column) -> Column:
    """A pair that was wrapped back on one line."""
    return F.regexp_replace(block, r"\n\s+(?![^\n]*::)", " ")


def _pair(line: Column) -> Column:
    key = F.trim(F.substring_index(line, "::", 1))
    plain = F.regexp_replace(F.replace(F.lower(key), F.lit(" "), F.lit("_")), r"[()]", "")
    return F.struct(plain.alias("key"), F.trim(F.regexp_extract(line, r"::(.*)$", 1)).alias("value"))


def _last_wins(pairs: Column) -> Column:
    return F.filter(F.coalesce(pairs, F.array().cast("array<struct<key:string,value:string>>")),
                    lambda x, i: ~F.exists(F.slice(pairs, i + 2, F.greatest(F.size(pairs), F.lit(1))), lambda y: y["key"] == x["key"]))


def parse_dblinks(records: DataFrame) -> DataFrame:
    """'DB: a, b' lines as a map of database, in lower case, to addresses; of a database without one, the bare ids."""
    lines = F.split(F.regexp_replace(section("DBLINK"), r"\n\s+(?![^\n:]*:)", " "), r"\n\s*")
    known = F.create_map(*[F.lit(x) for kv in LINK_URLS.items() for x in kv])

    def entry(line: Column) -> Column:
        db = F.trim(F.substring_index(line, ":", 1))
        ids = F.transform(F.split(F.regexp_extract(line, r":(.*)$", 1), ","), lambda x: F.concat(F.coalesce(known[db], F.lit("")), F.trim(x)))
        return F.struct(F.lower(db).alias("key"), ids.alias("value"))

    listed = F.transform(F.filter(lines, lambda x: F.contains(x, F.lit(":"))), entry)
    return records.withColumn("db_links", F.map_from_entries(listed))


def parse_references(records: DataFrame) -> DataFrame:
    """References as an array of (bp_range, authors, title, journal, pubmed, remark)."""
    sections = F.filter("sections", lambda s: F.startswith(s, F.lit("REFERENCE")))

    def field(s: Column, name: str) -> Column:
        raw = F.regexp_extract(s, rf"(?s)\n\s+{name}\s+(.*?)(?=\n {{1,4}}[A-Z]|$)", 1)
        return F.regexp_replace(raw, r"\s*\n\s+", " ")

    one = lambda s: F.struct(
        F.trim(F.regexp_extract(s, r"^REFERENCE\s+\d+([^\n]*)", 1)).alias("bp_range"),
        *[field(s, n).alias(n.lower()) for n in ("AUTHORS", "TITLE", "JOURNAL", "PUBMED", "REMARK")],
    )
    return records.withColumn("references", F.transform(sections, one))


def features_of(text: str | None) -> dict[str, dict[str, dict[str, str]]]:
    """{range: {feature: {qualifier: value}}} of one feature table; translations go, flags are gathered under 'other'."""
    found: dict[str, dict[str, dict[str, str]]] = {}
    current: dict[str, str] | None = None
    name = None
    for line in (text or "").split("\n")[1:]:
        body = line.strip()
        if not body:
            continue
        if len(line) > 5 and line[:5] == "     " and line[5] != " ":
            feature, _, span = body.partition(" ")
            current, name = found.setdefault(span.strip(), {}).setdefault(feature, {}), None
        elif current is not None and body.startswith("/"):
            name, eq, value = body[1:].partition("=")
            if eq:
                current[name] = value.strip('"')
            else:
                current["other"] = ", ".join(filter(None, (current.get("other"), name)))
                name = None
        elif current is not None and name is not None:
            current[name] = f"{current[name]} {body}".strip('"')
    for features in found.values():
        for qualifiers in features.values():
            qualifiers.pop("translation", None)
    return found


_FEATURES = "map<string,map<string,map<string,string>>>"


def parse_features(records: DataFrame, source_columns: list[str]) -> DataFrame:
    """The feature table as nested maps, and named qualifiers of feature 'source' as columns."""

    @F.pandas_udf(_FEATURES)
    def table(texts: pd.Series) -> pd.Series:
        return texts.map(features_of)

    section_ = F.try_element_at(F.filter("sections", lambda s: F.startswith(s, F.lit("FEATURES"))), F.lit(1))
    out = records.withColumn("features", table(section_))
    sources = F.filter(F.transform(F.map_values("features"), lambda m: F.try_element_at(m, F.lit("source"))), lambda m: m.isNotNull())
    first = F.try_element_at(sources, F.lit(1))
    return out.withColumns({c: F.try_element_at(first, F.lit(c)) for c in source_columns})


def specimen(df: DataFrame) -> DataFrame:
    """The first of voucher, isolate and accession."""
    filled = lambda c: F.when(F.trim(F.col(c)) != "", F.col(c))
    return df.withColumn("specimen", F.coalesce(filled("specimen_voucher"), filled("isolate"), filled("accession")))
