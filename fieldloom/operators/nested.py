"""Nested and semi-structured data (N01-N25). Schemas drive the projections; rows stay in the JVM."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldloom.operators.columns import q


def _walk(value: Column, kind: T.DataType, name: str, parents: tuple[str, ...], label, last_item: bool) -> Iterator[tuple[str, Column]]:
    if last_item and isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        value, kind = F.get(value, F.size(value) - 1), kind.elementType
    if isinstance(kind, T.StructType):
        for f in kind.fields:
            yield from _walk(value[f.name], f.dataType, f.name, (*parents, name), label, last_item)
    else:
        yield label(name, parents), value


def _flatten(df: DataFrame, label, last_item: bool) -> DataFrame:
    found: dict[str, Column] = {}
    for f in df.schema.fields:
        for name, value in _walk(q(f.name), f.dataType, f.name, (), label, last_item):
            found.pop(name, None)
            found[name] = value  # of equal names the last one stays
    return df.select(*[v.alias(n) for n, v in found.items()])


def flatten_nested(df: DataFrame) -> DataFrame:
    """parent_key, only the nearest parent in the name; of lists of records the last item."""
    return _flatten(df, lambda name, parents: f"{parents[-1]}_{name}" if parents else name, True)


def flatten_one(df: DataFrame) -> DataFrame:
    """key_subkey for structs at the top, everything else as it is."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StructType):
            out += [F.col(f"`{f.name}`.`{n}`").alias(f"{f.name}_{n}") for n in f.dataType.names]
        else:
            out.append(q(f.name))
    return df.select(*out)


def flatten_xml(df: DataFrame) -> DataFrame:
    """Names are the whole path joined by _, attributes at its end; of repeated siblings the last one."""

    def label(name: str, parents: tuple[str, ...]) -> str:
        return "_".join(p.lstrip("_") for p in (*parents, name) if p != "_VALUE")

    return _flatten(df, label, True)


def fully_flatten(df: DataFrame, sep: str = "|") -> DataFrame:
    """Structs split to a|b|c and arrays exploded, until nothing is nested."""
    while True:
        arrays = [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]
        structs = [f for f in df.schema.fields if isinstance(f.dataType, T.StructType)]
        if structs:
            parts = []
            for f in df.schema.fields:
                if isinstance(f.dataType, T.StructType):
                    parts += [F.col(f"`{f.name}`.`{n}`").alias(f"{f.name}{sep}{n}") for n in f.dataType.names]
                else:
                    parts.append(q(f.name))
            df = df.select(*parts)
        elif arrays:
            a = arrays[0]
            df = df.select(*[F.explode_outer(q(c)).alias(c) if c == a else q(c) for c in df.columns])
        else:
            return df


def normalize_json(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested records to a.b columns; arrays stay."""
    return _flatten(df, lambda name, parents: sep.join((*parents, name)), False)


def merge_structs(df: DataFrame, columns: list[str], rest: bool = True) -> DataFrame:
    """Fields of several struct columns side by side; of equal names the rightmost struct's."""
    owner = {n: c for c in columns for n in df.schema[c].dataType.names}
    others = [q(c) for c in df.columns if c not in columns and c not in owner] if rest else []
    return df.select(*[F.col(f"`{c}`.`{n}`").alias(n) for n, c in owner.items()], *others)


def pick(df: DataFrame, column: str, keys: Iterable[str], prefix: str = "", suffix: str = "") -> list[Column]:
    """Columns of some keys of a struct, with prefix and suffix unless they are there; missing keys are left out."""

    def named(k: str) -> str:
        k = k if not prefix or k.startswith(prefix) else f"{prefix}_{k}"
        return k if not suffix or k.endswith(suffix) else f"{k}_{suffix}"

    return [F.col(f"`{column}`.`{k}`").alias(named(k)) for k in keys if k in df.schema[column].dataType.names]


def key_list(df: DataFrame, column: str, key: str, keys: list[str], default: str = "Unknown") -> DataFrame:
    """A list of records to one column for each of the named keys; records without a key count as default."""
    named = lambda k: F.try_element_at(F.filter(q(column), lambda x: F.coalesce(x[key], F.lit(default)) == k), F.lit(-1))
    return df.select(*[q(c) for c in df.columns if c != column], *[named(k).alias(k) for k in keys])


def unwrap_description(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Localised descriptions to their English text, also in lists; plain values stay."""
    out = {}
    for c in columns:
        kind = df.schema[c].dataType
        if isinstance(kind, T.StructType) and "description" in kind.names:
            out[c] = F.col(f"`{c}`.description.en")
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
            out[c] = F.transform(q(c), lambda x: x["description"]["en"])
    return df.withColumns(out) if out else df


def parse_literal(df: DataFrame, column: str, schema: str) -> DataFrame:
    """Text with a printed record to its fields; null is an empty record.

    Printed nulls and booleans are read as such outside quoted text; a field asked for as text gives them as JSON does.
    """
    text = F.coalesce(q(column), F.lit("{}"))
    # Each match is a quoted text, which stays as it is, or one of the words outside of them.
    for word, json in (("None", "null"), ("True", "true"), ("False", "false")):
        text = F.regexp_replace(text, rf"""('(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|\b{word}\b""", f"$1\u0001{json}")
        text = F.regexp_replace(text, f"""(?<=['"])\u0001{json}""", "")
        text = F.replace(text, F.lit(f"\u0001{json}"), F.lit(json))
    parsed = F.from_json(text, schema, {"allowSingleQuotes": "true", "allowUnquotedFieldNames": "true"})
    return df.withColumn("_parsed", parsed).select(*[q(c) for c in df.columns if c != column], "_parsed.*")


def pack(df: DataFrame, into: str, fields: dict[str, str]) -> DataFrame:
    """Columns packed to a one-element array of structs and dropped."""
    packed = F.array(F.struct(*[q(c).alias(f) for f, c in fields.items()]))
    return df.withColumn(into, packed).drop(*[c for c in fields.values() if c != into])


def to_json_text(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: F.to_json(q(c)) for c in columns})


def json_get(df: DataFrame, column: str, keys: Iterable[str]) -> DataFrame:
    """Keys read out of JSON text, as columns."""
    return df.withColumns({k: F.get_json_object(q(column), f"$.{k}") for k in keys})


def _attribute_name(x: Column, kind: T.StructType) -> Column:
    names = [n for n in ("_harmonized_name", "_attribute_name", "harmonized_name", "attribute_name", "name") if n in kind.names]
    return F.coalesce(*[x[n] for n in names])


def _attribute_value(x: Column, kind: T.StructType) -> Column:
    return x["_VALUE" if "_VALUE" in kind.names else "value"]


def attributes_to_map(df: DataFrame, column: str, into: str = "attributes") -> DataFrame:
    """A list of attributes as JSON text of name to value; harmonised names first, the last one wins."""
    kind = df.schema[column].dataType.elementType
    # Later entries win: an entry stays if no later one has its name.
    pairs = F.transform(q(column), lambda x: F.struct(_attribute_name(x, kind).alias("key"), _attribute_value(x, kind).alias("value")))
    last = F.filter(pairs, lambda x, i: ~F.exists(F.slice(pairs, i + 2, F.greatest(F.size(pairs), F.lit(1))), lambda y: y["key"] == x["key"]))
    return df.withColumn(into, F.to_json(F.map_from_entries(F.filter(last, lambda x: x["key"].isNotNull()))))


def pick_attribute(df: DataFrame, column: str, names: dict[str, str]) -> DataFrame:
    """{new column: attribute name}: the last attribute of that name."""
    kind = df.schema[column].dataType.elementType
    last = lambda n: F.try_element_at(F.filter(q(column), lambda x: _attribute_name(x, kind) == n), F.lit(-1))
    return df.withColumns({c: _attribute_value(last(n), kind) for c, n in names.items()})


def pick_link(df: DataFrame, column: str, into: str = "url") -> DataFrame:
    """The last link whose type is url."""
    kind = df.schema[column].dataType.elementType
    mark = "_type" if "_type" in kind.names else "type"
    return df.withColumn(into, _attribute_value(F.try_element_at(F.filter(q(column), lambda x: x[mark] == "url"), F.lit(-1)), kind))


def sample_id(accession: Column, number: Column) -> Column:
    """The accession; else SAMN and the number padded to eight digits; else 'none' (N19)."""
    return F.coalesce(accession, F.concat(F.lit("SAMN"), F.lpad(number.cast("string"), 8, "0")), F.lit("none"))


def split_explode(df: DataFrame, column: str, pattern: str = r"\s+") -> DataFrame:
    """Multi-values to rows; a blank or null cell gives one null row."""
    parts = F.filter(F.split(F.trim(q(column)), pattern), lambda x: x != "")
    return df.select(*[F.explode_outer(parts).alias(c) if c == column else q(c) for c in df.columns])


def path_to_columns(df: DataFrame, column: str, prefixes: dict[str, str]) -> DataFrame:
    """{new column: prefix}: the last segment of a path that starts with it; the file name at the end is left out."""
    parts = F.split(q(column), "/")
    folders = F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0)))
    last = lambda p: F.try_element_at(F.filter(folders, lambda x: F.startswith(x, F.lit(p))), F.lit(-1))
    return df.withColumns({c: last(p) for c, p in prefixes.items()} | {"file_name": F.try_element_at(parts, F.lit(-1))})


def project(df: DataFrame, paths: dict[str, str]) -> DataFrame:
    """{new: path}: named fields of nested objects; a path that isn't there is null."""

    def there(path: str) -> bool:
        kind: T.DataType = df.schema
        for part in path.split("."):
            if not isinstance(kind, T.StructType) or part not in kind.names:
                return False
            kind = kind[part].dataType
        return True

    return df.select(*[(F.col(p) if there(p) else F.lit(None).cast("string")).alias(n) for n, p in paths.items()])


def strip_emphasis(c: Column) -> Column:
    return F.regexp_replace(c, "</?em>", "")


def media_to_images(df: DataFrame) -> DataFrame:
    """One row for each image among a record's media, sizes by preference, formats from the address.

    Records need id, media (array of struct) and taxonomy.taxonName.
    """
    kind = df.schema["media"].dataType.elementType
    images = df.select("id", "taxonomy", F.explode(F.filter("media", lambda m: m["type"] == "image")).alias("m"))
    sizes = [s for s in ("large", "medium", "small", "thumbnail") if s in kind.names]
    best = F.coalesce(*[F.when(F.col(f"m.{s}").isNotNull(), F.struct(*[F.col(f"m.{s}.{p}").alias(p) for p in ("uri", "width", "height")])) for s in sizes])
    images = images.withColumn("best", best).filter("best is not null")
    has = lambda n: F.col(f"m.{n}") if n in kind.names else F.lit(None).cast("string")
    blank = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    name = F.substring_index(F.col("best.uri"), "/", -1)
    return images.select(
        F.lit("").alias("type"), F.upper(F.substring_index(name, ".", -1)).alias("format"), F.col("best.uri").alias("identifier"),
        F.concat(F.lit("https://collections.museumsvictoria.com.au/"), F.col("id")).alias("references"), F.col("taxonomy.taxonName").alias("title"),
        strip_emphasis(blank(has("caption"))).alias("description"), F.lit("").alias("created"),
        (F.array_join(has("creators"), ", ") if "creators" in kind.names else F.lit("")).alias("creator"), F.lit("").alias("contributor"),
        F.lit("Museums Victoria").alias("publisher"), F.lit("").alias("audience"),
        (F.array_join(has("sources"), ", ") if "sources" in kind.names else F.lit("")).alias("source"),
        (blank(F.col("m.licence.name")) if "licence" in kind.names else F.lit("")).alias("license"), blank(has("rightsStatement")).alias("rightsHolder"),
        F.col("id").alias("datasetID"), F.col("taxonomy.taxonName").alias("taxonName"), F.col("best.width").alias("width"), F.col("best.height").alias("height"),
    )


def project_entries(df: DataFrame) -> DataFrame:
    """Landed dataset entries to flat rows with defaults, and a printed summary."""
    kind = {f.name: f.dataType for f in df.schema.fields}
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c.split(".")[0] in kind else F.lit("")
    none = F.array().cast("array<string>")
    keywords = F.coalesce(F.col("keywords"), none) if "keywords" in kind else none
    places = F.coalesce(F.transform("locations", lambda x: x["place"]), none) if "locations" in kind else none
    people = lambda x: F.concat_ws(" ", x["firstName"], x["lastName"])
    authors = F.coalesce(F.transform("authors", people), none) if "authors" in kind else none
    funders = F.coalesce(F.transform("funders", lambda x: x["organization"]), none) if "funders" in kind else none
    names = ("identifier", "id", "title", "abstract", "usageNotes", "methods", "relatedPublicationISSN", "publicationDate", "lastModificationDate", "visibility",
             "license", "storageSize", "versionNumber", "versionStatus", "curationStatus", "sharingLink")
    href = F.col("_links.self.href") if "_links" in kind else F.lit("")
    bullets = F.array_join(F.transform(keywords, lambda k: F.concat(F.lit("- "), k)), "\n")
    summary = F.concat(F.lit("Title: "), text("title"), F.lit("\nAbstract: "), text("abstract"), F.lit("\nKeywords:\n"), bullets)
    return df.select(
        F.coalesce(href, F.lit("")).alias("link"), *[text(n).alias(n) for n in names], keywords.alias("keywords"), places.alias("places"),
        authors.alias("authors"), funders.alias("funders"), summary.alias("summary"),
    )


def extract_links(pages: DataFrame, key: str, html: str, pattern: str = ".*", keep_rooted: bool = False, carried: Iterable[str] = ()) -> DataFrame:
    """Links of a page as (key, carried columns, href, kind): folders end in /, files match the pattern at the start."""
    hrefs = F.regexp_extract_all(q(html), F.lit(r"""(?i)<a\b[^>]*?\bhref\s*=\s*["']([^"']*)["']"""), F.lit(1))
    links = pages.select(q(key), *[q(c) for c in carried], F.explode(hrefs).alias("href")).filter("href <> ''")
    skipped = F.startswith("href", F.lit("?")) if keep_rooted else F.startswith("href", F.lit("/")) | F.startswith("href", F.lit("?"))
    links = links.filter(~skipped).withColumn("kind", F.when(F.endswith("href", F.lit("/")), "folder").otherwise("file"))
    return links.filter((F.col("kind") == "folder") | F.col("href").rlike(f"^(?:{pattern})"))




def resolve_urls(df: DataFrame, base: str, link: str, into: str = "url") -> DataFrame:
    """A link joined to the address of its page: whole, rooted, query and relative ones; dots are resolved."""
    root = F.regexp_extract(q(base), r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    plain = F.regexp_replace(q(base), r"[?#].*$", "")
    folder = F.when(plain == root, F.concat(plain, F.lit("/"))).otherwise(F.regexp_replace(plain, "[^/]*$", ""))
    scheme = F.regexp_extract(q(base), r"^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1)
    joined = (
        F.when(q(link) == "", q(base))
        .when(q(link).rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), q(link))
        .when(F.startswith(q(link), F.lit("//")), F.concat(scheme, q(link)))
        .when(F.startswith(q(link), F.lit("/")), F.concat(root, q(link)))
        .when(F.startswith(q(link), F.lit("?")), F.concat(plain, q(link)))
        .when(F.startswith(q(link), F.lit("#")), F.concat(F.regexp_replace(q(base), "#.*$", ""), q(link)))
        .otherwise(F.concat(folder, q(link)))
    )
    host = F.regexp_extract(joined, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    path = F.substring(joined, F.length(host) + 1, F.length(joined))
    tail = F.regexp_extract(path, r"([?#].*)$", 1)
    parts = F.split(F.regexp_replace(path, r"[?#].*$", ""), "/", -1)

    def step(acc: Column, x: Column) -> Column:
        up = F.when(F.size(acc) > 1, F.slice(acc, F.lit(1), F.size(acc) - 1)).otherwise(acc)
        return F.when(x == "..", up).when(x == ".", acc).otherwise(F.array_append(acc, x))

    clean = F.array_join(F.aggregate(parts, F.array().cast("array<string>"), step), "/")
    open_ = F.regexp_replace(path, r"[?#].*$", "").rlike(r"(^|/)\.\.?$")
    return df.withColumn(into, F.when(host == "", joined).otherwise(F.concat(host, clean, F.when(open_, "/").otherwise(""), tail)))


def html_kv(pages: DataFrame, key: str, html: str, skip: Iterable[str] = ()) -> DataFrame:
    """<th>key</th><td>value</td> rows of a page as a map; line breaks to blanks, tags cut, named keys left out."""
    rows = F.regexp_extract_all(q(html), F.lit(r"(?is)<th[^>]*>(?:(?!</th>).)*+</th>\s*<td[^>]*>(?:(?!</td>).)*+</td>"), F.lit(0))
    plain = lambda c: F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, r"(?i)<br\s*/?>", " "), r"<[^>]+>", ""), r"\s+", " "))
    pairs = F.transform(rows, lambda r: F.struct(plain(F.regexp_extract(r, r"(?is)<th[^>]*>(.*?)</th>", 1)).alias("key"), plain(F.regexp_extract(r, r"(?is)<td[^>]*>(.*?)</td>", 1)).alias("value")))
    wanted = F.filter(pairs, lambda p: ~p["key"].isin(*skip)) if skip else pairs
    last = F.filter(wanted, lambda x, i: ~F.exists(F.slice(wanted, i + 2, F.greatest(F.size(wanted), F.lit(1))), lambda y: y["key"] == x["key"]))
    return pages.select(q(key), F.map_from_entries(last).alias("values"))


def list_items(pages: DataFrame, key: str, html: str) -> DataFrame:
    """List items of a page without their tags, as (key, item_no, item)."""
    items = F.regexp_extract_all(q(html), F.lit(r"(?is)<li[^>]*>(.*?)</li>"), F.lit(1))
    rows = pages.select(q(key), F.posexplode(items).alias("item_no", "item"))
    return rows.withColumn("item", F.trim(F.regexp_replace("item", r"<[^>]+>", "")))
