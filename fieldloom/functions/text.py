"""Scalar functions on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_set(c: Column | str, chars: str) -> Column:
    """Any of the given characters cut from both ends."""
    return F.btrim(_c(c), F.lit(chars))


def null_if_match(c: Column | str, pattern: str) -> Column:
    """Null where the whole cell matches."""
    return F.when(~F.coalesce(_c(c).rlike(f"^(?:{pattern})$"), F.lit(False)), _c(c))


def null_if(c: Column | str, *values: str) -> Column:
    """Null where the cell is one of the values."""
    return F.when(~F.coalesce(_c(c).isin(*values), F.lit(False)), _c(c))


def prefixed(prefix: str, c: Column | str) -> Column:
    """Prefix and value; null stays null (X11)."""
    return F.concat(F.lit(prefix), _c(c))


def split_part(c: Column | str, mark: str = ".") -> Column:
    """What stands before the first mark."""
    return F.substring_index(_c(c), mark, 1)


def last_part(c: Column | str, mark: str = "/") -> Column:
    """What stands after the last mark."""
    return F.substring_index(_c(c), mark, -1)


def last_parts(c: Column | str, n: int, mark: str = "/", by: str = "_") -> Column:
    """The last n parts, joined."""
    parts = F.split(_c(c), mark)
    return F.array_join(F.slice(parts, F.greatest(F.size(parts) - n + 1, F.lit(1)), F.lit(n)), by)


def without_last(c: Column | str, n: int, mark: str = "/") -> Column:
    """All but the last n parts."""
    parts = F.split(_c(c), mark)
    return F.array_join(F.slice(parts, F.lit(1), F.greatest(F.size(parts) - n, F.lit(0))), mark)


def canonical_genus(genus: Column | str, subgenus: Column | str) -> Column:
    """Genus, with the subgenus in brackets where there is one."""
    g, s = _c(genus), _c(subgenus)
    return F.when(F.coalesce(F.trim(s), F.lit("")) == "", g).otherwise(F.concat(g, F.lit(" ("), s, F.lit(")")))


def authorship(author: Column | str, year: Column | str, original: Column) -> Column:
    """'Author, Year', in brackets unless the combination is the original one; blank without an author."""
    a, y = F.coalesce(F.trim(_c(author)), F.lit("")), F.coalesce(F.trim(_c(year)), F.lit(""))
    plain = F.when(y == "", a).otherwise(F.concat(a, F.lit(", "), y))
    return F.when(a.isin("", "NaN", "nan"), "").when(F.coalesce(original, F.lit(True)), plain).otherwise(F.concat(F.lit("("), plain, F.lit(")")))


def clean_authority(authority: Column | str, scientific_name: Column | str, synonym: Column | str) -> Column:
    """The authority without the name or synonym in front and without one outer pair of brackets; blank for null."""

    def cut(c: Column, name: Column) -> Column:
        return F.when((name != "") & F.startswith(c, name), F.substring(c, F.length(name) + 1, F.length(c))).otherwise(c)

    blank = lambda c: F.coalesce(_c(c), F.lit(""))
    rest = F.trim(cut(cut(blank(authority), blank(scientific_name)), blank(synonym)))
    return F.regexp_replace(rest, r"(?s)^\((.*)\)$", "$1")


def signed_degrees(c: Column | str) -> Column:
    """struct(latitude, longitude) as text of '39.2 N 123.7 W'; blanks unless there are four parts."""
    parts = F.split(F.trim(_c(c)), " ")
    part = lambda i: F.try_element_at(parts, F.lit(i))
    sign = lambda i, minus: F.when(part(i) == minus, "-").otherwise("")
    four = F.coalesce(F.size(parts) == 4, F.lit(False))
    lat, lon = F.concat(sign(2, "S"), part(1)), F.concat(sign(4, "W"), part(3))
    return F.struct(F.when(four, lat).otherwise("").alias("latitude"), F.when(four, lon).otherwise("").alias("longitude"))


def snake(c: Column | str) -> Column:
    """Each run of capitals gets an underscore before it and is lower-cased."""
    return F.lower(F.regexp_replace(_c(c), "([A-Z]+)", "_$1"))


def cut_brackets(c: Column | str) -> Column:
    """What stands between the first ( and the last ) is cut, with the brackets."""
    return F.regexp_replace(_c(c), r"(?s)\(.*\)", "")


def squeeze(c: Column | str) -> Column:
    """Runs of blanks to one."""
    return F.regexp_replace(_c(c), " +", " ")


def clean_number(c: Column | str) -> Column:
    """Commas cut where digits are left."""
    plain = F.replace(_c(c), F.lit(","), F.lit(""))
    return F.when(plain.rlike(r"^\d+$"), plain).otherwise(_c(c))


def to_flag(c: Column | str) -> Column:
    """'1' and '0' to booleans."""
    return _c(c).try_cast("int") == 1


def area(width: Column | str, height: Column | str) -> Column:
    """Product where a null side counts as 1."""
    return F.coalesce(_c(width), F.lit(1)) * F.coalesce(_c(height), F.lit(1))


UNITS = ("B", "KB", "MB", "GB", "TB", "PB")


def two_decimals(c: Column | str) -> Column:
    """A number from 0 up with two decimals: its own value is rounded, halves to even. Java's formats round its printed digits, halves up."""
    v = _c(c).cast("double")
    whole = F.floor(v)
    scaled = ((v - whole) * 2.0**56).cast("long") * 100  # whole for every double from a sixteenth up
    cents, rest = F.shiftright(scaled, 56), scaled.bitwiseAND(F.lit((1 << 56) - 1))
    up = (rest > 1 << 55) | ((rest == 1 << 55) & (cents % 2 == 1))
    cents = cents + up.cast("long")
    near = F.format_string("%d.%02d", whole + F.when(cents == 100, 1).otherwise(0), cents % 100)
    return F.when(v < 2.0**53, near).otherwise(F.format_string("%.2f", v))  # no decimals from there on


def human_size(c: Column | str, largest: str = "PB") -> Column:
    """Bytes as text: divided by 1,024 while above it, up to the largest unit; two decimals and a unit."""
    v = _c(c).cast("double")
    units = UNITS[: UNITS.index(largest) + 1]
    unit = lambda k: F.concat(F.when(v < 0, "-").otherwise(""), two_decimals(F.abs(v) / 1024.0**k), F.lit(f" {units[k]}"))
    out = unit(len(units) - 1)
    for k in reversed(range(len(units) - 1)):
        out = F.when(v <= 1024.0 ** (k + 1), unit(k)).otherwise(out)
    return F.when(v.isNotNull(), out)


def build_url(base: Column | str, pairs: dict[str, Column | list[Column]]) -> Column:
    """base?k=v&..., values encoded; lists repeat their key, booleans are lower-case, nulls are left out."""
    enc = lambda v: F.replace(F.replace(F.url_encode(v.cast("string")), F.lit("+"), F.lit("%20")), F.lit("%2F"), F.lit("/"))
    parts = [_pair(k, v, enc) for k, v in pairs.items()]
    query = F.array_join(F.filter(F.array(*parts), lambda p: p.isNotNull() & (p != "")), "&")
    return F.when(query == "", _c(base)).otherwise(F.concat(_c(base), F.lit("?"), query))


def _pair(key: str, value: Column | list[Column], enc) -> Column:
    if isinstance(value, list):
        return F.concat_ws("&", *[F.concat(F.lit(f"{key}="), enc(v)) for v in value])
    return F.concat(F.lit(f"{key}="), enc(value))


def strip_tags(c: Column | str) -> Column:
    """Markup tags cut."""
    return F.regexp_replace(_c(c), r"<[^>]+>", "")


def clean_text(c: Column | str) -> Column:
    """Tabs, line breaks and their printed forms cut."""
    return F.regexp_replace(_c(c), r"\\[tnr]|[\t\n\r]", "")


def pages(total: Column | str, size: int) -> Column:
    """How many pages of a size hold a total."""
    return F.ceil(_c(total) / F.lit(size)).cast("long")
