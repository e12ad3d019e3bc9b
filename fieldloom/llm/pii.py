"""Personal data spans, in DataFrame operations only.

Regular expressions propose spans, checks confirm them (number ranges, digit counts, Luhn for cards, mod-97 for account
numbers of their country's length, issued areas for security numbers, digits for secrets) and failing ones are dropped,
context words shortly before a span raise its score. Matches and their places
come from splitting a text at the matches: what lies between them gives the offsets, so a text is walked a fixed number
of times and patterns are written without backtracking over long runs.

Kinds: email, ip, card, phone (the base), iban, ssn and secret (access keys; passwords and tokens after their name).
Offsets are code points, ends exclusive. Defined results: null text counts as empty and has no spans; repeated rows give
repeated rows; an empty table gives an empty result; other columns, whatever their names, are ignored by ``digest`` and
carried by ``redact``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import text_or_empty

KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "secret")
#: Countries of the IBAN registry by the number of characters after the two check digits.
IBAN_COUNTRIES = {
    11: "NO",
    12: "BE",
    14: "DK FK FI FO GL NL SD",
    15: "MK SI",
    16: "AT BA EE KZ LT LU MN XK",
    17: "CH HR LI LV",
    18: "BG BH CR DE GB GE IE ME RS VA",
    19: "AE GI IL IQ OM SO TL",
    20: "AD CZ ES MD PK RO SA SE SK TN VG",
    21: "LY PT ST",
    22: "IS TR",
    23: "BI DJ FR GR IT MC MR SM",
    24: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    25: "BR EG PS QA UA",
    26: "JO KW MU YE",
    27: "MT SC",
    28: "LC",
    29: "RU",
}
#: Each pattern matches what the plain form of its kind matches, leftmost and without overlaps: runs are possessive, and
#: a match starts at the start of a run or where the last match ended. What looks ahead only fails sooner.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?=[A-Z]{2}[0-9]{2})\b(?:" + "|".join(rf"(?:{c.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n}}}" for n, c in IBAN_COUNTRIES.items()) + r")\b",
    "ssn": r"(?=[0-9])\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
    "secret": r"(?=[AaPpSsTt])\b(?:AKIA[0-9A-Z]{16}\b|(?i:password|passwd|secret|token|api_?key)\x20?[=:]\x20?[\x22']?[A-Za-z0-9+/_-]{8,})",
}
#: A text without this has no match of the kind.
HINTS = {"email": "@", "ip": ".", "phone": "+", "ssn": "-"}
#: Words that raise the score of a kind when they stand within CONTEXT characters before a span, after the match before it.
CONTEXT = 40
CONTEXT_WORDS = {
    "email": "mail|contact|write|reply",
    "ip": "ip|address|host|server",
    "card": "card|visa|credit|payment",
    "phone": "phone|call|tel|mobile|fax",
    "iban": "iban|account|bank|konto|compte|cuenta",
    "ssn": "ssn|social|security",
    "secret": "aws|key|login|auth|credential",
}
#: Score of a confirmed span by kind; those with a checksum are surer. Context adds to it.
SCORES = {"email": 0.8, "ip": 0.6, "card": 0.85, "phone": 0.6, "iban": 0.9, "ssn": 0.7, "secret": 0.8}
CONTEXT_SCORE = 0.1

BLOCK = 256
_SPANS = "array<struct<start:int,rank:int,end:int,kind:string,match:string,ahead:string>>"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def worth(i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.transform(F.sequence(F.lit(0), n - 1), worth), F.lit(0), lambda a, x: a + x) % 10 == 0


def _mod97(match: Column) -> Column:
    plain = F.replace(match, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))

    def step(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code < 58, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), lambda a, c: F.when(c == "", a).otherwise(step(a, c))) == 1


def _confirmed(kind: str, match: Column) -> Column:
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, "^0+", "")
        return F.forall(F.split(match, r"\."), lambda p: (F.length(part(p)) <= 3) & (F.coalesce(part(p).try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        return F.length(_digits(match)).between(14, 19) & _luhn(_digits(match))
    if kind == "phone":
        return F.length(_digits(match)).between(10, 15)
    if kind == "iban":
        return _mod97(match)
    if kind == "ssn":
        area = F.substring(match, 1, 3)
        return ~area.isin("000", "666") & (area < "900") & (F.substring(match, 5, 2) != "00") & (F.substring(match, 8, 4) != "0000")
    if kind == "secret":
        return F.regexp_replace(match, r"^(?i:[a-z_]+\x20?[=:]\x20?)?", "").rlike("[0-9]")
    return F.lit(True)


def _placed(kind: str, zipped: Column) -> Column:
    """Structs (start, rank, end, kind, match, ahead) of (gap, size, match, ahead): lengths of all that lies before are summed.

    It goes in blocks, so that work grows with the number of matches and not with its square.
    """
    none = F.array().cast(_SPANS)

    def place(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        span = F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), (start + x["size"]).alias("end"), F.lit(kind).alias("kind"), x["match"].alias("match"), x["ahead"].alias("ahead"))
        return F.struct((start + x["size"]).alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    def block(acc: Column, matches: Column) -> Column:
        start = F.struct(acc["at"].alias("at"), none.alias("spans"))
        return F.aggregate(matches, start, place, lambda x: F.struct(x["at"].alias("at"), F.concat(acc["blocks"], F.array(x["spans"])).alias("blocks")))

    blocks = F.transform(F.sequence(F.lit(1), F.size(zipped), F.lit(BLOCK)), lambda i: F.slice(zipped, i, F.lit(BLOCK)))
    first = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPANS}>").alias("blocks"))
    return F.aggregate(blocks, first, block, lambda acc: F.flatten(acc["blocks"]))


def _located(docs: DataFrame, p: str) -> DataFrame:
    """docs with p + text and, for each kind, p + kind: its confirmed spans. One step a projection, so nothing runs twice."""
    whole = f"{p}text"
    out = docs.select("*", text_or_empty().alias(whole))
    hint = lambda k: F.contains(whole, F.lit(HINTS[k])) if k in HINTS else F.lit(True)
    out = out.select("*", *[F.when(hint(k), F.regexp_extract_all(whole, F.lit(PATTERNS[k]), F.lit(0))).alias(f"{p}m_{k}") for k in KINDS])

    def zipped(k: str) -> Column:
        matches = F.col(f"{p}m_{k}")
        between = F.slice(F.split(whole, PATTERNS[k], -1), F.lit(1), F.size(matches))
        pairs = F.zip_with(between, matches, lambda b, m: F.struct(F.length(b).alias("gap"), F.length(m).alias("size"), m.alias("match"), F.right(b, F.lit(CONTEXT)).alias("ahead")))
        return F.when(F.size(matches) > 0, pairs)

    out = out.select("*", *[zipped(k).alias(f"{p}z_{k}") for k in KINDS])
    spans_ = [F.when(F.size(f"{p}z_{k}") > 0, _placed(k, F.col(f"{p}z_{k}"))) for k in KINDS]
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], whole, *[_sure(k, x).alias(f"{p}{k}") for k, x in zip(KINDS, spans_, strict=True)])


def _prefix(docs: DataFrame) -> str:
    """A prefix of helper columns with which no column of docs starts."""
    p = "pii_"
    while any(c.lower().startswith(p) for c in docs.columns):
        p += "_"
    return p


def _sure(kind: str, proposed: Column) -> Column:
    return F.filter(F.coalesce(proposed, F.array().cast(_SPANS)), lambda x: _confirmed(kind, x["match"]))


def _scored(x: Column) -> Column:
    named = F.lit(False)
    base = F.lit(0.0)
    for kind in KINDS:
        named = F.when(x["kind"] == kind, F.lower(x["ahead"]).rlike(rf"(?:^|[^a-z0-9])(?:{CONTEXT_WORDS[kind]})")).otherwise(named)
        base = F.when(x["kind"] == kind, F.lit(SCORES[kind])).otherwise(base)
    return F.struct(x["start"].alias("start"), x["rank"].alias("rank"), x["end"].alias("end"), x["kind"].alias("kind"), F.round(base + F.when(named, CONTEXT_SCORE).otherwise(0.0), 2).alias("score"))


def spans(docs: DataFrame) -> DataFrame:
    """doc_id and spans: an array of (start, rank, end, kind, score), by start and then kind, per row of docs."""
    found = F.concat(*[F.col(f"pii_{k}") for k in KINDS])
    return _located(docs.select("doc_id", "text"), "pii_").select("doc_id", F.array_sort(F.transform(found, _scored)).alias("spans"))


def _printed(spans_: Column) -> Column:
    return F.array_join(F.transform(spans_, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, a count for each base kind, base_sha256, spans (printed), counts of the other kinds and scores (printed)."""
    found = spans(docs)
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long")
    base = F.filter("spans", lambda x: x["rank"] < 4)
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS[:4]], F.sha2(_printed(base), 256).alias("base_sha256"), _printed(F.col("spans")).alias("spans"),
        *[count(k).alias(f"n_{k}") for k in KINDS[4:]], F.array_join(F.transform("spans", lambda x: F.format_number(x["score"], 2)), ",").alias("scores"),
    )


def redact(docs: DataFrame, least_score: float = 0.5) -> DataFrame:
    """docs with every span of at least that score replaced by its kind in angle brackets; overlapping spans as one."""
    p = _prefix(docs)
    text = F.col(f"{p}text")
    scored = _located(docs, p)
    kept = F.filter(F.array_sort(F.transform(F.concat(*[F.col(f"{p}{k}") for k in KINDS]), _scored)), lambda x: x["score"] >= least_score)
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def cut(acc: Column, x: Column) -> Column:
        fresh = x["start"] >= acc["at"]
        out = F.concat(acc["out"], F.substring(text, acc["at"] + 1, x["start"] - acc["at"]), F.lit("<"), x["kind"], F.lit(">"))
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"), F.when(fresh, out).otherwise(acc["out"]).alias("out"))

    # The text is put together from left to right.
    clean = F.aggregate(kept, start, cut, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return scored.select(*[F.when(F.col("text").isNotNull(), clean).alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns])
