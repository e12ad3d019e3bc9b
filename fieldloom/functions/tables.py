"""Table functions: rows made of one value, for lateral joins in SQL."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import AnalyzeArgument, AnalyzeResult, udtf
from pyspark.sql.types import IntegerType, StringType, StructType


class RecordSections:
    """A flat record's sections as rows: place, name, body, and one column for each sub-heading that is asked for.

    The second argument, a constant, lists sub-headings; it decides the columns, so it is looked at when the query is analysed.
    """

    @staticmethod
    def analyze(record: AnalyzeArgument, fields: AnalyzeArgument) -> AnalyzeResult:
        if not fields.isConstantExpression:
            raise ValueError("the list of sub-headings must be a constant")
        schema = StructType().add("place", IntegerType()).add("name", StringType()).add("body", StringType())
        for field in RecordSections.names(fields.value):
            schema = schema.add(field.lower(), StringType())
        return AnalyzeResult(schema)

    @staticmethod
    def names(fields: str | None) -> list[str]:
        return [f.strip() for f in (fields or "").split(",") if f.strip()]

    def eval(self, record: str, fields: str) -> Iterator[tuple]:
        wanted = self.names(fields)
        for place, part in enumerate(filter(str.strip, re.split(r"\n(?=\S)", record or ""))):
            head, _, rest = part.partition("\n")
            name, _, first = head.partition(" ")
            found: dict[str, str] = {}
            body, now = [first.strip()], None
            for line in rest.split("\n") if rest else ():
                sub = re.match(r" {1,4}([A-Z]+)(?:\s+(.*))?$", line)
                if sub:
                    now = sub[1]
                    found[now] = (sub[2] or "").strip()
                elif now:
                    found[now] = f"{found[now]} {line.strip()}"
                else:
                    body.append(line.strip())
            yield (place, name, " ".join(filter(None, body)), *[found.get(f) for f in wanted])


class PageSections:
    """A page's headed sections as rows: level, title, and the text below it up to the next heading."""

    @staticmethod
    def analyze(page: AnalyzeArgument) -> AnalyzeResult:
        return AnalyzeResult(StructType().add("level", IntegerType()).add("title", StringType()).add("text", StringType()))

    def eval(self, page: str) -> Iterator[tuple]:
        parts = re.split(r"(?is)<h([1-6])(?:\s[^>]*)?>(.*?)</h\1\s*>", page or "")
        plain = lambda t: " ".join(re.sub(r"<[^>]*>", " ", t).split())
        for level, title, text in zip(parts[1::3], parts[2::3], parts[3::3], strict=True):
            yield int(level), plain(title), plain(text)


def register(spark: SparkSession) -> None:
    """record_sections and page_sections, for SQL: FROM t, LATERAL record_sections(t.record, 'AUTHORS,TITLE')."""
    spark.udtf.register("record_sections", udtf(RecordSections, useArrow=False))
    spark.udtf.register("page_sections", udtf(PageSections, useArrow=False))
