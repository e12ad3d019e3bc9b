import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fieldloom.functions import text as X
from fieldloom.operators import aggregates, filters, html, joins, nested, records, sampling, sets, trees, windows
from fieldloom.operators.filters import split_where


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_text(spark):
    lit = F.lit
    assert one(spark, X.trim_set(lit("unidentified ABnt"), "unidentified ")) == "AB"
    assert one(spark, X.null_if_match(lit("unidentified sp."), "unidentified .*")) is None
    assert one(spark, X.null_if_match(lit("x"), "unidentified .*")) == "x"
    assert one(spark, X.canonical_genus(lit("A"), lit("B"))) == "A (B)"
    assert one(spark, X.canonical_genus(lit("A"), lit(""))) == "A"
    assert one(spark, X.authorship(lit("L."), lit("1758"), lit(False))) == "(L., 1758)"
    assert one(spark, X.authorship(lit("nan"), lit("1758"), lit(True))) == ""
    assert one(spark, X.clean_authority(lit("Aus bus (L.)"), lit("Aus bus"), lit(None).cast("string"))) == "L."
    assert one(spark, X.clean_authority(lit(None).cast("string"), lit("a"), lit("b"))) == ""
    assert one(spark, X.signed_degrees(lit("39.269 N 123.798 W"))) == ("39.269", "-123.798")
    assert one(spark, X.signed_degrees(lit("12 S 5 E"))) == ("-12", "5")
    assert one(spark, X.signed_degrees(lit("1 2 3"))) == ("", "")
    assert one(spark, X.cut_brackets(lit("a (b) c (d) e"))) == "a  e"
    assert one(spark, X.clean_number(lit("1,234"))) == "1234"
    assert one(spark, X.clean_number(lit("1,2a"))) == "1,2a"
    assert one(spark, X.human_size(lit(1536))) == "1.50 KB"
    assert one(spark, X.last_parts(lit("a/b/c"), 2)) == "b_c"
    assert one(spark, X.without_last(lit("a/b/c/d"), 3)) == "a"
    assert one(spark, X.build_url(lit("h"), {"q": lit("a b/c"), "r": [lit("1"), lit("2")], "t": lit(True)})) == "h?q=a%20b/c&r=1&r=2&t=true"
    assert one(spark, X.clean_text(lit("a\\tb\nc"))) == "abc"
    assert one(spark, X.pages(lit(101), 100)) == 2
    assert one(spark, X.to_flag(lit("1"))) is True
    assert one(spark, X.strip_tags(lit("<em>a</em>b"))) == "ab"


def test_filters_keep_nulls(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    assert {r.c for r in filters.filter_ne(df, "c", "a").collect()} == {"b", None}
    assert filters.apply_exclusions(df, {"c": ["a"], "d": ["x"]}).count() == 2
    rest, hit = split_where(df, F.col("c") == "a")
    assert rest.count() + hit.count() == 3
    assert filters.drop_where(df, F.col("c") == "a").count() == 2
    assert filters.filter_regex(df, "c", "^a", negate=True).count() == 2
    lists = spark.createDataFrame([("['A' 'B']",), ("A",), (None,)], "c string")
    assert filters.filter_list_overlap(lists, "c", ["B"]).count() == 1
    names = spark.createDataFrame([("a",), (" ",), ("..",), ("_x",), (None,)], "n string")
    assert [r.n for r in filters.skip_names(names, "n").collect()] == ["a"]


def test_joins(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    right = spark.createDataFrame([(1, "x"), (None, "y")], "k int, w string")
    assert {(r.v, r.w) for r in joins.join_left(left, right, "k").collect()} == {("a", "x"), ("b", None)}
    assert {(r.v, r.w) for r in joins.join_left(left, right, "k", null_keys=True).collect()} == {("a", "x"), ("b", "y")}
    clash = right.withColumnRenamed("w", "v")
    with pytest.raises(ValueError):
        joins.join_left(left, clash, "k")
    assert joins.join_left(left, clash, "k", suffixes=("_x", "_y")).columns == ["k", "v_x", "v_y"]
    codes = joins.map_codes(left, "v", {"a": "A"})
    with pytest.raises(PySparkException):
        codes.collect()
    assert [r.v for r in joins.map_codes(left, "v", {"a": "A"}, on_miss="null").collect()] == ["A", None]


def test_inheritance(spark):
    nodes = [(1, 1, False, "r"), (2, 1, True, "b"), (3, 2, True, "c"), (4, 3, True, "d"), (5, 1, False, "e"), (6, 5, True, "f"), (7, 99, True, "g")]
    df = spark.createDataFrame(nodes, "k int, p int, flag boolean, v string")
    out = trees.resolve_inheritance(df, "k", "p", {"flag": "v"})
    assert {r.k: r.v for r in out.collect()} == {1: "r", 2: "r", 3: "r", 4: "r", 5: "e", 6: "e", 7: "g"}
    assert out.columns == ["k", "p", "v"]


def test_order_dependent(spark):
    df = spark.createDataFrame([(1, "s", "syn1", 1), (1, "s", "syn2", 2), (1, "n", "name", 3), (2, "n", "other", 4)], "id int, cls string, txt string, line int")
    out = {r.id: (r.s, r.n) for r in aggregates.pivot_last(df, "id", "cls", "txt", ["line"], ["s", "n"]).collect()}
    assert out == {1: ("syn2", "name"), 2: (None, "other")}
    lists = {r.id: r.s for r in aggregates.pivot_lists(df, "id", "cls", "txt", ["s"]).collect()}
    assert lists == {1: ["syn1", "syn2"], 2: None}
    filled = windows.ffill(spark.createDataFrame([(i, str(i) if i % 7 == 3 else None) for i in range(100)], "o int, v string").repartition(5), ["o"])
    assert {r.o: r.v for r in filled.collect()} == {i: str((i - 3) // 7 * 7 + 3) if i >= 3 else None for i in range(100)}
    with pytest.raises(ValueError):
        windows.nth_snapshot(df, "line", 9)
    assert aggregates.empty_count(df, "missing") == -1
    assert one(spark, aggregates.merge_last(F.array(*[F.struct(F.lit(k).alias("key"), F.lit(v).alias("value")) for k, v in (("a", "1"), ("b", "2"), ("a", "3"))]))) == {"a": "3", "b": "2"}


def test_sets_and_samples(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    assert sets.changed_since(df, df, "k", ["v"]).count() == 0
    assert sets.changed_since(df.filter("k = 1"), df, "k", ["v"]).count() == 1
    assert sampling.sample_records(df, 1, 3).first().k == 1
    assert sampling.prefer(df.withColumn("w", F.lit(None).cast("string")), ["w", "v"], "x").count() == 1


def test_nested(spark):
    df = spark.createDataFrame([(1, ((2, 3), "x"), [(4,), (5,)])], "id int, a struct<b:struct<c:int,d:int>,e:string>, l array<struct<m:int>>")
    assert nested.flatten_nested(df).first().asDict() == {"id": 1, "b_c": 2, "b_d": 3, "a_e": "x", "l_m": 5}
    assert nested.flatten_one(df).columns == ["id", "a_b", "a_e", "l"]
    assert nested.fully_flatten(df).count() == 2
    assert nested.normalize_json(df).columns == ["id", "a.b.c", "a.b.d", "a.e", "l"]
    text = spark.createDataFrame([("a b",), (" ",), (None,)], "t string")
    assert [r.t for r in nested.split_explode(text, "t").collect()] == ["a", "b", None, None]
    literal = spark.createDataFrame([("{'name': 'x', 'n': None}",), (None,)], "t string")
    assert [r.name for r in nested.parse_literal(literal, "t", "name string, n string").collect()] == ["x", None]
    paths = spark.createDataFrame([("h/PRJCA1/CRA2/CRA3/f.gz",)], "u string")
    assert nested.path_to_columns(paths, "u", {"p": "PRJCA", "e": "CRA", "r": "CRR"}).first()[1:] == ("PRJCA1", "CRA3", None, "f.gz")
    assert one(spark, nested.sample_id(F.lit(None).cast("string"), F.lit(12))) == "SAMN00000012"
    attributes = spark.createDataFrame([([("a", None, "1"), ("b", "h", "2"), ("a", None, "3")],)], "x array<struct<attribute_name:string,harmonized_name:string,value:string>>")
    assert nested.attributes_to_map(attributes, "x").first().attributes == '{"h":"2","a":"3"}'
    keyed = spark.createDataFrame([([("mt", 1), (None, 2)],)], "o array<struct<description:string,n:int>>")
    out = nested.key_list(keyed, "o", "description", ["mt", "Unknown", "x"]).first()
    assert (out["mt"].n, out["Unknown"].n, out["x"]) == (1, 2, None)


@pytest.mark.parametrize("link", ["b", "/b", "../b", "?q=1", "#f", "http://o/x", "//o/x", "./b/./c/", "", "b/../c?x=../y"])
def test_resolve_urls(spark, link):
    from urllib.parse import urljoin

    base = "http://h/a/d/p.html"
    df = spark.createDataFrame([(base, link)], "base string, link string")
    assert nested.resolve_urls(df, "base", "link").first().url == urljoin(base, link)


RECORD = """LOCUS       AB1 120 bp DNA linear PLN 01-JAN-2000
DEFINITION  Some thing
            wrapped.
ACCESSION   AB1
VERSION     AB1.1
DBLINK      BioProject: PRJ1, PRJ2
            BioSample: S1
KEYWORDS    .
SOURCE      Aus bus
  ORGANISM  Aus bus
            Eukaryota; Plantae;
            Aus.
REFERENCE   1  (bases 1 to 120)
  AUTHORS   A. and
            B.
  TITLE     T
COMMENT     ##Assembly-Data-START##
            Assembly Method :: x v. 1 (beta)
            Sequencing Tech :: y
            ##Assembly-Data-END##
FEATURES             Location/Qualifiers
     source          1..120
                     /organism="Aus bus"
                     /isolate="I 1"
                     /flag
     CDS             3..9
                     /translation="MM"
                     /note="long
                     text"
ORIGIN
        1 acgt"""


def test_flat_records(spark, tmp_path):
    from fieldloom.plans.genomes import sequence_records
    from fieldloom.sources.readers import read_flat_records

    (tmp_path / "f.seq").write_text(f"HEADER LINE\n  more\n\n{RECORD}\n//\n{RECORD.replace('AB1', 'AB2')}\n//\n")
    out = sequence_records(read_flat_records(spark, str(tmp_path / "f.seq")), ["isolate", "specimen_voucher"]).orderBy("accession").collect()
    assert [r.accession for r in out] == ["AB1", "AB2"]
    r = out[0]
    assert (r.definition, r.organism, r.higher_classification, r.keywords) == ("Some thing wrapped.", "Aus bus", "Eukaryota; Plantae; Aus.", "")
    assert r.db_links["bioproject"][1].endswith("PRJ2") and r.comment_tags == {"assembly_method": "x v. 1 (beta)", "sequencing_tech": "y"}
    assert (r.references[0].bp_range, r.references[0].authors, r.specimen) == ("(bases 1 to 120)", "A. and B.", "I 1")
    assert r.features["1..120"]["source"]["other"] == "flag" and r.features["3..9"]["CDS"] == {"note": "long text"}
    assert records.features_of(None) == {}


def test_html(spark):
    page = """<h2>Genomes</h2><p>x</p><table><tr><th>Name</th><th>Size</th></tr><tr><td>A &amp; B</td><td><a href="/l">1,200</a></td></tr></table>
    <h3>Places</h3><ul><li><b>State:</b> North</li><li>South</li></ul><table><tr><th>Key</th><td>v<br>w</td></tr><tr><th>Skip</th><td>z</td></tr></table>"""
    pages = spark.createDataFrame([(1, page), (2, None), (3, "<p>no table")], "page_id int, html string")
    assert [(r.page_id, r.cells) for r in html.html_tables(pages, "page_id", "html").collect()] == [(1, {"Name": "A & B", "Size": "1,200"})]
    assert html.html_table_rules(pages, "page_id", "html", prefixes={"Size": "http://h"}).first().cells == {"Name": "A & B", "Size": "http://h/l"}
    assert html.html_table_rules(pages, "page_id", "html").first().cells["Size"] == "1200"
    assert html.html_table_with_link(pages, "page_id", "html", "Genomes").first().cells["link"] == "/l"
    sections = html.html_sections(pages, "page_id", "html")
    assert [(r.label, r.value) for r in sections.filter("section = 'Places'").orderBy("item_no").collect()][:2] == [("State", "North"), (None, "South")]
    assert nested.html_kv(pages, "page_id", "html", ["Skip"]).filter("page_id = 1").first()["values"]["Key"] == "v w"
    links = nested.extract_links(spark.createDataFrame([(1, '<a href="d/">x</a><a href="/r"></a><a href="f.gz"></a><a href="g.txt"></a>')], "k int, h string"), "k", "h", r".*\.gz")
    assert [(r.href, r.kind) for r in links.collect()] == [("d/", "folder"), ("f.gz", "file")]


def test_trees_of_any_depth(spark):
    """A chain longer than a hundred levels, and circles."""
    n = 102
    chain = spark.createDataFrame([(i, i - 1 if i else None, i == n - 1, str(i), i > 0, f"v{i}") for i in range(n)], "k int, p int, stop boolean, path string, flag boolean, v string").coalesce(1)
    (found,) = trees.walk_tree(chain, "k", "p", "stop", "path").collect()
    assert len(found.path) == n
    assert {r.v for r in trees.resolve_inheritance(chain, "k", "p", {"flag": "v"}).collect()} == {"v0"}
    links = chain.filter("p is not null and k < 12").selectExpr("cast(p as string) source", "cast(k as string) target", "'x' name")
    assert trees.crawl_frontier(links, spark.createDataFrame([("0",)], "url string"), -1).count() == 12
    for n in (2, 3):
        circle = spark.createDataFrame([(i, (i + 1) % n, True, "v") for i in range(n)], "k int, p int, flag boolean, v string")
        with pytest.raises(ValueError):
            trees.resolve_inheritance(circle, "k", "p", {"flag": "v"})
    repeated = spark.createDataFrame([(1, None, False, "a"), (2, 1, False, "b"), (3, 2, False, "c"), (2, 3, False, "d")], "k int, p int, stop boolean, path string")
    with pytest.raises(ValueError):
        trees.walk_tree(repeated, "k", "p", "stop", "path")


def test_samples_do_not_follow_partitions(spark):
    df = spark.range(500)
    assert [r.id for r in sampling.sample_n(df, 20, 3).collect()] == [r.id for r in sampling.sample_n(df.repartition(7), 20, 3).collect()]
    assert sampling.sample_n(df, 20, 4).collect() != sampling.sample_n(df, 20, 3).collect()


def test_literals_keep_quoted_words(spark):
    rows = [("{'a': 'None found', 'b': None, 'c': \"True, it's None\", 'd': False}",), ("{'a': 'x\\'None\\' y', 'b': 'z'}",), (None,)]
    out = nested.parse_literal(spark.createDataFrame(rows, "t string"), "t", "a string, b string, c string, d boolean").collect()
    assert tuple(out[0]) == ("None found", None, "True, it's None", False)
    assert out[1].b == "z" and "None" in out[1].a and tuple(out[2]) == (None,) * 4


def test_twins_follow_their_order(spark):
    rows, twins = spark.createDataFrame([(1, "x")], "k int, v string"), spark.createDataFrame([(1, "b", 1), (1, "a", 2)], "k int, v string, at int")
    assert joins.fetch_from_twin(rows, twins, "k", "v").first().v == "a" and joins.fetch_from_twin(rows, twins, "k", "v", ["at"]).first().v == "b"


def test_json_columns_keep_every_key(spark):
    from fieldloom.operators import schema

    rows = [(1, '{"a":1,"b":{"c":[1,2],"d":"x"},"it\'s":2.5}'), (2, '{"a":"t","b":{"c":[3],"e":true}}'), (3, '{"z":[{"q":1}],"a":null}'), (4, "no json"), (5, None), (6, '{"id":7,"Z":1,"x\'y\\"":3}')]
    df = spark.createDataFrame(rows, "id int, j string")
    wide = {r.id: r.asDict(True) for r in schema.json_columns(df, "j", 2).collect()}
    assert wide[1] == {"id": 1, "a": "1", "b": {"c": [1, 2], "d": "x", "e": None}, "rest": {"it's": "2.5"}}
    assert wide[3]["rest"] == {"z": '[{"q":1}]'} and wide[4]["rest"] is None and wide[5]["b"] is None
    every = {r.id: r.asDict(True) for r in schema.json_columns(df, "j").collect()}
    assert every[6]["id_"] == 7 and every[6]["Z"] == 1 and every[6]["rest"] == {"x'y\"": "3"} and every[1]["it's"] == 2.5
    flat = schema.flatten_json(df, "j")
    assert {"b|c", "b|d", "z_|q"} <= set(flat.columns) and flat.filter("id = 1").count() == 2
    none = schema.json_columns(df.limit(0), "j")
    assert none.columns == ["id", "rest"] and none.count() == 0


def test_named_values_and_keyed_records(spark):
    from fieldloom.operators import schema

    kv = spark.createDataFrame([(1, "a.b", "1", 1), (1, "a.b", "2", 2), (1, "c", "3", 1), (2, "c", "4", 1), (2, "d", "5", 1), (3, None, "6", 1)], "id int, n string, v string, o int")
    few = {r.id: r for r in schema.key_values(kv, "id", "n", "v", ["o"], width=1).collect()}
    assert (few[1].a_b, few[1].rest) == ("2", {"c": "3"}) and few[2].rest == {"c": "4", "d": "5"} and (few[3].a_b, few[3].rest) == (None, None)
    records = spark.createDataFrame([(1, [("x", 1), ("y", 2), ("x", 3)]), (2, [(None, 4)]), (3, []), (4, None)], "id int, l array<struct<k:string,v:int>>")
    made = {r.id: r for r in schema.keyed_records(records, "l", "k", width=2).collect()}
    assert made[1].x.v == 3 and made[1].rest == '[{"k":"y","v":2}]' and made[2].Unknown.v == 4 and made[3].rest is None and made[4].rest is None


def test_spread_ordinals_and_first_rows_of_hot_keys(spark):
    from fieldloom.operators import windows

    df = spark.range(20_000).selectExpr("IF(id % 10 < 9, NULL, id % 50) AS k", "id * 7919 % 20011 AS o")
    assert windows.ordinal(df, ["k"], ["o"]).exceptAll(windows.ordinal(df, ["k"], ["o"], spread=True)).isEmpty()
    plan = windows.keep_first(df, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan  # one row a key and task is sent on
    assert windows.keep_first(df, ["k"], ["o"]).count() == 6


def test_sketches_of_columns(spark):
    from fieldloom.operators import sampling

    df = spark.range(3000).selectExpr("CAST(id % 700 AS STRING) AS a", "id % 3 AS b", "IF(id % 2 = 0, NULL, id) AS c", "CAST(NULL AS STRING) AS d")
    import hashlib

    got = sorted(map(tuple, sampling.sample_fields(df.repartition(5), 10, 3).collect()))
    want = []
    for f in df.columns:
        values = {str(r[0]) for r in df.select(f).collect() if r[0] is not None}
        want += [(f, v) for v in sorted(values, key=lambda v: (hashlib.md5(f"3|{f}|{v}".encode()).hexdigest(), v))[:10]]
    assert got == sorted(want)


def test_missing_ancestors(spark):
    from fieldloom.operators import trees

    rows = [(1, None, False, "a"), (2, 1, True, "b"), (3, 9, True, "c"), (4, 3, True, "d"), (5, 3, False, "e"), (6, 8, True, "f")]
    out, missing = trees.resolve_and_report(spark.createDataFrame(rows, "k int, p int, f boolean, v string"), "k", "p", {"f": "v"})
    assert sorted((r.k, r.flag, r.missing) for r in missing.collect()) == [(3, "f", 9), (4, "f", 9), (6, "f", 8)]
    assert {r.k: r.v for r in out.collect()}[2] == "a"


def test_group_functions(spark):
    from fieldloom.operators import groups

    rows = [(i % 7 if i % 7 else None, "ab" + str(i % 3) * (i % 5), i * i % 101) for i in range(400)] + [(9, None, None)]
    df = spark.createDataFrame(rows, "k int, t string, v int").repartition(5)
    by = {}
    for k, t, v in rows:
        by.setdefault(k, []).append((t, v))
    import os

    wide = {r.k: r.prefix for r in groups.common_prefix(df, ["k"], "t").collect()}
    assert wide == {k: os.path.commonprefix([t for t, _ in x if t]) if any(t for t, _ in x) else None for k, x in by.items()}
    gaps = {r.k: r.gap for r in groups.largest_gap(df, ["k"], "v").collect()}
    ordered = {k: sorted({v for _, v in x if v is not None}) for k, x in by.items()}
    assert gaps == {k: max((b - a for a, b in zip(x, x[1:])), default=None) for k, x in ordered.items()}
    f = groups.GroupFunction(lambda rows: len(rows), lambda a, b: a + b, lambda s: (s,))
    for held in (1, 50_000):  # states that a task lets go early meet again
        assert {(r.k): r.n for r in groups.group_function(df, ["k"], ["v"], f, "n long", held).collect()} == {k: len(x) for k, x in by.items()}
    assert groups.common_prefix(df.limit(0), ["k"], "t").count() == 0


def test_table_functions(spark):
    from fieldloom.functions import tables

    tables.register(spark)
    rows = spark.sql("SELECT * FROM record_sections('LOCUS   L 1\\nREFERENCE   1\\n  AUTHORS   A.\\n            B.\\n            C.\\nX', 'AUTHORS')").collect()
    assert [tuple(r) for r in rows] == [(0, "LOCUS", "L 1", None), (1, "REFERENCE", "1", "A. B. C."), (2, "X", "", None)]
    assert spark.sql("SELECT * FROM record_sections(CAST(NULL AS STRING), '')").count() == 0
    page = spark.sql("SELECT * FROM page_sections('<p>x</p><h1 id=a>A <b>b</b></h1><p>t<h2>C</h2>')").collect()
    assert [tuple(r) for r in page] == [(1, "A b", "t"), (2, "C", "")]


def test_pages_are_parsed_in_linear_time():
    import time

    from fieldloom.operators import html

    cells = lambda page: [[c.text() for c in r] for r in html.table_rows(html.parse(page).find("table"))[1]]
    assert cells("<TABLE class=x><tr><th>A<th>B<tr><td>1 &amp; 2<td><a href='/x?a=1&amp;b'>y</a>z<br/>w</table>") == [["1 & 2", "yz w"]]
    link = html.parse("<p><a data-x href=\"a'b>c\" class=k>t</a></b>").find("a")
    assert link.attributes == {"data-x": "", "href": "a'b>c", "class": "k"} and link.text() == "t"
    assert html.parse("<script>var a='<td>';</script><td>x").find("td").text() == "x" and html.parse(None).children == []
    for unit in ("<td>", "<div>", "</p>", "<a ='", "<!--", "<b", "&amp"):
        began = time.process_time()
        html.parse("<b>" + unit * 50_000)
        assert time.process_time() - began < 3


def test_sizes_are_rounded_as_printf_does(spark):
    values = [512**3 * 997, 1034**3 * 997, 1152, 1408, 9961472 + 5243, 2**63 - 1, 0, 128]
    rows = spark.createDataFrame([(v,) for v in values], "v long")
    found = [tuple(r) for r in rows.select(X.human_size("v", "GB"), X.human_size("v")).collect()]
    for v, (gigabytes, any_unit) in zip(values, found, strict=True):
        for top, text in (("GB", gigabytes), ("PB", any_unit)):
            size, k = float(v), 0
            while size > 1024 and X.UNITS[k] != top:
                size, k = size / 1024, k + 1
            assert text == f"{size:.2f} {X.UNITS[k]}"
    assert found[0] == ("124.62 GB", "124.62 GB") and found[1] == ("1026.50 GB", "1.00 TB")


def test_gaps_are_found_without_python(spark):
    from fieldloom.operators import groups

    gaps = groups.largest_gap(spark.createDataFrame([(1, 5), (1, None), (1, 9), (1, 5), (2, 3), (None, None)], "k int, v long"), ["k"], "v")
    assert {r.k: r.gap for r in gaps.collect()} == {1: 4, 2: None, None: None} and dict(gaps.dtypes)["gap"] == "bigint"
    plan = gaps._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "Pandas" not in plan and "Arrow" not in plan


def test_group_functions_see_batches_not_groups(spark):
    from fieldloom.operators import groups

    rows = [(float("nan"), "a"), (float("nan"), "b"), (None, "c"), (0.5, "d")]
    f = groups.GroupFunction(lambda rows: sorted(v for (v,) in rows), lambda a, b: sorted(a + b), lambda s: ("".join(s),))
    found = groups.group_function(spark.createDataFrame(rows, "k double, t string").repartition(3), ["k"], ["t"], f, "all string")
    assert {(str(r.k), r["all"]) for r in found.collect()} == {("nan", "ab"), ("None", "c"), ("0.5", "d")}
    assert "FlatMapGroups" not in found._jdf.queryExecution().executedPlan().toString()


def test_deep_pages_are_searched():
    from fieldloom.operators import html

    assert html.parse("<div>" * 5000 + "<td>x<b> y</b>").find("td").text() == "xy"
