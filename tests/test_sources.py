import random

import pytest

from fieldloom.operators import storage
from fieldloom.operators.mapping import Target, convert
from fieldloom.sources import commits, readers, writers
from fieldloom.streaming import incremental


def write(path, text, encoding="utf-8"):
    path.parent.mkdir(exist_ok=True)
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_csv(spark, tmp_path):
    p = write(tmp_path / "a.csv", 'a,b\n1,x\n2\n3,y,extra\n4,"q, ""r"""\n')
    assert [tuple(r) for r in readers.read_csv(spark, p, on_bad_lines="skip").collect()] == [("1", "x"), ("2", None), ("4", 'q, "r"')]
    assert readers.read_csv(spark, p, columns=["b"], nrows=2).count() == 2
    assert readers.read_csv(spark, p, keep_na=True).filter("b = ''").count() == 1
    t = write(tmp_path / "t.tsv", "n\td\n5\t2020-01-02\n")
    assert readers.read_tsv(spark, t, infer=True).dtypes[0][1] == "int"
    assert readers.read_csv(spark, t, sep="\t", dates=["d"]).first().d.year == 2020
    banner = write(tmp_path / "s.txt", "# banner\n#acc\tx\na\t1\nb\t2\n")
    assert [tuple(r) for r in readers.read_csv(spark, banner, sep="\t", header_line=1).collect()] == [("a", "1"), ("b", "2")]
    skipped = write(tmp_path / "k.csv", "j\nj2\nh,i\nj3\n1,2\n")
    out = readers.read_csv(spark, skipped, skip_rows=lambda k: k < 4 and k != 2)
    assert out.columns == ["h", "i"] and [tuple(r) for r in out.collect()] == [("1", "2")]
    latin = write(tmp_path / "l.csv", "a\né\n", "iso-8859-1")
    assert readers.read_csv(spark, latin, encoding="ISO-8859-1").first().a == "é"
    pipes = write(tmp_path / "p.csv", "a\t|\tb\n1\t|\t2\n")
    assert tuple(readers.read_csv(spark, pipes, sep="\t|\t").first()) == ("1", "2")


def test_csv_records_over_lines(spark, tmp_path):
    text = 'a,b\n1,"x\ny"\n2,"q ""r""\n\nz"\n3,w\n'
    wanted = [("1", "x\ny"), ("2", 'q "r"\n\nz'), ("3", "w")]
    assert [tuple(r) for r in readers.read_csv(spark, write(tmp_path / "m.csv", text)).collect()] == wanted
    banner = write(tmp_path / "n.csv", "banner, with comma\n" + text)
    assert sorted(tuple(r) for r in readers.read_csv(spark, banner, header_line=1).collect()) == wanted
    assert [tuple(r) for r in readers.read_csv(spark, write(tmp_path / "o.csv", "a,b\n1,x\n"), multi_line=False).collect()] == [("1", "x")]


def test_lines_are_numbered_in_each_file(spark, tmp_path):
    for name, n in (("a", 3000), ("b", 5)):
        write(tmp_path / f"{name}.txt", "".join(f"{'note' if i % 2 else 'row'} {name}{i}\n" for i in range(n)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")  # several splits a file
    try:
        lines = readers.numbered_lines(spark, str(tmp_path)).collect()
        assert len(lines) == 3005 and all(r.value.endswith(str(r.no)) for r in lines)
        kept = readers.read_csv(spark, str(tmp_path), sep=" ", skip_rows=lambda k: k % 2 == 1 or k == 2000)
        values = {r[1] or r[2] for r in kept.collect()}  # each file's own header names its columns
        assert kept.columns == ["row", "a0", "b0"] and values == {f"a{i}" for i in range(2, 3000, 2) if i != 2000} | {"b2", "b4"}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_dumps_and_documents(spark, tmp_path):
    p = write(tmp_path / "n.dmp", "1\t|\troot\t|\t\t|\n2\t|\tx y\t|\tz\t|\n")
    assert [tuple(r) for r in readers.read_dmp(spark, p, ["id", "name", "u"]).collect()] == [("1", "root", ""), ("2", "x y", "z")]
    j = write(tmp_path / "j.json", '[{"a": 1}, {"a": 2}]')
    assert readers.read_json_array(spark, j).count() == 2
    g = write(tmp_path / "g.json", '{"total": 2, "results": [{"a": 1}, {"a": 2}]}')
    assert [r.a for r in readers.read_pages(spark, g, "results").collect()] == [1, 2]
    x = write(tmp_path / "x.xml", "<set><r id='1'><a> v </a></r><other/><r id='2'><a>w</a></r></set>")
    assert [(r._id, r.a) for r in readers.read_xml(spark, x, "r").collect()] == [(1, "v"), (2, "w")]
    pages = spark.createDataFrame([(1, 'var data = {"x": [{"k": 1}]}; var checklist;')], "page_id int, html string")
    assert readers.extract_script_json(pages, "struct<k:int>").first().k == 1
    assert readers.list_files(spark, str(tmp_path)).count() == 4


def test_stacked_and_folders(spark, tmp_path):
    a, b = write(tmp_path / "c.csv", "x\n1\n2\n3\n"), write(tmp_path / "d.csv", "y\n4\n5\n")
    out = readers.read_stacked(spark, {"collection": a, "assembly": b})
    assert sorted((r.collection.x, r.assembly.y) for r in out.collect()) == [("1", "4"), ("2", "5")]
    both = readers.read_dir(spark, str(tmp_path))
    assert both.columns == ["x", "y"] and both.count() == 5


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "b")], "a int, b string")
    writers.write_parquet(df, str(tmp_path / "t"), ["b", "a", "c"], as_text=True)
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "t")).orderBy("a").collect()] == [("", "1", ""), ("b", "2", "")]
    writers.write_snapshot(df, str(tmp_path / "s"), "2020-01-01")
    writers.write_snapshot(df.limit(1), str(tmp_path / "s"), "2020-01-02")
    writers.write_snapshot(df.limit(1), str(tmp_path / "s"), "2020-01-01")
    assert spark.read.parquet(str(tmp_path / "s")).groupBy("snapshot_date").count().count() == 2
    writers.write_examples(df, str(tmp_path / "e"))
    assert readers.read_tsv(spark, str(tmp_path / "e")).columns == ["Example #", "a", "b"]
    writers.write_parts(df.coalesce(1), str(tmp_path / "p"), 1)
    assert len(list((tmp_path / "p").glob("part*"))) == 2
    payload = writers.to_list_payload(df, "list", "a", ["b"]).first().payload
    assert payload == '{"listName":"list","listItems":[{"itemName":1,"kvpValues":[]},{"itemName":2,"kvpValues":[{"key":"b","value":"b"}]}]}'
    events = convert(spark.createDataFrame([("n", "m")], "a string, b string"), {"a": Target("collection", "scientific_name")}, "D")
    writers.write_events(events, str(tmp_path / "ev"))
    assert spark.read.parquet(str(tmp_path / "ev/unmapped")).columns == ["b"]
    writers.write_ids(df, "a", str(tmp_path / "i"))
    writers.compact(spark, str(tmp_path / "t"), str(tmp_path / "t2"))
    assert spark.read.parquet(str(tmp_path / "t2")).count() == 2


def test_incremental_restart_repeats_nothing(spark, tmp_path):
    found = {"n": Target("collection", "scientific_name")}
    source, target, checkpoint = (str(tmp_path / x) for x in ("in", "out", "ck"))

    def run():
        stream = incremental.read_increment(spark, source, spark.createDataFrame([], "n string").schema)
        incremental.convert_incremental(stream, found, "D", "collection", "scientific_name", target, checkpoint).awaitTermination()
        return sorted(r.entity_id for r in incremental.read_event(spark, target, "collection").collect())

    spark.createDataFrame([("a",)], "n string").write.parquet(source)
    assert run() == ["Da"]
    assert run() == ["Da"]
    spark.createDataFrame([("b",)], "n string").write.mode("append").parquet(source)
    assert run() == ["Da", "Db"]


def test_other_settings_start_afresh(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / x) for x in ("in", "out", "ck"))
    spark.createDataFrame([("a", "x"), ("b", "y")], "n string, m string").write.parquet(source)

    def run(mapping, dataset="D"):
        stream = incremental.read_increment(spark, source, spark.createDataFrame([], "n string, m string").schema)
        incremental.convert_incremental(stream, mapping, dataset, "collection", "scientific_name", target, checkpoint).awaitTermination()
        return incremental.read_event(spark, target, "collection")

    first, second = {"n": Target("collection", "scientific_name")}, {"n": Target("collection", "scientific_name"), "m": Target("collection", "site")}
    assert sorted(r.scientific_name for r in run(first).collect()) == ["a", "b"]
    assert sorted((r.scientific_name, r.site) for r in run(second).collect()) == [("a", "x"), ("b", "y")]
    assert {r.dataset_id for r in run(second, "E").collect()} == {"E"}
    assert "site" not in run(first).columns and run(first).count() == 2  # taken up again, nothing is repeated
    commits.drop_others(spark, target)
    assert [n for n in storage.list_names(spark, target) if n.startswith("run=")] == [f"run={commits.current(spark, target)}"]


def test_half_a_batch_is_not_seen(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "out")
    batch = lambda v: spark.createDataFrame([((v,), (v,))], "a struct<x:int>, b struct<y:int>")
    commits.begin(spark, target, "r")
    with pytest.raises(ValueError):
        commits.read_table(spark, target, "a")
    commits.write_batch(batch(1), target, "r", 0)

    def killed(*_):
        raise RuntimeError("killed")

    monkeypatch.setattr(commits, "write_text", killed)
    with pytest.raises(RuntimeError):
        commits.write_batch(batch(2), target, "r", 1)
    monkeypatch.undo()
    seen = lambda: [sorted(r[0] for r in commits.read_table(spark, target, t).collect()) for t in "ab"]
    assert seen() == [[1], [1]]
    commits.write_batch(batch(3), target, "r", 1)
    assert seen() == [[1, 3], [1, 3]]
    commits.write_batch(batch(4), target, "r", 0)  # tried again
    assert seen() == [[3, 4], [3, 4]]


def test_runs_and_schedules(spark, tmp_path):
    from datetime import datetime

    log = str(tmp_path / "runs")
    for day, ok in ((1, True), (3, True), (5, False)):
        incremental.log_run(spark, log, step="s", index=0, success=ok, task_started=datetime(2020, 1, day), outputs=["o"])
    assert incremental.latest_runs(spark, log).first()["task started"].day == 3
    runs = spark.createDataFrame([("d", "2020-01-01", True), ("w", "2020-01-01", True), ("m", "2020-01-31", True)], "source string, started string, success boolean")
    plan = spark.createDataFrame([("d", "daily", 2, None, None), ("w", "weekly", 1, "wednesday", None), ("m", "monthly", 1, None, 31), ("x", "daily", 1, None, None)], "source string, type string, interval int, day string, date int")
    due = lambda day: {r.source: r.due for r in incremental.refresh_due(runs, plan, day).collect()}
    assert due("2020-01-02") == {"d": False, "w": False, "m": False, "x": True}
    assert due("2020-01-08")["w"] is True and due("2020-01-09")["w"] is False
    assert due("2020-02-28")["m"] is False and due("2020-02-29")["m"] is True
    assert incremental.cursor(spark.createDataFrame([], "page int")).first().next_page == 1


def test_steps(spark):
    @incremental.step(inputs=1)
    def same(df):
        return df

    df = spark.range(3)
    assert incremental.chain(df, same).count() == 3
    with pytest.raises(ValueError):
        same(df, df)


def test_columns_by_each_files_header(spark, tmp_path):
    write(tmp_path / "a.csv", "x,y\n1,2\n")
    write(tmp_path / "b.csv", "y,x\n3,4\n")
    write(tmp_path / "c.csv", '\n"y",z,x\n5,6,7\n8,"9\n,",10,11\n')
    write(tmp_path / "d.csv", "w\n")
    every = [("1", "2", None, None), ("10", "8", "9\n,", None), ("4", "3", None, None), ("7", "5", "6", None)]
    found = readers.read_csv(spark, str(tmp_path))
    assert found.columns == ["x", "y", "z", "w"] and sorted(map(tuple, found.collect())) == sorted(every)
    assert sorted(map(tuple, readers.read_csv(spark, str(tmp_path / "*.csv"), on_bad_lines="skip").collect())) == [every[0], *every[2:]]
    typed = readers.read_csv(spark, [str(tmp_path / f"{n}.csv") for n in "ba"], infer=True, columns=["x", "y"])
    assert typed.dtypes == [("x", "int"), ("y", "int")] and sorted(map(tuple, typed.collect())) == [(1, 2), (4, 3)]
    assert sorted(map(tuple, readers.read_files(spark, [str(tmp_path / f"{n}.csv") for n in "abc"]).collect())) == [r[:3] for r in sorted(every)]
    for name, text in (("e", "# b\nx,y\n1,2\n"), ("f", '# b\n#y,x,w\n3,4,"5\n6"\n')):
        write(tmp_path / "banners" / f"{name}.csv", text)
    assert sorted(map(tuple, readers.read_csv(spark, str(tmp_path / "banners"), header_line=1).collect())) == [("1", "2", None), ("4", "3", "5\n6")]


def test_inferred(spark):
    df = spark.createDataFrame([("1", "1.5", "true", "2020-01-02", "x", None, "3000000000"), (None, "2", "false", "2021-01-02", "1", None, "1")], "a string, b string, c string, d string, e string, f string, g string")
    assert [t for _, t in readers.inferred(df).dtypes] == ["int", "double", "boolean", "date", "string", "string", "bigint"]


@pytest.fixture
def tiny_splits(spark):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "90b")
    yield
    spark.conf.set(name, before)


def test_records_over_splits(spark, tmp_path, tiny_splits):
    """Random files with line breaks in quoted fields, read in splits smaller than a record, against the one-task reader."""
    r = random.Random(11)
    cell = lambda: "".join(r.choice(['a', 'b', ',', '"', "\n", "\r\n", "é", " "]) for _ in range(r.choice([0, 3, 8, 150])))
    for name, end in (("a", "\n"), ("b", "\r\n")):
        rows = [[f"k{i}", cell(), cell()] for i in range(40)]
        write(tmp_path / f"{name}.csv", end.join(",".join('"' + c.replace('"', '""') + '"' if k else c for k, c in enumerate(row)) for row in [["key", "v", "w"], *rows]) + end)
        found = readers.read_csv(spark, str(tmp_path / f"{name}.csv"), split=True)
        assert found.columns == ["key", "v", "w"]
        assert sorted((x.key, x.v or "", x.w or "") for x in found.collect()) == sorted(map(tuple, rows))
    assert readers.split_lines(spark, str(tmp_path / "a.csv")).select("start").distinct().count() > 10


def test_flat_records_over_splits(spark, tmp_path, tiny_splits):
    """Records and sequence bodies longer than a split; CRLF; a // within a record is no end."""
    head = "GB1.SEQ   Bank\n   August 15 2022\n\n   Flat File Release 250.0\n\n   3 loci\n\n"
    text = head + "".join(f"LOCUS       L{i} x\nCOMMENT     http://a//b\n            // no end\nORIGIN\n" + f"{'        1 acgt' * 3}\n" * (i * 7) + "//\n" for i in range(9))
    for name, content in (("a", text), ("b", text.replace("\n", "\r\n"))):
        found = readers.read_flat_records(spark, write(tmp_path / name, content)).collect()
        assert sorted(x.record for x in found) == [f"LOCUS       L{i} x\nCOMMENT     http://a//b\n            // no end\nORIGIN" for i in range(9)]
        assert all([s.split()[0] for s in x.sections] == ["LOCUS", "COMMENT", "ORIGIN"] for x in found)


def test_inputs_read_together(spark, tmp_path):
    paths = [write(tmp_path / f"{n}.csv", f"{h}\n1,2\n") for n, h in (("a", "x,y"), ("b", "y,x"), ("c", "x,z"))]
    f = lambda df: df.withColumn("x", df["x"].cast("int") + 1)
    one = incremental.map_inputs(spark, f, paths, readers.read_csv)
    both = incremental.map_inputs(spark, f, paths, readers.read_files, together=True)
    assert both.columns == one.columns == ["x", "y", "z"] and sorted(map(str, both.collect())) == sorted(map(str, one.collect()))
    assert both._jdf.queryExecution().optimizedPlan().toString().count("csv") == 1
