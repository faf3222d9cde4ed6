"""Readers over small files."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from spendloom.operators import reshape
from spendloom.sources.pages import read_array, read_documents, read_pages
from spendloom.sources.quoted import Quoted
from spendloom.sources.tabular import POSITIONAL_PAGE, read_csv_report, read_table, rows_to_columns

RECORD = "id bigint, name string"


def put(folder, name, content):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(content if isinstance(content, str) else json.dumps(content, indent=1))


def test_indented_pages(spark, tmp_path, values):
    put(tmp_path, "1.json", {"data": [{"id": 1, "name": "a"}, {"id": 2}], "offset": 7})
    put(tmp_path, "2.json", {"data": [{"id": 3, "name": "c", "unknown": True}], "offset": 8})
    put(tmp_path, "3.json", {"data": []})
    put(tmp_path, "4.json", {"message": "no records"})
    got = read_pages(spark, str(tmp_path), "data", RECORD, context={"offset": "int"})
    assert values(got) == [(7, 1, "a"), (7, 2, None), (8, 3, "c")]


def test_pages_one_per_line(spark, tmp_path, values):
    put(tmp_path, "1.json", "\n".join(json.dumps({"data": [{"id": i, "name": "x"}]}) for i in range(3)))
    got = read_pages(spark, str(tmp_path), "data", RECORD, multi_line=False)
    assert values(got) == [(0, "x"), (1, "x"), (2, "x")]


def test_root_array(spark, tmp_path, values):
    put(tmp_path, "1.json", [{"id": 1, "name": "a"}, {"id": 2, "name": "b"}])
    assert values(read_array(spark, str(tmp_path), RECORD)) == [(1, "a"), (2, "b")]


def faults(read, *args, **options):
    """Parsed rows and texts of the others."""
    found = []
    rows = read(*args, unreadable=lambda df: found.extend(df.filter("_corrupt_record IS NOT NULL").collect()), **options)
    return rows, sorted(r["_corrupt_record"] for r in found)


def test_records_of_a_page_are_rejected_one_by_one(spark, tmp_path, values):
    put(tmp_path, "1.json", {"data": [{"id": 1, "name": "a"}, {"id": "x", "name": "b"}, {"id": 3}, 7, None, [{"id": 4}]], "offset": 5})
    put(tmp_path, "2.json", {"data": [{"id": 9}], "offset": "six"})
    put(tmp_path, "3.json", {"data": "none"})
    put(tmp_path, "4.json", '{"data": [{"id": 1}, {"i')
    put(tmp_path, "5.json", {"data": [{"id": 6, "name": 1.5}], "offset": 8})
    got, torn = faults(read_pages, spark, str(tmp_path), "data", RECORD, context={"offset": "int"})
    assert values(got) == [(5, None, None), (5, 1, "a"), (5, 3, None), (8, 6, "1.5")]
    pages = [json.dumps({"data": [{"id": 9}], "offset": "six"}, indent=1), json.dumps({"data": "none"}, indent=1), '{"data": [{"id": 1}, {"i']
    assert torn == sorted([*pages, '{"id":"x","name":"b"}', "7", '[{"id":4}]'])


def test_elements_of_an_array_are_rejected_one_by_one(spark, tmp_path, values):
    mixed = [{"id": 1, "name": "a"}, {"id": "x"}, {"id": 3}, {"id": [1]}]
    lines = [json.dumps(mixed), json.dumps(mixed), '[{"id": 5}, {"i', json.dumps([{"id": 6}]), "[]", '{"id": "y"}']
    put(tmp_path, "1.json", "\n".join(lines))
    got, torn = faults(read_array, spark, str(tmp_path), RECORD, multi_line=False)
    assert values(got) == [(1, "a"), (1, "a"), (3, None), (3, None), (6, None)]
    assert torn == sorted(['{"id":"x"}', '{"id":[1]}'] * 2 + [lines[2], lines[5]])


def test_good_pages_are_not_taken_apart(spark, tmp_path):
    """The input is parsed once, and pages without a fault by their types alone."""
    put(tmp_path, "1.json", {"data": [{"id": 1}]})
    scans = []
    got = read_pages(spark, str(tmp_path), "data", RECORD, unreadable=lambda df: scans.append(df))
    for df in (got, *scans):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Format: Parquet" in plan and "JSON" not in plan


def test_one_document_per_file(spark, tmp_path):
    for i in range(3):
        put(tmp_path, f"{i}.json", {"id": i, "properties": {"email": {"value": f"{i}@example.org"}}})
    docs = read_documents(spark, str(tmp_path), "id bigint, properties map<string, struct<value string>>")
    got = {r.id: r.v for r in docs.select("id", F.col("properties")["email"]["value"].alias("v")).collect()}
    assert got == {i: f"{i}@example.org" for i in range(3)}


def test_positional_rows(spark, tmp_path, values):
    put(tmp_path, "1.json", {"rows": [["a", "1"], ["b"]], "totalResults": 2})
    put(tmp_path, "2.json", {"totalResults": 0})
    pages = read_documents(spark, str(tmp_path), POSITIONAL_PAGE)
    assert values(rows_to_columns(pages, ("name", "n"))) == [("a", "1"), ("b", None)]


def test_csv_report(spark, tmp_path, values):
    put(tmp_path, "1.csv", 'Day,% new sessions,Cost / conv.\n2018-01-01,5%,1\n2018-01-02,"1,000%","say ""hi"""\n')
    got = read_csv_report(spark, str(tmp_path), ("Day", "% new sessions", "Cost / conv."))
    assert values(got) == [("2018-01-01", "5%", "1"), ("2018-01-02", "1,000%", 'say "hi"')]


HEADERS = ("day", "ad", "text")
#: Records and lines that are none, each with what it stands for.
CSV_LINES = [
    ("2018-01-01,1,plain", ("2018-01-01", "1", "plain")),
    ('2018-01-02,2,"two\nlines, ""quoted"""', ("2018-01-02", "2", 'two\nlines, "quoted"')),
    ('2018-01-03,3,"a stray quote', None),
    ("2018-01-04,4,", ("2018-01-04", "4", None)),
    ('2018-01-05,5,5" pipe', ("2018-01-05", "5", '5" pipe')),
    ("too,few", None),
    ('"a\n\nb","c\nd","e\nf"', ("a\n\nb", "c\nd", "e\nf")),
    ('x,"y\nz",w', ("x", "y\nz", "w")),
    ("one,too,many,values", None),
    ('"q","r","s"', ("q", "r", "s")),
    ('2018-01-06,"un\nclosed', None),
]


def csv_text(records):
    return "\n".join([",".join(HEADERS), *records]) + "\n"


@pytest.mark.parametrize("size", [1 << 20, 64, 200])
def test_quoted_records_in_ranges(spark, tmp_path, values, size):
    """Whatever the ranges, records that span lines are whole, and a stray quote costs its own line."""
    random.seed(size)
    want, faulty = [], []
    for name in ("a", "b"):
        some = [random.choice(CSV_LINES[:10]) for _ in range(120)] + [CSV_LINES[0], CSV_LINES[10]]
        put(tmp_path, f"{name}.csv", csv_text([text for text, _ in some]))
        want += [row for _, row in some if row]
        faulty += [line for text, row in some if not row for line in text.split("\n")]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        found = []
        got = read_csv_report(spark, str(tmp_path), HEADERS, unreadable=lambda df: found.extend(df.collect()))
        assert size > 1 << 16 or got.rdd.getNumPartitions() > 8
        assert values(got) == sorted(want, key=lambda r: [(v is not None, str(v)) for v in r])
        assert sorted(r["_corrupt_record"] for r in found) == sorted(faulty)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_stray_quote_costs_one_record(spark, tmp_path, values):
    lines = [f"2018-01-{n:02},{n},text" for n in range(1, 12)]
    lines[1] = '2018-01-02,2,"open'
    put(tmp_path, "1.csv", csv_text(lines))
    found = []
    got = read_csv_report(spark, str(tmp_path), HEADERS, unreadable=lambda df: found.extend(df.collect()))
    assert sorted(int(r.ad) for r in got.collect()) == [n for n in range(1, 12) if n != 2]
    assert [r["_corrupt_record"] for r in found] == [lines[1]]
    # Without a table for rejects the line is taken as far as it goes.
    assert read_csv_report(spark, str(tmp_path), HEADERS).count() == 11


def test_a_chain_of_records_that_span_lines(spark, tmp_path, values):
    """Every line is loose, and each may end a record or start one."""
    records = [f'{n},"a\nb",{n}' for n in range(500)]
    put(tmp_path, "1.csv", csv_text(records))
    got = read_csv_report(spark, str(tmp_path), HEADERS, unreadable=lambda df: None)
    assert sorted(values(got), key=lambda r: int(r[0])) == [(str(n), "a\nb", str(n)) for n in range(500)]


def test_too_long_runs_are_stray_quotes(spark, tmp_path):
    put(tmp_path, "1.csv", csv_text(['1,2,"' + "\n".join(["x" * 50] * 10) + '"', "3,4,5"]))
    report = Quoted(spark, str(tmp_path), HEADERS, longest=100)
    assert report.check_headers() == 10
    loose = report.numbered()
    assert report.runs(loose).count() == 0
    assert report.rejected(loose, report.taken(report.runs(loose))).count() == 10


def test_empty_and_missing_values(spark, tmp_path, values):
    put(tmp_path, "1.csv", csv_text(['a,"",c', ",,", "", "x,y,z"]))
    put(tmp_path, "2.csv", "")
    put(tmp_path, "3.csv", csv_text([]))
    got = read_csv_report(spark, str(tmp_path), HEADERS)
    assert values(got) == [(None, None, None), ("a", None, "c"), ("x", "y", "z")]


def test_csv_columns_that_moved_fail(spark, tmp_path):
    put(tmp_path, "1.csv", "b,a\n1,2\n")
    with pytest.raises(Exception, match="header"):
        read_csv_report(spark, str(tmp_path), ("a", "b")).collect()


def test_table_by_path_and_name(spark, tmp_path, make, values):
    df = make([(1, "a")], RECORD)
    df.write.parquet(str(tmp_path / "t"))
    assert values(read_table(spark, str(tmp_path / "t"), ["name"])) == [("a",)]
    df.createOrReplaceTempView("stored")
    assert values(read_table(spark, "stored", ["id"])) == [(1,)]


def test_flatten(make):
    df = make([(1, ((2, [3]), "x"))], "id int, a struct<b struct<c int, d array<int>>, e string>")
    flat = reshape.flatten(df)
    assert flat.columns == ["id", "a.b.c", "a.b.d", "a.e"]
    assert tuple(flat.first()) == (1, 2, [3], "x")
    assert reshape.flatten(df, "_").columns == ["id", "a_b_c", "a_b_d", "a_e"]


def test_flatten_of_a_missing_object(make):
    df = make([(1, None)], "id int, a struct<b int>")
    assert tuple(reshape.flatten(df).first()) == (1, None)


def test_programs_of_a_contact(make, values):
    df = make([(1, None), (2, ""), (3, "MSIS"), (4, "MSIS;BAPS;")], "VID int, programs string")
    got = reshape.explode_items(df, ["VID"], "programs", "P")
    assert values(got) == [(1, None), (2, None), (3, "MSIS"), (4, None), (4, "BAPS"), (4, "MSIS")]


def test_children_of_an_empty_or_missing_list(make, values):
    df = make([(1, [5, 6]), (2, []), (3, None)], "id int, list array<int>")
    assert values(reshape.explode_children(df, [F.col("id")], F.col("list"), "x")) == [(1, 5), (1, 6)]


def test_load_stamp(make):
    df = make([(1,)], "id int")
    assert reshape.load_stamp(df, "d", "2018-01-01").first().d == dt.date(2018, 1, 1)
    assert reshape.load_stamp(df, "d").first().d is not None


def test_a_faulty_line_is_not_repeated_with_each_element(spark, tmp_path, monkeypatch):
    from spendloom.sources import pages

    name = "".join(random.Random(1).choices("abcdef", k=50))
    array = json.dumps([{"id": "x" if i == 42 else i, "name": name} for i in range(200)])
    put(tmp_path, "1.json", "\n".join([array] * 3))
    seen, land = [], pages.landed_once
    monkeypatch.setattr(pages, "landed_once", lambda df, what: seen.append(land(df, what)) or seen[-1])
    got, torn = faults(read_array, spark, str(tmp_path), RECORD, multi_line=False)
    assert got.count() == 3 * 199 and len(torn) == 3
    assert all(df.agg(F.sum(F.length("_corrupt_record"))).first()[0] < len(array) for df in seen)


def test_odd_lines_of_arrays_are_read_as_the_reader_does(spark, tmp_path, values):
    lines = ['[{"id": 1}] tail', '{"id": 2} tail', "", " \t", "7", '"x"', '[{"id": 3}, {"id": 4, "name": "d"}]', "[]", ' {"id": 5}', "{}", "[7]", "[{"]
    put(tmp_path, "1.json", "\n".join(lines))
    got, torn = faults(read_array, spark, str(tmp_path), RECORD, multi_line=False)
    plain = read_documents(spark, str(tmp_path), RECORD, multi_line=False, keep_corrupt=True).filter("_corrupt_record IS NULL")
    assert values(got) == values(plain, "id", "name")
    assert torn == sorted(["7", '"x"', "7", "[{"])


def test_landed_files_are_bounded(spark, tmp_path, monkeypatch):
    """Report files by their lines, page files by their records; these are compressed."""
    from spendloom.checks import landing

    monkeypatch.setattr(landing, "FILE_LINES", 10)
    monkeypatch.setattr(landing, "FILE_RECORDS", 10)
    rows = spark.range(100).select(F.col("id").alias("A"), F.lit("b").alias("B"))
    report = landing.land_csv_lines(rows, F.concat_ws(",", "A", "B"), "report")
    lines = spark.read.text(report)
    assert lines.select(F.input_file_name()).distinct().count() == 10
    assert sorted(r.value for r in lines.collect()) == sorted(["A,B"] * 10 + [f"{i},b" for i in range(100)])
    assert read_csv_report(spark, report, ("A", "B")).count() == 100
    pages = landing.land_documents(rows.coalesce(1), "pages")
    files = spark.read.text(pages).groupBy(F.input_file_name().alias("f")).count().collect()
    assert [r["count"] for r in files] == [10] * 10 and all(".gz" in r.f for r in files)
