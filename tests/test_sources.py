from __future__ import annotations

from datetime import date

from conftest import bag, values
from pyspark.sql import functions as F

from loomframe import sources
from loomframe.plans.sales import SALES_SCHEMA, line_revenue

SALES = """product_id,name,category,price,quantity
k7,Rope 12 m,deck,18.25,4
k8,"Lamp, oil",cabin,0.05,200
m1,Anchor,deck,310.00,0"""
MORE_SALES = """product_id,name,category,price,quantity
z9,Bell,cabin,77.77,3"""
REVENUE = {"k7": 73.0, "k8": 10.0, "m1": 0.0, "z9": 233.31}


def sales_files(tmp_path):
    (tmp_path / "harbour.csv").write_text(SALES)
    (tmp_path / "harbour2.csv").write_text(MORE_SALES)
    (tmp_path / "notes.txt").write_text("not a table")
    return str(tmp_path)


def test_csv_with_header_and_wildcard(spark, tmp_path):
    folder = sales_files(tmp_path)
    one = sources.read_csv(spark, f"{folder}/harbour.csv", SALES_SCHEMA)
    assert one.count() == 3
    both = sources.read_csv(spark, f"{folder}/harbour*.csv", SALES_SCHEMA)
    revenue = line_revenue(both, ["product_id"], "price", "quantity")
    assert dict(tuple(r) for r in revenue.collect()) == REVENUE


def test_directory_with_and_without_schema(spark, tmp_path):
    folder = sales_files(tmp_path)
    assert sources.read_dir(spark, folder, SALES_SCHEMA).count() == 4
    inferred = sources.read_dir(spark, folder)
    assert dict(inferred.dtypes)["price"] == "double"
    assert dict(inferred.dtypes)["quantity"] == "int"


def test_source_file_name(spark, tmp_path):
    read = sources.read_csv(spark, f"{sales_files(tmp_path)}/harbour*.csv", SALES_SCHEMA)
    counts = sources.with_source_file(read).groupBy("filename").count()
    assert bag(counts) == {("harbour.csv", 3): 1, ("harbour2.csv", 1): 1}


def test_lines_header_and_records(spark, tmp_path):
    lines = sources.read_lines(spark, f"{sales_files(tmp_path)}/harbour*.csv")
    assert lines.count() == 6
    data = sources.drop_header(lines, SALES.split("\n")[0])
    records = sources.parse_delimited(data, SALES_SCHEMA)
    assert records.count() == 4
    first = records.where("product_id = 'k8'").first()
    assert tuple(first) == ("k8", "Lamp, oil", "cabin", 0.05, 200)


def test_header_removal_keeps_null_lines(spark):
    lines = spark.createDataFrame([("h",), (None,), ("x",)], "value string")
    assert sources.drop_header(lines, "h").count() == 2


def test_no_header_tab_pipe_and_space(spark, tmp_path):
    (tmp_path / "plain.csv").write_text("007,ab,-0.5\n007,cd,\n")
    plain = sources.read_csv(
        spark, str(tmp_path / "plain.csv"), "c string, o string, a float", header=False
    )
    assert plain.count() == 2 and plain.first()[0] == "007"

    (tmp_path / "marks.tsv").write_text("8\t-1\t0\t4102444800\n")
    tabs = sources.read_csv(
        spark, str(tmp_path / "marks.tsv"), "u int, m int, r int, t bigint", header=False, sep="\t"
    )
    assert tuple(tabs.first()) == (8, -1, 0, 4102444800)

    (tmp_path / "isles.txt").write_bytes("5|Île d'Ægir|x\n".encode("iso-8859-1"))
    pipes = sources.read_csv(
        spark, str(tmp_path / "isles.txt"), "id int, title string",
        header=False, sep="|", encoding="ISO-8859-1",
    )
    assert tuple(pipes.first()) == (5, "Île d'Ægir")

    (tmp_path / "names").write_text('3 "NORTH STAR/POLARIS"\n9 ""\n')
    names = sources.read_csv(
        spark, str(tmp_path / "names"), "id int, name string", header=False, sep=" "
    )
    assert bag(names) == {(3, "NORTH STAR/POLARIS"): 1, (9, None): 1}


def test_unparsable_fields_are_null(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("id,d\n1,2024-01-01\nx,2024-01-02\n")
    read = sources.read_csv(spark, str(tmp_path / "bad.csv"), "id int, d date")
    assert bag(read) == {(1, date(2024, 1, 1)): 1, (None, date(2024, 1, 2)): 1}


def test_malformed_lines_are_set_apart(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("1,2024-01-01\nx,bad\n3\n")
    read = sources.read_with_rejects(
        spark, str(tmp_path / "bad.csv"), "id int, d date", header=False
    )
    good, bad = sources.split_malformed(read)
    assert bag(good) == {(1, date(2024, 1, 1)): 1}
    assert bag(bad, "_rejected") == {("x,bad",): 1, ("3",): 1}


def test_a_line_is_judged_by_all_its_fields(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("1,2024-01-01\n2,bad\n")
    read = sources.read_with_rejects(
        spark, str(tmp_path / "bad.csv"), "id int, d date", header=False
    )
    good, bad = sources.split_malformed(read)
    assert values(good.select("id")) == [1]
    assert bad.agg(F.count("*")).first()[0] == 1


def test_sequence_excludes_its_end(spark):
    assert values(sources.sequence(spark, 1, 101)) == list(range(1, 101))
