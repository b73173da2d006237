import csv as csv_module
import random

import pytest
from pyspark.sql import functions as F

from souk.plans.warehouse import Warehouse
from souk.sources import csv_files, csv_ingest
from souk.sources.csv_ingest import CsvTables, _lines, field_count, ingest, read_records
from souk.sources.raw_tables import RAW_TABLES, RawTable
from souk.sources.store import TableStore

RECORDS = (
    "id,a,b\n"
    '1,x,"he said ""hi"", ok"\n'
    '2,y,"multi\nline"\n'
    "3,z\n"
    "4,p,q,EXTRA\n"
    '5,,""\n'
    "6,NA,w\n"
    '7,"p,1","q\nr",E1,"E,2"\n'
)


@pytest.fixture
def csv(tmp_path):
    def write(name, text):
        path = tmp_path / name
        path.write_text(text, encoding="utf-8")
        return str(path)

    return write


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_tolerant_load(spark, csv, store):
    loaded = ingest(spark, csv("t.csv", RECORDS), RawTable("t", ("id",)), store)
    assert rows(loaded.clean) == [
        ("1", "x", 'he said "hi", ok'),
        ("2", "y", "multi\nline"),
        ("3", "z", None),
        ("5", None, None),
        ("6", None, "w"),
    ]
    assert rows(loaded.quarantine) == [
        ("t", "4,p,q,EXTRA"),
        ("t", '7,"p,1","q\nr",E1,"E,2"'),
    ]
    assert rows(loaded.stats) == [("t", 5, 2, 28.6)]


def test_strict_load(spark, csv, store):
    loaded = ingest(spark, csv("t.csv", RECORDS), RawTable("t", ("id",), strict=True), store)
    assert rows(loaded.clean) == [
        ("1", "x", 'he said "hi", ok'),
        ("2", "y", "multi\nline"),
        ("5", "", ""),
        ("6", "NA", "w"),
    ]
    assert rows(loaded.stats) == [("t", 4, 3, 42.9)]


def test_load_replaces(spark, csv, store):
    table = RawTable("t", ("id",))
    ingest(spark, csv("one.csv", "id,a\n1,x\n2,y\n"), table, store)
    loaded = ingest(spark, csv("two.csv", "id,a\n3,z\n"), table, store)
    assert rows(loaded.clean) == [("3", "z")]


def test_quotes_inside_plain_fields_are_text(spark, csv, store):
    path = csv("q.csv", 'a,b\n5" pipe,x,3" y\n6" rod,y\n"7""",z\n')
    loaded = ingest(spark, path, RawTable("q", ("a",)), store)
    assert rows(loaded.clean) == [('6" rod', "y"), ('7"', "z")]
    assert rows(loaded.quarantine) == [("q", '5" pipe,x,3" y')]


def test_field_count(spark):
    texts = {"": 1, ",": 2, '"a,b",c': 2, 'a"b,c"d': 2, '"a""",",",': 3, 'x,"open,y': 2, '"p"q,r': 2}
    df = spark.createDataFrame([(t, n) for t, n in texts.items()], "t string, n int")
    assert df.where(field_count(F.col("t")) != F.col("n")).count() == 0


@pytest.mark.parametrize("split", [40, 333, 1 << 20])
def test_records_are_whole_wherever_files_are_split(spark, tmp_path, store, split):
    pick = random.Random(split)
    pieces = ["a", "long text", "6\" x", "two\nlines", 'said "so", he', "\n\n\n", "", "é,ü", '"']
    folder = tmp_path / "split.csv"
    folder.mkdir()
    expected = []
    for part in range(2):
        records = [[f"{part}-{i}", *pick.choices(pieces, k=2)] for i in range(200)]
        expected += [tuple(r) for r in records]
        with open(folder / f"part{part}.csv", "w", encoding="utf-8", newline="") as out:
            writer = csv_module.writer(out, lineterminator="\n")
            writer.writerows([["id", "a", "b"], *records])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        loaded = ingest(spark, str(folder), RawTable("split", ("id",), strict=True), store)
        blocks = _lines(spark, str(folder)).select("_file", "_block").distinct().count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert rows(loaded.clean) == sorted(expected)
    assert loaded.quarantine.count() == 0
    assert blocks > 20 if split == 333 else blocks >= 2


@pytest.mark.parametrize("limit", [300, 1 << 20])
def test_an_open_quote_is_one_record_in_bounded_pieces(spark, tmp_path, store, monkeypatch, limit):
    monkeypatch.setattr(csv_ingest, "RECORD_BYTES", limit)
    folder = tmp_path / "open.csv"
    folder.mkdir()
    good = [f'{i},"two\nlines {i}"' for i in range(50)]
    rest = [f"{i},plain text {i}" for i in range(50, 500)]
    text = "\n".join(["id,a", *good, '50,"never closed', *rest])
    (folder / "one.csv").write_text(text + "\n", encoding="utf-8")
    (folder / "two.csv").write_text("id,a\n900,x\n", encoding="utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        loaded = ingest(spark, str(folder), RawTable("open", ("id",)), store)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    if limit == 300:
        assert rows(loaded.clean) == sorted([(str(i), f"two\nlines {i}") for i in range(50)] + [("900", "x")])
        assert rows(loaded.stats) == [("open", 51, 1, 1.9)]
        pieces = [r.record for r in loaded.quarantine.collect()]
        assert len(pieces) > 20 and max(map(len, pieces)) < limit + 40
        lines = [line for piece in pieces for line in piece.split("\n")]
        assert sorted(lines) == sorted(['50,"never closed', *rest])
    else:
        # Short enough for one record, as any that a quote is missing of
        assert loaded.clean.count() == 52 and loaded.quarantine.count() == 0


def test_byte_order_mark_is_not_part_of_the_first_name(spark, csv, store):
    path = csv("b.csv", "\ufeffid,a\r\n1,x\r\n")
    records = read_records(spark, path, store, "bom")
    assert records.columns[0] == "id"
    assert rows(records) == [("1", "x", None)]


def test_empty_file_has_no_percentage(spark, csv, store):
    loaded = ingest(spark, csv("t.csv", "id,a\n"), RawTable("t", ("id",)), store)
    assert rows(loaded.stats) == [("t", 0, 0, None)]


def test_models_run_on_loaded_files(spark, warehouse, tmp_path):
    files = TableStore(spark, str(tmp_path / "files"))
    folder = csv_files.write_all(warehouse.raw, files)
    store = TableStore(spark, str(tmp_path / "loaded"))
    tables = CsvTables(spark, folder, store)
    assert set(tables) == set(RAW_TABLES)
    loaded = Warehouse(spark, tables, store)
    direct, from_files = warehouse["order_status_mix"], loaded["order_status_mix"]
    assert rows(direct) == rows(from_files)
    summary, expected = loaded["executive_summary"].first(), warehouse["executive_summary"].first()
    assert summary["delivered_orders"] == expected["delivered_orders"]
    # a fiftieth of the item records was too long
    assert 0.95 < summary["product_revenue"] / expected["product_revenue"] < 1


def test_lines_without_quotes_are_not_shuffled(spark, csv, store):
    """Only a row per chunk is; the text of plain lines goes from the scan to the table."""
    path = csv("p.csv", "id,a\n" + "".join(f"{i},x{i}\n" for i in range(500)))
    plan = csv_ingest.record_texts(spark, path, store, "p")._jdf.queryExecution().executedPlan()
    plain = plan.toString().split("Union")[1].split("p_pieces")[0]
    assert "p_lines" in plain and "hashpartitioning" not in plain
    assert csv_ingest.record_texts(spark, path, store, "p").count() == 500


@pytest.mark.parametrize("bits", [0, 2, 5])
def test_chunks_of_any_size_give_the_same_records(spark, csv, store, monkeypatch, bits):
    monkeypatch.setattr(csv_ingest, "CHUNK_BITS", bits)
    expected = [(str(i), f"a\n\n{i}" if i % 3 == 0 else "plain") for i in range(1, 120)]
    text = "".join(f'{i},"{a}"\n' if "\n" in a else f"{i},{a}\n" for i, a in expected)
    loaded = ingest(spark, csv("c.csv", "id,a\n" + text), RawTable("c", ("id",)), store)
    assert rows(loaded.clean) == sorted(expected)
    assert loaded.quarantine.isEmpty()


def test_a_long_line_is_loaded_beside_quoted_ones(spark, csv, store, monkeypatch):
    monkeypatch.setattr(csv_ingest, "RECORD_BYTES", 50)
    long = "y" * 300
    loaded = ingest(spark, csv("l.csv", f'id,a\n1,"p\nq"\n2,{long}\n'), RawTable("l", ("id",)), store)
    assert rows(loaded.clean) == [("1", "p\nq"), ("2", long)]
