"""Quoted line breaks and arrays in files that are cut into many splits."""

import csv
import io
import json
import os
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clickloom.sources import readers, records
from clickloom.sources.records import Csv, JsonArray, RecordFiles, list_files, read_heads


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "1"}
    old = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in old.items():
        spark.conf.set(n, v)


def catalog_rows(n, seed, breaks=0.2):
    draw = random.Random(seed)
    bits = ['"', '""', ",", "a", "é", " ", '","', "x" * 30, '"a"', "'"]
    rows = []
    for i in range(n):
        name = "".join(draw.choices(bits, k=draw.randrange(0, 6))) or "n"
        if draw.random() < breaks:
            name += "\n" + draw.choice(["tail", '"', ',"', "\n\n", "\r\nend", "long line " * 80])
        rows.append([str(i), name, draw.choice(["A", "B, C"]), "3.5", "1", "4.5", "7"])
    return rows


HEADER = ["product_id", "product_name", "category", "price", "stock_quantity", "rating", "num_reviews"]


def write_csv(path, rows, end="\n"):
    with open(path, "w", newline="", encoding="utf-8") as f:
        writer = csv.writer(f, lineterminator=end)
        writer.writerow(HEADER)
        writer.writerows(rows)


@pytest.mark.parametrize("seed, end", [(1, "\n"), (2, "\n"), (3, "\r\n")])
def test_quoted_breaks_survive_in_many_splits(spark, tmp_path, small_splits, seed, end):
    folder = tmp_path / "catalog.csv"
    folder.mkdir()
    broken, plain = catalog_rows(300, seed), catalog_rows(200, seed + 10, breaks=0)
    write_csv(folder / "a.csv", broken, end)
    write_csv(folder / "b.csv", [[str(1000 + i), *r[1:]] for i, r in enumerate(plain)], end)
    got = {r.product_id: (r.product_name, r.category, r.price) for r in readers.read_product_catalog(spark, str(folder)).collect()}
    expected = {int(r[0]): (r[1], r[2], 3.5) for r in broken} | {1000 + i: (r[1], r[2], 3.5) for i, r in enumerate(plain)}
    strip = lambda rows: {int(k): v for k, v in rows.items()}
    assert strip(got) == expected
    files = list_files(spark, str(folder))
    held = RecordFiles(spark, files, Csv())
    begins, cut = held.splits(held.summaries())
    assert len(begins) > 40 and any(s.inside for s in begins.values())  # splits do begin inside quotes
    assert cut == {f.number for f in files if f.path.endswith("a.csv")}


def test_the_probe_of_a_break_in_quotes(spark, tmp_path):
    path = tmp_path / "catalog.csv"
    path.write_text('product_id,product_name,category,price\n1,"two\nlines",a,3.5\n\n2,plain,b,1\n')
    rows = readers.read_product_catalog(spark, str(path)).orderBy("product_id").collect()
    assert [(int(r.product_id), r.product_name, r.category, r.price) for r in rows] == [(1, "two\nlines", "a", 3.5), (2, "plain", "b", 1.0)]
    lines = readers.read_product_catalog(spark, str(path), quoted_breaks=False)
    assert lines.count() == 3


def test_quotes_inside_plain_values_open_nothing(spark, tmp_path):
    path = tmp_path / "catalog.csv"
    path.write_text('product_id,product_name,category,price\n1,5" pipe,a,3.5\n2,"6"" pipe",b,1\n3,"a\nb",7" x,2\n')
    rows = readers.read_product_catalog(spark, str(path)).orderBy("product_id").collect()
    assert [r.product_name for r in rows] == ['5" pipe', '6" pipe', "a\nb"] and rows[2].category == '7" x'


def ends_inside(text, state):
    """Whether a line ends inside quotes, character by character."""
    i, field_start = 0, not state
    while i < len(text):
        if state and text[i] == '"':
            if text[i + 1 : i + 2] == '"':
                i += 1
            else:
                state = False
        elif not state and text[i] == '"' and field_start:
            state = True
        field_start = not state and text[i] == ","
        i += 1
    return state


def test_functions_of_lines_equal_a_plain_reading():
    draw = random.Random(5)
    lines = ["", "a,b", 'a,"b', '"a""b,c', '"a""",b', 'a"b', '"', '""', '"",', 'b",c', 'b","c', 'x","c', '""b",c', 'a"",b', '"a" b,"c']
    lines += ["".join(draw.choices('",ab', weights=[4, 2, 2, 1], k=draw.randrange(0, 10))) for _ in range(6000)]
    outside, inside, _, _ = Csv().functions(pa.array(lines))
    for line, a, b in zip(lines, outside, inside):
        assert (a, b) == (ends_inside(line, False), ends_inside(line, True)), line


def nested(draw, i):
    record = {"event_id": f"e{i}", "session_id": draw.choice(['s"}', "s\\", "{[", "]},{", "s"]), "user_id": "u" * draw.randrange(1, 200)}
    if draw.random() < 0.3:
        record["extra"] = {"a": [{"b": "}"}, [1, 2], {}], "c": {}}
    if draw.random() < 0.2:
        record["search_query"] = "line\nbreak \"quoted\" } \\"
    return record


@pytest.mark.parametrize("indent", [None, 2])
def test_arrays_are_read_by_many_tasks(spark, tmp_path, small_splits, indent):
    draw = random.Random(indent)
    folder = tmp_path / "clicks.json"
    folder.mkdir()
    rows = [nested(draw, i) for i in range(400)]
    (folder / "a.json").write_text("\n " + json.dumps(rows[:350], indent=indent, ensure_ascii=False) + "\n")
    (folder / "b.json").write_text(json.dumps(rows[350:], indent=indent))
    (folder / "c.json").write_text("[]")
    (folder / "d.json").write_text("\n".join(json.dumps({"event_id": f"l{i}"}) for i in range(5)))
    df = readers.read_events(spark, str(folder))
    got = {r.event_id: (r.session_id, r.user_id, r.search_query) for r in df.collect()}
    expected = {r["event_id"]: (r["session_id"], r["user_id"], r.get("search_query")) for r in rows}
    assert got == expected | {f"l{i}": (None, None, None) for i in range(5)} and df.count() == 405
    arrays = RecordFiles(spark, [f for f in list_files(spark, str(folder)) if not f.path.endswith("d.json")], JsonArray())
    assert len(arrays.summaries()) > 30 and arrays.pieces.rdd.getNumPartitions() > 30


def test_heads_do_not_grow_with_their_files(spark, tmp_path, monkeypatch):
    path = tmp_path / "wide.csv"
    path.write_text("\n\n" + ",".join(HEADER) + "\n" + "1,a,b,2,3,4,5\n" * 200_000)
    asked = []

    def found(text, whole):
        asked.append(len(text))
        return records.first_csv_record(text, whole)

    files = list_files(spark, str(path))
    assert read_heads(spark, files, found) == [",".join(HEADER)]
    assert os.path.getsize(path) > 2_000_000 and sum(asked) <= records.HEAD_BYTES
    # a header longer than the first read is read on, and quotes in it may hold a break
    monkeypatch.setattr(records, "HEAD_BYTES", 16)
    (tmp_path / "long.csv").write_text('"first\nname",' + ",".join(f"c{i}" for i in range(500)) + "\r\nx\n")
    head = read_heads(spark, list_files(spark, str(tmp_path / "long.csv")), records.first_csv_record)[0]
    assert next(csv.reader(io.StringIO(head, newline="")))[:2] == ["first\nname", "c0"] and not head.endswith("\r")


def test_changed_files_are_noticed(spark, tmp_path):
    path = tmp_path / "a.csv"
    write_csv(path, catalog_rows(20, 1))
    held = RecordFiles(spark, list_files(spark, str(path)), Csv())
    with pytest.raises(Exception, match="changed between two passes"):
        held.records({}).collect()


def test_compressed_files(spark, tmp_path):
    import gzip

    rows = catalog_rows(60, 4)
    write_csv(tmp_path / "x.csv", rows)
    folder = tmp_path / "zipped.csv"
    folder.mkdir()
    (folder / "x.csv.gz").write_bytes(gzip.compress((tmp_path / "x.csv").read_bytes()))
    got = {int(r.product_id): r.product_name for r in readers.read_product_catalog(spark, str(folder)).collect()}
    assert got == {int(r[0]): r[1] for r in rows}
    assert readers.read_product_catalog(spark, str(folder)).filter(F.col("price").isNull()).count() == 0
