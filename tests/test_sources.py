import json

import pytest

from tidemark.sources import newer_than, read_csv, read_json, read_query, read_table, read_xml
from tidemark.sources.delimited import has_quoted_newlines


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def test_csv_nulls_quotes_and_types(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'id,name,zip\n1,NA,007\n2,"a ""b"", c",\n3,"two\nlines",null\n4,n/a, x \n5,None,<NA>\n')
    df = read_csv(spark, path)
    assert [f.dataType.simpleString() for f in df.schema] == ["string"] * 3
    assert rows(df) == [
        ("1", None, "007"), ("2", 'a "b", c', None), ("3", "two\nlines", None), ("4", None, " x "), ("5", None, None),
    ]
    assert has_quoted_newlines(spark, path)


def test_csv_without_line_breaks_is_split(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'id,name\n1,"x ""y"""\n2,z\n')
    assert not has_quoted_newlines(spark, path)
    assert rows(read_csv(spark, path)) == [("1", 'x "y"'), ("2", "z")]


def test_csv_position_is_the_order_of_the_file(spark, tmp_path):
    path = write(tmp_path / "big.csv", "id,pad\n" + "".join(f"{i},{'x' * 60}\n" for i in range(20000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 200_000)
    try:
        df = read_csv(spark, path, keep_position=True)
        assert df.rdd.getNumPartitions() > 1
        got = [int(r.id) for r in df.orderBy("_position").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == list(range(20000))


def test_csv_watermark_and_missing_file(spark, tmp_path):
    path = write(tmp_path / "a.csv", "id,at\n1,2024-01-01 00:00:00\n2,2024-01-03 00:00:00\n3,bad\n4,\n")
    assert rows(read_csv(spark, path, watermark_col="at", watermark_value="2024-01-02 00:00:00")) == [("2", "2024-01-03 00:00:00")]
    assert rows(read_csv(spark, path, dtypes={"id": "int"}).select("id")) == [(1,), (2,), (3,), (4,)]
    assert read_csv(spark, path, watermark_col="other", watermark_value="2024-01-02").count() == 4
    for read in (read_csv, read_json, read_xml):
        with pytest.raises(FileNotFoundError):
            read(spark, str(tmp_path / "absent"))


def test_json_list_nested_and_nulls(spark, tmp_path):
    data = [
        {"id": 1, "v": 1.5, "who": {"name": "a", "at": {"city": "X"}}, "tags": [1, 2]},
        {"id": 2, "v": None, "who": {"name": None}, "tags": []},
        {"id": 3, "v": "nan", "who": None},
    ]
    path = write(tmp_path / "a.json", json.dumps(data, indent=2))
    df = read_json(spark, path)
    assert df.columns == ["id", "tags", "v", "who.at.city", "who.name"]
    assert rows(df) == [
        ("1", '["1","2"]', "1.5", "X", "a"), ("2", "[]", None, None, None), ("3", None, None, None, None),
    ]
    assert "who" in read_json(spark, path, normalize=False).columns
    assert rows(read_json(spark, path, columns=["id", "missing"])) == [("1", None), ("2", None), ("3", None)]


def test_json_object_and_record_path(spark, tmp_path):
    path = write(tmp_path / "o.json", json.dumps({"a": {"b": 1}, "c": "None"}))
    assert rows(read_json(spark, path)) == [("1", None)]
    path = write(tmp_path / "r.json", json.dumps({"n": 2, "items": [{"id": 1, "x": {"y": 2}}, {"id": 2}]}, indent=1))
    df = read_json(spark, path, record_path="items", keep_position=True)
    assert df.columns == ["id", "x.y", "_position"]
    assert [tuple(r)[:2] for r in df.orderBy("_position").collect()] == [("1", "2"), ("2", None)]
    path = write(tmp_path / "l.json", json.dumps([{"items": [{"id": 1}]}, {"items": [{"id": 2}, {"id": 3}]}]))
    assert rows(read_json(spark, path, record_path="items")) == [("1",), ("2",), ("3",)]
    assert rows(read_json(spark, path, record_path="items", normalize=True).limit(0)) == []
    path = write(tmp_path / "lines.json", '{"a":1}\n{"a":2}\n')
    assert rows(read_json(spark, path, lines=True)) == [("1",), ("2",)]


XML = """<?xml version="1.0"?>
<products>
  <!-- a comment -->
  <product><id>1</id><w>2.5</w></product>
  <product><id>2</id><w/></product>
  <product></product>
  <product><id> 3 </id></product>
  <extra><id>4</id></extra>
</products>
"""


def test_xml(spark, tmp_path):
    path = write(tmp_path / "a.xml", XML)
    df = read_xml(spark, path, record_tag="product", columns=["id", "w"])
    assert rows(df) == [(" 3 ", None), ("1", "2.5"), ("2", None)]
    assert sorted(r.id.strip() for r in read_xml(spark, path, record_tag="product").collect()) == ["1", "2", "3"]
    every = read_xml(spark, path, keep_position=True)
    assert sorted(r.id.strip() for r in every.collect()) == ["1", "2", "3", "4"]


def test_table_source(spark):
    df = spark.createDataFrame([(3, "a"), (1, "b"), (2, "a")], "id int, k string")
    assert rows(read_table(df, columns=["id"], where="k = 'a'")) == [(2,), (3,)]
    assert [r.id for r in read_table(df, limit=2).collect()] == [1, 2]
    assert rows(read_table(df, watermark_col="id", watermark_value="1", where="k = 'a'", limit=5)) == [(2, "a"), (3, "a")]
    df.createOrReplaceTempView("things")
    assert rows(read_query(spark, "SELECT id FROM things WHERE k = :k", {"k": "b"})) == [(1,)]
    assert newer_than(spark.createDataFrame([("x",), (None,)], "t string"), "t", "2024-01-01").count() == 0


def test_xml_root_is_found_past_comments(spark, tmp_path):
    path = write(tmp_path / "c.xml", "<?xml version='1.0'?>\n<!-- <old>\n<older> -->\n<rows>\n<r><a>1</a></r>\n<s><a>2</a></s>\n</rows>\n")
    assert sorted(rows(read_xml(spark, path))) == [("1",), ("2",)]


def test_csv_files_are_split_or_read_whole_one_by_one(spark, tmp_path):
    write(tmp_path / "a.csv", 'id,v\n1,"two\nlines"\n')
    write(tmp_path / "b.csv", "id,v\n2,plain\n")
    assert sorted(rows(read_csv(spark, str(tmp_path)))) == [("1", "two\nlines"), ("2", "plain")]
    assert read_csv(spark, str(tmp_path), keep_position=True).select("_position.file").distinct().count() == 2
