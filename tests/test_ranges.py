"""Files cut by many tasks, whose records span lines, against the standard library's readers."""

import csv
import json
import random
import xml.etree.ElementTree as ET
from xml.sax.saxutils import escape

import pytest

from tests.conftest import RUN_TS
from tidemark import pipeline
from tidemark.sources import read_csv, read_json, read_xml
from tidemark.streaming.arrivals import ingest_arrivals
from tidemark.warehouse import Warehouse


@pytest.fixture
def small_ranges(spark):
    """Byte ranges of a few records each."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def ranges(df):
    return df.select("_position.block").distinct().count()


def write(path, text):
    path.write_bytes(text.encode("utf-8"))
    return str(path)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_csv(spark, tmp_path, small_ranges, end):
    draw = random.Random(5)
    parts = ["a", "b", " ", '"', ",", "\n", "\r\n", "é", "x,y", '""', "z" * 30]
    rows = [[str(i), *["".join(draw.choice(parts) for _ in range(draw.randrange(6))) for _ in range(3)]] for i in range(1200)]
    with open(tmp_path / "a.csv", "w", newline="", encoding="utf-8") as file:
        out = csv.writer(file, lineterminator=end)
        out.writerow(["id", "p", "q\nq", "r"])
        out.writerows(rows)
    write(tmp_path / "b.csv", 'id,p,"q q",r\n' + "\n".join(f"b{i},5{'"' * (i % 2)} pipe,y," for i in range(9)))
    df = read_csv(spark, str(tmp_path / "a.csv"), keep_position=True)
    got = [tuple(r)[:4] for r in df.orderBy("_position").collect()]
    assert got == [(r[0], *[v or None for v in r[1:]]) for r in rows]
    assert ranges(df) > 10
    both = read_csv(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")])
    assert both.count() == 1209  # a quote within a field opens nothing
    assert both.where("id = 'b1'").first()["p"] == '5" pipe'


def test_csv_that_is_cut_off(spark, tmp_path):
    with pytest.raises(ValueError, match="ends inside a record"):
        read_csv(spark, write(tmp_path / "a.csv", 'a,b\n1,"two\nlines"\n3,"open\n')).collect()


@pytest.mark.parametrize("layout", [{}, {"indent": 2}, {"indent": 1, "ensure_ascii": False}])
def test_json_list(spark, tmp_path, small_ranges, layout):
    draw = random.Random(6)

    def text():
        return "".join(draw.choice(["a", "{", "}", "[", "]", '"', "\\", "\n", ", ", "é", '\\"', "}}"]) for _ in range(draw.randrange(8)))

    rows = [dict(id=i, p=text(), n=dict(x=text(), y=dict(z=i % 9)), l=[dict(k=text()) for _ in range(i % 3)], e={}) for i in range(500)]
    path = write(tmp_path / "a.json", "﻿" * ("indent" in layout) + json.dumps(rows, **layout) + "\n" * (len(layout) // 2))
    df = read_json(spark, path, keep_position=True)
    assert ranges(df) > 10
    got = [(r["id"], r["p"], r["n.x"], r["n.y.z"]) for r in df.orderBy("_position").collect()]
    assert got == [(str(r["id"]), r["p"], r["n"]["x"], str(r["n"]["y"]["z"])) for r in rows]
    assert {json.dumps(json.loads(r.l)) for r in df.where("id = 5").collect()} == {json.dumps([{"k": x["k"]} for x in rows[5]["l"]])}


def test_json_objects_and_bad_ones(spark, tmp_path):
    assert read_json(spark, write(tmp_path / "o.json", '\n{"a": 1, "b": {"c": "}"}}\n')).collect() == [("1", "}")]
    path = write(tmp_path / "b.json", '[{"a": 1}, {"a" 2}, {"a": "x}"} , 7, {"a": null}]')
    got = read_json(spark, path, columns=["a"], keep_bad=True, keep_position=True).orderBy("_position").collect()
    assert [(r.a, r._bad_record) for r in got] == [("1", None), (None, '{"a" 2}'), ("x}", None), (None, '7, {"a": null}')]
    with pytest.raises(Exception, match="no JSON object"):
        read_json(spark, path, columns=["a"]).collect()
    for cut in ("{not json", '[{"a":1},{"a":2}', '[{"a":1},{"a":2}\n', '[{"a":1}, {"a":"x'):
        with pytest.raises(ValueError, match="ends inside a record"):
            read_json(spark, write(tmp_path / "cut.json", cut), columns=["a"])
    assert read_json(spark, write(tmp_path / "e.json", "[ ]"), columns=["a"]).count() == 0
    lines = write(tmp_path / "l.json", '{"a": 1}\n\n{"a" 2}\n')
    got = read_json(spark, lines, columns=["a"], lines=True, keep_bad=True)
    assert sorted(map(repr, map(tuple, got.collect()))) == ["('1', None)", "(None, '{\"a\" 2}')"]


def test_xml(spark, tmp_path, small_ranges):
    draw = random.Random(7)

    def text():
        plain = escape("".join(draw.choice(["a", "<", "&", ">", '"', " x", "é", "--", "\n"]) for _ in range(draw.randrange(1, 6))))
        return plain if draw.random() < 0.8 else "<![CDATA[<part> a > b </part>]]>"

    out = ["<?xml version='1.0'?>\n<!-- <part>\n <x> > -->\n<parts>"]
    for i in range(500):
        kind = draw.random()
        if kind < 0.1:
            out.append(f"<group><part><id>{i}n</id></part><note>{text()}</note></group>")
        elif kind < 0.2:
            out.append(f"<!-- <part><id>{i}</id></part> -->")
        else:
            out.append(f"<part a='1'><id>{i}</id><v>{text()}</v><part>inner</part>{'<e/>' if i % 2 else '<e></e>'}</part>")
    whole = "\n".join([*out, "</parts>"])
    root = ET.fromstring(whole.encode())
    path = write(tmp_path / "a.xml", whole)
    df = read_xml(spark, path, record_tag="part", columns=["id", "v", "part", "e"], keep_position=True)
    assert [(r.id, r.v, r.part, r.e) for r in df.orderBy("_position").collect()] == [
        (c.find("id").text, c.find("v").text, "inner", None) for c in root if c.tag == "part"
    ]
    assert ranges(df) > 8
    every = read_xml(spark, path)
    assert every.count() == len(list(root)) and set(every.columns) == {"id", "v", "part", "e", "note"}


def test_bad_xml(spark, tmp_path):
    path = write(tmp_path / "b.xml", "<r><p><a>1</a></p><p><a>2</b></p></r>")
    got = read_xml(spark, path, "p", columns=["a"], keep_bad=True)
    assert sorted(map(repr, map(tuple, got.collect()))) == ["('1', None)", "(None, '<p><a>2</b></p>')"]
    with pytest.raises(ValueError, match="ends inside a record"):
        read_xml(spark, write(tmp_path / "c.xml", "<r><p><a>1</a></p>"), "p", columns=["a"])


def test_bad_records_of_arriving_files_are_rejected(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    source = next(s for s in pipeline.SOURCES if s.table == "payments")
    folder = tmp_path / "in"
    folder.mkdir()

    def arrive():
        ingest_arrivals(warehouse, source, str(folder), str(tmp_path / "cp"), RUN_TS, "ARRIVALS", batch_files=2).awaitTermination()
        return sorted(r.order_id for r in warehouse.read("bronze.payments").collect())

    for i in range(3):
        write(folder / f"{i} a.json", f'[{{"order_id": "o{i}", "payment_value": 1}}, {{"order_id" "bad{i}"}}]')
    assert arrive() == ["o0", "o1", "o2"]
    assert arrive() == ["o0", "o1", "o2"]
    rejected = warehouse.read("bronze.rejected_records").collect()
    assert sorted(json.loads(r.raw_data)["_bad_record"] for r in rejected) == ['{"order_id" "bad0"}', '{"order_id" "bad1"}', '{"order_id" "bad2"}']
    assert {r.reject_reason for r in rejected} == {"Unparseable record; NULL in order_id; "}
    assert warehouse.read("metadata.dq_results").where("check_name = 'parse_check' AND failed_records > 0").count() == 2
