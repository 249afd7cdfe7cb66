import csv
import io
import random

import pytest

from weekmart.sources import readers as r
from weekmart.sources import records
from weekmart.sources.schemas import text


def plain(content, encoding="utf-8"):
    """Rows by Python's own reader, line breaks in fields as line feeds, empty unquoted fields as nulls."""
    parsed = list(csv.reader(io.StringIO(content.decode(encoding).removeprefix("﻿"), newline="")))
    body = [row for row in parsed if row]
    return body[0], [tuple(c.replace("\r\n", "\n") or None for c in row) for row in body[1:]]


def same(got, expected):
    return sorted((tuple(c or None for c in g) for g in got), key=str) == sorted(expected, key=str)


@pytest.fixture()
def small_splits(spark):
    settings = {"spark.sql.files.maxPartitionBytes": "200", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k in settings:
        spark.conf.unset(k)


def write(folder, name, rows, encoding="utf-8", end="\r\n"):
    out = io.StringIO(newline="")
    csv.writer(out, lineterminator=end).writerows(rows)
    content = out.getvalue().encode(encoding)
    (folder / name).write_bytes(content)
    return content


def test_quoted_line_breaks_in_files_larger_than_a_split(spark, tmp_path, small_splits):
    rng = random.Random(4)
    signs = ["a", "bc", ",", '"', "\n", "\n\n", "\r\n", " ", "é", '""', '",', "\n\"", "x" * 30]
    rows = [["name", "two words", "n"]] + [["".join(rng.choices(signs, k=rng.randint(1, 8))).replace("\r", "") + "z", f"k{k}", str(k)] for k in range(400)]
    content = write(tmp_path, "a.csv", rows)
    assert len(content) > 20 * 200
    got = r.read_by_header(spark, str(tmp_path)).drop(r.FILE)
    assert got.columns == ["name", "two words", "n"]
    assert records.numbered_lines(spark, str(tmp_path)).select("_block").distinct().count() > 20
    assert same([tuple(x) for x in got.collect()], plain(content)[1])


def test_a_record_may_span_whole_blocks(spark, tmp_path, small_splits):
    rows = [["a", "b"], ["1", "line of words, and more\n" * 60 + "end"], ["2", "x"], ["3", 'y\n"z"\n' * 50]]
    content = write(tmp_path, "a.csv", rows, end="\n")
    assert same([tuple(x) for x in r.read_by_header(spark, str(tmp_path)).drop(r.FILE).collect()], plain(content)[1])


def test_headers_with_line_breaks_and_other_orders(spark, tmp_path):
    write(tmp_path, "a.csv", [["net\nlbs", "sku"], ["1", "a\nb"]])
    write(tmp_path, "b.csv", [["sku", "net\nlbs"], ["c", "2"]])
    got = r.read_by_header(spark, str(tmp_path), ["sku", "net\nlbs"])
    assert sorted((x[0], x[1]) for x in got.collect()) == [("a\nb", "1"), ("c", "2")]


def test_quotes_inside_unquoted_fields_are_signs(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'sku,label,n\n1,FRY 3/8" CC,5\n2,WEDGE 12",6\n3,"two\nlines, 4"" cut",7\n4,1/2" x 1/4",8\n')
    got = sorted(tuple(x) for x in r.read_by_header(spark, str(tmp_path)).drop(r.FILE).collect())
    assert got == [("1", 'FRY 3/8" CC', "5"), ("2", 'WEDGE 12"', "6"), ("3", 'two\nlines, 4" cut', "7"), ("4", '1/2" x 1/4"', "8")]


def test_each_file_has_its_own_encoding(spark, tmp_path):
    rows = [["label", "n"], ["Café – “größer” €", "1"], ["zwei\nZeilen ñ", "2"]]
    write(tmp_path, "a.csv", rows, "cp1252")
    write(tmp_path, "b.csv", rows, "utf-8")
    write(tmp_path, "c.csv", [["label", "n"], ["plain ™", "3"]], "cp1252")
    (tmp_path / "d.csv").write_bytes(b"\xef\xbb\xbf" + "label,n\nmit Marke €,4\n".encode())
    expected = [("Café – “größer” €", "1"), ("zwei\nZeilen ñ", "2")] * 2 + [("plain ™", "3"), ("mit Marke €", "4")]
    assert same([tuple(x) for x in r.read_by_header(spark, str(tmp_path)).drop(r.FILE).collect()], expected)
    named = r.read_by_header(spark, f"{tmp_path}/a.csv", encoding="cp1252").drop(r.FILE)
    assert same([tuple(x) for x in named.collect()], expected[:2])
    delimited = r.read_delimited(spark, f"{tmp_path}/c.csv", text("label", "n"), encoding="cp1252")
    assert [tuple(x) for x in delimited.collect()] == [("plain ™", "3")]


def test_an_unclosed_quote_names_its_file(spark, tmp_path):
    write(tmp_path, "good.csv", [["a", "b"], ["1", "x"]])
    (tmp_path / "bad.csv").write_bytes(b'a,b\n1,"never closed\n2,y\n')
    with pytest.raises(Exception, match="not closed in .*bad.csv"):
        r.read_by_header(spark, str(tmp_path)).collect()


def test_dated_headers_with_line_breaks(spark, tmp_path):
    schema = text("label", "sku", "lbs")
    (tmp_path / "a.csv").write_bytes('label,sku,2024-03-24 11\n"two\nlines, Café",7,5\nplain,8,6\n'.encode("cp1252"))
    (tmp_path / "b.csv").write_bytes(b"label,sku,2024-03-31 11\nother,9,7\n")
    got = sorted((x.label, x.sku, x.lbs, str(x.week_beginning_date)) for x in r.read_shared(spark, str(tmp_path), schema).collect())
    assert got == [("other", "9", "7", "2024-03-31"), ("plain", "8", "6", "2024-03-24"), ("two\nlines, Café", "7", "5", "2024-03-24")]
    (tmp_path / "c.csv").write_bytes(b'label,sku,"no\ndate"\n')
    with pytest.raises(Exception, match="no week date or other columns in the header of .*c.csv"):
        r.read_shared(spark, str(tmp_path), schema).collect()


def test_lines_meet_their_file_by_block(spark, tmp_path):
    write(tmp_path, "a.csv", [["a", "b"], ["1", "x"]])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = r.read_by_header(spark, str(tmp_path))
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert [tuple(x)[:2] for x in out.collect()] == [("1", "x")]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert f"SortMergeJoin [{records.FILE}" in plan and "_block" in plan.split("SortMergeJoin")[1][:80]


@pytest.fixture()
def kept(monkeypatch):
    """Plan and number of rows of what the scan stages, by label."""
    seen, write_out = {}, records.staged

    def counted(df, label):
        plan = df._jdf.queryExecution().executedPlan().toString()
        out = write_out(df, label)
        seen[label] = (plan, out.count())
        return out

    monkeypatch.setattr(records, "staged", counted)
    return seen


def test_lines_of_quoted_fields_are_joined_as_they_are_read(spark, tmp_path, kept):
    write(tmp_path, "a.csv", [["a", "b"], *[[f"{k}\n\n\nend", "x"] for k in range(300)]])
    out = r.read_by_header(spark, str(tmp_path))
    assert out.count() == 300
    assert kept["torn-records"][1] == 301  # the header among them, no line by itself
    assert max(rows for _, rows in kept.values()) == 301
    assert "Exchange" not in kept["torn-records"][0].replace("BroadcastExchange", "") and "Sort" not in kept["torn-records"][0]


def test_records_over_batches_and_many_files_a_task(spark, tmp_path):
    expected = []
    for n in range(6):
        rows = [["a", "b"], *[[f"{n}.{k}", "\n" * (k % 4) + "x"] for k in range(50)]]
        expected += plain(write(tmp_path, f"{n}.csv", rows, end="\n"))[1]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = [tuple(x) for x in r.read_by_header(spark, str(tmp_path)).drop(r.FILE).collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert same(got, expected)


def test_blocks_are_aggregated_by_hash(spark, tmp_path, kept):
    write(tmp_path, "a.csv", [["a", "b"], ["1", "x"]])
    assert r.read_by_header(spark, str(tmp_path)).count() == 1
    assert "HashAggregate" in kept["blocks"][0] and "SortAggregate" not in kept["blocks"][0]
