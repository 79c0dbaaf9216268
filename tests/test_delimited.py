"""Delimited text in splits: quoted line ends, mixed headers, reads by name."""

import csv
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from millrace.sources import delimited, files
from millrace.sources.files import read_csv_typed, read_from_events, read_objects

SPLIT = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def small_splits(spark):
    """Splits of some 200 bytes, so that values and records reach over them."""
    options = {SPLIT: "200", "spark.sql.files.openCostInBytes": "1"}
    before = {name: spark.conf.get(name) for name in options}
    for name, value in options.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def values(rng, n):
    pieces = ["x", 'a "q" b', "one,two", "line\nend", "\n\n", 'mixed "\n", x', '""', "", "carriage\r\nreturn", "é日", ",", '"', "\n"]
    for i in range(n):
        yield [str(i), rng.choice(pieces) + rng.choice(["", "tail"]), rng.choice(pieces * 2 + ["w" * 900, "v\n" * 300]), str(i * 0.5)]


def written(rows, line_end="\n", quoting=csv.QUOTE_MINIMAL):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=line_end, quoting=quoting)
    writer.writerow(["n", "first", "second", "half"])
    writer.writerows(rows)
    return out.getvalue()


@pytest.mark.parametrize("seed,line_end", [(1, "\n"), (2, "\r\n"), (3, "\n")])
def test_records_over_splits(spark, tmp_path, small_splits, seed, line_end):
    rng = random.Random(seed)
    expected = {}
    for k in range(3):
        rows = list(values(rng, 60))
        (tmp_path / f"{k}.csv").write_bytes(written(rows, line_end, rng.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL])).encode())
        expected[k] = rows
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
    lines = delimited.text_lines(spark, [str(tmp_path)])
    found = delimited.records(lines, delimited.split_states(lines, ","), ",")
    got = {}
    for row in found.select("file", "is_first", delimited.tokens(F.col("record"), ",").alias("values")).collect():
        if row["is_first"]:
            assert row["values"] == ["n", "first", "second", "half"]
        else:
            got.setdefault(int(row["file"][-5]), []).append([v or "" for v in row["values"]])
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in expected.items()}


def test_typed_reading_equals_one_task(spark, tmp_path, small_splits):
    rng = random.Random(9)
    for k in range(3):
        (tmp_path / f"{k}.csv").write_bytes(written(list(values(rng, 50))).encode())
    (tmp_path / "plain.csv").write_text("n,first,second,half\n" + "".join(f"{i},a,b,1.5\n" for i in range(40)) + "bad,a,b,2\n")
    schema = files.infer_csv_schema(spark, str(tmp_path / "0.csv"))
    whole = spark.read.options(**files.CSV_OPTIONS).option("multiLine", True).option("header", True).schema(schema).csv(str(tmp_path))
    mine = read_csv_typed(spark, str(tmp_path), schema=schema)
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(map(key, mine.drop("_error").collect())) == sorted(map(key, whole.collect()))
    assert [r["_error"] for r in mine.where("_error is not null").collect()] == ["SchemaMismatch"]


def test_state_of_a_line(spark):
    lines = ["a,b", '"a', 'a"', '"a","b', '""', '"a""', 'x"y,"z', 'x"y"', '"a"b"c,"d', '",', '","', '"""', '""""', ',"', '"a,b"', 'q,"r""']

    def walk(line, inside):
        state, fresh = ("in" if inside else "out"), True
        i = 0
        while i < len(line):
            c = line[i]
            if state == "in" and c == '"':
                if line[i + 1 : i + 2] == '"':
                    i += 1
                else:
                    state, fresh = "out", False
            elif state == "out":
                if c == ",":
                    fresh = True
                else:
                    state = "in" if c == '"' and fresh else "out"
                    fresh = False
            i += 1
        return state == "in"

    df = spark.createDataFrame([(l,) for l in lines], "line string")
    for inside in (False, True):
        got = {r["line"]: r["s"] for r in df.select("line", delimited.ends_inside(F.col("line"), ",", inside).alias("s")).collect()}
        assert got == {l: walk(l, inside) for l in lines}


def test_tokens(spark):
    cases = {'a,"b,c",,"",d ': ["a", "b,c", None, "", "d "], "": [None], ",": [None, None], '"a""b"': ['a"b'], '"x\ny",z': ["x\ny", "z"], '5" nail,2': ['5" nail', "2"], '"open,1': ['"open', "1"]}
    df = spark.createDataFrame([(c,) for c in cases], "record string")
    for delimiter in (",", "|", "\t", "^", "x"):
        swapped = df.select("record", F.translate("record", ",x", delimiter + "_").alias("own"))
        got = swapped.select("record", delimited.tokens(F.col("own"), delimiter).alias("t")).collect()
        for row in got:
            swap = str.maketrans(",x", delimiter + "_")
            assert row["t"] == [None if v is None else v.translate(swap) for v in cases[row["record"]]]
    long = spark.createDataFrame([("a," + '"' + 'v""' * 200_000 + '",z',)], "record string")
    assert long.select(F.size(delimited.tokens(F.col("record"), ",")).alias("n")).first()["n"] == 3


def test_long_value_spans_many_splits(spark, tmp_path, small_splits):
    middle = "line of text\n" * 400
    (tmp_path / "a.csv").write_text(f'n,t\n1,"{middle}"\n2,b\n3,"open to the end\nof the file\n')
    got = {r["n"]: r["t"] for r in read_csv_typed(spark, str(tmp_path)).collect()}
    assert got[1] == middle and got[2] == "b" and got[3].startswith("open to the end\nof the file")


def test_other_headers_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text('n,t\n1,"x\ny"\n')
    (tmp_path / "b.csv").write_text('n,u\n1,"x\ny"\n')
    with pytest.raises(Exception, match="header"):
        read_csv_typed(spark, str(tmp_path)).collect()


def test_partition_columns_stay(spark, tmp_path):
    for k in (1, 2):
        (tmp_path / f"k={k}").mkdir()
        (tmp_path / f"k={k}" / "a.csv").write_text('n,t\n1,"x\ny"\n2,z\n' if k == 1 else "n,t\n3,w\n")
    rows = read_csv_typed(spark, str(tmp_path)).drop("_error").collect()
    assert sorted((r["n"], r["t"], r["k"]) for r in rows) == [(1, "x\ny", 1), (2, "z", 1), (3, "w", 2)]


# --- folders of mixed headers -------------------------------------------------


def objects(df):
    return sorted((r["path"].rpartition("/")[2], r["t"], r["_error"]) for r in df.select("path", F.to_json("data").alias("t"), "_error").collect())


def test_odd_headers_cost_only_their_own_rows(spark, tmp_path):
    (tmp_path / "good.csv").write_text("id,name,when\n1,x,2024-01-02\n2,,\n")
    (tmp_path / "wide.csv").write_bytes(b'id,"two\nlines",v\r\n7,"a\nb",1.5\r\n8,c,2\r\n')
    (tmp_path / "twice.csv").write_text("id,name,id\n1,x,2\n3,y,4\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "only.csv").write_text("a,b\n")
    (tmp_path / "ragged.csv").write_text("a,b\n1,2\n3\n4,5,6\n")
    (tmp_path / "unnamed.csv").write_text("a,,c\n1,2,3\n")
    late = "".join(f"{i}\n" for i in range(150)) + "word\n"
    (tmp_path / "late.csv").write_text("n\n" + late)
    got = objects(read_objects(spark, str(tmp_path)))
    assert ("good.csv", '{"id":1,"name":"x","when":"2024-01-02"}', None) in got
    assert ("good.csv", '{"id":2,"name":null,"when":null}', None) in got
    wide = [json.loads(t) for f, t, e in got if f == "wide.csv" and e is None]
    assert wide == [{"id": 7, "two\nlines": "a\nb", "v": 1.5}, {"id": 8, "two\nlines": "c", "v": 2.0}]
    assert [(t, e) for f, t, e in got if f == "twice.csv"] == [(None, "SchemaMismatch")] * 2
    assert not [f for f, _, _ in got if f in ("empty.csv", "only.csv")]
    assert sorted(e or "" for f, _, e in got if f == "ragged.csv") == ["", "SchemaMismatch", "SchemaMismatch"]
    assert [t for f, t, _ in got if f == "unnamed.csv"] == ['{"_c1":2,"a":1,"c":3}']
    assert [e for f, _, e in got if f == "late.csv" and e] == ["SchemaMismatch"]


def test_kinds_are_the_narrowest(spark, tmp_path):
    (tmp_path / "a.csv").write_text("l,d,b,t,m,s,e\n1,1,true,2024-01-01,2024-01-01 10:00:00,1,\n-2,.5,FALSE,2024-02-30x,2024-01-01,x,\n")
    row = objects(read_objects(spark, str(tmp_path)))[0]
    assert json.loads(row[1]) == {"l": 1, "d": 1.0, "b": True, "t": "2024-01-01", "m": "2024-01-01 10:00:00+00:00", "s": "1", "e": None} or row[1]
    kinds = read_objects(spark, str(tmp_path)).select(*[F.schema_of_variant(F.try_variant_get("data", f"$.{c}", "variant")).alias(c) for c in "ldbtms"]).first()
    assert tuple(kinds) == ("BIGINT", "DOUBLE", "BOOLEAN", "STRING", "TIMESTAMP", "STRING")


def test_thousand_headers_are_one_read(spark, tmp_path):
    for n in range(1000):
        (tmp_path / f"{n}.csv").write_text(f"id,c{n}\n{n},v{n}\n")
    df = read_objects(spark, str(tmp_path))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan text") == 1
    got = objects(df)
    assert len(got) == 1000 and ("17.csv", '{"c17":"v17","id":17}', None) in got


def test_without_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text('1,"x\ny"\n2,z\n')
    (tmp_path / "b.csv").write_text("w\n")
    got = [json.loads(t) for _, t, _ in objects(read_objects(spark, str(tmp_path), has_header=False))]
    assert got == [{"_c0": 1, "_c1": "x\ny"}, {"_c0": 2, "_c1": "z"}, {"_c0": "w"}]


# --- reads that follow events -------------------------------------------------


def triggers(spark, *names):
    rows = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "n long, f string")
    return rows.select(
        F.struct("f").alias("data"), F.lit("s").alias("subject"), F.col("n").cast("string").alias("id"), F.col("n").alias("timestamp"),
        F.lit(0).alias("task_id"), F.lit("t").alias("task_type"),
    )


def test_reads_only_what_is_wanted(spark, tmp_path):
    for n in range(30):
        (tmp_path / f"doc{n}.json").write_text(f'{{"n":{n}}}')
        (tmp_path / f"rows {n}.csv").write_text(f"a\n{n}\n")
    (tmp_path / "odd[1]+{x}%20.csv").write_text("a\n99\n")
    wanted = triggers(spark, "doc3.json", "/rows 4.csv", "odd[1]+{x}%20.csv", "none.csv", "sub/doc3.json", None)
    df = read_from_events(spark, wanted, "{{event.data.f}}", name="r", root=str(tmp_path))
    got = sorted((r["t"] or "", r["path"], r["_error"]) for r in df.select(F.to_json("data").alias("t"), "path", "_error").collect())
    assert [g for g in got if g[0]] == [('{"a":4}', "/rows 4.csv", None), ('{"a":99}', "/odd[1]+{x}%20.csv", None), ('{"n":3}', "/doc3.json", None)]
    assert {g[2] for g in got if not g[0]} <= {"NotFound", "NoExtension"} and len(got) == 6
    read = {name.rpartition("/")[2] for name in df.inputFiles()}
    assert "doc3.json" in read and not any(f"doc{n}.json" in read for n in range(30) if n != 3)


def test_many_wanted_files_are_joined(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "NAMED_PATHS", 3)
    for n in range(6):
        (tmp_path / f"d{n}.json").write_text(f'{{"n":{n}}}')
    df = read_from_events(spark, triggers(spark, *[f"d{n}.json" for n in range(5)]), "{{event.data.f}}", name="r", root=str(tmp_path))
    assert sorted(r["t"] for r in df.select(F.to_json("data").alias("t")).collect()) == [f'{{"n":{n}}}' for n in range(5)]
