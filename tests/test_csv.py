"""CSV by column name and without loss."""

import datetime
import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import types as T

from forumlens.sources import files

SCHEMA = T.StructType([T.StructField("Id", T.LongType()), T.StructField("Title", T.StringType()),
                       T.StructField("Score", T.IntegerType()), T.StructField("At", T.TimestampType())])


def test_hand_written_file(spark, tmp_dir):
    path = f"{tmp_dir}/posts.csv"
    with open(path, "w", newline="") as f:
        f.write('# a comment\nAt,Id,More,Score,Title\n'
                '2015-03-01T10:00:00.5,1,x,7,"a ""b"", c"\n# another\n,2,,bad,"two\nlines"\n'
                '2016-01-01,3,,,  edge spaces  \n,4,,-1,C# lang #1\n')
    got = files.read_commented_csv(spark, path, SCHEMA).orderBy("Id").collect()
    assert [tuple(r) for r in got] == [
        (1, 'a "b", c', 7, datetime.datetime(2015, 3, 1, 10, 0, 0, 500000)), (2, "two\nlines", None, None),
        (3, "  edge spaces  ", None, datetime.datetime(2016, 1, 1)), (4, "C# lang #1", -1, None)]
    counted = Observation("bad")
    again = files.read_commented_csv(spark, path, SCHEMA, bad_values=counted)
    assert again.count() == 4 and counted.get == {"Id": 0, "Title": 0, "Score": 1, "At": 0}
    assert again._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    with pytest.raises(ValueError):
        files.read_commented_csv(spark, path, T.StructType([T.StructField("Absent", T.StringType())]))


@pytest.mark.parametrize("gzip", [False, True])
def test_round_trip_keeps_values(spark, tmp_dir, gzip):
    rows = [(1, ' say "hi", ok ', 1, datetime.datetime(2014, 5, 6, 7, 8, 9)), (2, "a\nb\r\nc", None, None),
            (3, "", 3, None), (4, None, -4, None), (5, "back\\slash \\\" quote", 5, None), (6, "# start", 6, None)]
    path = files.write_csv(spark.createDataFrame(rows, SCHEMA), f"{tmp_dir}/out", gzip=gzip)
    got = files.read_csv(spark, path, SCHEMA).orderBy("Id").collect()
    assert [tuple(r) for r in got] == rows


def random_csv(r, n, comment):
    """Text of a CSV file with ``n`` records, and its rows."""
    values = ["", "x", "two words", "a\nb", "\n\n", 'say "hi"', '"', "a\r\nb,c", "#no", "é\n#é", ",", '"\n"', None]
    rows, out = [], ["\ufeffId,Title"]
    for i in range(n):
        if r.random() < 0.15 and comment:
            out.append(r.choice(["# note", '# a "quoted, note', '#"']))
        if r.random() < 0.05:
            out.append("")
        v = r.choice(values)
        rows.append((i, v))
        out.append(f"{i}," + ("" if v is None else '"' + v.replace('"', '""') + '"' if v == "" or r.random() < 0.3 or set(v) & set('",\r\n')
                              else v))
    end = r.choice(["\n", "\r\n"])
    return end.join(out) + r.choice(["", end]), rows


@pytest.mark.parametrize("seed", range(6))
def test_blocks_of_a_file_are_read_apart(spark, tmp_dir, seed):
    """Small blocks, so that most records with line ends cross a border; equal to the rows written."""
    r = random.Random(seed)
    comment = "#" if seed % 2 else None
    expected = []
    for i in range(3):
        text, rows = random_csv(r, 120, comment)
        expected += rows
        with open(f"{tmp_dir}/{i}.csv", "w", newline="") as f:
            f.write(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(r.choice([23, 64, 200])))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        schema = "Id long, Title string"
        got = files.read_commented_csv(spark, tmp_dir, schema, "#") if comment else files.read_csv(spark, tmp_dir, schema)
        assert got.rdd.getNumPartitions() > 10
        key = lambda x: (x[0], x[1] is None, x[1] or "")
        assert sorted(map(tuple, got.collect()), key=key) == sorted(expected, key=key)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_odd_files(spark, tmp_dir):
    for name, text in (("empty", ""), ("only", "Id,Title\n"), ("note", "# x\n\nId,Title\n")):
        with open(f"{tmp_dir}/{name}.csv", "w") as f:
            f.write(text)
    assert files.read_commented_csv(spark, tmp_dir, "Id long, Title string").collect() == []
    assert files.read_csv(spark, f"{tmp_dir}/empty.csv", "Id long").collect() == []
    with open(f"{tmp_dir}/open.csv", "w") as f:
        f.write('Id,Title\n1,a\n2,"no end\n3,c')
    assert files.read_csv(spark, f"{tmp_dir}/open.csv", "id long, title string").orderBy("id").first()[1] == "a"
    with open(f"{tmp_dir}/twice.csv", "w") as f:
        f.write("Id,id,ID\n1,2,3\n")
    assert files.read_csv(spark, f"{tmp_dir}/twice.csv", "id long").collect() == [(2,)]
    with pytest.raises(ValueError):
        files.read_csv(spark, f"{tmp_dir}/twice.csv", "iD long")
    with pytest.raises(ValueError):
        files.read_csv(spark, [f"{tmp_dir}/twice.csv", f"{tmp_dir}/only.csv"], "Id long")


def test_records_without_quotes(spark, tmp_dir):
    """split at the commas, as the parser reads them; a record of another length raises as before."""
    with open(f"{tmp_dir}/a.csv", "w", newline="") as f:
        f.write("Id,Title,More\n1,  a b ,\n,#x,\\\n2,,\u00e9\n" + '3,"",x\n4,"a,b",\n')
    got = files.read_csv(spark, f"{tmp_dir}/a.csv", "Id long, Title string, More string").collect()
    assert [tuple(r) for r in got] == [(1, "  a b ", None), (None, "#x", "\\"), (2, None, "\u00e9"), (3, "", "x"), (4, "a,b", None)]
    with open(f"{tmp_dir}/b.csv", "w") as f:
        f.write("Id,Title\n1,a,b\n")
    with pytest.raises(Exception):
        files.read_csv(spark, f"{tmp_dir}/b.csv", "Id long, Title string").collect()
