"""XML dumps read by many tasks, rows over several lines, and the conversion of all tables."""

import html
import random
import xml.etree.ElementTree as ET

import pytest

from forumlens.sources import files, splits

SCHEMA = "Id long, Title string, Body string, Score int"


@pytest.fixture
def small_blocks(spark):
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield lambda n: spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def dump(r, n, several_lines):
    gap = (lambda: r.choice([" ", "\n   ", "  ", "\n\n "])) if several_lines else (lambda: " ")
    out = ['<?xml version="1.0" encoding="utf-8"?>', "<posts>"]
    for i in range(n):
        text = r.choice(["a > b", "/> tricky >", "it's <row Id=\"1\"/>", "é & ü", "", "x" * r.randint(1, 90), "tab\there"])
        value = html.escape(text, quote=True).replace("&gt;", r.choice(["&gt;", ">"]))
        if several_lines and r.random() < 0.3:
            value += r.choice(["\n", "\nmore\n"])
        title = "" if r.random() < 0.2 else f'{gap()}Title={gap().strip()}"{value}"'
        body = f"{gap()}Body='one \"quoted\"'" if r.random() < 0.3 else ""
        out.append(f'{r.choice(["", "  "])}<row Id="{i}"{title}{body}{gap()}Score = "{i % 7}"{r.choice([" ", ""])}{r.choice(["/>", "></row>"])}')
        if r.random() < 0.05:
            out.append("<rows Id=\"7\"/><other/>")
    return "\n".join(out + ["</posts>", ""])


def expected(text):
    keep = []
    for e in ET.fromstring(text.encode()):
        if e.tag == "row":
            keep.append((int(e.get("Id")), e.get("Title"), e.get("Body"), int(e.get("Score"))))
    return sorted(keep)


@pytest.mark.parametrize("several_lines, block", [(False, 150), (False, 10 ** 6), (True, 40), (True, 300), (True, 10 ** 6)])
def test_blocks_of_a_dump_are_read_apart(spark, tmp_dir, small_blocks, several_lines, block):
    r = random.Random(block)
    want = []
    for i in range(3):
        text = dump(r, 90, several_lines)
        want += expected(text)
        with open(f"{tmp_dir}/{i}.xml", "w") as f:
            f.write(text)
    small_blocks(block)
    got = files.read_xml_rows(spark, tmp_dir, SCHEMA, rows_span_lines=several_lines)
    if block < 1000:
        assert got.rdd.getNumPartitions() > 20
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


def test_a_row_over_line_ends_is_not_lost_in_silence(spark, tmp_dir):
    with open(f"{tmp_dir}/a.xml", "w") as f:
        f.write('<posts>\n<row Id="1"\n Title="x"/>\n</posts>\n')
    with pytest.raises(Exception, match="rows_span_lines"):
        files.read_xml_rows(spark, tmp_dir, SCHEMA).collect()
    assert files.read_xml_rows(spark, tmp_dir, SCHEMA, rows_span_lines=True).collect() == [(1, "x", None, None)]
    with open(f"{tmp_dir}/a.xml", "w") as f:
        f.write('<posts>\n<row Id="1"\n Title="x')
    with pytest.raises(Exception, match="without an end"):
        files.read_xml_rows(spark, tmp_dir, SCHEMA, rows_span_lines=True).collect()


def test_attribute_names(spark, tmp_dir):
    with open(f"{tmp_dir}/a.xml", "w") as f:
        f.write("<t>\n<row B=\"x C='1'\" A='2'/>\n<row D=\"\" A='Z=\"1\"'/>\n</t>\n")
    assert splits.attribute_names(splits.xml_elements(spark, tmp_dir)) == ["A", "B", "D"]
    out = files.convert_dump(spark, {"Tags": tmp_dir}, f"{tmp_dir}-csv", gzip=False)
    back = files.read_csv(spark, out["Tags"], "A string, B string, D string").collect()
    assert sorted(map(tuple, back), key=repr) == sorted([("2", "x C='1'", None), ('Z="1"', None, "")], key=repr)


def test_topics_in_one_scan(spark, tmp_dir):
    for i in range(12):
        with open(f"{tmp_dir}/topic {i}.csv", "w") as f:
            f.write("TagName,Year,Month\n" + f"t{i},2017,{i + 1}\n" * (i + 1))
    df = files.read_topics(spark, {f"T{i}": f"{tmp_dir}/topic {i}.csv" for i in range(12)})
    assert df.columns == ["TagName", "Year", "Month", "Topic"]
    assert {r["Topic"]: r["count"] for r in df.groupBy("Topic").count().collect()} == {f"T{i}": i + 1 for i in range(12)}
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan text") == 1
    with pytest.raises(ValueError):
        files.read_topics(spark, {"a": tmp_dir, "b": f"{tmp_dir}/topic 1.csv"})


def test_plain_elements_and_the_parser_agree(spark):
    """attributes found without the XML parser are those that it finds."""
    lines = ['<row Id="1" Title=" a "/>', '<row id="1"/>', '<row Id="1" id="2"/>', '<row Id="" Title=""/>', '<row Title="x=" Id="2"/>',
             '<row Title="a&amp;lt;b &quot;q&quot; &apos;" />', '<row Title="/> t" Id="2">', '<row Title=" Id=" Id="8"/>', '<row Title="a&#10;b"/>',
             '<row xmlns="u" Id="3"/>', '<row  Id="4"  Title="zz"/>', "<row Id='9' Title='a\"b'/>", '<row A="1" Id="2" Body="3"/>',
             '<row Title="tab\there"/>', '<row Title="\x7f\x85 \u00e9 \U0001F600 \u2028"/>', "<row/>", "<row />"]
    table = spark.createDataFrame(list(enumerate(lines)), "i int, line string")
    lone = splits.F.regexp_extract("line", splits.plain_pattern("row"), 1) != ""
    plain = [r[0] for r in table.orderBy("i").select(lone).collect()]
    assert plain[0] and plain[5] and plain[6] and not plain[4] and not plain[8] and sum(plain) >= 7
    schema = files.as_struct("Id string, Title string")
    got, want = (files._rows_of(table.orderBy("i").select(splits.F.col("line").alias("element"), p.alias("plain")), schema).collect()
                 for p in (lone, splits.F.lit(False)))
    assert got == want


@pytest.mark.parametrize("bad", ['<row Id="1" Id="2"/>', '<row Id="1 & 2"/>', '<row Id="&foo;"/>'])
def test_elements_that_are_not_well_formed_raise(spark, tmp_dir, bad):
    with open(f"{tmp_dir}/a.xml", "w") as f:
        f.write(f"<t>\n{bad}\n</t>\n")
    with pytest.raises(Exception):
        files.read_xml_rows(spark, tmp_dir, "Id string").collect()


def test_plain_rows_are_read_without_the_parser(spark, tmp_dir):
    """would have failed before, when every element went through the XML parser."""
    with open(f"{tmp_dir}/a.xml", "w") as f:
        f.write('<t>\n  <row Id="1" Title="x"/>\n</t>\n')
    plan = files.read_xml_rows(spark, tmp_dir, "Id long, Title string")._jdf.queryExecution().executedPlan().toString()
    assert "str_to_map" in plan and "file_block_start" not in plan


def test_attributes_in_the_order_of_the_columns(spark, tmp_dir):
    """found by one pattern, equal to what the XML parser finds; would have failed before, without such a pattern."""
    names = [f"C{i}" for i in range(1, 12)] + ["Id", "Title"]
    wanted = ["Title", "C11", "C1", "Id"]
    long = "&lt;p> a &amp;&quot;" * 4000
    there = ['<row Id="1" Title=" a "/>', '  <row C1="" Id="2" Title=""/> ', '<row C1="$1 \\" C2="b" C11="&quot;&quot;" Id="&amp;lt;" Title="&apos;>"></row>',
             '<row C10="x" Title="/> Id=1 &gt;" />', f'<row Id="9" Title="{long}"/>', '<row C11="é \U0001F600" Title="&quot;C1=7"/>',
             "\t" + "<row " + " ".join(f'{n}="{n}"' for n in names) + "/>\r"]
    other = ['<row Title="x" Id="3"/>', '<row Id="4" Other="1"/>', '<row id="5" Title="y"/>', "<row/>", "<row />", '<row Id="x=" Title="z"/>',
             "<row Id='6'/>", '<row  Id="7"/>', '<row Id="a&#10;b"/>', '<row Id="8"/><row Id="10" Title="&amp;"/>', '\x02<row Id="11"/>',
             '<row xml:lang="e" Id="12"/>', '<row Id="13" Title="tab\there"/>']
    with open(f"{tmp_dir}/a.xml", "w", newline="") as f:
        f.write("\n".join(["<t>", *there, *other, "</t>"]))
    schema = files.as_struct(", ".join(f"{n} string" for n in wanted))
    elements = splits.xml_elements(spark, tmp_dir, "row", False, names, wanted)
    assert elements.where("values IS NOT NULL").count() == len(there)
    parsed = files._rows_of(splits.xml_elements(spark, tmp_dir).select("element", splits.F.lit(False).alias("plain")), schema)
    got = sorted(map(repr, files._rows_of(elements, schema).collect()))
    assert got == sorted(map(repr, parsed.collect())) and len(got) == len(there) + len(other) + 1
    out = files.convert_dump(spark, {"T": tmp_dir}, f"{tmp_dir}-csv", {"T": ", ".join(f"{n} string" for n in names)},
                             {"T": [n for n in names if n not in wanted]})
    assert sorted(map(repr, files.read_csv(spark, out["T"], schema).collect())) == got
    for odd in (["Id", "id"], ["xmlId"], ["a-b"], ["a b"], []):
        assert splits.ordered_pattern("row", odd) is None


def test_element_that_names_an_attribute_twice_raises_in_any_order(spark, tmp_dir):
    with open(f"{tmp_dir}/a.xml", "w") as f:
        f.write('<t>\n<row A="1" B="2" B="3"/>\n</t>\n')
    with pytest.raises(Exception):
        files.read_xml_rows(spark, tmp_dir, "A string, B string").collect()
