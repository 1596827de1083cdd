"""XML documents of any structure as VARIANT."""

import json
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidesync.sources.files import read_xml_documents
from tidesync.sources.xml import parse_xml_variant, read_xml_record_variants, read_xml_variants, xml_root, xml_text

GOOD = {
    '<a id="1"><name>x</name><n:tag xmlns:n="u">5</n:tag></a>': {"a": {"@id": "1", "name": "x", "n:tag": {"@xmlns:n": "u", "#text": "5"}}},
    '<b><c>1</c><c>2</c><d k="v">text</d></b>': {"b": {"c": ["1", "2"], "d": {"@k": "v", "#text": "text"}}},
    '\ufeff<?xml version="1.0" encoding="UTF-8"?>\n<!-- c > d -->\n<a><x>007</x><y>1.50</y><z>true</z><w> pad </w><t>2020-01-02</t></a>': {
        "a": {"x": "007", "y": "1.50", "z": "true", "w": "pad", "t": "2020-01-02"}
    },
    "<a/>": {"a": None},
    "<a><l/><l>q</l></a>": {"a": {"l": [None, "q"]}},
    "<a><x>  </x><y></y></a>": {"a": {"x": None, "y": None}},
    '<a xml:lang="en"><s><![CDATA[0<raw>&]]></s>&amp;</a>': {"a": {"@xml:lang": "en", "s": "0<raw>&", "#text": "&"}},
    "<a><s><![CDATA[12]]></s></a>": {"a": {"s": "12"}},
    "<a>x&lt;y &#233; = 'q' a=\"5\"</a>": {"a": "x<y é = 'q' a=\"5\""},
    "<a b='x>y' c = \"1\"/>": {"a": {"@b": "x>y", "@c": "1"}},
    "<a><k>1</k><k><z>2</z></k></a>": {"a": {"k": ["1", {"z": "2"}]}},
    "<!DOCTYPE a [<!ELEMENT a ANY>]><a>1</a>": {"a": "1"},
}
BROKEN = ["<a><name>x</a>", "not xml", "<a/><b/>", "<a>1</a> junk", "<a>&unknown;</a>", "</tidesync_document><tidesync_document>", "<a", "7"]


def test_structures_and_texts_as_written(spark):
    docs = [*GOOD, *BROKEN, "", "  \n", None]
    rows = parse_xml_variant(spark.createDataFrame(list(enumerate(docs)), "i int, x string").repartition(3), "x")
    rows = {r.i: r for r in rows.select("i", F.to_json("doc").alias("doc"), "broken", "empty").collect()}
    for k, d in enumerate(docs):
        if d in GOOD:
            assert json.loads(rows[k].doc) == GOOD[d] and not rows[k].broken and not rows[k].empty
        else:
            assert rows[k].doc is None and rows[k].broken == (d in BROKEN) and rows[k].empty == (d not in BROKEN)


def test_paths_and_roots(spark):
    rows = parse_xml_variant(spark.createDataFrame([(d,) for d in GOOD], "x string"), "x").select(
        xml_root("doc").alias("root"), xml_text("doc", "$.b.c[1]").alias("c"), xml_text("doc", "$.a['n:tag']['#text']").alias("t"), xml_text("doc", "$.a.x").alias("x")
    ).collect()
    assert {r.root for r in rows} == {"a", "b"}
    assert {r.c for r in rows} == {None, "2"} and {r.t for r in rows} == {None, "5"} and {r.x for r in rows} == {None, "007"}


def test_files_and_lines_are_read_once(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/files")
    for k, d in enumerate([*GOOD, *BROKEN[:2], ""]):
        with open(f"{tmp_dir}/files/{k}.xml", "w") as f:
            f.write(d)
    loaded, broken = read_xml_variants(spark, f"{tmp_dir}/files")
    assert loaded.count() == len(GOOD) and broken.count() == 2
    assert "from_xml" not in loaded._jdf.queryExecution().toString()
    with open(f"{tmp_dir}/lines.txt", "w") as f:
        f.write("\n".join(["<a>1</a>", "", "<a>2</b>", "<c><d>3</d></c>"]))
    loaded, broken = read_xml_variants(spark, f"{tmp_dir}/lines.txt", per_line=True)
    assert {xml["root"] for xml in loaded.select(xml_root("doc").alias("root")).collect()} == {"a", "c"}
    assert [r.text for r in broken.collect()] == ["<a>2</b>"]


def test_nothing_to_read(spark):
    empty = spark.createDataFrame([], "x string")
    assert parse_xml_variant(empty, "x").count() == 0


def test_documents_of_several_lines_with_a_schema(spark, tmp_dir):
    """A document is one file, not one line, for the declared structure too."""
    os.makedirs(f"{tmp_dir}/many")
    for k, text in enumerate(('<p id="1">\n  <name>x</name>\n</p>', "<p>\n<name>y\n</p>")):
        with open(f"{tmp_dir}/many/{k}.xml", "w") as f:
            f.write(text)
    loaded, broken = read_xml_documents(spark, f"{tmp_dir}/many", T.StructType().add("@id", "string").add("name", "string"))
    assert [r.doc["name"] for r in loaded.collect()] == ["x"] and broken.count() == 1


def test_records_of_large_files_are_cut_and_split(spark, tmp_dir):
    """A broken record costs no other, wherever a file is split; the rest of a record without an end is broken."""
    os.makedirs(f"{tmp_dir}/records")
    item = lambda k: f'<item id="{k:04d}">\n <v>é{k}</v><items>x</items></item>' if k % 50 else f"<item id='{k}'><v>{k}</w></item>"
    with open(f"{tmp_dir}/records/a.xml", "w") as f:
        f.write("<?xml version='1.0'?>\n<items>\n" + "\n".join(item(k) for k in range(1000)) + "\n</items>\n")
    with open(f"{tmp_dir}/records/b.xml", "w") as f:
        f.write("<items><item><v>last</v></item><item><v>cut of")
    with open(f"{tmp_dir}/records/c.xml", "w") as f:
        f.write("<items>\n</items>")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        raw = spark.read.text(f"{tmp_dir}/records", lineSep="</item>")
        assert raw.rdd.getNumPartitions() > 5
        loaded, broken = read_xml_record_variants(spark, f"{tmp_dir}/records", "item")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    got = {r.id: r.v for r in loaded.select(xml_text("doc", "$.item['@id']").alias("id"), xml_text("doc", "$.item.v").alias("v")).collect()}
    assert got == {None: "last"} | {f"{k:04d}": f"é{k}" for k in range(1000) if k % 50}
    assert broken.count() == 20 + 1
