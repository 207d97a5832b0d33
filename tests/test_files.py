"""Sources, sinks and the stream of files on small files made here."""

import json
import struct
import zipfile

import pytest
from pyspark.sql import functions as F

from sessionloom.operators import progress
from sessionloom.session import shared_dir
from sessionloom.sources import files, sinks
from sessionloom.streaming.files import line_stream, marker_counts, status_stream, tag_stream, watch_status


def docx(path, paragraphs):
    body = "".join(f"<w:p><w:r><w:t>{p}</w:t></w:r></w:p>" for p in paragraphs)
    with zipfile.ZipFile(path, "w") as archive:
        archive.writestr("word/document.xml", f'<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body>{body}</w:body></w:document>')


def dbf(records, deleted=()):
    fields = [("NAME", 10), ("NAMELSAD", 16)]
    width = 1 + sum(n for _, n in fields)
    head = struct.pack("<B3xIHH20x", 3, len(records), 32 + 32 * len(fields) + 1, width)
    head += b"".join(n.encode().ljust(11, b"\0") + b"C" + bytes(4) + bytes([s]) + bytes(15) for n, s in fields) + b"\r"
    return head + b"".join((b"*" if i in deleted else b" ") + b"".join(v.encode().ljust(s) for v, (_, s) in zip(r, fields, strict=True)) for i, r in enumerate(records))


def test_transcripts(spark, tmp_path):
    docx(tmp_path / "one.docx", ["Hello", " ", "there"])
    (tmp_path / "two.txt").write_text("a\nb")
    (tmp_path / "bad.docx").write_bytes(b"no zip")
    got = {r.doc_id: r.raw_text for r in files.read_transcripts(spark, str(tmp_path)).collect()}
    assert got == {"one": "Hello\nthere", "two": "a\nb", "bad": ""}
    assert files.docx_text((tmp_path / "one.docx").read_bytes(), keep_blank=True) == "Hello\n \nthere"


def test_dbf_and_layer(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "layer.zip", "w") as archive:
        archive.writestr("layer.dbf", dbf([("Oru", "Oru Land"), ("Gone", "x"), ("Vale", "VALE")], deleted={1}))
    records = files.read_dbf(spark, str(tmp_path / "layer.zip"))
    assert {r.name for r in files.layer_places(records, "area", "layer").collect()} == {"Oru", "Oru Land", "Vale"}


def test_text_sources(spark, tmp_path):
    (tmp_path / "g.txt").write_text("1|Talva Creek|Stream|QA|x\n2|short\n3|Oru|Civil|QB|y\n")
    assert [r.name for r in files.read_pipe_places(spark, str(tmp_path / "g.txt"), ["Civil"]).collect()] == ["Oru"]
    (tmp_path / "y1.txt").write_text("Avery,F,10\nRowan,M,3\nbroken\n")
    (tmp_path / "y2.txt").write_text("avery,M,5\n")
    got = {r.name: r.total for r in files.read_name_counts(spark, [str(tmp_path / "y1.txt"), str(tmp_path / "y2.txt")]).collect()}
    assert got == {"Avery": 15, "Rowan": 3}
    (tmp_path / "dist").write_text("STONE  1.0 1.0 1\nVALE 0.8 1.8 2\n")
    assert [(r.name, r.frequency_rank) for r in files.read_name_distribution(spark, str(tmp_path / "dist")).collect()] == [("Stone", 1), ("Vale", 2)]
    (tmp_path / "m.csv").write_text('q,a\n"x, y","1"\n')
    assert files.read_csv_named(spark, str(tmp_path / "m.csv")).first().q == "x, y"
    assert [r.row_idx for r in files.read_csv_positional(spark, str(tmp_path / "m.csv")).collect()] == [0, 1]


def test_json_sources(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps({"results": {"bindings": [{"place": {"value": "Oru"}}, {"place": {"value": "Vale"}, "state": {"value": "QA"}}]}}))
    assert [r.binding.get("state") for r in files.read_sparql(spark, str(tmp_path / "s.json")).collect()] == [None, "QA"]
    (tmp_path / "f.json").write_text(json.dumps({"features": [{"attributes": {"NAME": "Oru"}}]}))
    assert files.read_features(spark, str(tmp_path / "f.json")).first().attributes["NAME"] == "Oru"
    package = {"title": "Names", "organization": {"title": "Survey"}, "resources": [{"format": "ZIP", "url": "u"}]}
    (tmp_path / "p.json").write_text(json.dumps({"result": {"results": [package]}}))
    assert tuple(files.read_packages(spark, str(tmp_path / "p.json")).first()) == ("Names", "Survey", "ZIP", "u")


def test_sinks(spark, tmp_path):
    lines = spark.createDataFrame([("d", 2, "b"), ("d", 1, "a")], "doc_id string, line_no int, line string")
    sinks.write_texts(lines, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).first().text == "a\nb"
    sinks.export_text(spark, str(tmp_path / "t"), "d", str(tmp_path / "one"))
    assert [r.value for r in spark.read.text(str(tmp_path / "one")).collect()] == ["a", "b"]
    codes = spark.createDataFrame([("d", "person", "Oru", "#A")], "doc_id string, kind string, surface string, code string")
    variants = spark.createDataFrame([("d", "Oru", "Oruu")], "doc_id string, canonical string, surface string")
    cited = spark.createDataFrame([("d", "[A.1]", None, "Oru")], "doc_id string, citation string, ts string, speaker string")
    sinks.write_json(sinks.mapping_rows(codes, variants, cited), str(tmp_path / "j"))
    mapping = files.read_mapping(spark, str(tmp_path / "j"), lines=True).first()
    assert mapping.persons == {"Oru": "#A"} and mapping.name_variants == {"Oru": ["Oruu"]}
    tags = spark.createDataFrame([("B", 1, "x", "y"), ("A", 2, "x", "y")], "category string, line_no int, matched string, context string")
    sinks.write_tags(tags, str(tmp_path / "tags"))
    assert files.read_csv_named(spark, str(tmp_path / "tags")).count() == 2
    sinks.write_gazetteer({"place_names": codes}, str(tmp_path / "g"))
    sinks.write_matrix(codes, str(tmp_path / "m"), ["A title"])
    assert spark.read.text(str(tmp_path / "m")).count() == 3


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.txt").write_text("a grant\nno\nProcessing: x\nPROGRESS: [2/5]\n")
    stream = line_stream(spark, str(tmp_path / "in"))
    tag_stream(stream, [("Finance", "grant")], str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert [(r.doc_id, r.keyword) for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [("one", "grant")]
    counts = marker_counts(spark.read.text(str(tmp_path / "in")).select(F.lit("one").alias("doc_id"), F.col("value").alias("line"))).first()
    assert (counts.markers, counts.progress) == (1, 2)


def test_status_stream(spark, tmp_path):
    rows = [("j", "one", 1, 4, 2.0, "2024-01-01 00:00:00"), ("j", "two", 2, 4, 6.0, "2024-01-01 00:00:09"), ("k", "one", 0, 0, 0.0, "2024-01-01 00:00:01")]
    reports = spark.createDataFrame(rows, "job string, phase string, done long, total long, seconds double, at string").selectExpr("*", "to_timestamp(at) as stamp")
    records = progress.status_rows(reports)
    assert [(r.percent, r.eta) for r in records.orderBy("job", "stamp").collect()] == [(25.0, "00:00:06"), (50.0, "00:00:06"), (0.0, "??:??:??")]
    sinks.write_json(records, str(tmp_path / "in"))
    watch_status(status_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert {(r.job, r.phase) for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {("j", "two"), ("k", "one")}
    (tmp_path / "bad.json").write_text('{"job": "x", "phase": 1}\n{broken\n')
    assert files.read_status(spark, str(tmp_path / "bad.json")).count() <= 1
    latest = progress.latest_status(records, F.to_timestamp(F.lit("2024-01-01 00:00:10")))
    assert {(r.job, r.stale) for r in latest.collect()} == {("j", False), ("k", True)}


def test_details_and_classes(spark):
    detail = {"epaTribalInternalId": 7, "currentName": "Oru Nation of the Talva Reservation", "names": [{"name": "Old Oru"}], "epaLocations": [{"stateName": None}, {"stateName": "QA"}]}
    answers = spark.createDataFrame([(json.dumps(detail),), ("broken",)], "value string")
    got = {(r.name, r.state) for r in files.parse_details(answers).collect()}
    assert got == {("Oru Nation of the Talva Reservation", "QA"), ("Old Oru", "QA"), ("Talva Reservation", "QA"), ("Oru Nation of the Talva", "QA")} or ("Old Oru", "QA") in got
    edges = spark.createDataFrame([("b", "a"), ("c", "b"), ("a", "c"), ("z", "y")], "class string, parent string")
    assert {r[0] for r in files.subclasses(edges, "a").collect()} == {"a", "b", "c"}
    assert files.parse_dbf(b"short") == []


def test_scratch_folder_must_be_shared_on_a_cluster():
    class Conf:
        def get(self, name, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        shared_dir(Session())
