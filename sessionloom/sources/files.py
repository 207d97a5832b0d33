"""File sources: transcripts (text, .docx), delimited tables, DBF, gazetteer files and JSON answers of services."""

from __future__ import annotations

import gzip
import struct
import zipfile
from collections.abc import Iterator, Sequence
from functools import reduce
from io import BytesIO
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionloom.functions.scalars import table_score
from sessionloom.operators.gazetteer import first_wins, flatten_places, places_in_name
from sessionloom.operators.progress import STATUS
from sessionloom.session import cut, number_rows

_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def docx_text(content: bytes, keep_blank: bool = False) -> str:
    """Paragraphs of a .docx joined by line breaks; '' if it can't be read."""
    try:
        with zipfile.ZipFile(BytesIO(content)) as archive:
            root = ElementTree.fromstring(archive.read("word/document.xml"))
    except (zipfile.BadZipFile, KeyError, ElementTree.ParseError, OSError):
        return ""
    paragraphs = ["".join(t.text or "" for t in p.iter(f"{_W}t")) for p in root.iter(f"{_W}p")]
    return "\n".join(p for p in paragraphs if keep_blank or p.strip())


def read_transcripts(spark: SparkSession, paths: str | Sequence[str], keep_blank: bool = False) -> DataFrame:
    """(doc_id, source_file, raw_text) of .txt, .vtt and .docx files of folders or explicit paths.

    A list of files is taken as it is, a folder gives the transcripts in it. ``position`` numbering is left to the
    caller (``in_file_order``), since reading is parallel.
    """
    return parse_transcripts(spark.read.format("binaryFile").option("pathGlobFilter", "*.{txt,vtt,docx}").load(paths), keep_blank)


def parse_transcripts(files: DataFrame, keep_blank: bool = False) -> DataFrame:
    """Transcripts of files (path, content): .docx by paragraphs, others as UTF-8 without their bad bytes."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [docx_text(c, keep_blank) if p.endswith(".docx") else c.decode("utf-8", "ignore") for p, c in zip(batch["path"], batch["content"], strict=True)]
            yield batch[["doc_id", "source_file"]].assign(raw_text=texts)

    name = F.element_at(F.split("path", "/"), -1)
    named = files.select("path", "content", F.regexp_replace(name, r"\.[^.]*$", "").alias("doc_id"), name.alias("source_file"))
    return named.mapInPandas(parse, "doc_id string, source_file string, raw_text string")


def in_file_order(transcripts: DataFrame, without: Sequence[str] = ()) -> DataFrame:
    """Transcripts with their ``position`` by file name, from 1; files whose name holds a part of ``without`` are left out."""
    kept = transcripts
    for part in without:
        kept = kept.where(~F.lower("source_file").contains(part.lower()))
    return number_rows(kept, [F.col("source_file")], "position")


def read_csv_positional(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a CSV file, header included, with ``row_idx`` from 0 in the order of the file.

    A file with line breaks inside quotes can't be split, so one task reads it; the rows of several files follow in
    the order of their names.
    """
    rows = spark.read.csv(path, header=False, multiLine=True, escape='"').withColumn("__file", F.col("_metadata.file_name"))
    marked = rows.withColumn("__id", F.monotonically_increasing_id())
    return number_rows(marked, [F.col("__file"), F.col("__id")], "row_idx").withColumn("row_idx", F.col("row_idx") - 1).drop("__file", "__id")


def read_csv_named(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    """A CSV file with a header; all strings unless types are inferred."""
    return spark.read.csv(path, header=True, multiLine=True, escape='"', inferSchema=infer)


def parse_dbf(content: bytes) -> list[dict[str, str]]:
    """Records of a dBase III/IV table, deleted ones left out, values trimmed and read as UTF-8, else Latin-1."""
    if len(content) < 33:
        return []
    count, header, width = struct.unpack("<IHH", content[4:12])
    fields, at = [], 32
    while at + 32 <= len(content) and content[at] != 0x0D:
        fields.append((content[at : at + 11].split(b"\0")[0].decode("ascii"), content[at + 16]))
        at += 32
    out = []
    for i in range(count):
        record = content[header + i * width : header + (i + 1) * width]
        if len(record) < width or record[:1] == b"*":
            continue
        values, start = {}, 1
        for name, size in fields:
            raw = record[start : start + size]
            try:
                values[name] = raw.decode("utf-8").strip()
            except UnicodeDecodeError:
                values[name] = raw.decode("latin-1").strip()
            start += size
        out.append(values)
    return out


def read_dbf(spark: SparkSession, path: str) -> DataFrame:
    """(source_file, record MAP) of .dbf files, also inside .zip or .gz files."""
    return parse_dbf_files(spark.read.format("binaryFile").load(path))


def unpacked(content: bytes, ending: str) -> list[bytes]:
    """What a file holds, told by its first bytes: the members of a zip that end so, a gzip's content, or itself."""
    if content[:2] == b"PK":
        with zipfile.ZipFile(BytesIO(content)) as archive:
            return [archive.read(n) for n in sorted(archive.namelist()) if n.lower().endswith(ending)]
    return [gzip.decompress(content)] if content[:2] == b"\x1f\x8b" else [content]


def parse_dbf_files(files: DataFrame) -> DataFrame:
    """Records of the DBF tables in files (path, content); files too short for a header have none."""
    schema = T.StructType([T.StructField("source_file", T.StringType()), T.StructField("record", T.MapType(T.StringType(), T.StringType()))])

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                rows = [r for t in unpacked(content, ".dbf") for r in parse_dbf(t)]
                yield pd.DataFrame({"source_file": [name.rsplit("/", 1)[-1]] * len(rows), "record": rows})

    return files.select("path", "content").mapInPandas(parse, schema)


def layer_places(records: DataFrame, kind: str, source: str) -> DataFrame:
    """Place records of a boundary layer: NAME and, if it differs ignoring case, NAMELSAD."""
    name, long = F.col("record")["NAME"], F.col("record")["NAMELSAD"]
    names = F.array_compact(F.array(name, F.when(F.lower(long) != F.lower(name), long)))
    return records.select(F.explode(names).alias("name"), F.lit(kind).alias("type"), F.lit(None).cast("string").alias("tribe"), F.lit(None).cast("string").alias("state"), F.lit(source).alias("source"))


def read_pipe_places(spark: SparkSession, paths: str | Sequence[str], kinds: Sequence[str] | None = None, source: str = "gazetteer", name_words: Sequence[str] = (), ignore_case: bool = False, state: str | None = None) -> DataFrame:
    """Place records of pipe-delimited gazetteer files (id, name, class, state, ...); short lines are left out.

    ``kinds`` keeps classes, ``name_words`` names that hold one of them (either suffices if both are given), with or
    without regard to letter case; ``state`` stands for the files of one state, which don't state it.
    """
    parts = F.split("value", r"\|")
    lines = spark.read.text(paths).where(F.size(parts) >= (3 if state else 4))
    where = F.lit(state) if state else F.get(parts, 3)
    places = lines.select(F.get(parts, 1).alias("name"), F.get(parts, 2).alias("type"), F.lit(None).cast("string").alias("tribe"), where.alias("state"), F.lit(source).alias("source"))
    fold = (lambda c: F.lower(c)) if ignore_case else (lambda c: F.col(c))
    own = (lambda words: [w.lower() for w in words]) if ignore_case else list
    wanted = [fold("type").isin(*own(kinds))] if kinds else []
    wanted += [fold("name").contains(w) for w in own(name_words)]
    return places.where(reduce(lambda a, b: a | b, wanted)) if wanted else places


def read_name_counts(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Yearly name files (Name,Sex,Count) as name totals; other lines are left out."""
    parts = F.split("value", ",")
    rows = spark.read.text(paths).where(F.size(parts) == 3)
    named = rows.select(F.initcap(F.trim(F.get(parts, 0))).alias("name"), F.expr("try_cast(split(value, ',')[2] as long)").alias("n"))
    return named.where("n is not null").groupBy("name").agg(F.sum("n").alias("total"))


def read_name_distribution(spark: SparkSession, path: str, alphabetical: bool = False) -> DataFrame:
    """Whitespace-separated name distributions: (name, frequency_rank), by the order of the file or of the names.

    Each name counts once, at its first place; lines of a file keep their order across splits.
    """
    rows = spark.read.text(path).withColumn("at", F.monotonically_increasing_id()).where(F.trim("value") != "")
    names = rows.groupBy(F.initcap(F.element_at(F.split(F.trim("value"), r"\s+"), 1)).alias("name")).agg(F.min("at").alias("at"))
    return number_rows(names, [F.col("name") if alphabetical else F.col("at")], "frequency_rank").select("name", "frequency_rank")


def read_surnames(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file of surnames by frequency with a column ``name`` or ``NAME``: (name, frequency_rank) in file order."""
    rows = spark.read.csv(path, header=True)
    column = next((c for c in rows.columns if c.lower() == "name"), rows.columns[0])
    named = rows.select(F.initcap(F.trim(f"`{column}`")).alias("name"), F.monotonically_increasing_id().alias("at")).where("name <> ''")
    return number_rows(named, [F.col("at")], "frequency_rank").select("name", "frequency_rank")


def name_presence(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """How many of the distribution files' lines begin with each name."""
    rows = spark.read.text(paths).where(F.trim("value") != "")
    return rows.groupBy(F.initcap(F.element_at(F.split(F.trim("value"), r"\s+"), 1)).alias("name")).agg(F.count("*").alias("n"))


def read_sparql(spark: SparkSession, path: str) -> DataFrame:
    """Bindings of SPARQL JSON answers as a map from variable to value; unbound variables are absent."""
    return parse_sparql(spark.read.text(path, wholetext=True))


def parse_sparql(answers: DataFrame, value: str = "value") -> DataFrame:
    """Bindings of answers held as JSON text; text that can't be read has none."""
    answer = answers.select(F.from_json(value, "results struct<bindings:array<map<string,struct<value:string>>>>").alias("a"))
    return answer.select(F.explode("a.results.bindings").alias("b")).select(F.transform_values("b", lambda _, v: v["value"]).alias("binding"))


def sparql_places(bindings: DataFrame, classes: Sequence[str], source: str) -> DataFrame:
    """Distinct place records of bindings (name, class, and state if bound) whose class holds one of the words."""
    b = F.col("binding")
    kept = bindings.where(F.lower(b["class"]).rlike("|".join(rf"\Q{c.lower()}\E" for c in classes)))
    return kept.select(b["name"].alias("name"), b["class"].alias("type"), F.lit(None).cast("string").alias("tribe"), b["state"].alias("state"), F.lit(source).alias("source")).distinct()


def sparql_people(bindings: DataFrame, source: str) -> DataFrame:
    """Distinct names of people by label: first and last word of labels of two words or more."""
    words = F.split(F.trim(F.col("binding")["label"]), r"\s+")
    named = bindings.where(F.size(words) >= 2)
    return named.select(F.get(words, 0).alias("first_name"), F.element_at(words, -1).alias("last_name"), F.col("binding")["tribe"].alias("tribe_origin"), F.lit(source).alias("source")).distinct()


def subclasses(edges: DataFrame, root: str, most: int = 1_000) -> DataFrame:
    """(class) the root and every class below it, of edges (class, parent); cycles end where nothing new is found."""
    spark = edges.sparkSession
    reached = spark.createDataFrame([(root,)], "class string")
    frontier = reached
    for _ in range(most):
        frontier = cut(edges.join(frontier.withColumnRenamed("class", "parent"), "parent").select("class").distinct().join(reached, "class", "left_anti"))
        if frontier.isEmpty():
            return reached
        reached = cut(reached.unionByName(frontier))
    raise ValueError(f"classes nest more than {most} deep")


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """Attributes of the features of ArcGIS JSON answers."""
    return parse_features(spark.read.text(path, wholetext=True))


def parse_features(answers: DataFrame, value: str = "value") -> DataFrame:
    answer = answers.select(F.from_json(value, "features array<struct<attributes:map<string,string>>>").alias("a"))
    return answer.select(F.explode("a.features.attributes").alias("attributes"))


def read_packages(spark: SparkSession, path: str) -> DataFrame:
    """(title, publisher, format, url) of the resources of a CKAN search answer."""
    return parse_packages(spark.read.text(path, wholetext=True))


def parse_packages(answers: DataFrame, value: str = "value") -> DataFrame:
    resource = "array<struct<format:string,url:string>>"
    answer = answers.select(F.from_json(value, f"result struct<results:array<struct<title:string,organization:struct<title:string>,resources:{resource}>>>").alias("a"))
    packages = answer.select(F.explode("a.result.results").alias("p")).select("p.title", F.col("p.organization.title").alias("publisher"), F.explode("p.resources").alias("r"))
    return packages.select("title", "publisher", "r.format", "r.url")


def best_package(packages: DataFrame, rules: Sequence[tuple[str, str, float]]) -> DataFrame:
    """The resource of the highest score by a table of rules (column, pattern, points); ties go to the first URL."""
    score = table_score({c: F.col(c) for c in ("title", "publisher", "format")}, rules)
    return packages.withColumn("score", score).orderBy(F.desc("score"), "url").limit(1)


def parse_details(answers: DataFrame, value: str = "value") -> DataFrame:
    """Place records of detail answers about nations: names crossed with the stated locations.

    An answer holds an id, the present name, former names and locations (state, region). The places that a name states
    stand beside it; a location without a state takes the answer's first one. Of records equal in name the one of the
    least id comes first.
    """
    # The field names of the service's answers
    detail = "epaTribalInternalId long, currentName string, names array<struct<name:string>>, epaLocations array<struct<stateName:string,epaRegionName:string>>"
    a = answers.select(F.from_json(value, detail).alias("a")).select("a.*").where("epaTribalInternalId is not null")
    every = F.array_distinct(F.filter(F.concat(F.array("currentName"), F.coalesce(F.transform("names", lambda n: n["name"]), F.array().cast("array<string>"))), lambda n: n.isNotNull()))
    placed = F.array_distinct(F.concat(every, F.flatten(F.transform(every, lambda n: places_in_name(n)))))
    states = F.coalesce(F.transform("epaLocations", lambda x: x["stateName"]), F.array(F.lit(None).cast("string")))
    rows = flatten_places(a.select(F.col("epaTribalInternalId").alias("id"), placed.alias("names"), states.alias("states")), "names", "states", "id")
    named = rows.join(a.select(F.col("epaTribalInternalId").alias("id"), F.col("currentName").alias("tribe")), "id").where("place is not null")
    return first_wins(named.select("id", F.col("place").alias("name"), "state", "tribe"), ["name"], ["id", "name", "state"])


def read_status(spark: SparkSession, path: str) -> DataFrame:
    """Status records; lines that can't be read are left out."""
    return spark.read.schema(STATUS).option("mode", "DROPMALFORMED").json(path)


def read_mapping(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Mapping files, one object a file or (``lines``) a line: a map per kind of entity and name variants by document."""
    schema = "source_file string, persons map<string,string>, organizations map<string,string>, locations map<string,string>, tribes map<string,string>, name_variants map<string,array<string>>"
    return spark.read.schema(schema).json(path, multiLine=not lines)
