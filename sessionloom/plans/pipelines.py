"""Queries of the end-to-end cleaner, the sources and sinks, the gazetteer build, reports and progress.

Sources are tested on the driver's tables: a table is written, or encoded in memory, in the format of the source and
read back by the source's own parser, so that SQL on the table is the answer wanted.
"""

from __future__ import annotations

import struct
import uuid
import zipfile
from collections.abc import Callable, Iterator
from io import BytesIO

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionloom.functions import scalars
from sessionloom.operators import cluster, extract, gazetteer, grading, lines, matrix, pipeline, progress, redact, reports, survey, tagging
from sessionloom.plans.reference import _CITED, _LINES, _TAGS, HEADER, LEXICON, NEGATIVE, ORACLE as KNOWN, QUESTION_WORDS, QUESTIONS, REQUIRED, TERMS, _documents, _graded, _tags, _timed
from sessionloom.session import shared_dir, table
from sessionloom.sources import files, sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLE[function.__name__] = sql
        return function

    return add


def _scratch(spark: SparkSession, name: str) -> str:
    """A new folder of the shared scratch space."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _written(df: DataFrame, name: str) -> str:
    """``df`` (one text column) written as text files; their folder."""
    path = _scratch(df.sparkSession, name)
    df.write.text(path)
    return path


# ---- the cleaner


def _lookups(spark, sf_dir) -> pipeline.Lookups:
    names, known = table(spark, sf_dir, "native_american_names"), table(spark, sf_dir, "canonical_names")
    seen = table(spark, sf_dir, "place_names").where("place_type <> 'district' and name is not null").groupBy("name").agg((F.countDistinct("state") == 1).alias("is_primarily_place"))
    return pipeline.Lookups(names.select(F.col("first_name").alias("name")), names.select(F.col("last_name").alias("name")), known.where("kind = 'affiliation'").select("name"), known.where("kind = 'place'").select("name"), seen)


SETTINGS = pipeline.Settings(LEXICON, QUESTION_WORDS, TERMS, NEGATIVE, REQUIRED, masked=("fish weir", "word list"), ambiguous_words=("May", "Will", "Grant"))


def _cleaned(spark, sf_dir) -> pipeline.Cleaned:
    return pipeline.clean_transcripts(table(spark, sf_dir, "documents").select("doc_id", "text"), _lookups(spark, sf_dir), SETTINGS)


@query()
def q_clean_transcripts(spark, sf_dir):
    """Every document cleaned end to end: its text with codes for what it named."""
    return _cleaned(spark, sf_dir).texts


@query()
def q_clean_summary(spark, sf_dir):
    """Entities, tags, verses and pages of every cleaned document."""
    return _cleaned(spark, sf_dir).summary


@query()
def q_run_totals(spark, sf_dir):
    return reports.run_totals(_cleaned(spark, sf_dir).summary)


@query()
def q_clean_leaves_no_name(spark, sf_dir):
    """Mapped surfaces that still stand in their cleaned text: none, but for those inside brackets."""
    cleaned = _cleaned(spark, sf_dir)
    return grading.residual_entities(cleaned.codes.select("doc_id", "kind", "surface"), cleaned.texts.where("text is not null"))


_FLAGS = """WITH c AS (SELECT doc_id, kind, surface, pattern_rank FROM ({candidates})),
    t AS (SELECT *, regexp_split_to_array(trim(surface), '\\s+') AS w FROM c),
    l AS (SELECT DISTINCT last_name AS n FROM native_american_names WHERE last_name IS NOT NULL), f AS (SELECT DISTINCT first_name AS n FROM native_american_names WHERE first_name IS NOT NULL),
    a AS (SELECT name AS an, count(DISTINCT state) = 1 AS one FROM place_names WHERE place_type <> 'district' AND name IS NOT NULL GROUP BY 1),
    p AS (SELECT doc_id, kind, surface, pattern_rank FROM t WHERE kind = 'person' AND ((pattern_rank = 0 AND len(w) > 1) OR CASE WHEN length(surface) < 2 THEN false WHEN w[len(w)] IN (SELECT n FROM l) THEN true WHEN len(w) = 1 THEN w[1] IN (SELECT n FROM f)
      WHEN len(w) > 4 THEN false ELSE len(list_filter(w, lambda x: NOT regexp_matches(x, '^[A-Z]') OR lower(x) IN ({stop}))) = 0 END)),
    g AS (SELECT doc_id, kind, surface, pattern_rank FROM t LEFT JOIN a ON surface = an WHERE kind = 'location' AND (lower(surface) IN (SELECT lower(name) FROM canonical_names)
      OR CASE WHEN an IS NOT NULL THEN CASE WHEN regexp_matches(surface, '(?i)\\b(?:in|at|near|from|to|town|city|village|county)\\s') THEN true WHEN regexp_matches(surface, '(?i)\\b(?:said|says|asked|told|explained)\\b') THEN false ELSE one END
         ELSE regexp_full_match(surface, '[A-Z][a-z]+(?: [A-Z][a-z]+)+') END)),
    r AS (SELECT doc_id, surface FROM c WHERE kind = 'tribe')
    SELECT * FROM p UNION ALL SELECT * FROM c WHERE kind = 'tribe' UNION ALL SELECT * FROM (SELECT * FROM c WHERE kind = 'organization' UNION ALL SELECT * FROM g) x WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.doc_id = x.doc_id AND r.surface = x.surface)"""


@query(_FLAGS.format(candidates=KNOWN["q_entity_candidates"], stop=", ".join(f"'{w}'" for w in extract.STOP_WORDS)))
def q_entities(spark, sf_dir):
    """Entities of the documents that patterns propose and the gazetteer accepts."""
    look = _lookups(spark, sf_dir)
    return extract.entities(table(spark, sf_dir, "documents"), look.first, look.last, look.tribal, look.general, look.ambiguous)


@query(
    f"""SELECT doc_id, count(DISTINCT CASE WHEN kind = 'person' THEN surface END) AS persons, count(DISTINCT CASE WHEN kind = 'organization' THEN surface END) AS organizations,
    count(DISTINCT CASE WHEN kind = 'location' THEN surface END) AS locations, count(DISTINCT CASE WHEN kind = 'tribe' THEN surface END) AS tribes FROM ({KNOWN["q_entity_candidates"]}) GROUP BY 1"""
)
def q_entity_counts(spark, sf_dir):
    return reports.entity_counts(extract.candidates(table(spark, sf_dir, "documents")).withColumn("code", F.col("surface")))


@query(f"SELECT source_file, kind, name, kind || '_' || row_number() OVER (PARTITION BY source_file, kind ORDER BY first, name) AS code FROM (SELECT source_file, substring(tag_category, 8) AS kind, matched_text AS name, min(tag_id) AS first FROM {_TAGS} WHERE tag_category IN ('ENTITY_Organization', 'ENTITY_Place', 'ENTITY_Tribe') AND matched_text IS NOT NULL GROUP BY 1, 2, 3)")
def q_numbered_codes(spark, sf_dir):
    tags = _tags(spark, sf_dir).where("tag_category in ('ENTITY_Organization', 'ENTITY_Place', 'ENTITY_Tribe') and matched_text is not null")
    first = tags.groupBy("source_file", F.substring_index("tag_category", "_", -1).alias("kind"), F.col("matched_text").alias("name")).agg(F.min("tag_id").alias("first"))
    return redact.numbered_codes(first, "source_file", F.col("kind"), "first", "name").drop("first")


@query(f"""SELECT source_file, f AS first_name, arg_min(name, (-length(name), name)) AS code FROM (SELECT DISTINCT source_file, matched_text AS name, string_split(matched_text, ' ')[1] AS f FROM {_TAGS} WHERE tag_category = 'ENTITY_Person' AND matched_text IS NOT NULL) GROUP BY 1, 2""")
def q_first_seen_code(spark, sf_dir):
    people = _tags(spark, sf_dir).where("tag_category = 'ENTITY_Person' and matched_text is not null").select("source_file", F.col("matched_text").alias("name")).distinct()
    return redact.first_seen_code(people.withColumn("code", F.col("name")), "source_file")


_LABEL = r"^([A-Z][A-Za-z_]*(?: ?[A-Za-z0-9]+){0,2}):\s+(.*)$"


@query(rf"""SELECT doc_id, line_no, CASE WHEN regexp_matches(line, '{_LABEL}') THEN regexp_extract(line, '{_LABEL}', 1) || ': ' || regexp_extract(line, '{_LABEL}', 2) ELSE 'Speaker: ' || trim(line, ' ') END AS line FROM {_LINES} WHERE NOT regexp_full_match(line, '\s*[0-9]*\s*')""")
def q_dialogue_lines(spark, sf_dir):
    return lines.dialogue_lines(_documents(spark, sf_dir))


@query(f"""WITH v AS ({KNOWN["q_verses"]}), r AS (SELECT doc_id, page, CAST(line_no AS DOUBLE) AS at, concat_ws(' ', citation, body) AS line FROM v UNION ALL SELECT doc_id, page, min(line_no) - 0.5, 'Page ' || page FROM v GROUP BY 1, 2)
    SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY page, r.at) AS position, line FROM r""")
def q_render_verses(spark, sf_dir):
    return lines.render_verses(lines.cite(lines.speaker_lines(_documents(spark, sf_dir))))


@query(f"""WITH v AS {_CITED} SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY letter, verse) AS position, rpad(citation, 15, ' ') || rpad(ts, 12, ' ') || speaker AS row FROM v WHERE ts IS NOT NULL
    UNION ALL SELECT doc_id, 1, '{lines.NO_TIMES}' FROM v GROUP BY doc_id HAVING count(ts) = 0""")
def q_full_reference_table(spark, sf_dir):
    return lines.full_reference_table(_timed(spark, sf_dir))


@query(rf"SELECT DISTINCT doc_id, speaker FROM ({KNOWN['q_verses']})")
def q_speakers(spark, sf_dir):
    return lines.speakers(_documents(spark, sf_dir))


@query(f"""SELECT doc_id, line_no, CASE WHEN regexp_matches(line, '(?i)honey|wool') THEN regexp_replace(regexp_replace(line, '(?i)\\bsweetgrass\\b', 'sweet grass', 'g'), '(?i)\\bweir\\b', 'fish weir', 'g') ELSE line END AS line FROM {_LINES}""")
def q_fix_terms(spark, sf_dir):
    return _documents(spark, sf_dir).withColumn("line", redact.fix_terms(F.col("line"), ["honey", "wool"], {"sweetgrass": "sweet grass", "weir": "fish weir"}))


@query(
    r"""WITH v AS (SELECT DISTINCT lower(trim(tribal_affiliation)) AS t FROM place_names WHERE trim(tribal_affiliation) <> ''), terms AS (SELECT t FROM v UNION SELECT p FROM (SELECT trim(unnest(regexp_split_to_array(t, '\s*[/,;&]\s*|\s+and\s+'))) AS p FROM v) WHERE length(p) >= 3),
    x AS (SELECT id, lower(trim(tribe_origin)) AS t FROM native_american_names UNION ALL SELECT id, trim(unnest(regexp_split_to_array(lower(tribe_origin), '\s*[/,;&]\s*|\s+and\s+'))) FROM native_american_names)
    SELECT id, tribe_origin, id IN (SELECT id FROM x WHERE t IN (SELECT t FROM terms)) AS tribe_term FROM native_american_names"""
)
def q_is_tribe_term(spark, sf_dir):
    terms = gazetteer.tribe_terms([(table(spark, sf_dir, "place_names"), "tribal_affiliation")])
    return extract.is_tribe_term(F.col("tribe_origin"), terms, table(spark, sf_dir, "native_american_names").select("id", "tribe_origin"))


# ---- sources and sinks


def _docx(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents as .docx files: (path, content)."""
    for batch in batches:
        content = []
        for text in batch["text"]:
            body = "".join(f"<w:p><w:r><w:t>{_escaped(p)}</w:t></w:r></w:p>" for p in (text or "").split("\n"))
            buffer = BytesIO()
            with zipfile.ZipFile(buffer, "w") as archive:
                archive.writestr("word/document.xml", f'<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body>{body}</w:body></w:document>')
            content.append(buffer.getvalue())
        yield pd.DataFrame({"path": "/in/" + batch["doc_id"].astype(str) + ".docx", "content": content})


def _escaped(text: str) -> str:
    return "".join(c for c in text if c >= " " or c == "\t").replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")


@query(r"""SELECT CAST(quote_id AS VARCHAR) AS doc_id, quote_id || '.docx' AS source_file, array_to_string(list_filter(string_split(regexp_replace(quote, '\r', '', 'g'), chr(10)), lambda p: trim(p) <> ''), chr(10)) AS raw_text FROM interview_quotes WHERE quote IS NOT NULL""")
def q_read_docx(spark, sf_dir):
    """Quotes written as .docx files and read back."""
    quotes = table(spark, sf_dir, "interview_quotes").where("quote is not null").select(F.col("quote_id").alias("doc_id"), F.col("quote").alias("text"))
    return files.parse_transcripts(quotes.mapInPandas(_docx, "path string, content binary"))


@query("SELECT CAST(quote_id AS VARCHAR) AS doc_id, quote_id || '.txt' AS source_file, quote AS raw_text, row_number() OVER (ORDER BY quote_id || '.txt') AS position FROM interview_quotes WHERE quote IS NOT NULL AND NOT contains(quote_id || '.txt', '77')")
def q_read_texts(spark, sf_dir):
    """Quotes as text files, in the order of their names, without those whose name holds 77."""
    quotes = table(spark, sf_dir, "interview_quotes").where("quote is not null")
    packed = quotes.select(F.concat(F.lit("/in/"), F.col("quote_id").cast("string"), F.lit(".txt")).alias("path"), F.encode("quote", "UTF-8").alias("content"))
    return files.in_file_order(files.parse_transcripts(packed), without=["77"])


def _dbf(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Places as DBF tables, one per batch: (path, content); every record of an odd id is marked deleted."""
    widths = [("NAME", 120), ("NAMELSAD", 120), ("PLACEID", 12)]
    for batch in batches:
        head = struct.pack("<B3xIHH20x", 3, len(batch), 32 + 32 * len(widths) + 1, 1 + sum(n for _, n in widths))
        head += b"".join(n.encode().ljust(11, b"\0") + b"C" + bytes(4) + bytes([s]) + bytes(15) for n, s in widths) + b"\r"
        rows = []
        for key, name, kind in zip(batch["id"], batch["name"], batch["place_type"], strict=True):
            values = (name, f"{name} {kind}" if kind == "village" else name.upper(), str(key))
            rows.append((b"*" if key % 2 else b" ") + b"".join(v.encode().ljust(s) for v, (_, s) in zip(values, widths, strict=True)))
        packed = BytesIO()
        with zipfile.ZipFile(packed, "w") as archive:
            archive.writestr("layer.dbf", head + b"".join(rows))
        yield pd.DataFrame({"path": [f"/in/layer{batch['id'].iloc[0]}.zip"], "content": [packed.getvalue()]})


@query("""WITH p AS (SELECT trim(name) AS name, place_type FROM place_names WHERE trim(name) <> '' AND id % 2 = 0) SELECT name, 'layer' AS type, count(*) AS n FROM (SELECT name FROM p UNION ALL SELECT name || ' village' FROM p WHERE place_type = 'village') GROUP BY 1""")
def q_read_dbf(spark, sf_dir):
    """Places written as zipped DBF tables and read back as a boundary layer."""
    places = table(spark, sf_dir, "place_names").where("trim(name) <> ''").select("id", F.trim("name").alias("name"), "place_type")
    records = files.parse_dbf_files(places.mapInPandas(_dbf, "path string, content binary"))
    return files.layer_places(records, "layer", "boundaries").groupBy("name", "type").agg(F.count("*").alias("n"))


@query("""SELECT name, place_type AS type, CAST(NULL AS VARCHAR) AS tribe, coalesce(state, '') AS state, 'gazetteer' AS source, count(*) AS n FROM place_names
    WHERE name IS NOT NULL AND NOT contains(name, '|') AND NOT contains(name, chr(10)) AND NOT contains(name, chr(13)) AND (lower(place_type) IN ('village', 'creek') OR contains(lower(name), 'landing')) GROUP BY 1, 2, 3, 4, 5""")
def q_read_pipe_places(spark, sf_dir):
    """Places written as pipe-delimited text and read back by class or name, letter case aside."""
    places = table(spark, sf_dir, "place_names").where(~F.col("name").rlike(r"[|\n\r]"))
    path = _written(places.select(F.concat_ws("|", F.col("id").cast("string"), "name", F.coalesce("place_type", F.lit("")), F.coalesce("state", F.lit("")), F.lit("x"))), "pipe")
    rows = files.read_pipe_places(spark, path, ["village", "creek"], name_words=["landing"], ignore_case=True)
    return rows.groupBy("name", "type", "tribe", "state", "source").agg(F.count("*").alias("n"))


@query("""SELECT upper(name[1]) || lower(name[2:]) AS name, sum(n) AS total FROM (SELECT lower(first_name) AS name, count(*) AS n FROM native_american_names WHERE regexp_full_match(first_name, '[A-Za-z]+') AND gender IS NOT NULL GROUP BY 1) GROUP BY 1""")
def q_read_name_counts(spark, sf_dir):
    """First names by sex and year of loading, written as yearly files and summed again."""
    names = table(spark, sf_dir, "native_american_names").where("first_name rlike '^[A-Za-z]+$' and gender is not null")
    counts = names.groupBy("first_name", "gender", F.year("loaded_at").alias("y")).agg(F.count("*").alias("n"))
    return files.read_name_counts(spark, _written(counts.select(F.concat_ws(",", "first_name", "gender", F.col("n").cast("string"))), "years"))


@query("""SELECT upper(n[1]) || lower(n[2:]) AS name, row_number() OVER (ORDER BY upper(n[1]) || lower(n[2:])) AS frequency_rank FROM (SELECT DISTINCT lower(last_name) AS n FROM native_american_names WHERE regexp_full_match(last_name, '[A-Za-z]+'))""")
def q_read_distribution(spark, sf_dir):
    """Last names written as a distribution file and ranked by name."""
    names = table(spark, sf_dir, "native_american_names").where("last_name rlike '^[A-Za-z]+$'").groupBy("last_name").agg(F.count("*").alias("n"))
    return files.read_name_distribution(spark, _written(names.select(F.concat_ws("  ", F.upper("last_name"), F.col("n").cast("string"))), "dist"), alphabetical=True)


@query("""SELECT upper(n[1]) || lower(n[2:]) AS name, count(*) AS n FROM (SELECT last_name AS n FROM native_american_names WHERE regexp_full_match(last_name, '[A-Za-z]+')) GROUP BY 1""")
def q_name_presence(spark, sf_dir):
    names = table(spark, sf_dir, "native_american_names").where("last_name rlike '^[A-Za-z]+$'")
    return files.name_presence(spark, _written(names.select(F.concat(F.upper("last_name"), F.lit(" 1"))), "presence"))


@query("""SELECT upper(n[1]) || lower(n[2:]) AS name, row_number() OVER (ORDER BY c DESC, n) AS frequency_rank FROM (SELECT last_name AS n, count(*) AS c FROM native_american_names WHERE regexp_full_match(last_name, '[A-Z][a-z]+') GROUP BY 1)""")
def q_read_surnames(spark, sf_dir):
    """Last names by frequency as a CSV file with a header, ranked by the order of the file."""
    names = table(spark, sf_dir, "native_american_names").where("last_name rlike '^[A-Z][a-z]+$'").groupBy("last_name").agg(F.count("*").alias("n"))
    path = _scratch(spark, "surnames")
    names.orderBy(F.desc("n"), "last_name").select(F.upper("last_name").alias("NAME"), "n").coalesce(1).write.csv(path, header=True)
    return files.read_surnames(spark, path)


@query("""SELECT DISTINCT name, place_type AS type, CAST(NULL AS VARCHAR) AS tribe, state, 'linked' AS source FROM place_names WHERE name IS NOT NULL AND (contains(lower(place_type), 'village') OR contains(lower(place_type), 'creek'))""")
def q_read_sparql(spark, sf_dir):
    """Places as SPARQL answers, state bound only where known, filtered by class."""
    places = table(spark, sf_dir, "place_names").where("name is not null and place_type is not null")
    value = lambda c: F.struct(F.col(c).alias("value"))
    binding = F.struct(value("name").alias("name"), value("place_type").alias("class"), F.when(F.col("state").isNotNull(), value("state")).alias("state"))
    answers = places.groupBy(F.pmod("id", F.lit(50))).agg(F.to_json(F.struct(F.struct(F.collect_list(binding).alias("bindings")).alias("results"))).alias("value"))
    return files.sparql_places(files.parse_sparql(answers), ["village", "creek"], "linked")


@query("""SELECT DISTINCT w[1] AS first_name, w[len(w)] AS last_name, tribe_origin, 'linked' AS source FROM (SELECT regexp_split_to_array(trim(first_name || ' ' || last_name), '\\s+') AS w, tribe_origin FROM native_american_names WHERE first_name IS NOT NULL AND last_name IS NOT NULL) WHERE len(w) >= 2""")
def q_read_people(spark, sf_dir):
    """People as SPARQL answers with labels, split to first and last word."""
    people = table(spark, sf_dir, "native_american_names").where("first_name is not null and last_name is not null")
    value = lambda c: F.struct(c.alias("value"))
    binding = F.struct(value(F.concat_ws(" ", "first_name", "last_name")).alias("label"), F.when(F.col("tribe_origin").isNotNull(), value(F.col("tribe_origin"))).alias("tribe"))
    answers = people.select(F.to_json(F.struct(F.struct(F.array(binding).alias("bindings")).alias("results"))).alias("value"))
    return files.sparql_people(files.parse_sparql(answers), "linked")


@query("SELECT id, name FROM place_names WHERE name IS NOT NULL")
def q_read_features(spark, sf_dir):
    """Places as feature answers of a map service."""
    places = table(spark, sf_dir, "place_names").where("name is not null")
    attributes = F.struct(F.struct(F.col("id").cast("string").alias("ID"), F.col("name").alias("NAME")).alias("attributes"))
    answers = places.groupBy(F.pmod("id", F.lit(50))).agg(F.to_json(F.struct(F.collect_list(attributes).alias("features"))).alias("value"))
    a = F.col("attributes")
    return files.parse_features(answers).select(a["ID"].cast("long").alias("id"), a["NAME"].alias("name"))


RULES = [("title", "minutes|notes", 5), ("title", "oral", 3), ("format", "^(zip|txt)$", 4), ("publisher", "co-?op", 2), ("title", "crawl", -6)]


@query("""SELECT source AS title, coop AS publisher, lang AS format, CAST(doc_id AS VARCHAR) AS url, CAST(coalesce(5 * CAST(regexp_matches(source, '(?i)minutes|notes') AS INT), 0) + coalesce(3 * CAST(regexp_matches(source, '(?i)oral') AS INT), 0) + coalesce(4 * CAST(regexp_matches(lang, '(?i)^(zip|txt)$') AS INT), 0)
    + coalesce(2 * CAST(regexp_matches(coop, '(?i)co-?op') AS INT), 0) - coalesce(6 * CAST(regexp_matches(source, '(?i)crawl') AS INT), 0) AS DOUBLE) AS score FROM documents WHERE source IS NOT NULL ORDER BY score DESC, url LIMIT 1""")
def q_best_package(spark, sf_dir):
    """Documents as the packages of a catalogue; the best one by a table of rules."""
    documents = table(spark, sf_dir, "documents").where("source is not null")
    resource = F.struct(F.col("lang").alias("format"), F.col("doc_id").cast("string").alias("url"))
    package = F.struct(F.col("source").alias("title"), F.struct(F.col("coop").alias("title")).alias("organization"), F.array(resource).alias("resources"))
    answers = documents.select(F.to_json(F.struct(F.struct(F.array(package).alias("results")).alias("result"))).alias("value"))
    return files.best_package(files.parse_packages(answers), RULES)


@query("""WITH n AS (SELECT ref_id, name, row_number() OVER (ORDER BY ref_id) AS k FROM canonical_names WHERE kind = 'affiliation'), p AS (SELECT name, min(state) AS state FROM canonical_names WHERE kind = 'place' AND state IS NOT NULL GROUP BY 1)
    SELECT lower(n.name) AS name_lc, n.ref_id AS id FROM n""")
def q_read_details(spark, sf_dir):
    """Nations as detail answers: their own names come back under their own ids."""
    nations = table(spark, sf_dir, "canonical_names").where("kind = 'affiliation'")
    detail = F.struct(F.col("ref_id").alias("epaTribalInternalId"), F.col("name").alias("currentName"), F.array(F.struct(F.col("name"))).alias("names"), F.array(F.struct(F.col("state").alias("stateName"), F.lit("R1").alias("epaRegionName"))).alias("epaLocations"))
    rows = files.parse_details(nations.select(F.to_json(detail).alias("value")))
    return rows.where("name = tribe").select(F.lower("name").alias("name_lc"), "id")


@query("""WITH RECURSIVE e AS (SELECT o_orderkey AS c, o_orderkey // 2 AS p FROM orders), r AS (SELECT CAST(32 AS BIGINT) AS class UNION SELECT e.c FROM e JOIN r ON e.p = r.class) SELECT CAST(class AS VARCHAR) AS class FROM r""")
def q_subclasses(spark, sf_dir):
    """The orders whose halved keys lead to order 32: a closure over parents."""
    edges = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("class"), F.expr("o_orderkey div 2").cast("string").alias("parent"))
    return files.subclasses(edges, "32")


@query("SELECT matrix_no, metric_code, question, answer_1 FROM human_readable_matrix")
def q_read_csv(spark, sf_dir):
    """The matrix written as CSV with quotes and read back by name; NULL and '' differ in the file."""
    path = _scratch(spark, "csv")
    table(spark, sf_dir, "human_readable_matrix").select("matrix_no", "metric_code", "question", "answer_1").write.csv(path, header=True, quoteAll=True, escape='"', nullValue="\\N", emptyValue="")
    rows = spark.read.csv(path, header=True, multiLine=True, escape='"', nullValue="\\N", emptyValue="")
    return rows.select(F.col("matrix_no").cast("long").alias("matrix_no"), "metric_code", "question", "answer_1")


@query("""SELECT CAST(row_number() OVER (ORDER BY quote_id) AS BIGINT) AS row_idx, CAST(quote_id AS VARCHAR) AS c0, question AS c1 FROM interview_quotes WHERE question IS NOT NULL UNION ALL SELECT 0, 'quote_id', 'question'""")
def q_read_csv_positional(spark, sf_dir):
    """Quotes as one CSV file, read by position with its header as row 0."""
    path = _scratch(spark, "rows")
    table(spark, sf_dir, "interview_quotes").where("question is not null").select("quote_id", "question").orderBy("quote_id").coalesce(1).write.csv(path, header=True, escape='"')
    return files.read_csv_positional(spark, path).select("row_idx", F.col("_c0").alias("c0"), F.col("_c1").alias("c1"))


@query(f"SELECT tag_category AS Tag_Category, CAST(line_number AS VARCHAR) AS Line_Number, matched_text AS Matched_Text, count(*) AS n FROM {_TAGS} WHERE line_number IS NOT NULL AND trim(matched_text) <> '' GROUP BY 1, 2, 3")
def q_write_tags(spark, sf_dir):
    """Tags written as the four-column CSV and read back."""
    tags = _tags(spark, sf_dir).where("line_number is not null and trim(matched_text) <> ''")
    path = _scratch(spark, "tags")
    sinks.write_tags(tags.select(F.col("tag_category").alias("category"), F.col("line_number").alias("line_no"), F.col("matched_text").alias("matched"), "context"), path)
    return files.read_csv_named(spark, path).groupBy("Tag_Category", "Line_Number", "Matched_Text").agg(F.count("*").alias("n"))


@query(f"SELECT source_file, matched_text AS surface, lower(matched_text) AS code FROM {_TAGS} WHERE tag_category = 'ENTITY_Person' AND matched_text IS NOT NULL GROUP BY 1, 2, 3")
def q_write_mapping(spark, sf_dir):
    """Mappings of the sessions written as JSON, read back and unfolded."""
    tags = _tags(spark, sf_dir).where("tag_category = 'ENTITY_Person' and matched_text is not null")
    codes = tags.select("source_file", F.lit("person").alias("kind"), F.col("matched_text").alias("surface"), F.lower("matched_text").alias("code")).distinct()
    variants = codes.select("source_file", F.lower("surface").alias("canonical"), "surface")
    citations = tags.select("source_file", F.format_string("[A.%d]", "tag_id").alias("citation"), F.lit(None).cast("string").alias("ts"), F.lit("Narrative").alias("speaker"))
    path = _scratch(spark, "mapping")
    sinks.write_json(sinks.mapping_rows(codes, variants, citations, "source_file"), path)
    back = files.read_mapping(spark, path, lines=True)
    return back.select("source_file", F.explode("persons").alias("surface", "code"))


# ---- the gazetteer

_KEYED = "QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY source_no, {rest}) = 1"


@query(
    """WITH u AS (SELECT name, coalesce(place_type, 'unknown') AS type, state, tribal_affiliation, source, 0 AS source_no FROM place_names UNION ALL SELECT name, 'reference', state, NULL, 'reference', 1 FROM canonical_names WHERE kind = 'place')
    SELECT name, type, state, tribal_affiliation, source FROM u WHERE name IS NOT NULL QUALIFY row_number() OVER (PARTITION BY lower(name), lower(type), lower(state) ORDER BY source_no, name, type, state NULLS FIRST, tribal_affiliation NULLS FIRST, source NULLS FIRST) = 1"""
)
def q_build_places(spark, sf_dir):
    places = table(spark, sf_dir, "place_names").withColumn("type", F.coalesce("place_type", F.lit("unknown")))
    known = table(spark, sf_dir, "canonical_names").where("kind = 'place'").withColumns({"type": F.lit("reference"), "source": F.lit("reference")})
    return gazetteer.build_table("place_names", [places, known])[0]


@query("SELECT first_name, last_name, gender, tribe_origin, source FROM native_american_names WHERE first_name IS NULL")
def q_build_rejects(spark, sf_dir):
    """Rows of the rolls that have no first name: rejected, not lost."""
    return gazetteer.build_table("native_american_names", [table(spark, sf_dir, "native_american_names")])[1]


_COMMON = """SELECT first_name AS name, row_number() OVER (ORDER BY count(*) DESC, first_name) AS rank FROM native_american_names WHERE first_name IS NOT NULL GROUP BY 1"""


@query(
    f"""SELECT 'place_names' AS table_name, count(*) AS n_rows FROM (SELECT DISTINCT lower(name), lower(coalesce(place_type, 'unknown')), lower(state) FROM place_names WHERE name IS NOT NULL)
    UNION ALL SELECT 'native_american_names', count(*) FROM (SELECT DISTINCT lower(first_name), lower(last_name) FROM native_american_names WHERE first_name IS NOT NULL)
    UNION ALL SELECT 'tribal_place_names', count(*) FROM (SELECT DISTINCT lower(name), lower(tribal_affiliation) FROM place_names WHERE name IS NOT NULL AND trim(tribal_affiliation) <> '')
    UNION ALL SELECT 'ambiguous_names', count(*) FROM (SELECT DISTINCT lower(name) FROM place_names WHERE name IN (SELECT last_name FROM native_american_names))
    UNION ALL SELECT 'common_first_names', count(DISTINCT lower(first_name)) FROM native_american_names
    UNION ALL SELECT 'common_last_names', count(DISTINCT lower(last_name)) FROM native_american_names
    UNION ALL SELECT 'tribes', count(*) FROM ({KNOWN["q_tribe_terms"]})"""
)
def q_build_gazetteer(spark, sf_dir):
    """All lookup tables built from the driver's tables, counted."""
    places, names = table(spark, sf_dir, "place_names"), table(spark, sf_dir, "native_american_names")
    typed = places.withColumn("type", F.coalesce("place_type", F.lit("unknown")))
    last = names.select(F.col("last_name").alias("name")).where("name is not null").distinct()
    both = places.select("name").where("name is not null").join(last, "name", "left_semi").withColumn("is_primarily_place", F.lit(True))
    ranked = lambda c: gazetteer.frequency_rank(names.where(F.col(c).isNotNull()).withColumn("one", F.lit(1)), c, "one").withColumnRenamed(c, "name").withColumn("source", F.lit("rolls"))
    nothing = spark.createDataFrame([], "name string, frequency_rank long, source string")
    tribal = typed.where("trim(tribal_affiliation) <> ''").withColumns({"tribe": F.col("tribal_affiliation"), "type": F.lit("place")})
    tables, _ = gazetteer.build_gazetteer([names], [typed], [tribal], [both], [nothing, ranked("first_name")], [ranked("last_name")], [(places, "tribal_affiliation"), (names, "tribe_origin")])
    return gazetteer.with_totals(tables).where("table_name is not null")


@query(f"SELECT name FROM ({_COMMON}) WHERE rank <= 200 UNION ALL SELECT DISTINCT first_name FROM native_american_names WHERE first_name IS NOT NULL")
def q_frequent_and_native(spark, sf_dir):
    names = table(spark, sf_dir, "native_american_names").where("first_name is not null").withColumn("one", F.lit(1))
    return gazetteer.frequent_and_native(gazetteer.top_ranked(names, "first_name", "one"), names.select("first_name").distinct(), "first_name")


@query(r"""SELECT ref_id, place FROM (SELECT ref_id, unnest(list_distinct(list_concat(regexp_extract_all(name, '((?:[A-Z][\w''-]*(?: [A-Z][\w''-]*)*)) (?:Reservation|Rancheria|Pueblo|Colony|Community|Village)(?:[^\w]|$)', 1), regexp_extract_all(name, ' of (?:the )?((?:[A-Z][\w''-]*(?: [A-Z][\w''-]*)*))', 1)))) AS place FROM canonical_names WHERE kind = 'affiliation')""")
def q_places_in_names(spark, sf_dir):
    known = table(spark, sf_dir, "canonical_names").where("kind = 'affiliation'")
    return known.select("ref_id", F.explode(gazetteer.places_in_name(F.col("name"))).alias("place"))


# ---- reports, survey rules, progress

SURVEY_RULES = {"Q1": survey.Rule(2, 1), "Q2": survey.Rule(3, 2, "LOW"), "Q5": survey.Rule(2, 1, "NONE", ("stories",)), "Q6": survey.Rule(4, 2, "LOW")}


def _rules_sql() -> str:
    parts = []
    for q, words in QUESTIONS.items():
        r = SURVEY_RULES.get(q, survey.Rule())
        hits = " + ".join(f"CAST(contains(lower(coalesce(text, '')), '{w}') AS BIGINT)" for w in words)
        decisive = " OR ".join(f"contains(lower(coalesce(text, '')), '{w}')" for w in r.decisive) or "false"
        parts.append(f"SELECT doc_id, '{q}' AS question, {hits} AS hits, CASE WHEN {decisive} OR {hits} >= {r.high} THEN 'HIGH' WHEN {hits} >= {r.medium} THEN 'MEDIUM' ELSE '{r.low}' END AS level FROM documents")
    return " UNION ALL ".join(parts)


@query(_rules_sql())
def q_survey_rules(spark, sf_dir):
    return survey.rule_levels(table(spark, sf_dir, "documents"), "doc_id", "text", QUESTIONS, SURVEY_RULES)


@query(rf"""SELECT doc_id, line_no, CASE WHEN regexp_matches(l, '^[0-9]+\.[0-9]+\.? +[^ ]') THEN 'subsection' WHEN regexp_matches(l, '^[0-9]+\. +[^ ]') THEN 'section' WHEN length(l) > 3 AND l = upper(l) AND regexp_matches(l, '[A-Z]') THEN 'heading'
    WHEN regexp_matches(l, '^[-*•] ') THEN 'bullet' ELSE 'body' END AS block, l AS line FROM (SELECT doc_id, line_no, trim(line, ' ') AS l FROM {_LINES}) WHERE l <> ''""")
def q_text_blocks(spark, sf_dir):
    return reports.text_blocks(_documents(spark, sf_dir))


@query("SELECT quote_id, replace(quote, '...', '…') AS shown, interview || ', excerpt ' || excerpt_num || CASE WHEN char_position IS NULL THEN '' ELSE ', character ' || char_position END AS note FROM interview_quotes")
def q_shown_quotes(spark, sf_dir):
    quotes = table(spark, sf_dir, "interview_quotes")
    return quotes.select("quote_id", reports.shown_quote(F.col("quote")).alias("shown"), reports.position_note(F.col("interview"), F.col("excerpt_num"), F.col("char_position")).alias("note"))


@query("SELECT matrix_no, metric_code, exported_at, CASE WHEN regexp_matches(lower(answer_1), 'not reported|unclear') THEN 'open' WHEN regexp_matches(lower(answer_1), 'yes|true') THEN 'good' ELSE 'plain' END AS shade FROM human_readable_matrix")
def q_highlight(spark, sf_dir):
    shade = reports.highlight(F.col("answer_1"), [("open", ["Not reported", "unclear"]), ("good", ["yes", "true"])])
    return table(spark, sf_dir, "human_readable_matrix").select("matrix_no", "metric_code", "exported_at", shade.alias("shade"))


@query(f"SELECT doc_id, line_no, line FROM {_LINES} l WHERE trim(line, ' ') <> '' QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY line_no DESC) = 1")
def q_last_line(spark, sf_dir):
    return reports.last_line(_documents(spark, sf_dir))


@query("""SELECT coop, arg_min(metric_code, evidence_id) AS metric_code, min(evidence_id) AS evidence_id FROM interview_evidence WHERE coop IS NOT NULL AND metric_value > 0 GROUP BY 1""")
def q_first_found(spark, sf_dir):
    rows = table(spark, sf_dir, "interview_evidence").where("coop is not null").select("coop", "metric_code", "evidence_id", "metric_value")
    return reports.first_found(rows, "coop", "evidence_id", F.col("metric_value") > 0).drop("metric_value")


@query("""SELECT source, doc_id, n_chars FROM documents WHERE source IS NOT NULL QUALIFY row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) = 1""")
def q_best_scored(spark, sf_dir):
    return reports.best_scored(table(spark, sf_dir, "documents").where("source is not null").select("source", "doc_id", "n_chars"), "source", "n_chars", "doc_id")


@query("""SELECT stem, '/raw/' || stem || '.docx' AS raw_path, '/out/' || stem || '_deidentified.txt' AS cleaned_path, CASE WHEN k % 2 = 0 THEN '/out/' || stem || '_mapping.json' END AS mapping_path, CASE WHEN k % 3 = 0 THEN '/out/' || stem || '_tags.csv' END AS tags_path
    FROM (SELECT DISTINCT 'session ' || doc_id AS stem, doc_id AS k FROM documents WHERE doc_id % 5 <> 0)""")
def q_join_by_stem(spark, sf_dir):
    """Files named after the documents: raw ones of all, cleaned ones of some, mappings and tags of fewer."""
    stem = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("session "), F.col("doc_id").cast("string")).alias("stem"))
    path = lambda df, form: df.select(F.format_string(form, "stem").alias("path"))
    cleaned, mapped, tagged = stem.where("doc_id % 5 <> 0"), stem.where("doc_id % 2 = 0"), stem.where("doc_id % 3 = 0")
    return reports.join_by_stem(path(stem, "/raw/%s.docx"), path(cleaned, "/out/%s_deidentified.txt"), path(mapped, "/out/%s_mapping.json"), path(tagged, "/out/%s_tags.csv"))


@query("""SELECT interview, question, excerpt_num, quote_id, row_number() OVER (PARTITION BY interview ORDER BY CASE question WHEN 'Q2' THEN 1 WHEN 'Q1' THEN 2 ELSE 3 END, question, excerpt_num, quote_id) AS position FROM interview_quotes""")
def q_quotes_in_order(spark, sf_dir):
    quotes = table(spark, sf_dir, "interview_quotes").select("interview", "question", "excerpt_num", "quote_id")
    return reports.in_order(quotes, "question", ["Q2", "Q1"], "interview", "excerpt_num", "quote_id")


@query("SELECT question, metric_code, answer_2, answer_3, answer_4, matrix_no FROM quantitative_interview_table")
def q_without_columns(spark, sf_dir):
    df = table(spark, sf_dir, "quantitative_interview_table").select("answer_1", "question", "metric_code", "answer_2", "answer_3", "answer_4", "exported_at", "matrix_no")
    return matrix.without_columns(df, [0, 6, 99])


_NO = "coalesce(trim({0}) IN ('', '-1', 'Not reported'), true)"
_EMPTY = " AND ".join(_NO.format(f"answer_{i}") for i in range(1, 5))


@query(f"""WITH m AS (SELECT CAST(matrix_no AS BIGINT) AS matrix_no, metric_code, category, CASE WHEN {_EMPTY} THEN 2 ELSE 0 END AS section FROM human_readable_matrix)
    SELECT * FROM m UNION ALL SELECT NULL, NULL, 'Not reported by any', 1 FROM (SELECT 1 FROM m WHERE section = 2 LIMIT 1)""")
def q_filtered_matrix(spark, sf_dir):
    df = table(spark, sf_dir, "human_readable_matrix")
    return matrix.filtered_matrix(df, [f"answer_{i}" for i in range(1, 5)], "category", ["matrix_no", "metric_code"]).select("matrix_no", "metric_code", "category", "section")


@query(f"""SELECT suggestion, count(*) AS documents FROM (SELECT CASE category {" ".join(f"WHEN '{c}' THEN '{t}'" for c, t in grading.SUGGESTIONS.items())} END AS suggestion, documents AS n FROM ({KNOWN["q_priorities"]})), range(n) GROUP BY 1""".replace(", range(n)", ", LATERAL (SELECT unnest(range(n)))"))
def q_top_suggestions(spark, sf_dir):
    return grading.top_suggestions(grading.category_grades(_graded(spark, sf_dir)))


@query("""WITH h AS (SELECT CAST(extract(hour FROM ts) AS BIGINT) AS hour, CAST(user_id AS VARCHAR) AS user_id, 100 - least(100, value) AS total FROM events), g AS (SELECT hour, round(avg(total), 6) AS mean_total, count(*) AS documents, bool_and(total >= 90) AS all_a FROM h GROUP BY 1)
    SELECT hour, mean_total, documents, all_a FROM g""")
def q_run_history(spark, sf_dir):
    """The events of each hour as the grades of an iteration."""
    events = table(spark, sf_dir, "events").select(F.hour("ts").cast("long").alias("hour"), (100 - F.least(F.lit(100.0), "value")).alias("total"))
    graded = events.withColumn("grade", scalars.letter_grade(F.col("total") / 100))
    return grading.run_history(graded, "hour").select("hour", F.round("mean_total", 6).alias("mean_total"), "documents", "all_a")


@query("""SELECT event_id, user_id, round(max(least(greatest(value / 100, 0), 1)) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 9) AS shown FROM events""")
def q_running_share(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", (F.col("value") / 100).alias("share"))
    return progress.running_share(events, "user_id", "event_id", "share").select("event_id", "user_id", F.round("shown", 9).alias("shown"))


@query("""SELECT user_id, round(sum(s * CASE event_type WHEN 'click' THEN 0.5 WHEN 'purchase' THEN 0.3 WHEN 'view' THEN 0.2 ELSE 0 END), 6) AS progress FROM (SELECT user_id, event_type, max(least(greatest(value / 100, 0), 1)) AS s FROM events GROUP BY 1, 2) GROUP BY 1""")
def q_weighted_progress(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_type", (F.col("value") / 100).alias("share"))
    return progress.weighted_progress(events, "user_id", "event_type", "share", {"click": 0.5, "purchase": 0.3, "view": 0.2}).select("user_id", F.round("progress", 6).alias("progress"))


@query("""SELECT CAST(user_id AS VARCHAR) AS job, arg_max(event_type, ts) AS phase, max(ts) < TIMESTAMP '2024-01-15' AS stale FROM events GROUP BY 1""")
def q_latest_status(spark, sf_dir):
    """Events as status records, written as JSON, read back, and the last of each job."""
    events = table(spark, sf_dir, "events")
    reported = events.select(F.col("user_id").cast("string").alias("job"), F.col("event_type").alias("phase"), F.col("event_id").alias("done"), F.lit(10_000_000).cast("long").alias("total"), F.abs("value").alias("seconds"), F.col("ts").alias("stamp"))
    path = _scratch(spark, "status")
    sinks.write_json(progress.status_rows(reported), path)
    return progress.latest_status(files.read_status(spark, path), F.to_timestamp(F.lit("2024-01-15 00:00:00")), 0.0).select("job", "phase", "stale")


@query("SELECT event_id, CASE WHEN done = 0 THEN NULL ELSE round((1000000 - done) * v / done, 6) END AS left_s, CASE WHEN done = 0 THEN '-' ELSE printf('%.2f%%', 100.0 * v / done) END AS rate FROM (SELECT event_id, event_id % 7 AS done, floor(abs(value)) AS v FROM events)")
def q_time_left(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", (F.col("event_id") % 7).alias("done"), F.floor(F.abs("value")).alias("v"))
    left = scalars.time_left(F.col("done"), F.lit(1_000_000), F.col("v"))
    return events.select("event_id", F.round(left, 6).alias("left_s"), scalars.percent(F.col("v"), F.col("done"), 2).alias("rate"))


@query(r"""SELECT doc_id, trim(regexp_replace(source || ' / ' || coalesce(lang, '?'), '[^A-Za-z0-9.-]+', '_', 'g'), '_') AS file_name, CASE WHEN doc_id % 3 = 0 THEN '1.' || doc_id || '.0' END AS version FROM documents""")
def q_file_names(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    manifest = F.when(F.col("doc_id") % 3 == 0, F.format_string("clean_text_v1.%d.0.py  current", "doc_id")).otherwise("# note")
    return documents.select("doc_id", scalars.file_name(F.concat("source", F.lit(" / "), F.coalesce("lang", F.lit("?")))).alias("file_name"), scalars.version_of(manifest, "clean_text").alias("version"))


@query("SELECT evidence_id, coop, metric_code, CAST(metric_value AS BIGINT) AS metric_value FROM interview_evidence")
def q_json_round_trip(spark, sf_dir):
    """Evidence encoded as JSON objects and decoded again."""
    rows = table(spark, sf_dir, "interview_evidence").select("evidence_id", scalars.as_json("coop", "metric_code", "metric_value").alias("j"))
    return rows.select("evidence_id", F.from_json("j", "coop string, metric_code string, metric_value long").alias("v")).select("evidence_id", "v.*")


@query(r"""WITH b AS (SELECT doc_id, regexp_split_to_array(regexp_replace(regexp_replace(text, '\r\n|[\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]', chr(10), 'g'), '\n$', ''), '\n') AS p FROM documents WHERE length(text) > 0)
    SELECT doc_id, unnest(range(1, len(p) + 1)) AS line_no, unnest(p) AS line FROM b""")
def q_split_any(spark, sf_dir):
    return lines.split_any(table(spark, sf_dir, "documents"))


@query()
def q_cluster_sizes(spark, sf_dir):
    """Clusters and variants of the people of each session."""
    people = _tags(spark, sf_dir).where("tag_category = 'ENTITY_Person'")
    return cluster.cluster_sizes(cluster.cluster_names(people, "source_file", "matched_text", "tag_id"), "source_file")


@query("SELECT interview AS doc_id, trim(question) AS stage, CAST(max(excerpt_num) AS BIGINT) AS done, CAST(40 AS BIGINT) AS total FROM interview_quotes WHERE interview IS NOT NULL AND question IS NOT NULL AND excerpt_num IS NOT NULL GROUP BY 1, 2")
def q_stage_markers(spark, sf_dir):
    """Quotes as a log that reports progress in stages."""
    quotes = table(spark, sf_dir, "interview_quotes")
    log = quotes.where("interview is not null and question is not null and excerpt_num is not null").select(F.col("interview").alias("doc_id"), F.format_string("PROGRESS: [%d/%d] %s", "excerpt_num", F.lit(40), "question").alias("line"))
    return progress.stage_markers(log)
