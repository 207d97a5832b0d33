"""Queries of the transcript-analytics operators over whole tables, each with equivalent SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sessionloom.functions import scalars
from sessionloom.operators import cluster, extract, gazetteer, grading, lines, matrix, redact, survey, tagging
from sessionloom.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

LEXICON = [
    ("Finance", "budget"), ("Finance", "grant"), ("Finance", "loan"), ("Governance", "board"), ("Governance", "bylaws"), ("Governance", "vote"),
    ("Membership", "members"), ("Membership", "household"), ("Culture", "elders"), ("Culture", "language"), ("Markets", "prices"), ("Technology", "web page"),
]
NEGATIVE = {"grant": r"(?i)grant writing", "language": r"(?i)language class"}
QUESTIONS = {
    "Q1": ["started", "first year", "years ago"], "Q2": ["grant", "budget", "loan", "reserve"], "Q3": ["web page", "flyer", "radio"],
    "Q4": ["members", "families", "household"], "Q5": ["elders", "language", "stories"], "Q6": ["board", "vote", "bylaws"],
}
HEADER = r"^(Agenda|Word list)"

_LINES = r"(SELECT doc_id, unnest(range(1, len(p) + 1)) AS line_no, unnest(p) AS line FROM (SELECT doc_id, regexp_split_to_array(text, '\r?\n') AS p FROM documents WHERE text IS NOT NULL))"
_BLANK = r"regexp_full_match(line, '\s*')"


def query(sql: str | None = None):
    """Register a query under its name, with its SQL."""

    def add(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLE[function.__name__] = sql
        return function

    return add


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.split_lines(table(spark, sf_dir, "documents"))


@query(f"SELECT * FROM {_LINES}")
def q_lines_split(spark, sf_dir):
    return _documents(spark, sf_dir)


@query(
    rf"""SELECT doc_id, line_no, line FROM (SELECT *, max(CASE WHEN regexp_matches(line, '{HEADER}') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS seen FROM {_LINES})
    WHERE seen = 0 AND NOT {_BLANK} AND NOT regexp_full_match(line, '\s*Page [0-9]+\s*') AND NOT regexp_full_match(line, '\s*[=-]{{10,}}\s*')"""
)
def q_lines_taggable(spark, sf_dir):
    return lines.taggable_lines(_documents(spark, sf_dir), HEADER)


def _word(keyword: str) -> str:
    return r"(?i)\b" + r"\s+".join(keyword.split()) + r"\b"


REQUIRED = {"budget": r"(?i)year|month|spend|spent|income", "members": r"(?i)[0-9]|vote|famil"}


def _hits_sql(negative: bool, lexicon=LEXICON, required: bool = False) -> str:
    """Every match by position; one that its window of 30 characters rules out doesn't count."""
    parts = []
    for category, keyword in lexicon:
        view = "substring(line, greatest(pos - 30, 1), pos + n + 30 - greatest(pos - 30, 1))"
        shown = "substring(line, greatest(pos - 50, 1), pos + n + 50 - greatest(pos - 50, 1))"
        wanted = f" WHERE NOT regexp_matches({view}, '{NEGATIVE[keyword]}')" if negative and keyword in NEGATIVE else f" WHERE regexp_matches({view}, '{REQUIRED[keyword]}')" if required and keyword in REQUIRED else ""
        parts.append(
            f"""SELECT doc_id, line_no, '{category}' AS category, '{keyword}' AS keyword, count(*) AS hits, arg_min({shown}, pos) AS context FROM (
            SELECT doc_id, line_no, line, length(x[i]) AS n, CAST(list_sum(list_transform(p[1:i], lambda z: length(z))) + coalesce(list_sum(list_transform(x[1:i - 1], lambda z: length(z))), 0) + 1 AS BIGINT) AS pos
            FROM (SELECT *, unnest(range(1, len(x) + 1)) AS i FROM (SELECT doc_id, line_no, line, regexp_split_to_array(line, '{_word(keyword)}') AS p, regexp_extract_all(line, '{_word(keyword)}') AS x FROM l WHERE regexp_matches(line, '{_word(keyword)}'))))
            {wanted} GROUP BY 1, 2"""
        )
    return f"WITH l AS MATERIALIZED (SELECT * FROM {_LINES}) " + " UNION ALL ".join(parts)


@query(_hits_sql(True))
def q_lexicon_tags(spark, sf_dir):
    return tagging.lexicon_hits(_documents(spark, sf_dir), LEXICON, NEGATIVE).drop("line")


@query(_hits_sql(False, required=True))
def q_required_context(spark, sf_dir):
    """As q_lexicon_tags, with what must stand near a keyword instead of what must not."""
    return tagging.lexicon_hits(_documents(spark, sf_dir), LEXICON, required=REQUIRED).drop("line")


@query(f"SELECT category, count(*) AS tags FROM ({_hits_sql(False)}) GROUP BY ROLLUP (category)")
def q_lexicon_rollup(spark, sf_dir):
    return tagging.tag_counts(tagging.lexicon_hits(_documents(spark, sf_dir), LEXICON))


_METRIC_SQL = rf"""SELECT doc_id, line_no, 'METRIC_' || upper(x[1]) || x[2:] AS metric, v AS value FROM (
      SELECT doc_id, line_no, regexp_extract(lower(m), '(member|employee|partner|grant)', 1) AS x, CAST(regexp_extract(m, '([0-9]+)', 1) AS DOUBLE) AS v
      FROM (SELECT doc_id, line_no, unnest(regexp_extract_all(line, '(?i)\b([0-9]+)\s+(members?|employees?|partners?|grants?)\b')) AS m FROM {_LINES}))
    UNION ALL SELECT doc_id, line_no, 'METRIC_Dollar', v FROM (SELECT doc_id, line_no, TRY_CAST(replace(m, ',', '') AS DOUBLE) AS v
      FROM (SELECT doc_id, line_no, unnest(regexp_extract_all(line, '\$([0-9]+(?:,[0-9]+)*(?:\.[0-9]+)?)', 1)) AS m FROM {_LINES})) WHERE v IS NULL OR v >= 1000"""


@query(_METRIC_SQL)
def q_metric_tags(spark, sf_dir):
    return tagging.metric_tags(_documents(spark, sf_dir))


_DIALOGUE = r"""SELECT doc_id, line_no, CASE WHEN regexp_matches(line, '^#[A-Z]+\b') THEN 'code' WHEN regexp_matches(line, '^[A-Z]{1,3}\. ') THEN 'letter' WHEN regexp_matches(line, '^\[[A-Z]+\.[0-9]+\]') THEN 'verse' END AS dialogue FROM __L__""".replace("__L__", _LINES)
_SEED = f"(SELECT doc_id, line_no FROM ({_METRIC_SQL}) UNION SELECT doc_id, line_no FROM ({_DIALOGUE}) WHERE dialogue IS NOT NULL)"
_CASCADE = rf"""WITH seed AS {_SEED}, filled AS (SELECT l.*, s.line_no IS NOT NULL AS seed FROM {_LINES} l LEFT JOIN seed s USING (doc_id, line_no) WHERE NOT {_BLANK}),
    gaps AS (SELECT *, line_no - lag(line_no) OVER (PARTITION BY doc_id ORDER BY line_no) AS gap FROM filled),
    isl AS (SELECT *, sum(CASE WHEN gap > 2 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS island FROM gaps)
    SELECT doc_id, line_no FROM (SELECT *, max(CASE WHEN seed THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, island ORDER BY line_no RANGE BETWEEN UNBOUNDED PRECEDING AND 2 FOLLOWING) AS near FROM isl) WHERE near = 1 AND NOT seed"""


@query(_CASCADE)
def q_context_cascade(spark, sf_dir):
    return tagging.context_cascade(_documents(spark, sf_dir), tagging.is_seed(F.col("line")))


@query(f"SELECT doc_id, line_no, dialogue FROM ({_DIALOGUE}) d WHERE dialogue IS NOT NULL AND NOT EXISTS (SELECT 1 FROM ({_METRIC_SQL}) m WHERE m.doc_id = d.doc_id AND m.line_no = d.line_no)")
def q_dialogue_tags(spark, sf_dir):
    rows = _documents(spark, sf_dir)
    return tagging.dialogue_tags(rows, tagging.metric_tags(rows))


QUESTION_WORDS = [("Q2", "grant"), ("Q2", "budget"), ("Q4", "members"), ("Q4", "household"), ("Q5", "elders"), ("Q6", "vote")]
TERMS = ["sweetgrass", "wild rice", "fish weir"]


def _all_tags_sql() -> str:
    entries = [(f"CATEGORY_{c}", k) for c, k in LEXICON] + [(f"QUESTION_{q}", k) for q, k in QUESTION_WORDS]
    parts = f"""SELECT doc_id, line_no, category AS tag, keyword AS matched, context FROM ({_hits_sql(True, entries)})
    UNION ALL SELECT doc_id, line_no, category, keyword, context FROM ({_hits_sql(False, [("TERM", t) for t in TERMS])})
    UNION ALL SELECT doc_id, line_no, metric, CAST(value AS VARCHAR), NULL FROM ({_METRIC_SQL})
    UNION ALL SELECT doc_id, line_no, 'DIALOGUE_' || upper(dialogue[1]) || dialogue[2:], NULL, NULL FROM ({ORACLE["q_dialogue_tags"]})
    UNION ALL SELECT doc_id, line_no, 'CONTEXT', NULL, NULL FROM ({_CASCADE})"""
    return f"""WITH t AS MATERIALIZED ({parts}) SELECT * FROM t UNION ALL SELECT doc_id, line_no, 'GENERAL', NULL, NULL FROM {_LINES} l
    WHERE NOT {_BLANK} AND NOT EXISTS (SELECT 1 FROM t WHERE t.doc_id = l.doc_id AND t.line_no = l.line_no)"""


@query(_all_tags_sql())
def q_all_tags(spark, sf_dir):
    """Every tag of every line, from all parts of the tagger."""
    return tagging.all_tags(_documents(spark, sf_dir), LEXICON, QUESTION_WORDS, TERMS, NEGATIVE)


_TAGGED = "(SELECT DISTINCT doc_id, line_no FROM (" + _hits_sql(False) + "))"


@query(f"SELECT doc_id, line_no FROM {_LINES} WHERE NOT {_BLANK} AND (doc_id, line_no) NOT IN (SELECT (doc_id, line_no) FROM {_TAGGED})")
def q_tag_general(spark, sf_dir):
    rows = _documents(spark, sf_dir)
    return tagging.general_tags(rows, tagging.lexicon_hits(rows, LEXICON))


_TAGGABLE = ORACLE["q_lines_taggable"]
_COVERAGE = f"""SELECT doc_id, count(*) AS taggable, count(t.line_no) AS tagged, round(count(t.line_no) / count(*), 6) AS coverage
    FROM ({_TAGGABLE}) l LEFT JOIN {_TAGGED} t USING (doc_id, line_no) GROUP BY doc_id"""


@query(_COVERAGE)
def q_tag_coverage(spark, sf_dir):
    rows = _documents(spark, sf_dir)
    taggable = lines.taggable_lines(rows, HEADER)
    return tagging.coverage(taggable, tagging.lexicon_hits(rows, LEXICON)).withColumn("coverage", F.round("coverage", 6))


_TRIM = "trim(line, ' ')"


@query(
    rf"""WITH l AS (SELECT doc_id, line_no, {_TRIM} AS line FROM {_LINES}), m AS (SELECT *, regexp_full_match(line, '[0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}(\.[0-9]+)?') AS c FROM l),
    s AS (SELECT *, sum(CASE WHEN c THEN 1 ELSE 0 END) OVER w AS seg, last_value(CASE WHEN c THEN line END IGNORE NULLS) OVER w AS ts FROM m WINDOW w AS (PARTITION BY doc_id ORDER BY line_no)),
    g AS (SELECT doc_id, seg, min(ts) AS ts, string_agg(line, ' ' ORDER BY line_no) AS text FROM s WHERE seg > 0 AND NOT c AND line <> '' GROUP BY 1, 2),
    n AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY seg) AS i FROM g)
    SELECT doc_id, i AS seg_idx, substring(ts, 1, 8) AS ts, CASE WHEN i % 2 = 1 THEN 'Person_1' ELSE 'Person_2' END AS speaker, text FROM n"""
)
def q_clock_segments(spark, sf_dir):
    return lines.clock_segments(_documents(spark, sf_dir))


_ARROW = r"([0-9]{2}:[0-9]{2}:[0-9]{2}\.[0-9]{3})\s*-->\s*([0-9]{2}:[0-9]{2}:[0-9]{2}\.[0-9]{3})"


@query(
    rf"""WITH l AS (SELECT doc_id, line_no, {_TRIM} AS line FROM {_LINES}), f AS (SELECT *, lead(line) OVER (PARTITION BY doc_id ORDER BY line_no) AS next, regexp_matches(line, '{_ARROW}') AS arrow FROM l),
    s AS (SELECT *, regexp_full_match(line, '[0-9]+') AND coalesce(regexp_matches(next, '{_ARROW}'), false) AS num, sum(CASE WHEN arrow THEN 1 ELSE 0 END) OVER w AS seg,
      last_value(CASE WHEN arrow THEN regexp_extract(line, '{_ARROW}', 1) END IGNORE NULLS) OVER w AS ts FROM f WINDOW w AS (PARTITION BY doc_id ORDER BY line_no)),
    g AS (SELECT doc_id, seg, min(ts) AS ts, string_agg(line, ' ' ORDER BY line_no) AS text FROM s WHERE seg > 0 AND NOT arrow AND NOT num AND line <> '' GROUP BY 1, 2)
    SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY seg) AS seg_idx, substring(ts, 1, 8) AS ts, text FROM g"""
)
def q_cue_segments(spark, sf_dir):
    return lines.cue_segments(_documents(spark, sf_dir))


def _strip_sql() -> str:
    text = r"replace(text, chr(13) || chr(10), chr(10))"
    for pattern in (r"(?m)^WEBVTT.*$", r"(?m)^[0-9]+[ \t]*$", r"(?m)^.*-->.*$", r"\.[0-9]{3}\s*-->\s*\.[0-9]{3}"):
        text = f"regexp_replace({text}, '{pattern}', '', 'g')"
    return rf"regexp_replace(regexp_replace({text}, '\n{{3,}}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g')"


@query(f"SELECT doc_id, {_strip_sql()} AS text FROM documents")
def q_strip_cues(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", lines.strip_cue_marks(F.col("text")).alias("text"))


@query(r"SELECT doc_id, regexp_replace(text, '\b[0-9]{2}:[0-9]{2}:[0-9]{2}\b', '', 'g') AS text FROM documents")
def q_strip_clocks(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", lines.strip_clocks(F.col("text")).alias("text"))


def _letter(n: str) -> str:
    return f"CASE WHEN {n} < 26 THEN chr(CAST(65 + {n} AS INTEGER)) ELSE chr(CAST(65 + ({n} - 26) // 26 AS INTEGER)) || chr(CAST(65 + ({n} - 26) % 26 AS INTEGER)) END"


_LABEL = r"^(#[A-Z]+|[A-Z][A-Za-z_]*(?: [A-Za-z0-9]+){0,2}):\s+(.*)$"
_VERSES = rf"""SELECT doc_id, line_no, speaker, body, {_letter("d")} AS letter, verse, page, '[' || {_letter("d")} || '.' || verse || ']' AS citation FROM (
    SELECT *, dense_rank() OVER (PARTITION BY doc_id ORDER BY speaker) - 1 AS d, row_number() OVER (PARTITION BY doc_id, speaker ORDER BY line_no) AS verse,
      (row_number() OVER (PARTITION BY doc_id ORDER BY line_no) - 1) // 50 + 1 AS page
    FROM (SELECT doc_id, line_no, regexp_extract(line, '{_LABEL}', 1) AS speaker, regexp_extract(line, '{_LABEL}', 2) AS body FROM {_LINES} WHERE regexp_matches(line, '{_LABEL}')))"""


@query(_VERSES)
def q_verses(spark, sf_dir):
    return lines.cite(lines.speaker_lines(_documents(spark, sf_dir)))


_TIMED = f"""WITH v AS ({_VERSES}), o AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS ordinal FROM v), c AS ({{cues}})
    SELECT {{columns}} FROM o LEFT JOIN c ON o.doc_id = c.doc_id AND o.ordinal = c.seg_idx"""


def _timed(spark, sf_dir) -> DataFrame:
    rows = _documents(spark, sf_dir)
    return lines.attach_segments(lines.cite(lines.speaker_lines(rows)), lines.cue_segments(rows))


@query(_TIMED.replace("{cues}", ORACLE["q_cue_segments"]).replace("{columns}", "o.doc_id, ordinal, citation, ts"))
def q_segment_join(spark, sf_dir):
    return _timed(spark, sf_dir).select("doc_id", "ordinal", "citation", "ts")


@query(_TIMED.replace("{cues}", ORACLE["q_cue_segments"]).replace("{columns}", "o.doc_id, citation, rpad(citation, 15, ' ') || rpad(ts, 12, ' ') || speaker AS row") + " WHERE ts IS NOT NULL")
def q_reference_table(spark, sf_dir):
    return lines.reference_table(_timed(spark, sf_dir))


_RENDERED = """(SELECT o_custkey AS doc_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS line_no, c_name, n_name,
    c_name || ' of ' || n_name || ' paid $' || CAST(CAST(round(o_totalprice) AS BIGINT) AS VARCHAR) || ' in ' || CAST(year(o_orderdate) AS VARCHAR) AS line
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""


def _rendered(spark, sf_dir) -> DataFrame:
    """A line per order that names a customer, a nation, an amount and a year."""
    o, c, n = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    joined = o.join(c, o.o_custkey == c.c_custkey).join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
    line = F.concat("c_name", F.lit(" of "), "n_name", F.lit(" paid $"), F.round("o_totalprice").cast("long").cast("string"), F.lit(" in "), F.year("o_orderdate").cast("string"))
    number = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    return joined.select(F.col("o_custkey").alias("doc_id"), number.cast("long").alias("line_no"), "c_name", "n_name", line.alias("line"))


@query(
    rf"""SELECT doc_id, line_no, regexp_replace(regexp_replace(regexp_replace(line, '(?i)\$[0-9,]+(?:\s*(?:million|thousand|billion))?', '[Financial_Amount]', 'g'),
    '(?i)[0-9,]+\s*(?:million|thousand|billion)\s+dollars?', '[Financial_Amount]', 'g'), '\b(19|20)[0-9]{{2}}\b', '[Year]', 'g') AS line FROM {_RENDERED}"""
)
def q_mask_money_years(spark, sf_dir):
    return _rendered(spark, sf_dir).select("doc_id", "line_no", redact.mask_years(redact.mask_money(F.col("line"))).alias("line"))


_CODES = f"""SELECT nation, name, n, '#' || {_letter("i")} AS code FROM (SELECT *, row_number() OVER (PARTITION BY nation ORDER BY n DESC, lower(name), name) - 1 AS i
    FROM (SELECT n_name AS nation, c_name AS name, count(*) AS n FROM {_RENDERED} GROUP BY 1, 2))"""


def _codes(spark, sf_dir) -> DataFrame:
    counts = _rendered(spark, sf_dir).groupBy(F.col("n_name").alias("nation"), F.col("c_name").alias("name")).agg(F.count("*").alias("n"))
    return redact.assign_codes(counts, "nation")


@query(_CODES)
def q_codes(spark, sf_dir):
    return _codes(spark, sf_dir)


@query(f"SELECT doc_id, n_name, line_no, replace(line, r.c_name, code) AS text FROM {_RENDERED} r JOIN ({_CODES}) c ON r.n_name = c.nation AND r.c_name = c.name")
def q_redact_names(spark, sf_dir):
    """Each line redacted with the codes of all customers of its nation."""
    rendered = _rendered(spark, sf_dir)
    mapping = _codes(spark, sf_dir).select(F.col("nation").alias("n_name"), F.col("name").alias("surface"), "code")
    return redact.replace_mapped(rendered.select("doc_id", "n_name", "line_no", F.col("line").alias("text")), mapping, "n_name")


@query(f"""SELECT tag_id, regexp_replace('#' || k || ' #' || k || ' met #' || k || ' and #' || k || ' #' || k || ' #' || k || ' at ' || coalesce(context, ''), '#' || k || '( #' || k || ')+( |$)', '#' || k || ' ', 'g') AS text
    FROM (SELECT tag_id, context, chr(CAST(65 + tag_id % 26 AS INTEGER)) AS k FROM (SELECT * FROM transcript_tags QUALIFY row_number() OVER (PARTITION BY tag_id ORDER BY loaded_at DESC, source_file DESC, tag_category DESC, line_number DESC, matched_text DESC, context DESC) = 1))""")
def q_collapse_codes(spark, sf_dir):
    """Sequences of codes before every context; repeats of one code side by side become one."""
    tags = _tags(spark, sf_dir)
    code = F.concat(F.lit("#"), F.chr(F.lit(65) + F.col("tag_id") % 26))
    text = F.concat(code, F.lit(" "), code, F.lit(" met "), code, F.lit(" and "), code, F.lit(" "), code, F.lit(" "), code, F.lit(" at "), F.coalesce("context", F.lit("")))
    return tags.select("tag_id", redact.collapse_codes(text).alias("text"))


_TAGS = "(SELECT * FROM transcript_tags QUALIFY row_number() OVER (PARTITION BY tag_id ORDER BY loaded_at DESC, source_file DESC, tag_category DESC, line_number DESC NULLS LAST, matched_text DESC NULLS LAST, context DESC NULLS LAST) = 1)"


def _tags(spark, sf_dir) -> DataFrame:
    return matrix.latest(table(spark, sf_dir, "transcript_tags"), ["tag_id"], "loaded_at")


@query(f"SELECT tag_id, source_file, tag_category, matched_text FROM {_TAGS}")
def q_latest_tags(spark, sf_dir):
    return _tags(spark, sf_dir).select("tag_id", "source_file", "tag_category", "matched_text")


@query(f"SELECT tag_category, source_file, count(*) AS tags FROM {_TAGS} GROUP BY ROLLUP (tag_category, source_file)")
def q_tag_rollup(spark, sf_dir):
    return _tags(spark, sf_dir).rollup("tag_category", "source_file").agg(F.count("*").alias("tags"))


@query(
    f"""SELECT source_file, lower(matched_text) AS name, count(*) AS n, arg_max(matched_text, (c, matched_text)) AS canonical FROM
    (SELECT source_file, matched_text, count(*) OVER (PARTITION BY source_file, matched_text) AS c FROM {_TAGS} WHERE tag_category = 'ENTITY_Person' AND matched_text IS NOT NULL) GROUP BY 1, 2"""
)
def q_canonical_variant(spark, sf_dir):
    people = _tags(spark, sf_dir).where("tag_category = 'ENTITY_Person' and matched_text is not null")
    counts = people.groupBy("source_file", "matched_text").agg(F.count("*").alias("c"))
    return counts.groupBy("source_file", F.lower("matched_text").alias("name")).agg(F.sum("c").alias("n"), F.max_by("matched_text", F.struct("c", "matched_text")).alias("canonical"))


@query(
    """SELECT source AS "group", f AS first_name, min(l) AS code FROM (SELECT source, string_split(first_name, ' ')[1] AS f, last_name AS l FROM native_american_names WHERE first_name IS NOT NULL AND last_name IS NOT NULL AND source IS NOT NULL)
    GROUP BY 1, 2 HAVING count(DISTINCT l) = 1"""
)
def q_first_name_unique(spark, sf_dir):
    names = table(spark, sf_dir, "native_american_names").where("first_name is not null and last_name is not null and source is not null")
    return redact.unique_first_names(names.select(F.col("source").alias("group"), F.col("first_name").alias("name"), F.col("last_name").alias("code")), "group")


@query(
    f"""SELECT tag_id, matched_text, lower(matched_text) IN (SELECT lower(name) FROM canonical_names WHERE kind = 'place') AS known FROM {_TAGS} WHERE tag_category = 'ENTITY_Place' AND matched_text IS NOT NULL"""
)
def q_known_places(spark, sf_dir):
    places = _tags(spark, sf_dir).where("tag_category = 'ENTITY_Place' and matched_text is not null").select("tag_id", "matched_text")
    return gazetteer.with_flag(places, F.col("matched_text"), table(spark, sf_dir, "canonical_names").where("kind = 'place'"), "name", "known", ignore_case=True)


@query(
    rf"""WITH p AS (SELECT tag_id, matched_text AS name, regexp_split_to_array(trim(matched_text), '\s+') AS t FROM {_TAGS} WHERE tag_category = 'ENTITY_Person' AND matched_text IS NOT NULL),
    l AS (SELECT DISTINCT last_name FROM native_american_names WHERE last_name IS NOT NULL), f AS (SELECT DISTINCT first_name FROM native_american_names WHERE first_name IS NOT NULL)
    SELECT tag_id, name, CASE WHEN length(name) < 2 THEN false WHEN t[len(t)] IN (SELECT last_name FROM l) THEN true WHEN len(t) = 1 THEN t[1] IN (SELECT first_name FROM f)
      WHEN len(t) > 4 THEN false ELSE len(list_filter(t, lambda x: NOT regexp_matches(x, '^[A-Z]') OR lower(x) IN ('the', 'and', 'of'))) = 0 END AS valid FROM p"""
)
def q_valid_names(spark, sf_dir):
    people = _tags(spark, sf_dir).where("tag_category = 'ENTITY_Person' and matched_text is not null").select("tag_id", F.col("matched_text").alias("name"))
    names = table(spark, sf_dir, "native_american_names")
    return extract.valid_names(people, names.select(F.col("first_name").alias("name")), names.select(F.col("last_name").alias("name")), stop_words=["the", "and", "of"])


@query(
    rf"""WITH p AS (SELECT tag_id, matched_text AS name, context FROM {_TAGS} WHERE tag_category = 'ENTITY_Place' AND matched_text IS NOT NULL AND context IS NOT NULL),
    a AS (SELECT name AS an, count(DISTINCT state) = 1 AS one FROM place_names WHERE place_type <> 'district' AND name IS NOT NULL GROUP BY 1)
    SELECT tag_id, name, context, lower(name) IN (SELECT lower(name) FROM canonical_names WHERE kind = 'affiliation') OR lower(name) IN (SELECT lower(name) FROM canonical_names WHERE kind = 'place')
      OR CASE WHEN an IS NOT NULL THEN CASE WHEN regexp_matches(context, '(?i)\b(?:in|at|near|from|to|town|city|village|county)\s') THEN true WHEN regexp_matches(context, '(?i)\b(?:said|says|asked|told|explained)\b') THEN false ELSE one END
         ELSE regexp_full_match(name, '[A-Z][a-z]+(?: [A-Z][a-z]+)+') END AS valid FROM p LEFT JOIN a ON p.name = an"""
)
def q_valid_locations(spark, sf_dir):
    places = _tags(spark, sf_dir).where("tag_category = 'ENTITY_Place' and matched_text is not null and context is not null").select("tag_id", F.col("matched_text").alias("name"), "context")
    known = table(spark, sf_dir, "canonical_names")
    seen = table(spark, sf_dir, "place_names").where("place_type <> 'district' and name is not null").groupBy("name").agg((F.countDistinct("state") == 1).alias("is_primarily_place"))
    return extract.valid_locations(places, known.where("kind = 'affiliation'"), known.where("kind = 'place'"), seen)


@query(
    r"""WITH v AS (SELECT DISTINCT lower(trim(tribal_affiliation)) AS term FROM place_names WHERE trim(tribal_affiliation) <> '' UNION SELECT DISTINCT lower(trim(tribe_origin)) FROM native_american_names WHERE trim(tribe_origin) <> '')
    SELECT term FROM v UNION SELECT p FROM (SELECT trim(unnest(regexp_split_to_array(term, '\s*[/,;&]\s*|\s+and\s+'))) AS p FROM v) WHERE length(p) >= 3"""
)
def q_tribe_terms(spark, sf_dir):
    return gazetteer.tribe_terms([(table(spark, sf_dir, "place_names"), "tribal_affiliation"), (table(spark, sf_dir, "native_american_names"), "tribe_origin")])


@query(
    """WITH u AS (SELECT name, coalesce(place_type, 'unknown') AS type, state, source, 0 AS source_no, id FROM place_names
    UNION ALL SELECT name, 'reference', state, 'reference', 1, ref_id FROM canonical_names WHERE kind = 'place')
    SELECT name, type, state, source, source_no, id FROM u QUALIFY row_number() OVER (PARTITION BY lower(name), lower(type), lower(state) ORDER BY source_no, id) = 1"""
)
def q_union_first_wins(spark, sf_dir):
    places = table(spark, sf_dir, "place_names")
    known = table(spark, sf_dir, "canonical_names").where("kind = 'place'").withColumns({"kind": F.lit("reference"), "source": F.lit("reference")})
    a = places.select("name", F.coalesce("place_type", F.lit("unknown")).alias("type"), "state", "source", "id")
    b = known.select("name", F.col("kind").alias("type"), "state", "source", F.col("ref_id").alias("id"))
    merged = gazetteer.union_sources([a, b])
    return gazetteer.first_wins(merged, ["name", "type", "state"], ["source_no", "id"])


@query(
    """SELECT first_name, last_name, min(id) AS id FROM native_american_names n WHERE source > 'Roll 0000002' AND first_name IS NOT NULL
    AND NOT EXISTS (SELECT 1 FROM native_american_names e WHERE e.source <= 'Roll 0000002' AND e.first_name IS NOT DISTINCT FROM n.first_name AND e.last_name IS NOT DISTINCT FROM n.last_name) GROUP BY 1, 2"""
)
def q_insert_if_absent(spark, sf_dir):
    names = table(spark, sf_dir, "native_american_names").select("first_name", "last_name", "source", "id")
    new = names.where("source > 'Roll 0000002'").groupBy("first_name", "last_name").agg(F.min("id").alias("id"))
    return gazetteer.insert_if_absent(names.where("source <= 'Roll 0000002'"), new, ["first_name", "last_name"], ["first_name"])[0]


@query("SELECT first_name, total, row_number() OVER (ORDER BY total DESC, first_name) AS frequency_rank FROM (SELECT first_name, count(*) AS total FROM native_american_names WHERE first_name IS NOT NULL GROUP BY 1)")
def q_rank_frequency(spark, sf_dir):
    names = table(spark, sf_dir, "native_american_names").where("first_name is not null").withColumn("one", F.lit(1))
    return gazetteer.frequency_rank(names, "first_name", "one")


@query("SELECT last_name, count(*) AS total FROM native_american_names WHERE last_name IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 200")
def q_top200(spark, sf_dir):
    return gazetteer.top_ranked(table(spark, sf_dir, "native_american_names").where("last_name is not null").withColumn("one", F.lit(1)), "last_name", "one")


_COUNTED = ["documents", "interview_evidence", "interview_quotes", "native_american_names", "place_names", "transcript_tags"]


@query("SELECT table_name, count(*) AS n_rows FROM (" + " UNION ALL ".join(f"SELECT '{t}' AS table_name FROM {t}" for t in _COUNTED) + ") GROUP BY ROLLUP (table_name)")
def q_table_counts(spark, sf_dir):
    return gazetteer.table_counts({t: table(spark, sf_dir, t) for t in _COUNTED})


@query(
    rf"""SELECT tag_id AS doc_id, lower(substring(tag_category, 8)) AS kind, matched_text AS surface FROM {_TAGS} WHERE starts_with(tag_category, 'ENTITY_')
    AND NOT regexp_full_match(matched_text, '[0-9]{{2}}:[0-9]{{2}}(:[0-9]{{2}})?(\.[0-9]+)?') AND regexp_matches(context, '(?is)(^|[^A-Za-z0-9_\[])' || regexp_escape(matched_text) || '($|[^A-Za-z0-9_\]])')"""
)
def q_residual_entities(spark, sf_dir):
    """Every surface of the four ENTITY_ categories that still stands in its context."""
    rows = _tags(spark, sf_dir).where("tag_category like 'ENTITY\\_%'")
    rows = rows.select(F.col("tag_id").alias("doc_id"), F.lower(F.substring_index("tag_category", "_", -1)).alias("kind"), F.col("matched_text").alias("surface"), F.col("context").alias("text"))
    return grading.residual_entities(rows.select("doc_id", "kind", "surface"), rows.select("doc_id", "text"))


@query(
    r"""SELECT doc_id, regexp_matches(text, '[0-9]{2}:[0-9]{2}:[0-9]{2}') AS has_times, regexp_matches(text, '^WEBVTT') AS has_header, regexp_matches(text, '(?m)^[A-Z][A-Za-z0-9 ]*: ') AS has_dialogue,
    CAST(len(regexp_extract_all(text, '\[[A-Z]{1,3}\.[0-9]+\]')) AS BIGINT) AS citations, CAST(len(regexp_extract_all(text, '-->')) AS BIGINT) AS artifacts FROM documents"""
)
def q_format_checks(spark, sf_dir):
    return grading.format_checks(table(spark, sf_dir, "documents"))


_CLEAN = r"regexp_replace(regexp_replace(text, '(?i)\$[0-9,]+(?:\s*(?:million|thousand|billion))?', '[Financial_Amount]', 'g'), '(?i)[0-9,]+\s*(?:million|thousand|billion)\s+dollars?', '[Financial_Amount]', 'g')"
_CLEANED = f"(SELECT doc_id, {_CLEAN} AS text FROM documents WHERE text IS NOT NULL)"
_RAW = rf"""(SELECT DISTINCT doc_id, kind, surface FROM (
    SELECT doc_id, 'speaker' AS kind, unnest(regexp_extract_all(text, '(?m)^([A-Z][A-Za-z]* [A-Za-z0-9]+): ', 1)) AS surface FROM documents
    UNION ALL SELECT doc_id, 'money', unnest(regexp_extract_all(text, '\$[0-9][0-9,]*')) FROM documents
    UNION ALL SELECT doc_id, 'year', unnest(regexp_extract_all(text, '(?i){grading.FOUNDING}[^\n]{{0,30}}?\b((?:19|20)[0-9]{{2}})\b', 1)) FROM documents
    UNION ALL SELECT doc_id, 'year', unnest(regexp_extract_all(text, '(?i)\b((?:19|20)[0-9]{{2}})\b[^\n]{{0,30}}?{grading.FOUNDING}', 1)) FROM documents))"""
_REMAIN = f"(SELECT r.* FROM {_RAW} r JOIN {_CLEANED} c USING (doc_id) WHERE contains(c.text, r.surface))"
_CITED = "(" + _TIMED.replace("{cues}", ORACLE["q_cue_segments"]).replace("{columns}", "o.*, ts") + ")"
_SUPPRESSED = f"(SELECT doc_id, sum(hits) AS tag_errors FROM (SELECT doc_id, hits FROM ({_hits_sql(False)}) UNION ALL SELECT doc_id, -hits FROM ({_hits_sql(True)})) GROUP BY 1)"
_SCORED = rf"""(WITH f AS (SELECT doc_id, regexp_matches(text, '[0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}') AS has_times, regexp_matches(text, '^WEBVTT') AS has_header, regexp_matches(text, '(?m)^[A-Z][A-Za-z0-9 ]*: ') AS has_dialogue, len(regexp_extract_all(text, '-->')) AS artifacts FROM {_CLEANED}),
    e AS (SELECT doc_id, count(*) AS entities FROM {_RAW} GROUP BY 1), r AS (SELECT doc_id, count(*) AS residual FROM {_REMAIN} GROUP BY 1),
    v AS (SELECT doc_id, count(DISTINCT letter) AS letters, count(*) AS verses, count(DISTINCT page) AS pages, count(ts) > 0 AS has_table, count(DISTINCT speaker) AS variants FROM {_CITED} GROUP BY 1),
    n AS (SELECT f.*, coalesce(entities, 0) AS entities, coalesce(residual, 0) AS residual, coalesce(letters, 0) AS letters, coalesce(verses, 0) AS verses, coalesce(pages, 0) AS pages, coalesce(has_table, false) AS has_table, variants, coalesce(tagged / taggable, 1.0) AS coverage, coalesce(tag_errors, 0) AS tag_errors
      FROM f LEFT JOIN e USING (doc_id) LEFT JOIN r USING (doc_id) LEFT JOIN v USING (doc_id) LEFT JOIN ({_COVERAGE}) c USING (doc_id) LEFT JOIN {_SUPPRESSED} s USING (doc_id))
    SELECT doc_id, greatest(0.0, 25.0 - residual) AS completeness, CASE WHEN entities > 0 THEN 20.0 * greatest(0.0, 1 - residual / entities) ELSE 20.0 END AS accuracy,
      greatest(0.0, 15.0 - CASE WHEN has_times THEN 4 ELSE 0 END - CASE WHEN has_header THEN 2 ELSE 0 END - CASE WHEN has_dialogue THEN 0 ELSE 4 END - least(3, artifacts)) AS formatting,
      15.0 - CASE WHEN letters > 0 THEN 0 ELSE 5 END - CASE WHEN verses > 0 THEN 0 ELSE 5 END - CASE WHEN pages > 0 THEN 0 ELSE 3 END - CASE WHEN has_table THEN 0 ELSE 2 END AS citation,
      10.0 * coverage AS tag_completeness, greatest(0.0, 10.0 - tag_errors) AS tag_precision, CASE WHEN variants IS NULL THEN 0.0 WHEN variants >= 5 THEN 5.0 ELSE greatest(1.0, variants) END AS matching FROM n)"""
_POINTS = list(grading.POINTS)


def _graded(spark, sf_dir) -> DataFrame:
    """Every document graded with its amounts masked: all checks come from its lines, verses, times and tags."""
    documents = table(spark, sf_dir, "documents").where("text is not null").select("doc_id", "text")
    cleaned = documents.select("doc_id", redact.mask_money(F.col("text")).alias("text"))
    raw = grading.raw_entities(documents)
    rows = lines.split_lines(documents)
    verses = _timed(spark, sf_dir)
    judged, every = (tagging.lexicon_hits(rows, LEXICON, rules).groupBy("doc_id").agg(F.sum("hits").alias(n)) for n, rules in (("judged", NEGATIVE), ("every", None)))
    errors = every.join(judged, "doc_id", "left").select("doc_id", (F.col("every") - F.coalesce("judged", F.lit(0))).alias("tag_errors"))
    covered = tagging.coverage(lines.taggable_lines(rows, HEADER), tagging.lexicon_hits(rows, LEXICON))
    variants = verses.groupBy("doc_id").agg(F.countDistinct("speaker").alias("variants"))
    checks = grading.gather_checks(cleaned, grading.residual_totals(raw, grading.still_there(raw, cleaned)), grading.citation_checks(verses), covered, errors, variants)
    return grading.scores(checks)


def _grade_sql(share: str) -> str:
    return "CASE " + " ".join(f"WHEN {share} >= {least} THEN '{grade}'" for least, grade in scalars.GRADES) + " ELSE 'F' END"


_TOTAL = " + ".join(_POINTS)


@query(f"""SELECT doc_id, {", ".join(f"round({c}, 4) AS {c}" for c in _POINTS)}, round({_TOTAL}, 4) AS total, {_grade_sql(f"round(({_TOTAL}) / 100, 9)")} AS grade FROM {_SCORED}""")
def q_scores(spark, sf_dir):
    graded = _graded(spark, sf_dir).withColumn("grade", scalars.letter_grade(F.round(F.col("total") / 100, 9)))
    return graded.select("doc_id", *(F.round(c, 4).alias(c) for c in (*_POINTS, "total")), "grade")


_SHARES = " UNION ALL ".join(f"SELECT doc_id, '{c}' AS category, {c} / {most} AS share FROM s" for c, most in grading.POINTS.items())


@query(f"WITH s AS MATERIALIZED (SELECT * FROM {_SCORED}) SELECT category, count(*) AS documents, round(avg(share), 6) AS mean_share FROM ({_SHARES}) WHERE round(share, 9) < 0.93 GROUP BY 1")
def q_priorities(spark, sf_dir):
    return grading.priorities(grading.category_grades(_graded(spark, sf_dir))).select("category", "documents", F.round("mean_share", 6).alias("mean_share"))


@query(rf"SELECT doc_id, kind, surface FROM {_RAW}")
def q_raw_entities(spark, sf_dir):
    return grading.raw_entities(table(spark, sf_dir, "documents"))


@query(f"""SELECT doc_id, entities, coalesce(residual, 0) AS residual, round(coalesce(residual, 0) / entities, 6) AS rate FROM (SELECT doc_id, count(*) AS entities FROM {_RAW} GROUP BY 1) LEFT JOIN (SELECT doc_id, count(*) AS residual FROM {_REMAIN} GROUP BY 1) USING (doc_id)""")
def q_residual_totals(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").where("text is not null")
    raw = grading.raw_entities(documents)
    cleaned = documents.select("doc_id", redact.mask_money(F.col("text")).alias("text"))
    return grading.residual_totals(raw, grading.still_there(raw, cleaned)).withColumn("rate", F.round("rate", 6))


@query(f"SELECT doc_id, count(DISTINCT letter) AS letters, count(*) AS verses, count(DISTINCT page) AS pages, count(ts) > 0 AS has_table FROM {_CITED} GROUP BY 1")
def q_citation_checks(spark, sf_dir):
    return grading.citation_checks(_timed(spark, sf_dir))


@query(
    """WITH h AS (SELECT CAST(ts AS DATE) AS day, round(avg(value), 6) AS score FROM events GROUP BY 1), c AS (SELECT *, abs(score - lag(score) OVER (ORDER BY day)) AS change FROM h),
    m AS (SELECT *, coalesce(CAST(change < 0.5 AS INTEGER), 0) AS small FROM c), i AS (SELECT *, sum(1 - small) OVER (ORDER BY day) AS island FROM m),
    r AS (SELECT *, sum(small) OVER (PARTITION BY island ORDER BY day) AS run FROM i) SELECT day, score, round(change, 6) AS change, CAST(run AS BIGINT) AS small_run, run >= 2 AS stop FROM r"""
)
def q_stop_rule(spark, sf_dir):
    history = table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("day")).agg(F.round(F.avg("value"), 6).alias("score"))
    return grading.stop_rule(history, "day", "score").withColumn("change", F.round("change", 6))


def _hits(question: str) -> str:
    return " + ".join(f"CAST(contains(lower(coalesce(text, '')), '{k}') AS BIGINT)" for k in QUESTIONS[question])


_SURVEY = "(" + " UNION ALL ".join(f"SELECT doc_id, source, '{q}' AS question, {_hits(q)} AS hits FROM documents" for q in QUESTIONS) + ")"
_LEVEL = "CASE WHEN hits >= 2 THEN 'HIGH' WHEN hits >= 1 THEN 'MEDIUM' ELSE 'NONE' END"


def _survey(spark, sf_dir) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    hits = survey.question_hits(documents, "doc_id", "text", QUESTIONS)
    return hits.join(documents.select("doc_id", "source"), "doc_id").withColumn("level", survey.coverage_level(F.col("hits"), 2))


@query(f"SELECT doc_id, question, hits, {_LEVEL} AS level FROM {_SURVEY}")
def q_survey_levels(spark, sf_dir):
    return _survey(spark, sf_dir).drop("source")


@query(f"""PIVOT (SELECT question, coalesce(source, 'none') AS source, CASE max(least(hits, 2)) WHEN 2 THEN 'HIGH' WHEN 1 THEN 'MEDIUM' ELSE 'NONE' END AS level FROM {_SURVEY} GROUP BY 1, 2)
    ON source USING max(level) GROUP BY question""")
def q_survey_pivot(spark, sf_dir):
    """The best level of every question in every source."""
    levels = _survey(spark, sf_dir).withColumn("source", F.coalesce("source", F.lit("none")))
    best = levels.groupBy("question", "source").agg(F.max("hits").alias("hits")).withColumn("level", survey.coverage_level(F.col("hits"), 2))
    return survey.level_table(best, "question", "source", matrix.distinct_names(best, "source"))


@query(f"SELECT question, count_if(hits >= 2) AS high, count_if(hits = 1) AS medium, count(*) AS total, round(count_if(hits >= 1) / count(*), 6) AS coverage FROM {_SURVEY} GROUP BY 1")
def q_survey_rates(spark, sf_dir):
    return survey.level_rates(_survey(spark, sf_dir), "question").withColumn("coverage", F.round("coverage", 6))


_EVIDENCE = "(SELECT * FROM interview_evidence QUALIFY row_number() OVER (PARTITION BY coop, metric_code ORDER BY coded_at DESC, evidence_id DESC) = 1)"


def _evidence(spark, sf_dir) -> DataFrame:
    rows = table(spark, sf_dir, "interview_evidence").withColumn("__version", F.struct("coded_at", "evidence_id"))
    return matrix.latest(rows, ["coop", "metric_code"], "__version").drop("__version")


@query(f"PIVOT (SELECT coop, metric_code, metric_value FROM {_EVIDENCE}) ON metric_code USING max(metric_value) GROUP BY coop")
def q_matrix_pivot(spark, sf_dir):
    """The matrix of every metric code in the evidence."""
    evidence = _evidence(spark, sf_dir)
    return matrix.pivot_values(evidence, "coop", "metric_code", "metric_value", matrix.distinct_names(evidence, "metric_code"))


@query(f"SELECT coop, metric_code, metric_value FROM {_EVIDENCE} WHERE metric_value IS NOT NULL")
def q_matrix_unpivot(spark, sf_dir):
    wide = q_matrix_pivot(spark, sf_dir)
    return matrix.unpivot_values(wide, ["coop"], matrix.value_columns(wide, ["coop"]), "metric_code", "metric_value").where("metric_value is not null")


_ANSWERS = ["answer_1", "answer_2", "answer_3", "answer_4"]
_GONE = " AND ".join(f"coalesce(trim({a}) IN ('', '-1', 'Not reported'), true)" for a in _ANSWERS)


@query(f"SELECT matrix_no, metric_code, exported_at, {_GONE} AS excluded FROM human_readable_matrix")
def q_matrix_filter(spark, sf_dir):
    return table(spark, sf_dir, "human_readable_matrix").select("matrix_no", "metric_code", "exported_at", matrix.all_missing(_ANSWERS).alias("excluded"))


@query(
    f"""SELECT e.coop, e.metric_code, d.category, d.question, e.metric_value FROM {_EVIDENCE} e JOIN (SELECT metric_code, category, question FROM metric_encodings
    QUALIFY row_number() OVER (PARTITION BY metric_code ORDER BY encoding_id) = 1) d USING (metric_code)"""
)
def q_matrix_dictionary(spark, sf_dir):
    first = table(spark, sf_dir, "metric_encodings").groupBy("metric_code").agg(F.min_by(F.struct("category", "question"), "encoding_id").alias("d"))
    return _evidence(spark, sf_dir).join(first, "metric_code").select("coop", "metric_code", "d.category", "d.question", "metric_value")


def _cells(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    keys = ["matrix_no", "metric_code", "exported_at"]
    base = table(spark, sf_dir, "exact_sonnet_style").select(*keys, *_ANSWERS).distinct()
    cells = matrix.unpivot_values(base, keys, _ANSWERS, "field", "value")
    patch = spark.createDataFrame([("debt_free", "answer_1", "Unclear"), ("paid_staff", "answer_2", "0"), ("no_such_metric", "answer_9", "x")], "metric_code string, field string, new_value string")
    return cells, patch


_CELLS = "(" + " UNION ALL ".join(f"SELECT DISTINCT matrix_no, metric_code, exported_at, answer_1, answer_2, answer_3, answer_4, '{a}' AS field, {a} AS value FROM exact_sonnet_style" for a in _ANSWERS) + ")"
_PATCH = "(VALUES ('debt_free', 'answer_1', 'Unclear'), ('paid_staff', 'answer_2', '0'), ('no_such_metric', 'answer_9', 'x')) p(metric_code, field, new_value)"


def _patch_sql(wanted: str) -> str:
    return f"SELECT matrix_no, metric_code, exported_at, field, CASE WHEN new_value IS NOT NULL AND {wanted} THEN new_value ELSE value END AS value, new_value IS NOT NULL AND {wanted} AS patched FROM {_CELLS} c LEFT JOIN {_PATCH} USING (metric_code, field)"


@query(_patch_sql("true"))
def q_patch_always(spark, sf_dir):
    cells, patch = _cells(spark, sf_dir)
    return matrix.patch_cells(cells, F.broadcast(patch), ["metric_code", "field"], "always")


@query(_patch_sql("value IS DISTINCT FROM new_value"))
def q_patch_if_different(spark, sf_dir):
    cells, patch = _cells(spark, sf_dir)
    return matrix.patch_cells(cells, F.broadcast(patch), ["metric_code", "field"], "if_different")


@query(_patch_sql("(value IS NULL OR trim(value) IN ('', '-1', 'Not reported'))"))
def q_patch_if_missing(spark, sf_dir):
    cells, patch = _cells(spark, sf_dir)
    return matrix.patch_cells(cells, F.broadcast(patch), ["metric_code", "field"], "if_missing")


@query(
    f"""SELECT matrix_no, metric_code, exported_at, field, value, coalesce(citation, CASE WHEN value IS NULL OR trim(value) IN ('', '-1', 'Not reported') THEN 'not stated in the interview'
    WHEN trim(value) IN ('Yes', 'No') THEN 'stated in the interview' WHEN regexp_full_match(trim(value), '[0-9]+') THEN 'counted in the interview' ELSE 'summarised from the interview' END) AS citation
    FROM {_CELLS} c LEFT JOIN (VALUES ('debt_free', 'answer_1', 'line 12')) s(metric_code, field, citation) USING (metric_code, field)"""
)
def q_citations(spark, sf_dir):
    cells, _ = _cells(spark, sf_dir)
    specific = spark.createDataFrame([("debt_free", "answer_1", "line 12")], "metric_code string, field string, citation string")
    return matrix.cite_cells(cells, F.broadcast(specific), ["metric_code", "field"])


@query(
    f"""SELECT doc_id, line_no, coalesce('line ' || line_no, 'inferred') AS citation FROM (SELECT doc_id, min(CASE WHEN contains(lower(line), 'grant') OR contains(lower(line), 'loan') THEN line_no END) AS line_no FROM {_LINES} GROUP BY 1)"""
)
def q_first_citation(spark, sf_dir):
    return matrix.first_line_with(_documents(spark, sf_dir), ["grant", "loan"], "doc_id")


@query(
    "SELECT codebook_no, encoding_id, last_value(CASE WHEN trim(category) <> '' THEN category END IGNORE NULLS) OVER (PARTITION BY codebook_no ORDER BY encoding_id) AS category FROM metric_encodings"
)
def q_category_fill(spark, sf_dir):
    return matrix.fill_category(table(spark, sf_dir, "metric_encodings").select("codebook_no", "encoding_id", "category"), "codebook_no", "encoding_id", "category")


@query("SELECT codebook_no, encoding_id, category FROM metric_encodings QUALIFY category IS DISTINCT FROM lag(category) OVER (PARTITION BY codebook_no ORDER BY encoding_id)")
def q_banner_rows(spark, sf_dir):
    return matrix.banner_rows(table(spark, sf_dir, "metric_encodings"), "codebook_no", "encoding_id", "category")


@query(
    """SELECT q.quote_id, q.question, coalesce(q.question_full, m.full) AS question_full, CASE WHEN length(quote) > 60 THEN substring(quote, 1, 57) || '...' ELSE quote END AS shown
    FROM interview_quotes q LEFT JOIN (SELECT question, min(question_full) AS "full" FROM interview_quotes WHERE question_full IS NOT NULL GROUP BY 1) m USING (question)"""
)
def q_question_map(spark, sf_dir):
    quotes = table(spark, sf_dir, "interview_quotes")
    known = quotes.where("question_full is not null").groupBy("question").agg(F.min("question_full").alias("full"))
    joined = quotes.join(known, "question", "left")
    return joined.select("quote_id", "question", F.coalesce("question_full", "full").alias("question_full"), scalars.shorten(F.col("quote")).alias("shown"))


@query("SELECT interview, question, excerpt_num, quote_id, row_number() OVER (PARTITION BY interview, question, excerpt_num ORDER BY extracted_at, quote_id) AS delivery FROM interview_quotes")
def q_quote_order(spark, sf_dir):
    w = Window.partitionBy("interview", "question", "excerpt_num").orderBy("extracted_at", "quote_id")
    return table(spark, sf_dir, "interview_quotes").select("interview", "question", "excerpt_num", "quote_id", F.row_number().over(w).cast("long").alias("delivery"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, printf('%02d:%02d:%02d', CAST(floor(abs(value)) AS BIGINT) // 3600, CAST(floor(abs(value)) AS BIGINT) // 60 % 60, CAST(floor(abs(value)) AS BIGINT) % 60) AS clock FROM events")
def q_json_props(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"), scalars.hhmmss(F.abs("value")).alias("clock"))


@query("SELECT doc_id, substring(sha256(source || '/' || doc_id), 1, 24) AS cache_key FROM documents")
def q_hash_key(spark, sf_dir):
    url = F.concat("source", F.lit("/"), F.col("doc_id").cast("string"))
    return table(spark, sf_dir, "documents").select("doc_id", scalars.cache_key(url).alias("cache_key"))


@query(
    """WITH g AS (SELECT source, name, state, row_number() OVER (PARTITION BY source ORDER BY id) AS i FROM place_names WHERE source IS NOT NULL AND name IS NOT NULL),
    f AS (SELECT source, first(state ORDER BY i) AS first_state FROM g WHERE state IS NOT NULL GROUP BY 1)
    SELECT source, name AS place, coalesce(state, first_state) AS state, count(*) AS n FROM (SELECT a.source, a.name, b.state FROM g a JOIN (SELECT source, state, i FROM g WHERE i <= 3) b USING (source)) LEFT JOIN f3 USING (source) GROUP BY 1, 2, 3""".replace(
        "f AS (SELECT source, first(state ORDER BY i) AS first_state FROM g WHERE state IS NOT NULL GROUP BY 1)", "f3 AS (SELECT source, first(state ORDER BY i) AS first_state FROM g WHERE i <= 3 AND state IS NOT NULL GROUP BY 1)"
    )
)
def q_place_flatten(spark, sf_dir):
    """A gazette's names crossed with the states of its first three rows, NULL ones backfilled."""
    rows = table(spark, sf_dir, "place_names").where("source is not null and name is not null")
    number = F.row_number().over(Window.partitionBy("source").orderBy("id"))
    first = rows.withColumn("i", number).where("i <= 3").groupBy("source").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "state"))), lambda x: x["state"]).alias("states"))
    records = rows.select("id", "source", F.array("name").alias("names")).join(first, "source")
    flat = gazetteer.flatten_places(records, "names", "states", "id").join(records.select("id", "source"), "id")
    return flat.groupBy("source", "place", "state").agg(F.count("*").alias("n"))


def _candidates_sql() -> str:
    parts = [f"SELECT doc_id, '{kind}' AS kind, regexp_replace(unnest(regexp_extract_all(text, '{pattern.replace("'", "''")}', {group})), '[ \\t\\r\\n]+', ' ', 'g') AS surface, {rank} AS pattern_rank FROM documents" for rank, (kind, pattern, group) in enumerate(extract.PATTERNS)]
    least = " ".join(f"WHEN '{k}' THEN {n}" for k, n in extract.LEAST_LENGTH.items())
    return f"SELECT doc_id, kind, surface, min(pattern_rank) AS pattern_rank FROM ({' UNION ALL '.join(parts)}) WHERE length(surface) >= CASE kind {least} END GROUP BY 1, 2, 3"


@query(_candidates_sql())
def q_entity_candidates(spark, sf_dir):
    return extract.candidates(table(spark, sf_dir, "documents"))


@query()
def q_similarity(spark, sf_dir):
    """Similarity of first names that share source and last name."""
    names = table(spark, sf_dir, "native_american_names").where("first_name is not null and last_name is not null").select("source", "last_name", "first_name").distinct()
    a, b = names.withColumnRenamed("first_name", "x"), names.withColumnRenamed("first_name", "y")
    distinct = a.join(b, ["source", "last_name"]).where("x < y").select("x", "y").distinct()
    return distinct.withColumn("similarity", F.round(cluster.similarity_udf("x", "y"), 6))


@query()
def q_clusters(spark, sf_dir):
    people = _tags(spark, sf_dir).where("tag_category = 'ENTITY_Person'")
    return cluster.cluster_names(people, "source_file", "matched_text", "tag_id")


@query()
def q_redact_transcripts(spark, sf_dir):
    tags = _tags(spark, sf_dir)
    counts = tags.where("tag_category = 'ENTITY_Person' and matched_text is not null").groupBy("source_file", F.col("matched_text").alias("name")).agg(F.count("*").alias("n"))
    codes = redact.assign_codes(counts, "source_file").select("source_file", F.col("name").alias("surface"), "code")
    return redact.replace_mapped(tags.select("source_file", "tag_id", F.col("context").alias("text")), codes, "source_file")
