"""Unit tests of the transcript operators on literal frames."""

import random

import pytest
from pyspark.sql import functions as F

from sessionloom.functions import scalars
from sessionloom.operators import cluster, extract, gazetteer, grading, lines, matrix, pipeline, redact, reports, survey, tagging
from sessionloom.plans import reference
from sessionloom.session import number_rows


def text_lines(spark, *texts):
    return lines.split_lines(spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "doc_id string, text string"))


def values(spark, column, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_base26_and_clock(spark):
    got = values(spark, scalars.base26(F.col("i")), [(i,) for i in (0, 25, 26, 701, 702, -1)], "i long")
    assert got == ["A", "Z", "AA", "ZZ", "AAA", None]
    assert values(spark, scalars.hhmmss(F.col("s")), [(3725.9,), (-4.0,), (None,)], "s double") == ["01:02:05", "00:00:00", "??:??:??"]


def label(n):
    out, n = "", n + 1
    while n:
        n, digit = divmod(n - 1, 26)
        out = chr(65 + digit) + out
    return out


def test_codes_of_any_length(spark):
    wanted = [0, 25, 26, 701, 702, 18_277, 18_278, 475_253, 475_254, 12_356_630, 2**31, 2**53 + 1, 2**63 - 1]
    got = values(spark, scalars.base26(F.col("i")), [(i,) for i in [*wanted, None]], "i long")
    assert got == [*map(label, wanted), None] and got[6] == "AAAA"
    names = spark.range(18_300).select(F.lit("g").alias("g"), F.format_string("Name%05d", "id").alias("name"), F.lit(1).alias("n"))
    codes = redact.assign_codes(names, "g")
    assert codes.where("code is null").count() == 0 and codes.select("code").distinct().count() == 18_300
    last = codes.where("name >= 'Name18277'").selectExpr("'1' as doc_id", "name as surface", "code")
    text = redact.replace_mapped(spark.createDataFrame([("1", "Name18277 met Name18278")], "doc_id string, text string"), last)
    assert text.first().text == "#ZZZ met #AAAA"
    df = spark.createDataFrame([("#AAAB Hi #AAAA #AAAA went [AAAA.3]",)], "text string")
    assert df.select(redact.collapse_codes(redact.drop_stray_codes(F.col("text")))).first()[0] == "Hi #AAAA went [AAAA.3]"
    assert grading.format_checks(df.withColumn("doc_id", F.lit("1"))).first().citations == 1


@pytest.mark.parametrize(("share", "grade"), [(0.93, "A"), (0.9299, "A-"), (0.90, "A-"), (0.87, "B+"), (0.83, "B"), (0.80, "B-"), (0.77, "C+"), (0.73, "C"), (0.70, "C-"), (0.67, "D+"), (0.60, "D"), (0.59, "F")])
def test_letter_grades(spark, share, grade):
    assert values(spark, scalars.letter_grade(F.col("x")), [(share,)], "x double") == [grade]


def test_scalars(spark):
    assert values(spark, scalars.amount(F.col("x")), [("$1,234.50",), ("abc",)], "x string") == [1234.5, None]
    assert values(spark, scalars.split_terms(F.col("x")), [("Lirra / Talva and Oru & Moro",)], "x string") == [["Lirra", "Talva", "Oru", "Moro"]]
    assert values(spark, scalars.quote_position(F.col("t"), F.col("q")), [("abc", "c"), ("abc", "z")], "t string, q string") == [2, -1]
    assert values(spark, scalars.value_class(F.col("x")), [("-1",), ("Yes",), ("12",), ("some",), (None,)], "x string") == ["missing", "yes_no", "number", "text", "missing"]
    score = scalars.table_score({"t": F.col("t"), "f": F.col("f")}, [("t", "names", 3), ("f", "^zip$", 2), ("t", "draft", -4)])
    assert values(spark, score, [("Names, draft", "ZIP"), ("names", None), (None, None)], "t string, f string") == [1.0, 3.0, 0.0]
    assert values(spark, scalars.clamp(F.col("x"), 0, 10), [(-1.0,), (4.0,), (11.0,)], "x double") == [0.0, 4.0, 10.0]
    assert values(spark, scalars.title_case(F.col("x")), [("  oru   VALE ",)], "x string") == ["Oru Vale"]
    assert values(spark, scalars.time_left(F.col("d"), F.lit(10), F.lit(4.0)), [(0,), (5,), (12,)], "d int") == [None, 4.0, 0.0]
    assert values(spark, scalars.version_of(F.col("x"), "clean"), [("clean_text_v1.2.3.py",), ("other_v1.0",)], "x string") == ["1.2.3", None]
    assert values(spark, scalars.ratio(F.col("a"), F.col("b"), 0.0), [(1.0, 2.0), (1.0, 0.0)], "a double, b double") == [0.5, 0.0]


def test_segments(spark):
    cues = "WEBVTT\n\n1\n00:00:01.900 --> 00:00:04.490\nAvery Stone: Hello.\n\n2\n00:00:05.000 --> 00:00:07.000\n\n3\n00:00:08.000 --> 00:00:09.000\nRowan Vale: We have\n250 members."
    got = lines.cue_segments(text_lines(spark, cues)).orderBy("seg_idx").collect()
    assert [(r.ts, r.text) for r in got] == [("00:00:01", "Avery Stone: Hello."), ("00:00:08", "Rowan Vale: We have 250 members.")]
    clocks = "Title line\r\n00:00:02\r\nGood morning\r\nto you\r\n00:00:05\r\n\r\n00:00:09\r\nThank you"
    got = lines.clock_segments(text_lines(spark, clocks)).orderBy("seg_idx").collect()
    assert [(r.ts, r.speaker, r.text) for r in got] == [("00:00:02", "Person_1", "Good morning to you"), ("00:00:09", "Person_2", "Thank you")]


def test_verses_pages_and_letters(spark):
    body = "\n".join(f"Person_{i % 27 + 10}: line {i}" for i in range(120)).replace("_", " ")
    got = lines.cite(lines.speaker_lines(text_lines(spark, body))).orderBy("line_no").collect()
    assert got[0].letter == "A" and got[26].letter == "AA" and got[27].verse == 2
    assert [got[i].page for i in (0, 49, 50, 100)] == [1, 1, 2, 3]
    assert got[0].citation == "[A.1]"


def test_strip_and_take(spark):
    df = spark.createDataFrame([("WEBVTT\n\n1\n00:00:01.900 --> 00:00:04.490\nHi\n\n\n\n.090 --> .280\nyou",)], "text string")
    assert df.select(lines.strip_cue_marks(F.col("text"))).first()[0] == "Hi\n\nyou"
    assert lines.join_lines(lines.take_until(text_lines(spark, "a\nb\nEND\nc"), "END")).first().text == "a\nb"


def test_context_cascade_matches_sequential_rule(spark):
    rng = random.Random(5)
    texts, wanted = [], {}
    for d in range(40):
        kinds = [rng.choice(["", "word", "SEED"]) if rng.random() < 0.7 else "" for _ in range(15)]
        texts.append("\n".join(kinds))
        context, marked = set(), {i for i, k in enumerate(kinds) if k == "SEED"}
        for i, k in enumerate(kinds):
            if k == "word" and any(j in marked or j in context for j in range(i - 2, i + 3)):
                context.add(i)
        wanted[str(d)] = {i + 1 for i in context}
    rows = text_lines(spark, *texts)
    got = {}
    for r in tagging.context_cascade(rows, F.col("line") == "SEED").collect():
        got.setdefault(r.doc_id, set()).add(r.line_no)
    assert got == {k: v for k, v in wanted.items() if v}


def test_lexicon_metrics_dialogue_and_coverage(spark):
    rows = text_lines(spark, "The grant paid $1,500 and $900 to 40 members.\ngrant writing help\nCOVID-19\n#A Hello\n\nB. Yes\n[A.1] fine")
    hits = tagging.lexicon_hits(rows, [("Finance", "grant"), ("Finance", "$"), ("Health", "COVID-19")], {"grant": "(?i)grant writing"})
    assert {(r.line_no, r.keyword, r.hits) for r in hits.collect()} == {(1, "grant", 1), (1, "$", 2), (3, "COVID-19", 1)}
    near = tagging.lexicon_hits(text_lines(spark, "grant writing took all of that long spring, and then the grant came with a budget. Budget"), [("F", "grant"), ("F", "budget")], {"grant": "writing"}, {"budget": "came"}, shown=5)
    assert {(r.keyword, r.hits, r.context) for r in near.collect()} == {("grant", 1, " the grant came"), ("budget", 2, "th a budget. Bud")}
    many = [("C", f"word{i} end{i}") for i in range(400)] + [("C", "word7")]
    assert {r.keyword for r in tagging.lexicon_hits(text_lines(spark, "WORD7  end7 and word399", None), many).collect()} == {"word7", "word7 end7"}
    everything = tagging.all_tags(rows, [("Finance", "grant")], [("Q1", "grant"), ("Q1", "help")], ["COVID-19"], {"grant": "(?i)grant writing"}, {"help": "(?i)please"})
    assert {(r.line_no, r.tag) for r in everything.collect()} >= {(1, "CATEGORY_Finance"), (1, "QUESTION_Q1"), (3, "TERM"), (1, "METRIC_Member"), (4, "DIALOGUE_Code"), (2, "CONTEXT")}
    assert {r.line_no for r in everything.collect()} == {1, 2, 3, 4, 6, 7}
    metrics = tagging.metric_tags(rows)
    assert {(r.metric, r.value) for r in metrics.collect()} == {("METRIC_Member", 40.0), ("METRIC_Dollar", 1500.0)}
    assert {(r.line_no, r.dialogue) for r in tagging.dialogue_tags(rows, metrics).collect()} == {(4, "code"), (6, "letter"), (7, "verse")}
    tagged = hits.select("doc_id", "line_no").unionByName(tagging.general_tags(rows, hits))
    nonblank = rows.where("trim(line) <> ''")
    assert tagging.coverage(nonblank, tagged).first().coverage == 1.0


def test_gazetteer(spark):
    rows = spark.createDataFrame([("Oru", "town", None, 1), ("ORU", "town", None, 2), ("Oru", "creek", "QA", 3)], "name string, type string, state string, id int")
    assert {r.id for r in gazetteer.first_wins(rows, ["name", "type", "state"], ["id"]).collect()} == {1, 3}
    old = spark.createDataFrame([("a", None)], "f string, l string")
    new = spark.createDataFrame([("a", None), ("b", "x"), ("b", "x"), (None, "z")], "f string, l string")
    inserted, rejected = gazetteer.insert_if_absent(old, new, ["f", "l"], ["f"])
    assert [tuple(r) for r in inserted.collect()] == [("b", "x")] and rejected.count() == 1
    terms = {r.term for r in gazetteer.tribe_terms([(spark.createDataFrame([("Lirra and Talva",), ("",), (None,)], "t string"), "t")]).collect()}
    assert terms == {"lirra and talva", "lirra", "talva"}
    flat = gazetteer.flatten_places(spark.createDataFrame([(1, ["p", "q"], [None, "QA"]), (2, [], [])], "id int, n array<string>, s array<string>"), "n", "s", "id")
    assert sorted((r.id, r.place, r.state) for r in flat.where("id = 1").collect()) == [(1, "p", "QA"), (1, "p", "QA"), (1, "q", "QA"), (1, "q", "QA")]


def test_build_table(spark):
    good = spark.createDataFrame([("Oru", None, "QA"), ("ORU", None, "QA"), (None, "town", "QA")], "name string, kind string, state string").withColumns({"tribe": F.lit(None).cast("string"), "from": F.lit("a")})
    places = gazetteer.place_records(good, "name", "kind", "tribe", "state", "from")
    later = spark.createDataFrame([("oru", "unknown", "QA"), ("Vale", "town", None), ("Vale", "town", None)], "name string, type string, state string")
    table, rejected = gazetteer.build_table("place_names", [places, later])
    assert {(r.name.lower(), r.type, r.state) for r in table.collect()} == {("oru", "unknown", "QA"), ("vale", "town", None)} and rejected.count() == 1
    assert table.columns == gazetteer.TABLES["place_names"][0]
    empty = places.limit(0)
    assert gazetteer.first_filled([empty, places, later]) is places and gazetteer.first_filled([empty, empty]) is empty
    counts = {r.table_name: r.n_rows for r in gazetteer.table_counts({"a": places, "b": empty}).collect()}
    assert counts == {"a": 3, "b": 0, None: 3}
    names = spark.createDataFrame([("Oru Reservation",), ("Oru Band of the Talva River, Aland",), (None,)], "n string")
    assert [r[0] for r in names.select(gazetteer.places_in_name(F.col("n"), ["Aland"])).collect()] == [["Oru"], ["Talva River", "Aland"], []]


def test_number_rows_agrees_with_a_window(spark):
    df = spark.range(1000).withColumn("x", F.col("id") * 7919 % 1000)
    got = {r.x: r.rank for r in number_rows(df.select("x"), [F.desc("x")], "rank").collect()}
    assert got == {x: 1000 - x for x in range(1000)}


def test_names_and_places(spark):
    names = spark.createDataFrame([("A",), ("Oru Vale",), ("Oru",), ("Moro",), ("The Big Hall",), ("a b",)], "name string")
    first, last = spark.createDataFrame([("Oru",)], "name string"), spark.createDataFrame([("Vale",)], "name string")
    got = {r.name: r.valid for r in extract.valid_names(names, first, last, stop_words=["the"]).collect()}
    assert got == {"A": False, "Oru Vale": True, "Oru": True, "Moro": False, "The Big Hall": False, "a b": False}
    found = {(r.kind, r.surface) for r in extract.candidates(spark.createDataFrame([("1", "Avery Stone: we met near Talva Creek, and the Moro Nation District came. Oru District. Vale Growers Cooperative")], "doc_id string, text string")).collect()}
    assert {("person", "Avery Stone"), ("location", "Talva Creek"), ("location", "Oru"), ("organization", "Vale Growers Cooperative"), ("tribe", "Moro Nation")} <= found
    entities = extract.with_recognizer(spark.createDataFrame([("1", "ab"), ("2", None)], "doc_id string, text string"), lambda t: [(0, 1, "X", t[:1])])
    assert [tuple(r) for r in entities.collect()] == [("1", 0, 1, "X", "a")]
    df = spark.createDataFrame([("Sun Dance here",)], "t string")
    assert df.select(extract.mask_terms(F.col("t"), ["sun dance"])).first()[0] == "TERM_PLACEHOLDER here"


def test_redaction(spark):
    assert redact.replace_names("Oru Vale met oru. [Oru] Orus", {"Oru": "#B", "Oru Vale": "#A"}) == "#A met #B. [Oru] Orus"
    assert redact.correct_words("covid and COVID-19", {"covid": "COVID-19"}) == "COVID-19 and COVID-19-19"
    df = spark.createDataFrame([("Paid $1,500 in 2015 and 3 million dollars. May came. #D #D went",)], "t string")
    text = redact.collapse_codes(redact.mark_ambiguous(redact.mask_years(redact.mask_money(F.col("t"))), ["May", "Will"]))
    assert df.select(text).first()[0] == "Paid [Financial_Amount] in [Year] and [Financial_Amount]. [May] came. #D went"
    stray = spark.createDataFrame([("#A Hello there\nthe #A went",)], "t string")
    assert stray.select(redact.drop_stray_codes(F.col("t"))).first()[0] == "Hello there\nthe #A went"
    df = spark.createDataFrame([("Elder May said May. Will it? Will Oru came",)], "t string")
    assert df.select(redact.mark_ambiguous(F.col("t"), ["May", "Will"], "pos_based")).first()[0] == "Elder [May] said May. Will it? [Will] Oru came"
    assert redact.replace_first_names("Oru said no. So, Oru and Oru Vale went; [Oru] and Oru.", {"Oru": "#A"}) == "#A said no. So, #A and Oru Vale went; [Oru] and #A."
    fixed = redact.fix_terms(F.col("t"), ["weir"], {"fsh": "fish"})
    assert [r[0] for r in spark.createDataFrame([("the fsh weir",), ("a fsh",)], "t string").select(fixed).collect()] == ["the fish weir", "a fsh"]
    texts = spark.createDataFrame([("1", "Oru spoke"), ("2", "Oru spoke"), ("3", None)], "doc_id string, text string")
    mapping = spark.createDataFrame([("1", "Oru", "#A"), ("3", "Oru", "#A")], "doc_id string, surface string, code string")
    assert {r.doc_id: r.text for r in redact.replace_mapped(texts, mapping).collect()} == {"1": "#A spoke", "2": "Oru spoke", "3": None}


def test_a_hot_session_is_split(spark):
    texts = spark.range(900).selectExpr("'s' as doc_id", "concat('Name', id, ' met ORU Vale at Vale Guild, and Oru left') as text").unionByName(spark.createDataFrame([("t", "Oru Vale")], "doc_id string, text string"))
    pairs = [("s", "person", "Oru Vale", "#A"), ("s", "person", "Vale", "#B"), ("s", "organization", "Vale Guild", "Org_1"), ("s", "person", None, "#C"), ("s", "person", "", "#C"), ("u", "person", "x", "#D")]
    mapping = spark.createDataFrame(pairs, "doc_id string, kind string, surface string, code string")
    got = redact.replace_mapped(texts, mapping, first_names=True, chunk_rows=100)
    assert {r.text.split(" ", 1)[-1] for r in got.where("doc_id = 's'").collect()} == {"met #A at #B Guild, and #A left"} and got.count() == 901
    assert got.where("doc_id = 't'").first().text == "Oru Vale"
    assert redact.replace_mapped(texts.limit(0), mapping).count() == 0 and redact.replace_mapped(texts, mapping.limit(0)).count() == 901


def test_codes_of_residual_names(spark):
    mapping = spark.createDataFrame([("d", "Oru Vale", "#A"), ("d", "Moro Vale", "#B")], "doc_id string, surface string, code string")
    left = spark.createDataFrame([("d", "oru"), ("d", "Vale"), ("d", "Zen"), ("d", "Zen"), ("e", "Zen")], "doc_id string, surface string")
    got = {(r.doc_id, r.surface): r.code for r in redact.assign_by_containment(left, mapping).collect()}
    assert got == {("d", "oru"): "#A", ("d", "Vale"): "#B", ("d", "Zen"): "#C", ("e", "Zen"): "#A"}


def test_clusters(spark):
    assert cluster.greedy_clusters(["Avery Stone", "Avery Ston", "Rowan Vale", "Rowen Vale"]) == [0, 0, 1, 1]
    assert cluster.similar_names("Avery", ["Averi", "Moro"]) == ["Averi"]
    assert [cluster.threshold("Avery Stone", "avery Moro"), cluster.threshold("A B", "C D", True), cluster.threshold("A", "A")] == [0.5, 0.55, 0.75]
    df = spark.createDataFrame([("1", "Avery Stone", 1), ("1", "Avery Ston", 2), ("1", "Avery Ston", 3), ("2", None, 1), ("3", "Avery Stone", 9)], "d string, name string, at long")
    got = cluster.cluster_names(df, "d", "name", "at").collect()
    assert {(r.d, r.canonical) for r in got} == {("1", "Avery Ston"), ("3", "Avery Stone")} and len(got) == 3
    sizes = cluster.cluster_sizes(cluster.cluster_names(df, "d", "name", "at"), "d").where("d = '1'").first()
    assert (sizes.clusters, sizes.variants) == (1, 1)
    assert cluster.cluster_names(df.limit(0), "d", "name", "at").count() == 0


def test_clusters_agree_with_the_sequential_rule(spark, tiny):
    tags = spark.read.parquet(f"{tiny}/transcript_tags.parquet").where("tag_category = 'ENTITY_Person' and matched_text is not null")
    wanted = {}
    for key, own in tags.toPandas().groupby("source_file"):
        names = list(dict.fromkeys(own.sort_values("tag_id", kind="stable")["matched_text"]))
        for name, at in zip(names, cluster.greedy_clusters(names), strict=True):
            wanted.setdefault((key, at), set()).add(name)
    got = {}
    for r in cluster.cluster_names(tags, "source_file", "matched_text", "tag_id").collect():
        got.setdefault((r.source_file, r.cluster), set()).add(r.matched_text)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, wanted.values()))


def test_matrix(spark):
    cells = spark.createDataFrame([(1, "a", "Yes"), (1, "b", None)], "r int, c string, value string")
    patch = spark.createDataFrame([(1, "a", "No"), (1, "b", "x"), (9, "z", "q")], "r int, c string, new_value string")
    got = {p: {r.c: r.value for r in matrix.patch_cells(cells, patch, ["r", "c"], p).collect()} for p in ("always", "if_missing")}
    assert got == {"always": {"a": "No", "b": "x"}, "if_missing": {"a": "Yes", "b": "x"}}
    df = spark.createDataFrame([(1, 1, "A"), (1, 2, ""), (1, 3, "B"), (1, 4, None)], "g int, i int, c string")
    filled = matrix.fill_category(df, "g", "i", "c")
    assert [r.c for r in filled.orderBy("i").collect()] == ["A", "A", "B", "B"]
    assert [r.i for r in matrix.banner_rows(filled, "g", "i", "c").orderBy("i").collect()] == [1, 3]


def test_pivot_keeps_every_code(spark, tiny):
    df = spark.createDataFrame([(1, "a", "x"), (1, "new_code", "y"), (2, "b", "z")], "r int, c string, value string")
    names = matrix.distinct_names(df, "c")
    assert names == ["a", "b", "new_code"]
    wide = matrix.pivot_values(df, "r", "c", "value", names)
    long = matrix.unpivot_values(wide, ["r"], names, "c", "value").where("value is not null")
    assert {tuple(r) for r in long.collect()} == {tuple(r) for r in df.collect()}
    for most, rows in ((2, df), (9, df.unionByName(spark.createDataFrame([(3, None, "q")], df.schema)))):
        with pytest.raises(ValueError):
            matrix.distinct_names(rows, "c", most)
    evidence = spark.read.parquet(f"{tiny}/interview_evidence.parquet")
    codes = {r[0] for r in evidence.select("metric_code").distinct().collect()}
    assert set(reference.QUERIES["q_matrix_pivot"](spark, tiny).columns) == {"coop", *codes} and len(codes) == 36


def test_residual_check_takes_every_surface(spark, tiny, tmp_path):
    surfaces = [("ENTITY_Person", "E. Quillaxon"), ("ENTITY_Organization", "Iskarsully Land Tr."), ("ENTITY_Place", "Krellhutch-Falls"), ("ENTITY_Tribe", "Moro (Upper)"), ("ENTITY_Person", "É. Orú")]
    tags = [(i, c, s, f"and {s} went", 1) for i, (c, s) in enumerate(surfaces)] + [(9, "ENTITY_Person", "E. Quill", "[E. Quill] and E. Quillaxon", 1), (10, "METRIC_Dollar", "a", "a", 1)]
    tags = [(i, "s", c, 1, m, x, at) for i, c, m, x, at in tags]
    spark.createDataFrame(tags, "tag_id long, source_file string, tag_category string, line_number int, matched_text string, context string, loaded_at long").write.parquet(f"{tmp_path}/transcript_tags.parquet")
    got = reference.QUERIES["q_residual_entities"](spark, str(tmp_path)).collect()
    assert {(r.kind, r.surface) for r in got} == {(c[7:].lower(), s) for c, s in surfaces}


def test_recognized_entities(spark):
    text = "I am Oru and then Moro came. Vale Coop, North Shore, Red River, 10:30"
    texts = spark.createDataFrame([("1", text)], "doc_id string, text string")
    at = lambda word, label: ("1", text.index(word), text.index(word) + len(word), label, word)
    found = spark.createDataFrame([at("Oru", "PERSON"), at("Moro", "PERSON"), at("Vale Coop", "PERSON"), at("Vale Coop", "ORG"), at("North Shore", "LOC"), at("Red River", "GPE"), at("10:30", "PERSON")], "doc_id string, start int, end int, label string, surface string")
    got = extract.accept_recognized(found, texts)
    assert {(r.kind, r.surface) for r in got.collect()} == {("person", "Oru"), ("organization", "Vale Coop"), ("location", "Red River")}
    assert "North Shore" in {r.surface for r in extract.accept_recognized(found, texts, places=["North Shore"]).collect()}
    patterns = spark.createDataFrame([("1", "person", "Oru", 0)], "doc_id string, kind string, surface string, pattern_rank long")
    assert {(r.surface, r.pattern_rank) for r in extract.merge_recognized(patterns, got).collect()} == {("Oru", 0), ("Vale Coop", len(extract.PATTERNS)), ("Red River", len(extract.PATTERNS))}
    terms = spark.createDataFrame([("lirra",), ("oru talva",)], "term string")
    rows = spark.createDataFrame([(1, "Lirra and Moro"), (2, "ORU TALVA"), (3, "Moro"), (4, None)], "id int, t string")
    assert {r.id for r in extract.is_tribe_term(F.col("t"), terms, rows).where("tribe_term").collect()} == {1, 2}


TRANSCRIPT = "WEBVTT\n\n1\n00:00:01.900 --> 00:00:04.000\nOru Vale: Ms. Moro Stone gave $1,500 to the Talva Weavers Guild in 1998.\n\n2\n00:00:05.000 --> 00:00:07.000\nMoro Stone: So, Oru and I met near Talva Creek.\nMay came. 40 members of the Lirra Nation."


def test_cleaner(spark):
    texts = spark.createDataFrame([("a", TRANSCRIPT, 1), ("b", None, 1), ("c", "", 1), ("d", "nothing named here", 1)], "doc_id string, text string, position int")
    settings = pipeline.Settings([("Groups", "members")], [("Q1", "met")], ["creek"], ambiguous_words=["May"])
    made = pipeline.clean_transcripts(texts, pipeline.Lookups.none(spark), settings)
    got = {r.doc_id: r.text for r in made.texts.collect()}
    assert got["b"] is None and got["c"] == "" and got["d"] == "nothing named here"
    for word in ("Oru", "Moro", "Stone", "Talva", "Lirra", "$1,500", "1998", "-->"):
        assert word not in got["a"], (word, got["a"])
    assert "[Financial_Amount]" in got["a"] and "[Year]" in got["a"] and "Organization_1" in got["a"] and "Location_1" in got["a"] and "Tribe_1" in got["a"] and "[May]" in got["a"]
    codes = {r.surface: r.code for r in made.codes.collect()}
    assert {codes["Oru Vale"], codes["Moro Stone"]} == {"#A", "#B"}
    verses = {(r.doc_id, r.citation, r.ts) for r in made.verses.where("doc_id = 'a'").collect()}
    assert {t for _, _, t in verses} == {"00:00:01", "00:00:05"} and len(verses) == 2
    assert [r.speaker for r in made.verses.where("doc_id = 'd'").collect()] == ["Narrative"]
    tags = {r.tag for r in made.tags.where("doc_id = 'a'").collect()}
    assert {"CATEGORY_Groups", "METRIC_Member", "METRIC_Dollar", "QUESTION_Q1"} <= tags
    summary = {r.doc_id: r for r in made.summary.collect()}
    assert (summary["a"].persons, summary["a"].organizations, summary["a"].locations, summary["a"].tribes) == (2, 1, 1, 1) and summary["b"].tags == 0
    assert reports.run_totals(made.summary).first().with_persons == 1
    again = pipeline.clean_transcripts(made.texts.where("doc_id = 'a'"), pipeline.Lookups.none(spark), settings).texts.first().text
    assert again.replace("[[May]]", "[May]") == got["a"]


def test_lines_and_reports(spark):
    rows = lines.split_any(spark.createDataFrame([("1", "a\r\nb\x0bc\u2028d\n"), ("2", ""), ("3", None)], "doc_id string, text string"))
    assert [r.line for r in rows.orderBy("line_no").collect()] == ["a", "b", "c", "d"]
    spoken = text_lines(spark, "12\nOru: hi\n\nand so on")
    labels = spark.createDataFrame([("0", "Oru", "Speaker 1")], "doc_id string, speaker string, label string")
    assert [r.line for r in lines.dialogue_lines(spoken, labels).orderBy("line_no").collect()] == ["Speaker 1: hi", "Speaker: and so on"]
    blocks = reports.text_blocks(text_lines(spark, "1. One\n1.2 Two\nALL CAPS\n- item\nbody\n\n"))
    assert [r.block for r in blocks.orderBy("line_no").collect()] == ["section", "subsection", "heading", "bullet", "body"]
    wide = spark.createDataFrame([(1, "A", "-1", None), (2, "A", "Yes", "")], "i int, category string, x string, y string")
    got = matrix.filtered_matrix(wide, ["x", "y"], "category", ["i"]).collect()
    assert [(r.i, r.section) for r in got] == [(2, 0), (None, 1), (1, 2)]
    assert matrix.without_columns(wide, [1, 7]).columns == ["i", "x", "y"] and matrix.value_columns(wide, ["i"]) == ["category", "x", "y"]
    assert matrix.interleave(wide.withColumns({"x (Citation)": F.lit("c"), "y (Citation)": F.lit("d")}), ["i"], ["x", "y"]).columns == ["i", "x (Citation)", "x", "y (Citation)", "y"]


def test_grading_parts(spark):
    text = spark.createDataFrame([("1", "Oru Vale: founded in 1998 with $1,500; in 2004 it rained a lot and nothing at all was done. Oru Vale: ok")], "doc_id string, text string")
    raw = grading.raw_entities(text)
    assert {(r.kind, r.surface) for r in raw.collect()} == {("speaker", "Oru Vale"), ("money", "$1,500"), ("year", "1998")}
    left = grading.still_there(raw, text.withColumn("text", F.lit("1998 only")))
    assert grading.residual_totals(raw, left).first().rate == pytest.approx(1 / 3)
    near = spark.createDataFrame([("Oru #A came", "Oru"), ("Oru came " + "x" * 40 + " #A", "Oru"), ("Person_1 Oru, and later " + "x" * 40 + " Oru", "Oru")], "t string, s string")
    assert [r[0] for r in near.select(grading.code_nearby(F.col("t"), F.col("s"))).collect()] == [True, False, False]
    columns = "run int, doc_id string, completeness double, accuracy double, formatting double, citation double, tag_completeness double, tag_precision double, matching double, total double, grade string"
    graded = spark.createDataFrame([(1, "a", 20.0, 20.0, 15.0, 15.0, 10.0, 10.0, 5.0, 95.0, "A"), (2, "a", 20.0, 20.0, 15.0, 15.0, 10.0, 10.0, 5.0, 70.0, "C-"), (3, "a", 20.0, 20.0, 15.0, 15.0, 10.0, 10.0, 5.0, 70.2, "C-"), (4, "a", 20.0, 20.0, 15.0, 15.0, 10.0, 10.0, 5.0, 70.3, "C-")], columns)
    assert [r.ends for r in grading.run_history(graded, "run").orderBy("run").collect()] == ["all A", None, None, "no progress"]
    report = grading.grade_report(graded.limit(1), "1").first()
    assert report.categories["completeness"].suggestions and not report.categories["citation"].suggestions
    categories = grading.category_grades(graded, "run")
    assert grading.top_suggestions(categories).first().documents == 4
    assert not grading.all_graded_a(categories, "run").where("all_a").count()


def test_survey_and_grading(spark):
    texts = spark.createDataFrame([("1", "A grant and a loan"), ("2", None)], "d string, t string")
    hits = survey.question_hits(texts, "d", "t", {"Q": ["grant", "loan", "x"]})
    assert {r.d: r.hits for r in hits.collect()} == {"1": 2, "2": 0}
    columns = "doc_id string, residual int, entities int, has_times boolean, has_header boolean, has_dialogue boolean, artifacts int, letters int, verses int, pages int, has_table boolean, coverage double, tag_errors int, variants int"
    rows = [("a", 0, 0, False, False, True, 0, 1, 1, 1, True, 1.0, 0, 5), ("b", 26, 13, True, True, False, 9, 0, 0, 0, False, 0.5, 12, None)]
    got = {r.doc_id: r for r in grading.scores(spark.createDataFrame(rows, columns)).collect()}
    assert got["a"].total == 100.0 and got["a"].grade == "A"
    assert (got["b"].completeness, got["b"].accuracy, got["b"].formatting, got["b"].citation, got["b"].matching) == (0.0, 0.0, 2.0, 0.0, 0.0)
    assert grading.priorities(grading.category_grades(grading.scores(spark.createDataFrame(rows, columns)))).count() == 7
    history = spark.createDataFrame([(1, 80.0), (2, 80.2), (3, 80.3), (4, 85.0)], "i int, s double")
    assert [r.stop for r in grading.stop_rule(history, "i", "s").orderBy("i").collect()] == [False, False, True, False]
