"""Personal information, confusables and line labels."""

import pickle

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sessionloom.llm.confusables import _TO_LATIN, clean_dictionary, clean_text, session_lookalikes
from sessionloom.llm.lines import Labeller, count_lines, fit, label_pages, learn_lines
from sessionloom.llm.personal import NameLexicon, find_personal, find_spans, learn_names, redact, split_mentions

LEXICON = NameLexicon(["avery", "rowan", "marisol", "tamsin"], ["stonefield", "valecrest", "underhill"])


def found(text, lexicon=LEXICON):
    return {(s.kind, text[s.start : s.end]) for s in find_spans(text, lexicon)}


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Write to info.vale+coop@mail.example, please.", {("email", "info.vale+coop@mail.example")}),
        ("Reach me: avery_82 at mailhost dot co dot example now", {("email", "avery_82 at mailhost dot co dot example")}),
        ("I copied a.b(at)host(dot)example on it.", {("email", "a.b(at)host(dot)example")}),
        ("x [at] host.example", {("email", "x [at] host.example")}),
        ("They meet @ noon at the dot of two.", set()),
        ("Call (330) 555-0185 twice.", {("phone", "(330) 555-0185")}),
        ("Call 865 555 0105 ext. 83 now", {("phone", "865 555 0105 ext. 83")}),
        ("Tel +1 454 555 0106 1966", {("phone", "+1 454 555 0106")}),
        ("Just text five five five oh one seven two, okay?", {("phone", "five five five oh one seven two")}),
        ("Batch 4018458 was fine. Order #54335433. We paid $558,558.", set()),
        ("Item 509-28-5401 came back.", set()),
        ("It says SSN 982-63-3639, I think.", {("identity_number", "982-63-3639")}),
        ("For the form, passport no. Z8765896.", {("identity_number", "Z8765896")}),
        ("They wrote down DL# QX265869L right there.", {("identity_number", "QX265869L")}),
        ("Enrolled as 970U610709 on file. social: 947554495", {("identity_number", "970U610709"), ("identity_number", "947554495")}),
        ("The house is 1128 N Ferry Dr., behind the store.", {("street_address", "1128 N Ferry Dr.")}),
        ("Moved to 4929 Council Rd.. We left.", {("street_address", "4929 Council Rd.")}),
        ("Mail goes to 29B Kiln St.", {("street_address", "29B Kiln St")}),
        ("Drop it at P.O. Box 1779 or 5 County Road 660.", {("street_address", "P.O. Box 1779"), ("street_address", "5 County Road 660")}),
        ("In 2015 Main Street got new lights.", set()),
        ("Elder Marisol J. Stonefield and A. Valecrest told me", {("name", "Marisol J. Stonefield"), ("name", "A. Valecrest")}),
        ("Underhill, Rowan can explain; Valecrest Fisheries can't.", {("name", "Underhill, Rowan")}),
        ("It was Tamsin V. who asked Mariosl Stonefeild", {("name", "Tamsin V."), ("name", "Mariosl Stonefeild")}),
        ("", set()),
    ],
)
def test_identifiers(text, want):
    assert found(text) == want


def test_disguised_characters_map_back():
    text = "mail аvery@hоst.example, call ５５５-０１５９"
    assert found(text) == {("email", "аvery@hоst.example"), ("phone", "５５５-０１５９")}
    assert redact(text, find_spans(text, LEXICON)) == "mail [EMAIL], call [PHONE]"


@pytest.mark.parametrize("value", ["jane {at} host.org", "jane <at> host.org", "jane ( at ) host.org", "jane (AT ) host.org", "three four six seven eight nine three four six seven"])
def test_prefilters_let_every_disguise_through(value):
    (span,) = find_spans(f"Write to {value} soon")
    assert f"Write to {value} soon"[span.start : span.end] == value


def test_names_are_whole_words_in_any_disguise():
    lexicon = NameLexicon(["al", "oru", "avery"], ["vale", "stonefield"])
    assert found("Also Al Vale said it, Alaska", lexicon) == {("name", "Al Vale")}
    assert found("Oru went to Oruville, and Averyt did too", lexicon) == set()
    assert found("so Аvery\u200b Stоnefield told me", lexicon) == {("name", "Аvery\u200b Stоnefield")}


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=200))
def test_spans_stay_in_order_on_any_text(text):
    spans = find_spans(text, LEXICON)
    assert all(a.end <= b.start for a, b in zip(spans, spans[1:], strict=False)) and all(0 <= s.start < s.end <= len(text) for s in spans)


def test_find_personal_edge_cases(spark):
    rows = [("f", 1, None, "x"), ("f", 2, "", "x"), ("f", 3, "word " * 100_000 + "a@b.example", "x"), ("f", 3, "a@b.example", "x"), ("f", None, "a@b.example", None)]
    df = spark.createDataFrame(rows, "field_name string, row_id long, text string, found string")
    got = find_personal(df, None).collect()
    assert [(r.row_id, r.redacted, len(r.found)) for r in got if r.row_id in (1, 2)] == [(1, None, 0), (2, "", 0)]
    assert [len(r.found) for r in got if r.row_id == 3] == [1, 1] and len(got) == 5
    assert find_personal(df.limit(0), LEXICON).count() == 0


def test_learn_names(spark):
    rows = [("Avery", "Stonefield")] * 3 + [("Stonefield", "Avery"), (None, "Vale"), ("Rowan", None), ("Once", "Seen"), ("", ""), ("Al", "d’Orú-Vale"), ("A.", "Fisheries")]
    lexicon = learn_names(spark.createDataFrame(rows, "first string, last string"), "first", "last")
    assert lexicon.first == {"avery", "once"} and lexicon.last == {"stonefield", "seen", "doruvale"} and lexicon.short == {"al"}
    assert lexicon.known == {"avery", "stonefield"}
    assert found("I met Al D'Orú-Vale.", pickle.loads(pickle.dumps(lexicon))) == {("name", "Al D'Orú-Vale")}
    assert not learn_names(spark.createDataFrame([], "first string, last string"), "first", "last").first
    many = spark.range(5_000).selectExpr("concat('first', chr(97 + id div 200), chr(97 + id % 26)) as first", "concat('last', id) as last")
    assert 0 < len(learn_names(many, "first", "last", sample_rows=500).first) <= 1_000


def test_split_mentions(spark):
    rows = spark.createDataFrame([("Elder Avery J. Stonefield",), ("Stonefield, Avery J.",), ("Avery",), (None,), ("A. Stonefield",)], "m string")
    assert [tuple(r) for r in split_mentions(rows, "m").collect()] == [("Avery", "Stonefield"), ("Avery", "Stonefield"), ("A.", "Stonefield")]


@pytest.mark.parametrize(
    ("dirty", "clean"),
    [
        ("Tаlva  Creek ", "Talva Creek"),
        ("Че́к", "Че́к"),
        ("Café", "Café"),
        ("Ｃｏ－ｏｐ １２", "Co-op 12"),
        ("Elders’ Kitchen", "Elders' Kitchen"),
        ("Co‑op Hub​", "Co-op Hub"),
        ("Жилдар Union", "Жилдар Union"),
        ("Жилдaр Union", "Жилдар Union"),
        ("ᐱᓚᒥ Union", "ᐱᓚᒥ Union"),
        ("ﬁsh oﬀer", "fish offer"),
        ("Сосо Weavers", "Coco Weavers"),
        ("٣ Rows", "3 Rows"),
        ("", ""),
    ],
)
def test_clean_forms(dirty, clean):
    assert clean_text(dirty) == clean


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="abcАВеоор́é​  -'’ΟνＣ１", max_size=20))
def test_clean_text_is_idempotent(text):
    once = clean_text(text)
    assert clean_text(once) == once


def test_lookalikes_of_every_script(spark):
    table = session_lookalikes(spark)
    assert len(table) > 250 and table.items() >= _TO_LATIN.items()
    assert clean_text("\ua4eenna went", table) == "Anna went" and clean_text("\ua4eenna") == "\ua4eenna"
    assert clean_text("\u1431\u14da\u14a5 Union", table) == "\u1431\u14da\u14a5 Union"
    for c, latin in table.items():
        assert clean_text(f"fkt{c}", table) == f"fkt{latin}"
    rows = spark.createDataFrame([(1, "T\U00010404lva"), (2, "\ua4ee\ua4f3")], "id long, v string")
    assert [(r.id, r.clean_text) for r in clean_dictionary(rows, "v").collect()] == [(1, "TOlva")]


def test_clean_dictionary_edge_cases(spark):
    df = spark.createDataFrame([(1, "plain", "x"), (2, None, "y"), (3, "", "z"), (4, "two  blanks", "c"), (4, "two  blanks", "c"), (5, "ａ" * 50_000, "q")], "id long, v string, clean_text string")
    got = clean_dictionary(df, "v").collect()
    assert sorted((r.id, r.clean_text[:10]) for r in got) == [(4, "two blanks"), (4, "two blanks"), (5, "a" * 10)]
    assert clean_dictionary(df.limit(0), "v").count() == 0


PROSE = "The buyer paid for the flyers and then we ate by the river. Our rule is simple: no one sells wool below what the elders agreed."
PAGES = {
    "prose": PROSE,
    "links": "\n".join(f"https://shop{i}.example/page?id={i}" for i in range(12)),
    "tags": " ".join(f"#WildRice{i % 3} #CheapFeed" for i in range(15)),
    "menu": "\n".join(f"Home > Buy > Wild Rice > Place {i}" for i in range(10)),
    "words": "\n".join(["wild rice", "Cheap Feed", "WILD RICE"] * 10),
    "stuffed": "Looking for honey? Our honey is the best honey for anyone who wants honey. Every honey fan knows honey means quality honey. " * 4,
    "agenda": "Agenda\n1. Visit to Talva Creek\n2. Budget for March\n3. Motion to repair the fish weir\n4. Budget for May\n5. Honey report",
    "glossary": "Word list\ngulichur - pottery\nnunohon - sweetgrass\njudatum - firewood\nshogumir - wild rice\njuzoju - maple syrup",
    "vtt": "WEBVTT\n\n1\n00:00:01.000 --> 00:00:02.000\nSpeaker 1: We tried wool once, and it paid off.\n\n2\n00:00:03.000 --> 00:00:04.000\nSpeaker 2: Yes.",
    "cited": PROSE + "\n\nhttps://a.example/x\n\n" + PROSE,
}
SPAM = {"links", "tags", "menu", "words", "stuffed"}


def test_pages(spark, tiny):
    documents = spark.read.parquet(f"{tiny}/../sf0.01/documents.parquet")
    rows = spark.createDataFrame(list(PAGES.items()), "doc_id string, text string")
    model = learn_lines(documents, "doc_id", "text")
    got = {r.doc_id for r in label_pages(rows, "doc_id", "text", model).where("flagged").collect()}
    assert got == SPAM


def test_label_path_is_the_best_of_all(spark, tiny):
    from itertools import product

    texts = pd.read_parquet(f"{tiny}/documents.parquet").text.dropna()
    counts = sum((count_lines(t) for t in texts), start=count_lines(""))
    labeller = Labeller(fit(counts))
    model = labeller.model
    text = "\n".join([PROSE, "https://a.example/b https://c.example", "cheap honey, best honey, buy honey, honey sale", "Home > Buy > Honey"])
    from sessionloom.llm.lines import page_lines

    own = [labeller.emission(v) for _, v in page_lines(text)]
    score = lambda p: model.start[p[0]] + own[0][p[0]] + sum(model.step[a][b] + own[i][b] for i, (a, b) in enumerate(zip(p, p[1:], strict=False), 1))
    best = max(product(range(len(model.start)), repeat=len(own)), key=score)
    assert score([s for s, _ in labeller.label(text)]) == pytest.approx(score(best))


def test_label_pages_edge_cases(spark, tiny):
    model = learn_lines(spark.read.parquet(f"{tiny}/documents.parquet"), "doc_id", "text")
    rows = spark.createDataFrame([(1, None, True), (2, "", True), (3, "\n \n", True), (4, "wild rice\n" * 60_000, True), (4, "wild rice\n" * 60_000, True)], "doc_id long, text string, flagged boolean")
    got = sorted((r.doc_id, r.words > 0, r.flagged) for r in label_pages(rows, "doc_id", "text", model).collect())
    assert got == [(1, False, False), (2, False, False), (3, False, False), (4, True, True), (4, True, True)]
    assert label_pages(rows.limit(0), "doc_id", "text", learn_lines(rows.limit(0), "doc_id", "text")).count() == 0
