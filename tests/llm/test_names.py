"""Canonical values and variant spellings, against brute force on small fixtures."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sessionloom.llm.canonical import _entry, _weights, assign_canonical, check, map_to_canonical, normal_words
from sessionloom.llm.spelling import abbreviates, common_length, edits, lcs_ratio, within
from sessionloom.llm.variants import KINDS, LETTERS, compare_person, entity_pairs, link_variants, parse_district, parse_organization, parse_person, sketch, typo

PLACES = ["Lommishaw Creek", "Lommishaw Landing", "Peloshaw Village", "Upper Peloshaw Village", "Talvane Creek", "Talvane Springs", "Drávajass Village", "Drávajass Crossing", "Krellridan", "Ruskfjell Village", "Brumejass Creek", "Orrinlente Crossing", "Ulmerholm Springs", "Aldranicket Springs", "Weskmoor Landing", "Holtudorn Landing", "Griskfroom Crossing"]
STATES = ["QA", "QA", "QR", "QD", "QV", "QF", "QN", "QB", "QT", "QN", "QD", "QL", "QA", "QA", "QA", "QA", "QA"]


@pytest.fixture
def reference(spark):
    rows = [(i, "place", n, s) for i, (n, s) in enumerate(zip(PLACES, STATES, strict=True), 1)] + [(99, "place", None, None), (98, "place", " ", None)]
    return spark.createDataFrame(rows, "ref_id long, kind string, name string, state string")


VALUES = {
    "Lommishaw Crk": 1, "lommishae landing": 2, "LommishawLanding": 2, "Landing, Lommishaw": 2, "near Peloshaw Vlg": 3, "Upper Peloshaw Vlg.": 4, "Talvane Creek (QV)": 5, "Talvnae Spgs": 6, "dravajass xing": 8, "KRELLRIDAN": 9,
    "Krelridan, QT": 9, "Hushewixen Village": 0, "Rakejass Creek": 0, "Griscfrum Xing": 17, "Orrinlemte Krossing": 12, "home": 0, "?": 0, "Talvane": 0, "Talvane Falls": 0, "Ruskfjell_Village": 10, "the Orrinlente Crsg": 12,
}


def test_map_to_canonical(spark, reference):
    values = spark.createDataFrame([("place", v, None) for v in VALUES] + [("place", None, None), ("place", "", None), ("place", "Drávajass", "QB"), ("place", "Drávajass", None), ("other", "Talvane Creek", None)], "kind string, value string, hint string")
    got = {(r.kind, r.value, r.hint): r.ref_id for r in map_to_canonical(values, reference).collect()}
    assert {v: got[("place", v, None)] for v in VALUES} == VALUES
    assert got[("place", "Drávajass", "QB")] == 8 and got[("place", "Drávajass", None)] == 0
    assert got[("place", None, None)] == got[("place", "", None)] == got[("other", "Talvane Creek", None)] == 0


def brute(spark, names, values, threshold=0.3, margin=0.1):
    """The mapping by comparison of every value with every entry."""
    entries = [(i, " ".join(normal_words(n))) for i, n in enumerate(names, 1)]
    weights = _weights(spark.createDataFrame([(i, "place", n) for i, n in entries], "ref_id long, kind string, norm string"))
    kinds, out = weights.kinds["place"], {}
    for value in values:
        norm, scored = " ".join(normal_words(value)), []
        for i, entry in entries:
            cosine = weights.cosine("place", norm, entry)
            distance = check(norm.split(" "), _entry(i, entry, kinds), kinds)
            if norm and cosine >= threshold and distance is not None:
                scored.append((cosine, distance, i))
        best = max((c for c, _, _ in scored), default=0)
        close = [s for s in scored if best - s[0] < margin]
        least = [s for s in close if s[1] == min(s[1] for s in close)]
        out[value] = close[0][2] if len(close) == 1 else least[0][2] if len(least) == 1 else 0
    return out


def test_index_finds_what_all_pairs_find(spark, reference):
    values = list(VALUES)
    frame = spark.createDataFrame([("place", v, None) for v in values], "kind string, value string, hint string")
    got = {r.value: r.ref_id for r in map_to_canonical(frame, reference).collect()}
    assert got == brute(spark, PLACES, values)
    assert check(["talvane", "creek"], _entry(1, "lommishaw creek", frozenset({"creek"})), frozenset({"creek"})) is None


def test_index_on_the_tables(spark, tiny):
    known = [r for r in spark.read.parquet(f"{tiny}/canonical_names.parquet").where("kind = 'place'").collect()]
    values = [r[0] for r in spark.read.parquet(f"{tiny}/place_names.parquet").where("place_type <> 'district' and trim(name) <> ''").select("name").distinct().collect()]
    listed = spark.createDataFrame([(i, "place", r.name, None) for i, r in enumerate(known, 1)], "ref_id long, kind string, name string, state string")
    frame = spark.createDataFrame([("place", v, None) for v in values], "kind string, value string, hint string")
    got = {r.value: r.ref_id for r in map_to_canonical(frame, listed).collect()}
    assert got == brute(spark, [r.name for r in known], values) and sum(map(bool, got.values())) > 20


def test_lists_of_any_size(spark):
    """More entries than are broadcast: the index is joined by shuffle."""
    listed = spark.range(30_000).selectExpr("id as ref_id", "'place' as kind", "concat('Q', translate(cast(id * 7919 as string), '0123456789', 'abelmorstu'), ' Creek') as name", "cast(null as string) as state")
    asked = listed.where("ref_id % 3000 = 7").selectExpr("kind", "upper(name) as value", "state as hint", "ref_id")
    got = {r.value: r.ref_id for r in map_to_canonical(asked, listed).collect()}
    assert got == {r.value: r.ref_id for r in asked.collect()}


def test_assign_canonical_edge_cases(spark, reference):
    rows = spark.createDataFrame([("f", 1, "place", "Talvane Creek", None, 7), ("f", 1, "place", "Talvane Creek", None, 7), ("f", 2, "place", "x" * 100_000, None, 7), ("f", None, "place", None, None, 7)], "field_name string, row_id long, kind string, value string, hint string, ref_id long")
    got = sorted(((r.row_id or 0), r.ref_id) for r in assign_canonical(rows, reference).collect())
    assert got == [(0, 0), (1, 5), (1, 5), (2, 0)]
    assert assign_canonical(rows.limit(0), reference).count() == 0
    assert {r.ref_id for r in assign_canonical(rows, reference.limit(0)).collect()} == {0}


def test_measures():
    assert edits("kitten", "sitting") == 3 and edits("ab", "ba") == 1
    assert common_length("abcde", "ace") == 3 and lcs_ratio("abc", "abc") == 1.0
    assert within("dravajass", "dravjaass", 2) and not within("abcdef", "uvwxyz", 3)
    assert abbreviates("vlg", "village") and abbreviates("xing", "crossing") and not abbreviates("pt", "village")


def test_parsers():
    assert parse_person("Dr. Avery J.", "Stone-Field") == ("avery", "stonefield")
    assert parse_person("Stonefield, Avery", None) == ("avery", "stonefield")
    assert parse_person("Elder Avery Stonefield", None) == ("avery", "stonefield")
    assert parse_person("A.", "Stonefield") == ("a", "stonefield")
    assert parse_organization("Guild of Oruvale") == ("oruvale", "guild") and parse_organization("P.H.C.") == ("phc",)
    assert parse_district("Skomaquash, Chapter No. VI") == parse_district("Chapter Six of Skomaquash") == ("skomaquash", "chapter", "6")
    assert parse_person(None, None) == ("", "")


ROWS = [
    (1, "person", "g", "Avery", "Stonefield", "x"), (2, "person", "g", "Averi", "Stonefield", None), (3, "person", "g", "Stonefield", "Avery", None), (4, "person", "g", "A.", "Stonefield", "x"),
    (5, "person", "g", "Rowan", "Valecrest", "x"), (6, "person", "g", "Rowan", "Valecrest", "y"), (7, "person", "h", "Avery", "Stonefield", "x"), (8, "person", "g", "Tamsin", "Underhill", None),
    (9, "person", "g", "Tam", "Underhill", None), (10, "person", "g", "Tamarind", "Overbrook", None), (11, "person", "g", "Avery", "Stonefield", "x"), (12, "person", None, "Avery", "Stonefield", "x"),
    (13, "person", "g", None, None, None), (14, "person", "g", "", "", None), (15, "organization", "g", "Oruvale Weavers Guild", None, None), (16, "organization", "g", "Weavers Guild of Oruvale", None, None),
    (17, "organization", "g", "O.W.G.", None, None), (18, "organization", "g", "The Oruvale Weavers", None, None), (19, "district", "g", "Skomaquash Chapter 6", None, None), (20, "district", "g", "Chptr Six of Scomaquash", None, None),
    (21, "district", "g", "Skomaquash Chapter 7", None, None), (22, "person", "k", "K.", "Crestfern", None), (23, "person", "k", "Kasuron", "Crestfern", None), (24, "person", "k", "Kelobira", "Crestfern", None),
]
WANT = {frozenset(p) for p in [(1, 2), (1, 3), (1, 4), (1, 11), (2, 3), (2, 4), (2, 11), (3, 4), (3, 11), (4, 11), (8, 9), (15, 16), (15, 17), (15, 18), (16, 17), (16, 18), (17, 18), (19, 20)]}


def people(spark, rows):
    return spark.createDataFrame([("f", *r, "extra") for r in rows], "field string, row_id long, kind string, group string, name string, second string, refine string, entity string")


def test_link_variants(spark):
    linked = link_variants(people(spark, ROWS))
    assert {frozenset((r.id_a, r.id_b)) for r in entity_pairs(linked).collect()} == WANT
    assert {r.row_id for r in linked.collect()} == {r[0] for r in ROWS} - {12, 13, 14}


def test_links_do_not_depend_on_the_number_of_groups(spark):
    rows = [("person", "Wilavik", "Yelkovane", "x"), ("person", "Wilavik", "Yrlkovane", "x"), ("person", "Otlinda", "Wyntennick", None), ("person", "Wyntennick", "Orlinda", None), ("district", "Griskgorra Ward 2", None, "QA"), ("district", "Griscgorra Ward 2", None, "QA"), ("organization", "Pelokotte Land Trust", None, None), ("organization", "Pelocotte Land Trust", None, None)]
    spelled = [(100 * g + i, kind, f"g{g}", name, second, refine) for g in range(4) for i, (kind, name, second, refine) in enumerate(rows)]
    got = {frozenset((r.id_a, r.id_b)) for r in entity_pairs(link_variants(people(spark, spelled))).collect()}
    assert got == {frozenset((100 * g + i, 100 * g + i + 1)) for g in range(4) for i in (0, 2, 4, 6)}
    assert compare_person(("zarnethko", "felilisa"), ("orlilisa", "sabbethko")) is None
    assert compare_person(("zarnethko", "felilisa"), ("zarnetkho", "orlilisa")) == "same"


def test_empty_repeated_and_long(spark):
    df = people(spark, [(1, "person", "g", "Avery " * 5_000, "Stonefield", None), (1, "person", "g", "Avery " * 5_000, "Stonefield", None), (2, "person", "g", "Rowan", "Valecrest", None)])
    assert link_variants(df).count() == 3 and entity_pairs(link_variants(df)).count() == 0
    assert link_variants(df.limit(0)).count() == 0


def brute_links(rows):
    """Pairs of rows that one comparison of all names of a group finds the same."""
    parsed = [(r[0], r[1], r[2], KINDS[r[1]].parse(r[3], r[4]), r[5].lower() if r[5] else None) for r in rows]
    out = set()
    for i, a in enumerate(parsed):
        for b in parsed[i + 1 :]:
            if a[1:3] == b[1:3] and (a[4] is None or b[4] is None or a[4] == b[4]):
                agree = a[4] is not None and a[4] == b[4]
                if "same" in (KINDS[a[1]].compare(a[3], b[3], agree), KINDS[a[1]].compare(b[3], a[3], agree)):
                    out.add(frozenset((a[0], b[0])))
    return out


@pytest.mark.parametrize("kind", ["person", "district", "organization"])
@pytest.mark.parametrize("common", [40, 4])
def test_blocking_loses_no_link(spark, tiny, kind, common):
    read = lambda name: spark.read.parquet(f"{tiny}/../sf0.01/{name}.parquet")
    if kind == "person":
        rows = [(r.id, kind, r.source, r.first_name, r.last_name, r.tribe_origin) for r in read("native_american_names").where("first_name is not null and source is not null").collect()]
    elif kind == "district":
        rows = [(r.id, kind, r.source, r.name, None, r.state) for r in read("place_names").where("place_type = 'district' and name is not null and source is not null").collect()]
    else:
        rows = [(r.tag_id, kind, "one session", r.matched_text, None, None) for r in read("transcript_tags").where("tag_category = 'ENTITY_Organization' and matched_text is not null").dropDuplicates(["tag_id"]).collect()]
    want = brute_links(rows)
    got = {frozenset((r.id_a, r.id_b)) for r in entity_pairs(link_variants(people(spark, rows), common_block=common)).collect()}
    assert len(want) > 50 and len(want & got) >= (0.999 if common == 40 else 0.99) * len(want)


@settings(max_examples=300, deadline=None)
@given(st.text("abcdefghiklmnorstuvwy", min_size=4, max_size=12), st.lists(st.tuples(st.integers(0, 12), st.sampled_from("abcdefghiklmnorstuvwy"), st.booleans()), max_size=3))
def test_sketches_of_misspelt_tokens_are_alike(token, changes):
    other = token
    for at, letter, drop in changes:
        at = min(at, len(other))
        other = other[:at] + other[at + 1 :] if drop and at < len(other) else other[:at] + letter + other[at:]
    if other and typo(token, other):
        a, b = sketch(token), sketch(other)
        letters = min(((a ^ b) & LETTERS).bit_count(), ((a ^ b) >> 26 & LETTERS).bit_count())
        assert letters <= (4 if min(len(token), len(other)) < 9 else 6)
