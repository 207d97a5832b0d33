"""Container packing and source mixing: constraints, brute force, edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sessionloom.llm.mixing import block_slots, mix_sources
from sessionloom.llm.packing import Corpus, ShardIndex, container_fill, pack_documents
from sessionloom.llm.tokens import encoder, with_token_count

CAPACITIES = [("small", 40), ("large", 200)]


def test_token_counts(spark):
    df = spark.createDataFrame([(1, "Hello there <|endoftext|>"), (2, None), (3, "")], "id long, text string")
    got = {r.id: r.n_tokens for r in with_token_count(df, "text").collect()}
    assert got[1] == len(encoder().encode_ordinary("Hello there <|endoftext|>")) > 4 and got[2] == got[3] == 0


def test_packing_constraints(spark, tiny):
    documents = spark.read.parquet(f"{tiny}/documents.parquet").withColumn("part", F.lit("clash"))
    plan = pack_documents(documents, CAPACITIES, "doc_id", "text", shard_documents=60)
    rows = plan.collect()
    sizes = {r.doc_id: r.n_tokens for r in with_token_count(documents.select("doc_id", "text"), "text").collect()}
    for name, capacity in CAPACITIES:
        own = [r for r in rows if r.container == name]
        loads, tokens, parts = {}, {}, {}
        for r in own:
            loads[r.container_id] = loads.get(r.container_id, 0) + r.n_tokens
            tokens[r.doc_id] = tokens.get(r.doc_id, 0) + r.n_tokens
            parts[r.doc_id] = parts.get(r.doc_id, 0) + 1
        assert max(loads.values()) <= capacity and tokens == sizes
        assert all(parts[d] == max(1, -(-n // capacity)) for d, n in sizes.items())
        assert sum(loads.values()) > 0.9 * capacity * len(loads)
    capacities = spark.createDataFrame(CAPACITIES, "container string, capacity_tokens int")
    assert {r.container: r.documents for r in container_fill(plan, capacities).collect()} == {n: len(sizes) for n, _ in CAPACITIES}


def test_scores_are_bm25_over_all_terms():
    rng = np.random.default_rng(3)
    texts = [rng.integers(0, 60 if i % 3 else 400, rng.integers(0, 120)) for i in range(90)]
    sizes = np.array([t.size for t in texts])
    packed = [np.unique(t.astype(np.uint32), return_counts=True) for t in texts]
    frequency = np.bincount(np.concatenate([t for t, _ in packed]), minlength=400) * 3
    corpus = Corpus(270, float(sizes.mean()), frequency)
    index = ShardIndex(sizes, [t for t, _ in packed], [n.astype(np.uint32) for _, n in packed], corpus)
    for a in range(90):
        want = np.zeros(90)
        for b, (terms, counts) in enumerate(packed):
            for term, tf in zip(terms, counts, strict=True):
                if term in packed[a][0]:
                    idf = np.log1p((270 - frequency[term] + 0.5) / (frequency[term] + 0.5))
                    want[b] += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * sizes[b] / sizes.mean()))
        assert np.allclose(index.scores(a), want, rtol=1e-4, atol=1e-4)


def test_packing_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "wool " * 50_000), (4, "wool"), (4, "wool")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = pack_documents(df, CAPACITIES, "doc_id", "text").where("container = 'small'").collect()
    assert sorted(r.doc_id for r in got if r.part == 0) == [1, 2, 3, 4, 4]
    assert pack_documents(df.limit(0), CAPACITIES, "doc_id", "text").count() == 0


@pytest.mark.parametrize("blocks", [{"a": 300, "b": 120, "c": 160, "d": 420}, {"a": 9}, {"a": 333, "b": 333, "c": 334}, {"a": 2_499, "b": 1}, {"a": 7, "b": 0, "c": 5}, {}])
def test_schedule_deviates_by_less_than_a_block(blocks):
    slots = block_slots(blocks)
    total = sum(blocks.values())
    assert sorted(s for v in slots.values() for s in v) == list(range(total)) and {n: len(v) for n, v in slots.items()} == blocks
    for own in slots.values():
        done = 0
        for t in range(1, total + 1):
            done += done < len(own) and own[done] < t
            assert abs(done - len(own) * t / total) < 1


def documents(spark, rows):
    return spark.createDataFrame([(i, s, n, "clash") for i, (s, n) in enumerate(rows)], "doc_id long, source string, n_tokens long, slot string")


def furthest(draws, shares):
    """The most tokens by which a source is away from its share of the mix, after any slot."""
    done, most, last = dict.fromkeys(shares, 0), 0, None
    for r in draws.orderBy("slot", "place").collect():
        if r.slot != last:
            most, last = max([most, *(abs(done[s] - w * sum(done.values())) for s, w in shares.items())]), r.slot
        done[r.source] += r.n_tokens
    return most


def test_documents_longer_than_a_block(spark):
    rows = [("long", 900 + i) for i in range(40)] + [("short", 7)] * 6_000
    targets = spark.createDataFrame([("long", 0.5, 1), ("short", 0.5, 1)], "source string, target_share double, max_repeats int")
    draws, shares = mix_sources(documents(spark, rows), targets, block=100)
    assert furthest(draws, {"long": 0.5, "short": 0.5}) < 100 + 939
    assert all(r.share == pytest.approx(0.5, abs=0.01) for r in shares.collect())


def test_tiny_sources_are_drawn(spark):
    rows = [("big", 100)] * 5_000 + [("tiny", 10)] * 30 + [("least", 1)]
    targets = spark.createDataFrame([("big", 0.9996, 1), ("tiny", 0.0004, 1), ("least", 1e-7, 1), ("tiny", 0.0001, 1)], "source string, target_share double, max_repeats int")
    draws, shares = mix_sources(documents(spark, rows), targets)
    got = {r.source: r for r in shares.collect()}
    assert got["tiny"].tokens == pytest.approx(200, abs=10) and got["least"].draws <= 1 and len(got) == 3
    assert draws.where("slot is null").count() == 0
    with pytest.raises(ValueError):
        mix_sources(documents(spark, rows), targets, most_slots=2)


def test_mix_meets_shares_and_caps(spark):
    rows = [("big", 50 + i % 7) for i in range(900)] + [("mid", 80)] * 200 + [("rare", 30)] * 20 + [("none", 10)] * 50 + [(None, 10), ("big", None), ("big", 0)]
    targets = spark.createDataFrame([("big", 0.6, 1), ("mid", 0.3, 2), ("rare", 0.1, 4), ("gone", 0.2, 3)], "source string, target_share double, max_repeats int")
    draws, shares = mix_sources(documents(spark, rows), targets, block=256, bucket_rows=100)
    got = {r.source: r for r in shares.collect()}
    assert got["gone"].tokens == 0 and got["rare"].most_repeats == 4
    for name, share in (("big", 0.6), ("mid", 0.3), ("rare", 0.1)):
        assert got[name].share == pytest.approx(share, abs=0.01)
    per = draws.groupBy("doc_id").agg(F.count("*").alias("n"), F.max("repeats").alias("r"), F.max("repeat_no").alias("last"))
    assert per.where("n <> r or n <> last").count() == 0
    assert furthest(draws, {"big": 0.6, "mid": 0.3, "rare": 0.1}) < 256 + 80
    assert draws.where("source is null or source = 'none'").count() == 0


def test_mix_edge_cases(spark):
    targets = spark.createDataFrame([("a", 1.0, 2)], "source string, target_share double, max_repeats int")
    draws, shares = mix_sources(documents(spark, []), targets)
    assert draws.count() == 0 and [(r.tokens, r.share) for r in shares.collect()] == [(0, None)]
    draws, _ = mix_sources(documents(spark, [("a", 5), ("a", 5)]), targets)
    assert draws.count() == 4
    draws, shares = mix_sources(documents(spark, [("a", 5)]), targets.limit(0))
    assert draws.count() == 0 and shares.count() == 0
