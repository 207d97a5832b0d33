"""Queries p3 to p9 on the project's tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionloom.llm.canonical import assign_canonical
from sessionloom.llm.confusables import clean_dictionary
from sessionloom.llm.lines import label_pages, learn_lines
from sessionloom.llm.mixing import mix_sources
from sessionloom.llm.packing import container_fill, pack_documents
from sessionloom.llm.personal import find_personal, learn_names, split_mentions
from sessionloom.llm.tokens import with_token_count
from sessionloom.llm.variants import entity_pairs, link_variants
from sessionloom.session import table


def _field(df: DataFrame, name: str, key: str, column: str, *more) -> DataFrame:
    return df.select(F.lit(name).alias("field_name"), F.col(key).alias("row_id"), F.col(column).alias("value"), *more)


def _tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """transcript_tags, of a tag_id delivered more than once the row loaded last."""
    tags = table(spark, sf_dir, "transcript_tags").select("tag_id", "source_file", "tag_category", "matched_text", "context", "loaded_at")
    latest = F.max_by(F.struct("source_file", "tag_category", "matched_text", "context"), "loaded_at").alias("t")
    return tags.groupBy("tag_id").agg(latest).select("tag_id", "t.*")


def p3_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contexts, quotes and notes with typed placeholders, and what was found in them."""
    people = table(spark, sf_dir, "transcript_tags").where("tag_category = 'ENTITY_Person'")
    rolls = table(spark, sf_dir, "native_american_names").selectExpr("first_name as first", "last_name as last")
    lexicon = learn_names(rolls.unionByName(split_mentions(people, "matched_text")), "first", "last")
    rows = [
        _field(table(spark, sf_dir, "transcript_tags"), "transcript_tags.context", "tag_id", "context"),
        _field(table(spark, sf_dir, "interview_quotes"), "interview_quotes.quote", "quote_id", "quote"),
        _field(table(spark, sf_dir, "interview_evidence"), "interview_evidence.note", "evidence_id", "note"),
    ]
    return find_personal(reduce(DataFrame.unionByName, rows).withColumnRenamed("value", "text"), lexicon)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct stretch of personal information by row and kind."""
    found = p3_redacted(spark, sf_dir).select("field_name", "row_id", F.explode("found").alias("f"))
    return found.select("field_name", "row_id", "f.kind", "f.surface").distinct()


def p4_mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every free-entered value with the canonical entry it means, 0 if the list has none."""
    places, tags = table(spark, sf_dir, "place_names"), table(spark, sf_dir, "transcript_tags")
    no_hint = F.lit(None).cast("string")
    rows = [
        _field(places.where("place_type is null or place_type <> 'district'"), "place_names.name", "id", "name", F.lit("place").alias("kind"), F.col("state").alias("hint")),
        _field(places, "place_names.tribal_affiliation", "id", "tribal_affiliation", F.lit("affiliation").alias("kind"), no_hint.alias("hint")),
        _field(tags.where("tag_category = 'ENTITY_Place'"), "transcript_tags.matched_text", "tag_id", "matched_text", F.lit("place").alias("kind"), no_hint.alias("hint")),
        _field(tags.where("tag_category = 'ENTITY_Tribe'"), "transcript_tags.matched_text", "tag_id", "matched_text", F.lit("affiliation").alias("kind"), no_hint.alias("hint")),
    ]
    values = reduce(DataFrame.unionByName, rows).where("value is not null and value <> ''")
    return assign_canonical(values, table(spark, sf_dir, "canonical_names"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mapping as distinct cases."""
    return p4_mapped(spark, sf_dir).select("field_name", "row_id", "ref_id").distinct()


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every co-op and place name that isn't in clean form, with the clean form."""
    rows = _field(table(spark, sf_dir, "interview_evidence"), "interview_evidence.coop", "evidence_id", "coop").unionByName(
        _field(table(spark, sf_dir, "place_names"), "place_names.name", "id", "name")
    )
    return clean_dictionary(rows, "value").select("field_name", "row_id", "clean_text")


def p6_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every named row with its entity."""
    nothing = F.lit(None).cast("string")

    def rows(df: DataFrame, field: str, kind, key: str, group: str, name: str, second=nothing, refine=nothing) -> DataFrame:
        columns = [F.lit(field).alias("field"), F.col(key).alias("row_id"), kind.alias("kind"), F.col(group).alias("group")]
        return df.select(*columns, F.col(name).alias("name"), second.alias("second"), refine.alias("refine"))

    names = table(spark, sf_dir, "native_american_names").where("first_name is not null")
    places = table(spark, sf_dir, "place_names").where("place_type = 'district'")
    tags = _tags(spark, sf_dir).where("tag_category in ('ENTITY_Person', 'ENTITY_Organization')")
    tag_kind = F.lower(F.substring_index("tag_category", "_", -1))
    parts = [
        rows(names, "native_american_names", F.lit("person"), "id", "source", "first_name", F.col("last_name"), F.col("tribe_origin")),
        rows(places, "place_names.name", F.lit("district"), "id", "source", "name", refine=F.col("state")),
        rows(tags, "transcript_tags.matched_text", tag_kind, "tag_id", "source_file", "matched_text"),
    ]
    return link_variants(reduce(DataFrame.unionByName, parts))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of rows that mean the same person, district or organisation."""
    return entity_pairs(p6_entities(spark, sf_dir)).withColumnRenamed("field", "field_name")


def p7_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's container, for each capacity."""
    # one plan per kind of container, so their number bounds nothing but the result
    sizes = [(r["container"], r["capacity_tokens"]) for r in table(spark, sf_dir, "container_sizes").orderBy("container").toLocalIterator()]
    return pack_documents(table(spark, sf_dir, "documents"), sizes, "doc_id", "text")


def p7_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How full the containers of each capacity are."""
    return container_fill(p7_plan(spark, sf_dir), table(spark, sf_dir, "container_sizes"))


def p7_placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each capacity and document: how often it was placed, and how many of its containers hold too much."""
    plan = p7_plan(spark, sf_dir)
    loads = plan.groupBy("container", "container_id").agg(F.sum("n_tokens").alias("load"))
    sizes = table(spark, sf_dir, "container_sizes").select("container", "capacity_tokens")
    full = loads.join(sizes, "container").withColumn("over", (F.col("load") > F.col("capacity_tokens")).cast("long"))
    each = plan.join(full.select("container_id", "over"), "container_id")
    return each.groupBy("container", "doc_id").agg(F.count_if(F.col("part") == 0).alias("placed"), F.sum("over").alias("overfull"))


def _mix(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    documents = with_token_count(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), "text")
    return mix_sources(documents, table(spark, sf_dir, "mix_targets"))


def p8_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The drawn documents with their repeats, in the order of the mix."""
    return _mix(spark, sf_dir)[0]


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share each source reached."""
    return _mix(spark, sf_dir)[1]


def p8_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each target source: whether no document is repeated beyond the cap, and the share is met as closely as whole documents allow.

    Each source is off its quota by at most half of its longest document; together they put the total off by as much.
    A source without tokens has no share, and the others have it in proportion.
    """
    _, shares = _mix(spark, sf_dir)
    sized = with_token_count(table(spark, sf_dir, "documents").select("source", "text"), "text")
    longest = sized.groupBy("source").agg(F.max("n_tokens").alias("longest"))
    joined = shares.join(longest, "source", "left").na.fill(0, ["longest"])
    whole = joined.agg(F.sum("tokens").alias("whole"), F.sum(F.when(F.col("longest") > 0, F.col("target_share"))).alias("weight"), (F.sum("longest") / 2).alias("halves"))
    share = F.when(F.col("longest") > 0, F.col("target_share") / F.col("weight")).otherwise(0.0)
    met = F.abs(F.col("tokens") - share * F.col("whole")) <= F.col("longest") / 2 + share * F.col("halves") + 1
    return joined.join(F.broadcast(whole)).select("source", (F.col("most_repeats") <= F.col("max_repeats")).alias("within_cap"), met.alias("share_met"))  # whole is one row


def p9_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words, share of them outside prose, and whether it is flagged."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return label_pages(documents, "doc_id", "text", learn_lines(documents, "doc_id", "text"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of which the greater part is keywords, links or tags."""
    return p9_pages(spark, sf_dir).where("flagged").select("doc_id").distinct()


_ALL = (p3_found, p3_redacted, p4_found, p5_found, p6_found, p6_entities, p7_plan, p7_fill, p7_placed, p8_plan, p8_shares, p8_kept, p9_found, p9_pages)
QUERIES = {query.__name__: query for query in _ALL}
#: Plans have no answer in SQL; what must hold of them has.
ORACLE: dict[str, str] = {
    "p7_placed": "SELECT container, doc_id, CAST(1 AS BIGINT) AS placed, CAST(0 AS BIGINT) AS overfull FROM container_sizes, documents",
    "p8_kept": "SELECT source, true AS within_cap, true AS share_met FROM mix_targets",
}
