"""Sources mixed to target weights by Pfair scheduling.

A source's draws stand in a fixed order of passes over its documents; a document's draw covers a stretch of tokens in
it. Blocks of equal token size are the jobs of a task per source: of ``n`` blocks among ``N`` in all, block ``k`` is
released at ``floor(k * N / n)`` and due at ``ceil((k + 1) * N / n)``. Earliest deadline first gives each block its
slot, and in any prefix of the slots a source lies less than one block from its share. Deadlines are exact integers
over the whole mix, so nothing drifts however long it is; the number of slots is bounded by the size of a block.
"""

from __future__ import annotations

from heapq import heappop, heappush

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionloom.session import broadcast_if_small, cut

#: Slots of a mix at most: a larger mix has larger blocks. The schedule of all slots is made on the driver.
MOST_SLOTS = 1 << 18


def block_slots(blocks: dict[str, int]) -> dict[str, list[int]]:
    """For each source the slots of its blocks, by earliest deadline first; as many slots as there are blocks.

    Sources without blocks have no slots. Ties of deadlines go to the name that comes first.
    """
    total = sum(blocks.values())
    slots: dict[str, list[int]] = {name: [] for name in blocks}
    released: list[tuple[int, int, str]] = [(0, -(-total // n), name) for name, n in sorted(blocks.items()) if n > 0]
    ready: list[tuple[int, str]] = []
    for slot in range(total):
        while released and released[0][0] <= slot:
            _, deadline, name = heappop(released)
            heappush(ready, (deadline, name))
        deadline, name = heappop(ready)
        if deadline <= slot:
            raise AssertionError("a deadline was missed")
        slots[name].append(slot)
        k, n = len(slots[name]), blocks[name]
        if k < n:
            heappush(released, (max(k * total // n, slot + 1), -(-(k + 1) * total // n), name))
    return slots


def mix_sources(documents: DataFrame, targets: DataFrame, key: str = "doc_id", size: str = "n_tokens", block: int = 4_096, bucket_rows: int = 50_000, most_slots: int = MOST_SLOTS) -> tuple[DataFrame, DataFrame]:
    """(draws, shares) of ``documents`` (key, source, size) mixed to ``targets`` (source, target_share, max_repeats).

    The mix is the largest one in which every source meets its share without exceeding its cap: its total is the least
    of ``size of a source * max_repeats / target_share``. ``draws`` has one row per drawn document and repeat: ``slot``
    and ``place`` (the order of the mix), the key, ``source``, ``repeat_no`` (from 1), ``repeats`` of the document and
    its size. ``shares`` has one row per target source: documents and draws, sizes, shares wanted and reached.

    Documents of size zero or NULL, and of sources without target, are never drawn; a source that has no tokens gets
    none, and the others share the mix in proportion. Repeated keys are drawn as separate documents; of targets that
    name a source again the one with the greatest share stands. A draw counts if its middle lies within the source's
    quota, so shares are met to within half a document per source.

    A document is drawn whole in the block in which it starts. After any slot a source is therefore less than one block
    and one of its documents away from its share of the mix so far. ``block`` is raised where the mix would need more
    than ``most_slots`` of them. Every source that is drawn has a slot, so more sources than slots are refused.
    """
    wanted = targets.where("source is not null and target_share > 0 and max_repeats > 0")
    wanted = wanted.groupBy("source").agg(F.max(F.struct("target_share", "max_repeats")).alias("t")).select("source", "t.*")
    spark = documents.sparkSession
    sized = documents.where(F.col(size) > 0).select(F.col(f"`{key}`").alias("__key"), "source", F.col(f"`{size}`").alias("__size"))
    sized = cut(sized.join(broadcast_if_small(wanted.select("source")), "source", "left_semi"))
    buckets = max(1, -(-sized.count() // bucket_rows))
    ordered = sized.withColumn("__hash", F.xxhash64("__key", F.lit("mix"))).withColumn("__bucket", F.floor((F.col("__hash") / F.lit(2.0**64) + 0.5) * buckets).cast("long"))

    per_bucket = ordered.groupBy("source", "__bucket").agg(F.sum("__size").alias("__sum"))
    before = F.coalesce(F.sum("__sum").over(Window.partitionBy("source").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = per_bucket.select("source", "__bucket", before.alias("__before"))
    totals = per_bucket.groupBy("source").agg(F.sum("__sum").alias("total"))
    live = wanted.join(totals, "source").limit(most_slots + 1).collect()
    if len(live) > most_slots:
        raise ValueError(f"more than {most_slots} sources to mix")
    weight = sum(r["target_share"] for r in live)
    whole = min((r["total"] * r["max_repeats"] * weight / r["target_share"] for r in live), default=0.0)
    quotas = {r["source"]: max(1, round(r["target_share"] / weight * whole)) for r in live}
    block = max(block, -(-sum(quotas.values()) // max(1, most_slots - len(live))))
    slots = block_slots({s: -(-quota // block) for s, quota in quotas.items()})
    plan = [(r["source"], int(r["total"]), quotas[r["source"]], int(r["max_repeats"]), slots[r["source"]]) for r in live]
    # at most most_slots numbers
    plan_df = F.broadcast(spark.createDataFrame(plan, "source string, total long, quota long, cap int, slots array<int>"))

    inside = Window.partitionBy("source", "__bucket").orderBy("__hash", "__key").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        ordered.withColumn("__start", F.coalesce(F.sum("__size").over(inside), F.lit(0)))
        .join(offsets, ["source", "__bucket"])
        .withColumn("__start", F.col("__start") + F.col("__before"))
        .join(plan_df, "source")
        .withColumn("repeats", F.greatest(F.lit(0), F.least("cap", F.ceil((F.col("quota") - F.col("__start") - F.col("__size") / 2) / F.col("total")))).cast("int"))
        .where("repeats > 0")
    )
    draws = placed.withColumn("repeat_no", F.explode(F.sequence(F.lit(1), "repeats"))).withColumn("__at", F.col("__start") + (F.col("repeat_no") - 1) * F.col("total"))
    draws = draws.select(
        F.element_at("slots", F.floor(F.col("__at") / block).cast("int") + 1).cast("long").alias("slot"),
        (F.col("__at") % block).cast("long").alias("place"),
        F.col("__key").alias(key),
        "source",
        "repeat_no",
        "repeats",
        F.col("__size").alias(size),
    )
    reached = draws.groupBy("source").agg(
        F.countDistinct(key).alias("documents"), F.count("*").alias("draws"), F.max("repeats").alias("most_repeats"), F.sum(size).alias("tokens")
    )
    every = F.sum("tokens").over(Window.partitionBy(F.lit(0)))
    named = targets.where("source is not null").groupBy("source").agg(F.max(F.struct("target_share", "max_repeats")).alias("t")).select("source", "t.*")
    table = named.join(reached, "source", "left").na.fill(0, ["documents", "draws", "most_repeats", "tokens"])
    table = table.select("source", "target_share", "max_repeats", "documents", "draws", "most_repeats", "tokens", (F.col("tokens") / F.nullif(every, F.lit(0))).alias("share"))
    return draws, table
