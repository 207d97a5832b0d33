"""Documents packed into containers of fixed capacity by lexical retrieval.

Documents are spread over shards of bounded size; each shard holds a BM25 inverted index over its documents, weighted
by the document frequencies of the whole corpus. The largest unused document opens a container, the index returns its
unused neighbours, and those that fit fill the window in the order of their score; what room is left takes the largest
unused documents that still fit. Terms are the tokenizer's tokens, so the vocabulary and its statistics are bounded.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.llm.tokens import FOLDER, VOCABULARY, encoder, token_vectors
from sessionloom.session import cut

K1, B = 1.2, 0.75


@dataclass(frozen=True)
class Corpus:
    """Statistics over all documents: how many, their mean size, document frequency by token."""

    documents: int
    mean_size: float
    frequency: np.ndarray


class ShardIndex:
    """BM25 inverted index over the documents of a shard; a query is every term of a document.

    Terms that more than a twentieth of the shard hold are kept as columns of a matrix, whose product gives all scores
    of all documents at once; the others have posting lists. Both together are the exact BM25 score.
    """

    def __init__(self, sizes: np.ndarray, terms: list[np.ndarray], tfs: list[np.ndarray], corpus: Corpus) -> None:
        self.size = sizes.size
        doc = np.repeat(np.arange(sizes.size), [t.size for t in terms])
        term = np.concatenate(terms) if terms else np.zeros(0, dtype=np.uint32)
        tf = (np.concatenate(tfs) if tfs else np.zeros(0)).astype(np.float32)
        df = corpus.frequency[term].astype(np.float32)
        idf = np.log1p((corpus.documents - df + 0.5) / (df + 0.5))
        weight = (idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * sizes[doc] / max(corpus.mean_size, 1.0)))).astype(np.float32)
        distinct, column, held = np.unique(term, return_inverse=True, return_counts=True)
        dense = held > max(8, sizes.size // 20)
        place = np.cumsum(dense) - 1
        common = dense[column]
        matrix = np.zeros((sizes.size, int(dense.sum())), dtype=np.float32)
        matrix[doc[common], place[column[common]]] = weight[common]
        self.common = (matrix > 0).astype(np.float32) @ matrix.T
        doc, column, weight = doc[~common], column[~common], weight[~common]
        order = np.argsort(column, kind="stable")
        self.doc, self.weight = doc[order], weight[order]
        rare = column[order]
        self.first, self.last = np.searchsorted(rare, column, "left"), np.searchsorted(rare, column, "right")
        self.at = np.searchsorted(doc, np.arange(sizes.size + 1))

    def scores(self, document: int) -> np.ndarray:
        """BM25 scores of all documents of the shard against all terms of one of them."""
        own = slice(self.at[document], self.at[document + 1])
        first, count = self.first[own], self.last[own] - self.first[own]
        if not first.size:
            return self.common[document]
        postings = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
        return self.common[document] + np.bincount(self.doc[postings], self.weight[postings], self.size)


def pack(index: ShardIndex, sizes: np.ndarray, capacity: int) -> list[tuple[int, int, int, int]]:
    """(container, document, part, tokens) for the documents of a shard.

    A document larger than the capacity is cut into parts that fill containers of their own; its rest is packed like
    any other document. No other document is cut.
    """
    out: list[tuple[int, int, int, int]] = []
    container = 0
    item_doc, item_size, item_part = [], [], []
    for document, size in enumerate(sizes.tolist()):
        part = 0
        while size > capacity:
            out.append((container, document, part, capacity))
            container, size, part = container + 1, size - capacity, part + 1
        item_doc.append(document)
        item_size.append(size)
        item_part.append(part)
    docs, item = np.array(item_doc), np.array(item_size, dtype=np.int64)
    order = np.argsort(-item, kind="stable")
    free = np.ones(item.size, dtype=bool)
    pool = sorted((int(s), i) for i, s in enumerate(item))
    for seed in order.tolist():
        if not free[seed]:
            continue
        room = capacity - int(item[seed])
        chosen = [seed]
        free[seed] = False
        pool.pop(bisect_right(pool, (int(item[seed]), seed)) - 1)
        if pool and pool[0][0] <= room:
            fitting = np.flatnonzero(free & (item <= room))
            score = index.scores(int(docs[seed]))[docs[fitting]]
            near = fitting[np.argsort(-score, kind="stable")[: np.count_nonzero(score > 0)]]
            while near.size:
                best = int(near[0])
                room -= int(item[best])
                chosen.append(best)
                free[best] = False
                pool.pop(bisect_right(pool, (int(item[best]), best)) - 1)
                closing = _closing(pool, room, capacity)
                if closing is not None:
                    chosen.append(closing)
                    room -= int(item[closing])
                    free[closing] = False
                    pool.pop(bisect_right(pool, (int(item[closing]), closing)) - 1)
                near = near[1:]
                near = near[(item[near] <= room) & free[near]]
            while pool and pool[0][0] <= room:
                size, best = pool.pop(bisect_right(pool, (room, item.size)) - 1)
                room -= size
                chosen.append(best)
                free[best] = False
        out += [(container, int(docs[i]), item_part[i], int(item[i])) for i in chosen]
        container += 1
    return out


def _closing(pool: list[tuple[int, int]], room: int, capacity: int) -> int | None:
    """The largest unused item that fits, if it leaves less than one percent of the capacity."""
    at = bisect_right(pool, (room, 1 << 60)) - 1
    return pool[at][1] if at >= 0 and pool[at][0] > 0 and room - pool[at][0] <= capacity // 100 else None


def document_frequency(vectors: DataFrame, vocabulary: int) -> np.ndarray:
    """Document frequency of every token, counted per batch and summed; ``vocabulary`` bounds the result."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(vocabulary, dtype=np.int64)
        for batch in batches:
            for terms in batch["terms"]:
                total[np.frombuffer(terms, dtype=np.uint32)] += 1
        seen = np.flatnonzero(total)
        yield pd.DataFrame({"term": seen, "n": total[seen]})

    out = np.zeros(vocabulary, dtype=np.int64)
    for row in vectors.select("terms").mapInPandas(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toLocalIterator():
        out[row["term"]] = row["n"]
    return out


def pack_documents(documents: DataFrame, containers: list[tuple[str, int]], key: str, text: str, folder: str = FOLDER, vocabulary: str = VOCABULARY, shard_documents: int = 2_000) -> DataFrame:
    """Containers of every document: ``container``, ``container_id``, ``key``, ``part``, ``n_tokens``.

    ``containers`` are (name, capacity in tokens). Every document goes into exactly one container of each name; one
    larger than the capacity fills as many as it needs. NULL and blank texts count as zero tokens and go in with
    others; repeated rows are packed each; an empty table gives no rows. ``shard_documents`` is the mean size of a
    shard; ``folder`` and ``vocabulary`` name the tokenizer, the number of whose tokens bounds the corpus statistics.
    """
    vectors = cut(token_vectors(documents, key, text, folder, vocabulary))
    stats = vectors.agg(F.count("*").alias("n"), F.avg("n_tokens").alias("mean")).first()
    corpus = Corpus(stats["n"], stats["mean"] or 0.0, document_frequency(vectors, encoder(folder, vocabulary).n_vocab))
    shards = max(1, round(stats["n"] / shard_documents))
    schema = f"container string, container_id string, `{key}` {documents.schema[key].dataType.simpleString()}, part int, n_tokens long"

    def run(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(key, kind="stable", ignore_index=True)
        sizes = shard["n_tokens"].to_numpy()
        terms = [np.frombuffer(t, dtype=np.uint32) for t in shard["terms"]]
        index = ShardIndex(sizes, terms, [np.frombuffer(t, dtype=np.uint32) for t in shard["tfs"]], corpus)
        parts = []
        for name, capacity in containers:
            plan = np.array(pack(index, sizes, capacity), dtype=np.int64).reshape(-1, 4)
            prefix = f"{name}-{int(shard['shard'].iloc[0])}-"
            parts.append(
                pd.DataFrame(
                    {
                        "container": name,
                        "container_id": [prefix + str(c) for c in plan[:, 0]],
                        key: shard[key].to_numpy()[plan[:, 1]],
                        "part": plan[:, 2].astype(np.int32),
                        "n_tokens": plan[:, 3],
                    }
                )
            )
        return pd.concat(parts, ignore_index=True)

    sharded = vectors.withColumn("shard", F.pmod(F.xxhash64(f"`{key}`", F.lit("pack")), F.lit(shards)))
    return sharded.groupBy("shard").applyInPandas(run, schema)


def container_fill(plan: DataFrame, capacities: DataFrame) -> DataFrame:
    """Per kind of container: how many, tokens held, share of the capacity used, documents, documents cut."""
    per = plan.groupBy("container").agg(
        F.countDistinct("container_id").alias("containers"), F.sum("n_tokens").alias("tokens"), F.sum((F.col("part") == 0).cast("long")).alias("documents"), F.sum((F.col("part") == 1).cast("long")).alias("cut_documents")
    )
    return per.join(capacities.select("container", "capacity_tokens"), "container").withColumn("fill", F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")))
