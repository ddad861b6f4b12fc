"""Lexical, vector and fused retrieval for whole query sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexigrove.operators.blocks import over_blocks

K1, B = 1.2, 0.75
#: Query vectors that a task holds at once.
QUERY_BLOCK = 50_000


def tokens(c: str) -> Column:
    """Lower-case runs of ASCII letters and digits."""
    return F.regexp_extract_all(F.lower(c), F.lit("[a-z0-9]+"), F.lit(0))


def postings(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(term, doc, tf, len): the inverted index with each document's length."""
    t = docs.select(F.col(id_col).alias("doc"), tokens(text_col).alias("a")).where(F.size("a") > 0)
    return t.select("doc", F.size("a").alias("len"), F.explode("a").alias("term")).groupBy("term", "doc", "len").agg(F.count("*").alias("tf"))


def bm25(docs: DataFrame, queries: DataFrame, id_col: str, text_col: str, stop: list[str], top: int) -> DataFrame:
    """(qid, doc, score, rank): the `top` documents of each query (qid, text) by BM25, higher is better, ties by id.

    Query words of at most two letters and stop words don't count. The corpus's size and mean length come from one row.
    The postings are joined with the query terms before anything else, so terms that nobody asks for don't travel.
    """
    index = postings(docs, id_col, text_col)
    sizes = index.select("doc", "len").distinct().agg(F.count("*").alias("n"), F.avg("len").alias("mean"))
    wanted = queries.select("qid", F.explode(F.array_distinct(tokens("text"))).alias("term")).where(F.length("term") > 2).where(~F.col("term").isin(stop))
    used = index.join(wanted.select("term").distinct(), "term", "left_semi")
    df = used.groupBy("term").agg(F.count("*").alias("df"))
    score = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5)) * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("len") / F.col("mean")))
    weights = used.join(df, "term").crossJoin(F.broadcast(sizes)).select("term", "doc", score.alias("w"))  # sizes is one row
    total = wanted.join(weights, "term").groupBy("qid", "doc").agg(F.round(F.sum("w"), 6).alias("score"))
    rank = F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score"), "doc"))
    return total.withColumn("rank", rank).where(F.col("rank") <= top)


def _first_k(sim: np.ndarray, k: int) -> np.ndarray:
    """A mask of the k largest values of each row; of equal ones the first."""
    kth = np.partition(sim, -k, axis=1)[:, [-k]]
    above, level = sim > kth, sim == kth
    return above | level & (np.cumsum(level, axis=1) <= k - above.sum(axis=1, keepdims=True))


def knn(vectors: DataFrame, queries: DataFrame, id_col: str, vec_col: str, top: int, block: int = QUERY_BLOCK) -> DataFrame:
    """(qid, id, sim, rank): the `top` nearest vectors of each query by inner product, itself included, exactly.

    The query set is broadcast in blocks of bounded size; each batch of vectors keeps its best `top` per query by the
    final order (rounded similarity, then id), so what is shuffled is bounded by queries * top per batch.
    """
    rows = queries.select(F.col(id_col).alias("qid"), F.col(vec_col).alias("v")).where("v is not null").toLocalIterator()

    def blocks() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        while held := [r for _, r in zip(range(block), rows, strict=False)]:
            yield np.array([r[0] for r in held], dtype=np.int64), np.array([r[1] for r in held], dtype=np.float64)

    def against(shared: Broadcast) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            qids, q = shared.value
            for batch in batches:
                if not batch.num_rows:
                    continue
                v = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, q.shape[1])
                keys = batch.column(0).to_numpy()
                by_id = np.argsort(keys, kind="stable")
                v, keys = v[by_id], keys[by_id]
                for lo in range(0, len(qids), 256):
                    sim = q[lo : lo + 256] @ v.T
                    sim = np.copysign(np.floor(np.abs(sim) * 1e6 + 0.5) / 1e6, sim)
                    k = min(top, sim.shape[1])
                    row, col = np.nonzero(_first_k(np.where(np.isnan(sim), np.inf, sim), k))
                    yield pa.RecordBatch.from_arrays([pa.array(qids[lo + row]), pa.array(keys[col]), pa.array(sim[row, col])], names=["qid", "id", "sim"])

        return vectors.select(id_col, vec_col).where(F.col(vec_col).isNotNull()).mapInArrow(run, schema)

    schema = "qid bigint, id bigint, sim double"
    found = over_blocks(vectors.sparkSession, blocks(), against, schema, "knn")
    rank = F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("sim"), "id"))
    return found.withColumn("sim", F.round("sim", 6)).withColumn("rank", rank).where(F.col("rank") <= top)


def phrase_hits(docs: DataFrame, queries: DataFrame) -> DataFrame:
    """(qid, doc, tf, len, demoted): documents (doc, text, demoted) that hold the tokens of a query (qid, text) next to each other, and how often.

    A document meets a query by the query's rarest token only, then the whole phrase is looked for; no runs of tokens are built.
    """
    d = docs.select("doc", "demoted", tokens("text").alias("a")).where(F.size("a") > 0)
    q = queries.select("qid", tokens("text").alias("q")).where(F.size("q") > 0)
    wanted = q.select("qid", F.explode(F.array_distinct("q")).alias("term"))
    used = d.select("doc", F.explode(F.array_distinct("a")).alias("term")).join(wanted.select("term").distinct(), "term", "left_semi")
    df = used.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    # A token that no document has makes its query empty.
    rarest = wanted.join(df, "term", "left").groupBy("qid").agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "term")).alias("m")).where("m.df > 0").select("qid", "m.term")
    padded = lambda c: F.concat(F.lit(" "), F.array_join(c, " "), F.lit(" "))
    pairs = rarest.join(q, "qid").join(used, "term").join(d, "doc").select("qid", "doc", "demoted", F.size("a").alias("len"), padded("a").alias("hay"), padded("q").alias("needle"))
    times = (F.length("hay") - F.length(F.replace("hay", F.col("needle")))) / F.length("needle")
    return pairs.where(F.col("hay").contains(F.col("needle"))).select("qid", "doc", times.cast("int").alias("tf"), "len", "demoted")


def substring_hits(docs: DataFrame, queries: DataFrame) -> DataFrame:
    """(qid, doc): documents (doc, text) that hold a query (qid, text) of three characters or more; candidates by the query's rarest trigram, then checked."""

    def grams(c: str) -> Column:
        return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) - 2), lambda i: F.col(c).substr(i, F.lit(3))))

    q = queries.where("length(text) >= 3").select("qid", F.col("text").alias("p"))
    asked = q.select("qid", "p", F.explode(grams("p")).alias("g"))
    index = docs.where("length(text) >= 3").select("doc", "text", F.explode(grams("text")).alias("g")).join(asked.select("g").distinct(), "g", "left_semi")
    df = index.groupBy("g").agg(F.count(F.lit(1)).alias("df"))
    # A gram that no text has makes its query empty.
    rare = asked.join(df, "g", "left").groupBy("qid", "p").agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "g")).alias("m")).where("m.df > 0").select("qid", "p", F.col("m.g").alias("g"))
    return rare.join(index, "g").where(F.col("text").contains(F.col("p"))).select("qid", "doc")


def fuse_ranks(lists: list[tuple[DataFrame, float]], k: int = 60) -> DataFrame:
    """(qid, id, score, rank): reciprocal rank fusion of ranked lists (qid, id, rank) with weights."""
    rows = None
    for df, weight in lists:
        one = df.select("qid", "id", (F.lit(float(weight)) / (k + F.col("rank"))).alias("s"))
        rows = one if rows is None else rows.unionByName(one)
    total = rows.groupBy("qid", "id").agg(F.round(F.sum("s"), 9).alias("score"))
    return total.withColumn("rank", F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score"), "id")))


def fuse_reserved(first: DataFrame, second: DataFrame, n: int, k: int = 60) -> DataFrame:
    """(qid, id, place): the top half of each list interleaved, then the fused order, without repeats, cut at n."""
    half = -(-n // 2)
    fused = fuse_ranks([(first, 1.0), (second, 1.0)], k)
    rows = first.where(F.col("rank") <= half).select("qid", "id", (2 * F.col("rank")).cast("bigint").alias("o"))
    rows = rows.unionByName(second.where(F.col("rank") <= half).select("qid", "id", (2 * F.col("rank") + 1).cast("bigint").alias("o")))
    rows = rows.unionByName(fused.select("qid", "id", (1_000_000 + F.col("rank")).cast("bigint").alias("o")))
    best = rows.groupBy("qid", "id").agg(F.min("o").alias("o"))
    return best.withColumn("place", F.row_number().over(Window.partitionBy("qid").orderBy("o"))).where(F.col("place") <= n).select("qid", "id", "place")
