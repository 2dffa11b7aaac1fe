"""Exact top-k inner-product search by aggregation without random access.

Vectors become whole numbers floor(scale * x). Candidates are cut into blocks; in a block each dimension has its
list of candidates sorted by value, read from the top for positive query weights and from the bottom for negative
ones. The lists are read in growing depths. What has been read bounds each candidate's score from below
(unread values counted at the far end of their list) and from above (at the list's frontier). Once the k-th best lower
bound of a query exceeds the upper bound of all but few candidates, reading stops and the scores of those few are
resolved. All queries of a block are bounded at once by matrix products over the values read.

Query blocks meet candidate blocks by an equi-join on the two block numbers, so neither side is broadcast; each pair
of blocks returns at most k rows a query, and a query's rows of all blocks are ranked at the end.

Sums of products are exact in doubles while scale^2 * dimensions * max(x)^2 stays below 2^53; larger values are
refused.

Defined results: vectors that are null or hold null or non-finite components take no part; vectors of another
length than a query's do not meet it; null ids take no part; rows that repeat an id are candidates each
(a query skips all rows of its own id); ties go to the smaller id; a query with fewer candidates has
fewer ranks; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCALE, BLOCK, QUERY_BLOCK = 64, 4096, 1024
DEPTHS = (1 / 8, 1 / 3, 1.0)  # shares of a list read before the bounds are compared


class SortedLists:
    """The sorted lists of a block of candidates (rows x dimensions of whole numbers)."""

    def __init__(self, values: np.ndarray):
        self.values = values.astype(float)
        self.rows = len(values)
        order = np.argsort(-values, axis=0, kind="stable")
        self.rank = np.empty_like(order)  # place in the descending list of each dimension
        np.put_along_axis(self.rank, order, np.arange(self.rows)[:, None], axis=0)
        self.top = np.take_along_axis(self.values, order, axis=0)  # descending lists

    def read(self, depth: int):
        """Lower and upper stand-ins for all values after `depth` reads from the top, and from the bottom."""
        high, low = self.top[0], self.top[-1]
        down, up = self.top[depth - 1], self.top[self.rows - depth]
        seen_down, seen_up = self.rank < depth, self.rank >= self.rows - depth
        v = self.values
        return ((np.where(seen_down, v, low), np.where(seen_down, v, down)),
                (np.where(seen_up, v, high), np.where(seen_up, v, up)))


def top_k(lists: SortedLists, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int):
    """(query rows, candidate rows, scores) of each query's k best candidates, ties to the smaller id. `ids` ascend."""
    plus, minus = np.maximum(queries, 0.0).T, np.minimum(queries, 0.0).T
    open_ = np.arange(len(queries))
    out = []
    for share in DEPTHS:
        depth = max(min(lists.rows, k), int(np.ceil(share * lists.rows)))
        (down_far, down_near), (up_far, up_near) = lists.read(depth)
        p, m = plus[:, open_], minus[:, open_]
        lower, upper = down_far @ p + up_far @ m, down_near @ p + up_near @ m
        own = ids[:, None] == query_ids[open_][None, :]
        lower[own], upper[own] = -np.inf, -np.inf
        at = max(0, lists.rows - k)
        kth = np.partition(lower, at, axis=0)[at]
        alive = upper >= kth[None, :]
        alive &= ~own
        few = alive.sum(axis=0) <= max(4 * k, lists.rows // 16)
        if depth >= lists.rows:
            few[:] = True
        for j in np.nonzero(few)[0]:
            rows = np.nonzero(alive[:, j])[0]
            score = lists.values[rows] @ queries[open_[j]]
            best = np.lexsort((ids[rows], -score))[:k]
            out.append((np.full(len(best), open_[j]), rows[best], score[best]))
        open_ = open_[~few]
        if not len(open_):
            break
    return [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, int)] * 3


def top_k_search(vectors: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vector_col: str = "embedding",
                 scale: int = SCALE, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that meets `is_query` (a condition on `vec_id`) its k best
    others by the inner product of floor(scale * x)."""
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = (vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
            .where("vec_id is not null and v is not null").where(good)
            .select("vec_id", F.size("v").alias("dim"), F.transform("v", lambda x: F.floor(x * scale).cast("long")).alias("v"),
                    is_query.alias("asks")))
    sizes = rows.agg(F.count("*").alias("n"), F.sum(F.col("asks").cast("int")).alias("q"),
                     F.max(F.col("dim") * F.pow(F.array_max(F.transform("v", lambda x: F.abs(x))), F.lit(2))).alias("most")).first()
    if (sizes["most"] or 0) >= 2.0 ** 53:
        raise ValueError("scores could exceed 2^53")
    blocks = max(1, -(-sizes["n"] // block))
    query_blocks = max(1, -(-(sizes["q"] or 0) // query_block))

    def pack(key, f):
        f = f.sort_values("vec_id", kind="stable")
        return pd.DataFrame({"dim": [int(key[0])], "part": [int(key[1])], "ids": [f["vec_id"].to_numpy(np.int64).tobytes()],
                             "values": [np.stack(f["v"]).astype(np.int64).tobytes()]})

    def packed(df, parts):
        return (df.where("dim > 0").withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(parts)))
                .groupBy("dim", "part").applyInPandas(pack, "dim int, part bigint, ids binary, values binary"))

    candidates = packed(rows.select("vec_id", "dim", "v"), blocks).select(
        "dim", F.col("part").alias("c_part"), F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("q_part"),
        F.col("ids").alias("c_ids"), F.col("values").alias("c_values"))
    queries = packed(rows.where("asks").select("vec_id", "dim", "v"), query_blocks).select(
        "dim", F.col("part").cast("int").alias("q_part"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("c_part"), "ids", "values")

    def search(f):  # one pair of blocks
        out = [pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype=np.int64)]
        for r in f.itertuples(index=False):
            ids, qids = np.frombuffer(r.c_ids, np.int64), np.frombuffer(r.ids, np.int64)
            lists = SortedLists(np.frombuffer(r.c_values, np.int64).reshape(len(ids), r.dim))
            ask = np.frombuffer(r.values, np.int64).reshape(len(qids), r.dim).astype(float)
            for s in range(0, len(qids), 256):
                q, c, score = top_k(lists, ids, ask[s:s + 256], qids[s:s + 256], k)
                out.append(pd.DataFrame({"query_id": qids[s:s + 256][q.astype(int)], "vec_id": ids[c.astype(int)],
                                         "score": score.astype(np.int64)}))
        return pd.concat(out)

    keys = ["dim", "c_part", "q_part"]
    best = candidates.join(queries, keys).groupBy(*keys).applyInPandas(search, "query_id bigint, vec_id bigint, score bigint")
    # The rows of one query: k from each block of candidates.
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
