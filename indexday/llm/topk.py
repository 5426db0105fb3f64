"""Exact top-k search by term-at-a-time accumulation over quantised vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from indexday.llm.common import prepared

QUERY_BLOCK_BYTES = 8 * 1024 * 1024
QUERIES_AT_ONCE = 128
NOT_A_HIT = np.iinfo(np.int64).min


def quantised(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, terms): each component as floor(scale * x); rows without id, null vectors and vectors with
    null or non-finite components are left out. Components beyond a long end at its bounds."""
    bad = F.exists(vector_col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    terms = F.transform(vector_col, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))
    usable = F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & ~bad
    return df.filter(usable).select(F.col(id_col).cast("long").alias("id"), terms.alias("terms"))


def _sparse(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, weight) of the weights that are not zero."""
    sizes = np.diff(lists.offsets.to_numpy())
    weights = lists.flatten().to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    terms = np.arange(len(weights)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    there = weights != 0
    return rows[there], terms[there], weights[there]


def _by_term(lists: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Posting lists: for each term its rows and their weights."""
    rows, terms, weights = _sparse(lists)
    order = np.argsort(terms, kind="stable")
    rows, terms, weights = rows[order], terms[order], weights[order]
    names, starts = np.unique(terms, return_index=True)
    ends = np.append(starts[1:], len(terms))
    return {int(t): (rows[a:b], weights[a:b]) for t, a, b in zip(names, starts, ends, strict=True)}


def _best(query: np.ndarray, score: np.ndarray, row_id: np.ndarray, k: int):
    """The k best hits of each query: high scores first, then small ids."""
    order = np.lexsort((row_id, ~score, query))  # ~x falls as x rises, for every long
    query, score, row_id = query[order], score[order], row_id[order]
    first = np.r_[True, query[1:] != query[:-1]] if len(query) else np.zeros(0, bool)
    starts = np.flatnonzero(first)
    place = np.arange(len(query)) - np.repeat(starts, np.diff(np.append(starts, len(query))))
    keep = place < k
    return query[keep], score[keep], row_id[keep]


def _search(block: pa.Table, k: int):
    """A scan of the rows against one block of queries; each task returns its k best per query."""
    keys = block.column("query_key").to_numpy()
    ids = block.column("id").to_numpy()
    lists = block.column("terms").combine_chunks()
    groups = []
    for start in range(0, len(ids), QUERIES_AT_ONCE):
        part = slice(start, start + QUERIES_AT_ONCE)
        groups.append((start, len(ids[part]), _by_term(lists.slice(start, QUERIES_AT_ONCE))))
    by_id = np.argsort(ids, kind="stable")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = (np.zeros(0, np.int64),) * 3
        for batch in batches:
            row_ids = batch.column("id").to_numpy()
            n = len(row_ids)
            if not n:
                continue
            postings = _by_term(batch.column("terms"))
            found = [best]
            # Rows that are a query's own: every query with the row's id.
            low = np.searchsorted(ids, row_ids, "left", sorter=by_id)
            high = np.searchsorted(ids, row_ids, "right", sorter=by_id)
            own_rows = np.repeat(np.arange(n), high - low)
            own_queries = by_id[np.concatenate([np.arange(a, b) for a, b in zip(low, high, strict=True)]).astype(int)]
            for start, m, terms in groups:
                scores = np.zeros((m, n), np.int64)
                for term, (queries, weights) in terms.items():
                    if term not in postings:
                        continue
                    rows, values = postings[term]
                    if len(rows) == n:
                        scores[queries] += weights[:, None] * values
                    else:
                        scores[queries[:, None], rows] += weights[:, None] * values
                mine = (own_queries >= start) & (own_queries < start + m)
                scores[own_queries[mine] - start, own_rows[mine]] = NOT_A_HIT
                if n > k:
                    bound = np.partition(scores, n - k, axis=1)[:, n - k]
                    query, row = np.nonzero(scores >= bound[:, None])
                else:
                    query, row = (x.ravel() for x in np.indices(scores.shape))
                score = scores[query, row]
                hit = score != NOT_A_HIT
                found.append(_best(query[hit] + start, score[hit], row_ids[row[hit]], k))
            best = _best(*[np.concatenate(x) for x in zip(*found, strict=True)], k)
        if len(best[0]):
            columns = [keys[best[0]], ids[best[0]], best[2], best[1]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["query_key", "query_id", "vec_id", "score"]
            )

    return scan


def top_k(
    df: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
    scale: int = 1024, block_bytes: int = QUERY_BLOCK_BYTES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of highest integer inner product with each query row.

    All rows are searched: a block of queries, at most about ``block_bytes``, goes to every task; there each
    query's weights are multiplied into the posting lists, term by term, and added in dense score arrays.
    ``np.partition`` picks a task's best, a window merges those of all tasks. More queries mean more passes,
    not larger blocks.

    Ties go to the smaller id. Rows with the query's own id are no hits. Repeated rows count each; a repeated
    query is answered once. A shorter vector is zero in the terms it lacks. Rows that :func:`quantised` leaves
    out take no part; an empty table or one without queries gives no rows.
    """
    spark = df.sparkSession
    store = prepared(spark)
    queries = quantised(df.filter(is_query), id_col, vector_col, scale).distinct()
    queries = store.put("queries", queries.withColumn("query_key", F.monotonically_increasing_id()))
    size = queries.agg(F.sum(F.size("terms") * 8 + 16)).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    rows = quantised(df, id_col, vector_col, scale)
    found = []
    for i in range(blocks):
        block = queries.filter(F.pmod(F.xxhash64("query_key"), F.lit(blocks)) == i).toArrow()
        if block.num_rows:
            hits = rows.mapInArrow(_search(block, k), "query_key long, query_id long, vec_id long, score long")
            found.append(store.put(f"hits_{i}", hits))
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    hits = found[0]
    for more in found[1:]:
        hits = hits.unionAll(more)
    place = Window.partitionBy("query_key").orderBy(F.desc("score"), "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
