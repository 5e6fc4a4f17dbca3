"""The best of many products of sparse rows, block by block.

A join of many queries with all postings makes a row for each term that a query shares with a document, most of them of
common terms, and sums them again. Here queries and documents are laid in blocks, and two blocks are multiplied in
memory: common terms as one product of matrices, rare ones posting by posting. Only the best of each query leave it.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions import text as tx
from siltstone.runtime import ship

#: Queries up to which they go to where the documents are; queries and documents of a group, which one task multiplies.
FEW, QUERY_GROUP, DOCUMENT_GROUP = 1_000, 20_000, 40_000
#: Queries and documents that are multiplied at once, and numbers of a matrix of documents and terms.
QUERIES, DOCUMENTS, NUMBERS = 1_000, 4_000, 4_000_000
#: Share of the pairs that share a term from which its products are made for all pairs: a matrix is so much faster.
COMMON = 0.005

Values = Callable[[pa.Table], np.ndarray]


def pack(rows: DataFrame, text: str, *kept: str, hashed: tuple[int, Callable[[str], tuple[int, int]]] | None = None) -> DataFrame:
    """(kept.., dl, term, tf): of each row how many tokens its text has, its distinct tokens and how often each comes.

    Nothing is shuffled. The words of `term` hold no spaces. With `hashed`, a number of buckets and a function that gives a term's bucket and sign, also (b,
    v): the buckets of the row's hashed vector and its numbers, which have the length 1.
    """
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in kept)
    ship(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, all_terms = flat(batch.column(len(kept)))
            terms = all_terms.dictionary_encode()
            row, n = np.repeat(np.arange(len(size)), size), max(1, len(terms.dictionary))
            both, tf = np.unique(row * n + terms.indices.to_numpy(zero_copy_only=False), return_counts=True)
            row, code = both // n, both % n
            out = [*batch.columns[: len(kept)], pa.array(size.astype(np.int32)), _nested(row, len(size), terms.dictionary.take(pa.array(code))), _nested(row, len(size), pa.array(tf.astype(np.int32)))]
            names = [*kept, "dl", "term", "tf"]
            if hashed:
                place = np.array([hashed[1](t) for t in terms.dictionary.to_pylist()], np.int64).reshape(-1, 2)
                spot, at = np.unique(row * hashed[0] + place[code, 0], return_inverse=True)
                v, row = np.bincount(at, place[code, 1] * tf, len(spot)), spot // hashed[0]
                v = v / np.maximum(np.sqrt(np.bincount(row, v * v, len(size))), 1e-12)[row]
                out += [_nested(row, len(size), pa.array((spot % hashed[0]).astype(np.int32))), _nested(row, len(size), pa.array(v))]
                names += ["b", "v"]
            yield pa.RecordBatch.from_arrays(out, names)

    tokens = rows.select(*kept, F.coalesce(tx.tokens(F.col(text)), F.array().cast("array<string>")).alias("tokens"))
    return tokens.mapInArrow(run, f"{kinds}, dl int, term array<string>, tf array<int>" + (", b array<int>, v array<double>" if hashed else ""))


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    """How long each list is, and all their values; words with spaces between are a list too."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_string(column.type):
        column = pc.split_pattern(column, " ")
    return pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64), column.flatten()


def _nested(row: np.ndarray, rows: int, values: pa.Array) -> pa.Array:
    """Lists of the values, whose rows ascend."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(rows + 1)).astype(np.int32)), values)


def best(docs: DataFrame, key: str, asked: DataFrame, k: int, term: str, of_document: Values, of_query: Values) -> DataFrame:
    """(query_id, key, score): of each query at least the `k` documents of the largest products above 0, by (score
    descending, key ascending); scores are rounded to six digits.

    `docs` and `asked` are stored and have lists `term`, whose numbers `of_document` and `of_query` give. Where `asked`
    has `asks`, products of those that ask are weighed by `kind` of the document. Up to FEW queries are sent to the
    documents. More are laid in groups, as are the documents, and each pair of groups is one task's work, in blocks of
    a fixed size. The number of groups follows from counts, so that none grows with the tables.
    """
    kind = lambda df, c: df.schema[c].dataType.simpleString()
    schema = f"query_id {kind(asked, 'query_id')}, {key} {kind(docs, key)}, score double"
    spark = docs.sparkSession
    ship(spark)
    docs, asked = docs.filter(F.col(key).isNotNull()), asked.filter(F.col("query_id").isNotNull())

    def multiply(queries: pa.Table, found: pa.Table) -> pa.Table:
        i, j, score = _best(queries, found, key, k, term, of_document, of_query)
        return pa.table({"query_id": queries["query_id"].take(pa.array(i)), key: found[key].take(pa.array(j)), "score": score})

    queries = asked.count()
    if queries <= FEW:
        sent = spark.sparkContext.broadcast(asked.toArrow())

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield from multiply(sent.value, pa.Table.from_batches([batch])).combine_chunks().to_batches()

        return docs.mapInArrow(run, schema)
    n, down = docs.count(), -(-queries // QUERY_GROUP)
    # enough groups for all cores, but none of less than a block
    across = max(-(-n // DOCUMENT_GROUP), min(-(-n // DOCUMENTS), -(-2 * spark.sparkContext.defaultParallelism // down)), 1)
    group = lambda c, of: F.pmod(F.xxhash64(c), F.lit(of)).cast("int")
    numbers = lambda of: F.explode(F.sequence(F.lit(0), F.lit(of - 1)))
    # a row of an array takes 16 bytes and more for each word
    slim = lambda df: df.filter(F.size(term) > 0).withColumn(term, F.concat_ws(" ", term)) if kind(df, term) == "array<string>" else df
    left = slim(asked).select("*", group("query_id", down).alias("y"), numbers(across).alias("x"))
    right = slim(docs).select("*", group(key, across).alias("x"), numbers(down).alias("y"))
    return left.groupBy("x", "y").cogroup(right.groupBy("x", "y")).applyInArrow(multiply, schema)


def _best(asked: pa.Table, docs: pa.Table, key: str, k: int, term: str, of_document: Values, of_query: Values) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of `asked` and of `docs` and the rounded products of each query's best `k` documents."""
    nothing = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    nq, nd = len(asked), len(docs)
    if not nq or not nd:
        return nothing
    (q_size, q_term), (d_size, d_term) = flat(asked[term]), flat(docs[term])
    terms = q_term.unique()
    q = np.repeat(np.arange(nq), q_size), pc.index_in(q_term, terms).to_numpy(zero_copy_only=False), of_query(asked)
    code = pc.index_in(d_term, terms).fill_null(-1).to_numpy(zero_copy_only=False)
    there = code >= 0
    d = np.repeat(np.arange(nd), d_size)[there], code[there], of_document(docs)[there]
    having = np.bincount(q[1], minlength=len(terms)).astype(float) * np.bincount(d[1], minlength=len(terms))
    common = having > COMMON * nq * nd
    column = np.where(common, np.cumsum(common) - 1, -1)
    width = int(common.sum())
    wide, tall = int(min(DOCUMENTS, max(500, NUMBERS // max(1, width)))), QUERIES
    order = np.empty(nd, np.int64)
    order[pc.sort_indices(docs[key]).to_numpy()] = np.arange(nd)
    kinds = docs["kind"].to_numpy() if "asks" in asked.column_names else None
    asks = asked["asks"].to_numpy() if kinds is not None else None
    # of each block of queries: rows, documents and scores so far, and the least score that may still count
    held = defaultdict(lambda: nothing)
    least = np.full(nq, 10.0**-6)

    def part(rows: tuple, first: int, last: int) -> tuple:
        a, b = np.searchsorted(rows[0], (first, last))
        at, code, x = rows[0][a:b] - first, rows[1][a:b], rows[2][a:b]
        dense = column[code] >= 0
        return (at[dense], column[code[dense]], x[dense]), (at[~dense], code[~dense], x[~dense])

    for d0 in range(0, nd, wide):
        d1 = min(nd, d0 + wide)
        (at, col, x), (rare_at, rare, rare_x) = part(d, d0, d1)
        matrix = np.zeros((width, d1 - d0))
        matrix[col, at] = x
        by_term = np.argsort(rare, kind="stable")
        rare_at, rare_x = rare_at[by_term], rare_x[by_term]
        starts = np.concatenate([[0], np.cumsum(np.bincount(rare, minlength=len(terms)))])
        for q0 in range(0, nq, tall):
            q1 = min(nq, q0 + tall)
            (at, col, x), (some_at, some, some_x) = part(q, q0, q1)
            sought = np.zeros((q1 - q0, width))
            sought[at, col] = x
            score = sought @ matrix
            n = starts[some + 1] - starts[some]
            posting = np.repeat(starts[some] - np.cumsum(n) + n, n) + np.arange(n.sum())
            np.add.at(score.reshape(-1), np.repeat(some_at, n) * (d1 - d0) + rare_at[posting], np.repeat(some_x, n) * rare_x[posting])
            if kinds is not None:
                own = np.flatnonzero(asks[q0:q1])
                score[own] *= kinds[None, d0:d1]
            if not d0 and d1 > k:
                least[q0:q1] = np.maximum(least[q0:q1], np.round(np.partition(score, d1 - k, axis=1)[:, d1 - k], 6))
            i, j = np.nonzero(score >= least[q0:q1, None] - 10.0**-6)
            s = np.round(score[i, j], 6)
            good = (s > 0) & (s >= least[q0 + i])
            i, j, s = (np.concatenate(x) for x in zip(held[q0], (i[good], j[good] + d0, s[good])))
            ranked = np.lexsort((order[j], -s, i))
            i, j, s = i[ranked], j[ranked], s[ranked]
            rank = np.arange(len(i)) - np.searchsorted(i, i)
            last = rank == k - 1
            least[q0 + i[last]] = s[last]
            held[q0] = tuple(x[rank < k] for x in (i, j, s))
    return tuple(np.concatenate(x) for x in zip(*[(i + q0, j, s) for q0, (i, j, s) in held.items()]))
