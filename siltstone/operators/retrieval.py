"""Lexical, vector and fused search.

Postings and vectors are made once from a corpus and kept with it; a search joins a few query terms with them. All
searches take a table of queries (query_id, query), so that many are answered in one pass; ranks are by (score
descending, id ascending) of scores rounded to SCORE_DIGITS, so that they do not hang on the order of additions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.functions import text as tx
from siltstone.operators import products
from siltstone.runtime import cut, ship

SCORE_DIGITS = 6
#: BM25's saturation and length normalisation; buckets of hashed vectors; the constant of rank fusion.
K1, LENGTH_WEIGHT, BUCKETS, FUSION = 1.5, 0.75, 384, 60
#: Documents and queries whose cosines are one product of matrices.
DOCUMENT_BLOCK, QUERY_BLOCK = 4_000, 1_000
MODES = ("lexical", "vector", "hybrid")

# Words of a query that ask for architecture, and what then weighs how much, first match wins.
ARCHITECTURE = ["snapshot", "aggregate", "event stream", "event sourcing", "replay", "idempot", "outbox", "transaction", "reconciliation", "payment", "refund", "callback", "webhook", "projection"]
WEIGHTS = [(r"\.go$", 1.30), (r"\.proto$", 1.10), (r"\.md$", 0.90), (r"\.golangci", 0.05), (r"\.vscode/", 0.05), (r"\.github/", 0.10), (r"\.ya?ml$", 0.20), (r"\.json$", 0.40)]


def candidates_for(k: int) -> int:
    """How many of each ranking are fused for the best `k`."""
    return max(50, 4 * k)


def check_search(k: int, mode: str) -> None:
    """Refuse a result size outside 1 to 100 and unknown modes."""
    if not 1 <= k <= 100:
        raise ValueError("k must be from 1 to 100")
    if mode not in MODES:
        raise ValueError(f"mode must be one of {', '.join(MODES)}")


def asks_architecture(query: Column) -> Column:
    """Whether a query asks for architecture."""
    asks = F.lit(False)
    for word in ARCHITECTURE:
        asks = asks | F.contains(F.lower(query), F.lit(word))
    return asks


def kind_weight(path: Column) -> Column:
    """How much a chunk of `path` weighs, by its kind, for a query that asks for architecture."""
    weight = F.lit(1.0)
    for pattern, w in reversed(WEIGHTS):
        weight = F.when(F.regexp_like(F.lower(path), F.lit(pattern)), w).otherwise(weight)
    return weight


def source_weight(path: Column, query: Column) -> Column:
    """How much a chunk of `path` weighs for a query: 1, or by its kind if the query asks for architecture."""
    return F.when(asks_architecture(query), kind_weight(path)).otherwise(1.0)


def weigh(scores: DataFrame, docs: DataFrame, key: str, queries: DataFrame, score: str) -> DataFrame:
    """`scores` (query_id, key, ..) with `score` weighed: each path and each query is looked at once, not each pair."""
    kinds = docs.select(key, (F.col("kind") if "kind" in docs.columns else kind_weight(F.col("path"))).alias("_kind"))
    asking = queries.select("query_id", (F.col("asks") if "asks" in queries.columns else asks_architecture(F.col("query"))).alias("_asks"))
    weight = F.when(F.col("_asks"), F.col("_kind")).otherwise(1.0)
    return scores.join(kinds, key).join(asking, "query_id").withColumn(score, F.col(score) * weight).drop("_kind", "_asks")


def searchable(chunks: DataFrame) -> DataFrame:
    """Chunks that a search may give: no package clauses or imports."""
    return chunks.filter(~F.coalesce(F.col("symbol_type").isin("package", "import"), F.lit(False)))


def postings(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(term, key, tf): how often each term stands in each document."""
    return docs.select(key, F.explode_outer(tx.tokens(F.col(text))).alias("term")).filter("term is not null").groupBy("term", key).agg(F.count("*").alias("tf"))


def tf_idf(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, term, value): term counts times ln(documents / documents with the term); terms of all documents count 0."""
    counts = postings(docs, key, text)
    df = counts.groupBy("term").agg(F.count("*").alias("df"))
    # one row
    n = docs.agg(F.count("*").alias("n_docs"))
    weighted = counts.join(df, "term").crossJoin(F.broadcast(n))
    return weighted.select(key, "term", (F.col("tf") * F.log(F.col("n_docs") / F.col("df"))).alias("value")).filter("value > 0")


def query_terms(queries: DataFrame) -> DataFrame:
    """(query_id, term): the distinct terms of each query."""
    return queries.select("query_id", F.explode(F.array_distinct(tx.tokens(F.col("query")))).alias("term"))


def bm25(docs: DataFrame, key: str, text: str, queries: DataFrame, weighted: bool = False) -> DataFrame:
    """(query_id, key, score) of all documents with a term of a query, and a score above 0.

    Only postings of the queries' terms leave the tokenisation: lengths are counted in the same pass over the documents
    by the size of their token arrays. `weighted` ones weigh by `source_weight` of their `path`.
    """
    tokens = tx.tokens(F.col(text))
    sized = docs.select("*", F.size(tokens).alias("dl"), tokens.alias("tokens"))
    terms = query_terms(queries)
    # the posting side is cut by a semi join before it is counted; the planner broadcasts the terms where they are few
    hits = sized.select(key, "dl", F.explode_outer("tokens").alias("term")).join(terms.select("term").distinct(), "term", "left_semi").groupBy("term", key, "dl").agg(F.count("*").alias("tf"))
    return _scores(hits, sized, key, docs, terms, queries, weighted)


def bm25_of(kept: DataFrame, docs: DataFrame, key: str, queries: DataFrame, weighted: bool = False) -> DataFrame:
    """`bm25` from postings (term, key, tf) that are kept, and `docs` with the length `dl` of each: no text is read."""
    terms = query_terms(queries)
    hits = kept.join(terms.select("term").distinct(), "term", "left_semi").join(docs.select(key, "dl"), key)
    return _scores(hits, docs, key, docs, terms, queries, weighted)


def _scores(hits: DataFrame, sized: DataFrame, key: str, docs: DataFrame, terms: DataFrame, queries: DataFrame, weighted: bool) -> DataFrame:
    stats = sized.agg(F.count("*").alias("n_docs"), F.coalesce(F.nullif(F.avg("dl"), F.lit(0.0)), F.lit(1.0)).alias("avg_dl"))
    df = hits.groupBy("term").agg(F.count("*").alias("df"))
    idf = F.log1p((F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    tf = F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - LENGTH_WEIGHT + LENGTH_WEIGHT * F.col("dl") / F.col("avg_dl")))
    # one row of statistics
    scored = hits.join(df, "term").crossJoin(F.broadcast(stats)).select("term", key, (idf * tf).alias("s"))
    found = scored.join(terms, "term").groupBy("query_id", key).agg(F.sum("s").alias("s"))
    if weighted:
        found = weigh(found, docs, key, queries, "s")
    return found.select("query_id", key, F.round("s", SCORE_DIGITS).alias("score")).filter("score > 0")


def bm25_best(docs: DataFrame, key: str, text: str, queries: DataFrame, k: int, weighted: bool = False) -> DataFrame:
    """`bm25` of any number of queries, of each at least the best `k`: by blocks, so that no pair of a query and a
    document is ever a row before it is known to be among the best of its block."""
    extra = [kind_weight(F.col("path")).alias("kind")] if weighted else []
    rows = products.pack(docs.select(key, text, *extra), text, key, *["kind"] * weighted)
    return bm25_packed(cut(rows, "terms"), key, pack_queries(queries, weighted), k)


def bm25_of_all(docs: DataFrame, key: str, text: str, k: int) -> DataFrame:
    """`bm25_best` where each document asks with its own text."""
    rows = cut(products.pack(docs, text, key), "terms")
    return bm25_packed(rows, key, rows.select(F.col(key).alias("query_id"), "term"), k)


def pack_queries(queries: DataFrame, weighted: bool, vectors: bool = False) -> DataFrame:
    """`products.pack` of queries, with whether each `asks` for architecture if they are `weighted`."""
    extra = [F.coalesce(asks_architecture(F.col("query")), F.lit(False)).alias("asks")] if weighted else []
    return cut(products.pack(queries.select("query_id", "query", *extra), "query", "query_id", *["asks"] * weighted, hashed=HASHED if vectors else None), "asked")


def bm25_packed(docs: DataFrame, key: str, asked: DataFrame, k: int) -> DataFrame:
    """`bm25_best` of stored rows of `products.pack`."""
    n_docs, avg_dl = docs.agg(F.count("*"), F.coalesce(F.nullif(F.avg("dl"), F.lit(0.0)), F.lit(1.0))).first()
    df = docs.select(F.explode("term").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    idf = F.log1p((F.lit(n_docs) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    extra = [c for c in ("asks",) if c in asked.columns]
    terms = asked.select("query_id", *extra, F.explode("term").alias("term")).join(df, "term")
    sought = terms.groupBy("query_id", *extra).agg(F.collect_list(F.struct("term", idf.alias("idf"))).alias("t")).select("query_id", *extra, F.col("t.term").alias("term"), F.col("t.idf").alias("idf"))

    def part(rows: pa.Table) -> np.ndarray:
        size, tf = products.flat(rows["tf"])
        tf, length = tf.to_numpy().astype(float), np.repeat(rows["dl"].to_numpy() / avg_dl, size)
        return tf * (K1 + 1) / (tf + K1 * (1 - LENGTH_WEIGHT + LENGTH_WEIGHT * length))

    kept = docs.select(key, *[c for c in ("kind",) if c in docs.columns], "dl", "term", "tf")
    return products.best(kept, key, cut(sought, "asked"), k, "term", part, lambda rows: products.flat(rows["idf"])[1].to_numpy())


def bucket_and_sign(term: Column) -> Column:
    """Where a term is counted in a hashed vector, and as what: by the first five bytes of its digest."""
    digest = tx.digest(term)
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % BUCKETS
    odd = F.conv(F.substring(digest, 9, 2), 16, 10).cast("int") % 2 == 1
    return F.struct(bucket.cast("int").alias("bucket"), F.when(odd, 1).otherwise(-1).alias("sign"))


def bucket_and_sign_of(term: str) -> tuple[int, int]:
    """`bucket_and_sign` in Python."""
    h = hashlib.sha256(term.encode()).digest()
    return int.from_bytes(h[:4], "big") % BUCKETS, 1 if h[4] % 2 else -1


#: What `products.pack` needs to make hashed vectors beside the terms.
HASHED = (BUCKETS, bucket_and_sign_of)


def hashed_vectors(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, bucket, value): sparse unit vectors of signed, hashed term counts; documents without terms have none.

    Terms are counted by document first, and each distinct term is hashed once a document.
    """
    return hashed_of(postings(docs, key, text), key)


def hashed_of(kept: DataFrame, key: str) -> DataFrame:
    """`hashed_vectors` from postings (term, key, tf)."""
    counts = kept.select(key, bucket_and_sign(F.col("term")).alias("b"), "tf")
    buckets = counts.groupBy(key, F.col("b.bucket").alias("bucket")).agg(F.sum(F.col("b.sign") * F.col("tf")).cast("double").alias("v"))
    norm = F.sqrt(F.sum(F.col("v") * F.col("v")).over(Window.partitionBy(key)))
    return buckets.select(key, "bucket", (F.col("v") / F.greatest(norm, F.lit(1e-12))).alias("value"))


def sparse_cosine(vectors: DataFrame, key: str, asked: DataFrame) -> DataFrame:
    """(query_id, key, score): cosines above 0 of queries' and documents' sparse vectors, over shared buckets only."""
    both = vectors.join(asked.select("query_id", "bucket", F.col("value").alias("q")), "bucket")
    return both.groupBy("query_id", key).agg(F.round(F.sum(F.col("value") * F.col("q")), SCORE_DIGITS).alias("score")).filter("score > 0")


def pack_vectors(vectors: DataFrame, key: str) -> DataFrame:
    """(key, b, v): sparse vectors (key, bucket, value) as a row each."""
    return vectors.groupBy(key).agg(F.collect_list("bucket").alias("b"), F.collect_list("value").alias("v"))


def nearest(vectors: DataFrame, key: str, asked: DataFrame, k: int) -> DataFrame:
    """(query_id, key, score): `sparse_cosine` of hashed vectors for many queries, of each at least the best `k`."""
    return nearest_packed(cut(pack_vectors(vectors, key), "packed"), key, cut(pack_vectors(asked, "query_id"), "asked"), k)


def nearest_packed(vectors: DataFrame, key: str, asked: DataFrame, k: int) -> DataFrame:
    """`nearest` of packed vectors (key, b, v) that are stored."""
    value = lambda rows: products.flat(rows["v"])[1].to_numpy(zero_copy_only=False)
    return products.best(vectors.select(key, "b", "v"), key, asked.select("query_id", "b", "v"), k, "b", value, value)


def hybrid_best(docs: DataFrame, key: str, text: str, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, key, score, rank): the best `k` of each query by the fused rankings of BM25 and of hashed vectors.

    Texts are cut into terms once for both.
    """
    rows = cut(products.pack(docs.select(key, text), text, key, hashed=HASHED), "terms")
    asked, n = pack_queries(queries, False, True), candidates_for(k)
    return fuse([top(bm25_packed(rows, key, asked, n), key, n), top(nearest_packed(rows, key, asked, n), key, n)], key, k)


def dense_cosine(vectors: DataFrame, key: str, vector: str, asked: DataFrame, k: int) -> DataFrame:
    """(query_id, key, score): cosines of vectors with query vectors, of each query at least the best `k`.

    Vectors that are null or have no length take no part; all others must have as many numbers as each other.
    """
    def matrix(rows: pd.DataFrame) -> np.ndarray:
        out = np.array(rows["v"].tolist(), np.float64)
        return out / np.linalg.norm(out, axis=1, keepdims=True)

    some = lambda df, id_, v: df.select(id_, F.col(v).alias("v")).filter(F.col("v").isNotNull() & F.exists("v", lambda x: x != 0))
    return _products(cut(some(vectors, key, vector), "packed"), key, some(asked, "query_id", "vector"), k, matrix, False)


def _products(docs: DataFrame, key: str, sought: DataFrame, k: int, matrix: Callable[[pd.DataFrame], np.ndarray], positive: bool) -> DataFrame:
    """(query_id, key, score) of the products of all rows' vectors, of each query at least the best `k` of each part.

    Up to QUERY_BLOCK queries go to where the stored `docs` are, and nothing else is moved but their best. More queries
    are laid in blocks, as are the documents; each pair of blocks is one product of matrices. The blocks' numbers follow
    from counts, so that none grows with the tables. Of each part a query keeps its best `k` and what ties with the last
    of them; `top` then has all it needs.
    """
    sought = cut(sought, "asked")
    kind = lambda df, c: df.schema[c].dataType.simpleString()
    schema = f"query_id {kind(sought, 'query_id')}, {key} {kind(docs, key)}, score double"
    ship(docs.sparkSession)

    def best(queries: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        if queries.empty or found.empty:
            return pd.DataFrame({"query_id": queries["query_id"][:0], key: found[key][:0], "score": np.zeros(0)})
        score = np.round(matrix(queries) @ matrix(found).T, SCORE_DIGITS)
        n = score.shape[1]
        last = np.partition(score, n - k, axis=1)[:, n - k, None] if n > k else -np.inf
        i, j = np.nonzero((score >= last) & ((score > 0) | (not positive)))
        return pd.DataFrame({"query_id": queries["query_id"].to_numpy()[i], key: found[key].to_numpy()[j], "score": score[i, j]})

    queries = sought.count()
    if queries <= QUERY_BLOCK:
        sent = docs.sparkSession.sparkContext.broadcast(sought.toPandas())

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for at in range(0, len(batch), DOCUMENT_BLOCK):
                    yield best(sent.value, batch.iloc[at : at + DOCUMENT_BLOCK])

        return docs.mapInPandas(run, schema)
    across, down = -(-docs.count() // DOCUMENT_BLOCK) or 1, -(-queries // QUERY_BLOCK)
    block = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = sought.select("*", block("query_id", down).alias("y"), numbers(across).alias("x"))
    right = docs.select("*", block(key, across).alias("x"), numbers(down).alias("y"))
    return left.groupBy("x", "y").cogroup(right.groupBy("x", "y")).applyInPandas(best, schema)


def top(scores: DataFrame, key: str, k: int) -> DataFrame:
    """(query_id, key, score, rank): the best `k` of each query."""
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), F.col(key))
    return scores.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def fuse(rankings: list[DataFrame], key: str, k: int, weights: DataFrame | None = None) -> DataFrame:
    """(query_id, key, score, rank): the best `k` by the sum of weight / (FUSION + rank) over the rankings."""
    rows = rankings[0].select("query_id", key, "rank")
    for r in rankings[1:]:
        rows = rows.unionByName(r.select("query_id", key, "rank"))
    if weights is not None:
        rows = rows.join(weights, ["query_id", key], "left")
    weight = F.coalesce("weight", F.lit(1.0)) if weights is not None else F.lit(1.0)
    total = rows.groupBy("query_id", key).agg(F.round(F.sum(weight / (F.lit(FUSION) + F.col("rank"))), SCORE_DIGITS + 3).alias("score"))
    return top(total, key, k)


#: Makes sparse vectors (id, bucket, value) of texts (id, body): buckets below BUCKETS, a length of 1.
Embedder = Callable[[DataFrame], DataFrame]


def searched(chunks: DataFrame) -> DataFrame:
    """(id, path, reference, body) of the searchable chunks, each id once."""
    one = searchable(chunks).filter("id is not null").groupBy("id").agg(F.min(F.struct("repo", "path", "symbol", "content", "start_line", "end_line")).alias("c")).select("id", "c.*")
    body = F.concat_ws(" ", F.concat_ws("/", "repo", "path"), "symbol", "content")
    reference = F.concat("repo", F.lit("/"), "path", F.lit(":"), F.col("start_line"), F.lit("-"), F.col("end_line"))
    return one.select("id", "path", reference.alias("reference"), body.alias("body"))


def corpus_tables(chunks: DataFrame, embedder: Embedder | None = None) -> dict[str, DataFrame]:
    """What searches read of a corpus: `documents` (id, path, reference, dl) of its searchable chunks, each id once,
    `postings` (term, id, tf) and `vectors` (id, b, v): buckets and values.

    The text of a chunk is its place, its symbol and its content. Without an `embedder` vectors are hashed terms.
    """
    docs = searched(chunks)
    kept = cut(postings(docs, "id", "body"), "postings")
    # a document's length is what its postings add up to
    sizes = kept.groupBy("id").agg(F.sum("tf").cast("int").alias("dl"))
    told = cut(docs.drop("body").join(sizes, "id", "left").select("id", "path", "reference", F.coalesce("dl", F.lit(0)).alias("dl")), "documents")
    return {"documents": told, "postings": kept, "vectors": cut(pack_vectors(embedder(docs.select("id", "body")) if embedder else hashed_of(kept, "id"), "id"), "vectors")}


def search(chunks: DataFrame, queries: DataFrame, k: int = 5, mode: str = "hybrid") -> DataFrame:
    """(query_id, id, score, rank, reference): `search_tables` over chunks that no index keeps, for any number of queries."""
    check_search(k, mode)
    docs = searched(chunks).select("id", "body", "reference", kind_weight(F.col("path")).alias("kind"))
    packed = cut(products.pack(docs, "body", "id", "reference", "kind", hashed=HASHED), "terms")
    asked = pack_queries(queries.filter(tx.collapse(F.col("query")) != ""), True, True)
    n = candidates_for(k)
    # stored, since both fusing and weighing read them
    lexical = cut(top(bm25_packed(packed, "id", asked, n), "id", n), "lexical") if mode != "vector" else None
    vector = cut(top(nearest_packed(packed, "id", asked, n), "id", n), "vector") if mode != "lexical" else None
    return _ranked(lexical, vector, packed, asked, k)


def search_tables(kept: dict[str, DataFrame], queries: DataFrame, k: int = 5, mode: str = "hybrid", embedder: Embedder | None = None) -> DataFrame:
    """(query_id, id, score, rank, reference): the best `k` chunks of each query (query_id, query).

    Blank queries find nothing. `hybrid` fuses the lexical ranking, weighted by kind of source, with that of hashed
    vectors, and weights again; the others rank by their own weighted scores. Only the tables of `corpus_tables` are
    read, never a text.
    """
    check_search(k, mode)
    docs = kept["documents"]
    asked = queries.filter(tx.collapse(F.col("query")) != "")
    n = candidates_for(k)
    lexical = vector = None
    if mode != "vector":
        lexical = top(bm25_of(kept["postings"], docs.select("id", "path", "dl"), "id", asked, True), "id", n)
    if mode != "lexical":
        sought = embedder(asked.select(F.col("query_id").alias("id"), F.col("query").alias("body"))).withColumnRenamed("id", "query_id") if embedder else hashed_vectors(asked, "query_id", "query")
        vector = top(nearest_packed(kept["vectors"], "id", cut(pack_vectors(sought, "query_id"), "asked"), n), "id", n)
    return _ranked(lexical, vector, docs, asked, k)


def _ranked(lexical: DataFrame | None, vector: DataFrame | None, docs: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """(query_id, id, score, rank, reference): the best `k` of one ranking or of both, weighed."""
    if lexical is not None and vector is not None:
        ids = lexical.select("query_id", "id").unionByName(vector.select("query_id", "id")).distinct()
        weights = weigh(ids.withColumn("weight", F.lit(1.0)), docs, "id", asked, "weight")
        best = fuse([lexical, vector], "id", k, weights)
    elif lexical is not None:
        best = lexical.filter(F.col("rank") <= k).select("query_id", "id", "score", "rank")
    else:
        weighed = weigh(vector.select("query_id", "id", "score"), docs, "id", asked, "score")
        best = top(weighed.withColumn("score", F.round("score", SCORE_DIGITS)), "id", k)
    return best.join(docs.select("id", "reference"), "id").select("query_id", "id", "score", "rank", "reference")


def find_symbol(chunks: DataFrame, symbol: str, limit: int = 100) -> DataFrame:
    """The first `limit` chunks named `symbol`, or `anything.symbol`, by file and id."""
    return chunks.filter((F.col("symbol") == symbol) | F.endswith("symbol", F.lit("." + symbol))).orderBy("file_key", "id").limit(limit)


def recall(expected: DataFrame, retrieved: DataFrame, k: int = 5) -> DataFrame:
    """(case_id, recall): the share of each case's expected files among those of its first `k` results."""
    got = retrieved.filter(F.col("rank") <= k).groupBy("case_id").agg(F.collect_set("file_key").alias("got"))
    want = expected.groupBy("case_id").agg(F.collect_set("file_key").alias("want"))
    found = F.size(F.array_intersect("want", F.coalesce("got", F.array().cast("array<string>"))))
    return want.join(got, "case_id", "left").select("case_id", (found / F.size("want")).alias("recall"))
