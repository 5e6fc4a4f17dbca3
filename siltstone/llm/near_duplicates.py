"""Near-duplicate records with small edits (problem 1), by vantage-point trees over fingerprints.

Records are sets of shingles (runs of consecutive tokens); two are near-duplicates when their sets' Jaccard similarity
is at least a threshold. A record's fingerprint is a bitmap of `SKETCH` bits: each shingle flips the bit that its hash
names. The Hamming distance of two fingerprints is never more than the number of shingles in just one of the two sets,
which for near-duplicates is bounded by their sizes; the distance to the empty fingerprint tells of the size itself.
So distances spread as widely as sizes do, and the triangle inequality has something to exclude; fingerprints whose
distances all lie about half the bits apart would leave it nothing.

1. Records with the same set are one class; only one of them is compared.
2. Records that agree on a band, `ROWS` of the minima of their hashed shingles, share a shard. At similarity 0.7 a pair
   misses all `BANDS` shards with probability 2e-5, at 0.8 with 8e-8. Unrelated records are not even near each other in
   any part of the tree; without shards the tree would compare the records of one size with each other.
3. A shard is a vantage-point tree over the fingerprints. Its root is the empty fingerprint, whose rings are one step
   of the similarity wide, so that partners lie in the same ring or the next; below, a node parts its members by their
   distance from one of them. A branch is entered only where the triangle inequality lets it hold partners.
4. A shard too large for a task is cut by the same vantage points, shared by all tasks: first into the rings about the
   empty fingerprint, then into rings about members, each at least one radius wide. A ring is queried by its own
   members and by those of the ring before, which is where the bound lets partners be. A ring that stays too large is
   compared block against block.
5. The candidates' sets are compared exactly.

Nothing is capped: every pair within the radius that shares a shard is compared.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.llm.matches import consolidate
from siltstone.runtime import cut, drop, ship

BANDS, ROWS = 16, 2
#: Bits of a fingerprint, and 64-bit words of it.
SKETCH = 256
WORDS = SKETCH // 64
#: Records of a shard that one task compares, and rounds of rings before blocks.
SHARD, RING_ROUNDS = 4096, 3
#: Fingerprints in a leaf of a tree.
LEAF = 8

TOKEN = re.compile(r"[a-z0-9_]+")
_KNOWN_TOKENS = 1 << 20


def radius(sizes: np.ndarray, similarity: float) -> np.ndarray:
    """Bits within which the fingerprint of a similar set, no larger than a set of each of `sizes`, lies.

    No set of that kind has more than (1 - s) / (1 + s) of both sizes' sum apart. Of many shingles apart, some fall on
    one bit and cancel: then the mean of the distance and five standard deviations are less than their number.
    """
    apart = np.floor((1 - similarity) / (1 + similarity) * 2 * np.asarray(sizes, np.float64) + 1e-9)
    left = np.exp(-2 * apart / SKETCH)
    likely = np.ceil(SKETCH / 2 * (1 - left) + 5 * np.sqrt(np.maximum(SKETCH / 4 * (1 - left * left), 1.0)))
    return np.minimum(apart, likely).astype(np.int32)


def ring_of(sizes: np.ndarray, similarity: float) -> np.ndarray:
    """The ring about the empty fingerprint: similar sets lie in the same or in neighbouring ones."""
    return np.floor(np.log(np.asarray(sizes, np.float64)) / -math.log(similarity) + 1e-9).astype(np.int32)


# --- fingerprints ----------------------------------------------------------------------------------------------------


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


@lru_cache(maxsize=1)
def _constants() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20250101)
    return draw.integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1), draw.integers(0, 1 << 63, BANDS * ROWS, np.uint64)


class _Shingles:
    """The shingle sets of texts, as sorted 50-bit hashes; remembers tokens' hashes."""

    def __init__(self, width: int):
        self.width, self.known = width, {}

    def _hash(self, token: str) -> int:
        found = self.known.get(token)
        if found is None:
            if len(self.known) >= _KNOWN_TOKENS:
                self.known.clear()
            found = self.known[token] = xxhash.xxh64_intdigest(token)
        return found

    def sets(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, starts): the set of texts[i] is hashes[starts[i] : starts[i + 1]]. At most 16,384 texts."""
        known, one = self.known, self._hash
        tokens: list[int] = []
        ends = np.zeros(len(texts) + 1, np.int64)
        for i, text in enumerate(texts):
            found = TOKEN.findall(text.lower())
            tokens += [known.get(t) or one(t) for t in found]
            ends[i + 1] = len(tokens)
        words = np.array(tokens, np.uint64)
        n = len(words) - self.width + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
        made = np.zeros(n, np.uint64)
        for k in range(self.width):
            made = _mix(made + words[k : k + n])
        text_of = np.repeat(np.arange(len(texts)), np.diff(ends))
        inside = text_of[:n] == text_of[self.width - 1 :]
        owner = text_of[:n][inside].astype(np.uint64)
        both = np.unique((owner << np.uint64(50)) | (made[inside] >> np.uint64(14)))
        owner = (both >> np.uint64(50)).astype(np.int64)
        return both & np.uint64((1 << 50) - 1), np.searchsorted(owner, np.arange(len(texts) + 1))


def _minima(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The minima of every set under each hash function: [sets, BANDS * ROWS]. No set may be empty."""
    a, b = _constants()
    spread = _mix(hashes)
    out = np.empty((BANDS * ROWS, len(starts) - 1), np.uint32)
    for j in range(BANDS * ROWS):
        out[j] = np.minimum.reduceat(((spread * a[j] + b[j]) >> np.uint64(32)).astype(np.uint32), starts[:-1])
    return out.T


def _band_keys(minima: np.ndarray) -> np.ndarray:
    """The key of each band of each set."""
    keys = np.zeros((len(minima), BANDS), np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)
    for r in range(ROWS):
        keys = _mix(keys + minima[:, r * BANDS : (r + 1) * BANDS].astype(np.uint64))
    return keys


def _prints(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The words of each set's fingerprint."""
    n = len(starts) - 1
    place = (_mix(hashes + np.uint64(0x5851F42D)) % np.uint64(SKETCH)).astype(np.int64)
    flips = np.bincount(np.repeat(np.arange(n) * SKETCH, np.diff(starts)) + place, minlength=n * SKETCH)
    return np.packbits((flips & 1).astype(np.uint8).reshape(n, SKETCH), axis=1).view(np.uint64)


WORD_NAMES = [f"w{i}" for i in range(WORDS)]


def fingerprints(df: DataFrame, key: str, text: str, shingle: int) -> DataFrame:
    """(key, set_a, set_b, size, w0.., bands) of every row whose text has a shingle; one pass, no shuffle."""
    ship(df.sparkSession)
    fields = [T.StructField(key, df.schema[key].dataType), T.StructField("set_a", T.LongType()), T.StructField("set_b", T.LongType())]
    fields.append(T.StructField("size", T.IntegerType()))
    schema = T.StructType([*fields, *(T.StructField(w, T.LongType()) for w in WORD_NAMES), T.StructField("bands", T.ArrayType(T.LongType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = _Shingles(shingle)
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                hashes, starts = made.sets(part.column(1).to_pylist())
                some = np.flatnonzero(np.diff(starts))
                if not len(some):
                    continue
                begins = np.append(starts[:-1][some], len(hashes))
                words, keys = _prints(hashes, begins), _band_keys(_minima(hashes, begins))
                sums = [np.add.reduceat(_mix(hashes + np.uint64(seed)), begins[:-1]).view(np.int64) for seed in (1, 2)]
                bands = pa.ListArray.from_arrays(pa.array(np.arange(0, BANDS * len(some) + 1, BANDS, dtype=np.int32)), pa.array(keys.ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(some)), *map(pa.array, sums), pa.array(np.diff(begins).astype(np.int32)), *(pa.array(words[:, i].view(np.int64)) for i in range(WORDS)), bands], names=schema.names)

    return df.select(key, text).filter(F.col(text).isNotNull()).mapInArrow(run, schema)


# --- trees -----------------------------------------------------------------------------------------------------------


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int32)


def close_pairs(words: np.ndarray, sizes: np.ndarray, similarity: float, computed: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """All (i, j), i < j, whose sizes and fingerprints allow so much similarity, by a vantage-point tree.

    Each is queried for those not larger than itself. The tree is built and queried together: a branch is entered by
    the queries whose distance from the vantage point is within the branch's own distances, give or take the query's
    radius. The first vantage point is the empty fingerprint, from which sizes are the distances. `computed` takes the
    number of distances computed.
    """
    reach = radius(sizes, similarity)
    rings = ring_of(sizes, similarity)
    every = np.arange(len(words))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    work: list[tuple[np.ndarray, np.ndarray]] = []
    count = 0

    def compare(queries: np.ndarray, members: np.ndarray) -> None:
        for at in range(0, len(queries), 512):
            some = queries[at : at + 512]
            q, m = np.nonzero(_distance(words[some][:, None], words[members][None]) <= reach[some][:, None])
            found.append((some[q], members[m]))

    for ring in np.unique(rings):
        members = every[rings == ring]
        low, high = sizes[members].min(), sizes[members].max()
        work.append((members, every[(sizes >= low) & (sizes * similarity <= high + 1e-9)]))
    while work:
        members, queries = work.pop()
        if not len(queries):
            continue
        if len(members) <= LEAF:
            count += len(members) * len(queries)
            compare(queries, members)
            continue
        point, members = members[0], members[1:]
        d, e = _distance(words[members], words[point]), _distance(words[queries], words[point])
        count += len(members) + len(queries)
        hit = queries[e <= reach[queries]]
        found.append((hit, np.full(len(hit), point)))
        near = d <= int(np.median(d))
        if near.all():
            near = d < d.max()
        if not near.any():
            # all equally far: no border parts them
            queries = queries[np.abs(e - d[0]) <= reach[queries]]
            count += len(members) * len(queries)
            compare(queries, members)
            continue
        for side in (near, ~near):
            low, high = d[side].min(), d[side].max()
            work.append((members[side], queries[(e >= low - reach[queries]) & (e <= high + reach[queries])]))
    if computed is not None:
        computed.append(count)
    q = np.concatenate([x for x, _ in found]) if found else np.zeros(0, np.int64)
    m = np.concatenate([y for _, y in found]) if found else np.zeros(0, np.int64)
    fit = (sizes[m] <= sizes[q]) & (sizes[m] >= similarity * sizes[q] - 1e-9) & ((sizes[m] < sizes[q]) | (q < m))
    return np.minimum(q[fit], m[fit]), np.maximum(q[fit], m[fit])


def _shard_pairs(batches: Iterator[pd.DataFrame], similarity: float) -> Iterator[pd.DataFrame]:
    """Pairs of each shard of a partition sorted by shard; a shard may go over several batches."""
    rest: pd.DataFrame | None = None

    def pairs(rows: pd.DataFrame) -> pd.DataFrame:
        shard = rows["shard"].to_numpy()
        cuts = np.concatenate([[0], np.flatnonzero(shard[1:] != shard[:-1]) + 1, [len(shard)]])
        words = rows[WORD_NAMES].to_numpy(np.int64).view(np.uint64)
        rep, guest = rows["rep"].to_numpy(), rows["guest"].to_numpy()
        size = rows["size"].to_numpy()
        left, right = [], []
        many = np.diff(cuts)
        # most shards are pairs: those all at once
        twos = cuts[:-1][many == 2]
        least, most = np.minimum(size[twos], size[twos + 1]), np.maximum(size[twos], size[twos + 1])
        twos = twos[(least >= similarity * most - 1e-9) & (_distance(words[twos], words[twos + 1]) <= radius(most, similarity))]
        left.append(twos)
        right.append(twos + 1)
        for lo, n in zip(cuts[:-1][many > 2], many[many > 2]):
            a, b = close_pairs(words[lo : lo + n], size[lo : lo + n], similarity)
            left.append(a + lo)
            right.append(b + lo)
        a, b = np.concatenate(left), np.concatenate(right)
        keep = ((guest[a] & guest[b]) == 0) & (rep[a] != rep[b])
        a, b = rep[a[keep]], rep[b[keep]]
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)}).drop_duplicates()

    for batch in batches:
        if rest is not None:
            batch = pd.concat([rest, batch], ignore_index=True)
        last = batch["shard"].iloc[-1] if len(batch) else None
        going_on = (batch["shard"] == last).to_numpy() if len(batch) else np.zeros(0, bool)
        # equal shards lie together: the last one may go on
        rest = batch[going_on]
        if not going_on.all():
            yield pairs(batch[~going_on])
    if rest is not None and len(rest):
        yield pairs(rest)


def _bit_distance(left: list[Column], right: list[Column]) -> Column:
    out = F.lit(0)
    for a, b in zip(left, right):
        out = out + F.bit_count(a.bitwiseXOR(b))
    return out


def _split_shards(shards: DataFrame, similarity: float, limit: int) -> DataFrame:
    """Rows (shard, rep, size, reach, guest, words) in shards of about `limit` at most; see step 4 of the module.

    `guest` has a bit for each round in which the row is in its shard only as a partner for the others: two rows that
    share such a bit meet elsewhere.
    """
    done: DataFrame | None = None
    carried = ["size", "reach", *WORD_NAMES]
    for turn in range(RING_ROUNDS):
        about = F.min_by(F.struct(*WORD_NAMES), F.xxhash64(F.lit(turn), "rep"))
        sizes = cut(shards.groupBy("shard").agg(F.count("*").alias("n"), F.max("reach").alias("most"), about.alias("point")).filter(F.col("n") > limit), "large")
        if sizes.isEmpty():
            return shards if done is None else done.unionByName(shards)
        # at most one row for `limit` rows of shards: the planner broadcasts it where that is small
        small = shards.join(sizes.select("shard"), "shard", "left_anti")
        done = small if done is None else done.unionByName(small)
        if turn == 0:
            ring = F.floor(F.log(F.col("size").cast("double")) / -math.log(similarity) + 1e-9)
        else:
            ring = F.floor(_bit_distance([F.col(w) for w in WORD_NAMES], [F.col(f"point.{w}") for w in WORD_NAMES]) / (F.col("most") + 1))
        placed = shards.join(sizes.select("shard", "point", "most"), "shard").withColumn("ring", ring.cast("int"))
        copies = F.explode(F.array(F.struct(F.col("ring").alias("at"), F.lit(0).alias("bit")), F.struct((F.col("ring") + 1).alias("at"), F.lit(1 << turn).alias("bit"))))
        placed = placed.select("*", copies.alias("c"))
        shards = cut(placed.select(F.xxhash64("shard", F.lit(turn), "c.at").alias("shard"), "rep", F.col("guest").bitwiseOR(F.col("c.bit")).alias("guest"), *carried), "rings")
    sizes = shards.groupBy("shard").agg(F.count("*").alias("n"))
    blocks = F.ceil(F.col("n") / (limit // 2)).cast("int")
    large = cut(sizes.filter(F.col("n") > limit).select("shard", blocks.alias("blocks")), "large")
    small = shards.join(large.select("shard"), "shard", "left_anti")
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    placed = shards.join(large, "shard").withColumn("own", own).select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    # block i meets block j in the shard (i, j); pairs within a block are made in (i, i) only
    side = F.when(F.col("own") == F.col("other"), F.lit(0)).when(F.col("own") < F.col("other"), 1 << RING_ROUNDS).otherwise(2 << RING_ROUNDS)
    named = F.xxhash64("shard", F.lit(-1), F.least("own", "other"), F.greatest("own", "other"))
    crossed = placed.select(named.alias("shard"), "rep", F.col("guest").bitwiseOR(side).alias("guest"), *carried)
    rest = small.unionByName(crossed)
    return rest if done is None else done.unionByName(rest)


# --- the operator ----------------------------------------------------------------------------------------------------


class NearDuplicates:
    """The near-duplicates of `df`: see the module.

    `members` has (key, rep): the class of each row with a text of at least one shingle; `links` has (a, b, similarity)
    between classes, a < b. Rows with a null key or text, and texts too short for a shingle, take part in nothing. Rows
    that repeat key and text count once; a key with several texts is in several classes. Ties do not matter, further
    columns are ignored, and an empty table gives empty results. Texts are read whole, whatever their length.
    """

    def __init__(self, df: DataFrame, key: str, text: str, similarity: float = 0.8, shingle: int = 5, shard: int = SHARD):
        rows = df.select(F.col(key).alias("key"), F.col(text).alias("text")).filter("key is not null and text is not null")
        prints = cut(fingerprints(rows, "key", "text", shingle).withColumn("row", F.monotonically_increasing_id()), "prints")
        classes = prints.groupBy("set_a", "set_b").agg(F.min("row").alias("rep"), F.count("*").alias("n"))
        shared = cut(classes.filter("n > 1").select("set_a", "set_b", "rep"), "copies")
        told = cut(prints.select("key", "set_a", "set_b", "row").join(shared, ["set_a", "set_b"], "left").select("key", "row", F.coalesce("rep", "row").alias("rep")), "members")
        self.members = told.select("key", "rep").distinct()
        copies = told.filter("row <> rep").select("row")
        # the only pass that moves whole fingerprints; what is needed of them later is read from here
        single = cut(prints.join(copies, "row", "left_anti").select(F.col("row").alias("rep"), "set_a", "set_b", "size", "bands", *WORD_NAMES), "single")
        drop(prints, shared)
        banded = single.select(F.explode("bands").alias("shard"), "rep")
        # counted before the shuffle, and no task holds a whole shard
        several = cut(banded.groupBy("shard").agg(F.count("*").alias("n")).filter("n > 1").select("shard"), "several")
        placed = cut(banded.join(several, "shard", "left_semi"), "shards")
        # no fingerprint is further than its size or the bits from the empty one: a bound of every radius in a shard
        reach = F.least(F.floor(F.col("size") * 2 * (1 - similarity) / (1 + similarity) + 1e-9).cast("int"), F.lit(SKETCH))
        words = single.select("rep", "size", reach.alias("reach"), *WORD_NAMES)
        shards = _split_shards(placed.join(words, "rep").select("shard", "rep", F.lit(0).alias("guest"), "size", "reach", *WORD_NAMES), similarity, shard)
        near = shards.select("shard", "rep", "guest", "size", *WORD_NAMES).repartition("shard").sortWithinPartitions("shard").mapInPandas(lambda it: _shard_pairs(it, similarity), "a long, b long")
        pairs = cut(near.distinct(), "pairs")
        asked = pairs.select(F.explode(F.array("a", "b")).alias("row")).distinct()
        # the rows' texts again, for those in question only: one key may have several texts
        keys = told.join(asked, "row", "left_semi").select("key").distinct()
        sets = cut(_exact_sets(rows.join(keys, "key", "left_semi"), shingle).dropDuplicates(["set_a", "set_b"]), "sets")
        named = single.select(F.col("rep").alias("row"), "set_a", "set_b").join(asked, "row", "left_semi").join(sets, ["set_a", "set_b"]).select("row", "shingles")
        named = cut(named, "sets")
        both = F.size(F.array_intersect("x", "y"))
        share = both / (F.size("x") + F.size("y") - both)
        compared = pairs.join(named.select(F.col("row").alias("a"), F.col("shingles").alias("x")), "a").join(named.select(F.col("row").alias("b"), F.col("shingles").alias("y")), "b")
        self.links = cut(compared.select("a", "b", share.alias("similarity")).filter(F.col("similarity") >= similarity), "links")
        self.key = key
        drop(single, several, placed, pairs, sets, named)

    def pairs(self) -> DataFrame:
        """(id_a, id_b) of all pairs of different keys, id_a < id_b, that are near-duplicates, copies among them."""
        a = self.members.select(F.col("rep").alias("a"), F.col("key").alias("x"))
        b = self.members.select(F.col("rep").alias("b"), F.col("key").alias("y"))
        between = self.links.join(a, "a").join(b, "b").select("x", "y")
        # copies of one text
        within = a.join(b, F.col("a") == F.col("b")).filter("x < y").select("x", "y")
        pairs = between.unionByName(within).filter("x <> y")
        return pairs.select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b")).distinct()

    def groups(self) -> DataFrame:
        """(key, group_id, class_id, links): one row a key; its group over all links, its class of equal texts (the
        least key in it), and how many other classes are near-duplicates of it."""
        linked = consolidate(self.links, "a", "b").withColumnsRenamed({"id": "rep", "group_id": "group"})
        names = self.members.groupBy("rep").agg(F.min("key").alias("class_id"))
        degree = self.links.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count("*").alias("links"))
        told = names.join(linked, "rep", "left").join(degree, "rep", "left").select("rep", "class_id", F.coalesce("group", "rep").alias("group"), F.coalesce("links", F.lit(0)).alias("links"))
        told = cut(told, "classes")
        least = told.groupBy("group").agg(F.min("class_id").alias("group_id"))
        one = self.members.groupBy("key").agg(F.min("rep").alias("rep"))
        return one.join(told.join(least, "group"), "rep").select(F.col("key").alias(self.key), "group_id", "class_id", "links")


def _exact_sets(rows: DataFrame, shingle: int) -> DataFrame:
    """(set_a, set_b, shingles) of each row with a shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = _Shingles(shingle)
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                hashes, starts = made.sets(batch.slice(at, 2048).column(0).to_pylist())
                some = np.flatnonzero(np.diff(starts))
                if not len(some):
                    continue
                begins = np.append(starts[:-1][some], len(hashes))
                sums = [np.add.reduceat(_mix(hashes + np.uint64(seed)), begins[:-1]).view(np.int64) for seed in (1, 2)]
                yield pa.RecordBatch.from_arrays([*map(pa.array, sums), pa.ListArray.from_arrays(pa.array(begins.astype(np.int32)), pa.array(hashes.view(np.int64)))], names=["set_a", "set_b", "shingles"])

    return rows.select("text").mapInArrow(run, "set_a long, set_b long, shingles array<long>")


def chunk_near_duplicates(chunks: DataFrame, similarity: float = 0.7, shingle: int = 3) -> NearDuplicates:
    """Near-duplicates among chunks: see TESTDATA, p1_found, for which take part."""
    fit = (F.length("content") >= 100) & ~F.coalesce(F.col("symbol_type").isin("package", "import"), F.lit(False))
    return NearDuplicates(chunks.filter(fit), "id", "content", similarity, shingle)
