"""Filling fixed-capacity containers with items (problem 8).

Items longer than a container are cut into full containers and a remainder. What is left is packed by multiway
differencing (Karmarkar and Karp): every item begins as a partition of itself and empty windows; the two partial
partitions with the largest imbalance are merged again and again, the fullest windows of the one onto the emptiest of
the other, until one partition is left whose windows are nearly equal. It has as many windows as the total needs at
least; while its fullest window exceeds the capacity, the window count rises.

Differencing is done in cells: items are hashed into as many cells as keep the expected total of each near
`CELL` containers and its items near `CELL_ITEMS` at most, whatever the table's size, so that no task sees more than a
few cells and the rounding up to whole windows costs less than one container in `CELL`, or one for so many items.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.runtime import cut, ship

#: Containers that the items of one cell are expected to fill.
CELL = 512
#: Items of one cell, as expected: empty and very small ones fill no containers, but they take time.
CELL_ITEMS = 1 << 15
#: Tasks that cells are spread over at most; beyond it a task has several cells, one after the other.
TASKS = 1 << 13


def _difference(sizes: np.ndarray, windows: int) -> tuple[np.ndarray, np.ndarray]:
    """(window of each item, sums) by multiway differencing into `windows`."""
    # every set of items is a tree: a node below len(sizes) is an item, any other joins two nodes
    n = len(sizes)
    left, right = np.empty(n, np.int64), np.empty(n, np.int64)
    joined = 0
    heap: list[tuple[int, int, np.ndarray, np.ndarray]] = [(-int(s), i, np.array([s]), np.array([i])) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    turn = n
    while len(heap) > 1:
        (_, _, a, x), (_, _, b, y) = heapq.heappop(heap), heapq.heappop(heap)
        # windows in falling order of sums; those that are not kept are empty
        over = len(a) + len(b) - windows
        if over > 0:
            # the fullest of one onto the emptiest of the other: only the last `over` of both meet
            sums = np.concatenate([a[: len(a) - over], a[len(a) - over :] + b[::-1][:over], b[: len(b) - over]])
            new = np.arange(n + joined, n + joined + over)
            left[joined : joined + over] = x[len(a) - over :]
            right[joined : joined + over] = y[::-1][:over]
            joined += over
            nodes = np.concatenate([x[: len(a) - over], new, y[: len(b) - over]])
        else:
            sums, nodes = np.concatenate([a, b]), np.concatenate([x, y])
        order = np.argsort(-sums, kind="stable")
        sums, nodes = sums[order], nodes[order]
        turn += 1
        low = int(sums[-1]) if len(sums) == windows else 0
        # an imbalance counts, not the sums: what all windows share is set aside
        heapq.heappush(heap, (low - int(sums[0]), turn, sums, nodes))
    _, _, sums, nodes = heap[0]
    owner = np.full(n + joined, -1, np.int64)
    owner[nodes] = np.arange(len(nodes))
    for j in range(joined - 1, -1, -1):
        owner[left[j]] = owner[right[j]] = owner[n + j]
    return owner[:n], sums


def pack_cell(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The window of each size, none over `capacity`; the window count begins at the least the total allows."""
    windows = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        owner, sums = _difference(sizes, windows)
        if len(sums) == 0 or int(sums.max()) <= capacity:
            return owner
        windows += 1


def pack(counts: DataFrame, key: str, size: str = "tokens", capacity: int = 2048, cell: int = CELL) -> DataFrame:
    """(key, part, first, size, container): every item of `counts` in containers of `capacity`, none overfull.

    An item longer than `capacity` comes out as several parts: full containers of their own, and the rest, which is
    packed with the others; `first` is where the part begins in the item. Any other item comes out as one part. Items
    of size 0 or null take no room and are put with others. Every row is an item: repeated rows and null keys are
    packed each for itself. Negative sizes are refused. Further columns are ignored; an empty table gives no rows.
    """
    spark = counts.sparkSession
    ship(spark)
    wanted = counts.select(F.col(key).alias("key"), F.coalesce(F.col(size).cast("long"), F.lit(0)).alias("size"))
    checked = wanted.withColumn("size", F.when(F.col("size") < 0, F.raise_error(F.lit("a size is negative"))).otherwise(F.col("size")))
    # the row's number is written with it, so that it stays whatever is computed again
    items = cut(checked.withColumn("row", F.monotonically_increasing_id()), "items")
    rest = F.pmod(F.col("size"), F.lit(capacity))
    sums = items.agg(F.coalesce(F.sum(rest), F.lit(0)).alias("total"), F.count("*").alias("rows")).first()
    cells = max(1, round(sums["total"] / capacity / cell), -(-sums["rows"] // CELL_ITEMS))
    parts = F.sequence(F.lit(0), F.floor(F.col("size") / capacity) - 1)
    full = items.filter(F.col("size") >= capacity).select("key", "row", F.explode(parts).alias("part"))
    full = full.select("key", F.col("part").cast("int"), (F.col("part") * capacity).cast("long").alias("first"), F.lit(capacity).cast("long").alias("size"), F.concat_ws("-", F.lit("own"), "row", "part").alias("container"))
    # an item whose parts fill their containers has no rest
    loose = items.filter((rest > 0) | (F.col("size") == 0)).select("key", "row", (F.col("size") - rest).alias("first"), rest.alias("size"), F.pmod(F.xxhash64("row"), F.lit(cells)).alias("cell"))
    schema = T.StructType([T.StructField("key", items.schema["key"].dataType), T.StructField("part", T.IntegerType()), T.StructField("first", T.LongType()), T.StructField("size", T.LongType()), T.StructField("container", T.StringType())])

    def fill(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("row", ignore_index=True)
        owner = pack_cell(group["size"].to_numpy(np.int64), capacity)
        where = f"{group['cell'].iloc[0]}-"
        return pd.DataFrame({"key": group["key"], "part": (group["first"] // capacity).astype("int32"), "first": group["first"], "size": group["size"], "container": [where + str(w) for w in owner]})

    # by number: cells are small in bytes and long in time, and would be put together into one task
    packed = loose.repartition(min(cells, TASKS), "cell").groupBy("cell").applyInPandas(fill, schema)
    return full.unionByName(packed).withColumnsRenamed({"key": key, "size": size})
