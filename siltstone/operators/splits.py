"""Train, validation and test splits of groups, and checks of them."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions import text as tx
from siltstone.operators.components import components
from siltstone.runtime import cut, ranked, ship


def module_split(files: DataFrame, chunks: DataFrame, fraction: float = 0.15) -> DataFrame:
    """(file_key, split): directories that share the text of a chunk are split together, by the least directory's hash.

    Texts of 100 characters or more count, whatever their white space; package clauses and imports do not.
    """
    if not 0 < fraction < 1:
        raise ValueError("fraction must lie between 0 and 1")
    module = F.concat("repo", F.lit("/"), tx.parent(F.col("path")))
    keys = files.select(F.concat("repo", F.lit("/"), "path").alias("file_key"), module.alias("module")).filter("file_key is not null").distinct()
    fit = (F.length("content") >= 100) & ~F.coalesce(F.col("symbol_type").isin("package", "import"), F.lit(False))
    texts = chunks.filter(fit).select(tx.fingerprint(F.col("content")).alias("fp"), module.alias("module")).filter("module is not null").distinct()
    hubs = texts.groupBy("fp").agg(F.min("module").alias("hub"), F.count("*").alias("n")).filter("n > 1").select("fp", "hub")
    edges = texts.join(hubs, "fp").select("module", "hub")
    roots = components(edges, "module", "hub").withColumnRenamed("vertex", "module")
    root = F.coalesce("root", "module")
    split = F.when(tx.hash_share(root) < fraction, "validation").otherwise("train")
    return keys.join(roots, "module", "left").select("file_key", split.alias("split"))


def leakage(rows: DataFrame, key: str, split: str) -> DataFrame:
    """(key, splits): keys found in more than one split."""
    return rows.groupBy(key).agg(F.count_distinct(split).alias("splits")).filter("splits > 1")


def _best(filled: Sequence[float], n: int, targets: Sequence[float], allowed: Iterable[int]) -> int:
    """The split that a group of size `n` brings nearest to its target; ties to the larger target, then the name."""
    return min(allowed, key=lambda i: ((filled[i] + n - targets[i]) ** 2 - (filled[i] - targets[i]) ** 2, -targets[i], i))


def fill(filled: Sequence[float], n: int, count: int, targets: Sequence[float]) -> list[float]:
    """The splits after `count` groups of size `n` each went to its best one.

    A group goes to the split that lacks most, so the splits are filled to one level: how many groups each takes until
    all lack about the same follows at once, and only the last few are placed one by one.
    """
    now, left = list(filled), count
    if n <= 0:
        return now
    lack = [t - f for t, f in zip(targets, now)]
    taking = list(range(len(now)))
    while count > 4 * len(now):
        level = (sum(lack[i] for i in taking) - count * n) / len(taking)
        if all(lack[i] > level for i in taking):
            for i in taking:
                # one less than may be: what rounding could give too much
                take = max(0, int((lack[i] - level) // n) - 1)
                now[i] += take * n
                left -= take
            break
        taking = [i for i in taking if lack[i] > level]
    for _ in range(left):
        now[_best(now, n, targets, range(len(now)))] += n
    return now


def greedy_split(groups: DataFrame, group: str, size: str, shares: Mapping[str, float] | None = None) -> DataFrame:
    """(group, split): each group, largest first, to the split where it brings the sizes nearest to their shares.

    Nearness is the squared distance; ties go to the larger share, then the name. The last groups go to empty splits
    where as many splits are empty. Null sizes count as 0. The order is by size and then by group, so groups of one size
    are told apart by their rank only, and how they fill the splits can be computed: the loop on the driver is over the
    distinct sizes, of which there are at most the square root of twice the total, and the groups themselves are ranked
    and placed in parallel.
    """
    shares = dict(shares or {"train": 0.8, "validation": 0.1, "test": 0.1})
    names = sorted(shares)
    ordered = cut(groups.select(F.col(group).alias("g"), F.coalesce(F.col(size).cast("long"), F.lit(0)).alias("n")), "sizes")
    sizes = sorted(((r["n"], r["count"]) for r in ordered.groupBy("n").count().collect()), reverse=True)
    total, count = sum(n * c for n, c in sizes), sum(c for _, c in sizes)
    if count < len(names):
        raise ValueError(f"{len(names)} splits need as many groups; there are {count}")
    targets = [total * shares[s] for s in names]
    # the last groups, where a split may still be empty, one by one; all before them by their sizes
    tail_at = count - len(names)
    filled, at, states, tail = [0.0] * len(names), 0, [], {}
    for n, c in sizes:
        states.append((n, at, filled))
        filled = fill(filled, n, max(0, min(c, tail_at - at)), targets)
        for place in range(max(at, tail_at), at + c):
            empty = [i for i, v in enumerate(filled) if v == 0]
            best = _best(filled, n, targets, empty if count - place <= len(empty) else range(len(names)))
            tail[place] = best
            filled = [v + n * (i == best) for i, v in enumerate(filled)]
        at += c
    begun = groups.sparkSession.createDataFrame(states, "n long, begun long, filled array<double>")

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for n, start, before, rank in zip(batch["n"], batch["begun"], batch["filled"], batch["rank"]):
                at = start + rank - 1
                out.append(names[tail[at] if at in tail else _best(fill(before, n, rank - 1, targets), n, targets, range(len(names)))])
            yield pd.DataFrame({group: batch["g"], "split": out})

    ship(groups.sparkSession)
    placed = ranked(ordered, ["n"], ["g"]).join(begun, "n").select("g", "n", "begun", "filled", "rank")
    return placed.mapInPandas(place, f"`{group}` {ordered.schema['g'].dataType.simpleString()}, split string")


def ratio_cap(rows: DataFrame, key: str, split: str, linked: str, least: float) -> DataFrame:
    """`rows` without those not `linked` that would bring the linked ones' share of a split below `least`.

    Of the others, the first by `key` stay: at most linked * (1 - least) / least of each split.
    """
    if not 0.5 <= least <= 1:
        raise ValueError("least must be from 0.5 to 1")
    per = rows.groupBy(split).agg(F.count_if(linked).alias("_linked"))
    allowed = F.floor(F.col("_linked") * (1 - least) / least + 1e-9)
    # ranked over all tasks: a split is most of the table
    generic = ranked(rows.filter(~F.col(linked)), [split], [key], "_n")
    named = per.select(F.col(split).alias("_split"), "_linked")
    kept = generic.join(named, F.col(split).eqNullSafe(F.col("_split"))).filter(F.col("_n") <= allowed)
    return rows.filter(F.col(linked)).unionByName(kept.select(rows.columns))
