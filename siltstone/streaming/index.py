"""The index: chunks, postings and vectors of a corpus, kept up to date by what changed."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions import screening
from siltstone.operators import chunking, golang, retrieval
from siltstone.operators.incremental import same_commit
from siltstone.runtime import Versions, create_file, cut, drop, read_file

#: What an index's contents hang on; another index version must be built anew.
VERSION = f"hashed-{retrieval.BUCKETS}/{chunking.VERSION}/{screening.VERSION}"
LOCK_SECONDS, LEASE_SECONDS = 10, 3600


def snapshot_diff(files: DataFrame, known: DataFrame) -> DataFrame:
    """(file_key, state): `added`, `changed`, `recommitted`, `unchanged` or `deleted`, of tables (file_key, hash, commit_hash)."""
    a = files.select("file_key", F.struct("hash", "commit_hash").alias("n"))
    b = known.select("file_key", F.struct("hash", "commit_hash").alias("o"))
    state = (
        F.when(F.col("o").isNull(), "added")
        .when(F.col("n").isNull(), "deleted")
        .when(~F.col("n.hash").eqNullSafe(F.col("o.hash")), "changed")
        .when(~same_commit(F.col("n.commit_hash"), F.col("o.commit_hash")), "recommitted")
        .otherwise("unchanged")
    )
    return a.join(b, "file_key", "full_outer").select("file_key", state.alias("state"))


#: Makes chunks (the key columns, symbol, symbol_type, start_line, end_line, content, facts) of files (key, content).
Parser = Callable[[DataFrame, list[str], str], DataFrame]

#: Parsers by language; what has none of its own is cut by sections.
PARSERS: dict[str, Parser] = {"go": golang.go_chunks}


def parse(files: DataFrame, on_error: str = "raise", parsers: dict[str, Parser] | None = None) -> DataFrame:
    """Chunks (id, file_key, repo, path, code_lang, symbol, symbol_type, start_line, end_line, commit_hash, content,
    facts) of files (repo, path, code_lang, commit_hash, content): by the parsers of their languages, all else by
    sections. `on_error` goes to the parser of Go."""
    key = ["repo", "path", "code_lang", "commit_hash"]
    known = PARSERS | (parsers or {})
    other = files.filter(~F.coalesce(F.col("code_lang").isin(*known), F.lit(False)))
    rows = chunking.sections(other.withColumn("kind", F.col("code_lang")), key, "content", "kind").withColumn("facts", F.lit(None).cast(golang.FACTS))
    for name, parser in known.items():
        own = files.filter(F.col("code_lang") == name)
        rows = rows.unionByName(parser(own, key, "content", on_error) if parser is golang.go_chunks else parser(own, key, "content"), allowMissingColumns=True)
    return rows.select(chunking.chunk_id("repo", "path", "start_line", "symbol").alias("id"), F.concat("repo", F.lit("/"), "path").alias("file_key"), *key, "symbol", "symbol_type", "start_line", "end_line", "content", "facts")


@dataclass(frozen=True)
class Update:
    """What an update did, in files and chunks."""

    changed: int
    unchanged: int
    deleted: int
    embedded: int


class IncompatibleIndex(RuntimeError):
    """The index was made by another version."""


class Index(Versions):
    """An index under `folder`, in versions that count whole or not at all.

    A writer holds the file LOCK in the folder, wherever it runs, and a second one waits for LOCK_SECONDS and fails. The
    lock spares work; what keeps versions whole is that only one writer can publish after a version. So a lock older
    than LEASE_SECONDS, of a writer that died, may be broken. Readers (`write=False`) need none, for a version never
    changes once it counts.
    """

    def __init__(self, spark: SparkSession, folder: str, write: bool = True, wait: float = LOCK_SECONDS, embedder: tuple[str, retrieval.Embedder] | None = None):
        """`embedder` is a function and the name that it goes by; an index is read with the one that it was made with."""
        super().__init__(spark, folder)
        self._embedder = embedder[1] if embedder else None
        self.made_by = VERSION if embedder is None else f"{embedder[0]}/{chunking.VERSION}/{screening.VERSION}"
        self._owner: str | None = None
        if write:
            self._lock(wait)
        now = self.current()
        if now and now["made_by"] != self.made_by:
            self.close()
            raise IncompatibleIndex(f"the index was made by {now['made_by']}, this is {self.made_by}")

    def _lock(self, wait: float) -> None:
        path, owner, until = f"{self.folder}/LOCK", uuid.uuid4().hex, time.time() + wait
        while not create_file(self.spark, path, json.dumps({"owner": owner, "since": time.time()})):
            held = self._held()
            if held and time.time() - held["since"] > LEASE_SECONDS:
                self._fs.delete(self._jpath(path), False)
            elif time.time() > until:
                raise RuntimeError("another writer holds the index")
            else:
                time.sleep(min(0.2, wait))
        self._owner = owner

    def _held(self) -> dict | None:
        try:
            held = read_file(self.spark, f"{self.folder}/LOCK")
        except Exception:  # noqa: BLE001 - it was given back meanwhile
            return None
        return json.loads(held) if held else None

    def close(self) -> None:
        """Give the lock back, if it is still held."""
        held = self._held() if self._owner else None
        if held and held["owner"] == self._owner:
            self._fs.delete(self._jpath(f"{self.folder}/LOCK"), False)
        self._owner = None

    def update(self, files: DataFrame, prune: bool = True) -> Update:
        """Take in files (repo, path, code_lang, content_hash, commit_hash, content).

        Only added and changed ones are parsed and embedded; of those with another commit only that is renewed; files
        that are no longer there go, unless `prune` is false. One unsafe file among those to be parsed stops the update,
        and nothing changes.
        """
        keyed = files.withColumn("file_key", F.concat("repo", F.lit("/"), "path"))
        state = keyed.select("file_key", F.col("content_hash").alias("hash"), "commit_hash")
        if self._owner is None:
            raise RuntimeError("the index was opened to read")
        now = self.current()
        known = self.read("files") if now else state.limit(0)
        diff = cut(snapshot_diff(state, known), "diff")
        counts = {r["state"]: r["n"] for r in diff.groupBy("state").agg(F.count("*").alias("n")).collect()}
        parse_keys = diff.filter("state in ('added', 'changed')").select("file_key")
        todo = keyed.join(parse_keys, "file_key", "left_semi")
        if todo.filter(~screening.safe(F.col("content"))).limit(1).count():
            raise ValueError("a file is unsafe; nothing was indexed")
        made = cut(parse(todo), "chunks")
        fresh = retrieval.corpus_tables(made, self._embedder)
        if now:
            gone = diff.filter("state = 'changed'" + (" or state = 'deleted'" if prune else "")).select("file_key")
            old = self.read("chunks")
            kept = old.join(gone, "file_key", "left_anti")
            lost = old.join(gone, "file_key", "left_semi").select("id")
            renewed = keyed.join(diff.filter("state = 'recommitted'"), "file_key", "left_semi").select("file_key", F.col("commit_hash").alias("_new"))
            kept = kept.join(renewed, "file_key", "left").withColumn("commit_hash", F.coalesce("_new", "commit_hash")).select(made.columns)
            rest = known.join(diff.filter("state = 'deleted'"), "file_key", "left_semi") if not prune else known.limit(0)
            parts = {"files": state.unionByName(rest.select("file_key", "hash", "commit_hash")), "chunks": kept.unionByName(made)}
            # what is searched goes by chunk: of unchanged files nothing is made anew
            parts |= {name: self.read(name).join(lost, "id", "left_anti").unionByName(df) for name, df in fresh.items()}
        else:
            parts = {"files": state, "chunks": made, **fresh}
        # a search for few terms or of one symbol reads few row groups
        parts["postings"] = parts["postings"].repartitionByRange("term").sortWithinPartitions("term")
        parts["chunks"] = parts["chunks"].repartitionByRange("file_key").sortWithinPartitions("file_key")
        self.publish(now, parts, {"made_by": self.made_by})
        embedded = made.count()
        drop(diff, made, *fresh.values())
        return Update(counts.get("added", 0) + counts.get("changed", 0), counts.get("unchanged", 0) + counts.get("recommitted", 0), counts.get("deleted", 0) if prune else 0, embedded)

    def search(self, queries: DataFrame, k: int = 5, mode: str = "hybrid") -> DataFrame:
        """The best `k` chunks of each query, from what is kept; see `retrieval.search_tables`."""
        return retrieval.search_tables({name: self.read(name) for name in ("documents", "postings", "vectors")}, queries, k, mode, self._embedder)

    def find_symbol(self, symbol: str) -> DataFrame:
        return retrieval.find_symbol(self.read("chunks"), symbol)


def follow(spark: SparkSession, index: Index, incoming: str, schema: str, checkpoint: str):
    """A stream that takes in files as they arrive under `incoming`, a batch at a time; each batch once.

    A batch that is replayed after a failure finds its files unchanged, so it adds nothing.
    """
    def take(batch: DataFrame, _: int) -> None:
        index.update(batch, prune=False)

    return spark.readStream.schema(schema).parquet(incoming).writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
