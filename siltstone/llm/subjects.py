"""Subject areas of documents (problem 9).

A document has a subject when at least a share of its sentences are about it. So sentences are classified: a sentence
is the average of learned vectors of its words and of the pieces of its words, with an independent logistic output for
each subject. The labels are of whole documents, though, some wrong, and name a subject that most but not all sentences
are about. So the model is trained twice: first each sentence of a labelled document has the document's subjects; then
each has those that the first model finds it to be about, none, one or several, and labels that most sentences
contradict die out. Every output is judged by itself, against its own threshold: a sentence may be about two subjects.

Training sentences lie in partitions. In each round every partition computes the gradient over its sentences, the
gradients are added up, and one step is taken for all. A gradient has the size of the model, whatever the data's size.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.runtime import cut, drop, ship

#: Vectors for words, as many for pieces of words, and their length.
BUCKETS, WIDTH = 1 << 14, 16
#: Letters of a piece of a word.
PIECE = 4
#: Rounds of each of the two trainings, and the step.
ROUNDS, STEP = 25, 0.1
#: Labelled documents to train on at most (those whose ids hash lowest), and partitions that compute gradients.
LABELLED, PARTITIONS = 4000, 8
#: How far from the usual towards certainty the likelihood of a subject must be for a sentence to teach it.
CLEARLY = 0.25
#: A sentence teaches a second subject if that is at least this part as likely as the first.
BESIDE = 0.95
#: A sentence is about every subject that is at least so likely.
SURE = 0.5
#: Subjects that a model may have: each is an output, and the names are held by the driver.
MOST_SUBJECTS = 1000
#: Pieces that a worker remembers before it forgets all of them.
KNOWN_WORDS = 200_000

_FENCE = re.compile(r"(?:^|\n)[ \t]*(```|~~~).*?(?:\n[ \t]*\1|\Z)", re.S)
_MARK = re.compile(r"^\s*(?:[-*+•>]+|\d+[.)])\s+")
_LINES = re.compile("[\r\n\x85\u2028\u2029]+")
_END = re.compile(r"(?<=[.!])[\"”»)]?\s+")
# one scan over a sentence: code, links, names of tickets, words, and the rest of what is written like words
_PIECES = re.compile(r"`[^`\n]*`|https?://\S+|www\.\S+|[A-Z]{2,}-\d+|\w+(?:['’][^\W\d_]+)?")
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")
_CAMEL = re.compile(r"[a-zß-ÿ][A-Z]")


def is_word(piece: str) -> bool:
    """Whether a piece of a sentence is a word: no code, link, number or identifier."""
    return _WORD.fullmatch(piece) is not None and _CAMEL.search(piece) is None


def sentences(text: str) -> Iterator[list[str]]:
    """The pieces of each sentence of `text`, without headings, tables and code blocks.

    A question and what follows it in the line are one sentence.
    """
    if "```" in text or "~~~" in text:
        text = _FENCE.sub("\n", text)
    for line in _LINES.split(text):
        if line.lstrip().startswith(("#", "|")) or line.startswith(("\t", "    ")):
            continue
        for part in _END.split(_MARK.sub("", line)):
            if part:
                yield _PIECES.findall(part)


def sentence_words(text: str) -> list[list[str]]:
    """The words of each sentence of `text`; what has fewer than three words is none."""
    found = ([p.lower() for p in pieces if is_word(p)] for pieces in sentences(text))
    return [words for words in found if len(words) >= 3]


def features(word: str) -> list[int]:
    """The vectors of a word: its own, and those of its pieces."""
    own = [zlib.crc32(word.encode()) % BUCKETS]
    if len(word) < PIECE:
        return own
    edged = f"<{word}>"
    return own + [BUCKETS + zlib.crc32(edged[i : i + PIECE].encode()) % BUCKETS for i in range(len(edged) - PIECE + 1)]


@dataclass
class Model:
    """Vectors [2 * BUCKETS, WIDTH], outputs [subjects, WIDTH] and their biases."""

    vectors: np.ndarray
    outputs: np.ndarray
    bias: np.ndarray

    @classmethod
    def new(cls, subjects: int, seed: int) -> Model:
        draw = np.random.default_rng(seed)
        made = lambda *shape: draw.normal(0, 1, shape).astype(np.float32)
        return cls(made(2 * BUCKETS, WIDTH) / WIDTH, made(subjects, WIDTH) / 4, np.full(subjects, -2, np.float32))

    def flat(self) -> np.ndarray:
        return np.concatenate([self.vectors.ravel(), self.outputs.ravel(), self.bias])

    @classmethod
    def from_flat(cls, flat: np.ndarray, subjects: int) -> Model:
        a, b = 2 * BUCKETS * WIDTH, subjects * WIDTH
        return cls(flat[:a].reshape(-1, WIDTH), flat[a : a + b].reshape(-1, WIDTH), flat[a + b :])

    def save(self, path: str) -> None:
        """Keep the model in one file, for `load`."""
        np.savez(path, vectors=self.vectors, outputs=self.outputs, bias=self.bias)

    @classmethod
    def load(cls, path: str) -> Model:
        with np.load(path) as kept:
            return cls(kept["vectors"], kept["outputs"], kept["bias"])

    def likely(self, hidden: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(hidden @ self.outputs.T + self.bias)))


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """(sizes, values) of a column of lists."""
    return np.diff(column.offsets.to_numpy()), column.flatten().to_numpy().astype(np.int64)


def _hidden(model: Model, sizes: np.ndarray, ids: np.ndarray) -> np.ndarray:
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    return np.add.reduceat(model.vectors[ids], starts, axis=0) / sizes[:, None].astype(np.float32)


def _gradient(model: Model, sizes: np.ndarray, ids: np.ndarray, wanted: np.ndarray, weight: np.ndarray) -> np.ndarray:
    hidden = _hidden(model, sizes, ids)
    off = (model.likely(hidden) - wanted) * weight[:, None]
    back = (off @ model.outputs) / sizes[:, None]
    order = np.argsort(ids, kind="stable")
    seen, starts = np.unique(ids[order], return_index=True)
    vectors = np.zeros_like(model.vectors)
    vectors[seen] = np.add.reduceat(back[np.repeat(np.arange(len(sizes)), sizes)[order]], starts, axis=0)
    return np.concatenate([vectors.ravel(), (off.T @ hidden).ravel(), off.sum(0)]).astype(np.float32)


def _matrix(column: pa.ListArray, subjects: int) -> np.ndarray:
    """[rows, subjects]: 1 where a row's list has the subject."""
    sizes, values = _flat(column)
    out = np.zeros((len(sizes), subjects), np.float32)
    out[np.repeat(np.arange(len(sizes)), sizes), values] = 1.0
    return out


def _fit(sentences: DataFrame, subjects: int, seed: int) -> Model:
    """A model trained on rows (features, subjects: numbers, weight): one Spark job a round."""
    spark = sentences.sparkSession
    flat = Model.new(subjects, seed).flat()
    first, second = np.zeros_like(flat), np.zeros_like(flat)
    total = float(sentences.agg(F.sum("weight").alias("w")).first()["w"])
    for turn in range(1, ROUNDS + 1):
        sent = spark.sparkContext.broadcast(flat)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = Model.from_flat(sent.value, subjects)
            sum_ = None
            for batch in batches:
                if batch.num_rows:
                    sizes, ids = _flat(batch.column("features"))
                    part = _gradient(model, sizes, ids, _matrix(batch.column("subjects"), subjects), batch.column("weight").to_numpy().astype(np.float32))
                    sum_ = part if sum_ is None else sum_ + part
            if sum_ is not None:
                yield pa.RecordBatch.from_pydict({"g": [sum_.tobytes()]})

        # one gradient a partition, each of the model's size
        gradient = np.sum([np.frombuffer(r["g"], np.float32) for r in sentences.mapInArrow(run, "g binary").collect()], axis=0) / total
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        flat = (flat - STEP * (first / (1 - 0.9**turn)) / (np.sqrt(second / (1 - 0.99**turn)) + 1e-6)).astype(np.float32)
        sent.destroy()
    return Model.from_flat(flat, subjects)


def train(documents: DataFrame, labels: DataFrame, names: list[str], key: str = "doc_id", text: str = "text", seed: int = 1, labelled: int = LABELLED) -> Model | None:
    """A model of the subjects `names` from labels (key, subject) of some documents; None without any usable label.

    The labels of a document are those that anyone gave it; repeated ones count once, null or unknown subjects and
    labels of unknown, null or empty documents not at all. At most `labelled` documents are used: those whose keys hash
    lowest. They are chosen by key; only their texts are moved.
    """
    spark = documents.sparkSession
    ship(spark)
    numbers = F.create_map(*[x for i, n in enumerate(names) for x in (F.lit(n), F.lit(i))])
    given = labels.select(F.col(key).alias("key"), F.try_element_at(numbers, F.col("subject")).alias("s")).filter("key is not null and s is not null").groupBy("key").agg(F.sort_array(F.collect_set("s")).alias("subjects"))
    texts = documents.select(F.col(key).alias("key"), F.col(text).alias("text")).filter(F.length(F.trim("text")) > 0)
    usable = given.join(texts.select("key").distinct(), "key", "left_semi")
    first = cut(usable.orderBy(F.xxhash64(F.lit(seed), "key"), "key").limit(labelled), "labelled")
    chosen = texts.join(first, "key")

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text_, subjects in zip(batch["text"], batch["subjects"]):
                found = sentence_words(text_)
                rows += [([f for w in words for f in features(w)], subjects, 1 / len(found) ** 0.5) for words in found]
            yield pd.DataFrame(rows, columns=["features", "subjects", "weight"])

    schema = "features array<int>, subjects array<int>, weight float"
    sentences = cut(chosen.repartition(PARTITIONS, "key").mapInPandas(split, schema), "sentences")
    if sentences.isEmpty():
        return None
    count = len(names)
    before = _fit(sentences, count, seed)
    # a sentence about nothing is as likely of a subject as any: only what is clearly likelier counts
    given_to = sentences.select(F.explode_outer("subjects").alias("s"), "weight").groupBy("s").agg(F.sum("weight").alias("w")).filter("s is not null").collect()
    total = sentences.agg(F.sum("weight").alias("w")).first()["w"]
    usual = np.zeros(count)
    for r in given_to:
        usual[r["s"]] = r["w"] / total
    clear = usual + CLEARLY * (1 - usual)

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            likely = before.likely(_hidden(before, *_flat(batch.column("features"))))
            # a subject that the document was not given needs stronger signs
            likely *= np.where(_matrix(batch.column("subjects"), count) > 0, 1.0, 0.6)
            # two subjects teach by one sentence where the signs are about as strong for both
            row, about = np.nonzero((likely > clear) & (likely >= BESIDE * likely.max(1, keepdims=True)))
            starts = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
            told = pa.ListArray.from_arrays(pa.array(starts), pa.array(about.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("features"), told, batch.column("weight")], names=["features", "subjects", "weight"])

    retold = cut(sentences.mapInArrow(tell, schema), "sentences")
    after = _fit(retold, count, seed)
    drop(sentences, retold, first)
    return after


def subject_shares(documents: DataFrame, model: Model, names: list[str], key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, subject, share, sentences): for each document, what share of its sentences are about which subjects.

    Only subjects of at least one sentence come out, so a null, empty or blank text, or one without sentences, has no
    rows. Very long texts are scored whole. Rows are scored each for itself: a repeated row repeats its result.
    """
    ship(documents.sparkSession)
    spark = documents.sparkSession
    sent = spark.sparkContext.broadcast(model.flat())
    schema = T.StructType([T.StructField(key, documents.schema[key].dataType), T.StructField("subject", T.StringType()), T.StructField("share", T.DoubleType()), T.StructField("sentences", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = Model.from_flat(sent.value, len(names))
        known: dict[str, int] = {}
        sums, sizes = np.zeros((1 << 10, WIDTH), np.float32), np.zeros(1 << 10, np.float32)

        def add(piece: str) -> int:
            """The row of a word's summed vectors in `sums`; 0 for what is no word."""
            nonlocal sums, sizes
            if not is_word(piece):
                known[piece] = 0
                return 0
            ids = features(piece.lower())
            n = len(known) + 1
            if n >= len(sums):
                sums, sizes = (np.concatenate([x, np.zeros_like(x)]) for x in (sums, sizes))
            sums[n], sizes[n] = one.vectors[ids].sum(0), len(ids)
            known[piece] = n
            return n

        for batch in batches:
            if len(known) > KNOWN_WORDS:
                known.clear()
            rows: list[int] = []
            counts: list[int] = []
            owners: list[int] = []
            for i, t in enumerate(batch.column(1).to_pylist()):
                for pieces in sentences(t):
                    words = [n for p in pieces if (n := known[p] if p in known else add(p))]
                    if len(words) >= 3:
                        rows += words
                        counts.append(len(words))
                        owners.append(i)
            if not counts:
                continue
            starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
            at = np.array(rows)
            hidden = np.add.reduceat(sums[at], starts, axis=0) / np.add.reduceat(sizes[at], starts)[:, None]
            about = np.zeros((batch.num_rows, len(names)), np.int64)
            sentence, subject = np.nonzero(one.likely(hidden) >= SURE)
            owner = np.array(owners)
            np.add.at(about, (owner[sentence], subject), 1)
            total = np.bincount(owner, minlength=batch.num_rows)
            doc, s = np.nonzero(about)
            told = [batch.column(0).take(pa.array(doc)), pa.array([names[i] for i in s]), pa.array(about[doc, s] / total[doc]), pa.array(total[doc].astype(np.int32))]
            yield pa.RecordBatch.from_arrays(told, names=schema.names)

    return documents.select(key, text).filter(F.length(F.trim(text)) > 0).mapInArrow(run, schema)


def document_subjects(documents: DataFrame, labels: DataFrame, subjects: DataFrame, least: float = 0.2, model: Model | None = None) -> DataFrame:
    """(doc_id, subject, share) of the subjects that at least `least` of a document's sentences are about.

    `model` is one that was trained on the same subjects before; without it one is trained.
    """
    rows = subjects.select("subject").filter("subject is not null").distinct().orderBy("subject").limit(MOST_SUBJECTS + 1).collect()
    names = [r["subject"] for r in rows]
    if len(names) > MOST_SUBJECTS:
        raise ValueError(f"more than {MOST_SUBJECTS} subjects")
    if model is None and names:
        model = train(documents, labels, names)
    if model is None:
        return documents.select("doc_id", F.lit("").alias("subject"), F.lit(0.0).alias("share")).limit(0)
    return subject_shares(documents, model, names).filter(F.col("share") >= least - 1e-9).select("doc_id", "subject", "share")
