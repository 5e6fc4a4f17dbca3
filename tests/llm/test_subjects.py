"""Subjects: held-out accuracy on made-up documents, and odd rows."""

import random

from pyspark.sql import functions as F

from siltstone.llm import subjects

TERMS = {
    "music": "violin orchestra melody chorus rhythm concert sonata tenor".split(),
    "cooking": "recipe oven flour butter simmer spice pastry broth".split(),
    "sailing": "harbour mast rudder anchor sails tide keel voyage".split(),
}


def sentence(draw, subject):
    a, b = draw.sample(TERMS[subject], 2)
    return draw.choice([f"The {a} comes before the {b} in every case.", f"Without a {a} nobody would look for the {b}.", f"We spoke about {a} and {b} for {draw.randrange(99)} days."])


def documents(n, seed):
    draw = random.Random(seed)
    rows, truth = [], {}
    names = list(TERMS)
    for i in range(n):
        main = draw.sample(names, draw.choice([1, 1, 2]))
        said = [sentence(draw, s) for s in main for _ in range(5)] + [draw.choice(["Nothing else was changed on that day.", "More of this follows in another chapter."]) for _ in range(2)]
        if draw.random() < 0.5:
            said.append(sentence(draw, draw.choice(names)))  # in passing
        draw.shuffle(said)
        rows.append((i, draw.choice([" ", "\n"]).join(said)))
        truth[i] = set(main)
    return rows, truth


def test_held_out_documents(spark):
    rows, truth = documents(420, 1)
    draw = random.Random(2)
    labels = [(i, s, None) for i in range(300) for s in truth[i]]
    labels += [(i, draw.choice(list(TERMS)), "crowd") for i in range(0, 300, 12)]  # some are wrong
    labels += labels[:20] + [(1, None, "x"), (None, "music", "x"), (5, "unknown", "x"), (999, "music", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("subject", F.lit("clash")).withColumn("key", F.lit(0))
    marks = spark.createDataFrame(labels, "doc_id long, subject string, labeller string")
    names = spark.createDataFrame([(s, "scope") for s in TERMS] + [(None, None)], "subject string, scope string")
    got = {}
    for r in subjects.document_subjects(docs, marks, names).collect():
        got.setdefault(r["doc_id"], set()).add(r["subject"])
    held = range(300, 420)
    hits = sum(len(got.get(i, set()) & truth[i]) for i in held)
    assert hits >= 0.95 * sum(len(truth[i]) for i in held)
    assert hits >= 0.95 * sum(len(got.get(i, set())) for i in held)


def test_odd_rows(spark):
    model = subjects.Model.new(2, 1)
    model.bias[:] = [5, -5]
    rows = [(1, None), (2, ""), (3, " \n "), (4, "two words."), (5, "One sentence that is long enough here."), (5, "One sentence that is long enough here."), (None, "And another sentence for no key."), (6, "Some more words in it. " * 20000), (7, "```\ncode stands here only now\n```\n# A heading of four words\n| a table row here |")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r["doc_id"], r["subject"], r["share"], r["sentences"]) for r in subjects.subject_shares(df, model, ["a", "b"]).collect()]
    assert sorted(got, key=str) == sorted([(5, "a", 1.0, 1)] * 2 + [(None, "a", 1.0, 1), (6, "a", 1.0, 20000)], key=str)


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "Some words to read here.")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, subject string, labeller string")
    names = spark.createDataFrame([("a", "x")], "subject string, scope string")
    assert subjects.document_subjects(docs, labels, names).count() == 0
    assert subjects.document_subjects(docs, labels, names.limit(0)).count() == 0


def test_sentences():
    text = "- First item has some words. Why is it so? Because of that.\n\n`x.Y(z)`\nsee https://a.example/b c d e!\n"
    assert subjects.sentence_words(text) == [["first", "item", "has", "some", "words"], ["why", "is", "it", "so", "because", "of", "that"], ["see", "c", "d", "e"]]
