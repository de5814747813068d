import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from dealspark.llm import hashing, quality_classifier as Q, toxicity as T
from dealspark.llm.common import table

from .helpers import doc, documents, empty, hard_documents

SF = "/root/testdata/sf0.01"


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 3 == 1


def auc(score, label):
    pos, neg = score[label == 1], score[label == 0]
    return np.mean(pos[:, None] > neg) + 0.5 * np.mean(pos[:, None] == neg)


def test_features_follow_words_and_their_grams():
    a, b = Q.features("one two"), Q.features("two\tone")
    assert sorted(a) == sorted(b)  # order of words does not matter, kind of space neither
    # words, then n-grams of " one " and " two ": 3 + 2 + 1 each
    assert len(a) == 2 + 2 * 6
    assert list(Q.features("x x x")).count(Q.SAME) == 2
    assert list(Q.features("a b c d a b c")).count(Q.AGAIN) == 1
    assert len(Q.features("")) == len(Q.features(" \n")) == 0


def test_word_hashes_depend_on_the_word_alone():
    c = hashing.points_of("alpha b alpha  𝒳 b")
    h = hashing.word_hashes(c, *hashing.word_bounds(c))
    assert len(h) == 5 and h[0] == h[2] and h[1] == h[4] and len(set(h.tolist())) == 3


def test_long_texts_are_read_in_blocks(monkeypatch):
    monkeypatch.setattr(hashing, "BLOCK", 50)
    text = "some words and more " * 40 + "z" * 200
    parts = list(hashing.blocks_of(text))
    assert "".join(parts) == text and max(map(len, parts)) <= 50


def test_quality_on_held_out_documents(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    got = Q.classify(docs, labels).join(labels, "doc_id").toPandas()
    assert (got["held_out"] == got["doc_id"].map(held)).all()
    out = got[got["held_out"]]
    assert auc(out["score"].to_numpy(), out["quality"].to_numpy()) > 0.97
    assert (out["predicted"] == out["quality"]).mean() > 0.93
    assert ((out["score"] >= 0.5) == (out["predicted"] == 1)).all()


def test_held_out_labels_are_never_learned_from(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    turned = labels.withColumn("quality", F.when(Q.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted(map(tuple, Q.classify(docs, x).collect())) for x in (labels, turned))
    assert a == b


def test_toxicity_on_held_out_documents(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    got = T.classify(docs, labels).join(labels.withColumnRenamed("toxic", "mark"), "doc_id").toPandas()
    out = got[got["held_out"]]
    assert auc(out["score"].to_numpy(), out["mark"].to_numpy()) > 0.9  # 30 toxic documents to learn from
    assert (out["toxic"] == (out["mark"] == 1)).mean() > 0.9


def test_sample_is_bounded_where_ids_repeat(spark):
    docs = documents(spark, [doc(i % 3, f"text {i}") for i in range(300)] + [doc(10, "alone")])
    labels = spark.createDataFrame([(0, 0), (1, 1), (1, 0), (2, 1), (10, 1)], "doc_id long, quality int")  # 2 is held out
    got = [(r["label"], r["text"]) for r in Q.sample(docs, labels, "quality", {0: 5, 1: 7}).collect()]
    assert [sum(y == k for y, _ in got) for k in (0, 1)] == [5, 7]
    again = [(r["label"], r["text"]) for r in Q.sample(docs.repartition(5), labels, "quality", {0: 5, 1: 7}).collect()]
    assert sorted(got) == sorted(again)


def test_copies_lie_in_one_fold(monkeypatch):
    """No link that gives a text's probability out of fold was fitted on a copy of the text."""
    fitted, told = [], []

    class Spy:
        def __init__(self, seen):
            self.seen = seen

        def probability(self, bag, earlier):
            told.append(bag.tobytes() not in self.seen)
            return 0.5

    def spy(bags, earlier, y, seed):
        fitted.append(Spy({b.tobytes() for b in bags}))
        return fitted[-1]

    monkeypatch.setattr(T, "fit_link", spy)
    T.fit([(i % 2, i % 2, T.features(f"word{i % 10} and more")) for i in range(60)])
    assert told and all(told)


def test_chain_uses_earlier_links():
    rng = np.random.default_rng(0)
    rows = []
    for i in range(400):
        seed = ["idiot", "pathetic", "scum", ""][i % 4]
        text = " ".join([*(f"w{rng.integers(50)}" for _ in range(20)), seed])
        rows.append((int(bool(seed)), T.categories(text), T.features(text)))
    chain = T.fit(rows)
    assert [len(link.before) for link in chain.links] == [0, 1, 2, 3]
    p = chain.probabilities("w1 w2 idiot w3")
    assert p[0] > 0.5 and p[3] > 0.5 > max(p[1], p[2])
    assert max(chain.probabilities("w1 w2 w3")) < 0.5
    assert chain.links[3].before.max() > 0  # the last link listens to the others


def test_categories_are_whole_words():
    assert T.categories("You IDIOT, pathetic!") == 0b011
    assert T.categories("idiots are clownish") == 0 == T.categories(None)


@pytest.mark.parametrize("module", [Q, T])
def test_hard_rows_and_empty_tables(spark, module):
    docs = documents(spark)
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(40)] + [(None, 1, 1), (1, None, None), (2, 7, 7), (3, 0, 0), (3, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    got = module.classify(docs, labels).collect()
    assert len(got) == len(hard_documents())
    assert all(0 <= r["score"] <= 1 for r in got)
    none = {r["score"] for r in got if r["doc_id"] in (100, 101, 102)}
    assert len(none) == 1
    assert module.classify(empty(spark), labels).count() == 0
    alone = module.classify(docs, labels.where("false")).select("score").distinct().collect()
    assert [r["score"] for r in alone] == [0.5 if module is Q else 0.0]
