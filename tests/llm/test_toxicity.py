from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from toneflow.llm import queries, toxicity

from .conftest import ODD

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    docs, labels = queries.read(spark, FOLDER, "documents"), queries.read(spark, FOLDER, "labels")
    return toxicity.learn(docs, labels.filter(F.crc32(F.col("doc_id").cast("string")) % 5 != 0))


def test_held_out_accuracy(spark):
    found = queries.op1_toxicity(spark, FOLDER).join(queries.read(spark, FOLDER, "labels"), "doc_id").toPandas()
    assert found["score"].between(0, 1).all() and (found["predicted"] == (found["score"] >= 0.5)).all()
    rest = found[found["held_out"]]
    assert (rest["predicted"] == rest["toxic"]).mean() >= 0.93
    pos, neg = rest.loc[rest["toxic"] == 1, "score"].to_numpy(), rest.loc[rest["toxic"] == 0, "score"].to_numpy()
    assert (pos[:, None] > neg[None, :]).mean() >= 0.93


@pytest.mark.parametrize("disguised, word", [
    ("1d10t", "idiot"), ("p@th3t1c", "pathetic"), ("m0r0n", "moron"), ("l0ser", "loser"), ("worth1ess", "worthless"), ("cl0wn", "clown"),
    ("tr@sh", "trash"), ("di$gu$ting", "disgusting"), ("5tup1d", "stupid"), ("idiooooot", "idiot"), ("LOOOOSER!!", "loser"),
    ("m.o.r.o.n", "moron"), ("s-c-u-m", "scum"), ("ordinary", "ordinary"), ("Été,", "été"), ("3", "3")])
def test_restored_words(model, disguised, word):
    assert toxicity.reading(disguised, model.costs, model.weights) == word


@pytest.mark.parametrize("text, word", [
    ("you are a m o r o n now", "moron"), ("y o u i d i o t", "idiot"), ("$ t u p i d", "stupid"), ("such a m  o  r  o  n", "moron"),
    ("m\u00a0o\u00a0r\u00a0o\u00a0n", "moron"), ("st upid people", "stupid"), ("that is a (m o r o n!)", "moron"), ("i d 1 o t", "idiot"),
    ("m\no\nr\no\nn", "moron"), ("I D I O O O O T", "idiot"), ("pat het ic.", "pathetic")])
def test_words_with_blanks_inside(model, text, word):
    assert word in toxicity.Reader(model.costs, model.weights).words(text)


@pytest.mark.parametrize("text", ["plan a b c of the list", "1 2 3 4 5", "x = a + b", "- - -", "", "a b", "I a m"])
def test_single_signs_that_mean_no_harm(model, text):
    reader = toxicity.Reader(model.costs, model.weights)
    assert all(reader.weight(w) < 2 for w in reader.words(text))


def test_decoding_finds_the_cheapest_way_with_blanks(model):
    """Against all ways through the lattice, with the gain of known words."""
    from itertools import product

    known = {"moron", "idiot", "you"}
    begins = {w[:n] for w in known for n in range(1, len(w) + 1)}

    def cost(text):
        a = b = 0
        total = 0.0
        for c in text + " ":
            z = toxicity.code(c)
            total += model.costs[a, b, z]
            a, b = b, z
        return total - toxicity.GAIN * sum(w in known for w in text.split())

    for signs in ("a m o r o n", "y o u 1 d i o t", "i i i d i o t", "a b b a", "é t é s"):
        ways = toxicity.spaced(signs.split())
        every = {}
        for p in product(*ways):
            text = "".join(x for x, _ in p)
            every[text] = min(every.get(text, np.inf), cost(text) + sum(e for _, e in p))
        assert every[" ".join(toxicity.decode(ways, model.costs, known, begins))] == pytest.approx(min(every.values()))


def test_counting_and_decoding_agree_on_classes():
    table = toxicity.codes_table()
    for c in "azAZéß漢あ한𠀀 .1_":
        assert table[min(ord(c), toxicity.LAST_LETTER)] == toxicity.code(c.lower())


def test_viterbi_finds_the_cheapest_reading(model):
    """Against all readings of the lattice."""
    from itertools import product

    def cost(text):
        a = b = 0
        total = 0.0
        for c in text + " ":
            z = toxicity.code(c)
            total += model.costs[a, b, z]
            a, b = b, z
        return total

    for word in ("1d10t", "w0rth1e55", "aaab", "a.b-c", "7|l1"):
        ways = toxicity.lattice(word)
        best = min(cost("".join(x for x, _ in p)) + sum(e for _, e in p) for p in product(*ways))
        found = toxicity.restore(word, model.costs, 5)
        assert found[0][0] == pytest.approx(best)
        every = sorted(cost("".join(x for x, _ in p)) + sum(e for _, e in p) for p in product(*ways))
        assert [c for c, _ in found] == pytest.approx(every[:5][:len(found)])


def test_disguises_score_like_the_word(spark, model, documents):
    base = [r["text"] for r in queries.read(spark, FOLDER, "documents").join(
        queries.read(spark, FOLDER, "labels").filter("toxic = 0 AND quality = 1"), "doc_id").filter("lang = 'en' AND n_chars < 1500").orderBy(
        "doc_id").limit(20).select("text").collect()]
    forms = ["idiot moron scum", "1d1ot m0r0n 5cum", "i d i o t and m o r o n and s c u m", "idiooot moronnnn scuuum", "i.d.i.o.t mo-ron s_c_u_m"]
    rows = [(i, t) for i, t in enumerate(base)] + [(100 * (k + 1) + i, f"{t} {f} {t[:50]}") for k, f in enumerate(forms) for i, t in enumerate(base)]
    found = {r["doc_id"]: r["s"] for r in documents(rows).select("doc_id", toxicity.scorer(model)(F.col("text")).alias("s")).collect()}
    assert np.mean([found[i] >= 0.5 for i in range(len(base))]) <= 0.1
    for k in range(len(forms)):
        assert np.mean([found[100 * (k + 1) + i] >= 0.5 for i in range(len(base))]) >= 0.8, forms[k]


def test_odd_rows(spark, documents):
    labels = spark.createDataFrame([(1, 1), (5, 1), (8, 0), (9, None), (77, 1), (None, 1), (2, 0), (3, 7)], "doc_id long, toxic int")
    got = toxicity.score(documents(ODD, clash=True), labels).collect()
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.score(documents([]), labels).count() == 0
    none = toxicity.score(documents(ODD), labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5}
