import random
import zlib

import numpy as np
import pytest
from cases import clashing

from cairnlake.llm import language_id as op

LETTERS = {"aa": "abcdeé", "bb": "fghijö", "cc": "klmnoñ"}
SCHEMA = "doc_id long, text string, lang string"


def text(lang, seed, words=40):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(LETTERS[lang]) for _ in range(rng.randint(2, 8))) for _ in range(words))


@pytest.fixture(scope="module")
def rows():
    made = [(i, text(lang, i), lang) for i, lang in enumerate(random.Random(3).choices(list(LETTERS), k=240))]
    return made + [(900, text("aa", 1, 5000), None), (901, None, "aa"), (902, "", "bb"), (903, "123 -- 4", "cc"), (904, "é", None), (None, text("bb", 2), "bb")]


@pytest.fixture(scope="module")
def net(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return op.trained(df.where(~op.held_out()))


def test_held_out_accuracy(spark, rows, net):
    df = clashing(spark.createDataFrame(rows, SCHEMA).withColumn("held_out", op.held_out()).repartition(3))
    got = op.predicted_languages(df, net)
    assert got.columns == [*df.columns, "lang_pred", "score"]
    found = {r.doc_id: r for r in got.collect()}
    assert len(found) == len(rows)
    judged = [(found[i].lang_pred, lang) for i, t, lang in rows if i is not None and found[i].held_out and lang and t and i < 900]
    assert len(judged) > 40
    assert sum(a == b for a, b in judged) >= 0.97 * len(judged)
    for i in (901, 902, 903):
        assert (found[i].lang_pred, found[i].score) == ("und", 0.0)
    assert found[900].lang_pred == "aa" and found[904].lang_pred in LETTERS
    assert all(0 <= r.score <= 1 for r in found.values())
    assert {i for i, r in found.items() if r.held_out} == {i for i in found if zlib.crc32(str("" if i is None else i).encode()) % 4 == 2}


def test_whole_texts_count(spark, net):
    """A long text is judged by all of it, not by how it begins."""
    t = text("aa", 5, 30) + " " + text("cc", 6, 900)
    got = op.predicted_languages(spark.createDataFrame([(1, t, None)], SCHEMA), net).first()
    assert got.lang_pred == "cc"


def test_scores_do_not_depend_on_the_batch(net):
    import pyarrow as pa

    texts = [text("aa", 1, 300), "", text("bb", 2, 3), None, text("cc", 3, 2000)]
    together = op.text_scores(pa.array(texts), net.fused())
    for t, s in zip(texts, together):
        assert np.allclose(op.text_scores(pa.array([t], pa.string()), net.fused())[0], s, atol=1e-5)


def test_without_rows(spark, net):
    none = spark.createDataFrame([], SCHEMA)
    assert op.trained(none) is None
    assert op.predicted_languages(none, net).collect() == []
    got = op.predicted_languages(spark.createDataFrame([(1, "x", None)], SCHEMA), None).first()
    assert (got.lang_pred, got.score) == ("und", 0.0)


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    net = op.ByteNet(["a", "b", "c"])
    x, y = rng.integers(0, 256, (4, op.WINDOW)).astype(np.uint8), np.array([0, 1, 2, 1])

    def loss():
        h = []
        e = net.p["embed"][x]
        for w in op.WIDTHS:
            span = op.WINDOW - w + 1
            h.append((sum(e[:, j : j + span] @ net.p[f"filter{w}"][j] for j in range(w)) + net.p[f"bias{w}"]).max(1))
        s = op._softmax(np.maximum(np.concatenate(h, 1), 0) @ net.p["out"] + net.p["out_bias"])
        return -np.log(s[np.arange(4), y]).mean()

    g = net._gradients(x, y)
    for k in ("out", "bias3", "filter2", "embed"):
        at = np.unravel_index(np.abs(g[k]).argmax(), g[k].shape)
        net.p[k][at] += 1e-6
        up = loss()
        net.p[k][at] -= 2e-6
        assert abs((up - loss()) / 2e-6 - g[k][at]) < 1e-4
        net.p[k][at] += 1e-6
