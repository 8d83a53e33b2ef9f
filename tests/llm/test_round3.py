"""Details of the text operators: markup with stray quotes and open elements, memory of language
labels, sums of the latent search."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pytest

from depotflow.llm import langid, latent, sitetree, textarrays


def text_of(page):
    return sitetree.main_text(page, frozenset())


@pytest.mark.parametrize(
    ("inside", "shown"),
    [
        ("<p data-x=don't>hello there</p><p>it's me</p><p>end</p>", "hello there\n\nit's me\n\nend"),
        ('<p title="a > b">one</p><p title=\'c > "d\'>two</p>', "one\n\ntwo"),
        ("<p \" '>one</p><p class=a=b>two</p><p x = y>three</p>", "one\n\ntwo\n\nthree"),
        ("<p>let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be</p>", "let x=2 be"),
        ("<p>one</p><svg><path><p>two</p>", "one\n\ntwo"),
        ("<p>one</p><object data=x><p>two</p>", "one\n\ntwo"),
        ("<p>one</p><svg><svg>a</svg>b</svg><p>two</p><canvas>c</canvas>", "one\n\ntwo"),
        ("<p>one</p><iframe src=x><p>two</p>", "one\n\ntwo"),
        ("<p>one</p><script>if (a < b) '<p>no</p>'</script><p>two</p>", "one\n\ntwo"),
        ("<p>one</p><!-- no > yes", "one"),
        ("<p>1 < 2 and a < b</p><p>two</p>", "1 < 2 and a < b\n\ntwo"),
    ],
)
def test_text_of_an_article_stays_whole(inside, shown):
    assert text_of(f"<html><body><nav>menu</nav><article>{inside}</article></body></html>") == shown


def test_long_attributes_take_no_time():
    page = "<article><p " + "a='b" * 20_000 + ">x</p><p " + '="' * 20_001 + ">y</p></article>"
    assert len(text_of(page)) < 10 and text_of("<p a=" * 30_000) is not None


def test_labels_of_short_texts_beside_a_very_long_one_take_little_memory():
    grams = 1 << langid.HASH_BITS
    rng = np.random.default_rng(1)
    logs = np.log(rng.random((grams, 4)).astype(np.float32) + 0.01)
    model = langid.LanguageModel(["a", "b", "c", "d"], logs, np.ones((len(langid.SCRIPTS), 4), bool))
    texts = ["some words of an ordinary short text"] * 10_000 + ["ab cd " * 10_000]
    alone = [model.label([t])[4] for t in (texts[0], texts[-1])]
    tracemalloc.start()
    letters = model.label(texts)[4]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 500e6
    assert (letters[0] == alone[0][0]).all() and (letters[-1] == alone[1][0]).all()


def test_viterbi_in_groups_is_viterbi_of_each_text(monkeypatch):
    rng = np.random.default_rng(2)
    owner = np.sort(rng.integers(0, 30, 400))
    scores = rng.random((400, 3)).astype(np.float32)
    each = np.concatenate([langid._viterbi(scores[owner == t], np.zeros((owner == t).sum(), int), 1, 0.5) for t in np.unique(owner)])
    for cells in (1, 100, 10**6):
        monkeypatch.setattr(langid, "_CELLS", cells)
        assert (langid._viterbi(scores, owner, 31, 0.5) == each).all()


def test_sums_of_the_latent_search():
    rng = random.Random(4)
    passage = np.sort([rng.randint(0, 200) * 3 for _ in range(900)])
    term = np.array([rng.randint(0, 40) for _ in range(900)])
    codes = np.unique(passage << 32 | term)
    passage, term = codes >> 32, codes & (2**32 - 1)
    table = np.random.default_rng(3).random((41, 5))
    starts = np.flatnonzero(np.diff(passage, prepend=-1))
    assert np.allclose(latent._grouped_sums(table, term, starts), np.add.reduceat(table[term], starts, axis=0))
    weights, total = np.random.default_rng(5).random(41), np.zeros((41, 5))
    latent._add_outer(total, passage, term, weights, table)
    dense = np.zeros((601, 41))
    dense[passage, term] = weights[term]
    assert np.allclose(total, dense.T @ (dense @ table))


def test_a_sample_has_one_row_of_each_id(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c d"), (3, "e")], "doc_id bigint, text string")
    many = docs.unionByName(docs.filter("doc_id = 2").crossJoin(spark.range(5000)).drop("id")).unionByName(
        spark.createDataFrame([(2, "another"), (None, "x")], docs.schema)
    )
    labels = spark.createDataFrame([(1, 0), (2, 1), (2, 1), (3, 1), (9, 1)], "doc_id bigint, toxic int")
    found = [tuple(r) for r in textarrays.labelled_sample(many.repartition(4), labels, "toxic", 3).collect()]
    assert sorted(found) == [("a b", 0), ("c d", 1), ("e", 1)]
