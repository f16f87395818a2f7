"""Phrase mining: two readings of the texts find all frequent phrases, whatever the sample proposed."""

import numpy as np
import pytest

from tarmac.llm import phrases
from tests.llm.test_new_operators import brute_phrases

TEXTS = [("en", "a b c d e. a b c d, x\ty"), ("en", "a b c d\n\na  b"), (None, "a b c"), ("de", None), ("de", " ,; \n"),
         ("en", "x y x y x y z"), ("en", "É b c\x00d É b")] * 7


@pytest.mark.parametrize("sample", [[], [("en", "a"), ("en", "b"), ("en", "a b")], [("en", "x"), ("en", "y"), ("en", "x y x")]])
def test_phrases_that_were_not_proposed_are_found_by_the_second_reading(spark, monkeypatch, sample):
    docs = spark.createDataFrame([(i, *t) for i, t in enumerate(TEXTS)], "doc_id long, lang string, text string").repartition(3)
    proposed = spark.createDataFrame(sample, "lang string, phrase string")
    monkeypatch.setattr(phrases, "propose", lambda *a: proposed)
    read = []
    monkeypatch.setattr(phrases, "_counted", lambda *a, f=phrases._counted: read.append(a) or f(*a))
    found, totals = phrases.frequent_phrases(docs, least=14)
    want = brute_phrases([(x or "und", t or "") for x, t in TEXTS], 14)
    assert {(r.lang, r.phrase): r.n for r in found.collect()} == want and any(len(p.split(" ")) == 4 for _, p in want)
    assert {r.lang: r.n for r in totals.collect() if r.n} == {
        x: sum(n for (y, _), n in brute_phrases([(a or "und", t or "") for a, t in TEXTS], 1, 1).items() if x == y)
        for x in ("en", "und")}
    assert len(read) == 1


def test_words_of_texts_by_number():
    texts = [None, "", "a  B\ta.b,\n\n", " é\x00x   y!", "end"]
    ids, words = phrases.number_pieces(texts)
    said = [None if i < 0 else words[int(i)].as_py().decode() for i in ids]
    want = []
    for t in texts:
        for piece in (t or "").lower().translate({ord(c): "\n" for c in phrases.ENDS.decode()}).split("\n"):
            want += [w for w in piece.replace("\t", " ").split(" ") if w] + [None]
    assert said == want and len(set(words.to_pylist())) == len(words)
    told = phrases.spell_phrases(words, np.array([[0, 1], [1, 0]]))
    assert told.to_pylist() == ["a b", "b a"]
