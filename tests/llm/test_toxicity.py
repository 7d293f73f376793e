from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyline.llm import toxicity
from tallyline.llm.toxicity import LexiconAutomaton, Matcher, max_errors


def distance(a, b):
    """Edit distance in which swapped neighbours cost one."""
    d = {(i, -1): i + 1 for i in range(-1, len(a))} | {(-1, j): j + 1 for j in range(-1, len(b))}
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (x != y))
            if i and j and x == b[j - 1] and y == a[i - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a) - 1, len(b) - 1]


TERMS = ["abcab", "badcab", "bacabacab", "cab"]


@settings(max_examples=300, deadline=None)
@given(st.text("abcd", max_size=11))
def test_automaton_agrees_with_edit_distance(word):
    found = LexiconAutomaton(TERMS, []).match(word)
    near = {t: distance(word, t) for t in TERMS}
    allowed = [e for t, e in near.items() if e <= max_errors(len(t)) and not (e and len(t) < 6 and word[:1] != t[:1])]
    assert (found[1] if found else None) == (min(allowed) if allowed else None)


def test_stems_lookalikes_and_runs():
    m = Matcher(["stupid", "worthless"], ["lowei"], [])
    assert m["loweischaft,"][:2] == ("lowei", 0) and m["loweischaft,"][2]
    assert m["(Stupid)".lower()] == ("stupid", 0, False)
    for word in ("stup1d", "5tup!d", "stuuuupid", "stpuid", "stupidd", "worhtles"):
        assert m[word] and m[word][1], word
    assert m["lowe"] is None and m["student"] is None and m["..."] is None
    assert Matcher(["stupid"], [], ["stupi"])["stupi"] is None


def corpus(n=600):
    rng = random.Random(3)
    plain = ["".join(rng.choices("aeioulmnrst", k=rng.randint(2, 8))) for _ in range(150)]
    bad = ["vorkun", "plexad", "drimmel"]
    texts, labels = [], []
    for i in range(n):
        words = rng.choices(plain, k=rng.choice([5, 40, 120]))
        if i % 4 == 0:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
        texts.append(" ".join(words))
        labels.append((i, int(i % 4 == 0)))
    return texts, labels, bad


def test_learns_scores_and_separates(spark, documents):
    texts, labels, bad = corpus()
    frame = documents(texts, extra="toxicity_")
    known = spark.createDataFrame([x for x in labels if x[0] % 3] + [(99999, 1), (None, 1)], "doc_id long, toxic int")
    model = toxicity.train(frame, known)
    assert set(bad) <= set(model.terms)
    rows = toxicity.score(frame, model).collect()
    held = [r for r in rows if r["doc_id"] % 3 == 0]
    wrong = [r for r in held if (r["toxicity"] >= toxicity.THRESHOLD) != (r["doc_id"] % 4 == 0)]
    assert len(wrong) <= 0.02 * len(held)
    assert {r["toxicity_"] for r in rows} == {"kept aside"}
    more = documents([None, "", "VORKUN! plexad ... dr1mmel", texts[1] + " drimmle plexadd vorkn plexad", texts[1] * 50])
    score = [r["toxicity"] for r in toxicity.score(more, model).orderBy("doc_id").collect()]
    assert score[0] == score[1] < 0.3 and score[2] > 0.7 and score[3] > 0.7 and score[4] < 0.3
    assert toxicity.score(documents([]), model).collect() == []


def test_copies_make_no_terms(spark, documents):
    texts, labels, bad = corpus(200)
    copied = "zwirbel knusper holdrio " + texts[1]
    frame = documents(texts + [copied] * 60)
    known = spark.createDataFrame(labels + [(200 + i, 1) for i in range(60)], "doc_id long, toxic int")
    model = toxicity.train(frame, known)
    assert not {"zwirbel", "knusper", "holdrio"} & set(model.terms)


@pytest.mark.parametrize("labels", [[], [(0, 0), (1, 0)]])
def test_without_labels_of_both_kinds(spark, documents, labels):
    frame = documents(["a b", "stupid words"])
    model = toxicity.train(frame, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert all(r["toxicity"] < 1e-9 for r in toxicity.score(frame, model).collect())


def test_quotation_counts_less():
    purity = {"vorkun": 1.0}
    m = Matcher(["vorkun"], [], [])
    features = lambda t: dict(zip(toxicity.FEATURES, toxicity.features(*m.hits(t), purity)))
    plain, quoted = features("you are a vorkun indeed"), features('they said "vorkun" about it')
    assert plain["direct"] > 0 and plain["quoted"] == 0
    assert quoted["direct"] == 0 and quoted["quoted"] > 0
