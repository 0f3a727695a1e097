"""Cases in which an operator once did less than its whole job."""

import math
import random
import re
from collections import Counter

import pytest
from tests.llm import brute
from tests.llm.test_operators import plain_matching, table

from skyair.llm import lm, pii


def plain_spans(docs):
    """The spans column of every document, from counts over all of them."""
    words = [set(re.findall(r"[^\W\d_]+", t.lower())) for t in docs]
    held = []
    for t in docs:
        digits = lambda v: re.sub("[^0-9]", "", v)
        held.append({f"{k}:{t[a:b].lower() if k == 'email' else digits(t[a:b])}" for k, a, b in brute.base_spans(t)})
    n, d, e, j = len(docs), Counter(), Counter(), Counter()
    for own, entities in zip(words, held):
        d.update(own)
        e.update(entities)
        j.update((x, w) for x in entities for w in own)
    kinds = {}
    for (x, w), both in j.items():
        given, whole = math.log2(both * n / (e[x] * d[w])), math.log2(n / e[x])
        if d[w] >= pii.MIN_DOCUMENTS and given > 0 and given >= pii.DISCLOSURE * whole:
            kinds[x, w] = "removed" if given >= whole - 1e-9 else "term"
    for t, entities in zip(docs, held):
        base = brute.base_spans(t)
        found = [(a, pii.KINDS.index(k), b, k) for k, a, b in base]
        for m in re.finditer(r"[^\W\d_]+", t):
            own = {kinds.get((x, m.group().lower())) for x in entities} - {None}
            if own and not any(a < m.end() and m.start() < b for _, a, b in base):
                found.append((m.start(), len(pii.KINDS), m.end(), "removed" if "removed" in own else "term"))
        yield ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(found))


def test_spans_equal_counts_over_all_documents(spark):
    rng = random.Random(3)
    rare = [f"{a}{b}{c}" for a in "qwrtz" for b in "aeiou" for c in "xvk"]
    docs = [" ".join(rng.choices(["the", "of", "and", "in"], k=6)) for _ in range(1500)]
    for k in range(0, 1500, 9):
        docs[k] += " " + " ".join(rng.sample(rare, 1))
    for k in range(0, 200, 5):  # each address in one document, the name one line below it
        docs[k] += f"\nmail user{'abcdefgh'[k % 8]}{k}@host.org or 10.0.{k}.1\n{rng.choice(rare).title()} {rng.choice(rare)}"
    docs += [docs[5]] * 4 + ["call +1 555 010 9999 now quux"] * 5
    found = pii.find(table(spark, [(k, t, None) for k, t in enumerate(docs)]), key="doc_id")
    found = {r.doc_id: r for r in found.collect()}
    expected = list(plain_spans(docs))
    assert [found[k].spans for k in range(len(docs))] == expected
    alone = [k for k in range(10, 200, 5) if "term:" in expected[k] or "removed:" in expected[k]]
    assert alone and all(found[k].n_terms > 0 for k in alone)


def test_removed_terms_leave_no_new_personal_data(spark):
    docs = [(k, "at x@y.zz +1 zorb 555 010 9999", None) for k in range(3)] + [(9 + k, "and so on", None) for k in range(200)]
    for r in pii.sanitise(table(spark, docs)).filter("doc_id < 9").collect():
        assert not brute.base_spans(r.text) and "zorb" not in r.text


@pytest.mark.parametrize("few", [0, 3, 1 << 16])
def test_scores_do_not_depend_on_which_contexts_are_frequent(spark, few):
    train = ["The cat sat. The cat ran!", "A dog, a cat and 12 mice\n", "", "éclair école", "мама мыла раму", "the cat sat"]
    texts = [*train, "the cats, 13 mice", "мама рыла яму", "école éclat 🙂", "Zebra"]
    model = lm.train(table(spark, [(k, t, None) for k, t in enumerate(train)]), long_contexts=few, frequent_grams=few)
    for r in lm.score(table(spark, [(k, t, None) for k, t in enumerate(texts)]), model).collect():
        assert r.score == pytest.approx(plain_matching(train, texts[r.doc_id]), rel=1e-5)


def test_bytes_are_contexts_of_their_own(spark):
    docs = table(spark, [(k, t, None) for k, t in enumerate(["1a", "2b", "яа", "юб"] * 20)])
    context, _, _ = lm.symbols_in_context(docs.select("text").toArrow().column("text").combine_chunks())
    assert len(set((context % 256).tolist())) == 1 + len(set("12ab".encode() + "яюаб".encode()))
