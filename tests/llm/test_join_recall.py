"""How many of the true links the n-gram join finds among families of like texts."""

import random
import re

import pytest

from calltide.llm import ngram_join


def windows(text, n=5):
    words = re.findall("[^\x20\x09-\x0d]+", text)
    return {" ".join(words[i : i + n]) for i in range(max(len(words) - n + 1, 1))}


def family(rng, size, edits, words):
    """Texts that fill a template: many are like each other at 0.3 to 0.7 and few at 0.8 or more."""
    base = rng.choices(words, k=150)
    out = []
    for _ in range(size):
        own = base[:]
        for at in rng.sample(range(len(own)), rng.randint(*edits)):
            own[at] = rng.choice(words)
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("seed", range(2))
def test_links_among_template_families(frame, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    texts = list(dict.fromkeys(t for edits in ((0, 4), (2, 9), (6, 20)) for t in family(rng, 70, edits, words)))
    sets = [windows(t) for t in texts]
    links = [0] * len(texts)
    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if len(x & y) >= 0.8 * len(x | y) - 1e-9:
                links[i] += 1
                links[j] += 1
    got = {r.doc_id: r.n_links for r in ngram_join.jaccard_join(frame(list(enumerate(texts)))).collect()}
    found = [got[i] for i in range(len(texts))]
    assert all(f <= n for f, n in zip(found, links)) and sum(links) > 200
    assert sum(found) >= 0.99 * sum(links)
