"""op4_near_duplicates on large groups without a text of origin, against brute force."""

import collections
import random

from adtally.llm import near_dups


def _bag(text):
    w = text.split()
    return collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def _roots(texts):
    bags, parent = [_bag(t) for t in texts], list(range(len(texts)))

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for a in range(len(texts)):
        for b in range(a):
            both = sum((bags[a] & bags[b]).values())
            if both >= 0.8 * (sum(bags[a].values()) + sum(bags[b].values()) - both):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return [root(d) for d in range(len(texts))]


def _changed(rnd, words, n, mark):
    words = list(words)
    for j in rnd.sample(range(len(words)), n):
        words[j] = f"{mark}x{j}"
    return words


def test_pairs_beside_a_huge_group_are_joined(spark, monkeypatch):
    rnd = random.Random(21)
    base = [f"b{i}" for i in range(300)]
    texts = [" ".join(_changed(rnd, base, 4, f"c{i}")) for i in range(150)]  # the huge group
    for p in range(40):  # near to each other, not to the group
        one = _changed(rnd, base, 16, f"p{p}")
        texts += [" ".join(one), " ".join(_changed(rnd, one, 5, f"q{p}"))]
    rnd.shuffle(texts)
    want = _roots(texts)
    assert len(set(want)) > 20
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for block in (near_dups.BLOCK, 50):
        monkeypatch.setattr(near_dups, "BLOCK", block)
        got = {r["doc_id"]: r["class_id"] for r in near_dups.near_duplicate_classes(df).collect()}
        assert [got[d] for d in range(len(texts))] == want
