"""Near copies within crowds of texts from one template, against all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from everkey.llm import copies, crowds
from everkey.session import written


def crowd(n, words, changes, seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(7))
    template = [word() for _ in range(words)]
    texts = []
    for _ in range(n):
        own = list(template)
        for place in rng.sample(range(words), changes if isinstance(changes, int) else rng.choice(changes)):
            own[place] = word()
        texts.append(" ".join(own))
    return texts


def all_components(texts):
    """Smallest place of each text's component, by all pairs."""
    sets = [copies.shingles(t) for t in texts]
    names = np.unique(np.concatenate(sets))
    held = np.zeros((len(texts), len(names)), dtype=np.float32)
    for row, own in zip(held, sets):
        row[np.searchsorted(names, own)] = 1
    both = held @ held.T
    sizes = held.sum(axis=1)
    near = both * 5 >= (sizes[:, None] + sizes[None, :] - both) * 4
    root = np.arange(len(texts))
    while True:
        least = np.where(near, root[None, :], len(texts)).min(axis=1)
        if (least == root).all():
            return root, near
        root = least


def found(spark, texts):
    """Smallest place of each text's component, and the number of pairs compared in bands and at each level."""
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    keyed = copies._keyed(rows)
    every = written(copies.sketches(keyed.select("_none", "_id", "_tie", F.col("_row.text").alias("text"))), "test-sketches")
    classes = written(every.groupBy("_print").agg(F.min(F.struct("_none", "_id", "_tie")).alias("_first"), F.first("_size").alias("_size"), F.first("_bands").alias("_bands")), "test-classes")
    links, counts = copies.links(keyed, classes)
    place = {r["_print"]: r["_id"] for r in every.collect()}
    root = list(range(len(texts)))
    pairs = [(place[r["a"]], place[r["b"]]) for r in links.collect()]
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(root[a], root[b])
            if root[a] != low or root[b] != low:
                root[a] = root[b] = low
                changed = True
    return root, pairs, counts


# Similarities of two texts in the mean: 0.55, where hardly any pair is compared, and 0.69, where more than half of all are.
@pytest.mark.parametrize("n, words, changes, most", [(1000, 120, 4, 32_000), (400, 150, 3, 100_000)])
def test_crowds(spark, n, words, changes, most):
    texts = crowd(n, words, changes, n)
    want, near = all_components(texts)
    root, pairs, counts = found(spark, texts)
    assert all(near[a, b] for a, b in pairs)
    assert root == want.tolist()
    assert sum(counts) <= most


def test_levels_change_nothing(spark, monkeypatch):
    """Crowds of several templates with few and many changes, in groups of any size and at any number of levels."""
    texts = list(dict.fromkeys(crowd(150, 60, (1, 2, 3, 4), 1) + crowd(60, 40, (0, 1, 2), 2) + crowd(40, 300, (3, 9, 12), 3)))
    rng = random.Random(4)
    texts += [" ".join(a.split()[:30] + b.split()[30:]) for a, b in (rng.sample(texts, 2) for _ in range(30))]
    sets = {i: copies.shingles(t) for i, t in enumerate(texts)}
    want = all_components(texts)[0]
    held = spark.createDataFrame([(i, s.view("<i8").tolist()) for i, s in sets.items()], "_print long, _set array<long>")
    groups = spark.createDataFrame([(1, 5, i, len(s)) for i, s in sets.items()], "_g long, _hub long, _x long, _size long")
    place = spark.createDataFrame([(i, i) for i in sets], "_x long, _root long")
    for list_up_to, levels, heavy in ((2, 3, 1e9), (8, 1, 8.0), (2, 0, 8.0)):
        monkeypatch.setattr(crowds, "LIST", list_up_to)
        links, _ = crowds.linked(groups, place, held, copies._checked, copies._fits, levels, heavy)
        roots = crowds.components(links).collect()
        got = {i: i for i in sets} | {r["node"]: r["root"] for r in roots}
        assert [got[i] for i in range(len(texts))] == want.tolist()
