"""The near-duplicate stage of the pipeline: SimHash first, then near copies that SimHash leaves."""

import random

import corpus_pipeline
from everkey.llm import copies, simhash


def similarity(a, b):
    x, y = set(copies.shingles(a).tolist()), set(copies.shingles(b).tolist())
    return len(x & y) / len(x | y)


def apart(a, b):
    return bin(simhash.fingerprint(a) ^ simhash.fingerprint(b)).count("1")


def test_near_duplicates_of_either_kind_go(spark):
    cycle = "one two three four five six seven " * 60
    alike = [cycle + "alpha beta gamma delta epsilon zeta", cycle + "red green blue black white brown"]
    assert apart(*alike) <= simhash.DISTANCE and similarity(*alike) < 0.8
    rng = random.Random(3)
    while True:
        words = [f"w{rng.randrange(10_000)}" for _ in range(200)]
        other = [f"x{i}" if i in (40, 90, 150) else w for i, w in enumerate(words)]
        copied = [" ".join(words), " ".join(other)]
        if apart(*copied) > simhash.DISTANCE:
            break
    assert similarity(*copied) >= 0.8
    alone = " ".join(f"z{i}" for i in range(50))
    # Two texts under one id: the near copy goes, the other stays.
    rows = [(1, alike[0]), (2, alike[1]), (2, alone), (3, copied[0]), (4, copied[1]), (None, ""), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([(1, alike[0]), (2, alone), (3, copied[0]), (5, None)], key=str)
