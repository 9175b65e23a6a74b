"""Operators on single texts: url rules, licences, pseudonyms, pieces, toxicity."""

import datetime
import random
import re
from array import array

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from everkey.llm import licenses, pii, sentences, toxicity, urls

EXTRA = ", rule string, path string, _score double, _text long, _id long"


def docs(spark, rows):
    """Documents with extra columns whose names clash with those of the operators."""
    full = [(i, t, "x", "y", 0.5, 1, 2) for i, t in rows]
    return spark.createDataFrame(full, "doc_id long, text string" + EXTRA)


# ---- urls


def plain_verdict(url):
    host, path, rest = "", "", ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match("[^/?#]*", rest).group()
        path = re.match("[^?#]*", rest[len(host):]).group()
        rest = rest[len(host):]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    base = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
    fits = [(len(h + p), h + p, v) for v, h, p in base if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return host, path, max(fits)[1], max(fits)[2]
    own = [r.verdict for r in urls.PATTERN_RULES if re.search(r.regex, host + rest)]
    return host, path, None, "allow" if "allow" in own or not own else "block"


def test_urls(spark):
    given_ = [None, "", "nothing", "http://", "http://A.NET/x", "http://net", "http://net/", "http://anet/", "http://x.example.net/en/1", "http://example.net/EN/1",
              "https://example.com/de/?a=/b", "https://examplex.com/de/", "ftp://a.org/fr/#x", "ftp://a.org?/fr/", "http://a.org/fr?x/", "http://É.net/ü", "http://b.com/ads/x",
              "http://b.com/ads/research/", "http://docs.b.com/search?q=1", "http://b.com/search?q=1", "http://b.com/x?sessionid=4", "://example.net/en/", "a://b://net/"] * 2
    rows = spark.createDataFrame([(i, u, "r", "p") for i, u in enumerate(given_)] + [(None, "http://net/", "r", "p")], "page_id long, url string, rule string, verdict string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judge(rows).collect()}
    assert len(got) == len(given_) + 1
    for i, u in enumerate(given_):
        assert got[i] == plain_verdict(u), u
    assert urls.judge(rows.limit(0)).count() == 0


def test_rules_need_a_whole_token():
    assert urls.Rule("block", "/ads*/x/").tokens == ["x"]
    with pytest.raises(ValueError):
        urls.Rule("block", "ads*").tokens


# ---- licences


def plain_scan(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    places, labels = [], set()
    for phrase, label in licenses.BASE_PHRASES:
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i: i + len(p)] == p:
                places.append(i)
                labels.add(label)
    spaced = "".join(f" {w} " for w in words)
    found = [(m.start(), m.end(), k) for k, r in enumerate(licenses.signatures()) for m in re.finditer(r.regex, spaced)]
    kept = [d for d in found if not any(e[0] <= d[0] and e[1] >= d[1] and (e[:2] != d[:2] or e[2] < d[2]) for e in found)]
    rules = licenses.signatures()
    score = max([rules[k].confidence for _, _, k in kept] + [0.5] * bool(labels) + [0.0])
    every = labels | {rules[k].label for _, _, k in kept}
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)), ",".join(sorted(every)), score)


def test_licenses(spark):
    texts = [None, "", "  ", "cc by", "CC-BY cc by cc by-nc 4.0", "x all rights reserved.", "General Public License general public licence", "the GNU General Public License, version 3 or any later version",
             "Licensed under the Apache License, Version 2.0.", "ccby cc bye", "K\u212a all rights reserved", "Éall rights reserved all rights\nreserved", "released under the terms of the MIT license " * 300,
             "creative commons attribution share alike 4.0 international", "BSD 3-clause license", "lgplv2.1 gpl v2+ GPL-3.0-or-later"]
    got = {r["doc_id"]: tuple(r)[1:] for r in licenses.scan(docs(spark, list(enumerate(texts)) + [(99, "cc by")] * 2)).collect()}
    for i, t in enumerate(texts):
        assert got[i] == plain_scan(t), t
    assert licenses.scan(docs(spark, [])).count() == 0
    assert len(licenses.signatures()) > 200


# ---- pseudonyms


def luhn(d):
    return sum((x * 2 - 9 if x > 4 else x * 2) if i % 2 else x for i, x in enumerate(int(c) for c in reversed(d))) % 10 == 0


def test_pseudonyms(spark):
    texts = [None, "", "nothing here", "4111 1111 1111 1111 and 4111111111111111, 4111111111111112", "call +1 (578) 555-6437 or 578-555-6437", "on 2024-02-29, 2023-02-29 and 1999/12/31 at 10.0.0.1 or 300.1.1.1",
             "mail Kfslg.71@mail0.example.com kfslg.71@x.org", "ssn 123-45-6789 000-12-3456 987-65-4321", "y" * 50_000 + " 4111111111111111 " + "9" * 3000]
    rows = {r["doc_id"]: r for r in pii.pseudonymise(docs(spark, list(enumerate(texts)) + [(3, texts[3])]), "secret").collect()}
    for i in (0, 1, 2):
        assert rows[i]["text"] == texts[i] and rows[i]["n_values"] == 0
    a = rows[3]["pseudonyms"]
    assert rows[3]["n_values"] == 2 and a[0].replace(" ", "") == a[1] and luhn(a[1]) and a[1][0] == "4" and re.fullmatch(r"\d{4}( \d{4}){3}", a[0])
    assert rows[3]["text"] == f"{a[0]} and {a[1]}, 4111111111111112"
    assert rows[8]["pseudonyms"] == [a[1]] and len(rows[8]["text"]) == len(texts[8])
    p = rows[4]["pseudonyms"]
    assert re.fullmatch(r"\+1 \([2-9]\d\d\) [2-9]\d\d-\d{4}", p[0]) and re.sub(r"\D", "", p[0])[1:] == re.sub(r"\D", "", p[1])
    assert rows[5]["kinds"] == ["date", "date", "ip"]
    for value, form in zip(rows[5]["pseudonyms"][:2], ("%Y-%m-%d", "%Y/%m/%d")):
        assert 1800 <= datetime.datetime.strptime(value, form).year <= 2199
    assert "2023-02-29" in rows[5]["text"] and "300.1.1.1" in rows[5]["text"]
    assert re.fullmatch(r"[A-Z][a-z]{4}\.\d\d@mail0\.example\.com", rows[6]["pseudonyms"][0])
    assert rows[7]["kinds"] == ["ssn"]
    assert pii.pseudonymise(docs(spark, []), "secret").count() == 0


@pytest.mark.parametrize("a, b", [(189, 773), (10, 100), (3, 7), (1, 5)])
def test_feistel_is_a_permutation(spark, a, b):
    got = spark.range(a * b).select(pii.feistel(F.col("id"), F.lit(a), F.lit(b), F.lit("k"), F.lit("t")).alias("v")).collect()
    assert sorted(r["v"] for r in got) == list(range(a * b))


def test_all_formats_permute_without_collision(spark):
    dates = [(i, (datetime.date(1999, 1, 1) + datetime.timedelta(i)).isoformat()) for i in range(800)]
    got = pii.pseudonymise(docs(spark, dates), "k").collect()
    assert len({r["text"] for r in got}) == 800
    cards = [(i, "4" + f"{i:014d}") for i in range(400)] + [(400 + i, "6" + f"{10**17 - 1 - i:017d}") for i in range(400)]
    cards = [(i, next(c + str(k) for k in range(10) if luhn(c + str(k)))) for i, c in cards]
    got = pii.pseudonymise(docs(spark, cards), "k").collect()
    assert len({r["text"] for r in got}) == 800 and all(luhn(r["text"]) for r in got)


# ---- pieces


@pytest.fixture(scope="module")
def model():
    with open(sentences.MODEL, "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def own(model):
    return sentences.Pieces(model)


@pytest.fixture(scope="module")
def library(model):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model)


def ids_of(own, text):
    return list(array("i", own.encode(text)))


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet="aethin rs.\n ▁é日", max_size=120)))
def test_pieces_as_in_the_library(own, library, text):
    assert ids_of(own, text) == library.encode(text)
    assert own.decode(ids_of(own, text)) == library.decode(library.encode(text))


def test_streams_commit_early(own, library):
    rng = random.Random(3)
    for text in ("thequickbrown" * 400, "a" * 3000, "".join(rng.choice("etaoinshr") for _ in range(5000)), "-" * 777):
        assert ids_of(own, text) == library.encode(text)
        stream = own.stream("▁" + text)
        taken, first = 0, []
        for piece, _ in stream:
            first.append(piece)
            taken += len(piece)
        assert "".join(first) == "▁" + text


def test_unigram_models(model):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(model)
    proto.trainer_spec.model_type = 1
    rng = random.Random(5)
    for p in proto.pieces:
        p.score = -rng.randrange(1, 4000) / 64 if p.type == 1 else p.score
    unigram = proto.SerializeToString()
    library, own = sentencepiece.SentencePieceProcessor(model_proto=unigram), sentences.Pieces(unigram)
    for text in ("the other thing", "and is thornwhinging", "nd é 日本 xyz", "within the heart of it all"):
        mine = [own.names[i] for i in ids_of(own, text)]
        best = library.nbest_encode_as_pieces(text, 1)[0]
        worth = lambda ps: sum(own.scores.get(p, 0) for p in ps)
        assert mine == best or abs(worth(mine) - worth(best)) < 1e-3


def test_encoded(spark, own):
    texts = [None, "", " ", "a b", "x" * 70_000, "line\nline", "a b"]
    rows = {r["doc_id"]: r for r in sentences.encoded(docs(spark, list(enumerate(texts)))).collect()}
    assert rows[0]["ids"] is None and rows[0]["n_tokens"] == 0
    assert rows[3]["ids"] == rows[6]["ids"]
    assert all(r["round_trip"] for r in rows.values())
    back = {r["doc_id"]: r["text"] for r in sentences.decoded(sentences.encoded(docs(spark, list(enumerate(texts))))).collect()}
    assert [back[i] for i in range(len(texts))] == texts
    assert sentences.encoded(docs(spark, [])).count() == 0


# ---- toxicity


def test_buckets_are_told_by_slices(monkeypatch):
    text = "some words that repeat " * 50
    whole = toxicity.buckets_of(text)
    monkeypatch.setattr(toxicity, "SLICE", 64)
    assert np.array_equal(whole, toxicity.buckets_of(text))


def toxic_docs(spark):
    rng = random.Random(7)
    words = ["th" + "".join(rng.choice("aeinst") for _ in range(rng.randrange(2, 8))) for _ in range(400)]
    rows, labels = [], []
    for i in range(600):
        body = [rng.choice(words) for _ in range(40)]
        bad = i % 5 == 0
        if bad:
            body[rng.randrange(40)] = "moronic"
            body[rng.randrange(40)] = "scumbag"
        rows.append((i, " ".join(body)))
        labels.append((i, 0, int(bad)))
    return docs(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), {i for i, _, b in labels if b}


def test_toxicity(spark):
    rows, labels, bad = toxic_docs(spark)
    got = toxicity.score(rows, labels).collect()
    held = [r for r in got if r["held_out"]]
    assert len(got) == 600 and 50 < len(held) < 300
    assert sum((r["predicted"] == 1) == (r["doc_id"] in bad) for r in held) >= 0.97 * len(held)
    again = toxicity.score(rows, labels).collect()
    assert {r["doc_id"]: r["score"] for r in got} == {r["doc_id"]: r["score"] for r in again}
    kept = {r["doc_id"] for r in toxicity.clean(rows, labels).collect()}
    assert kept == {r["doc_id"] for r in got if r["predicted"] == 0}


def test_toxicity_of_little(spark):
    labels = spark.createDataFrame([(1, 0, 1), (None, 0, 1), (2, 0, None), (1, 0, 0)], "doc_id long, quality int, toxic int")
    texts = docs(spark, [(1, "bad"), (1, "worse"), (2, None), (None, ""), (4, "z" * 100_000)])
    rows = toxicity.score(texts, labels).collect()
    assert len(rows) == 5 and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.score(texts.limit(0), labels.limit(0)).count() == 0
