"""License scan: base places by brute force, labels of the method, key phrases."""

import math
import random
import re

import pytest

from scoutlens.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places = [(i, label) for phrase, label in licenses.PHRASES.items() for i in range(len(words))
              if words[i:i + len(phrase.split())] == phrase.split()]
    at = [i for i, _ in places]
    return [len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))]


def by_label(label):
    return next(t for t in licenses.TEMPLATES if t.label == label)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(1)
    parts = ["MIT License", "cc-by", "CC BY", "Apache", "license", "GNU General Public License", "gnu general", "x", "é", "mit\nlicense"]
    out = [None, "", "...", "mit mit license license", "cc by cc by cc by", "cc", "by cc", "word " * 20000 + "mit license"]
    out += [" ".join(rng.choices(parts, k=rng.randint(1, 12))) for _ in range(60)]
    return out


def test_base_columns(spark, texts):
    docs = spark.createDataFrame([(i, x, "n", 0.5) for i, x in enumerate(texts)], "doc_id long, text string, labels string, score double")
    docs = docs.unionByName(docs.where("doc_id = 4"))
    rows = licenses.scan(docs).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        assert [r[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels")] == brute(texts[r["doc_id"]])
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))
        assert 0 <= r["score"] <= 1
    assert licenses.scan(docs.limit(0)).count() == 0


def test_templates_are_found_by_their_rare_words(spark):
    filler = "some words about nothing at all in this file and more of them "
    wanted = ["bsd", "isc", "mpl", "cc0", "unlicense", "boost", "lgpl", "agpl"]
    rows = [(i, filler + by_label(x).text + " " + filler) for i, x in enumerate(wanted)]
    bsd = by_label("bsd").text
    rows += [(20, filler + bsd.replace("source", "sauce")),                    # its key phrase is missing
             (21, filler + " ".join(reversed(bsd.split()))),                   # the words, out of place
             (22, filler + bsd.replace("provided that", "provided strictly")), # a small change elsewhere
             (23, filler + bsd + " " + filler + by_label("isc").text)]
    got = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, x in enumerate(wanted):
        assert x in got[i]["labels"].split(","), (x, got[i])
        assert got[i]["score"] == pytest.approx(1.0)
        assert f"{x}@13" in got[i]["starts"]
    assert got[20]["labels"] == "" and got[21]["labels"] == ""
    assert got[22]["labels"] == "bsd" and 0.6 <= got[22]["score"] < 1
    assert got[23]["labels"] == "bsd,isc" and got[23]["n_base"] == 0


def test_phrases_never_cross_texts(spark):
    docs = spark.createDataFrame([(1, "the mit"), (2, "license"), (3, "")], "doc_id long, text string").coalesce(1)
    assert all(r["n_base"] == 0 and r["first_word"] is None for r in licenses.scan(docs).collect())


def test_every_notice_of_a_long_text_is_found(spark):
    """All notices in one text, far apart: each is found at its own start, whatever else the text holds."""
    rng = random.Random(3)
    words, wanted = [], set()
    for t in licenses.TEMPLATES:
        words += rng.choices(["alpha", "beta", "gamma"], k=500)
        wanted.add(f"{t.label}@{len(words)}")
        words += WORD.findall(t.text.lower())
    together = " ".join(words + ["omega"] * 500)
    alone = [(i, t.text) for i, t in enumerate(licenses.TEMPLATES)]
    for rows in ([(99, together)], [(99, together), *alone], [(99, together), *((i, "the of and to in is free") for i in range(50))]):
        got = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}[99]
        assert wanted <= set(got["starts"].split(",")), wanted - set(got["starts"].split(","))
        assert set(got["labels"].split(",")) == {t.label for t in licenses.TEMPLATES}
        assert got["score"] == pytest.approx(1.0)


def brute_alignments(texts):
    """(label, start, share) of every text: each template held against each start, without postings."""
    split = [WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), x or "")) for x in texts]
    idf = lambda word: math.log((len(texts) + 1) / (sum(word in x for x in split) + 1)) + 1
    out = []
    for words in split:
        joined, got = f" {' '.join(words)} ", []
        for t in licenses.TEMPLATES:
            wanted = WORD.findall(t.text.lower())
            if not all(f" {' '.join(WORD.findall(m))} " in joined for m in t.mandatory):
                continue
            weight = [idf(x) for x in wanted]
            for start in range(-len(wanted), len(words)):
                here = [0 <= start + k < len(words) and words[start + k] == x for k, x in enumerate(wanted)]
                share = sum(w for w, h in zip(weight, here) if h) / sum(weight)
                if share >= licenses.SHARE and sum(here) >= min(licenses.AGREE, len(set(wanted))):
                    got.append((start, t.label, share))
        out.append(sorted(got))
    return out


def test_alignments_are_those_of_every_start(spark):
    rng = random.Random(8)
    texts = [None, "", "the"]
    for _ in range(90):
        words = []
        for t in rng.choices(licenses.TEMPLATES, k=rng.randint(1, 3)):
            part = t.text.split()
            part = [x if rng.random() > rng.choice([0, 0.1, 0.4]) else rng.choice(["alpha", "the", "license"]) for x in part]
            words += rng.choices(["the", "of", "alpha", "license", "software"], k=rng.randint(0, 6))
            words += part[rng.choice([0, 0, 0, 2]):]     # some are cut off in front
        texts.append(" ".join(words))
    expected = brute_alignments(texts)
    assert sum(map(bool, expected)) > 30 and any(start < 0 for got in expected for start, *_ in got)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(2)
    for r in licenses.scan(docs).collect():
        got = expected[r["doc_id"]]
        assert r["starts"] == ",".join(f"{label}@{start}" for start, label, _ in got)
        base = set(filter(None, r["base_labels"].split(",")))
        assert r["labels"] == ",".join(sorted(base | {label for _, label, _ in got}))
        assert r["score"] == pytest.approx(max([share for *_, share in got] + [1.0 if base else 0.0]))
