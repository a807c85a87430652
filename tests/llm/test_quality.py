"""Quality rules against plain Python; divergence against numpy; no Python in the plan."""

import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from scoutlens.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    often = collections.Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 8)}
    return [len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered)]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(30)] + ["the", "of", "é☃", "a#b", "|", "X<y>"]
    out = [None, "", " \t\n\x0b ", "one", "a\na\n\na\n a", "x " * 20000, "\n".join(["same line here"] * 9)]
    for _ in range(80):
        words = rng.choices(vocabulary, k=rng.randint(0, 60))
        if rng.random() < 0.5 and len(words) > 10:
            at = rng.randrange(len(words) - 9)
            words += words[at:at + rng.randint(7, 20)] * rng.randint(1, 3)
        out.append("".join(w + rng.choice([" ", "\n", "\t ", "  "]) for w in words))
    return out


def test_counts_and_base_rules(spark, texts):
    rows = [(i, x, (None, "en", "de")[i % 3], 1, [2]) for i, x in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, words int, hits array<int>")
    docs = docs.unionByName(docs.where("doc_id = 4"))     # a repeated row
    got = quality.verdicts(docs).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        want = brute(texts[r["doc_id"]])
        assert [r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")] == want
        assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r["kept"] and r["base_failed"])
    assert quality.verdicts(docs.limit(0)).count() == 0


def js(p, q):
    p, q = np.array(p, float) / sum(p), np.array(q, float) / sum(q)
    m = (p + q) / 2
    kl = lambda a: sum(x * np.log2(x / y) for x, y in zip(a, m) if x > 0)
    return (max(kl(p) + kl(q), 0) / 2) ** 0.5


def test_distance_is_jensen_shannon(spark):
    a, b = [3, 0, 5, 2], [1, 4, 0, 5]
    df = spark.createDataFrame([(a, [x / 10 for x in b])], "n array<int>, q array<double>")
    assert df.select(quality.distance(F.col("n"), F.col("q"))).first()[0] == pytest.approx(js(a, b))
    empty = spark.createDataFrame([([0, 0], [0.5, 0.5])], "n array<int>, q array<double>")
    assert empty.select(quality.distance(F.col("n"), F.col("q"))).first()[0] is None


def test_strange_text_goes_and_usual_text_stays(spark):
    rng = random.Random(9)
    common = ["the", "of", "and", "to", "in", "is", "that", "for"]
    usual = lambda: " ".join(rng.choice(common) if rng.random() < 0.4 else f"word{rng.randint(0, 3000)}" for _ in range(150))
    texts = [usual() for _ in range(120)]
    strange = [" ".join(f"{rng.randint(0, 10**6)} %%" for _ in range(100)),
               " ".join(f"W{rng.randint(0, 3000)}!!".upper() + "QRS" for _ in range(150))]
    docs = spark.createDataFrame([(i, x, "en") for i, x in enumerate([*texts, *strange, "short 12 %%"])],
                                 "doc_id long, text string, lang string")
    kept = {r["doc_id"] for r in quality.verdicts(docs).where("kept").collect()}
    assert kept == set(range(120))


def test_no_python_in_the_plan(spark, texts):
    docs = spark.createDataFrame([(1, "a b", "en")], "doc_id long, text string, lang string")
    for df in (quality.common_words(docs), quality.counts(docs.withColumnRenamed("doc_id", "key")), quality.verdicts(docs)):
        plan = df._jdf.queryExecution().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def bins(text, common):
    """Histograms of one text: character classes and the rest of ASCII; common words and all others."""
    words = WORD.findall(text)
    classes = [r"[a-z]", r"[A-Z]", r"[0-9]", r"[\x20\x09-\x0D]", r"[#*$%&|<>]", r"[^\x00-\x7F]"]
    chars = [len(re.findall(c, text)) for c in classes]
    hits = [sum(w.lower() == c for w in words) for c in common]
    return [*chars, len(text) - sum(chars)], [*hits, len(words) - sum(hits)]


def test_common_words_and_verdict_by_brute_force(spark):
    rng = random.Random(12)
    vocabulary = {"en": [f"w{i}" for i in range(400)], "fr": [f"é{i}" for i in range(50)], "xx": ["a", "B", "b"]}
    rows = []
    for i in range(240):
        lang = rng.choice(["en", "en", "fr", "xx", None])
        words = vocabulary[lang or "fr"]
        body = [rng.choice(words[:rng.choice([5, len(words)])]) for _ in range(rng.randint(0, 160))]
        rows.append((i, rng.choice([" ", "\n", " # "]).join(w.upper() if rng.random() < 0.1 else w for w in body), lang))
    rows += [(500, "", "empty"), (501, None, "empty")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    wanted = {}
    for lang in {r[2] for r in rows}:
        count = collections.Counter(w.lower() for _, t, g in rows if g == lang for w in WORD.findall(t or ""))
        wanted[lang] = sorted(sorted(count, key=lambda w: (-count[w], w))[:quality.COMMON])
    full = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    assert {r["lang"]: r["common"] for r in quality.common_words(full).collect()} == {g or "": w for g, w in wanted.items()}
    total = {}
    for _, t, g in rows:
        c, h = bins(t or "", wanted[g])
        a, b = total.setdefault(g, ([0] * 7, [0] * len(h)))
        total[g] = [x + y for x, y in zip(a, c)], [x + y for x, y in zip(b, h)]
    for r in quality.verdicts(docs).collect():
        _, text, lang = next(x for x in rows if x[0] == r["doc_id"])
        c, h = bins(text or "", wanted[lang])
        assert r["char_distance"] == (pytest.approx(js(c, total[lang][0])) if sum(c) else None)
        assert r["word_distance"] == (pytest.approx(js(h, total[lang][1])) if sum(h) else None)
        near = (sum(h) < quality.MIN_WORDS or r["word_distance"] <= quality.MAX_WORD_DISTANCE) and (
            sum(c) < quality.MIN_CHARS or r["char_distance"] <= quality.MAX_CHAR_DISTANCE)
        assert r["kept"] == (near and not r["base_failed"])


def test_bins_of_common_words_of_all_lengths(spark):
    """Words are looked for among the common words of their length, and counted from one sorted array."""
    rng = random.Random(3)
    known = ["a", "b", "de", "ß", "das", "été", "i̇x", "und", "oder", "x" * 30]
    texts = [" ".join(rng.choice(known + [k.upper() for k in known] + ["zz", "İX", "rare%d" % rng.randrange(99)]) for _ in range(rng.randrange(90)))
             for _ in range(40)] + ["", "zz"]
    docs = spark.createDataFrame([(i, "l", t) for i, t in enumerate(texts)], "key long, lang string, text string")
    common = quality.common_words(docs.where("key < 40"))
    words = common.first()["common"]
    rows = quality.histograms(quality.counts(docs).join(common, "lang")).select("key", "text", "hits").collect()
    assert len(rows) == 42 and len(words) == quality.COMMON
    for r in rows:
        low = [w.lower() for w in r["text"].split()]
        assert r["hits"] == [low.count(w) for w in words] + [sum(w not in words for w in low)]
