"""Classifiers: accuracy on rows that were not learned from, constraints, expressions."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from made_texts import words
from pyspark.sql import functions as F

from landfall.llm import boosting, ordinal
from landfall.llm.language_id import language_id, subword_counts
from landfall.llm.quality_classifier import quality_classifier
from landfall.llm.quality_rules import STATISTICS, counts_and_statistics, fit_quality, quality_rules
from landfall.llm.toxicity import toxicity
from landfall.llm.url_filter import (
    RULES, UrlModel, features, host_of, path_of, suffix_counts, tree_score, url_filter)

LETTERS = {"aa": "aeioulmn", "bb": "xyzkrtua", "cc": "éèàosdfg"}


@pytest.fixture(scope="module")
def tongues(spark):
    rng = random.Random(1)
    rows = [(i, words(rng, rng.randint(5, 60), LETTERS[lang]), lang)
            for i in range(300) for lang in [rng.choice(list(LETTERS))]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_languages_of_rows_held_out(tongues):
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    got = language_id(tongues, held_out).join(tongues.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert held and sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_labels_of_rows_held_out_do_not_matter(tongues):
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    changed = tongues.withColumn("lang", F.when(held_out, "zz").otherwise(F.col("lang")))
    one, two = language_id(tongues, held_out), language_id(changed, held_out)
    assert one.exceptAll(two).count() == 0


def test_subwords_are_counted_over_the_whole_text():
    text = words(random.Random(2), 90_000).encode()
    assert subword_counts(text).sum() == 2 * len(text) - 5


def brute_counts(text):
    found = re.findall("[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(found[i:i + 3]) for i in range(len(found) - 2))
    covered = {i + k for i in range(len(found) - 2) if grams[tuple(found[i:i + 3])] > 1 for k in range(3)}
    return (len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered))


def test_base_counts_against_plain_python():
    rng = random.Random(7)
    pool = ["a", "b", "é#", "日本*", "c|d", "\u00a0x", "<e>"]
    for _ in range(300):
        text = "".join(rng.choice(pool) + rng.choice([" ", "  ", "\n", "\t", " \n ", "\x0b"])
                       for _ in range(rng.randint(0, 40)))
        assert counts_and_statistics(text.encode())[0] == brute_counts(text)


def graded(spark, seed, bad):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(400):
        text, grade = words(rng, rng.randint(60, 90), "abcdefghijk").split(), rng.randint(0, 2)
        for at in rng.sample(range(len(text)), 12 * grade):
            text[at] = bad(rng, text[at])
        rows.append((i, " ".join(text)))
        if i % 2:
            labels.append((i, grade))
    return (spark.createDataFrame(rows, "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, grade int"), dict(labels))


def test_trees_learn_the_rules_and_keep_their_constraints(spark):
    df, grades, _ = graded(spark, 3, lambda rng, word: word + "***")
    labels = grades.select("doc_id", (F.col("grade") == 0).cast("int").alias("quality"))
    model = fit_quality(df, labels)
    got = quality_rules(df, model).collect()
    assert all(r.kept == (r.n_symbols == 0) for r in got if not r.base_failed)
    rng = np.random.default_rng(0)
    rows = rng.random((300, len(STATISTICS)))
    for f, sign in enumerate(STATISTICS.values()):
        more = rows.copy()
        more[:, f] += rng.random(300)
        if sign:
            assert (sign * (model.margin(more) - model.margin(rows)) >= -1e-12).all()


def test_constraints_hold_where_the_labels_break_them():
    rng = np.random.default_rng(4)
    rows = rng.random((800, 2))
    labels = (np.sin(9 * rows[:, 0]) + rows[:, 1] > 0.5).astype(float)
    free = boosting.fit(rows, labels, monotone=np.zeros(2, int))
    held = boosting.fit(rows, labels, monotone=np.array([-1, 1]))
    line = np.stack([np.linspace(0, 1, 200), np.full(200, 0.4)], axis=1)
    assert (np.diff(held.margin(line)) <= 1e-12).all() and (np.diff(free.margin(line)) > 0).any()
    assert ((free.margin(rows) > 0) == labels).mean() > 0.95


@pytest.mark.parametrize("apply, column, names", [
    (quality_classifier, "expected_grade", ("expected_grade", "tail", "selected", "_which")),
    (toxicity, "severity", ("severity", "tail", "toxic", "_which")),
])
def test_grades_are_ranked_on_texts_not_learned_from(spark, apply, column, names):
    df, labels, known = graded(spark, 5, lambda rng, word: rng.choice(["scum", "clown", "idiot"]))
    out = apply(df, labels, grade_col="grade")
    assert out.columns == ["doc_id", *names]
    got = {r.doc_id: r for r in out.collect()}
    fresh = [r for i, r in got.items() if i not in known]
    texts = {r.doc_id: r.text for r in df.collect()}
    truth = [len(re.findall("scum|clown|idiot", texts[r.doc_id])) for r in fresh]
    assert np.corrcoef(truth, [r[column] for r in fresh])[0, 1] > 0.8
    assert all(0 <= r[column] <= 2 and 0 <= r["tail"] <= 1 for r in got.values())


def test_thresholds_are_ordered():
    rng = np.random.default_rng(1)
    grades = rng.integers(0, 4, 300)
    texts = [(np.array([g, 4 + rng.integers(0, 4)]), np.ones(2)) for g in grades]
    model = ordinal.train(texts, grades.tolist(), 8)
    assert (np.diff(model.thresholds) >= 0).all()
    scores = np.array([model.weights[ids] @ x for ids, x in texts])
    assert np.corrcoef(model.expected(scores), grades)[0, 1] > 0.9


URLS = [
    None, "", "no scheme/de/", "http://Example.ORG/es/1", "https://a.example.org/en/12?x=/de/", "http://org/",
    "http://notexample.org/es/", "http://x.com/fr/", "http://x.com?/fr/", "https://x.com/de/#a", "http://x.net/de/",
    "ftp://COM/de/y", "http://y.com", "://com/fr/", "http://example.org/en/2", "a://b://c.org/",
]


def brute_rule(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match("(?s)[^/?#]*", rest).group()
    path = re.match("(?s)[^?#]*", rest[len(host):]).group()
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.name), default=None)
    return host, path, best


def test_rules_against_plain_python(spark):
    df = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    for r in url_filter(df).collect():
        host, path, rule = brute_rule(URLS[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule and rule.name)
        assert r.verdict in ("allow", "block") and (rule is None or r.verdict == rule.verdict)


def test_the_trees_as_an_expression_score_as_in_numpy(spark):
    rng = np.random.default_rng(2)
    rows = rng.random((300, 3))
    trees = boosting.fit(rows, (rows[:, 0] * rows[:, 1] > 0.2).astype(float), monotone=np.zeros(3, int), trees=9)
    df = spark.createDataFrame([tuple(map(float, row)) for row in rows], "a double, b double, c double")
    got = [r[0] for r in df.select(tree_score(trees, [F.col(c) for c in "abc"])).collect()]
    assert np.allclose(got, trees.margin(rows))


def test_url_features_and_learning(spark):
    urls = ([f"http://h{i % 7}.com/fr/{i}" for i in range(60)] + [f"http://h{i % 5}.com/de/{i}?p=1&q={i}&r=2" for i in range(60)]
            + ["http://new.net/xx/3?p=1&q=2&r=3", "http://new.net/xx/3"])
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: r for r in url_filter(df).collect()}
    assert got[120].verdict == "block" and got[121].verdict == "allow"
    told = features(F.lit("https://a-b.c1.org/x/y1?u=1&v=2#z?q"), F.lit("a-b.c1.org"), F.lit("/x/y1"))
    row = spark.range(1).select(*(v.alias(k) for k, v in told.items())).first()
    assert (row.labels, row.depth, row.hyphens, row.parameters, row.secure, row.ending_length) == (3, 2, 1, 2, 1, 3)
    assert row.host_digits == pytest.approx(0.1)
    share = np.array([2, 1, 1, 1, 1, 1, 1, 1, 1]) / 10
    assert row.entropy == pytest.approx(-(share * np.log2(share)).sum())
    assert UrlModel._fields[0] == "trees"


def test_suffixes_are_counted_over_all_rows_and_samples_drawn_from_distinct_urls(spark):
    # More suffixes than a small sample holds: what is blocked shows in the suffix alone.
    urls = [f"http://{kind}.s{i}.com/{path}/{j}" for i in range(300) for j in range(9)
            for kind, path in [("a", "fr") if i % 2 else ("b", "de")]]
    open_ = [f"http://{'ab'[i % 2 == 0]}.s{i}.com/xx/1" for i in range(300)]
    # A URL with more rows than the sample has places.
    urls += ["http://hot.com/fr/0"] * 3000
    df = spark.createDataFrame(list(enumerate(urls + open_)), "page_id long, url string")
    labelled = df.select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
                         F.col("url").contains("/de/").alias("blocked")).where("path not like '/xx/%'")
    counts = {r.suffix: (r.n, r.bad) for r in suffix_counts(labelled).collect()}
    assert counts == {f"s{i}.com": (9, 9 * (i % 2 == 0)) for i in range(300)} | {"hot.com": (3000, 0)}
    got = {r.page_id: r for r in url_filter(df, train_rows=200).collect()}
    assert len(got) == len(urls) + 300
    verdicts = [got[len(urls) + i].verdict for i in range(300)]
    assert verdicts == [("block", "allow")[i % 2] for i in range(300)]


@pytest.mark.parametrize("hot", [range(8), ()])
def test_a_verdict_is_learned_though_the_sample_misses_it(spark, hot):
    urls = [f"http://h{i}.com/fr/{'' if i in hot else i}" for i in range(400)] + ["http://bad.com/de/1?a=1&b=2&c=3"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    assert all(r.score is not None for r in url_filter(df, train_rows=5).collect())
    same = spark.createDataFrame(list(enumerate(urls[:-1])), "page_id long, url string")
    assert all(r.score is None and r.verdict == "allow" for r in url_filter(same, train_rows=5).collect())


def test_a_row_that_repeats_is_learned_once(spark):
    """2,500 copies of the row that hashes lowest do not crowd out a language."""
    rng = random.Random(11)
    rows = [(words(rng, 40, letters), lang) for letters, lang in (("abcdehn", "en"), ("aouzsch", "de"))
            for _ in range(300)]
    frame = spark.createDataFrame(rows, "text string, lang string").withColumn("doc_id", F.monotonically_increasing_id())
    first = frame.orderBy(F.xxhash64("text", "lang")).first()
    many = frame.unionByName(spark.createDataFrame([first] * 2500, frame.schema))
    told = language_id(many, F.lit(False), sample=200)
    right = told.join(frame, "doc_id").selectExpr("avg(cast(lang_pred = lang as int)) a").first().a
    assert right > 0.95
