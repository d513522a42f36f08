"""Collocations against counting every phrase in plain Python."""

import random
import re
from collections import Counter

import pytest

from landfall.llm import blocks, collocations as module
from landfall.llm.collocations import collocations

SCHEMA = "doc_id long, text string, lang string"


def plain(rows, longest=3, least=10, inside=50, top=2000):
    found = {}
    for _, text, lang in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^\x20\x09]+", piece)
            f = found.setdefault("und" if lang is None else lang, Counter())
            for k in range(1, longest + 1):
                f.update(" ".join(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in found.items():
        n = sum(c for w, c in f.items() if " " not in w)
        phrases = {p: a for p, a in f.items() if " " in p and a >= least}
        rows_of = []
        for phrase, a in phrases.items():
            if any(f" {phrase} " in f" {other} " and len(other) > len(phrase) and 100 * b >= inside * a
                   for other, b in phrases.items()):
                continue
            w = phrase.split(" ")
            cuts = [(10**6 * a * a // (f[" ".join(w[:k])] * f[" ".join(w[k:])]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            rows_of.append((phrase, a, f[" ".join(w[:k])], f[" ".join(w[k:])], n, score))
        rows_of.sort(key=lambda r: (-r[5], -r[1], r[0].encode()))
        out += [(lang, i + 1, *r) for i, r in enumerate(rows_of[:top])]
    return sorted(out)


def texts(seed, count):
    rng = random.Random(seed)
    words = ["a", "B", "cé", "d", "e", "ü", "Z", "ff", " x"]
    out = []
    for i in range(count):
        given = "".join(rng.choice(words) + rng.choice([" ", "  ", "\t", " ", ". ", ",", "\n", "\r\n"])
                        for _ in range(rng.randint(0, 60)))
        out.append((i, given, rng.choice(["en", "de", None, ""])))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("longest", [2, 3, 4])
def test_equals_counting(spark, seed, longest, monkeypatch):
    monkeypatch.setattr(module, "gathered", lambda *a: blocks.gathered(*a, 300))  # many blocks
    rows = texts(seed, 120)
    rows += rows[:5]  # repeated rows count again
    rows += [(None, None, None), (7, "", "en"), (8, " \t ", None), (9, "a " * 5000, "en"), (9, "und alone", "und")]
    got = collocations(spark.createDataFrame(rows, SCHEMA).repartition(4), longest=longest)
    assert sorted(map(tuple, got.collect())) == plain(rows, longest)


def test_first_of_each_language(spark):
    rows = texts(5, 200)
    got = collocations(spark.createDataFrame(rows, SCHEMA), top=3, least=5, inside=80)
    assert sorted(map(tuple, got.collect())) == plain(rows, top=3, least=5, inside=80)


def test_products_beyond_64_bits(spark, monkeypatch):
    """Counts of 10^10: their products have 26 digits, exactly floored."""
    rows = [(i, "a b", "en") for i in range(12)] + [(i, "a c a", "en") for i in range(9)]
    k, real = 1000000007, module.group_counts
    monkeypatch.setattr(module, "group_counts", lambda relation, least: real(relation, least).selectExpr(
        "lang", "word", f"a * {k} as a"))
    got = [tuple(r) for r in collocations(spark.createDataFrame(rows, SCHEMA)).select(
        "phrase", "a", "l", "r", "score").collect()]
    assert ("a b", 12 * k, 30 * k, 12 * k, 10**6 * 12 * 12 // (30 * 12)) in got


def test_hashes_that_clash_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(module, "HASH_BITS", 4)
    rows = texts(6, 100)
    assert sorted(map(tuple, collocations(spark.createDataFrame(rows, SCHEMA)).collect())) == plain(rows)


def test_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(module, "RANGE_GROUPS", 50)
    rows = texts(7, 100)
    assert sorted(map(tuple, collocations(spark.createDataFrame(rows, SCHEMA)).collect())) == plain(rows)


def test_nothing_to_find(spark):
    columns = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    for rows in ([], [(1, None, None)], [(1, "a. b. " * 30, "en")]):
        got = collocations(spark.createDataFrame(rows, SCHEMA))
        assert got.columns == columns and got.count() == 0


def test_other_columns_do_not_matter(spark):
    rows = texts(9, 80)
    frame = spark.createDataFrame(rows, SCHEMA)
    crowded = frame.selectExpr("*", "1 as block", "'w' as word", "2 as n", "3 as code", "4 as codes", "5 as rank")
    assert sorted(map(tuple, collocations(crowded).collect())) == plain(rows)
