"""Repeated byte strings against a count of every window."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from made_texts import words

from landfall.llm import suffix_dedup as module
from landfall.llm.suffix_dedup import anchors, remove_repeats, repeated_starts, suffix_dedup


def brute(texts, window):
    raw = [(text or "").encode() for text in texts]
    count = Counter(r[i:i + window] for r in raw for i in range(len(r) - window + 1))
    for r in raw:
        gone = np.zeros(len(r), bool)
        for i in range(len(r) - window + 1):
            if count[r[i:i + window]] > 1:
                gone[i:i + window] = True
        kept = bytes(np.frombuffer(r, np.uint8)[~gone])
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        yield len(r), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept


def texts():
    rng = random.Random(4)
    shared = [words(rng, 60, "abcdéñ") for _ in range(5)]
    out = [None, "", "short", "a" * 450, "ab" * 300, shared[0], shared[0], shared[0][1:]]
    for _ in range(60):
        parts = [words(rng, rng.randint(1, 90))]
        for _ in range(rng.randint(0, 3)):
            passage = rng.choice(shared)
            cut = rng.randrange(0, 120)
            parts += [passage[cut:], words(rng, rng.randint(1, 60))]
        out.append("\n".join(parts))
    return out


@pytest.mark.parametrize("most", [20_000, 1])
def test_every_repeated_byte_goes_and_no_other(spark, monkeypatch, most):
    monkeypatch.setattr(module, "MOST", most)
    given = texts()
    rows = spark.createDataFrame(list(enumerate(given)), "doc_id long, text string").repartition(5)
    got = {r.doc_id: r for r in suffix_dedup(rows).collect()}
    cut = {r.doc_id: r.text for r in remove_repeats(rows).collect()}
    for i, want in enumerate(brute(given, 200)):
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, got[i].kept_sha256) == want[:4]
        assert cut[i] == (None if given[i] is None else want[4].decode("utf-8", "ignore"))


def test_columns_of_symbols_give_the_repeated_windows():
    rng = random.Random(1)
    for _ in range(150):
        window = rng.choice([3, 5, 8])
        letters = rng.choice([b"ab", b"abc", bytes(range(256)), b"a"])
        strings = [bytes(rng.choice(letters) for _ in range(rng.randint(window, window + 20)))
                   for _ in range(rng.randint(1, 12))]
        group = np.sort([rng.randint(0, 2) for _ in strings])
        at = np.array([rng.randrange(len(s)) for s in strings])
        count = Counter((g, i - a, s[i:i + window]) for g, a, s in zip(group, at, strings)
                        for i in range(len(s) - window + 1))
        want = [[i for i in range(len(s) - window + 1) if count[g, i - a, s[i:i + window]] > 1]
                for g, a, s in zip(group, at, strings)]
        assert [x.tolist() for x in repeated_starts(strings, group, at, window)] == want


def test_equal_windows_have_equal_anchors_and_each_has_one(monkeypatch):
    monkeypatch.setattr(module, "_PIECE", 100)
    rng = np.random.default_rng(2)
    passage = rng.integers(0, 256, 260).astype(np.uint8)
    owner = []
    for before in (0, 37, 310):
        raw = np.concatenate([rng.integers(0, 256, before).astype(np.uint8), passage])
        keys, starts, counts, at = anchors(raw)
        assert (np.repeat(starts, counts) + np.concatenate([np.arange(c) for c in counts])
                == np.arange(len(raw) - 199)).all()
        own = np.stack([np.repeat(keys, counts).view(np.int64),
                        np.repeat(starts + at, counts) - np.arange(len(raw) - 199)])
        owner.append(own[:, before:before + 61])
    assert (owner[0] == owner[1]).all() and (owner[0] == owner[2]).all()
