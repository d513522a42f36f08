"""Encoding and decoding against the tokenizers library, whose vocabulary it is."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from made_texts import words
from tokenizers import Tokenizer

from landfall.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts():
    rng = random.Random(3)
    out = ["", "  \n", "<|endoftext|> Hi<|startoftext|>", "ΣΊΣΥΦΟΣ ς İstanbul ǅ ﬁ", "日本語テキスト 一二三 ½ ² Ⅷ ٣",
           "é É naïve I'll don't we've'S 'LL", "😀😀 a😀b ​ x\u0085y", "ª_º __init__ a1b2", "x" * 500,
           "ab" * 300, "\x00\x1c\x1d a", "ﬀ ẞ ß ŉ", "Ⓐ ⓐ Å K Ω", words(rng, 900, "etaoinshrdlu")]
    ranges = [(32, 127), (32, 127), (0xA0, 0x250), (0x370, 0x600), (0x900, 0x3000), (0x1F300, 0x1F700)]
    return out + ["".join(chr(rng.randrange(*rng.choice(ranges))) for _ in range(60)) for _ in range(200)]


def test_ids_and_texts_are_the_librarys(spark, library):
    given = texts()
    rows = spark.createDataFrame([*enumerate(given), (-1, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in bpe.encode(rows, PATH, with_ids=True).collect()}
    for i, text in enumerate(given):
        ids = library.encode(text, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert got[i].ids == ids and got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
    assert got[-1].n_tokens == 0
    back = bpe.decode(bpe.encode(rows, PATH, with_ids=True), PATH)
    assert {r.doc_id: r.decoded for r in back.collect()}[13] == library.decode(got[13].ids, skip_special_tokens=False)


def test_two_tokens_stand_together_if_merging_their_text_gives_them():
    vocab, rng = bpe.Vocabulary(PATH), random.Random(9)
    tokens = [t for t in vocab.ids if vocab.merged(vocab.symbols(t)) == [t]]
    assert len({a + b for a, b in vocab.ranks}) == len(vocab.ranks)
    inner = [t for t in tokens if not t.endswith(bpe.END)]
    near = [t for t in inner if len(t) < 4]
    for k in range(6000):
        left, right = rng.choice(near if k % 2 else inner), rng.choice(tokens if k % 3 else near)
        together = vocab.merged(vocab.symbols(left) + vocab.symbols(right)) == [left, right]
        assert vocab.may_follow(left, right) == together, (left, right)


def test_a_full_memory_changes_nothing(monkeypatch, library):
    monkeypatch.setattr(bpe, "WORDS", 50)
    monkeypatch.setattr(bpe, "PAIRS", 20)
    vocab = bpe.Vocabulary(PATH)
    for text in texts()[10:40]:
        (ids, _), = vocab.encode([text])
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_states_are_found_only_when_asked_for(monkeypatch, library):
    vocab, rng, calls = bpe.Vocabulary(PATH), random.Random(5), []
    last = vocab._last
    monkeypatch.setattr(vocab, "_last", lambda *told: calls.append(0) or last(*told))
    given = words(rng, 2000, ["th", "er", "on", "ing", "and", "re", "tion", "es"]).split()
    for word, (ids, _) in zip(given, vocab.encode(given)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(word, add_special_tokens=False).ids
    nodes = {word[:k] for word in given for k in range(1, len(word) + 1)}
    assert len(calls) < 0.75 * len(nodes)


def test_words_of_the_older_generation_are_not_learned_again(monkeypatch):
    vocab, learned, learn = bpe.Vocabulary(PATH), [], bpe.Vocabulary.learn
    monkeypatch.setattr(bpe, "WORDS", 3)
    monkeypatch.setattr(vocab, "learn", lambda new: learned.extend(new) or learn(vocab, new))
    for text in ["harbour one two", "harbour, one!"]:
        list(vocab.encode([text]))
    assert sorted(learned) == ["!", ",", "harbour", "one", "two"]


def test_letters_need_no_pattern():
    vocab = bpe.Vocabulary(PATH)
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for c in every:
        if not c.isspace():
            assert vocab._parts(f"a{c}b,") == vocab._findall(f"a{c}b,"), hex(ord(c))


@pytest.mark.parametrize("letters", ["etaoinshrdlu", "ab", "xyé日"])
def test_long_words(library, letters):
    vocab, rng = bpe.Vocabulary(PATH), random.Random(7)
    sizes = [bpe.DEEP - 1, bpe.DEEP, bpe.DEEP + 1, 3 * bpe.DEEP]
    given = ["".join(rng.choices(letters, k=n)) for n in sizes for _ in range(20)]
    given += [given[-1][:n] + "ing" for n in range(bpe.DEEP - 9, bpe.DEEP + 9)]
    for word, (ids, decoded) in zip(given, vocab.encode(given)):
        want = library.encode(word, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert decoded == library.decode(want, skip_special_tokens=False)


def test_special_tokens_are_told_apart_by_case(library):
    vocab = bpe.Vocabulary(PATH)
    given = ["a <|ENDOFTEXT|> b", "<|EndOfText|>", "<|endoftext|><|Startoftext|>", "<|<|endoftext|>|>"]
    for text, (ids, decoded) in zip(given, vocab.encode(given)):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert decoded == library.decode(want, skip_special_tokens=False)
