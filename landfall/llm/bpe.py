"""Byte-pair encoding of whole texts by a walk over the trie of their distinct words.

The encoding of a prefix is known by its last token: the one token that ends there, is
its own encoding, and may follow the last token of what stands before it (two tokens may
stand together if encoding their joint text gives just these two). So a state per trie node, the
last token, is all an encoding needs. Sorted distinct words are the trie's depth-first order:
a stack holds the states of the current path, a word keeps those of the prefix it shares
with the word before, and encodings of shared prefixes are found once. A state is found when
a longer prefix first asks for it, so nodes at which no likely token starts cost nothing.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm import arrays
from landfall.llm.common import text_rows, which_text

PIECE = 1 << 20         # bytes of text whose words are sorted together
WORDS = 250_000         # encoded words a task keeps
PAIRS = 250_000         # verdicts on pairs a worker keeps
DEEP = 200              # letters up to which states are found as they are asked for
END = "</w>"


def byte_letters() -> list[str]:
    """The printable character that stands for each byte: itself, or the next beyond U+00FF."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in set(shown) else chr(next(spare)) for b in range(256)]


def _unassigned() -> str:
    """Characters that newer tables call letters and the vocabulary's library does not know."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    new = [ord(c) for c in regex.findall(r"\p{L}", every) if unicodedata.category(c) == "Cn"]
    starts = [c for i, c in enumerate(new) if not i or new[i - 1] != c - 1]
    ends = [c for i, c in enumerate(new) if i + 1 == len(new) or new[i + 1] != c + 1]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(starts, ends)) or r"\x00"


class Vocabulary:
    """A vocabulary file of byte pairs with word ends, and what a worker has learned of it."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        model = told["model"]
        if model["end_of_word_suffix"] != END or model["unk_token"] is not None:
            raise ValueError("not a vocabulary of byte pairs with word ends")
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in told["added_tokens"]}
        self.names = {i: t for t, i in [*self.ids.items(), *self.special.items()]}
        self.ranks = {tuple(m if isinstance(m, list) else m.split(" ")): r
                      for r, m in enumerate(model["merges"])}
        # How each token is made: its rank and its two parts. A token has one merge, so
        # whatever merges it further has a higher rank than it has.
        self.made = {a + b: (r, a, b) for (a, b), r in self.ranks.items()}
        # The two splitting rules of the file: letters, single digits, runs of the rest.
        split = told["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(split.replace(r"\p{L}", rf"[\p{{L}}--[{_unassigned()}]]"), regex.V1)
        self.latin_words = regex.compile(split)     # faster, the same below U+0250
        self.beyond_latin = regex.compile(r"[^\x00-\u024f]")
        # As chunks, special tokens have a blank before them: text that only reads so in lower case has none.
        self.marked = {" " + t: chr(i) for t, i in self.special.items()}
        self.marks = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        # Ids travel as the characters of these numbers, which UTF-32 writes as the ids.
        self.codes = {t: chr(i) for t, i in self.ids.items()}
        self.spoken = {i: t + " " for i, t in self.names.items()}
        # Of what tokens end with: the tokens it ends with itself, longest first; for tokens
        # that go on, and for those that end a word (by their letters).
        self.inner = self._tails([t for t in self.ids if not t.endswith(END)], "")
        self.ends = self._tails([t.removesuffix(END) for t in self.ids if t.endswith(END)], END)
        self.table = dict(enumerate(byte_letters()))
        self.pairs: dict[tuple[str, str], bool] = {}
        self.own: dict[str, bool] = {}
        # Encoded words: those met of late, and the generation before them.
        self.known: dict[str, str] = {}
        self.older: dict[str, str] = {}

    @staticmethod
    def _tails(bare: list[str], end: str) -> dict[str, tuple[tuple[int, str], ...]]:
        """By tail: lengths and tokens."""
        tokens = {t: t + end for t in bare}
        out: dict[str, tuple[tuple[int, str], ...]] = {"": ()}
        for t in bare:
            for k in range(len(t) - 1, -1, -1):
                tail = t[k:]
                if tail not in out:
                    shorter = out[tail[1:]]
                    out[tail] = ((len(tail), tokens[tail]), *shorter) if tail in tokens else shorter
        return out

    def merged(self, symbols: list[str]) -> list[str]:
        """Plain merging, least rank first; only for the short texts of one or two tokens."""
        while len(symbols) > 1:
            ranks = [self.ranks.get(p, 1 << 30) for p in zip(symbols, symbols[1:])]
            least = min(ranks)
            if least == 1 << 30:
                break
            out, i = [], 0
            while i < len(symbols):
                if i < len(ranks) and ranks[i] == least:
                    out.append(symbols[i] + symbols[i + 1])
                    i += 2
                else:
                    out.append(symbols[i])
                    i += 1
            symbols = out
        return symbols

    @staticmethod
    def symbols(token: str) -> list[str]:
        if token.endswith(END):
            bare = token[:-len(END)]
            return [*bare[:-1], bare[-1] + END]
        return list(token)

    def is_token(self, token: str) -> bool:
        found = self.own.get(token)
        if found is None:
            found = token in self.ids and self.merged(self.symbols(token)) == [token]
            if token in self.ids:
                self.own[token] = found
        return found

    def may_follow(self, left: str, right: str) -> bool:
        pair = (left, right)
        found = self.pairs.get(pair)
        if found is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            found = self.pairs[pair] = self._stand_together(left, right)
        return found

    def _stand_together(self, left: str, right: str) -> bool:
        """Whether no merge joins the two on the way to both, going back in time: each step
        takes apart the one that was made last. Of equal ranks the merge further left goes first."""
        ranks, base = self.ranks, (-1, "", "")
        if (left, right) in ranks:
            return False
        while True:
            one, two = self.made.get(left, base), self.made.get(right, base)
            if one[0] > two[0]:
                left = one[2]
                if ranks.get((left, right), one[0]) < one[0]:
                    return False
            elif two[0] >= 0:
                right = two[1]
                if ranks.get((left, right), two[0] + 1) <= two[0]:
                    return False
            else:
                return True

    def _last(self, path: list[str], text: str, size: int, tails: dict) -> str:
        """The last token of a text's first letters. The path holds those of shorter
        prefixes, empty where not yet found."""
        pairs, start = self.pairs, size - 1
        found = longer = tails.get(text[start:size], ())
        while start and longer is not None:
            found, start = longer, start - 1
            longer = tails.get(text[start:size])
        for length, token in longer or found:
            at = size - length
            if not at:
                if self.own.get(token) or self.is_token(token):
                    return token
                continue
            left = path[at]
            if not left:
                left = path[at] = self._last(path, text, at, self.inner)
            known = pairs.get((left, token))
            if known or known is None and self.is_token(token) and self.may_follow(left, token):
                return token
        raise ValueError(f"no encoding of {text[:size]!r}")

    def learn(self, words: set[str]) -> None:
        """Encode distinct words in the trie's depth-first order."""
        table, codes, inner, ends = self.table, self.codes, self.inner, self.ends
        # Printable ASCII letters stand for themselves.
        mapped = sorted([(word if word.isascii() and word.isprintable()
                          else word.encode().decode("latin-1").translate(table), word) for word in words])
        # By depth: the last token of the first letters, empty where not yet found.
        path, before = [""], ""
        for text, word in mapped:
            size = len(text)
            shared, most = 0, min(len(path), size) - 1
            while shared < most and before[shared] == text[shared]:
                shared += 1
            path[shared + 1:] = [""] * (size - 1 - shared)
            if size > DEEP:     # else prefixes would ask for one another too deeply
                for depth in range(1, size):
                    path[depth] = path[depth] or self._last(path, text, depth, inner)
            token = self._last(path, text, size, ends)
            out, at = [codes[token]], size - (len(token) - len(END))
            while at:
                token = path[at]
                out.append(codes[token])
                at -= len(token)
            self.known[word] = "".join(out[::-1])
            before = text

    def split(self, text: str) -> list[str]:
        """What a text holds between blanks, composed and in lower case; special tokens apart."""
        if "<|" not in text:
            return self._chunks(self.normal(text))
        out: list[str] = []
        for k, part in enumerate(self.marks.split(text)):
            out += [" " + part] if k % 2 else self._chunks(self.normal(part))
        return out

    def _chunks(self, text: str) -> list[str]:
        # Python takes four more characters for blanks than the vocabulary does.
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return self._findall(text)
        return text.split()

    def _findall(self, text: str) -> list[str]:
        return (self.words if self.beyond_latin.search(text) else self.latin_words).findall(text)

    @staticmethod
    def normal(text: str) -> str:
        """Composed and in lower case, a letter at a time: a final sigma is a sigma.
        Blanks need no change, as no word holds any."""
        if text.isascii():
            return text.lower()
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def _parts(self, chunk: str) -> list[str]:
        """The words of a chunk; letters with a mark or none behind, as most are, need no pattern."""
        core = chunk.rstrip(".,;:!?")
        if core.isalpha():
            return [chunk] if core == chunk else [core, chunk[len(core):]]
        return self._findall(chunk)

    def _recall(self, wanted: set[str]) -> set[str]:
        """Take what the older generation knows over to the later one; the rest."""
        fresh = wanted.difference(self.known)
        again = fresh & self.older.keys()
        self.known.update({chunk: self.older[chunk] for chunk in again})
        return fresh - again

    def _know(self, chunks: set[str]) -> None:
        """Encode chunks that are not known: their words first, each once."""
        parts = {chunk: self._parts(chunk) for chunk in chunks.difference(self.marked)}
        self.learn(self._recall(set().union(*parts.values())))
        known = self.known
        for chunk, words in parts.items():
            if words != [chunk]:
                known[chunk] = "".join([known[word] for word in words])
        for token in chunks & self.marked.keys():
            known[token] = self.marked[token]

    def encode(self, texts: list[str]) -> Iterator[tuple[bytes, str]]:
        """The ids (unsigned, 32 bits, little-endian) and the decoded text of each text."""
        split = [self.split(text) for text in texts]
        wanted = set().union(*split)
        if len(self.known) + len(wanted.difference(self.known)) > WORDS:
            self.older, self.known = self.known, {}
        self._know(self._recall(wanted))
        for chunks in split:
            ids = "".join(map(self.known.__getitem__, chunks))
            yield ids.encode("utf-32-le", "surrogatepass"), ids.translate(self.spoken)[:-1]

    def decode(self, ids: bytes) -> str:
        """The text of ids: tokens as the vocabulary writes them, a space between."""
        return " ".join([self.names[i] for i in np.frombuffer(ids, "<u4").tolist()])


_LOADED: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary, read once by each worker."""
    if path not in _LOADED:
        _LOADED[path] = Vocabulary(path)
    return _LOADED[path]


def _encode(path: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            texts = list(arrays.raw_texts(batch.column("_text")))
            texts = [text or b"" for text in texts]
            counts, ids_hash, text_hash, kept = [], [], [], []
            for start, end in arrays.pieces(texts, PIECE):
                for ids, decoded in vocab.encode([text.decode() for text in texts[start:end]]):
                    counts.append(len(ids) // 4)
                    ids_hash.append(hashlib.sha256(ids).hexdigest())
                    text_hash.append(hashlib.sha256(decoded.encode()).hexdigest())
                    if with_ids:
                        kept.append(np.frombuffer(ids, "<u4").astype(np.int32))
            columns = [batch.column("_id"), pa.array(counts, pa.int64()), pa.array(ids_hash, pa.string()),
                       pa.array(text_hash, pa.string()), batch.column("which")]
            names = ["_id", "n_tokens", "ids_sha256", "decoded_sha256", "_which"]
            if with_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", *,
           with_ids: bool = False) -> DataFrame:
    """Token ids of every whole text and what they decode to.

    ``path`` names the vocabulary file, which every executor must have at that place. Returns
    one row per row of ``df``: the id, ``n_tokens``, ``ids_sha256`` (of the ids as little-endian
    unsigned 32-bit numbers), ``decoded_sha256``, ``_which`` (a hash of the text) and, with
    ``with_ids``, the ``ids``. A null text counts as empty and has no tokens; the strings of
    special tokens inside a text become those tokens. Repeated rows are encoded alike; an
    empty table gives no rows.
    """
    rows = text_rows(df, id_col, text_col).select("_id", which_text().alias("which"), "_text")
    schema = "_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, _which int"
    return rows.mapInArrow(_encode(path, with_ids), schema + ", ids array<int>" * with_ids
                           ).withColumnRenamed("_id", id_col)


def decode(df: DataFrame, path: str, ids_col: str = "ids", into: str = "decoded") -> DataFrame:
    """``df`` with the text that its ``ids`` (arrays of numbers) decode to; null ids give null, and
    a number that is no token raises. A column called ``into`` is replaced."""

    @F.pandas_udf("string")
    def decoded(ids):
        vocab = vocabulary(path)
        return ids.map(lambda row: None if row is None else vocab.decode(np.asarray(row, "<u4").tobytes()))

    return df.withColumn(into, decoded(F.col(ids_col).cast("array<int>")))
