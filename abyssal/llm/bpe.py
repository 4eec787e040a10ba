"""BPE encoding and decoding with a deterministic tokenization automaton.

The automaton reads tokens. It starts with one state in which every base symbol may follow every other, and each merge a b -> c,
in order, adds its gadget: after a, b may no longer follow (its state is split off); wherever a may be read, c may be read too,
and c leads where b led. What is left are exactly the token sequences that applying the merges gives. A state is shared by copying
on write: it holds only the arcs its own gadgets took away, with the number of the merge, and the state it was split from.

A word is encoded from left to right, the longest arc first. For every position there is exactly one last token with which the
prefix is accepted, so a position that leads no further is never tried again: linear in the word's length for any word. No word and
no normalisation reaches across white space, so a task remembers what it encoded by the pieces between. Decoding emits arc labels.

Null texts count as empty and give no tokens. Texts of any length are encoded whole.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from hashlib import sha256
from itertools import chain

import pandas as pd
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abyssal.llm.batches import bound_batches, return_memory

# The byte alphabet of byte-level vocabularies, white space, and the word pattern of the vocabulary file.
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
SPACES = re.compile("[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+")
NO_SPACES = "\x1c\x1d\x1e\x1f"  # that `str.split` takes for white space

BEGIN = 4  # symbols that bound an arc's length
WORDS_KEPT = 400_000  # encoded words, and pieces of them, that a task remembers
PAIRS_KEPT = 2_000_000
TASK_KEEPS = 100_000, 500_000  # words and pairs where a task shares its worker's memory with other stages
TASK_BYTES = 1 << 20  # texts of a batch there: words, ids and decoded text of a batch take a multiple of it in Python


def byte_alphabet() -> dict[int, str]:
    """Printable bytes stand for themselves, the others for the characters from 256 on."""
    others = [b for b in range(256) if b not in set(PRINTABLE)]
    return {b: chr(b) for b in PRINTABLE} | {b: chr(256 + i) for i, b in enumerate(others)}


@dataclass
class Vocabulary:
    """What a tokenizer file says: tokens, merges, word suffix, word pattern and special tokens."""

    tokens: dict[str, int]
    merges: list[tuple[str, str]]
    suffix: str
    pattern: str
    special: dict[str, int]


def read_vocabulary(path: str) -> Vocabulary:
    """From a tokenizers file with NFC, white space and lower-case normalisation and a word pattern."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, steps = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    return Vocabulary(model["vocab"], merges, model["end_of_word_suffix"] or "", steps[0]["pattern"]["Regex"], special)


class Remembered(dict):
    """What a function gave, by its argument; forgotten when there are too many."""

    def __init__(self, function: Callable[[str], tuple], most: int):
        super().__init__()
        self.function, self.most = function, most

    def __missing__(self, key: str) -> tuple:
        found = self.function(key)
        if len(self) >= self.most:
            self.clear()
        self[key] = found
        return found


class TokenAutomaton:
    """States, arcs and labels compiled from the merges; encoder and decoder."""

    def __init__(self, vocabulary: Vocabulary, words_kept: int = WORDS_KEPT, pairs_kept: int = PAIRS_KEPT):
        self.pairs_kept, self.vocabulary = pairs_kept, vocabulary
        ids, alphabet = vocabulary.tokens, byte_alphabet()
        self.labels = [""] * (1 + max([*ids.values(), *vocabulary.special.values()]))
        for token, i in [*ids.items(), *vocabulary.special.items()]:
            self.labels[i] = token
        self.decimals = [str(i) for i in range(len(self.labels))]
        self.byte = [alphabet[b] for b in range(256)]
        self.removed: dict[tuple[int, int], int] = {}  # (state's token, arc): the merge whose gadget took the arc away
        self.parts: dict[int, tuple[int, int, int]] = {}  # token: left part, right part, merge
        self.readable = {s: ids[s] for c in alphabet.values() for s in (c, c + vocabulary.suffix) if s in ids}
        for rank, (a, b) in enumerate(vocabulary.merges):
            self._gadget(rank, ids[a], ids[b], a + b)
        self.longest: dict[str, int] = {}  # of the arcs that begin with these symbols
        for label in self.readable:
            symbols = label.removesuffix(vocabulary.suffix)
            if len(symbols) >= BEGIN:
                self.longest[symbols[:BEGIN]] = max(len(symbols), self.longest.get(symbols[:BEGIN], 0))
        self.known: dict[int, bool] = {}
        self.words = Remembered(self.encode_word, words_kept)
        self.pieces = Remembered(self._encode_piece, words_kept)
        self.listed = Remembered(self._list_piece, words_kept)
        self.listed_words = Remembered(self._list_word, words_kept)
        self.split = regex.compile(vocabulary.pattern)
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(vocabulary.special, key=len, reverse=True))) + ")") if vocabulary.special else None

    def _gadget(self, rank: int, a: int, b: int, label: str) -> None:
        if not self._follows(a, b):
            return  # an earlier gadget took the path away, so the merge never applies
        self.removed[a, b] = rank
        c = self.vocabulary.tokens[label]
        self.parts[c] = (a, b, rank)
        self.readable[label] = c

    def _follows(self, token: int, arc: int) -> bool:
        """Has the state after ``token`` the arc? Walks the states it was split from and the arcs the arc was made from."""
        state, state_until = token, None
        while True:
            read, read_until = arc, None
            while True:
                at = self.removed.get((state, read))
                if at is not None and (state_until is None or at < state_until) and (read_until is None or at <= read_until):
                    return False
                made = self.parts.get(read)
                if made is None:
                    break
                read, _, rank = made
                read_until = rank if read_until is None else min(rank, read_until)
            made = self.parts.get(state)
            if made is None:
                return True
            _, state, rank = made
            state_until = rank if state_until is None else min(rank, state_until)

    def follows(self, token: int, arc: int) -> bool:
        """`_follows`, as a transition table that is filled on first use."""
        key = token << 32 | arc
        found = self.known.get(key)
        if found is None:
            if len(self.known) > self.pairs_kept:
                self.known.clear()
            found = self.known[key] = self._follows(token, arc)
        return found

    def encode_word(self, word: str) -> tuple[int, ...]:
        """Tokens of one pre-split word."""
        text, read, suffix = "".join(map(self.byte.__getitem__, word.encode())), self.readable.get, self.vocabulary.suffix
        whole = read(text + suffix)
        if whole is not None:
            return (whole,)
        n, longest, known = len(text), self.longest.get, self.known.get
        out: list[int] = []
        begun: list[int] = []
        dead: set[int] = set()  # positions that lead no further
        start, end, last = 0, min(n, longest(text[:BEGIN], BEGIN - 1)), None
        while start < n:
            while end > start:
                arc = read(text[start:end] if end < n else text[start:] + suffix)
                if arc is not None and end not in dead:
                    if last is None:
                        break
                    follows = known(last << 32 | arc)
                    if self.follows(last, arc) if follows is None else follows:
                        break
                end -= 1
            else:
                if last is None:
                    raise ValueError("the vocabulary lacks a symbol of the text")
                dead.add(start)
                out.pop()
                last = out[-1] if out else None
                start, end = begun.pop(), start - 1
                continue
            out.append(arc)
            begun.append(start)
            start, last = end, arc
            end = start + longest(text[start : start + BEGIN], BEGIN - 1)
            if end > n:
                end = n
        return tuple(out)

    def _words(self, piece: str) -> list[str]:
        # lower case character by character: no special form of a final sigma
        return self.split.findall(unicodedata.normalize("NFC", piece).replace("Σ", "σ").lower())

    def _encode_piece(self, piece: str) -> tuple[int, ...]:
        return tuple(chain.from_iterable(map(self.words.__getitem__, self._words(piece))))

    def _list_word(self, word: str) -> tuple[str, str]:
        ids = self.encode_word(word)
        return " ".join(map(self.decimals.__getitem__, ids)), self.decode(ids)

    def _list_piece(self, piece: str) -> tuple[str, str]:
        words = self._words(piece)
        if len(words) == 1:
            return self.listed_words[words[0]]
        listed = [self.listed_words[w] for w in words]
        return " ".join([x[0] for x in listed]), " ".join([x[1] for x in listed])

    def _cut(self, text: str) -> list[str]:
        """The pieces between white space."""
        return SPACES.split(text) if any(c in text for c in NO_SPACES) else text.split()

    def _parts(self, text: str) -> Iterator[tuple[str, bool]]:
        """Special tokens and the texts between them; is it one?"""
        if self.special is None or not any(s in text for s in self.vocabulary.special):
            return iter([(text, False)])
        return ((part, i % 2 == 1) for i, part in enumerate(self.special.split(text)))

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for part, special in self._parts(text):
            out += [self.vocabulary.special[part]] if special else chain.from_iterable(map(self.pieces.__getitem__, self._cut(part)))
        return out

    def texts(self, text: str) -> tuple[str, str]:
        """The ids as decimals and what they decode to, each joined by blanks."""
        ids, labels = [], []
        for part, special in self._parts(text):
            if special:
                ids.append(self.decimals[self.vocabulary.special[part]])
                labels.append(part)
            elif pieces := self._cut(part):
                listed, decoded = zip(*map(self.listed.__getitem__, pieces))
                ids += listed
                labels += decoded
        return " ".join(filter(None, ids)), " ".join(filter(None, labels))

    def decode(self, ids: Iterable[int]) -> str:
        """The labels of the arcs; a vocabulary without a decoder joins them by blanks."""
        return " ".join(map(self.labels.__getitem__, ids))


#: The automaton of the vocabulary that this Python worker compiled last.
_COMPILED: dict[int, TokenAutomaton] = {}


def compiled(vocabulary: Broadcast) -> TokenAutomaton:
    if vocabulary.value is not _COMPILED.get(-1):
        _COMPILED.clear()
        _COMPILED[-1] = vocabulary.value
        _COMPILED[0] = TokenAutomaton(vocabulary.value)
    return _COMPILED[0]


def encoder(spark: SparkSession, path: str):
    """Column function: text to token ids. The vocabulary (a file of fixed size) is read once and sent to the workers."""
    bound_batches(spark)
    shared = spark.sparkContext.broadcast(read_vocabulary(path))

    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = compiled(shared)
        for texts in batches:
            yield pd.Series([automaton.encode(t) if isinstance(t, str) else [] for t in texts])

    return encode


def decoder(spark: SparkSession, path: str):
    """Column function: token ids to text."""
    bound_batches(spark)
    shared = spark.sparkContext.broadcast(read_vocabulary(path))

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = compiled(shared)
        for ids in batches:
            yield pd.Series([automaton.decode(list(i)) if i is not None else "" for i in ids])

    return decode


def tokenizer(spark: SparkSession, path: str):
    """Column function: text to (token_ids, decoded), in one pass with one broadcast.

    The automaton and the words it remembers live as long as the task: a worker that Spark reuses for other stages keeps neither.
    """
    bound_batches(spark, TASK_BYTES)
    shared = spark.sparkContext.broadcast(read_vocabulary(path))

    @F.pandas_udf("token_ids array<int>, decoded string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = TokenAutomaton(shared.value, *TASK_KEEPS)
        try:
            for texts in batches:
                ids = [automaton.encode(t) if isinstance(t, str) else [] for t in texts]
                yield pd.DataFrame({"token_ids": ids, "decoded": [automaton.decode(i) for i in ids]})
        finally:
            del automaton
            return_memory()

    return run


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256; ids are encoded and decoded in one pass and not kept."""
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    @F.pandas_udf("n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = compiled(shared)
        for texts in batches:
            out = []
            for t in texts:
                listed, decoded = automaton.texts(t) if isinstance(t, str) else ("", "")
                n = listed.count(" ") + 1 if listed else 0
                out.append((n, sha256(listed.encode()).hexdigest(), sha256(decoded.encode()).hexdigest()))
            yield pd.DataFrame(out, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", run("text").alias("r")).select("doc_id", "r.*")
