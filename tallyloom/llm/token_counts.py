"""Token counts by rank-synchronous merging of ragged arrays."""

from __future__ import annotations

import functools
import json
import os
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyloom.llm.common import by_batch, pick, slices

#: Pre-tokens that a worker remembers between batches; beyond it the store starts afresh.
HELD = 300_000
_NONE = np.iinfo(np.int64).max

# The parts of the vocabulary's split pattern, for characters up to U+00FF.
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
_NUMBERS = "0-9²³¹¼½¾"
_WHITE = "\t-\r \x85\xa0"
_SHORT = "'s|'t|'re|'ve|'m|'ll|'d"
_LATIN = re.compile(f"{_SHORT}|[{_LETTERS}]+|[{_NUMBERS}]|[^{_WHITE}{_LETTERS}{_NUMBERS}]+")
_WORD = re.compile(f"[^{_WHITE}\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


def is_latin(text: str) -> bool:
    """Whether all characters are up to U+00FF: such text is in normal form and its classes never change."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Splitter:
    """Cuts texts into pre-tokens as the tokenizers library does for a file.

    No pre-token reaches over white space, so words are cut one by one. Latin text goes through an
    equal pattern; words with other characters go to the library's own normalizer and splitter.
    Special tokens in the text are parts of their own.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")")
        self.is_special = frozenset(special)
        self.odd: dict[str, list[str]] = {}

    def word(self, word: str) -> list[str]:
        if is_latin(word):
            return _LATIN.findall(word.lower())
        if word not in self.odd:
            if len(self.odd) >= HELD:
                self.odd.clear()
            plain = self.library.normalizer.normalize_str(word)
            self.odd[word] = [plain[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(plain)]
        return self.odd[word]

    def plain(self, text: str) -> list[str]:
        if is_latin(text):
            return _LATIN.findall(text.lower())
        return [part for word in _WORD.findall(text) for part in self.word(word)]

    def parts(self, text: str) -> list[str]:
        """Pre-tokens in normal form, and special tokens as they are."""
        if not any(s in text for s in self.is_special):
            return self.plain(text)
        return [x for i, part in enumerate(self.special.split(text)) for x in ([part] if i % 2 else self.plain(part))]


class Merger:
    """Merges symbols of many pre-tokens at once by the ranks of a tokenizer file.

    Pre-tokens lie one after the other in an array of symbol ids. In each round every pre-token's
    lowest-ranked pair is merged wherever it stands in it, in all pre-tokens at once; pre-tokens
    without a known pair leave the array. Merging all places of a pair at once is what one merge
    after the other gives if a symbol is made by one pair alone and is used by later pairs only.
    Where a file breaks that rule, only the first place is merged per round.
    """

    def __init__(self, path: str):
        self.splitter = Splitter(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("continuing_subword_prefix"):
            raise ValueError("a BPE vocabulary without prefixes inside words is needed")
        self.suffix = model.get("end_of_word_suffix") or ""
        self.vocab: dict[str, int] = model["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        left, right, made = (np.array([self.vocab[x] for x in side], np.int64) for side in (*zip(*pairs, strict=True), [a + b for a, b in pairs]))
        self.size = max(self.vocab.values()) + 1
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order, made[order]
        born = np.full(self.size, -1, np.int64)
        born[made[::-1]] = np.arange(len(made))[::-1]
        steps = np.arange(len(made))
        self.at_once = len(np.unique(made)) == len(made) and bool((born[left] < steps).all() and (born[right] < steps).all())
        # the characters that stand for the bytes 0 to 255: printable ones for themselves, the rest from U+0100 on
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in shown]
        chars = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}
        self.inside = np.array([self.vocab[chars[b]] for b in range(256)])
        self.last = np.array([self.vocab[chars[b] + self.suffix] for b in range(256)])

    def surviving(self, sequences: list[bytes]) -> np.ndarray:
        """The number of symbols left of each sequence of bytes when no pair can be merged any more."""
        lengths = np.fromiter(map(len, sequences), np.int64, len(sequences))
        counts = lengths.copy()
        raw = np.frombuffer(b"".join(sequences), np.uint8)
        ids = self.inside[raw]
        ends = np.cumsum(lengths) - 1
        ids[ends] = self.last[raw[ends]]
        owner = np.repeat(np.arange(len(sequences)), lengths)
        while len(ids) > 1:
            key = ids[:-1] * self.size + ids[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.where((self.keys[at] == key) & (owner[:-1] == owner[1:]), self.ranks[at], _NONE)
            best = np.full(len(sequences), _NONE)
            np.minimum.at(best, owner[:-1], rank)
            chosen = (rank != _NONE) & (rank == best[owner[:-1]])
            if not chosen.any():
                break
            places = np.flatnonzero(chosen)
            if self.at_once:  # of places that overlap, as in "aaa", every other one from the left
                new = np.r_[True, np.diff(places) > 1]
                begin = np.maximum.accumulate(np.where(new, np.arange(len(places)), 0))
                places = places[(np.arange(len(places)) - begin) % 2 == 0]
            else:
                places = places[np.r_[True, np.diff(owner[places]) > 0]]
            ids[places] = self.made[at[places]]
            np.subtract.at(counts, owner[places], 1)
            stays = np.ones(len(ids), bool)
            stays[places + 1] = False
            stays &= best[owner] != _NONE
            ids, owner = ids[stays], owner[stays]
        return counts

    def counts(self, parts: Iterable[str]) -> dict[str, int]:
        """Tokens of each pre-token; a special token is one."""
        parts = list(parts)
        own = [p for p in parts if p not in self.splitter.is_special]
        found = dict.fromkeys(parts, 1)
        if own:
            found |= zip(own, self.surviving([p.encode() for p in own]).tolist(), strict=True)
        return found


@functools.lru_cache(maxsize=2)
def _merger(path: str) -> tuple[Merger, dict[str, int]]:
    return Merger(path), {}


def count_texts(texts: list[str], path: str) -> list[int]:
    """Tokens of each text; a pre-token is merged once and remembered, up to ``HELD`` of them."""
    merger, known = _merger(path)
    parts = [merger.splitter.parts(text) for text in texts]
    new = set().union(*parts) - known.keys()
    if len(known) + len(new) > HELD:
        known.clear()
        new = set().union(*parts)
    if new:
        known |= merger.counts(new)
    return [sum(map(known.__getitem__, own)) for own in parts]


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 2048, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Bytes and tokens of every row's whole text, and whether it has more than ``limit`` tokens.

    ``vocabulary`` is the path of a BPE file of the tokenizers library, without special tokens
    around the text; strings of special tokens inside it count as the library's default has it.
    Null texts count as empty: no bytes, no tokens. Every row gives one row, repeated ones too; a
    null key stays null. Nothing is shuffled, and a task holds a batch and ``HELD`` pre-tokens.
    """
    rows = pick(docs, key, text)
    out = rows.sparkSession.createDataFrame([], f"{key} {dict(rows.dtypes)[key]}, n_bytes long, n_tokens long, over_limit boolean").schema

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        size, tokens = [], []
        for _, texts in slices(batch.column(1)):
            size += [len(t.encode()) for t in texts]
            tokens += count_texts(texts, vocabulary)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(size, pa.int64()), pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_())],
            names=[key, "n_bytes", "n_tokens", "over_limit"],
        )

    return rows.mapInArrow(by_batch(make), out)
