"""Exact byte-pair encoding by dynamic programming over prefixes, and decoding."""

from __future__ import annotations

import json
import re

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import CACHE_ENTRIES, hold, with_columns

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
END = "</w>"
# Texts of these characters alone are normalised and split here; others by the vocabulary's own normaliser and splitter,
# whose Unicode tables may differ from Python's.
PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xa1-\xac\xae-įı-ſ]*\Z")
# The vocabulary's splitting rule, with the letters and numbers among those characters spelt out.
LETTERS, NUMBERS = "A-Za-zªµºÀ-ÖØ-öø-ſ", "0-9²³¹¼½¾"
PIECES = re.compile(f"[{LETTERS}]+|'(?:s|t|re|ve|m|ll|d)|[{NUMBERS}]|[^\\s{LETTERS}{NUMBERS}]+")
LONG_WORD = 64


def byte_characters() -> list[str]:
    """The character that byte-level vocabularies write for each byte: itself if printable, else the next from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = iter(range(256, 512))
    kept = set(shown)
    return [chr(b) if b in kept else chr(next(other)) for b in range(256)]


class Encoder:
    """Encodes and decodes texts with a vocabulary whose merges each make one token and whose words end in ``</w>``."""

    def __init__(self, path: str = VOCABULARY):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.ids: dict[str, int] = spec["model"]["vocab"]
        self.rank: dict[str, int] = {}
        self.parts: dict[str, tuple[str, str]] = {}
        self.pair_rank: dict[tuple[str, str], int] = {}
        for n, (left, right) in enumerate(spec["model"]["merges"]):
            if left + right in self.parts:
                raise ValueError(f"two merges make the token {left + right!r}")
            self.parts[left + right] = (left, right)
            self.rank[left + right] = self.pair_rank[left, right] = n
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.names = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.special.items()}
        self.library = Tokenizer.from_file(path)
        self.characters = byte_characters()
        self.pairs: dict[tuple[str, str], bool] = {}
        # The automaton reports every token that is a suffix of the prefix read so far; \0 stands for the word's end.
        self.matches = ahocorasick.Automaton()
        for token in self.ids:
            if self.stands(token):
                ends = token.endswith(END)
                key = token[: -len(END)] + "\0" if ends else token
                self.matches.add_word(key, (len(key), token))
        self.matches.make_automaton()
        self.words: dict[str, bytes] = {}

    def stands(self, token: str) -> bool:
        """Whether merging the token's own characters gives the token."""
        known = self.rank.get(token)
        if known is None:
            return True
        left, right = self.parts[token]
        return self.stands(left) and self.stands(right) and self._apart(left, right, known)

    def _apart(self, left: str, right: str, limit: float) -> bool:
        """Whether no merge joins the two sides before ``limit``. Merges next to the border are undone, latest first; at
        each stage the border pair must not have a merge that would have come earlier than the one undone."""
        while True:
            merge = self.pair_rank.get((left, right))
            if merge is not None and merge < limit:
                return False
            a, b = self.rank.get(left, -1), self.rank.get(right, -1)
            if a < 0 and b < 0:
                return True
            if a > b:
                limit, left = a, self.parts[left][1]
            else:  # of equal merges the left one comes first, so one across the border would precede the right one
                limit, right = b + 1, self.parts[right][0]

    def compatible(self, left: str, right: str) -> bool:
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= CACHE_ENTRIES:
                self.pairs.clear()
            known = self.pairs[left, right] = self._apart(left, right, float("inf"))
        return known

    def word(self, word: str) -> list[int]:
        """Token ids of one word, given in the vocabulary's characters."""
        n = len(word)
        last: list[str | None] = [None] * (n + 1)
        start = [0] * (n + 1)
        for end, (size, token) in self.matches.iter(word + "\0"):
            whole = end == n
            if whole != token.endswith(END):
                continue
            at = end + 1 - size
            to = n if whole else end + 1
            if to == n and not whole:
                continue
            if last[to] is None and (at == 0 or (last[at] is not None and self.compatible(last[at], token))):
                last[to], start[to] = token, at
        out, at = [], n
        while at:
            if last[at] is None:
                raise ValueError(f"the vocabulary does not cover {word!r}")
            out.append(self.ids[last[at]])
            at = start[at]
        return out[::-1]

    def _word_bytes(self, piece: str, in_bytes: bool) -> bytes:
        word = piece if in_bytes else "".join([self.characters[b] for b in piece.encode("utf-8", "replace")])
        return np.array(self.word(word), np.int32).tobytes()

    def _plain(self, text: str) -> bytes:
        out, words = [], self.words
        for piece in PIECES.findall(text.lower()):
            got = words.get(piece)
            if got is None:
                got = self._word_bytes(piece, False)
                if len(words) >= CACHE_ENTRIES:
                    words.clear()
                if len(piece) <= LONG_WORD:
                    words[piece] = got
            out.append(got)
        return b"".join(out)

    def _other(self, text: str) -> bytes:
        text = self.library.normalizer.normalize_str(text)
        return b"".join([self._word_bytes(w, True) for w, _ in self.library.pre_tokenizer.pre_tokenize_str(text)])

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text; null is empty. The strings of special tokens become their ids."""
        text = text or ""
        segments = self.split_special.split(text) if "<|" in text else [text]
        out = []
        for s in segments:
            if s in self.special:
                out.append(np.int32(self.special[s]).tobytes())
            elif s:
                out.append(self._plain(s) if PLAIN.match(s) else self._other(s))
        return np.frombuffer(b"".join(out), np.int32)

    def decode(self, ids) -> str:
        """The tokens' texts, special ones too, with spaces between them: this vocabulary names no decoder."""
        return " ".join([self.names[i] for i in ids])


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str = VOCABULARY) -> Encoder:
    """One encoder per Python worker and vocabulary, so its caches serve all tasks of the worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def round_trip(docs: DataFrame, *, text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """All columns of ``docs`` with ``ids`` and ``decoded``. Null and empty texts have no ids and decode to ''. Columns of
    these two names are replaced."""
    def make():
        hold("bpe", _ENCODERS.clear)
        bpe = encoder(vocabulary)

        def work(texts):
            ids = [bpe.encode(t) for t in texts]
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            flat = np.concatenate(ids) if ids else np.array([], np.int32)
            return [pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32())),
                    pa.array([bpe.decode(x.tolist()) for x in ids], pa.string())]

        return work

    return with_columns(docs, text, [T.StructField("ids", T.ArrayType(T.IntegerType())),
                                     T.StructField("decoded", T.StringType())], make)


def op4_bpe(spark, docs: DataFrame) -> DataFrame:
    """Ids and decoded text of every document, as digests. Null and empty texts have no ids, repeated rows give equal results,
    an empty table gives no rows, and columns but doc_id and text are ignored."""
    done = round_trip(docs.select("doc_id", "text"))
    return done.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
