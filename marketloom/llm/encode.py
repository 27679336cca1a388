"""Encoding of texts by a public byte-level BPE vocabulary as a streaming transducer.

A text is cut into words by the vocabulary's pattern; the bytes of every word run through the
transducer. It keeps, for every prefix of the bytes read, the last token of that prefix's
encoding: the one token ending there that can follow the last token of the prefix before it, two
tokens being able to follow each other if their joint bytes encode to just these two.

What comes later can change a boundary only through a chain of ever earlier merges: a merge of
two parts is forestalled if its right part first merges with what follows, by an earlier merge,
and so on. ``sufficient_lookahead`` adds up the longest such chain of the merge list (178 bytes
for the default vocabulary, computed in under a second). A boundary with that many bytes behind
it is final: its tokens are emitted and their bytes forgotten, so the state is at most
lookahead + longest token + ``STEP`` bytes, whatever the length of the word. Results of frequent
words are kept in a bounded cache.

Defined results: null and empty texts have no tokens (the empty list); strings that look like
special tokens are plain text; every token sequence decodes to exactly the text it came from.
"""

from __future__ import annotations

import base64
import codecs
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how the vocabulary's texts were cut into words.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHED_WORDS = 200_000
CACHED_PAIRS = 500_000
#: Longest word (characters) whose tokens are cached, bytes between two looks for final boundaries, and
#: characters of a word that are fed at once.
CACHED_LENGTH, STEP, PIECE = 64, 128, 1024


def read_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(t): int(r) for t, r in (line.split() for line in data.splitlines() if line)}


def sufficient_lookahead(ranks: dict[bytes, int]) -> int:
    """Bytes after a boundary of an encoding beyond which nothing can change it any more.

    Merges are taken in the list's order. Whether parts a and b merge at their turn depends on b's
    right neighbour if b, or the last part that b was made of, may merge with it at an earlier turn;
    then that neighbour must be seen, and what in turn decides about it. ``ahead[t]`` is how far one
    must look beyond a token t for merges so far that begin with t, ``inner[t]`` for those that begin
    with the last parts t was made of, at their time. All ways to split a token count, so the bound
    may be larger than needed, never smaller.
    """
    ahead: dict[bytes, int] = {}
    inner: dict[bytes, int] = {}
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        deep, found = 0, []
        for k in range(1, len(token)):
            a, b = token[:k], token[k:]
            if a in inner and b in inner:
                beyond = max(inner[b], ahead.get(b, 0))
                deep = max(deep, beyond)
                found.append((a, len(b) + beyond))
        inner[token] = deep
        for a, n in found:
            if n > ahead.get(a, 0):
                ahead[a] = n
    return max((max(inner[t], ahead.get(t, 0)) for t in ranks), default=0)


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        self.ranks = ranks
        self.tokens = {i: b for b, i in ranks.items()}
        self.longest = max(map(len, ranks))
        self.lookahead = sufficient_lookahead(ranks)
        self.most_held = 0  # bytes that the transducer ever kept
        #: every ending of every token, for reading tokens backwards
        self.endings = {b[k:] for b in ranks for k in range(len(b))}
        self._words = regex.compile(pattern)
        self._cache: dict[str, array] = {}
        self._follows: dict[tuple[int, int], bool] = {}
        self._alone: dict[int, bool] = {}

    def merge(self, word: bytes, before: int = 1 << 30) -> list[int]:
        """The parts of two tokens' bytes by the list's merges ``before`` a rank: the earliest first, leftmost first.

        Only for building the transducer: which tokens can stand after each other.
        """
        ranks = self.ranks
        parts = [word[i : i + 1] for i in range(len(word))]
        scores = [ranks.get(word[i : i + 2], 1 << 30) for i in range(len(word) - 1)]
        while scores:
            best = min(scores)
            if best >= before:
                break
            i = scores.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del scores[i]
            if i < len(scores):
                scores[i] = ranks.get(parts[i] + parts[i + 1], 1 << 30)
            if i:
                scores[i - 1] = ranks.get(parts[i - 1] + parts[i], 1 << 30)
        return [ranks[p] for p in parts]

    def can_follow(self, left: int, right: int) -> bool:
        pair = (left, right)
        known = self._follows.get(pair)
        if known is None:
            if len(self._follows) >= CACHED_PAIRS:
                self._follows.clear()
            known = self._follows[pair] = self.merge(self.tokens[left] + self.tokens[right]) == [left, right]
        return known

    def stands(self, token: int) -> bool:
        """Whether a token's bytes by themselves encode to it."""
        known = self._alone.get(token)
        if known is None:
            piece = self.tokens[token]
            parts = [p for k in range(1, len(piece)) if (p := (piece[:k], piece[k:])) and p[0] in self.ranks and p[1] in self.ranks]
            # the list makes a token of two parts that stay apart until its turn
            known = self._alone[token] = len(piece) == 1 or any(self._made(*p, self.ranks[piece]) for p in parts)
        return known

    def _made(self, a: bytes, b: bytes, rank: int) -> bool:
        return self.merge(a + b, rank) == [self.ranks[a], self.ranks[b]]

    def stream(self, chunks: Iterable[bytes]) -> Iterator[int]:
        """Tokens of one word that arrives in pieces, each as soon as nothing that follows can change it."""
        ranks, endings, follows, reach = self.ranks, self.endings, self._follows, self.longest
        held = b""  # bytes since the last emitted boundary
        last: list[int] = []  # last token of the encoding of each prefix of held
        size: list[int] = []  # its length
        n, look = 0, self.lookahead + reach
        for chunk in chunks:
            for lo in range(0, len(chunk), STEP):
                held += chunk[lo : lo + STEP]
                for n in range(n + 1, len(held) + 1):
                    for k in range(1, min(n, reach) + 1):
                        piece = held[n - k : n]
                        if piece not in endings:
                            raise ValueError("no token ends here")  # not with a vocabulary of all bytes
                        token = ranks.get(piece)
                        if token is None:
                            continue
                        at = n - k
                        if at:
                            pair = (last[at - 1], token)
                            fits = follows.get(pair)
                            if fits is None:
                                fits = self.can_follow(*pair)
                        else:
                            fits = self.stands(token)
                        if fits:
                            break
                    last.append(token)
                    size.append(k)
                if n > self.most_held:
                    self.most_held = n
                if n >= look:
                    final = n
                    while final > n - self.lookahead:
                        final -= size[final - 1]
                    yield from self._back(last, size, final)
                    held = held[final:]
                    del last[:final], size[:final]
                    n -= final
        if n:
            yield from self._back(last, size, n)

    @staticmethod
    def _back(last: list[int], size: list[int], end: int) -> list[int]:
        out = []
        while end > 0:
            out.append(last[end - 1])
            end -= size[end - 1]
        return out[::-1]

    def word(self, word: str) -> array:
        ids = array("i", self.stream(word[lo : lo + PIECE].encode("utf-8") for lo in range(0, len(word), PIECE)))
        if len(word) <= CACHED_LENGTH:
            if len(self._cache) >= CACHED_WORDS:
                self._cache.clear()
            self._cache[word] = ids
        return ids

    def encode_into(self, text: str | None, out: array) -> None:
        if not text:
            return
        get, extend, make = self._cache.get, out.extend, self.word
        for m in self._words.finditer(text):
            w = m.group()
            extend(get(w) or make(w))

    def encode(self, text: str | None) -> list[int]:
        out = array("i")
        self.encode_into(text, out)
        return out.tolist()


class Decoder:
    """Tokens back to text: bytes go through an incremental UTF-8 automaton, text comes out as it completes."""

    def __init__(self, ranks: dict[bytes, int]):
        self.tokens = {i: b for b, i in ranks.items()}
        self._automaton = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        step, tokens = self._automaton.decode, self.tokens
        return "".join(step(tokens[i]) for i in ids)

    def end(self) -> str:
        rest = self._automaton.decode(b"", final=True)
        self._automaton.reset()
        return rest


@lru_cache(maxsize=2)
def _encoder(data: bytes) -> Encoder:
    return Encoder(read_ranks(data))


def shipped(df: DataFrame, vocabulary: str):
    """The vocabulary file (under 1 MB, whatever the data) as a broadcast, so executors need no copy of it."""
    with open(vocabulary, "rb") as f:
        data = f.read()
    return df.sparkSession.sparkContext.broadcast(data)


def _slices(batches, rows: int = 1000):
    for b in batches:
        for lo in range(0, b.num_rows, rows):
            yield b.slice(lo, rows)


def _ids(encoder: Encoder, texts: Iterable[str | None]) -> tuple[array, np.ndarray]:
    flat, ends = array("i"), [0]
    for t in texts:
        encoder.encode_into(t, flat)
        ends.append(len(flat))
    return flat, np.array(ends, np.int32)


def encode(df: DataFrame, key: str, text: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, ids): the tokens of each text; one Arrow map, no shuffle."""
    ranks = shipped(df, vocabulary)
    schema = T.StructType([df.schema[key], T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches):
        encoder = _encoder(ranks.value)
        for b in _slices(batches):
            flat, ends = _ids(encoder, b.column(1).to_pylist())
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(flat, np.int32) if len(flat) else np.zeros(0, np.int32)))
            yield pa.RecordBatch.from_arrays([b.column(0), ids], names=[key, "ids"])

    return df.select(key, text).mapInArrow(run, schema)


def token_counts(df: DataFrame, key: str, text: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, n_tokens)."""
    ranks = shipped(df, vocabulary)
    schema = T.StructType([df.schema[key], T.StructField("n_tokens", T.LongType())])

    def run(batches):
        encoder = _encoder(ranks.value)
        for b in _slices(batches):
            _, ends = _ids(encoder, b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(ends).astype(np.int64))], names=[key, "n_tokens"])

    return df.select(key, text).mapInArrow(run, schema)


def round_trip(df: DataFrame, key: str, text: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, n_tokens, same): whether the tokens decode to exactly the text (a null text as empty)."""
    ranks = shipped(df, vocabulary)
    schema = T.StructType([df.schema[key], T.StructField("n_tokens", T.LongType()), T.StructField("same", T.BooleanType())])

    def run(batches):
        encoder = _encoder(ranks.value)
        decoder = Decoder(encoder.ranks)
        for b in _slices(batches):
            counts, same = [], []
            for t in b.column(1).to_pylist():
                ids = encoder.encode(t)
                counts.append(len(ids))
                same.append(decoder.feed(ids) + decoder.end() == (t or ""))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts, pa.int64()), pa.array(same, pa.bool_())], names=[key, "n_tokens", "same"])

    return df.select(key, text).mapInArrow(run, schema)
