"""BPE encoding and decoding with a public vocabulary: merge rounds over many words at once in numpy."""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_id, documents, rows
from .words import steps

#: Fixed value: the vocabulary's pattern of the pieces that are encoded apart.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Chunks of text whose encoding a worker remembers, and their characters in all; beyond either it starts anew. What it
#: holds is then a few times REMEMBERED_CHARS, and the chunks of one batch.
REMEMBERED = 800_000
REMEMBERED_CHARS = 16 << 20
NONE = np.iinfo(np.int32).max


class Vocabulary(NamedTuple):
    keys: np.ndarray      # left id * size + right id of each merge, ascending
    ranks: np.ndarray     # the merge's rank, by place in keys
    results: np.ndarray   # the symbol it makes, by rank
    careful: np.ndarray   # by rank: its symbol takes part in a merge of lower rank
    inner: np.ndarray     # symbol of a byte
    final: np.ndarray     # symbol of a piece's last byte
    tokens: list[str]     # by id
    special: dict[str, int]


def _byte_chars() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself, or the next free code from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    free = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(free)) for b in range(256)]


def vocabulary(path: str | None = None) -> Vocabulary:
    """Reads a vocabulary file of the tokenizers library: BPE over bytes with word ends."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        told = json.load(f)
    ids, suffix = told["model"]["vocab"], told["model"]["end_of_word_suffix"]
    special = {t["content"]: t["id"] for t in told["added_tokens"]}
    tokens = [""] * (max([*ids.values(), *special.values()]) + 1)
    for token, i in [*ids.items(), *special.items()]:
        tokens[i] = token
    merges = [m.split(" ") if isinstance(m, str) else m for m in told["model"]["merges"]]
    left, right, made = (np.array(x, np.int64) for x in zip(*((ids[a], ids[b], ids[a + b]) for a, b in merges)))
    first_use = np.full(len(tokens), NONE, np.int64)  # of a symbol in any merge
    np.minimum.at(first_use, left, np.arange(len(left)))
    np.minimum.at(first_use, right, np.arange(len(left)))
    keys = left * len(tokens) + right
    order = np.argsort(keys, kind="stable")
    chars = _byte_chars()
    return Vocabulary(keys[order], order.astype(np.int32), made.astype(np.int32),
                      first_use[made] < np.arange(len(made)), np.array([ids[c] for c in chars], np.int32),
                      np.array([ids[c + suffix] for c in chars], np.int32), tokens, special)


def merge(v: Vocabulary, symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, owner) after all merges; ``owner`` is the piece of each symbol, ascending.

    Each round looks up every neighbouring pair by binary search in the sorted pair keys and merges, in each
    piece, the pair of lowest rank: all its places from the left, or, where the new symbol may take part in a
    merge of still lower rank, the leftmost alone. Pieces without a pair to merge leave the round.
    """
    done: list[tuple[np.ndarray, np.ndarray]] = []
    symbols, owner = symbols.astype(np.int64), owner.copy()
    while len(symbols):
        key = symbols[:-1] * len(v.tokens) + symbols[1:]
        at = np.minimum(np.searchsorted(v.keys, key), len(v.keys) - 1)
        rank = np.full(len(symbols), NONE, np.int32)
        rank[:-1] = np.where((v.keys[at] == key) & (owner[:-1] == owner[1:]), v.ranks[at], NONE)
        new = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        best = np.repeat(np.minimum.reduceat(rank, new), np.diff(np.r_[new, len(symbols)]))
        still = best < NONE
        if not still.all():
            done.append((symbols[~still], owner[~still]))
            symbols, owner, rank, best = symbols[still], owner[still], rank[still], best[still]
            if not len(symbols):
                break
        place = np.flatnonzero(rank == best)
        other = np.r_[True, (np.diff(place) > 1) | (owner[place[1:]] != owner[place[:-1]])]
        run = np.maximum.accumulate(np.where(other, place, 0))  # pairs that overlap form a run: every second merges
        take = (place - run) % 2 == 0
        first = np.r_[True, owner[place[1:]] != owner[place[:-1]]]
        take &= first | ~v.careful[rank[place]]
        place = place[take]
        symbols[place] = v.results[rank[place]]
        keep = np.ones(len(symbols), bool)
        keep[place + 1] = False
        symbols, owner = symbols[keep], owner[keep]
    if not done:
        return symbols.astype(np.int32), owner
    symbols, owner = (np.concatenate(x) for x in zip(*done))
    order = np.argsort(owner, kind="stable")
    return symbols[order].astype(np.int32), owner[order]


def ragged(flat: np.ndarray, at: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slices flat[at[i]:at[i+1]] for i in ``which`` one after the other, and where each begins."""
    sizes = at[which + 1] - at[which]
    bounds = np.r_[0, np.cumsum(sizes)]
    return flat[np.repeat(at[which] - bounds[:-1], sizes) + np.arange(bounds[-1])], bounds


class Encoder:
    """Encodes lists of texts; remembers the chunks between white space that it has met."""

    def __init__(self, v: Vocabulary):
        self.v = v
        self.pieces = regex.compile(PIECES)
        self.blanks = regex.compile(r"\s+")
        self.special = regex.compile("(" + "|".join(map(regex.escape, v.special)) + ")") if v.special else None
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.chars = 0
        self.flat, self.at, self.decoded = np.zeros(0, np.int32), np.zeros(1, np.int64), []
        for token, i in self.v.special.items():
            self._add([token], np.array([i], np.int32), np.array([1]))

    def _add(self, chunks: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        for c in chunks:
            self.known[c] = len(self.known)
        tokens, bounds = [self.v.tokens[i] for i in ids.tolist()], np.r_[0, np.cumsum(sizes)].tolist()
        self.decoded += [" ".join(tokens[a:b]) for a, b in zip(bounds, bounds[1:])]
        self.flat = np.concatenate([self.flat, ids])
        self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(sizes)])

    def _learn(self, chunks: list[str]) -> None:
        split = [self.pieces.findall(c) for c in chunks]
        number: dict[bytes, int] = {}
        inside = [[number.setdefault(p.encode(), len(number)) for p in ps] for ps in split]
        sizes = np.array([len(p) for p in number], np.int64)
        data = np.frombuffer(b"".join(number), np.uint8)
        symbols = self.v.inner[data]
        ends = np.cumsum(sizes) - 1
        symbols[ends] = self.v.final[data[ends]]
        symbols, owner = merge(self.v, symbols, np.repeat(np.arange(len(sizes)), sizes))
        at = np.searchsorted(owner, np.arange(len(sizes) + 1))
        counts = np.array([len(x) for x in inside], np.int64)
        ids, bounds = ragged(symbols, at, np.array([i for x in inside for i in x], np.int64))
        self._add(chunks, ids, np.diff(bounds[np.r_[0, np.cumsum(counts)]]))

    def chunks(self, text: str) -> list[str]:
        """Lower-cased stretches between white space; special tokens stand alone, as they are written."""
        if self.special is not None and "<" in text:
            out = []
            for k, part in enumerate(self.special.split(text)):
                out += [part] if k % 2 else self._plain(part)
            return out
        return self._plain(text)

    def _plain(self, text: str) -> list[str]:
        # lower case of single characters: a final capital sigma is no exception
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        if "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text:  # blanks for str.split alone
            return [c for c in self.blanks.split(text) if c]
        return text.split()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """(ids of all texts, bounds of each, decoded texts)."""
        split = [self.chunks(t) for t in texts]
        if len(self.known) > REMEMBERED or self.chars > REMEMBERED_CHARS:
            self.forget()
        flat = list(chain.from_iterable(split))
        new = list(set(flat).difference(self.known))
        if new:
            self._learn(new)
            self.chars += sum(map(len, new))
        numbers = list(map(self.known.__getitem__, flat))
        ids, bounds = ragged(self.flat, self.at, np.array(numbers, np.int64))
        ends = np.r_[0, np.cumsum([len(cs) for cs in split])]
        spelt, edges = list(map(self.decoded.__getitem__, numbers)), ends.tolist()
        if "" in spelt:  # a chunk without a piece has no token, and no blank of its own
            return ids, bounds[ends], [" ".join(filter(None, spelt[a:b])) for a, b in zip(edges, edges[1:])]
        return ids, bounds[ends], [" ".join(spelt[a:b]) for a, b in zip(edges, edges[1:])]


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids, decoded), one row for each row of ``docs``: token ids of the whole text and the text they give.

    Equal to what the tokenizers library encodes without adding special tokens (special tokens written in a text
    are recognised) and decodes without skipping any. Null and empty texts have no ids and decode to an empty
    text; repeated rows are encoded alike; an empty table gives an empty result; other columns are ignored.
    The vocabulary (some MB, fixed) is broadcast; rows go through in steps of bounded size, without a shuffle.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch, _, _ in steps(batches):
            ids, bounds, decoded = encoder.encode(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids)),
                 pa.array(decoded, pa.string())], ["id", "ids", "decoded"])

    return (rows(docs).mapInArrow(run, "id bigint, ids array<int>, decoded string")
            .select(doc_id(), "ids", "decoded"))


def decode(tokens: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, decoded) of (doc_id, ids): the tokens' spellings joined by single spaces; null ids decode to ''."""
    shared = tokens.sparkSession.sparkContext.broadcast(vocabulary(path).tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelling = shared.value
        for batch in batches:
            texts = [" ".join([spelling[i] for i in ids or ()]) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())],
                                             ["doc_id", "decoded"])

    return tokens.select(F.col("doc_id").cast("bigint").alias("doc_id"), "ids").mapInArrow(
        run, "doc_id bigint, decoded string")


def query(spark, sf_dir: str) -> DataFrame:
    return encode(documents(spark, sf_dir)).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
