"""Quality rules as a cascade: each rule sees what the rules before it left, in the order of rejections per cost."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_id, documents, rows
from .words import BLANK, fingerprints, mix, spans, steps, windows

SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True
CAPITAL = np.zeros(256, bool)
CAPITAL[65:91] = True
LETTER = CAPITAL.copy()
LETTER[97:123] = True
FIRST = (np.arange(256) & 0xC0) != 0x80  # the first byte of a code point


def per_text(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.r_[0, np.cumsum(mask)][offsets])


class Texts:
    """Some texts and the figures of them that rules have asked for."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        self.starts, self.ends, self.bounds = spans(data, offsets)
        self.n_words = np.diff(self.bounds)
        self.base: dict[str, np.ndarray] = {}

    def measure(self) -> Texts:
        """The figures that every row reports."""
        data, offsets = self.data, self.offsets
        self.base = {
            "n_words": self.n_words, "word_chars": per_text(FIRST[data] & ~BLANK[data], offsets),
            "n_symbols": per_text(SYMBOL[data], offsets), "n_dup_lines": self._dup_lines(),
            "n_repeat_words": self._repeat_words(8)}
        return self

    def _dup_lines(self) -> np.ndarray:
        out = np.zeros(len(self.offsets) - 1, np.int64)
        raw = self.data.tobytes()
        for i, (a, b) in enumerate(zip(self.offsets.tolist(), self.offsets[1:].tolist())):
            lines = [x for x in raw[a:b].split(b"\n") if x and not x.isspace()]
            out[i] = len(lines) - len(set(lines))
        return out

    def _repeat_words(self, size: int) -> np.ndarray:
        codes, bounds = fingerprints(self.data, self.starts, self.ends), self.bounds
        window, whole = windows(codes, bounds, size)
        place = np.flatnonzero(whole)
        text = np.searchsorted(bounds, place, "right") - 1
        key = mix(window[place] + text.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        order = np.argsort(key)
        same = key[order[1:]] == key[order[:-1]]
        again = np.zeros(len(key), bool)
        again[order[1:]] |= same
        again[order[:-1]] |= same
        edge = np.zeros(len(codes) + 1, np.int64)
        np.add.at(edge, place[again], 1)
        np.add.at(edge, place[again] + size, -1)
        return per_text(np.cumsum(edge[:-1]) > 0, bounds)

    def part(self, chosen: np.ndarray) -> Texts:
        """The chosen texts alone."""
        if len(chosen) == len(self.offsets) - 1:
            return self
        cut = [self.data[self.offsets[i]:self.offsets[i + 1]] for i in chosen]
        out = Texts(np.concatenate([*cut, np.zeros(0, np.uint8)]), np.r_[0, np.cumsum([len(x) for x in cut])].astype(np.int64))
        out.base = {k: v[chosen] for k, v in self.base.items()}
        return out


class Rule(NamedTuple):
    name: str
    rejects: Callable[[Texts], np.ndarray]


def _word_length(t: Texts) -> np.ndarray:
    chars, n = t.base["word_chars"], t.base["n_words"]
    return (chars < 2 * n) | (chars > 20 * n)


def _symbols(t: Texts) -> np.ndarray:
    return 10 * t.base["n_symbols"] > 3 * t.base["n_words"]


def _duplicate_lines(t: Texts) -> np.ndarray:
    lines = per_text(t.data == 10, t.offsets) + 1
    return 2 * t.base["n_dup_lines"] > lines


def _capitals(t: Texts) -> np.ndarray:
    return 2 * per_text(CAPITAL[t.data], t.offsets) > per_text(LETTER[t.data], t.offsets)


def _letterless(t: Texts) -> np.ndarray:
    """Under six tenths of the words hold a letter or a character beyond ASCII."""
    sums = np.r_[0, np.cumsum(LETTER[t.data] | (t.data >= 128))]
    return 10 * per_text(sums[t.ends] > sums[t.starts], t.bounds) < 6 * t.n_words


def _one_word(t: Texts) -> np.ndarray:
    """Every other word equals the word before it, or more."""
    codes = fingerprints(t.data, t.starts, t.ends)
    same = np.r_[False, codes[1:] == codes[:-1]]
    same[t.bounds[:-1][t.n_words > 0]] = False
    return 2 * per_text(same, t.bounds) > t.n_words


def _shouts(t: Texts) -> np.ndarray:
    """Over four tenths of the words end in two exclamation or question marks."""
    loud = (t.data == 33) | (t.data == 63)
    long = t.ends - t.starts >= 2
    two = loud[t.ends - 1] & loud[np.maximum(t.ends - 2, 0)] & long
    return 10 * per_text(two, t.bounds) > 4 * t.n_words


RULES = [Rule("word length", _word_length), Rule("symbols", _symbols), Rule("duplicate lines", _duplicate_lines),
         Rule("capitals", _capitals), Rule("letterless", _letterless), Rule("one word", _one_word),
         Rule("shouts", _shouts)]


def base_failed(t: Texts) -> np.ndarray:
    return (t.n_words < 20) | (100 * t.base["n_repeat_words"] > 30 * t.n_words)


def cascade(t: Texts, rules: list[Rule], alive: np.ndarray) -> np.ndarray:
    """Which texts pass all rules; a rule runs on the texts that passed the ones before it."""
    alive = alive.copy()
    for rule in rules:
        left = np.flatnonzero(alive)
        if not len(left):
            break
        alive[left[rule.rejects(t.part(left))]] = False
    return alive


def rule_order(docs: DataFrame, rules: list[Rule], sample_rows: int) -> list[Rule]:
    """The rules by rejections per second, from a random sample of about ``sample_rows`` documents."""
    total = docs.count()
    if not total:
        return rules

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spent, lost = np.zeros(len(rules)), np.zeros(len(rules), np.int64)
        for _, data, offsets in steps(batches):
            t = Texts(data, offsets).measure()
            t = t.part(np.flatnonzero(~base_failed(t)))
            for k, rule in enumerate(rules):
                began = time.perf_counter()
                lost[k] += int(rule.rejects(t).sum())
                spent[k] += time.perf_counter() - began
        yield pa.RecordBatch.from_arrays([pa.array(range(len(rules)), pa.int32()), pa.array(spent), pa.array(lost)],
                                         ["rule", "spent", "lost"])

    sample = rows(docs).sample(min(1.0, sample_rows / total), seed=1)
    figures = (sample.mapInArrow(run, "rule int, spent double, lost bigint")
               .groupBy("rule").agg(F.sum("spent").alias("spent"), F.sum("lost").alias("lost")).collect())
    worth = {r["rule"]: (r["lost"] + 0.01) / (r["spent"] + 1e-6) for r in figures}
    return [rules[k] for k in sorted(range(len(rules)), key=lambda k: -worth.get(k, 0.0))]


def quality_rules(docs: DataFrame, rules: list[Rule] | None = None, sample_rows: int = 2000) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept) of each row.

    The figures are of the whole text. ``base_failed`` marks texts under 20 words or with over 30 % of their words
    in repeated 8-word windows; the others are kept when every rule passes them. The sample decides the order in
    which rules run, never the verdict, so reruns agree. Null and empty texts have no words and fail; repeated
    rows get the same verdict; an empty table gives an empty result; other columns are ignored. No shuffle.
    """
    ordered = rule_order(docs, RULES if rules is None else rules, sample_rows)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in steps(batches):
            t = Texts(data, offsets).measure()
            failed = base_failed(t)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *(pa.array(t.base[n].astype(np.int64)) for n in names), pa.array(failed),
                 pa.array(cascade(t, ordered, ~failed))], ["id", *names, "base_failed", "kept"])

    schema = "id bigint, " + "".join(f"{n} bigint, " for n in names) + "base_failed boolean, kept boolean"
    return rows(docs).mapInArrow(run, schema).select(doc_id(), *names, "base_failed", "kept")


def query(spark, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir))
