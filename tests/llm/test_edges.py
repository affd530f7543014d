"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns for every operator."""

import pytest
from pyspark.sql import functions as F

from quillrank.llm import (bpe, collocations, exact_dedup, importance, language_id, license_scan, line_dedup, mixing,
                           near_dedup, pii, quality_model, quality_rules, substring_dedup)

from . import brute

LONG = " ".join(f"w{k % 977}x{k % 31}" for k in range(60_000))
PASSAGE = " ".join(f"alpha{k}" for k in range(30))
LINE = "A line that is long enough to count as one of many"
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, id long, mark string, key string, "
          "size string, rows string, label string, hash string, part string, score string")
TEXTS = {1: "", 2: None, 3: " \n\t ", 4: "one", 5: "One", 6: LONG, 7: LONG + " end", 8: PASSAGE, 9: f"before {PASSAGE} after",
         10: "aaa " * 60, 11: f"{LINE}\nb", 12: f"{LINE} \nc", 13: f" {LINE.upper()}\nd", 14: f"{LINE}\ne", 15: f"{LINE}\n{LINE}",
         16: "MIT License and CC-BY", 17: "été à l'école 中文", 18: "\x00\x01 \x7f", 19: "<|endoftext|> x", 20: "1 2 3"}


def table(spark, texts, extra=()):
    rows = [(d, t, None if d % 3 else "en", None if d % 2 else "web", None, 7, "m", "k", "s", "r", "l", "h", "p", "x")
            for d, t in texts.items()]
    return spark.createDataFrame(rows + list(extra), SCHEMA)


def twice(spark):
    """All rows, each of them again, and one with a null id."""
    base = table(spark, TEXTS)
    one = spark.createDataFrame([(None, PASSAGE, None, None, None, 7, "m", "k", "s", "r", "l", "h", "p", "x")], SCHEMA)
    return base.unionByName(base).unionByName(one)


OPERATORS = {
    "exact": exact_dedup.exact_duplicates, "lines": line_dedup.line_dedup, "near": near_dedup.near_duplicates,
    "passages": substring_dedup.substring_dedup, "rules": quality_rules.quality_rules, "bpe": bpe.encode,
    "licenses": lambda d: license_scan.license_scan(d).drop("spans"), "mix": mixing.mix,
    "language": lambda d: language_id.identify(d, F.lit(True)),
    "accepted": lambda d: language_id.accepted(d, F.lit(True)),
    "pii": pii.find_pii, "redact": pii.redact,
    "importance": lambda d: importance.resample(d, d).drop("rank"),
    "quality": lambda d: quality_model.quality(d, d.select("doc_id", F.lit(1).alias("label")).filter("doc_id < 9")),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_repeated_rows_agree_and_nothing_is_lost(spark, name):
    docs = twice(spark)
    got = OPERATORS[name](docs).collect()
    if name != "accepted":
        assert len(got) == 2 * len(TEXTS) + 1
    if name != "mix":  # the mix decides on each row
        assert len(set(map(str, got))) == len({r["doc_id"] for r in got})


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_table(spark, name):
    assert OPERATORS[name](table(spark, TEXTS).filter("doc_id < 0")).collect() == []


def test_values(spark):
    docs, plain = table(spark, TEXTS), list(TEXTS.items())
    take = lambda df, *c: {r[0]: tuple(r[1:]) for r in df.select("doc_id", *c).collect()}
    digest = F.sha2("kept", 256)
    assert take(exact_dedup.exact_duplicates(docs), "keep_id", "group_size", "kept", "text_sha256") == brute.exact(plain)
    assert take(line_dedup.line_dedup(docs), "n_lines", "n_dropped", digest) == brute.lines(plain)
    assert take(substring_dedup.substring_dedup(docs), "n_words", "n_removed", digest) == brute.passages(plain)
    assert take(near_dedup.near_duplicates(docs), "n_shingles", "component_id") == brute.near(plain)
    assert take(license_scan.license_scan(docs), "n_words", "n_base", "first_word", "last_word", "base_labels") == {
        d: brute.phrases(t) for d, t in plain}
    assert take(quality_rules.quality_rules(docs), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                "base_failed") == {d: brute.figures(t) for d, t in plain}
    assert take(importance.resample(docs, docs.filter("doc_id > 7")), "n_features", "weight", "score", "rank") == brute.importance(
        plain, [t for d, t in plain if d > 7])
    assert {d: [(x.start, x.kind, x.end) for x in spans] for d, (spans,) in take(pii.find_pii(docs), "base").items()} == {
        d: [(a, kind, b) for a, _, kind, b in brute.pii(t)] for d, t in plain}
    assert take(language_id.identify(docs, F.lit(True)), "lang_pred")[20] == ("und",)
    assert {r.doc_id for r in language_id.accepted(docs, F.lit(True)).collect()} == {
        d for d, t in plain if t and any(map(str.isalpha, t))}


def test_null_id_is_the_largest(spark):
    docs = twice(spark)
    near = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs).collect()}
    assert near[None] == 8
    gone = {r.doc_id: r.n_removed for r in substring_dedup.substring_dedup(docs).collect()}
    assert gone[None] == 30 and gone[8] == 0 and gone[9] == 30
    kept = {r.doc_id: (r.keep_id, r.kept) for r in exact_dedup.exact_duplicates(docs).collect()}
    assert kept[None] == (8, False)


def test_ranks_of_repeated_rows_and_null_ids(spark):
    """Repeated rows are documents of their own; an empty target is no target at all."""
    docs = twice(spark)
    got = importance.resample(docs, docs.limit(0), importance.Settings(percent=100)).collect()
    ranked = sorted((r["rank"], -r.score, r.doc_id) for r in got if r["rank"])
    assert [x[0] for x in ranked] == list(range(1, 1 + sum(r.n_words >= 20 for r in got)))
    assert [x[1] for x in ranked] == sorted(x[1] for x in ranked)
    picked = importance.drawn(docs, importance.resample(docs, docs, importance.Settings(percent=100)))
    assert picked.filter("doc_id is null").count() == 1 and picked.count() == len(ranked)


def test_collocations_of_odd_tables(spark):
    """Null languages are one language, null texts are empty, every repeated row counts."""
    docs = twice(spark)
    few = collocations.Settings(least=2, flush=500, part_bytes=50_000)
    got = sorted(tuple(r) for r in collocations.collocations(docs, few).collect())
    assert got == brute.collocations([(r.lang, r.text) for r in docs.collect()], least=2)
    assert collocations.collocations(docs.filter("doc_id < 0"), few).collect() == []
    assert collocations.collocations(docs.filter("doc_id < 4"), few).collect() == []
