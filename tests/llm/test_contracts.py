"""Every registered query over the smallest tables, against SQL or a plain version."""

import duckdb
import pandas as pd
import pytest
from tokenizers import Tokenizer

from quillrank.llm.queries import ORACLES, QUERIES
from tests.oracle import connect, difference

from . import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs():
    return duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()


def rows(spark, name, *columns):
    table = QUERIES[name](spark, SF).select("doc_id", *columns).collect()
    got = {r[0]: tuple(r[1:]) for r in table}
    assert len(got) == len(table)
    return got


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    got, want = QUERIES[name](spark, SF).toPandas(), connect(SF).execute(ORACLES[name]).df()
    if "rank" in got:  # a missing rank makes a column of floats of one engine's and of nullable integers of the other's
        got["rank"], want["rank"] = (x["rank"].fillna(0).astype("int64") for x in (got, want))
    assert difference(got, want) is None


def test_near(spark, docs):
    want = {d: (n, c, c == d) for d, (n, c) in brute.near(docs).items()}
    assert rows(spark, "op1_near_dedup", "n_shingles", "component_id", "kept") == want


def test_mixing(spark, docs):
    got = QUERIES["op2_mixing"](spark, SF).toPandas()
    assert got["size"].sum() == sum(len(brute.WORD.findall(t or "")) for _, t in docs)
    assert (got.taken == got["size"] * got.copies).all() and got.copies.between(0, 2).all()
    by = got.groupby("source").agg(size=("size", "sum"), told=("source_size", "first"), target=("target", "first"),
                                   taken=("taken", "sum"))
    assert (by["size"] == by.told).all()
    weight = dict(zip(sorted(by.index), [3, 1, 2] * 10))
    goal, full, left = {}, set(), 1.5 * by["size"].sum()
    while True:  # stop at the limit, reshare the rest
        share = {s: left * weight[s] / sum(weight[x] for x in weight if x not in full) for s in weight if s not in full}
        over = [s for s in share if share[s] > 2 * by["size"][s]]
        goal |= share
        if not over:
            break
        for s in over:
            goal[s] = 2.0 * by["size"][s]
            left -= goal[s]
            full.add(s)
    assert all(abs(by.target[s] - goal[s]) < 1e-6 * goal[s] for s in goal)
    largest = got.groupby("source")["size"].max()
    assert ((by.taken - by.target).abs() <= largest[by.index]).all()
    again = QUERIES["op2_mixing"](spark, SF).toPandas()
    pd.testing.assert_frame_equal(got.sort_values("doc_id", ignore_index=True), again.sort_values("doc_id", ignore_index=True))


def test_language(spark):
    got = QUERIES["op4_language_id"](spark, SF).toPandas()
    told = duckdb.sql(f"select doc_id, lang from '{SF}/documents.parquet'").df().merge(got, on="doc_id")
    assert len(told) == len(got) == 200 and got.score.between(0, 1).all()
    assert (told[told.held_out].lang == told[told.held_out].lang_pred).mean() > 0.95


def test_quality_model(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op5_quality_model"](spark, sf).toPandas()
    told = duckdb.sql(f"select * from '{sf}/labels.parquet'").df().merge(got, on="doc_id")
    assert len(got) == 1000 and got.score.between(0, 1).all() and ((got.score >= 0.3).astype(int) == got.predicted).all()
    assert (told[told.held_out].quality == told[told.held_out].predicted).mean() > 0.95


def test_licenses(spark, docs):
    got = rows(spark, "op6_license_scan", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert got == {d: brute.phrases(t) for d, t in docs}


def test_bpe(spark, docs):
    import public_tokenizers
    tool = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tool.no_truncation(), tool.no_padding()
    want = {}
    for d, t in docs:
        ids = tool.encode(t or "", add_special_tokens=False).ids
        want[d] = (len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(tool.decode(ids, skip_special_tokens=False)))
    assert rows(spark, "op7_bpe", "n_tokens", "ids_sha256", "decoded_sha256") == want


def test_quality_rules(spark, docs):
    got = rows(spark, "op8_quality_rules", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert got == {d: brute.figures(t) for d, t in docs}


def test_quality_rules_keep_good_texts(spark):
    got = QUERIES["op8_quality_rules"](spark, SF).toPandas()
    told = duckdb.sql(f"select * from '{SF}/labels.parquet'").df().merge(got, on="doc_id")
    alive = told[~told.base_failed]
    assert (alive.kept == (alive.quality == 1)).mean() > 0.95


def test_substrings(spark, docs):
    assert rows(spark, "op9_substring_dedup", "n_words", "n_removed", "kept_sha256") == brute.passages(docs)


def test_importance(spark, docs):
    target = [t for (t,) in duckdb.sql(f"select text from '{SF}/benchmark.parquet'").fetchall()]
    assert rows(spark, "op11_importance", "n_features", "weight", "score", "rank") == brute.importance(docs, target)


def test_pii(spark, docs):
    got = rows(spark, "op12_pii", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")
    for d, t in docs:
        base = brute.pii(t)
        listed = [f"{kind}:{a}:{b}" for a, _, kind, b in base]
        assert got[d][:5] == (*(sum(x[2] == k for x in base) for k in brute.PII), brute.sha(",".join(listed)))
        assert set(listed) <= set(filter(None, got[d][5].split(",")))


def test_collocations(spark):
    texts = duckdb.sql(f"select lang, text from '{SF}/documents.parquet'").fetchall()
    assert sorted(map(tuple, QUERIES["op13_collocations"](spark, SF).collect())) == brute.collocations(texts)


def test_pipeline(spark):
    import corpus_pipeline as p
    table = spark.read.parquet(f"{SF}/documents.parquet")
    seen = [table]
    for _, stage in p.STAGES:
        seen.append(p.saved(stage(spark, seen[-1], SF), "test"))
    texts = [[(r.doc_id, r.text) for r in t.collect()] for t in seen[:5]]
    assert all(t.columns == table.columns for t in seen[:5])
    assert {d for d, t in texts[0]} - {d for d, _ in texts[1]} == {d for d, t in texts[0] if not any(map(str.isalpha, t))}
    assert {d for d, _ in texts[2]} == {d for d, x in brute.exact(texts[1]).items() if x[2]}
    assert {d for d, _ in texts[3]} == {d for d, (_, c) in brute.near(texts[2]).items() if c == d}
    copies = pd.Series([d for d, _ in texts[4]]).value_counts()
    assert copies.max() <= 2 and set(copies.index) <= {d for d, _ in texts[3]}
    assert sorted(r.doc_id for r in seen[5].collect()) == sorted(d for d, _ in texts[4])
