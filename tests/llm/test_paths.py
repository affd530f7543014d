"""The paths that small tables seldom take: collisions, splits, pivots, merge order, hot groups."""

import random
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quillrank.llm import (bpe, common, exact_dedup, license_rules, line_dedup, mixing, near_dedup, quality_rules,
                           substring_dedup, words)

from . import brute


def frame(spark, texts):
    return spark.createDataFrame(list(texts), "doc_id long, text string")


def test_join_sized_gives_each_row_once(spark):
    left = frame(spark, [(d, "hot" if d % 3 else f"k{d}") for d in range(300)])
    groups = left.groupBy("text").count()
    got = common.join_sized(left, groups, ["text"], "count", 300, share=10)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, left.join(groups, "text").select("text", "doc_id", "count").collect()))


def test_directory_splits_only_full_buckets(spark):
    keys = spark.range(3000).selectExpr("xxhash64(id) key")
    slots, _ = exact_dedup.directory(keys, capacity=100)
    depth = keys.count() and exact_dedup.directory(keys, 100)[1]
    fill = (keys.selectExpr(f"shiftrightunsigned(key, {64 - depth}) slot").join(slots, "slot")
            .groupBy("bucket").count().collect())
    assert sum(r["count"] for r in fill) == 3000 and max(r["count"] for r in fill) <= 100


def test_colliding_keys_are_chained(spark):
    texts = [(d, f"text {d // 2}" + " " * (d % 5)) for d in range(80)]
    got = exact_dedup.exact_duplicates(frame(spark, texts), capacity=4, key_bits=3).collect()
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got} == brute.exact(texts)


def test_chains_hold_each_text_of_a_key_once(spark):
    """The index decides: one link per different text, in the bucket that owns the key, heads first by rank."""
    texts = [(d, f"text {d // 4}" + " " * (d % 3)) for d in range(40)] + [(None, "text 0"), (None, "lone"), (3, "lone"), (3, "other")]
    docs = frame(spark, texts)
    stored = exact_dedup.entries(docs, 2).drop("norm")
    got = exact_dedup.index(docs, stored, 2, 2).collect()
    assert len(got) == 12 and sum(r.group_size for r in got) == len(texts)
    for key in {r.key for r in got}:
        own = sorted((r for r in got if r.key == key), key=lambda r: r.chain)
        assert [r.chain for r in own] == list(range(1, len(own) + 1)) and len({r.bucket for r in own}) == 1


def test_near_groups_need_several_pivots(spark):
    """A chain of texts, each close to the next alone, and a star of edits around one text."""
    rng = random.Random(3)
    base = [f"w{k}" for k in range(300)]
    texts = [(d, " ".join(base[4 * d:] + [f"z{k}" for k in range(4 * d)])) for d in range(25)]
    centre = [f"v{k}" for k in range(120)]
    for d in range(100, 150):  # one edit keeps 111 of 121 shingles; two copies share 106 of 126, too few
        copy = list(centre)
        copy[rng.randrange(10, 110)] = f"edit{d}"
        texts.append((d, " ".join(copy)))
    texts.append((150, " ".join(centre)))
    want = brute.near(texts)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(frame(spark, texts)).collect()}
    assert got == want and len({c for _, c in want.values()}) < 30


def test_rows_of_one_id_connect_what_their_texts_resemble(spark):
    """Two texts under one doc_id, and rows without doc_id, which are documents of their own."""
    a, b = (" ".join(f"{x}{k}" for k in range(60)) for x in "ab")
    got = {(r.doc_id, r.n_shingles): r.component_id for r in near_dedup.near_duplicates(
        frame(spark, [(1, a + " x"), (2, b + " x"), (5, a), (5, b + " y z")])).collect()}
    assert got == {(1, 57): 1, (2, 57): 1, (5, 56): 1, (5, 58): 1}
    apart = near_dedup.near_duplicates(frame(spark, [(1, a + " x"), (2, b + " x"), (None, a), (None, b + " y z")])).collect()
    assert sorted((r.doc_id or 0, r.component_id) for r in apart) == [(0, 1), (0, 2), (1, 1), (2, 2)]


def test_a_crowd_of_unlike_texts_makes_few_pairs(spark, monkeypatch):
    """All share their buckets, each pair differs in too many places; most pairs fail the bounds before any is compared."""
    rng, base, texts = random.Random(6), [f"w{k}" for k in range(200)], []
    for d in range(300):
        copy = list(base)
        for k in rng.sample(range(5, 195), 5):
            copy[k] = f"e{d}x{k}"
        texts.append((d, " ".join(copy)))
    pairs, plain = [], near_dedup.saved
    monkeypatch.setattr(near_dedup, "saved", lambda df, name: (lambda out: (pairs.append(out.count()) if name == "near-pairs" else None, out)[1])(plain(df, name)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(frame(spark, texts)).collect()}
    assert got == brute.near(texts)
    assert sum(pairs) < 10 * len(texts)


def test_maps_bound_what_sets_share(spark):
    rng = random.Random(2)
    texts = {d: " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(4, 90))) for d in range(40)}
    s = near_dedup.Settings(bits=256)
    maps = {r.id: r.map for r in near_dedup.bitmaps(frame(spark, texts.items()).toDF("id", "text"), s).collect()}
    sets = {d: brute.shingles(t) for d, t in texts.items()}
    for x in sets:
        for y in sets:
            apart = sum(((a ^ b) & (1 << 64) - 1).bit_count() for a, b in zip(maps[x], maps[y]))
            if min(len(texts[x].split()), len(texts[y].split())) >= 5:
                assert len(sets[x] & sets[y]) <= (len(sets[x]) + len(sets[y]) - apart) / 2


def test_sequential_test_keeps_what_may_be_similar():
    bounds = near_dedup.least_matches(near_dedup.Settings())
    assert [n for n, _ in bounds] == [25, 50, 75, 100, 125]
    assert all(m < 0.85 * n for n, m in bounds) and bounds[-1][1] > 60
    rng = np.random.default_rng(1)
    drawn = rng.random((200_000, 125)) < 0.85
    lost = np.zeros(len(drawn), bool)
    for n, least in bounds:
        lost |= drawn[:, :n].sum(axis=1) < least
    assert lost.mean() < 1e-4


def test_signatures_estimate_similarity():
    a, b = np.arange(2000, dtype=np.uint64), np.arange(300, 2300, dtype=np.uint64)
    sig = near_dedup.signatures(words.mix(np.r_[a, b]), np.array([0, 2000, 4000]), 500)
    assert abs((sig[0] == sig[1]).mean() - 1700 / 2300) < 0.08


ALPHABET = "aab bc\n"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(ALPHABET, max_size=80), min_size=1, max_size=6))
def test_spans_and_fingerprints(texts):
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    offsets = np.r_[0, np.cumsum([len(x) for x in raw])].astype(np.int64)
    starts, ends, bounds = words.spans(data, offsets)
    want = [x.split() for x in raw]
    assert [data[a:b].tobytes() for a, b in zip(starts, ends)] == [w for ws in want for w in ws]
    assert np.diff(bounds).tolist() == [len(ws) for ws in want]
    codes = words.fingerprints(data, starts, ends)
    flat = [w for ws in want for w in ws]
    assert len(set(codes.tolist())) == len(set(flat))
    window, whole = words.windows(codes, bounds, 3)
    assert int(whole.sum()) == sum(max(0, len(ws) - 2) for ws in want)


def test_long_words_have_fingerprints():
    data = np.frombuffer(b"x" * 5000 + b" abc " + b"x" * 5000 + b" " + b"x" * 5001, np.uint8)
    codes = words.fingerprints(data, *words.spans(data, np.array([0, len(data)]))[:2])
    assert codes[0] == codes[2] and len(set(codes.tolist())) == 3


def thue_morse(n, swap=False):
    return "".join("ab"[k.bit_count() % 2 ^ swap] for k in range(n))


@pytest.mark.parametrize("size", [1024, 2048])
def test_words_built_to_collide_stay_apart(spark, size):
    """Polynomials modulo a power of two give these two words one value, whatever their base."""
    x, y = thue_morse(size), thue_morse(size, True)
    other = [f"w{k}" for k in range(19)]
    text = " ".join([x, *other, y, *other, "end"])
    assert len(set(words.fingerprints(*(lambda d: (d, *words.spans(d, np.array([0, len(d)]))[:2]))(
        np.frombuffer(f"{x} {y}".encode(), np.uint8))).tolist())) == 2
    docs = frame(spark, [(1, text), (2, " ".join([x, *other[:4], y, *other[:4]]))])
    assert {r.doc_id: (r.n_words, r.n_removed) for r in substring_dedup.substring_dedup(docs).collect()} == {
        d: v[:2] for d, v in brute.passages([tuple(r) for r in docs.collect()]).items()}
    assert {r.doc_id: (r.n_repeat_words, r.base_failed) for r in quality_rules.quality_rules(docs).collect()} == {
        r.doc_id: brute.figures(r.text)[4:] for r in docs.collect()}
    assert {r.doc_id: r.n_shingles for r in near_dedup.near_duplicates(docs).collect()} == {
        r.doc_id: len(brute.shingles(r.text)) for r in docs.collect()}


def test_texts_of_many_lines_take_linear_time(spark):
    line = "a line that is long enough to be counted as one"
    texts = [(d, "\n".join([line, *(f"own line {d} {k}" for k in range(50_000)), line])) for d in range(5)]
    began = time.time()
    got = {r.doc_id: (r.n_lines, r.n_dropped, brute.sha(r.kept)) for r in line_dedup.line_dedup(frame(spark, texts)).collect()}
    assert time.time() - began < 60 and got == brute.lines(texts)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=60), min_size=2, max_size=5), st.integers(0, 2**32))
def test_equal_windows_share_anchor_keys(texts, seed):
    """Whatever stands around them; random codes make the halves of the alphabet differ from run to run."""
    code = np.random.default_rng(seed).integers(0, 2**63, 4).astype(np.uint64)
    bounds = np.r_[0, np.cumsum([len(t) for t in texts])]
    codes = code[np.array([c for t in texts for c in t], np.int64)] if bounds[-1] else np.zeros(0, np.uint64)
    key, first, last = substring_dedup.anchors(codes, bounds, 20)
    anchor = {}
    for k, a, b in zip(key.tolist(), first.tolist(), last.tolist()):
        for p in range(a, b + 1):
            assert anchor.setdefault(tuple(codes[p:p + 20].tolist()), k) == k
    assert int((last - first + 1).sum()) == sum(max(0, len(t) - 19) for t in texts)


def test_passages_against_brute_force(spark):
    rng = random.Random(5)
    texts = []
    for d in range(60):
        w = [rng.choice("abc") * rng.randrange(1, 3) for _ in range(rng.randrange(0, 150))]
        if d and rng.random() < 0.6:
            other = brute.WORD.findall(texts[rng.randrange(d)][1])
            k = rng.randrange(len(other) + 1)
            w[len(w) // 2:len(w) // 2] = other[k:k + rng.randrange(60)]
        texts.append((d, rng.choice([" ", "\n", " \t"]).join(w)))
    texts += [(100, "x " * 500), (101, "y " + "x " * 40), (102, texts[3][1]), (103, texts[3][1])]
    got = substring_dedup.substring_dedup(frame(spark, texts)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, brute.sha(r.kept)) for r in got} == brute.passages(texts)


@pytest.fixture(scope="module")
def coder():
    import public_tokenizers
    return bpe.Encoder(bpe.vocabulary()), Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_bpe_on_odd_texts(coder):
    own, tool = coder
    rng = random.Random(2)
    texts = ["", " ", "a" * 4000, "ha" * 500, "Σίσυφος ΟΔΟΣ", "İstanbul", "a\x1cb\x1fc\x85d", "don't WE'LL 's''s",
             "<|startoftext|>Hi<|ENDOFTEXT|><|endoftext|>", "é ﬁ ½ ²", "🎉👨‍👩‍👧", "\x00\x01", "中文字符"]
    texts += ["".join(rng.choice("aeioustnrlhdc 'é!.0Σ<|>\n") for _ in range(150)) for _ in range(200)]
    ids, bounds, decoded = own.encode(texts)
    for i, text in enumerate(texts):
        want = tool.encode(text, add_special_tokens=False).ids
        assert ids[bounds[i]:bounds[i + 1]].tolist() == want
        assert decoded[i] == tool.decode(want, skip_special_tokens=False)


def test_bpe_forgets_without_changing_its_answer(coder, monkeypatch):
    own, _ = coder
    texts = [f"word{k} and number {k * k}" for k in range(300)]
    once = own.encode(texts)
    monkeypatch.setattr(bpe, "REMEMBERED", 10)
    again = [own.encode([t]) for t in texts]
    assert np.concatenate([x[0] for x in again]).tolist() == once[0].tolist()


def test_bpe_remembers_no_long_chunks(coder, monkeypatch):
    own, tool = coder
    own.forget()
    monkeypatch.setattr(bpe, "REMEMBERED_CHARS", 3000)
    for k in range(12):
        text = f"{'xyz' * 300}{k} short"
        ids, _, _ = own.encode([text])
        assert ids.tolist() == tool.encode(text, add_special_tokens=False).ids
        assert own.chars <= 3000 + len(text) and sum(map(len, own.known)) <= 3000 + 2 * len(text)


def test_decode_undoes_encode(spark):
    docs = frame(spark, [(1, "Some plain words"), (2, None), (3, "<|endoftext|> & more")])
    encoded = bpe.encode(docs)
    assert {tuple(r) for r in bpe.decode(encoded.drop("decoded")).collect()} == {
        tuple(r) for r in encoded.select("doc_id", "decoded").collect()}


def test_rules_match_only_behind_their_gates():
    """Every rule's pattern needs one of its keywords and one of the gates."""
    assert len(license_rules.rules()) > 300
    for rule in license_rules.rules():
        plain = rule.pattern.replace("(?: ", " (?:").replace("licen[cs]e", "license")
        assert any(g in plain for g in license_rules.GATES) or "cc by" in plain, rule
        assert any(k.split()[-1] in plain for k in rule.keyword.split("|")), rule


def test_mix_splits_hot_sizes_and_reaches_targets(spark):
    texts = [(d, "same words here " * 4, "big") for d in range(900)] + [(1000 + d, "w " * (d + 1), None) for d in range(60)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, source string")
    got = mixing.mix(docs, part_rows=50).toPandas()
    assert len(got) == 960
    for _, g in got.groupby("source", dropna=False):
        assert abs(g.taken.sum() - g.target.iloc[0]) <= g["size"].max()
