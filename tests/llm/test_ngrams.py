"""The interning table, the summaries, the resampling draw and the transducers, on inputs that small tables lack."""

import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from quillrank.llm import collocations, importance, ngrams, pii

from . import brute


@pytest.fixture(scope="module")
def ranges():
    rng = random.Random(1)
    raw = bytes(rng.randrange(256) if rng.random() < 0.3 else 97 for _ in range(5000))
    starts = np.array([rng.randrange(4000) for _ in range(3000)])
    lengths = np.array([rng.choice([rng.randrange(40), rng.randrange(300), rng.randrange(900)]) for _ in starts])
    return np.frombuffer(raw + bytes(16), np.uint8), starts, lengths


def test_hashes_are_the_public_ones(ranges):
    buffer, starts, lengths = ranges
    parts = [buffer[a:a + n].tobytes() for a, n in zip(starts, lengths)]
    assert ngrams.xxhash64(*ranges).tolist() == [xxhash.xxh64_intdigest(x) for x in parts]
    assert ngrams.crc32(*ranges).tolist() == [zlib.crc32(x) for x in parts]


@pytest.mark.parametrize("keys", [None, lambda n: (n % 3).astype(np.uint64), lambda n: np.zeros(len(n), np.uint64)])
def test_interning_is_exact_even_if_keys_collide(ranges, keys):
    buffer, starts, lengths = (x[:600] if k else x for k, x in enumerate(ranges))
    table = ngrams.Interned(buffer, starts, lengths, keys and keys(lengths))
    parts = [buffer[a:a + n].tobytes() for a, n in zip(starts, lengths)]
    assert len(table.owner) == len(set(parts)) and table.count.sum() == len(parts)
    assert [parts[table.owner[k]] for k in table.slot] == parts


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text("aB 9é-.中", max_size=30), min_size=1, max_size=6))
def test_words_of_a_class(texts):
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    offsets = np.r_[0, np.cumsum([len(x) for x in raw])].astype(np.int64)
    starts, ends, bounds = ngrams.word_spans(data, offsets, importance.WORD)
    want = [[w.encode() for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)] for t in texts]
    assert [data[a:b].tobytes() for a, b in zip(starts, ends)] == [w for ws in want for w in ws]
    assert np.diff(bounds).tolist() == [len(ws) for ws in want]
    words = ngrams.Words(data, starts, ends)
    at, size = words.runs(np.arange(max(0, len(starts) - 1)), 2)
    flat = [w for ws in want for w in ws]
    assert [words.buffer[a:a + n].tobytes() for a, n in zip(at, size)] == [x + b" " + y for x, y in zip(flat, flat[1:])]


def test_merged_summaries_lose_no_frequent_key():
    rng = np.random.default_rng(2)
    stream = np.r_[rng.integers(0, 50_000, 200_000), np.repeat(np.arange(60_000, 60_040), 100), np.full(70_000, 7)].astype(np.uint32)
    rng.shuffle(stream)
    summary = collocations.Summary(len(stream) // 100 + 1)
    for part in np.split(stream, 37 * np.arange(1, len(stream) // 37)):
        summary.add(*np.unique(part, return_counts=True))
        if summary.waiting > 5000:
            summary.merge()
    summary.merge()
    assert len(summary.keys[0]) <= summary.capacity and 0 < summary.lost < 100
    true = dict(zip(*(x.tolist() for x in np.unique(stream, return_counts=True))))
    kept = dict(zip(summary.keys[0].tolist(), summary.counts[0].tolist()))
    assert all(kept.get(k, 0) <= n <= kept.get(k, 0) + summary.lost for k, n in true.items())
    assert all(k in kept for k, n in true.items() if n >= 100)


def test_a_full_filter_lets_more_through_and_never_less():
    h = ngrams.xxhash64(np.arange(16_000, dtype=np.uint16).view(np.uint8), 2 * np.arange(15_000), np.full(15_000, 2))
    own = h[collocations.part_of(h, 4) == 2][:2000]
    rest = h[collocations.part_of(h, 4) == 2][2000:]
    for most, rate in ((1 << 16, 0.05), (64, 1.0)):
        found = collocations.Filter([(2, *collocations.Filter.segment(own & np.uint64(0xFFFFFFFF), most))], 4)
        assert found.has(own).all() and found.has(rest).mean() <= rate
        assert not found.has(h[collocations.part_of(h, 4) != 2]).any()


def test_collocations_do_not_depend_on_how_summaries_are_cut(spark):
    rng = random.Random(4)
    texts = [(d % 3 and "en" or None, "".join(rng.choice(["a ", "b ", "c\t", "d ", "new york ", ". ", "É ", "x, "]) for _ in range(200)))
             for d in range(60)]
    docs = spark.createDataFrame(texts, "lang string, text string")
    want = brute.collocations(texts, least=20, top=30)
    for s in (collocations.Settings(least=20, top=30), collocations.Settings(least=20, top=30, flush=1000, blob=3, part_bytes=2000),
              collocations.Settings(least=20, top=30, filter_bytes=1)):
        assert sorted(map(tuple, collocations.collocations(docs, s).collect())) == want


def test_scores_pass_64_bits(spark):
    big = 10 ** 13
    counts = spark.createDataFrame([("en", "a b", 2, big), ("en", "a", 1, 2 * big), ("en", "b", 1, 3 * big), ("en", None, 0, 10 ** 15)],
                                   "lang string, phrase string, size int, f bigint")
    (row,) = collocations.scored(counts).collect()
    assert row.score == 1000 * big * 10 ** 15 // (6 * big * big)


def test_ties_go_to_the_smaller_id(spark):
    words = " ".join(f"w{k}" for k in range(30))
    docs = spark.createDataFrame([(d, words) for d in range(400)], "doc_id long, text string")
    got = {r.doc_id: (r.n_features, r.weight, r.score, r["rank"]) for r in importance.resample(docs, docs.limit(3)).collect()}
    assert got == brute.importance([(d, words) for d in range(400)], [words] * 3)


def test_detectors_against_plain_patterns():
    rng = random.Random(3)
    for alphabet in ("a@.-b1 ", "1.2 5", "0123456789 -+().", "a1@.+ (-)"):
        for _ in range(5000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(40)))
            assert [(x.start, pii.KINDS[x.kind], x.end) for x in pii.identifiers(text)] == [
                (a, kind, b) for a, _, kind, b in brute.pii(text)], text


DISGUISES = [
    ("write to john (at) example dot com now", "email", "john (at) example dot com"),
    ("John[AT]example[DOT]org", "email", "John[AT]example[DOT]org"),
    ("mail: a.b at mail dot example dot co dot uk!", "email", "a.b at mail dot example dot co dot uk"),
    ("john_at_example_dot_com", "email", "john_at_example_dot_com"),
    ("é јоhn@ехаmрlе.соm é", "email", "јоhn@ехаmрlе.соm"),
    ("x john＠example．com", "email", "john＠example．com"),
    ("jo​hn@exa​mple.com", "email", "jo​hn@exa​mple.com"),
    ("call plus one five five five two three four five six seven eight.", "phone",
     "plus one five five five two three four five six seven eight"),
    ("+1 (555) 123–4567 now", "phone", "+1 (555) 123–4567"),
    ("card 4111-one one one one-1111-one one one one ok", "card", "4111-one one one one-1111-one one one one"),
    ("quatre un un un, un un un un, un un un un, un un un un", "card", "quatre un un un, un un un un, un un un un, un un un un"),
    ("٤١١١ ١١١١ ١١١١ ١١١١", "card", "٤١١١ ١١١١ ١١١١ ١١١١"),
    ("ip 192[.]168[.]1[.]20 x", "ip", "192[.]168[.]1[.]20"),
    ("ip 192 dot 168 dot 1 dot 20", "ip", "192 dot 168 dot 1 dot 20"),
    ("one nine two dot one six eight dot one dot one", "ip", "one nine two dot one six eight dot one dot one"),
]


@pytest.mark.parametrize("text, kind, part", DISGUISES)
def test_disguised_identifiers_map_back_to_the_source(text, kind, part):
    found = pii.disguised(text, pii.identifiers(text))
    assert [(pii.KINDS[x.kind], text[x.start:x.end]) for x in found] == [(kind, part)]


@pytest.mark.parametrize("text", [
    "look at the dot matrix", "we met at example.com", "one two three", "seven eight nine ten eleven", "почта@example.com",
    "point at one dot two", "le point com", "(at) [dot]", "1.2.3", "at dot com", "five six seven eight who do we appreciate"])
def test_plain_prose_is_left_alone(text):
    assert pii.disguised(text, pii.identifiers(text)) == []


def test_base_spans_stay_beside_disguised_ones(spark):
    text = "a@b.com and c (at) d.org; 10.0.0.1"
    (row,) = pii.find_pii(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert [tuple(x) for x in row.base] == [("email", 0, 7), ("ip", 26, 34)]
    assert [tuple(x) for x in row.spans] == [("email", 0, 7), ("email", 12, 24), ("ip", 26, 34)]
    (plain,) = pii.redact(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert plain.text == "[EMAIL] and [EMAIL]; [IP]"


@settings(max_examples=200, deadline=None)
@given(st.text("a@.(t) dо１1one²", max_size=60))
def test_spans_lie_in_the_text_and_cut_no_word(text):
    base = pii.identifiers(text)
    for x in pii.disguised(text, base):
        assert 0 <= x.start < x.end <= len(text)
        assert not text[x.end:x.end + 1].isalnum() and not (x.start and text[x.start - 1].isalnum())
