"""Each operator against its plain-Python version, on the smallest driver tables and on odd ones."""

import hashlib
import itertools
import math
import zlib
from fractions import Fraction

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from flightlake.llm import (
    bagminhash, lpf_dedup, mixing, ordinal, packing, pii_crf, pitman_yor, queries, repetition, token_files, topk,
)
from flightlake.llm import textkit as T
from flightlake.llm.components import components
from flightlake.llm.corpus import pack, unpack
from flightlake.session import scratch_path

SF = "/root/testdata/sf0.001"


def ids_of(name, texts, end):
    tok = Tokenizer.from_file(public_tokenizers.path(name))
    tok.encode_special_tokens = True
    return [np.array(e.ids + [end], "<u4") for e in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def rows_of(df):
    return sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))


# ---- shared kernels

def test_words_and_hashes_do_not_depend_on_place():
    texts = ["ab  cd\nab", "", "ab", " cd", "é ab"]
    _, buf, off = next(T.text_blocks(pa.array(texts)))
    start, end, doc = T.words(buf, off)
    assert [bytes(buf[s:e]).decode() for s, e in zip(start, end)] == ["ab", "cd", "ab", "ab", "cd", "é", "ab"]
    assert doc.tolist() == [0, 0, 0, 2, 3, 4, 4]
    h = T.span_hash(T.prefix_hash(buf), start, end)
    assert h[0] == h[2] == h[3] == h[6] and h[1] == h[4] and len(set(h.tolist())) == 3


def test_blocks_skip_null_bytes_and_slices():
    a = pa.array(["x", None, "yz", "", "w"]).slice(1)
    parts = list(T.text_blocks(a, 2))
    assert [(f, bytes(b), (o[1:] - o[:-1]).tolist()) for f, b, o in parts] == [(0, b"yz", [0, 2, 0]), (3, b"w", [1])]


def test_pack_round_trip():
    arrays = [np.arange(5, dtype="<u8"), np.zeros(0, "<u4"), np.array([1.5, -2], "<f4"), np.array([3], "u1")]
    assert [a.tolist() for a in unpack(pack(*arrays))] == [a.tolist() for a in arrays]


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (3, 10), (20, 21), (21, 22), (22, 23), (23, 24), (24, 20)] + [(100, i) for i in range(101, 140)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "x long, y long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 10: 1, 8: 8, 9: 8, **{i: 20 for i in range(20, 25)}, **{i: 100 for i in range(100, 140)}}
    assert components(spark.createDataFrame([], "x long, y long")).count() == 0


# ---- 1

def brute_top(rows, k=5):
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in good:
        if q % 50 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return sorted(out)


def test_topk_odd_vectors(spark):
    rnd = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rnd.integers(-2, 3, 4)]) for i in range(120)]
    rows += [(150, None), (200, [1.0, None, 0.0, 0.0]), (250, [float("nan"), 0.0, 0.0, 0.0]), (300, [0.0, 0.0, 0.0, 0.0]), (301, [float("inf"), 1.0, 1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("x"))
    got = topk.top_k(df, df.where("vec_id % 50 = 0"), block_rows=16, group_rows=2)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == brute_top(rows)
    assert topk.top_k(df.limit(0), df.limit(0)).count() == 0
    huge = spark.createDataFrame([(0, [1e15, 1e15]), (1, [1e15, 1.0]), (2, [3e14, 2.0])], "vec_id long, embedding array<double>")
    assert [r.vec_id for r in topk.top_k(huge, huge.where("vec_id = 0"), scale=1.0).orderBy("rank").collect()] == [1, 2]
    vast = [(0, [1e-2, 1.0]), (1, [1e17, 0.0]), (2, [1.7e308, -1.0]), (3, [5e18, 0.0]), (4, [-1e300, 3.0]), (5, [3e14, 1.0]), (6, [0.0, 2.0])]
    df = spark.createDataFrame(vast, "vec_id long, embedding array<double>")
    got = [(r.vec_id, r.score) for r in topk.top_k(df, df.where("vec_id = 0"), k=6).orderBy("rank").collect()]
    whole = {i: [math.floor(Fraction(x) * 256) for x in v] for i, v in vast}
    want = [(i, max(-(1 << 63), min((1 << 63) - 1, sum(a * b for a, b in zip(whole[0], w))))) for i, w in whole.items() if i]
    assert got == sorted(want, key=lambda x: (-x[1], x[0]))


# ---- 2

def check_spans(df, spans):
    start, want = 0, []
    rows = rows_of(df)
    for (d, t), ids in zip(rows, ids_of("byte_bpe_50k.json", [t for _, t in rows], 0)):
        want.append((d, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = [(r.doc_id, r.n_tokens, r.ids_crc32) for r in spans]
    assert sorted(got, key=str) == sorted(want, key=str)
    by_place = sorted(spans, key=lambda r: r.start)
    assert [r.start for r in by_place] == np.cumsum([0] + [r.n_tokens for r in by_place])[:-1].tolist()
    ids = [r.doc_id for r in by_place if r.doc_id is not None]
    assert ids == sorted(ids)


def test_token_files(spark, odd_docs, sf_docs, empty_docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    for df in (odd_docs, sf_docs):
        check_spans(df, token_files.token_spans(spark, df, scratch_path(spark, "t"), path, seq_len=64, batch_rows=3).collect())
    assert token_files.token_spans(spark, empty_docs, scratch_path(spark, "t"), path).count() == 0
    manifest = token_files.write_token_files(odd_docs, scratch_path(spark, "t"), path, seq_len=64, batch_rows=3).collect()
    for m in manifest:
        batches, index = token_files.open_sequences(m.path)
        assert all(b.schema.field("ids").type == pa.list_(pa.uint16(), 64) for b in batches) and index.num_rows == m.n_docs
        assert sum(b.column("mask").flatten().sum().as_py() for b in batches) == m.n_tokens


# ---- 3

def test_bagminhash_estimates_weighted_jaccard():
    rnd = np.random.default_rng(2)
    a, b = rnd.integers(1, 30, 60), rnd.integers(1, 30, 60)
    names = T.mix64(np.arange(60, dtype=np.uint64))
    doc = np.repeat([0, 1], 60)
    sig = bagminhash.signatures(doc, np.concatenate((names, names)), np.concatenate((a, b)), 2, 4096)
    assert abs((sig[0] == sig[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.03
    assert np.isinf(bagminhash.signatures(np.zeros(0, int), np.zeros(0, np.uint64), np.zeros(0, int), 1, 8)).all()


def test_near_duplicates(spark, sf_docs, sf_rows, odd_docs, empty_docs):
    got = {r.doc_id: r.class_id for r in bagminhash.near_duplicates(sf_docs).collect()}
    assert got == brute.classes(sf_rows)
    odd = bagminhash.near_duplicates(odd_docs).collect()
    assert len(odd) == odd_docs.count()
    by_id = {(r.doc_id, r.class_id) for r in odd}
    assert {(1, 1), (2, 1), (12, 1), (3, 3), (4, 4), (5, 5), (16, 16), (17, 17)} <= by_id
    kept = bagminhash.keep_first(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(d) for d in [1, 3, 4, 5, 6, 7, 8, 9, 10, 11, 13, 14, 15, 16, 17, None])
    assert bagminhash.near_duplicates(empty_docs).count() == 0


@pytest.mark.parametrize("ids", [(None, 5), (None, None)])
def test_near_copies_without_an_id_are_linked(spark, ids):
    words = [f"w{i}" for i in range(200)]
    df = spark.createDataFrame([(ids[0], " ".join(words)), (ids[1], " ".join([*words, "more"])), (7, "another text")], "doc_id long, text string")
    got = bagminhash.near_duplicates(df).where("doc_id IS NULL OR doc_id <> 7").collect()
    assert [r.class_docs for r in got] == [2, 2] and sum(r.is_first for r in got) == 1


def test_chained_near_copies_are_one_class(spark):
    """A large group of near copies, each alike to some but not to all of the others: no link is lost."""
    words = [f"w{i}" for i in range(120)]
    docs = []
    for d in range(60):
        text = words.copy()
        for k in range(d // 3):
            text[6 * (k % 20)] = f"v{k}"
        docs.append((d, " ".join(text) + f" tail{d}"))
    docs += [(1000 + d, " ".join(f"z{d}x{i}" for i in range(50))) for d in range(10)]
    got = {r.doc_id: r.class_id for r in bagminhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == brute.classes(docs)


# ---- 4

def test_base_spans_equal_the_patterns():
    texts = ["a@b.c d@e x.y@z-1.co.uk.", "@a.b a@@b.c a@b@c.d", "1.2.3.4.5.6.7.8 300.1.1.1 1.1.1.1", "4012 8888 8888 1881 9 4012888888881881",
             "+1 (017) 555-7713 +12 +1234567890123456 ++44 20 7946 0958", "0" * 3000, "a" * 3000 + "@x.y", "é+1 (017) 555-7713, ça@b.fr", "", "1-2 3-4 5678 9012 3456-"]
    for t in texts:
        assert pii_crf.base_spans(t) == brute.base_spans(t), t
    assert pii_crf.base_spans("9" * 5000 + ".1.1.1") == []


def test_pii(spark, sf_docs, sf_rows, odd_docs, empty_docs):
    for df, rows in ((sf_docs, sf_rows), (odd_docs, None)):
        found = pii_crf.find_pii(df).collect()
        texts = rows or rows_of(df)
        want = sorted(hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in brute.base_spans(t or "")).encode()).hexdigest() for _, t in texts)
        assert sorted(r.base_sha256 for r in found) == want
        assert all(set(s.split(",")) >= set(f"{k}:{a}:{b}" for k, a, b in brute.base_spans(dict(texts)[r.doc_id] or "")) - {""} for r in found if r.doc_id and r.doc_id != 16 for s in [r.spans])
    assert pii_crf.find_pii(empty_docs).count() == 0
    clean = pii_crf.redact(odd_docs)
    assert clean.columns == odd_docs.columns
    got = {r.doc_id: r.text for r in clean.collect()}
    assert got[11] == "mail me: [EMAIL], [IP] or [PHONE]" and got[3] is None and got[6].startswith("één naïve")


def test_skip_chain_carries_a_label_to_an_alike_token(spark):
    """A number proven to be a card by its digits makes its other spelling, which no pattern takes, a card too."""
    card = "4012888888881881"
    odd = "4012.8888.8888.1881"
    docs = [(i, f"pay with {card} now") for i in range(40)] + [(99, f"pay with {card} now, I repeat, pay with {odd} now")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    text = docs[-1][1]
    potentials = pii_crf.train_potentials(df)
    base, added = pii_crf.all_spans(text, potentials, 3.0, 0.9)
    assert ("card", *[text.index(card), text.index(card) + 16]) in base
    loose = pii_crf.marginals(np.array([[0.0, -9, -9, 0.0, -9], [-30.0, -30, -30, 0, -30]]), [[0, 1]], np.zeros((5, 5)), 3.0)
    alone = pii_crf.marginals(np.array([[0.0, -9, -9, 0.0, -9], [-30.0, -30, -30, 0, -30]]), [], np.zeros((5, 5)), 3.0)
    assert loose[0, 3] > 0.9 > alone[0, 3]
    assert np.allclose(loose.sum(1), 1)
    assert added == [("card", text.index(odd), text.index(odd) + len(odd))]


def test_numbers_side_by_side_are_found_apart(spark):
    """Matches that the base patterns lose to a neighbour become spans of the field, and are redacted; numbers inside hashes don't."""
    phone, ip, card, other = "+1 (826) 555-4081", "190.137.223.204", "4845168114407329", "4012888888881881"
    docs = [f"call {phone[:-2]}{i:02} or write from {ip} and pay with {c} now" for i in range(50) for c in (card, other)]
    docs += [f'token = "b0{i}f-c{572391524 + i}f37a8" here' for i in range(50)]
    odd = [f"seen {phone} {ip} there", f"seen {card} {other} there", f"seen {phone} {card} there", f"seen {' '.join([card, other] * 30)} there", 'token = "ede4f6405768150e04" here',
           "(" * 5000 + "@" * 500 + "1 " * 5000, "9" * 5000]
    df = spark.createDataFrame(list(enumerate(docs + odd)), "doc_id long, text string")
    found = {r.doc_id - len(docs): r for r in pii_crf.find_pii(df).collect()}
    assert all(found[i].n_added == 0 for i in range(-len(docs), 0))
    assert [found[i].n_added for i in range(len(odd))] == [1, 2, 2, 60, 0, 0, 0]
    assert found[0].spans == "ip:23:38,phone:5:22" and found[1].spans == "card:5:21,card:22:38"
    clean = {r.doc_id - len(docs): r.text for r in pii_crf.redact(df).collect()}
    assert [clean[i] for i in range(3)] == ["seen [PHONE] [IP] there", "seen [CARD] [CARD] there", "seen [PHONE] [CARD] there"]
    assert clean[3] == f"seen {' '.join(['[CARD]'] * 60)} there"


def test_marginals_equal_all_labellings_of_a_small_tree():
    """On a graph without a loop, message passing gives the marginals of the sum over all labellings."""
    rng = np.random.default_rng(4)
    nodes, chain, prior, skip = rng.normal(size=(3, 5)), rng.normal(size=(5, 5)), np.log(rng.dirichlet(np.ones(5))), 2.0
    same = 1 / (1 + np.exp(-skip))
    for groups, linked in (([], None), ([[0, 2]], 0.0)):
        steps = chain if linked is None else np.zeros((5, 5))       # the chain and the tie would close a loop
        want = np.zeros((3, 5))
        for x in itertools.product(range(5), repeat=3):
            w = np.exp(sum(nodes[i, k] for i, k in enumerate(x)) + steps[x[0], x[1]] + steps[x[1], x[2]])
            if groups:
                w *= same * (x[0] == x[2]) / np.exp(prior[x[0]]) + 1 - same
            for i, k in enumerate(x):
                want[i, k] += w
        got = pii_crf.marginals(nodes, groups, steps, skip, rounds=60, prior=prior)
        assert np.allclose(got, want / want.sum(1, keepdims=True), atol=1e-6)


@pytest.mark.parametrize("times", [1, 100])
def test_alike_spellings_are_added_in_a_corpus_of_any_size(spark, times):
    """Unproven tokens of the same shape, after the same word and after the same label, do not outvote a tie."""
    card, phone = "4012888888881881", "+1 (017) 555-7713"
    odd_card, odd_phone = "4012.8888.8888.1881", "1.017.555.7713"
    text = f"pay with {card} now, I repeat, pay with {odd_card} now; call {phone} or dial {odd_phone} today"
    docs = [f"pay with {card} now" for _ in range(20 * times)] + [f"write with a{i}@b.example now" for i in range(20 * times)]
    docs += [f"pay with {1000 + i}.{2000 + i}.8888.1881 or dial 2.{100 + i % 800}.555.7713 now" for i in range(60 * times)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*docs, text])], "doc_id long, text string")
    found = pii_crf.find_pii(df).where(F.col("doc_id") == len(docs)).first()
    for kind, token in (("card", odd_card), ("phone", odd_phone)):
        s = text.index(token)
        assert f"{kind}:{s}:{s + len(token)}" in found.spans.split(",")
    assert found.n_added == 2


# ---- 5

@pytest.mark.parametrize("options", [{}, {"crowd": 1, "chunk_bytes": 20_000, "bucket_bytes": 50_000}, {"crowd": 3, "max_contexts": 2, "chunk_bytes": 50_000}])
def test_removed_passages(sf_docs, sf_rows, options):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in lpf_dedup.remove_repeats(sf_docs, **options).collect()}
    assert got == brute.removed(sf_rows)


def test_removed_passages_odd(spark, odd_docs, empty_docs):
    line = "this very passage of a few words stands in many documents, and so it goes on and on. "
    docs = [(i, f"{brute_text(i)} {line * (1 + i % 2)}{brute_text(i + 500)}") for i in range(60)]
    docs += [(100, line), (101, line[:49]), (102, line[:50]), (103, "é" * 40), (104, "é" * 41), (105, None), (106, ""), (107, "ab" * 200), (108, "x" + "ab" * 30)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    for options in ({}, {"crowd": 1, "chunk_bytes": 500}, {"max_contexts": 1}):
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in lpf_dedup.remove_repeats(df, **options).collect()}
        assert got == brute.removed(docs), options
    odd = lpf_dedup.remove_repeats(odd_docs, with_text=True).collect()
    assert len(odd) == odd_docs.count() and all(len(r.kept) == r.n_bytes - r.n_removed for r in odd)
    assert {r.n_removed for r in odd if r.doc_id == 16} == {0}        # equal ids do not remove each other
    assert lpf_dedup.remove_repeats(empty_docs).count() == 0


def brute_text(i):
    return " ".join(f"{chr(97 + (i * 7 + k) % 26)}{i}q{k}" for k in range(12))


def test_longest_previous_factors():
    texts = [b"abcdefghijklmnop", b"xxcdefghijklmyy", b"abcdefgh--------"]
    buf = np.frombuffer(b"".join(texts) + bytes(24), np.uint8)
    doc = np.repeat([0, 1, 2], [len(t) for t in texts])
    places = np.arange(len(doc))
    got = lpf_dedup.longest_previous_factors(lpf_dedup.prefix_ranks(buf, 10), places, doc)
    joined = b"".join(texts) + bytes(24)
    for p in places:
        exact = max([next((k for k in range(10) if joined[p + k] != joined[q + k]), 10) for q in places if doc[q] < doc[p]], default=0)
        assert got[p] == (10 if exact == 10 else 8 if exact >= 8 else 0)
    rng = np.random.default_rng(5)
    for depth in (9, 16, 24, 50):
        buf = np.concatenate([rng.integers(0, 2, 4000).astype(np.uint8), np.tile(np.arange(7, dtype=np.uint8), 300), np.zeros(depth + 8, np.uint8)])
        places = np.sort(rng.choice(len(buf) - depth, 1500, replace=False))
        doc = rng.integers(0, 40, len(places))
        every, some = lpf_dedup.prefix_ranks(buf, depth), lpf_dedup.prefix_ranks(buf, depth, places)
        assert [k for k, _ in some] == [depth]
        want = lpf_dedup.longest_previous_factors(every, places, doc) >= depth
        assert want.any() and (want == (lpf_dedup.longest_previous_factors(some, places, doc) >= depth)).all()


# ---- 6

def check_packing(df, packed, capacity):
    want = {}
    rows = rows_of(df)
    for (d, t), ids in zip(rows, ids_of("word_bpe_49k.json", [t for _, t in rows], 1)):
        for k, i in enumerate(range(0, len(ids), capacity)):
            want.setdefault((d, k), []).append((i, len(ids[i:i + capacity]), zlib.crc32(ids[i:i + capacity].tobytes())))
    got = {}
    for r in packed:
        got.setdefault((r.doc_id, r.piece), []).append((r.start, r.length, r.ids_crc32))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    bins = {}
    for r in packed:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in bins.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= capacity
    return len(bins)


def test_packing(sf_docs, odd_docs, empty_docs):
    path = public_tokenizers.path("word_bpe_49k.json")
    for df, capacity in ((sf_docs, 4096), (odd_docs, 512)):
        packed = packing.pack_documents(df, path, capacity=capacity).collect()
        used = check_packing(df, packed, capacity)
        counts = np.bincount([r.length for r in packed], minlength=capacity + 1)
        assert used == packing.bin_bound(counts)
        dealt = packing.pack_documents(df, path, capacity=capacity, part_pieces=60).collect()
        assert used <= check_packing(df, dealt, capacity) <= used + 2          # partitions exchanged what they had left
    assert packing.pack_documents(empty_docs, path).count() == 0


def test_bin_bound_is_a_lower_bound():
    rnd = np.random.default_rng(3)
    for _ in range(40):
        lengths = rnd.integers(1, 61, rnd.integers(1, 40))
        counts = np.bincount(lengths, minlength=61)
        _, _, fill = packing.best_fit_decreasing(lengths, 60)
        assert -(-lengths.sum() // 60) <= packing.bin_bound(counts) <= len(fill) and fill.sum() == lengths.sum()
    assert packing.bin_bound(np.bincount([31] * 7, minlength=61)) == 7        # two never fit


# ---- 7

def test_repetition_counts(sf_docs, sf_rows, odd_docs, empty_docs):
    for df, rows in ((sf_docs, sf_rows), (odd_docs, rows_of(odd_docs))):
        got = sorted((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in repetition.quality_rules(df).collect())
        assert got == sorted(brute.rules(t) for _, t in rows)
    assert repetition.quality_rules(empty_docs).count() == 0


def test_repeats_and_cover():
    rnd = np.random.default_rng(4)
    texts = [" ".join(rnd.choice(list("abc"), n)) for n in (1, 2, 30, 60)] + ["a " * 40, "", "p q r s p q r s t p q r"]
    _, buf, off = next(T.text_blocks(pa.array(texts)))
    start, end, doc = T.words(buf, off)
    longest = repetition.repeats(T.span_hash(T.prefix_hash(buf), start, end), doc)
    want = [x for t in texts for x in brute.longest_repeats(t.split())]
    assert longest.tolist() == want
    cover = repetition.covered_words(longest, doc, 3)
    at = 0
    for t in texts:
        n = len(t.split())
        marks = {k for i in range(n) if want[at + i] >= 3 for k in range(i, i + want[at + i])}
        assert np.flatnonzero(cover[at:at + n]).tolist() == sorted(marks)
        at += n


def test_repetition_verdict(spark):
    clean = " ".join(f"word{i}" for i in range(200))
    twice = clean + " " + clean
    df = spark.createDataFrame([(1, clean), (2, twice), (3, "spam ham " * 100)], "doc_id long, text string")
    assert {r.doc_id: r.kept for r in repetition.quality_rules(df).collect()} == {1: True, 2: False, 3: False}


# ---- 8

def test_ordinal_learns_graded_words(spark):
    rnd = np.random.default_rng(5)
    rows, grades = [], []
    for d in range(400):
        g = d % 3
        words = [f"w{rnd.integers(300)}" for _ in range(60)] + [f"tox{rnd.integers(3)}"] * (2 * (g == 0)) + [f"bad{rnd.integers(5)} ###"] * (8 * (g < 2))
        rows.append((d, " ".join(words)))
        grades.append((d, g))
    docs, graded = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(grades, "doc_id long, grade int")
    model = ordinal.train(docs, graded.where("doc_id < 300"), bits=14)
    assert model.thresholds[0] < model.thresholds[1]
    held = [r for r in ordinal.score(docs, model).collect() if r.doc_id >= 300]
    assert sum(r.kept == (r.doc_id % 3 == 2) for r in held) >= 0.95 * len(held)
    means = [np.mean([r.expected_grade for r in held if r.doc_id % 3 == g]) for g in range(3)]
    assert means[0] < means[1] < means[2]
    again = ordinal.train(docs, graded.where("doc_id < 300"), bits=14)
    assert np.array_equal(again.weights, model.weights)


def test_ordinal_gradient():
    """One step from the start follows the numeric slope of the likelihood."""
    doc, feature, grade = np.array([0, 0, 1, 2, 2, 3]), np.array([1, 2, 2, 1, 3, 3]), np.array([0, 2, 1, 2])
    model = ordinal.fit(doc, feature, grade, 4, steps=400, rate=0.1, l2=0.01, min_docs=1)

    def loss(w, t):
        s = np.bincount(doc, w[feature], minlength=4)
        c = 1 / (1 + np.exp(-(np.concatenate(([-np.inf], t, [np.inf]))[None] - s[:, None])))
        return -np.log(c[np.arange(4), grade + 1] - c[np.arange(4), grade]).mean() + 0.005 * (w ** 2).sum()

    best = loss(model.weights, model.thresholds)
    for k in (1, 2, 3):
        for e in (-0.05, 0.05):
            w = model.weights.copy()
            w[k] += e
            assert loss(w, model.thresholds) >= best - 1e-6


def test_ordinal_odd(spark, odd_docs, empty_docs):
    labels = spark.createDataFrame([(1, 1, 0), (9, 0, 0), (8, None, 0), (None, 1, 1), (4, 0, 1), (1, 1, 0)], "doc_id long, quality int, toxic int")
    graded = ordinal.grade_labels(labels)
    assert sorted((r.doc_id, r.grade) for r in graded.distinct().collect()) == [(1, 2), (4, 0), (9, 1)]
    model = ordinal.train(odd_docs, graded, bits=10)
    assert ordinal.score(odd_docs, model).count() == odd_docs.count()
    none = ordinal.train(odd_docs, graded.limit(0), bits=10)
    assert ordinal.select_documents(odd_docs, none).count() == odd_docs.count()
    assert all(r.kept for r in ordinal.score(odd_docs, none).collect())
    assert ordinal.select_documents(odd_docs, model).columns == odd_docs.columns
    assert ordinal.score(empty_docs, model).count() == 0


# ---- 9

def test_mixing_repeats_and_budget(spark):
    rows = [(i, "one two three four", "big" if i < 800 else "mid" if i < 1000 else "small" if i < 1040 else None) for i in range(1050)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.mix_sources(docs, max_repeats=3.0, blocks=256).collect()
    uses = {}
    for r in mixed:
        uses.setdefault((r.source, r.doc_id), []).append(r.mix_pass)
    assert len(uses) == 1050 and all(sorted(p) == list(range(len(p))) for p in uses.values())
    mean = {s: np.mean([len(p) for (t, _), p in uses.items() if t == s]) for s in ("big", "mid", "small", None)}
    e = 1 - math.log(3) / math.log(800 / 10)                       # the least source is used three times
    for s, n in (("big", 800), ("mid", 200), ("small", 40), (None, 10)):
        assert abs(mean[s] - (800 / n) ** (1 - e)) < 0.15
    assert max(len(p) for p in uses.values()) <= 3
    keys = {s: np.sort([r.mix_key for r in mixed if r.source == s]) for s in ("big", "mid")}
    for k in keys.values():
        assert np.abs(k - (np.arange(len(k)) + 0.5) / len(k)).max() < 0.12     # evenly spread
    half = mixing.mix_sources(docs, max_repeats=3.0, blocks=256, budget_tokens=2000.0)
    assert abs(half.agg(F.sum("mix_tokens")).first()[0] - 2000) < 200


def test_mixing_entropy_and_odd(spark, odd_docs, empty_docs):
    totals = spark.createDataFrame([(1000,), (100,), (10,)], "tokens long")
    for target in (0.5, 0.9, 1.05):
        e = mixing.find_exponent(totals, target, None)
        p = np.array([1000.0, 100, 10]) ** e
        p /= p.sum()
        assert abs(-(p * np.log(p)).sum() - target) < 1e-6
    assert mixing.find_exponent(totals, 5.0, None) == 0.0 and mixing.find_exponent(totals, 0.0, None) == 1.0
    assert mixing.find_exponent(totals, None, 1.0) == 1.0 and mixing.find_exponent(totals, None, 100.0) == 0.0
    mixed = mixing.mix_sources(odd_docs, max_repeats=2.0)
    assert {(r.doc_id, r.text) for r in mixed.collect()} == {(r.doc_id, r.text) for r in odd_docs.collect()}
    assert mixing.mixed_order(mixed, odd_docs.columns).columns == odd_docs.columns
    assert mixing.mix_sources(empty_docs, max_repeats=2.0).count() == 0


def test_permutations(spark):
    for turn in range(4):
        got = [r.p for r in spark.range(64).select(mixing.permuted(F.col("id"), F.lit(turn), 64).alias("p")).collect()]
        assert sorted(got) == list(range(64))


# ---- 10

def test_pitman_yor(sf_docs, sf_rows, odd_docs, empty_docs):
    for df, rows, options in ((sf_docs, sf_rows, {}), (sf_docs, sf_rows, {"chunk_bytes": 5_000, "bucket_bytes": 20_000})):
        got = {r.doc_id: r for r in pitman_yor.language_model_scores(df, **options).collect()}
        for d, (held, n, known, total, base) in brute.base_scores(rows).items():
            r = got[d]
            assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
            assert math.isclose(r.base_score, base, rel_tol=1e-9)
            assert -400 * n < r.score < 0
        held = [r for r in got.values() if r.held_out]
        assert sum(r.score for r in held) > sum(r.base_score for r in held)       # it predicts held-out texts better
    odd = pitman_yor.language_model_scores(odd_docs)
    rows = odd.collect()
    assert len(rows) == odd_docs.count() and all(math.isfinite(r.score) for r in rows)
    assert [r.held_out for r in rows if r.doc_id is None] == [True]
    assert pitman_yor.perplexity(odd).count() == 2
    assert pitman_yor.language_model_scores(empty_docs).count() == 0


def test_pitman_yor_probabilities_sum_to_one():
    """Over the known words and one unknown, in every context, after every sweep."""
    rnd = np.random.default_rng(6)
    words = np.sort(T.mix64(np.arange(200, dtype=np.uint64)) & ~np.uint64(0xFF))
    keys = np.unique(np.concatenate([w | rnd.integers(0, 4, 3).astype(np.uint64) for w in words[:, None]]))
    counts = rnd.integers(1, 40, len(keys))
    kind = (keys & np.uint64(0xFF)).astype(int)
    prior = pitman_yor.Prior(sweeps=1, burn_in=0)
    customers = np.bincount(kind, counts, minlength=256)
    tables = np.bincount(kind, minlength=256).astype(float)
    totals = pitman_yor.Totals(customers, tables, 200.0, 200, int(counts.sum()))
    for _ in range(40):          # the totals settle where the sweep gives back what it was given
        got = pitman_yor.sweep_bucket(keys, counts, totals, prior)
        totals = pitman_yor.Totals(customers, got["tables"], float(got["root_tables"]), 200, totals.train_tokens)
    word, n, _ = pitman_yor.split_keys(keys)
    of = np.repeat(np.arange(200), n)
    back = totals.back_off(prior)
    for c in range(4):
        mine = kind == c
        p = back[c] * got["word"]
        p[of[mine]] = got["key"][mine]
        assert abs(p.sum() + back[c] * totals.new_root(prior) - 1) < 0.03
    assert got["word"].sum() + totals.new_root(prior) == pytest.approx(1, abs=0.03)


def test_pitman_yor_tells_all_words_before_apart(spark):
    """Each of 2,000 words has a context of its own, so the word after it is foreseen; buckets share the contexts' totals."""
    df = spark.createDataFrame([(i, f"a{i} b{i} " * 40) for i in range(1000)], "doc_id long, text string")
    for options in ({}, {"chunk_bytes": 50_000, "bucket_bytes": 50_000}):
        got = pitman_yor.language_model_scores(df, **options).where("not held_out").selectExpr("avg(score / n_tokens) AS a", "min(score / n_tokens) AS m").first()
        assert got.a > -0.25 and got.m > -0.4, (got, options)


def test_seats_follow_the_restaurant():
    """The mean number of tables of c customers with a steady opening weight."""
    customers = np.full(20_000, 12)
    seed = T.mix64(np.arange(20_000, dtype=np.uint64))
    got = pitman_yor.seat(customers, np.full(20_000, 1.5), 0.5, seed).mean()
    rnd = np.random.default_rng(7)
    tables = np.ones(20_000)
    for i in range(1, 12):
        tables += rnd.random(20_000) < 1.5 / (1.5 + i - 0.5 * tables)
    assert abs(got - tables.mean()) < 0.05


@pytest.mark.parametrize("n, others", [(2, 0), (9, 3), (90, 4), (300, 40)])
def test_tables_are_drawn_from_their_posterior(n, others):
    """Repeated steps from kept tables give the exact conditional, by generalised Stirling numbers, for few and for many customers."""
    prior, rows = pitman_yor.Prior(), 4000
    d, d0 = prior.discount, prior.root_discount
    full = lambda x: np.full(rows, float(x))
    rest = pitman_yor.Rest(full(20), full(others), full(1), 3000.0, 800.0, 1 / 500)
    t = np.arange(1, n + 1)
    log_p = [pitman_yor.log_stirling(np.array([n]), np.array([k]), d)[0] + pitman_yor.log_stirling(np.array([others + k]), np.array([1]), d0)[0]
             + math.lgamma(prior.strength / d + 20 + k) + k * math.log(d) - math.lgamma(prior.root_strength + 3000 + k) for k in t]
    p = np.exp(np.array(log_p) - max(log_p))
    p /= p.sum()
    tables, customers = full(1), np.full(rows, n)
    for k in range(150):
        tables = pitman_yor.reseat(customers, tables, rest, prior, T.mix64(np.arange(rows, dtype=np.uint64) + np.uint64(k * rows)))
    seen = np.bincount(tables.astype(int), minlength=n + 1)[1:] / rows
    assert abs(seen - p).sum() / 2 < 0.05
    assert abs(tables.mean() - (t * p).sum()) < 0.1 * max(1, (t * p).sum() / 5)


def exact_stirling(n, most, d):
    """Log of the Stirling numbers of n customers at 0 to most tables, by their recursion."""
    row, k = np.full(most + 1, -np.inf), np.arange(1, most + 1)
    row[0] = 0.0
    with np.errstate(divide="ignore"):
        for i in range(n):
            row[1:], row[0] = np.logaddexp(row[1:] + np.log(np.maximum(i - d * k, 0)), row[:-1]), -np.inf
    return row


@pytest.mark.parametrize("d", [0.3, 0.7, 0.8])
def test_stirling_numbers_of_many_customers(d):
    want = exact_stirling(3000, 3000, d)
    t = np.array([1, 2, 3, 7, 30, 150, 700, 1500, 2500, 2900, 3000])
    n = np.full(len(t), 3000)
    assert np.abs(pitman_yor.log_stirling(n, t, d) - want[t]).max() < 1e-3
    assert np.isneginf(pitman_yor.log_stirling(np.array([2000, 2000]), np.array([0, 2001]), d)).all()
    low = t[:-1]
    assert np.abs(pitman_yor.one_more_table(n[:-1], low, d) - (want[low + 1] - want[low])).max() < 1e-3
    assert pitman_yor.one_more_table(np.array([3000]), np.array([2999]), d)[0] == pytest.approx(want[3000] - want[2999], abs=1e-6)
    more = exact_stirling(3020, 3000, d)
    assert np.abs(pitman_yor.more_customers(n, np.full(len(t), 20), t, d, np.full(len(t), np.nan)) - (more[t] - want[t]))[:7].max() < 5e-3       # tables few against customers
    # a single customer, and numbers on either side of the table's end
    assert pitman_yor.log_stirling(np.array([10**8]), np.array([1]), d)[0] == pytest.approx(math.lgamma(1e8 - d) - math.lgamma(1 - d), abs=1e-3)
    assert pitman_yor.more_customers(np.array([1024]), np.array([1]), np.array([50]), d, np.array([np.nan]))[0] == pytest.approx(
        exact_stirling(1025, 50, d)[50] - exact_stirling(1024, 50, d)[50], abs=1e-3)


def test_tables_of_many_customers_are_drawn_from_their_posterior():
    """10,000 customers of a word in a restaurant, 3,000 more in the root: the steps move and give the exact conditional."""
    prior, rows, n, others = pitman_yor.Prior(), 400, 10_000, 3000
    d, d0, most = prior.discount, prior.root_discount, 300
    full = lambda x: np.full(rows, float(x))
    rest = pitman_yor.Rest(full(600), full(others), full(40), 80_000.0, 9000.0, 1 / 5000)
    t = np.arange(1, most + 1)
    shift = pitman_yor.shift_of(np.array([others]), np.array([40]), d0)[0]
    root = np.array([math.lgamma(others + k - shift) for k in t])
    log_p = (exact_stirling(n, most, d)[1:] + root + t * math.log(d)
             + np.array([math.lgamma(prior.strength / d + 600 + k) - math.lgamma(prior.root_strength + 80_000 + k) for k in t]))
    p = np.exp(log_p - log_p.max())
    p /= p.sum()
    tables, customers, moved = full(1), np.full(rows, n), 0.0
    for k in range(80):
        new = pitman_yor.reseat(customers, tables, rest, prior, T.mix64(np.arange(rows, dtype=np.uint64) + np.uint64(k * rows)))
        moved, tables = moved + (new != tables).mean() / 80, new
    mean = (t * p).sum()
    spread = math.sqrt(((t - mean) ** 2 * p).sum())
    assert moved > 0.3
    assert abs(tables.mean() - mean) < 4 * spread / math.sqrt(rows), (tables.mean(), mean, spread)
    assert abs(tables.std() - spread) < 0.2 * spread


def test_root_tables_pass_a_thousand():
    """A word with 5,000 customers in the root of a small vocabulary: its tables follow the exact conditional, without a cap."""
    prior, rows, n, base, others = pitman_yor.Prior(), 200, 5000, 0.3, 4000.0
    d = prior.root_discount
    t = np.arange(1, 5000)
    log_p = exact_stirling(n, 5000, d)[1:5000] + np.array([math.lgamma(prior.root_strength / d + others + k) for k in t]) + t * math.log(d * base)
    p = np.exp(log_p - log_p.max())
    p /= p.sum()
    mean = (t * p).sum()
    spread = math.sqrt(((t - mean) ** 2 * p).sum())
    tables, seed = np.full(rows, round(mean + 3 * spread) * 1.0), T.mix64(np.arange(rows, dtype=np.uint64))
    assert mean > 1024
    one = lambda r, k: pitman_yor.root_step(np.array([n]), r, others + r[0], base, prior, seed[k % rows:k % rows + 1], k)
    chain = [tables[:1]]
    for k in range(6000):
        chain.append(one(chain[-1], k))
    late = np.concatenate(chain[3000:])
    assert abs(late.mean() - mean) < 2 * spread, (late.mean(), mean, spread)


# ---- queries

def test_queries_are_registered():
    import __spark_entry__ as entry
    for n in range(1, 11):
        assert len([k for k in entry.queries() if k.startswith(f"op{n}_")]) == 1
    assert "pipeline" in entry.queries() and set(queries.ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("key", sorted(queries.QUERIES))
def test_query_runs_on_the_whole_table(spark, key):
    df = queries.QUERIES[key](spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert df.count() >= (docs if key != "op1_topk" else 5)
