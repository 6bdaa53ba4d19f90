"""Operators 11 to 13 and the reworked parts of 3, 6 and 9, against plain-Python versions."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from flightlake.llm import bagminhash, bond, curve_packing, encoder, mixing, packing, periodic_runs, queries, token_files
from flightlake.llm import textkit as T

SF = "/root/testdata/sf0.001"


def tokens(name, texts):
    tok = Tokenizer.from_file(public_tokenizers.path(name))
    tok.encode_special_tokens = True
    return [e.ids for e in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]


# ---- the shared encoder

@pytest.mark.parametrize("name,style", [("word_bpe_49k.json", "words"), ("byte_bpe_50k.json", "spaces")])
def test_encoder_on_odd_texts(name, style):
    rnd = random.Random(8)
    letters = [*"aZbé×÷ßİıÀÿ.,;:!?'\"01 \n\t  \r-_ñЖ漢😀́​\u0085\xa0　ªµſﬁ", "<|endoftext|>", "'s", "</w>", "Ġ"]
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 25))) for _ in range(3000)]
    texts += ["İ.", "aİ.", "İ, b", "xİİ; y", "", "a" * 5000, "The the THE the, The, the."]
    enc = encoder.CachedEncoder(public_tokenizers.path(name), style)
    for part in (texts, texts[::-1]):           # the second time from the cache
        ids, at = enc.encode(pa.array(part))
        assert [ids[s:e].tolist() for s, e in zip(at, at[1:])] == tokens(name, part)


# ---- 3

def test_crowd_of_nearly_alike_texts_costs_few_pairs():
    """Texts that share 0.7 of their shingles pairwise: the pairs that the second level would verify, per text,
    stay far under the pairs there are; pairs at 0.8 and more share a band at the documented rate."""
    (_, _, _), (rows, bands, _) = bagminhash.LEVELS
    rnd = np.random.default_rng(1)

    def pairs_of(n, alike):
        """n texts whose pairs overlap by alike: each keeps a share of common shingles and has its own besides."""
        size = 300
        common = round(size * 2 * alike / (1 + alike))
        base = rnd.integers(1, 1 << 62, common).astype(np.uint64)
        doc = np.repeat(np.arange(n), size)
        names = np.concatenate([np.concatenate((base, rnd.integers(1, 1 << 62, size - common).astype(np.uint64))) for _ in range(n)])
        hashes = bagminhash.band_hashes(bagminhash.signatures(doc, names, np.ones(n * size, int), n, rows * bands), rows)
        buckets = defaultdict(list)
        for i, row in enumerate(hashes.tolist()):
            for h in row:
                buckets[h].append(i)
        return {(a, b) for m in buckets.values() for a in m for b in m if a < b}

    few, many = len(pairs_of(40, 0.7)) / 40, len(pairs_of(160, 0.7)) / 160
    assert many < 0.25 * 159 / 2 and few < 0.25 * 39 / 2
    assert len(pairs_of(40, 0.81)) >= 0.9 * 40 * 39 / 2


def test_crowded_buckets_give_the_classes_of_brute_force(spark):
    """A group grown from one text by edits, from few to many: hubs, crowds and texts linked to none."""
    rnd = random.Random(3)
    base = [f"w{i}" for i in range(150)]
    rows = [(0, " ".join(base))]
    for i in range(1, 260):
        words = list(base)
        for _ in range(rnd.randint(1, 14)):
            words[rnd.randrange(150)] = f"x{rnd.randrange(10 ** 6)}"
        rows.append((i, " ".join(words)))
    got = {r.doc_id: r.class_id for r in bagminhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4, "doc_id")).collect()}
    want = brute.classes(rows)
    assert len(set(want.values())) > 20 and Counter(want.values())[0] > 20
    assert sum(got[d] == want[d] for d in want) >= 0.98 * len(want)
    assert all(want[got[d]] == want[d] for d in want)                  # never more than there is


def test_keep_first_with_any_column_names(spark):
    rows = [(1, "a b c d e f g", "x"), (2, "a b c d e f g", "y"), (3, None, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, own_key string").selectExpr("*", "'k' as _kept_id", "1 as _text_key", "2 as id", "3 as key", "4 as row")
    got = bagminhash.keep_first(docs)
    assert got.columns == docs.columns and sorted((r.doc_id, r.own_key) for r in got.collect()) == [(1, "x"), (3, "z")]


# ---- 6, 9

def test_copies_apart_in_best_fit():
    rnd = np.random.default_rng(2)
    for _ in range(50):
        n = int(rnd.integers(1, 60))
        lengths, copies = rnd.integers(1, 41, n), rnd.integers(-1, 6, n)
        bins, offsets, fill = packing.best_fit_decreasing(lengths, 40, copies)
        for b in range(len(fill)):
            inside = np.flatnonzero(bins == b)
            assert fill[b] == lengths[inside].sum() <= 40
            twins = copies[inside][copies[inside] >= 0]
            assert len(set(twins.tolist())) == len(twins)
            at = inside[np.argsort(offsets[inside])]
            assert offsets[at].tolist() == (np.cumsum(lengths[at]) - lengths[at]).tolist()


def test_mixing_takes_any_column_names(spark):
    names = ["passes", "extra", "salt", "plan_source", "row", "id", "use", "weight", "mix_key", "mix_source"]
    docs = spark.createDataFrame([(i, f"one two {i}", "a" if i % 3 else "b") for i in range(60)], "doc_id long, text string, source string")
    docs = docs.selectExpr("*", *[f"{k} as {n}" for k, n in enumerate(names)])
    mixed = mixing.mix_sources(docs, max_repeats=2.0, blocks=16)
    assert len(set(mixed.columns)) == len(mixed.columns) and set(docs.columns) <= set(mixed.columns)
    got = mixed.collect()
    assert {r.doc_id for r in got} == set(range(60)) and all((r.passes, r.extra, r.salt, r.row, r.id) == (0, 1, 2, 4, 5) for r in got)
    assert {r.mix_source for r in got} == {"a", "b"}
    assert mixing.mixed_order(mixed, docs.columns).columns == docs.columns


# ---- 2

def test_files_are_read_back_by_a_task_each(spark, tmp_path, sf_docs):
    joining = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(joining, "false")            # several files of a small table
    try:
        manifest = token_files.write_token_files(sf_docs, str(tmp_path / "tokens"), public_tokenizers.path("byte_bpe_50k.json"))
    finally:
        spark.conf.set(joining, "true")
    spans = token_files.read_token_spans(manifest)
    assert spans.rdd.getNumPartitions() >= manifest.count() > 1


# ---- 11

def test_hilbert_curve_is_one():
    """Every cell once, and a step along the curve is a step of one cell in one dimension."""
    for dims, bits in ((2, 4), (3, 3), (4, 2), (6, 1)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        key = curve_packing.hilbert_key(grid.astype(np.uint64), bits)
        assert sorted(key.tolist()) == list(range(1 << dims * bits))
        assert (np.abs(np.diff(grid[np.argsort(key)], axis=0)).sum(1) == 1).all()


def check_curve(df, packed, capacity):
    texts = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    want = Counter((d, np.array([*ids, 1], "<u4").tobytes()) for (d, _), ids in zip(texts, tokens("word_bpe_49k.json", [t for _, t in texts])))
    total = sum(len(ids) // 4 * n for (_, ids), n in want.items())
    sequences = defaultdict(list)
    for r in packed:
        sequences[r.sequence_id].append(r)
    padding = 0
    for rows in sequences.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    assert sum(r.length for r in packed) == total and padding == 0
    if len(want) == len(texts) and None not in {d for d, _ in texts}:
        parts = defaultdict(list)
        for r in packed:
            parts[r.doc_id].append(r)
        for d, ids in want:
            at = 0
            for r in sorted(parts[d], key=lambda r: r.start):
                assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids) // 4, zlib.crc32(ids[4 * at:4 * (at + r.length)]))
                at += r.length
            assert at == len(ids) // 4


def test_curve_packing(spark, sf_docs, odd_docs, empty_docs):
    path = public_tokenizers.path("word_bpe_49k.json")
    check_curve(sf_docs, queries.op11_curve_packing(spark, SF).collect(), 2048)
    check_curve(sf_docs, curve_packing.pack_along_curve(sf_docs, path, part_tokens=9000).collect(), 2048)
    check_curve(odd_docs, curve_packing.pack_along_curve(odd_docs, path, capacity=500, part_tokens=3000).collect(), 500)
    assert curve_packing.pack_along_curve(empty_docs, path).count() == 0


def test_neighbours_on_the_curve_are_alike(spark, sf_docs):
    """Documents that follow one another share far more words than documents at random."""
    texts = {r.doc_id: set((r.text or "").lower().split()) for r in sf_docs.collect()}
    rows = curve_packing.pack_along_curve(sf_docs, public_tokenizers.path("word_bpe_49k.json")).where("start = 0").orderBy("sequence_id", "offset").collect()
    order = [r.doc_id for r in rows]
    alike = lambda ids: np.mean([len(texts[a] & texts[b]) / max(1, len(texts[a] | texts[b])) for a, b in zip(ids, ids[1:])])
    shuffled = random.Random(1).sample(order, len(order))
    assert alike(order) > 1.5 * alike(shuffled)


def test_rest_is_cut_by_its_binary_digits():
    firsts, numbers = curve_packing.rest_sequences(2048 * 3 + 1300, 2048)
    assert (firsts - 2048 * 3).tolist() == [0, 1024, 1024 + 256, 1024 + 256 + 16] and numbers.tolist() == [3, 4, 5, 6]
    assert curve_packing.cut(100, 2048 * 3 + 1000, 2048 * 3 + 1300, 2048, firsts, numbers) == [(0, 24, 3, 1000), (24, 76, 4, 0)]
    assert len(curve_packing.rest_sequences(4096, 2048)[0]) == 0


# ---- 12

def brute_negatives(rows, modulus):
    good = [(i, [math.floor(256 * x) for x in v], c) for i, v, c in rows
            if i is not None and c is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    score = lambda a, b: max(-(1 << 63), min((1 << 63) - 1, sum(x * y for x, y in zip(a, b))))
    out = set()
    for a, w, label in good:
        if a % modulus:
            continue
        ranked = sorted((-score(w, v), i) for i, v, c in good if c == label and i != a)[:5]
        for minus, p in ranked:
            near = sorted((-score(w, v), i) for i, v, c in good if c != label and i != a and 80 * -minus <= 100 * score(w, v) <= 100 * -minus)[:5]
            out |= {(a, p, k + 1, i, -minus, -s) for k, (s, i) in enumerate(near)}
    return sorted(out)


COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def test_bond_equals_brute_force(spark):
    rnd = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rnd.normal(size=12).round(3)], int(rnd.integers(0, 4))) for i in range(300)]
    rows += [(300 + i, [float(x) for x in rnd.integers(-1, 2, 12)], 1) for i in range(60)]                 # many ties
    rows += [(400, None, 1), (401, [None] * 12, 1), (402, [float("nan")] * 12, 1), (403, [float("inf")] * 12, 1), (404, [1.0] * 12, None),
             (405, [1.0, 0.5], 2), (410, [0.0] * 12, 0), (420, [1e17] + [0.0] * 11, 0), (430, [-1e17] + [0.5] * 11, 3), (None, [1.0] * 12, 1), (440, [], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "1 as block", "2 as grp", "3 as v").repartition(5, "vec_id")
    want = brute_negatives(rows, 10)
    for options in ({}, {"block_rows": 40, "group_rows": 7}):
        got = bond.mine_hard_negatives(df, F.col("vec_id") % 10 == 0, **options)
        assert sorted(tuple(r) for r in got.select(*COLUMNS).collect()) == want
    empty = bond.mine_hard_negatives(df.where("false"), F.col("vec_id") % 10 == 0)
    assert empty.count() == 0


def test_bond_prunes(spark):
    """Candidates leave the bitmap before the last dimension, and none that counts."""
    rnd = np.random.default_rng(3)
    rows = rnd.normal(size=(4000, 64)) * np.exp(-np.arange(64) / 8)
    table = pa.table({"vec_id": pa.array(range(4000)), "label": pa.array([0] * 4000), "v": pa.array(rows.tolist())})
    block = bond.Block(table, 256.0)
    w = block.columns[:, 7].copy()
    sizes = []

    def useful(low, high):
        stays = high >= bond.kth_best(low, 5) if len(low) > 5 else np.ones(len(low), bool)
        sizes.append(int(stays.sum()))
        return stays

    alive, scores = block.scan(w, np.arange(4000), useful)
    best = np.argsort(-(w @ block.columns), kind="stable")[:5]
    assert set(best) <= set(alive) and sizes[-2] < 400 and sizes == sorted(sizes, reverse=True)


# ---- 13

def brute_runs(words, power=4):
    n, out = len(words), []
    for q in range(1, n // power + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            e = i + q
            if e - s >= power * q and not any(words[s:e - x] == words[s + x:e] for x in range(1, q)):
                out.append((s, e - s, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_of_random_words():
    rnd = random.Random(5)
    for _ in range(300):
        docs = []
        for _ in range(rnd.randint(1, 5)):
            k, n = rnd.choice([1, 2, 2, 3, 40]), rnd.randint(0, 150)
            w = [rnd.randrange(k) for _ in range(n)]
            for _ in range(rnd.randint(0, 4) if n > 10 else 0):
                a, p, length = rnd.randrange(n), rnd.randint(1, 30), rnd.randint(1, n)
                for i in range(a + p, min(n, a + p + length)):
                    w[i] = w[i - p]
            docs.append(w)
        off = np.concatenate(([0], np.cumsum([len(d) for d in docs])))
        s, e, q = periodic_runs.find_runs(T.mix64(np.array([x for d in docs for x in d], np.uint64) + np.uint64(77)), off)
        want = [(a + o, b, c) for d, o in zip(docs, off.tolist()) for a, b, c in brute_runs(d)]
        assert list(zip(s.tolist(), (e - s).tolist(), q.tolist())) == want


def contract_row(doc_id, text):
    words = brute.WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    number = {}
    runs = [r for r in brute_runs([number.setdefault(w, len(number)) for w in words]) if r[1] >= 6]
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    top = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else (None,) * 3
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *top, 1000 * top[1] // top[2] if runs else None, sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)),
            sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_periodic_runs_equal_brute_force(spark, sf_docs, odd_docs, empty_docs):
    short = F.coalesce(F.length("text"), F.lit(0)) < 9000           # the quadratic version's limit
    extra = [(1000 + i, " ".join(f"w{j % (3 + i % 9)}" for j in range(40 + 7 * i)), "x", "y", None) for i in range(60)]
    some = spark.createDataFrame(extra, sf_docs.schema).unionByName(sf_docs.where(short))
    key = lambda r: tuple((x is not None, x) for x in r)
    for df in (some, odd_docs.where(short)):
        planted = periodic_runs.with_planted_periods(df)
        got = periodic_runs.run_digests(periodic_runs.periodic_runs(planted)).drop("n_words").collect()
        want = [contract_row(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
        assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert sum(r[1] for r in want) >= 1
    assert periodic_runs.periodic_runs(empty_docs).count() == 0
    assert queries.op13_periodic_runs(spark, SF).count() == sf_docs.count()


def test_runs_need_four_periods(odd_docs):
    with pytest.raises(ValueError):
        periodic_runs.periodic_runs(odd_docs, min_power=3)
    long = periodic_runs.periodic_runs(odd_docs.where("doc_id = 9")).first()
    assert [tuple(r) for r in long.runs] == [(0, 400, 1)] and long.collapsed == "same"
