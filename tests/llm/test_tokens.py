"""Encoding, packing, shards, neighbours."""

import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from corpusloom.llm import lexicon, neighbours, packing, sharding
from pyspark.sql import functions as F
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"


def _odd_texts(signs, n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(n)]


@pytest.fixture(scope="module")
def odd(spark):
    signs = list("ab Cé1'  \n\t 　sßΣİ́<😀.,lrẾ²½ª_\x1c\x85中文ñ") + ["<|endoftext|>", "'ll", "'s"]
    texts = _odd_texts(signs, 800, 3) + ["x" * 3_000, "ΑΣ ΣΑΣ. Σ", "", " ", None, " " * 500]
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = [(700_000 + i, t) for i, t in enumerate(texts)]
    return docs.unionByName(spark.createDataFrame(rows, "doc_id long, text string"))


def test_pieces_equal_the_library(spark, odd):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = {}
    for r in packing.token_pieces(odd, public_tokenizers.path("byte_bpe_50k.json")).collect():
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        assert len(ids) == r.length <= 1024
        pieces.setdefault(r.doc_id, []).append((r.piece, r.start, ids))
    for row in odd.collect():
        want = library.encode(row.text or "", add_special_tokens=False).ids + [2]
        held = sorted(pieces[row.doc_id])
        assert [i for _, _, ids in held for i in ids] == want
        assert [start for _, start, _ in held] == [sum(len(h[2]) for h in held[:k]) for k in range(len(held))]
        assert len(held) == -(-len(want) // 1024) and all(len(h[2]) == 1024 for h in held[1:])


def test_packing_places_every_piece(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice([5, 1024, rng.randint(1, 500), rng.randint(1, 500)]), "x") for i in range(3_000)]
    pieces = spark.createDataFrame(rows, "id long, length long, tokens string")
    got = packing.pack(pieces).collect()
    assert sorted((r.id, r.length, r.tokens) for r in got) == sorted(rows)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 1024
    total = sum(r[1] for r in rows)
    assert len(sequences) <= 1.02 * -(-total // 1024)
    assert packing.pack(pieces.where("false")).count() == 0
    with pytest.raises(ValueError):
        packing.pack(pieces.withColumn("length", F.lit(2_000)))


@pytest.mark.parametrize("seed", range(4))
def test_plan_uses_every_piece_and_is_no_worse_than_best_fit(seed):
    rng = random.Random(seed)
    histogram = {n: rng.randint(1, 500) for n in rng.sample(range(1, 101), rng.randint(1, 60))}
    plan, fit = packing.plan(histogram, 100), packing.best_fit(histogram, 100)
    for patterns in (plan, fit):
        used = Counter()
        for p in patterns:
            assert sum(n * k for n, k in p.pieces) <= 100
            for n, k in p.pieces:
                used[n] += k * p.times
        assert dict(used) == histogram
    assert sum(p.times for p in plan) <= sum(p.times for p in fit)


def _optimum(pieces, capacity):
    """Fewest sequences, by trying every subset that fits."""
    whole = (1 << len(pieces)) - 1
    fits = [m for m in range(1, whole + 1) if sum(p for i, p in enumerate(pieces) if m >> i & 1) <= capacity]
    need = {0: 0}
    for mask in range(1, whole + 1):
        need[mask] = 1 + min(need[mask & ~m] for m in fits if m & mask == m and m >> (mask.bit_length() - 1) & 1)
    return need[whole]


@pytest.mark.parametrize("seed", range(6))
def test_plan_meets_the_optimum_of_small_histograms(seed):
    rng = random.Random(100 + seed)
    for _ in range(12):
        pieces = [rng.randint(8, 60) for _ in range(rng.randint(1, 9))]
        histogram = dict(Counter(pieces))
        plan = packing.plan(histogram, 100, nodes=100_000)
        assert sum(p.times for p in plan) == _optimum(pieces, 100)
        assert packing.lower_bound(histogram, 100) <= _optimum(pieces, 100)


def test_plan_of_large_histograms_against_the_bound():
    """Many big pieces: never worse than best fit, and within 3 % of the bound."""
    rng = random.Random(8)
    for _ in range(3):
        histogram = {n: rng.randint(1, 400) for n in rng.sample(range(200, 701), 300)}
        sizes = [sum(p.times for p in f(histogram, 1024)) for f in (packing.plan, packing.best_fit)]
        bound = packing.lower_bound(histogram, 1024)
        assert bound <= sizes[0] <= sizes[1] and sizes[0] <= 1.03 * bound
    assert packing.plan({}, 10) == []


def test_fillings_are_all_and_undominated():
    left = {5: 2, 4: 1, 3: 3, 2: 2}
    found = list(packing.fillings(left, 10, 3))
    kept = [tuple(f) for f in found if f is not None]
    assert kept[0] == (5, 5) and len(kept) == len(set(kept))
    assert all(sum(f) >= 7 and all(f.count(n) <= left[n] for n in f) for f in kept)
    everything = {
        (5,) * a + (4,) * b + (3,) * c + (2,) * d
        for a in range(3) for b in range(2) for c in range(4) for d in range(3)
        if 7 <= 5 * a + 4 * b + 3 * c + 2 * d <= 10
    }
    # what is left out is dominated by something that is there
    assert len(found) == len(everything)
    for other in everything - set(kept):
        assert any(packing._dominates(list(k), list(other)) for k in kept)


def test_plan_improves_on_best_fit():
    # 5 + 5 + 2 + ... : best fit puts the fives and fours together and needs a third sequence
    histogram = {5: 2, 4: 2, 3: 2}
    assert sum(p.times for p in packing.best_fit(histogram, 12)) == 3
    assert sum(p.times for p in packing.plan(histogram, 12)) == 2


def test_transducer_finds_its_words_and_no_others():
    rng = random.Random(6)
    words = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 8))).encode() for _ in range(500)}
    held = lexicon.compile_lexicon({w: [i, i + 1] for i, w in enumerate(sorted(words))})
    found = held.find(sorted(words))
    assert found.tolist() == list(range(len(words)))
    assert [np.frombuffer(held.output(i), "<u4").tolist() for i in (0, 7)] == [[0, 1], [7, 8]]
    others = [w + b"q" for w in words] + [b"", b"d", b"a" * 70]
    assert (held.find(others) == -1).all()
    assert len(held.final) < sum(map(len, words)) / 2  # endings are shared
    assert (lexicon.compile_lexicon({}).find([b"a"]) == -1).all()


def test_encoding_and_decoding_equal_the_library(spark, odd):
    path = public_tokenizers.path("word_bpe_49k.json")
    library, vocabulary = Tokenizer.from_file(path), lexicon.Vocabulary.read(path)
    held = lexicon.lexicon_of(lexicon.frequent_words(odd, vocabulary, words=500), vocabulary)
    got = {r.doc_id: r for r in lexicon.encode_documents(odd, vocabulary, held).collect()}
    for row in odd.collect():
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        assert np.frombuffer(bytes(got[row.doc_id].ids), "<u4").tolist() == ids
        assert got[row.doc_id].decoded == library.decode(ids, skip_special_tokens=False)
    assert lexicon.encode_documents(odd.where("false"), vocabulary, held).count() == 0
    for word in ("a" * 150, "ab" * 90, "Ġx" * 80):
        parts = [vocabulary.ids[c] for c in [*word[:-1], word[-1] + vocabulary.word_end]]
        assert lexicon._merge_long(parts, vocabulary) == lexicon.merge(word, vocabulary)


def test_every_code_point_is_cut_as_the_library_cuts_it():
    """Letters, numbers, marks and white space of the tokenizer's own version of Unicode."""
    path = public_tokenizers.path("word_bpe_49k.json")
    library, encoder = Tokenizer.from_file(path), lexicon.Encoder(lexicon.Vocabulary.read(path), None)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    # planes without any assigned character in parts
    points = [c for c in points if ord(c) < 0x33480 or ord(c) % 0x101 == 0]
    for start in range(0, len(points), 40_000):
        texts = [f"ab{c}?{c}cd" for c in points[start : start + 40_000]]
        want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        for text, ids, (got, _) in zip(texts, want, encoder.batch(texts)):
            assert np.frombuffer(got, "<u4").tolist() == ids, hex(ord(text[2]))


def test_words_merged_together_are_merged_alike():
    vocabulary = lexicon.Vocabulary.read(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(12)
    words = ["".join(rng.choice("etaonrisé中1!") for _ in range(rng.randint(1, 30))).encode()[:200] for _ in range(3_000)]
    words += [b"a", b"a" * 200, b"ab" * 90, b"the", b"thethethe", b"\xff\x00"]
    merger, table = lexicon.Merger(vocabulary), lexicon.byte_table()
    for batch in (words, words[:1], []):
        got = [np.frombuffer(b, "<u4").tolist() for b in merger.merge(batch)]
        assert got == [lexicon.merge("".join(table[b] for b in w), vocabulary) for w in batch]


def test_cuts_are_cut_into_words_together(odd, monkeypatch):
    """New cuts in ASCII cost no call each, and give the words that each gives alone."""
    path = public_tokenizers.path("word_bpe_49k.json")
    library, vocabulary = Tokenizer.from_file(path), lexicon.Vocabulary.read(path)
    rng, alone, calls = random.Random(8), lexicon.Cutter.words, []
    texts = [r.text or "" for r in odd.collect()]
    texts += [" ".join("".join(rng.choice("aB1'stvelm.,!_é\x1c") for _ in range(9)) for _ in range(50)) for _ in range(40)]

    def words(self, text):
        calls.append(text)
        return alone(self, text)

    monkeypatch.setattr(lexicon.Cutter, "words", words)
    encoder = lexicon.Encoder(vocabulary, None)
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    got = list(encoder.batch(texts))
    assert [np.frombuffer(ids, "<u4").tolist() for ids, _ in got] == want
    assert [t for _, t in got] == [library.decode(ids, skip_special_tokens=False) for ids in want]
    assert not any(c.isascii() for c in calls)
    cutter = lexicon.Cutter(vocabulary.letters, vocabulary.numbers, vocabulary.lower)
    cuts = sorted({c for t in texts for c in encoder.cut(t)})
    for some in (cuts, [c for c in cuts if c.isascii()], [c for c in cuts if not c.isascii()], cuts[:1], []):
        found, counts = cutter.many(some)
        each = [alone(cutter, c) for c in some]
        assert found == [w for ws in each for w in ws] and counts.tolist() == [len(ws) for ws in each]


def test_frequent_words_are_the_most_frequent(spark, odd):
    path = public_tokenizers.path("word_bpe_49k.json")
    vocabulary = lexicon.Vocabulary.read(path)
    words = lexicon.Cutter(vocabulary.letters, vocabulary.numbers, vocabulary.lower).words
    counts = Counter(
        w for r in odd.collect() for cut in (r.text or "").split() for w in words(cut) if len(w) <= lexicon.LONGEST
    )
    for most in (1, 40, 500, 10**6):
        got = lexicon.frequent_words(odd, vocabulary, words=most)
        assert len(got) == len(set(got)) <= most
        least = min((counts[w] for w in got), default=None)
        if least is not None:
            # none that is as frequent is missing
            assert set(got) == {w for w, n in counts.items() if n >= least}
    assert lexicon.frequent_words(odd.where("false"), vocabulary) == []


def test_rendezvous_moves_rows_only_into_the_new_shard(spark):
    ids = spark.range(4_000).select(F.col("id").alias("doc_id"))
    even = dict.fromkeys(range(8), 1.0)
    both = ids.select(
        sharding.rendezvous(["doc_id"], even).alias("a"),
        sharding.rendezvous(["doc_id"], {**even, 8: 1.0}).alias("b"),
        sharding.rendezvous(["doc_id"], {0: 1.0, 1: 3.0}).alias("w"),
    ).collect()
    assert all(r.a == r.b or r.b == 8 for r in both)
    assert 0.07 < sum(r.b == 8 for r in both) / 4_000 < 0.15
    assert 0.70 < sum(r.w == 1 for r in both) / 4_000 < 0.80
    with pytest.raises(ValueError):
        sharding.rendezvous(["doc_id"], {})


def test_shards_have_gapless_slots(spark):
    rows = [(i % 50, "t") for i in range(600)] + [(None, None)] * 30
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("size", F.lit(1))
    placed = sharding.assign_shards(docs, ["doc_id"], dict.fromkeys(range(4), 1.0)).collect()
    slots = {}
    for r in placed:
        slots.setdefault(r.shard, []).append(r.slot)
    assert len(placed) == len(rows) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({(r.doc_id, r.shard) for r in placed}) == 51
    assert sharding.assign_shards(docs.where("false"), ["doc_id"], {0: 1.0}).count() == 0


def _nearest(rows, k=5):
    ids, x = [r[0] for r in rows], np.array([r[1] for r in rows], np.float64)
    norm = np.sqrt((x * x).sum(axis=1))
    out = {}
    for i, q in enumerate(ids):
        if q % 50 == 0:
            s = x @ x[i] / (norm * norm[i])
            best = sorted((-s[j], ids[j]) for j in range(len(ids)) if ids[j] != q)[:k]
            out[q] = [(b, -a) for a, b in best]
    return out


def test_neighbours(spark):
    base = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding")
    odd = spark.createDataFrame(
        [(5_000, None), (5_050, [0.0] * 64), (5_100, [float("nan")] * 64), (5_150, [None] + [1.0] * 63), (5_200, [])],
        "vec_id long, embedding array<float>",
    )
    copies = base.where("vec_id = 7").join(spark.range(60)).selectExpr("id + 9000 as vec_id", "embedding")
    for vectors in (base.unionByName(odd).unionByName(copies).unionByName(base.where("vec_id < 5")), base.where("vec_id < 3")):
        got = {}
        for r in neighbours.search(vectors, F.col("vec_id") % 50 == 0).collect():
            got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
        want = _nearest(sorted({r.vec_id: tuple(r) for r in vectors.where(neighbours.usable("embedding")).collect()}.values()))
        assert got.keys() == want.keys()
        hits = sum(len({v for _, v, _ in got[q]} & {v for v, _ in w}) for q, w in want.items())
        assert hits >= 0.9 * sum(map(len, want.values()))
        for q, held in got.items():
            assert [rank for rank, _, _ in sorted(held)] == list(range(1, len(held) + 1))
            scores = dict(want[q])
            assert all(abs(scores.get(v, s) - s) < 1e-12 for _, v, s in held)
    assert neighbours.search(base.where("false"), F.lit(True)).count() == 0


def test_neighbours_among_nearly_equal_vectors(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(0, 1e-4, (1_500, 12))
    x[:, 0] = 1.0  # one component dominates, the others differ by less than a byte shows
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in neighbours.search(vectors, F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    want = _nearest(rows)
    assert got.keys() == want.keys()
    assert sum(len(got[q] & {v for v, _ in w}) for q, w in want.items()) >= 0.95 * 5 * len(want)
