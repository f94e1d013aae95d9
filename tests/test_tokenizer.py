"""Training, encoding and decoding against the public tokenizer library and a plain loop."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.models import BPE
from tokenizers.pre_tokenizers import Whitespace
from tokenizers.processors import TemplateProcessing
from tokenizers.trainers import BpeTrainer

from corpusloom.operators.bpe import (
    CLASSIFIER_SPECIALS,
    BpeTokenizer,
    _code,
    _Heads,
    _count_pairs,
    _merged,
    _postings,
    _shifts,
    _words_with,
    train_bpe,
    word_counts,
)
from corpusloom.operators.encode import decode_column, encode, encode_pairs

VOCAB = 260


@pytest.fixture(scope="module")
def library(documents):
    texts = [r["text"] for r in documents.orderBy("doc_id").collect()]
    tokenizer = Tokenizer(BPE(unk_token="[UNK]"))
    tokenizer.pre_tokenizer = Whitespace()
    trainer = BpeTrainer(
        vocab_size=VOCAB,
        special_tokens=list(CLASSIFIER_SPECIALS),
        min_frequency=2,
        show_progress=False,
    )
    tokenizer.train_from_iterator(texts, trainer)
    tokenizer.post_processor = TemplateProcessing(
        single="[CLS] $A [SEP]", special_tokens=[("[CLS]", 2), ("[SEP]", 3)]
    )
    return tokenizer


@pytest.fixture(scope="module")
def trained(documents):
    return train_bpe(word_counts(documents, ["text"]), VOCAB, rewrite_every=40)


def test_same_vocabulary(trained, library):
    assert {t: i for i, t in enumerate(trained.tokens)} == library.get_vocab()


def test_same_ids_and_texts(spark, documents, trained, library):
    odd = ["", "   ", "[CLS] in a text([SEP])", "unknown 中文 \U0001f600x", "a" * 3000]
    rows = documents.select("text").union(spark.createDataFrame([(t,) for t in odd], "text string"))
    ids = encode(rows, "text", trained).withColumn("back", decode_column("input_ids", trained))
    for row in ids.collect():
        expected = library.encode(row["text"])
        assert row["input_ids"] == expected.ids
        assert row["back"] == library.decode(expected.ids)


def test_null_text_keeps_its_row(spark, trained):
    rows = spark.createDataFrame([(1, None), (2, "the")], "k int, text string")
    got = {r["k"]: r["input_ids"] for r in encode(rows, "text", trained).collect()}
    assert got[1] is None and got[2][0] == 2


def test_save_and_load(spark, trained, tmp_path):
    trained.save(spark, str(tmp_path / "tokenizer"))
    assert BpeTokenizer.load(spark, str(tmp_path / "tokenizer")) == trained


def test_pair_lengths(documents, trained):
    rows = encode_pairs(documents, "text", "text", 20, 9, trained).select("src", "tgt").collect()
    assert {len(r["src"]) for r in rows} == {20} and {len(r["tgt"]) for r in rows} == {9}
    assert all(r["src"][:2] == [2, 2] for r in rows)


def _plain_merges(words, alphabet_start, specials, vocab_size):
    """One merge at a time over a dictionary of words."""
    characters = sorted({c for w in words for c in w})
    tokens = list(specials) + characters
    ids = {t: i for i, t in enumerate(tokens)}
    split = {w: [ids[c] for c in w] for w in words}
    merges = []
    while len(tokens) < vocab_size:
        pairs = Counter()
        for w, n in words.items():
            for pair in zip(split[w], split[w][1:]):
                pairs[pair] += n
        best = min(pairs, key=lambda p: (-pairs[p], p), default=None)
        if best is None or pairs[best] < 2:
            break
        joined = tokens[best[0]] + tokens[best[1]]
        if joined not in ids:
            ids[joined] = len(tokens)
            tokens.append(joined)
        merges.append((*best, ids[joined]))
        for w, symbols in split.items():
            out, i = [], 0
            while i < len(symbols):
                if tuple(symbols[i : i + 2]) == best:
                    out.append(ids[joined])
                    i += 2
                else:
                    out.append(symbols[i])
                    i += 1
            split[w] = out
    return merges, tokens


@pytest.mark.parametrize(
    "seed,letters,candidates", [(0, "ab", 3), (1, "a\U0001f600é中", 2_048), (2, "abcdefg", 9)]
)
def test_ties_and_short_rankings(spark, seed, letters, candidates):
    """Few letters give ties, equal pairs and texts made in two ways; short rankings end guesses."""
    chance = random.Random(seed)
    words = Counter(
        "".join(chance.choices(letters, k=chance.randint(1, 9))) for _ in range(120)
    )
    table = spark.createDataFrame(list(words.items()), "word string, n bigint")
    got = train_bpe(table, 60, candidates=candidates, rewrite_every=9, lookahead=12)
    merges, tokens = _plain_merges(words, 4, CLASSIFIER_SPECIALS, 60)
    assert list(got.merges) == merges
    assert list(got.tokens) == tokens


def test_long_training_equals_the_library(documents):
    """Two thousand tokens, over several writings of the tables."""
    texts = [r["text"] for r in documents.orderBy("doc_id").collect()]
    library = Tokenizer(BPE(unk_token="[UNK]"))
    library.pre_tokenizer = Whitespace()
    trainer = BpeTrainer(
        vocab_size=2_000, special_tokens=list(CLASSIFIER_SPECIALS), min_frequency=2, show_progress=False
    )
    library.train_from_iterator(texts, trainer)
    got = train_bpe(word_counts(documents, ["text"]), 2_000)
    assert len(got.tokens) == 2_000
    assert {t: i for i, t in enumerate(got.tokens)} == library.get_vocab()


def test_words_with_a_pair_are_read_once(spark):
    words = spark.createDataFrame([("abcb", 2), ("bc", 5), ("xyz", 1), ("aaaa", 3)], "s string, n long")
    postings = _postings(words)
    assert sorted(map(tuple, postings.collect())) == sorted(
        [("ab", "abcb", 2), ("bc", "abcb", 2), ("cb", "abcb", 2), ("bc", "bc", 5), ("xy", "xyz", 1), ("yz", "xyz", 1), ("aa", "aaaa", 3)]
    )
    assert sorted(map(tuple, _words_with(postings, ["ab", "bc", "zz"]).collect())) == [("abcb", 2), ("bc", 5)]
    assert _words_with(postings, []).count() == 0


def test_heads_lead_to_what_a_word_held():
    heads = _Heads()
    assert heads.pairs("ab") == {"ab"}
    heads.merge("ab", "X")
    heads.merge("cX", "Y")
    assert {"ab"} <= heads.pairs("Xd") and {"ca"} <= heads.pairs("Yd")
    assert "da" in heads.pairs("dX") and "dc" in heads.pairs("dY")
    # the same token by another way
    heads.merge("ef", "X")
    assert {"ab", "ef"} <= heads.pairs("Xd") and {"da", "de"} <= heads.pairs("dX")


def test_symbols_pass_the_surrogates():
    codes = [_code(i) for i in range(70_000)]
    assert codes == sorted(set(codes)) and all(c.encode() for c in codes)


def test_word_counts_ignore_partitioning(documents):
    def total(df):
        return word_counts(df, ["text"]).agg(F.count("*"), F.sum("n")).first()

    assert total(documents.repartition(1)) == total(documents.repartition(17))


def test_shifts_are_the_differences_of_counts(spark):
    """Merged one after another, overlapping runs and neighbouring places included."""
    chance = random.Random(5)
    letters = [_code(i) for i in range(3)]
    words = {"".join(chance.choices(letters, k=chance.randint(1, 12))): chance.randint(1, 9) for _ in range(200)}
    table = spark.createDataFrame(list(words.items()), "s string, n long").repartition(3)
    a, b, c = letters
    x, y, z = (_code(i) for i in (3, 4, 5))
    merges = [(a + a, x), (b + c, y), (x + y, z), (x + x, z)]

    def counts(k):
        merged = table.selectExpr(f"{_merged('s', merges[:k])} AS s", "n")
        return Counter({r["pair"]: r["n"] for r in _count_pairs(merged).collect()})

    plain = Counter()
    for word, n in words.items():
        for pair in zip(word, word[1:]):
            plain["".join(pair)] += n
    assert counts(0) == plain
    got = {(r["step"], r["pair"]): r["n"] for r in _shifts(table, merges[:1], merges[1:]).collect()}
    stages = [counts(0), counts(1), counts(2), counts(3), counts(4)]
    want = {}
    for step, (before, after) in enumerate(zip(stages, stages[1:])):
        for pair in before.keys() | after.keys():
            if after[pair] != before[pair]:
                want[step, pair] = after[pair] - before[pair]
    assert got == want


def test_batches_are_encoded_some_rows_after_another(trained, monkeypatch):
    import pyarrow as pa

    from corpusloom.operators import encode as operator

    words = [["the", "a"], None, [], ["theatre"], ["x", "the", "a" * 40], [], ["é"]]
    batch = pa.array(words, pa.list_(pa.string()))
    whole = operator._word_encoder(trained)(batch).to_pylist()
    monkeypatch.setattr(operator, "ENCODED_CHARACTERS", 4)
    assert operator._word_encoder(trained)(batch).to_pylist() == whole
    assert operator._word_encoder(trained)(batch.slice(2, 4)).to_pylist() == whole[2:6]
    assert operator._word_encoder(trained)(batch.slice(0, 0)).to_pylist() == []
    assert whole[1] is None and whole[2] == []
