"""Language, personal data, language model."""

import math
import random
from collections import Counter

import numpy as np
import pytest
import reference
from corpusloom.llm import language_id, language_model, pii
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def _crc(modulus):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


def test_languages_of_held_out_documents(spark, labelled):
    model = language_id.fit(labelled.where(_crc(4) != 2))
    rows = language_id.identify(labelled, model).collect()
    sizer = language_id.Sizer(model)
    assert all((r.lang_pred, r.lang_score) == sizer.classify(r.text) for r in rows[:100])
    assert all(0 <= r.lang_score <= 1 and len(r) == 8 for r in rows)
    unseen = [r for r in rows if reference.held_out(r.doc_id, 4)]
    assert sum(r.lang == r.lang_pred for r in unseen) / len(unseen) > 0.95
    assert sum(r.rejected for r in rows) < 0.01 * len(rows)


def test_language_edges(spark, labelled):
    model = language_id.fit(labelled)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 %& 34"), (4, "the and of " * 5_000)], "doc_id long, text string")
    got = {r.doc_id: r for r in language_id.identify(odd, model).collect()}
    assert all(got[i].lang_pred == "und" and got[i].rejected and got[i].lang_score == 0 for i in (1, 2, 3))
    assert got[4].lang_pred == "en"
    with pytest.raises(ValueError):
        language_id.identify(odd.withColumn("Rejected", F.lit(1)), model)
    empty = language_id.fit(labelled.where("false"))
    assert {r.lang_pred for r in language_id.identify(odd, empty).collect()} == {"und"}
    assert language_id.identify(odd.where("false"), model).count() == 0


def test_texts_without_a_letter_have_no_language(spark):
    model = language_id.LanguageModel({"de": b"der die das und", "en": b"the of and to"})
    texts = ["\u00bd", "\u00b2\u00b2 \u2460", "12 ... \u2167", "_", "the", "\u4e00"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in language_id.identify(docs, model).collect()}
    assert [got[i].lang_pred == "und" for i in range(6)] == [True, True, True, True, False, False]
    assert all(got[i].lang_score == 0 and got[i].rejected for i in range(4))


def test_dictionaries_take_texts_until_full(spark):
    rng = random.Random(6)

    def prose(signs, n):
        return " ".join("".join(rng.choice(signs) for _ in range(rng.randint(2, 9))) for _ in range(n))

    hidden = "7 " * 40_000 + prose("rst", 5_000)  # letters after a long stretch without any
    rows = [(f"{i} " + prose("abcde", 200_000), "long") for i in range(6)]  # a few long texts
    rows += [(f"{i} " + prose("fghij", 150), "mixed") for i in range(400)] + [(prose("fghij", 600_000), "mixed")] * 8
    rows += [("1 " * 20_000 + str(i), "digits") for i in range(40)] + [(prose("klmno", 2_000), "digits")]
    rows += [(hidden, "hidden"), ("12 34", "none"), (None, "none")]
    docs = spark.createDataFrame(rows, "text string, lang string")
    model = language_id.fit(docs, dictionary_bytes=20_000)
    held = {name: len(d) for name, d in model.dictionaries.items()}
    assert set(held) == {"long", "mixed", "digits", "hidden"}
    assert all(held[name] >= 19_990 for name in ("long", "mixed", "hidden")) and held["digits"] > 10_000
    again = language_id.fit(docs.repartition(7), dictionary_bytes=20_000)
    assert again == model


def test_base_spans(spark, labelled):
    rng = random.Random(1)
    signs = "a1 2@.-+()9 5%_é😀\n"
    rows = [(i, "".join(rng.choice(signs) for _ in range(rng.randint(0, 80)))) for i in range(1_500)]
    rows += [
        (5_001, None),
        (5_002, ""),
        (5_003, "x@y.z 999.1.1.1 a@b.c_d@e.f 001.2.3.4"),
        (5_004, "1 " * 20_000),
        (5_005, "a" * 100_000 + "@"),
        (5_006, "4111111111111111 " * 300),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").unionByName(labelled.select("doc_id", "text"))
    model = pii.fit(docs)
    found = pii.with_spans(docs, model).select("text", "base_spans", "spans", pii.joined("base_spans").alias("b"))
    for r in found.collect():
        assert r.b == reference.base_spans(r.text)
        assert {tuple(s) for s in r.base_spans} <= {tuple(s) for s in r.spans}
        for s in r.spans:
            assert r.text[s.start : s.end] == s.value


def test_added_spans_and_redaction(spark, labelled):
    more = [
        (9_001, "mail joe (at) example (dot) com, tel. (030) 555-1234, isbn 978-3-16-148410-0"),
        (9_002, "nothing here 12 34"),
        (9_003, "\U0001f600 +49 30 1234567, 4111 1111 1111 1111 and 10.0.0.1"),
        (9_004, None),
    ]
    odd = spark.createDataFrame(more, "doc_id long, text string").withColumn("spans", F.lit("mine"))
    model = pii.fit(labelled.select("doc_id", "text").unionByName(odd.drop("spans")))
    got = pii.redact(odd, model)
    assert got.columns == odd.columns
    text = {r.doc_id: r.text for r in got.collect()}
    assert "[EMAIL]" in text[9_001] and "978-3-16-148410-0" in text[9_001]
    assert text[9_002] == more[1][1] and text[9_004] is None
    assert text[9_003] == "\U0001f600 [PHONE], [CARD] and [IP]"
    assert pii.redact(odd.where("false"), model).count() == 0
    assert pii.fit(odd.where("false")).weights == {}


def test_expectation_maximisation_finds_the_good_labeler():
    rng = random.Random(3)
    counts = Counter()
    for _ in range(4_000):
        truth = 1 if rng.random() < 0.5 else -1
        vote = lambda right: truth if rng.random() < right else -truth
        counts[vote(0.95), vote(0.9), vote(0.85), vote(0.5), vote(0.9)] += 1
    posterior, reliability = pii._expectation_maximisation([(k, float(n)) for k, n in sorted(counts.items())], 30)
    assert reliability["strict"] > reliability["gazetteer"] > reliability["denied"]
    assert abs(reliability["denied"] - 0.5) < 0.05


def test_language_model(spark, labelled):
    odd = spark.createDataFrame([(2_000_001, None), (2_000_002, ""), (2_000_002, "")], "doc_id long, text string")
    docs = labelled.select("doc_id", "text").unionByName(odd)
    train = _crc(7) != 2
    model = language_model.train(docs.where(train))
    rows = [(r.doc_id, [*reference.words(r.text), None]) for r in docs.collect()]
    counts = Counter()
    for key, tokens in rows:
        if not reference.held_out(key, 7):
            counts.update(tokens)
    n, v = sum(counts.values()), len(counts)
    assert (model.tokens, model.types) == (n, v)
    got = {}
    for r in language_model.score(docs, model, train).collect():
        got.setdefault(r.doc_id, []).append(r)
    base = better = 0.0
    for key, tokens in rows:
        want = sum(math.log10((counts[t] + 1) / (n + 1 * (v + 1))) for t in tokens)
        for r in got[key]:
            assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(counts[t] > 0 for t in tokens), n)
            assert math.isclose(r.base_score, want, rel_tol=1e-9)
            if reference.held_out(key, 7):
                base, better = base + r.base_score, better + r.score
    assert better > base  # of documents it has not seen
    assert sum(len(x) for x in got.values()) == len(rows)
    assert language_model.score(docs.where("false"), model, train).count() == 0
    nothing = language_model.train(docs.where("false"))
    assert (nothing.tokens, nothing.types, nothing.documents) == (0, 0, 0)


def test_filter_never_counts_too_little(spark, labelled):
    docs = labelled.select("text")
    model = language_model.train(docs)
    from corpusloom.llm.shingles import word_hashes

    words = np.concatenate(word_hashes([r.text for r in docs.collect()]))
    keys, counts = np.unique(words, return_counts=True)
    held = model.filter.counts(language_model._short(keys, model.filter.ranges))
    floor = language_model._THRESHOLDS[language_model.levels(counts) - 1]
    assert (held >= floor).all()
    assert (held > counts).mean() < 0.05
    small = language_model.train(docs, max_bytes=20_000)
    assert len(small.filter.bits) <= 21_000


def test_every_bigram_is_held_and_probed_by_ranges(spark, labelled, monkeypatch):
    from corpusloom.llm import keycounts
    from corpusloom.llm.shingles import word_hashes

    docs = labelled.select("doc_id", "text").where("doc_id % 4 = 0")
    train = F.col("doc_id") % 3 != 0
    model = language_model.train(docs.where(train))
    rows = docs.collect()
    split = {r.doc_id: language_model.tokens_of(word_hashes([r.text])[0]) for r in rows}
    seen = np.concatenate([language_model.pairs(b, t) for k, (t, b) in split.items() if k % 3])
    keys, counts = np.unique(seen, return_counts=True)
    held = model.filter.counts(language_model._short(keys, model.ranges))
    assert (counts == 1).any() and (held >= language_model._SMALLEST[language_model.levels(counts)]).all()
    want = {}
    for key, (tokens, before) in split.items():
        own, context, pair = (
            model.filter.counts(language_model._short(k, model.ranges))
            for k in (tokens, before, language_model.pairs(before, tokens))
        )
        want[key] = language_model.log10(own, context, pair, model.tokens, model.types).sum()
    first = {r.doc_id: r for r in language_model.score(docs, model, train).collect()}
    assert all(math.isclose(first[k].score, v, rel_tol=1e-9) for k, v in want.items()) and len(first) == len(want)
    monkeypatch.setattr(keycounts, "KEYS_PER_RANGE", 2_000)  # more ranges of questions than parts
    assert {r.doc_id: r for r in language_model.score(docs, model, train).collect()} == first


def test_batches_of_texts_are_sorted_and_sliced():
    """Tokens of all texts at once, sorted keys without a hash table, and slices that leave no text out."""
    rng = np.random.default_rng(7)
    for sizes in ([], [0], [3], [0, 0, 5, 1, 0], rng.integers(0, 9, 300).tolist()):
        words = [rng.integers(0, 2**64, n, np.uint64) % np.uint64(50) for n in sizes]
        split = [language_model.tokens_of(w) for w in words]
        none = np.zeros(0, np.uint64)
        tokens, before, lengths = language_model._row_tokens(words)
        assert tokens.dtype == before.dtype == np.uint64 and lengths.tolist() == [n + 1 for n in sizes]
        assert np.array_equal(tokens, np.concatenate([none, *[t for t, _ in split]]))
        assert np.array_equal(before, np.concatenate([none, *[b for _, b in split]]))
        assert np.array_equal(language_model._distinct(tokens), np.unique(tokens))
        for most in (1, 7, 10**6):
            runs = list(language_model._slices(lengths, most))
            assert [i for a, z in runs for i in range(a, z)] == list(range(len(sizes)))
            assert all(z - a == 1 or lengths[a:z].sum() <= most for a, z in runs)


def test_counting_holds_a_part_of_a_batch_in_memory():
    """An Arrow batch of many long texts is counted in parts, and no text is left out."""
    import tracemalloc

    import pyarrow as pa

    from corpusloom.llm import keycounts
    from corpusloom.llm.shingles import word_hashes

    class Docs:
        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            return run

    rng = np.random.default_rng(11)
    vocabulary = np.array([f"word{i}" for i in range(20_000)])
    long = " ".join(vocabulary[rng.integers(0, 20_000, 300_000)])
    texts = [None, "", *[long[i : i + 1 + i % 30_000] for i in range(0, len(long), 1_000)] * 8, long, None, "a"]
    assert sum(len(t or "") for t in texts) > 30 << 20
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    counted = language_model._counted(Docs(), 64)
    tracemalloc.start()
    try:
        sent = [b for b in counted(iter([batch.slice(0, 0), batch]))]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 150 << 20
    table = pa.Table.from_batches(sent)
    split = [language_model.tokens_of(w) for w in word_hashes(texts)]
    tokens, before = (np.concatenate(x) for x in zip(*split))
    want = np.unique(tokens, return_counts=True)
    words = table.filter(pa.compute.equal(table.column("batch"), 0))
    _, keys, _, totals = keycounts.added(words, wide=True)
    assert np.array_equal(keys, want[0]) and np.array_equal(totals, want[1])
    both = table.filter(pa.compute.equal(table.column("batch"), 1))
    counts = [keycounts.unpacked(c, "<u4").sum(dtype=np.int64) for c in both.column("counts").to_pylist()]
    assert sum(counts) == len(tokens)


def test_parts_are_built_where_they_are_counted(spark, labelled, monkeypatch):
    """One Python function after the shuffle, not two with a worker each; the parts are those of written levels."""
    docs = labelled.select("text").where("doc_id % 5 = 0")
    written, real = [], language_model.materialize
    monkeypatch.setattr(language_model, "materialize", lambda df, name: written.append((name, df)) or real(df, name))
    monkeypatch.setattr(language_model, "PROBED", 1_000)
    model = language_model.train(docs)
    ((name, df),) = written
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert name == "filter" and plan.count("MapInArrow") == 1 and plan.count("FlatMapGroupsInArrow") == 1
    levelled = language_model._levelled(language_model._counted(docs, model.ranges), model.ranges)
    monkeypatch.undo()
    want = {r["range"]: r for r in language_model._parts(levelled, 1).select("range", "size", "bits").collect()}
    assert {r["range"]: r for r in model.parts.collect()} == want
    keys = language_model._short(np.random.default_rng(2).integers(0, 2**64, 5_000, np.uint64), model.ranges)
    first = model.filter.levels(keys)
    monkeypatch.setattr(language_model, "PROBED", 700)
    assert np.array_equal(model.filter.levels(keys), first) and len(model.filter.levels(keys[:0])) == 0


def test_shares_of_all_words_add_up():
    """After every word, and after one never seen, within what quantised counts can miss."""
    rng = np.random.default_rng(4)
    words = rng.integers(0, 12, 4_000)
    n = np.bincount(words, minlength=12)
    follow = np.zeros((12, 12), np.int64)
    np.add.at(follow, (words[:-1], words[1:]), 1)
    tokens, types = int(n.sum()), 12

    def level(counts):
        return language_model._SMALLEST[language_model.levels(counts)]

    unknown = np.zeros(1, np.int64)
    for first in range(12):
        # nothing follows the last word
        for known, low in ((lambda x: x, 1 - 1 / n.min()), (level, 1 / language_model.GROWTH**2)):
            own, context = np.append(known(n), unknown), np.full(13, known(n[first : first + 1])[0])
            both = np.append(known(follow[first]), unknown)
            total = (10 ** language_model.log10(own, context, both, tokens, types)).sum()
            assert low <= total <= language_model.GROWTH
    # what follows a word that was never seen: the words' own shares, all of them
    own = np.append(n, unknown)
    total = (10 ** language_model.log10(own, np.zeros(13, np.int64), np.zeros(13, np.int64), tokens, types)).sum()
    assert abs(total - 1) < 1e-9
