"""Exact, near and passage duplicates against plain versions."""

import random

import reference
from corpusloom.llm import exact_dedup, jaccard_join, suffix_dedup
from corpusloom.llm.components import connected_components
from pyspark.sql import functions as F


def test_exact_groups(spark, texts):
    rows = [tuple(r) for r in texts.collect()]
    strip = str.maketrans("", "", exact_dedup.WHITE_SPACE)
    groups = {}
    for key, text in rows:
        groups.setdefault((text or "").translate(strip), []).append((-len(text or ""), key is None, key or 0))
    got = exact_dedup.exact_groups(texts).collect()
    want = []
    for key, text in rows:
        mine = sorted(groups[(text or "").translate(strip)])
        want.append((key, None if mine[0][1] else mine[0][2], len(mine)))
    order = lambda r: tuple((x is None, x) for x in r)
    assert sorted([(r.doc_id, r.keep_id, r.group_size) for r in got], key=order) == sorted(want, key=order)
    assert sum(r.kept for r in got) == len(groups)  # of repeated rows one stays


def test_exact_keeps_columns_and_empty_tables(spark, texts):
    extra = texts.withColumn("__row", F.lit("mine")).withColumn("rest", F.lit(1))
    kept = exact_dedup.drop_exact_duplicates(texts.withColumn("rest", F.lit(1)).withColumn("keep_id", F.lit(2)))
    assert kept.columns == ["doc_id", "text", "rest", "keep_id"]
    assert extra.count() == texts.count()
    none = exact_dedup.exact_groups(texts.where("false"))
    assert none.count() == 0


def test_equal_beginnings_are_not_equal(spark):
    start = "s" * 5_000
    rows = [(1, start + "a"), (2, start + "b"), (3, start), (4, start + "a"), (5, start[:64]), (6, start[:64])]
    got = exact_dedup.exact_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.keep_id) for r in got} == {(1, 1), (4, 1), (2, 2), (3, 3), (5, 5), (6, 5)}


def _near_copies():
    rng = random.Random(5)
    base = [rng.choice([f"w{i}" for i in range(50)]) for _ in range(60)]
    out = []
    for i in range(40):
        copy = list(base)
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(60)] = f"e{rng.randrange(1000)}"
        out.append((800_000 + i, " ".join(copy)))
    return out


def test_jaccard_join(spark, texts):
    docs = texts.where("doc_id is not null").unionByName(
        spark.createDataFrame(_near_copies(), "doc_id long, text string")
    )
    rows = [tuple(r) for r in docs.collect()]
    assert sorted(tuple(r) for r in jaccard_join.join_documents(docs).collect()) == reference.linked(rows)


def test_jaccard_null_key_and_empty_table(spark, texts):
    odd = jaccard_join.join_documents(texts.where("doc_id is null or doc_id >= 900000")).collect()
    assert {r.component_id for r in odd if r.doc_id is None} == {900_006}
    assert jaccard_join.join_documents(texts.where("false")).count() == 0
    kept = jaccard_join.drop_near_duplicates(texts.where("doc_id = 900006").withColumn("n", F.lit(1)))
    assert [tuple(r) for r in kept.collect()] == [(900_006, "a b c d e", 1)]


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(50, 51), (51, 50), (60, 60)], "a long, b long")
    got = {r.node: r.component for r in connected_components(links).collect()}
    assert got == {**dict.fromkeys(range(31), 0), 50: 50, 51: 50}


def test_suffix_dedup(spark, texts):
    rng = random.Random(4)
    pool = [f"w{i}" for i in range(300)]
    passages = [[rng.choice(pool) for _ in range(rng.randint(50, 130))] for _ in range(6)]
    rows = []
    for i in range(50):
        held = []
        for _ in range(rng.randint(1, 3)):
            held += [rng.choice(pool) for _ in range(rng.randint(0, 60))]
            held += rng.choice(passages)[rng.randint(0, 20) if rng.random() < 0.3 else 0 :]
        rows.append((800_000 + i, " ".join(held)))
    rows += [(850_000, " ".join(passages[0][:50])), (850_001, " ".join(passages[0][:49]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").unionByName(
        texts.where("doc_id is not null and doc_id not in (900006, 900007)")
    )
    found = suffix_dedup.repeated_spans(docs)
    got = {r.doc_id: [(s.start, s.end) for s in r.spans] for r in found.collect()}
    assert got == reference.repeated([tuple(r) for r in docs.collect()])
    cut = suffix_dedup.cut_spans(docs.join(found, "doc_id")).select("doc_id", "text").collect()
    lengths = {r.doc_id: len(reference.words(r.text)) for r in cut}
    for key, text in rows:
        assert lengths[key] == len(reference.words(text)) - sum(b - a for a, b in got[key])
    assert suffix_dedup.repeated_spans(docs.where("false")).count() == 0


def test_passages_that_end_in_a_frequent_head(spark):
    """Pairs agree on 25 words before a head that all hold, and go on differently after it."""
    from corpusloom.llm import shingles

    rng = random.Random(8)
    pool = [f"w{i}" for i in range(5_000)]
    least = 2**64
    while least > 2**64 // 3_000:  # a head that is the least of its window
        head = [rng.choice(pool) for _ in range(25)]
        least = int(shingles.mixed(shingles.ngrams(shingles.word_hashes([" ".join(head)])[0], 25))[0])
    before = [[rng.choice(pool) for _ in range(25)] for _ in range(150)]
    rows = [
        (i, " ".join(before[i % 150] + head + [rng.choice(pool) for _ in range(30)])) for i in range(300)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.doc_id: [tuple(s) for s in r.spans] for r in suffix_dedup.repeated_spans(docs).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == reference.repeated(rows) == {i: [(0, 50)] for i in range(300)}
