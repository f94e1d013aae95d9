"""The stages in order, on clean, copied and odd documents."""

from pathlib import Path

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
import reference
from corpusloom.llm import packing
from corpusloom.llm.queries import QUERIES
from corpusloom.session import materialize, scratch_path
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    text = " ".join(f"the other of and {w}" for w in "thing letter under where there".split())
    more = [
        (800_001, None, None, None, None),
        (800_002, "", "en", "s", 0),
        (800_003, "### 12 $$", "en", "s", 9),
        (800_004, text, "en", None, 1),
        (800_004, text, "en", None, 1),
        (800_005, text + " mail a@b.example", "en", "s", 1),
    ]
    docs = docs.unionByName(spark.createDataFrame(more, docs.schema))
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), f"test-{name}")
        seen[name] = docs
        if name != "packing":
            assert docs.columns == columns
    kept = {r.doc_id for r in seen["language_id"].collect()}
    assert not kept & {800_001, 800_002, 800_003} and {800_004, 800_005} <= kept
    assert seen["exact_dedup"].where("doc_id = 800004").count() == 1
    near = [(r.doc_id, r.text) for r in seen["exact_dedup"].collect()]
    assert {r.doc_id for r in seen["ngram_jaccard"].collect()} == {c for _, _, c in reference.linked(near)}
    assert all(not reference.base_spans(r.text) for r in seen["pii"].collect())
    assert seen["pii"].count() == seen["ngram_jaccard"].count()
    packed = seen["packing"].collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in seen["pii"].collect()}
    assert all(len(np.frombuffer(bytes(r.ids), "<u4")) == r.length for r in packed)


def _scratch(spark):
    """Names of the folders of tables that were written and still hold files."""
    root = Path(scratch_path(spark, "x").removeprefix("file:")).parent
    return {p.parent: p.parent.name.rpartition("-")[0] for p in root.glob("*/*.parquet")}


def test_stages_leave_only_what_their_results_read(spark):
    """The tables of a stage stay until the application ends: those that nothing reads must go at once."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    start = "s" * 500
    more = [(800_000 + i, start + "ab"[i % 2], "en", "s", 1) for i in range(6)]
    # near copies: first all different, then with links over several rounds
    words = [f"w{i}" for i in range(60)]
    more += [(810_000 + i, " ".join([*words[i:], *(f"e{i}-{j}" for j in range(i))]), "en", "s", 1) for i in range(8)]
    docs = docs.unionByName(spark.createDataFrame(more, docs.schema))
    apart = spark.createDataFrame([(i, f"a{i} b{i} c{i} d{i} e{i} f{i}", "en", "s", 1) for i in range(9)], docs.schema)
    wanted = {
        corpus_pipeline.exact: ["radix-docs", "radix-dropped"],
        corpus_pipeline.near: ["near-copies", "whole"],
    }
    for given in (docs, apart, docs.where("false")):
        for stage, names in wanted.items():
            before = _scratch(spark)
            result = stage(spark, given, SF)
            n = result.count()
            left = [name for path, name in _scratch(spark).items() if path not in before]
            if stage is corpus_pipeline.near:
                left = [name for name in left if name not in ("links", "large-star", "small-star", "least")]
            assert sorted(left) == names
            assert result.count() == n and (given is docs) == (n < given.count())


def test_pieces_move_with_two_bytes_an_id(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [(800_001, None), (800_002, ""), (800_003, "ab " * 3_000), (None, "ab"), (None, "ab")]
    docs = docs.select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    before = _scratch(spark)
    packed = corpus_pipeline.packed(spark, docs, SF)
    (written,) = [path for path, name in _scratch(spark).items() if path not in before and name == "pieces"]
    held = spark.read.parquet(str(written))
    assert held.where(F.octet_length("ids") != 2 * F.col("length")).count() == 0
    columns = ["doc_id", "piece", "start", "length", "ids"]
    pieces = packing.token_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"))
    assert packed.columns == [*columns, "sequence_id", "offset"]
    assert dict(packed.dtypes)["ids"] == "binary"
    assert packed.count() == held.count() == pieces.count()
    assert packed.select(columns).exceptAll(pieces).isEmpty()


def test_ids_of_large_vocabularies_stay_wide(spark):
    ranks = {b"a": 3, b"b": 65_535}
    assert packing.id_width(ranks, {}) == 2 and packing.id_width({}, {}) == 2
    assert packing.id_width(ranks, {"<x>": 65_536}) == packing.id_width({**ranks, b"c": 65_536}, {}) == 4
    wide = np.array([0, 2, 65_535], "<u4")
    rows = [(1, wide.astype("<u2").tobytes()), (2, b""), (3, None)]
    given = spark.createDataFrame(rows, "doc_id long, ids binary")
    got = {r.doc_id: r.ids for r in packing.widened(given, 2).collect()}
    assert got == {1: wide.tobytes(), 2: b"", 3: None}
    assert packing.widened(given, 4) is given
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    for width, end in ((3, 2), (2, 65_536)):
        with pytest.raises(ValueError):
            packing.token_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), end=end, width=width)


def test_every_operator_is_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
