import bz2
import gzip
import json
import tarfile
import wave
from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from corpusloom.operators.tables import filter_batches, filter_length, map_rows
from corpusloom.plans import labeled, speech
from corpusloom.session import shared_dir
from corpusloom.sources import labeled as labeled_files
from corpusloom.sources import tabular
from corpusloom.sources.archives import read_tar_members
from corpusloom.sources.labeled import read_labeled_dirs, write_labeled_dirs
from corpusloom.sources.media import media_lengths

AWKWARD = ["a, b", 'say "hi"', "two\nlines\r\n", "NA", "", "  blanks  ", "tab\t;", "null", "\\\\"]


def test_labeled_dirs(spark, tmp_path):
    expected = set()
    for subset in ("train", "test"):
        for name, code in (("pos", 1), ("neg", 0)):
            folder = tmp_path / "set with space" / subset / name
            folder.mkdir(parents=True)
            for i in range(3):
                text = f"{subset} {name} {i}\nsecond line é"
                (folder / f"{i}_7.txt").write_text(text, encoding="utf-8")
                expected.add((text, code, subset))
    got = read_labeled_dirs(spark, str(tmp_path / "set with space")).collect()
    assert len(got) == 12 and {(r["text"], r["label"], r["subset"]) for r in got} == expected


def test_many_labeled_files_are_listed_and_read_by_few_tasks(spark, tmp_path):
    for name in ("pos", "neg"):
        (tmp_path / "train" / name).mkdir(parents=True)
        for i in range(300):
            (tmp_path / "train" / name / f"{i}.txt").write_text(f"{name} {i}")
    got = read_labeled_dirs(spark, str(tmp_path), subsets=["train"])
    assert got.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    # names stay off the driver, and no join takes the texts for small
    assert got.inputFiles() == []
    assert int(str(got._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) > 1 << 40
    rows = {(r["text"], r["label"], r["subset"]) for r in got.collect()}
    assert rows == {(f"{n} {i}", c, "train") for n, c in (("pos", 1), ("neg", 0)) for i in range(300)}


ODD_FILES = {
    "empty.txt": b"",
    "no_utf8.txt": b"caf\xe9\x00\xff",
    "_hidden.txt": b"h",
    ".hidden": b"h",
    "_a=1.txt": b"kept",
    "_metadata.txt": b"h",
    "_metadata/pos/1.txt": b"kept too",
    "copy.txt._COPYING_": b"h",
    "deep/pos/a+b %20;.txt": b"two\r\nlines",
    "_deep/pos/1.txt": b"h",
    "long.txt": b"x" * 9_000_000,
    "gz.txt": b"\x1f\x8b not packed",
}


@pytest.mark.parametrize("packed", [{}, {"a.gz": gzip.compress(b"unpacked"), "b.bz2": bz2.compress(b"too")}])
def test_odd_labeled_files_are_read_as_spark_reads_them(spark, tmp_path, packed):
    for path, content in (ODD_FILES | packed).items():
        file = tmp_path / "set" / "train" / "pos" / path
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_bytes(content)
    (tmp_path / "set" / "train" / "pos" / "gone.txt").symlink_to(tmp_path / "nothing")
    (tmp_path / "set" / "train" / "neg").mkdir()
    whole = spark.read.text(f"{tmp_path}/set/train/pos", wholetext=True, recursiveFileLookup=True)
    by_spark = whole.select(F.base64(F.col("value").cast("binary")), F.md5("value"), "_metadata.file_name")
    for root in ("set", "se[t]"):
        got = read_labeled_dirs(spark, str(tmp_path / root), subsets=["train"])
        assert [f.dataType.simpleString() for f in got.schema] == ["string", "int", "string", "string"]
        rows = got.select(F.base64(F.col("text").cast("binary")), F.md5("text"), "path", "label", "subset").collect()
        assert sorted(r[:2] for r in rows) == sorted(r[:2] for r in by_spark.collect())
        assert len(rows) == 6 + len(packed)
        names = {r["path"].removeprefix(f"file:{tmp_path}/set/train/pos/"): r[3:] for r in rows}
        assert names.pop("deep/pos/a+b %20;.txt") == (1, "deep")
        assert names.pop("_metadata/pos/1.txt") == (1, "_metadata")
        assert set(names.values()) == {(1, "train")}


def test_a_missing_class_folder_is_an_error(spark, tmp_path):
    (tmp_path / "train" / "pos").mkdir(parents=True)
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_labeled_dirs(spark, str(tmp_path), subsets=["train"])
    (tmp_path / "train" / "neg").mkdir()
    assert read_labeled_dirs(spark, str(tmp_path), subsets=["train"]).collect() == []


@pytest.mark.parametrize("by_spark", [False, True])
def test_a_file_for_each_row(spark, tmp_path, monkeypatch, by_spark):
    if by_spark:
        monkeypatch.setattr(labeled_files, "mounted", lambda spark, path: None)
    texts = [None, "", "same", "same", "same", "two\r\nlines\n", "end\x1d", "é"]
    rows = spark.createDataFrame(
        [(t, f) for t in texts for f in ("train/pos", "train/neg")], "text string, folder string"
    )
    root = str(tmp_path / "set with space")
    write_labeled_dirs(rows, root, ["train/pos", "train/neg", "test/pos", "test/neg"], "\x1d")
    got = read_labeled_dirs(spark, root).collect()
    assert len({r["path"] for r in got}) == len(got) == 16
    expected = sorted(((t or "") + "\x1d", c) for t in texts for c in (0, 1))
    assert sorted((r["text"], r["label"]) for r in got) == expected
    if not by_spark:
        # no checksum files and none of an attempt
        assert len(list((tmp_path / "set with space").rglob("*.*"))) == 16
    with pytest.raises((FileExistsError, AnalysisException)):
        write_labeled_dirs(rows, root, ["train/pos"], "\x1d")


def test_archives(spark, tmp_path):
    for a in ("one", "two"):
        with tarfile.open(tmp_path / f"{a}.tar.gz", "w:gz") as archive:
            for i in range(3):
                member = tmp_path / f"{a}{i}.txt"
                member.write_text(f"{a} {i}")
                archive.add(member, arcname=f"data/{a}{i}.txt")
    (tmp_path / "bad.tar.gz").write_bytes(b"not an archive")
    paths = [str(tmp_path / f"{n}.tar.gz") for n in ("one", "two", "bad", "missing")]
    rows = read_tar_members(spark, paths).collect()
    good = {r["member"]: bytes(r["content"]).decode() for r in rows if r["error"] is None}
    assert good == {f"data/{a}{i}.txt": f"{a} {i}" for a in ("one", "two") for i in range(3)}
    assert [r["archive"].endswith("bad.tar.gz") for r in rows if r["error"]] == [True]
    assert read_tar_members(spark, [str(tmp_path / "nothing*.tar")]).count() == 0
    with pytest.raises(Exception, match="ReadError"):
        read_tar_members(spark, paths[2:3], on_error="fail").collect()


def test_media_lengths(spark, tmp_path):
    for name, rate, frames in (("a", 48_000, 48_000), ("b", 16_000, 0), ("c", 16_000, 480_000), ("d", 48_000, 1_439_997)):
        with wave.open(str(tmp_path / f"{name}.wav"), "wb") as audio:
            audio.setnchannels(1)
            audio.setsampwidth(2)
            audio.setframerate(rate)
            audio.writeframes(b"\0\0" * frames)
    (tmp_path / "e.wav").write_bytes(b"noise")
    lengths = media_lengths(spark, [str(tmp_path / "*.wav")])
    by_name = {r["path"][-5]: r["input_length"] for r in lengths.collect()}
    assert by_name == {"a": 16_000, "b": 0, "c": 480_000, "d": 479_999, "e": None}
    assert {r["path"][-5] for r in filter_length(lengths, "input_length").collect()} == {"a", "d"}


def test_csv_round_trip_and_union(spark, tmp_path):
    rows = spark.createDataFrame(
        [(t, i, "train" if i % 2 else "test") for i, t in enumerate(AWKWARD)],
        "text string, label int, split string",
    )
    path = str(tmp_path / "csv")
    tabular.write_splits_csv(rows, path, ["text", "label"])
    parts = [f"{path}/split=train", f"{path}/split=gone", f"{path}/split=test"]
    got = tabular.read_union(spark, parts, tabular.LABELED).collect()
    assert {r["label"]: r["text"] for r in got} == dict(enumerate(AWKWARD))
    with pytest.raises(FileNotFoundError):
        tabular.read_union(spark, parts[1:2], tabular.LABELED)
    assert tabular.read_union(spark, parts[1:2], tabular.LABELED, require_any=False).count() == 0


def test_split_pruning(spark, tmp_path):
    rows = spark.range(10).withColumn("split", F.when(F.col("id") < 3, "dev").otherwise("train"))
    tabular.write_dataset(rows, str(tmp_path / "set"))
    dev = tabular.read_dataset(spark, str(tmp_path / "set"), "dev")
    assert dev.count() == 3
    assert "PartitionFilters: [isnotnull(split" in dev._jdf.queryExecution().toString()


def test_log_history(spark, tmp_path):
    log = [{"step": 1, "loss": 0.5}, {"step": 1, "eval_loss": 0.4, "eval_wer": 30.0}, {"step": 2, "epoch": 1.0}]
    (tmp_path / "log.json").write_text(json.dumps(log, indent=2))
    got = [tuple(r) for r in tabular.read_log_history(spark, str(tmp_path / "log.json")).collect()]
    assert got == [(1, 0.5, None, None), (1, None, 0.4, 30.0), (2, None, None, None)]


def test_corpus_text(spark, tmp_path):
    lines = spark.createDataFrame([("a",), ("b",)], "value string")
    tabular.write_corpus_text(lines, str(tmp_path / "t"))
    assert sorted(r["value"] for r in spark.read.text(str(tmp_path / "t")).collect()) == ["a", "b"]


def test_row_functions(spark):
    rows = spark.createDataFrame([(1, "ab", 0.5)], "k int, t string, unused double")
    out = map_rows(rows, lambda r: {"k": r["k"], "n": len(r["t"])}, "k int, n int", ["k", "t"])
    assert [tuple(r) for r in out.collect()] == [(1, 2)]


def test_speech_plan(spark):
    manifest = spark.createDataFrame(
        [("It's 3.5", "twi", "/a/b/c/1.wav", "train"), ("x", "akan (fante)", "/a/b/d/2.wav", "dev")],
        "transcript string, accent string, audio_paths string, split string",
    )
    paths = ["/r/twi/train/data/data/intron/c/1.wav", "/r/akan-fante/dev/data/data/intron/d/2.wav"]
    lengths = spark.createDataFrame([(paths[0], 16_000), (paths[1], 0)], "audio string, input_length bigint")
    kept = speech.prepare_transcripts(
        manifest, "/r", lengths, F.size(F.split("transcript", " "))
    )
    assert [r.asDict() for r in kept.collect()] == [
        {"audio": paths[0], "transcript": "its three point five", "split": "train"}
    ]


def test_labeled_plan_writes_everything(spark, documents, tmp_path):
    rows = documents.select("doc_id", "text", (F.col("doc_id") % 2).cast("int").alias("label"))
    prepared = labeled.prepare_labeled_corpus(rows, ["doc_id"], per_class=30, vocab_size=150)
    labeled.write_prepared(prepared, str(tmp_path / "out"))
    saved = spark.read.json(str(tmp_path / "out" / "metadata")).first()
    assert (saved["total_samples"], saved["train_samples"], saved["val_samples"]) == (60, 57, 1)
    shaped = labeled.fit_shape(prepared.rows, "text", prepared.tokenizer, saved["max_length"])
    sizes = shaped.select(F.size("input_ids").alias("n"), F.size("attention_mask").alias("m")).distinct()
    assert [tuple(r) for r in sizes.collect()] == [(saved["max_length"], saved["max_length"])]


def test_class_folders_with_blanks_and_signs(spark, tmp_path):
    for name, text in (("very good", "a"), ("a+b%20", "b")):
        folder = tmp_path / "train" / name
        folder.mkdir(parents=True)
        (folder / "1.txt").write_text(text)
    got = read_labeled_dirs(spark, str(tmp_path), {"very good": 1, "a+b%20": 2}, subsets=["train"]).collect()
    assert {(r["text"], r["label"], r["subset"]) for r in got} == {("a", 1, "train"), ("b", 2, "train")}


def test_python_predicate_over_batches(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None), (3, "ccc")], "id int, t string")
    kept = filter_batches(rows, lambda i, t: (t.str.len() > 0) & (i != 1), ["id", "t"]).collect()
    assert [r["id"] for r in kept] == [3]


def test_python_predicate_gets_a_few_texts_at_a_time(spark):
    rows = spark.range(3_000).select("id", F.concat(F.lit("t"), "id").alias("t")).coalesce(1)
    kept = filter_batches(rows, lambda i, t: (i % 3 == 0) & (t.str.len() > 1) & (len(t) <= 512), ["id", "t"])
    assert sorted(r["id"] for r in kept.collect()) == list(range(0, 3_000, 3))
    dated = spark.createDataFrame([(1, "2020-01-02"), (2, None)], "id int, d string").withColumn("d", F.to_date("d"))
    assert [r["id"] for r in filter_batches(dated, lambda d: d.notna(), ["d"]).collect()] == [1]


class _Cluster:
    master = "spark://host:7077"

    def getCheckpointDir(self):
        return None


def test_a_cluster_needs_a_shared_folder():
    session = SimpleNamespace(
        sparkContext=_Cluster(), conf=SimpleNamespace(get=lambda key, default: default)
    )
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session)
