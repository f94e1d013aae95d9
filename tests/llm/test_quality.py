"""Quality rules against brute force, on the given documents and on odd ones."""

import re
from collections import Counter, defaultdict

import duckdb
import pytest

from conftest import SF
from corpusloom.llm import quality_rules as qr
from corpusloom.llm.queries import QUERIES, SQL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    runs = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if runs[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    dup = len(lines) - len(set(lines))
    return len(words), sum(map(len, words)), symbols, dup, len(covered), len(lines)


def values(c):
    words, chars, symbols, dup, repeat, lines = c
    if not words:
        return {}
    return {
        "word_length": chars * 100 // words,
        "symbol_share": symbols * 10_000 // chars,
        "dup_share": dup * 10_000 // lines,
        "repeat_share": repeat * 10_000 // words,
    }


def rounded(v):
    cut = max(0, v.bit_length() - qr.PRECISION)
    return v >> cut << cut


def at(sorted_values, permille):
    return sorted_values[max(0, -(-len(sorted_values) * permille // 1000) - 1)]


def verdicts(rows, min_group=qr.MIN_GROUP):
    """(base_failed, kept) of each (text, lang, source)."""
    held = defaultdict(list)
    for text, lang, source in rows:
        for name, v in values(counts(text)).items():
            for group in ((), (lang,), (lang, source)):
                held[group, name].append(rounded(v))
    out = []
    for text, lang, source in rows:
        c = counts(text)
        failed = c[0] < 50 or 100 * c[4] > 50 * c[0]
        inside = True
        for name, v in values(c).items():
            group = next(
                g for g in ((lang, source), (lang,), ()) if not g or len(held[g, name]) >= min_group
            )
            s = sorted(held[group, name])
            low, mid, high = at(s, qr.OUTER), at(s, 500), at(s, 1000 - qr.OUTER)
            top = high + qr.REACH * max(high - mid, qr.SLACK[name])
            bottom = low - qr.REACH * max(mid - low, qr.SLACK[name])
            inside &= v <= top and (v >= bottom or name not in qr.LOWER)
        out.append((*c[:5], failed, not failed and inside))
    return out


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
HOSTILE = [
    (1, None, "en", "a"),
    (2, "", None, None),
    (3, " \n\t\n ", "en", None),
    (4, "a a a a a " * 30, "en", "a"),
    (5, "x y z w " * 2 + "\nsame line\nsame line\n same line\n\n\n", None, "a"),
    (5, "x y z w " * 2 + "\nsame line\nsame line\n same line\n\n\n", None, "a"),
    (None, "é 中文 <b>&amp;</b> | $5 100% #1 *x* y z", "fr", "b"),
    (7, " ".join(f"w{i}" for i in range(400_000)), "en", "a"),
    (8, "word" * 50_000, "en", "a"),
    (9, "A a A a A\x00 a", "en", "a"),
]


def test_query_equals_brute_force(spark, documents):
    rows = documents.select("doc_id", "text", "lang", "source").collect()
    want = dict(zip([r["doc_id"] for r in rows], verdicts([(r["text"], r["lang"], r["source"]) for r in rows])))
    got = QUERIES["op11_quality_rules"](spark, SF).collect()
    assert {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in got} == want
    assert {kept for *_, kept in want.values()} == {True, False}


@pytest.mark.parametrize("min_group", [qr.MIN_GROUP, 2])
def test_hostile_rows(spark, min_group, monkeypatch):
    monkeypatch.setattr(qr.fences, "__defaults__", (*qr.fences.__defaults__[:-1], min_group))
    docs = spark.createDataFrame(
        [(*row, 1, "z") for row in HOSTILE],
        "doc_id long, text string, lang string, source string, measure int, bucket string",
    )
    got = qr.judge(docs, keep=["measure", "bucket"])
    want = [(r[0], *v) for r, v in zip(HOSTILE, verdicts([r[1:] for r in HOSTILE], min_group))]
    assert sorted((tuple(r[c] for c in ("doc_id", *COLUMNS)) for r in got.collect()), key=repr) == sorted(
        want, key=repr
    )
    left = qr.quality_filter(docs)
    assert left.columns == docs.columns
    assert left.count() == sum(w[-1] for w in want)


def test_clashing_names_and_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert qr.judge(empty).count() == 0
    with pytest.raises(ValueError):
        qr.judge(empty.withColumnRenamed("doc_id", "kept"), key="kept")


def test_merged_sketches_are_sketches_of_the_whole(spark):
    rows = [(i % 3, (i * 7919) % 100_003) for i in range(20_000)]
    df = spark.createDataFrame(rows, "g int, v long")
    parts = qr.sketches(df, ["g"], ["v"])
    whole = qr.merged(parts, [])
    assert sorted(whole.collect()) == sorted(qr.sketches(df, [], ["v"]).collect())
    found = qr.quantiles(whole, [], {"q1": 100, "q5": 500, "q9": 900}).first()
    ordered = sorted(v for _, v in rows)
    for name, permille in (("q1", 100), ("q5", 500), ("q9", 900)):
        right = at(ordered, permille)
        assert found[name] == rounded(right) and right * (1 - 2 ** (1 - qr.PRECISION)) <= found[name] <= right


def test_null_and_white_space_rows_in_sql(spark):
    """The query's SQL on odd rows."""
    rows = [r for r in HOSTILE if r[1] is None or "\x00" not in r[1]]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", rows)
    result = con.execute(SQL["op11_quality_rules"])
    names = [d[0] for d in result.description]
    got = sorted((tuple(dict(zip(names, r))[c] for c in ("doc_id", *COLUMNS)) for r in result.fetchall()), key=repr)
    want = [(r[0], *v) for r, v in zip(rows, verdicts([r[1:] for r in rows]))]
    assert got == sorted(want, key=repr)
