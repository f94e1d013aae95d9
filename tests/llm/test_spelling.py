"""Spelling groups against brute force."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF
from corpusloom.llm import spelling_variants as sv
from corpusloom.llm.queries import QUERIES


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i:] == b[i + 1 :] if len(a) < len(b) else a[i + 1 :] == b[i + 1 :]


def counted(rows, damage=97):
    total = Counter()
    for key, text in rows:
        lower = "".join(c.lower() if c.isascii() else c for c in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", lower):
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if damage and h % damage == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}


def expected(words):
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words.get(form[w])))
    return out


def rows_of(df):
    got = [tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_query_equals_brute_force(spark, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    words = counted(rows)
    assert len(words) > 100
    got = QUERIES["op13_spelling_variants"](spark, SF)
    assert rows_of(got) == expected(words)
    assert dict(got.dtypes) == {"word": "string", "form": "string", "root": "string"} | dict.fromkeys(
        ("n", "n_near", "form_n"), "bigint"
    )


HOSTILE = [
    (1, None),
    (2, ""),
    (3, "  \x00 123 ... 中文"),
    (4, "Haben×HABEN haben ÉCOLE école " * 3),
    (5, "koloured coloured coloure colourred colored " * 4),
    (5, "koloured coloured coloure colourred colored " * 4),
    (None, "coloured colours colour's " * 2),
    (7, "a" * 40_000),
    (8, "aaaaa aaaab aaabb aabbb abbbb bbbbb " * 5 + "aaaaa " * 6 + "aaabb " * 11),
    (9, "naive naïve naïveté " * 3),
]


@pytest.mark.parametrize("symbols", [None, 1, 2, 40])
def test_hostile_rows_and_any_alphabet(spark, symbols):
    docs = spark.createDataFrame(
        [(k, t, "x", 1) for k, t in HOSTILE], "doc_id long, text string, word string, n int"
    )
    got = sv.spelling_groups(sv.word_counts(docs), symbols=symbols)
    want = expected(counted(HOSTILE))
    assert rows_of(got) == want
    assert any(w[1] for w in want)


def test_chain_of_forms_is_followed_to_its_end(spark):
    chain = [("a" * (5 + i), 3 * 2**i) for i in range(12)]
    words = spark.createDataFrame(chain, "word string, n long")
    assert rows_of(sv.spelling_groups(words)) == expected(dict(chain))
    assert {r[2] for r in rows_of(sv.spelling_groups(words))} == {"a" * 16}


def test_no_table_of_words_is_broadcast(spark, monkeypatch):
    """Files of words are small beside the words, and a table of neighbours is sized by its words."""
    plans = []
    write = sv.materialize

    def planned(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(sv, "materialize", planned)
    words = {"haben": 9, "habem": 3, "hoben": 4, "klein": 3}
    got = sv.spelling_groups(spark.createDataFrame(list(words.items()), "word string, n long"))
    plans.append(got._jdf.queryExecution().executedPlan().toString())
    assert "SortMergeJoin" in plans[1] and "SortMergeJoin" in plans[-1]
    assert not [p for p in plans if "Broadcast" in p]
    assert rows_of(got) == expected(words)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert sv.spelling_groups(sv.word_counts(docs)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text("abcde", min_size=5, max_size=9), st.data(), st.integers(1, 9))
def test_neighbourhood_holds_every_edit(word, data, alphabet):
    place = data.draw(st.integers(0, len(word)))
    kind = data.draw(st.sampled_from("dir"))
    letter = data.draw(st.sampled_from("abcdez"))
    other = {
        "d": word[:place] + word[place + 1 :],
        "i": word[:place] + letter + word[place:],
        "r": word[:place] + letter + word[place + 1 :],
    }[kind]

    def points(w):
        return np.array([[ord(c) for c in w]], np.uint32)

    near = sv.neighbourhood(sv.reduced(points(word), alphabet), alphabet)
    assert sv._numbers(sv.reduced(points(other), alphabet))[1][0, -1] in near[0]
