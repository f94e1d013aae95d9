"""Aligned tokens against the two libraries and brute force."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from conftest import SF
from corpusloom.llm import token_alignment
from corpusloom.llm.queries import QUERIES

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=B)


def byte_of():
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    table = {chr(b): b for b in shown}
    for b in range(256):
        if b not in shown:
            table[chr(256 + len(table) - len(shown))] = b
    return table


def spelled(libraries, text):
    """(id, start, end) of the tokens of both, or None."""
    first, second = libraries
    back = byte_of()
    a = first.encode(" " + text, add_special_tokens=False).ids
    b = second.encode(text)
    tokens = [[(i, bytes(back[c] for c in first.id_to_token(i))) for i in a], []]
    for i in b:
        piece = second.id_to_piece(i)
        data = bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()
        tokens[1].append((i, data))
    whole = (" " + text).encode()
    if any(b"".join(x for _, x in side) != whole for side in tokens):
        return None
    placed = []
    for side in tokens:
        at, out = 0, []
        for i, data in side:
            out.append((i, at, at + len(data)))
            at += len(data)
        placed.append(out)
    return placed


def expected(libraries, rows):
    found, total = [], Counter()
    for key, text in rows:
        placed = spelled(libraries, text) if text else None
        if placed is None:
            found.append((key, 0, 0, [], []))
            continue
        a, b = placed
        links, j = [], 0
        for i, start, end in a:
            while b[j][2] <= start:
                j += 1
            k = j
            while k < len(b) and b[k][1] < end:
                links.append((i, b[k][0]))
                k += 1
        total.update(links)
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, begin = [], 0
        ia = ib = 0
        for end in ends:
            left, right = [], []
            while ia < len(a) and a[ia][2] <= end:
                left.append(a[ia][0])
                ia += 1
            while ib < len(b) and b[ib][2] <= end:
                right.append(b[ib][0])
                ib += 1
            groups.append(",".join(map(str, left)) + "|" + ",".join(map(str, right)))
        found.append((key, len(a), len(b), groups, links))
    most = {}
    for (_, second), n in total.items():
        most[second] = max(most.get(second, 0), n)
    out = []
    for key, na, nb, groups, links in found:
        text = ";".join(groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if text else ""
        best = sum(total[x] == most[x[1]] for x in links)
        out.append((key, na, nb, len(groups), len(links), best, sum(total[x] for x in links), digest))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_query_equals_libraries_and_brute_force(spark, documents, libraries):
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    got = QUERIES["op12_token_alignment"](spark, SF)
    assert sorted((tuple(r[c] for c in COLUMNS) for r in got.collect()), key=repr) == expected(libraries, rows)


HOSTILE = [
    (1, None),
    (2, ""),
    (3, " "),
    (4, "   two  spaces   and \t tabs\n\n new lines \r\n"),
    (5, "<|endoftext|> <s> </s> <unk> <0x41> plain"),
    (6, "a▁b ▁ marked"),
    (7, "中文 текст 🙂🙂 é ½²²  nul\x00 "),
    (7, "the same same same words words"),
    (7, "the same same same words words"),
    (None, "the same words"),
    (9, "long " * 9_000),
    (10, "x" * 9_000),
    (11, " 　​ odd spaces"),
]


def test_hostile_rows(spark, libraries):
    docs = spark.createDataFrame(
        [(k, t, "q", 5, 1) for k, t in HOSTILE], "doc_id long, text string, pairs string, n_a int, batch int"
    )
    got = token_alignment.align(docs, A, B).collect()
    want = expected(libraries, HOSTILE)
    mine = []
    for r in got:
        digest = hashlib.sha256(r["groups"].encode()).hexdigest() if r["groups"] else ""
        mine.append(tuple(digest if c == "groups_sha256" else r[c] for c in COLUMNS))
    assert sorted(mine, key=repr) == want
    assert any(w[0] == 6 and not w[1] for w in want)


def test_hash_collisions_change_nothing(spark, libraries, monkeypatch):
    """With every window hashed alike, each stands for itself."""
    pair = token_alignment.Pair(token_alignment.read_vocabulary(A)[0], open(B, "rb").read())
    texts = [t for _, t in HOSTILE]
    right = token_alignment.Aligner(pair).batch(texts)
    monkeypatch.setattr(token_alignment, "_run_hashes", lambda ids, starts, ends: starts.astype("u8") * 0)
    other = token_alignment.Aligner(pair).batch(texts)
    assert other[1:] == right[1:]
    assert all((other[0][c] == right[0][c]).all() for c in right[0])


class Counting:
    """A processor that keeps what it is given."""

    def __init__(self, processor):
        self.processor, self.given = processor, []

    def encode(self, texts, **given):
        self.given += texts
        return self.processor.encode(texts, **given)


def test_words_met_before_are_not_tokenised_again(libraries, monkeypatch):
    rng = random.Random(5)
    signs = list("ab Cé1'  \n\t\u3000sß<😀.,▁½\x00中") + [" the ", " of", "<s>", "<|endoftext|>", "thing", "  "]
    odd = ["".join(rng.choice(signs) for _ in range(rng.randint(1, 60))) for _ in range(600)]
    plain = [" ".join(rng.choice(["the", "of.", "to\nkens", "wörter", "x1y2"]) for _ in range(30)) + "z" for _ in range(50)]
    texts = [*(t for _, t in HOSTILE), *odd, "trailing space ", *plain]
    pair = token_alignment.Pair(token_alignment.read_vocabulary(A)[0], open(B, "rb").read())
    pair.processor = Counting(pair.processor)
    for most in (token_alignment.CACHED, 5, 5):
        monkeypatch.setattr(token_alignment, "CACHED", most)
        places, ids, sizes = pair.tokenised(texts)
        ends = [[0, *n.cumsum().tolist()] for n in sizes]
        got = {i: [side[e[k] : e[k + 1]].tolist() for side, e in zip(ids, ends)] for k, i in enumerate(places.tolist())}
        for i, text in enumerate(texts):
            placed = spelled(libraries, text) if text else None
            assert got.get(i) == (placed and [[x for x, *_ in side] for side in placed])
    monkeypatch.undo()
    pair.tokenised(plain)
    pair.processor.given.clear()
    assert len(pair.tokenised(plain + plain[::-1])[0]) == 2 * len(plain)
    assert not pair.processor.given


def test_only_some_models_part_at_spaces():
    from sentencepiece import sentencepiece_model_pb2

    held = sentencepiece_model_pb2.ModelProto.FromString(open(B, "rb").read())
    assert token_alignment.parts_at_spaces(held.SerializeToString())

    def changed(change):
        other = sentencepiece_model_pb2.ModelProto()
        other.CopyFrom(held)
        change(other)
        return other.SerializeToString()

    for change in (
        lambda m: setattr(m.trainer_spec, "model_type", m.trainer_spec.UNIGRAM),
        lambda m: setattr(m.trainer_spec, "byte_fallback", False),
        lambda m: setattr(m.normalizer_spec, "remove_extra_whitespaces", True),
        lambda m: setattr(m.normalizer_spec, "precompiled_charsmap", b"x"),
        lambda m: m.pieces.add(piece="of▁the", score=-1.0),
        lambda m: m.pieces.add(piece="own", score=0.0, type=m.SentencePiece.USER_DEFINED),
    ):
        assert not token_alignment.parts_at_spaces(changed(change))
    whole = token_alignment.Pair(
        token_alignment.read_vocabulary(A)[0], changed(lambda m: m.pieces.add(piece="the▁words", score=0.0))
    )
    texts = ["the words of 中 a text", "", "the words"]
    places, (_, b), (_, nb) = whole.tokenised(texts)
    assert b.tolist() == [i for k in places for i in whole.processor.encode(texts[k])]
    assert nb.tolist() == [len(whole.processor.encode(texts[k])) for k in places]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert token_alignment.align(docs, A, B).count() == 0
