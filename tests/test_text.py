import re
import string

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import text
from corpusloom.functions.numbers import MAX_DIGITS, ordinals_to_words
from corpusloom.plans.speech import normalize_transcript, numbers_to_words


def _apply(spark, fn, values):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, t string")
    return [r["o"] for r in rows.select("i", fn("t").alias("o")).orderBy("i").collect()]


NUMBERS = {
    "1ST place": "1ST place",
    "1st 2nd 3rd 21st": "first second third twenty-first",
    "a1st 1stx": "a1st 1stx",
    "0th 12th 20th 100th 1000th": "zeroth twelfth twentieth one hundredth one thousandth",
    "101st 1234th": "one hundred and first one thousand, two hundred and thirty-fourth",
    "3.14": "three point one four",
    "1.2.3": "one point two.three",
    "1.2a b.5": "one.2a b.five",
    "007 0": "seven zero",
    "1,234": "one,two hundred and thirty-four",
    "1234 1001 1100 1000000": "one thousand, two hundred and thirty-four one thousand and one "
    "one thousand, one hundred one million",
    "x_1 1_x ٣": "x_1 1_x three",
    "12000345": "twelve million, three hundred and forty-five",
    "9" * (MAX_DIGITS + 1): "9" * (MAX_DIGITS + 1),
    "no numbers": "no numbers",
    "": "",
}


def test_numbers(spark):
    assert _apply(spark, numbers_to_words, list(NUMBERS)) == list(NUMBERS.values())


def test_largest_numeral(spark):
    (words,) = _apply(spark, numbers_to_words, ["9" * MAX_DIGITS])
    assert words.startswith("nine hundred and ninety-nine decillion, ")
    assert words.endswith(" thousand, nine hundred and ninety-nine")


def test_upper_case_ordinals_stay(spark):
    assert _apply(spark, ordinals_to_words, ["2ND 2nd"]) == ["2ND second"]


def test_normalize(spark):
    cases = {
        "Well-known, TWENTY-three!": "wellknown twentythree",
        "1,234": "onetwo hundred and thirtyfour",
        "1.2.3": "one point twothree",
        "1ST": "1st",
        " café \n a\x1cb ": "caf a b",
    }
    assert _apply(spark, normalize_transcript, list(cases)) == list(cases.values())


def test_clean_matches_python(documents):
    def clean(t):
        t = re.sub(f"[{re.escape(string.punctuation)}]", "", t.lower())
        return re.sub(r"\s+", " ", re.sub(r"[^a-z0-9\s]", "", t)).strip()

    rows = documents.select("text", text.clean_transcript("text").alias("o")).collect()
    assert all(r["o"] == clean(r["text"]) for r in rows)


def test_pretokenize_takes_specials_out(spark):
    (tokens,) = _apply(
        spark, lambda c: text.pretokenize(c, ["[CLS]", "[SEP]"]), ["a([CLS])b[SEP] x[CL"]
    )
    assert tokens == ["a", "(", "[CLS]", ")", "b", "[SEP]", "x", "[", "CL"]


def test_paths_and_clips(spark):
    row = spark.createDataFrame(
        [("akan (fante)", "dev", "/x/y/abc/1.wav", "short")],
        "accent string, split string, audio_paths string, t string",
    )
    out = row.select(text.rewrite_media_path("/r/audio"), text.clip_text("t", 3)).first()
    assert tuple(out) == ("/r/audio/akan-fante/dev/data/data/intron/abc/1.wav", "sho...")


@pytest.mark.parametrize("value,code", [("pos", 1), ("neg", 0), ("other", None)])
def test_map_label(spark, value, code):
    row = spark.range(1).select(text.map_label(F.lit(value), {"pos": 1, "neg": 0}).alias("c"))
    assert row.first()["c"] == code
