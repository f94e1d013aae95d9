"""Numerals to English words, inside the JVM.

A text is cut into numerals and the stretches between them with one regular expression, the
numerals are spelt through lookups in constant arrays, and the pieces are joined again. Texts without
a digit skip all of it.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# The English number words.
UNITS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen "
    "fifteen sixteen seventeen eighteen nineteen"
).split()
TENS = "twenty thirty forty fifty sixty seventy eighty ninety".split()
SCALES = (
    "thousand million billion trillion quadrillion quintillion sextillion septillion octillion "
    "nonillion decillion"
).split()
IRREGULAR_ORDINALS = {
    "one": "first",
    "two": "second",
    "three": "third",
    "five": "fifth",
    "eight": "eighth",
    "nine": "ninth",
    "twelve": "twelfth",
}
MAX_DIGITS = 3 * (len(SCALES) + 1)  # longer numerals stay as they are

# Edges as Python sees them: letters, numbers and the underscore make a word.
_LEFT = r"(?<![\p{L}\p{N}_])"
_RIGHT = r"(?![\p{L}\p{N}_])"
ORDINAL = rf"{_LEFT}\p{{Nd}}+(?:st|nd|rd|th){_RIGHT}"
DECIMAL = rf"{_LEFT}\p{{Nd}}+\.\p{{Nd}}+{_RIGHT}"
INTEGER = rf"{_LEFT}\p{{Nd}}+{_RIGHT}"


def _below_hundred(n: int) -> str:
    if n < 20:
        return UNITS[n]
    tens, unit = divmod(n, 10)
    return TENS[tens - 2] + (f"-{UNITS[unit]}" if unit else "")


def _below_thousand(n: int) -> str:
    hundreds, rest = divmod(n, 100)
    if not hundreds:
        return _below_hundred(rest)
    return f"{UNITS[hundreds]} hundred" + (f" and {_below_hundred(rest)}" if rest else "")


def _ordinal_word(word: str) -> str:
    if word in IRREGULAR_ORDINALS:
        return IRREGULAR_ORDINALS[word]
    return word[:-1] + "ieth" if word.endswith("y") else word + "th"


@lru_cache(maxsize=1)
def _digit_tables() -> tuple[str, str]:
    """All decimal digits outside ASCII, and the ASCII digits they stand for."""
    digits = [chr(c) for c in range(128, sys.maxunicode + 1) if chr(c).isdecimal()]
    return "".join(digits), "".join(str(unicodedata.decimal(d)) for d in digits)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _table(values: list[str]) -> Column:
    # one constant instead of a thousand literal nodes; folded once by the optimizer
    return F.split(F.lit("|".join(values)), r"\|")


def _ascii_digits(numeral: Column) -> Column:
    """ASCII digits without leading zeros."""
    source, target = _digit_tables()
    plain = F.when(numeral.rlike("^[0-9]*$"), numeral).otherwise(
        F.translate(numeral, source, target)
    )
    return F.regexp_replace(plain, "^0+(?=[0-9])", "")


def spell_integer(digits: Column) -> Column:
    """Words of an ASCII numeral without leading zeros, e.g. ``one hundred and twenty-three``."""
    below_thousand = _table([_below_thousand(n) for n in range(1000)])
    scales = _table([""] + [f" {s}" for s in SCALES])

    def spoken_groups(padded: Column) -> Column:
        groups = (F.length(padded) / 3).cast("int")
        values = F.transform(
            F.sequence(F.lit(0), groups - 1),
            lambda i: F.substring(padded, i * 3 + 1, F.lit(3)).cast("int"),
        )
        return F.filter(
            F.transform(
                values,
                lambda v, i: F.when(
                    v > 0, F.concat(F.get(below_thousand, v), F.get(scales, groups - 1 - i))
                ),
            ),
            lambda w: w.isNotNull(),
        )

    def joined(spoken: Column, padded: Column) -> Column:
        # a last group below one hundred is joined by "and", any other by a comma
        last = F.substring(padded, -3, 3).cast("int")
        joint = F.when((last > 0) & (last < 100), F.lit(" and ")).otherwise(F.lit(", "))
        head = F.array_join(F.slice(spoken, F.lit(1), F.size(spoken) - 1), ", ")
        return (
            F.when(F.size(spoken) == 0, F.lit(UNITS[0]))
            .when(F.size(spoken) == 1, F.get(spoken, F.lit(0)))
            .otherwise(F.concat(head, joint, F.get(spoken, F.size(spoken) - 1)))
        )

    width = F.ceil(F.length(digits) / 3).cast("int") * 3
    return _let(
        F.lpad(digits, width, F.lit("0")),
        lambda padded: _let(spoken_groups(padded), lambda spoken: joined(spoken, padded)),
    )


def spell_ordinal(digits: Column) -> Column:
    """Words of an ordinal numeral, e.g. ``twenty-first``."""
    cardinals = UNITS + TENS + ["hundred"] + SCALES
    names, ordinals = _table(cardinals), _table([_ordinal_word(w) for w in cardinals])

    def last_word_changed(spelt: Column) -> Column:
        last = F.regexp_extract(spelt, "[a-z]+$", 0)
        place = F.array_position(names, last).cast("int")
        stem = F.substring(spelt, F.lit(1), F.length(spelt) - F.length(last))
        return F.concat(stem, F.get(ordinals, place - 1))

    return _let(spell_integer(digits), last_word_changed)


def spell_decimal(whole: Column, fraction: Column) -> Column:
    """Integer part, ``point``, then digit by digit."""
    source, target = _digit_tables()
    spoken = F.transform(
        F.split(F.translate(fraction, source, target), ""),
        lambda d: F.get(_table(UNITS[:10]), d.cast("int")),
    )
    return F.concat(spell_integer(whole), F.lit(" point "), F.array_join(spoken, " "))


def _rewrite(
    col: Column | str, pattern: str, spell: Callable[[Column, Column], Column]
) -> Column:
    """Replace each match of ``pattern`` by its spelling, leaving too long numerals alone.

    ``spell`` gets the leading digits of the match and the match.
    """
    c = F.col(col) if isinstance(col, str) else col

    def piece(p: Column) -> Column:
        leading = _ascii_digits(F.regexp_extract(p, r"^\p{Nd}+", 0))
        spelt = _let(
            leading, lambda d: F.when(F.length(d) <= MAX_DIGITS, spell(d, p)).otherwise(p)
        )
        return F.when(p.rlike(rf"^(?:{pattern})$"), spelt).otherwise(p)

    # a whole word that holds no match stays one piece, so that no part of it looks like a numeral
    cut = F.lit(rf"{pattern}|[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_]+")

    def rewritten(text: Column) -> Column:
        pieces = F.regexp_extract_all(text, cut, F.lit(0))
        return F.when(
            text.rlike(pattern), F.array_join(F.transform(pieces, piece), "")
        ).otherwise(text)

    return _let(c, rewritten)


def ordinals_to_words(col: Column | str) -> Column:
    """``21st`` to ``twenty-first``; only lower-case endings count."""
    return _rewrite(col, ORDINAL, lambda digits, _: spell_ordinal(digits))


def decimals_to_words(col: Column | str) -> Column:
    """``3.14`` to ``three point one four``."""
    return _rewrite(
        col, DECIMAL, lambda digits, p: spell_decimal(digits, F.substring_index(p, ".", -1))
    )


def integers_to_words(col: Column | str) -> Column:
    """``123`` to ``one hundred and twenty-three``; leading zeros are lost."""
    return _rewrite(col, INTEGER, lambda digits, _: spell_integer(digits))
