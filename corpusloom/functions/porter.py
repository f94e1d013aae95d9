"""Suffix stripping for English words after Porter (1980), with the usual later revisions.

The revisions are those of the widely used extended variant: a table of irregular words, ``-ies`` and
``-ied`` of short words, ``y`` after a consonant, ``-alli``, ``-fulli``, ``-logi`` and ``-bli``.
"""

from __future__ import annotations

# Words with a stem of their own.
IRREGULAR = {
    "sky": "sky",
    "skies": "sky",
    "dying": "die",
    "lying": "lie",
    "tying": "tie",
    "news": "news",
    "innings": "inning",
    "inning": "inning",
    "outings": "outing",
    "outing": "outing",
    "cannings": "canning",
    "canning": "canning",
    "howe": "howe",
    "proceed": "proceed",
    "exceed": "exceed",
    "succeed": "succeed",
}

# The suffix tables of steps 2, 3 and 4.
STEP_2 = (
    ("ational", "ate"),
    ("tional", "tion"),
    ("enci", "ence"),
    ("anci", "ance"),
    ("izer", "ize"),
    ("bli", "ble"),
    ("alli", "al"),
    ("entli", "ent"),
    ("eli", "e"),
    ("ousli", "ous"),
    ("ization", "ize"),
    ("ation", "ate"),
    ("ator", "ate"),
    ("alism", "al"),
    ("iveness", "ive"),
    ("fulness", "ful"),
    ("ousness", "ous"),
    ("aliti", "al"),
    ("iviti", "ive"),
    ("biliti", "ble"),
    ("fulli", "ful"),
)
STEP_3 = (
    ("icate", "ic"),
    ("ative", ""),
    ("alize", "al"),
    ("iciti", "ic"),
    ("ical", "ic"),
    ("ful", ""),
    ("ness", ""),
)
STEP_4 = (
    "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize"
).split()


def _shape(word: str) -> str:
    """``v`` and ``c`` per letter; a y is a vowel after a consonant."""
    out = ""
    for letter in word:
        vowel = letter in "aeiou" or (letter == "y" and out[-1:] == "c")
        out += "v" if vowel else "c"
    return out


def _measure(stem: str) -> int:
    return _shape(stem).count("vc")


def _short_end(stem: str) -> bool:
    """Consonant, vowel, consonant other than w, x, y; or a two-letter vowel, consonant."""
    shape = _shape(stem)
    return (shape.endswith("cvc") and stem[-1] not in "wxy") or shape == "vc"


def _double_end(stem: str) -> bool:
    return len(stem) > 1 and stem[-1] == stem[-2] and _shape(stem)[-1] == "c"


def _plurals(word: str) -> str:
    if word.endswith("ies"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("sses"):
        return word[:-2]
    return word[:-1] if word.endswith("s") and not word.endswith("ss") else word


def _past_and_progressive(word: str) -> str:
    if word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    for suffix in ("ed", "ing"):
        stem = word[: -len(suffix)]
        if word.endswith(suffix) and "v" in _shape(stem):
            break
    else:
        return word
    if stem.endswith(("at", "bl", "iz")):
        return stem + "e"
    if _double_end(stem):
        return stem if stem[-1] in "lsz" else stem[:-1]
    return stem + "e" if _measure(stem) == 1 and _short_end(stem) else stem


def _final_y(word: str) -> str:
    stem = word[:-1]
    if word.endswith("y") and len(stem) > 1 and _shape(stem)[-1] == "c":
        return stem + "i"
    return word


def _replace_first(word: str, table) -> str:
    for suffix, new in table:
        if word.endswith(suffix):
            stem = word[: -len(suffix)]
            return stem + new if _measure(stem) > 0 else word
    return word


def _double_suffixes(word: str) -> str:
    if word.endswith("alli") and _measure(word[:-4]) > 0:
        return _double_suffixes(word[:-2])
    if word.endswith("logi"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    return _replace_first(word, STEP_2)


def _last_suffix(word: str) -> str:
    for suffix in STEP_4:
        if word.endswith(suffix):
            stem = word[: -len(suffix)]
            fits = _measure(stem) > 1 and (suffix != "ion" or stem[-1:] in ("s", "t"))
            return stem if fits else word
    return word


def _final_e(word: str) -> str:
    stem = word[:-1]
    if word.endswith("e") and (_measure(stem) > 1 or (_measure(stem) == 1 and not _short_end(stem))):
        word = stem
    if word.endswith("ll") and _measure(word[:-1]) > 1:
        word = word[:-1]
    return word


def stem_word(word: str) -> str:
    """The stem of a lower-case word."""
    if word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) <= 2:
        return word
    word = _final_y(_past_and_progressive(_plurals(word)))
    word = _replace_first(_double_suffixes(word), STEP_3)
    return _final_e(_last_suffix(word))
