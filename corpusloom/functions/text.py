"""Text expressions: transcript cleaning, pre-tokenising, label codes, paths."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The pre-tokeniser's two token shapes, runs of word characters and runs of the rest.
WORD_PATTERN = r"(?U)\w+|[^\w\s]+"

# Python's \s also holds the four ASCII separators, Java's Unicode \s does not.
SPACE_CLASS = r"\s\x1c-\x1f"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_transcript(col: Column | str) -> Column:
    """Lower-case, delete all but ASCII letters, digits and whitespace, collapse whitespace, trim."""
    kept = F.regexp_replace(F.lower(_col(col)), rf"(?U)[^a-z0-9{SPACE_CLASS}]", "")
    return F.trim(F.regexp_replace(kept, rf"(?U)[{SPACE_CLASS}]+", " "))


def pretokenize(col: Column | str, specials: Sequence[str] = ()) -> Column:
    """Split into runs of word characters and runs of other visible characters.

    ``specials`` are taken out first, wherever they stand, as one token each.
    """
    if not specials:
        return F.regexp_extract_all(_col(col), F.lit(WORD_PATTERN), F.lit(0))
    longest_first = sorted(specials, key=len, reverse=True)
    any_special = "|".join(rf"\Q{s}\E" for s in longest_first)
    pattern = rf"(?U){any_special}|(?:(?!{any_special})\w)++|(?:(?!{any_special})[^\w\s])++"
    return F.regexp_extract_all(_col(col), F.lit(pattern), F.lit(0))


def map_label(col: Column | str, mapping: Mapping[str, int]) -> Column:
    """Class name to class code; a name that is not in the mapping gives NULL."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.create_map(*pairs)[_col(col)]


def rewrite_media_path(
    root: str,
    accent: Column | str = "accent",
    split: Column | str = "split",
    path: Column | str = "audio_paths",
    renames: Mapping[str, str] | None = None,
    middle: str = "data/data/intron",
) -> Column:
    """``<root>/<accent>/<split>/<middle>/<last two components of path>``."""
    folder = _col(accent)
    # Fixed value: the one accent whose folder is spelt differently.
    for old, new in (renames or {"akan (fante)": "akan-fante"}).items():
        folder = F.replace(folder, F.lit(old), F.lit(new))
    tail = F.substring_index(_col(path), "/", -2)
    return F.concat_ws("/", F.lit(root), folder, _col(split), F.lit(middle), tail)


def clip_text(col: Column | str, n: int = 200, suffix: str = "...") -> Column:
    """The first ``n`` characters plus a suffix, which is added to short texts too."""
    return F.concat(F.substring(_col(col), 1, n), F.lit(suffix))


def words(col: Column | str) -> Column:
    """The words an error rate counts: whitespace runs become one space, then split at spaces."""
    one_space = F.regexp_replace(_col(col), rf"(?U)[{SPACE_CLASS}]{{2,}}", " ")
    stripped = F.regexp_replace(one_space, rf"(?U)^[{SPACE_CLASS}]+|[{SPACE_CLASS}]+$", "")
    return F.filter(F.split(stripped, " "), lambda w: w != "")


def summary_tokens(col: Column | str) -> Column:
    """Lower-cased runs of ASCII letters and digits, the units of summary scores."""
    return F.regexp_extract_all(F.lower(_col(col)), F.lit("[a-z0-9]+"), F.lit(0))
