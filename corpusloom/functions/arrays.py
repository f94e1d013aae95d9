"""Array expressions: fixed shapes, masks, label preparation, per-row scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

IGNORED_LABEL = -100  # fixed value: the label that a loss skips


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _int(value: int) -> Column:
    return F.lit(value).cast("int")


def wrap_ids(col: Column | str, first: int, last: int) -> Column:
    """Put the template's first and last special id around a sequence."""
    return F.concat(F.array(_int(first)), _col(col), F.array(_int(last)))


def truncate_ids(col: Column | str, n: int, last: int) -> Column:
    """Cut a wrapped sequence to ``n`` ids; a cut sequence still ends with its closing special."""
    c = _col(col)
    cut = F.concat(F.slice(c, 1, n - 1), F.array(_int(last)))
    return F.when(F.size(c) > n, cut).otherwise(c)


def pad_ids(col: Column | str, n: Column | int, pad: int) -> Column:
    """Fill up on the right to ``n`` ids; longer sequences stay as they are."""
    c = _col(col)
    target = _int(n) if isinstance(n, int) else n
    return F.concat(c, F.array_repeat(_int(pad), F.greatest(target - F.size(c), _int(0))))


def fit_length(col: Column | str, n: int, pad: int, last: int) -> Column:
    """Truncate, then pad: every sequence has ``n`` ids afterwards."""
    return pad_ids(truncate_ids(col, n, last), n, pad)


def attention_mask(col: Column | str, n: int) -> Column:
    """1 for each position a sequence fills, 0 for the padding up to ``n``.

    ``col`` is the sequence before padding: the mask follows its length, not the ids' values.
    """
    kept = F.least(F.size(_col(col)), _int(n))
    return F.concat(F.array_repeat(_int(1), kept), F.array_repeat(_int(0), _int(n) - kept))


def seq_pair_side(col: Column | str, n: int, bos: int, eos: int, pad: int) -> Column:
    """One side of a source/target pair: cut at ``n - 2``, wrap once more, pad, cut at ``n``.

    Given ids that already carry the template, the specials come out doubled and a long text loses
    its inner closing special. Give bare ids for single specials.
    """
    wrapped = wrap_ids(F.slice(_col(col), 1, max(n - 2, 0)), bos, eos)
    return F.slice(pad_ids(wrapped, n, pad), 1, n)


def mask_labels(col: Column | str, length: Column | str) -> Column:
    """Replace what lies past ``length`` by the ignored label."""
    n = _col(length)
    return F.transform(
        _col(col), lambda x, i: F.when(i < n, x).otherwise(_int(IGNORED_LABEL))
    )


def unmask_labels(col: Column | str, pad: int) -> Column:
    """Turn the ignored label back into the padding id."""
    return F.transform(
        _col(col), lambda x: F.when(x == IGNORED_LABEL, _int(pad)).otherwise(x)
    )


def decoder_input(col: Column | str) -> Column:
    """All ids but the last."""
    c = _col(col)
    return F.slice(c, _int(1), F.greatest(F.size(c) - 1, _int(0)))


def decoder_target(col: Column | str) -> Column:
    """All ids but the first."""
    c = _col(col)
    return F.slice(c, _int(2), F.greatest(F.size(c) - 1, _int(0)))


def ctc_collapse(col: Column | str, blank: int, group: bool = True) -> Column:
    """Drop repeats of the id before, then blanks; references are not grouped and keep their repeats."""
    c = _col(col)
    if not group:
        return F.filter(c, lambda x: x != blank)
    return F.filter(
        c,
        lambda x, i: ((i == 0) | (F.get(c, i - 1) != x)) & (x != blank),
    )


def argmax(col: Column | str) -> Column:
    """0-based place of the largest score; the first of equal ones."""
    c = _col(col)
    return (F.array_position(c, F.array_max(c)) - 1).cast("int")


def cross_entropy(logits: Column | str, label: Column | str) -> Column:
    """``logsumexp(z) - z[y]``, shifted by the maximum so that it cannot overflow."""
    z = _col(logits).cast("array<double>")
    peak = F.array_max(z)
    total = F.aggregate(z, F.lit(0.0), lambda acc, x: acc + F.exp(x - peak))
    return peak + F.log(total) - F.get(z, _col(label).cast("int"))


def token_count(col: Column | str, specials: bool = False) -> Column:
    """Length of a bare id sequence, with or without the template's two specials."""
    return F.size(_col(col)) + _int(2 if specials else 0)
