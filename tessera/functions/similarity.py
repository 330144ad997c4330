"""String similarity. What Spark has no function for runs as Arrow UDFs over bit-parallel kernels."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence; each step of b updates all of a's positions in one integer."""
    if len(a) > len(b):
        a, b = b, a
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    open_ = full
    for c in b:
        hit = open_ & masks.get(c, 0)
        open_ = ((open_ + hit) | (open_ - hit)) & full
    return len(a) - open_.bit_count()


def ratio(a: str, b: str) -> float:
    return 200.0 * lcs(a, b) / (len(a) + len(b)) if a or b else 100.0


def token_sort_ratio(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set_ratio(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both = " ".join(sorted(x & y))
    left, right = " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if both and (not left or not right):
        return 100.0
    gap = 1 if both else 0
    one, two = len(both) + gap + len(left), len(both) + gap + len(right)
    best = 100.0 * (1 - (len(left) + len(right) - 2 * lcs(left, right)) / (one + two))
    if both:
        best = max(best, 200.0 * len(both) / (len(both) + one), 200.0 * len(both) / (len(both) + two))
    return best


def _best_piece(a: str, b: str, best: float) -> float:
    """The best ratio of a, which is no longer than b, with a piece of b; pieces whose letters cannot reach what is found are not compared."""
    need, have, common = Counter(a), Counter(), 0
    for i in range(1 - len(a), len(b)):
        if i + len(a) <= len(b):
            c = b[i + len(a) - 1]
            have[c] += 1
            common += have[c] <= need[c]
        if i > 0:
            c = b[i - 1]
            common -= have[c] <= need[c]
            have[c] -= 1
        piece = min(i + len(a), len(b)) - max(i, 0)
        if 200.0 * common / (len(a) + piece) > best:
            best = max(best, ratio(a, b[max(0, i) : i + len(a)]))
    return best


def partial_ratio(a: str, b: str) -> float:
    """The best ratio of the shorter string with a piece of the longer one of its length, or with a shorter one at either end."""
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return 100.0 if not b else 0.0
    found = _best_piece(a, b, 0.0)
    return _best_piece(b, a, found) if len(a) == len(b) else found


def partial_token_ratio(a: str, b: str) -> float:
    """100 with a token in common; else the best partial ratio of the sorted tokens, or, where tokens repeat, of the distinct ones."""
    one, two = a.split(), b.split()
    x, y = set(one), set(two)
    if x & y:
        return 100.0
    found = partial_ratio(" ".join(sorted(one)), " ".join(sorted(two)))
    if len(x) < len(one) or len(y) < len(two):
        found = max(found, partial_ratio(" ".join(sorted(x)), " ".join(sorted(y))))
    return found


def wratio(a: str, b: str) -> float:
    if not a or not b:
        return 0.0
    unequal = max(len(a), len(b)) / min(len(a), len(b))
    plain = ratio(a, b)
    if unequal < 1.5:
        return max(plain, 0.95 * max(token_sort_ratio(a, b), token_set_ratio(a, b)))
    scale = 0.9 if unequal <= 8 else 0.6
    return max(plain, scale * partial_ratio(a, b), 0.95 * scale * partial_token_ratio(a, b))


def jaro_winkler(a: str, b: str) -> float:
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    used, mine = [False] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == c:
                used[j] = True
                mine.append(c)
                break
    m = len(mine)
    if not m:
        return 0.0
    swapped = sum(x != y for x, y in zip(mine, [b[j] for j in range(len(b)) if used[j]], strict=True)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swapped) / m) / 3
    if jaro <= 0.7:
        return jaro
    prefix = 0
    for x, y in zip(a[:4], b[:4], strict=False):
        if x != y:
            break
        prefix += 1
    return jaro + 0.1 * prefix * (1 - jaro)


KERNELS = {f.__name__: f for f in (ratio, token_sort_ratio, token_set_ratio, partial_ratio, wratio, jaro_winkler)}


#: Letters of a pair, up to which its similarity is remembered: with as many pairs as there may be, some 20 MB.
SHORT = 200


@lru_cache(50_000)
def _known(name: str, a: str, b: str) -> float:
    return KERNELS[name](a, b)


def similarity(name: str, a: str, b: str) -> float:
    return _known(name, a, b) if len(a) + len(b) <= SHORT else KERNELS[name](a, b)


def _column(name: str) -> Callable[[Column, Column], Column]:
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([round(similarity(name, x, y), 9) for x, y in zip(a, b, strict=True)], dtype="float64")

    return lambda a, b: F.pandas_udf(lambda x, y: run(x, y), DoubleType())(F.coalesce(a, F.lit("")), F.coalesce(b, F.lit("")))


def column_of(name: str) -> Callable[[Column, Column], Column]:
    """The similarity of that name as a function of two columns; a null counts as empty."""
    if name not in KERNELS:
        raise ValueError(f"no similarity {name}")
    return _column(name)


def levenshtein_percent(a: Column, b: Column) -> Column:
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, 100.0).otherwise(100.0 * (1 - F.levenshtein(a, b) / longest))


def set_jaccard(a: Column, b: Column, none: float) -> Column:
    """Of the distinct elements of two arrays; none, where both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, none).otherwise(F.size(F.array_intersect(a, b)) / union)


def number_overlap(a: Column, b: Column) -> Column:
    return set_jaccard(a, b, -1.0)


def digits_jaccard(a: Column, b: Column) -> Column:
    return set_jaccard(a, b, 1.0)


def first_digit_match(a: Column, b: Column) -> Column:
    return F.when((F.size(a) > 0) & (F.size(b) > 0) & (F.get(a, F.lit(0)) == F.get(b, F.lit(0))), 1.0).otherwise(0.0)


def veto(a: Column, b: Column) -> Column:
    return F.when((F.size(a) > 0) & (F.size(b) > 0) & ~F.arrays_overlap(a, b), 1.0).otherwise(0.0)


def house_conflict(a: Column, b: Column) -> Column:
    x, y = F.get(a, F.lit(0)), F.get(b, F.lit(0))
    return F.when((F.size(a) > 0) & (F.size(b) > 0) & (x != y) & ~F.array_contains(b, x) & ~F.array_contains(a, y), 1).otherwise(0)


def relative_length_difference(a: Column, b: Column) -> Column:
    return F.abs(F.length(a) - F.length(b)) / F.greatest(F.length(a), F.length(b), F.lit(1))


def length_ratio(a: Column, b: Column) -> Column:
    most = F.greatest(F.length(a), F.length(b))
    return F.when(most == 0, 1.0).otherwise(F.least(F.length(a), F.length(b)) / most)


def first_char_match(a: Column, b: Column) -> Column:
    return F.when((F.length(a) > 0) & (F.length(b) > 0) & (F.left(a, F.lit(1)) == F.left(b, F.lit(1))), 1.0).otherwise(0.0)
