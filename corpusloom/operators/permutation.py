"""A keyed permutation of [0, n): positions by arithmetic, without a sort.

The numbers below n are written with two digits, of base a and b with a*b >= n and
a*b - n < a.  A round adds a hash of one digit to the other, so it can be taken back
by subtracting; a few rounds in turn on both digits mix them.  What lands at n or
above is sent through again until it is below (cycle walking), which keeps the map a
permutation of [0, n).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.arith import ceil_div, int_div

# The arithmetic of the order; SQL repeats it.
MULTIPLIERS = (2654435761 % (1 << 31), 2246822519 % (1 << 31))
KEY_MODULUS, KEY_SHIFT = 1 << 40, 9
MIX_MODULUS, MIX_SHIFT = 1 << 45, 14
SEED_MULTIPLIER, EPOCH_MULTIPLIER, ROUND_MULTIPLIER = 40503, 69069, 1013904223
SALT_MODULUS = 1 << 31
ROUNDS = 6
WALK = 64       # more than so many steps are an error; see `permuted`


def salts(seed: int, epoch: int) -> list[tuple[int, int]]:
    """Two numbers below 2**31 per round."""
    first = [seed * SEED_MULTIPLIER + epoch * EPOCH_MULTIPLIER + r * ROUND_MULTIPLIER for r in range(1, ROUNDS + 1)]
    return [(x % SALT_MODULUS, (x * MULTIPLIERS[1] + 1) % SALT_MODULUS) for x in first]


def _hash(digit: Column, salt: tuple[int, int]) -> Column:
    """31 bits of a digit below 2**31; the digit is read once."""
    keyed = F.shiftright((digit * F.lit(MULTIPLIERS[0]) + F.lit(salt[0])) % F.lit(KEY_MODULUS), KEY_SHIFT)
    return F.shiftright((keyed * F.lit(MULTIPLIERS[1]) + F.lit(salt[1])) % F.lit(MIX_MODULUS), MIX_SHIFT)


def bases(n: Column) -> tuple[Column, Column]:
    a = (F.floor(F.sqrt(n.cast("double"))) + 1).cast("bigint")
    return a, ceil_div(n, a)


def _rounds(x: Column, a: Column, b: Column, keys: list[tuple[int, int]], back: bool) -> Column:
    sign = F.lit(-1 if back else 1)
    high, low = int_div(x, b), x % b
    for which, salt in list(enumerate(keys))[:: -1 if back else 1]:
        if which % 2 == 0:
            high = F.pmod(high + sign * _hash(low, salt), a)
        else:
            low = F.pmod(low + sign * _hash(high, salt), b)
    return high * b + low


def _walked(x: Column, n: Column, seed: int, epoch: int, back: bool) -> Column:
    a, b = bases(n)
    keys = salts(seed, epoch)
    first = _rounds(x.cast("bigint"), a, b, keys, back)
    lost = F.raise_error(F.lit(f"more than {WALK} steps outside of the permutation's range")).cast("bigint")
    # only the few that are outside walk at all
    walk = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALK)),
        first,
        lambda at, _: F.when(at < n, at).otherwise(_rounds(at, a, b, keys, back)),
        lambda at: F.when(at < n, at).otherwise(lost),
    )
    return F.when(first < n, first).otherwise(walk)


def permuted(index: Column, n: Column, seed: int, epoch: int) -> Column:
    """Position of `index` in the epoch's order of [0, n); n is at most 2**62.

    Up to 64 numbers lie outside the range and so are walked through in any case; where there are
    more, n is over 4,096 and each step stays outside for less than one number in 64, so the
    error after 64 steps is a formality.
    """
    return _walked(index, n.cast("bigint"), seed, epoch, back=False)


def unpermuted(position: Column, n: Column, seed: int, epoch: int) -> Column:
    """The index at a position of the epoch's order: where a reader goes on after a restart."""
    return _walked(position, n.cast("bigint"), seed, epoch, back=True)
