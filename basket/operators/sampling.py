"""Deterministic sampling by key hash.

``DataFrame.sample`` keeps a different set of rows when the partition layout
changes; a threshold on a seeded hash of the key keeps the same keys whatever
the layout, needs no shuffle, and every branch of a plan that filters the same
key with it agrees.  The hash is the 128-bit md5 of (seed, step, key), compared
as hexadecimal text, so any SQL engine can repeat it and a fraction is kept to
its full precision.  ``step`` names the sampling step: two steps with different
names sample independently, so their fractions multiply.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F


def key_hash(key: str, seed: int, step: str) -> Column:
    """32 hexadecimal digits; a NULL key hashes like an empty one."""
    value = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.md5(F.concat_ws("/", F.lit(str(int(seed))), F.lit(step), value).cast("binary"))


def threshold(fraction: float) -> str:
    """The least hash outside the sample, as 32 hexadecimal digits."""
    return f"{int(Fraction(fraction) * 2**128):032x}"


def in_sample(key: str, fraction: float, seed: int, step: str) -> Column:
    """Whether the key's hash falls in the first ``fraction`` of the hash space."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError(f"fraction must be in [0, 1], got {fraction}")
    if fraction >= 1.0:
        return F.lit(True)
    return key_hash(key, seed, step) < F.lit(threshold(fraction))


def hash_sample(df: DataFrame, key: str, fraction: float, seed: int, step: str = "rows") -> DataFrame:
    """Rows whose key is in the sample of that step."""
    return df.filter(in_sample(key, fraction, seed, step))


# Hexadecimal digits decided in one pass, and the keys that are few enough to look at one by one.
_DIGITS, _FEW = 3, 10_000


def hash_cutoff(keys: DataFrame, key: str, max_keys: int, seed: int, step: str = "cap") -> Row | None:
    """``(h, k)`` of the last of the ``max_keys`` distinct keys with the smallest (hash, key); None if there are no more than that.

    A radix select: every pass counts the distinct keys by the next digits of their hash (at most 4,096 rows come
    back) and goes on with the one prefix in which the cap falls.  Passes are scans with a filter on the hash:
    keys outside the prefix are dropped before anything is shuffled, nothing is sorted or stored, and the last few keys decide.
    """
    max_keys = int(max_keys)
    if max_keys < 1:
        raise ValueError(f"max_keys must be at least 1, got {max_keys}")
    hashed = keys.select(key_hash(key, seed, step).alias("h"), F.col(key).alias("k"))
    prefix, left = "", max_keys
    while True:
        near = hashed.filter(F.col("h").startswith(prefix)) if prefix else hashed
        digits = F.substring("h", len(prefix) + 1, _DIGITS).alias("d")
        counts = sorted((r.d, r.n) for r in near.distinct().groupBy(digits).agg(F.count(F.lit(1)).alias("n")).collect())
        if sum(n for _, n in counts) < left or (not prefix and sum(n for _, n in counts) == left):
            return None
        for d, n in counts:
            if n >= left:
                break
            left -= n
        prefix += d
        if n <= _FEW or len(prefix) + _DIGITS > 32:
            last = hashed.filter(F.col("h").startswith(prefix)).distinct().orderBy("h", "k").limit(left)
            return last.collect()[-1]


def _within(key: str, last: Row | None, keys: DataFrame, seed: int, step: str) -> Column:
    """Whether a row's (hash, key) is not beyond ``last``."""
    if last is None:
        return F.lit(True)
    own = F.struct(key_hash(key, seed, step).alias("h"), F.col(key).alias("k"))
    return own <= F.struct(F.lit(last.h).alias("h"), F.lit(last.k).cast(keys.schema[key].dataType).alias("k"))


def hash_cap(keys: DataFrame, key: str, max_keys: int, seed: int, step: str = "cap") -> DataFrame:
    """At most ``max_keys`` distinct keys, the ones with the smallest hash (ties by key): the same keys whatever the layout."""
    last = hash_cutoff(keys, key, max_keys, seed, step)
    return keys.select(key).filter(_within(key, last, keys, seed, step)).distinct()


def sample_predicate(
    keys: DataFrame, key: str, fraction: float, seed: int, max_keys: int | None = None, step: str = "rows"
) -> Column:
    """A row filter equal to "key is in ``hash_sample`` (then ``hash_cap``) of ``keys``".

    Used in place of a semi-join with the sampled key table: a filter is
    map-only, so a key that holds a large share of the rows never has to meet
    the key table in one join task.  The cap becomes a cutoff on (hash, key).
    """
    pred = in_sample(key, fraction, seed, step)
    if max_keys is not None:
        cap = f"{step}-cap"
        sampled = hash_sample(keys.select(key), key, fraction, seed, step)
        pred = pred & _within(key, hash_cutoff(sampled, key, max_keys, seed, cap), keys, seed, cap)
    return pred
