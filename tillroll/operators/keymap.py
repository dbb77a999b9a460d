"""Keys without collisions: a stored map from natural keys to surrogate keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.keys import KEY_SEPARATOR, surrogate_key
from tillroll.session import ensure_checkpoint_dir

PROBES = 64


def assign_keys(
    naturals: DataFrame,
    natural: str,
    known: DataFrame | None = None,
    hashed: Callable[[Column], Column] = surrogate_key,
    probes: int = PROBES,
) -> DataFrame:
    """(natural, key) of every distinct natural key, each with a key of its own.

    Those in ``known`` (an earlier map) keep their key.  The others get the hash
    of their text; where that is taken, or wanted by several (the least text
    has it), the rest try the hash of text and probe number.  Each probe is a
    join of what is still open, in practice none after the first.  Null natural
    keys have no key.
    """
    ensure_checkpoint_dir(naturals.sparkSession)
    text = F.col(natural).cast("string").alias("natural")
    wanted = naturals.select(text).where("natural IS NOT NULL").distinct()
    done = known.select("natural", "key") if known is not None else None
    left = wanted.join(done, "natural", "left_anti") if done is not None else wanted
    for probe in range(probes):
        tried = F.col("natural") if probe == 0 else F.concat_ws(KEY_SEPARATOR, "natural", F.lit(f"#{probe}"))
        # Kept, as the next probe reads what this one left.
        claims = left.select("natural", hashed(tried).alias("key")).checkpoint()
        free = claims.join(done.select("key"), "key", "left_anti") if done is not None else claims
        won = free.groupBy("key").agg(F.min("natural").alias("natural")).select("natural", "key").checkpoint()
        done = won if done is None else done.unionByName(won)
        left = claims.join(won, "natural", "left_anti").select("natural")
        if left.isEmpty():
            return done
    raise RuntimeError(f"keys still collide after {probes} probes: the hash is too short for so many")


def with_mapped_key(dim: DataFrame, keys: DataFrame, natural: str, key: str) -> DataFrame:
    """``dim`` with ``key`` taken from the map, columns in their order."""
    mapped = keys.select(F.col("natural").alias("_natural"), F.col("key").alias("_key"))
    joined = dim.join(mapped, F.col(natural).cast("string") == F.col("_natural"), "left")
    return joined.select(*[F.col("_key").alias(key) if c == key else F.col(c) for c in dim.columns])
