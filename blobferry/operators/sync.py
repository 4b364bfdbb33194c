"""Set and join operators that keep objects and tables in step.

All joins are on keys and sizes only; bodies are attached last, after the
plan has decided which rows move. Right-hand key sides are de-duplicated
before the join: ``distinct`` is a partial (map-side) aggregate, so a key
that holds a third of all rows collapses to one row per map task before the
shuffle, and its output partitioning is reused by the join (no extra
exchange). AQE then picks broadcast only when the measured side is under
``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blobferry.functions import keys as K


def _keys(df: DataFrame, key: str, as_name: str = "key") -> DataFrame:
    return df.select(F.col(key).alias(as_name))


def distinct_keys(df: DataFrame, key: str = "key") -> DataFrame:
    """Distinct non-null keys (a set)."""
    return _keys(df, key).where(F.col("key").isNotNull()).distinct()


def new_objects(listing: DataFrame, existing: DataFrame, key: str = "key",
                existing_key: str = "key") -> DataFrame:
    """Listed objects whose key is not in ``existing`` (bag: duplicates stay)."""
    right = distinct_keys(existing, existing_key).withColumnRenamed("key", key)
    return listing.join(right, key, "left_anti")


def new_objects_by_probe(listing: DataFrame, existing: DataFrame, key: str = "key",
                         existing_key: str = "key", n_listing: int | None = None) -> DataFrame:
    """:func:`new_objects` for a listing small enough to broadcast (a stream's
    micro-batch, a small new arrival): the listing's keys are broadcast and the
    existing keys are scanned once against them - no shuffle of the (large)
    existing side. The listing is counted (unless ``n_listing`` is given);
    above ``BROADCAST_MAX_ROWS`` this falls back to :func:`new_objects`."""
    n = listing.count() if n_listing is None else n_listing
    if n > BROADCAST_MAX_ROWS:
        return new_objects(listing, existing, key, existing_key)
    probe = F.broadcast(listing.select(F.col(key).alias("_k")).where(F.col("_k").isNotNull()).distinct())
    present = (existing.select(F.col(existing_key).alias("_k"))
               .join(probe, "_k", "left_semi").distinct())
    # present holds at most the listing's keys: within the same bound.
    return listing.join(F.broadcast(present), listing[key] == present["_k"], "left_anti")


def orphans(existing: DataFrame, listing: DataFrame, key: str = "key",
            listing_key: str = "key") -> DataFrame:
    """Registry keys that no longer exist in the listing (a set)."""
    left = distinct_keys(existing, key)
    right = distinct_keys(listing, listing_key)
    return left.join(right, "key", "left_anti")


def accumulate(listings: Sequence[DataFrame], as_set: bool = False) -> DataFrame:
    """Union of listing pages or shards by column name; ``as_set`` drops repeats."""
    out = listings[0]
    for more in listings[1:]:
        out = out.unionByName(more)
    return out.distinct() if as_set else out


def pick(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is in ``keys`` (semi-join; ``IN`` list)."""
    on = [on] if isinstance(on, str) else list(on)
    return df.join(keys.select(*on).distinct(), on, "left_semi")


def drop_keys(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is not in ``keys`` (anti-join, null-safe unlike NOT IN)."""
    on = [on] if isinstance(on, str) else list(on)
    return df.join(keys.select(*on).distinct(), on, "left_anti")


SKIP, NEW, CHANGED, NONE = "skip", "upload_new", "upload_changed", "none"


def size_plan(src: DataFrame, target: DataFrame, key: str = "key", size: str = "size",
              target_size: str = "size", compare_sha1: str | None = None) -> DataFrame:
    """Decide per source row: ``skip`` (target has equal size), ``upload_new``
    (no target), ``upload_changed`` (size differs).

    ``target`` is an object listing; a key listed twice counts once.
    With ``compare_sha1`` naming a sha1 column present on both sides, equal
    size is not enough: content must hash equal too.
    """
    facts = [F.col(target_size).alias("target_size")]
    if compare_sha1:
        facts.append(F.col(compare_sha1).alias("target_sha1"))
    # One row per key even if listings overlap (a deterministic pick); the
    # aggregate is hash-partitioned on the key, which the join then reuses.
    t = (target.groupBy(key).agg(F.max(F.struct(*facts)).alias("_t"))
         .select(key, *[F.col(f"_t.{c}") for c in (["target_size", "target_sha1"] if compare_sha1
                                                  else ["target_size"])]))
    j = src.join(t, key, "left")
    same = F.col(size) == F.col("target_size")
    if compare_sha1:
        same = same & (F.col(compare_sha1) == F.col("target_sha1"))
    action = (F.when(F.col("target_size").isNull(), F.lit(NEW))
              .when(same, F.lit(SKIP)).otherwise(F.lit(CHANGED)))
    return j.withColumn("action", action)


def reconcile(src: DataFrame, own: DataFrame | None, live: DataFrame) -> DataFrame:
    """Three-way comparison of what should be in the target, what we wrote there, and what is there.

    ``src`` (``key, size, sha1``, more columns are kept) holds one row per key, ``own`` our latest
    successful write of a key (``key, size, sha1``), ``live`` the listing (``key, size``, and ``sha1`` where
    a body was hashed). One row per key of any side, with ``target_size``, ``state`` and ``action``:

    * ``absent``: not in the target and never written; ``removed``: written, but gone. Both: ``upload_new``.
    * ``unknown``: there, but not written by us; ``replaced``: not what we wrote (another size or hash);
      ``changed``: ours, with content the source no longer has. All: ``upload_changed``.
    * ``same``: ``skip``. So is an ``unknown`` or ``replaced`` object whose own hash is the source's.
    * ``stray`` (there, not in the source) and ``forgotten`` (only written once): ``none``.

    An object of the size we wrote, without a hash of its own, is taken for what we wrote. The outer
    join of the three is an aggregate of their union: one shuffle of keys, sizes and hashes, combined map-side,
    whatever a side repeats.
    """
    fact = "struct<size:bigint,sha1:string>"

    def side(df: DataFrame) -> Column:
        sha1 = F.col("sha1") if "sha1" in df.columns else F.lit(None)
        return F.struct(F.col("size").cast("bigint").alias("size"), sha1.cast("string").alias("sha1"))

    extra = [c for c in src.columns if c not in ("key", "size", "sha1")]
    row = F.struct(F.col("size").cast("bigint").alias("size"), F.col("sha1").cast("string").alias("sha1"),
                   *[F.col(c) for c in extra])
    wanted = src.select("key", row.alias("_src"))
    row_type = wanted.schema["_src"].dataType
    parts = [wanted.select("key", "_src", F.lit(None).cast(fact).alias("_own"), F.lit(None).cast(fact).alias("_live"))]
    if own is not None:
        parts.append(own.select("key", F.lit(None).cast(row_type).alias("_src"), side(own).alias("_own"),
                                F.lit(None).cast(fact).alias("_live")))
    parts.append(live.select("key", F.lit(None).cast(row_type).alias("_src"), F.lit(None).cast(fact).alias("_own"),
                             side(live).alias("_live")))
    j = accumulate(parts).groupBy("key").agg(*[F.max(c).alias(c) for c in ("_src", "_own", "_live")])
    in_src, in_own, in_live = (F.col(c).isNotNull() for c in ("_src", "_own", "_live"))
    same_size = F.col("_live.size") == F.col("_own.size")
    # The hash of what is there: its own, or that of our write of the same size.
    held = F.coalesce(F.col("_live.sha1"), F.when(same_size, F.col("_own.sha1")))
    as_written = same_size & F.coalesce(F.col("_live.sha1") == F.col("_own.sha1"), F.lit(True))
    equal = F.coalesce((F.col("_live.size") == F.col("_src.size")) & (held == F.col("_src.sha1")), F.lit(False))
    state = (F.when(~in_src, F.when(in_live, "stray").otherwise("forgotten"))
             .when(~in_live, F.when(in_own, "removed").otherwise("absent"))
             .when(~in_own, "unknown")
             .when(~F.coalesce(as_written, F.lit(False)), "replaced")
             .when(equal, "same").otherwise("changed"))
    action = F.when(~in_src, NONE).when(~in_live, NEW).when(equal, SKIP).otherwise(CHANGED)
    return j.select("key", *[F.col(f"_src.{c}").alias(c) for c in ("size", "sha1", *extra)],
                    F.col("_live.size").alias("target_size"), state.alias("state"), action.alias("action"))


def latest_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[str],
                   payload: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the one with the greatest ``order`` tuple.

    Written as ``max(struct(order..., payload))`` per key rather than a
    ``row_number`` window: the aggregate combines map-side, so a key holding a
    third of all rows is reduced in every map task before the shuffle and no
    single task ever holds the whole group. Nulls in ``order`` sort lowest.
    Keep bodies out of ``payload``; join them back on a unique id.
    """
    key = [key] if isinstance(key, str) else list(key)
    order = list(order)
    if payload is None:
        payload = [c for c in df.columns if c not in key and c not in order]
    packed = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in payload])
    best = df.groupBy(*key).agg(F.max(packed).alias("_best"))
    return best.select(*key, *[F.col(f"_best.{c}").alias(c) for c in order + list(payload)])


def with_flag_from(registry: DataFrame, ok_keys: DataFrame, key: str = "guid",
                   flag: str = K.FLAG_COLUMN) -> DataFrame:
    """Registry with ``flag`` set where ``key`` is in ``ok_keys`` (keyed update
    expressed as a join, since files take no UPDATE)."""
    marks = ok_keys.select(key).distinct().withColumn("_ok", F.lit(True))
    j = registry.join(marks, key, "left")
    cols = [(F.coalesce(F.col(flag), F.lit(False)) | F.coalesce(F.col("_ok"), F.lit(False))).alias(flag)
            if c == flag else F.col(c) for c in registry.columns]
    return j.select(*cols)


def mass_delete_guard(n_existing: int, n_orphans: int, n_listed: int, max_share: float,
                      allow_mass_delete: bool) -> None:
    """Refuse a delete when the listing is empty or the orphan share is too high."""
    if allow_mass_delete:
        return
    if n_listed == 0 and n_existing > 0:
        raise RuntimeError("listing is empty while the registry is not; refusing to delete "
                           "every row (pass allow_mass_delete=True to force)")
    if n_existing and n_orphans / n_existing > max_share:
        raise RuntimeError(f"{n_orphans} of {n_existing} rows would be deleted "
                           f"(share above {max_share}); pass allow_mass_delete=True to force")


# Largest key-side frame we broadcast: a counted, materialized bound.
BROADCAST_MAX_ROWS = 500_000


def checked_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> tuple[DataFrame, int]:
    """``broadcast(df)`` if it holds at most ``max_rows`` rows, else ``df``.

    Counts the rows (cheap when ``df`` is materialized or small), so the
    broadcast side has a proven size, not an estimate.
    """
    n = df.count()
    return (F.broadcast(df) if n <= max_rows else df), n
