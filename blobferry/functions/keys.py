"""Scalar key, name and hash expressions (all JVM-side Column expressions).

Nothing here runs Python per row: each function returns a ``Column`` that
Catalyst folds into whole-stage codegen next to the scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Names that stored rows and objects already carry.
OBJECT_SUFFIX = ".pdf"  # suffix of the objects that are listed and loaded
OBJECT_NAME_PREFIX = "binder_"  # exported object name: binder_{policy id}.pdf
OBJECT_NAME_SUFFIX = ".pdf"
FLAG_COLUMN = "uploaded_to_s3"  # registry column marking exported rows
BODY_COLUMN = "BINDER_DOC"  # source column holding the document body


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- predicates

def has_suffix(key: ColumnOrName, suffix: str, case_sensitive: bool = True) -> Column:
    """Key ends with ``suffix`` (case-sensitive by default, like a name match)."""
    k = _c(key)
    if case_sensitive:
        return k.endswith(suffix)
    return F.lower(k).endswith(suffix.lower())


def has_prefix(key: ColumnOrName, prefix: str) -> Column:
    """Key starts with a string prefix (a text prefix, not a directory)."""
    return _c(key).startswith(prefix)


def non_empty_body(body: ColumnOrName) -> Column:
    """Body is present and has at least one byte."""
    b = _c(body)
    return b.isNotNull() & (F.octet_length(b) > 0)


def is_pending(flag: ColumnOrName = FLAG_COLUMN) -> Column:
    """Row not yet exported: the flag is false or null."""
    return ~F.coalesce(_c(flag), F.lit(False))


def is_safe_name(name: ColumnOrName) -> Column:
    """Relative name without ``..`` segments, usable below a target folder (and not its folder of metadata)."""
    n = _c(name)
    return (n.isNotNull() & (F.length(n) > 0) & ~n.startswith("/")
            & ~n.rlike(r"(^|/)\.\.(/|$)") & ~n.rlike(r"^[A-Za-z]:[\\/]") & ~n.rlike(r"^\.blobferry-meta(/|$)"))


# ------------------------------------------------------------ key derivation

def strip_text(name: ColumnOrName, text: str, leading_only: bool = False) -> Column:
    """Remove ``text`` from a name: every occurrence (default), or a leading one."""
    n = _c(name)
    if not text:
        return n
    if leading_only:
        return F.when(n.startswith(text), F.substring(n, len(text) + 1, 1 << 30)).otherwise(n)
    return F.replace(n, F.lit(text), F.lit(""))


def template_key(value: ColumnOrName, prefix: str = OBJECT_NAME_PREFIX,
                 suffix: str = OBJECT_NAME_SUFFIX) -> Column:
    """Object name from a template ``{prefix}{value}{suffix}``."""
    return F.concat(F.lit(prefix), _c(value).cast("string"), F.lit(suffix))


def join_key(prefix: str | ColumnOrName, name: ColumnOrName) -> Column:
    """``{prefix}/{name}``; a null prefix or name gives null."""
    p = F.lit(prefix) if isinstance(prefix, str) else _c(prefix)
    return F.concat(p, F.lit("/"), _c(name))


def split_uri(uri: ColumnOrName) -> tuple[Column, Column]:
    """Split ``scheme://bucket/prefix/...`` into (bucket, prefix)."""
    u = _c(uri)
    parts = F.split(u, "/")
    bucket = F.split_part(u, F.lit("/"), F.lit(3))
    rest = F.array_join(F.slice(parts, 4, F.greatest(F.size(parts) - 3, F.lit(0))), "/")
    return bucket, rest


def byte_length(body: ColumnOrName) -> Column:
    """Byte length of a binary or string column, as BIGINT."""
    return F.octet_length(_c(body)).cast("bigint")


def body_sha1(body: ColumnOrName) -> Column:
    """Hex SHA-1 of a body (strings hashed as UTF-8)."""
    return F.sha1(_c(body).cast("binary"))


def derived_guid(key: ColumnOrName) -> Column:
    """Repeatable GUID-shaped id from a key: md5 cut 8-4-4-4-12.

    A random ``uuid()`` changes from plan to plan; a load that is re-run (or a
    task that is retried) must produce the same id for the same key.
    """
    h = F.md5(_c(key).cast("binary"))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))


def random_guid() -> Column:
    """A random GUID per row (non-repeatable; only for one-shot loads)."""
    return F.expr("uuid()")


# ------------------------------------------------------------------- hashes

def record_hash(cols: Sequence[ColumnOrName]) -> Column:
    """SHA-1 of the columns' texts glued with no separator, nulls as ''.

    Kept for parity with the bookmark strategy's record hash. Note that
    ('1','23') and ('12','3') collide; prefer :func:`safe_record_hash`.
    """
    parts = [F.coalesce(_c(c).cast("string"), F.lit("")) for c in cols]
    return F.sha1(F.concat(*parts).cast("binary"))


def key_text(cols: Sequence[ColumnOrName], sep: str = "|") -> Column:
    """The key columns joined with ``sep`` (nulls skipped). Text, not a hash."""
    return F.concat_ws(sep, *[_c(c).cast("string") for c in cols])


def safe_record_hash(cols: Sequence[ColumnOrName]) -> Column:
    """Injective record hash: escaped values, a separator and a null mark."""
    parts = []
    for c in cols:
        s = _c(c).cast("string")
        esc = F.replace(F.replace(s, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|"))
        parts.append(F.coalesce(esc, F.lit("\\N")))
    return F.sha1(F.concat_ws("|", *parts).cast("binary"))


# ------------------------------------------------------------- projections

def apply_mapping(df: DataFrame, mapping: Iterable[tuple[str, str, str, str]]) -> DataFrame:
    """Select, cast and rename by a ``(source, source_type, target, target_type)``
    list; columns not listed are dropped. Source names match case-insensitively;
    each value is read as the source type, then cast to the target type."""
    mapping = list(mapping)
    have = {f.name.lower(): f for f in df.schema.fields}
    cols = []
    for src, src_type, dst, dst_type in mapping:
        field = have.get(src.lower())
        if field is None:
            raise ValueError(f"apply_mapping: no column {src!r} in {sorted(have)}")
        cols.append(F.col(field.name).cast(src_type).cast(dst_type).alias(dst))
    return df.select(*cols)


def with_key_text(df: DataFrame, keys: Sequence[str], name: str = "CALCULATED_HASH",
                  sep: str = "|") -> DataFrame:
    """Add the joined key text column (the composite strategy's 'hash')."""
    return df.withColumn(name, key_text(keys, sep))
