"""Logins, repository names and storage keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a login that matches anywhere belongs to a bot.
BOT_PATTERN = r"(?i)(-bot|[._]bot|bot[._]|^bot-|^bot$|\[bot\]$)"


def _as_column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def is_bot(login: str | Column) -> Column:
    """Bot flag of a login, false for a missing login."""
    return F.coalesce(_as_column(login).rlike(BOT_PATTERN), F.lit(False))


def has_owner(repo_name: str | Column) -> Column:
    return _as_column(repo_name).contains("/")


def owner_of(repo_name: str | Column) -> Column:
    """Part before the slash, NULL for a name without one."""
    name = _as_column(repo_name)
    return F.when(has_owner(name), F.split_part(name, F.lit("/"), F.lit(1)))


def short_name_of(repo_name: str | Column) -> Column:
    """Part after the slash, the whole name when there is none."""
    name = _as_column(repo_name)
    return F.when(has_owner(name), F.split_part(name, F.lit("/"), F.lit(2))).otherwise(name)


def object_key(path: str | Column, base: str, prefix: str = "") -> Column:
    """Storage key of a file: its path below `base`, with `prefix` in front."""
    clean = F.regexp_replace(_as_column(path), r"\\", "/")
    base = base.rstrip("/") + "/"
    relative = F.when(clean.startswith(base), F.substr(clean, F.lit(len(base) + 1))).otherwise(clean)
    return F.concat(F.lit(prefix.rstrip("/") + "/"), relative) if prefix else relative


def plain_path(path: str | Column) -> Column:
    """One spelling for local paths, which readers give with one or three slashes."""
    return F.regexp_replace(_as_column(path), "^file:/+", "file:/")
