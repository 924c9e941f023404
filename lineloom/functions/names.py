"""Qualified names, short names and stable ids, all as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the suffix a glossary term carries in its qualified name.
GLOSSARY_SUFFIX = "@Glossary"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def table_key(database: Column | str, table: Column | str, *, domain: str, scheme: str = "cat") -> Column:
    """``scheme://domain/database/table``"""
    return F.concat(F.lit(f"{scheme}://{domain}/"), _col(database), F.lit("/"), _col(table))


def column_key(
    database: Column | str, table: Column | str, column: Column | str, *, domain: str, scheme: str = "cat"
) -> Column:
    """``scheme://domain/database/table#column``"""
    return F.concat(table_key(database, table, domain=domain, scheme=scheme), F.lit("#"), _col(column))


def job_key(path: Column | str, *, domain: str, scheme: str = "cat") -> Column:
    """``scheme://domain/notebooks/path``.

    The whole path, so that two scripts of the same name in different folders
    stay two jobs.
    """
    return F.concat(F.lit(f"{scheme}://{domain}/notebooks/"), F.ltrim(_col(path), F.lit("/")))


def term_key(term: Column | str) -> Column:
    """``term@Glossary``"""
    return F.concat(_col(term), F.lit(GLOSSARY_SUFFIX))


def last_segment(path: Column | str) -> Column:
    """Text after the last slash."""
    return F.element_at(F.split(_col(path), "/"), -1)


def short_name(qualified_name: Column | str) -> Column:
    """Lower-cased text after the last slash, the form names are searched in."""
    return F.lower(last_segment(qualified_name))


def is_csv_name(name: Column | str, word: str = "csv") -> Column:
    """True if the word stands anywhere after the first character (case kept)."""
    return F.instr(_col(name), word) > 1


def name_part(name: Column | str, index: int) -> Column:
    """Dot-separated part of a name, NULL where there is none."""
    return F.get(F.split(_col(name), r"\."), F.lit(index))


def entity_guid(type_name: Column | str, qualified_name: Column | str) -> Column:
    """Id that depends on type and key alone, so a retried task gives it again."""
    return F.sha2(F.concat_ws("|", _col(type_name), _col(qualified_name)), 256)
