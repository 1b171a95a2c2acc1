"""Scalar functions of the extraction, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def constituency_suffix(name: Column | str) -> Column:
    """What stands behind the last slash."""
    return F.element_at(F.split(name, "/"), -1)


def page_argument(page: Column | str) -> Column:
    return F.concat(F.lit("Page$"), F.col(page).cast("string") if isinstance(page, str) else page.cast("string"))


def page_count(text: Column | str, strict: bool = True) -> Column:
    """The number that a pager's last cell shows. strict raises for anything else, else it is null."""
    text = F.trim(F.col(text) if isinstance(text, str) else text)
    return text.cast("int") if strict else text.try_cast("int")


def first_of(values: Column | str, strict: bool = True) -> Column:
    """The first of several matches. strict raises where there is none."""
    return F.element_at(values, 1) if strict else F.get(values, 0)


def present(values: Column | str) -> Column:
    return F.size(values) > 0


def require(value: Column, what: str) -> Column:
    """value, or an error that names what is missing."""
    return F.when(value.isNotNull(), value).otherwise(F.raise_error(F.lit(f"missing {what}")))


def markup_decoded(text: Column) -> Column:
    """Text of a page with the three references of markup signs decoded; all others, and those that are cut short, stay as they stand."""
    for code, sign in (("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        text = F.replace(text, F.lit(code), F.lit(sign))
    return text
