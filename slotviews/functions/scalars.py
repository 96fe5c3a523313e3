"""Scalar expressions and the SQL functions that view texts may call."""

from __future__ import annotations

import logging
import re
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotviews.errors import SpecError


def operating_system(user_agent: Column) -> Column:
    """The text between the last ``(`` before the first ``)`` and that ``)``."""
    return F.substring_index(F.substring_index(user_agent, ")", 1), "(", -1)


def base_session(session: Column) -> Column:
    """A channel session id without its ``@@...`` suffix."""
    return F.substring_index(session, "@@", 1)


def client_of_account(account: Column) -> Column:
    return F.substring_index(account, "-", 1)


def hide_listed(column: Column, listed: Iterable[int]) -> Column:
    """-1 in place of listed values."""
    return F.when(column.isin(list(listed)), F.lit(-1)).otherwise(column)


def log_payload(line: Column, separator: str = " -") -> Column:
    """The part of a log line between its first and second separator, trimmed."""
    return F.trim(F.try_element_at(F.split(line, separator), F.lit(2)), F.lit(" \t\r\n"))


# texts in quotes and comments, or a call with a dotted column and a field's name
_NAME = r"(?:`[^`]*`|\w+)"
_FIELD_CALL = re.compile(
    r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`[^`]*`|--[^\n]*|/\*.*?\*/"""
    rf"|\b(?P<call>isFieldExists|getFieldValue)\s*\((?:\s*(?P<struct>{_NAME}(?:\s*\.\s*{_NAME})*)\s*,\s*'(?P<field>[^'\\`]*)'\s*\))?",
    re.IGNORECASE | re.DOTALL,
)


@contextmanager
def _quiet() -> Iterator[None]:
    """Keeps the error that answers a question out of the log."""
    logger = logging.getLogger("SQLQueryContextLogger")
    before, logger.disabled = logger.disabled, True
    try:
        yield
    finally:
        logger.disabled = before


def with_fields_resolved(text: str, analyse: Callable[[str], object]) -> str:
    """SQL text in which each isFieldExists and getFieldValue is a plain expression.

    Both ask about the type of a struct, so they are answered when the text is planned, not
    for each row: ``analyse`` plans a text, and says by Spark's own error whether a field is
    missing. ``isFieldExists(s, 'f')`` is whether ``s`` is not null, or false; ``getFieldValue``
    is the text of ``s.f``, or empty where the struct is null or the field is missing.
    """
    calls = [m for m in _FIELD_CALL.finditer(text) if m["call"]]
    for m in calls:
        if not m["struct"]:
            raise SpecError(f"{m['call']} takes a column and the name of a field in quotes: {text[m.start() : m.start() + 60]}")

    def filled(parts: list[str]) -> str:
        out, at = "", 0
        for m, part in zip(calls, parts, strict=True):
            out, at = out + text[at : m.start()] + part, m.end()
        return out + text[at:]

    tests = [m["call"].lower() == "isfieldexists" for m in calls]
    answers = [f"CAST(NULL AS {'BOOLEAN' if test else 'STRING'})" for test in tests]
    for i, (m, test) in enumerate(zip(calls, tests, strict=True)):
        struct, field = m["struct"], f"{m['struct']}.`{m['field']}`"
        parts = list(answers)
        parts[i] = f"({struct} IS NOT NULL AND ({field} IS NULL OR true))" if test else f"CAST({field} AS STRING)"
        try:
            with _quiet():
                analyse(filled(parts))
            answers[i] = f"({struct} IS NOT NULL)" if test else f"(CASE WHEN {struct} IS NOT NULL THEN CAST({field} AS STRING) ELSE '' END)"
        except AnalysisException as error:
            if error.getCondition() != "FIELD_NOT_FOUND":
                raise
            answers[i] = "false" if test else "''"
    return filled(answers)


def view_sql(spark: SparkSession, text: str) -> DataFrame:
    """``spark.sql`` for texts that may call isFieldExists and getFieldValue."""
    return spark.sql(with_fields_resolved(text, spark.sql))


def _text_literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register_functions(spark: SparkSession, key: str) -> None:
    """Makes encrypt and decrypt callable from SQL; Catalyst inlines them.

    isFieldExists and getFieldValue take a struct of any type, which a SQL function cannot
    declare: texts that call them go through ``view_sql``.
    """
    secret = _text_literal(key)
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION encrypt(plain STRING) RETURNS STRING "
        f"RETURN translate(base64(aes_encrypt(plain, {secret})), chr(13) || chr(10), '')"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION decrypt(cipher STRING) RETURNS STRING "
        f"RETURN CAST(aes_decrypt(unbase64(cipher), {secret}) AS STRING)"
    )
