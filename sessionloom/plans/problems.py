"""Queries p1 and p2: the general training-data operators on the project's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sessionloom.operators.copydiff import diff_copies, without_item_number
from sessionloom.operators.multivalue import explode_values
from sessionloom.session import table

ANSWERS = ["answer_1", "answer_2", "answer_3", "answer_4"]
COPIES = {"exact_sonnet_style": ["category", "question", *ANSWERS], "quantitative_interview_table": ["question", *ANSWERS]}


def p1_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every difference of both copies from the base, with the canonical values of both sides."""
    return diff_copies(
        table(spark, sf_dir, "human_readable_matrix"),
        {name: table(spark, sf_dir, name) for name in COPIES},
        ["matrix_no", "metric_code"],
        COPIES,
        "exported_at",
        {("quantitative_interview_table", "question"): without_item_number},
    )


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The differences as cases."""
    return p1_differences(spark, sf_dir).select("copy_name", "matrix_no", "metric_code", "field_name", "diff_kind")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per value of allowed_values and extraction_keywords."""
    return explode_values(table(spark, sf_dir, "metric_encodings"), "encoding_id", ["allowed_values", "extraction_keywords"])


QUERIES = {"p1_found": p1_found, "p1_differences": p1_differences, "p2_found": p2_found}

def _canon(column: str) -> str:
    """SQL of a value's one spelling: trimmed, numbers in plain decimal form, missing ones NULL."""
    text = rf"regexp_replace({column}, '^[\s\pZ\x{{85}}]+|[\s\pZ\x{{85}}]+$', '', 'g')"
    number = rf"regexp_replace(regexp_replace(regexp_replace(regexp_replace({text}, '[,+]', '', 'g'), '^(-?)0+(\d)', '\1\2'), '(\.\d*?)0+$', '\1'), '\.$', '')"
    spelled = rf"CASE WHEN regexp_full_match({text}, '[+-]?(\d{{1,3}}(,\d{{3}})+|\d+)(\.\d*)?') THEN CASE {number} WHEN '-0' THEN '0' ELSE {number} END ELSE {text} END"
    return f"nullif(nullif(nullif({spelled}, ''), '-1'), 'Not reported')"


def _p1_sql() -> str:
    every = list(dict.fromkeys(f for fields in COPIES.values() for f in fields))

    def version(name: str, fields: list[str], item_number: bool) -> str:
        columns = ", ".join(_canon(r"regexp_replace(question, '^[\s\pZ]*\(?\d+[.)]+', '')" if item_number and f == "question" else f) + f" AS v_{f}" for f in every if f in fields)
        order = ", ".join(f"v_{f} DESC NULLS LAST" for f in every if f in fields)
        return f"(SELECT * FROM (SELECT matrix_no, metric_code, exported_at, {columns} FROM {name}) QUALIFY row_number() OVER (PARTITION BY matrix_no, metric_code ORDER BY exported_at DESC NULLS LAST, {order}) = 1)"

    parts = []
    for name, fields in COPIES.items():
        base, copy = version("human_readable_matrix", every, False), version(name, fields, name.startswith("quantitative"))
        join = "b.matrix_no IS NOT DISTINCT FROM c.matrix_no AND b.metric_code IS NOT DISTINCT FROM c.metric_code"
        lead = f"SELECT '{name}' AS copy_name, {{0}}.matrix_no, {{0}}.metric_code"
        parts.append(f"{lead.format('b')}, '*' AS field_name, 'missing_in_copy' AS diff_kind, NULL AS base_value, NULL AS copy_value FROM {base} b ANTI JOIN {copy} c ON {join}")
        parts.append(f"{lead.format('c')}, '*', 'missing_in_base', NULL, NULL FROM {copy} c ANTI JOIN {base} b ON {join}")
        parts += [f"{lead.format('b')}, '{f}', 'changed', b.v_{f}, c.v_{f} FROM {base} b JOIN {copy} c ON {join} WHERE b.v_{f} IS DISTINCT FROM c.v_{f}" for f in fields]
    return "\nUNION ALL ".join(parts)


ORACLE = {"p1_differences": _p1_sql(), "p1_found": f"SELECT copy_name, matrix_no, metric_code, field_name, diff_kind FROM ({_p1_sql()})"}
