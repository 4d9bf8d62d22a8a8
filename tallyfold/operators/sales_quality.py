"""Checks of sales CSV lines: ``path, line, value`` in, a checked table out."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyfold import schemas as S
from tallyfold.functions import strict
from tallyfold.functions.once import once
from tallyfold.operators.verdict import REJECT, SKIP, VALID, is_reject, is_valid
from tallyfold.session import join_small, settle

FIELDS = ("date", "product", "category", "unit_price", "quantity", "discount")

# A field without quotes or one in quotes with inner quotes doubled, and a
# record of such fields; the comma outside quotes that separates them.
_FIELD = r'(?:"(?:[^"]|"")*"|[^",]*)'
_RECORD = rf"\A{_FIELD}(?:,{_FIELD})*\z"
_SEPARATOR = r',(?=(?:[^"]*"[^"]*")*[^"]*\z)'


def _unquote(field: str) -> str:
    inner = f"replace(substring({field}, 2, length({field}) - 2), '\"\"', '\"')"
    return f"CASE WHEN {field} LIKE '\"%\"' THEN {inner} ELSE {field} END"


def repair_quotes(product: str) -> str:
    """Quotes around the product are dropped, inner ones kept."""
    return f"trim(BOTH '\"' FROM {product})"


def header_ok(value: str) -> str:
    """The first line names the six columns, each possibly in quotes."""
    in_quotes = f"contains({value}, '\"') AND {value} RLIKE r'{_RECORD}' AND NOT contains({value}, '\"\"')"
    return f"({value} = '{S.SALES_HEADER}' OR ({in_quotes} AND replace({value}, '\"', '') = '{S.SALES_HEADER}'))"


def split_fields(lines: DataFrame) -> DataFrame:
    """``path, line, value, has_quote, product, stray_quote, parts``.

    The ``\\r`` of a ``\\r\\n`` line end is dropped. Lines without a quote are
    cut at every comma. Otherwise the product, the second of at least six
    pieces, is taken out first, since it may hold stray quotes; the rest must
    be a well-formed record. A product torn apart by a comma inside its quotes
    leaves the line with too many pieces.
    """
    n = len(FIELDS)
    content = lines.selectExpr(
        "path", "line", "CASE WHEN endswith(value, '\r') THEN left(value, length(value) - 1) ELSE value END AS value"
    )
    cut = once(
        content, ["path", "line", "value"], has_quote="contains(value, '\"')", pieces="split(value, ',', -1)"
    )
    torn = f"size(pieces) > {n} AND startswith(get(pieces, 1), '\"') AND NOT endswith(get(pieces, 1), '\"')"
    rest = r"regexp_replace(value, r'\A([^,]*),[^,]*,((?:[^,]*,){3})', '$1,,$2')"
    cut = once(
        cut, ["path", "line", "value", "has_quote", "pieces"],
        record=f"CASE WHEN NOT has_quote OR ({torn}) THEN '' WHEN size(pieces) >= {n} THEN {rest} ELSE value END",
    )
    formed = f"record RLIKE r'{_RECORD}'"
    return once(
        cut, ["path", "line", "value", "has_quote"],
        product=repair_quotes("get(pieces, 1)"),
        stray_quote=f"contains(record, '\"') AND NOT {formed}",
        parts=f"CASE WHEN contains(record, '\"') AND {formed} THEN split(record, r'{_SEPARATOR}', -1) ELSE pieces END",
    )


def raw_fields(lines: DataFrame) -> DataFrame:
    """Data lines cut into six text fields (NULL where the count is not six)."""
    cut = split_fields(lines).selectExpr("*", f"size(parts) = {len(FIELDS)} AS six")
    columns = {}
    for i, name in enumerate(FIELDS):
        part = f"get(parts, {i})"
        field = "product" if name == "product" else f"CASE WHEN has_quote THEN {_unquote(part)} ELSE {part} END"
        columns[f"raw_{name}"] = f"CASE WHEN six THEN {field} END"
    return once(cut, ["path", "line", "value", "six", "stray_quote"], **columns)


def check_sales(lines: DataFrame) -> DataFrame:
    """Every line with its verdict, first error and, if valid, typed columns.

    One pass over the lines: nothing is shuffled.
    """
    typed = once(
        raw_fields(lines).withColumnsRenamed({"raw_product": "product", "raw_category": "category"}),
        ["path", "line", "value", "six", "stray_quote", "product", "category"],
        date=strict.to_date("raw_date"),
        unit_price=strict.to_double("raw_unit_price"),
        quantity=strict.to_integer("raw_quantity"),
        discount_pct=strict.to_double("raw_discount"),
    )
    # Fixed order: the first check that fails names the error.
    error = f"""CASE
        WHEN line = 1 THEN CASE WHEN NOT {header_ok("value")} THEN '{S.ERR_HEADER}' END
        WHEN stray_quote THEN '{S.ERR_QUOTE}'
        WHEN NOT six THEN '{S.ERR_COLUMNS}'
        WHEN date IS NULL THEN '{S.ERR_DATE}'
        WHEN unit_price IS NULL THEN '{S.ERR_PRICE}'
        WHEN quantity IS NULL THEN '{S.ERR_QUANTITY}'
        WHEN discount_pct IS NULL THEN '{S.ERR_DISCOUNT}'
        WHEN unit_price <= 0 THEN '{S.ERR_PRICE_SIGN}'
        WHEN quantity <= 0 THEN '{S.ERR_QUANTITY_SIGN}'
        WHEN NOT discount_pct BETWEEN 0 AND 100 THEN '{S.ERR_DISCOUNT_RANGE}' END"""
    judged = typed.selectExpr("*", f"{error} AS error").selectExpr(
        "*", f"CASE WHEN error IS NOT NULL THEN '{REJECT}' WHEN line = 1 THEN '{SKIP}' ELSE '{VALID}' END AS verdict"
    )
    kept = ("date", "product", "category", "unit_price", "quantity", "discount_pct")
    return judged.selectExpr(
        "path", "line", "verdict", "error",
        f"coalesce(error IN ('{S.ERR_HEADER}', '{S.ERR_QUOTE}'), false) AS fatal",
        *[f"CASE WHEN verdict = '{VALID}' THEN {c} END AS {c}" for c in kept],
    ).transform(add_amounts)


def add_amounts(rows: DataFrame) -> DataFrame:
    return rows.selectExpr(
        "*", "unit_price * quantity AS gross", "unit_price * quantity * (1 - discount_pct / 100) AS net"
    )


def failed_files(lines: DataFrame) -> DataFrame:
    """``path, quote``: files that fail as a whole, by a stray quote or by their header.

    Only the first line and lines with a quote can do that, so only those are
    checked.
    """
    suspects = lines.where("line = 1 OR contains(value, '\"')")
    return check_sales(suspects).where("fatal").groupBy("path").agg(
        F.bool_or(F.col("error") == S.ERR_QUOTE).alias("quote")
    )


def valid_sales(lines: DataFrame) -> DataFrame:
    """The valid rows of files that do not fail as a whole."""
    rows = check_sales(lines).where(is_valid()).drop("verdict", "error", "fatal")
    return join_small(rows, failed_files(lines).select("path"), "path", "left_anti")


def sales_rejects(lines: DataFrame) -> DataFrame:
    """``path, line, error``; a file that fails as a whole has one row.

    A bad header is reported at line 1, a stray quote for the file (line NULL).
    """
    failed = settle(failed_files(lines))
    per_file = failed.selectExpr(
        "path", "CASE WHEN NOT quote THEN 1L END AS line",
        f"CASE WHEN quote THEN '{S.ERR_QUOTE}' ELSE '{S.ERR_HEADER}' END AS error",
    )
    rows = check_sales(lines).where(is_reject() & ~F.col("fatal")).selectExpr(
        "path", "CAST(line AS BIGINT) AS line", "error"
    )
    return join_small(rows, failed.select("path"), "path", "left_anti").unionByName(per_file)


def empty_files(files: DataFrame) -> DataFrame:
    """CSV files of the manifest (``path, bytes``) without any content: one reject each."""
    return files.where("bytes = 0 AND endswith(path, '.csv')").select(
        "path", F.lit(1).cast("bigint").alias("line"), F.lit(S.ERR_EMPTY_CSV).alias("error")
    )
