"""Named rules bound to columns; built-in rules and callers' own."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions import cleaning, validation


@dataclass(frozen=True)
class Rule:
    """A cleaner or a predicate on one or more columns.

    `apply` takes a Column and returns a Column, so it runs in generated code.
    """

    name: str
    columns: list[str]
    apply: Callable[[Column], Column]
    description: str = ""
    severity: str = "ERROR"
    enabled: bool = True


def python_rule(
    name: str,
    columns: list[str],
    function: Callable,
    returns: T.DataType | str = "string",
    **options,
) -> Rule:
    """Wrap a plain Python function of one value; it runs over Arrow batches."""

    @F.pandas_udf(returns)
    def batch(values):
        return values.map(lambda v: function(v))

    return Rule(name, columns, lambda c: batch(c), **options)


# The names of the rules, here and below.
CLEANING_RULES = [
    Rule("clean_invoice_no", ["InvoiceNo"], cleaning.clean_invoice_no),
    Rule("clean_stock_code", ["StockCode"], cleaning.clean_stock_code),
    Rule("clean_description", ["Description"], cleaning.clean_description),
    Rule("clean_quantity", ["Quantity"], cleaning.clean_quantity),
    Rule("clean_unit_price", ["UnitPrice"], cleaning.clean_unit_price),
    Rule("clean_customer_id", ["CustomerID"], cleaning.clean_customer_id),
    Rule("clean_country", ["Country"], cleaning.clean_country),
    Rule("clean_date", ["InvoiceDate"], cleaning.clean_date),
]


def validation_rules(as_of: str) -> list[Rule]:
    """Checks on cleaned columns, in the order they are tried."""
    return [
        Rule(
            "validate_required_fields_present",
            ["InvoiceNo", "StockCode", "CustomerID"],
            validation.present,
        ),
        Rule("validate_invoice_format", ["InvoiceNo"], validation.invoice_format_ok),
        Rule("validate_quantity_exists", ["Quantity"], validation.quantity_ok),
        Rule("validate_non_negative_price", ["UnitPrice"], validation.price_ok),
        Rule(
            "validate_date_range",
            ["InvoiceDate"],
            lambda c: validation.date_ok(c, as_of),
        ),
    ]


def apply_cleaning(df: DataFrame, rules: list[Rule] = CLEANING_RULES) -> DataFrame:
    """Run every enabled rule on the columns of its own that the frame has."""
    for rule in rules:
        if rule.enabled:
            present = [c for c in rule.columns if c in df.columns]
            df = df.withColumns({c: rule.apply(F.col(c)) for c in present})
    return df


def first_failure(rules: list[Rule]) -> Column:
    """Name of the first enabled ERROR rule a row fails; NULL for a valid row."""
    chain = F
    used = False
    for rule in rules:
        if rule.enabled and rule.severity == "ERROR":
            for name in rule.columns:
                chain = chain.when(~rule.apply(F.col(name)), F.lit(rule.name))
                used = True
    return chain.otherwise(F.lit(None).cast("string")) if used else F.lit(None).cast("string")


def warnings(rules: list[Rule]) -> Column:
    """Names of the failed rules of lower severity, which do not reject a row."""
    failed = [
        F.when(~rule.apply(F.col(name)), F.lit(rule.name))
        for rule in rules
        if rule.enabled and rule.severity != "ERROR"
        for name in rule.columns
    ]
    return F.array_compact(F.array(*failed)) if failed else F.array().cast("array<string>")


def rule_counts(df: DataFrame, rules: list[Rule] = CLEANING_RULES) -> DataFrame:
    """How often each rule was applied and how often it changed the text.

    One pass over the raw rows, then one output row per rule.
    """
    enabled = [r for r in rules if r.enabled and set(r.columns) & set(df.columns)]
    totals = [F.count(F.lit(1)).alias("rows")]
    for i, rule in enumerate(enabled):
        changed = F.lit(False)
        for name in rule.columns:
            if name in df.columns:
                cleaned = rule.apply(F.col(name)).cast("string")
                changed = changed | ~cleaned.eqNullSafe(F.col(name))
        totals.append(F.count_if(changed).alias(f"changed_{i}"))
    pairs = ", ".join(f"'{rule.name}', changed_{i}" for i, rule in enumerate(enabled))
    return (
        df.agg(*totals)
        .selectExpr("rows AS rows_applied", f"stack({len(enabled)}, {pairs}) AS (rule_name, rows_changed)")
        .select("rule_name", "rows_applied", "rows_changed")
    )
