"""Rule-based validation: split a frame into valid rows and a quarantine.

A rule is a named boolean ``Column``. A row is valid when every rule holds.
The combined predicate is made total with ``coalesce(..., false)``: a rule
that evaluates to NULL sends the row to quarantine instead of dropping it
from both sides, so ``valid + invalid == input`` always holds. An empty rule
list accepts every row.

The split is two filters over the same lazy input. The valid side filters
on the plain conjunction (a NULL drops the row there just as ``false``
does), so Catalyst splits it and pushes the null tests and comparisons into
the Parquet scan; only the quarantine side needs the total form.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Rule:
    rule_id: str
    check: Column


def _conjunction(rules: Sequence[Rule]) -> Column:
    if not rules:
        return F.lit(True)
    return functools.reduce(lambda a, b: a & b, [r.check for r in rules])


def all_rules_hold(rules: Sequence[Rule]) -> Column:
    """Total conjunction of the rules (NULL counts as failing)."""
    return F.coalesce(_conjunction(rules), F.lit(False))


def validate_and_split(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Return ``(valid, invalid)``; both keep the input's columns."""
    return df.filter(_conjunction(rules)), df.filter(~all_rules_hold(rules))


def flag_valid(df: DataFrame, rules: Sequence[Rule], name: str = "is_valid") -> DataFrame:
    """The input with one boolean column telling whether all rules hold."""
    return df.withColumn(name, all_rules_hold(rules))


def failed_rules(df: DataFrame, rules: Sequence[Rule], name: str = "failed_rules") -> DataFrame:
    """Add an array of the ids of the rules each row fails (empty when valid)."""
    if not rules:
        return df.withColumn(name, F.array().cast("array<string>"))
    ids = [F.when(~F.coalesce(r.check, F.lit(False)), F.lit(r.rule_id)) for r in rules]
    return df.withColumn(name, F.filter(F.array(*ids), lambda x: x.isNotNull()))


def split_counts(named: dict[str, tuple[DataFrame, Sequence[Rule]]]) -> DataFrame:
    """``(dataset, is_valid, n)`` over several datasets in one job.

    Each input contributes only its validity flag, so the scan prunes every
    column the rules do not read; counts are partial-aggregated per task.
    """
    parts = [
        flag_valid(df, rules).select(F.lit(name).alias("dataset"), "is_valid")
        for name, (df, rules) in named.items()
    ]
    union = functools.reduce(DataFrame.unionByName, parts)
    return union.groupBy("dataset", "is_valid").agg(F.count(F.lit(1)).alias("n"))


@dataclass(frozen=True)
class SplitWrite:
    """Both sides of a split as written, and what was counted on the way."""

    valid: DataFrame
    invalid: DataFrame
    rows: int
    failed: dict[str, int]  # by rule; a row may fail several
    n_invalid: int


def write_split(df: DataFrame, rules: Sequence[Rule], path: str, name: str = "split") -> SplitWrite:
    """Write both sides in one job, one folder each, and count every rule's
    failures in that job (``DataFrame.observe``): the input is read once.

    The metrics are taken in the writing tasks, above any shuffle of the input,
    so a task that is run again is counted once.
    """
    ids = [r.rule_id for r in rules]
    if len(set(ids)) != len(ids):
        raise ValueError("rule ids must differ")
    side = "_valid"
    observation = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows"), F.count_if(~F.col(side)).alias("invalid")]
    metrics += [F.count_if(~F.coalesce(r.check, F.lit(False))).alias(f"rule {r.rule_id}") for r in rules]
    flagged = flag_valid(df, rules, side).observe(observation, *metrics)
    flagged.write.mode("overwrite").partitionBy(side).parquet(path)
    counted = observation.get
    back = df.sparkSession.read.schema(T.StructType([*df.schema.fields, T.StructField(side, T.BooleanType())])).parquet(path)
    return SplitWrite(
        back.filter(F.col(side)).drop(side),
        back.filter(~F.col(side)).drop(side),
        counted["rows"],
        {r: counted[f"rule {r}"] for r in ids},
        counted["invalid"],
    )


def rule_counts(splits: dict[str, SplitWrite], spark: SparkSession) -> DataFrame:
    """``(dataset, rule_id, n_failed)`` of written splits; the driver holds a
    number for each rule."""
    rows = [(name, rule, n) for name, split in splits.items() for rule, n in split.failed.items()]
    return spark.createDataFrame(rows, "dataset string, rule_id string, n_failed bigint")


# ---------------------------------------------------------------------------
# Rule sets of the three datasets.

# Product codes that are not products (compared upper-cased).
EXCLUDED_STOCK_CODES = ["POST", "POSTAGE", "M", "D", "BANK CHARGES"]

# Description fragments of non-product lines (compared lower-cased).
EXCLUDED_DESCRIPTION_FRAGMENTS = ["bad debt", "adjust", "dotcom postage", "amazon fee"]


def _present(name: str) -> list[Rule]:
    c = F.col(name)
    return [Rule(f"{name}_not_null", c.isNotNull()), Rule(f"{name}_not_empty", c != "")]


def product_rules() -> list[Rule]:
    code, desc, price = F.col("StockCode"), F.col("Description"), F.col("UnitPrice")
    rules = _present("StockCode")
    rules.append(Rule("StockCode_is_product", ~F.upper(code).isin(EXCLUDED_STOCK_CODES)))
    rules += _present("Description")
    for fragment in EXCLUDED_DESCRIPTION_FRAGMENTS:
        rules.append(
            Rule(f"Description_not_{fragment.replace(' ', '_')}", ~F.lower(desc).contains(fragment))
        )
    rules.append(Rule("UnitPrice_not_null", price.isNotNull()))
    rules.append(Rule("UnitPrice_positive", price > 0))
    return rules


def order_rules() -> list[Rule]:
    """Expects ``InvoiceDate`` already parsed, so a bad date is NULL here."""
    return (
        _present("InvoiceNo")
        + [Rule("InvoiceDate_not_null", F.col("InvoiceDate").isNotNull())]
        + _present("Country")
    )


def line_rules() -> list[Rule]:
    return (
        _present("InvoiceNo")
        + _present("StockCode")
        + [
            Rule("Quantity_not_null", F.col("Quantity").isNotNull()),
            Rule("Quantity_not_zero", F.col("Quantity") != 0),
        ]
    )
