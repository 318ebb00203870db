"""Contracts: every rule gives violation rows (contract, subject, detail, severity); a contract holds if it gives none.

Rules are declared over named tables and compiled together: a table is scanned once, however many rules it has, and each row gives its facts to all of them; all facts are
counted in one grouping, with partial counts before the shuffle. What a rule says of its counts then makes the violations.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COLUMNS = ("contract", "subject", "detail", "severity")
FACT = "rule int, key array<string>, n long, other long"


def _rows(df: DataFrame, contract: str, subject: Column, detail: Column, severity: str = "ERROR") -> DataFrame:
    return df.select(F.lit(contract).alias("contract"), subject.cast("string").alias("subject"), detail.cast("string").alias("detail"), F.lit(severity).alias("severity"))


class Contracts:
    """Rules over named tables; `report` gives the violations of all of them.

    Edge cases: a null subject stays null; keys are compared as texts with nulls apart; an empty table violates only totals that aren't 0.
    """

    def __init__(self, **tables: DataFrame):
        self.tables = tables
        self.facts: dict[str, list[Column]] = {t: [] for t in tables}
        self.rules: list[tuple[str, str, str]] = []  # contract, kind, severity
        self.seeds: list[tuple] = []

    def _fact(self, table: str, when: Column, key: list[Column], n: Column | int = 1, other: int = 0) -> None:
        key = F.array(*[k.cast("string") for k in key])
        n = n if isinstance(n, Column) else F.lit(n)
        self.facts[table].append(F.when(when, F.struct(F.lit(len(self.rules) - 1).alias("rule"), key.alias("key"), n.cast("long").alias("n"), F.lit(other).cast("long").alias("other"))))

    def every(self, table: str, contract: str, subject: str, condition: Column, detail: Column | str, severity: str = "ERROR") -> Contracts:
        """Rows for which a condition isn't true."""
        self.rules.append((contract, "row", severity))
        self._fact(table, ~F.coalesce(condition, F.lit(False)), [F.col(subject), detail if isinstance(detail, Column) else F.lit(detail)])
        return self

    def vocabulary(self, table: str, contract: str, subject: str, column: str, allowed: Iterable[str]) -> Contracts:
        return self.every(table, contract, subject, F.col(column).isin(*allowed), F.concat(F.lit(f"{column}="), F.coalesce(F.col(column).cast("string"), F.lit("null"))))

    def schema(self, table: str, contract: str, subject: str, schema: dict) -> Contracts:
        """Rows and rules of a JSON Schema that don't hold; what it understands is in `compile_schema`."""
        for name, condition in compile_schema(schema).items():
            self.every(table, contract, subject, condition, name)
        return self

    def unique(self, table: str, contract: str, *key: str) -> Contracts:
        self.rules.append((contract, "unique", "ERROR"))
        self._fact(table, F.lit(True), [F.col(k) for k in key])
        return self

    def reference(self, table: str, contract: str, column: str, target: str, target_column: str) -> Contracts:
        """Values that don't exist in the target; nulls refer to nothing."""
        self.rules.append((contract, "reference", "ERROR"))
        self._fact(table, F.col(column).isNotNull(), [F.col(column)])
        self._fact(target, F.col(target_column).isNotNull(), [F.col(target_column)], 0, 1)
        return self

    def total(self, table: str, contract: str, name: str, want: int, value: Column | int = 1, when: Column | None = None) -> Contracts:
        """A pinned sum of `value` (1: a number of rows) over the rows for which `when` is true."""
        self.rules.append((contract, "total", "ERROR"))
        self._fact(table, F.lit(True) if when is None else F.coalesce(when, F.lit(False)), [F.lit(name), F.lit(want)], value)
        self.seeds.append((len(self.rules) - 1, [name, str(want)], 0, 0))
        return self

    def report(self) -> DataFrame:
        parts = [df.select(F.explode(F.array_compact(F.array(*self.facts[t]))).alias("f")).select("f.*") for t, df in self.tables.items() if self.facts[t]]
        if self.seeds:
            parts.append(parts[0].sparkSession.createDataFrame(self.seeds, FACT))
        counted = reduce(DataFrame.unionAll, parts).groupBy("rule", "key").agg(F.sum("n").alias("n"), F.sum("other").alias("other"))
        of = lambda i: F.element_at(F.array(*[F.lit(r[i]) for r in self.rules]), F.col("rule") + 1)
        kind, first, rows = of(1), F.col("key")[0], F.concat(F.lit("rows="), F.col("n"))
        bad = (kind == "row") | ((kind == "unique") & (F.col("n") > 1)) | ((kind == "reference") & (F.col("n") > 0) & (F.col("other") == 0)) | ((kind == "total") & (F.col("n") != F.col("key")[1].cast("long")))
        subject = F.when(kind == "unique", F.array_join("key", "|")).otherwise(first)
        detail = F.when(kind == "row", F.col("key")[1]).when(kind == "total", F.concat(F.lit("got="), F.col("n"), F.lit(" want="), F.col("key")[1])).otherwise(rows)
        found = counted.filter(bad).select(of(0).alias("contract"), subject.alias("subject"), detail.alias("detail"), of(2).alias("severity"), F.when(kind == "row", F.col("n")).otherwise(F.lit(1)).alias("_n"))
        return found.select(*COLUMNS, F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))).alias("_i")).drop("_i")


def unique(df: DataFrame, contract: str, *key: str) -> DataFrame:
    return Contracts(t=df).unique("t", contract, *key).report()


def vocabulary(df: DataFrame, contract: str, subject: str, column: str, allowed: Iterable[str]) -> DataFrame:
    return Contracts(t=df).vocabulary("t", contract, subject, column, allowed).report()


def file_pins(inventory: DataFrame, contract: str, pins: DataFrame) -> DataFrame:
    """Files (file, bytes, sha256) that are missing or differ from their pins."""
    got = inventory.select("file", F.col("bytes").alias("_b"), F.col("sha256").alias("_h"))
    bad = pins.join(got, "file", "left").filter(F.col("_h").isNull() | (F.col("_h") != F.col("sha256")) | (F.col("_b") != F.col("bytes")))
    return _rows(bad, contract, F.col("file"), F.when(F.col("_h").isNull(), "missing").otherwise("changed"))


def same_rows(left: DataFrame, right: DataFrame, contract: str) -> DataFrame:
    """Rows, with repetitions, that only one side has."""
    a, b = left.exceptAll(right), right.exceptAll(left)
    return _rows(a, contract, F.to_json(F.struct(*a.columns)), F.lit("only left")).union(_rows(b, contract, F.to_json(F.struct(*b.columns)), F.lit("only right")))


def same_fields(left: DataFrame, right: DataFrame, contract: str, key: str, columns: Sequence[str]) -> DataFrame:
    """Fields in which two documents with one key differ, one row each."""
    b = right.select(key, *[F.col(c).alias(f"_{c}") for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("f"), F.col(c).cast("string").alias("a"), F.col(f"_{c}").cast("string").alias("b")) for c in columns])
    long = left.join(b, key).select(key, F.explode(pairs).alias("x")).filter("not (x.a <=> x.b)")
    return _rows(long, contract, F.col(key), F.concat(F.col("x.f"), F.lit(": "), F.coalesce("x.a", F.lit("null")), F.lit(" / "), F.coalesce("x.b", F.lit("null"))))


def dependencies(df: DataFrame, contract: str, key: str, needs: str) -> DataFrame:
    """Ids that a row depends on and that no row has."""
    asked = df.select(F.col(key).alias("_by"), F.explode(needs).alias("_v"))
    return _rows(asked.join(df.select(F.col(key).alias("_v")), "_v", "left_anti"), contract, F.col("_by"), F.concat(F.lit("needs "), F.col("_v")))


def report(*parts: DataFrame) -> DataFrame:
    """All violations together."""
    return reduce(DataFrame.union, parts)


def summary(violations: DataFrame) -> DataFrame:
    """One row: errors, warnings and PASS or FAIL."""
    errors = F.count_if(F.col("severity") == "ERROR")
    return violations.agg(errors.alias("errors"), F.count_if(F.col("severity") == "WARNING").alias("warnings"), F.when(errors == 0, "PASS").otherwise("FAIL").alias("result"))


def complete(df: DataFrame, **conditions: Column) -> DataFrame:
    """One row: every named condition over the whole table, and PASS only if all hold."""
    row = df.agg(*[F.coalesce(F.bool_and(c), F.lit(True)).alias(n) for n, c in conditions.items()])
    return row.withColumn("result", F.when(reduce(lambda a, b: a & b, [F.col(n) for n in conditions]), "PASS").otherwise("FAIL"))


def compile_schema(schema: dict) -> dict[str, Column]:
    """Conditions from a JSON Schema's required, const, enum, minimum, maximum, pattern, minLength, minItems and maxItems."""
    out = {}
    for name in schema.get("required", []):
        out[f"{name}.required"] = F.col(name).isNotNull()
    for name, rule in schema.get("properties", {}).items():
        c = F.col(name)
        tests = {
            "const": lambda v, c=c: c == v, "enum": lambda v, c=c: c.isin(*v), "minimum": lambda v, c=c: c >= v, "maximum": lambda v, c=c: c <= v, "pattern": lambda v, c=c: c.rlike(v),
            "minLength": lambda v, c=c: F.length(c) >= v, "minItems": lambda v, c=c: F.size(c) >= v, "maxItems": lambda v, c=c: F.size(c) <= v,
        }
        for k, v in rule.items():
            if k in tests:
                out[f"{name}.{k}"] = c.isNull() | tests[k](v)
    return out


def schema_violations(df: DataFrame, contract: str, subject: str, schema: dict) -> DataFrame:
    return Contracts(t=df).schema("t", contract, subject, schema).report()
