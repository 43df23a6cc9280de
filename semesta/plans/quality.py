"""Declared constraints as violation counts.

Every report has the rows (tabel, aturan, pelanggaran): table, rule, number of violations. Row rules
of a table are counted in one pass. Key rules of all tables are counted together: each table is read once and
gives a (rule, key) row for each of its keys and references, and one aggregate over all of them combines
before its only shuffle, so a key that holds a large part of a table does not travel as rows. As in a
database, NULL passes every check but NOT NULL.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from semesta.schemas import ForeignKey, Table

Tables = Mapping[str, DataFrame]


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _count_rules(df: DataFrame, table: str, rules: dict[str, Column]) -> DataFrame:
    """One pass over ``df``: how many rows break each rule (a condition true on violations)."""
    names = list(rules)
    counted = df.agg(*(F.count(F.when(broken, 1)).alias(f"r{i}") for i, broken in enumerate(rules.values())))
    report = F.array(
        *(F.struct(F.lit(name).alias("aturan"), F.col(f"r{i}").alias("pelanggaran")) for i, name in enumerate(names))
    )
    return counted.select(F.lit(table).alias("tabel"), F.inline(report))


def required_columns(spec: Table) -> list[str]:
    """Columns without NULL: a primary key is required too."""
    return list(dict.fromkeys((*spec.key, *spec.required)))


def not_null(tables: Tables, specs: Iterable[Table]) -> DataFrame:
    return union_all(
        _count_rules(tables[s.name], s.name, {f"{c} not null": F.col(c).isNull() for c in required_columns(s)})
        for s in specs
    )


def lengths(tables: Tables, specs: Iterable[Table]) -> DataFrame:
    """Texts longer than declared."""
    return union_all(
        _count_rules(tables[s.name], s.name, {f"{c} length": F.char_length(c) > n for c, n in s.lengths.items()})
        for s in specs
        if s.lengths
    )


def domain_values(tables: Tables, specs: Iterable[Table]) -> DataFrame:
    return union_all(
        _count_rules(
            tables[s.name], s.name, {f"{c} domain": ~F.col(c).isin(*values) for c, values in s.domains.items()}
        )
        for s in specs
        if s.domains
    )


def ranges(tables: Tables, specs: Iterable[Table]) -> DataFrame:
    return union_all(
        _count_rules(tables[s.name], s.name, {f"{c} range": ~F.expr(valid) for c, valid in s.ranges.items()})
        for s in specs
        if s.ranges
    )


def date_order(tables: Tables, specs: Iterable[Table]) -> DataFrame:
    return union_all(
        _count_rules(tables[s.name], s.name, {f"{c} order": ~F.expr(valid) for c, valid in s.date_order.items()})
        for s in specs
        if s.date_order
    )


def _key(columns: tuple[str, ...]) -> Column:
    """A key as one text, different for different keys; NULL if any part is."""
    texts = [F.col(c).cast("string") for c in columns]
    if len(texts) == 1:
        return texts[0]
    return F.concat(*(part for t in texts for part in (F.char_length(t).cast("string"), F.lit(":"), t)))


def _number(df: DataFrame, columns: tuple[str, ...]) -> bool:
    """Whether a key is one whole number."""
    return len(columns) == 1 and isinstance(df.schema[columns[0]].dataType, T.IntegralType)


class _Keys:
    """(rule, key, child, parent) rows of many tables, each of which is read once for all its rules.

    Keys are texts, or numbers where those of all rules are.
    """

    def __init__(self) -> None:
        self.rules: list[tuple[str, str]] = []
        self._tables: dict[int, tuple[DataFrame, list[tuple[int, tuple[str, ...], int, int]]]] = {}

    def rule(self, table: str, name: str) -> int:
        self.rules.append((table, name))
        return len(self.rules) - 1

    def take(self, rows: DataFrame, rule: int, columns: tuple[str, ...], child: int, parent: int) -> None:
        self._tables.setdefault(id(rows), (rows, []))[1].append((rule, columns, child, parent))

    def _taken(self, kind: str) -> Iterable[DataFrame]:
        def entry(rule: int, columns: tuple[str, ...], child: int, parent: int) -> Column:
            key = _key(columns) if kind == "string" else F.col(columns[0]).cast(kind)
            return F.struct(F.lit(rule).alias("rule"), key.alias("key"), F.lit(child).alias("child"), F.lit(parent).alias("parent"))

        for rows, entries in self._tables.values():
            yield rows.select(F.inline(F.array(*(entry(*given) for given in entries))))

    def report(self, broken: Column) -> DataFrame:
        """Sum of ``broken`` over the keys of each rule, from their ``children`` and ``parents`` rows."""
        numbers = all(_number(rows, columns) for rows, entries in self._tables.values() for _, columns, _, _ in entries)
        kind = "bigint" if numbers else "string"
        taken = [*self._taken(kind)]
        # A row without key for each rule, so that rules of empty tables are reported.
        spark = taken[0].sparkSession
        every = spark.range(len(self.rules)).select(
            F.col("id").cast("int").alias("rule"), F.lit(None).cast(kind).alias("key"), F.lit(0).alias("child"), F.lit(0).alias("parent")
        )
        keys = union_all([*taken, every]).groupBy("rule", "key").agg(
            F.sum("child").alias("children"), F.max("parent").alias("parents")
        )
        counted = keys.groupBy("rule").agg(
            F.sum(F.when(F.col("key").isNotNull(), broken).otherwise(0)).cast("bigint").alias("pelanggaran")
        )
        names = F.array(*(F.struct(F.lit(table).alias("tabel"), F.lit(name).alias("aturan")) for table, name in self.rules))
        return counted.select(names[F.col("rule")].alias("r"), "pelanggaran").select("r.*", "pelanggaran")


def unique_keys(tables: Tables, specs: Iterable[Table]) -> DataFrame:
    """Number of keys that occur more than once."""
    keys = _Keys()
    for s in specs:
        for key in (s.key, *s.unique):
            keys.take(tables[s.name], keys.rule(s.name, f"{', '.join(key)} unique"), key, 1, 0)
    return keys.report(F.when(F.col("children") > 1, 1).otherwise(0))


def orphans(references: Iterable[tuple[DataFrame, str, ForeignKey]], parents: Tables) -> DataFrame:
    """Number of rows of each (rows, table, foreign key) whose key has no parent."""
    keys = _Keys()
    for rows, table, fk in references:
        rule = keys.rule(table, f"{', '.join(fk.columns)} in {fk.parent}")
        keys.take(rows, rule, fk.columns, 1, 0)
        keys.take(parents[fk.parent], rule, fk.parent_columns, 0, 1)
    return keys.report(F.when(F.col("parents") == 0, F.col("children")).otherwise(0))


def referential(tables: Tables, specs: Iterable[Table]) -> DataFrame:
    return orphans([(tables[s.name], s.name, fk) for s in specs for fk in s.references], tables)


def logical_references(tables: Tables, specs: Iterable[Table]) -> DataFrame:
    """References across the two operational systems, which no database enforces."""
    return orphans([(tables[s.name], s.name, fk) for s in specs for fk in s.logical_references], tables)


def apply_defaults(df: DataFrame, spec: Table) -> DataFrame:
    """Declared defaults on missing values, as at insert."""
    return df.fillna(spec.defaults) if spec.defaults else df


def defaults_applied(tables: Tables, specs: Iterable[Table]) -> DataFrame:
    """Rows per column that get the declared default at ingest."""
    return union_all(
        _count_rules(tables[s.name], s.name, {f"{c} default": F.col(c).isNull() for c in s.defaults})
        for s in specs
        if s.defaults
    )


def row_counts(tables: Tables) -> DataFrame:
    """Labelled row count of every table."""
    return union_all(
        df.agg(F.count(F.lit(1)).alias("total")).select(F.lit(name).alias("tabel"), "total")
        for name, df in tables.items()
    )


def reconcile(counts: DataFrame, expected: DataFrame) -> DataFrame:
    """Counts next to the expected ones, where there is one; a positive gap is rows that did not arrive."""
    return counts.join(expected.withColumnRenamed("total", "diharapkan"), "tabel", "left").select(
        "tabel", "total", "diharapkan", (F.col("diharapkan") - F.col("total")).alias("selisih")
    )
