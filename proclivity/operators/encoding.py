"""Category encoders: wide 0/1 columns, sorted ordinals, passthrough."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from proclivity.functions.columns import col
from proclivity.functions.sqltext import ident, text, with_expressions
from proclivity.operators.base import FittedStep, Step
from proclivity.operators.summary import value_counts
from proclivity.schema import require_columns, text_columns
from proclivity.session import materialize, written

#: Categories of one column that one-hot encoding turns into columns, unless more are asked for.
MAX_CATEGORIES = 10_000
#: Up to so many categories are looked up in the expression itself, more by a join.
IN_LINE = 100
NULL_NAME = "nan"


def fitted_categories(
    df: DataFrame, columns: list[str], limit: int = MAX_CATEGORIES
) -> dict[str, list[str | None]]:
    """Sorted categories per column, nulls last.

    Categories become columns or literals, so the number in each column is checked against ``limit`` before any is fetched.
    """
    if not columns:
        return {}
    found = _few_categories(value_counts(df, columns), columns, limit)
    if found is None:
        raise ValueError(f"more than {limit} categories in one of {columns}; raise max_categories or use ordinal codes")
    return found


def _few_categories(counted: DataFrame, columns: list[str], limit: int) -> dict[str, list[str | None]] | None:
    """Sorted categories per column, nulls last; None if a column has more than ``limit``. One job, no more rows than that."""
    most = limit * len(columns)
    rows = counted.select("feature", "category").limit(most + 1).collect()
    out: dict[str, list[str | None]] = {c: [] for c in columns}
    for row in rows:
        out[row["feature"]].append(row["category"])
    if len(rows) > most or any(len(v) > limit for v in out.values()):
        return None
    return {c: sorted(v, key=lambda x: (x is None, x or "")) for c, v in out.items()}


def numbered(categories: DataFrame) -> DataFrame:
    """``(feature, category, code)``: categories of each column numbered from 0 in sorted order.

    The order is cut into ranges; rows are numbered inside their range, and a range starts at the number of rows in the
    ranges before it. So no task holds more than a range, however many categories a column has.
    """
    order = ["feature", "category"]
    ranged = categories.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    # The upper bits of this number are the range, the lower 33 the place in it.
    placed = materialize(ranged.withColumn("place", F.monotonically_increasing_id()), "places")
    part, inside = F.shiftright("place", 33), F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range, that is per task.
    sizes = placed.groupBy(part.alias("part")).count()
    starts = sizes.select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    everywhere = placed.withColumn("part", part).join(starts, "part").select(*order, (F.col("start") + inside).alias("number"))
    first = everywhere.groupBy("feature").agg(F.min("number").alias("first"))
    return everywhere.join(first, "feature").select(*order, (F.col("number") - F.col("first")).cast("double").alias("code"))


def categorical_encoder(
    encoding: str = "onehot", columns: list[str] | None = None, handle_unknown: str = "ignore"
):
    """Encoder by name: onehot, ordinal or passthrough."""
    if encoding == "onehot":
        return OneHotEncoder(columns, handle_unknown)
    if encoding == "ordinal":
        return OrdinalEncoder(columns)
    if encoding == "passthrough":
        return Passthrough()
    if encoding == "target":
        raise NotImplementedError("target encoding would need leakage-safe folds; not offered")
    raise ValueError("encoding must be 'onehot', 'ordinal', 'passthrough' or 'target'")


class OneHotEncoder(Step):
    """Each text column becomes one 0/1 column per fitted category, ``<column>_<value>``.

    A category unseen at fit matches no column: all zeros, or an error with
    ``handle_unknown="error"``. Nulls at fit form a category of their own. A column of more than ``max_categories``
    categories is an error, since each becomes a column.
    """

    def __init__(self, columns: list[str] | None = None, handle_unknown: str = "ignore", max_categories: int = MAX_CATEGORIES):
        super().__init__()
        self.max_categories = max_categories
        if handle_unknown not in ("ignore", "error"):
            raise ValueError("handle_unknown must be 'ignore' or 'error'")
        self.columns = columns
        self.handle_unknown = handle_unknown

    def _fit(self, df: DataFrame) -> OneHotModel:
        columns = text_columns(df) if self.columns is None else list(self.columns)
        require_columns(df, columns)
        return OneHotModel(
            {"categories": fitted_categories(df, columns, self.max_categories), "unknown": self.handle_unknown}
        )


class OneHotModel(FittedStep):
    """Equality tests against literals; source columns are dropped."""

    @property
    def outputs(self) -> list[str]:
        return [
            f"{c}_{NULL_NAME if v is None else v}"
            for c, values in self.state["categories"].items()
            for v in values
        ]

    def _transform(self, df: DataFrame) -> DataFrame:
        categories = self.state["categories"]
        hot = {}
        for c, values in categories.items():
            source = f"CAST({ident(c)} AS STRING)"
            if self.state["unknown"] == "error":
                known = [f"{source} <=> {text(v)}" for v in values] or ["false"]
                message = f"concat({text(f'unknown category in {c}: ')}, coalesce({source}, 'null'))"
                source = f"CASE WHEN {' OR '.join(known)} THEN {source} ELSE raise_error({message}) END"
            for v in values:
                name = f"{c}_{NULL_NAME if v is None else v}"
                if name in hot or (name in df.columns and name not in categories):
                    raise ValueError(f"two columns would be named {name}; rename a column or a category")
                hot[name] = f"CAST({source} <=> {text(v)} AS DOUBLE)"
        return with_expressions(df, hot, drop=set(categories))


class OrdinalEncoder(Step):
    """Each text column becomes the rank of its value among the sorted fitted ones; unseen -1.

    Columns with more than ``in_line`` categories are looked up in a table of codes, so their number is not limited.
    """

    def __init__(self, columns: list[str] | None = None, in_line: int = IN_LINE):
        super().__init__()
        self.columns = columns
        self.in_line = in_line

    def _fit(self, df: DataFrame) -> OrdinalModel:
        columns = text_columns(df) if self.columns is None else list(self.columns)
        require_columns(df, columns)
        if not columns:
            return OrdinalModel({"categories": {}, "tabled": []})
        counted = value_counts(df, columns)
        if (short := _few_categories(counted, columns, self.in_line)) is not None:
            return OrdinalModel({"categories": short, "tabled": []})
        with written(counted.select("feature", "category"), "categories") as found:
            sizes = {r["feature"]: r["count"] for r in found.groupBy("feature").count().collect()}
            tabled = [c for c in columns if sizes.get(c, 0) > self.in_line]
            rest = [c for c in columns if c not in tabled]
            short = _few_categories(found.where(F.col("feature").isin(rest)), rest, self.in_line)
            named = found.where(F.col("feature").isin(tabled) & F.col("category").isNotNull())
            return OrdinalModel({"categories": short, "tabled": tabled}, materialize(numbered(named), "codes"))


class OrdinalModel(FittedStep):
    """Literal or joined lookup per column; a null stays null."""

    parts = ("table",)

    def __init__(self, state: dict | None = None, table: DataFrame | None = None):
        super().__init__(state)
        self.table = table

    def _transform(self, df: DataFrame) -> DataFrame:
        out = self._short(df)
        for i, c in enumerate(self.state.get("tabled", [])):
            # No hint: Spark broadcasts the codes below its size threshold and shuffles beyond it.
            value, code = f"__value_{i}", f"__code_{i}"
            codes = self.table.where(F.col("feature") == c).select(F.col("category").alias(value), F.col("code").alias(code))
            source = col(c).cast("string")
            found = F.when(source.isNotNull(), F.coalesce(code, F.lit(-1.0)))
            out = out.join(codes, source == F.col(value), "left").withColumn(c, found).drop(value, code)
        return out.select(*[col(c) for c in df.columns])

    def _short(self, df: DataFrame) -> DataFrame:
        changes = {}
        for c, values in self.state["categories"].items():
            source = col(c).cast("string")
            known = [v for v in values if v is not None]
            if known:
                position = F.array_position(F.array(*[F.lit(v) for v in known]), source) - 1
            else:
                position = F.lit(-1)
            changes[c] = F.when(source.isNotNull(), position.cast("double"))
        return df.withColumns(changes)


class Passthrough(Step):
    """Leave the frame as it is."""

    def _fit(self, df: DataFrame) -> PassthroughModel:
        return PassthroughModel()


class PassthroughModel(FittedStep):
    def _transform(self, df: DataFrame) -> DataFrame:
        return df
