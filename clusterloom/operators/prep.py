"""Mixed-type table -> numeric feature vectors: typing, imputation, scaling, one-hot, labels.

``fit_prep`` needs a handful of aggregates over the whole table; ``PrepModel.transform`` is one
projection that Catalyst prunes and pushes like any other.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DecimalType, NumericType, StringType

from clusterloom.functions.columns import MISSING_MARKERS
from clusterloom.functions.linalg import SPARSE
from clusterloom.operators.selection import medians, row_numbers

MAX_DENSE = 4096  # widest one-hot layout that is assembled as one array per row, and most classes that are coded by a literal list
FILL_ALL_NULL = "Missing"  # fixed value: fill of a categorical column without any value
NULL_CLASS = "nan"  # fixed value: class name of rows without a class


def class_column(df: DataFrame, name: str | None = None) -> str:
    """The named class column, by default the last one."""
    return name or df.columns[-1]


def markers_to_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Whole-value missing markers become null in string columns; NaN becomes null in numeric ones."""
    changed = {}
    for f in df.schema.fields:
        if columns is not None and f.name not in columns:
            continue
        if isinstance(f.dataType, StringType):
            changed[f.name] = F.when(~F.col(f.name).isin(*MISSING_MARKERS), F.col(f.name))
        elif f.dataType.simpleString() in ("double", "float"):
            changed[f.name] = F.when(~F.isnan(f.name), F.col(f.name))
    return df.withColumns(changed) if changed else df


def parsed(column: str) -> Column:
    """The column as double; text that is no number, and NaN, become null."""
    v = F.col(column).try_cast("double")
    return F.when(~F.isnan(v), v)


def numeric_shares(df: DataFrame, columns: list[str]) -> dict[str, float]:
    """Share of rows that parse as numbers, all columns in one aggregate."""
    row = df.agg(*[F.avg(parsed(c).isNotNull().cast("double")).alias(f"s_{i}") for i, c in enumerate(columns)]).first()
    return {c: row[f"s_{i}"] or 0.0 for i, c in enumerate(columns)}


def is_numeric(data_type) -> bool:
    return isinstance(data_type, (NumericType, DecimalType)) and not isinstance(data_type, BooleanType)


def split_types(df: DataFrame, class_col: str | None, skip: tuple = ()) -> tuple[list[str], list[str]]:
    """(numeric, categorical) feature columns.

    A column counts as numeric when its type is, or when more than half of its rows parse.
    """
    feats = [f for f in df.schema.fields if f.name != class_col and f.name not in skip]
    text = [f.name for f in feats if not is_numeric(f.dataType)]
    share = numeric_shares(df, text) if text else {}
    typed = {f.name for f in feats if is_numeric(f.dataType)}
    numeric = [f.name for f in feats if f.name in typed or share.get(f.name, 0.0) > 0.5]
    return numeric, [f.name for f in feats if f.name not in numeric]


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, n) for all categorical columns at once; one partial aggregation."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    return df.select(F.explode(pairs).alias("p")).where("p.value IS NOT NULL").groupBy("p.column", "p.value").agg(F.count("*").alias("n"))


def modes(df: DataFrame, columns: list[str]) -> dict[str, str]:
    """Most frequent value per column, smallest on ties; columns without values are absent."""
    if not columns:
        return {}
    best = value_counts(df, columns).groupBy("column").agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("value"))
    return {r["column"]: r["value"] for r in best.collect()}


@dataclass
class PrepModel:
    """Everything learnt from the table; all of it small except ``dictionary`` of a wide layout."""

    class_col: str | None
    numeric: list[str]
    categorical: list[str]
    coerced: list[str]
    fills: dict[str, object]
    bounds: dict[str, tuple[float, float]]
    categories: dict[str, list[str]] | None
    classes: list[str] | None = None
    dictionary: DataFrame | None = field(default=None, repr=False)
    class_codes: DataFrame | None = field(default=None, repr=False)  # (_class, _code) in place of ``classes`` beyond MAX_DENSE
    width: int = 0

    @property
    def feature_names(self) -> list[str]:
        if self.categories is None:
            raise ValueError("layout is too wide to list; see dictionary")
        return self.numeric + [f"{c}_{v}" for c in self.categorical for v in self.categories[c]]

    def imputed(self, df: DataFrame) -> DataFrame:
        """Typed columns with markers removed and gaps filled."""
        out = markers_to_null(df).withColumns({c: parsed(c) for c in self.coerced})
        return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in self.fills.items()})

    def _scaled(self, c: str) -> Column:
        lo, hi = self.bounds[c]
        if lo is None or hi == lo:
            return F.lit(0.0)
        return (F.col(c).cast("double") - F.lit(lo)) / F.lit(hi - lo)

    def _class_name(self) -> Column:
        return F.coalesce(F.col(self.class_col).cast("string"), F.lit(NULL_CLASS))

    def label(self) -> Column:
        """Class code: position of the class name in sorted order, null for an unseen class."""
        return (F.nullif(F.array_position(F.array(*[F.lit(c) for c in self.classes]), self._class_name()), F.lit(0)) - 1).cast("int")

    def labelled(self, ready: DataFrame) -> tuple[DataFrame, list[Column]]:
        """``ready`` and its label column, if classes were learnt; many classes are joined by name."""
        if self.class_codes is not None:
            return ready.withColumn("_class", self._class_name()).join(self.class_codes, "_class", "left"), [F.col("_code").alias("label")]
        return ready, [self.label().alias("label")] if self.classes is not None else []

    def transform(self, df: DataFrame, id_col: str = "id") -> DataFrame:
        """(id, features[, label]); numeric columns first, then one 0/1 value per category.

        Up to MAX_DENSE features are an array, more are a sparse vector (see :meth:`transform_sparse`).
        """
        if self.categories is None:
            return self.transform_sparse(df, id_col)
        parts = [self._scaled(c) for c in self.numeric]
        parts += [(F.col(c).cast("string") == F.lit(v)).cast("double") for c in self.categorical for v in self.categories[c]]
        ready, label = self.labelled(self.imputed(df))
        return ready.select(F.col(id_col).alias("id"), F.array(*parts).alias("features"), *label)

    def transform_sparse(self, df: DataFrame, id_col: str = "id") -> DataFrame:
        """(id, features[, label]) with features as (size, positions, values) of the non-zero entries, positions rising.

        The dictionary is joined on (column, value) once per row and categorical column; a row's entries, at most one a column, meet
        again by its id, which must be unique. Unseen categories have no entry.
        """
        ready, label = self.labelled(self.imputed(df))
        entry = "struct<position: int, value: double>"
        own = F.filter(F.array(*[F.struct(F.lit(i).alias("position"), self._scaled(c).alias("value")) for i, c in enumerate(self.numeric)]), lambda e: e["value"] != 0) if self.numeric else F.array()
        pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("category")) for c in self.categorical])
        kept = ready.select(F.col(id_col).alias("id"), *label, own.cast(f"array<{entry}>").alias("own"), pairs.alias("pairs"))
        if self.categorical:
            each = kept.withColumn("p", F.explode_outer("pairs")).select("id", *[c for c in kept.columns if c not in ("id", "pairs")], "p.column", "p.category")
            met = each.join(self.dictionary, ["column", "category"], "left")
            hot = F.when(F.col("position").isNotNull(), F.struct((F.col("position") + len(self.numeric)).cast("int").alias("position"), F.lit(1.0).alias("value")))
            kept = met.groupBy("id").agg(F.first("own").alias("own"), F.collect_list(hot).alias("hot"), *[F.first("label").alias("label") for _ in label])
            entries = F.concat("own", F.array_sort(F.col("hot").cast(f"array<{entry}>")))
        else:
            entries = F.col("own")
        vector = F.struct(F.lit(self.width).alias("size"), F.transform(entries, lambda e: e["position"]).alias("positions"), F.transform(entries, lambda e: e["value"]).alias("values"))
        return kept.select("id", vector.cast(SPARSE).alias("features"), *[F.col("label") for _ in label])

    def transform_long(self, df: DataFrame, id_col: str = "id") -> DataFrame:
        """(id, position, value) with the non-zero one-hot entries: any number of categories.

        The dictionary is joined on (column, value); Spark picks broadcast or shuffle by its real
        size and splits hot values at run time.
        """
        ready = self.imputed(df)
        scaled = ready.select(F.col(id_col).alias("id"), F.posexplode(F.array(*[self._scaled(c) for c in self.numeric])).alias("position", "value")) if self.numeric else None
        if not self.categorical:
            return scaled.select("id", F.col("position").cast("bigint").alias("position"), "value")
        pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("category")) for c in self.categorical])
        hot = (
            ready.select(F.col(id_col).alias("id"), F.explode(pairs).alias("p")).select("id", "p.column", "p.category")
            .join(self.dictionary, ["column", "category"])
            .select("id", (F.col("position") + F.lit(len(self.numeric))).cast("bigint").alias("position"), F.lit(1.0).alias("value"))
        )
        return hot if scaled is None else scaled.select("id", F.col("position").cast("bigint").alias("position"), "value").unionByName(hot)


def fit_prep(df: DataFrame, class_col: str | None = None, id_col: str = "id", drop_class: bool = False) -> PrepModel:
    """Learn types, fills, bounds, categories and class codes from the whole table.

    Three scans: one aggregate over all columns, one count of categorical and class values, and the
    medians of numeric columns. Every column gets a fill, since later rows may have gaps where these have none.
    A fill never moves a bound, so bounds come early.
    """
    class_col = class_column(df, class_col)
    feats = [f for f in df.schema.fields if f.name not in (class_col, id_col)]
    typed = {f.name for f in feats if is_numeric(f.dataType)}
    names = [f.name for f in feats]
    aggs = [F.count("*").alias("n")]
    for i, c in enumerate(names):
        v = parsed(c)
        aggs += [F.count(v).alias(f"n_{i}"), F.min(v).alias(f"lo_{i}"), F.max(v).alias(f"hi_{i}")]
    s = df.agg(*aggs).first()
    numeric = [c for i, c in enumerate(names) if c in typed or s[f"n_{i}"] > 0.5 * s["n"]]
    categorical = [c for c in names if c not in numeric]
    coerced = [c for c in numeric if c not in typed]
    bounds = {c: (s[f"lo_{i}"], s[f"hi_{i}"]) for i, c in enumerate(names) if c in numeric}
    clean = markers_to_null(df).withColumns({c: parsed(c) for c in coerced})
    fills: dict[str, object] = {c: m for c, m in medians(clean, numeric).items() if m is not None}
    counted = categorical + ([] if drop_class else [class_col])
    categories, dictionary, classes, class_codes = {}, None, None, None
    width = 0
    if counted:
        counts = value_counts(clean, counted).persist(StorageLevel.MEMORY_AND_DISK)
        summary = {
            r["column"]: r
            for r in counts.groupBy("column").agg(
                F.sum("n").alias("n"), F.count("*").alias("values"), F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode")
            ).collect()
        }
        for c in categorical:
            fills[c] = summary[c]["mode"] if c in summary else FILL_ALL_NULL
        empty = [c for c in categorical if c not in summary]
        width = sum(summary[c]["values"] for c in categorical if c in summary) + len(empty)
        if width <= MAX_DENSE:
            seen = counts.where(F.col("column").isin(categorical)).select("column", "value").collect() if categorical else []
            categories = {c: sorted(r["value"] for r in seen if r["column"] == c) or [FILL_ALL_NULL] for c in categorical}
            order = [(c, v, i) for i, (c, v) in enumerate((c, v) for c in categorical for v in categories[c])]
            dictionary = df.sparkSession.createDataFrame(order, "column string, category string, position bigint")
        else:
            categories = None
            rank = F.array_position(F.array(*[F.lit(c) for c in categorical]), F.col("column"))
            known = counts.where(F.col("column").isin(categorical)).select("column", F.col("value").alias("category"))
            if empty:
                known = known.unionByName(df.sparkSession.createDataFrame([(c, FILL_ALL_NULL) for c in empty], "column string, category string"))
            dictionary = row_numbers(known.withColumn("_c", rank), ["_c", "category"]).select("column", "category", "position")
        if not drop_class:
            found = summary.get(class_col)
            seen = counts.where(F.col("column") == class_col).select("value")
            missing = [] if found and found["n"] == s["n"] else [(NULL_CLASS,)]
            if found and found["values"] > MAX_DENSE:
                names = seen.union(df.sparkSession.createDataFrame(missing, "value string")).distinct().withColumnRenamed("value", "_class")
                class_codes = row_numbers(names, ["_class"], "_code").withColumn("_code", F.col("_code").cast("int"))
            else:
                classes = sorted({r["value"] for r in seen.collect()} | {v for v, in missing})
        counts.unpersist()
    return PrepModel(class_col, numeric, categorical, coerced, fills, bounds, categories, classes, dictionary, class_codes, len(numeric) + width)


def prepare(df: DataFrame, class_col: str | None = None, id_col: str = "id", drop_class: bool = False) -> tuple[DataFrame, PrepModel]:
    """Fit on ``df`` and transform it: (features frame, model)."""
    model = fit_prep(df, class_col, id_col, drop_class)
    return model.transform(df, id_col), model


def nan_to_zero(features: Column) -> Column:
    """Vector with null and NaN entries replaced by 0."""
    return F.transform(features, lambda v: F.coalesce(F.nanvl(v.cast("double"), F.lit(None).cast("double")), F.lit(0.0)))
