"""Row-wise cleaning; everything here is a projection and also runs on a streaming DataFrame."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from riskframe.functions.presets import AGE_BANDS, BMI_BANDS, SMOKING_CODES, SYMPTOM_SYSTEM, VITAL_RANGES
from riskframe.functions.rules import Rules, as_column, flag_sum
from riskframe.operators.prefix import exact_quantiles

#: Distinct labels that a classification may have.
MAX_LABELS = 100_000


def require(df: DataFrame, columns: list[str] | tuple[str, ...]) -> None:
    """Raise an error that lists every missing column."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")


def impute_medians(df: DataFrame, columns: list[str], integers: tuple[str, ...] = ()) -> DataFrame:
    """Replace NULL and NaN by the column's lower median; columns become double, ``integers`` become int."""
    require(df, columns)

    def clean(name: str) -> Column:
        value = F.col(name).cast("double")
        return F.when(F.isnan(value), F.lit(None)).otherwise(value)

    melted = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), clean(c).alias("x")) for c in columns])))
    found = exact_quantiles(melted, ["feature"], "x", {"m": 0.5}, bounded_groups=True)
    medians = found.agg(F.struct(*[F.max(F.when(F.col("feature") == c, F.col("m"))).alias(c) for c in columns]).alias("m"))
    filled = {}
    for name in columns:
        value = F.coalesce(clean(name), medians.scalar().getField(name))
        filled[name] = value.cast("int") if name in integers else value
    return df.withColumns(filled)


def band_columns(df: DataFrame, bands: dict[str, tuple[str, Rules]]) -> DataFrame:
    """Add one label column per entry ``{new column: (input column, rules)}``."""
    require(df, [source for source, _ in bands.values()])
    return df.withColumns({name: rules.on(source) for name, (source, rules) in bands.items()})


def clean_patients(
    df: DataFrame, impute: list[str] | None = None, integers: tuple[str, ...] = ("age",)
) -> DataFrame:
    """Median imputation followed by the age and body-mass bands."""
    impute = impute or ["age", "weight", "height", "bmi"]
    return band_columns(
        impute_medians(df, impute, integers),
        {"age_group": ("age", AGE_BANDS), "bmi_category": ("bmi", BMI_BANDS)},
    )


def fill_constants(df: DataFrame, values: dict[str, object]) -> DataFrame:
    return df.na.fill(values)


def flag_columns(df: DataFrame, exclude: tuple[str, ...] = ("patient_id",)) -> list[str]:
    """Integer columns, which are the 0/1 flags of a flag table."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, IntegerType) and f.name not in exclude]


def valid_flags(df: DataFrame, flags: list[str]) -> DataFrame:
    """Keep 0 and 1; anything else becomes NULL."""
    return df.withColumns({c: F.when(F.col(c).isin(0, 1), F.col(c)).cast("int") for c in flags})


def clean_symptoms(df: DataFrame, flags: list[str] | None = None) -> DataFrame:
    """Domain check of the flags and ``symptom_count``."""
    flags = flags or flag_columns(df)
    return valid_flags(df, flags).withColumn("symptom_count", flag_sum(flags).cast("int"))


def standardize(df: DataFrame, upper: tuple[str, ...] = (), lower: tuple[str, ...] = ()) -> DataFrame:
    """Trim and change case."""
    return df.withColumns(
        {
            **{c: F.upper(F.trim(F.col(c))) for c in upper},
            **{c: F.lower(F.trim(F.col(c))) for c in lower},
        }
    )


def is_filled(value: str | Column) -> Column:
    """True for a text that is neither NULL nor blank."""
    value = as_column(value)
    return F.coalesce(F.length(F.trim(value)) > 0, F.lit(False))


def guarded_ratio(numerator: str | Column, denominator: str | Column, digits: int = 2) -> Column:
    """Ratio rounded half up, by way of eight decimals; NULL unless both are set and the denominator is positive."""
    numerator, denominator = as_column(numerator).cast("double"), as_column(denominator).cast("double")
    ratio = F.try_divide(numerator, denominator).cast("decimal(18,8)")
    return F.when(numerator.isNotNull() & (denominator > 0), F.round(ratio, digits).cast("double"))


def clean_images(df: DataFrame) -> DataFrame:
    """Path flag, standard case and aspect ratio, each for the columns that exist."""
    present = set(df.columns)
    added: dict[str, Column] = {}
    if "image_path" in present:
        added["path_valid"] = is_filled("image_path")
    for name in ("modality", "format"):
        if name in present:
            added[name] = F.upper(F.trim(F.col(name)))
    if "body_part" in present:
        added["body_part"] = F.lower(F.trim(F.col("body_part")))
    if {"width", "height"} <= present:
        added["aspect_ratio"] = guarded_ratio("width", "height")
    return df.withColumns(added)


def prefix_columns(df: DataFrame, prefix: str, keys: tuple[str, ...] = ("patient_id",)) -> DataFrame:
    """Prefix every column but the keys."""
    return df.select(*[F.col(f"`{c}`").alias(c if c in keys else f"{prefix}_{c}") for c in df.columns])


def drop_missing(df: DataFrame, required: list[str]) -> DataFrame:
    require(df, required)
    return df.na.drop(subset=required)


def decode(value: str | Column, labels: dict[int, str], prefix: str = "Class ") -> Column:
    """Label of a class index; an unknown index becomes ``prefix`` plus the index."""
    value = as_column(value)
    entries = [F.lit(item) for pair in labels.items() for item in pair]
    return F.coalesce(F.create_map(*entries)[value.cast("int")], F.concat(F.lit(prefix), value.cast("string")))


def smoking_code(value: str | Column) -> Column:
    return SMOKING_CODES.on(value)


def organ_system_counts(
    df: DataFrame, flags: list[str], key: str = "patient_id", systems: dict[str, str] | None = None
) -> DataFrame:
    """Number of set flags per entity and organ system, one row for every system that has a flag column."""
    systems = SYMPTOM_SYSTEM if systems is None else systems
    groups: dict[str, list[str]] = {}
    for flag in flags:
        if flag in systems:
            groups.setdefault(systems[flag], []).append(flag)
    counts = [
        F.struct(F.lit(system).alias("organ_system"), flag_sum(members).cast("long").alias("n_symptoms"))
        for system, members in sorted(groups.items())
    ]
    return df.select(key, F.inline(F.array(*counts)))


def excerpt(value: str | Column, length: int = 300) -> Column:
    """The first ``length`` characters, followed by dots when text was cut."""
    value = as_column(value)
    return F.when(F.length(value) > length, F.concat(F.substring(value, 1, length), F.lit("..."))).otherwise(value)


def active_flags(flags: list[str] | tuple[str, ...], title: bool = False) -> Column:
    """Array with the names of the flags that are set, in the given order."""
    names = [f.replace("_", " ").title() if title else f for f in flags]
    marks = [F.when(F.col(f) == 1, F.lit(n)) for f, n in zip(flags, names)]
    return F.filter(F.array(*marks), lambda x: x.isNotNull())


def out_of_range(value: str | Column, low: float | Column | None, high: float | Column | None) -> Column:
    """True when the value lies below ``low`` or above ``high``; the edges and NULL are not."""
    value = as_column(value)
    tests = []
    if low is not None:
        tests.append(value < low)
    if high is not None:
        tests.append(value > high)
    return F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False))


def vital_status(df: DataFrame, ranges: dict[str, tuple] = VITAL_RANGES) -> DataFrame:
    """``<vital>_status`` per vital (NULL when not measured) and the array ``abnormal_vitals``."""
    require(df, list(ranges))
    status, marks = {}, []
    for name, (low, high) in ranges.items():
        outside = out_of_range(name, low, high)
        status[f"{name}_status"] = F.when(
            F.col(name).isNotNull(), F.when(outside, F.lit("Abnormal")).otherwise(F.lit("Normal"))
        )
        marks.append(F.when(outside, F.lit(name)))
    return df.withColumns({**status, "abnormal_vitals": F.filter(F.array(*marks), lambda x: x.isNotNull())})


def fahrenheit(celsius: str | Column) -> Column:
    return F.round(as_column(celsius) * F.lit(9.0) / F.lit(5.0) + F.lit(32.0), 1)


def index_labels(df: DataFrame, label: str, name: str = "label_index") -> DataFrame:
    """Alphabetical class index, NULL labels stay NULL. The label set is a size-checked lookup."""
    from riskframe.operators.sizing import lookup_join

    return lookup_join(df, label_dimension(df, label, name), [label], "left")


def label_dimension(df: DataFrame, label: str, name: str = "label_index") -> DataFrame:
    """Distinct labels with their 0-based alphabetical index.

    The position is read from the sorted array of the distinct labels. A column with more than ``MAX_LABELS`` distinct
    values is no class column and an error, so the array stays small.
    """
    if df.select(label).distinct().limit(MAX_LABELS + 1).count() > MAX_LABELS:
        raise ValueError(f"{label} has more than {MAX_LABELS} distinct values")
    classes = df.agg(F.array_sort(F.collect_set(label)).alias("labels"))
    return classes.select(F.posexplode("labels").alias(name, label))
