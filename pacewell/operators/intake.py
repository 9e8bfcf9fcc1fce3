"""Shape checks, coercion and range validation of incoming records."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pacewell.errors import ValidationError
from pacewell.functions.columns import names_where, nan_to_null
from pacewell.functions.validation import broken, rule_conditions, violations
from pacewell.schemas import CRITICAL, OPTIONAL, REQUIRED
from pacewell.settings import PROFILES

PARSE_FAILED = "parse_failed"
# The raw line of a record that is not well-formed, as the CSV scan gives it.
CORRUPT = "_corrupt"


def missing_columns(df: DataFrame, required=REQUIRED) -> list[str]:
    """Required names the frame lacks. Looks at the schema only."""
    return sorted(set(required) - set(df.columns))


def require_columns(df: DataFrame, required=REQUIRED) -> DataFrame:
    missing = missing_columns(df, required)
    if missing:
        raise ValidationError(f"missing required columns: {', '.join(missing)}")
    return df


_TARGETS = {"athlete_id": "string", "record_date": "date",
            **{c: "double" for c in [*CRITICAL, *OPTIONAL]}}


def coerce(df: DataFrame, strict: bool = True) -> DataFrame:
    """Typed record columns; other columns pass through.

    Strict casts fail the job on the first value that does not parse. Lenient
    casts give NULL and name the column in ``parse_failed``. Optional fields
    that are absent become NULL columns. Empty text is a missing value.
    """
    require_columns(df)
    texts = [c for c in _TARGETS if c in df.columns
             and isinstance(df.schema[c].dataType, T.StringType)]
    raw = {c: f"_raw_{c}" for c in texts}
    present = df.withColumns({raw[c]: F.nullif(F.trim(c), F.lit("")) for c in texts})

    def typed(c):
        target = _TARGETS[c]
        if c not in df.columns:
            return F.lit(None).cast(target)
        if target == "string" and c in raw:
            return F.when(F.col(raw[c]).isNotNull(), F.col(c))
        source = F.col(raw.get(c, c))
        return source.cast(target) if strict else source.try_cast(target)

    # One projection per step: each value is parsed once, then looked at.
    out = present.withColumns({c: typed(c) for c in _TARGETS})
    doubles = [c for c in _TARGETS if _TARGETS[c] == "double"]
    nan_free = {c: nan_to_null(F.col(c)) for c in doubles}
    if not strict:
        nan_free[PARSE_FAILED] = names_where({
            c: F.col(raw[c]).isNotNull() & F.col(c).isNull() for c in texts if _TARGETS[c] != "string"})
    return out.withColumns(nan_free).drop(*raw.values())


def _damaged(df: DataFrame) -> Column:
    return F.col(CORRUPT).isNotNull() if CORRUPT in df.columns else F.lit(False)


def with_violations(df: DataFrame, profile: str = "ingest") -> DataFrame:
    """Adds ``violations``: the names of the rules each row breaks, after
    ``damaged_line`` and the columns that did not parse."""
    found = violations(PROFILES[profile])
    if PARSE_FAILED in df.columns:
        unparsed = F.transform(F.col(PARSE_FAILED), lambda c: F.concat(c, F.lit("_unparsed")))
        found = F.when(F.size(PARSE_FAILED) > 0, F.concat(unparsed, found)).otherwise(found)
    if CORRUPT in df.columns:
        found = F.concat(names_where({"damaged_line": _damaged(df)}), found)
    return df.withColumn("violations", found)


def is_bad(df: DataFrame, profile: str = "ingest") -> Column:
    """True for a row that is damaged, did not parse or breaks a rule."""
    bad = broken(PROFILES[profile]) | _damaged(df)
    return bad | (F.size(PARSE_FAILED) > 0) if PARSE_FAILED in df.columns else bad


def violation_counts(df: DataFrame, profile: str = "ingest") -> DataFrame:
    """Rows breaking each rule, zero included: one aggregate, then unpivot."""
    rules = rule_conditions(PROFILES[profile])
    wide = df.agg(*[F.count(F.when(bad, F.lit(1))).alias(n) for n, bad in rules.items()])
    return wide.unpivot([], list(rules), "rule", "n_rows")


def evaluated(df: DataFrame) -> DataFrame:
    """The same rows, whose columns are evaluated before anything that follows.

    A filter moves below projections, and each column it names then is parsed
    again at every mention. It does not move below a generator that makes them.
    """
    return df.select(F.inline(F.array(F.struct("*"))))


def split_valid(df: DataFrame, profile: str = "ingest") -> tuple[DataFrame, DataFrame]:
    """Good and bad rows; only the bad ones get their ``violations``."""
    judged = evaluated(df.withColumn("_is_bad", is_bad(df, profile)))
    good, bad = judged.filter("NOT _is_bad").drop("_is_bad"), judged.filter("_is_bad").drop("_is_bad")
    return good.drop(PARSE_FAILED, CORRUPT), with_violations(bad, profile)


def split_batches(df: DataFrame, by, profile: str = "ingest", few: bool = False) -> tuple[DataFrame, DataFrame]:
    """Rows of the batches that are valid as a whole, and the refused batches.

    A batch is all rows equal in ``by`` (a file, say). One bad row refuses it:
    none of its rows are among the good ones, and it is listed with its number
    of rows, of bad rows and the first violation by name. The verdicts are a
    row per batch; rows are read twice, and only joined with what is refused.
    Give ``few`` where batches are as few as files: then no row is moved for it.
    """
    bad = is_bad(df, profile)
    judged = with_violations(df, profile).withColumn("_bad", bad)
    verdicts = judged.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("_bad").alias("n_bad"),
        F.min(F.when(F.col("_bad"), F.get("violations", 0))).alias("first_violation"))
    refused = verdicts.filter("n_bad > 0")
    names = refused.select(*by)
    good = df.join(F.broadcast(names) if few else names, list(by), "left_anti")
    return good.drop(PARSE_FAILED, CORRUPT), refused


def require_valid(df: DataFrame, profile: str = "ingest") -> DataFrame:
    """Rejects the whole batch if any row is bad.

    Asks for one bad row only, so a bad batch is found without a full pass.
    """
    good, bad = split_valid(df, profile)
    first = bad.select("violations").take(1)
    if first:
        raise ValidationError(f"batch rejected, a row violates {', '.join(first[0][0])}")
    return good


def oversized_groups(df: DataFrame, by, limit: int | None = None) -> DataFrame:
    """Groups (files, batches, athletes) holding more rows than allowed."""
    counted = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.filter(F.lit(False) if limit is None else F.col("n_rows") > limit)


def require_batch_size(df: DataFrame, by, limit: int | None = None) -> DataFrame:
    """Rejects input that is empty, or holds a group above a limit if one is given."""
    if limit is not None:
        over = oversized_groups(df, by, limit).take(1)
        if over:
            raise ValidationError(f"a batch has {over[0]['n_rows']} rows, at most {limit} allowed")
    if not df.take(1):
        raise ValidationError("a batch needs at least one row")
    return df
