"""Table outputs: pairs, skill rows, upserts, reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seamark.functions.clock import parse_request_time
from seamark.functions.rounding import fixed, half_even

# Columns of the skill table and of its extrema form.
SKILL_COLUMNS = (
    "ID NODE obs_water_depth mod_water_depth rmse r bias bias_perc bias_dir central_freq "
    "central_freq_pass_fail pos_outlier_freq pos_outlier_freq_pass_fail neg_outlier_freq "
    "neg_outlier_freq_pass_fail max_duration_pos_outlier max_duration_pos_outlier_pass_fail "
    "max_duration_neg_outlier max_duration_neg_outlier_pass_fail worst_case_outlier_freq "
    "worst_case_outlier_freq_pass_fail bias_standard_dev target_error_range datum Y X start_date end_date"
).split()
_RENAMES = {
    "station_id": "ID",
    "node_id": "NODE",
    "max_pos_hours": "max_duration_pos_outlier",
    "max_pos_hours_pass_fail": "max_duration_pos_outlier_pass_fail",
    "max_neg_hours": "max_duration_neg_outlier",
    "max_neg_hours_pass_fail": "max_duration_neg_outlier_pass_fail",
    "worst_case_freq": "worst_case_outlier_freq",
    "worst_case_freq_pass_fail": "worst_case_outlier_freq_pass_fail",
    "bias_std": "bias_standard_dev",
    "target_error": "target_error_range",
    "lat": "Y",
    "lon": "X",
}
EXTREMA_NAMES = {"timing_rmse": "timing_rmse", "timing_central_freq": "timing_central_freq"}


def skill_table(df: DataFrame) -> DataFrame:
    """Skill rows under the table's column names; absent columns are NULL."""
    named = df.withColumnsRenamed({k: v for k, v in _RENAMES.items() if k in df.columns})
    return named.select(
        *[F.col(c) if c in named.columns else F.lit(None).cast("string").alias(c) for c in SKILL_COLUMNS]
    )


def extrema_table(df: DataFrame, counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Extrema skill rows with timing columns and the three detection counts."""
    return df.join(counts, list(keys), "left")


def write_partitioned(df: DataFrame, path: str, partition: Sequence[str], fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Partitioned output; rows are spread by (partition, time) first so that a
    dominant series becomes several files."""
    spread = [F.col(c) for c in partition]
    if "ts" in df.columns:
        spread.append(F.to_date("ts"))
    writer = df.repartition(*spread).write.mode(mode).partitionBy(*partition)
    (writer.option("header", True) if fmt == "csv" else writer).format(fmt).save(path)


def insert_or_ignore(existing: DataFrame, new: DataFrame, keys: Sequence[str], seq: str | None = None) -> DataFrame:
    """New rows whose key is absent from the table, one per key."""
    from seamark.operators.sequence import keep_first

    fresh = new.join(existing.select(*keys), list(keys), "left_anti")
    return keep_first(fresh, keys, [seq]) if seq else fresh.dropDuplicates(list(keys))


def period_matches(start: Column, end: Column, period: str) -> Column:
    """False for a one-day file loaded as something else than daily, or a 28-31
    day file loaded as something else than monthly; unknown periods pass."""
    days = F.datediff(end, start)
    if period not in ("daily", "monthly"):
        return F.lit(True)
    clash = ((days == 1) & F.lit(period != "daily")) | (days.between(28, 31) & F.lit(period != "monthly"))
    return ~clash


def skill_records(table: DataFrame, *, product: str, kind: str) -> DataFrame:
    """Rows for the long-term store, with parsed period bounds."""
    return table.select(
        F.lit(product).alias("product"),
        F.col("ID").alias("station_id"),
        F.lit(kind).alias("type"),
        parse_request_time(F.col("start_date")).alias("begin_date_time"),
        parse_request_time(F.col("end_date")).alias("end_date_time"),
        *[c for c in table.columns if c not in ("ID", "start_date", "end_date")],
    )


# Failure codes of the model-side datum shift. The texts are ours.
SHIFT_FAILURES = {
    -9999: "model position lies outside the datum grid",
    -9990: "datum file missing: water levels are left unshifted",
    -9991: "model side cannot be converted to the target datum",
    -9992: "position not found in the model station file",
    -9993: "position not found in the model field file",
    -9994: "conversion file missing",
}
STATUS_FAILURES = {
    "RANGE": "observation lies outside the datum grid",
    "UNKNOWN": "observation side cannot be converted to the target datum",
}


def datum_report(model: DataFrame, stations: DataFrame, *, target: str, key: str = "station_id") -> DataFrame:
    """Offsets of both sides per station, pass / fail / NA and the reasons.

    ``model`` has (key, model_offset); ``stations`` has (key, source, datum,
    datum_shift, shift_status).
    """
    j = model.join(stations, key, "left")
    off = F.col("model_offset")
    obs_ok = F.col("datum_shift").isNotNull()
    state = (
        F.when(off.isNull(), "NA").when(obs_ok & (off > -999), "pass").otherwise("fail")
    )
    reasons = [F.when(F.col("shift_status") == s, F.lit(t)) for s, t in STATUS_FAILURES.items()]
    reasons += [F.when(off == c, F.lit(t)) for c, t in SHIFT_FAILURES.items()]
    why = (
        F.when(state == "NA", F.lit("no station output of the model to shift"))
        .when(state == "fail", F.concat_ws("; ", *reasons))
        .otherwise(F.lit(""))
    )
    return j.select(
        key,
        "source",
        F.lit(target).alias("target_datum"),
        half_even(off, 2).alias("model_offset"),
        F.col("datum").alias("obs_datum"),
        F.coalesce(F.col("datum_shift"), F.when(state == "fail", F.lit(0.0))).alias("obs_offset"),
        state.alias("conversion"),
        why.alias("reason"),
    )


def time_file_key(df: DataFrame, *, ts: str = "ts", file: str = "file") -> DataFrame:
    """Which file supplied each time (the last one on overlap)."""
    return df.groupBy(ts).agg(F.max(file).alias(file))


def frame_table(stats: DataFrame) -> DataFrame:
    """Per-frame statistics under report headings (outlier columns correctly named)."""
    return stats.select(
        F.col("ts").alias("Date"),
        F.col("obs_mean").alias("Obs mean"),
        F.col("obs_std").alias("Obs std"),
        F.col("model_mean").alias("Model mean"),
        F.col("model_std").alias("Model std"),
        F.col("bias").alias("Bias"),
        F.col("bias_std").alias("Bias std"),
        F.col("r").alias("R"),
        F.col("rmse").alias("RMSE"),
        F.col("central_freq").alias("Central frequency"),
        F.col("pos_outlier_freq").alias("Positive outlier freq"),
        F.col("neg_outlier_freq").alias("Negative outlier freq"),
    )


# Headings of the constituent table.
CONSTITUENT_COLUMNS = "N Constituent Ref_Amp Ref_Phase Model_Amp Model_Phase Amp_Diff Phase_Diff Vector_Diff".split()


def constituent_rows(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Constituent table as text: amplitudes with four decimals, phases with one, NULL empty."""
    def text(c: str) -> Column:
        digits = 1 if c.endswith("phase") or c == "phase_diff" else 4
        return F.coalesce(fixed(F.col(c), digits), F.lit("")).alias(c)

    shown = ("ref_amp", "ref_phase", "model_amp", "model_phase", "amp_diff", "phase_diff", "vector_diff")
    return table.select(*keys, "n", "constituent", *map(text, shown))


def constituent_file(
    table: DataFrame, keys: Sequence[str], *, station: str = "station_id", stats: DataFrame | None = None, metadata: dict[str, str] | None = None
) -> DataFrame:
    """Lines of each constituent file: (keys, part, n, line), to be ordered by part and n.

    Part 0 holds ``#`` comments with the station and ``metadata`` and the headings, part 1 the constituents in
    their order, part 2 an empty line and one comment for each column of ``stats`` (one row a key):
    six decimals for fractions, whole numbers as they are, ``nan`` for NULL.
    """
    def numbered(df: DataFrame, part: int, lines: Sequence[Column]) -> DataFrame:
        return df.select(*keys, F.lit(part).alias("part"), F.posexplode(F.array(*lines)).alias("n", "line"))

    facts = [F.lit(f"# {k}: {v}") for k, v in (metadata or {}).items()]
    head = [F.concat(F.lit("# Station: "), F.col(station).cast("string")), *facts, F.lit(",".join(CONSTITUENT_COLUMNS))]
    rows = constituent_rows(table, keys)
    body = rows.select(*keys, F.lit(1).alias("part"), F.col("n").cast("int").alias("n"), F.concat_ws(",", *[F.col(c).cast("string") for c in rows.columns if c not in keys]).alias("line"))
    out = numbered(table.select(*keys).distinct(), 0, head).unionByName(body)
    if stats is None:
        return out

    def shown(c: str, kind: str) -> Column:
        value = fixed(F.col(c), 6) if kind in ("double", "float") else F.col(c).cast("string")
        return F.concat(F.lit(f"# {c}: "), F.when(F.col(c).isNull(), F.lit("nan")).otherwise(value))

    foot = [shown(c, kind) for c, kind in stats.dtypes if c not in keys]
    return out.unionByName(numbered(stats, 2, [F.lit(""), *foot]))
