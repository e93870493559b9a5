"""The preprocessing run as a chain of DataFrame steps.

Order is semantics: fences are fit on data that still has NULLs, medians on
clipped data, correlations on imputed data. Each fit is one aggregate whose
result (a few numbers per column) comes back to the driver; everything else
stays a lazy plan. Stage boundaries that later steps re-read many times are
written to the checkpoint folder, so a lost executor costs one stage, not
the whole lineage.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tabmill.functions.quantiles import column_medians, column_quantiles
from tabmill.functions.exprs import hash_uniform
from tabmill.operators import clean, profile, select, split
from tabmill.session import materialize
from tabmill.sources.assay import ASSAY_SPEC, assay
from tabmill.spec import TableSpec

CORR_THRESHOLD = 0.8      # fixed value: absolute Pearson r above which a later feature goes
VARIANCE_THRESHOLD = 0.01  # fixed value: population variance a feature must exceed


@dataclass
class Preprocessed:
    table: DataFrame
    spec: TableSpec
    fences: profile.Fences
    medians: clean.Medians
    floor_counts: dict[str, int]
    corr_dropped: list[str]
    kept: list[str]
    log_targets: list[str] = field(default_factory=list)
    info_before: DataFrame | None = None
    deduped: DataFrame | None = None


def stage_dedup(df: DataFrame) -> DataFrame:
    return clean.dedup_rows(df)


def stage_clip(df: DataFrame, spec: TableSpec):
    return clean.clip_iqr(df, spec.targets)


def stage_impute(df: DataFrame, spec: TableSpec):
    cols = [c for c in clean.numeric_columns(df) if c != spec.id]
    out, med = clean.impute_median(df, cols)
    strings = [c for c in clean.string_columns(df) if c != spec.id]
    if strings:
        out, _ = clean.impute_mode(out, strings)
    return out, med


def fit_part(df: DataFrame, spec: TableSpec, fit_on: str) -> DataFrame:
    """The rows that statistics are fit on: the train side of the hash holdout, or all."""
    if fit_on == "all":
        return df
    if fit_on != "train":
        raise ValueError("fit_on is 'train' or 'all'")
    return df.where(hash_uniform(spec.id, split.SEED) >= split.TEST_FRACTION)


def stage_clip_impute(df: DataFrame, spec: TableSpec, fit_on: str = "all"):
    """Clip the targets to IQR fences, then fill NULLs with medians of the
    clipped table, with one exact-quantile fit for both.

    Clipping is monotone and leaves values inside the fences alone. For
    n >= 3 the two order statistics the median interpolates between lie in
    [Q1, Q3], inside the fences, so the median of the clipped column equals
    the median of the unclipped one; only columns with fewer than 3 values
    need a second fit on the clipped table."""
    num = [c for c in clean.numeric_columns(df) if c != spec.id]
    qs, sizes = column_quantiles(fit_part(df, spec, fit_on), num, [0.25, 0.5, 0.75], with_sizes=True)
    bounds = {}
    for t in spec.targets:
        q1, q3 = qs[t][0.25], qs[t][0.75]
        if q1 is not None:
            iqr = q3 - q1
            bounds[t] = (q1, q3, q1 - profile.IQR_FACTOR * iqr, q3 + profile.IQR_FACTOR * iqr)
    fences = profile.Fences(bounds)
    clipped = clean.apply_clip(df, fences)
    med = {c: qs[c][0.5] for c in num}
    few = [t for t in spec.targets if t in med and 0 < sizes[t] < 3]
    if few:
        med.update(column_medians(fit_part(clipped, spec, fit_on), few))
    medians = clean.Medians(med)
    out = clean.apply_medians(clipped, medians)
    strings = [c for c in clean.string_columns(out) if c != spec.id]
    if strings:
        out = clean.apply_modes(out, clean.fit_modes(fit_part(out, spec, fit_on), strings))
    return out, fences, medians


def stage_floor(df: DataFrame, spec: TableSpec):
    return clean.floor_positive(df, spec.targets)


def stage_log(df: DataFrame, spec: TableSpec) -> DataFrame:
    return clean.log_targets(df, spec.targets)


def logged_stage(df: DataFrame, spec: TableSpec, cut_lineage: bool = True,
                 profile_before: bool = False, fit_on: str = "all"):
    """dedup -> clip targets -> impute -> floor -> log. The deduplicated
    table is written once (every fit below re-reads it, not the sources);
    the logged table too, as selection and the tasks read it many times.
    With ``profile_before`` the returned tuple ends with the "before"
    profile row, computed on the written deduplicated table."""
    df = stage_dedup(df)
    if cut_lineage:
        df = materialize(df, "dedup")
    deduped = df
    df, fences, medians = stage_clip_impute(df, spec, fit_on)
    # the before profile's fences are the clip fences: same table, same fit
    info = (profile.profile_info(deduped, "before", spec.targets, fences=fences if fit_on == "all" else None), deduped) \
        if profile_before else None
    df, floors = stage_floor(df, spec)
    df = stage_log(df, spec)
    if cut_lineage:
        df = materialize(df, "logged")
    if profile_before:
        return df, fences, medians, floors, info
    return df, fences, medians, floors


def preprocess(df: DataFrame, spec: TableSpec, corr_threshold: float = CORR_THRESHOLD,
               var_threshold: float = VARIANCE_THRESHOLD, cut_lineage: bool = True,
               profile_before: bool = False, fit_on: str = "train") -> Preprocessed:
    """dedup -> clip targets -> impute -> floor -> log -> correlation drop
    -> variance filter. Returns the cleaned table and every fitted value
    (and, with ``profile_before``, the profile row of the deduplicated
    input)."""
    staged = logged_stage(df, spec, cut_lineage, profile_before, fit_on)
    df, fences, medians, floors = staged[:4]
    info, deduped = staged[4] if profile_before else (None, None)
    logs = [f"log_{t}" for t in spec.targets]
    feats = [c for c in spec.features if c in df.columns]
    fit = fit_part(df, spec, fit_on)
    dropped = select.corr_drop_list(fit, feats, corr_threshold)
    kept_corr = [c for c in feats if c not in set(dropped)]
    kept = select.variance_keep(fit, kept_corr, var_threshold)
    if not kept:
        raise ValueError("no features left after variance filtering")
    out = df.select(spec.id, *kept, *spec.targets, *logs)
    return Preprocessed(out, TableSpec(spec.id, spec.targets + logs, kept), fences,
                        medians, floors, dropped, kept, logs, info, deduped)


def assay_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assay(spark, sf_dir)


def assay_processed(spark: SparkSession, sf_dir: str, cut_lineage: bool = False) -> Preprocessed:
    return preprocess(assay(spark, sf_dir), ASSAY_SPEC, cut_lineage=cut_lineage)
