"""Gap, coverage and priority reports: which samples and labels to work on next.

Tables keyed by field group are tiny (the groups are a closed set) and reach the big tables by
broadcast after a row check.  Lists that grow with the data (case ids of a sample, entries of a
group) stay rows; only the sink nests what is bounded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom import constants as K
from paperloom.functions.predicates import field_group, is_accepted, with_nfc
from paperloom.functions.text import literal_array, nonempty, present
from paperloom.operators.evaluate import rollup
from paperloom.session import broadcast_if_small, with_index


def _known(col: Column) -> Column:
    return F.coalesce(nonempty(col), F.lit(K.UNKNOWN))


# --- counts --------------------------------------------------------------------

def counts_by(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(_known(F.col(key)).alias(key)).agg(F.count(F.lit(1)).alias("rows"))


def unique_sources_by(df: DataFrame, key: str) -> DataFrame:
    pairs = df.select(_known(F.col(key)).alias(key), _known(F.col("source_path")).alias("source")).distinct()
    return pairs.groupBy(key).agg(F.count(F.lit(1)).alias("sources"))


def group_accuracy(metrics: DataFrame) -> DataFrame:
    """Weighted accuracy per field group, rounded for the report; groups without comparisons drop out."""
    rolled = rollup(metrics).filter("level = 'field_group' AND comparisons > 0")
    return rolled.select(
        F.col("key").alias("field_group"), "comparisons",
        *[F.round(r, 4).alias(r) for r in ("exact_match_rate", "average_character_error_rate", "average_word_error_rate")],
    )


# --- gap report -----------------------------------------------------------------

def crop_counts(manifest: DataFrame) -> DataFrame:
    """Crops and distinct sources per (field group, split, document type, verdict).

    The only step of the gap report that touches the manifest: distinct sources first, so the
    shuffle is spread by source, then a table of a few dozen rows.
    """
    per_source = manifest.groupBy(
        "field_group", "split", _known(F.col("document_type")).alias("document_type"),
        is_accepted(F.col("quality.accepted")).alias("accepted"), _known(F.col("source_path")).alias("source"),
    ).agg(F.count(F.lit(1)).alias("crops"))
    return per_source.groupBy("field_group", "split", "document_type", "accepted").agg(
        F.sum("crops").alias("crops"), F.count(F.lit(1)).alias("sources")
    )


def missing_types(counts: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """Per field group the known document types without an accepted train or val crop.

    ``counts`` as of :func:`crop_counts`; the window runs over that table of a few dozen rows.
    """
    everything = Window.partitionBy(F.lit(1))
    known = F.when(F.col("accepted") & (F.col("document_type") != K.UNKNOWN), F.col("document_type"))
    rows = counts.select("field_group", "split", "document_type", "accepted")
    if groups is not None:
        rows = rows.unionByName(groups.select("field_group"), allowMissingColumns=True)
    typed = rows.withColumn("all_types", F.collect_set(known).over(everything))
    seen = lambda split: F.collect_set(
        F.when(F.col("accepted") & (F.col("split") == split), F.col("document_type"))
    )
    return typed.filter("field_group IS NOT NULL AND field_group <> ''").groupBy("field_group", "all_types").agg(
        seen(K.TRAIN).alias("train"), seen(K.VAL).alias("val")
    ).select(
        "field_group",
        F.array_sort(F.array_except("all_types", "train")).alias("missing_train_types"),
        F.array_sort(F.array_except("all_types", "val")).alias("missing_val_types"),
    )


def gap_scores(manifest: DataFrame, profiles: DataFrame | None = None, accuracy: DataFrame | None = None) -> DataFrame:
    """Need of new samples per field group.

    ``profiles`` as of ``curate.readiness(...)`` or ``sources.training_profiles(...)``, ``accuracy``
    as of :func:`group_accuracy`; a group named by any of the three gets a row.  Sources are summed
    over document types: one source under two types counts twice here.
    """
    counts = crop_counts(manifest)
    ok, train, val = F.col("accepted"), F.col("split") == K.TRAIN, F.col("split") == K.VAL
    total = lambda test, what: F.coalesce(F.sum(F.when(test, F.col(what))), F.lit(0)).cast("bigint")
    base = counts.filter("field_group IS NOT NULL AND field_group <> ''").groupBy("field_group").agg(
        total(ok & train, "crops").alias("base_train_count"), total(ok & val, "crops").alias("base_val_count"),
        total(ok & train, "sources").alias("base_train_source_count"), total(ok & val, "sources").alias("base_val_source_count"),
        total(~ok, "crops").alias("rejected_count"),
    )
    named = base.select("field_group")
    for other in (profiles, accuracy):
        if other is not None:
            named = named.unionByName(other.select("field_group"))
    named = named.distinct()
    joined = named.join(base, "field_group", "left").join(missing_types(counts, named), "field_group", "left")
    if accuracy is not None:
        joined = joined.join(accuracy, "field_group", "left")
    else:
        joined = joined.withColumns({
            r: F.lit(None).cast("double")
            for r in ("exact_match_rate", "average_character_error_rate", "average_word_error_rate")
        })
    extra = {
        "filtered_hard_case_train_count": "bigint", "train_hard_count": "bigint", "unique_hard_case_variant_count": "bigint",
        "training_readiness_status": "string", "blocking_warnings": "array<string>",
    }
    if profiles is not None:
        joined = joined.join(profiles.select("field_group", *[c for c in extra if c in profiles.columns]), "field_group", "left")
    joined = joined.withColumns({c: F.lit(None).cast(t) for c, t in extra.items() if c not in joined.columns})
    counted = {
        c: F.coalesce(c, F.lit(0)).cast("bigint")
        for c in ("base_train_count", "base_val_count", "base_train_source_count", "base_val_source_count", "rejected_count")
    }
    rows = joined.withColumns(counted)
    part = lambda target, have, weight: F.greatest(F.lit(0), F.lit(target) - F.col(have)) * F.lit(weight)
    accuracy_gap = (
        (1 - F.col("exact_match_rate")) * 10 + F.col("average_character_error_rate") * 5
        + F.col("average_word_error_rate") * 2
    )
    rows = rows.withColumns({
        "train_gap": part(K.MIN_TRAIN, "base_train_count", K.TRAIN_WEIGHT),
        "val_gap": part(K.MIN_VAL, "base_val_count", K.VAL_WEIGHT),
        "train_source_gap": part(K.MIN_TRAIN_SOURCES, "base_train_source_count", K.TRAIN_SOURCE_WEIGHT),
        "val_source_gap": part(K.MIN_VAL_SOURCES, "base_val_source_count", K.VAL_SOURCE_WEIGHT),
        "document_gap": F.size("missing_train_types") + F.size("missing_val_types") * 0.5,
        "rejected_gap": F.col("rejected_count") * 0.25,
        "raw_accuracy_gap": F.coalesce(accuracy_gap, F.lit(0.0)),
    })
    gaps = [F.col(c) for c in ("train_gap", "val_gap", "train_source_gap", "val_source_gap", "document_gap", "rejected_gap")]
    score = F.col("raw_accuracy_gap")
    for gap in gaps:
        score = score + gap
    return rows.withColumns({"accuracy_gap": F.round("raw_accuracy_gap", 4), "priority_score": F.round(score, 4)}).drop(
        "raw_accuracy_gap"
    )


def gap_recommendations(scores: DataFrame) -> DataFrame:
    """Add the ordered recommendations of each field group."""
    inaccurate = F.coalesce(
        (F.col("exact_match_rate") < 0.9) | (F.col("average_character_error_rate") > 0.05), F.lit(False)
    )
    return scores.withColumn("recommendations", present(
        (F.col("train_gap") > 0, "collect_base_train_samples"),
        (F.col("val_gap") > 0, "collect_base_val_samples"),
        (F.size("missing_train_types") > 0, "expand_train_document_coverage"),
        (F.size("missing_val_types") > 0, "expand_val_document_coverage"),
        (F.col("train_source_gap") > 0, "collect_distinct_train_sources"),
        (F.col("val_source_gap") > 0, "collect_distinct_val_sources"),
        (F.col("rejected_count") > 0, "review_rejected_field_crops"),
        (inaccurate, "prioritize_low_accuracy_group"),
        (F.coalesce("filtered_hard_case_train_count", F.lit(0)) > 0, "add_base_samples_before_more_hard_cases"),
        (
            (F.coalesce("train_hard_count", F.lit(0)) > 0) & (F.coalesce("unique_hard_case_variant_count", F.lit(0)) < 2),
            "expand_hard_case_variant_coverage",
        ),
    ))


def rank_gaps(scores: DataFrame) -> DataFrame:
    """Number the field groups by need; one row per group, so one small window."""
    order = Window.partitionBy(F.lit(1)).orderBy(F.desc("priority_score"), "base_train_count", "field_group")
    return scores.withColumn("rank", F.row_number().over(order))


# --- rejected crops -----------------------------------------------------------------

def review_actions(flags: Column) -> Column:
    has = lambda *names: F.arrays_overlap(F.coalesce(flags, F.array().cast("array<string>")), literal_array(names))
    actions = present(
        (has("dense_edge_content"), "inspect_seal_or_noise_overlap"),
        (has("foreground_fills_crop"), "tighten_region_box_or_verify_template"),
        (has("low_dark_ratio", "low_contrast"), "check_blank_or_faint_text_crop"),
        (has("too_narrow", "too_short"), "review_region_box_size"),
    )
    return F.when(F.size(actions) > 0, actions).otherwise(literal_array(["review_crop_quality"]))


def rejected_entries(manifest: DataFrame) -> DataFrame:
    """Rejected crops with what to do about each."""
    rows = manifest.filter(~is_accepted(F.col("quality.accepted")))
    return rows.select(
        _known(F.col("field_group")).alias("field_group"), "document_type", "case_id", "field_name", "split", "crop_path",
        "source_path", F.col("quality.quality_flags").alias("quality_flags"),
        review_actions(F.col("quality.quality_flags")).alias("review_actions"),
    )


def rejected_report(manifest: DataFrame, gaps: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(groups, entries): group totals with their gap score in report order, and the sorted entries.

    Entries are left as globally sorted rows: a group may hold most rejected crops.
    """
    entries = rejected_entries(manifest)
    kinds = entries.groupBy("field_group", _known(F.col("document_type")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    per_type = kinds.groupBy("field_group").agg(
        F.sum("n").alias("rejected_count"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("kind", "n")))).alias("counts_by_document_type"),
    )
    flagged = entries.select("field_group", F.explode("quality_flags").alias("flag")).groupBy("field_group", "flag").agg(
        F.count(F.lit(1)).alias("n")
    ).groupBy("field_group").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("flag", "n")))).alias("quality_flag_counts")
    )
    groups = per_type.join(flagged, "field_group", "left")
    if gaps is not None:
        groups = groups.join(gaps.select("field_group", "priority_score", "recommendations"), "field_group", "left")
    else:
        groups = groups.withColumns({
            "priority_score": F.lit(None).cast("double"), "recommendations": F.lit(None).cast("array<string>"),
        })
    groups = groups.withColumn("recommendations", F.coalesce("recommendations", F.array().cast("array<string>")))
    order = Window.partitionBy(F.lit(1)).orderBy(
        F.desc(F.coalesce("priority_score", F.lit(-1.0))), F.desc("rejected_count"), "field_group"
    )
    return groups.withColumn("rank", F.row_number().over(order)), entries.orderBy(
        "field_group", F.coalesce("document_type", F.lit("")), F.coalesce("case_id", F.lit("")), F.coalesce("field_name", F.lit(""))
    )


# --- sample coverage -------------------------------------------------------------------

def coverage_links(labels: DataFrame, expected: DataFrame) -> DataFrame:
    """Distinct (sample key, kind, case id, document type) rows tying samples to labels and cases.

    ``labels``: ``source_path``, ``case_id``, ``document_type``, ``pending``.  Kinds: ``label``,
    ``pending``, ``eval`` (a reviewed label whose case is also an expected case).
    """
    complete = labels.filter(
        (F.coalesce("source_path", F.lit("")) != "") & (F.coalesce("case_id", F.lit("")) != "")
        & (F.coalesce("document_type", F.lit("")) != "")
    )
    keyed = with_nfc(complete, "source_path", "sample_key").select("sample_key", "case_id", "document_type", "pending")
    known = expected.select("case_id").filter("case_id IS NOT NULL").distinct().withColumn("known", F.lit(True))
    kinds = F.when(F.col("pending"), F.array(F.lit("pending"))).when(
        F.col("known"), F.array(F.lit("label"), F.lit("eval"))).otherwise(F.array(F.lit("label")))
    return keyed.join(known, "case_id", "left").select(
        "sample_key", F.explode(kinds).alias("kind"), "case_id", "document_type"
    ).distinct()


def coverage(files: DataFrame, labels: DataFrame, expected: DataFrame, samples: DataFrame | None = None) -> DataFrame:
    """One row per sample file: what labels and cases cover it, and what the curated list says.

    Case ids are counted, not listed, since one paper may carry very many labels; the list is
    :func:`coverage_links`.
    """
    links = coverage_links(labels, expected)
    cases = links.select("sample_key", "kind", "case_id").distinct()
    count = lambda kind: F.count_if(F.col("kind") == kind)
    per_sample = cases.groupBy("sample_key").agg(
        count("label").alias("label_cases"), count("pending").alias("pending_cases"), count("eval").alias("eval_cases")
    )
    kinds = links.filter("kind = 'label'").groupBy("sample_key").agg(
        F.array_sort(F.collect_set("document_type")).alias("document_types")  # a closed set of types
    )
    keyed = with_nfc(files.select("path"), "path", "sample_key").select("sample_key")
    joined = keyed.join(per_sample, "sample_key", "left").join(kinds, "sample_key", "left")
    if samples is not None:
        listed = with_nfc(samples, "source", "sample_key").select(
            "sample_key", F.lit(True).alias("listed"), F.col("document_type").alias("sample_dataset_document_type"),
            F.col("case_id").alias("sample_dataset_case_id"), F.col("split").alias("sample_dataset_split"),
        )
        joined = joined.join(listed, "sample_key", "left")
    else:
        joined = joined.withColumns({
            "listed": F.lit(None).cast("boolean"), "sample_dataset_document_type": F.lit(None).cast("string"),
            "sample_dataset_case_id": F.lit(None).cast("string"), "sample_dataset_split": F.lit(None).cast("string"),
        })
    zero = lambda c: F.coalesce(c, F.lit(0))
    return joined.select(
        F.col("sample_key").alias("sample_path"), (zero("label_cases") > 0).alias("covered_by_labeled"),
        (zero("pending_cases") > 0).alias("pending_review"), (zero("eval_cases") > 0).alias("covered_by_eval"),
        zero("label_cases").alias("label_cases"), zero("pending_cases").alias("pending_cases"), zero("eval_cases").alias("eval_cases"),
        F.coalesce("document_types", F.array().cast("array<string>")).alias("document_types"),
        F.coalesce("listed", F.lit(False)).alias("known_to_sample_dataset"),
        "sample_dataset_document_type", "sample_dataset_case_id", "sample_dataset_split",
    )


def coverage_totals(covered: DataFrame) -> DataFrame:
    return covered.agg(
        F.count(F.lit(1)).alias("sample_file_count"), F.count_if("covered_by_labeled").alias("covered_by_labeled_count"),
        F.count_if("pending_review").alias("covered_by_pending_review_count"),
        F.count_if("covered_by_eval").alias("covered_by_eval_count"),
        F.count_if(~F.col("covered_by_labeled")).alias("uncovered_count"),
    )


def labels_without_eval(labels: DataFrame, expected: DataFrame) -> DataFrame:
    """Reviewed case ids that have no expected case."""
    reviewed = labels.filter(
        ~F.col("pending") & (F.coalesce("source_path", F.lit("")) != "") & (F.coalesce("case_id", F.lit("")) != "")
        & (F.coalesce("document_type", F.lit("")) != "")
    )
    return reviewed.select("case_id").distinct().join(expected.select("case_id"), "case_id", "left_anti")


def type_groups(labels: DataFrame) -> DataFrame:
    """Field groups seen in the reviewed labels of each document type; both are closed sets."""
    usable = labels.filter(~F.col("pending") & (F.coalesce("document_type", F.lit("")) != "") & (F.size("expected_fields") > 0))
    groups = F.array_distinct(F.transform(F.map_keys("expected_fields"), field_group))
    return usable.select("document_type", F.explode(groups).alias("field_group")).distinct()


# --- worklists ---------------------------------------------------------------------------

def merge_recommendations(matched: DataFrame, keys: list[str]) -> DataFrame:
    """Join the recommendation lists of the matched groups by falling need, first mention kept.

    At most one row per (key, field group), so the gathered list is short.
    """
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("priority_score")).alias("need"), "field_group", "recommendations")))
    return matched.groupBy(*keys).agg(ordered.alias("ordered")).select(
        *keys, F.array_distinct(F.flatten(F.transform("ordered", lambda g: g["recommendations"]))).alias("recommendations")
    )


def sample_priority(covered: DataFrame, gaps: DataFrame, groups: DataFrame) -> DataFrame:
    """Ranked samples without a reviewed label.

    What a sample gains depends only on its document type and split, so the sums are made once per
    (type, split) - a few rows - and reach the samples by one small join.  ``groups`` as of
    :func:`type_groups`, ``gaps`` with scores, gap parts, recommendations and readiness.
    """
    open_ = covered.filter(~F.col("covered_by_labeled"))
    matched = groups.join(gaps, "field_group").withColumn("split_key", F.explode(literal_array([K.TRAIN, K.VAL, ""])))
    in_train, in_val = F.col("split_key") == K.TRAIN, F.col("split_key") == K.VAL
    blocked = F.coalesce(F.col("training_readiness_status") == "blocked", F.lit(False))
    warned = lambda name: F.coalesce(F.array_contains("blocking_warnings", name), F.lit(False))
    split_gap = F.when(in_train, F.col("train_gap") + F.col("train_source_gap")).when(
        in_val, F.col("val_gap") + F.col("val_source_gap")
    ).otherwise(0.0)
    stuck = (in_train & warned("no_train_samples")) | (in_val & warned("no_val_samples"))
    named = F.struct((-F.col("priority_score")).alias("need"), "field_group", "recommendations", blocked.alias("blocked"))
    gains = matched.groupBy("document_type", "split_key").agg(
        F.round(F.sum("priority_score"), 4).alias("gap_score"), (F.count_if(blocked) * 5.0).alias("blocked_boost"),
        F.round(F.sum(split_gap), 4).alias("split_gap_boost"), (F.count_if(stuck) * 5.0).alias("blocking_split_boost"),
        F.array_sort(F.collect_list(named)).alias("ordered"),
    )
    gains = broadcast_if_small(gains.withColumnRenamed("document_type", "gain_type"))
    split_key = F.when(F.col("sample_dataset_split").isin(K.TRAIN, K.VAL), F.col("sample_dataset_split")).otherwise("")
    joined = open_.withColumn("__split", split_key).join(
        gains, (F.col("sample_dataset_document_type") == F.col("gain_type")) & (F.col("__split") == F.col("split_key")), "left"
    )
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    rows = F.coalesce("ordered", F.array().cast(
        "array<struct<need:double,field_group:string,recommendations:array<string>,blocked:boolean>>"
    ))
    scored = joined.withColumn("matched", rows).withColumn("queue_ready_boost", F.when(F.col("pending_review"), 1.0).otherwise(0.0))
    is_blocked = F.exists("matched", lambda g: g["blocked"])
    first = F.array(F.when(F.col("pending_review"), "review_pending_label").otherwise("bootstrap_label_scaffold"))
    second = F.when(is_blocked, literal_array(["unblock_recognizer_training"])).otherwise(literal_array([]))
    merged = F.flatten(F.transform("matched", lambda g: g["recommendations"]))
    boosts = ("gap_score", "blocked_boost", "split_gap_boost", "blocking_split_boost", "queue_ready_boost")
    total = zero(boosts[0])
    for boost in boosts[1:]:
        total = total + zero(boost)
    return scored.select(
        "sample_path", F.col("sample_dataset_case_id").alias("case_id"), F.col("sample_dataset_document_type").alias("document_type"),
        "sample_dataset_split", F.when(F.col("pending_review"), "pending_review").otherwise("unbootstrapped").alias("status"),
        F.transform("matched", lambda g: g["field_group"]).alias("matched_field_groups"),
        F.transform(F.filter("matched", lambda g: g["blocked"]), lambda g: g["field_group"]).alias("blocked_field_groups"),
        *[zero(b).alias(b) for b in boosts], F.round(total, 4).alias("priority_score"),
        F.array_distinct(F.concat(first, second, merged)).alias("recommendations"),
    )


def ranked_samples(priorities: DataFrame) -> DataFrame:
    """Number the samples by need, pending first, then path; numbered without a single big task."""
    keyed = priorities.withColumns({
        "__need": -F.col("priority_score"), "__order": F.when(F.col("status") == "pending_review", 0).otherwise(1)
    })
    return with_index(keyed, [], ["__need", "__order", "sample_path"], "rank").drop("__need", "__order").withColumn(
        "rank", F.col("rank") + 1
    )


def queue_priority(cases: DataFrame, docs: DataFrame, gaps: DataFrame, labels: DataFrame) -> DataFrame:
    """Worth of reviewing each queued case that has no reviewed label of any of its types.

    ``cases``: ``case_id``, ``status``, ``finding_count``; ``docs``: ``case_id``, ``document_type``,
    ``fields``.  Field groups are found per paper and reduced to a set of at most four per case
    before anything is joined.
    """
    listed = labels.filter(~F.col("pending")).select("case_id", "document_type")
    reviewed = docs.select("case_id", "document_type").join(listed, ["case_id", "document_type"], "left_semi").select("case_id")
    groups = docs.select(
        "case_id", F.explode(F.array_distinct(F.transform(F.map_keys("fields"), field_group))).alias("field_group")
    ).distinct()
    small = broadcast_if_small(gaps.select("field_group", "priority_score", "recommendations"))
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("priority_score")).alias("need"), "field_group", "recommendations")))
    matched = groups.join(small, "field_group").groupBy("case_id").agg(
        F.round(F.sum("priority_score"), 4).alias("gap_score"), ordered.alias("ordered")
    )
    with_docs = docs.select("case_id").distinct()
    rows = cases.join(with_docs, "case_id", "left_semi").join(reviewed, "case_id", "left_anti").join(matched, "case_id", "left")
    empty = F.array().cast("array<struct<need:double,field_group:string,recommendations:array<string>>>")
    status = F.when(F.col("status") == K.REJECT, 2.0).when(F.col("status") == K.NEEDS_REVIEW, 1.0).otherwise(0.0)
    scored = rows.withColumns({
        "gap_score": F.coalesce("gap_score", F.lit(0.0)), "ordered": F.coalesce("ordered", empty),
        "status_boost": status, "findings_boost": F.least(F.col("finding_count"), F.lit(5)) * 0.5,
    })
    return scored.select(
        "case_id", "status", "gap_score", "status_boost", "findings_boost",
        F.round(F.col("gap_score") + F.col("status_boost") + F.col("findings_boost"), 4).alias("priority_score"),
        F.transform("ordered", lambda g: g["field_group"]).alias("matched_field_groups"),
        F.array_distinct(F.flatten(F.transform("ordered", lambda g: g["recommendations"]))).alias("recommendations"),
    )


def ranked_queue(priorities: DataFrame, limit: int | None = None) -> DataFrame:
    """Ranks from 1, the neediest case first; with ``limit``, a top-k that neither sorts nor writes the rest."""
    keyed = priorities.withColumn("__need", -F.col("priority_score"))
    if limit is not None:
        best = keyed.orderBy("__need", "case_id").limit(limit)
        place = F.row_number().over(Window.orderBy("__need", "case_id"))  # ``limit`` rows at most
        return best.withColumn("rank", place.cast("bigint")).drop("__need")
    return with_index(keyed, [], ["__need", "case_id"], "rank").drop("__need").withColumn("rank", F.col("rank") + 1)


# --- scaffolds ---------------------------------------------------------------------------

def without_existing(new: DataFrame, existing: DataFrame, keys: list[str], overwrite: bool = False) -> DataFrame:
    """Rows to write: those whose key is not there yet, or all of them when overwriting."""
    return new if overwrite else new.join(existing.select(*keys), keys, "left_anti")


def promote(
    cases: DataFrame, docs: DataFrame, existing: DataFrame, priority: DataFrame | None = None, limit: int | None = None,
    case_ids: list[str] | None = None, overwrite: bool = False,
) -> DataFrame:
    """Label scaffolds for queued cases, best ranked first, at most ``limit`` cases that write something.

    ``priority`` as of :func:`ranked_queue`.  Existing labels are removed before the limit, which is
    a top-k over cases.
    """
    wanted = docs if not case_ids else docs.filter(F.col("case_id").isin(*case_ids))
    fresh = without_existing(wanted, existing, ["case_id", "document_type"], overwrite)
    context = F.struct("priority_score", "status", "matched_field_groups", "recommendations")
    if priority is not None:
        ranks = priority.select("case_id", "rank", context.alias("priority_context"))
        queued = cases.select("case_id", F.col("status").alias("expected_status"), *[c for c in ("findings",) if c in cases.columns])
        queued = queued.join(ranks, "case_id", "left")
    else:
        queued = cases.select("case_id", F.col("status").alias("expected_status"), *[c for c in ("findings",) if c in cases.columns])
        queued = queued.withColumn("rank", F.lit(None).cast("bigint"))
    if limit is not None:
        writing = queued.join(fresh.select("case_id"), "case_id", "left_semi")
        queued = writing.orderBy(F.asc_nulls_last("rank"), "case_id").limit(limit)
    rows = fresh.join(queued, "case_id")
    columns = ["case_id", "document_type", "source_path", F.lit(K.PENDING_REVIEW).alias("dataset_split"),
               F.lit(K.SCAFFOLD_STATUS).alias("promotion_status"), "expected_status", F.col("fields").alias("expected_fields")]
    if "findings" in cases.columns:
        columns.append(F.col("findings").alias("source_findings"))
    if priority is not None:
        columns.append("priority_context")
    return rows.select(*columns, "rank")


def bootstrap(covered: DataFrame, samples: DataFrame, existing: DataFrame, overwrite: bool = False) -> DataFrame:
    """Empty pending labels for uncovered samples that the curated list knows."""
    open_ = covered.filter(~F.col("covered_by_labeled")).select("sample_path")
    listed = with_nfc(samples, "source", "sample_path")
    found = listed.join(open_, "sample_path", "left_semi")
    fresh = without_existing(found, existing, ["case_id", "document_type"], overwrite)
    return fresh.select(
        "case_id", "document_type", F.col("source").alias("source_path"), F.lit(K.PENDING_REVIEW).alias("dataset_split"),
        F.lit(K.SCAFFOLD_STATUS).alias("promotion_status"), F.lit(None).cast("string").alias("expected_status"),
        F.create_map().cast("map<string,string>").alias("expected_fields"),
        F.create_map().cast("map<string,boolean>").alias("expected_quality_checks"),
        literal_array(K.SCAFFOLD_NOTES).alias("notes"),
    )
