"""Train and validation split by source paper."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom import constants as K
from paperloom.session import cut_lineage


def split_score(key: Column) -> Column:
    """Position of a source in [0, 1]: the first 32 bits of its SHA-1."""
    return F.conv(F.substring(F.sha1(key), 1, 8), 16, 10).cast("bigint") / F.lit(4294967295.0)


def hash_split(key: Column, ratio: float) -> Column:
    return F.when(split_score(key) < ratio, K.VAL).otherwise(K.TRAIN)


# --- coverage repair ------------------------------------------------------------

def source_keys(items: DataFrame) -> DataFrame:
    """Every coverage key a source belongs to: its document types first, then its field groups.

    ``items``: ``source_path``, ``document_type``, ``field_groups`` and ``seq`` (the order in which
    items were seen).  One row per (source, key); partial aggregation collapses a source with very
    many items on the map side.
    """
    tagged = items.select(
        "source_path", "seq",
        F.explode(F.concat(
            F.array(F.struct(F.lit(0).alias("phase"), F.col("document_type").alias("key"), F.lit(0).alias("place"))),
            F.transform(
                F.array_sort(F.array_distinct("field_groups")),
                lambda g, i: F.struct(F.lit(1).alias("phase"), g.alias("key"), i.alias("place")),
            ),
        )).alias("k"),
    ).select("source_path", "seq", "k.*")
    return tagged.groupBy("source_path", "phase", "key").agg(F.min(F.struct("seq", "place")).alias("seen"))


def coverage_moves(keys: DataFrame, ratio: float) -> DataFrame:
    """Sources whose hash split must change so that each key is in both splits.

    Keys are document types and field groups, so their number is small and fixed, and only the
    lowest and the highest scored source of a key can ever move.  One aggregate over the sources
    gives both per key; a second look at the sources finds which of those few candidates belong
    to which other keys; the ordered steps, each seeing the moves before it, then run over one
    small array.  The result has at most two rows per key.
    """
    scored = keys.withColumn("score", split_score(F.col("source_path"))).withColumn(
        "split", F.when(F.col("score") < ratio, K.VAL).otherwise(K.TRAIN)
    )
    scored = cut_lineage(scored)
    ranked = F.struct("score", "source_path")
    stats = scored.groupBy("phase", "key").agg(
        F.min("seen").alias("seen"), F.count(F.lit(1)).alias("sources"), F.min(ranked).alias("low"), F.max(ranked).alias("high"),
        F.count_if(F.col("split") == K.VAL).alias("vals"),
    )
    candidates = stats.select(F.explode(F.array("low.source_path", "high.source_path")).alias("source_path")).distinct()
    members = scored.join(F.broadcast(candidates), "source_path", "left_semi").groupBy("phase", "key").agg(
        F.collect_set(F.struct("source_path", "split")).alias("members")
    )
    steps = stats.join(F.broadcast(members), ["phase", "key"]).select(
        F.struct(
            "phase", "seen", "sources", "members", F.col("low.source_path").alias("low"),
            F.col("high.source_path").alias("high"),
            # splits found among the sources that cannot move
            (F.col("vals") > F.size(F.filter("members", lambda m: m["split"] == K.VAL))).alias("other_val"),
            (F.col("sources") - F.col("vals") > F.size(F.filter("members", lambda m: m["split"] == K.TRAIN))).alias(
                "other_train"
            ),
        ).alias("step")
    ).agg(F.array_sort(F.collect_list("step")).alias("steps"))
    start = F.map_from_entries(F.array_distinct(F.flatten(F.transform("steps", lambda s: s["members"]))))

    def holds(state: Column, step: Column, split: str, other: Column) -> Column:
        return other | F.exists(step["members"], lambda m: F.try_element_at(state, m["source_path"]) == split)

    def put(state: Column, source: Column, split: str, when: Column) -> Column:
        return F.transform_values(state, lambda k, v: F.when(when & (k == source), split).otherwise(v))

    def apply_step(state: Column, step: Column) -> Column:
        return F.when(step["sources"] < 2, state).otherwise(
            put(state, step["low"], K.VAL, ~holds(state, step, K.VAL, step["other_val"]))
        )

    def apply_train(state: Column, step: Column) -> Column:
        return F.when(step["sources"] < 2, state).otherwise(
            put(state, step["high"], K.TRAIN, ~holds(state, step, K.TRAIN, step["other_train"]))
        )

    both = F.aggregate("steps", F.col("start"), lambda state, step: apply_train(apply_step(state, step), step))
    final = steps.withColumn("start", start).select("start", both.alias("final"))
    return final.select("start", F.explode("final").alias("source_path", "split")).filter(
        F.col("split") != F.try_element_at("start", F.col("source_path"))
    ).select("source_path", "split")


def repair_coverage(items: DataFrame, ratio: float) -> DataFrame:
    """The few moved sources; nothing moves when the ratio leaves one split empty on purpose."""
    moves = coverage_moves(source_keys(items), ratio)
    return moves if 0.0 < ratio < 1.0 else moves.limit(0)


def apply_splits(df: DataFrame, moves: DataFrame, ratio: float, key: str = "source_path") -> DataFrame:
    """Add ``split``: the hash split, overruled by the moved sources.

    The hash is a function of the row, so a source holding a third of all rows needs no shuffle;
    ``moves`` has at most two rows per coverage key and is broadcast.
    """
    moved = F.broadcast(moves.select(F.col("source_path").alias("__moved"), F.col("split").alias("__split")))
    joined = df.join(moved, F.col(key) == F.col("__moved"), "left")
    return joined.withColumn("split", F.coalesce("__split", hash_split(F.col(key), ratio))).drop("__moved", "__split")


# --- split objective --------------------------------------------------------------

def _gap(target: int, value: Column, weight: float) -> Column:
    return F.greatest(F.lit(0), F.lit(target) - value) * F.lit(weight)


def group_shortfall(train: Column, val: Column, train_sources: Column, val_sources: Column) -> Column:
    return (
        _gap(K.MIN_TRAIN, train, K.TRAIN_WEIGHT) + _gap(K.MIN_VAL, val, K.VAL_WEIGHT)
        + _gap(K.MIN_TRAIN_SOURCES, train_sources, K.TRAIN_SOURCE_WEIGHT)
        + _gap(K.MIN_VAL_SOURCES, val_sources, K.VAL_SOURCE_WEIGHT)
    )


def source_profiles(items: DataFrame) -> DataFrame:
    """Fields per (source, field group) from items with ``field_counts_by_group`` maps."""
    return items.select("source_path", F.explode("field_counts_by_group").alias("field_group", "fields")).groupBy(
        "source_path", "field_group"
    ).agg(F.sum("fields").alias("fields"))


def split_objective(assignment: DataFrame | None, profiles: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Shortfall of an assignment (or, with ``keys``, of each of several) against the sample targets.

    Without an ``assignment`` the profiles carry their source's ``split``, as a hash of the source does
    without a join; profiles dealt by the keys then stay where they are.
    """
    joined = profiles if assignment is None else profiles.join(assignment, "source_path")
    train, val = F.col("split") == K.TRAIN, F.col("split") == K.VAL
    per_group = joined.groupBy(*keys, "field_group").agg(
        F.sum(F.when(train, F.col("fields")).otherwise(0)).alias("train"),
        F.sum(F.when(val, F.col("fields")).otherwise(0)).alias("val"),
        F.count_if(train).alias("train_sources"), F.count_if(val).alias("val_sources"),
    )
    gap = group_shortfall(F.col("train"), F.col("val"), F.col("train_sources"), F.col("val_sources"))
    return per_group.groupBy(*keys).agg(F.round(F.sum(gap), 4).alias("score"))


def repaired_split(items: DataFrame, ratio: float) -> DataFrame:
    """Split per source by hash, repaired where a document type or field group would miss a side; any number of sources."""
    return apply_splits(items.select("source_path").distinct(), repair_coverage(items, ratio), ratio)


def best_split(items: DataFrame, ratio: float) -> DataFrame:
    """Split per source: the best of all assignments of at most ``EXACT_SPLIT_SOURCES`` sources.

    More sources are an error: there ``salted_split`` or ``repaired_split`` is the operator to ask for.  The sources are
    gathered into one row, the masks 0..2^n-1 are exploded and spread over the cluster, and each mask
    is scored by array expressions; the least (score, distance from the repaired split, assignment)
    wins.  At a ratio of 0 or 1 nothing is left to choose.
    """
    default = repaired_split(items, ratio)
    count = items.select("source_path").distinct().limit(K.EXACT_SPLIT_SOURCES + 1).count()
    if count > K.EXACT_SPLIT_SOURCES:
        raise ValueError(f"more than {K.EXACT_SPLIT_SOURCES} sources: use repaired_split")
    if count == 0 or not 0.0 < ratio < 1.0:
        return default
    counts = items.select("source_path", "document_type", F.explode_outer("field_counts_by_group").alias("field_group", "n"))
    profile = counts.groupBy("source_path", "field_group").agg(F.sum("n").alias("n")).filter("n > 0").groupBy("source_path").agg(
        F.collect_list(F.struct("field_group", "n")).alias("groups")
    )
    types = items.groupBy("source_path").agg(F.collect_set("document_type").alias("types"))
    gathered = types.join(profile, "source_path", "left").join(default, "source_path").agg(
        F.array_sort(F.collect_list(F.struct("source_path", "split", "types", "groups"))).alias("sources")
    )
    masks = gathered.select("sources", F.explode(F.sequence(F.lit(0), F.lit((1 << count) - 1))).alias("mask")).repartition("mask")
    bit = lambda i: F.getbit("mask", i) == 1
    assigned = masks.select(F.transform(
        "sources",
        lambda s, i: F.struct(
            s["source_path"].alias("source_path"), F.when(bit(i), K.VAL).otherwise(K.TRAIN).alias("split"),
            s["split"].alias("default"), s["types"].alias("types"), F.coalesce(s["groups"], F.array()).alias("groups"),
        ),
    ).alias("sources"))
    group_names = F.array_distinct(F.flatten(F.transform("sources", lambda s: F.transform(s["groups"], lambda g: g["field_group"]))))
    type_names = F.array_distinct(F.flatten(F.transform("sources", lambda s: s["types"])))

    def total(group: Column, split: str) -> Column:
        return F.aggregate(
            "sources", F.lit(0).cast("bigint"),
            lambda acc, s: acc + F.when(s["split"] == split, F.aggregate(
                s["groups"], F.lit(0).cast("bigint"),
                lambda a, g: a + F.when(g["field_group"] == group, g["n"]).otherwise(0).cast("bigint"),
            )).otherwise(F.lit(0).cast("bigint")),
        )

    def having(group: Column, split: str | None) -> Column:
        return F.size(F.filter(
            "sources",
            lambda s: F.exists(s["groups"], lambda g: g["field_group"] == group)
            & (F.lit(True) if split is None else s["split"] == split),
        ))

    def of_type(kind: Column, split: str | None) -> Column:
        return F.size(F.filter(
            "sources",
            lambda s: F.array_contains(s["types"], kind) & (F.lit(True) if split is None else s["split"] == split),
        ))

    def covered(counter):
        return lambda name: (counter(name, None) < 2) | ((counter(name, K.VAL) > 0) & (counter(name, K.TRAIN) > 0))

    gaps = F.transform(
        group_names,
        lambda g: group_shortfall(total(g, K.TRAIN), total(g, K.VAL), having(g, K.TRAIN), having(g, K.VAL)),
    )
    scored = assigned.select(
        "sources",
        F.round(F.aggregate(gaps, F.lit(0.0), lambda a, g: a + g), 4).alias("score"),
        F.size(F.filter("sources", lambda s: s["split"] != s["default"])).alias("distance"),
        F.transform("sources", lambda s: s["split"]).alias("splits"),
        (F.forall(type_names, covered(of_type)) & F.forall(group_names, covered(having))).alias("covered"),
    )
    # the default itself competes even when it does not cover every key
    allowed = scored.filter(F.col("covered") | (F.col("distance") == 0))
    best = allowed.agg(F.min_by("sources", F.struct("score", "distance", "splits")).alias("sources"))
    return best.select(F.explode("sources").alias("s")).select("s.source_path", "s.split")


def salted_split(items: DataFrame, ratio: float, candidates: int = 32) -> DataFrame:
    """Split per source: the best of ``candidates`` assignments, for any number of sources.

    Candidate 0 is the repaired split, candidate c the hash split of the source's name with ``#c`` behind
    it.  Those that leave a document type or field group of several sources on one side alone are out,
    but for candidate 0; the least (score, sources that differ from candidate 0, number) wins.  A
    source is one row per key before the candidates are dealt out, and their sums merge on the map side:
    what is shuffled is one row per candidate and key from each task, whatever the number of sources.
    An empty table gives no rows; at a ratio of 0 or 1 nothing is left to choose.
    """
    moves = repair_coverage(items, ratio)
    tagged = items.select("source_path", F.explode(F.concat(
        F.array(F.struct(F.lit("source").alias("kind"), F.lit("").alias("key"), F.lit(0).cast("bigint").alias("n")),
                F.struct(F.lit("type").alias("kind"), F.col("document_type").alias("key"), F.lit(0).cast("bigint").alias("n"))),
        F.transform(
            F.coalesce(F.map_entries("field_counts_by_group"), F.array()),
            lambda e: F.struct(F.lit("group").alias("kind"), e["key"].alias("key"), e["value"].cast("bigint").alias("n")),
        ),
    )).alias("k")).select("source_path", "k.*")
    summed = tagged.groupBy("source_path", "kind", "key").agg(F.sum("n").alias("n")).filter("kind <> 'group' OR n > 0")
    keys = cut_lineage(apply_splits(summed, moves, ratio))

    def side(candidate: Column) -> Column:
        salted = hash_split(F.concat("source_path", F.lit("#"), candidate.cast("string")), ratio)
        return F.when(candidate == 0, F.col("split")).otherwise(salted)

    if not 0.0 < ratio < 1.0:
        candidates = 1
    dealt = keys.withColumn("candidate", F.explode(F.sequence(F.lit(0), F.lit(candidates - 1)))).withColumn("side", side(F.col("candidate")))
    train, val = F.col("side") == K.TRAIN, F.col("side") == K.VAL
    per_key = dealt.groupBy("candidate", "kind", "key").agg(
        F.sum(F.when(train, F.col("n")).otherwise(0)).alias("train"), F.sum(F.when(val, F.col("n")).otherwise(0)).alias("val"),
        F.count_if(train).alias("train_sources"), F.count_if(val).alias("val_sources"), F.count_if(F.col("side") != F.col("split")).alias("differ"),
    )
    gap = group_shortfall(F.col("train"), F.col("val"), F.col("train_sources"), F.col("val_sources"))
    covered = (F.col("kind") == "source") | (F.col("train_sources") + F.col("val_sources") < 2) | ((F.col("train_sources") > 0) & (F.col("val_sources") > 0))
    scored = per_key.groupBy("candidate").agg(
        F.round(F.coalesce(F.sum(F.when(F.col("kind") == "group", gap)), F.lit(0.0)), 4).alias("score"),
        F.sum(F.when(F.col("kind") == "source", F.col("differ"))).alias("distance"), F.bool_and(covered).alias("covered"),
    ).filter("covered OR candidate = 0")
    best = scored.agg(F.min(F.struct("score", "distance", "candidate")).alias("best")).select(F.col("best.candidate").alias("candidate"))
    chosen = keys.filter("kind = 'source'").crossJoin(F.broadcast(best))  # one row
    return chosen.select("source_path", side(F.col("candidate")).alias("split"))


# --- audit ------------------------------------------------------------------------

def leakage(df: DataFrame) -> DataFrame:
    """Sources found in more than one split, and augmented rows outside train."""
    crossing = df.groupBy("source_path").agg(
        F.min("split").alias("first"), F.max("split").alias("last"), F.count(F.lit(1)).alias("rows")
    ).filter("first <> last").select(F.lit("source_in_two_splits").alias("problem"), "source_path", "rows")
    augmented = df.filter(F.col("augmentation_type").isNotNull() & (F.col("split") != K.TRAIN)).groupBy("source_path").agg(
        F.count(F.lit(1)).alias("rows")
    ).select(F.lit("augmented_outside_train").alias("problem"), "source_path", "rows")
    return crossing.unionByName(augmented)
