"""Splits by source."""

from pyspark.sql import functions as F

from paperloom import constants as K
from paperloom.operators import splits as S
from workload import views as V
from workload.query import Query

SCORE = "(('0x' || substr(sha1({0}), 1, 8))::BIGINT / 4294967295.0::DOUBLE)"
SRC = SCORE.format("source_path")


def _v(names, select):
    return V.plain(V.with_views(names) + select)


def hash_split(spark, folder):
    rows = V.view(spark, folder, "crops_v")
    return rows.select("source_path", S.hash_split(F.col("source_path"), 0.2).alias("split")).groupBy("source_path", "split").agg(F.count(F.lit(1)).alias("crops"))


def _items(spark, folder):
    """Crops as split items; the sequence number is the order in which items were seen."""
    rows = V.view(spark, folder, "crops_v")
    return rows.select("source_path", "document_type", F.array("field_group").alias("field_groups"), F.col("crop_path").alias("seq"))


RATIO = 0.012


def repaired(spark, folder):
    """Every crop under a ratio so small that most keys need a moved source."""
    items = _items(spark, folder)
    moves = S.repair_coverage(items, RATIO)
    return S.apply_splits(items, moves, RATIO).groupBy("source_path", "split").agg(F.count(F.lit(1)).alias("crops"))


def _repair_sql():
    """The ordered steps one after another: types, then groups, each in order of first sight."""
    steps = ["""keys AS (SELECT source_path, 0 AS phase, document_type AS key, min(crop_path) AS seen FROM crops_v GROUP BY ALL
      UNION ALL SELECT source_path, 1, field_group, min(crop_path) FROM crops_v GROUP BY ALL),
    ordered AS (SELECT phase, key, row_number() OVER (ORDER BY phase, min(seen)) AS n FROM keys GROUP BY phase, key),
    s0 AS (SELECT DISTINCT source_path, """ + SRC + f""" AS score, CASE WHEN {SRC} < {RATIO} THEN 'val' ELSE 'train' END AS split FROM crops_v)"""]
    state = "s0"
    for n in range(1, 8):
        for half, (wanted, pick) in enumerate((("val", "arg_min"), ("train", "arg_max"))):
            new = f"s{n}_{half}"
            steps.append(f"""m{new} AS (SELECT {pick}(s.source_path, (s.score, s.source_path)) AS mover FROM {state} s JOIN keys k USING (source_path) JOIN ordered o ON o.phase = k.phase AND o.key = k.key AND o.n = {n}
              HAVING count(*) >= 2 AND count(*) FILTER (s.split = '{wanted}') = 0),
            {new} AS (SELECT source_path, score, CASE WHEN source_path IN (SELECT mover FROM m{new}) THEN '{wanted}' ELSE split END AS split FROM {state})""")
            state = new
    return V.plain(V.with_views(("crops_v",), ",\n".join(steps)) + f" SELECT source_path, split, count(*) AS crops FROM crops_v JOIN {state} f USING (source_path) GROUP BY ALL").replace("JOIN " + state + " f USING (source_path) GROUP BY ALL", f"c JOIN {state} f USING (source_path) GROUP BY ALL").replace("SELECT source_path, split, count(*) AS crops FROM crops_v c", "SELECT c.source_path, f.split, count(*) AS crops FROM crops_v c")


ROWS_PER_PART = 250_000


def objective(spark, folder):
    """Shortfall of the hash split inside every case."""
    # a task's groups are held in memory: the cases are dealt into as many parts as the line items ask for
    parts = max(1, spark.sparkContext.defaultParallelism, V.table(spark, folder, "lineitem").count() // ROWS_PER_PART)
    rows = V.view(spark, folder, "crops_v").select("case_id", "source_path", "field_group").repartition(parts, "case_id")
    profiles = rows.groupBy("case_id", "source_path", "field_group").agg(F.count(F.lit(1)).alias("fields"))
    return S.split_objective(None, profiles.withColumn("split", S.hash_split(F.col("source_path"), 0.02)), ("case_id",))


OBJECTIVE_SQL = _v(("crops_v",), f"""SELECT case_id, round(sum(3.0 * greatest(0, 12 - t) + 2.0 * greatest(0, 3 - v) + 2.5 * greatest(0, 3 - ts) + 2.0 * greatest(0, 2 - vs))::DOUBLE, 4) AS score FROM (
  SELECT case_id, field_group, coalesce(sum(n) FILTER (NOT val), 0) AS t, coalesce(sum(n) FILTER (val), 0) AS v, count(*) FILTER (NOT val) AS ts, count(*) FILTER (val) AS vs FROM (
    SELECT case_id, source_path, field_group, {SRC} < 0.02 AS val, count(*) AS n FROM crops_v GROUP BY ALL) GROUP BY ALL) GROUP BY case_id""")


def exact_search(spark, folder):
    """Best of all assignments of the regions' sources: every line item, counted by its nation's region."""
    lines, suppliers = V.table(spark, folder, "lineitem"), V.table(spark, folder, "supplier")
    rows = lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    source = F.concat(F.lit("nation_"), (F.col("s_nationkey") % 11).cast("string"), F.lit(".png"))
    group = F.when(F.col("l_linenumber") % 3 == 0, K.DATE_GROUP).when(F.col("l_linenumber") % 3 == 1, K.NUMERIC_GROUP).otherwise(K.ENGLISH_GROUP)
    kind = F.when(F.col("l_returnflag") == "A", K.APOSTILLE).when(F.col("l_returnflag") == "N", K.RESIDENCY).otherwise(K.WITHHOLDING)
    counts = rows.groupBy(source.alias("source_path"), kind.alias("document_type"), group.alias("field_group")).agg((F.count(F.lit(1)) % 7).alias("n"))
    items = counts.groupBy("source_path", "document_type").agg(
        F.map_from_entries(F.collect_list(F.struct("field_group", "n"))).alias("field_counts_by_group"),
        F.collect_list("field_group").alias("field_groups"), F.concat("source_path", F.lit("#"), "document_type").alias("seq"),
    )
    return S.best_split(items, 0.2)


EXACT_SQL = """WITH c AS (SELECT 'nation_' || (s_nationkey % 11) || '.png' AS source_path, CASE l_returnflag WHEN 'A' THEN 'apostille' WHEN 'N' THEN 'residency_certificate' ELSE 'withholding_tax_form' END AS document_type,
  CASE l_linenumber % 3 WHEN 0 THEN 'date' WHEN 1 THEN 'numeric_tin_code' ELSE 'english_name_org' END AS field_group, count(*) % 7 AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL),
src AS (SELECT source_path, row_number() OVER (ORDER BY source_path) - 1 AS i, CASE WHEN """ + SRC + """ < 0.2 THEN 'val' ELSE 'train' END AS dflt FROM (SELECT DISTINCT source_path FROM c)),
prof AS (SELECT source_path, field_group, sum(n) AS n FROM c GROUP BY ALL HAVING sum(n) > 0),
masks AS (SELECT mask FROM generate_series(0, (SELECT (1 << count(*)) - 1 FROM src)) g(mask)),
a AS (SELECT mask, source_path, i, dflt, CASE WHEN (mask >> i) & 1 = 1 THEN 'val' ELSE 'train' END AS split FROM masks, src),
sc AS (SELECT mask, sum(3.0 * greatest(0, 12 - t) + 2.0 * greatest(0, 3 - v) + 2.5 * greatest(0, 3 - ts) + 2.0 * greatest(0, 2 - vs)) AS score, bool_and(ts + vs < 2 OR (ts > 0 AND vs > 0)) AS ok FROM (
   SELECT mask, field_group, coalesce(sum(n) FILTER (split = 'train'), 0) AS t, coalesce(sum(n) FILTER (split = 'val'), 0) AS v, count(*) FILTER (split = 'train') AS ts, count(*) FILTER (split = 'val') AS vs
   FROM a JOIN prof USING (source_path) GROUP BY ALL) GROUP BY mask),
ty AS (SELECT mask, bool_and(ts + vs < 2 OR (ts > 0 AND vs > 0)) AS ok FROM (SELECT mask, document_type, count(*) FILTER (split = 'train') AS ts, count(*) FILTER (split = 'val') AS vs
   FROM a JOIN (SELECT DISTINCT source_path, document_type FROM c) d USING (source_path) GROUP BY ALL) GROUP BY mask),
di AS (SELECT mask, count(*) FILTER (split <> dflt) AS distance, string_agg(split, ',' ORDER BY source_path) AS tuple FROM a GROUP BY mask),
best AS (SELECT arg_min(mask, (score, distance, tuple)) AS mask FROM sc JOIN ty USING (mask) JOIN di USING (mask) WHERE (sc.ok AND ty.ok) OR distance = 0)
SELECT source_path, split FROM a JOIN best USING (mask)"""


SALTED_RATIO, CANDIDATES = 0.1, 32


def salted_search(spark, folder):
    """Best of 32 assignments of all suppliers: every line item, counted by its supplier's region."""
    lines, suppliers, nations = (V.table(spark, folder, t) for t in ("lineitem", "supplier", "nation"))
    kind = F.when(F.col("l_returnflag") == "A", K.APOSTILLE).when(F.col("l_returnflag") == "N", K.RESIDENCY).otherwise(K.WITHHOLDING)
    counts = lines.groupBy("l_suppkey", kind.alias("document_type")).agg((F.count(F.lit(1)) % 7).alias("n"))
    rows = counts.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    source, group = F.concat(F.lit("supplier_"), F.col("s_suppkey").cast("string")), F.concat(F.lit("region_"), F.col("n_regionkey").cast("string"))
    items = rows.select(
        source.alias("source_path"), "document_type", F.create_map(group, F.col("n")).alias("field_counts_by_group"),
        F.array(group).alias("field_groups"), F.concat(source, F.lit("#"), F.col("document_type")).alias("seq"),
    )
    return S.salted_split(items, SALTED_RATIO, CANDIDATES)


def _salted_sql():
    """The repaired split by its ordered steps, then every candidate by plain grouping."""
    steps = [f"""c AS (SELECT 'supplier_' || s_suppkey AS source_path, CASE l_returnflag WHEN 'A' THEN 'apostille' WHEN 'N' THEN 'residency_certificate' ELSE 'withholding_tax_form' END AS document_type,
      'region_' || n_regionkey AS field_group, count(*) % 7 AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL),
    keys AS (SELECT source_path, 0 AS phase, document_type AS key, min(source_path || '#' || document_type) AS seen FROM c GROUP BY ALL
      UNION ALL SELECT source_path, 1, field_group, min(source_path || '#' || document_type) FROM c GROUP BY ALL),
    ordered AS (SELECT phase, key, row_number() OVER (ORDER BY phase, min(seen)) AS n FROM keys GROUP BY phase, key),
    s0 AS (SELECT DISTINCT source_path, {SRC} AS score, CASE WHEN {SRC} < {SALTED_RATIO} THEN 'val' ELSE 'train' END AS split FROM c)"""]
    state = "s0"
    for n in range(1, 9):
        for half, (wanted, pick) in enumerate((("val", "arg_min"), ("train", "arg_max"))):
            new = f"s{n}_{half}"
            steps.append(f"""m{new} AS (SELECT {pick}(s.source_path, (s.score, s.source_path)) AS mover FROM {state} s JOIN keys k USING (source_path) JOIN ordered o ON o.phase = k.phase AND o.key = k.key AND o.n = {n}
              HAVING count(*) >= 2 AND count(*) FILTER (s.split = '{wanted}') = 0),
            {new} AS (SELECT source_path, score, CASE WHEN source_path IN (SELECT mover FROM m{new}) THEN '{wanted}' ELSE split END AS split FROM {state})""")
            state = new
    salted = SCORE.format("(source_path || '#' || candidate)")
    steps.append(f"""a AS (SELECT candidate, source_path, split AS dflt, CASE WHEN candidate = 0 THEN split WHEN {salted} < {SALTED_RATIO} THEN 'val' ELSE 'train' END AS side FROM {state}, range({CANDIDATES}) g(candidate)),
    prof AS (SELECT source_path, field_group, sum(n) AS n FROM c GROUP BY ALL HAVING sum(n) > 0),
    sc AS (SELECT candidate, sum(3.0 * greatest(0, 12 - t) + 2.0 * greatest(0, 3 - v) + 2.5 * greatest(0, 3 - ts) + 2.0 * greatest(0, 2 - vs)) AS score, bool_and(ts + vs < 2 OR (ts > 0 AND vs > 0)) AS ok FROM (
      SELECT candidate, field_group, coalesce(sum(n) FILTER (side = 'train'), 0) AS t, coalesce(sum(n) FILTER (side = 'val'), 0) AS v, count(*) FILTER (side = 'train') AS ts, count(*) FILTER (side = 'val') AS vs
      FROM a JOIN prof USING (source_path) GROUP BY ALL) GROUP BY candidate),
    ty AS (SELECT candidate, bool_and(ts + vs < 2 OR (ts > 0 AND vs > 0)) AS ok FROM (SELECT candidate, document_type, count(*) FILTER (side = 'train') AS ts, count(*) FILTER (side = 'val') AS vs
      FROM a JOIN (SELECT DISTINCT source_path, document_type FROM c) d USING (source_path) GROUP BY ALL) GROUP BY candidate),
    di AS (SELECT candidate, count(*) FILTER (side <> dflt) AS distance FROM a GROUP BY candidate),
    best AS (SELECT arg_min(candidate, (score, distance, candidate)) AS candidate FROM sc JOIN ty USING (candidate) JOIN di USING (candidate) WHERE (sc.ok AND ty.ok) OR candidate = 0)""")
    return "WITH " + ",\n".join(steps) + " SELECT source_path, side AS split FROM a JOIN best USING (candidate)"


def leakage(spark, folder):
    rows = V.hard_cases(spark, folder)
    mixed = rows.withColumn("split", F.when(F.col("field_name") == "remarks", K.VAL).otherwise(F.col("split")))
    return S.leakage(mixed)


LEAK_SQL = _v(("hard_v",), """SELECT 'source_in_two_splits' AS problem, source_path, count(*) AS rows FROM (SELECT source_path, CASE WHEN field_name = 'remarks' THEN 'val' ELSE split END AS split FROM hard_v) GROUP BY source_path HAVING count(DISTINCT split) > 1
  UNION ALL SELECT 'augmented_outside_train', source_path, count(*) FROM (SELECT source_path, CASE WHEN field_name = 'remarks' THEN 'val' ELSE split END AS split FROM hard_v) WHERE split <> 'train' GROUP BY source_path""")

QUERIES = [
    Query("D1_hash_split", hash_split, _v(("crops_v",), f"SELECT source_path, CASE WHEN {SRC} < 0.2 THEN 'val' ELSE 'train' END AS split, count(*) AS crops FROM crops_v GROUP BY ALL").replace("source_path, CASE WHEN", "source_path, CASE WHEN")),
    Query("D2_repaired_split", repaired, _repair_sql()),
    Query("D3_split_objective", objective, OBJECTIVE_SQL),
    Query("D4_exact_search", exact_search, EXACT_SQL),
    Query("D4_salted_search", salted_search, _salted_sql()),
    Query("D5_leakage", leakage, LEAK_SQL),
]
