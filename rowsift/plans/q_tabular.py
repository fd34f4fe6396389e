"""Preprocessing, metric, split and k-NN queries over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.bits import sql_seeded_hash
from ..operators import metrics, preprocess as pp, split
from ..operators.knn import knn_classify, knn_rank
from ..sources.tables import prepared_embeddings, scan_table
from .catalog import register


def _round(df, cols, digits=6):
    return df.select(*[F.round(c, digits).alias(c) if c in cols else F.col(c) for c in df.columns])


def _std(col, src):
    return (f"round(({col} - (SELECT avg({col}) FROM {src})) / "
            f"coalesce(nullif((SELECT stddev_pop({col}) FROM {src}), 0), 1), 6) AS {col}")


# ------------------------------------------------------------------ cleaning

NULLED = """(SELECT c_custkey, nullif(c_nationkey, 3) AS c_nationkey,
         CASE WHEN c_custkey % 97 = 0 THEN CAST('NaN' AS DOUBLE) ELSE c_acctbal END AS c_acctbal,
         nullif(c_mktsegment, 'BUILDING') AS c_mktsegment FROM customer)"""


def _nulled(spark, d):
    c = scan_table(spark, d, "customer")
    return c.select("c_custkey",
                    F.when(F.col("c_nationkey") != 3, F.col("c_nationkey")).alias("c_nationkey"),
                    F.when(F.pmod("c_custkey", F.lit(97)) == 0, F.lit(float("nan")))
                    .otherwise(F.col("c_acctbal")).alias("c_acctbal"),
                    F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment"))
                    .alias("c_mktsegment"))


@register("drop_missing", f"""
SELECT * FROM {NULLED}
WHERE c_nationkey IS NOT NULL AND c_mktsegment IS NOT NULL AND NOT isnan(c_acctbal)""")
def q_drop_missing(spark, d):
    """Rows with any null or NaN are dropped (nulls injected into customer)."""
    return pp.drop_missing(_nulled(spark, d))


@register("category_cardinality", """
SELECT 'p_name' AS "column", count(DISTINCT p_name) AS n_distinct FROM part
UNION ALL SELECT 'p_brand', count(DISTINCT p_brand) FROM part
UNION ALL SELECT 'p_type', count(DISTINCT p_type) FROM part""")
def q_category_cardinality(spark, d):
    part = scan_table(spark, d, "part")
    _, cat = pp.classify_columns(part)
    return pp.category_cardinality(part, cat)


@register("drop_high_cardinality", """
SELECT 'c_name' AS "column", count(DISTINCT c_name) < 100 AS kept FROM customer
UNION ALL SELECT 'c_mktsegment', count(DISTINCT c_mktsegment) < 100 FROM customer""")
def q_drop_high_cardinality(spark, d):
    """Which categorical columns of customer survive the 100-value limit."""
    c = scan_table(spark, d, "customer")
    _, cat = pp.classify_columns(c)
    _, card = pp.vocabulary(c, cat)
    return spark.createDataFrame([(col, card[col] < pp.MAX_CATEGORIES) for col in cat],
                                 '`column` string, kept boolean')


@register("label_encode", """
SELECT p_partkey,
       CAST(dense_rank() OVER (ORDER BY p_name) - 1 AS INTEGER) AS p_name,
       CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS INTEGER) AS p_brand,
       CAST(dense_rank() OVER (ORDER BY p_type) - 1 AS INTEGER) AS p_type
FROM part""")
def q_label_encode(spark, d):
    """String columns of part coded by code-point rank (bounded vocabularies
    applied as map literals, no join)."""
    part = scan_table(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    _, cat = pp.classify_columns(part)
    vocab, _ = pp.vocabulary(part, cat)
    return part.select("p_partkey", *[pp.encode_expr(c, vocab[c]).cast("int").alias(c)
                                      for c in cat if c in vocab])


@register("standardize", f"""
SELECT p_partkey, {_std('p_size', 'part')}, {_std('p_retailprice', 'part')} FROM part""")
def q_standardize(spark, d):
    part = scan_table(spark, d, "part").select("p_partkey", "p_size", "p_retailprice")
    out = part.select("p_partkey", *pp.standardize_exprs(part, ["p_size", "p_retailprice"]))
    return _round(out, ["p_size", "p_retailprice"])


CUST = "(SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment AS class FROM customer)"


@register("preprocess", f"""
SELECT CAST(dense_rank() OVER (ORDER BY class) - 1 AS INTEGER) AS class,
       {_std('c_custkey', CUST)}, {_std('c_nationkey', CUST)}, {_std('c_acctbal', CUST)}
FROM {CUST}""")
def q_preprocess(spark, d):
    """customer with c_mktsegment as the target: c_name (one value per row) is
    dropped, the target coded, the numeric columns standardised."""
    c = scan_table(spark, d, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", F.col("c_mktsegment").alias("class"))
    prep = pp.preprocess(c)
    return _round(prep.table, prep.features)


ORD = """(SELECT o_orderkey, o_custkey, o_totalprice,
                 CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS o_orderpriority,
                 o_orderstatus AS status FROM orders)"""


@register("preprocess_orders", f"""
SELECT CAST(dense_rank() OVER (ORDER BY status) - 1 AS INTEGER) AS status,
       {_std('o_orderkey', ORD)}, {_std('o_custkey', ORD)}, {_std('o_totalprice', ORD)},
       {_std('o_orderpriority', ORD)}
FROM {ORD}""")
def q_preprocess_orders(spark, d):
    """orders with o_orderstatus as the target ``status``: the timestamp is
    rendered as text and dropped (too many values), the priority coded and,
    like every feature, standardised."""
    o = scan_table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderstatus").alias("status"), "o_totalprice",
        "o_orderdate", "o_orderpriority")
    prep = pp.preprocess(o)
    return _round(prep.table, prep.features)


# ------------------------------------------------------------------ metrics

LAB = "labels"


@register("accuracy", "SELECT CAST(count(*) FILTER (WHERE quality = toxic) AS DOUBLE) / count(*) AS accuracy FROM labels")
def q_accuracy(spark, d):
    """Share of rows where the prediction (toxic) equals the truth (quality)."""
    return metrics.accuracy(scan_table(spark, d, LAB), "quality", "toxic")


@register("mse", "SELECT round(avg(CAST((quality - toxic) * (quality - toxic) AS DOUBLE)), 6) AS mse FROM labels")
def q_mse(spark, d):
    return _round(metrics.mse(scan_table(spark, d, LAB), "quality", "toxic"), ["mse"])


@register("r2", """
SELECT round(1 - sum(CAST((quality - toxic) * (quality - toxic) AS DOUBLE))
             / (var_pop(CAST(quality AS DOUBLE)) * count(*)), 6) AS r2 FROM labels""")
def q_r2(spark, d):
    return _round(metrics.r2(scan_table(spark, d, LAB), "quality", "toxic"), ["r2"])


@register("classification_report", """
WITH conf AS (SELECT quality AS label, toxic AS prediction, count(*) AS n FROM labels GROUP BY 1, 2),
cls AS (SELECT label AS cls FROM conf UNION SELECT prediction FROM conf),
per AS (
  SELECT cls,
         coalesce((SELECT sum(n) FROM conf WHERE label = cls), 0) AS support,
         coalesce((SELECT sum(n) FROM conf WHERE prediction = cls), 0) AS predicted,
         coalesce((SELECT sum(n) FROM conf WHERE label = cls AND prediction = cls), 0) AS tp
  FROM cls),
p2 AS (
  SELECT cls, support, tp,
         CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision,
         CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall
  FROM per),
p3 AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
                      ELSE 0.0 END AS f1 FROM p2)
SELECT CAST(cls AS VARCHAR) AS class, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM p3
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM p3
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
                 CAST(sum(support) AS BIGINT) FROM p3
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
                 round(sum(recall * support) / sum(support), 6),
                 round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM p3""")
def q_classification_report(spark, d):
    rep = metrics.classification_report(scan_table(spark, d, LAB), "quality", "toxic")
    return _round(rep, ["precision", "recall", "f1"])


FOLDS_SQL = """
WITH c AS (SELECT {label} AS label, count(*) AS c, min({rid}) AS first FROM {src} GROUP BY 1),
o AS (SELECT label, c, coalesce(sum(c) OVER (ORDER BY first ROWS BETWEEN UNBOUNDED PRECEDING
                                                         AND 1 PRECEDING), 0) AS o FROM c),
a AS (SELECT label, f.range AS fold,
             sum(((o + c - g.range + {k} - 1) // {k}) - ((o - g.range + {k} - 1) // {k})) AS cum
      FROM o, range(0, {k}) f, range(0, {k}) g WHERE g.range <= f.range GROUP BY label, f.range),
r AS (SELECT {rid} AS row_id, {label} AS label,
             row_number() OVER (PARTITION BY {label} ORDER BY {rid}) - 1 AS r FROM {src})
SELECT r.row_id, r.label,
       CAST((SELECT count(*) FROM a WHERE a.label = r.label AND a.cum <= r.r) AS INTEGER) AS fold
FROM r"""


@register("cross_validate_folds",
          FOLDS_SQL.format(label="label", rid="vec_id", src="embeddings", k=5))
def q_cross_validate_folds(spark, d):
    """Unshuffled stratified 5-fold assignment of the embedding rows."""
    emb = prepared_embeddings(spark, d).select("row_id", "label")
    return split.stratified_folds(emb, 5).select("row_id", "label", "fold")


@register("cv_mean_std", f"""
WITH f AS ({FOLDS_SQL.format(label="quality", rid="doc_id", src="labels", k=5)}),
j AS (SELECT f.fold, l.quality, l.toxic FROM f JOIN labels l ON l.doc_id = f.row_id),
s AS (SELECT fold, CAST(count(*) FILTER (WHERE quality = toxic) AS DOUBLE) / count(*) AS score
      FROM j GROUP BY fold)
SELECT round(avg(score), 6) AS mean, round(stddev_pop(score), 6) AS std FROM s""")
def q_cv_mean_std(spark, d):
    """Mean and population std of per-fold accuracy (toxic predicting quality)
    over stratified 5 folds of the labels table."""
    lab = scan_table(spark, d, LAB).select(F.col("doc_id").alias("row_id"),
                                           F.col("quality").alias("label"), "toxic")
    folds = split.stratified_folds(lab, 5)
    scores = folds.groupBy("fold").agg(
        F.avg((F.col("label") == F.col("toxic")).cast("double")).alias("score"))
    return _round(metrics.mean_std(scores, "score"), ["mean", "std"])


# ------------------------------------------------------------------ splits

H_HOLD = sql_seeded_hash(42, "holdout", "vec_id")
H_SPLIT = sql_seeded_hash(42, "split", "vec_id")


@register("holdout_split", f"""
SELECT vec_id AS row_id,
       row_number() OVER (ORDER BY {H_HOLD}, vec_id) <= ceil(CAST('0.2' AS DOUBLE) * (SELECT count(*) FROM embeddings)) AS is_test
FROM embeddings""")
def q_holdout_split(spark, d):
    """Seeded 80/20 split: the ceil(0.2 n) rows with the smallest hash are the
    hold-out (exact cut-off by radix refinement, no sort)."""
    emb = prepared_embeddings(spark, d).select("row_id")
    return split.holdout_split(emb, 0.2, 42)


STRAT_SQL = f"""
WITH b AS (SELECT vec_id AS row_id, label, {H_SPLIT} AS h FROM embeddings),
n AS (SELECT count(*) AS n, least(1000, (3 * count(*)) // 4) AS t FROM b),
c AS (SELECT label, count(*) AS c FROM b GROUP BY label),
a0 AS (SELECT label, (t * c) // n AS fl, (t * c) % n AS rem, t FROM c, n),
a AS (SELECT label, fl + CASE WHEN row_number() OVER (ORDER BY rem DESC, label)
                               <= t - sum(fl) OVER () THEN 1 ELSE 0 END AS a FROM a0),
r AS (SELECT b.*, row_number() OVER (PARTITION BY label ORDER BY h, row_id) AS class_rank FROM b)
SELECT r.row_id, r.label, r.class_rank, r.class_rank <= a.a AS in_train
FROM r JOIN a USING (label)"""


@register("stratified_split", f"SELECT row_id, label, in_train FROM ({STRAT_SQL})")
def q_stratified_split(spark, d):
    """Class-proportional train sample of min(1000, int(0.75 n)) embedding rows."""
    emb = prepared_embeddings(spark, d).select("row_id", "label")
    return split.stratified_split(emb, seed=42).select("row_id", "label", "in_train")


@register("stratified_rank", f"SELECT row_id, label, class_rank FROM ({STRAT_SQL})")
def q_stratified_rank(spark, d):
    """Order of each row within its class by seeded hash (positions over the
    whole table minus class offsets, no per-class window)."""
    emb = prepared_embeddings(spark, d).select("row_id", "label")
    return split.stratified_rank(emb, seed=42).select("row_id", "label", "class_rank")


KNN_PAIRS = f"""
WITH s AS ({STRAT_SQL}),
e AS (SELECT vec_id AS row_id, label, CAST(embedding AS DOUBLE[]) AS f FROM embeddings),
t AS (SELECT e.* FROM e JOIN s USING (row_id) WHERE s.in_train),
p AS (SELECT q.row_id, q.label, t.row_id AS train_id, t.label AS tlabel,
             list_distance(q.f, t.f) AS distance,
             row_number() OVER (PARTITION BY q.row_id ORDER BY list_distance(q.f, t.f), t.row_id) AS rank
      FROM e q, t)"""


def _knn_model(spark, d):
    emb = prepared_embeddings(spark, d)
    train = split.stratified_split(emb, seed=42).where("in_train").drop("in_train")
    return emb, train


@register("knn_classify", f"""{KNN_PAIRS},
v AS (SELECT row_id, label, tlabel, count(*) AS votes FROM p WHERE rank <= 5 GROUP BY ALL),
w AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY votes DESC, tlabel) AS o FROM v)
SELECT row_id, label, tlabel AS prediction FROM w WHERE o = 1""")
def q_knn_classify(spark, d):
    """5-NN trained on the stratified sample, predicting every embedding row."""
    emb, train = _knn_model(spark, d)
    return knn_classify(emb, train, keep=("label",))


@register("knn_rank", f"""{KNN_PAIRS}
SELECT row_id, CAST(rank AS INTEGER) AS rank, train_id, round(distance, 6) AS distance
FROM p WHERE rank <= 5""")
def q_knn_rank(spark, d):
    """The 5 nearest training rows of every embedding row."""
    emb, train = _knn_model(spark, d)
    return _round(knn_rank(emb, train), ["distance"])


# ------------------------------------------------------------------ scans, splits

@register("scan_table", """
SELECT l_orderkey, l_quantity, l_extendedprice FROM lineitem
WHERE l_shipdate < TIMESTAMP '1997-01-01 00:00:00' AND l_returnflag = 'R'""")
def q_scan_table(spark, d):
    """Parquet scan with a projection and a filter that both reach the reader
    (ReadSchema of 5 columns, PushedFilters on shipdate and returnflag)."""
    li = scan_table(spark, d, "lineitem")
    return (li.where((F.col("l_shipdate") < F.lit("1997-01-01 00:00:00").cast("timestamp_ntz"))
                     & (F.col("l_returnflag") == "R"))
            .select("l_orderkey", "l_quantity", "l_extendedprice"))


@register("split_xy", f"""
SELECT {_std('c_custkey', CUST)}, {_std('c_nationkey', CUST)}, {_std('c_acctbal', CUST)}
FROM {CUST}""")
def q_split_xy(spark, d):
    """The feature part X of the prepared customer table (all but the target)."""
    c = scan_table(spark, d, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", F.col("c_mktsegment").alias("class"))
    prep = pp.preprocess(c)
    return _round(prep.table.select(*prep.features), prep.features)


H_CUST = sql_seeded_hash(42, "split", "c_custkey")


@register("stratify_fallback", f"""
SELECT c_custkey AS row_id,
       row_number() OVER (ORDER BY {H_CUST}, c_custkey)
         <= least(1000, (3 * (SELECT count(*) FROM customer)) // 4) AS in_train
FROM customer""")
def q_stratify_fallback(spark, d):
    """Stratifying customer by c_name (every class has one member) is
    impossible, so the seeded sample falls back to an unstratified one."""
    c = scan_table(spark, d, "customer").select(F.col("c_custkey").alias("row_id"),
                                                F.col("c_name").alias("label"))
    return split.stratified_split(c, seed=42).select("row_id", "in_train")
