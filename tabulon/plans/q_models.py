"""I-family (and K1/K6) queries: grouped CV search, selection, fit gap, persistence, encoded map."""

from __future__ import annotations

import math
import uuid

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from tabulon.functions.exprs import h8, sql_str
from tabulon.operators import clean as D
from tabulon.operators import models as I
from tabulon.operators import tree_explain as T
from tabulon.plans.base import Query
from tabulon.plans.q_features import MODEL_FEATURES, SPLIT_CTE, TARGET, split_frame
from tabulon.session import materialize, shared_scratch, written
from tabulon.sources.fixtures import DIMENSIONS


def prepared(spark, d, split=None):
    """The split survey as weighted cells (profile, label, side, fold, ``n``) with their encoded features, and the
    fitted one-hot template (vocabulary from training rows): its size is bounded by the categories."""
    sp = (split_frame(spark, d) if split is None else split).withColumn("label", F.col(TARGET))
    cells = materialize(I.profile_cells(sp, ["side", "cv_fold", *MODEL_FEATURES], "label"))
    prep = D.prep_template([], MODEL_FEATURES).fit(cells.filter(F.col("side") == "train"))
    parts = max(1, math.ceil(cells.count() / 50_000))
    return materialize(prep.transform(cells.coalesce(parts)).select("label", "n", "side", "cv_fold", "features", *MODEL_FEATURES)), prep


#: Families whose settings the registered search fits, all of them; a whole ``full_grid`` takes the ensembles too (README has its time).
SEARCHED = ("baseline", "logistic", "tree")

#: Written search tables of a session: three queries read the same one.
_SEARCHES: dict[tuple[str, str], str] = {}


def _search(spark, d):
    """The search over the settings of ``SEARCHED`` families and all folds, fitted once for a session and table folder."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _SEARCHES:
        data, _prep = prepared(spark, d)
        root = shared_scratch(spark, f"search/{uuid.uuid4().hex}")
        train = data.filter(F.col("side") == "train")
        scores = I.search_on_cells(train, "cv_fold", [c for c in I.full_grid() if c.family in SEARCHED], f"{root}/scores")
        k = train.select("cv_fold").distinct().count()
        I.search_table(I.fit_metrics(scores, weight="n"), k).write.parquet(f"{root}/table")
        _SEARCHES[key] = f"{root}/table"
    return spark.read.parquet(_SEARCHES[key])


def q_cv_search(spark, d):
    t = _search(spark, d)
    return t.select("candidate_id", "family", "complexity", "validation_roc_auc_mean", "validation_roc_auc_std",
                    "validation_accuracy_mean", "validation_precision_mean", "validation_recall_mean",
                    "validation_f1_mean", "validation_brier_mean", "train_roc_auc_mean", "rank_in_family")


def q_one_se(spark, d):
    return I.one_se_selection(_search(spark, d)).select("candidate_id", "complexity", "validation_roc_auc_mean",
                                                        "one_se_cutoff", "one_se_eligible", "selected")


def q_fit_gap(spark, d):
    return _search(spark, d).select("candidate_id", "auc_gap", "fit_gap")


# The settings of the rule search (family, number, strength of the label in its score)
RULE_SETTINGS = (("baseline", 0, 0), ("logistic", 1, 30), ("logistic", 2, 42), ("tree", 3, 12), ("tree", 4, 40), ("forest", 5, 44), ("forest", 6, 20),
                 ("gbt", 7, 45), ("gbt", 8, 43))
FOLDS = 5


def rule_scores(spark, d):
    """Score cells of fixed scoring rules in place of fitted models: the whole search, with results any engine can repeat."""
    rows = split_frame(spark, d).filter(F.col("side") == "train").select("respondent_id", F.col(TARGET).cast("double").alias("y"), "cv_fold")
    rules = F.array(*[F.struct(F.lit(f"{f}:{k}").alias("candidate_id"), F.lit(f).alias("family"), F.lit("{}").alias("params"), F.lit(k).alias("complexity"),
                               F.lit(s).alias("s")) for f, k, s in RULE_SETTINGS])
    each = rows.select("*", F.explode(rules).alias("r")).select("respondent_id", "y", "cv_fold", "r.*")
    u = h8(F.concat(F.col("candidate_id"), F.lit("|"), F.col("respondent_id").cast("string"))) % 100
    p = F.when(F.col("family") == "baseline", 0.5).otherwise((u + F.col("s") * F.col("y")) / (100.0 + F.col("s")))
    cells = each.groupBy("candidate_id", "family", "params", "complexity", "cv_fold", "y", p.alias("p")).agg(F.count("*").alias("n"))
    return cells.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(FOLDS - 1)))).withColumn(
        "split", F.when(F.col("cv_fold") == F.col("fold"), "validation").otherwise("train"))


def q_rule_search(spark, d):
    cells = materialize(rule_scores(spark, d))  # the metrics go over them more than once
    t = I.one_se_selection(materialize(I.search_table(I.fit_metrics(cells, weight="n"), FOLDS)))
    return t.select("candidate_id", *[f"{s}_{m}_mean" for s in ("validation", "train") for m in I.METRICS], "validation_roc_auc_std", "rank_in_family",
                    "auc_gap", "fit_gap", "one_se_cutoff", "one_se_eligible", "selected")


_RULES = ", ".join(f"('{f}:{k}', '{f}', {s})" for f, k, s in RULE_SETTINGS)
_U = f"(cast(('0x' || substr(md5(concat(candidate_id, '|', cast(respondent_id as varchar))), 1, 8)) as bigint) % 100)"
RULE_CTE = SPLIT_CTE + (
    f", rules(candidate_id, family, s) as (values {_RULES}), "
    f"rc as (select candidate_id, family, cv_fold, {TARGET} as y, case when family = 'baseline' then 0.5::double else ({_U} + s * {TARGET}) / (100.0 + s)::double end as p, "
    "count(*) as n from (select * from split where side = 'train') cross join rules group by all), "
    f"rf as (select candidate_id, family, fold, case when cv_fold = fold then 'validation' else 'train' end as split, y, p, sum(n)::double as n "
    f"from rc cross join range(0, {FOLDS}) t(fold) group by all), "
    "rm as (select candidate_id, family, fold, split, coalesce(sum(n) filter (where y = 1 and p >= 0.5), 0) as tp, coalesce(sum(n) filter (where y = 0 and p < 0.5), 0) as tn, "
    "coalesce(sum(n) filter (where y = 0 and p >= 0.5), 0) as fp, coalesce(sum(n) filter (where y = 1 and p < 0.5), 0) as fn, "
    "sum(n * power(p - y, 2)) / sum(n) as brier from rf group by all), "
    "ra as (select candidate_id, fold, split, sum(pos * (neg_le - neg / 2.0)) / (sum(pos) * sum(neg)) as roc_auc from (select *, sum(neg) over "
    "(partition by candidate_id, fold, split order by p rows between unbounded preceding and current row) as neg_le from "
    "(select candidate_id, fold, split, p, coalesce(sum(n) filter (where y = 1), 0) as pos, coalesce(sum(n) filter (where y = 0), 0) as neg from rf group by all)) group by all), "
    "rx as (select m.candidate_id, family, split, roc_auc, (tp + tn) / (tp + tn + fp + fn) as accuracy, coalesce(tp / nullif(tp + fp, 0), 0.0) as precision, "
    "coalesce(tp / nullif(tp + fn, 0), 0.0) as recall, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0) as f1, brier "
    "from rm m join ra using (candidate_id, fold, split)), "
    "rt as (select candidate_id, family, " + ", ".join(f"avg({m}) filter (where split = '{s}') as {s}_{m}_mean" for s in ("validation", "train") for m in I.METRICS)
    + ", stddev_pop(roc_auc) filter (where split = 'validation') as validation_roc_auc_std from rx group by all), "
    "rr as (select *, cast(rank() over (partition by family order by validation_roc_auc_mean desc, candidate_id) as integer) as rank_in_family, "
    "train_roc_auc_mean - validation_roc_auc_mean as auc_gap from rt), "
    "rk as (select validation_roc_auc_mean - validation_roc_auc_std / sqrt(5) as cut from rr where family <> 'baseline' order by validation_roc_auc_mean desc limit 1), "
    "re as (select rr.*, cut as one_se_cutoff, family <> 'baseline' and rank_in_family = 1 and validation_roc_auc_mean >= cut as one_se_eligible from rr cross join rk), "
    "rs as (select candidate_id as chosen from re where one_se_eligible order by case family when 'logistic' then 1 when 'tree' then 2 else 3 end, "
    "validation_roc_auc_mean desc, candidate_id limit 1)")
RULE_SQL = ("select candidate_id, " + ", ".join(f"{s}_{m}_mean" for s in ("validation", "train") for m in I.METRICS)
            + ", validation_roc_auc_std, rank_in_family, auc_gap, case when auc_gap < 0.05 then 'low' when auc_gap < 0.10 then 'moderate' else 'high' end as fit_gap, "
              "one_se_cutoff, one_se_eligible, candidate_id = chosen as selected from re cross join rs")
RULE_DOUBLES = (*[f"{s}_{m}_mean" for s in ("validation", "train") for m in I.METRICS], "validation_roc_auc_std", "auc_gap", "one_se_cutoff")


def q_roundtrip(spark, d):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    sp = materialize(split_frame(spark, d))
    train = sp.filter(F.col("side") == "train").withColumn("label", F.col(TARGET))
    n = train.count()
    pipe = Pipeline(stages=D.prep_template([], MODEL_FEATURES).getStages()
                    + [LogisticRegression(regParam=1.0 / (1.0 * n), elasticNetParam=0.0, standardization=False)])
    model = pipe.fit(train)
    return I.roundtrip_parity(model, sp.filter(F.col("side") == "test"),
                              shared_scratch(spark, f"models/{uuid.uuid4().hex}"), "respondent_id")


def q_encoded_map(spark, d):
    _data, prep = prepared(spark, d)
    indexer = [s for s in prep.stages if s.__class__.__name__ == "StringIndexerModel"][0]
    rows = I.encoded_feature_map(indexer, MODEL_FEATURES)
    return spark.createDataFrame(rows, "encoded_index int, source_feature string, category string")


def q_native_importance(spark, d):
    """K6, both forms: impurity importance of a tree, |coefficient| of a logistic model, each summed to source features."""
    data, prep = prepared(spark, d)
    train = data.filter(F.col("side") == "train")
    totals = {r["label"]: int(r["c"]) for r in train.groupBy("label").agg(F.sum("n").alias("c")).collect()}  # a row per class
    indexer = [s for s in prep.stages if s.__class__.__name__ == "StringIndexerModel"][0]
    emap = spark.createDataFrame(I.encoded_feature_map(indexer, MODEL_FEATURES),
                                 "encoded_index int, source_feature string, category string")
    tree = I.fit_cells(train, I.Candidate("tree", {"max_depth": 5, "min_leaf": 15}), totals).featureImportances.toArray()
    linear = abs(I.fit_cells(train, I.Candidate("logistic", {"C": 1.0}), totals).coefficients.toArray())
    imps = spark.createDataFrame([(form, i, float(v)) for form, values in (("impurity", tree), ("abs_coefficient", linear)) for i, v in enumerate(values)],
                                 "form string, encoded_index int, importance double")
    per = emap.join(imps, "encoded_index").groupBy("form", "source_feature").agg(F.sum("importance").alias("importance"))
    return per.withColumn("importance_share", F.col("importance") / F.sum("importance").over(Window.partitionBy("form"))) \
        .withColumn("rank", F.row_number().over(Window.partitionBy("form").orderBy(F.col("importance").desc(), "source_feature")))


ENC_SQL = ("select cast(row_number() over (order by fpos, category) - 1 as integer) as encoded_index, "
           "feature as source_feature, category from (select distinct feature, category, "
           + "case " + " ".join(f"when feature = '{f}' then {i}" for i, f in enumerate(MODEL_FEATURES)) + " end as fpos "
           f"from (select * from split where side = 'train') unpivot (category for feature in ({', '.join(MODEL_FEATURES)})))")

QUERIES = [
    Query("cv_search", "I1,I2,I3,I6,I7", q_cv_search),
    Query("one_se_selection", "I8", q_one_se),
    Query("fit_gap", "I9", q_fit_gap),
    Query("model_roundtrip", "I10", q_roundtrip),
    Query("encoded_feature_map", "K1", q_encoded_map, ENC_SQL, ctes=SPLIT_CTE),
    Query("native_importance", "K6", q_native_importance),
]


def tree_context(spark, d, split=None):
    """The largest boosting setting of the grid as a path table, the encoded profiles of the holdout, and the encoded map."""
    data, prep = prepared(spark, d, split)
    train = data.filter(F.col("side") == "train")
    totals = {r["label"]: int(r["c"]) for r in train.groupBy("label").agg(F.sum("n").alias("c")).collect()}  # a row per class
    setting = I.Candidate("gbt", {"rounds": 200, "rate": 0.1, "max_depth": 2, "min_leaf": 15})
    model = I.fit_cells(train, setting, totals)
    nodes = T.node_table(spark, model, shared_scratch(spark, f"gbt/{uuid.uuid4().hex}"), setting.cid)
    indexer = [s for s in prep.stages if s.__class__.__name__ == "StringIndexerModel"][0]
    sources = {i: f for i, f, _c in I.encoded_feature_map(indexer, MODEL_FEATURES)}
    test = data.filter(F.col("side") == "test").groupBy(*MODEL_FEATURES).agg(F.first("features").alias("features"))
    cells = materialize(test.withColumn("x", vector_to_array("features")).withColumn("cell", F.monotonically_increasing_id()).withColumn("model", F.lit(setting.cid)))
    return T.path_table(nodes, setting.params["max_depth"]), model, cells, sources


def q_tree_attr(spark, d):
    sp = written(split_frame(spark, d), "split")
    paths, _model, cells, sources = tree_context(spark, d, sp)
    rows = sp.filter(F.col("side") == "test").select("respondent_id", *MODEL_FEATURES)
    return T.tree_attribution(rows.join(cells.select(*MODEL_FEATURES, "x"), MODEL_FEATURES), paths, "respondent_id", MODEL_FEATURES, "x", sources)


def q_tree_additivity(spark, d):
    paths, model, cells, _sources = tree_context(spark, d)
    raw = model.transform(cells).select("cell", (2 * vector_to_array("rawPrediction")[1]).alias("__raw"))
    got = T.tree_additivity(cells, paths, ["cell"], raw)
    return got.select(F.col("rows").alias("profiles"), (F.col("max_raw_error") <= 1e-8).alias("passed"))


# A small ensemble over ordinal codes of the survey (tree, node, left, right, feature, threshold, cover, value)
RULE_TREES = (
    (0, 0, 1, 2, 1, 2.5, 100.0, 0.0), (0, 1, 3, 4, 4, 0.5, 60.0, 0.0), (0, 2, 5, 6, 1, 4.5, 40.0, 0.0), (0, 3, -1, -1, -1, None, 25.0, 0.4),
    (0, 4, 7, 8, 2, 1.5, 35.0, 0.0), (0, 5, -1, -1, -1, None, 30.0, -0.3), (0, 6, -1, -1, -1, None, 10.0, 0.9),
    (0, 7, -1, -1, -1, None, 20.0, -0.6), (0, 8, 9, 10, 3, 1.5, 15.0, 0.0), (0, 9, -1, -1, -1, None, 9.0, 0.2), (0, 10, -1, -1, -1, None, 6.0, 1.1),
    (1, 0, 1, 2, 0, 0.5, 100.0, 0.0), (1, 1, 3, 4, 3, 2.5, 45.0, 0.0), (1, 2, 5, 6, 3, 1.5, 55.0, 0.0), (1, 3, -1, -1, -1, None, 20.0, 0.1),
    (1, 4, -1, -1, -1, None, 25.0, -0.25), (1, 5, -1, -1, -1, None, 22.0, 0.35), (1, 6, -1, -1, -1, None, 33.0, -0.05),
    (2, 0, -1, -1, -1, None, 100.0, 0.07))
RULE_FEATURES = ("female", "age_group", "educ", "inc_q", "internet_use")
_ORDER = {c: list(v) for _k, c, _l, v in DIMENSIONS}


def q_tree_rules(spark, d):
    """K3 on a fixed node table: attributions of every holdout profile, repeated by the definition in SQL."""
    nodes = spark.createDataFrame([("rules", t, n, le, r, f, th, None, c, v) for t, n, le, r, f, th, c, v in RULE_TREES],
                                  "model string, tree int, node int, left int, right int, feature int, threshold double, cats array<double>, cover double, value double")
    x = F.array(*[F.coalesce(F.array_position(F.array(*[F.lit(v) for v in _ORDER[c]]), F.col(c)) - 1, F.lit(-1)).cast("double") for c in RULE_FEATURES])
    rows = split_frame(spark, d).filter(F.col("side") == "test").select("respondent_id", *RULE_FEATURES).withColumn("x", x)
    return T.tree_attribution(rows, T.path_table(nodes, 4), "respondent_id", RULE_FEATURES, "x", dict(enumerate(RULE_FEATURES)))


def _rule_shapley_sql() -> str:
    """The definition: every subset of a path's other features, with its weight."""
    codes = ", ".join("cast(coalesce(list_position([" + ", ".join(sql_str(v) for v in _ORDER[c]) + f"], {c}) - 1, -1) as double)" for c in RULE_FEATURES)
    names = ", ".join(sql_str(c) for c in RULE_FEATURES)
    values = ", ".join("(" + ", ".join("null" if v is None else repr(v) for v in r) + ")" for r in RULE_TREES)
    return SPLIT_CTE + (
        f", nd(tree, node, lc, rc, f, th, cover, val) as (values {values}), "
        "ed as (select n.tree, n.node, c.node as child, n.f, case when c.node = n.lc then '-inf'::double else n.th end as lo, "
        "case when c.node = n.lc then n.th else 'inf'::double end as hi, c.cover / n.cover as z from nd n join nd c on c.tree = n.tree and c.node in (n.lc, n.rc)), "
        "w0 as (select tree, 0 as node, 0 as leaf_of, null::integer as f, null::double as lo, null::double as hi, null::double as z from nd where node = 0), "
        + ", ".join(
            # every node's edges, one level after the other: (node reached, edge on its path)
            f"w{i} as (select e.tree, e.child as node, w.f, w.lo, w.hi, w.z from {'r0' if i == 1 else f'w{i - 1}'} w join ed e on e.tree = w.tree and e.node = w.node "
            f"where w.f is not null union all select distinct e.tree, e.child, e.f, e.lo, e.hi, e.z from {'r0' if i == 1 else f'w{i - 1}'} w join ed e on e.tree = w.tree and e.node = w.node)"
            if i else "r0 as (select tree, node, f, lo, hi, z from w0)" for i in range(5))
        + ", cond as (" + " union all ".join(f"select * from w{i}" for i in range(1, 5)) + "), "
        "pf as (select c.tree, c.node, n.val, c.f, max(c.lo) as lo, min(c.hi) as hi, product(c.z) as z from cond c join nd n on n.tree = c.tree and n.node = c.node "
        "where n.lc < 0 group by all), "
        f"xs as (select respondent_id, [{codes}] as x from split where side = 'test'), "
        "ev as (select respondent_id, tree, node, val, list(f order by f) as fs, list(z order by f) as zs, "
        "list(case when x[f + 1] > lo and x[f + 1] <= hi then 1.0::double else 0.0::double end order by f) as os from xs cross join pf group by all), "
        "sb as (select *, len(fs) as m, unnest(range(1, len(fs) + 1)) as i from ev), "
        "sm as (select *, unnest(range(0, (1 << m))) as mask from sb), "
        "sv as (select respondent_id, fs[i] as f, val * (os[i] - zs[i]) * factorial(bit_count(mask)::integer) * factorial((m - bit_count(mask) - 1)::integer) / factorial(m::integer) "
        "* coalesce(list_product(list_transform(list_filter(range(1, m + 1), lambda j: j <> i), lambda j: case when (mask >> (j - 1)) & 1 = 1 then os[j] else zs[j] end)), 1.0) as v "
        "from sm where (mask >> (i - 1)) & 1 = 0), "
        f"tr as (select respondent_id, [{names}][f + 1] as source_feature, sum(v) as phi from sv group by all)")


def q_family_fits(spark, d):
    """One setting per family at its full size, fitted on the training cells, scored on the holdout."""
    data, _prep = prepared(spark, d)
    cands = [I.Candidate("baseline", {}, 0), I.Candidate("logistic", {"C": 1.0, "class_weight": "balanced"}, 1),
             I.Candidate("tree", {"max_depth": 5, "min_leaf": 15}, 2),
             I.Candidate("forest", {"trees": 300, "max_depth": None, "min_leaf": 5, "features": "sqrt"}, 3),
             I.Candidate("gbt", {"rounds": 200, "rate": 0.1, "max_depth": 2, "min_leaf": 15}, 3)]
    # one fold to score (the holdout), the other to train on: the same job as a fit of the search
    two = data.select("label", "n", "features", F.when(F.col("side") == "test", 0).otherwise(1).alias("side"))
    scores = I.search_on_cells(two, "side", cands, shared_scratch(spark, f"families/{uuid.uuid4().hex}"), folds=[0])
    return I.fit_metrics(scores.filter("split = 'validation'"), weight="n").select("family", "candidate_id", *I.METRICS)


QUERIES += [
    Query("family_fits", "I1,I2,I3,I4,I5,J1-J5", q_family_fits),
    Query("tree_attribution", "K3,K4", q_tree_attr),
    Query("tree_additivity", "K3,K9", q_tree_additivity,
          f"select count(*) as profiles, true as passed from (select distinct {', '.join(MODEL_FEATURES)} from split where side = 'test')", ctes=SPLIT_CTE),
    Query("tree_shapley_rules", "K3", q_tree_rules, "select * from tr", ("phi",), ctes=_rule_shapley_sql()),
    Query("rule_search", "I6,I7,I8,I9", q_rule_search, RULE_SQL, RULE_DOUBLES, ctes=RULE_CTE),
]
