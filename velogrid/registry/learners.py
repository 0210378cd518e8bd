"""Queries of learners, saved models and their checks, in cases that SQL can state."""

from __future__ import annotations

from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import functions as F

from velogrid.operators import boosting as B
from velogrid.operators import enrich as E
from velogrid.operators import learning as L
from velogrid.operators import leafwise as W
from velogrid.operators.columns import drop_prefixed
from velogrid.registry import parts
from velogrid.registry.queries import GROUP_MEANS, SLIM, _by_weekend, b, query, split, staged_grid, users, valid
from velogrid.schemas import BASE_FEATURES, TARGET
from velogrid.session import work_path
from velogrid.sources.models import load_version, save_version

# --- patience ---------------------------------------------------------------

PATIENCE = 4


@query(
    "patience_of_one_flag",
    parts.sql(
        ["train", "val"],
        f"""select cast(n as bigint) as ronda, round(e, 6) as error_val, n = 1 as elegida from range(1, {PATIENCE + 2}) t(n), (
  select avg(power(v.arribos_count - m.media, 2)) as e from val v
  join (select cast(es_fin_semana as bigint) as f, avg(arribos_count) as media from train group by 1) m on cast(v.es_fin_semana as bigint) = m.f)""",
    ),
)
def patience_of_one_flag(spark, folder):
    """The validation error of every round. The first tree finds the group means, so no later round gains, and after the patience the fit ends."""
    train, val = split(spark, folder, [*SLIM, "es_fin_semana"])
    fit = B.fit_patient_trees(train, val, ["es_fin_semana"], patience=PATIENCE, depth=1, subsample=1.0, columns="all")
    return fit.curve(train).withColumn("ronda", F.col("ronda").cast("bigint"))


PATIENT = {"depth": 3, "step": 0.3, "patience": 3, "subsample": 1.0, "columns": "all", "bins": 32}


@query(
    "patience_checks",
    parts.sql(
        ["val"],
        """select prueba, cast(valor as bigint) as valor from (values ('elegida no es la de menor error', 0), ('rondas tras la paciencia', 0),
  ('error del modelo distinto del de su ronda', 0), ('filas', (select count(*) from val))) t(prueba, valor)""",
    ),
)
def patience_checks(spark, folder):
    """A fit on the plain features: its curve against its choice, and the model that it keeps against the curve."""
    train, val = split(spark, folder, ["timestamp", TARGET, *BASE_FEATURES])
    fit = B.fit_patient_trees(train, val, **PATIENT)
    curve = fit.curve(train)
    best = curve.where("elegida").select("error_val").scalar()
    late = curve.where(F.col("ronda") > fit.best + PATIENT["patience"])
    scored = fit.model.transform(B.vectors(val, BASE_FEATURES, [TARGET]))
    own = F.avg(F.pow(F.col(TARGET) - F.col("arribos_predichos"), 2))
    rows = [
        curve.where(F.col("error_val") < best * (1 - 1e-9)).agg(F.count("*")).select(F.lit("elegida no es la de menor error"), "*"),
        late.agg(F.count("*")).select(F.lit("rondas tras la paciencia"), "*"),
        scored.agg((F.abs(own - best) > 1e-9).cast("bigint")).select(F.lit("error del modelo distinto del de su ronda"), "*"),
        val.agg(F.count("*")).select(F.lit("filas"), "*"),
    ]
    out = rows[0]
    for row in rows[1:]:
        out = out.union(row)
    return out.toDF("prueba", "valor")


# --- trees grown leaf by leaf -----------------------------------------------


@query("leafwise_tree_of_one_flag", parts.sql(["train", "val"], GROUP_MEANS), digits=4)
def leafwise_tree_of_one_flag(spark, folder):
    """One split over all rows predicts the group means."""
    train, val = split(spark, folder, [*SLIM, "es_fin_semana"])
    return _by_weekend(W.fit_leafwise_trees(train, None, ["es_fin_semana"], rounds=1, leaves=2, step=1.0).predict(val))


@query("poisson_trees_of_one_flag", parts.sql(["train", "val"], GROUP_MEANS), digits=4)
def poisson_trees_of_one_flag(spark, folder):
    """Newton steps on a count's loss come to the group means, here within a few rounds."""
    train, val = split(spark, folder, [*SLIM, "es_fin_semana"])
    return _by_weekend(W.fit_leafwise_trees(train, None, ["es_fin_semana"], rounds=5, leaves=2, step=1.0, loss="poisson").predict(val))


FIRST = ["es_fin_semana", "dia_semana", "hora"]
_CUTS = " union all ".join(f"select {i} as f, '{c}' as c, cast({c} as bigint) as x, count(*) as n, sum(arribos_count - (select avg(arribos_count) from train)) as s from train group by 3" for i, c in enumerate(FIRST))


@query(
    "leafwise_first_split",
    parts.sql(
        ["train"],
        f"""select c as caracteristica, cast(x as double) as umbral, cast(l as bigint) as filas_izquierda, cast(t - l as bigint) as filas_derecha, round(gain, 4) as ganancia from (
  select *, g * g / l + (w - g) * (w - g) / (t - l) - w * w / t as gain from (
    select *, sum(n) over k as l, sum(s) over k as g, sum(n) over (partition by f) as t, sum(s) over (partition by f) as w from ({_CUTS}) window k as (partition by f order by x))
  where l < t) order by gain desc, f, x limit 1""",
    ),
    digits=4,
)
def leafwise_first_split(spark, folder):
    """The split with the largest gain of all features and values."""
    train, _ = split(spark, folder, ["timestamp", TARGET, *FIRST])
    (tree,) = W.fit_leafwise_trees(train, None, FIRST, rounds=1, leaves=2, step=1.0, bins=256, least=1).trees
    row = (tree.feature, float(tree.threshold), tree.left.rows, tree.right.rows, float(tree.gain))
    return spark.createDataFrame([row], "caracteristica string, umbral double, filas_izquierda bigint, filas_derecha bigint, ganancia double")


@query(
    "leafwise_checks",
    parts.sql(["val"], "select count(*) as filas, cast(0 as bigint) as nulos, cast(0 as bigint) as negativos, cast(0 as bigint) as distintos, true as mejor_que_la_media from val"),
)
def leafwise_checks(spark, folder):
    """All validation rows scored by trees on the plain features, also after the model went through JSON; on train closer than the plain mean."""
    train, val = split(spark, folder, ["timestamp", TARGET, *BASE_FEATURES])
    model = W.fit_leafwise_trees(train, val, rounds=3, leaves=6, step=0.3, bins=32)
    again = W.LeafwiseModel.of_json(model.to_json())
    key = ["timestamp", "id_estacion"]
    both = model.predict(val).join(again.predict(val).select(*key, F.col("arribos_predichos").alias("otra")), key)
    p = F.col("arribos_predichos")
    better = model.predict(train).agg((F.avg(F.pow(F.col(TARGET) - p, 2)) < F.var_pop(TARGET)).alias("x")).scalar()
    return both.agg(F.count("*").alias("filas"), F.count_if(p.isNull()).alias("nulos"), F.count_if(p < 0).alias("negativos"), F.count_if(~p.eqNullSafe(F.col("otra"))).alias("distintos")).withColumn("mejor_que_la_media", better)


# --- active intervals, saved models -----------------------------------------

_QUIET = """not (despachos_count <= (select quantile_cont(despachos_count, 0.97) from train)
  and arribos_count <= (select quantile_cont(arribos_count, 0.97) from train))"""


@query(
    "active_model_scores",
    parts.sql(["train", "val"], f"""select "timestamp", cast(id_estacion as bigint) as id_estacion, cast(arribos_count as bigint) as arribos_count,
  false as sin_prediccion, false as negativa, false as distinta from val where {_QUIET}"""),
)
def active_model_scores(spark, folder):
    """The rows that a saved and loaded model of the active intervals scores: those above the thresholds of train, as the model before it was saved."""
    train, val = split(spark, folder, ["timestamp", TARGET, *BASE_FEATURES])
    fit = B.fit_active_trees(train, val, share=0.97, rounds=3, patience=2, depth=3)
    path = work_path(spark, "active")
    fit.save(path, train)
    again = B.ActiveTrees.load(spark, path)
    key = ["timestamp", "id_estacion"]
    before = fit.score(val).select(*key, F.col("arribos_predichos").alias("antes"))
    p = F.col("arribos_predichos")
    scored = again.score(val).join(before, key, "left")
    return scored.select(*key, TARGET, p.isNull().alias("sin_prediccion"), (p < 0).alias("negativa"), (~p.eqNullSafe(F.col("antes"))).alias("distinta"))


@query(
    "saved_model_scores",
    parts.sql(["val"], "select cast(1 as bigint) as version, count(*) as filas, cast(0 as bigint) as distintas from val union all select 2, count(*), 0 from val"),
)
def saved_model_scores(spark, folder):
    """Two versions of a model, saved, loaded and used: rows scored, and those that the unsaved model scores otherwise."""
    train, val = split(spark, folder, ["timestamp", TARGET, *BASE_FEATURES])
    path, out = work_path(spark, "model"), None
    fits = [B.fit_patient_trees(train, val, rounds=n, depth=3) for n in (1, 2)]
    for fit in fits:
        save_version(path, fit.model, train, BASE_FEATURES, {"mse": fit.errors[fit.best - 1]})
    key = ["timestamp", "id_estacion"]
    for number, fit in enumerate(fits, 1):
        saved = load_version(spark, path, GBTRegressionModel, number)
        saved.check(val)
        mine = L.predict(saved.model, val, saved.features).join(L.predict(fit.model, val).select(*key, F.col("arribos_predichos").alias("otra")), key)
        row = mine.agg(F.lit(number).cast("bigint").alias("version"), F.count("*").alias("filas"), F.count_if(~F.col("arribos_predichos").eqNullSafe(F.col("otra"))).alias("distintas"))
        out = row if out is None else out.union(row)
    return out


# --- importances ------------------------------------------------------------

PROFILE = ["id_estacion", "dia_semana", "hora"]
_KEY = """md5(concat('42|', strftime("timestamp", '%Y-%m-%d %H:%M:%S'), '|', id_estacion))"""


def _variant(name: str) -> str:
    columns = ", ".join(f"s_{c} as {c}" if c == name else c for c in PROFILE)
    return f"select '{name}' as c, arribos_count, {columns} from s"


@query(
    "permutation_importance",
    parts.sql(
        ["val", "means", "train"],
        f"""select c as caracteristica, round(e, 6) as error, round(e - e0, 6) as importancia from (
  with k as (select *, {_KEY} as h from val),
  s as (select *, {', '.join(f"coalesce(lead({c}) over w, first_value({c}) over w) as s_{c}" for c in PROFILE)} from k window w as (partition by substr(h, 1, 2) order by h)),
  a as ({' union all '.join(_variant(c) for c in ('', *PROFILE))})
  select c, avg(power(a.arribos_count - coalesce(m.m, (select avg(arribos_count) from train)), 2)) as e, max(avg(power(a.arribos_count - coalesce(m.m, (select avg(arribos_count) from train)), 2))) filter (where c = '') over () as e0
  from a left join means m using (id_estacion, dia_semana, hora) group by c) where c <> ''""",
    ),
)
def permutation_importance(spark, folder):
    """How much the profile's error on validation rows grows when a feature is shuffled."""
    train, val = split(spark, folder, ["timestamp", TARGET, *PROFILE])
    return L.permutation_importance(val, PROFILE, lambda rows: L.predict_from_profile(rows, train), ["timestamp", "id_estacion"])


# --- clusters, columns ------------------------------------------------------


@query(
    "cluster_sizes_of_bands",
    parts.sql(
        ["grid"],
        """select case when lat_estacion is null or long_estacion is null or id_estacion % 7 = 0 then -1
    else cast(floor(abs(round(lat_estacion, 6)) * 50) as bigint) % 12 end as cluster_geo, count(*) as filas from grid group by 1""",
    ),
)
def cluster_sizes_of_bands(spark, folder):
    """Rows per cluster where clusters are bands of latitude, and stations of one remainder are in none."""
    rows = staged_grid(spark, folder).select("id_estacion", "lat_estacion", "long_estacion")
    points = rows.where("lat_estacion is not null and long_estacion is not null").withColumns({"_a": F.round("lat_estacion", 6), "_b": F.round("long_estacion", 6)})
    lookup = points.where("id_estacion % 7 <> 0").groupBy("_a", "_b").agg((F.floor(F.abs(F.first("_a")) * 50) % 12).alias("cluster_geo"))
    return L.cluster_sizes(rows, lookup)


DROPPED = ["nombre_", "direccion_", "modelo_", "duracion_", "edad_", "lat_", "long_", "arribos_prev", "proporcion"]
LEFT = ["id_estacion", "despachos_count", "hora", "dia_semana", "es_fin_semana", "mes", "dia_mes", "año", "arribos_count"]


@query("without_prefixed_columns", parts.sql(["grid"], f'select "timestamp", {b(*LEFT)} from grid'))
def without_prefixed_columns(spark, folder):
    rows = drop_prefixed(staged_grid(spark, folder), DROPPED)
    return rows.select(*[F.col(c) if c == "timestamp" else F.col(c).cast("bigint").alias(c) for c in rows.columns])


# --- hot riders -------------------------------------------------------------

#: Every third trip is rider 1's.
_HOT = "case when id_recorrido % 3 = 0 then 1 else id_usuario end"
HOT_PARTITIONS = 8


def hot_trips(spark, folder):
    return valid(spark, folder).withColumn("id_usuario", F.expr(_HOT).cast("bigint"))


@query(
    "hot_riders",
    parts.sql(
        ["valid"],
        f"""select cast(u as bigint) as id_usuario, n as viajes, cast(ceil(n / t) as bigint) as copias from (
  select {_HOT} as u, count(*) as n, (select greatest(count(*) / {E.HOT_PARTS * HOT_PARTITIONS}, 1.0) from valid) as t from valid group by 1) where u is not null and n > t""",
    ),
)
def hot_riders(spark, folder):
    return E.hot_riders(hot_trips(spark, folder), HOT_PARTITIONS)


@query(
    "trips_with_hot_riders",
    parts.sql(
        ["valid", "users"],
        f"""select id_recorrido, cast(u as bigint) as id_usuario, cast(edad_usuario as bigint) as edad_usuario
  from (select *, {_HOT} as u from valid) v left join users r on v.u = r.id_usuario""",
    ),
)
def trips_with_hot_riders(spark, folder):
    """A third of the trips is one rider's; the library finds and splits that rider."""
    joined = E.add_users_balanced(hot_trips(spark, folder), users(spark, folder))
    return joined.select("id_recorrido", "id_usuario", F.col("edad_usuario").cast("bigint").alias("edad_usuario"))
