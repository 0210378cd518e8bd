"""Named building blocks of the SQL counterparts (DuckDB dialect)."""

from __future__ import annotations

from velogrid.schemas import LAGGED, LAGS


def _name(s: str) -> str:
    return (
        f"case when event_id % 9 = 0 then null when event_id % 7 = 0 then concat('EST-', {s}, ' BIS') "
        f"else concat('EST-', {s}) end"
    )


def _station(side: str, s: str) -> str:
    return f"""{s} as id_estacion_{side}, {_name(s)} as nombre_estacion_{side},
  case when event_id % 5 = 0 then null else concat('CALLE ', {s}) end as direccion_estacion_{side},
  case when event_id % 13 = 0 then null when {s} = 40 then 0E0 else -58.36E0 - floor({s} / 10E0) * 0.02E0 end as long_estacion_{side},
  case when event_id % 13 = 0 then null when {s} = 40 then 0E0 else -34.52E0 - ({s} % 10) * 0.01E0 end as lat_estacion_{side}"""


def _raw(packed: bool) -> str:
    """Cleaned rows of the text views, straight from the rules of the dirt."""

    def lat(s):
        return f"cast(concat('-34.', 52 + {s} % 10) as float)"

    def lng(s):
        return f"cast(concat('-58.', 36 + 2 * ({s} // 10)) as float)"

    def long_of(s):
        return (
            f"case when {s} is null or event_id % 11 = 0 then null else {lng(s)} end"
            if packed
            else f"case when {s} is null or event_id % 17 = 0 then null else {lng(s)} end"
        )

    return f"""select event_id as id_recorrido,
  case when event_id % 97 = 0 then null else dur end as duracion_recorrido,
  case when event_id % 31 = 0 then null else so end as id_estacion_origen,
  sd as id_estacion_destino, user_id as id_usuario,
  {lat('so')} as lat_estacion_origen, {long_of('so')} as long_estacion_origen,
  case when sd is null then null else {lat('sd')} end as lat_estacion_destino, {long_of('sd')} as long_estacion_destino,
  case event_type when 'view' then 'ICONIC' when 'click' then 'FIT' end as modelo_bicicleta,
  case event_id % 3 when 0 then 'FEMALE' when 1 then 'MALE' end as genero,
  ts as fecha_origen_recorrido, case when event_id % 41 = 0 then null else ts end as fecha_destino_recorrido
from ends where event_id % 97 <> 0 and dur >= 60 and event_id % 31 <> 0"""


STATION_ROWS = """select {n} as lado, fecha_origen_recorrido as visto, id_estacion_{s} as id_estacion, nombre_estacion_{s} as nombre_estacion,
  direccion_estacion_{s} as direccion_estacion, lat_estacion_{s} as lat_estacion, long_estacion_{s} as long_estacion from {t}"""


def _first_seen(trips: str) -> str:
    rows = STATION_ROWS.format(n=0, s="origen", t=trips) + " union all " + STATION_ROWS.format(n=1, s="destino", t=trips)
    return f"""select id_estacion, nombre_estacion, direccion_estacion, lat_estacion, long_estacion from (
  select *, row_number() over (partition by id_estacion order by lado, visto is null, visto, nombre_estacion nulls first,
    direccion_estacion nulls first, lat_estacion nulls first, long_estacion nulls first) as rn
  from ({rows})) where rn = 1 and id_estacion is not null"""


_LAGS = ", ".join(f"lag({c}, {k}, 0) over w as {c}_prev_{k}" for k in range(1, LAGS + 1) for c in LAGGED)

HOURS_TS = "time_bucket(interval '30 minutes', {c})"

ARRIVALS_HOUR = """case when h between 7 and 9 then {m0} when h between 17 and 19 then {m1} when h between 12 and 14 then {m2}
  when h >= 22 or h <= 6 then {m3} else {e} end"""


def score(h: str, weekend: str) -> str:
    """Expected arrivals of the rule-based estimate; ``pop`` and ``avail`` are columns."""
    band = ARRIVALS_HOUR.format(m0=8, m1=12, m2=4, m3=-2, e=0).replace("h between", f"{h} between").replace("h >=", f"{h} >=").replace("h <=", f"{h} <=")
    base = f"(5 + floor(pop / 100 * 15 + 0.5) + {band})"
    return f"""cast(greatest(1, least(50, case when {weekend} then floor({base} * 0.6 + 0.5) else {base} end
  + case when avail > 0.8 then 2 when avail < 0.2 then -3 else 0 end)) as bigint)"""


def confidence(h: str, weekend: str) -> str:
    band = ARRIVALS_HOUR.format(m0=10, m1=15, m2=5, m3=-10, e=0).replace("h between", f"{h} between").replace("h >=", f"{h} >=").replace("h <=", f"{h} <=")
    return f"""cast(greatest(50, least(95, 70 + {band} + case when {weekend} then -5 else 5 end
  + case when avail < 0.2 then -10 else 0 end)) as bigint)"""


# name -> (names it needs, body)
PARTS: dict[str, tuple[list[str], str]] = {
    "ends": (
        [],
        """select *, user_id % 40 + 1 as so, case when event_id % 50 = 0 then null else (user_id * 7 + event_id) % 40 + 1 end as sd,
  cast(floor(value * 20) as int) as dur from events""",
    ),
    "trips": (
        ["ends"],
        f"""select event_id as id_recorrido, dur as duracion_recorrido, {_station('origen', 'so')}, {_station('destino', 'sd')},
  user_id as id_usuario,
  case event_type when 'view' then 'ICONIC' when 'purchase' then 'ICONIC' when 'click' then 'FIT' end as modelo_bicicleta,
  case event_id % 3 when 0 then 'FEMALE' when 1 then 'MALE' end as genero,
  ts as fecha_origen_recorrido, ts + to_seconds(dur) as fecha_destino_recorrido from ends""",
    ),
    "valid": (["trips"], "select * from trips where duracion_recorrido >= 60 and id_estacion_origen is not null"),
    "packed": (["ends"], _raw(True)),
    "comma": (["ends"], _raw(False)),
    "users_raw": (
        [],
        """select c_custkey as id_usuario, case when c_custkey % 17 = 0 then 'N/A' when c_custkey % 11 = 0 then '1,0'
  else concat(' ', cast(cast(floor(abs(c_acctbal) / 90) as int) as varchar)) end as edad_usuario from customer""",
    ),
    "ages": (
        ["users_raw"],
        """select id_usuario, edad_usuario as original, trim(replace(edad_usuario, ',', '')) as texto,
  case when regexp_full_match(trim(replace(edad_usuario, ',', '')), '[0-9]+') then try_cast(trim(replace(edad_usuario, ',', '')) as int) end as edad
  from users_raw""",
    ),
    "users": (["ages"], "select id_usuario, edad as edad_usuario from ages where edad between 10 and 100"),
    "enriched": (["valid", "users"], "select t.*, u.edad_usuario from valid t left join users u on t.id_usuario = u.id_usuario"),
    "dep": (
        ["enriched"],
        """select time_bucket(interval '30 minutes', fecha_origen_recorrido) + interval '30 minutes' as ts, id_estacion_origen as id_estacion,
  count(*) as despachos_count, avg(duracion_recorrido) as duracion_recorrido_mean,
  coalesce(stddev_samp(duracion_recorrido), 0) as duracion_recorrido_std, count(duracion_recorrido) as duracion_recorrido_count,
  coalesce(avg(edad_usuario), 0) as edad_usuario_mean, coalesce(stddev_samp(edad_usuario), 0) as edad_usuario_std,
  count(*) filter (where genero = 'FEMALE') / count(*) as proporcion_mujeres
  from enriched group by 1, 2""",
    ),
    "modes": (
        ["enriched"],
        """select ts, id_estacion, modelo from (select *, row_number() over (partition by ts, id_estacion order by n desc, modelo) as rn from (
    select time_bucket(interval '30 minutes', fecha_origen_recorrido) + interval '30 minutes' as ts, id_estacion_origen as id_estacion,
      modelo_bicicleta as modelo, count(*) as n from enriched where modelo_bicicleta is not null group by 1, 2, 3)) where rn = 1""",
    ),
    "arr": (
        ["valid"],
        """select time_bucket(interval '30 minutes', fecha_destino_recorrido) as ts, id_estacion_destino as id_estacion, count(*) as arribos_count
  from valid where id_estacion_destino is not null and fecha_destino_recorrido is not null group by 1, 2""",
    ),
    "stations": (["valid"], _first_seen("valid")),
    "all_stations": (["trips"], _first_seen("trips")),
    "span": (
        ["valid"],
        """select min(time_bucket(interval '30 minutes', fecha_origen_recorrido)) + interval '30 minutes' as desde,
  max(time_bucket(interval '30 minutes', fecha_destino_recorrido)) as hasta from valid""",
    ),
    "skeleton": (
        ["span", "stations"],
        "select t.ts, s.* from (select unnest(generate_series(desde, hasta, interval '30 minutes')) as ts from span) t cross join stations s",
    ),
    "grid": (
        ["skeleton", "dep", "modes", "arr"],
        """select s.ts as "timestamp", s.id_estacion, nombre_estacion, direccion_estacion, lat_estacion, long_estacion,
  coalesce(d.despachos_count, 0) as despachos_count, coalesce(d.duracion_recorrido_mean, 0) as duracion_recorrido_mean,
  coalesce(d.duracion_recorrido_std, 0) as duracion_recorrido_std, coalesce(d.duracion_recorrido_count, 0) as duracion_recorrido_count,
  coalesce(d.edad_usuario_mean, 0) as edad_usuario_mean, coalesce(d.edad_usuario_std, 0) as edad_usuario_std,
  coalesce(d.proporcion_mujeres, 0) as proporcion_mujeres, coalesce(m.modelo, 'UNKNOWN') as modelo_mas_comun,
  coalesce(a.arribos_count, 0) as arribos_count, coalesce(p.arribos_count, 0) as arribos_prev_count,
  hour(s.ts) as hora, isodow(s.ts) - 1 as dia_semana, cast(isodow(s.ts) >= 6 as int) as es_fin_semana,
  month(s.ts) as mes, day(s.ts) as dia_mes, year(s.ts) as "año"
  from skeleton s left join dep d on s.ts = d.ts and s.id_estacion = d.id_estacion
  left join modes m on s.ts = m.ts and s.id_estacion = m.id_estacion
  left join arr a on s.ts = a.ts and s.id_estacion = a.id_estacion
  left join arr p on s.ts = p.ts + interval '30 minutes' and s.id_estacion = p.id_estacion""",
    ),
    "lagged": (["grid"], f'select *, {_LAGS} from grid window w as (partition by id_estacion order by "timestamp")'),
    "days": (
        ["grid"],
        """select fecha from (select fecha, row_number() over (partition by year(fecha), month(fecha), weekofyear(fecha)
    order by md5('42|' || cast(fecha as varchar))) as rn from (select distinct cast("timestamp" as date) as fecha from grid)) where rn = 1""",
    ),
    "train": (["grid", "days"], 'select * from grid where cast("timestamp" as date) not in (select fecha from days)'),
    "val": (["grid", "days"], 'select * from grid where cast("timestamp" as date) in (select fecha from days)'),
    "means": (["train"], "select id_estacion, dia_semana, hora, avg(arribos_count) as m from train group by 1, 2, 3"),
    "pred": (
        ["val", "means", "train"],
        """select v.*, coalesce(m.m, (select avg(arribos_count) from train)) as arribos_predichos
  from val v left join means m on v.id_estacion = m.id_estacion and v.dia_semana = m.dia_semana and v.hora = m.hora""",
    ),
    "pred_train": (
        ["means", "train"],
        """select v.*, m.m as arribos_predichos from train v
  join means m on v.id_estacion = m.id_estacion and v.dia_semana = m.dia_semana and v.hora = m.hora""",
    ),
    "errors": (
        ["pred"],
        """select *, abs(arribos_count - arribos_predichos) as error_prediccion,
  least(greatest(1 - abs(arribos_count - arribos_predichos) / greatest(1, arribos_count), 0), 1) as accuracy from pred""",
    ),
    "traffic": (
        ["trips"],
        """select id_estacion, count(*) as trafico from (select id_estacion_origen as id_estacion from trips
  union all select id_estacion_destino from trips) where id_estacion is not null group by 1""",
    ),
    "catalog": (
        ["all_stations", "traffic"],
        """select *, round_even(cast(total_trips as double) / max(total_trips) over () * 100, 1) as popularity_score from (
  select s.id_estacion as id, nombre_estacion as name, direccion_estacion as address, lat_estacion as lat, long_estacion as lng,
    coalesce(trafico, 0) as total_trips from all_stations s left join traffic t on s.id_estacion = t.id_estacion
  where lat_estacion between -35 and -34 and long_estacion between -59 and -58)""",
    ),
    "stock": (
        ["catalog"],
        """select *, case when available_bikes = 0 then 'empty' when available_bikes >= total_docks * 0.8 then 'full' else 'active' end as status
  from (select *, id * 7 % 30 as available_bikes, id * 7 % 30 + id * 5 % 15 as total_docks from catalog)""",
    ),
    "rated": (
        ["stock"],
        """select *, popularity_score as pop, available_bikes / (case when total_docks = 0 then 20 else total_docks end) as avail from stock""",
    ),
    "comparison": (
        ["errors", "all_stations"],
        """select e.id_estacion, coalesce(s.nombre_estacion, 'Estación ' || e.id_estacion) as nombre_estacion,
  coalesce(lat, 0) as lat_estacion, coalesce(lng, 0) as lng_estacion, arribos_reales, salidas_reales,
  cast(trunc(round(predichos, 6)) as bigint) as arribos_predichos, error_prediccion, accuracy,
  arribos_reales + salidas_reales as total_viajes, duracion_promedio from (
    select id_estacion, max(lat_estacion) as lat, max(long_estacion) as lng, cast(sum(arribos_count) as bigint) as arribos_reales,
      cast(sum(despachos_count) as bigint) as salidas_reales, sum(arribos_predichos) as predichos, avg(error_prediccion) as error_prediccion,
      avg(accuracy) as accuracy, avg(duracion_recorrido_mean) as duracion_promedio from errors {where} group by 1) e
  left join all_stations s on e.id_estacion = s.id_estacion""",
    ),
}


def needed(names: list[str]) -> list[str]:
    """``names`` and all they build on, in order."""
    out: list[str] = []

    def visit(name: str) -> None:
        for other in PARTS[name][0]:
            visit(other)
        if name not in out:
            out.append(name)

    for n in names:
        visit(n)
    return out


def sql(names: list[str], body: str, **fill: str) -> str:
    """A statement over the given parts. ``fill`` sets the open places of a part."""
    fill = {"where": "", **fill}
    ctes = []
    for n in needed(names):
        part = PARTS[n][1]
        if n == "comparison":
            part = part.format(**fill)
        ctes.append(f"{n} as ({part})")
    return ("with " + ",\n".join(ctes) + "\n" if ctes else "") + body
