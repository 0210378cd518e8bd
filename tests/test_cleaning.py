"""Cleaning rules on small text frames."""

from velogrid.operators import cleaning as C
from velogrid.operators.columns import fold_headers, prepare_features, user_header
from velogrid.operators.enrich import add_users
from velogrid.sources import files


def raw(spark, rows, columns):
    return spark.createDataFrame([tuple(r) for r in rows], ", ".join(f"`{c}` string" for c in columns))


def test_durations_and_origins(spark):
    df = raw(
        spark,
        [("1", "1,234", "5"), ("2", "59", "5"), ("3", "60", "5"), ("4", "x", "5"), ("5", None, "5"), ("6", "70", None), ("7", "80.0", "5BAEcobici")],
        ["id_recorrido", "duracion_recorrido", "id_estacion_origen"],
    )
    got = {r["id_recorrido"]: (r["duracion_recorrido"], r["id_estacion_origen"]) for r in C.clean_trips(df).collect()}
    assert got == {1: (1234, 5), 3: (60, 5), 7: (80, 5)}


def test_headers_fold_and_both_gender_columns_merge(spark):
    df = raw(spark, [("1", "MALE", None), ("2", None, "FEMALE"), ("3", None, None)], ["ID_Recorrido", "genero", "Género"])
    got = fold_headers(df)
    assert got.columns == ["id_recorrido", "genero"]
    assert [r["genero"] for r in got.orderBy("id_recorrido").collect()] == ["MALE", "FEMALE", None]


def test_renames_and_drops_ignore_missing_names(spark):
    df = raw(spark, [("1", "9", "FEMALE", "2")], ["id_recorrido", "X", "Género", "a.b"])
    from velogrid.operators.columns import drop_and_rename

    assert drop_and_rename(df, ["X", "no"], {"Género": "genero", "zz": "y"}).columns == ["id_recorrido", "genero", "a.b"]


COORD = ["id_recorrido", "duracion_recorrido", "id_estacion_origen", "lat_estacion_origen", "long_estacion_origen"]


def coords(df):
    return {
        r["id_recorrido"]: tuple(None if v is None else round(v, 4) for v in (r["lat_estacion_origen"], r["long_estacion_origen"]))
        for r in C.clean_trips(df).collect()
    }


def test_one_comma_makes_the_whole_column_packed(spark):
    df = raw(spark, [("1", "90", "5", "-34.59,-58.37", "-1"), ("2", "90", "5", "-34.6", "-58.4"), ("3", "90", "5", None, "-58.4")], COORD)
    assert coords(df) == {1: (-34.59, -58.37), 2: (-34.6, None), 3: (None, None)}


def test_without_commas_only_decimal_marks_are_repaired(spark):
    df = raw(spark, [("1", "90", "5", "-34.59", "-58,37"), ("2", "90", "5", "x", "-58.4")], COORD)
    assert coords(df) == {1: (-34.59, -58.37), 2: (None, -58.4)}


def test_large_ids_stay_exact(spark):
    df = raw(spark, [("9007199254740993BAEcobici", "90", "12.0")], ["id_recorrido", "duracion_recorrido", "id_estacion_origen"])
    row = C.clean_trips(df).first()
    assert (row["id_recorrido"], row["id_estacion_origen"]) == (9007199254740993, 12)


def test_ages(spark):
    ages = [" 25", "1,0", "25.0", "N/A", "9", "10", "100", "101", "1,000", None, "99999999999", "-30"]
    users = raw(spark, [(str(i), a) for i, a in enumerate(ages)], ["id_usuario", "edad_usuario"])
    got = {r["id_usuario"]: r["edad_usuario"] for r in C.clean_users(users).collect()}
    assert got == {0: 25, 1: 10, 5: 10, 6: 100}


def test_user_headers():
    assert user_header("Customer.Has.Dni..Yes...No.") == "customer_has_dni_yes__no_"
    assert user_header("ID usuario") == "idusuario" and user_header("Edad..Usuario") == "edad_usuario"


def test_null_users_never_match_and_repeats_multiply(spark, make_trips):
    trips = make_trips({"id_usuario": None}, {"id_usuario": 1}, {"id_usuario": 2}, {"id_usuario": 3})
    users = spark.createDataFrame([(None, 50), (1, 20), (1, 21), (2, 30)], "id_usuario bigint, edad_usuario int")

    def ages(df):
        return sorted((r["id_recorrido"], r["edad_usuario"]) for r in df.select("id_recorrido", "edad_usuario").collect() if r["edad_usuario"])

    for salt in (1, 8):
        joined = add_users(trips, users, salt=salt)
        assert joined.count() == 5 and ages(joined) == [(1, 20), (1, 21), (2, 30)]
    once = add_users(trips, users, dedupe=True)
    assert once.count() == 4 and ages(once) == [(1, 20), (2, 30)]
    assert add_users(trips, None) is trips


def test_a_user_join_without_broadcast_gives_the_same(spark, make_trips):
    trips = make_trips(*[{"id_usuario": i % 5 or None} for i in range(40)])
    users = spark.createDataFrame([(i, 20 + i) for i in range(5)], "id_usuario bigint, edad_usuario int")
    small = sorted(map(str, add_users(trips, users).collect()))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert sorted(map(str, add_users(trips, users, salt=3).collect())) == small
        plain = add_users(trips, users)
        assert sorted(map(str, plain.collect())) == small
        # the spread of trips without a user is part of the shuffle key
        plan = plain._jdf.queryExecution().executedPlan().toString()
        keys = [line for line in plan.splitlines() if "hashpartitioning(id_usuario#" in line]
        assert keys and all("_part#" in line.split("hashpartitioning")[1].split(")")[0] for line in keys)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_cut_months_and_days(spark):
    stamps = ["2023-12-31 23:59:59", "2024-08-31 23:59:59", "2024-09-01 00:00:00", "2024-12-31 23:59:59", "2025-01-01 00:00:00", None]
    df = raw(spark, [(s,) for s in stamps], ["t"]).selectExpr("cast(t as timestamp_ntz) as fecha_destino_recorrido")
    df = df.withColumnRenamed("fecha_destino_recorrido", "timestamp").selectExpr("timestamp", "timestamp as fecha_destino_recorrido")
    assert C.train_part(df).count() == 2 and C.test_part(df).count() == 2
    assert C.train_part(df, 2024, 12).count() == 4
    assert C.on_day(df, "2024-08-31").count() == 1
    assert C.at_instants(df, ["2024-09-01 00:00:00", "2000-01-01 00:00:00"]).count() == 1


def test_day_filters_reach_the_scan(spark, tmp_path):
    df = spark.sql("select timestamp_ntz '2024-01-01 00:00:00' as timestamp, 1 as id_estacion")
    df.write.parquet(str(tmp_path / "t"))
    plan = C.on_day(spark.read.parquet(str(tmp_path / "t")), "2024-01-01")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(timestamp" in plan and "LessThan(timestamp" in plan


def test_usable_coordinates(spark):
    df = spark.createDataFrame(
        [(1, -34.0, -58.0), (2, 0.0, -58.0), (3, None, -58.0), (4, float("nan"), -58.0)], "i int, lat_estacion double, lng_estacion double"
    )
    assert [r["i"] for r in C.usable_coordinates(df).collect()] == [1]


def test_prepared_features_fill_and_order(spark):
    df = spark.createDataFrame([(1, None, "x")], "b int, a double, other string")
    got = prepare_features(df, ["a", "b", "c"], keep=["other"])
    assert got.columns == ["other", "a", "b", "c"] and tuple(got.first()) == ("x", 0.0, 1, 0)


def test_read_years_and_users(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        'Unnamed: 0,Id_recorrido,duracion_recorrido,id_estacion_origen,Género,fecha_origen_recorrido,fecha_destino_recorrido\n'
        '0,1BAEcobici,"1,200",7BAEcobici,FEMALE,2022-01-01 10:00:00,2022-01-01 10:20:00\n',
        encoding="utf-8",
    )
    (tmp_path / "b.csv").write_text("id_recorrido,duracion_recorrido,id_estacion_origen\n2,70,8\n3,10,8\n")
    years = [files.YearFile(str(tmp_path / "a.csv"), ("Unnamed: 0",)), files.YearFile(str(tmp_path / "b.csv")), files.YearFile(str(tmp_path / "none.csv"), use=False)]
    got = files.read_years(spark, years).orderBy("id_recorrido").collect()
    assert [(r["id_recorrido"], r["duracion_recorrido"], r["id_estacion_origen"], r["genero"]) for r in got] == [(1, 1200, 7, "FEMALE"), (2, 70, 8, None)]
    (tmp_path / "u.csv").write_text("ID_usuario,genero.usuario,Edad usuario,Customer.Has.Dni..Yes...No.,fecha_alta\n5,F,30,Yes,2020-01-02\n")
    users = files.read_users(spark, {str(tmp_path / "u.csv"): True})
    assert users.columns == ["id_usuario", "genero_usuario", "edadusuario", "fecha_alta"]


def _csv_folder(tmp_path, **files):
    for name, text in files.items():
        (tmp_path / f"{name}.csv").write_text(text)
    return str(tmp_path)


HEAD = "id_estacion_origen,duracion_recorrido,genero,lat_estacion_origen,long_estacion_origen"


def test_files_with_other_header_orders_lose_no_rows(spark, tmp_path):
    folder = _csv_folder(
        tmp_path, a=f"{HEAD}\n7,600,MALE,-34.5,-58.4\n", b="duracion_recorrido,genero,id_estacion_origen\n700,FEMALE,8\n"
    )
    for path in (folder, [f"{folder}/a.csv", f"{folder}/b.csv"]):
        rows = {(r.id_estacion_origen, r.duracion_recorrido, r.genero, r.lat_estacion_origen) for r in files.read_trips(spark, path).collect()}
        assert rows == {(7, 600, "MALE", -34.5), (8, 700, "FEMALE", None)}


def test_packed_coordinates_are_found_per_file(spark, tmp_path):
    folder = _csv_folder(tmp_path, a=f'{HEAD}\n7,600,MALE,"-34.5,-58.25",\n', b=f"{HEAD}\n8,600,MALE,-34.75,-58.5\n")
    rows = {(r.id_estacion_origen, r.lat_estacion_origen, r.long_estacion_origen) for r in files.read_trips(spark, folder).collect()}
    assert rows == {(7, -34.5, -58.25), (8, -34.75, -58.5)}


def test_missing_markers_and_ids_with_a_fraction(spark, tmp_path):
    folder = _csv_folder(tmp_path, a=f"{HEAD}\n7.0,600,NA,NaN,null\n2.7,600,MALE,-34.5,-58.5\n")
    (row,) = files.read_trips(spark, folder).collect()
    assert (row.id_estacion_origen, row.genero, row.lat_estacion_origen, row.long_estacion_origen) == (7, None, None, None)
