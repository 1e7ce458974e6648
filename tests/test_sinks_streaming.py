"""Landing, inventory, lookups, unique-key table writes and the ingest stream."""

import os

from rankwell.sources import rawfiles as RF
from rankwell.sources import sinks
from rankwell.streaming import ingest

def test_lookups_from_files(spark, tmp_path):
    for name, text in {"u.genre": "unknown|0\naction|1\n\n", "u.occupation": "artist\nwriter\n", "u.info": "3 users\n2 items\n7 ratings\n",
                       "u.user": "1|24|M|technician|85711\n2|53|F|other|94043\n3|x|F|caf\xe9|\n"}.items():
        (tmp_path / name).write_bytes(text.encode("latin-1"))
    lines = lambda name: RF.read_lines(spark, str(tmp_path / name))
    genres = RF.parse_lookup_names(lines("u.genre"), r"\|")
    assert {(r.id, r.name) for r in genres.collect()} == {(0, "unknown"), (1, "action")}
    assert RF.parse_lookup_names(lines("u.occupation")).count() == 2
    assert {r.label: r.n for r in RF.parse_info(lines("u.info")).collect()} == {"users": 3, "items": 2, "ratings": 7}
    users = {r.user_id: r for r in RF.parse_users(lines("u.user")).collect()}
    assert len(users) == 3 and users[1].age == 24 and users[3].age is None and users[3].occupation == "café"


def test_land_and_inventory(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    (src / "u.user").write_text("1|24|M|technician|85711\n")
    (src / "u.data").write_text("1\t1\t5\t874965758\n")
    manifest = {r.file: r for r in sinks.land_raw(spark, str(src), str(tmp_path / "dst")).collect()}
    assert manifest["u.user"].status == "uploaded" and manifest["u.item"].status == "missing"
    assert (tmp_path / "dst" / "users" / "u.user").exists()
    inv = sinks.file_inventory(spark, str(tmp_path / "dst")).collect()
    assert sorted(r.size for r in inv) == sorted([os.path.getsize(src / "u.user"), os.path.getsize(src / "u.data")])


def test_landing_skips_whole_copies_and_renews_others(spark, tmp_path):
    src, dst = tmp_path / "src", tmp_path / "dst"
    src.mkdir()
    raw = "1|24|M|technician|85711\n2|53|F|caf\xe9|\n".encode("latin-1")
    (src / "u.user").write_bytes(raw)
    (src / "u.occupation").write_bytes(b"")
    land = lambda: {r.file: r for r in sinks.land_raw(spark, str(src), str(dst)).collect()}
    copy = lambda: b"".join(f.read_bytes() for f in sorted((dst / "users" / "u.user").glob("part-*")))
    first = land()
    assert first["u.user"].status == "uploaded" and (first["u.user"].n_lines, first["u.user"].size) == (2, len(raw)) and copy() == raw
    assert first["u.occupation"].status == "uploaded" and first["u.occupation"].n_lines == 0
    assert first["u.item"].status == "missing" and first["u.item"].size is None
    parts = sorted(f.name for f in (dst / "users" / "u.user").iterdir())
    again = land()
    assert again["u.user"].status == again["u.occupation"].status == "present" and again["u.user"].checksum == first["u.user"].checksum
    assert parts == sorted(f.name for f in (dst / "users" / "u.user").iterdir())
    # The same number of bytes, another byte: the copy is renewed.
    (src / "u.user").write_bytes(raw.replace(b"24", b"25"))
    assert land()["u.user"].status == "uploaded" and copy() == raw.replace(b"24", b"25")
    # What a killed run left under its own name is no copy.
    (dst / "items" / "_landing-x").mkdir(parents=True)
    (src / "u.item").write_bytes(b"1|a|||\n")
    assert land()["u.item"].status == "uploaded" and land()["u.item"].status == "present"


def test_result_table_is_idempotent(spark, tmp_path):
    recs = spark.createDataFrame([(1, 2, 4.5, 4.5, "v1", "kmeans"), (1, 3, 4.0, 4.0, "v1", "kmeans")],
                                 "user_id long, item_id long, predicted_rating double, recommendation_score double, "
                                 "model_version string, algorithm string")
    root = str(tmp_path / "tables")
    assert sinks.write_result_table(recs, root, "recommendations").count() == 2
    assert sinks.write_result_table(recs, root, "recommendations").count() == 0
    assert spark.read.parquet(f"{root}/recommendations").count() == 2


def test_ingest_stream_first_write_wins(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.data").write_text("1\t1\t5\t100\n1\t2\t3\t101\n")
    table, ckpt = str(tmp_path / "ratings"), str(tmp_path / "ckpt")
    ingest.start_ingest(spark, str(landing), table, ckpt).awaitTermination()
    (landing / "b.data").write_text("1\t1\t1\t200\n2\t2\t4\t201\n1\t2\t2\t99\n")
    ingest.start_ingest(spark, str(landing), table, ckpt).awaitTermination()
    got = {(r.user_id, r.item_id): r.rating for r in spark.read.parquet(table).collect()}
    assert got == {(1, 1): 5, (1, 2): 3, (2, 2): 4}


def test_export_csv_and_model_roundtrip(spark, tmp_path):
    from rankwell.operators import features
    rows = [(u, i, 1 + (u * i) % 5, 20.0 + u, 1.0 if u % 2 else 0.0, float(u % 3), 1990.0 + i, 1.0 if i % 2 else 0.0)
            for u in range(1, 30) for i in range(1, 6)]
    df = spark.createDataFrame(rows, "user_id long, item_id long, rating int, age double, gender_enc double, "
                                     "occupation_enc double, release_year double, g double")
    model = features.fit_forest(df, ["g"], numTrees=3, maxDepth=3)
    sinks.save_model(model, str(tmp_path / "forest"))
    again = sinks.load_pipeline(str(tmp_path / "forest"))
    a = features.predict_forest(model, df).orderBy("user_id", "item_id").collect()
    b = features.predict_forest(again, df).orderBy("user_id", "item_id").collect()
    assert a == b
    imp = features.feature_importances(spark, model, ["g"], 10).collect()
    assert abs(imp[-1].cumulative - 1.0) < 1e-9
    sinks.export_csv(features.feature_importances(spark, model, ["g"], 10), str(tmp_path / "imp"))
    assert spark.read.option("header", "true").csv(str(tmp_path / "imp")).count() == len(imp)


def test_audit_columns(spark):
    from rankwell.operators import quality
    v1 = spark.createDataFrame([(1, "a"), (2, "b")], "user_id long, name string")
    first = quality.audit_columns(v1).collect()
    prev = spark.createDataFrame(first)
    v2 = spark.createDataFrame([(1, "a"), (2, "c")], "user_id long, name string")
    out = {r.user_id: r for r in quality.audit_columns(v2, prev, ["user_id"]).collect()}
    old = {r.user_id: r for r in first}
    assert out[1].updated_at == old[1].updated_at and out[1].created_at == old[1].created_at
    assert out[2].updated_at >= old[2].updated_at and out[2].created_at == old[2].created_at
