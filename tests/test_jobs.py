"""Jobs, files and streams on small inputs."""

import json
import os

import pytest
from pyspark.sql import functions as F

from ferrolith.plans import access, catalogue, dating, delays, images, trips
from ferrolith.sources import files, sinks, web
from ferrolith.streaming import live

SAMPLE = {
    "imagePath": "1.jpg", "imageHeight": 100, "imageWidth": 200,
    "lps": [{"lp_id": "AB-1", "poly_coord": [[10, 20], [30, 20], [30, 40], [10, 40]],
             "characters": [{"char_id": "A", "bbox_coord": [[10, 20], [15, 40]]}, {"char_id": "B", "bbox_coord": [[16, 20], [20, 40]]}]},
            {"lp_id": "CD-2", "poly_coord": [[1, 2], [3, 4]], "characters": []}],
}


def test_catalogue_edges(spark, tmp_path):
    def game(i, **kw):
        base = {"appid": i, "name": f"g{i}", "publisher": "p", "required_age": "0", "price": "999", "discount": "0",
                "release_date": "2012/11/1", "positive": 30, "negative": 10,
                "platforms": {"windows": True, "mac": False, "linux": False}, "genre": "Action, Indie", "languages": "English, <b>French</b>,,"}
        return {"data": {**base, **kw}}

    records = [game(1), game(2, name=None), game(3, price="abc", release_date="Nov 2012"), game(4, price=None, positive=0, negative=0), game(5, price="0", genre=None)]
    path = tmp_path / "games.json"
    path.write_text(json.dumps(records))
    games = catalogue.games(files.read_json(spark, str(path), catalogue.RAW_SCHEMA, multi_line=True))
    got = {r["app_id"]: r for r in games.collect()}
    assert sorted(got) == [1, 3, 4, 5]
    assert got[1]["price_eur"] == 9.99 and got[1]["positive_ratio"] == 75.0 and got[1]["release_year"] == 2012
    assert got[3]["price_eur"] is None and not got[3]["is_free"] and got[3]["release_year"] is None
    assert got[4]["is_free"] and got[4]["positive_ratio"] is None and got[5]["is_free"]
    by_genre = catalogue.genres(games)
    assert by_genre.count() == 6
    assert catalogue.genres(games, keep_without=True).count() == 7
    assert [r["language"] for r in catalogue.languages(games).collect()] == ["English", "French"]
    assert catalogue.REPORTS["platforms"].run(games).first()["all_platforms"] == 0


def test_threshold_curves_monotone_and_brute_force(spark):
    pairs = [(f"t{i % 2}", float((i * 37) % 400), float((i * 11) % 300)) for i in range(80)]
    df = spark.createDataFrame(pairs, "kind string, prev_delay_filled double, gap double").withColumn(
        "is_problem", F.col("prev_delay_filled") > F.col("gap"))
    curves = delays.threshold_curves(df, df, "kind", "t1", "gap").orderBy("threshold").collect()
    assert len(curves) == 50
    for scope in ("all", "t1"):
        mine = [p for p in pairs if scope == "all" or p[0] == scope]
        problems = [p for p in mine if p[1] > p[2]]
        last = -1.0
        for r in (c for c in curves if c["scope"] == scope):
            assert r["solved"] == sum(p[1] <= r["threshold"] for p in problems)
            assert r["affected"] == sum(p[2] < r["threshold"] for p in mine)
            assert r["pct_problems_solved"] >= last
            last = r["pct_problems_solved"]


def test_scope_without_problem(spark):
    df = spark.createDataFrame([("a", 0.0, 10.0, False)], "kind string, prev_delay_filled double, gap double, is_problem boolean")
    rows = delays.threshold_curves(df, df, "kind", "a", "gap").collect()
    assert {r["pct_problems_solved"] for r in rows} == {0.0}


def test_speed_dating_cleaning(spark):
    data = [(1, w, d, 1, 2) for w, d in ((5, 1), (6, 1), (9, 0), (10, None), (None, 0))]
    df = spark.createDataFrame(data, "iid int, wave int, dec int, dec_o int, goal int")
    got = dating.clean(df).collect()
    assert sorted(str(r["wave"]) for r in got) == ["5", "None"]
    assert {r["goal_desc"] for r in got} == {"Meet new people"}


def test_trip_jobs(spark):
    raw = spark.createDataFrame(
        [("A", "Paris", "Avec une note de 8.5", "120", "48.8", "2.3", "u", None), ("B", "Paris", "9", "90", "bad", "2.3", "u", "d")],
        "nom_hotel string, ville string, score string, prix string, latitude string, longitude string, url string, description string")
    hotels = trips.clean_hotels(raw)
    assert [(r["name"], r["rating"]) for r in hotels.collect()] == [("A", 8.5)]
    blocks = [{"city": "Paris", "list": [{"main": {"temp": 10.0}, "pop": 0.5, "rain": {"3h": 1.0}}, {"main": {"temp": 20.0}}]}, {"city": "Nice", "list": []}]
    forecasts = spark.createDataFrame([json.dumps(b) for b in blocks], "string").select(
        F.from_json("value", files.FORECAST_SCHEMA).alias("f")).select("f.*")
    weather = trips.forecast_rollup(forecasts)
    row = weather.first()
    assert weather.count() == 1
    assert (row["temperature_moyenne"], row["pluie_totale_mm"], row["risque_pluie_pct"], row["score_meteo"]) == (15.0, 1.0, 25.0 + 0.0, 13.0)
    ranked = trips.best_hotels(hotels, weather.withColumnRenamed("city", "ville"))
    assert ranked.count() == 1 and trips.best_cities(ranked).first()["n"] == 1


def test_result_page_listings(spark):
    card = '<div data-testid="property-card"><a data-testid="title-link" href="/h{0}">x</a><div data-testid="title">Hotel {0}</div><span data-testid="price-and-discounted-price">1{0}0 €</span><div data-testid="review-score"><div>8,{0}</div></div></div>'
    html = "<html>" + "".join(card.format(i) for i in range(4)) + '<div data-testid="property-card"></div></html>'
    pages = spark.createDataFrame([(1, 7, "Paris", html)], "page int, id_ville int, ville string, html string")
    got = web.listings(pages, "page", "id_ville", "ville", "html", "https://b.org", per_city=5).orderBy("rank").collect()
    assert (got[1]["nom_hotel"], got[1]["url"], got[1]["score"], got[1]["prix"]) == ("Hotel 1", "https://b.org/h1", "8.1", "110")
    assert got[4]["nom_hotel"] is None and got[4]["prix"] == "0" and got[4]["url"] == "https://b.org"
    assert web.listings(pages, "page", "id_ville", "ville", "html", "https://b.org", per_city=3).count() == 3


def test_description_fallbacks(spark):
    pages = spark.createDataFrame([
        (1, '<div id="new"><p> a </p>b</div>'), (2, '<div id="old">c</div>'), (3, '<meta name="description" content="m">'), (4, "<p>none</p>")],
        "i int, html string")
    blocks = [r'(?s)<div id="new">(.*?)</div>', r'(?s)<div id="old">(.*?)</div>']
    got = [r[1] for r in pages.select("i", web.description(F.col("html"), blocks)).orderBy("i").collect()]
    assert got == ["a b...", "c...", "m...", web.MISSING_DESCRIPTION]


@pytest.fixture
def residents(spark):
    return spark.createDataFrame(
        [("AB-123-CD", "Renault", "X", "oui", "non"), ("EF456GH", "Fiat", "Y", "non", "oui"), ("IJ789KL", "Audi", "Z", "oui", "oui")],
        "plaque string, marque string, nom string, acces string, abonnement string")


def test_access_decisions(spark, residents):
    reads = spark.createDataFrame(
        [("1", "ab 123 cd", 0.9, "renault"), ("2", "EF-456-GH", 0.9, "Fiat"), ("3", "ZZ", 0.8, None), ("4", "AB123CD", 0.4, None),
         ("5", "", 0.9, None), ("6", "IJ789KL", 0.5, "BMW"), ("7", "IJ789KL", 0.6, None)],
        "timestamp string, plate_number string, detection_confidence double, brand string")
    decided = access.decide(reads, residents)
    assert {r["timestamp"]: r["decision"] for r in decided.collect()} == {
        "1": "AUTHORISED", "2": "REFUSED", "3": "REFUSED", "6": "AUTHORISED", "7": "AUTHORISED"}
    assert [r["timestamp"] for r in access.brand_mismatches(decided).collect()] == ["6"]
    assert [r["timestamp"] for r in access.history(access.audit_log(decided), "ij-789-kl").collect()] == ["7", "6"]
    assert access.resident_indicators(residents).first().asDict() == {"total": 3, "active": 2, "blocked": 1, "subscribers": 2}


def test_registry_changes(spark, residents):
    blank = ("", "", "", "")
    changes = [
        (1, "toggle", "AB-123-CD", *blank), (2, "toggle", "AB-123-CD", *blank), (3, "toggle", "AB-123-CD", *blank),
        (4, "add", "EF456GH", "New", "N", "oui", "non"),  # plate exists: rejected
        (5, "delete", "IJ789KL", *blank), (6, "add", "IJ789KL", "Seat", "W", "non", "non"), (7, "toggle", "IJ789KL", *blank),
        (8, "add", "NEW1", "Kia", "V", "non", "non"), (9, "delete", "NEW1", *blank), (10, "toggle", "NOPE", *blank),
    ]
    df = spark.createDataFrame(changes, "seq int, op string, plaque string, marque string, nom string, acces string, abonnement string")
    after = {r["plaque"]: (r["marque"], r["acces"]) for r in access.apply_changes(residents, df).collect()}
    assert after == {"AB-123-CD": ("Renault", "non"), "EF456GH": ("Fiat", "non"), "IJ789KL": ("Seat", "oui")}


def test_annotation_files(spark, tmp_path):
    labels = tmp_path / "train" / "labels"
    labels.mkdir(parents=True)
    (labels / "a.txt").write_text("0 0.5 0.5 0.4 0.2\n\nbad line\n0 0.1 0.1 0.3 0\n0 x 0.1 0.3 0.1\n")
    boxes = files.read_boxes(spark, str(labels / "*.txt"))
    assert sorted((round(r["area"], 3), r["ratio"]) for r in boxes.collect()) == [(0.0, 0.0), (0.08, 2.0)]
    assert images.box_summary(boxes).first()["n"] == 2
    (tmp_path / "train" / "x.jpg").write_bytes(b"1")
    (tmp_path / "test").mkdir()
    (tmp_path / "test" / "y.png").write_bytes(b"1")
    inventory = files.file_inventory(spark, str(tmp_path))
    assert {(r["split"], r["pct"]) for r in images.split_shares(inventory).collect()} == {("train", 50.0), ("test", 50.0)}
    assert inventory.filter("kind = 'label'").count() == 1


def test_plate_annotations(spark, tmp_path):
    path = tmp_path / "a.json"
    path.write_text(json.dumps(SAMPLE, indent=2))
    annotations = files.read_plate_annotations(spark, str(path))
    plates = files.plates(annotations).orderBy("plate_index").collect()
    assert [(r["plate"], r["x1"], r["y2"], r["n_characters"]) for r in plates] == [("AB-1", 10, 40, 2), ("CD-2", 1, 4, 0)]
    assert files.characters(annotations).count() == 2


def test_image_light(spark, tmp_path):
    ppm = tmp_path / "dark.bmp"
    width, height = 4, 3
    body = bytes([20, 20, 20] * width) * height
    header = b"BM" + (54 + len(body)).to_bytes(4, "little") + bytes(4) + (54).to_bytes(4, "little")
    header += (40).to_bytes(4, "little") + width.to_bytes(4, "little") + height.to_bytes(4, "little")
    header += (1).to_bytes(2, "little") + (24).to_bytes(2, "little") + bytes(4) + len(body).to_bytes(4, "little") + bytes(16)
    ppm.write_bytes(header + body)
    lit = images.with_light(files.read_images(spark, str(tmp_path)))
    row = lit.first()
    assert round(row["brightness"]) == 20 and row["sharpness"] == pytest.approx(0.0) and row["light"] == "Nuit/Très sombre"
    assert images.hard_light_share(lit).first()["hard_pct"] == 100.0
    assert {r["column"]: r["mean"] for r in images.size_summary(lit).collect()}["width"] == 4.0


def test_csv_round_trip_and_tables(spark, tmp_path):
    df = spark.createDataFrame([("été", 1), ("x", None)], "name string, n int")
    path = str(tmp_path / "out")
    sinks.write_csv(df, path, "ISO-8859-1")
    back = files.read_csv(spark, path, "name string, n int", "ISO-8859-1")
    assert sorted((r["name"], r["n"] or 0) for r in back.collect()) == [("x", 0), ("été", 1)]
    sinks.write_parquet(df, str(tmp_path / "p"), ["name"])
    assert any(d.startswith("name=") for d in os.listdir(tmp_path / "p"))
    sinks.write_json(df, str(tmp_path / "j"))
    assert spark.read.schema("name string, n int").json(str(tmp_path / "j")).count() == 2


def test_correction_feed(spark):
    df = spark.createDataFrame(
        [("p", "img", "Fiat", '{"x1":1,"y1":2,"x2":3,"y2":4}', "2024-01-02 10:00:00"), ("q", "img2", None, None, "2024-01-02 10:00:00")],
        "plaque string, image_path string, corrected_brand string, box_json string, timestamp string")
    row = access.correction_feed(df).collect()
    assert len(row) == 1 and row[0]["box"]["x2"] == 3.0 and str(row[0]["day"]) == "2024-01-02"


def test_stream_resumes_without_repeating(spark, residents, tmp_path):
    schema = "timestamp string, plate_number string, detection_confidence double, brand string"
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    batch = lambda rows: spark.createDataFrame(rows, schema).write.mode("append").json(source)
    batch([("1", "AB123CD", 0.9, None)])
    read = lambda: live.access_decisions(spark.readStream.schema(schema).json(source), residents)
    assert live.run_to_folder(read(), "t", out, state).count() == 1
    batch([("2", "ZZ", 0.9, None)])
    log = live.run_to_folder(read(), "t", out, state)
    assert sorted((r["timestamp"], r["resultat"]) for r in log.collect()) == [("1", "AUTHORISED"), ("2", "REFUSED")]


def test_spellings_of_one_plate_are_one_resident(spark, residents):
    schema = "timestamp string, plate_number string, detection_confidence double, brand string"
    reads = spark.createDataFrame([("1", "ab-123 cd", 0.9, None)], schema)
    more = residents.filter("plaque = 'AB-123-CD'").withColumn("plaque", F.lit("AB123CD")).withColumn("acces", F.lit("non"))
    both = residents.unionByName(more)
    decided = access.decide(reads, both).collect()
    assert len(decided) == 1 and decided[0]["decision"] == access.AUTHORISED  # the smaller text is AB-123-CD
    changes = residents.filter("plaque = 'AB-123-CD'").withColumn("plaque", F.lit("ab 123 cd")).withColumns({"op": F.lit("toggle"), "seq": F.lit(1).cast("long")})
    rows = [r for r in access.apply_changes(both, changes).collect() if r["plaque"].replace("-", "") == "AB123CD"]
    assert len(rows) == 1 and rows[0]["acces"] == "non"
    assert access.one_per_plate(both.withColumn("plaque", F.lit(None).cast("string"))).count() == 0
