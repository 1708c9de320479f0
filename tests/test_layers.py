"""Clustered and replaced tables, rejected lines, losses, lasting keys, buckets, saved models and the quality of scores."""

from __future__ import annotations

import datetime as dt
import random
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from lakestar.operators.keys import missing_keys, stable_key
from lakestar.operators.lasting import lasting_keys, read_keys, with_lasting_key
from lakestar.plans import calendars, facts, features, refresh, scoring
from lakestar.plans.silver import SILVER_TABLES
from lakestar.session import side_session
from lakestar.sources import tables
from lakestar.sources.bucketed import drop_bucketed, write_bucketed
from tests.helpers import executed_plan, plan, rows
from tests.test_refresh import layers as lake  # noqa: F401  (the refreshed layers of a few records)

# Clustered tables


def _bytes(folder, columns, itemid=None):
    """Bytes of the columns in all row groups, or in those whose statistics allow the items."""
    total = 0
    for file in Path(folder).glob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for g in range(meta.num_row_groups):
            group = {meta.row_group(g).column(c).path_in_schema: meta.row_group(g).column(c) for c in range(meta.num_columns)}
            low, high = group["itemid"].statistics.min, group["itemid"].statistics.max
            if itemid is None or any(low <= i <= high for i in itemid):
                total += sum(group[c].total_compressed_size for c in columns)
    return total


def test_vital_signs_read_under_a_tenth_of_a_clustered_table(spark, tmp_path):
    items = [*facts.HEART_RATE_ITEMS, *facts.SPO2_ITEMS]
    other = F.lit(300_000) + F.col("id") % 997
    itemid = F.when(F.col("id") % 50 == 0, F.element_at(F.array(*[F.lit(i) for i in items]), (F.col("id") / 50 % len(items)).cast("int") + 1))
    charted = spark.range(400_000).select(
        F.coalesce(itemid, other).cast("int").alias("itemid"), (F.col("id") % 3001).cast("int").alias("stay_id"),
        F.xxhash64("id").cast("string").alias("value"), (F.col("id") % 97).cast("double").alias("valuenum"),
    )
    plain, dealt = str(tmp_path / "plain"), str(tmp_path / "dealt")
    tables.write_new(charted, plain)
    assert tables.write_clustered(charted, dealt, ["itemid", "stay_id"], files=40)
    assert not tables.write_clustered(charted, dealt, ["itemid", "stay_id"])
    read = ["itemid", "stay_id", "value"]
    assert _bytes(dealt, read, items) < _bytes(dealt, read) / 10
    assert _bytes(plain, read, items) == _bytes(plain, read)
    signs = facts.vital_signs(tables.read_table(spark, dealt), facts.HEART_RATE_ITEMS, facts.SPO2_ITEMS)
    assert rows(signs) == rows(facts.vital_signs(charted, facts.HEART_RATE_ITEMS, facts.SPO2_ITEMS))
    assert "PushedFilters" in plan(signs) and "itemid" in plan(signs).split("PushedFilters")[1]


def test_a_hot_item_fills_many_files_and_rows_stay_sorted(spark, tmp_path):
    charted = spark.range(30_000).select(F.lit(1).alias("itemid"), F.lit(7).alias("stay_id"), F.col("id").alias("value"))
    path = str(tmp_path / "t")
    tables.write_clustered(charted, path, ["itemid", "stay_id"], files=6)
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in Path(path).glob("*.parquet")]
    assert len(sizes) == 6 and max(sizes) < 10_000
    mixed = spark.range(5_000).select((F.col("id") * 7919 % 100).alias("a"), "id")
    tables.write_clustered(mixed, str(tmp_path / "m"), ["a"], files=3)
    for file in Path(tmp_path / "m").glob("*.parquet"):
        values = pq.read_table(file).column("a").to_pylist()
        assert values == sorted(values)


def test_small_row_groups(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_clustered(spark.range(200_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text")), path, ["id"], files=1, row_group_bytes=1 << 20)
    (file,) = Path(path).glob("*.parquet")
    assert pq.ParquetFile(file).metadata.num_row_groups > 3


def test_event_tables_of_the_typed_layer_are_clustered():
    assert {t: s.cluster for t, s in SILVER_TABLES.items() if s.cluster} == {
        "chartevents": ("itemid", "stay_id"), "labevents": ("itemid", "subject_id"),
    }


# Replaced tables


@pytest.mark.parametrize("killed_at", ["write", 1, 2, "delete"])
def test_a_killed_replace_leaves_one_whole_table(spark, tmp_path, monkeypatch, killed_at):
    path = str(tmp_path / "t")
    tables.write_replace(spark.range(5), path)
    calls = []

    def die(*given):
        calls.append(given)
        if killed_at == "delete" or len(calls) == killed_at:
            raise KeyboardInterrupt
        return real(*given)

    new = spark.range(9)
    if killed_at == "write":
        new = new.select(F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error(F.lit("no")).cast("long")).alias("id"))
    else:
        real = getattr(tables, "_delete" if killed_at == "delete" else "_rename")
        monkeypatch.setattr(tables, "_delete" if killed_at == "delete" else "_rename", die)
    with pytest.raises((KeyboardInterrupt, Exception)):
        tables.write_replace(new, path)
    monkeypatch.undo()
    # Until the second rename the old table is whole, after the first one the new one takes its place.
    expected = 5 if killed_at in ("write", 1) else 9
    assert tables.read_table(spark, path).count() == expected
    tables.write_replace(spark.range(3), path)
    assert tables.read_table(spark, path).count() == 3
    assert not [p.name for p in tmp_path.iterdir() if p.name.startswith(".t.")]


def test_recover_prefers_what_is_whole(spark, tmp_path):
    path = str(tmp_path / "t")
    assert not tables.recover(spark, path)
    spark.range(2).write.parquet(str(tmp_path / ".t.last"))
    (tmp_path / ".t.next").mkdir()
    assert not tables.write_new(spark.range(7), path)
    assert tables.read_table(spark, path).count() == 2
    with pytest.raises(AnalysisException):
        tables.read_table(spark, str(tmp_path / "nowhere"))


def test_a_table_may_be_replaced_by_a_part_of_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_replace(spark.range(10), path)
    tables.write_replace(tables.read_table(spark, path).where("id < 4"), path)
    assert rows(tables.read_table(spark, path)) == [(0,), (1,), (2,), (3,)]


# Rejected lines

CSV = "\n".join([
    "a,b,c", "1,x,2020-01-01", "2,short", "3,too,2020-01-01,long", '4,"never closed,2020-01-01', "", '5,"a, b",', "6,,",
])
LATER = 'a,b,c\n7,y,bad\n8,"z"'


def test_rows_and_rejects_add_up(spark, tmp_path):
    for name, text in (("one", CSV), ("two", LATER)):
        (tmp_path / "raw.csv").mkdir(exist_ok=True)
        (tmp_path / "raw.csv" / f"{name}.csv").write_text(text + "\n")
    source, target, rejects = (str(tmp_path / n) for n in ("raw.csv", "table", "rejects"))
    assert tables.ingest_checked(spark, source, target, rejects) == (4, 4)
    assert tables.ingest_checked(spark, source, target, rejects) is None
    assert rows(tables.read_table(spark, target), "a", "b", "c") == [("1", "x", "2020-01-01"), ("5", "a, b", None), ("6", None, None), ("7", "y", "bad")]
    assert rows(tables.read_table(spark, rejects), "line", "reason") == [
        ("2,short", tables.MISCOUNTED), ("3,too,2020-01-01,long", tables.MISCOUNTED), ('4,"never closed,2020-01-01', tables.UNCLOSED),
        ('8,"z"', tables.MISCOUNTED),
    ]
    assert all(f.endswith("csv") for (f,) in tables.read_table(spark, rejects).select("file").collect())


def test_clean_files_give_what_the_reader_gives(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('a,b,c\n1,"x, ""y""",\n2.50,,2020-01-01\n" 3 ",\' ,z\n')
    good, bad = tables.split_rejects(tables.read_checked(spark, str(path)))
    assert rows(good) == rows(tables.read_csv(spark, str(path))) and bad.count() == 0
    assert not tables.ingest(spark, {"": ["t"]}, str(tmp_path), str(tmp_path / "out"), rejects_root=str(tmp_path / "rejects"))["/t"]
    assert not (tmp_path / "rejects").exists()
    assert rows(tables.read_table(spark, str(tmp_path / "out" / "t"))) == rows(good)


def test_an_ingest_keeps_files_without_a_marker(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a\n1\n")
    target = tmp_path / "t"
    tables.write_new(spark.range(1), str(target))
    (target / "_SUCCESS").unlink()
    with pytest.raises(FileExistsError, match="repair=True"):
        tables.ingest_checked(spark, str(tmp_path / "t.csv"), str(target), str(tmp_path / "r"))
    assert tables.ingest_checked(spark, str(tmp_path / "t.csv"), str(target), str(tmp_path / "r"), repair=True) == (1, 0)


# Losses


def test_losses_of_the_refreshed_layers(lake):  # noqa: F811
    found = {(r["table"], r["column"]): (r["rows"], r["lost"]) for r in refresh.losses(lake).collect()}
    assert len(found) == 181
    assert found["patients", "anchor_age"] == (2, 1) and found["patients", "gender"] == (2, 1) and found["patients", "dod"] == (2, 0)
    assert found["chartevents", "valuenum"] == (2, 0) and found["emar_detail", "subject_id"] == (1, 0)


def test_typing_and_counting_is_one_pass(spark, tmp_path):
    raw = side_session(spark).createDataFrame([("1", "x"), ("y", None), (None, "2"), ("z", "3.5")], "category string, note string")
    typed, lost = SILVER_TABLES["d_hcpcs"].build_counted(raw)
    typed.write.parquet(str(tmp_path / "t"))
    assert lost.get == {"rows": 4, "0": 2}
    assert rows(typed) == rows(SILVER_TABLES["d_hcpcs"].build(raw))


# Lasting keys


def test_keys_last_when_rows_are_added(spark, tmp_path):
    path, key = str(tmp_path / "keys"), "sk"
    some = spark.createDataFrame([(3, "c"), (1, "a"), (1, "a"), (None, "n")], "id int, name string")
    first = lasting_keys(some, path, ["id"], key)
    assert rows(first) == [(None, 1), (1, 2), (3, 3)]
    more = some.union(spark.createDataFrame([(2, "b"), (0, "z")], "id int, name string"))
    assert rows(lasting_keys(more, path, ["id"], key)) == [(None, 1), (0, 4), (1, 2), (2, 5), (3, 3)]
    # Nothing new, or a part only: the table stays as it is.
    assert rows(lasting_keys(some.limit(1), path, ["id"], key)) == [(None, 1), (0, 4), (1, 2), (2, 5), (3, 3)]
    assert len([p for p in (tmp_path / "keys").iterdir()]) == 2


def test_a_batch_that_was_not_finished_does_not_count(spark, tmp_path):
    path = str(tmp_path / "keys")
    ids = spark.range(3).select(F.col("id").cast("int").alias("id"))
    lasting_keys(ids, path, ["id"], "sk")
    lasting_keys(spark.range(6).select(F.col("id").cast("int").alias("id")), path, ["id"], "sk")
    (tmp_path / "keys" / "batch-000002" / "_SUCCESS").unlink()
    assert read_keys(spark, path, ids.schema.fields, "sk").count() == 3
    again = lasting_keys(spark.range(4).select(F.col("id").cast("int").alias("id")), path, ["id"], "sk")
    assert rows(again) == [(0, 1), (1, 2), (2, 3), (3, 4)]


def test_a_planted_collision_ends_with_two_keys(spark, tmp_path):
    path, natural = str(tmp_path / "keys"), ["code", "version"]
    hasher = lambda attempt, columns: F.lit(100 * attempt) + F.length("code")
    codes = spark.createDataFrame([("bb", 9), ("aa", 9), ("c", 9)], "code string, version int")
    assert rows(lasting_keys(codes, path, natural, "sk", hashed=True, hasher=hasher)) == [("aa", 9, 2), ("bb", 9, 102), ("c", 9, 1)]
    # A later code that comes before the others in order takes no key away.
    more = codes.union(spark.createDataFrame([("a0", 9), ("a", 10)], "code string, version int"))
    found = lasting_keys(more, path, natural, "sk", hashed=True, hasher=hasher)
    assert rows(found) == [("a", 10, 101), ("a0", 9, 202), ("aa", 9, 2), ("bb", 9, 102), ("c", 9, 1)]


def test_hashes_without_collision_are_the_stable_keys(spark, tmp_path):
    dim = spark.createDataFrame([(0, "b", 1), (0, "a", 2)], "sk long, code string, n int")
    keyed = with_lasting_key(dim, str(tmp_path / "keys"), ["code"], "sk", hashed=True)
    assert keyed.columns == dim.columns
    assert rows(keyed) == rows(dim.select(stable_key("code").alias("sk"), "code", "n"))


def test_two_refreshes_share_their_keys(spark, lake, tmp_path):  # noqa: F811
    roots = [lake.raw, lake.bronze, lake.silver]
    one = refresh.Layers(spark, *roots, str(tmp_path / "gold1"), keys=str(tmp_path / "keys"))
    refresh.admission_star(one)
    before = rows(one.gold_table(refresh.ADMISSION_STAR, "dim_patient"), "subject_id", "patient_sk")
    # A patient whose number comes before all others.
    silver = tmp_path / "silver"
    for table in ("admissions", "transfers", "services", "diagnoses_icd", "d_icd_diagnoses"):
        tables.write_new(lake.silver_table(table), f"{silver}/{SILVER_TABLES[table].area}/{table}")
    patients = lake.silver_table("patients")
    added = patients.where("subject_id = 1").withColumn("subject_id", F.lit(0))
    tables.write_new(patients.unionByName(added), f"{silver}/PatientTracking/patients")
    two = refresh.Layers(spark, lake.raw, lake.bronze, str(silver), str(tmp_path / "gold2"), keys=str(tmp_path / "keys"))
    refresh.admission_star(two)
    after = rows(two.gold_table(refresh.ADMISSION_STAR, "dim_patient"), "subject_id", "patient_sk")
    assert before == [(1, 1), (2, 2)] and after == [(0, 3), (1, 1), (2, 2)]
    refresh.coding_star(two.__class__(spark, *roots, str(tmp_path / "gold3"), keys=str(tmp_path / "keys")))


# Calendar and key report


def test_no_known_date_is_without_a_key(spark, lake, tmp_path):  # noqa: F811
    silver = tmp_path / "silver"
    for table in ("patients", "services", "emar_detail"):
        tables.write_new(lake.silver_table(table), f"{silver}/{SILVER_TABLES[table].area}/{table}")
    late = lake.silver_table("emar").withColumn("charttime", F.lit("2216-02-29").cast("date"))
    tables.write_new(late, f"{silver}/Medication/emar")
    given = refresh.Layers(spark, lake.raw, lake.bronze, str(silver), str(tmp_path / "gold"))
    refresh.medication_star(given)
    star = refresh.MEDICATION_STAR
    assert given.gold_table(star, "fact_medication_administration").first()["date_sk"] == 22160229
    report = rows(given.gold_table(star, "key_report"), "fact", "key", "rows", "missing")
    assert report == [("fact_medication_administration", k, 1, 0) for k in ("date_sk", "drug_sk", "subject_sk")]
    dates = given.gold_table(star, "dim_date").agg(F.min("date"), F.max("date"), F.count("*")).first()
    assert tuple(dates) == (dt.date(2109, 1, 1), dt.date(2216, 2, 29), 39_080 + 60)


def test_extremes_of_nothing(spark):
    empty = spark.createDataFrame([(None, None)], "a date, b string")
    assert rows(calendars.extreme_dates(spark, [(empty, ["a"])])) == [(None, None)]
    assert calendars.range_calendar(calendars.extreme_dates(spark, [(empty, ["a"])]), "start", "end").count() == 0
    assert rows(missing_keys(empty, ["a", "b"])) == [("a", 1, 1), ("b", 1, 1)]
    assert rows(missing_keys(empty.limit(0), ["a"])) == [("a", 0, 0)]


# Features, transfers, buckets: one shuffle, one join, none


def _events(spark, n=300):
    key = (F.col("id") % 7).cast("int")
    return spark.range(n).select(
        key.alias("subject_id"), key.alias("hadm_id"), key.alias("stay_id"), F.col("id").cast("int").alias("transfer_id"), F.lit("u").alias("careunit"),
        (F.lit(220_045) + F.col("id") % 2 * 232).cast("int").alias("itemid"), F.col("id").cast("double").alias("valuenum"), F.col("id").cast("string").alias("value"),
        F.col("id").cast("double").alias("amount"), F.lit("2150-01-01").cast("date").alias("intime"), F.lit("2150-01-02").cast("date").alias("outtime"),
        F.lit(40).alias("anchor_age"), F.lit("Male").alias("gender"), F.lit("2150-01-02").cast("date").alias("dischtime"), F.lit(0).alias("hospital_expire_flag"),
    )


def test_features_take_one_shuffle(spark):
    e = _events(spark)
    patients = e.select("subject_id", "anchor_age", "gender").distinct()
    table = features.feature_table(e, e, e, e, e, e, [e, e])
    table.collect()
    assert executed_plan(table).split("== Initial Plan ==")[0].count("Exchange hashpartitioning(subject_id") == 1
    assert "Join" not in executed_plan(table)
    assert rows(features.feature_table(patients, e, e, e, e, e, [e, e])) == rows(table)


def test_transfers_join_once(spark):
    patient = spark.range(9).select(F.col("id").cast("int").alias("subject_id"), F.col("id").alias("patient_sk"))
    fact = facts.fact_transfers(_events(spark), patient)
    assert fact.count() == 300 and "Join" not in plan(fact)


def test_monitoring_of_bucketed_events_shuffles_none_of_them(spark, tmp_path):
    events = _events(spark)
    names = {e: f"t_{e}_{random.randrange(10**9)}" for e in refresh.EVENT_KEYS}
    frames = [
        write_bucketed(events, names[e], [key], 4, str(tmp_path / e), refresh.EVENT_SORT.get(e, [])) for e, key in refresh.EVENT_KEYS.items()
    ]
    stays = events.dropDuplicates(["stay_id"]).select("stay_id", "subject_id", "hadm_id", "intime", "outtime")
    admissions = events.dropDuplicates(["hadm_id"]).select("hadm_id", "dischtime", "hospital_expire_flag")
    patient = spark.range(9).select(F.col("id").cast("int").alias("subject_id"), F.col("id").alias("subject_sk"))
    service = spark.range(9).select(F.col("id").cast("int").alias("hadm_id"), F.col("id").alias("service_sk"))
    date = spark.createDataFrame([(dt.date(2150, 1, 1), 1), (dt.date(2150, 1, 2), 2)], "date date, date_sk int")
    build = lambda e: facts.fact_icu_monitoring(stays, admissions, *e, patient, service, date)
    fact = build(frames)
    columns = [c for c in fact.columns if c != "icu_monitoring_sk"]
    assert rows(fact, *columns) == rows(build([events] * 5), *columns)
    text = plan(fact)
    reduced = [line for line in text.splitlines() if "FileScan" in line and "Bucketed: true" in line]
    assert len(reduced) == 5
    # Between the scan of an event table and its final aggregate lies no exchange: partial and final meet in one stage.
    lines = text.splitlines()
    for i, line in enumerate(lines):
        if "Bucketed: true" in line:
            above = lines[:i][::-1]
            final = next(j for j, x in enumerate(above) if "HashAggregate" in x and "partial_" not in x)
            assert not any("Exchange" in x for x in above[:final])
    for name in names.values():
        drop_bucketed(spark, name)


def test_a_hot_key_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="unbucketed"):
        write_bucketed(spark.range(50).select(F.lit(1).alias("k"), "id"), "hot_buckets", ["k"], 4, str(tmp_path / "t"), hot_rows=10)


def test_the_monitoring_star_of_a_refresh_may_use_buckets(spark, lake, tmp_path):  # noqa: F811
    given = refresh.Layers(spark, lake.raw, lake.bronze, lake.silver, str(tmp_path / "gold"), events=str(tmp_path / "events"), buckets=2)
    refresh.icu_star(given)
    name = "fact_icu_monitoring"
    columns = ["stay_id", "avg_heart_rate", "total_input_ml", "total_output_ml", "num_procedures", "num_medications"]
    assert rows(given.gold_table(refresh.ICU_STAR, name), *columns) == rows(lake.gold_table(refresh.ICU_STAR, name), *columns)
    skipped = dict(rows(given.gold_table(refresh.ICU_STAR, "skipped_sources")))
    assert "ICU-Measurement/labevents" in skipped
    spark.sql(f"DROP DATABASE {refresh.EVENT_DATABASE} CASCADE")


# Saved models and quality


def test_features_and_scores_of_a_refresh(spark, lake, tmp_path):  # noqa: F811
    given = refresh.Layers(spark, lake.raw, lake.bronze, lake.silver, str(tmp_path / "gold"))
    refresh.refresh(given, ["features", "score"])
    rows_ = given.gold_table(refresh.FEATURES, "features")
    assert rows_.columns == ["subject_id", *features.FEATURES]
    scores = rows(given.gold_table(refresh.FEATURES, "scores"), "subject_id", "death", "death_probability")
    assert [s[0] for s in scores] == [1, 2]
    models = Path(tmp_path / "gold" / refresh.MODELS)
    before = sorted((p, p.stat().st_mtime_ns) for p in models.rglob("*") if p.is_file())
    refresh.refresh(given, ["score"])
    assert before == sorted((p, p.stat().st_mtime_ns) for p in models.rglob("*") if p.is_file())
    assert rows(given.gold_table(refresh.FEATURES, "scores"), "subject_id", "death", "death_probability") == scores


def test_a_model_refuses_other_features(spark, tmp_path):
    points = spark.range(40).select((F.col("id") % 2 * 9.0).alias("x"), (F.col("id") % 5 * 1.0).alias("y"))
    path = str(tmp_path / "model")
    model = scoring.fit_once(spark, path, ["x", "y"], lambda: scoring.fit_clusters(points, ["x", "y"], k=2))
    again = scoring.fit_once(spark, path, ["x", "y"], lambda: pytest.fail("fitted twice"))
    assert rows(scoring.assign_clusters(model, points)) == rows(scoring.assign_clusters(again, points))
    for other in (["y", "x"], ["x"], ["x", "z"]):
        with pytest.raises(ValueError, match="takes x, y"):
            scoring.load_model(spark, path, other)


def test_a_model_that_was_not_finished_is_fitted_again(spark, tmp_path):
    points = spark.range(40).select((F.col("id") % 2 * 9.0).alias("x"))
    path = tmp_path / "model"
    scoring.fit_scaler(points, ["x"]).write().save(str(path / "model"))
    with pytest.raises(AnalysisException):
        scoring.load_model(spark, str(path), ["x"])
    fitted = []
    scoring.fit_once(spark, str(path), ["x"], lambda: fitted.append(1) or scoring.fit_scaler(points, ["x"]))
    assert fitted == [1]


@pytest.mark.parametrize("pairs", [[(0.1, 0), (0.4, 1), (0.4, 0), (0.9, 1), (1.0, 0), (0.0, 1), (None, 1), (0.5, None)], [(0.2, 0)], []])
def test_area_is_the_share_of_won_pairs(spark, pairs):
    table = spark.createDataFrame(pairs, "score double, label int")
    known = [p for p in pairs if None not in p]
    good, bad = [s for s, y in known if y == 1], [s for s, y in known if y == 0]
    won = sum((a > b) + (a == b) / 2 for a in good for b in bad)
    (found,) = scoring.area_under_curve(table, "score", "label").collect()
    expected = won / (len(good) * len(bad)) if good and bad else None
    assert tuple(found)[:2] == (len(good), len(bad)) and found["area"] == (pytest.approx(expected) if expected is not None else None)


def test_silhouette_is_that_of_all_pairs(spark):
    rng = random.Random(4)
    points = [(rng.choice("aab"), rng.random() * 5, rng.random()) for _ in range(60)] + [("c", 9.0, 9.0)]
    table = spark.createDataFrame(points, "cluster string, x double, y double")
    expected = {}
    for i, (c, x, y) in enumerate(points):
        far = {}
        for j, (d, u, v) in enumerate(points):
            if i != j:
                far.setdefault(d, []).append((x - u) ** 2 + (y - v) ** 2)
        mean = {d: sum(v) / len(v) for d, v in far.items()}
        score = 0.0
        if c in mean:
            b = min(m for d, m in mean.items() if d != c)
            score = (b - mean[c]) / max(b, mean[c])
        expected.setdefault(c, []).append(score)
    found = {r["cluster"]: (r["members"], r["silhouette"]) for r in scoring.cluster_quality(table, ["x", "y"]).collect()}
    assert found == {c: (len(v), pytest.approx(sum(v) / len(v))) for c, v in expected.items()}
    assert rows(scoring.cluster_quality(table.where("cluster = 'a'"), ["x", "y"]))[0][2] == 0.0
    assert scoring.cluster_quality(table.limit(0), ["x", "y"]).count() == 0


def test_silver_losses_counts_without_storing_typed_tables(spark, tmp_path):
    from lakestar.session import scratch_root
    from workload import layers  # noqa: F401  (registers the query)
    from workload.registry import QUERIES

    spark.createDataFrame([(k,) for k in (1, 2, 999, 1000, 5000)], "o_orderkey long").write.parquet(str(tmp_path / "orders.parquet"))
    found = QUERIES["silver_losses"](spark, str(tmp_path)).collect()
    assert len(found) == sum(len(spec.rule_names()) for spec in SILVER_TABLES.values())
    assert {r["rows"] for r in found} == {5}
    scratch = Path(scratch_root(spark))
    assert not list(scratch.glob("typed-*")) if scratch.exists() else True
