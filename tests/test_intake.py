from statistics import mean, median

import pytest
from pyspark.sql import functions as F

from pacewell.errors import ValidationError
from pacewell.operators import intake
from pacewell.operators.analytics import daily_means
from pacewell.operators.clean import clean
from pacewell.operators.features import engineer, fit_fill_values
from pacewell.schemas import RECORD_COLUMNS
from pacewell.sources import files

HEADER = ",".join(RECORD_COLUMNS)
GOOD = "kim,2031-05-04,6.25,3,512.5,2,7,71,38.5,47"


def lines(path, name, *rows, header=HEADER):
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join([header, *rows]) + "\n", encoding="utf-8")
    return str(path)


def test_golden_values(golden, golden_rows):
    """Aggregates of the made-up records against plain Python."""
    known = [[r[i] for r in golden_rows if r[i] is not None] for i in (7, 8)]
    assert fit_fill_values(clean(golden)) == {"resting_heart_rate": median(known[0]), "hrv": median(known[1])}
    row = engineer(clean(golden)).agg(
        F.count("*").alias("n"), F.count_distinct("athlete_id").alias("athletes"),
        F.avg("performance_score").alias("mean"), F.sum("sleep_recovery_ratio").alias("sleep"),
        F.sum("load_stress_ratio").alias("load")).first()
    assert (row["n"], row["athletes"]) == (15, 3)
    assert row["mean"] == pytest.approx(mean(r[9] for r in golden_rows))
    assert row["sleep"] == pytest.approx(sum(r[2] * r[3] / (r[6] + 1e-6) for r in golden_rows))
    assert row["load"] == pytest.approx(sum(r[4] / (r[5] + 1e-6) for r in golden_rows))
    days = sorted({r[1] for r in golden_rows})
    means = [r["mean_performance_score"] for r in daily_means(golden).collect()]
    assert means == pytest.approx([mean(r[9] for r in golden_rows if r[1] == day) for day in days])


def test_csv_round_trip(spark, golden, tmp_path):
    files.write_csv(golden, str(tmp_path / "out"))
    back = files.read_csv(spark, str(tmp_path / "out")).select(*RECORD_COLUMNS)
    assert back.exceptAll(golden).isEmpty() and golden.exceptAll(back).isEmpty()


def test_csv_columns_go_by_name(spark, tmp_path):
    names = list(reversed(RECORD_COLUMNS))
    path = lines(tmp_path / "r", "a.csv", ",".join(reversed(GOOD.split(","))), header=",".join(names))
    row = files.read_csv(spark, path).first()
    assert (row["athlete_id"], row["hrv"], row["sleep_hours"]) == ("kim", 38.5, 6.25)


def test_csv_optional_columns_may_be_absent(spark, tmp_path):
    path = lines(tmp_path / "r", "a.csv", "a,2031-05-04,6,3,512,2,7", header=",".join(RECORD_COLUMNS[:7]))
    row = files.read_csv(spark, path).first()
    assert row["hrv"] is None and row["resting_heart_rate"] is None and row["performance_score"] is None


def test_csv_needs_extension_and_columns(spark, tmp_path):
    lines(tmp_path / "m", "upper.CSV", GOOD)
    path = lines(tmp_path / "m", "notes.txt", GOOD)
    assert files.read_csv(spark, path).count() == 1
    with pytest.raises(ValidationError, match="hrv|missing"):
        files.csv_text(spark, lines(tmp_path / "n", "a.csv", "1", header="athlete_id"))
    with pytest.raises(ValidationError):
        files.read_csv(spark, str(tmp_path / "nothing"))


def test_csv_bad_values(spark, tmp_path):
    path = lines(
        tmp_path / "b", "a.csv", GOOD,
        "lee,someday,6.25,3,512.5,2,7,71,38.5,47",
        "moe,2031-05-06,6.25,3,heavy,2,7,71,38.5,47",
        ",2031-05-07,6.25,3,512.5,2,7,71,38.5,47",
        "noa,2031-05-08,6.25",
        "ola,2031-05-09,,3,512.5,2,7,,NaN,47")
    text = files.read_csv(spark, path, strict=False)
    good, bad = intake.split_valid(text)
    assert [r["athlete_id"] for r in good.collect()] == ["kim"]
    found = {r["athlete_id"]: r["violations"] for r in bad.collect()}
    assert found["lee"] == ["record_date_unparsed", "record_date_missing"]
    assert found["moe"] == ["training_load_unparsed", "training_load_missing"]
    assert found[None] == ["athlete_id_length"]
    assert found["noa"][0] == "damaged_line"
    assert found["ola"] == ["sleep_hours_missing"]
    damaged = text.filter(F.col(intake.CORRUPT).isNotNull()).select("athlete_id", intake.CORRUPT).collect()
    assert [r["athlete_id"] for r in damaged] == ["noa"]
    with pytest.raises(Exception, match="(?i)damaged|cast|invalid"):
        files.read_csv(spark, path).collect()


def test_csv_must_be_utf8(spark, tmp_path):
    (tmp_path / "u").mkdir()
    latin = GOOD.replace("kim", "Zoé")
    (tmp_path / "u" / "a.csv").write_bytes((HEADER + "\n" + latin + "\n").encode("latin-1"))
    (tmp_path / "u" / "b.csv").write_text(HEADER + "\n" + latin + "\n", encoding="utf-8")
    good, bad = intake.split_valid(files.read_csv(spark, str(tmp_path / "u"), strict=False))
    assert [r["athlete_id"] for r in good.collect()] == ["Zoé"]
    assert [r["violations"] for r in bad.collect()] == [["damaged_line"]]
    with pytest.raises(Exception, match="damaged CSV line"):
        files.read_csv(spark, str(tmp_path / "u")).collect()


def test_file_size_limit(spark, tmp_path):
    path = lines(tmp_path / "l", "a.csv", GOOD, GOOD, GOOD)
    assert files.read_csv(spark, path, max_rows_per_file=3).count() == 3
    with pytest.raises(ValidationError, match="3 rows"):
        files.read_csv(spark, path, max_rows_per_file=2)


def test_json_batches(spark, golden, tmp_path):
    holes = golden.withColumn("hrv", F.when(F.col("hrv") > 50, F.col("hrv")))
    path = str(tmp_path / "j")
    files.write_json_batches(holes.coalesce(1), path, batch_size=4)
    documents = spark.read.text(path)
    assert documents.count() >= 4
    assert documents.filter("value LIKE '%\"hrv\":null%'").isEmpty()
    back = files.read_json_batches(spark, path, max_records=4).select(*RECORD_COLUMNS)
    assert back.exceptAll(holes).isEmpty() and holes.exceptAll(back).isEmpty()
    with pytest.raises(ValidationError):
        files.read_json_batches(spark, path, max_records=3)


def test_json_damage_is_kept_or_refused(spark, tmp_path):
    record = '{"athlete_id":"kim","record_date":"2031-05-04","sleep_hours":6,"sleep_quality":3,"training_load":512,"stress_level":2,"recovery_score":7}'
    (tmp_path / "d").mkdir()
    documents = [f'{{"records":[{record}]}}', '{"records":[{"athlete', f'{{"records":[{record.replace("6", chr(34) + "abc" + chr(34))}]}}', '{"records":[]}', '{"other":1}']
    (tmp_path / "d" / "a.json").write_text("\n".join(documents))
    rows = intake.with_violations(files.read_json_batches(spark, str(tmp_path / "d"), strict=False)).collect()
    assert sorted(r["violations"][:1] for r in rows) == [[], ["damaged_line"], ["damaged_line"], ["sleep_hours_unparsed"]]
    with pytest.raises(Exception, match="damaged JSON document|cast"):
        files.read_json_batches(spark, str(tmp_path / "d")).collect()
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "a.json").write_text('{\n "records": [\n' + record + "\n]\n}")
    assert files.read_json_batches(spark, str(tmp_path / "m"), multi_line=True).count() == 1
    assert intake.with_violations(files.read_json_batches(spark, str(tmp_path / "m"), strict=False)).filter("violations[0] = 'damaged_line'").count() > 0


def test_missing_columns(golden):
    with pytest.raises(ValidationError, match="record_date, sleep_hours"):
        intake.require_columns(golden.drop("record_date", "sleep_hours"))
    assert intake.missing_columns(golden) == []


def test_profiles_differ(spark, golden):
    odd = golden.limit(1).withColumns({"training_load": F.lit(2500.0), "hrv": F.lit(250.0)})
    assert intake.with_violations(odd, "ingest").first()["violations"] == ["training_load_range", "hrv_range"]
    assert intake.with_violations(odd, "api").first()["violations"] == []


def test_out_of_range_request_is_rejected(golden):
    request = golden.limit(1).withColumns({"recovery_score": F.lit(78.0), "prediction_date": F.col("record_date")})
    with pytest.raises(ValidationError, match="recovery_score_range"):
        intake.require_valid(request, "predict")
    assert intake.require_valid(golden, "ingest").count() == 15


def test_bounds_are_inclusive_and_nan_is_outside(golden):
    edge = golden.limit(1).withColumns({"sleep_hours": F.lit(24.0), "stress_level": F.lit(1.0)})
    assert intake.with_violations(edge, "ingest").first()["violations"] == []
    nan = golden.limit(1).withColumn("training_load", F.lit(float("nan")))
    assert intake.with_violations(nan, "api").first()["violations"] == ["training_load_range"]


def test_batch_limit(golden):
    assert {r["n_rows"] for r in intake.oversized_groups(golden, ["athlete_id"], 4).collect()} == {5}
    assert intake.oversized_groups(golden, ["athlete_id"], None).isEmpty()
    with pytest.raises(ValidationError):
        intake.require_batch_size(golden.limit(0), ["athlete_id"], 5)


def test_values_are_parsed_before_rows_are_told_apart(spark):
    """A filter on parsed columns that moves below their projection parses them again at each mention."""
    text = spark.range(3).select(*[F.col("id").cast("string").alias(c) for c in RECORD_COLUMNS])
    for rows in intake.split_valid(intake.coerce(text, strict=False)):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert [line for line in plan.splitlines() if "Filter" in line]
        assert not [line for line in plan.splitlines() if "Filter" in line and "cast(" in line]
