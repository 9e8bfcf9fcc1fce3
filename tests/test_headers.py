"""CSV files with different headers in one folder, read in a batch and as a stream."""

import pytest
from pyspark.sql import functions as F

from pacewell.errors import ValidationError
from pacewell.operators import intake
from pacewell.schemas import OPTIONAL, RECORD_COLUMNS, REQUIRED
from pacewell.sources import files
from pacewell.streaming import jobs

VALUES = dict(zip(RECORD_COLUMNS, ["a{n}", "2031-05-04", "6.25", "3", "512.5", "2", "7", "71", "38.5", "47"]))


def write(folder, name, header, numbers, extra=""):
    """A file with the given columns; what the columns hold depends on their names only."""
    folder.mkdir(exist_ok=True)
    lines = [",".join(VALUES.get(c.removeprefix("﻿"), "x").format(n=n) for c in header) for n in numbers]
    (folder / name).write_text("\n".join([",".join(header), *lines]) + "\n" + extra)


@pytest.fixture
def folder(tmp_path):
    source = tmp_path / "in"
    write(source, "plain.csv", RECORD_COLUMNS, [1, 2])
    write(source, "turned round.csv", RECORD_COLUMNS[::-1], [3, 4])
    write(source, "short.csv", REQUIRED, [5])
    write(source, "more[1].CSV", ["coach", *RECORD_COLUMNS, "club"], [6], "too,few\n\n")
    write(source, "marked.csv", ["﻿athlete_id", *RECORD_COLUMNS[1:]], [7])
    write(source, "same.csv", RECORD_COLUMNS, [8])
    (source / "empty.csv").write_text("")
    (source / "other.txt").write_text("no,csv\n1,2\n")
    return source


def as_rows(df):
    return sorted(tuple(r) for r in df.select(*RECORD_COLUMNS).collect())


def test_each_file_by_its_own_header(spark, folder):
    found = files.read_csv(spark, str(folder), strict=False)
    whole = found.filter(F.col(intake.CORRUPT).isNull())
    assert sorted(r["athlete_id"] for r in whole.collect()) == [f"a{n}" for n in range(1, 9)]
    full = whole.filter("athlete_id <> 'a5'")
    assert len({tuple(r)[1:] for r in as_rows(full)}) == 1  # every column under its own name
    short = whole.filter("athlete_id = 'a5'").first()
    assert [short[c] for c in OPTIONAL] == [None, None, None] and short["training_load"] == 512.5
    assert whole.filter("coach = 'x' AND club = 'x'").count() == 1
    assert [r[intake.CORRUPT] for r in found.filter(F.col(intake.CORRUPT).isNotNull()).collect()] == ["too,few"]
    assert {r[0].rsplit("/", 1)[1] for r in found.select(files.SOURCE_FILE).distinct().collect()} >= {"plain.csv", "marked.csv"}


def test_strict_reading_names_the_file(spark, folder):
    (folder / "more[1].CSV").unlink()
    assert files.read_csv(spark, str(folder)).count() == 7
    write(folder, "lacking.csv", [c for c in RECORD_COLUMNS if c != "stress_level"], [9])
    with pytest.raises(ValidationError, match="stress_level.*lacking.csv"):
        files.read_csv(spark, str(folder))


@pytest.mark.parametrize("header", [
    [c for c in RECORD_COLUMNS if c != "stress_level"], [*RECORD_COLUMNS, "HRV"], [*RECORD_COLUMNS, "_corrupt"], ["no header at all"]])
def test_lenient_reading_keeps_lines_of_unreadable_files(spark, folder, header):
    write(folder, "wrong.csv", header, [9, 9])
    found = files.read_csv(spark, str(folder), strict=False)
    damaged = found.filter(F.col(files.SOURCE_FILE).endswith("wrong.csv"))
    assert damaged.count() == 2 and damaged.filter(F.col(intake.CORRUPT).isNull()).count() == 0
    assert found.count() == 8 + 1 + 2


def test_one_known_header_needs_no_pass(spark, folder):
    with pytest.raises(Exception):
        files.read_csv(spark, str(folder), header=RECORD_COLUMNS).collect()
    for name in ("turned round.csv", "short.csv", "more[1].CSV", "marked.csv"):
        (folder / name).unlink()
    assert as_rows(files.read_csv(spark, str(folder), header=RECORD_COLUMNS)) == as_rows(files.read_csv(spark, str(folder)))


def test_folders_without_records(spark, tmp_path):
    (tmp_path / "none").mkdir()
    with pytest.raises(ValidationError):
        files.read_csv(spark, str(tmp_path / "none"))
    write(tmp_path / "head", "only.csv", RECORD_COLUMNS, [])
    assert files.csv_text(spark, str(tmp_path / "head")).count() == 0


@pytest.fixture
def arriving(folder):
    """Spark's stream of files takes brackets in a name for a pattern and then lists the other files twice."""
    (folder / "more[1].CSV").rename(folder / "more.CSV")
    return folder


def outcome(good, bad):
    return (sorted(r["athlete_id"] for r in good.collect()),
            sorted((r["violations"], r["athlete_id"] or "") for r in bad.collect()))


def test_a_stream_reads_what_the_batch_reads(spark, arriving, tmp_path):
    write(arriving, "wrong.csv", ["no header at all"], [9, 9])
    for max_files in (None, 2):
        paths = [str(tmp_path / f"{p}{max_files}") for p in ("good", "bad", "checkpoint")]
        jobs.intake_stream(jobs.csv_stream(spark, str(arriving), max_files), *paths).awaitTermination()
        streamed = outcome(spark.read.parquet(paths[0]), spark.read.parquet(paths[1]))
        assert streamed == outcome(*intake.split_valid(files.read_csv(spark, str(arriving), strict=False)))
        assert len(streamed[0]) == 8 and len(streamed[1]) == 3


def test_whole_files_are_refused(spark, arriving, tmp_path):
    write(arriving, "refused.csv", RECORD_COLUMNS, [10, 11, 12], "a13,never,6,3,512,2,7,,,\n")
    good, refused = intake.split_batches(files.read_csv(spark, str(arriving), strict=False), [files.SOURCE_FILE])
    names = {r[files.SOURCE_FILE].rsplit("/", 1)[1]: (r["n_rows"], r["n_bad"], r["first_violation"]) for r in refused.collect()}
    assert names == {"refused.csv": (4, 1, "record_date_unparsed"), "more.CSV": (2, 1, "damaged_line")}
    assert sorted(r["athlete_id"] for r in good.collect()) == ["a1", "a2", "a3", "a4", "a5", "a7", "a8"]
    paths = [str(tmp_path / p) for p in ("good", "bad", "checkpoint")]
    for _ in range(2):  # a second run has nothing to do
        jobs.intake_stream(jobs.csv_stream(spark, str(arriving), 3), *paths, whole_files=True).awaitTermination()
        assert sorted(r["athlete_id"] for r in spark.read.parquet(paths[0]).collect()) == ["a1", "a2", "a3", "a4", "a5", "a7", "a8"]
        listed = spark.read.parquet(paths[1])
        assert sorted((r["n_rows"], r["n_bad"], r["first_violation"]) for r in listed.collect()) == sorted(names.values())
