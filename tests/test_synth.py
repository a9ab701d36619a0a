import datetime

from tidemark.sources import doctors, ensure_table, grow, integer_series, patients
from tidemark.sources.synth import pick
from tidemark.sources import words


def test_series_has_both_ends(spark):
    assert [r.n for r in integer_series(spark, 3, 6).orderBy("n").collect()] == [3, 4, 5, 6]
    assert integer_series(spark, 3, 2).count() == 0


def test_list_sizes():
    sizes = {
        name: len(getattr(words, name))
        for name in ("PATIENT_FIRST", "SURNAMES", "CONTACT_FIRST", "DOCTOR_FIRST", "STREETS")
    }
    assert sizes == {
        "PATIENT_FIRST": 40,
        "SURNAMES": 30,
        "CONTACT_FIRST": 30,
        "DOCTOR_FIRST": 30,
        "STREETS": 25,
    }
    assert len(words.CITIES) == len(words.PROVINCES) == 34
    assert len(words.SPECIALTIES) == 15
    assert len(words.DEPARTMENTS) == 10


def test_first_patient(spark):
    row = patients(integer_series(spark, 1, 1)).first()
    assert tuple(row) == (
        1,
        "Bayu",
        "Wijaya",
        datetime.date(1940, 1, 2),
        "Perempuan",
        "bayu.1@email.com",
        "08201000001",
        "Jl. Thamrin No. 2, RT.002/RW.002",
        "Surabaya",
        "Jawa Timur",
        "10001",
        "A+",
        "Hadi Hakim",
        "08101003001",
        datetime.date(2010, 1, 2),
    )


def test_first_doctor(spark):
    row = doctors(integer_series(spark, 1, 1)).first()
    assert tuple(row) == (
        1,
        "Budi",
        "Wijaya",
        "Pediatri",
        "dr.budi1@rumahsakit.co.id",
        "08201000001",
        "SIP/00000001/2024",
        2,
        "IGD",
        datetime.date(2000, 1, 2),
    )


def test_postcode_cuts_six_digits_to_five(spark):
    row = patients(integer_series(spark, 90_000, 90_000)).first()
    assert row.kode_pos == "10000"


def test_pick(spark):
    rows = spark.createDataFrame([(None,), (-5,), (0,), (4,)], "n long")
    got = [r[0] for r in rows.select(pick(["a", "b", "c"], rows.n)).collect()]
    assert got == ["c", "c", "a", "b"]


def test_ensure_table_seeds_once(spark, tmp_path):
    location = str(tmp_path / "patients")
    make = lambda: patients(integer_series(spark, 1, 50))
    assert ensure_table(spark, location, make) is True
    assert ensure_table(spark, location, make) is False
    assert spark.read.parquet(location).count() == 50


def test_ensure_table_seeds_an_empty_table(spark, tmp_path):
    location = str(tmp_path / "patients")
    make = lambda: patients(integer_series(spark, 1, 50))
    make().limit(0).write.parquet(location)
    assert ensure_table(spark, location, make) is True
    assert spark.read.parquet(location).count() == 50


def test_growth_adds_only_what_is_absent(spark, tmp_path):
    location = str(tmp_path / "patients")
    patients(integer_series(spark, 1, 120)).write.parquet(location)
    assert grow(spark, location, 101, 200) == {
        "before_count": 120,
        "after_count": 200,
        "added": 80,
    }
    assert grow(spark, location, 101, 200)["added"] == 0
    rows = spark.read.parquet(location)
    assert rows.select("id_pasien").distinct().count() == rows.count() == 200
