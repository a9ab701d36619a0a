import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.operators import quality, transform
from tidemark.plans.spec import PATIENTS, Copy, TransformSpec, lookup, register
from tidemark.sources import integer_series, patients

COLUMNS = "id_pasien int, nama_depan string, nama_belakang string, email string"


def source(spark, rows):
    """Patient rows with the given ids, names and emails; the rest as generated."""
    given = spark.createDataFrame(rows, COLUMNS)
    filled = patients(given.select("id_pasien").distinct(), "id_pasien").drop(
        "nama_depan", "nama_belakang", "email"
    )
    return given.join(filled, "id_pasien")


EDGE = [
    (1, "Bayu", "Wijaya", "a@b.c"),
    (2, "  ", "\t", "a@b.c"),
    (3, "Dian", "", "a@b.c"),
    (4, None, None, "a@b.c"),
    (5, " Ana　", "", "a@b.c"),
    (6, "x" * 50, "y" * 50, "a@b.c"),
    (7, "A", "B", "\U0001f600" * 101),
    (0, "A", "B", None),
    (-1, "A", "B", ""),
]


def test_edge_rows(spark):
    mapped = transform.map_rows(source(spark, EDGE), PATIENTS)
    valid = {r.pasien_uuid: r for r in transform.valid_rows(mapped, PATIENTS).collect()}
    names = {r.nama_lengkap for r in valid.values()}
    assert len(valid) == 7
    assert valid["3eb9191e-e35a-5b19-ab9a-5e4526c482d0"].nama_lengkap == "Bayu Wijaya"
    assert {"Dian", "Ana", "A B", "x" * 50 + " " + "y" * 49} <= names
    assert any(r.email == "\U0001f600" * 100 for r in valid.values())
    assert any(r.email is None for r in valid.values())


def test_reject_messages(spark):
    mapped = transform.map_rows(source(spark, EDGE), PATIENTS)
    rejects = {r.id: r.error for r in transform.rejected_rows(mapped).collect()}
    text = "nama_lengkap is empty (both nama_depan and nama_belakang are blank)"
    assert rejects == {i: f"transform id_pasien={i}: {text}" for i in (2, 4)}


def test_survivors_keep_their_source_columns(spark):
    rows = source(spark, EDGE)
    kept = transform.surviving_source_rows(rows, PATIENTS)
    assert kept.columns == rows.columns
    assert sorted(r.id_pasien for r in kept.collect()) == [-1, 0, 1, 3, 5, 6, 7]


def test_missing_key_is_rejected(spark):
    mapped = transform.map_rows(source(spark, EDGE[:1]).withColumn("id_pasien", F.lit(None).cast("int")), PATIENTS)
    assert [r.id for r in transform.rejected_rows(mapped).collect()] == [None]


def test_strict_nulls_raise(spark):
    rows = source(spark, [(4, None, "B", "a@b.c")])
    assert transform.valid_rows(transform.map_rows(rows, PATIENTS), PATIENTS).count() == 1
    with pytest.raises(PySparkException, match="null in column nama_depan"):
        transform.map_rows(rows, PATIENTS, strict_nulls=True).collect()


def test_target_columns_and_renames(spark):
    mapped = transform.map_rows(patients(integer_series(spark, 42, 42)), PATIENTS)
    row = transform.valid_rows(mapped, PATIENTS).first()
    source_row = patients(integer_series(spark, 42, 42)).first()
    assert list(row.asDict()) == [
        "pasien_uuid",
        "nama_lengkap",
        "tanggal_lahir",
        "gender",
        "email",
        "telepon",
        "alamat_lengkap",
        "kota",
        "provinsi",
        "kode_pos",
        "golongan_darah",
        "nama_kontak_darurat",
        "telepon_kontak_darurat",
        "tanggal_registrasi",
    ]
    assert row.gender == source_row.jenis_kelamin
    assert row.telepon == source_row.no_telepon
    assert row.alamat_lengkap == source_row.alamat
    assert row.nama_kontak_darurat == source_row.kontak_darurat
    assert row.telepon_kontak_darurat == source_row.no_kontak_darurat
    assert row.tanggal_lahir == datetime.date(1940, 2, 12)


def test_whole_transform_stays_in_generated_code(spark, plan_of):
    mapped = transform.map_rows(patients(integer_series(spark, 1, 9)), PATIENTS)
    plan = plan_of(transform.valid_rows(mapped, PATIENTS))
    assert "Python" not in plan
    assert "Exchange" not in plan


def test_registry():
    assert lookup("pasien") is PATIENTS
    assert lookup("pasien", "pasien") is PATIENTS
    with pytest.raises(LookupError):
        lookup("dokter")
    with pytest.raises(LookupError):
        lookup("pasien", "other")


def test_prepare_hook(spark):
    spec = register(
        TransformSpec(
            source="raw_people",
            target="people",
            key="id",
            key_output="key",
            namespace=PATIENTS.namespace,
            fields=(Copy("name", "name", max_chars=3),),
            prepare=lambda rows: rows.withColumn("name", F.upper("name")),
        )
    )
    rows = spark.createDataFrame([(1, "abcdef")], "id long, name string")
    mapped = transform.map_rows(rows, spec)
    assert transform.valid_rows(mapped, spec).first().name == "ABC"


def test_generated_patients_conform(spark):
    mapped = transform.map_rows(patients(integer_series(spark, 1, 5_000)), PATIENTS)
    valid = transform.valid_rows(mapped, PATIENTS)
    assert quality.violations(valid, "pasien_uuid", PATIENTS.limits, PATIENTS.not_null).count() == 0


def test_violations(spark):
    rows = spark.createDataFrame([(1, "abc", None), (2, "ab", "x"), (3, None, None)], "id int, a string, b string")
    found = quality.violations(rows, "id", {"a": 2}, ("a", "b"))
    assert sorted(tuple(r) for r in found.fillna(-1).collect()) == [
        (1, "a", "too long", 3),
        (1, "b", "null", -1),
        (3, "a", "null", -1),
        (3, "b", "null", -1),
    ]
