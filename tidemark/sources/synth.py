"""Deterministic synthetic tables: every column is a function of an integer id."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.load import absent_keys
from tidemark.session import path_exists, run_folder
from tidemark.sources import words
from tidemark.sources.series import integer_series

# Id ranges of the published seed data.
FIRST_PATIENTS = (1, 2_000_000)
GROWTH_PATIENTS = (2_000_001, 3_500_000)
FIRST_DOCTORS = (1, 10_000)

ROWS_PER_TASK = 500_000


def pick(values: tuple[str, ...], number: Column) -> Column:
    """The entry of ``values`` at ``number`` modulo its length; the last one where there is none."""
    entries = F.array(*[F.lit(v) for v in values])
    return F.coalesce(F.get(entries, (number % len(values)).cast("int")), F.lit(values[-1]))


def padded(number: Column, width: int) -> Column:
    """Decimal digits filled with zeros at the left; longer numbers keep their first digits."""
    return F.lpad(number.cast("string"), width, "0")


# The remainders, shifts, texts and dates in the functions below.


def phone(number: Column, operators: int, shift: int, digits_shift: int) -> Column:
    operator = (number + shift) % operators + 1
    digits = (number + digits_shift) % 9_000_000 + 1_000_000
    return F.concat(F.lit("08"), operator.cast("string"), padded(digits, 8))


def day_after(start: str, days: Column) -> Column:
    return F.date_add(F.lit(start).cast("date"), days.cast("int"))


def postcode(number: Column) -> Column:
    return padded(number % 99_999 + 10_000, 5)


def patients(ids: DataFrame, column: str = "n") -> DataFrame:
    """Patient rows for every id of ``ids``."""
    n = F.col(column)
    first = pick(words.PATIENT_FIRST, n)
    address = F.concat(
        F.lit("Jl. "),
        pick(words.STREETS, n),
        F.lit(" No. "),
        (n % 200 + 1).cast("string"),
        F.lit(", RT."),
        padded(n % 20 + 1, 3),
        F.lit("/RW."),
        padded(n % 15 + 1, 3),
    )
    contact = F.concat_ws(
        " ", pick(words.CONTACT_FIRST, n + 7), pick(words.SURNAMES[:20], n + 13)
    )
    return ids.select(
        n.alias("id_pasien"),
        first.alias("nama_depan"),
        pick(words.SURNAMES, n).alias("nama_belakang"),
        day_after("1940-01-01", n % 30_000).alias("tanggal_lahir"),
        pick(words.GENDERS, n).alias("jenis_kelamin"),
        F.concat(F.lower(first), F.lit("."), n.cast("string"), F.lit("@email.com")).alias("email"),
        phone(n, 3, 0, 0).alias("no_telepon"),
        address.alias("alamat"),
        pick(words.CITIES, n).alias("kota"),
        pick(words.PROVINCES, n).alias("provinsi"),
        postcode(n).alias("kode_pos"),
        pick(words.BLOOD_GROUPS, n).alias("golongan_darah"),
        contact.alias("kontak_darurat"),
        phone(n, 3, 5_000, 3_000).alias("no_kontak_darurat"),
        day_after("2010-01-01", n % 5_475).alias("tanggal_registrasi"),
    )


def doctors(ids: DataFrame, column: str = "n") -> DataFrame:
    """Doctor rows for every id of ``ids``."""
    n = F.col(column)
    first = pick(words.DOCTOR_FIRST, n)
    return ids.select(
        n.alias("id_dokter"),
        first.alias("nama_depan"),
        pick(words.SURNAMES[:25], n).alias("nama_belakang"),
        pick(words.SPECIALTIES, n).alias("spesialisasi"),
        F.concat(
            F.lit("dr."), F.lower(first), n.cast("string"), F.lit("@rumahsakit.co.id")
        ).alias("email"),
        phone(n, 2, 0, 0).alias("no_telepon"),
        F.concat(F.lit("SIP/"), padded(n, 8), F.lit("/2024")).alias("no_sip"),
        (n % 35 + 1).cast("int").alias("tahun_pengalaman"),
        pick(words.DEPARTMENTS, n).alias("departemen"),
        day_after("2000-01-01", n % 9_125).alias("tanggal_bergabung"),
    )


def ensure_table(
    spark: SparkSession, location: str, make_rows: Callable[[], DataFrame]
) -> bool:
    """Write the seed rows where the table is missing or empty; tell whether it did."""
    if path_exists(spark, location):
        existing = spark.read.schema(make_rows().schema).parquet(location)
        if not existing.isEmpty():
            return False
    make_rows().write.mode("overwrite").parquet(location)
    return True


def grow(
    spark: SparkSession, location: str, first: int, last: int, key: str = "id_pasien"
) -> dict[str, int]:
    """Append patients ``first`` to ``last`` where absent. Running it again adds nothing.

    The check is on bare ids and the rows are made after it; the range filter reaches the scan,
    which skips the row groups outside the range.
    """
    total = max(last - first + 1, 0)
    pieces = max(spark.sparkContext.defaultParallelism, total // ROWS_PER_TASK)
    ids = integer_series(spark, first, last, key, pieces)
    schema = patients(ids, key).schema
    existing = spark.read.schema(schema).parquet(location)
    before = existing.count()
    in_range = existing.where(F.col(key).between(first, last))
    with run_folder(spark, "growth"):
        new_ids = absent_keys(ids, in_range, key, find_first=True)
        patients(new_ids, key).write.mode("append").parquet(location)
    after = spark.read.schema(schema).parquet(location).count()
    return {"before_count": before, "after_count": after, "added": after - before}
