"""Dimension rows from the operational tables.

Full-load functions return all rows, ``new_*`` only what the dimension does not have yet. Surrogate
ids are assigned afterwards by ``operators.keys``; ``natural_ids`` puts the natural key in their
place where results are compared between runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from semesta.functions import decode
from semesta.operators.merge import insert_if_absent, upsert

# Natural key and id column of the dimensions with assigned ids.
NATURAL_KEYS = {
    "dim_waktu": (["tahun_akademik", "semester"], "waktu_id"),
    "dim_mahasiswa": (["nim"], "mahasiswa_id"),
    "dim_mata_kuliah": (["kode_mata_kuliah"], "mata_kuliah_id"),
}


def semesters(hasil_studi: DataFrame) -> DataFrame:
    return (
        hasil_studi.select("tahun_akademik", "semester")
        .filter(F.col("tahun_akademik").isNotNull() & F.col("semester").isNotNull())
        .distinct()
    )


def study_programmes(program_studi: DataFrame) -> DataFrame:
    return program_studi.select("program_studi_id", "jenjang", "nama_program_studi", "kelas")


def students(mahasiswa: DataFrame, gender=decode.gender_full_load) -> DataFrame:
    return mahasiswa.select(
        "nim",
        F.col("nama_lengkap").alias("nama"),
        gender(F.col("jenis_kelamin")).alias("jenis_kelamin"),
        F.col("angkatan").cast("int").alias("angkatan"),
    )


def courses(mata_kuliah: DataFrame) -> DataFrame:
    return mata_kuliah.select(
        F.col("mata_kuliah_id").alias("kode_mata_kuliah"),
        "nama_mata_kuliah",
        F.col("sks").cast("int").alias("bobot_sks"),
        F.lit(decode.COMPULSORY).alias("jenis_mata_kuliah"),
    )


def categories(kategori_buku: DataFrame) -> DataFrame:
    return kategori_buku.select(
        F.col("kategori_id").cast("int").alias("kategori_id"),
        "nama_kategori",
        decode.category_description(F.col("nama_kategori")).alias("deskripsi"),
    )


def new_semesters(hasil_studi: DataFrame, dim_waktu: DataFrame) -> DataFrame:
    """Unseen semesters. Unlike the full load this keeps NULLs, which then fail the NOT NULL check."""
    sent = hasil_studi.select("tahun_akademik", "semester").distinct()
    return insert_if_absent(sent, dim_waktu, ["tahun_akademik", "semester"])


def upserted_students(mahasiswa: DataFrame, dim_mahasiswa: DataFrame) -> DataFrame:
    """All students after the upsert: name and gender follow the source, intake year stays."""
    sent = students(mahasiswa, decode.gender_incremental)
    return upsert(sent, dim_mahasiswa, "nim", update=["nama", "jenis_kelamin"])


def new_courses(mata_kuliah: DataFrame, dim_mata_kuliah: DataFrame) -> DataFrame:
    return insert_if_absent(courses(mata_kuliah), dim_mata_kuliah, ["kode_mata_kuliah"])


def new_study_programmes(program_studi: DataFrame, dim_program_studi: DataFrame) -> DataFrame:
    return insert_if_absent(study_programmes(program_studi), dim_program_studi, ["program_studi_id"])


def new_categories(kategori_buku: DataFrame, dim_kategori_buku: DataFrame) -> DataFrame:
    return insert_if_absent(categories(kategori_buku), dim_kategori_buku, ["kategori_id"])


def natural_ids(name: str, dimension: DataFrame) -> DataFrame:
    """The dimension with its natural key as id."""
    key, id_column = NATURAL_KEYS[name]
    return dimension.select(F.concat_ws(" ", *key).alias(id_column), *dimension.columns)
