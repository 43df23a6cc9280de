from __future__ import annotations

import os
import sys
from datetime import date
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from semesta.schemas import TABLES  # noqa: E402
from semesta.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "semesta-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "2",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def table(spark):
    """``table(name, rows)``: literal rows of a declared table."""

    def build(name: str, *rows: tuple):
        return spark.createDataFrame(list(rows), TABLES[name].schema)

    return build


def rows(df, *columns: str) -> list[tuple]:
    picked = df.select(*columns) if columns else df
    return sorted((tuple(row) for row in picked.collect()), key=repr)


def in_order(df, *columns: str) -> list[tuple]:
    picked = df.select(*columns) if columns else df
    return [tuple(row) for row in picked.collect()]


def d(text: str) -> date:
    return date.fromisoformat(text)


def dec(text: str) -> Decimal:
    return Decimal(text)


@pytest.fixture(scope="session")
def campus(table):
    """A small campus: three students, two courses, two categories, loans and fines."""
    return {
        "program_studi": table("program_studi", (1, "S1", "Informatika", "Reguler"), (2, "S1", "Sistem", "Internasional")),
        "mata_kuliah": table("mata_kuliah", ("C1", "Basis Data", 3), ("C2", "Statistika", 2)),
        "mahasiswa": table(
            "mahasiswa",
            ("S1", 1, "Ani", "P", 2020, None),
            ("S2", 1, "Budi", "L", 2020, None),
            ("S3", 2, "Citra", "P", 2021, None),
        ),
        "hasil_studi": table(
            "hasil_studi",
            ("K1", "S1", "2020/2021", "Ganjil", None),
            ("K2", "S2", "2020/2021", "Ganjil", None),
            ("K3", "S1", "2020/2021", "Genap", None),
            ("K4", "S3", "2020/2021", "Genap", None),
        ),
        "detail_nilai": table(
            "detail_nilai",
            (1, "K1", "C1", dec("3.00"), "B", "Lulus"),
            (2, "K1", "C2", dec("4.00"), "A", "Lulus"),
            (3, "K2", "C1", dec("1.00"), "D", "Tidak Lulus"),
            (4, "K3", "C2", dec("3.50"), "A", "Lulus"),
            (5, "K4", "C1", None, None, None),
            (6, "K4", "C2", dec("4.00"), "A", "Lulus"),
        ),
        "kategori_buku": table("kategori_buku", (1, "Fiksi", None), (2, "Teknologi", None)),
        "buku": table(
            "buku",
            ("B1", "i1", "Judul 1", "p", None, 2000, 1),
            ("B2", "i2", "Judul 2", "p", None, 2000, 2),
            ("B3", "i3", "Judul 3", "p", None, 2000, 2),
            ("B4", "i4", "Judul 4", "p", None, 2000, 2),
        ),
        "eksemplar_buku": table(
            "eksemplar_buku", ("E1", "B1", "Baik", "Y"), ("E2", "B1", "Baik", "N"), ("E3", "B2", "Baik", "Y"), ("E4", "B3", "Baik", "N")
        ),
        "anggota": table(
            "anggota",
            ("A1", "S1", "Ani", "P", d("2020-01-01"), d("2024-01-01"), "Y"),
            ("A2", "S2", "Budi", "L", d("2020-01-01"), d("2024-01-01"), "Y"),
            ("A3", "S3", "Citra", "P", d("2020-01-01"), d("2024-01-01"), "N"),
        ),
        "kunjungan": table(
            "kunjungan",
            (1, "A1", d("2020-09-01"), "08:00:00", 10),
            (2, "A1", d("2020-09-02"), "08:00:00", 10),
            (3, "A1", d("2020-09-03"), "08:00:00", 10),
        ),
        "peminjaman": table(
            "peminjaman",
            (1, "A1", d("2020-09-01"), d("2020-09-15"), d("2020-09-22"), "Dikembalikan", "P1"),
            (2, "A1", d("2021-03-01"), d("2021-03-15"), None, "Dipinjam", "P1"),
            (3, "A2", d("2021-03-02"), d("2021-03-16"), d("2021-03-10"), "Dikembalikan", "P1"),
            (4, "A2", d("2022-03-02"), d("2022-03-16"), None, "Dipinjam", "P1"),
        ),
        "detail_peminjaman": table(
            "detail_peminjaman",
            (1, 1, "B1", "E1"),
            (2, 1, "B2", "E3"),
            (3, 1, "B3", "E4"),
            (4, 2, "B1", "E2"),
            (5, 3, "B1", "E1"),
            (6, 4, "B1", "E1"),
        ),
        "denda": table("denda", (1, 1, 7, 7000, "Belum Dibayar", None)),
    }
