"""Code-to-label decodes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels as they appear in the warehouse and in the reports.
MALE, FEMALE = "Laki-laki", "Perempuan"
COMPULSORY = "Wajib"
CATEGORY_PREFIX = "Kategori: "
GPA_BANDS = (
    (351, "Cumlaude (3.51 - 4.00)"),
    (301, "Sangat Memuaskan (3.01 - 3.50)"),
    (251, "Memuaskan (2.51 - 3.00)"),
    (200, "Cukup (2.00 - 2.50)"),
)
LOWEST_BAND = "Kurang (< 2.00)"
NEVER_BORROWS = "1 - Tidak Pernah Pinjam"
SELDOM_BORROWS = "2 - Jarang (1-5 Buku/Semester)"
OFTEN_BORROWS = "3 - Rajin (>5 Buku/Semester)"
WITHOUT_FINE = "Disiplin (Tanpa Denda)"
WITH_FINE = "Pernah Terlambat (Kena Denda)"


def gender_full_load(code: Column) -> Column:
    """Full load: unknown codes and NULL pass through."""
    return F.when(code == "L", MALE).when(code == "P", FEMALE).otherwise(code)


def gender_incremental(code: Column) -> Column:
    """Incremental load: everything but ``L``, NULL included, is female."""
    return F.when(code == "L", MALE).otherwise(FEMALE)


def category_description(name: Column) -> Column:
    return F.concat(F.lit(CATEGORY_PREFIX), name)


def gpa_band(hundredths: Column) -> Column:
    """Band of a GPA in hundredths; a missing GPA falls in the lowest band."""
    band = F
    for floor, label in GPA_BANDS:
        band = band.when(hundredths >= floor, label)
    return band.otherwise(LOWEST_BAND)


def borrowing_tier(loans: Column) -> Column:
    return (
        F.when(loans == 0, NEVER_BORROWS).when(loans.between(1, 5), SELDOM_BORROWS).otherwise(OFTEN_BORROWS)
    )


def fine_status(fine: Column) -> Column:
    return F.when(fine == 0, WITHOUT_FINE).otherwise(WITH_FINE)
