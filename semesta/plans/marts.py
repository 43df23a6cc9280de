"""Analytic marts over the facts.

Facts are reduced on their own key columns first; names and labels from dimensions are joined to
the reduced rows. Percentages and averages are rounded once, on exact integers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from semesta.functions import decode
from semesta.functions.rounding import half_up, hundredths, percent, two_places
from semesta.operators import rank
from semesta.operators.grouping import cube_sets, grouping_sets, grouping_sets_by_entity, label, rollup_sets
from semesta.operators.settled import settled

# Labels of subtotal rows and thresholds of the reports.
ALL_YEARS, ALL_SEMESTERS = "Semua Tahun (Grand Total)", "Semua Semester (Sub-Total)"
ALL_CLASSES = "Grand Total Keseluruhan"
COHORT_ALL = {"angkatan": "Semua Angkatan", "tahun_akademik": "Semua Tahun", "semester": "Semua Semester"}
LOANS_ALL_YEARS, LOANS_ALL_SEMESTERS = "Total Semua Waktu", "Sub-Total Tahun"
ALL_TIERS = "Grand Total Populasi"
ALL_FINE_STATUS = "Rata-rata Keseluruhan Mahasiswa"
ALL_GENDERS = "Semua Demografi (Total)"
MORE_TAKERS_THAN = 10
HIGH_GPA = 350

_TERM = ["tahun_akademik", "semester"]


def _gpa() -> Column:
    return hundredths(F.col("ip_semester"))


def _failed() -> Column:
    return F.sum(F.when(~F.col("status_lulus"), 1).otherwise(0))


def course_failures(fact_detail_nilai: DataFrame, dim_mata_kuliah: DataFrame) -> DataFrame:
    """Share of failed takers per course, densely ranked; at most 10,001 distinct shares are ranked."""
    per_course = fact_detail_nilai.groupBy("mata_kuliah_id").agg(
        F.count("mahasiswa_id").alias("takers"), _failed().alias("failed")
    )
    shares = (
        per_course.join(
            dim_mata_kuliah.select("mata_kuliah_id", "kode_mata_kuliah", "nama_mata_kuliah"), "mata_kuliah_id"
        )
        .withColumn("share", percent(F.col("failed"), F.col("takers")))
    )
    return rank.dense_rank(shares, "share", "peringkat_kritis").select(
        "kode_mata_kuliah",
        "nama_mata_kuliah",
        F.col("takers").alias("total_mahasiswa_mengambil"),
        F.col("failed").alias("total_tidak_lulus"),
        two_places(F.col("share")).alias("persentase_tidak_lulus"),
        "peringkat_kritis",
    )


def _gpa_by_term(
    fact_rekap_ip: DataFrame, dimension: DataFrame, on: str, dimensions: list[str], sets: list[tuple[str, ...]]
) -> DataFrame:
    rows = fact_rekap_ip.join(dimension.select(on, *dimensions), on)
    return grouping_sets_by_entity(
        rows, dimensions, sets, "mahasiswa_id", "students", {"gpa": _gpa(), "graded": F.col("ip_semester").isNotNull().cast("bigint")}
    ).withColumn("mean", two_places(half_up(F.col("gpa"), F.nullif(F.col("graded"), F.lit(0)))))


def gpa_trend(fact_rekap_ip: DataFrame, dim_waktu: DataFrame) -> DataFrame:
    """Students and mean GPA per semester, academic year and overall, in report order."""
    return (
        _gpa_by_term(fact_rekap_ip, dim_waktu, "waktu_id", _TERM, rollup_sets(_TERM))
        .orderBy(F.asc_nulls_last("tahun_akademik"), F.desc_nulls_first("semester"))
        .select(
            label("tahun_akademik", ALL_YEARS).alias("tahun_akademik"),
            label("semester", ALL_SEMESTERS).alias("semester"),
            F.col("students").alias("total_mahasiswa_aktif"),
            F.col("mean").alias("rata_rata_ip_semester"),
        )
    )


def class_comparison(fact_rekap_ip: DataFrame, dim_program_studi: DataFrame) -> DataFrame:
    """Students and mean GPA per class type and overall, the best first; equal means by class, the total last."""
    return _gpa_by_term(
        fact_rekap_ip, dim_program_studi, "program_studi_id", ["kelas"], [("kelas",), ()]
    ).orderBy(F.desc_nulls_first("mean"), F.asc_nulls_last("kelas")).select(
        label("kelas", ALL_CLASSES).alias("kelas"),
        F.col("students").alias("populasi_mahasiswa"),
        F.col("mean").alias("rata_rata_ipk_keseluruhan"),
    )


def intake_cohorts(fact_rekap_ip: DataFrame, dim_mahasiswa: DataFrame, dim_waktu: DataFrame) -> DataFrame:
    """Students, mean GPA and mean credits for every combination of intake year, year and semester, in report order."""
    dimensions = ["angkatan", *_TERM]
    rows = fact_rekap_ip.join(dim_waktu.select("waktu_id", *_TERM), "waktu_id").join(
        dim_mahasiswa.select("mahasiswa_id", "angkatan"), "mahasiswa_id"
    )
    sums = {
        "gpa": _gpa(),
        "graded": F.col("ip_semester").isNotNull().cast("bigint"),
        "credits": F.col("total_sks").cast("bigint"),
        "credited": F.col("total_sks").isNotNull().cast("bigint"),
    }
    cube = grouping_sets_by_entity(rows, dimensions, cube_sets(dimensions), "mahasiswa_id", "students", sums)
    order = [F.desc_nulls_first("angkatan"), F.asc_nulls_last("tahun_akademik"), F.desc_nulls_first("semester")]
    return cube.orderBy(*order).select(
        *(label(d, COHORT_ALL[d]).alias(d) for d in dimensions),
        F.col("students").alias("jumlah_mahasiswa_aktif"),
        two_places(half_up(F.col("gpa"), F.nullif(F.col("graded"), F.lit(0)))).alias("rata_rata_ip_angkatan"),
        half_up(F.col("credits"), F.nullif(F.col("credited"), F.lit(0))).cast("double").alias("rata_rata_sks_diambil"),
    )


def critical_courses_by_intake(
    fact_detail_nilai: DataFrame, dim_mahasiswa: DataFrame, dim_mata_kuliah: DataFrame
) -> DataFrame:
    """Courses with more than ten takers per intake year, numbered by share of failed takers.

    Courses of equal name and type count as one. Ties are numbered by name, then type.
    """
    per_course = (
        fact_detail_nilai.select("mahasiswa_id", "mata_kuliah_id", "status_lulus")
        .join(dim_mahasiswa.select("mahasiswa_id", "angkatan"), "mahasiswa_id")
        .groupBy("angkatan", "mata_kuliah_id")
        .agg(F.count("mahasiswa_id").alias("takers"), _failed().alias("failed"))
    )
    shares = (
        per_course.join(
            dim_mata_kuliah.select("mata_kuliah_id", "nama_mata_kuliah", "jenis_mata_kuliah"), "mata_kuliah_id"
        )
        .groupBy("angkatan", "nama_mata_kuliah", "jenis_mata_kuliah")
        .agg(F.sum("takers").alias("total_pengambil"), F.sum("failed").alias("total_gagal"))
        .filter(F.col("total_pengambil") > MORE_TAKERS_THAN)
        .withColumn("share", percent(F.col("total_gagal"), F.col("total_pengambil")))
    )
    return rank.row_number(
        shares,
        ["angkatan"],
        "share",
        [F.col("nama_mata_kuliah"), F.col("jenis_mata_kuliah")],
        "ranking_matkul_kritis_angkatan",
    ).select(
        "angkatan",
        "nama_mata_kuliah",
        "jenis_mata_kuliah",
        "total_pengambil",
        "total_gagal",
        two_places(F.col("share")).alias("persen_gagal"),
        "ranking_matkul_kritis_angkatan",
    )


def popular_categories(fact_rekap_pinjam: DataFrame, dim_kategori_buku: DataFrame) -> DataFrame:
    """Loans and titles per book category, ranked with gaps; category ids are SMALLINT, so few values are ranked."""
    # Computed once: the ranked side needs no titles and would otherwise be planned as another aggregate.
    per_category = settled(
        fact_rekap_pinjam.groupBy("kategori_id")
        .agg(F.sum("total_peminjaman").alias("loans"), F.sum("jumlah_buku").alias("titles"))
        .join(dim_kategori_buku.select("kategori_id", "nama_kategori"), "kategori_id")
        .groupBy("nama_kategori")
        .agg(F.sum("loans").alias("frekuensi_peminjaman"), F.sum("titles").alias("total_judul_buku_unik_dipinjam"))
    )
    return rank.competition_rank(per_category, "frekuensi_peminjaman", "peringkat_popularitas").select(
        "nama_kategori", "frekuensi_peminjaman", "total_judul_buku_unik_dipinjam", "peringkat_popularitas"
    )


def loan_trend(fact_rekap_pinjam: DataFrame, dim_waktu: DataFrame) -> DataFrame:
    """Loans and fines per semester, academic year and overall, in report order."""
    per_semester = fact_rekap_pinjam.groupBy("waktu_id").agg(
        F.sum("total_peminjaman").alias("loans"), F.sum("jumlah_denda").alias("fines")
    )
    named = per_semester.join(dim_waktu, "waktu_id").select(*_TERM, "loans", "fines")
    sums = {"total_transaksi_pinjam": F.sum("loans"), "total_denda_rp": F.sum("fines")}
    return (
        grouping_sets(named, _TERM, rollup_sets(_TERM), sums)
        .orderBy(F.asc_nulls_last("tahun_akademik"), F.desc_nulls_first("semester"))
        .select(
            label("tahun_akademik", LOANS_ALL_YEARS).alias("tahun_akademik"),
            label("semester", LOANS_ALL_SEMESTERS).alias("semester"),
            "total_transaksi_pinjam",
            "total_denda_rp",
        )
    )


def _gpa_by_lending(
    fact_rekap_ip: DataFrame,
    fact_rekap_pinjam: DataFrame,
    measure: str,
    classify,
    names: tuple[str, str],
    total: str,
) -> DataFrame:
    """Mean GPA of student-semesters grouped by what they did at the library, with a total row."""
    name, samples = names
    pair = ["mahasiswa_id", "waktu_id"]
    lending = fact_rekap_pinjam.groupBy(*pair).agg(F.sum(measure).alias("lending"))
    groups = (
        fact_rekap_ip.select(*pair, "ip_semester")
        .join(lending, pair, "left")
        .groupBy(classify(F.coalesce(F.col("lending"), F.lit(0))).alias(name))
        .agg(
            F.count("mahasiswa_id").alias("samples"),
            F.sum(_gpa()).alias("gpa"),
            F.count("ip_semester").alias("graded"),
        )
    )
    sums = {"samples": F.sum("samples"), "gpa": F.sum("gpa"), "graded": F.sum("graded")}
    return (
        grouping_sets(groups, [name], [(name,), ()], sums)
        .orderBy(F.asc_nulls_last(name))
        .select(
            label(name, total).alias(name),
            F.coalesce("samples", F.lit(0)).alias(samples),
            two_places(half_up(F.col("gpa"), F.nullif(F.col("graded"), F.lit(0)))).alias("rata_rata_ip_semester"),
        )
    )


def gpa_by_borrowing(fact_rekap_ip: DataFrame, fact_rekap_pinjam: DataFrame) -> DataFrame:
    return _gpa_by_lending(
        fact_rekap_ip,
        fact_rekap_pinjam,
        "total_peminjaman",
        decode.borrowing_tier,
        ("klasifikasi_peminjam", "total_sampel_semester"),
        ALL_TIERS,
    )


def gpa_by_fines(fact_rekap_ip: DataFrame, fact_rekap_pinjam: DataFrame) -> DataFrame:
    return _gpa_by_lending(
        fact_rekap_ip,
        fact_rekap_pinjam,
        "jumlah_denda",
        decode.fine_status,
        ("status_kedisiplinan_perpus", "total_sampel"),
        ALL_FINE_STATUS,
    )


def gpa_distribution(fact_rekap_ip: DataFrame) -> DataFrame:
    """Student-semesters per GPA band with their share, best band first."""
    bands = fact_rekap_ip.groupBy(decode.gpa_band(_gpa()).alias("kategori_ip")).agg(
        F.count(F.lit(1)).alias("jumlah_mahasiswa"), F.min("ip_semester").alias("lowest")
    )
    # Five bands at most, so one task may hold them all.
    total = F.sum("jumlah_mahasiswa").over(Window.partitionBy())
    return (
        bands.withColumn("persentase", two_places(percent(F.col("jumlah_mahasiswa"), total)))
        .orderBy(F.desc_nulls_first("lowest"))
        .select("kategori_ip", "jumlah_mahasiswa", "persentase")
    )


def favourite_categories_of_top_students(
    fact_rekap_pinjam: DataFrame, fact_rekap_ip: DataFrame, dim_kategori_buku: DataFrame
) -> DataFrame:
    """Loans per category in semesters with a high GPA, densely ranked; few categories are ranked."""
    pair = ["mahasiswa_id", "waktu_id"]
    top = fact_rekap_ip.filter(F.col("ip_semester") >= F.lit(HIGH_GPA / 100).cast("decimal(3,2)")).select(*pair)
    per_category = (
        fact_rekap_pinjam.select(*pair, "kategori_id", "total_peminjaman")
        .join(top, pair)
        .groupBy("kategori_id")
        .agg(F.sum("total_peminjaman").alias("loans"))
        .join(dim_kategori_buku.select("kategori_id", "nama_kategori"), "kategori_id")
        .groupBy("nama_kategori")
        .agg(F.sum("loans").alias("total_peminjaman"))
    )
    return rank.dense_rank(per_category, "total_peminjaman", "peringkat_buku_berprestasi").select(
        "nama_kategori", "total_peminjaman", "peringkat_buku_berprestasi"
    )


# A student's mean GPA is kept with this many decimal places before the mean of means is taken.
_MEAN_SCALE = 10**14


def gender_comparison(
    dim_mahasiswa: DataFrame, fact_rekap_ip: DataFrame, fact_rekap_pinjam: DataFrame
) -> DataFrame:
    """Students, mean of their mean GPA, loans and fines per gender and overall.

    The mean of means is summed as a scaled integer, so the order of additions cannot change it.
    """
    means = fact_rekap_ip.groupBy("mahasiswa_id").agg(
        half_up(
            F.sum(_gpa()).cast("decimal(24,0)") * F.lit(_MEAN_SCALE).cast("decimal(15,0)"),
            F.nullif(F.count("ip_semester"), F.lit(0)).cast("decimal(19,0)"),
        ).alias("mean")
    )
    lending = fact_rekap_pinjam.groupBy("mahasiswa_id").agg(
        F.sum("total_peminjaman").alias("loans"), F.sum("jumlah_denda").alias("fines")
    )
    groups = (
        dim_mahasiswa.select("mahasiswa_id", "jenis_kelamin")
        .join(means, "mahasiswa_id", "left")
        .join(lending, "mahasiswa_id", "left")
        .groupBy("jenis_kelamin")
        .agg(
            F.count("mahasiswa_id").alias("students"),
            F.sum(F.col("mean").cast("decimal(20,0)")).alias("mean"),
            F.count("mean").alias("with_mean"),
            F.sum("loans").alias("loans"),
            F.sum("fines").alias("fines"),
        )
    )
    sums = {
        "total_mahasiswa": F.coalesce(F.sum("students"), F.lit(0)),
        "mean": F.sum("mean"),
        "with_mean": F.sum("with_mean"),
        "total_buku_dipinjam": F.coalesce(F.sum("loans"), F.lit(0)),
        "total_akumulasi_denda_rp": F.coalesce(F.sum("fines"), F.lit(0)),
    }
    return (
        grouping_sets(groups, ["jenis_kelamin"], [("jenis_kelamin",), ()], sums)
        .orderBy(F.asc_nulls_last("jenis_kelamin"))
        .select(
            label("jenis_kelamin", ALL_GENDERS).alias("jenis_kelamin"),
            "total_mahasiswa",
            two_places(
                half_up(
                    F.col("mean"),
                    F.nullif(F.col("with_mean"), F.lit(0)).cast("decimal(19,0)") * F.lit(_MEAN_SCALE).cast("decimal(15,0)"),
                )
            ).alias("rata_rata_ipk"),
            "total_buku_dipinjam",
            "total_akumulasi_denda_rp",
        )
    )


def top_courses(failures: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most critical courses."""
    return failures.orderBy("peringkat_kritis", "kode_mata_kuliah").limit(n)


def top_courses_by_intake(critical: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` rows by intake year and rank."""
    return critical.orderBy("angkatan", "ranking_matkul_kritis_angkatan").limit(n)
