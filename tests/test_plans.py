"""Edge rows of the jobs, marts and reports."""

from __future__ import annotations

import re
from datetime import datetime

import pytest
from pyspark.errors import ArithmeticException
from pyspark.sql import functions as F

from semesta import queries
from semesta.functions import decode
from semesta.functions.rounding import half_up, percent
from semesta.functions.semester import academic_year, first_day, last_day, semester_name
from semesta.operators import heavy
from semesta.plans import audit, dims, facts, incremental, library, marts, quality
from semesta.schemas import LIBRARY, SOURCES, TABLES, Table
from semesta.sources import testbed
from tests.conftest import d, dec, in_order, rows


@pytest.fixture(scope="module")
def star(campus):
    """Dimensions with natural keys and the facts of the small campus."""
    s = {
        "dim_waktu": dims.natural_ids("dim_waktu", dims.semesters(campus["hasil_studi"])),
        "dim_mahasiswa": dims.natural_ids("dim_mahasiswa", dims.students(campus["mahasiswa"])),
        "dim_mata_kuliah": dims.natural_ids("dim_mata_kuliah", dims.courses(campus["mata_kuliah"])),
        "dim_program_studi": dims.study_programmes(campus["program_studi"]),
        "dim_kategori_buku": dims.categories(campus["kategori_buku"]),
    }
    s["grades"] = _grades(campus, s)
    s["gpa"] = facts.gpa_recap(s["grades"], s["dim_mahasiswa"], s["dim_mata_kuliah"], campus["mahasiswa"])
    s["loans"] = _loans(campus, s)
    return s


def _grades(campus, star, **changes):
    c = {**campus, **changes}
    return facts.grade_lines(
        c["detail_nilai"], c["hasil_studi"], star["dim_waktu"], star["dim_mahasiswa"], star["dim_mata_kuliah"]
    )


def _loans(campus, star, **changes):
    c = {**campus, **changes}
    return facts.loan_recap(
        c["peminjaman"], c["detail_peminjaman"], c["denda"], c["buku"], c["anggota"], star["dim_mahasiswa"], star["dim_waktu"]
    )


def _gpa_rows(spark, *values):
    """GPA facts: (semester, student, GPA), then the programme where it is not 1."""
    data = [(w, p[0] if p else 1, m, None if g is None else dec(g), 3, 1) for w, m, g, *p in values]
    return spark.createDataFrame(
        data, "waktu_id STRING, program_studi_id INT, mahasiswa_id STRING, ip_semester DECIMAL(3,2), total_sks INT, jumlah_mata_kuliah INT"
    )


def _loan_rows(spark, *values):
    """Loan facts: (semester, student, category, loans, fine)."""
    data = [(w, m, k, n, f, 1) for w, m, k, n, f in values]
    return spark.createDataFrame(
        data, "waktu_id STRING, mahasiswa_id STRING, kategori_id INT, total_peminjaman INT, jumlah_denda INT, jumlah_buku INT"
    )


# Column functions


def test_semester_borders(spark):
    days = ["2021-06-30", "2021-07-01", "2021-12-31", "2022-01-01"]
    df = spark.createDataFrame([(d(x),) for x in days], "t DATE")
    named = df.select("t", academic_year(F.col("t")).alias("y"), semester_name(F.col("t")).alias("s"))
    assert in_order(named, "y", "s") == [
        ("2020/2021", "Genap"),
        ("2021/2022", "Ganjil"),
        ("2021/2022", "Ganjil"),
        ("2021/2022", "Genap"),
    ]
    inside = named.filter(F.col("t").between(first_day(F.col("y"), F.col("s")), last_day(F.col("y"), F.col("s"))))
    assert inside.count() == 4


def test_gender_decodes_differ_on_unknown_codes(spark):
    df = spark.createDataFrame([("L",), ("P",), ("X",), (None,)], "g STRING")
    both = df.select(decode.gender_full_load(F.col("g")), decode.gender_incremental(F.col("g")))
    assert in_order(both) == [
        ("Laki-laki", "Laki-laki"),
        ("Perempuan", "Perempuan"),
        ("X", "Perempuan"),
        (None, "Perempuan"),
    ]


def test_rounding_is_half_up_and_exact(spark):
    df = spark.createDataFrame([(2345, 10), (23449, 100), (1, 2), (0, 3), (None, 3)], "s BIGINT, n BIGINT")
    assert [r[0] for r in in_order(df.select(half_up(F.col("s"), F.col("n"))))] == [235, 234, 1, 0, None]
    third = spark.createDataFrame([(1, 3), (1, 8), (2, 3)], "p BIGINT, w BIGINT")
    assert [r[0] for r in in_order(third.select(percent(F.col("p"), F.col("w"))))] == [3333, 1250, 6667]


# Facts


def test_grade_lines(star):
    assert rows(star["grades"]) == rows_of(
        ("2020/2021 Ganjil", "S1", "C1", dec("3.00"), True, dec("9.00")),
        ("2020/2021 Ganjil", "S1", "C2", dec("4.00"), True, dec("8.00")),
        ("2020/2021 Ganjil", "S2", "C1", dec("1.00"), False, dec("3.00")),
        ("2020/2021 Genap", "S1", "C2", dec("3.50"), True, dec("7.00")),
        ("2020/2021 Genap", "S3", "C1", None, False, None),
        ("2020/2021 Genap", "S3", "C2", dec("4.00"), True, dec("8.00")),
    )


def rows_of(*values):
    return sorted(values, key=repr)


def test_missing_grade_keeps_its_credits(star):
    """S3: one course without a grade, so 8 points over 5 credits."""
    gpa = {(r["waktu_id"], r["mahasiswa_id"]): (r["ip_semester"], r["total_sks"]) for r in star["gpa"].collect()}
    assert gpa[("2020/2021 Genap", "S3")] == (dec("1.60"), 5)
    assert gpa[("2020/2021 Ganjil", "S1")] == (dec("3.40"), 5)


def test_gpa_without_any_grade_is_null(campus, star, table):
    lines = _grades(campus, star, detail_nilai=table("detail_nilai", (1, "K1", "C1", None, None, None)))
    gpa = facts.gpa_recap(lines, star["dim_mahasiswa"], star["dim_mata_kuliah"], campus["mahasiswa"])
    assert rows(gpa, "ip_semester", "total_sks") == [(None, 3)]


def test_grade_overflow_fails(campus, star, table):
    lines = _grades(campus, star, detail_nilai=table("detail_nilai", (1, "K1", "C1", dec("10.00"), "A", "Lulus")))
    with pytest.raises(ArithmeticException):
        lines.collect()


def test_fine_counts_once_per_line_and_loan_once_per_category(star):
    """A fine of 7,000 on a loan with one book in one category and two in another."""
    loan = star["loans"].filter("waktu_id = '2020/2021 Ganjil'")
    assert rows(loan, "kategori_id", "total_peminjaman", "jumlah_denda", "jumlah_buku") == [
        (1, 1, 7000, 1),
        (2, 1, 14000, 2),
    ]


def test_loan_in_a_semester_without_transcripts_vanishes(star):
    assert star["loans"].filter("mahasiswa_id = 'S2'").select("waktu_id").collect() == [("2020/2021 Genap",)]


def test_loan_fact_keeps_a_hot_member_whole(spark, campus, star):
    """A member with a third of all loans, one loan with a third of all lines: nothing is lost."""
    hot = spark.range(300).select(
        (F.col("id") + 100).alias("peminjaman_id"),
        F.when(F.col("id") < 100, "A1").when(F.col("id") % 2 == 0, "A2").otherwise("A3").alias("anggota_id"),
        F.lit(d("2020-10-01")).alias("tgl_pinjam"),
    )
    lines = spark.range(900).select(
        F.when(F.col("id") < 300, F.lit(100)).otherwise(F.col("id") % 300 + 100).alias("peminjaman_id"),
        F.format_string("B%d", F.col("id") % 4 + 1).alias("buku_id"),
    )
    fines = hot.select("peminjaman_id", F.lit(1000).alias("total_denda"))
    recap = _loans(campus, star, peminjaman=hot, detail_peminjaman=lines, denda=fines)
    naive = (
        lines.join(hot, "peminjaman_id").join(campus["buku"], "buku_id").join(fines, "peminjaman_id")
        .groupBy("anggota_id", "kategori_id")
        .agg(F.countDistinct("peminjaman_id"), F.sum("total_denda"), F.countDistinct("buku_id"))
    )
    member = {"A1": "S1", "A2": "S2", "A3": "S3"}
    expected = [(member[a], k, n, f, b) for a, k, n, f, b in (tuple(r) for r in naive.collect())]
    assert rows(recap.drop("waktu_id")) == rows_of(*expected)


def test_hot_loan_is_split_over_tasks(spark, campus, star):
    """A loan with a third of all lines, each of another book: the join that meets it is split at run time."""
    loans = spark.range(1000).select(
        F.col("id").alias("peminjaman_id"), F.lit("A1").alias("anggota_id"), F.lit(d("2020-10-01")).alias("tgl_pinjam")
    )
    lines = spark.range(0, 60000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).alias("peminjaman_id"),
        F.format_string("B%d", F.col("id")).alias("buku_id"),
    )
    titles = lines.select("buku_id", F.lit(1).cast("smallint").alias("kategori_id")).distinct()
    fines = loans.select("peminjaman_id", F.lit(10).alias("total_denda"))
    settings = {
        # As without this library's session: no extra shuffle is made for the sake of a split.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        recap = _loans(campus, star, peminjaman=loans, detail_peminjaman=lines, denda=fines, buku=titles)
        assert [tuple(r)[3:] for r in recap.collect()] == [(1000, 600000, titles.count())]
        plan = recap._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert re.search(r"SortMergeJoin\(skew=true\) \[peminjaman_id#\d+L?\], \[peminjaman_id#", plan)


def test_loan_lines_are_joined_once(campus, star):
    """One scan of the lines, one join with their books and one with their loans."""
    lines = campus["detail_peminjaman"].select("*")
    plan = _loans(campus, star, detail_peminjaman=lines)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Join Inner, \(buku_id#\d+ = buku_id#\d+\)", plan)) == 1
    assert len(re.findall(r"Join Inner, \(peminjaman_id#\d+L? = peminjaman_id#\d+L?\)", plan)) == 1


def test_key_rules_read_each_table_once_and_shuffle_once(spark, campus, tmp_path):
    """All unique keys, and all references, of all tables: one scan per table, one exchange of keys."""
    stored = {}
    for name, df in campus.items():
        df.write.parquet(f"{tmp_path}/{name}")
        stored[name] = spark.read.parquet(f"{tmp_path}/{name}")
    specs = [TABLES[name] for name in campus]
    for report, names in (
        (quality.unique_keys(stored, specs), set(campus)),
        (quality.referential(stored, specs), {s.name for s in specs if s.references} | {fk.parent for s in specs for fk in s.references}),
    ):
        report.collect()
        plan = report._jdf.queryExecution().sparkPlan().toString()
        assert len(re.findall(r"FileScan parquet", plan)) == len(names)
        executed = report._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[1]
        # By (rule, key), and then by rule.
        assert len(re.findall(r"Exchange hashpartitioning", executed)) == 2


def test_composite_keys_do_not_run_together(spark):
    spec = Table("t", "a STRING; b STRING", key=("a", "b"))
    data = spark.createDataFrame([("1:x", "y"), ("1", "x1:y"), ("x", None), ("x", None), ("q", "r"), ("q", "r")], "a STRING, b STRING")
    assert rows(quality.unique_keys({"t": data}, [spec])) == [("t", "a, b unique", 1)]


def test_rules_of_empty_tables_are_reported(campus):
    specs = [TABLES[name] for name in campus]
    empty = {name: df.limit(0) for name, df in campus.items()}
    for report in (quality.unique_keys, quality.referential, quality.not_null, quality.lengths):
        result = report(empty, specs).collect()
        assert result and all(r["pelanggaran"] == 0 for r in result)


# Incremental load


def _watermark(spark, table, *terms):
    dim = dims.natural_ids("dim_waktu", spark.createDataFrame(list(terms), "tahun_akademik STRING, semester STRING"))
    return dim, incremental.latest_semester(dim, dim.select("waktu_id")).first()


def test_watermark_of_an_empty_fact(spark, table, star):
    empty = star["grades"].limit(0)
    assert rows(incremental.latest_semester(star["dim_waktu"], empty)) == [("0/0", "Ganjil")]
    assert incremental.later_semesters(star["dim_waktu"], "0/0", "Ganjil").count() == 2


def test_semesters_after_the_watermark(spark, table):
    dim, mark = _watermark(spark, table, ("2020/2021", "Ganjil"), ("2020/2021", "Genap"), ("2019/2020", "Genap"))
    assert tuple(mark) == ("2020/2021", "Genap")
    assert rows(incremental.later_semesters(dim, "2020/2021", "Ganjil"), "semester") == [("Genap",)]
    assert incremental.later_semesters(dim, *mark).count() == 0


def test_unusual_semester_name_blocks_its_year(spark, table):
    """It has no order: never later within its year, and as the newest row it sorts first."""
    dim, mark = _watermark(spark, table, ("2020/2021", "Ganjil"), ("2020/2021", "Pendek"), ("2020/2021", "Genap"))
    assert tuple(mark) == ("2020/2021", "Pendek")
    assert incremental.later_semesters(dim, *mark).count() == 0
    assert rows(incremental.later_semesters(dim, "2020/2021", "Ganjil"), "semester") == [("Genap",)]
    assert incremental.later_semesters(dim, "2019/2020", "Genap").count() == 3


def _log(table, *runs):
    return table("log_proses_etl", *((i, p, datetime.fromisoformat(t), None, None, s, None) for i, (p, t, s) in enumerate(runs)))


def test_checkpoint_is_per_process_and_success_only(table):
    first = _log(table, ("full", "2024-01-01", "SUCCESS"))
    assert rows(incremental.last_success(first, "loans")) == [(datetime(1970, 1, 1),)]
    later = _log(
        table,
        ("loans", "2024-01-02", "SUCCESS"),
        ("loans", "2024-01-03", "SUCCESS"),
        ("loans", "2024-01-04", "FAILED"),
        ("loans", "2024-01-05", "RUNNING"),
    )
    assert rows(incremental.last_success(later, "loans")) == [(datetime(2024, 1, 3),)]


def test_impacted_semesters(spark, table):
    """On the day counts; a backdated loan and an unpaid fine do not."""
    loans = table(
        "peminjaman",
        (1, "A1", d("2020-09-01"), d("2020-09-15"), None, "Dipinjam", "P"),  # backdated, fine unpaid
        (2, "A1", d("2021-02-01"), d("2021-02-15"), d("2022-01-05"), "Dikembalikan", "P"),  # returned on the day
        (3, "A1", d("2019-02-01"), d("2019-02-15"), d("2019-03-01"), "Dikembalikan", "P"),  # fine paid later
        (4, "A1", d("2022-01-05"), d("2022-01-15"), None, "Dipinjam", "P"),  # borrowed on the day
        (5, "A1", d("2018-09-05"), d("2018-09-15"), d("2018-09-16"), "Dikembalikan", "P"),
    )
    fines = table("denda", (1, 1, 1, 1000, "Belum Dibayar", None), (2, 3, 1, 1000, "Lunas", d("2022-02-01")))
    terms = [("2018/2019", "Ganjil"), ("2018/2019", "Genap"), ("2020/2021", "Ganjil"), ("2020/2021", "Genap"), ("2021/2022", "Genap")]
    dim = dims.natural_ids("dim_waktu", spark.createDataFrame(terms, "tahun_akademik STRING, semester STRING"))
    impacted = incremental.impacted_semesters(loans, fines, dim, d("2022-01-05"))
    assert rows(impacted, "waktu_id") == [("2018/2019 Genap",), ("2020/2021 Genap",), ("2021/2022 Genap",)]
    c = d("2022-01-05")
    naive = (
        facts.loan_semesters(loans)
        .join(fines, "peminjaman_id", "left")
        .filter((F.col("tgl_pinjam") >= c) | (F.col("tgl_kembali_aktual") >= c) | (F.col("tgl_bayar") >= c))
        .join(dim, ["tahun_akademik", "semester"])
        .select("waktu_id")
        .distinct()
    )
    assert rows(impacted, "waktu_id") == rows(naive)


def test_upsert_changes_name_and_gender_only(spark, table):
    existing = table(
        "dim_mahasiswa", (7, "S1", "Old", "Laki-laki", 2019), (8, "S9", "Gone", "Laki-laki", 2018)
    )
    source = table("mahasiswa", ("S1", 1, "New", "X", 2025, None), ("S2", 1, "Fresh", "L", 2024, None))
    assert rows(dims.upserted_students(source, existing)) == rows_of(
        (7, "S1", "New", "Perempuan", 2019), (8, "S9", "Gone", "Laki-laki", 2018), (None, "S2", "Fresh", "Laki-laki", 2024)
    )


def test_null_semester_is_filtered_only_by_the_full_load(table):
    sent = table("hasil_studi", ("K1", "S1", None, "Ganjil", None), ("K2", "S1", "2020/2021", "Ganjil", None))
    known = table("dim_waktu", (1, "2020/2021", "Ganjil"))
    assert rows(dims.semesters(sent)) == [("2020/2021", "Ganjil")]
    assert rows(dims.new_semesters(sent, known)) == [(None, "Ganjil")]


# Marts


def _courses(spark, *names):
    return spark.createDataFrame(
        [(n, n, title, 2, kind) for n, title, kind in names],
        "mata_kuliah_id STRING, kode_mata_kuliah STRING, nama_mata_kuliah STRING, bobot_sks INT, jenis_mata_kuliah STRING",
    )


def _outcomes(spark, *values):
    """Grade facts: (student, course, passed)."""
    return spark.createDataFrame(
        [("w", m, c, p) for m, c, p in values], "waktu_id STRING, mahasiswa_id STRING, mata_kuliah_id STRING, status_lulus BOOLEAN"
    )


def test_course_failures_dense_rank_and_rounding(spark):
    taken = [("s%d" % i, "C1", i > 0) for i in range(3)] + [("s%d" % i, "C2", i > 0) for i in range(3)]
    taken += [("s0", "C3", False), ("s0", "C4", True)]
    result = marts.course_failures(
        _outcomes(spark, *taken), _courses(spark, *((c, c, "Wajib") for c in ("C1", "C2", "C3", "C4")))
    )
    assert rows(result, "kode_mata_kuliah", "persentase_tidak_lulus", "peringkat_kritis") == [
        ("C1", 33.33, 2), ("C2", 33.33, 2), ("C3", 100.0, 1), ("C4", 0.0, 3),
    ]


def test_critical_courses_having_edge_merge_and_ties(spark):
    """Ten takers are out, eleven in; equal names merge; ties are numbered by name."""
    taken = [(f"s{i}", "C1", True) for i in range(10)]
    taken += [(f"s{i}", "C2", i > 0) for i in range(11)]
    taken += [(f"s{i}", "C3", i > 0) for i in range(6)] + [(f"s{i}", "C4", True) for i in range(6, 11)]
    courses = _courses(spark, ("C1", "Ten", "Wajib"), ("C2", "Eleven", "Wajib"), ("C3", "Both", "Wajib"), ("C4", "Both", "Wajib"))
    students = spark.createDataFrame([(f"s{i}", 2020) for i in range(11)], "mahasiswa_id STRING, angkatan INT")
    result = marts.critical_courses_by_intake(_outcomes(spark, *taken), students, courses)
    assert rows(result, "nama_mata_kuliah", "total_pengambil", "persen_gagal", "ranking_matkul_kritis_angkatan") == [
        ("Both", 11, 9.09, 1), ("Eleven", 11, 9.09, 2),
    ]


def test_gpa_trend_in_report_order(star):
    result = in_order(marts.gpa_trend(star["gpa"], star["dim_waktu"]))
    assert result == [
        ("2020/2021", "Semua Semester (Sub-Total)", 3, 2.38),
        ("2020/2021", "Genap", 2, 2.55),
        ("2020/2021", "Ganjil", 2, 2.2),
        ("Semua Tahun (Grand Total)", "Semua Semester (Sub-Total)", 3, 2.38),
    ]


def test_classes_are_ordered_by_their_mean(spark):
    """Best mean first, a missing one before all; the total after a class of the same mean."""
    gpa = _gpa_rows(spark, ("w1", "S1", "2.00", 1), ("w1", "S2", "4.00", 2), ("w1", "S3", "3.00", 3), ("w1", "S4", None, 4))
    programmes = spark.createDataFrame([(1, "A"), (2, "Z"), (3, "M"), (4, "B")], "program_studi_id INT, kelas STRING")
    assert in_order(marts.class_comparison(gpa, programmes)) == [
        ("B", 1, None), ("Z", 1, 4.0), ("M", 1, 3.0), ("Grand Total Keseluruhan", 4, 3.0), ("A", 1, 2.0),
    ]


def test_cohorts_in_report_order(star):
    """Intake years downwards, totals first; academic years upwards, totals last; semesters downwards, totals first."""
    result = in_order(marts.intake_cohorts(star["gpa"], star["dim_mahasiswa"], star["dim_waktu"]), "angkatan", "tahun_akademik", "semester")
    years = ["Semua Angkatan", "2021", "2020"]
    terms = [("2020/2021", "Semua Semester"), ("2020/2021", "Genap"), ("2020/2021", "Ganjil"),
             ("Semua Tahun", "Semua Semester"), ("Semua Tahun", "Genap"), ("Semua Tahun", "Ganjil")]
    assert result == [(y, *t) for y in years for t in terms if (y, *t) in result]
    assert result[0] == ("Semua Angkatan", "2020/2021", "Semua Semester") and len(result) == 16


def test_subtotals_are_told_from_null_groups(spark):
    gpa = _gpa_rows(spark, ("w1", "S1", "2.00"), ("w1", "S2", "4.00"))
    programmes = spark.createDataFrame([(1, None)], "program_studi_id INT, kelas STRING")
    assert rows(marts.class_comparison(gpa, programmes)) == rows_of(
        (None, 2, 3.0), ("Grand Total Keseluruhan", 2, 3.0)
    )


def test_mean_gpa_rounds_half_up_once(spark):
    programmes = spark.createDataFrame([(1, "Reguler")], "program_studi_id INT, kelas STRING")
    tie = _gpa_rows(spark, ("w1", "S1", "2.34"), ("w1", "S2", "2.35"))
    below = _gpa_rows(spark, *(("w%d" % i, "S1", "2.34") for i in range(501)), *(("v%d" % i, "S1", "2.35") for i in range(500)))
    assert rows(marts.class_comparison(tie, programmes), "rata_rata_ipk_keseluruhan") == [(2.35,), (2.35,)]
    assert rows(marts.class_comparison(below, programmes), "rata_rata_ipk_keseluruhan") == [(2.34,), (2.34,)]


def test_cohorts_cover_every_combination(star):
    result = marts.intake_cohorts(star["gpa"], star["dim_mahasiswa"], star["dim_waktu"])
    by_key = {tuple(r)[:3]: tuple(r)[3:] for r in result.collect()}
    assert by_key[("Semua Angkatan", "Semua Tahun", "Semua Semester")] == (3, 2.38, 4.0)
    assert by_key[("2020", "2020/2021", "Semua Semester")] == (2, 2.63, 3.0)
    assert len(by_key) == len(result.collect()) == 16


def test_category_rank_has_gaps_and_merges_names(spark):
    loans = _loan_rows(spark, ("w", "S1", 1, 5, 0), ("w", "S1", 2, 5, 0), ("w", "S1", 3, 1, 0), ("w", "S2", 4, 2, 0))
    names = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C"), (4, "C")], "kategori_id INT, nama_kategori STRING")
    assert rows(marts.popular_categories(loans, names), "nama_kategori", "frekuensi_peminjaman", "peringkat_popularitas") == [
        ("A", 5, 1), ("B", 5, 1), ("C", 3, 3),
    ]


def test_loan_trend_total_equals_detail(star):
    result = in_order(marts.loan_trend(star["loans"], star["dim_waktu"]))
    detail = [r for r in result if r[1] in ("Ganjil", "Genap")]
    assert result[-1] == ("Total Semua Waktu", "Sub-Total Tahun", sum(r[2] for r in detail), sum(r[3] for r in detail))
    assert result[0][:2] == ("2020/2021", "Sub-Total Tahun")


def test_borrowing_tiers_and_missing_gpa(spark):
    """0, 1, 5 and 6 loans; a missing GPA is counted but not averaged."""
    gpa = _gpa_rows(spark, ("w", "S0", "2.00"), ("w", "S1", "3.00"), ("w", "S5", None), ("w", "S6", "4.00"))
    loans = _loan_rows(spark, ("w", "S1", 1, 1, 0), ("w", "S5", 1, 2, 0), ("w", "S5", 2, 3, 100), ("w", "S6", 1, 6, 0), ("v", "S0", 1, 9, 0))
    assert rows(marts.gpa_by_borrowing(gpa, loans)) == [
        ("1 - Tidak Pernah Pinjam", 1, 2.0),
        ("2 - Jarang (1-5 Buku/Semester)", 2, 3.0),
        ("3 - Rajin (>5 Buku/Semester)", 1, 4.0),
        ("Grand Total Populasi", 4, 3.0),
    ]
    assert rows(marts.gpa_by_fines(gpa, loans)) == [
        ("Disiplin (Tanpa Denda)", 3, 3.0),
        ("Pernah Terlambat (Kena Denda)", 1, None),
        ("Rata-rata Keseluruhan Mahasiswa", 4, 3.0),
    ]


def test_gpa_bands(spark):
    values = ["3.51", "3.50", "3.01", "3.00", "2.51", "2.50", "2.00", "1.99", None]
    result = in_order(marts.gpa_distribution(_gpa_rows(spark, *(("w", f"S{i}", g) for i, g in enumerate(values)))))
    assert sorted(result) == [
        ("Cukup (2.00 - 2.50)", 2, 22.22),
        ("Cumlaude (3.51 - 4.00)", 1, 11.11),
        ("Kurang (< 2.00)", 2, 22.22),
        ("Memuaskan (2.51 - 3.00)", 2, 22.22),
        ("Sangat Memuaskan (3.01 - 3.50)", 2, 22.22),
    ]
    assert [r[0][:4] for r in result] == ["Cuml", "Sang", "Memu", "Cuku", "Kura"]


def test_favourites_need_a_gpa_of_three_and_a_half(spark):
    gpa = _gpa_rows(spark, ("w", "S1", "3.50"), ("w", "S2", "3.49"), ("v", "S2", "4.00"))
    loans = _loan_rows(spark, ("w", "S1", 1, 2, 0), ("w", "S2", 2, 9, 0), ("v", "S1", 2, 9, 0), ("v", "S2", 2, 2, 0))
    names = spark.createDataFrame([(1, "A"), (2, "B")], "kategori_id INT, nama_kategori STRING")
    assert rows(marts.favourite_categories_of_top_students(loans, gpa, names)) == [("A", 2, 1), ("B", 2, 1)]


def test_gender_comparison_averages_student_means(spark):
    students = spark.createDataFrame(
        [("S1", "Laki-laki"), ("S2", "Laki-laki"), ("S3", "Perempuan")], "mahasiswa_id STRING, jenis_kelamin STRING"
    )
    gpa = _gpa_rows(spark, ("a", "S1", "2.00"), ("b", "S1", "3.00"), ("c", "S1", "3.00"), ("a", "S2", "4.00"))
    loans = _loan_rows(spark, ("a", "S1", 1, 2, 500), ("b", "S1", 1, 3, 0))
    assert rows(marts.gender_comparison(students, gpa, loans)) == [
        ("Laki-laki", 2, 3.33, 5, 500), ("Perempuan", 1, None, 0, 0), ("Semua Demografi (Total)", 3, 3.33, 5, 500),
    ]


# Library views


def test_member_summary_multiplies_fines_by_visits(campus):
    result = library.member_summary(campus["anggota"], campus["peminjaman"], campus["kunjungan"], campus["denda"])
    assert rows(result.drop("nim", "nama_lengkap", "status_aktif")) == [
        ("A1", 2, 3, 21000, 21000), ("A2", 2, 0, 0, 0), ("A3", 0, 0, 0, 0),
    ]


def test_title_without_copies_stays(campus):
    result = library.title_stock(campus["buku"], campus["kategori_buku"], campus["eksemplar_buku"])
    assert rows(result, "buku_id", "total_eksemplar", "tersedia", "dipinjam") == [
        ("B1", 2, 1, 1), ("B2", 1, 1, 0), ("B3", 1, 0, 1), ("B4", 0, 0, 0),
    ]


# Data quality and run history


def test_valid_tables_pass_every_rule(campus):
    specs = list(SOURCES.values())
    reports = [quality.not_null, quality.domain_values, quality.ranges, quality.date_order, quality.unique_keys, quality.referential, quality.logical_references]
    for report in reports:
        assert report(campus, specs).filter("pelanggaran > 0").collect() == []


def _broken(report, tables):
    return {(r["tabel"], r["aturan"]): r["pelanggaran"] for r in report.collect() if r["pelanggaran"]}


def test_each_broken_rule_is_counted_once(campus, table):
    broken = {
        **campus,
        "eksemplar_buku": table("eksemplar_buku", ("E1", "B1", "Hilang", "Y"), ("E1", "B9", "Baik", None)),
        "anggota": table("anggota", ("A1", "S9", "x", "L", d("2020-01-01"), d("2020-01-01"), "Y")),
        "denda": table("denda", (1, 1, 0, 1000, "Lunas", None)),
    }
    specs = LIBRARY
    assert _broken(quality.not_null(broken, specs), broken) == {("eksemplar_buku", "tersedia not null"): 1}
    assert _broken(quality.domain_values(broken, specs), broken) == {("eksemplar_buku", "kondisi domain"): 1}
    assert _broken(quality.ranges(broken, specs), broken) == {("denda", "hari_keterlambatan range"): 1}
    assert _broken(quality.date_order(broken, specs), broken) == {("anggota", "tgl_expired order"): 1}
    assert _broken(quality.unique_keys(broken, specs), broken) == {("eksemplar_buku", "eksemplar_id unique"): 1}
    assert _broken(quality.logical_references(broken, specs), broken) == {("anggota", "nim in mahasiswa"): 1}
    orphans = _broken(quality.referential(broken, specs), broken)
    assert orphans[("eksemplar_buku", "buku_id in buku")] == 1


def test_defaults_fill_missing_values(table):
    raw = table("eksemplar_buku", ("E1", "B1", None, None), ("E2", "B1", "Rusak Ringan", "N"))
    assert rows(quality.apply_defaults(raw, TABLES["eksemplar_buku"])) == [
        ("E1", "B1", "Baik", "Y"), ("E2", "B1", "Rusak Ringan", "N"),
    ]


def test_run_log_keeps_failed_and_running_steps(spark):
    t = datetime(2024, 1, 1, 1)
    events = spark.createDataFrame(
        [
            (1, "a", t, "RUNNING", None),
            (1, "a", t.replace(second=9), "SUCCESS", "ok"),
            (2, "b", t.replace(minute=1), "RUNNING", None),
            (2, "b", t.replace(minute=1), "FAILED", "boom"),
            (3, "c", t.replace(minute=2), "RUNNING", None),
        ],
        audit.EVENTS_DDL,
    )
    shown = in_order(audit.monitor(audit.run_log(events)), "log_id", "total_durasi", "status", "pesan_error")
    assert shown == [(3, None, "RUNNING", None), (2, "0 detik", "FAILED", "boom"), (1, "9 detik", "SUCCESS", "ok")]


def test_grades_of_a_loaded_warehouse_are_derived_once(spark, campus):
    stored, derived = (star(campus)["fact_detail_nilai"] for star in (queries.Loaded, queries.Star))
    assert rows(stored) == rows(derived)
    assert "Join" in derived._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in stored._jdf.queryExecution().optimizedPlan().toString()


def _raw_folder(spark, folder, **given):
    """The driver's tables as files: the rows given, no others."""
    for name, ddl in testbed.RAW.items():
        spark.createDataFrame(given.get(name, []), ddl).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_flawed_copies_are_grouped_once(spark, tmp_path):
    """A copy's state and condition come from one aggregate; only lines without a number meet again by the copy's text."""
    # Order, part, supplier, line number, quantity, return flag, line state.
    copies = [(11, 7, "R", "O"), (11, 7, "A", "F"), (11, 8, "N", "O"), (None, 9, "R", "O"), (9, None, "A", "F"), (None, None, "N", "O"), (None, 9, "A", "F")]
    lines = [(1, part, supplier, 1, 2.0, flag, state) for part, supplier, flag, state in copies]
    folder = _raw_folder(spark, tmp_path, lineitem=lines)
    got = testbed.flawed_tables(spark, folder)["eksemplar_buku"]

    raw = spark.read.schema(testbed.RAW["lineitem"]).parquet(f"{folder}/lineitem.parquet")
    clean, worst = testbed.eksemplar_buku(raw), F.max("l_returnflag")
    condition = F.when(worst == "R", "Baik").when(worst == "A", "Sobek").alias("kondisi")
    conditions = raw.groupBy("l_partkey", "l_suppkey").agg(condition).select(testbed._copy().alias("eksemplar_id"), "kondisi")
    joined = clean.drop("kondisi").join(conditions, "eksemplar_id")
    expected = rows(testbed.broken(joined, SOURCES["eksemplar_buku"], "eksemplar_buku"))
    assert rows(got) == expected and len(expected) >= 7

    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 1
    # Both sides of that join read only lines without a number; before, they read all.
    assert len(re.findall(r"Filter.*isnull\(l_partkey", plan)) == 2


def test_flawed_facts_share_the_shuffles_of_their_sources(spark, tmp_path):
    """The repeated grades and the clean ones shuffle lines by order, and transcripts with their ids, once."""
    day = datetime(1999, 10, 1)
    folder = _raw_folder(
        spark,
        tmp_path,
        nation=[(0, "N", 0)],
        customer=[(i, f"c{i}", 0, 1.0, "BUILDING") for i in range(4)],
        part=[(i, f"p{i}", "b", "t", 1) for i in range(3)],
        orders=[(i, i % 4, "F", day, "1-URGENT") for i in range(8)],
        lineitem=[(i % 8, i % 3, 1, 1, 30.0, "N", "F") for i in range(24)],
    )
    facts_of = [TABLES["fact_detail_nilai"], TABLES["fact_rekap_ip"]]
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        report = quality.unique_keys(queries.Campus(spark, folder).flawed, facts_of)
        assert report.count() == 2 and len(report.collect()) == 2
        plan = report._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    reused = [line for line in plan.splitlines() if "ReusedExchange" in line]
    assert any("l_orderkey" in line and "l_partkey" in line for line in reused), plan
    assert any("khs_id" in line and "mahasiswa_id" in line for line in reused), plan


def test_loan_lines_are_dealt_out_once(spark, campus, star):
    """After the join with their loans, lines travel once, by member; the counts of a group need no other exchange."""
    kept = {key: spark.conf.get(key) for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _loans(campus, star)._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in kept.items():
            spark.conf.set(key, value)
    dealt = re.findall(r"Exchange hashpartitioning\(([^)]*), 2\)", plan)
    assert sum("anggota_id" in keys for keys in dealt) == 2  # the lines, and the members they meet
    assert not any("title" in keys or "kategori_id" in keys for keys in dealt)


def test_crowded_members_are_counted_in_slots(spark, campus, star, monkeypatch):
    """A member with many loans and one with a long loan: the same counts, whatever the number of slots."""
    loans = spark.range(60).select(
        F.col("id").alias("peminjaman_id"),
        F.when(F.col("id") < 40, "A1").when(F.col("id") == 59, "A2").otherwise("A3").alias("anggota_id"),
        F.lit(d("2020-10-01")).alias("tgl_pinjam"),
    )
    lines = spark.range(600).select(
        F.when(F.col("id") < 300, F.lit(59)).otherwise(F.col("id") % 60).alias("peminjaman_id"),
        F.format_string("B%d", F.col("id") % 4 + 1).alias("buku_id"),
    )
    fines = loans.select("peminjaman_id", F.lit(1000).alias("total_denda"))
    given = {"peminjaman": loans, "detail_peminjaman": lines, "denda": fines}
    expected = rows(_loans(campus, star, **given))
    assert len(expected) == 6
    monkeypatch.setattr(facts, "CROWD", 25)
    crowds = facts._crowds(loans, lines)
    assert rows(crowds) == [("A1", 2), ("A2", 13)]
    recap = _loans(campus, star, **given)
    assert rows(recap) == expected
    assert "xxhash64" in recap._jdf.queryExecution().optimizedPlan().toString()


def test_heavy_keys_are_exact(spark, monkeypatch):
    data = spark.createDataFrame([("a",)] * 5 + [("b",)] * 4 + [("c",)] + [(None,)] * 9, "k STRING")
    assert rows(heavy.heavy_keys(data, "k", 3)) == [("a", 5), ("b", 4)]
    assert rows(heavy.heavy_keys(data, "k", 4)) == [("a", 5)]
    assert heavy.heavy_keys(data, "k", 9) is None
    # Keys that share a bucket are told apart.
    monkeypatch.setattr(heavy, "BUCKETS", 1)
    assert rows(heavy.heavy_keys(data, "k", 3)) == [("a", 5), ("b", 4)]
    assert rows(heavy.heavy_keys(data, "k", 7)) == []


def test_number_keys_are_compared_as_numbers(spark, table):
    """References between whole numbers need no text; where one side is text, both are."""
    fact = table("fact_rekap_ip", (1, 7, 5, dec("3.00"), 3, 1), (1, 8, None, None, None, None))
    parents = {"dim_waktu": table("dim_waktu", (1, "2020/2021", "Ganjil")), "dim_program_studi": table("dim_program_studi", (7, "S1", "x", "y"))}
    references = [fk for fk in TABLES["fact_rekap_ip"].references if fk.parent in parents]
    report = quality.orphans([(fact, "fact_rekap_ip", fk) for fk in references], parents)
    assert sorted(r["pelanggaran"] for r in report.collect()) == [0, 1]
    assert " as string)" not in report._jdf.queryExecution().optimizedPlan().toString()
    texts = {"dim_waktu": parents["dim_waktu"].withColumn("waktu_id", F.col("waktu_id").cast("string")), "dim_program_studi": parents["dim_program_studi"]}
    mixed = quality.orphans([(fact, "fact_rekap_ip", fk) for fk in references], texts)
    assert rows(mixed) == rows(report)


def test_referential_report_derives_one_fact_after_the_other(spark, tmp_path, monkeypatch):
    """The facts' keys are there when the keys of all tables are counted, so their shuffles are not on disk together."""
    day = datetime(1999, 10, 1)
    folder = _raw_folder(
        spark,
        tmp_path,
        nation=[(0, "N", 0)],
        customer=[(i, f"c{i}", 0, 1.0, "BUILDING") for i in range(4)],
        part=[(i, f"p{i}", "b", "t", 1) for i in range(3)],
        orders=[(i, i % 4, "F", day, "1-URGENT") for i in range(8)],
        lineitem=[(i % 8, i % 3, 1, 1, 30.0, "N", "F") for i in range(24)],
    )
    expected = rows(quality.referential(queries.Campus(spark, folder).flawed, queries._ALL))
    given = {}
    whole = quality.referential
    monkeypatch.setattr(quality, "referential", lambda tables, specs: given.update(tables=tables) or whole(tables, specs))
    assert rows(queries.PLANS["dq_referential"](queries.Campus(spark, folder))) == expected
    for spec in queries.FACTS:
        assert "Join" not in given["tables"][spec.name]._jdf.queryExecution().optimizedPlan().toString()
