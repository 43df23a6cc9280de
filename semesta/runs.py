"""Full and incremental load: audited steps in dependency order.

The plans are pure; only these functions write. A failing step records FAILED, publishes nothing and
stops the steps after it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from semesta.operators import merge
from semesta.operators.keys import assign_keys, extend_keys, last_key
from semesta.operators.settled import settled
from semesta.plans import audit, dims, facts, incremental, library, marts
from semesta.session import temporary
from semesta.sources.tables import lines_in
from semesta.warehouse import Warehouse, one_row, read_if_present

# Process names and messages of the run history, and its time zone.
INITIAL = "Initial Load Data Warehouse"
SHARED_DIMENSIONS = "Load Shared Dimensions"
LIBRARY_DIMENSION = "Load Data Perpustakaan Dimensi"
LOAN_FACTS = "Build Cross Domain Facts (Daily)"
ACADEMIC = "Load Data Akademik DW"
DASHBOARD = "Refresh Semua Dashboard DW"
INITIAL_DONE = "Initial load berhasil. Total durasi: {seconds} detik"
DASHBOARD_DONE = "Seluruh Materialized Views berhasil diperbarui dengan sukses."
ZONE = ZoneInfo("Asia/Jakarta")

Sources = dict[str, DataFrame]

STORED_MARTS: dict[str, Callable[[dict[str, DataFrame]], DataFrame]] = {
    "tingkat_ketidaklulusan": lambda t: marts.course_failures(t["fact_detail_nilai"], t["dim_mata_kuliah"]),
    "perbandingan_kelas": lambda t: marts.class_comparison(t["fact_rekap_ip"], t["dim_program_studi"]),
    "kategori_buku_populer": lambda t: marts.popular_categories(t["fact_rekap_pinjam"], t["dim_kategori_buku"]),
    "korelasi_rajin_pinjam_ip": lambda t: marts.gpa_by_borrowing(t["fact_rekap_ip"], t["fact_rekap_pinjam"]),
    "korelasi_denda_ip": lambda t: marts.gpa_by_fines(t["fact_rekap_ip"], t["fact_rekap_pinjam"]),
    "buku_favorit_berprestasi": lambda t: marts.favourite_categories_of_top_students(
        t["fact_rekap_pinjam"], t["fact_rekap_ip"], t["dim_kategori_buku"]
    ),
    "gender_akademik_perpus": lambda t: marts.gender_comparison(
        t["dim_mahasiswa"], t["fact_rekap_ip"], t["fact_rekap_pinjam"]
    ),
    "cohort_angkatan": lambda t: marts.intake_cohorts(t["fact_rekap_ip"], t["dim_mahasiswa"], t["dim_waktu"]),
    "matkul_kritis_angkatan": lambda t: marts.critical_courses_by_intake(
        t["fact_detail_nilai"], t["dim_mahasiswa"], t["dim_mata_kuliah"]
    ),
}

LIVE_VIEWS: dict[str, Callable[[dict[str, DataFrame]], DataFrame]] = {
    "tren_performa_akademik": lambda t: marts.gpa_trend(t["fact_rekap_ip"], t["dim_waktu"]),
    "tren_peminjaman_semester": lambda t: marts.loan_trend(t["fact_rekap_pinjam"], t["dim_waktu"]),
    "distribusi_ip": lambda t: marts.gpa_distribution(t["fact_rekap_ip"]),
}


LIBRARY_VIEWS: dict[str, Callable[[Sources], DataFrame]] = {
    "ringkasan_anggota": lambda s: library.member_summary(s["anggota"], s["peminjaman"], s["kunjungan"], s["denda"]),
    "stok_buku": lambda s: library.title_stock(s["buku"], s["kategori_buku"], s["eksemplar_buku"]),
}


class RunLog:
    """Run history kept by appending events; nothing is updated in place, so a failure stays on record."""

    def __init__(self, spark: SparkSession, root: str, clock: Callable[[], datetime] | None = None):
        self.spark = spark
        self.path = f"{root.rstrip('/')}/_run_events"
        self.clock = clock or _now

    def events(self) -> DataFrame:
        return read_if_present(self.spark, self.path, audit.COUNTED_EVENTS_DDL)

    def runs(self) -> DataFrame:
        return audit.run_log(self.events())

    def load_counts(self) -> DataFrame:
        return audit.load_counts(self.events())

    def _append(
        self, log_id: int, process: str, at: datetime, status: str, message: str | None, rows: dict[str, int] | None = None
    ) -> None:
        event = one_row(self.spark, audit.COUNTED_EVENTS_DDL, log_id, process, at, status, message, rows)
        event.write.mode("append").parquet(self.path)

    @contextmanager
    def step(self, process: str, done: str | None = None) -> Iterator[dict[str, int]]:
        """A logged step; the block fills in the rows it wrote by table. Its scratch folders end with it."""
        log_id = last_key(self.events(), "log_id") + 1
        started = self.clock()
        self._append(log_id, process, started, audit.RUNNING, None)
        written: dict[str, int] = {}
        try:
            with temporary(self.spark):
                yield written
        except Exception as error:
            self._append(log_id, process, self.clock(), audit.FAILED, str(error))
            raise
        ended = self.clock()
        message = done and done.format(seconds=int((ended - started).total_seconds() + 0.5))
        self._append(log_id, process, ended, audit.SUCCESS, message, written)


def _now() -> datetime:
    return datetime.now(ZONE).replace(tzinfo=None)


def _numbered(name: str, rows: DataFrame) -> DataFrame:
    key, id_column = dims.NATURAL_KEYS[name]
    return assign_keys(rows, key, id_column)


def _loan_facts(
    sources: Sources, loans: DataFrame, lines: DataFrame, dim_mahasiswa: DataFrame, dim_waktu: DataFrame
) -> DataFrame:
    return facts.loan_recap(
        loans,
        lines,
        sources["denda"],
        sources["buku"],
        sources["anggota"],
        dim_mahasiswa,
        dim_waktu,
    )


def initial_load(warehouse: Warehouse, sources: Sources) -> dict[str, int]:
    """Replace all dimensions and facts by a load of the whole sources."""
    staged = warehouse.stage_all(
        {
            "dim_waktu": lambda: _numbered("dim_waktu", dims.semesters(sources["hasil_studi"])),
            "dim_program_studi": lambda: dims.study_programmes(sources["program_studi"]),
            "dim_mahasiswa": lambda: _numbered("dim_mahasiswa", dims.students(sources["mahasiswa"])),
            "dim_mata_kuliah": lambda: _numbered("dim_mata_kuliah", dims.courses(sources["mata_kuliah"])),
            "dim_kategori_buku": lambda: dims.categories(sources["kategori_buku"]),
        }
    )
    terms, students, courses = (
        staged[name].rows for name in ("dim_waktu", "dim_mahasiswa", "dim_mata_kuliah")
    )
    # The lines of one fact at a time, so that the shuffles of both are not on disk together.
    grades = warehouse.stage(
        "fact_detail_nilai",
        facts.grade_lines(sources["detail_nilai"], sources["hasil_studi"], terms, students, courses),
    )
    staged["fact_detail_nilai"] = grades
    staged |= warehouse.stage_all(
        {
            "fact_rekap_ip": lambda: facts.gpa_recap(grades.rows, students, courses, sources["mahasiswa"]),
            "fact_rekap_pinjam": lambda: _loan_facts(
                sources, sources["peminjaman"], sources["detail_peminjaman"], students, terms
            ),
        }
    )
    return warehouse.publish(replace=staged.values())


def load_shared_dimensions(warehouse: Warehouse, sources: Sources) -> dict[str, int]:
    """Unseen semesters are added, students are upserted; known ids stay."""
    known = warehouse.tables()

    def terms() -> DataFrame:
        key, id_column = dims.NATURAL_KEYS["dim_waktu"]
        unseen = dims.new_semesters(sources["hasil_studi"], known["dim_waktu"])
        return assign_keys(unseen, key, id_column, last_key(known["dim_waktu"], id_column))

    def students() -> DataFrame:
        key, id_column = dims.NATURAL_KEYS["dim_mahasiswa"]
        # Read twice: the known rows and the ones to be numbered.
        merged = settled(dims.upserted_students(sources["mahasiswa"], known["dim_mahasiswa"]))
        unseen = merged.filter(F.col(id_column).isNull()).drop(id_column)
        return extend_keys(merged.filter(F.col(id_column).isNotNull()), unseen, key, id_column)

    staged = warehouse.stage_all({"dim_waktu": terms, "dim_mahasiswa": students})
    return warehouse.publish(replace=[staged["dim_mahasiswa"]], add=[staged["dim_waktu"]])


def load_library_dimension(warehouse: Warehouse, sources: Sources) -> dict[str, int]:
    unseen = dims.new_categories(sources["kategori_buku"], warehouse.read("dim_kategori_buku"))
    return warehouse.publish(add=[warehouse.stage("dim_kategori_buku", unseen)])


def rebuild_loan_facts(warehouse: Warehouse, sources: Sources, run_log: DataFrame) -> dict[str, int]:
    """Delete and rebuild the loan facts of every semester touched since the last successful run."""
    known = warehouse.tables()
    checkpoint = incremental.last_success(run_log, LOAN_FACTS).first()["waktu_mulai"].date()
    impacted = settled(
        incremental.impacted_semesters(sources["peminjaman"], sources["denda"], known["dim_waktu"], checkpoint)
    )
    loans = incremental.loans_in(sources["peminjaman"], impacted)
    lines = lines_in(sources["detail_peminjaman"], impacted)
    rebuilt = warehouse.stage(
        "fact_rekap_pinjam", _loan_facts(sources, loans, lines, known["dim_mahasiswa"], impacted)
    )
    emptied = [str(row["waktu_id"]) for row in impacted.select("waktu_id").collect()]
    return warehouse.publish(add=[rebuilt], drop={"fact_rekap_pinjam": emptied})


def load_academic(warehouse: Warehouse, sources: Sources) -> dict[str, int]:
    """Add the grades and GPA rows of semesters after the latest loaded one."""
    known = warehouse.tables()
    mark = incremental.latest_semester(known["dim_waktu"], warehouse.semesters("fact_detail_nilai")).first()
    later = settled(incremental.later_semesters(known["dim_waktu"], mark["tahun_akademik"], mark["semester"]))

    def unseen_courses() -> DataFrame:
        key, id_column = dims.NATURAL_KEYS["dim_mata_kuliah"]
        unseen = dims.new_courses(sources["mata_kuliah"], known["dim_mata_kuliah"])
        return assign_keys(unseen, key, id_column, last_key(known["dim_mata_kuliah"], id_column))

    staged = warehouse.stage_all(
        {
            "dim_mata_kuliah": unseen_courses,
            "dim_program_studi": lambda: dims.new_study_programmes(
                sources["program_studi"], known["dim_program_studi"]
            ),
        }
    )
    all_courses = known["dim_mata_kuliah"].unionByName(staged["dim_mata_kuliah"].rows)

    transcripts = incremental.transcripts_from(sources["hasil_studi"], mark["tahun_akademik"])
    arrived = lines_in(sources["detail_nilai"], later)
    lines = warehouse.stage(
        "fact_detail_nilai",
        facts.grade_lines(arrived, transcripts, later, known["dim_mahasiswa"], all_courses),
    )
    # Grades of later semesters are all new: the watermark is the latest semester with any.
    recap = facts.gpa_recap(lines.rows, known["dim_mahasiswa"], all_courses, sources["mahasiswa"])
    added = [int(part) for part, _ in lines.folders]
    present = known["fact_rekap_ip"].filter(F.col("waktu_id").isin(added))
    recap = merge.insert_or_ignore(recap, present, ["waktu_id", "mahasiswa_id"], ["program_studi_id"])
    return warehouse.publish(add=[*staged.values(), lines, warehouse.stage("fact_rekap_ip", recap)])


def refresh_dashboard(warehouse: Warehouse) -> dict[str, int]:
    """Recompute the nine stored marts and switch them together."""
    tables = warehouse.tables()
    staged = warehouse.stage_all(
        {name: (lambda mart=mart: mart(tables)) for name, mart in STORED_MARTS.items()}
    )
    return warehouse.publish(replace=staged.values())


def initial_run(
    spark: SparkSession, root: str, sources: Sources, clock: Callable[[], datetime] | None = None
) -> Warehouse:
    warehouse, log = Warehouse(spark, root), RunLog(spark, root, clock)
    with log.step(INITIAL, INITIAL_DONE) as written:
        written |= initial_load(warehouse, sources)
    return warehouse


def incremental_run(
    spark: SparkSession, root: str, sources: Sources, clock: Callable[[], datetime] | None = None
) -> Warehouse:
    """The five nightly steps; a failing step stops the chain. ``clock`` dates the run, and so the next checkpoint."""
    warehouse, log = Warehouse(spark, root), RunLog(spark, root, clock)
    warehouse.remove_unnamed()
    with log.step(SHARED_DIMENSIONS) as written:
        written |= load_shared_dimensions(warehouse, sources)
    with log.step(LIBRARY_DIMENSION) as written:
        written |= load_library_dimension(warehouse, sources)
    with log.step(LOAN_FACTS) as written:
        written |= rebuild_loan_facts(warehouse, sources, log.runs())
    with log.step(ACADEMIC) as written:
        written |= load_academic(warehouse, sources)
    with log.step(DASHBOARD, DASHBOARD_DONE) as written:
        written |= refresh_dashboard(warehouse)
    return warehouse


def register_views(spark: SparkSession, warehouse: Warehouse, sources: Sources | None = None) -> None:
    """Published tables, stored marts and live views as temp views for ``spark.sql``; with sources, the library's too.

    They read the version that is published now: register them again after a run, as the next one removes what it replaced.
    """
    for name, view in LIBRARY_VIEWS.items() if sources else ():
        view(sources).createOrReplaceTempView(name)
    tables = warehouse.tables()
    for name, rows in tables.items():
        rows.createOrReplaceTempView(name)
    for name in STORED_MARTS:
        warehouse.read(name).createOrReplaceTempView(name)
    for name, view in LIVE_VIEWS.items():
        view(tables).createOrReplaceTempView(name)
