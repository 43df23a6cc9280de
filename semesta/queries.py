"""One query per job, mart and report, over the campus tables derived from a driver folder.

Facts and dimensions carry natural keys here, so results do not depend on id assignment; whole
numbers are BIGINT and decimals DOUBLE in every result.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import cached_property, partial
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from semesta import runs
from semesta.functions.rounding import half_up, hundredths
from semesta.operators import merge
from semesta.operators.keys import assign_keys, extend_keys
from semesta.operators.settled import settled
from semesta.plans import audit, dims, facts, incremental, marts, quality
from semesta.schemas import ACADEMIC, DIMENSIONS, FACTS, LIBRARY, SOURCES, WAREHOUSE, Table
from semesta.session import shared_dir, temporary, tidy
from semesta.sources import testbed
from semesta.sources.tables import land, read_landing
from semesta.warehouse import Warehouse


def comparable(df: DataFrame) -> DataFrame:
    def plain(field: T.StructField):
        if isinstance(field.dataType, (T.ShortType, T.IntegerType)):
            return F.col(field.name).cast("bigint").alias(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        return F.col(field.name)

    return df.select(*map(plain, df.schema.fields))


class Star(dict):
    """Dimensions and facts over a set of operational tables, built on first use, with natural keys."""

    def __init__(self, sources: testbed.LazyTables, **given: DataFrame):
        super().__init__(given)
        self.sources = sources

    def __missing__(self, name: str) -> DataFrame:
        self[name] = getattr(self, f"_{name}")()
        return self[name]

    def _dim_waktu(self) -> DataFrame:
        return dims.natural_ids("dim_waktu", settled(dims.semesters(self.sources["hasil_studi"])))

    def _dim_mahasiswa(self) -> DataFrame:
        return dims.natural_ids("dim_mahasiswa", dims.students(self.sources["mahasiswa"]))

    def _dim_mata_kuliah(self) -> DataFrame:
        return dims.natural_ids("dim_mata_kuliah", dims.courses(self.sources["mata_kuliah"]))

    def _dim_program_studi(self) -> DataFrame:
        return dims.study_programmes(self.sources["program_studi"])

    def _dim_kategori_buku(self) -> DataFrame:
        return dims.categories(self.sources["kategori_buku"])

    def grades(self, dim_waktu: DataFrame, hasil_studi: DataFrame | None = None) -> DataFrame:
        return facts.grade_lines(
            self.sources["detail_nilai"],
            self.sources["hasil_studi"] if hasil_studi is None else hasil_studi,
            dim_waktu,
            self["dim_mahasiswa"],
            self["dim_mata_kuliah"],
        )

    def gpa(self, fact_detail_nilai: DataFrame) -> DataFrame:
        return facts.gpa_recap(
            fact_detail_nilai, self["dim_mahasiswa"], self["dim_mata_kuliah"], self.sources["mahasiswa"]
        )

    def loans(self, dim_waktu: DataFrame, peminjaman: DataFrame | None = None) -> DataFrame:
        return facts.loan_recap(
            self.sources["peminjaman"] if peminjaman is None else peminjaman,
            self.sources["detail_peminjaman"],
            self.sources["denda"],
            self.sources["buku"],
            self.sources["anggota"],
            self["dim_mahasiswa"],
            dim_waktu,
        )

    def _fact_detail_nilai(self) -> DataFrame:
        return self.grades(self["dim_waktu"])

    def _fact_rekap_ip(self) -> DataFrame:
        return self.gpa(self["fact_detail_nilai"])

    def _fact_rekap_pinjam(self) -> DataFrame:
        return self.loans(self["dim_waktu"])


class Loaded(Star):
    """A warehouse that a load has left: its grades are stored, as many queries read them more than once."""

    def _fact_detail_nilai(self) -> DataFrame:
        return settled(super()._fact_detail_nilai())


class Campus:
    """The states of the operational tables the queries start from."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def sources(self) -> testbed.LazyTables:
        return testbed.source_tables(self.spark, self.sf_dir)

    @cached_property
    def star(self) -> Star:
        return Star(self.sources)

    @cached_property
    def before(self) -> Star:
        """The warehouse before the batches arrive."""
        return Loaded(testbed.first_snapshot(self.spark, self.sf_dir))

    @cached_property
    def existing(self) -> dict[str, DataFrame]:
        return testbed.existing_dimensions(self.spark, self.sf_dir)

    @cached_property
    def run_events(self) -> DataFrame:
        return testbed.run_events(self.spark, self.sf_dir)

    @cached_property
    def watermark(self) -> DataFrame:
        return incremental.latest_semester(self.before["dim_waktu"], self.before["fact_detail_nilai"])

    @cached_property
    def new_grades(self) -> DataFrame:
        year, semester = self.watermark.first()
        later = settled(incremental.later_semesters(self.star["dim_waktu"], year, semester))
        return self.star.grades(later, incremental.transcripts_from(self.sources["hasil_studi"], year))

    @cached_property
    def new_gpa(self) -> DataFrame:
        return merge.insert_or_ignore(
            self.star.gpa(self.new_grades), self.before["fact_rekap_ip"], ["waktu_id", "mahasiswa_id"], ["program_studi_id"]
        )

    @cached_property
    def impacted(self) -> DataFrame:
        return settled(
            incremental.impacted_semesters(
                self.sources["peminjaman"], self.sources["denda"], self.star["dim_waktu"], testbed.CUT
            )
        )

    @cached_property
    def rebuilt_loans(self) -> DataFrame:
        return self.star.loans(self.impacted, incremental.loans_in(self.sources["peminjaman"], self.impacted))

    @cached_property
    def after(self) -> Star:
        """The warehouse after an incremental load: late transcripts are not in it."""
        return Star(
            self.sources,
            fact_detail_nilai=self.before["fact_detail_nilai"].unionByName(self.new_grades),
            fact_rekap_ip=self.before["fact_rekap_ip"].unionByName(self.new_gpa),
        )

    @cached_property
    def flawed(self) -> dict[str, DataFrame]:
        """Operational and warehouse tables in which every constraint is broken."""
        tables = testbed.flawed_tables(self.spark, self.sf_dir)
        # Grades as they arrive, not reduced to one per student, semester and course.
        arrived = testbed.arrived_grades(self.spark, self.sf_dir)

        def repeated() -> DataFrame:
            # On the same dimensions, so the transcripts with their ids are one shuffle for both facts.
            known = {name: self.star[name] for name in ("dim_waktu", "dim_mahasiswa", "dim_mata_kuliah")}
            return Star(self.sources.with_builders(detail_nilai=lambda: arrived), **known)["fact_detail_nilai"]

        return tables.with_builders(**testbed.flawed_warehouse(self.star, repeated))


def _semester_of_date(c: Campus) -> DataFrame:
    return facts.loan_semesters(c.sources["peminjaman"]).select(
        "peminjaman_id", "tgl_pinjam", "tahun_akademik", "semester"
    )


def _surrogate_keys(c: Campus) -> DataFrame:
    known = c.existing["dim_mahasiswa"].select("nim")
    numbered = assign_keys(known, ["nim"], "mahasiswa_id")
    unseen = merge.insert_if_absent(c.sources["mahasiswa"].select("nim"), known, ["nim"])
    return extend_keys(numbered, unseen, ["nim"], "mahasiswa_id").select("nim", "mahasiswa_id")


def _row_counts(c: Campus) -> DataFrame:
    arrived = quality.row_counts(
        {name: c.sources[name] for name in SOURCES} | {name: c.after[name] for name in WAREHOUSE}
    )
    sent = {
        "dim_program_studi": "program_studi",
        "dim_mahasiswa": "mahasiswa",
        "dim_mata_kuliah": "mata_kuliah",
        "dim_kategori_buku": "kategori_buku",
        "fact_detail_nilai": "detail_nilai",
        "fact_rekap_ip": "hasil_studi",
    }
    return quality.reconcile(
        arrived, quality.row_counts({target: c.sources[source] for target, source in sent.items()})
    )


def _named(tables: dict[str, DataFrame], name: str) -> DataFrame:
    """A warehouse table; a fact with the natural keys of its student and semester."""
    if not name.startswith("fact"):
        return tables[name]
    named = tables[name].join(tables["dim_mahasiswa"].select("mahasiswa_id", "nim"), "mahasiswa_id")
    return named.join(tables["dim_waktu"].select("waktu_id", "tahun_akademik", "semester"), "waktu_id")


def _controls() -> dict[str, Column]:
    """Per warehouse table what its control total adds up; a fact's follows its ids to the natural keys."""
    whose = F.col("nim").cast("bigint") % 1009 + F.substring("tahun_akademik", 1, 4).cast("bigint") + F.length("semester")
    return {
        "dim_waktu": F.length("tahun_akademik"),
        "dim_program_studi": F.col("program_studi_id"),
        "dim_mahasiswa": F.col("angkatan") + F.length("nama") + F.col("nim").cast("bigint"),
        "dim_mata_kuliah": F.col("bobot_sks") + F.col("kode_mata_kuliah").cast("bigint"),
        "dim_kategori_buku": F.col("kategori_id") + F.length("deskripsi"),
        "fact_detail_nilai": whose * (hundredths(F.col("bobot_nilai")) + F.col("status_lulus").cast("int")),
        "fact_rekap_ip": whose * (hundredths(F.col("ip_semester")) + F.col("total_sks") + F.col("jumlah_mata_kuliah")),
        "fact_rekap_pinjam": whose * (F.col("total_peminjaman") + F.col("jumlah_denda") + F.col("jumlah_buku")),
    }


def _summary(warehouse: Warehouse) -> DataFrame:
    """Rows and a control total of every warehouse table."""
    tables = warehouse.tables()
    return quality.union_all(
        _named(tables, name)
        .agg(F.count(F.lit(1)).alias("total"), F.sum(value).cast("bigint").alias("kontrol"))
        .select(F.lit(name).alias("tabel"), "total", "kontrol")
        for name, value in _controls().items()
    )


def _new_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/warehouse-{uuid4().hex}"


def _initial_run(c: Campus) -> DataFrame:
    return _summary(runs.initial_run(c.spark, _new_root(c.spark), c.sources))


def _loaded(c: Campus) -> Warehouse:
    """A full load of the first snapshot, then a night with all rows."""
    root = _new_root(c.spark)
    runs.initial_run(c.spark, root, testbed.first_snapshot(c.spark, c.sf_dir))
    return runs.incremental_run(c.spark, root, c.sources)


def _incremental_run(c: Campus) -> DataFrame:
    return _summary(_loaded(c))


def _load_counts(c: Campus) -> DataFrame:
    """Rows that every step of a full load and a night wrote, from the run log."""
    warehouse = _loaded(c)
    return runs.RunLog(c.spark, warehouse.root).load_counts().select("nama_proses", "tabel", "baris")


def _dashboards(c: Campus) -> DataFrame:
    """Rows and a control total of each report, read by its name: the stored marts as published, the views as they are."""
    runs.register_views(c.spark, _loaded(c), c.sources)

    def weighed(field: T.StructField, weight: int) -> Column:
        value = F.col(field.name)
        if isinstance(field.dataType, T.StringType):
            value = F.length(value)
        elif isinstance(field.dataType, (T.DecimalType, T.DoubleType)):
            value = F.round(value * 100)
        return weight * F.coalesce(value, F.lit(0)).cast("bigint")

    def total(name: str) -> DataFrame:
        rows = c.spark.sql(f"SELECT * FROM {name}")
        fields = sorted(rows.schema.fields, key=lambda field: field.name)
        control = sum((weighed(field, i + 1) for i, field in enumerate(fields)), F.lit(0))
        return rows.agg(F.count(F.lit(1)).alias("total"), F.sum(control).alias("kontrol")).select(
            F.lit(name).alias("nama"), "total", "kontrol"
        )

    return quality.union_all(total(name) for name in (*runs.STORED_MARTS, *runs.LIVE_VIEWS, *runs.LIBRARY_VIEWS))


def _second_night(c: Campus) -> DataFrame:
    """Two nights, the second from landed files: rows and control total of each semester, and whether its folder stayed."""
    root = _new_root(c.spark)
    first = datetime(testbed.CUT.year, testbed.CUT.month, testbed.CUT.day)
    warehouse = runs.incremental_run(c.spark, f"{root}/dw", testbed.first_snapshot(c.spark, c.sf_dir), lambda: first)
    before = warehouse.folders()
    with temporary(c.spark):
        # Landing reads lines twice; grades are derived once for that.
        land(f"{root}/landing", {name: c.sources[name] for name in SOURCES} | {"detail_nilai": settled(c.sources["detail_nilai"])})
    landed = read_landing(c.spark, f"{root}/landing")
    runs.incremental_run(c.spark, f"{root}/dw", landed, lambda: first.replace(year=first.year + 1))
    kept = before & warehouse.folders()
    tables, controls = warehouse.tables(), _controls()

    def parts(fact: str) -> DataFrame:
        stayed = F.col("waktu_id").isin([int(part) for name, part, _ in kept if name == fact])
        return (
            _named(tables, fact)
            .groupBy("tahun_akademik", "semester", stayed.alias("dipertahankan"))
            .agg(F.count(F.lit(1)).alias("total"), F.sum(controls[fact]).cast("bigint").alias("kontrol"))
            .select(F.lit(fact).alias("tabel"), "tahun_akademik", "semester", "dipertahankan", "total", "kontrol")
        )

    return quality.union_all(parts(spec.name) for spec in FACTS)


def _conflicts(c: Campus) -> DataFrame:
    """GPA rows after a batch with one row per transcript: stored rows win, then the transcript that came first.

    ``pesaing`` counts the batch's rows of a key, ``khs`` names the one that was taken.
    """
    key, stored = ["waktu_id", "mahasiswa_id"], c.before["fact_rekap_ip"]
    transcripts = c.sources["hasil_studi"].select(
        "khs_id", F.col("nim").alias("mahasiswa_id"), F.concat_ws(" ", "tahun_akademik", "semester").alias("waktu_id")
    )
    lines = testbed.arrived_grades(c.spark, c.sf_dir).select("khs_id", "mata_kuliah_id", "nilai_angka")
    batch = (
        lines.join(c.sources["mata_kuliah"].select("mata_kuliah_id", "sks"), "mata_kuliah_id")
        .groupBy("khs_id")
        .agg(
            F.sum(hundredths(F.col("nilai_angka")) * F.col("sks")).alias("bobot"),
            F.sum("sks").alias("total_sks"),
            F.count(F.lit(1)).alias("jumlah_mata_kuliah"),
        )
        .join(transcripts, "khs_id")
        .join(c.sources["mahasiswa"].select(F.col("nim").alias("mahasiswa_id"), "program_studi_id"), "mahasiswa_id")
        .select(
            *key,
            F.col("khs_id").cast("bigint").alias("khs"),
            "program_studi_id",
            (half_up(F.col("bobot"), F.col("total_sks")).cast("decimal(20,0)") / 100).cast("decimal(3,2)").alias("ip_semester"),
            "total_sks",
            "jumlah_mata_kuliah",
        )
    )
    batch = settled(batch)
    rivals = batch.groupBy(*key).agg(F.count(F.lit(1)).alias("pesaing"))
    added = merge.insert_or_ignore(batch, stored, key, ["khs"])
    after = stored.select(*key, F.lit(None).cast("bigint").alias("khs"), *added.columns[3:]).unionByName(added)
    return after.join(rivals, key, "left").withColumn("pesaing", F.coalesce("pesaing", F.lit(0)))


def _referential(c: Campus) -> DataFrame:
    """Foreign keys of the flawed tables; those of the facts are derived one fact after the other, before all are counted."""

    def keys(spec: Table) -> DataFrame:
        with tidy(c.spark):
            return settled(c.flawed[spec.name].select(*(column for fk in spec.references for column in fk.columns)))

    return quality.referential(c.flawed.with_builders(**{spec.name: partial(keys, spec) for spec in FACTS}), _ALL)


def _landing_load(c: Campus) -> DataFrame:
    """A full load of tables that landed as a snapshot and a batch of later rows."""
    root = _new_root(c.spark)
    # The column whose hash says which of the two a row came with.
    by = {
        **{spec.name: spec.key[0] for spec in SOURCES.values()},
        "detail_nilai": "khs_id",
        "detail_peminjaman": "peminjaman_id",
    }
    for name, column in by.items():
        with temporary(c.spark):
            rows = settled(c.sources[name]) if name in testbed.SHUFFLED else c.sources[name]
            late = F.xxhash64(column) % 3 == 0
            rows.filter(~late).write.parquet(f"{root}/snapshot/{name}")
            rows.filter(late).write.parquet(f"{root}/batch/{name}")
    landed = read_landing(c.spark, f"{root}/snapshot", {name: [f"{root}/batch"] for name in by})
    return _summary(runs.initial_run(c.spark, f"{root}/warehouse", landed))


_ALL = (*ACADEMIC, *LIBRARY, *DIMENSIONS, *FACTS)
_LOANS = runs.LOAN_FACTS

PLANS: dict[str, Callable[[Campus], DataFrame]] = {
    # Dimensions
    "dim_waktu_initial": lambda c: dims.semesters(c.sources["hasil_studi"]),
    "dim_program_studi_initial": lambda c: dims.study_programmes(c.sources["program_studi"]),
    "dim_mahasiswa_initial": lambda c: dims.students(c.sources["mahasiswa"]),
    "dim_mata_kuliah_initial": lambda c: dims.courses(c.sources["mata_kuliah"]),
    "dim_kategori_buku_initial": lambda c: dims.categories(c.sources["kategori_buku"]),
    "dim_waktu_incremental": lambda c: dims.new_semesters(c.sources["hasil_studi"], settled(c.existing["dim_waktu"])),
    "dim_mahasiswa_upsert": lambda c: dims.upserted_students(c.sources["mahasiswa"], c.existing["dim_mahasiswa"]),
    "dim_mata_kuliah_incremental": lambda c: dims.new_courses(c.sources["mata_kuliah"], c.existing["dim_mata_kuliah"]),
    "dim_program_studi_incremental": lambda c: dims.new_study_programmes(
        c.sources["program_studi"], c.existing["dim_program_studi"]
    ),
    "dim_kategori_buku_incremental": lambda c: dims.new_categories(
        c.sources["kategori_buku"], c.existing["dim_kategori_buku"]
    ),
    "surrogate_key_assignment": _surrogate_keys,
    "semester_of_date": _semester_of_date,
    # Facts
    "fact_detail_nilai_initial": lambda c: c.star["fact_detail_nilai"],
    "fact_rekap_ip_initial": lambda c: c.star["fact_rekap_ip"],
    "fact_rekap_pinjam_initial": lambda c: c.star["fact_rekap_pinjam"],
    # Incremental load
    "watermark_last_semester": lambda c: c.watermark,
    "fact_detail_nilai_incremental": lambda c: c.new_grades,
    "fact_rekap_ip_incremental": lambda c: c.new_gpa,
    "checkpoint_last_success": lambda c: incremental.last_success(audit.run_log(c.run_events), _LOANS),
    "impacted_waktu": lambda c: c.impacted,
    "fact_rekap_pinjam_kept": lambda c: merge.outside(c.before["fact_rekap_pinjam"], c.impacted, "waktu_id"),
    "fact_rekap_pinjam_rebuild": lambda c: c.rebuilt_loans,
    "fact_rekap_pinjam_after_replace": lambda c: merge.replace(
        c.before["fact_rekap_pinjam"], c.impacted, c.rebuilt_loans, "waktu_id"
    ),
    "initial_run": _initial_run,
    "incremental_run": _incremental_run,
    "landing_load": _landing_load,
    "load_counts": _load_counts,
    "second_night": _second_night,
    "dashboards": _dashboards,
    "fact_rekap_ip_conflict": _conflicts,
    # Marts and views
    **{name: (lambda c, mart=mart: mart(c.star)) for name, mart in (runs.STORED_MARTS | runs.LIVE_VIEWS).items()},
    "top10_ketidaklulusan": lambda c: marts.top_courses(runs.STORED_MARTS["tingkat_ketidaklulusan"](c.star)),
    "top10_matkul_kritis": lambda c: marts.top_courses_by_intake(runs.STORED_MARTS["matkul_kritis_angkatan"](c.star)),
    **{name: (lambda c, view=view: view(c.sources)) for name, view in runs.LIBRARY_VIEWS.items()},
    # Data quality
    "dq_not_null": lambda c: quality.not_null(c.flawed, _ALL),
    "dq_length": lambda c: quality.lengths(c.flawed, _ALL),
    "dq_domain_values": lambda c: quality.domain_values(c.flawed, LIBRARY),
    "dq_range": lambda c: quality.ranges(c.flawed, LIBRARY),
    "dq_date_order": lambda c: quality.date_order(c.flawed, LIBRARY),
    "dq_unique_key": lambda c: quality.unique_keys(c.flawed, _ALL),
    "dq_referential": _referential,
    "dq_logical_fk": lambda c: quality.logical_references(c.flawed, LIBRARY),
    "dq_defaults": lambda c: quality.defaults_applied(c.flawed, LIBRARY),
    "row_count_reconciliation": _row_counts,
    # Run history
    "etl_run_log": lambda c: audit.run_log(c.run_events),
    "etl_log_monitor": lambda c: audit.monitor(audit.run_log(c.run_events)),
}


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(PLANS[name](Campus(spark, sf_dir)))
