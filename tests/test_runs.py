"""Full and incremental load: write, publish, read back."""

from __future__ import annotations

import os
import re
import subprocess
import sys
import time

import pytest
from pyspark.sql import functions as F

from semesta import runs, session
from semesta.operators.settled import settled
from semesta.plans import quality
from semesta.schemas import SOURCES, WAREHOUSE
from semesta.sources.tables import land, lines_in, read_landing
from semesta.warehouse import BrokenRule, Warehouse
from tests.conftest import d, dec, rows


def _contents(warehouse: Warehouse) -> dict[str, list[tuple]]:
    return {name: rows(df) for name, df in warehouse.tables().items()}


def _recap(warehouse: Warehouse) -> list[tuple]:
    terms, students = warehouse.read("dim_waktu"), warehouse.read("dim_mahasiswa")
    return rows(
        warehouse.read("fact_rekap_pinjam").join(terms, "waktu_id").join(students, "mahasiswa_id"),
        "tahun_akademik", "semester", "nim", "kategori_id", "total_peminjaman", "jumlah_denda", "jumlah_buku",
    )


@pytest.fixture(scope="module")
def later(campus, table):
    """The sources after new rows arrived: a new semester, a late grade, a student, a course, changes."""
    return {
        **campus,
        "mahasiswa": table(
            "mahasiswa",
            ("S1", 1, "Ani Baru", "P", 2099, None),
            ("S2", 1, "Budi", "L", 2020, None),
            ("S3", 2, "Citra", "P", 2021, None),
            ("S4", 2, "Dedi", "L", 2021, None),
        ),
        "mata_kuliah": campus["mata_kuliah"].unionByName(table("mata_kuliah", ("C3", "Etika", 2))),
        "hasil_studi": campus["hasil_studi"].unionByName(
            table("hasil_studi", ("K5", "S4", "2021/2022", "Ganjil", None), ("K6", "S2", "2020/2021", "Genap", None))
        ),
        "detail_nilai": campus["detail_nilai"].unionByName(
            table("detail_nilai", (7, "K5", "C3", dec("4.00"), "A", "Lulus"), (8, "K6", "C1", dec("2.00"), "C", "Lulus"))
        ),
        # Loan 2 lost its only line, so one rebuilt semester has fewer rows than before.
        "detail_peminjaman": campus["detail_peminjaman"].filter("peminjaman_id <> 2"),
    }


@pytest.fixture(scope="module")
def loaded(spark, campus, later, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("warehouse"))
    states = [_contents(runs.initial_run(spark, root, campus))]
    for _ in range(2):
        states.append(_contents(runs.incremental_run(spark, root, later)))
    return root, states


def test_initial_load_counts(loaded):
    _, (first, *_) = loaded
    assert {name: len(data) for name, data in first.items()} == {
        "dim_waktu": 2, "dim_mahasiswa": 3, "dim_program_studi": 2, "dim_mata_kuliah": 2, "dim_kategori_buku": 2,
        "fact_detail_nilai": 6, "fact_rekap_ip": 4, "fact_rekap_pinjam": 4,
    }


def test_ids_follow_the_natural_key_and_stay(loaded):
    _, (first, second, _) = loaded
    assert first["dim_waktu"] == [(1, "2020/2021", "Ganjil"), (2, "2020/2021", "Genap")]
    assert second["dim_waktu"] == [*first["dim_waktu"], (3, "2021/2022", "Ganjil")]
    assert second["dim_mahasiswa"] == [
        (1, "S1", "Ani Baru", "Perempuan", 2020), (2, "S2", "Budi", "Laki-laki", 2020),
        (3, "S3", "Citra", "Perempuan", 2021), (4, "S4", "Dedi", "Laki-laki", 2021),
    ]
    assert [row[1] for row in second["dim_mata_kuliah"]] == ["C1", "C2", "C3"]


def test_late_grades_stay_out_and_show_as_a_gap(spark, loaded, later):
    root, (first, second, _) = loaded
    assert set(second["fact_detail_nilai"]) - set(first["fact_detail_nilai"]) == {(3, 4, 3, dec("4.00"), True, dec("8.00"))}
    counts = quality.row_counts({"fact_detail_nilai": Warehouse(spark, root).read("fact_detail_nilai")})
    sent = quality.row_counts({"fact_detail_nilai": later["detail_nilai"]})
    assert rows(quality.reconcile(counts, sent)) == [("fact_detail_nilai", 7, 8, 1)]


def test_rebuild_removes_emptied_rows(loaded):
    _, (first, second, _) = loaded
    assert len(first["fact_rekap_pinjam"]) == 4 and len(second["fact_rekap_pinjam"]) == 3


def test_incremental_twice_equals_once(loaded):
    _, (_, second, third) = loaded
    assert second == third


def test_rebuild_equals_full_load(spark, loaded, later, tmp_path):
    root, _ = loaded
    full = runs.initial_run(spark, str(tmp_path), later)
    assert _recap(full) == _recap(Warehouse(spark, root))


def test_facts_are_read_by_semester_folder(spark, loaded):
    root, _ = loaded
    fact = Warehouse(spark, root).read("fact_detail_nilai").filter("waktu_id = 3")
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(waktu_id" in plan
    assert fact.count() == 1


def test_marts_are_stored_and_views_registered(spark, loaded):
    root, _ = loaded
    warehouse = Warehouse(spark, root)
    runs.register_views(spark, warehouse)
    tables = warehouse.tables()
    for name, mart in runs.STORED_MARTS.items():
        assert rows(spark.table(name)) == rows(mart(tables)), name
    total = spark.sql("SELECT sum(total_mahasiswa_mengambil) FROM tingkat_ketidaklulusan").first()[0]
    assert total == tables["fact_detail_nilai"].count()
    assert spark.table("tren_performa_akademik").count() == 3 + 2 + 1


def test_run_history(spark, loaded):
    root, _ = loaded
    history = runs.RunLog(spark, root).runs()
    assert history.count() == 11
    assert rows(history.select("status").distinct()) == [("SUCCESS",)]
    initial = history.filter(F.col("nama_proses") == runs.INITIAL).first()
    assert initial["pesan_error"].startswith("Initial load berhasil")


def test_second_run_rebuilds_only_since_the_checkpoint(spark, loaded, later):
    """The first incremental run starts from 1970; afterwards old loans are left alone."""
    root, _ = loaded
    log = runs.RunLog(spark, root).runs()
    changed = {**later, "denda": later["denda"].withColumn("total_denda", F.lit(1))}
    warehouse = Warehouse(spark, root)
    before = _recap(warehouse)
    runs.rebuild_loan_facts(warehouse, changed, log)
    assert _recap(warehouse) == before


def test_duplicate_grade_fails_the_load_and_publishes_nothing(spark, campus, table, tmp_path):
    root = str(tmp_path)
    twice = campus["detail_nilai"].unionByName(table("detail_nilai", (9, "K1", "C1", dec("2.00"), "C", "Lulus")))
    with pytest.raises(BrokenRule, match="fact_detail_nilai"):
        runs.initial_run(spark, root, {**campus, "detail_nilai": twice})
    assert all(not data for data in _contents(Warehouse(spark, root)).values())
    failed = runs.RunLog(spark, root).runs().first()
    assert failed["status"] == "FAILED" and "unique" in failed["pesan_error"]


def test_null_semester_stops_the_incremental_chain(spark, campus, later, table, tmp_path):
    root = str(tmp_path)
    first = _contents(runs.initial_run(spark, root, campus))
    bad = later["hasil_studi"].unionByName(table("hasil_studi", ("K9", "S1", None, "Ganjil", None)))
    with pytest.raises(BrokenRule, match="tahun_akademik not null"):
        runs.incremental_run(spark, root, {**later, "hasil_studi": bad})
    assert _contents(Warehouse(spark, root)) == first
    assert runs.RunLog(spark, root).runs().count() == 2


def test_landing_reads_snapshot_and_batches_with_defaults(spark, campus, table, tmp_path):
    snapshot, batch = str(tmp_path / "snapshot"), str(tmp_path / "batch1")
    for name in SOURCES:
        campus[name].write.parquet(f"{snapshot}/{name}")
    table("eksemplar_buku", ("E9", "B4", None, None)).write.parquet(f"{batch}/eksemplar_buku")
    landed = read_landing(spark, snapshot, {"eksemplar_buku": [batch]})
    assert set(landed) == set(SOURCES)
    assert landed["eksemplar_buku"].filter("eksemplar_id = 'E9'").first()["tersedia"] == "Y"
    assert landed["eksemplar_buku"].count() == campus["eksemplar_buku"].count() + 1
    assert rows(landed["peminjaman"]) == rows(campus["peminjaman"])


def test_declared_tables_are_complete():
    assert len(SOURCES) == 13 and len(WAREHOUSE) == 8
    assert d("2020-01-01").year == 2020


def test_orphans_nulls_and_repeated_keys_are_not_published(spark, campus, table, tmp_path):
    warehouse = runs.initial_run(spark, str(tmp_path), campus)
    before = _contents(warehouse)
    fact = warehouse.read("fact_rekap_pinjam")
    orphan = fact.limit(1).withColumn("kategori_id", F.lit(99))
    staged = warehouse.stage("fact_rekap_pinjam", orphan)
    with pytest.raises(BrokenRule, match="kategori_id in dim_kategori_buku"):
        warehouse.publish(add=[staged])
    with pytest.raises(BrokenRule, match="published already"):
        warehouse.publish(add=[warehouse.stage("dim_kategori_buku", warehouse.read("dim_kategori_buku").limit(1))])
    with pytest.raises(BrokenRule, match="program_studi_id not null"):
        warehouse.stage("dim_program_studi", table("dim_program_studi", (None, "S1", "x", "y")))
    with pytest.raises(BrokenRule, match="mahasiswa_id in dim_mahasiswa"):
        warehouse.publish(replace=[warehouse.stage("dim_mahasiswa", warehouse.read("dim_mahasiswa").filter("nim <> 'S1'"))])
    assert _contents(warehouse) == before


def test_nights_without_new_rows_publish_no_folders(spark, campus, tmp_path):
    warehouse = runs.initial_run(spark, str(tmp_path), campus)
    runs.load_academic(warehouse, campus)
    once = {name for name, _, _ in warehouse._folders()[1]}, len(warehouse._folders()[1])
    for _ in range(3):
        runs.load_library_dimension(warehouse, campus)
        runs.load_academic(warehouse, campus)
    assert ({name for name, _, _ in warehouse._folders()[1]}, len(warehouse._folders()[1])) == once


def test_null_keys_are_reported(spark, table):
    students = table("mahasiswa", (None, 1, "a", "L", 2020, None), (None, 1, "b", "L", 2020, None))
    report = quality.not_null({"mahasiswa": students}, [SOURCES["mahasiswa"]])
    assert rows(report) == [("mahasiswa", "nim not null", 2)]


def test_rows_per_load_are_counted_by_the_write(spark, loaded):
    root, (first, second, _) = loaded
    log = runs.RunLog(spark, root)
    counts = {(r["log_id"], r["tabel"]): r["baris"] for r in log.load_counts().collect()}
    assert {table: n for (log_id, table), n in counts.items() if log_id == 1} == {name: len(data) for name, data in first.items()}
    steps = {r["log_id"]: r["nama_proses"] for r in log.load_counts().collect()}
    night = {(steps[i], table): n for (i, table), n in counts.items() if 2 <= i <= 6}
    assert night[runs.SHARED_DIMENSIONS, "dim_waktu"] == 1 and night[runs.SHARED_DIMENSIONS, "dim_mahasiswa"] == 4
    assert night[runs.ACADEMIC, "fact_detail_nilai"] == len(second["fact_detail_nilai"]) - len(first["fact_detail_nilai"])
    assert night[runs.LOAN_FACTS, "fact_rekap_pinjam"] == 3 and night[runs.LIBRARY_DIMENSION, "dim_kategori_buku"] == 0
    assert {table for step, table in night if step == runs.DASHBOARD} == set(runs.STORED_MARTS)


def test_staging_counts_rows_and_nulls_while_writing(spark, table, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    programmes = table("dim_program_studi", *((i, "S1", "x", "y") for i in range(500))).repartition(7)
    assert warehouse.stage("dim_program_studi", programmes).count == 500
    assert warehouse.stage("dim_program_studi", programmes.filter("program_studi_id < 0")).count == 0
    with pytest.raises(BrokenRule, match="jenjang not null, broken 500 times"):
        warehouse.stage("dim_program_studi", programmes.withColumn("jenjang", F.lit(None).cast("string")))


def _scratch(spark) -> list[str]:
    """Names of the application's scratch folders that are there now."""
    return [folder for root in session._FOLDERS.values() for folder in session.list_folders(spark, root)]


def test_runs_leave_no_scratch_folders(spark, campus, later, tmp_path):
    before = set(_scratch(spark))
    warehouse = runs.initial_run(spark, str(tmp_path), campus)
    log = runs.RunLog(spark, str(tmp_path))
    for _ in range(10):
        with log.step(runs.SHARED_DIMENSIONS) as written:
            written |= runs.load_shared_dimensions(warehouse, later)
    assert set(_scratch(spark)) == before
    with pytest.raises(ZeroDivisionError), log.step(runs.LOAN_FACTS):
        assert settled(spark.range(3)).count() == 3 and len(_scratch(spark)) == len(before) + 1
        raise ZeroDivisionError
    assert set(_scratch(spark)) == before


def test_threads_hold_their_folders_in_the_callers_block(spark, tmp_path):
    before = set(_scratch(spark))
    warehouse = Warehouse(spark, str(tmp_path))
    with session.temporary(spark):
        staged = warehouse.stage_all({name: lambda: settled(spark.range(5)) for name in ("one", "two")})
        assert len(_scratch(spark)) == len(before) + 2
    assert set(_scratch(spark)) == before
    assert [one.rows.count() for one in staged.values()] == [5, 5]


def test_folders_nobody_names_are_removed(spark, campus, later, tmp_path):
    root = str(tmp_path)
    warehouse = runs.initial_run(spark, root, campus)
    first = {path for _, _, path in warehouse.folders()}
    lost = warehouse.stage("dim_kategori_buku", warehouse.read("dim_kategori_buku"))
    runs.incremental_run(spark, root, later)
    assert not any(os.path.exists(path) for _, path in lost.folders)
    contents = _contents(warehouse)
    warehouse.remove_unnamed()
    named = {path for _, _, path in warehouse.folders()}
    assert all(os.path.exists(path) == (path in named) for path in first)
    there = {f"{root}/{name}/{run}" for name in (*WAREHOUSE, *runs.STORED_MARTS) for run in os.listdir(f"{root}/{name}")}
    assert there == {re.sub(r"/waktu_id=[^/]*$", "", path) for path in named}
    assert _contents(warehouse) == contents


def test_an_application_removes_its_scratch_folder_at_its_end(tmp_path):
    code = f"""
from semesta.session import build_session
from semesta.operators.settled import settled
spark = build_session("ending", "local[1]", **{{"spark.checkpoint.dir": {str(tmp_path)!r}}})
assert settled(spark.range(3)).count() == 3
"""
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(os.path.dirname(__file__)), timeout=120)
    # The JVM ends a little after its Python process.
    for _ in range(60):
        if not [name for name in os.listdir(tmp_path) if name.startswith("semesta-")]:
            return
        time.sleep(0.5)
    pytest.fail("the scratch folder is still there")


def _files_read(df) -> int:
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numFiles").value() for i in range(leaves.size()))


def test_landed_lines_are_read_by_semester(spark, campus, later, tmp_path):
    """A night opens the folders of its semesters, and those of lines whose transcript or loan is not known yet."""
    folder = str(tmp_path)
    land(folder, campus)
    for name in ("detail_nilai", "detail_peminjaman"):
        landed = read_landing(spark, folder)[name]
        assert rows(landed.drop("masa")) == rows(campus[name])
        every = spark.createDataFrame([("2020/2021", "Ganjil"), ("2020/2021", "Genap")], "tahun_akademik STRING, semester STRING")
        some = lines_in(landed, every.limit(1))
        assert re.search(r"PartitionFilters: \[[^\]]*masa#", some._jdf.queryExecution().executedPlan().toString())
        assert 0 < _files_read(some) < _files_read(lines_in(landed, every))
        assert 0 < some.count() < landed.count()
        # Loan 4 was borrowed in another semester.
        wanted = campus[name].filter("peminjaman_id <> 4") if name == "detail_peminjaman" else campus[name]
        assert rows(lines_in(landed, every)) == rows(wanted)
        # Tables that were not landed by semester are read whole.
        assert lines_in(campus[name], every.limit(1)) is campus[name]


def test_lines_that_arrive_before_their_transcript(spark, campus, table, tmp_path):
    first, second = str(tmp_path / "a"), str(tmp_path / "b")
    lines = table("detail_nilai", (70, "K70", "C1", dec("2.00"), "C", "Lulus"))
    land(first, {**campus, "detail_nilai": lines})
    land(second, {"hasil_studi": table("hasil_studi", ("K70", "S1", "2029/2030", "Ganjil", None)),
                  "detail_nilai": table("detail_nilai", (71, "K1", "C2", dec("3.00"), "B", "Lulus"))}, campus)
    landed = read_landing(spark, first, {"hasil_studi": [second], "detail_nilai": [second]})
    term = spark.createDataFrame([("2029/2030", "Ganjil")], "tahun_akademik STRING, semester STRING")
    assert rows(lines_in(landed["detail_nilai"], term), "detail_id") == [(70,)]
    known = spark.createDataFrame([("2020/2021", "Ganjil")], "tahun_akademik STRING, semester STRING")
    assert rows(lines_in(landed["detail_nilai"], known), "detail_id") == [(70,), (71,)]


def test_a_night_from_landed_lines_equals_one_from_whole_tables(spark, campus, later, tmp_path):
    nights = []
    for name, given in (("whole", later), ("landed", None)):
        if given is None:
            land(str(tmp_path / "landing"), later)
            given = read_landing(spark, str(tmp_path / "landing"))
        root = str(tmp_path / name)
        runs.initial_run(spark, root, campus)
        nights.append(_contents(runs.incremental_run(spark, root, given)))
    assert nights[0] == nights[1]


def test_library_views_by_name(spark, campus, tmp_path):
    warehouse = runs.initial_run(spark, str(tmp_path), campus)
    runs.refresh_dashboard(warehouse)
    runs.register_views(spark, warehouse, campus)
    assert spark.sql("SELECT * FROM ringkasan_anggota").count() == campus["anggota"].count()
    assert spark.sql("SELECT * FROM stok_buku").count() == campus["buku"].count()


def _shuffle_files(spark) -> set[str]:
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = manager.getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def test_shuffle_files_go_with_their_action(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = _shuffle_files(spark), spark.conf.get(key)
    with session.temporary(spark):
        kept = spark.range(5000).repartition(3, "id")
        assert kept.groupBy((F.col("id") % 7).alias("k")).count().count() == 7
        # A frame that is asked again computes its shuffle again.
        assert [kept.count(), kept.count(), len(kept.collect()), len(kept.collect())] == [5000] * 4
        for _ in range(60):
            if not _shuffle_files(spark) - before:
                break
            time.sleep(0.5)
        assert not _shuffle_files(spark) - before
    assert spark.conf.get(key) == setting
    with pytest.raises(ZeroDivisionError), session.tidy(spark):
        raise ZeroDivisionError
    assert spark.conf.get(key) == setting


def test_landing_keeps_no_second_copy(spark, tmp_path, monkeypatch):
    """The landed files are all that is left of the tables once they have landed, and every row is in one of them."""
    from semesta import queries
    from tests.test_plans import _raw_folder

    folder = _raw_folder(
        spark, tmp_path / "raw", customer=[(i, f"c{i}", 0, 1.0, "BUILDING") for i in range(40)], nation=[(0, "N", 0)]
    )
    campus, before, landed = queries.Campus(spark, folder), set(_scratch(spark)), {}
    monkeypatch.setattr(queries.runs, "initial_run", lambda spark, root, sources: landed.update(sources))
    monkeypatch.setattr(queries, "_summary", lambda warehouse: None)
    queries._landing_load(campus)
    assert set(_scratch(spark)) == before
    assert rows(landed["mahasiswa"]) == rows(campus.sources["mahasiswa"]) and landed["mahasiswa"].count() == 40


def test_grades_are_derived_once_for_landing(spark, tmp_path, monkeypatch):
    from semesta import queries
    from tests.test_plans import _raw_folder

    class Landed(Exception):
        pass

    def land(folder, tables):
        given.update(tables)
        assert "Join" not in tables["detail_nilai"]._jdf.queryExecution().optimizedPlan().toString()
        raise Landed

    given, folder = {}, _raw_folder(spark, tmp_path / "raw")
    monkeypatch.setattr(queries.runs, "incremental_run", lambda *args: Warehouse(spark, str(tmp_path / "dw")))
    monkeypatch.setattr(queries, "land", land)
    before = set(_scratch(spark))
    with pytest.raises(Landed):
        queries._second_night(queries.Campus(spark, folder))
    assert set(given) == set(SOURCES) and set(_scratch(spark)) == before
