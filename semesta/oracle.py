"""The expected results in DuckDB SQL over the driver's tables.

Written in the plainest form, without the rewrites of the Spark plans: joins fan out, ranks are plain
windows, subtotals are plain ROLLUP and CUBE. Grades and GPAs are kept in integer hundredths.
"""

from __future__ import annotations

import re


def _year(day: str) -> str:
    half_later = f"year(({day})::DATE + INTERVAL 6 MONTH)"
    return f"(({half_later} - 1)::VARCHAR || '/' || {half_later}::VARCHAR)"


def _term(day: str) -> str:
    return f"CASE WHEN quarter(({day})::DATE) <= 2 THEN 'Genap' ELSE 'Ganjil' END"


def _half_up(numerator: str, denominator: str) -> str:
    return f"((2 * ({numerator}) + ({denominator})) // (2 * ({denominator})))"


def _places(hundredths: str) -> str:
    return f"({hundredths})::DOUBLE / 100.0::DOUBLE"


def _mean(value: str) -> str:
    return _places(_half_up(f"sum({value})", f"nullif(count({value}), 0)"))


def _percent(part: str, whole: str) -> str:
    return _half_up(f"10000 * {part}", whole)


CUT = "DATE '2000-07-01'"
LOAN_DAY = "(o_orderdate::DATE + 170)"
RETURNED = f"""(CASE o_orderstatus WHEN 'P' THEN {LOAN_DAY} + (o_orderkey % 15)::INT
    WHEN 'F' THEN {LOAN_DAY} + (15 + o_orderkey % 7)::INT END)"""
IN_TIME = f"o_orderdate::DATE < {CUT} AND o_orderpriority <> '5-LOW'"
ORDINAL = "CASE {0} WHEN 'Ganjil' THEN 1 WHEN 'Genap' THEN 2 END"


def _transcripts(where: str = "true") -> str:
    return f"""SELECT o_orderkey::VARCHAR AS khs_id, o_custkey::VARCHAR AS nim,
        {_year('o_orderdate')} AS tahun_akademik, {_term('o_orderdate')} AS semester
    FROM orders WHERE {where}"""


def _grades(where: str = "true") -> str:
    return f"""SELECT nim, tahun_akademik, semester, l_partkey::VARCHAR AS mata_kuliah_id,
        min(khs) AS khs, (8 * max(l_quantity))::BIGINT AS nilai, max(l_quantity) >= 25 AS lulus
    FROM lineitem JOIN (SELECT o_orderkey AS khs, o_custkey::VARCHAR AS nim, {_year('o_orderdate')} AS tahun_akademik,
        {_term('o_orderdate')} AS semester FROM orders WHERE {where}) ON l_orderkey = khs
    GROUP BY ALL"""


def _grade_fact(grades: str, terms: str, students: str) -> str:
    return f"""SELECT w.waktu_id, m.nim AS mahasiswa_id, k.kode_mata_kuliah AS mata_kuliah_id,
        g.nilai, g.lulus AS status_lulus, g.nilai * k.bobot_sks AS bobot
    FROM {grades} g JOIN {terms} w ON w.tahun_akademik = g.tahun_akademik AND w.semester = g.semester
    JOIN {students} m ON m.nim = g.nim JOIN dim_mata_kuliah k ON k.kode_mata_kuliah = g.mata_kuliah_id"""


def _gpa_fact(fact: str, students: str) -> str:
    return f"""SELECT waktu_id, program_studi_id, mahasiswa_id, {_half_up('sum(bobot)', 'sum(bobot_sks)')}::BIGINT AS ip,
        sum(bobot_sks)::BIGINT AS total_sks, count(*) AS jumlah_mata_kuliah
    FROM {fact} JOIN {students} ON nim = mahasiswa_id JOIN dim_mata_kuliah ON kode_mata_kuliah = mata_kuliah_id
    GROUP BY waktu_id, program_studi_id, mahasiswa_id"""


def _loan_fact(loans: str, terms: str, students: str) -> str:
    borrowed = f"""SELECT peminjaman_id, anggota_id, {_year('tgl_pinjam')} AS tahun_akademik, {_term('tgl_pinjam')} AS semester,
        (SELECT sum(total_denda) FROM denda WHERE denda.peminjaman_id = l.peminjaman_id) AS fine FROM {loans} l"""
    shelved = "SELECT peminjaman_id, buku_id, kategori_id FROM detail_peminjaman JOIN buku USING (buku_id)"
    return f"""SELECT waktu_id, nim AS mahasiswa_id, kategori_id, count(DISTINCT peminjaman_id) AS total_peminjaman,
        coalesce(sum(fine), 0)::BIGINT AS jumlah_denda, count(DISTINCT buku_id) AS jumlah_buku
    FROM ({borrowed}) JOIN ({shelved}) USING (peminjaman_id) JOIN {terms} USING (tahun_akademik, semester)
    JOIN (SELECT anggota_id, nim FROM anggota WHERE nim IN (SELECT nim FROM {students})) USING (anggota_id)
    GROUP BY waktu_id, nim, kategori_id"""


def _terms(transcripts: str) -> str:
    return f"""SELECT DISTINCT tahun_akademik || ' ' || semester AS waktu_id, tahun_akademik, semester
    FROM {transcripts} WHERE tahun_akademik IS NOT NULL AND semester IS NOT NULL"""


def _students(customers: str, gender: str) -> str:
    return f"""SELECT c_custkey::VARCHAR AS nim, c_name AS nama, {gender} AS jenis_kelamin, 1994 + c_custkey % 6 AS angkatan
    FROM {customers}"""


FULL_GENDER = "if(c_custkey % 5 < 2, 'Perempuan', 'Laki-laki')"

TABLES = {
    # Operational tables
    "program_studi": """SELECT n_nationkey + 1 AS program_studi_id,
        CASE n_regionkey WHEN 0 THEN 'S2' WHEN 1 THEN 'D4' ELSE 'S1' END AS jenjang, n_name AS nama_program_studi,
        if(n_nationkey % 3 = 0, 'Internasional', 'Reguler') AS kelas, n_regionkey FROM nation""",
    "mahasiswa": "SELECT c_custkey::VARCHAR AS nim, c_nationkey + 1 AS program_studi_id FROM customer",
    "old_mahasiswa": """SELECT c_custkey::VARCHAR AS nim, c_nationkey + 1 AS program_studi_id FROM customer
        WHERE c_mktsegment <> 'MACHINERY'""",
    "hasil_studi": _transcripts(),
    "old_hasil_studi": _transcripts(IN_TIME),
    "detail_nilai": _grades(),
    "old_detail_nilai": _grades(IN_TIME),
    "kategori_buku": """SELECT row_number() OVER (ORDER BY p_type) AS kategori_id, p_type AS nama_kategori
        FROM (SELECT DISTINCT p_type FROM part)""",
    "buku": """SELECT p_partkey::VARCHAR AS buku_id, p_name AS judul, p_brand AS penulis, kategori_id, p_size
        FROM part JOIN kategori_buku ON nama_kategori = p_type""",
    "eksemplar_buku": """SELECT l_partkey || '-' || l_suppkey AS eksemplar_id, l_partkey::VARCHAR AS buku_id,
        if(count(*) FILTER (l_linestatus <> 'O') = 0, 'N', 'Y') AS tersedia, max(l_returnflag) AS worst
        FROM lineitem GROUP BY l_partkey, l_suppkey""",
    "anggota": """SELECT 'A' || c_custkey AS anggota_id, c_custkey::VARCHAR AS nim, c_name AS nama_lengkap,
        if(c_acctbal < 0, 'N', 'Y') AS status_aktif FROM customer""",
    "kunjungan": """SELECT min(event_id) AS kunjungan_id, 'A' || user_id AS anggota_id, ts::DATE AS tanggal
        FROM events GROUP BY user_id, ts::DATE""",
    "peminjaman": f"""SELECT o_orderkey AS peminjaman_id, 'A' || o_custkey AS anggota_id, {LOAN_DAY} AS tgl_pinjam,
        {RETURNED} AS tgl_kembali_aktual FROM orders""",
    "old_peminjaman": f"SELECT * FROM peminjaman WHERE tgl_pinjam < {CUT}",
    "detail_peminjaman": """SELECT l_orderkey AS peminjaman_id, l_partkey::VARCHAR AS buku_id,
        l_partkey || '-' || l_suppkey AS eksemplar_id FROM lineitem""",
    "denda": f"""SELECT o_orderkey AS peminjaman_id, 1 + o_orderkey % 7 AS hari_keterlambatan,
        1000 * (1 + o_orderkey % 7) AS total_denda,
        CASE o_orderkey % 4 WHEN 0 THEN 'Belum Dibayar' WHEN 1 THEN 'Dihapuskan' ELSE 'Lunas' END AS status_pembayaran,
        if(o_orderkey % 4 >= 2, {RETURNED} + 10, NULL) AS tgl_bayar FROM orders WHERE o_orderstatus = 'F'""",
    # Dimensions
    "dim_waktu": _terms("hasil_studi"),
    "old_dim_waktu": _terms("old_hasil_studi"),
    "dim_mahasiswa": _students("customer", FULL_GENDER),
    "old_dim_mahasiswa": _students("(FROM customer WHERE c_mktsegment <> 'MACHINERY')", FULL_GENDER),
    "dim_mata_kuliah": """SELECT p_partkey::VARCHAR AS kode_mata_kuliah, p_name AS nama_mata_kuliah,
        (1 + p_size % 4)::BIGINT AS bobot_sks, 'Wajib' AS jenis_mata_kuliah, p_type FROM part""",
    "dim_kategori_buku": "SELECT kategori_id, nama_kategori, 'Kategori: ' || nama_kategori AS deskripsi FROM kategori_buku",
    "known_dim_waktu": f"SELECT DISTINCT tahun_akademik, semester FROM ({_transcripts(f'o_orderdate::DATE < {CUT}')})",
    "known_dim_mahasiswa": f"""SELECT c_custkey::VARCHAR AS nim, if(c_mktsegment = 'BUILDING', 'Old ' || c_name, c_name) AS nama,
        {FULL_GENDER} AS jenis_kelamin, 1994 + c_custkey % 6 + (c_mktsegment = 'BUILDING')::INT AS angkatan
        FROM customer WHERE c_mktsegment <> 'MACHINERY'""",
    # Facts
    "fact_detail_nilai": _grade_fact("detail_nilai", "dim_waktu", "dim_mahasiswa"),
    "old_fact_detail_nilai": _grade_fact("old_detail_nilai", "old_dim_waktu", "old_dim_mahasiswa"),
    "fact_rekap_ip": _gpa_fact("fact_detail_nilai", "mahasiswa"),
    "old_fact_rekap_ip": _gpa_fact("old_fact_detail_nilai", "old_mahasiswa"),
    "fact_rekap_pinjam": _loan_fact("peminjaman", "dim_waktu", "dim_mahasiswa"),
    "old_fact_rekap_pinjam": _loan_fact("old_peminjaman", "old_dim_waktu", "old_dim_mahasiswa"),
    # Incremental load
    "watermark": f"""SELECT tahun_akademik, semester FROM old_dim_waktu
        WHERE waktu_id IN (SELECT waktu_id FROM old_fact_detail_nilai)
        ORDER BY tahun_akademik DESC, {ORDINAL.format('semester')} DESC NULLS FIRST LIMIT 1""",
    "later": f"""SELECT w.* FROM dim_waktu w, watermark v WHERE w.tahun_akademik > v.tahun_akademik
        OR (w.tahun_akademik = v.tahun_akademik AND {ORDINAL.format('w.semester')} > {ORDINAL.format('v.semester')})""",
    "new_fact_detail_nilai": _grade_fact("detail_nilai", "later", "dim_mahasiswa"),
    "new_fact_rekap_ip": f"""SELECT * FROM ({_gpa_fact('new_fact_detail_nilai', 'mahasiswa')}) n WHERE NOT EXISTS (
        SELECT 1 FROM old_fact_rekap_ip o WHERE o.waktu_id = n.waktu_id AND o.mahasiswa_id = n.mahasiswa_id)""",
    "after_fact_detail_nilai": "SELECT * FROM old_fact_detail_nilai UNION ALL SELECT * FROM new_fact_detail_nilai",
    "after_fact_rekap_ip": "SELECT * FROM old_fact_rekap_ip UNION ALL SELECT * FROM new_fact_rekap_ip",
    "touched": f"""SELECT tgl_pinjam FROM peminjaman WHERE greatest(tgl_pinjam, tgl_kembali_aktual) >= {CUT}
        UNION ALL SELECT tgl_pinjam FROM peminjaman WHERE peminjaman_id IN (SELECT peminjaman_id FROM denda WHERE tgl_bayar >= {CUT})""",
    "impacted": f"""SELECT * FROM dim_waktu WHERE (tahun_akademik, semester) IN
        (SELECT ({_year('tgl_pinjam')}, {_term('tgl_pinjam')}) FROM touched)""",
    "kept": "SELECT * FROM old_fact_rekap_pinjam WHERE waktu_id NOT IN (SELECT waktu_id FROM impacted)",
    "rebuilt": "SELECT * FROM fact_rekap_pinjam WHERE waktu_id IN (SELECT waktu_id FROM impacted)",
    # Per student and semester: GPA next to what was borrowed
    "lending": """SELECT i.waktu_id, i.mahasiswa_id, i.ip, coalesce(sum(p.total_peminjaman), 0) AS loans,
        coalesce(sum(p.jumlah_denda), 0) AS fines FROM fact_rekap_ip i
        LEFT JOIN fact_rekap_pinjam p ON p.mahasiswa_id = i.mahasiswa_id AND p.waktu_id = i.waktu_id
        GROUP BY i.waktu_id, i.mahasiswa_id, i.ip""",
    # Run history
    "run_log": """SELECT event_id AS log_id, CASE event_type WHEN 'click' THEN 'Build Cross Domain Facts (Daily)'
            WHEN 'view' THEN 'Load Shared Dimensions' WHEN 'purchase' THEN 'Load Data Akademik DW'
            WHEN 'signup' THEN 'Load Data Perpustakaan Dimensi' WHEN 'error' THEN 'Refresh Semua Dashboard DW' END AS nama_proses,
        ts AS waktu_mulai, if(value < 5, NULL, ts + to_microseconds(round(value * 1000000)::BIGINT)) AS waktu_selesai,
        if(value < 5, NULL, (round(value * 1000000)::BIGINT + 500000) // 1000000) AS durasi_detik,
        CASE WHEN value < 5 THEN 'RUNNING' WHEN value > 100 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
        if(value > 100, props, NULL) AS pesan_error FROM events""",
    # Marts the top-ten reports read
    "failures": f"""SELECT kode_mata_kuliah, nama_mata_kuliah, count(mahasiswa_id) AS total_mahasiswa_mengambil,
        count(*) FILTER (NOT status_lulus) AS total_tidak_lulus,
        {_percent('count(*) FILTER (NOT status_lulus)', 'count(mahasiswa_id)')} AS share
        FROM fact_detail_nilai JOIN dim_mata_kuliah ON kode_mata_kuliah = mata_kuliah_id GROUP BY 1, 2""",
    "ranked_failures": f"""SELECT kode_mata_kuliah, nama_mata_kuliah, total_mahasiswa_mengambil, total_tidak_lulus,
        {_places('share')} AS persentase_tidak_lulus, dense_rank() OVER (ORDER BY share DESC) AS peringkat_kritis FROM failures""",
    "critical": f"""SELECT angkatan, nama_mata_kuliah, jenis_mata_kuliah, count(mahasiswa_id) AS total_pengambil,
        count(*) FILTER (NOT status_lulus) AS total_gagal,
        {_percent('count(*) FILTER (NOT status_lulus)', 'count(mahasiswa_id)')} AS share
        FROM fact_detail_nilai JOIN dim_mata_kuliah ON kode_mata_kuliah = mata_kuliah_id
        JOIN dim_mahasiswa ON nim = mahasiswa_id GROUP BY 1, 2, 3 HAVING count(mahasiswa_id) > 10""",
    "ranked_critical": f"""SELECT angkatan, nama_mata_kuliah, jenis_mata_kuliah, total_pengambil, total_gagal,
        {_places('share')} AS persen_gagal, row_number() OVER (PARTITION BY angkatan
            ORDER BY share DESC, nama_mata_kuliah, jenis_mata_kuliah) AS ranking_matkul_kritis_angkatan FROM critical""",
    # Operational tables whose codes, numbers, dates and defaults are broken, before the other rules are
    "r_mata_kuliah": "SELECT p_partkey::VARCHAR AS mata_kuliah_id, p_name AS nama_mata_kuliah FROM part",
    "r_mahasiswa": """SELECT c_custkey::VARCHAR AS nim, c_nationkey + 1 AS program_studi_id,
        c_name AS nama_lengkap, if(c_custkey % 5 < 2, 'P', 'L') AS jenis_kelamin FROM customer""",
    "r_detail_nilai": """SELECT row_number() OVER () AS detail_id, l_orderkey::VARCHAR AS khs_id, l_partkey::VARCHAR AS mata_kuliah_id,
        NULL::VARCHAR AS nilai_huruf, if(l_quantity >= 25, 'Lulus', 'Tidak Lulus') AS status_lulus
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey""",
    "r_kategori_buku": """SELECT kategori_id, nullif(nama_kategori, 'PROMO') AS nama_kategori, NULL::VARCHAR AS kode_ddc
        FROM kategori_buku""",
    "r_buku": """SELECT buku_id, judul AS isbn, judul, if(p_size < 50, penulis, NULL) AS penulis, penulis AS penerbit, kategori_id,
        1875 + p_size AS tahun_terbit FROM buku""",
    "r_eksemplar_buku": """SELECT eksemplar_id, buku_id, tersedia,
        CASE worst WHEN 'R' THEN 'Baik' WHEN 'A' THEN 'Sobek' END AS kondisi FROM eksemplar_buku""",
    "r_anggota": """SELECT 'A' || c_custkey AS anggota_id, if(c_mktsegment = 'FURNITURE', 'X', '') || c_custkey AS nim,
        c_name AS nama_lengkap, if(c_custkey % 5 < 2, 'P', 'L') AS jenis_kelamin,
        DATE '1994-01-01' + (c_custkey % 365)::INT AS tgl_daftar,
        DATE '1994-01-01' + (c_custkey % 365)::INT + floor(c_acctbal)::INT AS tgl_expired,
        CASE WHEN c_acctbal > 9000 THEN 'T' WHEN c_acctbal >= 0 THEN 'Y' END AS status_aktif FROM customer""",
    "r_kunjungan": """SELECT event_id AS kunjungan_id, if(event_type = 'error', 'E', 'A') || user_id AS anggota_id,
        ts::DATE AS tanggal, strftime(ts, '%H:%M:%S') AS jam_masuk, floor(value)::BIGINT AS durasi_menit FROM events""",
    "r_peminjaman": f"""SELECT o_orderkey AS peminjaman_id, 'A' || o_custkey AS anggota_id, {LOAN_DAY} AS tgl_pinjam,
        {LOAN_DAY} + 14 AS tgl_kembali_rencana, {LOAN_DAY} + (o_orderkey % 20 - 3)::INT AS tgl_kembali_aktual,
        CASE WHEN o_orderpriority = '5-LOW' THEN 'Diproses' WHEN o_orderstatus <> 'O' THEN 'Dikembalikan' END AS status,
        o_orderpriority AS petugas_id FROM orders""",
    "r_detail_peminjaman": """SELECT row_number() OVER () AS detail_id, l_orderkey AS peminjaman_id, l_partkey::VARCHAR AS buku_id,
        if(l_linenumber = 7, '?' || l_suppkey, l_partkey || '-' || l_suppkey) AS eksemplar_id FROM lineitem""",
    "r_denda": """SELECT o_orderkey AS denda_id, o_custkey AS peminjaman_id, o_orderkey % 7 AS hari_keterlambatan,
        1000 * (o_orderkey % 7) AS total_denda,
        CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'Dihapuskan' ELSE 'Lunas' END AS status_pembayaran
        FROM orders WHERE o_orderstatus = 'F'""",
    "r_dim_mahasiswa": "SELECT *, nim AS mahasiswa_id FROM dim_mahasiswa",
    "r_dim_mata_kuliah": "SELECT *, kode_mata_kuliah AS mata_kuliah_id FROM dim_mata_kuliah",
    "r_fact_detail_nilai": f"""SELECT {_year('o_orderdate')} || ' ' || {_term('o_orderdate')} AS waktu_id,
        o_custkey::VARCHAR AS mahasiswa_id, p_partkey::VARCHAR AS mata_kuliah_id
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
        JOIN part ON p_partkey = l_partkey""",
}

GRADE_COLUMNS = f"waktu_id, mahasiswa_id, mata_kuliah_id, {_places('nilai')} AS nilai_angka, status_lulus, {_places('bobot')} AS bobot_nilai"
GPA_COLUMNS = f"waktu_id, program_studi_id::BIGINT AS program_studi_id, mahasiswa_id, {_places('ip')} AS ip_semester, total_sks, jumlah_mata_kuliah"
LOAN_COLUMNS = "waktu_id, mahasiswa_id, kategori_id, total_peminjaman, jumlah_denda, jumlah_buku"
PROGRAMME_COLUMNS = "program_studi_id::BIGINT AS program_studi_id, jenjang, nama_program_studi, kelas"
COURSE_COLUMNS = "kode_mata_kuliah, nama_mata_kuliah, bobot_sks, jenis_mata_kuliah"


def _report(rows: list[tuple[str, str, str]]) -> str:
    """(table, rule, query of the violating rows) as one report."""
    return " UNION ALL ".join(
        f"SELECT '{table}' AS tabel, '{rule}' AS aturan, count(*) AS pelanggaran FROM ({query}) AS r" for table, rule, query in rows
    )


def _breaks(table: str, rule: str, condition: str, rows: str | None = None) -> tuple[str, str, str]:
    return table, rule, f"SELECT 1 FROM {rows or 'f_' + table} WHERE {condition}"


def _nulls(table: str, columns: str, rows: str) -> list[tuple[str, str, str]]:
    return [_breaks(table, f"{c} not null", f"{c} IS NULL", rows) for c in columns.split()]


def _repeats(table: str, key: str, rows: str) -> tuple[str, str, str]:
    present = " AND ".join(f"{c} IS NOT NULL" for c in key.split(", "))
    return table, f"{key} unique", f"SELECT {key} FROM {rows} WHERE {present} GROUP BY {key} HAVING count(*) > 1"


def _orphans(table: str, column: str, parent: str, rows: str, parent_rows: str, parent_column: str | None = None) -> tuple[str, str, str]:
    return (
        table,
        f"{column} in {parent}",
        f"SELECT 1 FROM {rows} c WHERE c.{column} IS NOT NULL AND NOT EXISTS "
        f"(SELECT 1 FROM {parent_rows} p WHERE p.{parent_column or column} = c.{column})",
    )


# Required columns, declared text lengths and references of each table. A table's rows, the number by which
# a row breaks one rule of it, required columns, lengths, references with their parents, and dates.
RULES = {
    "program_studi": ("program_studi", "program_studi_id", "program_studi_id",
                      {"jenjang": 5, "nama_program_studi": 100, "kelas": 20}, {}, ""),
    "mata_kuliah": ("r_mata_kuliah", "mata_kuliah_id", "mata_kuliah_id", {"mata_kuliah_id": 10, "nama_mata_kuliah": 150}, {}, ""),
    "mahasiswa": ("r_mahasiswa", "nim", "nim", {"nim": 20, "nama_lengkap": 100, "jenis_kelamin": 1},
                  {"program_studi_id": "program_studi"}, ""),
    "hasil_studi": ("hasil_studi", "khs_id", "khs_id", {"khs_id": 20, "nim": 20, "tahun_akademik": 10, "semester": 10},
                    {"nim": "mahasiswa"}, ""),
    "detail_nilai": ("r_detail_nilai", "khs_id + mata_kuliah_id", "detail_id",
                     {"khs_id": 20, "mata_kuliah_id": 10, "nilai_huruf": 5, "status_lulus": 15},
                     {"khs_id": "hasil_studi", "mata_kuliah_id": "mata_kuliah"}, ""),
    "kategori_buku": ("r_kategori_buku", "kategori_id", "kategori_id nama_kategori", {"nama_kategori": 60, "kode_ddc": 20}, {}, ""),
    "buku": ("r_buku", "buku_id", "buku_id judul penulis kategori_id",
             {"buku_id": 8, "isbn": 20, "judul": 200, "penulis": 100, "penerbit": 80}, {"kategori_id": "kategori_buku"}, ""),
    "eksemplar_buku": ("r_eksemplar_buku", "buku_id", "eksemplar_id buku_id kondisi tersedia",
                       {"eksemplar_id": 10, "buku_id": 8, "kondisi": 15, "tersedia": 1}, {"buku_id": "buku"}, ""),
    "anggota": ("r_anggota", "substr(anggota_id, 2)", "anggota_id nim nama_lengkap jenis_kelamin tgl_daftar tgl_expired status_aktif",
                {"anggota_id": 25, "nim": 20, "nama_lengkap": 100, "jenis_kelamin": 1, "status_aktif": 1}, {}, "tgl_expired"),
    "kunjungan": ("r_kunjungan", "kunjungan_id", "kunjungan_id anggota_id tanggal jam_masuk durasi_menit", {"anggota_id": 25},
                  {"anggota_id": "anggota"}, ""),
    "peminjaman": ("r_peminjaman", "peminjaman_id", "peminjaman_id anggota_id tgl_pinjam tgl_kembali_rencana status petugas_id",
                   {"anggota_id": 25, "status": 15, "petugas_id": 10}, {"anggota_id": "anggota"},
                   "tgl_kembali_rencana tgl_kembali_aktual"),
    "detail_peminjaman": ("r_detail_peminjaman", "peminjaman_id + buku_id", "detail_id peminjaman_id buku_id eksemplar_id",
                          {"buku_id": 8, "eksemplar_id": 10},
                          {"peminjaman_id": "peminjaman", "buku_id": "buku", "eksemplar_id": "eksemplar_buku"}, ""),
    "denda": ("r_denda", "denda_id", "denda_id peminjaman_id hari_keterlambatan total_denda status_pembayaran",
              {"status_pembayaran": 15}, {"peminjaman_id": "peminjaman"}, ""),
    "dim_waktu": ("dim_waktu", "left(tahun_akademik, 4)::BIGINT * 2 + length(semester) % 2", "waktu_id tahun_akademik semester",
                  {"tahun_akademik": 20, "semester": 10}, {}, ""),
    "dim_mahasiswa": ("r_dim_mahasiswa", "nim", "mahasiswa_id nim nama jenis_kelamin angkatan",
                      {"nim": 20, "nama": 150, "jenis_kelamin": 15}, {}, ""),
    "dim_program_studi": ("program_studi", "program_studi_id", "program_studi_id jenjang nama_program_studi kelas",
                          {"jenjang": 10, "nama_program_studi": 100, "kelas": 20}, {}, ""),
    "dim_mata_kuliah": ("r_dim_mata_kuliah", "kode_mata_kuliah",
                        "mata_kuliah_id kode_mata_kuliah nama_mata_kuliah bobot_sks jenis_mata_kuliah",
                        {"kode_mata_kuliah": 20, "nama_mata_kuliah": 150, "jenis_mata_kuliah": 20}, {}, ""),
    "dim_kategori_buku": ("dim_kategori_buku", "kategori_id", "kategori_id nama_kategori", {"nama_kategori": 100}, {}, ""),
    "fact_detail_nilai": ("r_fact_detail_nilai", "mahasiswa_id + mata_kuliah_id", "waktu_id mahasiswa_id mata_kuliah_id", {},
                          {"waktu_id": "dim_waktu", "mahasiswa_id": "dim_mahasiswa", "mata_kuliah_id": "dim_mata_kuliah"}, ""),
    "fact_rekap_ip": ("fact_rekap_ip", "mahasiswa_id", "waktu_id mahasiswa_id program_studi_id", {},
                      {"waktu_id": "dim_waktu", "program_studi_id": "dim_program_studi", "mahasiswa_id": "dim_mahasiswa"}, ""),
    "fact_rekap_pinjam": ("fact_rekap_pinjam", "mahasiswa_id + kategori_id", "waktu_id mahasiswa_id kategori_id", {},
                          {"waktu_id": "dim_waktu", "mahasiswa_id": "dim_mahasiswa", "kategori_id": "dim_kategori_buku"}, ""),
}
NUMBERS = {"program_studi_id", "kategori_id", "peminjaman_id"}


def _flawed(rows: str, number: str, required: str, lengths: dict[str, int], references: dict[str, str], dates: str) -> str:
    """Rows of a table, each of which breaks one of its rules: see FIXTURES.md."""
    breaks = [
        *((c, "NULL") for c in required.split()),
        *((c, f"rpad(coalesce({c}, ''), {most + 1}, 'x')") for c, most in lengths.items()),
        *((c, f"-1 - {c}" if c in NUMBERS else f"'?' || {c}") for c in references),
        *((c, "DATE '1900-01-01'") for c in dates.split()),
    ]
    columns = ", ".join(
        f"CASE {' '.join(f'WHEN slot = {i} THEN {value}' for i, (c, value) in enumerate(breaks) if c == column)} ELSE {column} END AS {column}"
        for column in dict.fromkeys(c for c, _ in breaks)
    )
    whole = " + ".join(f"({part})::BIGINT" for part in number.split(" + "))
    return f"""SELECT * REPLACE ({columns}) FROM (SELECT *, ({whole}) % {len(breaks) + 2} AS slot FROM {rows})
    JOIN (VALUES (1), (2)) copies(number) ON number = 1 OR slot = {len(breaks)}"""


TABLES |= {f"f_{table}": _flawed(*rule) for table, rule in RULES.items()}

NOT_NULL = [row for table, rule in RULES.items() for row in _nulls(table, rule[2], f"f_{table}")]

LENGTHS = [
    _breaks(table, f"{column} length", f"length({column}) > {most}")
    for table, rule in RULES.items()
    for column, most in rule[3].items()
]

DOMAINS = [
    _breaks("eksemplar_buku", "kondisi domain", "kondisi NOT IN ('Baik', 'Rusak Ringan', 'Rusak Berat')"),
    _breaks("eksemplar_buku", "tersedia domain", "tersedia NOT IN ('Y', 'N')"),
    _breaks("anggota", "jenis_kelamin domain", "jenis_kelamin NOT IN ('L', 'P')"),
    _breaks("anggota", "status_aktif domain", "status_aktif NOT IN ('Y', 'N')"),
    _breaks("peminjaman", "status domain", "status NOT IN ('Dipinjam', 'Dikembalikan', 'Hilang')"),
    _breaks("denda", "status_pembayaran domain", "status_pembayaran NOT IN ('Lunas', 'Belum Dibayar', 'Dihapuskan')"),
]

RANGES = [
    _breaks("buku", "tahun_terbit range", "tahun_terbit < 1900 OR tahun_terbit > 2099"),
    _breaks("kunjungan", "durasi_menit range", "durasi_menit <= 0"),
    _breaks("denda", "hari_keterlambatan range", "hari_keterlambatan <= 0"),
    _breaks("denda", "total_denda range", "total_denda <= 0"),
]

DATE_ORDER = [
    _breaks("anggota", "tgl_expired order", "tgl_expired <= tgl_daftar"),
    _breaks("peminjaman", "tgl_kembali_rencana order", "tgl_kembali_rencana < tgl_pinjam"),
    _breaks("peminjaman", "tgl_kembali_aktual order", "tgl_kembali_aktual < tgl_pinjam"),
]

DEFAULTS = [
    _breaks("eksemplar_buku", "kondisi default", "kondisi IS NULL"),
    _breaks("eksemplar_buku", "tersedia default", "tersedia IS NULL"),
    _breaks("anggota", "status_aktif default", "status_aktif IS NULL"),
    _breaks("peminjaman", "status default", "status IS NULL"),
    _breaks("denda", "status_pembayaran default", "status_pembayaran IS NULL"),
]

# Keys, and the column a parent is known by here where it has another name.
KEYS = {
    "program_studi": ["program_studi_id"], "mata_kuliah": ["mata_kuliah_id"], "mahasiswa": ["nim"], "hasil_studi": ["khs_id"],
    "detail_nilai": ["detail_id"], "kategori_buku": ["kategori_id"], "buku": ["buku_id", "isbn"],
    "eksemplar_buku": ["eksemplar_id"], "anggota": ["anggota_id", "nim"], "kunjungan": ["kunjungan_id", "anggota_id, tanggal"],
    "peminjaman": ["peminjaman_id"], "detail_peminjaman": ["detail_id"], "denda": ["denda_id", "peminjaman_id"],
    "dim_waktu": ["waktu_id"], "dim_mahasiswa": ["mahasiswa_id", "nim"], "dim_program_studi": ["program_studi_id"],
    "dim_mata_kuliah": ["mata_kuliah_id", "kode_mata_kuliah"], "dim_kategori_buku": ["kategori_id"],
    "fact_detail_nilai": ["waktu_id, mahasiswa_id, mata_kuliah_id"], "fact_rekap_ip": ["waktu_id, mahasiswa_id"],
    "fact_rekap_pinjam": ["waktu_id, mahasiswa_id, kategori_id"],
}
UNIQUE = [_repeats(table, key, f"f_{table}") for table, keys in KEYS.items() for key in keys]

REFERENCES = [
    _orphans(table, column, parent, f"f_{table}", f"f_{parent}")
    for table, rule in RULES.items()
    for column, parent in rule[4].items()
]

COUNTED = {
    "program_studi": "program_studi", "mata_kuliah": "dim_mata_kuliah", "mahasiswa": "mahasiswa",
    "hasil_studi": "hasil_studi", "detail_nilai": "detail_nilai", "kategori_buku": "kategori_buku", "buku": "buku",
    "eksemplar_buku": "eksemplar_buku", "anggota": "anggota", "kunjungan": "kunjungan", "peminjaman": "peminjaman",
    "detail_peminjaman": "detail_peminjaman", "denda": "denda", "dim_waktu": "dim_waktu", "dim_mahasiswa": "dim_mahasiswa",
    "dim_program_studi": "program_studi", "dim_mata_kuliah": "dim_mata_kuliah", "dim_kategori_buku": "dim_kategori_buku",
    "fact_detail_nilai": "after_fact_detail_nilai", "fact_rekap_ip": "after_fact_rekap_ip", "fact_rekap_pinjam": "fact_rekap_pinjam",
}
SENT = {
    "dim_program_studi": "program_studi", "dim_mahasiswa": "mahasiswa", "dim_mata_kuliah": "dim_mata_kuliah",
    "dim_kategori_buku": "kategori_buku", "fact_detail_nilai": "detail_nilai", "fact_rekap_ip": "hasil_studi",
}


def _counts() -> str:
    def row(label: str, table: str) -> str:
        sent = f"(SELECT count(*) FROM {SENT[label]})" if label in SENT else "NULL::BIGINT"
        return f"SELECT '{label}' AS tabel, (SELECT count(*) FROM {table}) AS total, {sent} AS diharapkan"

    rows = " UNION ALL ".join(row(label, table) for label, table in COUNTED.items())
    return f"SELECT *, diharapkan - total AS selisih FROM ({rows})"


def _summary(grades: str, gpas: str, names: str = "dim_mahasiswa") -> str:
    whose = "(mahasiswa_id::BIGINT % 1009 + left(waktu_id, 4)::BIGINT + length(split_part(waktu_id, ' ', 2)))"
    control = {
        "dim_waktu": ("length(tahun_akademik)", "dim_waktu"),
        "dim_program_studi": ("program_studi_id", "program_studi"),
        "dim_mahasiswa": ("angkatan + length(nama) + nim::BIGINT", names),
        "dim_mata_kuliah": ("bobot_sks + kode_mata_kuliah::BIGINT", "dim_mata_kuliah"),
        "dim_kategori_buku": ("kategori_id + length(deskripsi)", "dim_kategori_buku"),
        "fact_detail_nilai": (f"{whose} * (bobot + status_lulus::INT)", grades),
        "fact_rekap_ip": (f"{whose} * (ip + total_sks + jumlah_mata_kuliah)", gpas),
        "fact_rekap_pinjam": (f"{whose} * (total_peminjaman + jumlah_denda + jumlah_buku)", "fact_rekap_pinjam"),
    }
    return " UNION ALL ".join(
        f"SELECT '{name}' AS tabel, count(*) AS total, sum({value})::BIGINT AS kontrol FROM {table}"
        for name, (value, table) in control.items()
    )


def _parts(fact: str, value: str, kept: str, rebuilt: str) -> str:
    """Rows and control total per semester of a fact: those that stayed and those that were written anew."""
    whose = "(mahasiswa_id::BIGINT % 1009 + left(waktu_id, 4)::BIGINT + length(split_part(waktu_id, ' ', 2)))"
    return " UNION ALL ".join(
        f"""SELECT '{fact}' AS tabel, split_part(waktu_id, ' ', 1) AS tahun_akademik, split_part(waktu_id, ' ', 2) AS semester,
        {stayed} AS dipertahankan, count(*) AS total, sum({whose} * ({value}))::BIGINT AS kontrol FROM {rows} GROUP BY waktu_id"""
        for stayed, rows in (("true", kept), ("false", rebuilt))
    )


def _after(query: str) -> str:
    """The same query over the facts that an incremental load leaves."""
    names = "fact_detail_nilai|fact_rekap_ip|failures|ranked_failures|critical|ranked_critical|lending"
    return re.sub(rf"\b(FROM|JOIN) ({names})\b", r"\1 after_\2", query)


# Columns of the reports: t text, n whole number, d with two decimal places.
REPORTS = {
    "tingkat_ketidaklulusan": "t kode_mata_kuliah, t nama_mata_kuliah, n peringkat_kritis, d persentase_tidak_lulus, n total_mahasiswa_mengambil, n total_tidak_lulus",
    "perbandingan_kelas": "t kelas, n populasi_mahasiswa, d rata_rata_ipk_keseluruhan",
    "kategori_buku_populer": "n frekuensi_peminjaman, t nama_kategori, n peringkat_popularitas, n total_judul_buku_unik_dipinjam",
    "korelasi_rajin_pinjam_ip": "t klasifikasi_peminjam, d rata_rata_ip_semester, n total_sampel_semester",
    "korelasi_denda_ip": "d rata_rata_ip_semester, t status_kedisiplinan_perpus, n total_sampel",
    "buku_favorit_berprestasi": "t nama_kategori, n peringkat_buku_berprestasi, n total_peminjaman",
    "gender_akademik_perpus": "t jenis_kelamin, d rata_rata_ipk, n total_akumulasi_denda_rp, n total_buku_dipinjam, n total_mahasiswa",
    "cohort_angkatan": "t angkatan, n jumlah_mahasiswa_aktif, d rata_rata_ip_angkatan, d rata_rata_sks_diambil, t semester, t tahun_akademik",
    "matkul_kritis_angkatan": "n angkatan, t jenis_mata_kuliah, t nama_mata_kuliah, d persen_gagal, n ranking_matkul_kritis_angkatan, n total_gagal, n total_pengambil",
    "tren_performa_akademik": "d rata_rata_ip_semester, t semester, t tahun_akademik, n total_mahasiswa_aktif",
    "tren_peminjaman_semester": "t semester, t tahun_akademik, n total_denda_rp, n total_transaksi_pinjam",
    "distribusi_ip": "n jumlah_mahasiswa, t kategori_ip, d persentase",
    "ringkasan_anggota": "t anggota_id, n denda_belum_bayar_rp, t nama_lengkap, t nim, t status_aktif, n total_denda_rp, n total_kunjungan, n total_peminjaman",
    "stok_buku": "t buku_id, n dipinjam, t judul, t nama_kategori, n tersedia, n total_eksemplar",
}


def _totals() -> str:
    def value(kind: str, column: str) -> str:
        weighed = {"t": f"length({column})", "n": column, "d": f"round({column} * 100)"}[kind]
        return f"coalesce({weighed}, 0)::BIGINT"

    def total(name: str, columns: str) -> str:
        pairs = [column.split(" ") for column in columns.split(", ")]
        control = " + ".join(f"{i + 1} * {value(*pair)}" for i, pair in enumerate(pairs))
        return f"SELECT '{name}' AS nama, count(*) AS total, sum({control})::BIGINT AS kontrol FROM ({_after(QUERIES[name])}) AS r"

    return " UNION ALL ".join(total(name, columns) for name, columns in REPORTS.items())


def _written() -> str:
    """(nama_proses, tabel, baris) of a full load of the first snapshot and a night after it."""
    first = {
        "dim_waktu": "old_dim_waktu", "dim_program_studi": "program_studi", "dim_mahasiswa": "old_dim_mahasiswa",
        "dim_mata_kuliah": "dim_mata_kuliah", "dim_kategori_buku": "kategori_buku", "fact_detail_nilai": "old_fact_detail_nilai",
        "fact_rekap_ip": "old_fact_rekap_ip", "fact_rekap_pinjam": "old_fact_rekap_pinjam",
    }
    rows = [("Initial Load Data Warehouse", table, f"SELECT * FROM {source}") for table, source in first.items()]
    rows += [
        ("Load Shared Dimensions", "dim_waktu", "SELECT * FROM dim_waktu WHERE waktu_id NOT IN (SELECT waktu_id FROM old_dim_waktu)"),
        ("Load Shared Dimensions", "dim_mahasiswa", "SELECT * FROM dim_mahasiswa"),
        ("Load Data Perpustakaan Dimensi", "dim_kategori_buku", "SELECT * FROM kategori_buku WHERE false"),
        ("Build Cross Domain Facts (Daily)", "fact_rekap_pinjam", "SELECT * FROM fact_rekap_pinjam"),
        ("Load Data Akademik DW", "dim_mata_kuliah", "SELECT * FROM dim_mata_kuliah WHERE false"),
        ("Load Data Akademik DW", "dim_program_studi", "SELECT * FROM program_studi WHERE false"),
        ("Load Data Akademik DW", "fact_detail_nilai", "SELECT * FROM new_fact_detail_nilai"),
        ("Load Data Akademik DW", "fact_rekap_ip", "SELECT * FROM new_fact_rekap_ip"),
        *(("Refresh Semua Dashboard DW", name, _after(QUERIES[name])) for name in list(REPORTS)[:9]),
    ]
    return " UNION ALL ".join(
        f"SELECT '{process}' AS nama_proses, '{table}' AS tabel, count(*) AS baris FROM ({query}) AS r" for process, table, query in rows
    )


def _tiers(label: str, name: str, samples: str, total: str) -> str:
    return f"""SELECT if(grouping(g) = 1, '{total}', g) AS {name}, count(mahasiswa_id) AS {samples}, {_mean('ip')} AS rata_rata_ip_semester
    FROM (SELECT *, {label} AS g FROM lending) GROUP BY GROUPING SETS ((g), ()) ORDER BY {name}"""


QUERIES = {
    "dim_waktu_initial": "SELECT tahun_akademik, semester FROM dim_waktu",
    "dim_program_studi_initial": f"SELECT {PROGRAMME_COLUMNS} FROM program_studi",
    "dim_mahasiswa_initial": "SELECT * FROM dim_mahasiswa",
    "dim_mata_kuliah_initial": f"SELECT {COURSE_COLUMNS} FROM dim_mata_kuliah",
    "dim_kategori_buku_initial": "SELECT * FROM dim_kategori_buku",
    "dim_waktu_incremental": """SELECT DISTINCT tahun_akademik, semester FROM hasil_studi h WHERE NOT EXISTS (SELECT 1
        FROM known_dim_waktu w WHERE w.tahun_akademik = h.tahun_akademik AND w.semester = h.semester)""",
    "dim_mahasiswa_upsert": """SELECT s.nim, s.nama, s.jenis_kelamin, coalesce(k.angkatan, s.angkatan) AS angkatan
        FROM dim_mahasiswa s LEFT JOIN known_dim_mahasiswa k ON k.nim = s.nim""",
    "dim_mata_kuliah_incremental": f"SELECT {COURSE_COLUMNS} FROM dim_mata_kuliah WHERE p_type = 'PROMO'",
    "dim_program_studi_incremental": f"SELECT {PROGRAMME_COLUMNS} FROM program_studi WHERE n_regionkey = 4",
    "dim_kategori_buku_incremental": "SELECT * FROM dim_kategori_buku WHERE nama_kategori >= 'PROMO'",
    "surrogate_key_assignment": """SELECT nim, row_number() OVER (ORDER BY new, nim) AS mahasiswa_id
        FROM (SELECT c_custkey::VARCHAR AS nim, c_mktsegment = 'MACHINERY' AS new FROM customer)""",
    "semester_of_date": f"""SELECT peminjaman_id, tgl_pinjam, {_year('tgl_pinjam')} AS tahun_akademik,
        {_term('tgl_pinjam')} AS semester FROM peminjaman""",
    "fact_detail_nilai_initial": f"SELECT {GRADE_COLUMNS} FROM fact_detail_nilai",
    "fact_rekap_ip_initial": f"SELECT {GPA_COLUMNS} FROM fact_rekap_ip",
    "fact_rekap_pinjam_initial": f"SELECT {LOAN_COLUMNS} FROM fact_rekap_pinjam",
    "watermark_last_semester": "SELECT * FROM watermark",
    "fact_detail_nilai_incremental": f"SELECT {GRADE_COLUMNS} FROM new_fact_detail_nilai",
    "fact_rekap_ip_incremental": f"SELECT {GPA_COLUMNS} FROM new_fact_rekap_ip",
    "checkpoint_last_success": """SELECT coalesce(max(waktu_mulai), TIMESTAMP '1970-01-01') AS waktu_mulai FROM run_log
        WHERE nama_proses = 'Build Cross Domain Facts (Daily)' AND status = 'SUCCESS'""",
    "impacted_waktu": "SELECT * FROM impacted",
    "fact_rekap_pinjam_kept": f"SELECT {LOAN_COLUMNS} FROM kept",
    "fact_rekap_pinjam_rebuild": f"SELECT {LOAN_COLUMNS} FROM rebuilt",
    "fact_rekap_pinjam_after_replace": f"SELECT {LOAN_COLUMNS} FROM kept UNION ALL SELECT {LOAN_COLUMNS} FROM rebuilt",
    "initial_run": _summary("fact_detail_nilai", "fact_rekap_ip"),
    "incremental_run": _summary("after_fact_detail_nilai", "after_fact_rekap_ip"),
    "landing_load": _summary("fact_detail_nilai", "fact_rekap_ip"),
    "tingkat_ketidaklulusan": "SELECT * FROM ranked_failures",
    "tren_performa_akademik": f"""SELECT if(grouping(tahun_akademik) = 1, 'Semua Tahun (Grand Total)', tahun_akademik) AS tahun_akademik,
        if(grouping(semester) = 1, 'Semua Semester (Sub-Total)', semester) AS semester,
        count(DISTINCT mahasiswa_id) AS total_mahasiswa_aktif, {_mean('ip')} AS rata_rata_ip_semester
        FROM fact_rekap_ip JOIN dim_waktu w USING (waktu_id) GROUP BY ROLLUP (w.tahun_akademik, w.semester)
        ORDER BY w.tahun_akademik ASC NULLS LAST, w.semester DESC NULLS FIRST""",
    "perbandingan_kelas": f"""SELECT if(grouping(p.kelas) = 1, 'Grand Total Keseluruhan', p.kelas) AS kelas,
        count(DISTINCT mahasiswa_id) AS populasi_mahasiswa, {_mean('ip')} AS rata_rata_ipk_keseluruhan
        FROM fact_rekap_ip JOIN program_studi p USING (program_studi_id) GROUP BY GROUPING SETS ((p.kelas), ())
        ORDER BY rata_rata_ipk_keseluruhan DESC NULLS FIRST, p.kelas ASC NULLS LAST""",
    "cohort_angkatan": f"""SELECT if(grouping(m.angkatan) = 1, 'Semua Angkatan', m.angkatan::VARCHAR) AS angkatan,
        if(grouping(w.tahun_akademik) = 1, 'Semua Tahun', w.tahun_akademik) AS tahun_akademik,
        if(grouping(w.semester) = 1, 'Semua Semester', w.semester) AS semester,
        count(DISTINCT mahasiswa_id) AS jumlah_mahasiswa_aktif, {_mean('ip')} AS rata_rata_ip_angkatan,
        {_half_up('sum(total_sks)', 'count(total_sks)')}::DOUBLE AS rata_rata_sks_diambil
        FROM fact_rekap_ip JOIN dim_waktu w USING (waktu_id) JOIN dim_mahasiswa m ON m.nim = mahasiswa_id
        GROUP BY CUBE (m.angkatan, w.tahun_akademik, w.semester)
        ORDER BY m.angkatan DESC NULLS FIRST, w.tahun_akademik ASC NULLS LAST, w.semester DESC NULLS FIRST""",
    "matkul_kritis_angkatan": "SELECT * FROM ranked_critical",
    "kategori_buku_populer": """SELECT nama_kategori, sum(total_peminjaman)::BIGINT AS frekuensi_peminjaman,
        sum(jumlah_buku)::BIGINT AS total_judul_buku_unik_dipinjam,
        rank() OVER (ORDER BY sum(total_peminjaman) DESC) AS peringkat_popularitas
        FROM fact_rekap_pinjam JOIN kategori_buku USING (kategori_id) GROUP BY nama_kategori""",
    "tren_peminjaman_semester": """SELECT if(grouping(w.tahun_akademik) = 1, 'Total Semua Waktu', w.tahun_akademik) AS tahun_akademik,
        if(grouping(w.semester) = 1, 'Sub-Total Tahun', w.semester) AS semester,
        sum(total_peminjaman)::BIGINT AS total_transaksi_pinjam, sum(jumlah_denda)::BIGINT AS total_denda_rp
        FROM fact_rekap_pinjam JOIN dim_waktu w USING (waktu_id) GROUP BY ROLLUP (w.tahun_akademik, w.semester)
        ORDER BY w.tahun_akademik ASC NULLS LAST, w.semester DESC NULLS FIRST""",
    "korelasi_rajin_pinjam_ip": _tiers(
        """CASE WHEN loans = 0 THEN '1 - Tidak Pernah Pinjam' WHEN loans BETWEEN 1 AND 5 THEN '2 - Jarang (1-5 Buku/Semester)'
            ELSE '3 - Rajin (>5 Buku/Semester)' END""",
        "klasifikasi_peminjam", "total_sampel_semester", "Grand Total Populasi",
    ),
    "korelasi_denda_ip": _tiers(
        "CASE WHEN fines = 0 THEN 'Disiplin (Tanpa Denda)' ELSE 'Pernah Terlambat (Kena Denda)' END",
        "status_kedisiplinan_perpus", "total_sampel", "Rata-rata Keseluruhan Mahasiswa",
    ),
    "distribusi_ip": f"""SELECT kategori_ip, count(*) AS jumlah_mahasiswa,
        {_places(_percent('count(*)', '(sum(count(*)) OVER ())'))} AS persentase
        FROM (SELECT CASE WHEN ip / 100.0 >= 3.51 THEN 'Cumlaude (3.51 - 4.00)'
            WHEN ip / 100.0 >= 3.01 THEN 'Sangat Memuaskan (3.01 - 3.50)' WHEN ip / 100.0 >= 2.51 THEN 'Memuaskan (2.51 - 3.00)'
            WHEN ip / 100.0 >= 2.00 THEN 'Cukup (2.00 - 2.50)' ELSE 'Kurang (< 2.00)' END AS kategori_ip
        , ip FROM fact_rekap_ip) GROUP BY kategori_ip ORDER BY min(ip) DESC NULLS FIRST""",
    "buku_favorit_berprestasi": """SELECT nama_kategori, sum(total_peminjaman)::BIGINT AS total_peminjaman,
        dense_rank() OVER (ORDER BY sum(p.total_peminjaman) DESC) AS peringkat_buku_berprestasi
        FROM fact_rekap_pinjam p JOIN fact_rekap_ip i ON i.mahasiswa_id = p.mahasiswa_id AND i.waktu_id = p.waktu_id AND i.ip / 100.0 >= 3.50
        JOIN kategori_buku USING (kategori_id) GROUP BY nama_kategori""",
    "gender_akademik_perpus": f"""SELECT if(grouping(m.jenis_kelamin) = 1, 'Semua Demografi (Total)', m.jenis_kelamin) AS jenis_kelamin,
        count(m.nim) AS total_mahasiswa, {_places(_half_up('sum(mean)', 'nullif(count(mean), 0) * 100000000000000::HUGEINT'))} AS rata_rata_ipk,
        coalesce(sum(loans), 0)::BIGINT AS total_buku_dipinjam, coalesce(sum(fines), 0)::BIGINT AS total_akumulasi_denda_rp
        FROM dim_mahasiswa m
        LEFT JOIN (SELECT mahasiswa_id, {_half_up('sum(ip)::HUGEINT * 100000000000000', 'count(ip)')} AS mean
            FROM fact_rekap_ip GROUP BY mahasiswa_id) a ON a.mahasiswa_id = m.nim
        LEFT JOIN (SELECT mahasiswa_id, sum(total_peminjaman) AS loans, sum(jumlah_denda) AS fines
            FROM fact_rekap_pinjam GROUP BY mahasiswa_id) b ON b.mahasiswa_id = m.nim
        GROUP BY GROUPING SETS ((m.jenis_kelamin), ())""",
    "top10_ketidaklulusan": "SELECT * FROM ranked_failures ORDER BY peringkat_kritis, kode_mata_kuliah LIMIT 10",
    "top10_matkul_kritis": "SELECT * FROM ranked_critical ORDER BY angkatan, ranking_matkul_kritis_angkatan LIMIT 10",
    "ringkasan_anggota": """SELECT a.anggota_id, a.nim, a.nama_lengkap, a.status_aktif,
        count(DISTINCT p.peminjaman_id) AS total_peminjaman, count(DISTINCT k.kunjungan_id) AS total_kunjungan,
        coalesce(sum(f.total_denda), 0)::BIGINT AS total_denda_rp,
        coalesce(sum(f.total_denda) FILTER (f.status_pembayaran = 'Belum Dibayar'), 0)::BIGINT AS denda_belum_bayar_rp
        FROM anggota a LEFT JOIN peminjaman p ON p.anggota_id = a.anggota_id
        LEFT JOIN kunjungan k ON k.anggota_id = a.anggota_id LEFT JOIN denda f ON f.peminjaman_id = p.peminjaman_id GROUP BY 1, 2, 3, 4""",
    "stok_buku": """SELECT b.buku_id, b.judul, k.nama_kategori, count(e.eksemplar_id) AS total_eksemplar,
        count(*) FILTER (e.tersedia = 'Y') AS tersedia, count(*) FILTER (e.tersedia = 'N') AS dipinjam
        FROM buku b JOIN kategori_buku k USING (kategori_id) LEFT JOIN eksemplar_buku e ON e.buku_id = b.buku_id GROUP BY 1, 2, 3""",
    "dq_not_null": _report(NOT_NULL),
    "dq_length": _report(LENGTHS),
    "dq_domain_values": _report(DOMAINS),
    "dq_range": _report(RANGES),
    "dq_date_order": _report(DATE_ORDER),
    "dq_unique_key": _report(UNIQUE),
    "dq_referential": _report(REFERENCES),
    "dq_logical_fk": _report([_orphans("anggota", "nim", "mahasiswa", "f_anggota", "f_mahasiswa")]),
    "dq_defaults": _report(DEFAULTS),
    "row_count_reconciliation": _counts(),
    "etl_run_log": "SELECT * FROM run_log",
    "etl_log_monitor": """SELECT log_id, nama_proses, waktu_mulai, waktu_selesai, durasi_detik::VARCHAR || ' detik' AS total_durasi,
        status, pesan_error FROM run_log ORDER BY run_log.waktu_mulai DESC, log_id DESC""",
}


TABLES |= {
    f"after_{name}": _after(TABLES[name]) for name in ("failures", "ranked_failures", "critical", "ranked_critical", "lending")
}
TABLES["per_khs"] = f"""SELECT {_year('o_orderdate')} || ' ' || {_term('o_orderdate')} AS waktu_id, o_custkey::VARCHAR AS mahasiswa_id,
    o_orderkey AS khs, (c_nationkey + 1)::BIGINT AS program_studi_id,
    {_half_up('sum(8 * l_quantity * (1 + p_size % 4))::BIGINT', 'sum(1 + p_size % 4)')}::BIGINT AS ip,
    sum(1 + p_size % 4)::BIGINT AS total_sks, count(*) AS jumlah_mata_kuliah
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN part ON p_partkey = l_partkey
    GROUP BY 1, 2, 3, 4"""

QUERIES |= {
    "load_counts": _written(),
    "dashboards": _totals(),
    "second_night": " UNION ALL ".join((
        _parts("fact_detail_nilai", "bobot + status_lulus::INT", "old_fact_detail_nilai", "new_fact_detail_nilai"),
        _parts("fact_rekap_ip", "ip + total_sks + jumlah_mata_kuliah", "old_fact_rekap_ip", "new_fact_rekap_ip"),
        _parts("fact_rekap_pinjam", "total_peminjaman + jumlah_denda + jumlah_buku", "kept", "rebuilt"),
    )),
    "fact_rekap_ip_conflict": f"""SELECT waktu_id, mahasiswa_id, khs, program_studi_id, {_places('ip')} AS ip_semester, total_sks,
        jumlah_mata_kuliah, coalesce(pesaing, 0) AS pesaing
        FROM (SELECT waktu_id, mahasiswa_id, NULL::BIGINT AS khs, program_studi_id, ip, total_sks, jumlah_mata_kuliah
            FROM old_fact_rekap_ip UNION ALL
            SELECT * FROM per_khs n WHERE khs = (SELECT min(khs) FROM per_khs p WHERE p.waktu_id = n.waktu_id AND p.mahasiswa_id = n.mahasiswa_id)
            AND NOT EXISTS (SELECT 1 FROM old_fact_rekap_ip o WHERE o.waktu_id = n.waktu_id AND o.mahasiswa_id = n.mahasiswa_id))
        LEFT JOIN (SELECT waktu_id, mahasiswa_id, count(*) AS pesaing FROM per_khs GROUP BY ALL) USING (waktu_id, mahasiswa_id)""",
}


def sql(name: str) -> str:
    """The query with the tables it reads, and no others, as CTEs."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for table in TABLES:
            if table not in needed and re.search(rf"\b(FROM|JOIN)\s+{table}\b|, {table} ", text):
                visit(TABLES[table])
                needed.append(table)

    visit(QUERIES[name])
    ctes = ",\n".join(f"{table} AS MATERIALIZED ({TABLES[table]})" for table in needed)
    return f"WITH {ctes}\n{QUERIES[name]}" if ctes else QUERIES[name]
