"""Declared tables: column types, keys and the rules the data has to keep.

Spark does not enforce keys, foreign keys, domains or checks on files, so they are declared here
once and turned into distributed violation counts by ``plans.quality``.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class ForeignKey:
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class Table:
    name: str
    ddl: str
    key: tuple[str, ...]
    required: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    domains: dict[str, tuple[str, ...]] = field(default_factory=dict)
    ranges: dict[str, str] = field(default_factory=dict)
    date_order: dict[str, str] = field(default_factory=dict)
    references: tuple[ForeignKey, ...] = ()
    logical_references: tuple[ForeignKey, ...] = ()
    defaults: dict[str, object] = field(default_factory=dict)
    lengths: dict[str, int] = field(default_factory=dict)
    partition: str | None = None

    @property
    def columns(self) -> list[str]:
        return [part.split()[0] for part in self.ddl.split("; ")]

    @property
    def schema(self) -> str:
        return self.ddl.replace("; ", ", ")


def _fk(column: str, parent: str, parent_column: str | None = None) -> ForeignKey:
    return ForeignKey((column,), parent, (parent_column or column,))


# Status codes and default values of the operational tables.
CONDITIONS = ("Baik", "Rusak Ringan", "Rusak Berat")
YES_NO = ("Y", "N")
GENDERS = ("L", "P")
LOAN_STATUS = ("Dipinjam", "Dikembalikan", "Hilang")
FINE_STATUS = ("Lunas", "Belum Dibayar", "Dihapuskan")

ACADEMIC = (
    Table(
        "program_studi",
        "program_studi_id INT; jenjang STRING; nama_program_studi STRING; kelas STRING",
        key=("program_studi_id",),
        lengths={"jenjang": 5, "nama_program_studi": 100, "kelas": 20},
    ),
    Table(
        "mata_kuliah",
        "mata_kuliah_id STRING; nama_mata_kuliah STRING; sks SMALLINT",
        key=("mata_kuliah_id",),
        lengths={"mata_kuliah_id": 10, "nama_mata_kuliah": 150},
    ),
    Table(
        "mahasiswa",
        "nim STRING; program_studi_id INT; nama_lengkap STRING; jenis_kelamin STRING; angkatan SMALLINT; total_sks SMALLINT",
        key=("nim",),
        lengths={"nim": 20, "nama_lengkap": 100, "jenis_kelamin": 1},
        references=(_fk("program_studi_id", "program_studi"),),
    ),
    Table(
        "hasil_studi",
        "khs_id STRING; nim STRING; tahun_akademik STRING; semester STRING; sks_ditempuh SMALLINT",
        key=("khs_id",),
        lengths={"khs_id": 20, "nim": 20, "tahun_akademik": 10, "semester": 10},
        references=(_fk("nim", "mahasiswa"),),
    ),
    Table(
        "detail_nilai",
        "detail_id BIGINT; khs_id STRING; mata_kuliah_id STRING; nilai_angka DECIMAL(4,2); nilai_huruf STRING; status_lulus STRING",
        key=("detail_id",),
        lengths={"khs_id": 20, "mata_kuliah_id": 10, "nilai_huruf": 5, "status_lulus": 15},
        references=(_fk("khs_id", "hasil_studi"), _fk("mata_kuliah_id", "mata_kuliah")),
    ),
)

LIBRARY = (
    Table(
        "kategori_buku",
        "kategori_id SMALLINT; nama_kategori STRING; kode_ddc STRING",
        key=("kategori_id",),
        lengths={"nama_kategori": 60, "kode_ddc": 20},
        required=("kategori_id", "nama_kategori"),
    ),
    Table(
        "buku",
        "buku_id STRING; isbn STRING; judul STRING; penulis STRING; penerbit STRING; tahun_terbit SMALLINT; kategori_id SMALLINT",
        key=("buku_id",),
        lengths={"buku_id": 8, "isbn": 20, "judul": 200, "penulis": 100, "penerbit": 80},
        required=("buku_id", "judul", "penulis", "kategori_id"),
        unique=(("isbn",),),
        ranges={"tahun_terbit": "tahun_terbit between 1900 and 2099"},
        references=(_fk("kategori_id", "kategori_buku"),),
    ),
    Table(
        "eksemplar_buku",
        "eksemplar_id STRING; buku_id STRING; kondisi STRING; tersedia STRING",
        key=("eksemplar_id",),
        lengths={"eksemplar_id": 10, "buku_id": 8, "kondisi": 15, "tersedia": 1},
        required=("eksemplar_id", "buku_id", "kondisi", "tersedia"),
        domains={"kondisi": CONDITIONS, "tersedia": YES_NO},
        references=(_fk("buku_id", "buku"),),
        defaults={"kondisi": "Baik", "tersedia": "Y"},
    ),
    Table(
        "anggota",
        "anggota_id STRING; nim STRING; nama_lengkap STRING; jenis_kelamin STRING; tgl_daftar DATE; tgl_expired DATE; status_aktif STRING",
        key=("anggota_id",),
        lengths={"anggota_id": 25, "nim": 20, "nama_lengkap": 100, "jenis_kelamin": 1, "status_aktif": 1},
        required=("anggota_id", "nim", "nama_lengkap", "jenis_kelamin", "tgl_daftar", "tgl_expired", "status_aktif"),
        unique=(("nim",),),
        domains={"jenis_kelamin": GENDERS, "status_aktif": YES_NO},
        date_order={"tgl_expired": "tgl_expired > tgl_daftar"},
        logical_references=(_fk("nim", "mahasiswa"),),
        defaults={"status_aktif": "Y"},
    ),
    Table(
        "kunjungan",
        "kunjungan_id BIGINT; anggota_id STRING; tanggal DATE; jam_masuk STRING; durasi_menit SMALLINT",
        key=("kunjungan_id",),
        lengths={"anggota_id": 25},
        required=("kunjungan_id", "anggota_id", "tanggal", "jam_masuk", "durasi_menit"),
        unique=(("anggota_id", "tanggal"),),
        ranges={"durasi_menit": "durasi_menit > 0"},
        references=(_fk("anggota_id", "anggota"),),
    ),
    Table(
        "peminjaman",
        "peminjaman_id BIGINT; anggota_id STRING; tgl_pinjam DATE; tgl_kembali_rencana DATE; tgl_kembali_aktual DATE; status STRING; petugas_id STRING",
        key=("peminjaman_id",),
        lengths={"anggota_id": 25, "status": 15, "petugas_id": 10},
        required=("peminjaman_id", "anggota_id", "tgl_pinjam", "tgl_kembali_rencana", "status", "petugas_id"),
        domains={"status": LOAN_STATUS},
        date_order={
            "tgl_kembali_rencana": "tgl_kembali_rencana >= tgl_pinjam",
            "tgl_kembali_aktual": "tgl_kembali_aktual >= tgl_pinjam",
        },
        references=(_fk("anggota_id", "anggota"),),
        defaults={"status": "Dipinjam"},
    ),
    Table(
        "detail_peminjaman",
        "detail_id BIGINT; peminjaman_id BIGINT; buku_id STRING; eksemplar_id STRING",
        key=("detail_id",),
        lengths={"buku_id": 8, "eksemplar_id": 10},
        required=("detail_id", "peminjaman_id", "buku_id", "eksemplar_id"),
        references=(
            _fk("peminjaman_id", "peminjaman"),
            _fk("buku_id", "buku"),
            _fk("eksemplar_id", "eksemplar_buku"),
        ),
    ),
    Table(
        "denda",
        "denda_id BIGINT; peminjaman_id BIGINT; hari_keterlambatan SMALLINT; total_denda INT; status_pembayaran STRING; tgl_bayar DATE",
        key=("denda_id",),
        lengths={"status_pembayaran": 15},
        required=("denda_id", "peminjaman_id", "hari_keterlambatan", "total_denda", "status_pembayaran"),
        unique=(("peminjaman_id",),),
        domains={"status_pembayaran": FINE_STATUS},
        ranges={"hari_keterlambatan": "hari_keterlambatan > 0", "total_denda": "total_denda > 0"},
        references=(_fk("peminjaman_id", "peminjaman"),),
        defaults={"status_pembayaran": "Belum Dibayar"},
    ),
)

DIMENSIONS = (
    Table(
        "dim_waktu",
        "waktu_id INT; tahun_akademik STRING; semester STRING",
        key=("waktu_id",),
        lengths={"tahun_akademik": 20, "semester": 10},
        required=("tahun_akademik", "semester"),
    ),
    Table(
        "dim_mahasiswa",
        "mahasiswa_id INT; nim STRING; nama STRING; jenis_kelamin STRING; angkatan INT",
        key=("mahasiswa_id",),
        lengths={"nim": 20, "nama": 150, "jenis_kelamin": 15},
        required=("nim", "nama", "jenis_kelamin", "angkatan"),
        unique=(("nim",),),
    ),
    Table(
        "dim_program_studi",
        "program_studi_id INT; jenjang STRING; nama_program_studi STRING; kelas STRING",
        key=("program_studi_id",),
        lengths={"jenjang": 10, "nama_program_studi": 100, "kelas": 20},
        required=("jenjang", "nama_program_studi", "kelas"),
    ),
    Table(
        "dim_mata_kuliah",
        "mata_kuliah_id INT; kode_mata_kuliah STRING; nama_mata_kuliah STRING; bobot_sks INT; jenis_mata_kuliah STRING",
        key=("mata_kuliah_id",),
        lengths={"kode_mata_kuliah": 20, "nama_mata_kuliah": 150, "jenis_mata_kuliah": 20},
        required=("kode_mata_kuliah", "nama_mata_kuliah", "bobot_sks", "jenis_mata_kuliah"),
        unique=(("kode_mata_kuliah",),),
    ),
    Table(
        "dim_kategori_buku",
        "kategori_id INT; nama_kategori STRING; deskripsi STRING",
        key=("kategori_id",),
        lengths={"nama_kategori": 100},
        required=("nama_kategori",),
    ),
)

FACTS = (
    Table(
        "fact_detail_nilai",
        "waktu_id INT; mahasiswa_id INT; mata_kuliah_id INT; nilai_angka DECIMAL(3,2); status_lulus BOOLEAN; bobot_nilai DECIMAL(5,2)",
        key=("waktu_id", "mahasiswa_id", "mata_kuliah_id"),
        required=("waktu_id", "mahasiswa_id", "mata_kuliah_id"),
        references=(
            _fk("waktu_id", "dim_waktu"),
            _fk("mahasiswa_id", "dim_mahasiswa"),
            _fk("mata_kuliah_id", "dim_mata_kuliah"),
        ),
        partition="waktu_id",
    ),
    Table(
        "fact_rekap_ip",
        "waktu_id INT; program_studi_id INT; mahasiswa_id INT; ip_semester DECIMAL(3,2); total_sks INT; jumlah_mata_kuliah INT",
        key=("waktu_id", "mahasiswa_id"),
        required=("waktu_id", "program_studi_id", "mahasiswa_id"),
        references=(
            _fk("waktu_id", "dim_waktu"),
            _fk("program_studi_id", "dim_program_studi"),
            _fk("mahasiswa_id", "dim_mahasiswa"),
        ),
        partition="waktu_id",
    ),
    Table(
        "fact_rekap_pinjam",
        "waktu_id INT; mahasiswa_id INT; kategori_id INT; total_peminjaman INT; jumlah_denda INT; jumlah_buku INT",
        key=("waktu_id", "mahasiswa_id", "kategori_id"),
        required=("waktu_id", "mahasiswa_id", "kategori_id"),
        references=(
            _fk("waktu_id", "dim_waktu"),
            _fk("mahasiswa_id", "dim_mahasiswa"),
            _fk("kategori_id", "dim_kategori_buku"),
        ),
        defaults={"total_peminjaman": 0, "jumlah_denda": 0, "jumlah_buku": 0},
        partition="waktu_id",
    ),
)

RUN_LOG = Table(
    "log_proses_etl",
    "log_id INT; nama_proses STRING; waktu_mulai TIMESTAMP_NTZ; waktu_selesai TIMESTAMP_NTZ; durasi_detik INT; status STRING; pesan_error STRING",
    key=("log_id",),
    required=("nama_proses", "waktu_mulai", "status"),
)

SOURCES = {table.name: table for table in ACADEMIC + LIBRARY}
WAREHOUSE = {table.name: table for table in DIMENSIONS + FACTS}
TABLES = {**SOURCES, **WAREHOUSE, RUN_LOG.name: RUN_LOG}
