"""Library views over the operational tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNPAID = "Belum Dibayar"  # fixed value


def member_summary(
    anggota: DataFrame, peminjaman: DataFrame, kunjungan: DataFrame, denda: DataFrame
) -> DataFrame:
    """Loans, visits and fines per member.

    Defined over a join that pairs each loan with each visit, so a fine counts once per visit. The
    product is never built: loans and visits are reduced per member first and the fine totals are
    multiplied by the number of visits.
    """
    unpaid = F.when(F.col("status_pembayaran") == UNPAID, F.col("total_denda")).otherwise(0)
    loans = (
        peminjaman.select("peminjaman_id", "anggota_id")
        .join(denda.select("peminjaman_id", "total_denda", "status_pembayaran"), "peminjaman_id", "left")
        .groupBy("anggota_id")
        .agg(
            F.count("peminjaman_id").alias("loans"),
            F.sum("total_denda").alias("fines"),
            F.sum(unpaid).alias("unpaid"),
        )
    )
    visits = kunjungan.groupBy("anggota_id").agg(F.count("kunjungan_id").alias("visits"))
    pairs = F.greatest(F.coalesce(F.col("visits"), F.lit(0)), F.lit(1))
    return (
        anggota.select("anggota_id", "nim", "nama_lengkap", "status_aktif")
        .join(loans, "anggota_id", "left")
        .join(visits, "anggota_id", "left")
        .select(
            "anggota_id",
            "nim",
            "nama_lengkap",
            "status_aktif",
            F.coalesce(F.col("loans"), F.lit(0)).alias("total_peminjaman"),
            F.coalesce(F.col("visits"), F.lit(0)).alias("total_kunjungan"),
            (F.coalesce(F.col("fines"), F.lit(0)) * pairs).alias("total_denda_rp"),
            (F.coalesce(F.col("unpaid"), F.lit(0)) * pairs).alias("denda_belum_bayar_rp"),
        )
    )


def title_stock(buku: DataFrame, kategori_buku: DataFrame, eksemplar_buku: DataFrame) -> DataFrame:
    """Copies per title, available and lent; titles without a copy are kept."""
    copies = eksemplar_buku.groupBy("buku_id").agg(
        F.count("eksemplar_id").alias("copies"),
        F.sum((F.col("tersedia") == "Y").cast("bigint")).alias("available"),
        F.sum((F.col("tersedia") == "N").cast("bigint")).alias("lent"),
    )
    return (
        buku.select("buku_id", "judul", "kategori_id")
        .join(kategori_buku.select("kategori_id", "nama_kategori"), "kategori_id")
        .join(copies, "buku_id", "left")
        .select(
            "buku_id",
            "judul",
            "nama_kategori",
            *(
                F.coalesce(F.col(source), F.lit(0)).alias(target)
                for source, target in (("copies", "total_eksemplar"), ("available", "tersedia"), ("lent", "dipinjam"))
            ),
        )
    )
