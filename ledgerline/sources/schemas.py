"""Explicit schemas of the 30 source tables (no inference on read).

The source system ships no DDL; types follow from how the reports use each column:
money ``decimal(18,2)``, keys ``bigint``, shop/warehouse/user ids ``int``,
timestamps without zone (``timestamp_ntz``), JSON objects as ``string``.
"""

from __future__ import annotations

MONEY = "DECIMAL(18,2)"


def _ad(date_col: str, amount_col: str, date_type: str = "DATE") -> str:
    return f"{date_col} {date_type}, toko_id INT, {amount_col} {MONEY}"


SCHEMAS: dict[str, str] = {
    "pesanan": ("id BIGINT, toko_id INT, marketplace STRING, created_at TIMESTAMP_NTZ, "
                "atur_by INT, id_marketplace BIGINT, harga DECIMAL(18,2), gudang_id INT, "
                "status STRING, customer STRING, data STRING"),
    "pesanan_detail": "id BIGINT, pesanan_id BIGINT",
    "pesanan_detail_sku": "pesanan_detail_id BIGINT, nama STRING, qty INT",
    "toko": "id INT, nama STRING",
    "gudang": "id INT, nama STRING",
    "users_omni": "id INT, name STRING",
    "pesanan_pembentuk_harga_shopee": (
        f"pesanan_id BIGINT, escrow_amount {MONEY}, order_selling_price {MONEY}, "
        f"voucher_from_seller {MONEY}, order_ams_commission_fee {MONEY}"),
    "pesanan_pembentuk_harga_tiktok_shop": (
        f"pesanan_id BIGINT, total_amount {MONEY}, original_total_product_price {MONEY}, "
        f"seller_discount {MONEY}"),
    "tiktok_pencairan": (
        f"order_id BIGINT, total_settlement_amount {MONEY}, toko_id INT, "
        f"affiliate_commission {MONEY}, affiliate_shop_ads_commission {MONEY}"),
    "tiktok_ads_manager": _ad("tanggal", "cost"),
    "tiktok_iklan_gmv_max": _ad("tanggal", "biaya_iklan"),
    "tiktok_iklan_booster": _ad("tanggal", "biaya_iklan"),
    "tiktok_proteksi_roas": _ad("tanggal", "biaya_iklan", "TIMESTAMP_NTZ"),
    "shopee_iklan": _ad("tanggal", "biaya"),
    "shopee_iklan_live": _ad("tanggal", "biaya"),
    "shopee_iklan_toko": _ad("tanggal", "biaya"),
    "shopee_cpas_internal": _ad("reporting_starts", "amount_spent"),
    "shopee_cpas_eksternal": _ad("tanggal", "pengeluaran_idr"),
    "shopee_cpas_google": _ad("tanggal", "pengeluaran_idr"),
    "shopee_proteksi_roas": _ad("waktu", "jumlah", "TIMESTAMP_NTZ"),
    "beban": f"id INT, import_id INT, jenis STRING, tahun INT, bulan INT, nilai {MONEY}",
    "beban_toko": "beban_id INT, toko_id INT",
    "kelontong": f"tanggal DATE, toko_id INT, nominal {MONEY}",
    "marketing": f"jenis_pengeluaran STRING, nominal {MONEY}, platform STRING, tanggal DATE",
    "facebook_iklan": (f"awal_pelaporan DATE, toko_id INT, imported_by INT, "
                       f"jumlah_yang_dibelanjakan {MONEY}"),
    "sheet2_kol_ig": ("posting_tanggal_posting DATE, week1_views BIGINT, week1_koment BIGINT, "
                      "week1_like BIGINT, week1_share BIGINT, week1_komen_brand BIGINT"),
    "sheet2_kol_tt": ("tanggal_posting DATE, views BIGINT, koment BIGINT, `like` BIGINT, "
                      "ctr DECIMAL(9,4)"),
    "sheet2_am_tasya": ("tanggal_upload DATE, average_views_video_1_pekan BIGINT, "
                        "comment BIGINT, likes BIGINT, ctr DECIMAL(9,4)"),
    "sheet2_am_tama": ("tanggal_upload DATE, average_views_video_1_pekan BIGINT, "
                       "comment BIGINT, likes BIGINT, ctr DECIMAL(9,4)"),
    "sheet2_internal": (
        "tanggal DATE, week1_views BIGINT, week1_comment BIGINT, week1_like BIGINT, "
        "week1_share BIGINT, week1_comment_brand BIGINT, week1_yellowcart_avg_views BIGINT, "
        "week1_yellowcart_comment BIGINT, week1_yellowcart_likes BIGINT, "
        "week1_yellowcart_clicks BIGINT"),
}

# (table, date column, amount column) of the ad-spend sources, in a fixed order.
AD_SOURCES = (
    ("tiktok_ads_manager", "tanggal", "cost"),
    ("tiktok_iklan_gmv_max", "tanggal", "biaya_iklan"),
    ("tiktok_iklan_booster", "tanggal", "biaya_iklan"),
    ("tiktok_proteksi_roas", "tanggal", "biaya_iklan"),
    ("shopee_iklan", "tanggal", "biaya"),
    ("shopee_iklan_live", "tanggal", "biaya"),
    ("shopee_iklan_toko", "tanggal", "biaya"),
    ("shopee_cpas_internal", "reporting_starts", "amount_spent"),
    ("shopee_cpas_eksternal", "tanggal", "pengeluaran_idr"),
    ("shopee_cpas_google", "tanggal", "pengeluaran_idr"),
    ("shopee_proteksi_roas", "waktu", "jumlah"),
)
