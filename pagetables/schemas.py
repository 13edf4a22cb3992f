"""Schemas of the tables the engine keeps."""

from pyspark.sql import types as T

ENTITY = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("major", T.StringType()),
    ]
)

URLS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("danh_muc", T.StringType()),
    ]
)

RESULTS = T.StructType(
    [
        T.StructField("cong_cu", T.StringType()),
        T.StructField("lan", T.IntegerType()),
        T.StructField("url", T.StringType()),
        T.StructField("trang_thai", T.StringType()),
        T.StructField("ten", T.StringType()),
        T.StructField("gia", T.LongType()),
        T.StructField("don_vi", T.StringType()),
        T.StructField("thuong_hieu", T.StringType()),
        T.StructField("so_dang_ky", T.StringType()),
        T.StructField("thoi_gian_xu_ly", T.DoubleType()),
        T.StructField("thoi_diem", T.TimestampType()),
    ]
)

RUNS = T.StructType(
    [
        T.StructField("cong_cu", T.StringType()),
        T.StructField("lan", T.IntegerType()),
        T.StructField("so_url", T.LongType()),
        T.StructField("so_trang_ok", T.LongType()),
        T.StructField("tong_thoi_gian", T.DoubleType()),
        T.StructField("thoi_gian_xu_ly", T.DoubleType()),
        T.StructField("ram_dinh_mb", T.DoubleType()),
        T.StructField("thoi_diem", T.TimestampType()),
    ]
)

RESULT_KEY = ["cong_cu", "lan", "url"]
