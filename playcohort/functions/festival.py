"""Public holidays by calendar day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: day=name, one line per holiday ---------------------------------
FESTIVAL_DAYS = """
20140101=元旦
20140131=春节
20140201=春节
20140202=春节
20140203=春节
20140204=春节
20140205=春节
20140206=春节
20140405=清明节
20140406=清明节
20140407=清明节
20140501=五一劳动节
20140502=五一劳动节
20140503=五一劳动节
20140531=端午节
20140601=端午节
20140602=端午节
20140906=中秋节
20140907=中秋节
20140908=中秋节
20141001=国庆节
20141002=国庆节
20141003=国庆节
20141004=国庆节
20141005=国庆节
20141006=国庆节
20141007=国庆节
20150101=元旦
20150102=元旦
20150103=元旦
20150218=春节
20150219=春节
20150220=春节
20150221=春节
20150222=春节
20150223=春节
20150224=春节
20150404=清明节
20150405=清明节
20150406=清明节
20150501=五一劳动节
20150502=五一劳动节
20150503=五一劳动节
20150620=端午节
20150621=端午节
20150622=端午节
20150926=中秋节
20150927=中秋节
20151001=国庆节
20151002=国庆节
20151003=国庆节
20151004=国庆节
20151005=国庆节
20151006=国庆节
20151007=国庆节
20160101=元旦
20160102=元旦
20160103=元旦
20160207=春节
20160208=春节
20160209=春节
20160210=春节
20160211=春节
20160212=春节
20160213=春节
20160402=清明节
20160403=清明节
20160404=清明节
20160430=五一劳动节
20160501=五一劳动节
20160502=五一劳动节
20160609=端午节
20160610=端午节
20160611=端午节
20160915=中秋节
20160916=中秋节
20160917=中秋节
20161001=国庆节
20161002=国庆节
20161003=国庆节
20161004=国庆节
20161005=国庆节
20161006=国庆节
20161007=国庆节
"""


def festival_table(spark: SparkSession) -> DataFrame:
    """The calendar as a two-column table (yyyymmdd, festival)."""
    rows = [tuple(line.split("=")) for line in FESTIVAL_DAYS.split()]
    return spark.createDataFrame(rows, "yyyymmdd string, festival string")


def day_digits(text: Column) -> Column:
    """``yyyymmdd`` of a day written with or without dashes, alone or before a time; else null."""
    full = r"\d{4}-\d{2}-\d{2}\s+\d{2}:\d{2}:\d{2}"
    return (
        F.when(text.rlike(full), F.left(F.replace(text, F.lit("-"), F.lit("")), F.lit(8)))
        .when(text.rlike(r"\d{4}-\d{2}-\d{2}"), F.replace(text, F.lit("-"), F.lit("")))
        .when(text.rlike(r"\d{8}"), text)
    )


def number_digits(number: Column) -> Column:
    """A day stored as a number, without exponent or decimals."""
    return number.cast("decimal(20,0)").cast("string")


def with_festival(df: DataFrame, text: Column) -> DataFrame:
    """Add ``festival`` ('null' when the day is none) and ``is_festival`` (0/1).

    The calendar is a fixed list, so Spark's size-checked broadcast always applies.
    """
    days = festival_table(df.sparkSession)
    keyed = df.withColumn("_day", day_digits(text))
    return keyed.join(days, keyed["_day"] == days["yyyymmdd"], "left").select(
        *[keyed[c] for c in df.columns],
        F.coalesce("festival", F.lit("null")).alias("festival"),
        F.col("festival").isNotNull().cast("int").alias("is_festival"),
    )
