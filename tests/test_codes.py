"""Edge rows of the code functions, each table checked in one Spark job."""

from pyspark.sql import functions as F

from parcelflow.functions.codes import (commune_of_parcelle, departement_of, lot_of, routable, srid_of,
                                        type_prefix)


def check(spark, cases, *exprs):
    """cases: list of (input, expected...) ; exprs: functions of the input column."""
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, v string")
    got = df.select("i", *[e(F.col("v")).alias(f"r{k}") for k, e in enumerate(exprs)]).orderBy("i").collect()
    for case, row in zip(cases, got):
        assert tuple(row[f"r{k}"] for k in range(len(exprs))) == tuple(case[1:]), (case, row)


def test_departement_of(spark):
    check(spark, [("59350", "59"), ("2A004", "2A"), ("97411", "974"), ("97", "97"), ("98701", "98"),
                  (None, None), ("ZZ001", "ZZ"), ("00123", "00"), ("9", "9")], departement_of)


def test_srid_literal_and_documented(spark):
    check(spark, [("59", 2154, 2154), ("2A", 2154, 2154), ("971", 5490, 5490), ("972", 5490, 5490),
                  ("973", 2972, 2972), ("974", 2975, 2975), ("976", 4471, 4471), ("98", 2154, 2154),
                  ("975", 2154, 2154), ("000", 2154, 0), ("00", None, None), (None, None, None)],
          lambda c: srid_of(c, "literal"), lambda c: srid_of(c, "documented"))


def test_lot_borders_and_routable(spark):
    cases = [("01", "01_10"), ("10", "01_10"), ("11", "11_25"), ("25", "11_25"), ("26", "26_40"),
             ("40", "26_40"), ("41", "41_55"), ("55", "41_55"), ("56", "56_70"), ("70", "56_70"),
             ("71", "71_85"), ("85", "71_85"), ("86", "86_95"), ("95", "86_95"), ("971", "971_976"),
             ("98", "971_976"), ("96", "971_976"), ("2A", "2A_2B"), ("2B", "2A_2B"), ("000", "01_10"),
             ("00", "01_10"), ("ZZ", None), (None, None)]
    check(spark, [(d, lot, lot is not None) for d, lot in cases], lot_of, routable)


def test_commune_of_parcelle_and_type_prefix(spark):
    check(spark, [("59350000AB0012", "59350", "59350000"), ("subdivisions_fiscales", "subdi", "subdivis")],
          commune_of_parcelle, type_prefix)
