"""Canned inputs of the three domains (test fixtures only).

--- Fixed values: the compiled source rows, as published with the pipeline ---
"""

DEFORESTATION_ALL = [  # (year, biome, state, area_km2): yearly totals
    (2000, "Amazon", "ALL", 18226), (2001, "Amazon", "ALL", 18165), (2002, "Amazon", "ALL", 21651),
    (2003, "Amazon", "ALL", 25396), (2004, "Amazon", "ALL", 27772), (2005, "Amazon", "ALL", 19014),
    (2006, "Amazon", "ALL", 14286), (2007, "Amazon", "ALL", 11651), (2008, "Amazon", "ALL", 12911),
    (2009, "Amazon", "ALL", 7464), (2010, "Amazon", "ALL", 7000), (2011, "Amazon", "ALL", 6418),
    (2012, "Amazon", "ALL", 4571), (2013, "Amazon", "ALL", 5891), (2014, "Amazon", "ALL", 5012),
    (2015, "Amazon", "ALL", 6207), (2016, "Amazon", "ALL", 7893), (2017, "Amazon", "ALL", 6947),
    (2018, "Amazon", "ALL", 7536), (2019, "Amazon", "ALL", 10129), (2020, "Amazon", "ALL", 10851),
    (2021, "Amazon", "ALL", 13038), (2022, "Amazon", "ALL", 11568), (2023, "Amazon", "ALL", 9001),
    (2024, "Amazon", "ALL", 6288),
]

DEFORESTATION_BY_STATE = [  # (year, biome, state, area_km2)
    (2019, "Amazon", "PA", 3862), (2019, "Amazon", "MT", 1685), (2019, "Amazon", "AM", 1434),
    (2019, "Amazon", "RO", 1257), (2019, "Amazon", "MA", 859), (2019, "Amazon", "AC", 682),
    (2020, "Amazon", "PA", 3997), (2020, "Amazon", "AM", 1830), (2020, "Amazon", "MT", 1779),
    (2020, "Amazon", "RO", 1245), (2020, "Amazon", "MA", 929), (2020, "Amazon", "AC", 706),
    (2021, "Amazon", "PA", 5257), (2021, "Amazon", "AM", 2347), (2021, "Amazon", "MT", 2108),
    (2021, "Amazon", "MA", 1154), (2021, "Amazon", "RO", 1291),
    (2022, "Amazon", "PA", 4216), (2022, "Amazon", "AM", 2293), (2022, "Amazon", "MT", 1901),
    (2022, "Amazon", "RO", 1203), (2022, "Amazon", "MA", 894),
    (2023, "Amazon", "PA", 3025), (2023, "Amazon", "MT", 1600), (2023, "Amazon", "AM", 1490),
    (2023, "Amazon", "RO", 980), (2023, "Amazon", "MA", 710),
    (2024, "Amazon", "PA", 2100), (2024, "Amazon", "MT", 1200), (2024, "Amazon", "AM", 1050),
    (2024, "Amazon", "RO", 700), (2024, "Amazon", "MA", 520),
]

# Spending by function in billions, 2000 to 2024.
SPENDING_FROM_2000 = {
    "Saude": [42, 44, 47, 50, 54, 58, 62, 67, 72, 78, 82, 88, 95, 100, 107, 114, 122, 130, 137, 144, 148, 173, 190, 172, 195],
    "Educacao": [23, 25, 27, 29, 32, 35, 38, 42, 46, 52, 60, 68, 75, 83, 88, 93, 100, 108, 116, 124, 117, 133, 140, 148, 155],
    "Previdencia Social": [108, 117, 126, 138, 152, 166, 181, 200, 217, 237, 258, 282, 309, 338, 370, 405, 442, 483, 527, 575,
                           627, 684, 746, 814, 888],
    "Defesa Nacional": [18, 19, 21, 23, 25, 27, 29, 31, 33, 35, 37, 40, 43, 46, 49, 52, 55, 58, 61, 64, 66, 71, 75, 79, 84],
    "Assistencia Social": [5, 6, 7, 9, 12, 15, 18, 22, 26, 30, 35, 39, 44, 49, 55, 62, 69, 77, 86, 96, 140, 110, 105, 118, 125],
    "Meio Ambiente": [2.1, 2.3, 2.5, 2.8, 3.0, 3.2, 3.5, 3.8, 4.1, 3.9, 4.2, 4.5, 4.0, 3.8, 3.5, 3.2, 3.0, 2.8, 2.6, 2.4, 2.2,
                      2.5, 2.8, 3.1, 3.5],
    "Ciencia e Tecnologia": [3.5, 3.8, 4.0, 4.3, 4.8, 5.2, 5.7, 6.3, 6.9, 7.5, 8.0, 8.5, 9.0, 9.5, 9.0, 8.5, 8.0, 7.5, 7.0, 6.5,
                             6.0, 6.5, 7.0, 7.5, 8.0],
    "Seguranca Publica": [4.0, 4.3, 4.6, 5.0, 5.5, 6.0, 6.5, 7.0, 7.5, 8.0, 8.5, 9.0, 9.5, 10.0, 10.5, 11.0, 11.5, 12.0, 12.5,
                          13.0, 13.5, 14.0, 14.5, 15.0, 15.5],
}

# Tax: brackets with effective rates, declaration distribution, yearly national
# totals (millions of declarations, billions of tax).
TAX_BRACKETS = [
    ("Ate 2 SM", 0.02), ("2 a 5 SM", 0.05), ("5 a 10 SM", 0.08), ("10 a 20 SM", 0.12),
    ("20 a 40 SM", 0.18), ("40 a 80 SM", 0.22), ("Acima de 80 SM", 0.15),
]
TAX_BRACKET_DIST = [0.35, 0.28, 0.15, 0.10, 0.06, 0.04, 0.02]
TAX_YEARLY = [
    (2008, 25.2, 130), (2009, 24.4, 125), (2010, 24.0, 140), (2011, 25.2, 155), (2012, 26.0, 165),
    (2013, 26.5, 175), (2014, 27.0, 185), (2015, 27.5, 190), (2016, 28.3, 195), (2017, 28.8, 210),
    (2018, 30.5, 225), (2019, 31.1, 240), (2020, 32.0, 220), (2021, 34.0, 260), (2022, 36.3, 290),
    (2023, 38.0, 310), (2024, 40.0, 330),
]
# --- end of fixed values ------------------------------------------------------


def deforestation_raw(spark):
    rows = [(str(y), b, s, str(a)) for y, b, s, a in DEFORESTATION_ALL + DEFORESTATION_BY_STATE]
    return spark.createDataFrame(rows, "year string, biome string, state string, area_km2 string")


def spending_raw(spark):
    from pyspark.sql import functions as F

    from strata.plans import spending

    series = spark.createDataFrame([(k, [float(x) for x in v]) for k, v in SPENDING_FROM_2000.items()], "name string, vals array<double>")
    rows = spending.from_series(series, "name", "vals", 2000)
    return rows.select(*[F.col(c).cast("string").alias(c) for c in spending.RAW_COLUMNS])


def tax_raw(spark):
    from pyspark.sql import functions as F

    from strata.plans import tax

    yearly = spark.createDataFrame(
        [(y, int(d * 1e6), t * 1e9) for y, d, t in TAX_YEARLY],
        "year int, total_declarations bigint, total_tax double",
    )
    brackets = spark.createDataFrame(
        [(y, name, share, rate) for y, _, _ in TAX_YEARLY for (name, rate), share in zip(TAX_BRACKETS, TAX_BRACKET_DIST)],
        "year int, income_bracket string, decl_share double, rate double",
    )
    rows = tax.allocate_compiled(yearly, brackets)
    return rows.select(*[F.col(c).cast("string").alias(c) for c in tax.RAW_COLUMNS])
