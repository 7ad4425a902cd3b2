"""Fixed values of the domain: constants, the region and data-group dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed values, equal to the reference's for equal results.
WATER, ICE, OCEAN_KM2, SEASONAL_ERROR = 997.0, 850.0, 3.625e8, 0.1
GRACE_GAP = (2017.4, 2018.6)
GRACE_ROW = "2017-07-01"
NODATA_LIMIT = {"m": 100.0, "mwe": 100.0, "gt": 10_000.0}
REGION_COLUMNS = "rgi_id int, name string, long_name string, short_name string, rgi5_area double, rgi6_area double, rgi7_area double, area_change double, area_change_reference_year int, glaciological_year_start double, area_uncertainty_percentage double"
REGIONS = [
    (0, "global", "Global", "N/A", 705569.0, 705644.0, 706744.0, None, None, 0.0, None),
    (1, "alaska", "Alaska", "ALA", 86725.0, 86725.0, 86708.0, -0.48, 2009, 0.75, 0.05),
    (2, "western_canada_us", "Western Canada & US", "WNA", 14556.0, 14524.0, 14521.0, -0.54, 2003, 0.75, 0.05),
    (3, "arctic_canada_north", "Arctic Canada North", "ACN", 105128.0, 105111.0, 105370.0, -0.07, 2000, 0.75, 0.05),
    (4, "arctic_canada_south", "Arctic Canada South", "ACS", 40888.0, 40888.0, 40538.0, -0.08, 2001, 0.75, 0.05),
    (5, "greenland_periphery", "Greenland Periphery", "GRL", 89717.0, 89717.0, 90482.0, -0.82, 2000, 0.75, 0.05),
    (6, "iceland", "Iceland", "ISL", 11060.0, 11060.0, 11060.0, -0.36, 2001, 0.75, 0.05),
    (7, "svalbard", "Svalbard", "SJM", 33959.0, 33959.0, 33959.0, -0.26, 2007, 0.75, 0.05),
    (8, "scandinavia", "Scandinavia", "SCA", 2851.0, 2949.0, 2948.0, -0.27, 2003, 0.75, 0.05),
    (9, "russian_arctic", "Russian Arctic", "RUA", 51592.0, 51592.0, 51595.0, -0.08, 2005, 0.75, 0.05),
    (10, "north_asia", "North Asia", "ASN", 2410.0, 2410.0, 2643.0, -0.43, 2003, 0.75, 0.05),
    (11, "central_europe", "Central Europe", "CEU", 2075.0, 2092.0, 2124.0, -0.93, 2004, 0.75, 0.05),
    (12, "caucasus_middle_east", "Caucasus & Middle East", "CAU", 1295.0, 1307.0, 1407.0, -0.53, 2000, 0.75, 0.05),
    (13, "central_asia", "Central Asia", "ASC", 49303.0, 49303.0, 50344.0, -0.18, 2001, 0.75, 0.05),
    (14, "south_asia_west", "South Asia West", "ASW", 33568.0, 33568.0, 33075.0, -0.36, 2001, 0.75, 0.05),
    (15, "south_asia_east", "South Asia East", "ASE", 14734.0, 14734.0, 16049.0, -0.47, 2001, 0.75, 0.05),
    (16, "low_latitudes", "Low Latitudes", "TRP", 2346.0, 2341.0, 1929.0, -1.19, 1999, 0.0, 0.05),
    (17, "southern_andes", "Southern Andes", "SAN", 29333.0, 29429.0, 27674.0, -0.18, 2002, 0.25, 0.05),
    (18, "new_zealand", "New Zealand", "NZL", 1162.0, 1162.0, 886.0, -0.69, 2001, 0.25, 0.05),
    (19, "antarctic_and_subantarctic", "Antarctic & Subantarctic", "ANT", 132867.0, 132867.0, 133432.0, -0.27, 1991, 0.25, 0.05),
]
DATA_GROUPS = ["altimetry", "demdiff", "gravimetry", "glaciological", "combined", "demdiff_and_glaciological", "consensus"]


def regions(spark: SparkSession, rgi_version: int = 6) -> DataFrame:
    """The region dimension of 20 rows, with `area` of the chosen inventory version."""
    return spark.createDataFrame(REGIONS, REGION_COLUMNS).selectExpr("*", f"rgi{int(rgi_version)}_area AS area")


def data_groups(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(g, g.replace("_", " ")) for g in DATA_GROUPS], "name string, long_name string")
