import pytest


@pytest.fixture
def images_and_tile(spark):
    images = spark.createDataFrame([
        ("a", 1, 1, 10.0, 0.0), ("b", 1, 3, 10.1, 0.1), ("c", 2, 1, 9.9, 0.0), ("d", 1, 2, 10.0, 0.0), ("far", 3, 1, 200.0, 0.0)],
        "filename string, expnum long, ccdnum int, ra_cent double, dec_cent double")
    images = images.selectExpr("*", "cast(null as string) as compression", "0.2D as ra_size", "0.1D as dec_size")
    tile = spark.createDataFrame([("T", 10.0, 0.0, 1.0, 1.0, "N")], "tilename string, ra_cent double, dec_cent double, ra_size double, dec_size double, crossra0 string")
    return images, tile
