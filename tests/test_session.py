from silverline.functions.dates import parse_date
from silverline.session import tune


def test_long_steps_are_not_one_method(spark):
    before = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    try:
        spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
        # the JVM compiles no method above this size, and a row of dates then costs several times as much
        assert int(tune(spark).conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000
        rows = spark.createDataFrame([(1, "2024-05-01", "1/2/2024"), (2, "May 3, 2024", None)], "id int, a string, b string").repartition(1)
        cleaned = rows.select("id", parse_date("a").alias("a"), parse_date("b").alias("b"))
        assert [tuple(map(str, r)) for r in cleaned.orderBy("id").collect()] == [("1", "2024-05-01", "2024-02-01"), ("2", "2024-05-03", "None")]
    finally:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", before)
