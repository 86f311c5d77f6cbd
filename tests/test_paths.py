from pyspark.sql import functions as F

from rostrum.functions.paths import storage_prefix
from rostrum.operators.paths import list_prefixes


def test_prefix_rules(spark):
    cases = {"/home/airflow/gcs/dags/team/job.py": "dags/team/", "/srv/x/dags/team/job.py": "dags/team/",
             "/mnt/gcs/data/a/job.py": "gcs/data/a/", "/opt/app/job.py": "/opt/app/",
             "/home/airflow/gcs/job.py": "/", "/opt//app/./x/": "/opt/app/", "job.py": "/",
             "/a/b/../c/x.py": "/a/c/", "//srv/x.py": "//srv/", "a/../../x": "../", "/../x.py": "/"}
    df = spark.createDataFrame([(k,) for k in cases], "path string")
    got = {r["path"]: r["p"] for r in df.select("path", storage_prefix(F.col("path")).alias("p")).collect()}
    assert got == cases


def test_listing(spark):
    objs = spark.createDataFrame([("a/x.txt",), ("a/b/y.txt",), ("a/b/z/w.txt",), ("a/c/",), ("q/r.txt",)], "path string")
    pre = spark.createDataFrame([("a/",), ("a/b/",)], "prefix string")
    got = sorted(tuple(r) for r in list_prefixes(objs, pre).collect())
    assert got == sorted([("a/", "file", "a/x.txt"), ("a/", "folder", "a/b/"), ("a/", "folder", "a/c/"),
                          ("a/b/", "file", "a/b/y.txt"), ("a/b/", "folder", "a/b/z/")])
