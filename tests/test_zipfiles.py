import os
import resource
import zipfile

import pytest
from pyspark.sql import types as T

from haulage.sources import zipfiles

SCHEMA = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.FloatType()), T.StructField("s", T.StringType())])


def _zip(path, **members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in members.items():
            z.writestr(name.replace("__", "/").replace("_csv", ".csv").replace("_txt", ".txt"), text)


def test_members_types_and_missing_columns(spark, tmp_path):
    _zip(tmp_path / "one.zip", dir__x_csv="s,extra,a,b\nq,1,7,1.5\n,2,seven,\n", y_csv="a,s\n8,\"z, z\"\n", notes_txt="a\n1\n", empty_csv="")
    df = zipfiles.read_zip_csv(spark, str(tmp_path / "one.zip"), SCHEMA)
    assert df.rdd.getNumPartitions() == 3  # one per CSV member
    assert sorted(map(tuple, df.collect()), key=str) == sorted([(7, 1.5, "q"), (None, None, None), (8, None, "z, z")], key=str)
    assert df.schema.names == ["a", "b", "s"] and df.select("a").where("a = 8").count() == 1


def test_folder_of_archives_and_round_trip(spark, tmp_path):
    rows = [(i, i / 4, f"t{i}" if i % 3 else None) for i in range(1000)]
    src = spark.createDataFrame(rows, "a int, b float, s string").repartition(3)
    assert zipfiles.write_zip_csv(src, str(tmp_path / "out"), 100) >= 10
    assert len(os.listdir(tmp_path / "out")) == 3
    back = zipfiles.read_zip_csv(spark, str(tmp_path / "out"), SCHEMA)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(rows, key=str)


def test_no_archive_and_no_member(spark, tmp_path):
    _zip(tmp_path / "none.zip", notes_txt="x")
    assert zipfiles.read_zip_csv(spark, str(tmp_path / "none.zip"), SCHEMA).collect() == []
    with pytest.raises(Exception):
        zipfiles.read_zip_csv(spark, str(tmp_path / "gone.zip"), SCHEMA).collect()


def test_memory_does_not_grow_with_the_member(tmp_path):
    line = b"7,1.5," + b"x" * 94 + b"\n"
    with zipfile.ZipFile(tmp_path / "big.zip", "w", zipfile.ZIP_DEFLATED, compresslevel=1) as z, z.open("big.csv", "w") as m:
        m.write(b"a,b,s\n")
        for _ in range(300):
            m.write(line * 10_000)  # 300 MB in all
    reader = zipfiles.ZipCsvReader(SCHEMA, {"path": str(tmp_path / "big.zip")})
    part, = reader.partitions()
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    n = sum(b.num_rows for b in reader.read(part))
    assert n == 3_000_000 and resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 100 * 1024
