from __future__ import annotations

import pytest
from helpers import rows
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    ByteType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    TimestampType,
)

from chirplake.sources import generations


@pytest.mark.parametrize(
    ("one", "other", "wanted"),
    [
        (IntegerType(), LongType(), LongType()),
        (ByteType(), FloatType(), FloatType()),
        (IntegerType(), FloatType(), DoubleType()),
        (LongType(), DoubleType(), StringType()),
        (LongType(), DecimalType(10, 2), DecimalType(21, 2)),
        (DecimalType(38, 0), DecimalType(10, 5), StringType()),
        (DateType(), TimestampType(), TimestampType()),
        (BooleanType(), IntegerType(), StringType()),
        (StringType(), IntegerType(), StringType()),
    ],
)
def test_widest_type(one, other, wanted):
    assert generations.widest(one, other) == wanted == generations.widest(other, one)


def write(spark, path, *columns, n=3):
    spark.range(n).select(*[F.expr(c) for c in columns]).coalesce(1).write.mode("append").parquet(path)


def test_generations_are_read_under_one_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    write(spark, path, "id", "cast(id as int) as v")
    write(spark, path, "id", "cast(id + 10 as int) as v")
    write(spark, path, "id", "id + 20 as v", "true as extra")
    write(spark, path, "concat('t', id) as v", "id")
    found = generations.read_reconciled(spark, path)
    assert found.dtypes == [("id", "bigint"), ("v", "string"), ("extra", "boolean")]
    wanted = [(i, str(i + base), None) for base in (0, 10) for i in range(3)]
    wanted += [(i, str(i + 20), True) for i in range(3)] + [(i, f"t{i}", None) for i in range(3)]
    assert sorted(rows(found), key=repr) == sorted(wanted, key=repr)


def test_few_groups_however_many_files(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(9):
        write(spark, path, "id" if i < 4 else "cast(id as double) as id")
    files = sorted(str(f) for f in (tmp_path / "t").glob("*.parquet"))
    files.sort(key=lambda f: (tmp_path / "t" / f).stat().st_mtime_ns)
    groups = generations.generations(spark, files)
    assert sorted(len(part) for _, part in groups) == [4, 5]
    assert generations.read_reconciled(spark, path).dtypes == [("id", "string")]


def test_no_files(spark, tmp_path):
    (tmp_path / "t").mkdir()
    with pytest.raises(FileNotFoundError):
        generations.read_reconciled(spark, str(tmp_path / "t"))
