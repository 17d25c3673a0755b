import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import codec


def one(spark, column, values="1"):
    return spark.range(1).select(column.alias("x")).first().x


def test_bytes(spark):
    assert one(spark, codec.bytes_text(F.unhex(F.lit("68656c6c6f")))) == "hello"
    assert one(spark, codec.bytes_text(F.unhex(F.lit("fffe")))) == "//4="
    assert one(spark, codec.bytes_text(F.unhex(F.lit("fffe")), "latin-1")) == "ÿþ"


def test_time_and_sets(spark):
    for seconds, text in ((3723, "01:02:03"), (-90, "-00:01:30"), (838 * 3600, "838:00:00"), (0, "00:00:00")):
        assert one(spark, codec.time_text(F.lit(seconds))) == text
    assert one(spark, codec.set_text(F.array(F.lit("b"), F.lit("a")))) == "a,b"


def test_decode(spark):
    ntz = T.TimestampNTZType()
    assert one(spark, codec.decode(F.lit("2024-01-15T12:30:00.123456"), ntz)) == datetime.datetime(2024, 1, 15, 12, 30, 0, 123000)
    assert one(spark, codec.decode(F.lit("2024-01-15 12:30:00.9"), ntz)) == datetime.datetime(2024, 1, 15, 12, 30)
    assert one(spark, codec.decode(F.lit("2024-01-15"), T.DateType())) == datetime.date(2024, 1, 15)
    assert one(spark, codec.decode(F.lit("x"), T.IntegerType())) is None
    assert one(spark, codec.decode(F.lit("true"), T.ByteType())) == 1
    assert one(spark, codec.decode(F.lit(""), T.StringType())) == ""


def test_positions(spark):
    def key(file, pos):
        return tuple(one(spark, codec.position_key(F.lit(file).cast("string"), F.lit(pos))))

    assert key("bin.000999", 100) < key("bin.001000", 1)
    assert key("bin.000001", 100) < key("bin.000001", 200)
    assert key("", 10) == key(None, 10) == ("", 0, 0)
    assert tuple(one(spark, codec.parse_position(F.lit("bin.1:20")))) == ("bin.1", 20)
    assert one(spark, codec.parse_position(F.lit("bin.1"))) is None


def test_nulls_count_in_keys(spark):
    a = one(spark, codec.row_key(F.lit("a"), F.lit(None), F.lit("b")))
    assert a != one(spark, codec.row_key(F.lit("a"), F.lit("b")))
    assert a != one(spark, codec.row_key(F.lit("a"), F.lit(""), F.lit("b")))


def test_comments(spark):
    for text, left in (("-- note\nCREATE TABLE t", "CREATE TABLE t"), ("/* b */\n# c\nDROP TABLE t ", "DROP TABLE t"), ("-- only", ""), (None, "")):
        assert one(spark, codec.strip_comments(F.lit(text).cast("string"))) == left
