import pytest
from pyspark.sql import Row

from helpers import rows
from tallywork import schemas
from tallywork.operators.graph import degrees
from tallywork.sinks import save
from tallywork.sources import adjacency, files


def test_comma_file_with_crlf_and_bad_fields(spark, tmp_path):
    (tmp_path / "f.csv").write_bytes(b"10,Zoe,41,7\r\n11,Abel-Kim,28,90\r\n12,Ida,old,13\r\n13,Omar\r\n")
    assert rows(files.read_delimited(spark, str(tmp_path / "f.csv"), schemas.FRIENDS)) == [
        (10, "Zoe", 41, 7),
        (11, "Abel-Kim", 28, 90),
        (12, "Ida", None, 13),
        (13, "Omar", None, None),
    ]


def test_tab_file(spark, tmp_path):
    (tmp_path / "r").write_text("70\t801\t2\t1500000001\n71\t802\t4\t1500000002\n")
    assert rows(files.read_delimited(spark, str(tmp_path), schemas.RATINGS, sep="\t")) == [
        (70, 801, 2, 1500000001),
        (71, 802, 4, 1500000002),
    ]


def test_pipe_file_in_latin1_uses_the_first_two_fields(spark, tmp_path):
    (tmp_path / "t").write_bytes("1|Café (2031)|a||b|0|1\n2|Plain|a||b|1|0\n".encode("latin-1"))
    read = files.read_delimited(spark, str(tmp_path), schemas.TITLES, sep="|", encoding="ISO-8859-1")
    assert rows(read) == [(1, "Café (2031)"), (2, "Plain")]


def test_blank_separated_names_with_quotes(spark, tmp_path):
    (tmp_path / "n").write_text('1 "OLD OAK/TREE"\n2 "7-B HOUSE/ON HILL"\n3 PLAIN\n')
    assert rows(files.read_delimited(spark, str(tmp_path), schemas.NAMES, sep=" ")) == [
        (1, "OLD OAK/TREE"),
        (2, "7-B HOUSE/ON HILL"),
        (3, "PLAIN"),
    ]


def test_double_colon_file(spark, tmp_path):
    (tmp_path / "r").write_text("9::77::5::1500000003\n9::78::3.5::1500000004\n")
    read = files.read_delimited(spark, str(tmp_path), schemas.RATINGS_FRACTIONAL, sep="::")
    assert rows(read) == [(9, 77, 5.0, 1500000003), (9, 78, 3.5, 1500000004)]


def test_header_with_mark_and_inferred_types(spark, tmp_path):
    (tmp_path / "h.csv").write_bytes("\ufeffNo,HouseAge,Name\r\n1,32.0,a\r\n2,19.5,b\r\n".encode())
    read = files.read_with_header(spark, str(tmp_path / "h.csv"))
    assert read.dtypes == [("No", "int"), ("HouseAge", "double"), ("Name", "string")]
    assert rows(read.select("No", "HouseAge")) == [(1, 32.0), (2, 19.5)]


@pytest.mark.parametrize("sample", [1000, 2])
def test_types_of_a_sample_are_widened(spark, tmp_path, sample):
    """The same types and rows as inference from all rows, also where the first lines do not show them."""
    plain = [f"{i},{i},{i},,{i % 2 == 0},2026-01-{i % 28 + 1:02d},x{i}" for i in range(50)]
    odd = ["7,1.5,a,3,true,2026-01-01 10:00:00,y", "3000000000,2,b,4,maybe,never,z", "1,2", '8,"9",c,,,,"q,r"', "1,2,3,4,5,6,7,8"]
    (tmp_path / "f.csv").write_text("\n".join(["a,b,c,d,e,f,g", *plain, *odd, ""]))
    expected = spark.read.option("header", True).option("inferSchema", True).csv(str(tmp_path / "f.csv"))
    got = files.read_with_header(spark, str(tmp_path / "f.csv"), sample=sample)
    assert got.dtypes == expected.dtypes
    assert rows(got) == rows(expected)


def test_types_of_odd_files(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    assert files.read_with_header(spark, str(tmp_path / "empty.csv")).columns == []
    (tmp_path / "head.csv").write_text("a,b\n")
    assert files.read_with_header(spark, str(tmp_path / "head.csv")).columns == ["a", "b"]


def test_header_with_other_delimiter(spark, tmp_path):
    (tmp_path / "h.csv").write_text("a;b\n1;x\n")
    assert rows(files.read_with_header(spark, str(tmp_path / "h.csv"), sep=";")) == [(1, "x")]


def test_lines_and_blank_fields(spark, tmp_path):
    (tmp_path / "l").write_text("1\t2  5\n7 8\n")
    lines = files.read_lines(spark, str(tmp_path))
    assert lines.columns == ["value"]
    assert rows(lines.select(files.blank_field(2))) == [("5",), (None,)]


def test_split_fields(spark):
    lines = spark.createDataFrame([("1,Ann,20,3",), ("2,Bo,x,4",)], ["value"])
    assert rows(files.split_fields(lines, schemas.FRIENDS)) == [(1, "Ann", 20, 3), (2, "Bo", None, 4)]


def test_rows(spark):
    assert files.frame_from_rows(spark, [Row(id=1, name="a")]).columns == ["id", "name"]
    assert files.frame_from_rows(spark, [(1.0, 2.0)], ["label", "x"]).columns == ["label", "x"]
    assert rows(files.frame_from_rows(spark, [[5]], schemas.TITLES[:1])) == [(5,)]


def test_file_order(spark, tmp_path):
    written = [f"{(i * 7919) % 1000}\t{i}\t3\t0\n" for i in range(3000)]
    (tmp_path / "r").write_text("".join(written))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        read = files.in_file_order(files.read_delimited(spark, str(tmp_path), schemas.RATINGS, sep="\t"))
        assert read.rdd.getNumPartitions() > 5
        assert [r.movie_id for r in read.orderBy("line").collect()] == list(range(3000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_adjacency(spark):
    lines = spark.createDataFrame([("1 2 3 ",), ("1  2",), ("4",), ("",), ("x 1",), ("5 y 6",)], ["value"])
    parsed = adjacency.parse_adjacency(lines)
    assert rows(parsed) == [(1, [2, 3]), (1, [2]), (4, []), (5, [None, 6]), (None, None), (None, None)]
    assert rows(adjacency.edges_of(parsed)) == [(1, 2), (1, 2), (1, 3), (5, 6)]
    assert rows(adjacency.nodes_of(parsed)) == [(1,), (2,), (3,), (4,), (5,), (6,)]


def test_save_sorted(spark, tmp_path):
    df = spark.range(1000).repartition(5)
    save(df, str(tmp_path / "out"), fmt="csv", sort_by=("id",))
    parts = sorted((tmp_path / "out").glob("part-*"))
    assert [int(x) for p in parts for x in p.read_text().split()] == list(range(1000))


def test_columns_resolve_in_any_case(spark):
    assert rows(spark.createDataFrame([(1,)], ["userID"]).select("userId")) == [(1,)]


def test_lines_are_split_once(spark, tmp_path):
    (tmp_path / "g").write_text("1 2 3\n2 1\n")
    parsed = adjacency.parse_adjacency(files.read_lines(spark, str(tmp_path)))
    for df in (adjacency.edges_of(parsed), adjacency.nodes_of(parsed), degrees(files.read_lines(spark, str(tmp_path)))):
        assert df._jdf.queryExecution().executedPlan().toString().count("split(") == 1


def test_white_space_of_any_kind_around_fields(spark, tmp_path):
    (tmp_path / "g").write_text("5 6\t\n\t7 8\n\t1\t2\n")
    lines = files.read_lines(spark, str(tmp_path))
    assert rows(adjacency.edges_of(adjacency.parse_adjacency(lines))) == [(1, 2), (5, 6), (7, 8)]
    assert rows(degrees(lines)) == [(1, 1), (5, 1), (7, 1)]
    assert rows(lines.select(files.blank_field(2))) == [(None,), (None,), (None,)]
    assert rows(lines.select(files.blank_field(0))) == [("1",), ("5",), ("7",)]


def test_header_with_a_schema_reads_once(spark, tmp_path):
    (tmp_path / "h.csv").write_text("a,b\n1,x\n")
    read = files.read_with_header(spark, str(tmp_path / "h.csv"), schema="a long, b string")
    assert read.dtypes == [("a", "bigint"), ("b", "string")] and rows(read) == [(1, "x")]
