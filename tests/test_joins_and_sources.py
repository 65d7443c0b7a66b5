import os

import pytest
from pyspark.sql import functions as F

from checks import registry
from checks.adapters import Fixture
from morbidity.config import Config
from morbidity.operators import joins
from morbidity.sources import files, readers, schemas, writers

CFG = Config()


@pytest.fixture
def skewed(spark):
    """A third of 9,000 rows on one key; some keys unknown to the other side, some null."""
    key = F.expr("case when id % 3 = 0 then 1 when id % 50 = 1 then null else id % 700 end")
    events = spark.range(9000).select(key.cast("long").alias("patid"), "id")
    people = spark.range(600).select(F.col("id").alias("patid"), (F.col("id") + 1900).alias("yob"))
    return events, people


@pytest.mark.parametrize("how", ["inner", "left_semi"])
def test_equal_rows_of_a_hot_key_are_split(spark, how):
    """The adaptive skew join deals a hot patient's rows, all equal, to several tasks."""
    lowered = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    }
    before = {k: spark.conf.get(k, None) for k in lowered}
    for k, v in lowered.items():
        spark.conf.set(k, v)
    try:
        hot = spark.range(0, 30_000, 1, 8).select(F.lit(1).cast("long").alias("patid"))
        events = hot.union(spark.range(2, 60, 1, 2).toDF("patid"))
        out = joins.lookup_join(events, spark.range(50).toDF("patid"), "patid", how)
        tasks = out.where("patid = 1").groupBy(F.spark_partition_id()).count().collect()
        assert len(tasks) > 1 and sum(r["count"] for r in tasks) == 30_000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_restrict_to(skewed, rows):
    events, people = skewed
    some = people.where("patid < 3").unionByName(people.where("patid = 1"))
    assert rows(joins.restrict_to(events, some)) == rows(events.where("patid < 3"))


def _write(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write(text)


def test_tab_and_pipe_delimited(spark, tmp_path, rows):
    _write(tmp_path / "t", "a.txt", "patid\tdod\tmatch_rank\n1\t05/04/2010\t2\n2\t\t\n")
    out = readers.read_delimited(spark, str(tmp_path / "t"), schemas.DEATH_REGISTER)
    assert rows(out) == [(1, "2010-04-05", 2), (2, None, None)]
    _write(tmp_path / "p", "m.txt", "gemscript_drug_code|dmd_code\n001|7\n")
    assert rows(readers.read_delimited(spark, str(tmp_path / "p"), schemas.GEMSCRIPT_MAP, sep="|")) == [("001", 7)]


def test_codelist_folder_skips_subfolders(spark, tmp_path, rows):
    _write(tmp_path, "a.csv", "disease,medcodeid,descr,system\nA,1,x,Cancers\n")
    _write(tmp_path, "b.csv", 'disease,medcodeid,descr,system\nB,2,"x, y",Other\n')
    _write(tmp_path, "notes.txt", "no\n")
    _write(tmp_path / "old", "c.csv", "disease,medcodeid,descr,system\nC,3,x,Other\n")
    out = readers.read_codelist_dir(spark, str(tmp_path), schemas.MEDCODE_LIST)
    assert rows(out, "disease", "medcodeid", "descr") == [("A", 1, "x"), ("B", 2, "x, y")]


def test_columns_are_taken_by_name(spark, tmp_path, rows):
    _write(tmp_path / "d", "imd.txt", "e_pracid\te_patid\tnote\timd2015_decile\n900\t1\tx\t3\n901\t2\t\tabc\n")
    raw = readers.raw_text(spark, str(tmp_path / "d"))
    assert rows(readers.typed(raw, schemas.DEPRIVATION, prefix="e_")) == [(1, 3), (2, None)]
    assert rows(readers.unparsed(raw, schemas.DEPRIVATION, prefix="e_")) == [("imd2015_decile", 1), ("patid", 0)]
    with pytest.raises(ValueError, match="patid"):
        readers.typed(raw, schemas.DEPRIVATION)
    assert rows(readers.typed(raw, "x date, e_patid long", optional=("x",))) == [(None, 1), (None, 2)]


def test_codelist_files_of_differing_columns(spark, tmp_path, rows):
    _write(tmp_path, "a.csv", "descr,system,disease,medcodeid\nx,Cancers,A,1\n")
    _write(tmp_path, "b.csv", "medcodeid,extra,disease,descr\n2,z,B,y\n")
    out = readers.read_codelist_dir(spark, str(tmp_path), schemas.MEDCODE_LIST, optional=("system",))
    assert rows(out) == [("A", 1, "x", "Cancers"), ("B", 2, "y", None)]
    with pytest.raises(ValueError, match="system"):
        readers.read_codelist_dir(spark, str(tmp_path), schemas.MEDCODE_LIST)
    assert readers.read_codelist_dir(spark, str(tmp_path / ""), schemas.MEDCODE_LIST, optional=("system",)).count() == 2


def test_files_of_one_table_must_agree(spark, tmp_path):
    _write(tmp_path, "a.txt", "patid\tdod\tmatch_rank\n1\t05/04/2010\t2\n")
    _write(tmp_path, "b.txt", "dod\tpatid\tmatch_rank\n05/04/2010\t2\t2\n")
    with pytest.raises(Exception, match="header"):
        readers.read_delimited(spark, str(tmp_path), schemas.DEATH_REGISTER).collect()


def test_tagged_folder(spark, tmp_path, rows):
    _write(tmp_path, "CPRDCAM_CON150_PC_V1-1_Oct.csv", "gemscriptcode\ng1\ng2\n")
    _write(tmp_path, "CPRDCAM_PNC166_PC_V1-1_Oct.csv", "name,gemscriptcode,form\nsyrup,g3,oral\n")
    _write(tmp_path, "CPRDCAM_XXX000_MC_V1-1_Oct.csv", "gemscriptcode\ng9\n")
    out = readers.read_tagged_dir(spark, str(tmp_path), schemas.DRUG_LIST)
    assert rows(out) == [("CON150", "g1"), ("CON150", "g2"), ("PNC166", "g3")]


def test_unlike_files_are_one_scan(spark, tmp_path, rows):
    _write(tmp_path / "a b", "1.txt", "\ufeffe_patid\tE_DOD\tmatch_rank\n1\t05/04/2010\t2\n2\t31/02/2010\tx\n")
    _write(tmp_path / "a b", "2.txt", "Rank\tnote\tPATID\n7\tz\t3\n\t\t4\n5\n")
    _write(tmp_path / "a b", "3.txt", "e_dod\tmatch_rank\tpatid\n")
    _write(tmp_path / "a b", "_SUCCESS", "")
    source = files.Source(schemas.DEATH_REGISTER, prefix="e_", optional=("dod",), renamed={"rank": "match_rank"})
    read = files.read_source(spark, str(tmp_path / "a b"), source)
    assert rows(files.parsed(read)) == sorted([(1, "2010-04-05", 2), (2, None, None), (3, None, 7), (4, None, None), (None, None, 5)], key=repr)
    assert rows(files.rejects(read), "column", "value") == [("dod", "31/02/2010"), ("match_rank", "x")]
    assert {r.file.split("/")[-1] for r in files.rejects(read).collect()} == {"1.txt"}
    assert read._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 1
    with pytest.raises(ValueError, match="dod"):
        files.read_source(spark, str(tmp_path / "a b"), files.Source(schemas.DEATH_REGISTER, renamed={"rank": "match_rank"}, prefix="e_"))
    assert files.read_source(spark, str(tmp_path / "none*"), source).collect() == []


def test_a_text_is_parsed_once_and_good_rows_build_no_rejects(spark, tmp_path, rows):
    _write(tmp_path, "a.txt", "patid\tdod\tmatch_rank\n1\t05/04/2010\t2\nx\t31/02/2010\t z \n3\t \t\n\t1/2/2010\t4\n")
    read = files.read_source(spark, str(tmp_path), files.Source(schemas.DEATH_REGISTER))
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert plan.count("gettimestamp(") == 1 and plan.count("try_cast(") == 2 and "lambda" not in plan and "regexp" not in plan
    assert rows(files.parsed(read)) == sorted([(1, "2010-04-05", 2), (None, None, None), (3, None, None), (None, None, 4)], key=repr)
    assert [[tuple(x) for x in r.rejected] for r in read.orderBy(F.size("rejected")).collect()] == [
        [], [], [("dod", "1/2/2010")], [("patid", "x"), ("dod", "31/02/2010"), ("match_rank", " z ")]]


def test_two_hundred_unlike_files_are_a_scan_for_each_separator(spark, tmp_path):
    f = Fixture(spark, "/root/testdata/sf0.001")
    registry.write_unlike_files(f, str(tmp_path / "u"))
    read = files.read_source(spark, str(tmp_path / "u/file=*"), registry.ORDERS)
    assert len(os.listdir(tmp_path / "u")) > 200  # with Spark's mark
    assert read._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 2
    assert files.parsed(read).count() == f.base("orders").count() and files.rejects(read).isEmpty()


def test_bucketed_tables_meet_without_an_exchange(spark, make):
    keep = writers.by_key("patid", 4)
    a = keep(spark.range(1000).select((F.col("id") % 90).alias("patid"), "id"), "a")
    b = keep(spark.range(80).select(F.col("id").alias("patid"), F.lit(1).alias("x")), "b")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    joined = a.hint("merge").join(b, "patid").groupBy("patid").agg(F.max("id"))
    assert "Exchange" not in plan(joined) and joined.count() == 80
    assert "Exchange" not in plan(a.groupBy("patid", "id").count())
    assert keep(spark.range(3), "c").count() == 3


def test_column_names_and_empty_columns(make, rows):
    df = make("e_patid long, name_e_x string, `Date Of-Birth` string", [(1, None, "a"), (2, None, None)])
    assert readers.strip_prefix(df).columns == ["patid", "name_e_x", "Date Of-Birth"]
    assert readers.drop_all_null_columns(df).columns == ["e_patid", "Date Of-Birth"]


def test_disease_map_file(spark, tmp_path, rows):
    head = "Disease,Disease (REAL),c,d,e,f,g,h,i\n"
    _write(tmp_path, "map.csv", head + "Atrial fib x,Atrial fibrilation,,,,,,,z\nGout,Gout,,,,,,,z\n")
    out = readers.read_disease_map(spark, str(tmp_path / "map.csv"), CFG)
    assert rows(out, "Disease", "list_disease_real", "main_cond") == [
        ("Atrial_fib_x", "Atrial fibrillation", 1), ("Gout", "Gout", 0)]


def test_tables_and_named_tables(spark, tmp_path, make, rows):
    df = make("patid long, bucket int, x string", [(1, 0, "a"), (2, 1, "b")])
    writers.write_table(df, str(tmp_path / "t"), ["bucket"])
    assert sorted(os.listdir(tmp_path / "t"))[:4] and (tmp_path / "t" / "bucket=0").is_dir()
    assert rows(readers.read_table(spark, str(tmp_path / "t"), ["patid", "x"])) == [(1, "a"), (2, "b")]
    keep = writers.Addressed(str(tmp_path / "n"))
    first, again = keep(df, "x"), keep(df, "x")
    assert rows(first) == rows(again) == rows(df) and first.inputFiles() == again.inputFiles()
    assert rows(readers.read_table(spark, str(tmp_path / "n*/x/*"), ["x"], "x string")) == [("a",), ("b",)]


def test_resume_after_a_broken_write(tmp_path, make, rows):
    df = make("patid long, x string", [(1, "a"), (2, "b")])
    keep = writers.Addressed(str(tmp_path))
    os.makedirs(f"{keep.path(df, 'empty')}/_temporary/0")
    os.makedirs(keep.path(df, "nothing"))
    keep(df, "half")
    os.remove(f"{keep.path(df, 'half')}/_SUCCESS")  # as if moving its files had broken off
    assert not keep.has(df, "half")
    for name in ("empty", "nothing", "half"):
        assert rows(keep(df, name)) == rows(df) and keep.has(df, name)


def test_a_table_is_made_anew_when_what_it_is_made_from_changes(spark, tmp_path, rows):
    """Files, settings and rules count, the order of building and the session's numbers don't; what follows unchanged tables is not made again."""
    source, keep = str(tmp_path / "in"), writers.Addressed(str(tmp_path / "out"))
    spark.range(10).write.parquet(source)

    def build(least, factor):
        raw = spark.read.parquet(source)
        small = keep(raw.where(F.col("id") >= least).select("id", F.transform(F.array("id"), lambda x: x + 1).alias("a")), "small")
        return small, keep(small.withColumn("y", F.col("id") * factor), "wide")

    def places(tables):
        return [sorted(t.inputFiles()) for t in tables]

    first = places(build(2, 3))
    spark.range(5).select(F.transform(F.array("id"), lambda x: x * 2)).collect()
    assert places(build(2, 3)) == first
    other = places(build(2, 4))
    assert other[0] == first[0] and other[1] != first[1]
    assert all(a != b for a, b in zip(places(build(3, 3)), first))
    spark.range(3).write.mode("append").parquet(source)
    grown = build(2, 3)
    assert all(a != b for a, b in zip(places(grown), first)) and grown[1].count() == 9


def test_reports_and_stage(spark, tmp_path, make, rows):
    df = make("report string, fyear int, x double", [("a", 2008, 1.0), ("a", 2009, 2.0), ("b", 2008, 3.0)])
    writers.write_reports({"score": df}, str(tmp_path))
    assert sorted(p for p in os.listdir(tmp_path / "score") if "=" in p) == ["report=a", "report=b"]
    assert rows(writers.read_report(spark, str(tmp_path), "score", "a")) == [(2008, 1.0), (2009, 2.0)]
    shuffled = df.unionByName(make("report string, fyear int, x double", [("a", 2007, 0.0)])).repartition(3, "x")
    writers.write_reports({"score": shuffled}, str(tmp_path / "in_order"))
    assert [r.fyear for r in writers.read_report(spark, str(tmp_path / "in_order"), "score", "a").collect()] == [2007, 2008, 2009]
    staged = writers.stage(df, "t")
    assert rows(staged) == rows(df) and staged.schema == df.schema
    assert writers.shared_folder(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
