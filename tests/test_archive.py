from abyssal import standin
from abyssal.queries import QUERIES

DATA = "/root/testdata/sf0.001"


def test_text_is_made_after_the_events_are_dealt_and_sorted_once(spark):
    spark.conf.set("spark.sql.maxPlanStringLength", "1000000")
    for make in standin.ARCHIVE.values():
        lines = make(standin.events(spark, DATA))
        plan = lines._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression", 1)
        assert "AS text" in plan[0] and "AS text" not in plan[1] and "date_format(ts" not in plan[1].split("file#")[0]
        assert not any(f.nullable for f in lines.schema.fields if f.name != "text")


def test_an_archive_holds_the_kinds_that_are_read(spark):
    names = lambda *kinds: {r.path.rsplit("/", 1)[1].split("_")[0].split("-")[0] for r in spark.read.format("binaryFile").option("recursiveFileLookup", True)
                            .load(standin.archive(spark, "/root/testdata/../testdata/sf0.001", *kinds)).select("path").collect()}
    assert names("exports") == {"PAR", "hobo", "gems"}
    assert names() == {"PAR", "hobo", "gems", "surface"}


def test_queries_on_exports_write_no_logs(spark, monkeypatch):
    asked, archive = [], standin.archive
    monkeypatch.setattr(standin, "archive", lambda spark, d, *kinds: asked.append(kinds) or archive(spark, d, *kinds))
    for name in ("AGG13", "DOM12", "FLT09"):
        QUERIES[name](spark, DATA)
    assert asked == [("exports",)] * 3
