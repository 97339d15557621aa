import datetime as dt
from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F

import citations as c
from paperloom.functions import xml
from paperloom.operators.changelog import ArticleStore, live_rows
from paperloom.sources import change_files as cf
from paperloom.streaming.article_stream import apply_change_stream


def rows(df, key="pmid"):
    return {r[key]: r.asDict() for r in df.collect()}


@pytest.fixture
def folder(tmp_path, write_gz):
    path = tmp_path / "xml"
    path.mkdir()
    rich = c.article(
        100, title="Effect of <i>x</i> on y", date="<Year>2024</Year><Month>Mar</Month><Day>5</Day>",
        body=c.RICH_BODY, authors=c.RICH_AUTHORS, journal_extra="<Volume>33</Volume><Issue>1</Issue>",
    )
    book = "<PubmedBookArticle><BookDocument><PMID Version='1'>9</PMID></BookDocument></PubmedBookArticle>\n"
    write_gz(path / "med24n0001.xml.gz", c.citation_set(
        c.article(1), c.article(2, title="old"), c.article(2, title="newer"), book, rich, c.deletes([2])))
    write_gz(path / "med24n0002.xml.gz", c.citation_set(
        c.article(2, title="back"), c.article(3, version="2"), c.article(4), c.article(5), c.deletes([1, 4], [77, 5])))
    write_gz(path / "med24n0003.xml.gz", c.citation_set(c.article(4, title="<b>all</b> markup")))
    write_gz(path / "notes.xml.gz", c.citation_set(c.article(6)))
    (path / "ignored.txt").write_text("x")
    return str(path)


def test_list_files(spark, folder):
    names = [r.file_name for r in cf.list_change_files(spark, folder).collect()]
    assert names == ["med24n0001.xml.gz", "med24n0002.xml.gz", "med24n0003.xml.gz", "notes.xml.gz"]


def test_rich_record(spark, folder):
    got = rows(cf.parse_articles(cf.read_chunks(spark, folder)))[100]
    expected = {
        "title": "Effect of ",
        "abstract": "AIM & SCOPE\nFirst \n\na>b\nPlain <text> with α end.\n\nraw < & data tail",
        "publication_date": dt.date(2024, 3, 5),
        "mesh_terms": "Humans\nMice",
        "keywords": "alpha\nbeta ",
        "chemicals": "Aspirin",
        "authors": "Yang, J\nThe Group\nPlato",
        "journal_name": "J Test",
        "year": 2024,
        "volume": "33",
        "issue": "1",
        "pagination": "289-302",
        "publication_types": "Journal Article\nReview",
        "file_number": 1,
        "error": None,
    }
    assert {k: got[k] for k in expected} == expected


def test_full_text_mode(spark, folder):
    got = rows(cf.parse_articles(cf.read_chunks(spark, folder), text_mode="full"))[100]
    assert got["title"] == "Effect of x on y"
    assert got["abstract"].startswith("AIM & SCOPE\nFirst part cut.\n\na>b\nPlain <text>")
    assert "\n\nStarts with markup\n\n" in got["abstract"]
    assert got["keywords"] == "alpha\nbeta 2\nx"


def test_optional_elements_are_null(spark, folder):
    got = rows(cf.parse_articles(cf.read_chunks(spark, folder)))[1]
    for name in ("abstract", "mesh_terms", "keywords", "chemicals", "authors", "volume", "issue",
                 "pagination", "publication_types"):
        assert got[name] is None
    assert got["publication_date"] == dt.date(2001, 1, 1)


def test_leading_text_agrees_with_a_parser(spark):
    samples = [
        "<T>plain</T>", "<T/>", "<T a='1'/>", "<T></T>", "<T> <i>x</i></T>", "<T><i>x</i>y</T>",
        "<T a=\"x>y\">v &amp; w &#65;</T>", "<T>a<!-- c -->b</T>", "<T>l1\r\nl2</T>", "<T>q<![CDATA[<i>]]>r</T>",
        "<T>été “q” </T>", "<Tx>no</Tx>", "<T>  spaced  </T>",
    ]
    df = spark.createDataFrame([(i, f"<R>{s}</R>") for i, s in enumerate(samples)], "i int, x string")
    got = {r.i: r.t for r in df.select("i", xml.leading_text(xml.clean_record(F.col("x")), "T").alias("t")).collect()}
    for i, s in enumerate(samples):
        element = ElementTree.fromstring(f"<R>{s}</R>").find("T")
        assert got[i] == (element.text if element is not None else None), s


def test_changes_in_one_scan(spark, folder):
    changes = cf.read_changes(spark, folder)
    plan = changes._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1
    live = rows(live_rows(changes))
    assert set(live) == {2, 4, 6, 100}
    assert live[2]["title"] == "back" and live[4]["title"] is None
    assert live[6]["file_number"] is None


def test_first_delete_only(spark, folder):
    live = rows(live_rows(cf.read_changes(spark, folder, first_delete_only=True)))
    assert set(live) == {2, 4, 5, 6, 100}
    ids = cf.parse_deletes(cf.read_chunks(spark, folder), first_only=True)
    assert sorted(r.pmid for r in ids.collect()) == [1, 2, 77]


def test_unreadable_records(spark, tmp_path, write_gz):
    bad = tmp_path / "bad"
    bad.mkdir()
    write_gz(bad / "xn0001.xml.gz", c.citation_set(
        c.article(1),
        c.article(2, date="<Year>2001</Year><Month>Feb</Month><Day>31</Day>"),
        c.article(3, date="<MedlineDate>unknown</MedlineDate>"),
        c.article(4, date="<Year>2001</Year><Month/>"),
        c.article(5, authors="<AuthorList><Author><ForeName>X</ForeName></Author></AuthorList>"),
        c.article("x"),
    ))
    changes = cf.read_changes(spark, str(bad), on_error="quarantine")
    good, errors = cf.split_errors(changes)
    assert [r.pmid for r in good.collect()] == [1]
    assert sorted(((r.pmid, r.error) for r in errors.collect()), key=lambda t: t[0] or 0) == [
        (None, "no article id"),
        (2, "unreadable publication date"), (3, "unreadable publication date"),
        (4, "unreadable publication date"), (5, "unreadable author"),
    ]
    with pytest.raises(Exception, match="unreadable"):
        cf.read_changes(spark, str(bad)).collect()
    with pytest.raises(ValueError):
        cf.read_changes(spark, str(bad), on_error="skip")


def state(df):
    return sorted((r.pmid, r.title, r.file_number) for r in df.collect())


def test_store_is_independent_of_arrival_order(spark, folder, tmp_path):
    changes = cf.read_changes(spark, folder)
    expected = state(live_rows(changes))
    for i, order in enumerate([["0001", "0002", "0003", "notes"], ["notes", "0003", "0002", "0001"]]):
        store = ArticleStore(spark, str(tmp_path / f"store{i}"))
        for part in order:
            store.append(changes.filter(F.col("file_name").contains(part)))
            if part == "0002":
                store.compact()
        assert state(store.articles()) == expected
        store.upsert(changes.filter(F.col("file_name").contains("0001")))
        assert state(store.articles()) == expected
        assert store.snapshot_version() == store.batches()[-1]


def test_compacted_store_is_read_without_a_shuffle(spark, folder, tmp_path):
    store = ArticleStore(spark, str(tmp_path / "store"))
    changes = cf.read_changes(spark, folder)
    store.upsert(changes.filter(F.col("file_name") < "med24n0002"))
    assert "Exchange" not in store.articles()._jdf.queryExecution().executedPlan().toString()
    store.append(changes.filter(F.col("file_name") >= "med24n0002"))
    assert state(store.articles()) == state(live_rows(changes))


def test_empty_store(spark, tmp_path):
    store = ArticleStore(spark, str(tmp_path / "none"))
    assert store.articles().count() == 0 and store.compact() is None


def test_stream_equals_batch(spark, folder, tmp_path, write_gz):
    def run():
        apply_change_stream(
            spark, folder, str(tmp_path / "store"), str(tmp_path / "ckpt"), files_per_batch=1,
            quarantine=str(tmp_path / "quarantine"),
        ).awaitTermination()

    run()
    store = ArticleStore(spark, str(tmp_path / "store"))
    assert state(store.articles()) == state(live_rows(cf.read_changes(spark, folder)))
    write_gz(f"{folder}/med24n0004.xml.gz", c.citation_set(c.article(100, title="final"), c.deletes([6])))
    run()
    assert state(store.articles()) == state(live_rows(cf.read_changes(spark, folder)))
    assert len(store.batches()) == 5


def test_stream_takes_small_files_together(spark, tmp_path, write_gz):
    landing = tmp_path / "landing"
    landing.mkdir()
    for i in range(20):
        write_gz(f"{landing}/med24n{i + 10:04d}.xml.gz", c.citation_set(c.article(200 + i, title="more")))
    store = ArticleStore(spark, str(tmp_path / "store"))
    apply_change_stream(spark, str(landing), store.folder, str(tmp_path / "ckpt")).awaitTermination()
    assert store.batches() == [1]
    assert {r.pmid for r in store.articles().collect()} == set(range(200, 220))
