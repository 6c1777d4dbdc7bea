import os
import tempfile

import pytest

from pyspark.sql import functions as F

from ledgerline.operators.totals import company_totals
from ledgerline.plans import adapter, pipeline
from ledgerline.schemas import GOLD
from ledgerline.sources.delimited import (detect_delimiter, first_line, header_lines,
                                          read_delimited)
from ledgerline.sources.documents import document_texts, document_warnings, read_documents
from ledgerline.sources.sinks import Warehouse, write_csv
from ledgerline.sources.tables import read_tables
from conftest import SMALL_SF, rows


def first_count(tables, name):
    return len(tables[name])


def _silver(spark):
    t = read_tables(spark, SMALL_SF)
    return pipeline.silver_from_pages(adapter.silver(t), t["pages"])


def test_gold_rerun_is_identical_and_totals_match(spark):
    root = tempfile.mkdtemp(prefix="ll-gold-")
    wh = pipeline.gold_warehouse(spark, root)
    assert wh.current_version() is None
    silver = _silver(spark)
    r1 = pipeline.publish_gold(silver, wh, "2024-01-01 00:00:00")
    assert wh.current_version() == r1.version
    first = {n: rows(wh.table(n, r1.version)) for n in GOLD}
    r2 = pipeline.publish_gold(silver, wh, "2025-01-01 00:00:00")
    assert r2.version > r1.version and wh.current_version() == r2.version
    for n in GOLD:
        assert rows(wh.table(n, r2.version)) == first[n], n
    assert r1.rows["factfinancials"] == wh.table("factfinancials").count()
    # insert-only dimensions: the rerun wrote empty deltas, not full copies
    assert r2.rows["filingdim"] == 0 and r1.rows["filingdim"] == first_count(first, "filingdim")
    li = read_tables(spark, SMALL_SF)["lineitem"]
    assert r1.rows["factfinancials"] >= li.count()
    got = company_totals(wh.table("factfinancials"), wh.table("companydim"), limit=None)
    assert got.count() > 0


def test_bronze_csv_in_the_source_layout(spark):
    """Columns by name whatever their order, quotes, line breaks, bad and missing dates."""
    bronze = tempfile.mkdtemp(prefix="ll-bronze-")
    files = {
        "sub": 'adsh,cik,name,form,sic,filing_summary\n'
               'f1,1,"A ""B"" Co",10-K,1000,"line one,\nline two"\nf2,2,Beta,10-Q,2000,\n',
        "tag": "tag_id,tag,version,custom,label\n1,Revenues,us-gaap/2023,0,Revenues\n",
        "pre": "pre_id,adsh,stmt,tag_id\n77,f1,IS,1\n",
        "num": "num_id,adsh,tag_id,version,ddate,qtrs,value\n0,f1,1,us-gaap/2023,20240131,4,10.5\n"
               "1,f1,1,us-gaap/2023,soon,4,11\n2,f2,1,us-gaap/2023,,1,12\n"
               "3,f2,1,us-gaap/2023,20240201,x,13\n",
    }
    for name, text in files.items():
        with open(f"{bronze}/{name}.csv", "w") as fh:
            fh.write(text)
    docs = tempfile.mkdtemp(prefix="ll-docs-")
    with open(f"{docs}/f2.html", "w") as fh:
        fh.write("<script>x</script><b>one</b>")
    silver, rejects = pipeline.build_silver(spark, bronze, docs, "*.html")
    assert rows(silver["sub"], "adsh", "name", "filing_summary", "extracted_pdf_text") == [
        ("f1", 'A "B" Co', "line one,\nline two", None), ("f2", "Beta", None, "one")]
    assert [(r["num_id"], str(r["ddate"])) for r in silver["num"].collect()] == [(0, "2024-01-31")]
    assert rows(silver["pre"]) == [(77, "f1", "IS", 1)]
    assert rows(rejects, "table", "reason") == [
        ("num", "ddate does not parse as yyyyMMdd"), ("num", "ddate is missing"),
        ("num", "line does not fit the columns")]


def test_columns_are_bound_by_name(spark):
    from ledgerline.schemas import NUM
    from ledgerline.sources.delimited import read_csv
    import pytest
    d = tempfile.mkdtemp(prefix="ll-csv-")
    for name, text in (("a", "value,adsh,tag_id\n1.5,x,1\n"), ("b", "tag_id,extra,adsh,value\n2,e,y,2\n")):
        with open(f"{d}/{name}.csv", "w") as fh:
            fh.write(text)
    read = read_csv(spark, d, NUM)
    assert rows(read.table, "adsh", "tag_id", "value", "num_id") == [("x", 1, 1.5, None), ("y", 2, 2.0, None)]
    with pytest.raises(ValueError, match="no column qtrs"):
        read_csv(spark, d, NUM, required=["qtrs"])


def test_without_a_date_column_all_facts_pass(spark):
    num = spark.createDataFrame([(1,)], "num_id long")
    good, bad = pipeline.split_dates(num)
    assert good.count() == 1 and bad.count() == 0


def test_bad_and_extensionless_documents(spark):
    d = tempfile.mkdtemp(prefix="ll-docs-")
    files = {"bad.html": b"\xff\xfe<p>x</p>", "ok.html": b"<p>fine</p>", "plain": b"no ending",
             ".hidden": b"dots", "half.html": "<p>kept n\u00e9</p>".encode() + b"\xe9<p>lost</p>",
             "cut.txt": "caf\u00e9 \ufffd kept".encode() + "\u20ac".encode()[:2],
             "own.txt": "only \ufffd its own".encode(), "empty.txt": b"",
             "long.txt": b"x" * 300_000 + b"\xc3("}
    for name, data in files.items():
        with open(f"{d}/{name}", "wb") as fh:
            fh.write(data)
    docs = read_documents(spark, d)
    got = dict(rows(document_texts(docs)))
    assert got["bad"] == "" and got["ok"] == "fine" and got["plain"] == "no ending"
    assert got["half"] == "kept n\u00e9" and got["cut"] == "caf\u00e9 \ufffd kept"
    assert got["own"] == "only \ufffd its own" and "empty" not in got
    assert got["long"] == "x" * 300_000
    warned = {r["doc_key"]: r["at"] for r in document_warnings(docs).collect()}
    assert warned == {"bad": 0, "half": len(files["half.html"]) - 12, "cut": len(files["cut.txt"]) - 2,
                      "long": 300_000}


def test_page_breaks_become_lines(spark):
    d = tempfile.mkdtemp(prefix="ll-pages-")
    for name, data in (("a.html", "<p>one</p>\f \n\f<b>two</b>\f"), ("b.txt", "\f\f")):
        with open(f"{d}/{name}", "w") as fh:
            fh.write(data)
    assert rows(document_texts(read_documents(spark, d))) == [("a", "one\ntwo"), ("b", "")]
    plain = document_texts(read_documents(spark, d, "a*"), html=False)
    assert rows(plain) == [("a", "<p>one</p>\n<b>two</b>")]


def test_headers_take_the_same_bytes_from_files_of_any_size(spark):
    import gzip
    d = tempfile.mkdtemp(prefix="ll-headers-")
    for name, lines in (("small.csv", 10), ("large.csv", 200_000)):
        with open(f"{d}/{name}", "w") as fh:
            fh.write("\ufeffa,b\n" + "1,2\n" * lines)
    with gzip.open(f"{d}/packed.csv.gz", "wt") as fh:
        fh.write("b,a\r\n" + "3,4\r\n" * 1000)
    open(f"{d}/empty.csv", "w").close()
    sizes = {n: first_line(spark, f"file:{d}/{n}.csv")[1] for n in ("small", "large")}
    assert sizes["large"] <= 64 * 1024 < os.path.getsize(f"{d}/large.csv")
    assert first_line(spark, f"file:{d}/empty.csv")[0] is None
    found = {h.lstrip("\ufeff"): [f.rsplit("/", 1)[1] for f in files]
             for h, files in header_lines(spark, d).items()}
    assert found == {"a,b": ["large.csv", "small.csv"], "b,a": ["packed.csv.gz"]}
    read = read_delimited(spark, d)
    assert read.table.groupBy("a", "b").count().orderBy("a").collect() == [
        ("1", "2", 200_010), ("4", "3", 1000)]


def test_read_documents_key_from_name(spark):
    d = tempfile.mkdtemp(prefix="ll-docs-")
    with open(f"{d}/0000320193-23-000106.html", "w") as fh:
        fh.write("<html><body>Annual  report</body></html>")
    got = rows(document_texts(read_documents(spark, d)))
    assert got == [("0000320193-23-000106", "Annual report")]
    with open(f"{d}/0000000001-23-000001.html", "w") as fh:
        fh.write("<p>first</p>")
    keys = [r["doc_key"] for r in read_documents(spark, d, ordered=True).collect()]
    assert keys == ["0000000001-23-000001", "0000320193-23-000106"]


def test_detect_delimiter():
    assert detect_delimiter("a|b|c") == "|"
    assert detect_delimiter("a\tb,c\td") == "\t"
    assert detect_delimiter("a;b;c,d") == ";"
    assert detect_delimiter("single") == ","


def test_read_delimited_rejects_bad_lines(spark):
    d = tempfile.mkdtemp(prefix="ll-txt-")
    with open(f"{d}/f.txt", "w") as fh:
        fh.write(" Company Name|Form.Type|SIC\nAcme|10-K|1000\nBroken|line\nBeta|10-Q|2000\n")
    res = read_delimited(spark, f"{d}/f.txt")
    assert res.sep == "|"
    assert res.table.columns == ["company_name", "formtype", "sic"]
    assert rows(res.table) == [("Acme", "10-K", "1000"), ("Beta", "10-Q", "2000")]
    assert res.rejects.count() == 1


def test_each_file_has_its_own_header_and_delimiter(spark):
    d = tempfile.mkdtemp(prefix="ll-txt-")
    for name, text in (("a", "Name|SIC\nAcme|1000\n"), ("b", "SIC|Name\n2000|Beta\n"),
                       ("c", "sic,name,form\n3000,Gamma,10-K\n"), ("d", "")):
        with open(f"{d}/{name}.txt", "w") as fh:
            fh.write(text)
    res = read_delimited(spark, d)
    assert rows(res.table, "name", "sic", "form") == [
        ("Acme", "1000", None), ("Beta", "2000", None), ("Gamma", "3000", "10-K")]
    assert res.rejects.count() == 0


def test_register_document_filings(spark):
    from ledgerline.schemas import FILING_DIM
    existing = spark.createDataFrame([(1, "a", "10-K", None, None)], FILING_DIM)
    docs = spark.createDataFrame([("a",), ("b",), ("b",)], "doc_key string")
    delta = pipeline.register_document_filings(existing, docs, "10-K")
    assert rows(delta, "accession_number", "form_type") == [("b", "10-K")]


def test_publish_corpus_partitioned_and_rejects(spark):
    from ledgerline.operators.search import knn, publish_corpus
    corpus = spark.createDataFrame(
        [("1", "10-K", [1.0, 0.0]), ("2", "10-Q", [0.0, 1.0]), ("3", "10-K", [1.0])],
        "id string, form string, embedding array<float>")
    wh = Warehouse(spark, tempfile.mkdtemp(prefix="ll-corpus-"))
    version, bad = publish_corpus(wh, corpus, dim=2)
    assert rows(bad, "id") == [("3",)]
    table = wh.table("search_corpus", version)
    assert table.count() == 2
    plan = knn(table, [1.0, 0.0], 5, facet="form", facet_value="10-K")
    assert [r["id"] for r in plan.collect()] == ["1"]


def test_unmarked_version_is_invisible(spark):
    schema = "id long, accession_number string, form_type string, period_of_report string, " \
             "date_filed string"
    from ledgerline.schemas import FILING_DIM, TAG_DIM
    wh = Warehouse(spark, tempfile.mkdtemp(prefix="ll-wh-"),
                   {"filingdim": FILING_DIM, "tagdim": TAG_DIM}, append_only=["filingdim"])
    first = spark.createDataFrame([(1, "a", "10-K", None, None)], schema)
    v1 = wh.publish({"filingdim": first})
    # a failed run: staged, never marked
    wh.stage("99990101T000000000000Z-failed",
             {"filingdim": spark.createDataFrame([(2, "b", "10-Q", None, None)], schema)})
    assert wh.current_version() == v1
    assert rows(wh.table("filingdim"), "accession_number") == [("a",)]
    v2 = wh.publish({"filingdim": spark.createDataFrame([(3, "c", "8-K", None, None)], schema)})
    assert wh.current_version() == v2
    assert rows(wh.table("filingdim"), "accession_number") == [("a",), ("c",)]
    assert rows(wh.table("filingdim", v1), "accession_number") == [("a",)]


def test_scratch_dir_uses_session_checkpoint_dir(spark):
    from ledgerline.session import SCRATCH_KEY, fresh_path, scratch_dir
    shared = spark.conf.get("spark.checkpoint.dir", None)
    d = scratch_dir(spark)
    if shared:  # the cluster's shared folder wins
        assert d == shared.rstrip("/")
    else:       # local fallback, remembered for the session
        assert d == spark.conf.get(SCRATCH_KEY)
    assert fresh_path(spark, "x").startswith(d + "/x-")
    assert fresh_path(spark, "x") != fresh_path(spark, "x")


def test_company_history_is_append_only(spark):
    from pyspark.sql import functions as F
    silver = _silver(spark)
    wh = pipeline.gold_warehouse(spark, tempfile.mkdtemp(prefix="ll-gold2-"))
    r1 = pipeline.publish_gold(silver, wh, "2024-01-01 00:00:00")
    n_companies = wh.table("companydim_current", r1.version).count()
    renamed = dict(silver)
    some_cik = silver["sub"].select("cik").first()["cik"]
    renamed["sub"] = silver["sub"].withColumn(
        "name", F.when(F.col("cik") == some_cik, F.lit("Renamed Co")).otherwise(F.col("name")))
    r2 = pipeline.publish_gold(renamed, wh, "2025-01-01 00:00:00")
    assert r2.rows["companydim_history"] == 1          # only the expired version is written
    assert r2.rows["companydim_current"] == n_companies
    comp = wh.table("companydim")
    assert comp.filter(F.col("cik") == str(some_cik)).count() == 2
    assert comp.filter("is_current").groupBy("cik").count().filter("count > 1").count() == 0
    # the fact follows the current version
    cur = wh.table("companydim_current").filter(F.col("cik") == str(some_cik)).first()
    assert cur["name"] == "Renamed Co"
    assert wh.table("factfinancials").filter(F.col("company_id") == cur["id"]).count() > 0


def test_failed_table_write_publishes_nothing(spark):
    import pytest
    from pyspark.sql import functions as F
    wh = Warehouse(spark, tempfile.mkdtemp(prefix="ll-wh-fail-"))
    ok = spark.range(3).withColumnRenamed("id", "x")
    v1 = wh.publish({"a": ok})
    bad = spark.range(3).select(F.lit("not a number").cast("int").alias("x"))  # fails at run time
    prev = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "true")
    try:
        with pytest.raises(Exception):
            wh.publish({"a": ok, "b": bad, "c": ok})
    finally:
        spark.conf.set("spark.sql.ansi.enabled", prev)
    assert wh.current_version() == v1
    assert wh.table("a").count() == 3


def test_of_two_publishers_one_is_refused(spark):
    from ledgerline.schemas import FILING_DIM
    from ledgerline.sources.sinks import Superseded, new_version
    wh = Warehouse(spark, tempfile.mkdtemp(prefix="ll-wh2-"), {"filingdim": FILING_DIM},
                   append_only=["filingdim"])

    def filing(key):
        return spark.createDataFrame([(hash(key) % 1000, key, "10-K", None, None)], FILING_DIM)

    v1 = wh.publish({"filingdim": filing("a")})
    ours, theirs = new_version(), new_version()
    for v in (ours, theirs):       # both read v1 and add the same filing
        wh.stage(v, {"filingdim": filing("b")})
    wh.mark(theirs, ["filingdim"], v1)
    with pytest.raises(Superseded):
        wh.mark(ours, ["filingdim"], v1)
    assert rows(wh.table("filingdim"), "accession_number") == [("a",), ("b",)]
    assert wh.chain() == [v1, theirs]


@pytest.mark.parametrize("first_load", [True, False])
def test_a_publisher_between_check_and_marker_changes_nothing(spark, monkeypatch, first_load):
    """The slower one (with the smaller id) has passed its check when the other marks."""
    from ledgerline.sources.sinks import Superseded, new_version
    root = tempfile.mkdtemp(prefix="ll-race-")
    slow, fast = Warehouse(spark, root), Warehouse(spark, root)
    one = spark.createDataFrame([(1,)], "x long")
    parent = None if first_load else slow.publish({"t": one})
    ours, theirs = new_version(), new_version()
    assert ours < theirs
    for v, x in ((ours, 2), (theirs, 3)):
        slow.stage(v, {"t": spark.createDataFrame([(x,)], "x long")})
    create = slow._create_marker

    def late(*args):
        fast.mark(theirs, ["t"], parent)  # told that it succeeded
        create(*args)

    monkeypatch.setattr(slow, "_create_marker", late)
    with pytest.raises(Superseded):
        slow.mark(ours, ["t"], parent)
    assert slow.chain() == ([] if first_load else [parent]) + [theirs]
    assert rows(slow.table("t")) == [(3,)]
    after = fast.publish({"t": one})
    assert fast.chain()[-2:] == [theirs, after]


def test_an_empty_marker_ends_the_chain(spark):
    from ledgerline.sources.sinks import Superseded
    wh = Warehouse(spark, tempfile.mkdtemp(prefix="ll-wh4-"))
    one = spark.createDataFrame([(1,)], "x long")
    v1 = wh.publish({"t": one})
    open(f"{wh.root}/_published/after-{v1}", "w").close()
    assert wh.chain() == [v1]
    with pytest.raises(Superseded):
        wh.publish({"t": one})


def test_a_broken_marker_folder_is_an_error(spark):
    import pytest
    root = tempfile.mkdtemp(prefix="ll-wh3-")
    os.makedirs(f"{root}/_published")
    with open(f"{root}/_published/part-0.parquet", "w") as fh:
        fh.write("not parquet")
    with pytest.raises(Exception):
        Warehouse(spark, root).current_version()


def test_a_reused_batch_time_is_refused_and_publishes_nothing(spark):
    import pytest
    silver = _silver(spark)
    wh = pipeline.gold_warehouse(spark, tempfile.mkdtemp(prefix="ll-gold3-"))
    r1 = pipeline.publish_gold(silver, wh, "2024-01-01 00:00:00")
    renamed = dict(silver)
    renamed["sub"] = silver["sub"].withColumn("name", F.concat("name", F.lit("!")))
    with pytest.raises(Exception, match="not later than"):
        pipeline.publish_gold(renamed, wh, "2024-01-01 00:00:00")
    assert wh.current_version() == r1.version


def test_checks_run_before_a_version_is_marked(spark):
    import pytest
    from ledgerline.operators.quality import CheckFailed
    silver = _silver(spark)
    wh = pipeline.gold_warehouse(spark, tempfile.mkdtemp(prefix="ll-gold4-"))
    dims = {n: wh.spark.createDataFrame([], GOLD[n]) for n in GOLD}
    bad = spark.createDataFrame([(1, "20240101"), (1, "20240102")], GOLD["datedim"])
    with pytest.raises(CheckFailed, match="datedim"):
        pipeline.check_gold({**{n: dims[n] for n in ("companydim", "filingdim", "tagdim",
                                                     "statementdim")}, "datedim": bad},
                            dims["factfinancials"])
    with pytest.raises(ValueError, match="gold_warehouse"):
        pipeline.publish_gold(silver, Warehouse(spark, wh.root, GOLD), "2024-01-01 00:00:00")


def test_no_local_scratch_on_a_cluster():
    import pytest
    from types import SimpleNamespace
    from ledgerline.session import scratch_dir
    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: None),
                              sparkContext=SimpleNamespace(master="yarn"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(cluster)


def test_landing_and_text_tables(spark):
    """CSV landed as parquet by trimmed header name; one (key, text) table."""
    from ledgerline.schemas import TAG
    from ledgerline.sources.delimited import land_csv_as_parquet
    from ledgerline.sources.documents import write_texts
    d = tempfile.mkdtemp(prefix="ll-land-")
    with open(f"{d}/tag.csv", "w") as fh:
        fh.write(" tag , tag_id,version\nCash,6,v1\nBad,x,v1\n")
    rejects = land_csv_as_parquet(spark, f"{d}/tag.csv", f"{d}/tag.parquet", TAG)
    assert rows(spark.read.parquet(f"{d}/tag.parquet"), "tag_id", "tag", "label") == [(6, "Cash", None)]
    assert [r["record"] for r in rejects.collect()] == ["Bad,x,v1"]
    with open(f"{d}/a.html", "w") as fh:
        fh.write("<p>text</p>")
    write_texts(document_texts(read_documents(spark, d, "*.html")), f"{d}/texts")
    assert rows(spark.read.parquet(f"{d}/texts")) == [("a", "text")]


def test_empty_reset(spark):
    """A version of empty tables with the declared schemas."""
    wh = Warehouse(spark, tempfile.mkdtemp(prefix="ll-reset-"), GOLD)
    wh.publish_empty(GOLD)
    assert all(wh.table(n).count() == 0 and wh.table(n).columns == GOLD[n].fieldNames() for n in GOLD)


def test_a_file_per_key_by_tasks_and_by_folders(spark):
    from ledgerline.sources.documents import write_files, write_folders

    # One partition, as a table with one row group has: the files still come from many tasks.
    data = [(i, f"text {i}\nline two") for i in range(200)] + [(7, "again"), (None, "no key"), (201, "")]
    pages = spark.createDataFrame(data, "page_id long, value string").coalesce(1)
    odd = F.concat(F.col("value").cast("binary"), F.unhex(F.lit("FF"))).cast("string")
    pages = pages.select("page_id", F.when(F.col("page_id") == 9, odd).otherwise(F.col("value")).alias("value"))
    d = tempfile.mkdtemp()
    write_files(pages, f"{d}/tasks", "page_id", "value")
    write_folders(pages, f"{d}/folders", "page_id")
    tasks, folders = ({r["page_id"]: bytes(r["content"]) for r in read_documents(
        spark, f"{d}/{way}", "*.txt", key="page_id", key_from="page_id=([^/.]+)").collect()}
        for way in ("tasks", "folders"))
    assert tasks == folders and len(tasks) == 202
    assert tasks["9"] == b"text 9\nline two\xff\n" and tasks["201"] == b"\n"
    assert sorted(tasks["7"].split(b"\n")) == [b"", b"again", b"line two", b"text 7"]
    parts = [p for p in os.listdir(f"{d}/tasks") if os.listdir(f"{d}/tasks/{p}")]
    assert len(parts) > spark.sparkContext.defaultParallelism
