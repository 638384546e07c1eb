"""Readers, sinks, payloads, pages and streams on temporary folders."""

import datetime as dt
import math
import uuid

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from foghorn.schemas import EVENT_COLUMNS
from foghorn.sources import adapters, config, pages, payloads, readers, sinks
from foghorn.streaming import events as st

AS_OF = "2024-01-31"


def _write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_universe_filters_and_maximum(spark, tmp_path):
    path = _write(
        tmp_path / "u.csv",
        "company_id,company_name,country,industry,size_bin\n1.0,Uno,ar,oil,M\n2,Dos,BR,oil,s\n3,Tres,AR,gas,l\n",
    )
    got = readers.read_universe(spark, path, countries=["AR"], size_bins=["m"]).collect()
    assert [r["company_id"] for r in got] == ["1"] and got[0]["ticker"] is None
    assert readers.read_universe(spark, path, max_companies=2).count() == 2
    with pytest.raises(FileNotFoundError):
        readers.read_universe(spark, str(tmp_path / "none.csv"))


def test_events_backfill_and_absent(spark, tmp_path):
    path = _write(tmp_path / "e.csv", "company_id,ts,signal_strength\n1,2024-01-02T00:00:00Z,x\n2,garbage,0.5\n")
    got = readers.read_events(spark, path).orderBy("company_id").collect()
    assert got[0]["signal_strength"] == 0.0 and got[0]["ts"] == dt.datetime(2024, 1, 2) and got[1]["ts"] is None
    empty = readers.read_events(spark, str(tmp_path / "no.csv"))
    assert empty.columns == EVENT_COLUMNS and empty.count() == 0


def test_aliases_and_missing_columns(spark, tmp_path):
    path = _write(tmp_path / "m.csv", "company_name,url,ts\nUno,u,2020-01-02\n")
    row = readers.read_members(spark, "sbti", path, AS_OF).first()
    assert row["member_name"] == "Uno" and row["ts"] == "2020-01-02T00:00:00Z" and row["signal_type"] == "sbti"
    bad = _write(tmp_path / "b.csv", "x\n1\n")
    with pytest.raises(ValueError, match="member_name"):
        readers.read_members(spark, "ungc", bad, AS_OF)
    assert readers.read_members(spark, "re100", str(tmp_path / "no.csv"), AS_OF).count() == 0


def test_header_sniffing(spark):
    df = spark.createDataFrame([("x", "Uno", "3/4/2020", "Chile")], ["id", "Organización", "Fecha", "PAIS"])
    row = readers.member_list(df, "http://l", "bcorp").first()
    assert (row["member_name"], row["ts"], row["country"], row["sector"]) == ("Uno", "3/4/2020", "Chile", "")
    first = readers.member_list(spark.createDataFrame([("Solo",), (" ",)], ["col"]), "u", "k").collect()
    assert [r["member_name"] for r in first] == ["Solo"]


def test_recursive_scan_of_mixed_layouts(spark, tmp_path):
    _write(tmp_path / "n/a/x.csv", 'company_id,title,ts\n1,"two\nlines",2024-01-01\n')
    _write(tmp_path / "n/b/y.csv", "title,company_id,signal_strength\nt,2,0.5\n")
    _write(tmp_path / "n/b/skip.txt", "no\n")
    got = {r["company_id"]: r for r in readers.read_recursive(spark, str(tmp_path / "n")).collect()}
    assert got["1"]["title"] == "two\nlines" and got["2"]["signal_strength"] == 0.5 and len(got) == 2
    assert readers.read_recursive(spark, str(tmp_path / "none")).count() == 0


def test_recursive_scan_of_odd_files(spark, tmp_path):
    long = "x" * 200_000
    _write(tmp_path / "o/a.csv", '\ufeffcompany_id, title ,ts\r\n1,"say ""hi"", ok",2024-01-01\r\n\r\n2,,bad\r\n3\r\n')
    _write(tmp_path / "o/b.csv", "title,company_id,title\n")
    _write(tmp_path / "o/c.csv", "")
    _write(tmp_path / "o/d.csv", f'unknown,company_id,title\n9,4,"{long}""{long}"\n,"5",last')
    _write(tmp_path / "o/e.csv", 'title,company_id,title\n"",6,other\n')
    got = {r.company_id: r for r in readers.read_recursive(spark, str(tmp_path / "o")).collect()}
    assert sorted(got) == ["1", "2", "3", "4", "5", "6"]
    assert got["1"].title == 'say "hi", ok' and got["1"].ts == dt.datetime(2024, 1, 1)
    assert got["2"].title == "" and got["2"].ts is None and got["3"].title == ""
    assert got["4"].title == f'{long}"{long}' and got["5"].title == "last" and got["6"].title == ""


def test_recursive_scan_of_many_files_sends_nothing_to_the_driver(spark, tmp_path):
    layouts = ("company_id,title\n{0},t{0}\n", "title,x,company_id\nt{0},1,{0}\n", "signal_strength,company_id\n0.5,{0}\n")
    for i in range(10_000):
        path = tmp_path / "many" / f"d{i % 20}" / f"{i}.csv"
        if i < 20:
            path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(layouts[i % 3].format(i), encoding="utf-8")
    spark.sparkContext.setJobGroup("recursive-scan", "")
    frame = readers.read_recursive(spark, str(tmp_path / "many"))
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("recursive-scan")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not jobs  # no job before the scan itself
    row = frame.agg(
        F.count_distinct("company_id").alias("ids"), F.count(F.lit(1)).alias("n"), F.sum("signal_strength").alias("s"),
        F.count_if(F.col("title") == F.concat(F.lit("t"), F.col("company_id"))).alias("titles"),
    ).first()
    assert (row.ids, row.n, row.titles) == (10_000, 10_000, 6667) and row.s == 3333 * 0.5


def test_recursive_scan_cuts_a_file_among_tasks(spark, tmp_path):
    rows = [f'{i},"line {i}\n\nof, ""{i}""\nthree",t' if i % 3 == 0 else f"{i},plain {i},t" for i in range(2000)]
    _write(tmp_path / "cut/a.csv", "\r\n \ncompany_id,title,source\n" + "\n".join(rows) + '\nlast,"open\n end\n')
    _write(tmp_path / "cut/d/b.csv", "\ufeffsource,company_id\n" + "\n".join(f"u,b{i}" for i in range(500)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "997b")  # most records with line breaks cross a cut
    try:
        frame = readers.read_recursive(spark, str(tmp_path / "cut"))
        assert "wholetext" not in frame._jdf.queryExecution().optimizedPlan().toString().lower()
        got = {r.company_id: r for r in frame.select("company_id", "title", "source").collect()}
        parts = readers._csv_records(spark, str(tmp_path / "cut"), "*.csv").select(F.max(F.length("record"))).first()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert parts[0] < 100
    assert len(got) == 2501 and got["b7"].source == "u" and got["last"].title == "open\n end"
    for i in range(2000):
        title = f'line {i}\n\nof, "{i}"\nthree' if i % 3 == 0 else f"plain {i}"
        assert (got[str(i)].title, got[str(i)].source) == (title, "t")


def test_pages_are_read_a_few_at_a_time():
    htmls = ["<p>" + "x" * size + "</p>" for size in (10, pages.PAGE_BYTES * 2, *[9_000] * 1000)] + [None]
    batch = pa.RecordBatch.from_pydict({"page_id": list(range(len(htmls))), "url": ["u"] * len(htmls), "html": htmls})
    parts = list(pages._small(iter([batch, batch.slice(0, 0)])))
    assert [i for p in parts for i in p["page_id"]] == list(range(len(htmls)))
    assert [h for p in parts for h in p["html"]] == htmls
    assert all(sum(len(h or "") for h in p["html"][:-1]) < pages.PAGE_BYTES for p in parts) and len(parts) > 8


def test_first_existing(spark, tmp_path):
    path = _write(tmp_path / "b.csv", "a\n1\n")
    assert readers.first_existing(spark, [str(tmp_path / "a.csv"), path]) == path
    assert readers.first_existing(spark, [str(tmp_path / "a.csv")]) is None


def test_append_events_table(spark, tmp_path):
    table = str(tmp_path / "events")
    ts = dt.datetime(2024, 1, 1)
    a = spark.createDataFrame([("1", "u", ts, 0.1), ("2", "u", ts, 0.2)], "company_id string, url string, ts timestamp, signal_strength double")
    b = spark.createDataFrame([("2", "u", ts, 0.9), ("3", "u", ts, 0.3)], a.schema)
    assert sinks.append_events(spark, table, a, "news", "news") == 2
    assert sinks.append_events(spark, table, b, "news", "news") == 1
    assert sinks.append_events(spark, table, b, "news", "news") == 0
    got = {r["company_id"]: r["signal_strength"] for r in spark.read.parquet(table).collect()}
    assert got == {"1": 0.1, "2": 0.9, "3": 0.3}
    assert sinks.append_many(spark, table, []) == 0
    assert sinks.append_many(spark, table, [a.withColumn("url", F.lit("w")).withColumn("signal_type", F.lit("x"))]) == 2
    assert [p.name for p in tmp_path.iterdir()] == ["events"]
    new = sinks.append_new_only(spark, table, spark.createDataFrame([("u",), ("z",)], "url string"))
    assert [r["url"] for r in new.collect()] == ["z"]


def test_landing_and_text(spark, tmp_path):
    df = spark.createDataFrame([("AR", "oil & gas", 1), ("", "x", 2)], "country string, industry string, n int")
    sinks.land_raw(df, str(tmp_path / "raw"))
    assert (tmp_path / "raw" / "country_dir=AR" / "industry_dir=oil_gas").exists()
    assert (tmp_path / "raw" / "country_dir=ALL").exists()
    sinks.write_lines(df.select(F.col("industry").alias("value")), str(tmp_path / "t"))
    assert spark.read.text(str(tmp_path / "t")).count() == 2


# --- adapters -----------------------------------------------------------------

def test_member_adapters(spark):
    ungc = spark.createDataFrame(
        [("Uno", "Company", "Banks", "Peru", "2015", "Active", "", "p"), ("Dos", "x", "", "France", "", "", "", "")],
        "name string, type string, sector string, country string, joined_on string, status string, ownership string, participant_url string",
    )
    rows = adapters.ungc_members(ungc, AS_OF).collect()
    assert len(rows) == 1
    row = rows[0]
    assert (row["country"], row["size_bin"], row["industry"], row["text_snippet"]) == ("PE", "l", "finance_insurance", "Active")
    assert row["ts"] == dt.datetime(2015, 1, 1) and row["context_type"] == "Company"
    sbti = spark.createDataFrame([("S", "México", None, None)], "member_name string, country string, ts string, sector string")
    row = adapters.sbti_members(sbti, AS_OF).first()
    assert row["industry"] == "other_services" and row["ts"] == dt.datetime(2024, 1, 31) and row["country"] == "MX"


def test_target_list_and_list_pages(spark):
    df = spark.createDataFrame(
        [("Uno", "Santiago, Chile", "Media", "Corporate", None), ("Dos", "Chile", "Media", "SME", None), ("T", "Chile", "nothing", "Corporate", None)],
        "company_name string, location string, sector string, organization_type string, full_target_language string",
    )
    rows = adapters.target_list_candidates(df, ["CL"]).collect()
    assert [(r["company_name"], r["industry"], r["size_bin"]) for r in rows] == [("Uno", "ict_telecom", "l")]
    html = "<table><tr><th>Company name</th><th>Industry</th></tr><tr><td>Petro A</td><td>Oil</td></tr><tr><td>Petro A</td><td>Gas</td></tr><tr><td>Z</td><td>?</td></tr></table>"
    landed = pages.table_rows(spark.createDataFrame([("http://x", html)], "url string, html string"))
    got = adapters.list_page_candidates(landed.withColumn("country", F.lit("AR"))).collect()
    assert [(r["company_name"], r["industry"], r["source_rank"]) for r in got] == [("Petro A", "oil_gas", 3)]
    assert got[0]["qid"].startswith("wiki-")


# --- pages --------------------------------------------------------------------

HTML = """<html><head><title>Our  ESG</title><meta name="date" content="2023-05-06"></head><body>
<h1>Net zero</h1><p>carbon <b>capture</b></p><script>var x = '<p>no</p>';</script><ul><li>one<li>two</ul>
<a href="/a/?utm_x=1#f">a</a><a href="https://other.example/">o</a><a href="b">b</a>%s</body></html>"""


def test_page_contents_links_and_score(spark):
    time_tag = '<time datetime="2024-01-01T00:00:00Z">t</time>'
    df = spark.createDataFrame(
        [(1, "https://www.x.example/esg/", HTML % time_tag), (2, "https://x.example/2022/3/4/n", HTML % ""),
         (3, "https://x.example/2022/3/4/n", "")],
        "page_id long, url string, html string",
    )
    contents = pages.page_contents(df)
    got = {r["page_id"]: r for r in contents.collect()}
    assert got[1]["title"] == "Our  ESG" and "Net zero carbon capture" in got[1]["text"] and "no" not in got[1]["text"].split()
    assert got[1]["published"] == dt.datetime(2024, 1, 1) and got[2]["published"] == dt.datetime(2023, 5, 6)
    assert got[3]["published"] == dt.datetime(2022, 3, 4) and got[3]["text"] == ""
    links = {r["link"] for r in pages.page_links(contents).filter("page_id = 1").collect()}
    assert links == {"https://www.x.example/a", "https://www.x.example/esg/b"}
    scored = {r["page_id"]: r["score"] for r in pages.page_scores(contents, AS_OF).collect()}
    # page 1: 30 days old, an esg address, two of ten terms in under 250 words
    assert scored[1] == pytest.approx(min(1.0, math.exp(-30 / 365) * 1.0), abs=1e-4)
    assert 3 not in scored  # an empty page scores zero
    undated = spark.createDataFrame([(9, "https://x.example/esg", "<p>x</p>")], "page_id long, url string, html string")
    assert pages.page_scores(pages.page_contents(undated), AS_OF).first()["score"] == pytest.approx(0.14)


def test_part_limit_is_optional(spark):
    html = "".join(f"<p>w{i}</p>" for i in range(300))
    df = spark.createDataFrame([(1, "http://x", html)], "page_id long, url string, html string")
    assert len(pages.page_contents(df).first()["text"].split()) == 300
    assert len(pages.page_contents(df, max_parts=201).first()["text"].split()) == 201


def test_table_layouts(spark):
    energy = (
        "<table><tr><th>Member</th><th>a</th></tr><tr><th class='notranslate'><a href='/m'>Uno</a></th>"
        "<td>gold</td><td>2019</td><td>2030</td><td>x</td><td>Food</td><td>Brazil</td></tr><tr><td>about Uno</td></tr></table>"
    )
    rows = pages.table_rows(spark.createDataFrame([("https://r.example/l", energy)], "url string, html string"))
    row = pages.energy_members(rows).first()
    assert (row["member_name"], row["ts"], row["country"], row["sector"], row["url"]) == (
        "Uno", "2019-01-01", "BR", "Food", "https://r.example/m")
    grid = "<table><tr><th>Name</th><th>Country</th></tr><tr><td><a href='/p/1'>Uno</a></td></tr></table>"
    rows = pages.table_rows(spark.createDataFrame([("https://u.example/", grid)], "url string, html string"))
    row = pages.participant_rows(rows).first()
    assert (row["name"], row["country"], row["participant_url"]) == ("Uno", "", "https://u.example/p/1")
    plain = "<table><tr><td>Solo</td><td>x</td></tr></table><table><tr><td>no</td></tr></table>"
    rows = pages.table_rows(spark.createDataFrame([("https://u.example/", plain)], "url string, html string"))
    assert [r["member_name"] for r in pages.generic_members(rows, "sbti").collect()] == ["Solo"]


# --- payloads -----------------------------------------------------------------

def test_json_payloads(spark):
    board = '{"jobs": [{"absolute_url": "u", "title": "t", "location": {"name": "L"}, "created_at": "2024-01-02T00:00:00Z"}, {"title": "x"}]}'
    row = payloads.board_jobs(spark.createDataFrame([("b", board)], "slug string, p string"), "p", AS_OF).collect()
    assert [(r["title"], r["snippet"], r["ts"]) for r in row] == [("t", "L", dt.datetime(2024, 1, 2))]
    graph = (
        '{"results": {"bindings": [{"company": {"value": "http://e/Q5"}, "companyLabel": {"value": " Uno "}, '
        '"employees1128": {"value": "1,200"}, "employees1081": {"value": "5"}, "ticker": {"value": "T"}, '
        '"exchangeLabel": {"value": "X"}, "website": {"value": "https://www.Uno.com/a"}}]}}'
    )
    row = payloads.company_bindings(spark.createDataFrame([("AR", graph)], "country string, p string"), "p").first()
    assert (row["qid"], row["company_name"], row["employees"], row["ticker"]) == ("Q5", "Uno", 1200.0, "T@X")
    stories = '{"results": [{"url": "u", "title": "t", "publish_date": "2024-01-05"}]}'
    row = payloads.archive_stories(spark.createDataFrame([(stories,)], "p string"), "p").first()
    assert row["source"] == "mediacloud" and row["ts"] == dt.datetime(2024, 1, 5)


def test_feed_limits_and_dates(spark):
    xml = "<rss><channel>" + "".join(
        f"<item><title>t{i}</title><link>l{i}</link><pubDate>Tue, 02 Jan 2024 03:04:05 +0100</pubDate></item>" for i in range(3)
    ) + "</channel></rss>"
    df = spark.createDataFrame([("f", xml)], "feed string, xml string")
    rows = payloads.feed_entries(df, "feed", "xml", AS_OF, limit=2).collect()
    assert [r["title"] for r in rows] == ["t0", "t1"] and rows[0]["ts"] == dt.datetime(2024, 1, 2, 2, 4, 5)


# --- settings -----------------------------------------------------------------

def test_settings():
    weights, days = config.signal_map({"decay": {"half_life_days": 30}, "groups": {"g": {"types": {" News ": 2}}}})
    assert weights == [("g", 100.0, "news", 2.0)] and days == 30.0
    with pytest.raises(ValueError):
        config.signal_map({"groups": {}})
    aliases, patterns = config.industry_map({"mall": ["tienda", ""], "bank": ["banco"]})
    assert aliases == [("mall", ["tienda"]), ("bank", ["banco"])] and patterns[0] == ("tienda", "mall", 1.0)
    _, patterns = config.industry_map({"mappings": [{"pattern": "(?i)a|b", "to": "x", "weight": "bad"}, {"to": "y"}]})
    assert patterns == [("a|b", "x", 1.0)]
    assert config.keywords({"include": ["A", "a"], "exclude": None}) == (["A"], [])
    assert config.job_boards({"lever": [{"slug": "s", "company_domain": "d"}, {"slug": ""}]}) == [("lever", "s", "d")]
    assert config.providers({})["rss"]["limit_per_feed"] == 20
    assert config.sample_settings({"sample": {"min_employees_options": [100, 250]}})["thresholds"] == [100, 250]


# --- streams ------------------------------------------------------------------

EVENT_SPEC = "company_id string, signal_type string, url string, ts timestamp, signal_strength double"


def _land(spark, folder, rows):
    spark.createDataFrame(rows, EVENT_SPEC).coalesce(1).write.mode("append").parquet(folder)


def test_stream_keeps_first_and_drops_repeats(spark, tmp_path):
    folder = str(tmp_path / "in")
    ts = dt.datetime(2024, 1, 1)
    _land(spark, folder, [("1", "news", "u", ts, 0.1), ("1", "news", "u", ts, 0.1), ("2", "news", "u", ts, 0.2)])
    stream = st.read_event_stream(spark, folder, spark.read.parquet(folder).schema)
    out = st.run_available(st.dedupe_stream(stream), f"t-{uuid.uuid4().hex[:6]}")
    assert out.count() == 2


def test_stream_updates_replace_earlier_windows(spark, tmp_path):
    folder, name = str(tmp_path / "in"), f"t-{uuid.uuid4().hex[:6]}"
    schema = spark.createDataFrame([], EVENT_SPEC).schema
    _land(spark, folder, [("1", "news", "u", dt.datetime(2024, 1, 10), 1.0)])
    run = lambda: st.run_available(
        st.volume_stream(st.read_event_stream(spark, folder, schema), "signal_type", "5 days"),
        name, ["window_start", "signal_type"],
    )
    assert [r["total_signals"] for r in run().collect()] == [1]
    _land(spark, folder, [("1", "news", "v", dt.datetime(2024, 1, 10), 2.0)])
    _land(spark, folder, [("1", "news", "w", dt.datetime(2023, 1, 1), 2.0)])  # far behind the watermark
    got = run().collect()
    assert [(r["total_signals"], r["total_strength"]) for r in got] == [(2, 3.0)]


def test_streams_without_a_watermark_keep_late_rows(spark, tmp_path):
    folder = str(tmp_path / "in")
    schema = spark.createDataFrame([], EVENT_SPEC).schema
    days = [dt.datetime(2024, 3, 1), dt.datetime(2024, 6, 1), dt.datetime(2023, 1, 1), dt.datetime(2022, 1, 1)]
    for i, day in enumerate(days):  # one file and one batch each, the last two far behind
        _land(spark, folder, [("1", "news", f"u{i}", day, 1.0)])
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    volume = st.volume_stream(stream(), "signal_type", "5 days", late=None)
    got = st.run_available(volume, f"t-{uuid.uuid4().hex[:6]}", ["window_start", "signal_type"])
    assert [r["total_signals"] for r in got.collect()] == [1, 1, 1, 1]
    assert st.run_available(st.dedupe_stream(stream(), late=None), f"t-{uuid.uuid4().hex[:6]}").count() == 4
    assert st.run_available(stream(), f"t-{uuid.uuid4().hex[:6]}", st.EVENT_KEY).count() == 4


def test_keep_last_stream(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    ts = dt.datetime(2024, 1, 1)
    schema = spark.createDataFrame([], EVENT_SPEC).schema
    for strength in (0.1, 0.7):
        _land(spark, folder, [("1", "news", "u", ts, strength)])
        query = (
            st.read_event_stream(spark, folder, schema).writeStream.foreachBatch(st.keep_last_writer(out))
            .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        )
        query.awaitTermination()
    assert [r["signal_strength"] for r in st.read_last(spark, out).collect()] == [0.7]


def test_batches_are_merged_by_level(spark, tmp_path):
    path = str(tmp_path / "state")
    write = st.keep_last_writer(path, ["k"], every=3)
    want = {}
    for i in range(20):
        rows = [(f"k{i % 7}", i), (f"own{i}", i)]
        want |= dict(rows)
        batch = spark.createDataFrame(rows, "k string, v int")
        write(batch, i)
        if i in (4, 8):  # a replay, merged or not, changes nothing
            write(batch, i)
    folders = st.BatchFolders(spark, path, ["k"], 3)
    assert folders.ranges() == [(0, 8), (9, 17), (18, 18), (19, 19)]
    assert {r["k"]: r["v"] for r in st.read_last(spark, path, ["k"]).collect()} == want
    # a writer that stopped before it removed what it had merged
    spark.createDataFrame([("k0", -1, 3)], "k string, v int, _batch bigint").write.parquet(f"{path}/{folders.name(3, 3)}")
    assert {r["k"]: r["v"] for r in st.read_last(spark, path, ["k"]).collect()} == want
    assert len([p for p in (tmp_path / "state").iterdir() if p.name.startswith("batches=")]) == 5
