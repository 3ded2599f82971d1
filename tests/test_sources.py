import os
import zipfile

from pyspark.sql import functions as F

from linkforge.sources import delimited, listing, manifest, pages


def _line(fields_by_pos, n=142):
    f = [""] * n
    for p, v in fields_by_pos.items():
        if p < n:
            f[p] = v
    return "|".join(f)


def _snapshot_lines():
    rec = lambda key, name, n=142, **kw: _line({0: key, 11: name, 19: "123456789", 17: "Town", **kw}, n)
    lines = [
        "BOF PUBLIC V2 20240101 0000009",
        rec("AAA111", "Alpha LLC", 122),
        rec("BBB222", "Beta Corp", 142)[:-4] + "!end",
        rec("CCC333", "Short Row", 121),
        "",
        "!end",
        rec("   ", "No Key"),
        rec("DDD444", "First Version Inc"),
        rec("DDD444", "Second Version Inc"),
        rec("BOFKEY", "Bof Key Ltd"),
        rec("EEE555", "Café Éco Inc."),
        rec("FFF666", "\xa0Padded Name\xa0"),
        rec("GGG777", "Foo\rBar Company") + "\r",
    ]
    return ("\n".join(lines) + "\n").encode("latin-1")


EXPECTED = {
    "AAA111": ("Alpha LLC", "alpha"),
    "BBB222": ("Beta Corp", "beta"),
    "DDD444": ("Second Version Inc", "second version"),
    "BOFKEY": ("Bof Key Ltd", "bof key"),
    "EEE555": ("Café Éco Inc.", "café éco"),
    "FFF666": ("Padded Name", "padded name"),
    "GGG777": ("Foo\rBar Company", "foo bar"),
}


def _check(df):
    rows = {r.uei: r for r in df.collect()}
    assert set(rows) == set(EXPECTED)
    for k, (legal, norm) in EXPECTED.items():
        assert rows[k].legal_name == legal and rows[k].name_norm == norm, (k, rows[k])
        assert str(rows[k].snapshot_date) == "2024-01-01"
        assert rows[k].zip5 == "12345" and rows[k].phys_city == "Town"


def test_text_reader(spark, tmp_dir):
    p = os.path.join(tmp_dir, "SAM_PUBLIC_MONTHLY_V2_20240101.dat")
    with open(p, "wb") as fh:
        fh.write(_snapshot_lines())
    _check(delimited.registrations_from_lines(delimited.read_text_lines(spark, p)))


def test_zip_reader(spark, tmp_dir):
    p = os.path.join(tmp_dir, "SAM_PUBLIC_MONTHLY_V2_20240101.ZIP")
    with zipfile.ZipFile(p, "w") as zf:
        zf.writestr("readme.txt", "x")
        zf.writestr("SAM_PUBLIC_MONTHLY_V2_20240101.dat", _snapshot_lines())
    lines = delimited.read_zip_lines(spark, tmp_dir)
    assert lines.where(F.col("line_no") == 0).first().raw.startswith("BOF")
    _check(delimited.registrations_from_lines(lines))


def test_source_selection(spark):
    rows = [("Public V2", "SAM_PUBLIC_MONTHLY_V2_20250101.ZIP"), ("Public V2", "SAM_PUBLIC_MONTHLY_V2_20260101.ZIP"),
            ("Public V2", "SAM_PUBLIC_UTF-8_MONTHLY_V2_20260101.ZIP"),
            ("Public - Historical", "SAM_PUBLIC_MONTHLY_2025_NOV_X.zip"),
            ("Public - Historical", "sam_public_monthly_v2_20250101.zip"),
            ("Public - Historical", "notes.Zip"), ("Other", "SAM_PUBLIC_MONTHLY_V2_20270101.ZIP")]
    lst = spark.createDataFrame(rows, "folder string, name string")
    all_ = [r.name for r in listing.source_file_select(lst, "all").collect()]
    assert all_ == ["SAM_PUBLIC_MONTHLY_V2_20250101.ZIP", "SAM_PUBLIC_MONTHLY_V2_20260101.ZIP",
                    "SAM_PUBLIC_MONTHLY_2025_NOV_X.zip"]
    assert listing.source_file_select(lst, "first").first().name == "SAM_PUBLIC_MONTHLY_V2_20250101.ZIP"
    assert listing.source_file_select(lst, "latest").first().name == "SAM_PUBLIC_MONTHLY_V2_20260101.ZIP"
    loaded = spark.createDataFrame([("SAM_PUBLIC_MONTHLY_V2_20250101.ZIP",)], "source_file string")
    new = [r.name for r in listing.incremental_new_files(listing.source_file_select(lst, "all"), loaded).collect()]
    assert sorted(new) == ["SAM_PUBLIC_MONTHLY_2025_NOV_X.zip", "SAM_PUBLIC_MONTHLY_V2_20260101.ZIP"]


def test_page_links_class_and_hidden_spans(spark):
    html = ('<ul><li><a class="data-service-file-link" href="x"> <span class="sr-only">Download</span> '
            'FILE_A.ZIP </a></li><li><a class="other" href="y">Other</a></li>'
            '<li><a class="btn data-service-file-link" href="z"> </a></li>'
            '<li><a href="w" class="data-service-file-link"><b>Part</b> Two &amp; More</a></li></ul>')
    df = spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")
    got = [r.link_text for r in pages.page_links(df).orderBy("link_pos").collect()]
    assert got == ["FILE_A.ZIP", "PartTwo & More"]
    every = [r.link_text for r in pages.page_links(df, None).orderBy("link_pos").collect()]
    assert every == ["FILE_A.ZIP", "Other", "PartTwo & More"]


def test_manifest(spark):
    doc = ('{"_embedded": {"customS3ObjectSummaryList": ['
           '{"key": "Entity Registration/Public V2/A.ZIP", "displayKey": "A.ZIP", "dateModified": "2025-01-01"},'
           '{"key": "Entity Registration/Public V2/B.ZIP", "displayKey": "B.ZIP", "dateModified": "2025-02-01"}]}}')
    docs = spark.createDataFrame([("Public V2", doc)], "folder string, json string")
    expected = manifest.listing_flatten(docs)
    assert [r.local_path for r in expected.orderBy("key").collect()] == ["Public V2/A.ZIP", "Public V2/B.ZIP"]
    present = spark.createDataFrame([("a.zip", 3 * 1024 * 1024)], "name string, size_bytes long")
    st = {r.name: (r.downloaded, r.size_mb) for r in manifest.manifest_status(expected, present).collect()}
    assert st == {"A.ZIP": (True, 3.0), "B.ZIP": (False, None)}
    assert [r.name for r in manifest.manifest_missing(expected, present).collect()] == ["B.ZIP"]
    prog = manifest.manifest_progress(manifest.manifest_status(expected, present)).first()
    assert (prog.done, prog.total) == (1, 2)


def test_rendered_fixture_lines_equal_sql_rendering(spark):
    import duckdb

    import fixture_views as fixtures
    sf = "/root/testdata/sf0.001"
    got = sorted((r.line_no, r.raw) for r in fixtures.customer_lines(spark, sf).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW customer AS SELECT * FROM read_parquet('{sf}/customer.parquet')")
    want = sorted((n, raw) for _, n, raw in con.execute(fixtures.customer_lines_sql("customer")).fetchall())
    assert got == want


def test_parsing_renders_no_fixture_line_again(spark):
    import fixture_views as fixtures
    rows = delimited.registrations_from_lines(fixtures.customer_lines(spark, "/root/testdata/sf0.001"))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "c_custkey" not in plan and "Relation" in plan


def test_page_links_match_whole_class_words_and_decode_entities(spark):
    link = "data-service-file-link"
    html = (f'<a class="{link}-disabled">No</a><a data-class="{link}" href=x>No</a><a href=y class={link}>Bare</a>'
            f"<a class='x {link}\ty'>Single</a><a CLASS = \"{link}\"><span class=\"not-sr-only\">A</span>.ZIP</a>"
            f'<a class="{link}">&nbsp;B&nbsp;&#67;&#x44;&#x1F600;&apos;&amp;lt;&amp;#65; </a>'
            f'<a class="{link}"><span data-x="1" class="a sr-only b">gone</span><i class=sr-only>gone</i>Kept</a>'
            f'<a class="{link}"><span data-class="sr-only">Shown</span></a><a class="{link}">&#0;&#xD800;</a>')
    df = spark.createDataFrame([(1, "u", html), (2, "u", None), (3, "u", "")], "page_id long, url string, html string")
    got = [r.link_text for r in pages.page_links(df).orderBy("link_pos").collect()]
    assert got == ["Bare", "Single", "A.ZIP", "B\xa0CD\U0001f600'&lt;&#65;", "Kept", "Shown", "\ufffd\ufffd"]
