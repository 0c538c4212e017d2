"""Sources and extraction on texts shaped like real filings."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from plumbline.metrics import MetricSpec, spec_table
from plumbline.plans.candidates import class_candidates
from plumbline.session import durable, shared_folder
from plumbline.sources import html_tables as ht, prose, structured as st


def docs(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")


def fees(spark, text):
    return [(r["metric"], r["value"], r["flags"], r["effective_until"]) for r in
            prose.fee_prose(docs(spark, text), ["id"]).orderBy("pos").collect()]


WAS = "Prior to May 1, 2019, the Management Fee fell due each month at an annual rate of 4.75% of average net assets."
NOW = "Its management fee is calculated at an annual rate of 2.25% on all holdings."
M, H, I = "management_fee_pct", "incentive_hurdle_pct", "incentive_fee_pct"


def test_historical_rate_is_marked_and_a_neighbour_is_not(spark):
    was, now = (M, 4.75, ["superseded_rate"], date(2019, 5, 1)), (M, 2.25, [], None)
    assert fees(spark, WAS) == [was] and fees(spark, NOW) == [now]
    for text in (f"{WAS} {NOW}", f"{NOW} {WAS}"):
        assert {f[1]: f for f in fees(spark, text)} == {4.75: was, 2.25: now}, "both statements of one text come back"


def test_quarterly_and_annual_hurdles(spark):
    assert fees(spark, "a flat hurdle rate of 3.0% quarterly, as")[0][:2] == (H, 12.0)
    assert fees(spark, "or 2.25% per quarter, so an annualized hurdle rate of 9.00%, and a catch-up")[0][:2] == (H, 9.0)
    assert fees(spark, "for each calendar quarter, above a hurdle rate of 2.25%. Then")[0][:2] == (H, 9.0)
    assert not any(v == 1.765 for _, v, _, _ in fees(spark, "lies above the 2.250% hurdle rate and below the catch up of 1.765%; so"))
    far = "annualized hurdle rate of 2.50%. " + "Nothing more. " * 300 + "hurdle rate of 2.50% per quarter"
    assert sorted(v for _, v, _, _ in fees(spark, far)) == [2.5, 10.0], "the same number, yearly and quarterly"


def test_quarterly_fee_on_adjusted_equity_is_annualised(spark):
    text = ("owed a quarterly management fee equal to the greater of $9,000 or 0.25% of weighted average adjusted equity "
            "and quarterly incentive compensation equal to 15.0% of the excess over")
    got = {(m, v) for m, v, _, _ in fees(spark, text)}
    assert (M, 1.0) in got and (I, 15.0) in got


def test_reduced_from_to_gives_two_dated_rows(spark):
    text = "The board met on May 9, 2024; effective as of June 1, 2024, the management fee rate was reduced from 2.125% to 2.0%."
    got = {r["value"]: (r["flags"], r["effective_from"], r["effective_until"]) for r in
           prose.superseded_pairs(docs(spark, text), ["id"]).collect()}
    assert got == {2.0: ([], date(2024, 6, 1), None), 2.125: (["superseded_rate"], None, date(2024, 6, 1))}


def test_first_stops_and_windows(spark):
    places = prose.Places(["fee", "management fee"], most=1)
    assert list(places.of("a fee, a management fee, a fee")) == [2, 9] and list(prose.Places(["fee"]).of("fee fee")) == [0, 4]
    wide = "management fee " + "x" * 5000 + " is calculated at an annual rate of 1.5% "
    spec = MetricSpec("rate", anchors=("management fee",), patterns=(r"annual rate of ([0-9.]+)",))
    read = lambda **k: prose.declared_metrics(docs(spark, wide), [spec], ["id"], **k).count()
    assert read() == 0 and read(after=None) == 1


def test_places_of_many_phrases_in_markup():
    text = "Mana<b>gement</b> fee; MANAGEMENT<br>\n&nbsp;Fee and management&#8217;fee, <i title='Management  Fee'>managementfee</i> < fee"
    at = [i for i in range(len(text)) if text[i:].lower().startswith("management") and "fee" in text[i + 10:i + 24].lower()]
    assert list(prose.Places(["management fee", "no such phrase"]).of(text)) == at and len(at) == 4
    many = prose.Places([f"word{i} x" for i in range(3000)] + ["word7 x y"])
    assert many.hits("word12 x; word7 x y; word299 9") == [(0, 12), (10, 7), (10, 3000)]
    assert list(prose.Places([]).of("text")) == [] and list(prose.Places([""]).of("text")) == [0] and prose.Places(["a"]).hits("") == []


def test_specs_as_rows(spark):
    specs = [MetricSpec(f"m{i}", anchors=(f"rate {i} is",), patterns=(rf"rate {i} is ([0-9.]+)",)) for i in range(400)]
    df = docs(spark, " ".join(f"rate {i} is {i}.5;" for i in (3, 77, 399)), "rate 400 is 1")
    for given in (specs, spec_table(spark, specs)):
        got = {r["metric"]: r["value"] for r in prose.declared_metrics(df, given, ["id"]).collect()}
        assert got == {"m3": 3.5, "m77": 77.5, "m399": 399.5}
    with pytest.raises(ValueError):
        prose.declared_metrics(df, spec_table(spark, specs[:1]).union(spec_table(spark, specs[:1])), ["id"])


def test_table_tree():
    page = ("<TABLE><tr><td>a<td>b <table><tr><th>in</th></tr><tr><td>x<!-- </table> --></td></tr></table> c</tr><tr><td></td></tr>"
            "<tr><td>last</TABLE> text <table><td>no row</td><tr></tr>")
    rows = [ht._rows_of(page, t) for t in ht.table_tree(page)]
    assert rows == [[["a", "b c"], ["last"]], [["in"], ["x"]], [["no row"]]]
    assert ht.table_tree("</table><tr><td>x") == [] and ht.table_tree("") == []


def test_declared_metrics_of_entity_types_and_odd_captures(spark):
    spec = MetricSpec("rate", anchors=("rate",), patterns=(r"rate ([0-9.]+)",), entity_types=("A",))
    df = spark.createDataFrame([(1, "A", "rate 1.5"), (2, "B", "rate 1.5"), (3, None, "rate 1.5"), (4, "A", "rate 1.2.3"), (5, "A", None)],
                               "id int, kind string, text string")
    assert [(r["id"], r["value"]) for r in prose.declared_metrics(df, [spec], ["id"], entity_type=df["kind"]).collect()] == [(1, 1.5)]


def test_declared_metric_reads_through_tags_and_whole_texts(spark):
    spec = MetricSpec("expenses", near=("Total Annual Expenses",), take="first_percent", within=120, high=5.0)
    late = "filler. " * 20_000 + "Total <b>Annual</b>&nbsp;Expenses are 7.25 % of assets"
    # Only the phrase may carry tags; the value must follow it in plain text.
    got = prose.declared_metrics(docs(spark, late, "Total annual expenses: none. 3%"), [spec], ["id"]).collect()
    assert [(r["id"], r["value"], r["flags"]) for r in got] == [(0, 7.25, ["out_of_sane_range"])]


def test_quotes_tolerate_typography_but_not_invention(spark):
    src = docs(spark, "A house   pays its “Keeper” a yearly\nsum of 3.00%.", "other words entirely here", None, "")
    q = spark.createDataFrame([(1, 'house pays its "keeper" a yearly sum of 3.00%'), (2, "a yearly sum of 3.25%"), (3, "ouse pays its Keep"),
                               (4, "sum of"), (5, "rds"), (6, "um o"), (7, "keeper a"), (8, ""), (9, None), (10, "its"), (11, "s ent")],
                              "qid int, text string")
    found = prose.locate_quotes(q, src, "qid", "id")
    # The third quote has a quotation mark missing.
    assert sorted(tuple(r) for r in found.collect()) == [(0, 1), (0, 4), (0, 6), (0, 10), (1, 5), (1, 11)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_tiers(spark):
    t = docs(spark, "Income Incentive Fee and the capital gain incentive fee", "income incentive fee only", "nothing")
    got = [r[0] for r in t.orderBy("id").select(prose.tier_structure(F.col("text"))).collect()]
    assert got == ["income and capital-gain tiers", "income incentive fee", ""]


ROWS = [["CLASS I", "2025", "2024", "2023"], ["Net asset value, beginning of period", "$", "11.10", "$", "10.90"],
        ["Net asset value, end of period", "$", "11.40", "$", "11.10", "$", "10.90"],
        ["Total Return, at Net Asset Value (2)", "4.10", "%", "5.20", "%", "(1.30", ")%"],
        ["Total Dividends and/or distributions to shareholders:", "(0.57", ")", "(0.55", ")", "(0.54", ")"]]


def rows_frame(spark, rows, preamble=""):
    data = [("E", "N-CSR", date(2025, 12, 31), 0, i, cells, preamble) for i, cells in enumerate(rows)]
    return spark.createDataFrame(data, "entity string, form string, report_date date, table_no int, row_no int, "
                                       "cells array<string>, preamble string")


KEYS = ["entity", "form", "report_date", "table_no"]


def chained(*years):
    total = 1.0
    for y in years:
        total *= 1 + y / 100
    return (total ** (1 / len(years)) - 1) * 100


def test_class_table_and_candidates(spark):
    tables = ht.highlights_from_rows(rows_frame(spark, ROWS), KEYS)
    t = tables.first()
    assert (t["share_class"], t["years"], t["nav_end"]) == ("CLASS I", [2025, 2024, 2023], [11.40, 11.10, 10.90])
    assert (t["total_return"], t["dividends"]) == ([4.10, 5.20, -1.30], [0.57, 0.55, 0.54])
    ents = spark.createDataFrame([("E", "Class I")], "entity string, institutional_class string")
    got = {r["metric"]: r["value"] for r in class_candidates(tables, ents).collect()}
    assert got["net_return_3y_pct"] == pytest.approx(chained(4.1, 5.2, -1.3), abs=1e-6)
    assert got["distribution_yield_pct"] == pytest.approx(100 * 0.57 / 11.40, abs=1e-6)
    assert got["nav_per_share_usd"] == 11.40 and got["net_return_1y_pct"] == pytest.approx(4.10) and "net_return_5y_pct" not in got
    other = spark.createDataFrame([("E", "Class Y")], "entity string, institutional_class string")
    assert class_candidates(tables, other).count() == 0


def test_published_goldens(spark):
    rows = [["CLASS I", "2025", "2024", "2023"], ["Net asset value, end of period", "8.32", "8.55", "8.52"],
            ["Total return", "6.27", "10.80", "14.15"], ["Total distributions to shareholders", "(0.75)", "(0.86)", "(0.88)"]]
    ents = spark.createDataFrame([("E", "Class I")], "entity string, institutional_class string")
    got = {r["metric"]: r["value"] for r in class_candidates(ht.highlights_from_rows(rows_frame(spark, rows), KEYS), ents).collect()}
    assert got["net_return_3y_pct"] == pytest.approx(10.3593, abs=1e-4) and got["distribution_yield_pct"] == pytest.approx(9.0144, abs=1e-4)


def test_a_year_stated_twice_counts_once(spark):
    rows = [["CLASS I", "2025", "2025", "2024", "2023"], ["Net asset value, end of period", "9.0", "9.1", "9.2", "9.3"],
            ["Total return", "1.00", "2.00", "3.00", "4.00"]]
    tables = ht.highlights_from_rows(rows_frame(spark, rows), KEYS)
    assert tables.first()["years"] == [2025, 2025, 2024, 2023]
    ents = spark.createDataFrame([("E", "Class I")], "entity string, institutional_class string")
    got = {r["metric"]: r["value"] for r in class_candidates(tables, ents).collect()}
    assert got["net_return_3y_pct"] == pytest.approx(chained(2.0, 3.0, 4.0), abs=1e-6) and got["net_return_1y_pct"] == pytest.approx(2.0)


def test_class_from_heading_and_headers_anywhere(spark):
    rows = [["For the Year Ended June 30, 2025", "For the Year Ended June 30, 2024"],
            ["Net asset value, end of period", "$", "7.70", "$", "7.30"], ["Total return 4", "3.25", "%", "2.50", "%"]]
    t = ht.highlights_from_rows(rows_frame(spark, rows, "Highlights of Class I Shares, per share"), KEYS).first()
    assert (t["share_class"], t["total_return"]) == ("Class I", [3.25, 2.50])
    late = [[f"note {i}"] for i in range(12)] + rows
    t = ht.highlights_from_rows(rows_frame(spark, late, "Class I"), KEYS).first()
    assert (t["years"], t["nav_end"]) == ([2025, 2024], [7.70, 7.30])


def test_tables_at_any_distance_unless_limited(spark):
    page = lambda n: "<p>Fees and Expenses</p>" + "x" * n + "<table><tr><td>Management fee</td><td>1.0%</td></tr></table>"
    df = spark.createDataFrame([(0, page(900)), (1, page(90_000)), (2, None)], "id int, html string")
    assert sorted(r["id"] for r in ht.fee_tables(df, ["id"], "html").collect()) == [0, 1]
    assert [r["id"] for r in ht.fee_tables(df, ["id"], "html", within=1000).collect()] == [0]
    pre = ht.html_tables(df, ["id"], "html", ht.FEE_ANCHORS, preamble=5).where("id = 0").first()["preamble"]
    assert pre == "xxxxx"


def test_nested_facts_and_series_files(spark, tmp_path):
    body = ('{"cik": "0001", "facts": {"us-gaap": {"Assets": {"units": {"USD": [{"val": 5, "end": "2025-12-31", "accn": "a-1", '
            '"form": "10-K", "filed": "2026-02-01", "fy": 2025, "fp": "FY"}]}}}}}')
    (tmp_path / "f.json").write_text(body)
    r = st.flatten_facts(st.read_facts(spark, str(tmp_path / "f.json")), ["cik"]).first()
    assert (r["cik"], r["tag"], r["unit"], r["val"], r["end"], r["start"]) == ("0001", "Assets", "USD", 5.0, date(2025, 12, 31), None)
    head = "quarter,net_return_qtd_pct,net_return_1y_pct,net_return_3y_pct,net_return_5y_pct,nav_per_share_usd,total_aum_usd_mm,management_fee_pct,incentive_fee_pct,incentive_hurdle_pct,leverage_ratio_dte,distribution_yield_pct\n"
    (tmp_path / "s.csv").write_text(head + "Q3 2025,1,2,3,4,25.94,6,1.25,12.5,6,0.98,9.14\nQ4 2025,1,2,3,4,26.12,6,1.25,12.5,6,0.96,9.22\n")
    got = st.own_series(st.read_series(spark, str(tmp_path / "s.csv")), F.lit(date(2025, 11, 30))).collect()
    assert [(r["period_end"], r["nav_per_share_usd"]) for r in got] == [(date(2025, 9, 30), 25.94)]


def test_sinks_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(date(2025, 12, 31), "E", 1.0), (date(2025, 9, 30), "E", 2.0)], "anchor date, entity string, value double")
    st.write_tables({"coverage": df}, str(tmp_path), ["anchor"])
    back = spark.read.parquet(f"{tmp_path}/coverage")
    assert sorted(map(tuple, back.select("anchor", "entity", "value").collect())) == sorted(map(tuple, df.collect()))
    assert (tmp_path / "coverage" / "anchor=2025-12-31").is_dir()
    again = spark.createDataFrame([(date(2025, 9, 30), "F", 3.0)], df.schema)
    for _ in range(2):
        st.write_tables({"coverage": again}, str(tmp_path), ["anchor"])
    back = spark.read.parquet(f"{tmp_path}/coverage").select("anchor", "entity", "value")
    assert sorted(map(tuple, back.collect())) == [(date(2025, 9, 30), "F", 3.0), (date(2025, 12, 31), "E", 1.0)]
    st.write_csv(df, f"{tmp_path}/c")
    assert spark.read.option("header", "true").csv(f"{tmp_path}/c").count() == 2


def test_durable_tables_use_the_shared_folder(spark):
    df = spark.range(5).withColumn("m", F.create_map(F.lit("a"), F.col("id")))
    kept = durable(df)
    assert kept.schema.simpleString() == df.schema.simpleString() and kept.count() == 5
    folder = shared_folder(spark).removeprefix("file:")
    assert all(folder in f for f in kept.inputFiles())
    assert durable(df.where("id < 0")).count() == 0


def test_reports_that_cannot_be_read_are_listed(spark):
    good = ("<r><formData><genInfo><regName>A</regName></genInfo><fundInfo><netAssets>5</netAssets></fundInfo></formData></r>")
    rows = [(1, good), (2, "<r><formData>"), (3, None), (4, "<r><formData><genInfo><regName>A</regName></genInfo></formData></r>"), (5, "<r/>")]
    df = spark.createDataFrame(rows, "id int, xml string")
    got = {r["id"]: r["reason"] for r in st.unreadable_reports(df, "xml", ["id"]).collect()}
    assert got == {2: "unreadable", 3: "no_document", 4: "no_balances", 5: "unreadable"}
    assert [r["id"] for r in st.parse_reports(df, "xml", ["id"]).collect()] == [1]


def test_many_short_quotes_are_found_without_carrying_them(spark, monkeypatch):
    src = docs(spark, "one two three four five six seven eight", "two threes", "x")
    q = spark.createDataFrame(enumerate(["two", "wo th", "two three four", "three four five six", "e t", "eight", "seven eight nine",
                                         "one two three four five six", "x"]), "qid int, text string")
    want = sorted(tuple(r) for r in prose.locate_quotes(q, src, "qid", "id").collect())
    assert want == [(0, 0), (0, 1), (0, 2), (0, 3), (0, 4), (0, 5), (0, 7), (0, 8), (1, 0), (1, 1), (2, 8)]
    monkeypatch.setattr(prose, "SHORT_MOST", 0)
    assert sorted(tuple(r) for r in prose.locate_quotes(q, src, "qid", "id").collect()) == want


def test_pages_of_one_file_are_dealt_to_many_tasks(spark):
    """A file with one row group gives one task; pages are read in as many as shuffles have."""
    from catalog import extraction as x

    pages = x.highlight_pages(spark, "/root/testdata/sf0.001")
    parts = pages.select("html").rdd.glom().map(len).collect()
    assert len(parts) == int(spark.conf.get("spark.sql.shuffle.partitions")) and min(parts) > 0


def test_phrases_inside_and_outside_of_markup():
    from plumbline.sources.phrases import Places

    text = "<p title='Fund Total'>A <b>fund</b> total</p><!-- fund total --><i>x</i>"
    assert Places(["fund total"]).hits(text) == [(10, 0), (27, 0), (50, 0)]
    assert Places(["fund total"]).hits("<p>fu</p>nd total <i fund> total") == []


def test_only_named_rows_are_read_for_numbers(spark):
    rows = [("CLASS I", "2024", "2023"), ("Net asset value, end of period", "9.10", "9.20"), ("Odd row", "1.10", "2.20"),
            ("Total distributions to shareholders", "none"), ("Total dividends to shareholders", "(0.75", ")", "0.80")]
    table = spark.createDataFrame([(1, 0, n, list(r), "") for n, r in enumerate(rows)],
                                  "o int, table_no int, row_no int, cells array<string>, preamble string")
    got = ht.highlights_from_rows(table, ["o", "table_no"]).collect()
    assert [(r["share_class"], r["years"], r["nav_end"], r["total_return"], r["dividends"]) for r in got] == [
        ("CLASS I", [2024, 2023], [9.1, 9.2], None, [0.75, 0.8])]


def test_long_tables_of_specs_take_several_passes(spark, monkeypatch):
    from plumbline.sources import prose

    specs = [MetricSpec(f"m{i}", unit="count", anchors=(f"mail{i}.",), patterns=(rf"mail({i})\.",)) for i in range(40)]
    docs = spark.createDataFrame([(1, "mail3. mail17. mail39."), (2, "mail0. <b>mail17.</b>"), (3, "none")], "doc_id int, text string")
    read = lambda: sorted(map(tuple, prose.declared_metrics(docs, spec_table(spark, specs), ["doc_id"]).select("doc_id", "metric", "value").collect()))
    whole = read()
    monkeypatch.setattr(prose, "MOST_SPECS", 30)
    assert whole == read() == [(1, "m17", 17.0), (1, "m3", 3.0), (1, "m39", 39.0), (2, "m0", 0.0), (2, "m17", 17.0)]
    twice = spec_table(spark, specs).union(spec_table(spark, specs[:1]))
    with pytest.raises(ValueError, match="defined twice"):
        prose.declared_metrics(docs, twice, ["doc_id"])


def test_fee_pages_are_read_once(spark):
    page = ("<p>Annual Expenses</p><table><tr><td>of net assets</td></tr><tr><td>Management Fee</td><td>1.25%</td></tr>"
            "<tr><td>Other expenses</td><td>0.1%</td></tr><tr><td>Total annual expenses</td><td>2%</td></tr></table>")
    out = ht.fee_tables(spark.createDataFrame([(1, page), (2, page.replace("Other", "Incentive"))], "k int, html string"), ["k"], "html")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1
    got = {(r.k, r.metric, r.value, r.basis["fee_basis"], *r.flags) for r in out.collect()}
    assert got == {(1, "management_fee_pct", 1.25, "pct_of_net_assets"), (2, "management_fee_pct", 1.25, "pct_of_net_assets"),
                   (1, "incentive_fee_pct", 0.0, "none_disclosed", "inferred_from_absence")}


def test_places_that_share_a_window_are_matched_once(monkeypatch):
    import pyarrow as pa

    text = "a management fee of 2%. " * 50
    calls, plain = [], prose.shown
    monkeypatch.setattr(prose, "shown", lambda markup: calls.append(1) or plain(markup))
    search = prose.Search(("management fee",), (r"fee of ([0-9])%",))
    batch = pa.RecordBatch.from_arrays([pa.array([7, 8]), pa.array([text, "no fee"])], names=["k", "text"])
    rows = [r for b in prose.matcher([search], None, None)(iter([batch])) for r in b.to_pylist()]
    assert [r["pos"] for r in rows] == list(range(2, len(text), 24)) and len(calls) == 1
    assert {(r["k"], r["rule"], r["pattern"], r["value_start"], r["value_end"], *r["captured"]) for r in rows} == {(7, 0, 0, 20, 21, "2")}


def test_letters_hold_every_phrase_that_is_found():
    import random

    from plumbline.sources.phrases import Places, phrase_letters, text_letters

    some = random.Random(5)
    units = ["fee", "Fund", " ", "\n", " ", "&nbsp;", "<b>", "</i fund>", "<", "&", "ΟΔΟΣ", "İ", "ß", "a", "1.", "\0"]
    found = 0
    for _ in range(3000):
        text = "".join(some.choices(units, k=12))
        phrases = ["".join(some.choices(units, k=3)) for _ in range(20)]
        for _, i in Places(phrases).hits(text):
            found += 1
            assert phrase_letters(phrases[i]) in text_letters(text)
    assert found > 1000


def test_hashes_find_phrases_of_every_size(spark, monkeypatch):
    from plumbline.sources import hashed

    phrases = ["x", "Zw", "fee", "rate of", "late fee", "a phrase that is longer than others", "ΟΔΟΣ fee", "q" * 70, "q" * 64]
    specs = spark.createDataFrame([(i, [p]) for i, p in enumerate(phrases)], "n long, phrases array<string>")
    texts = ["", "none here", "an x", "zw", "a FEE; Rate<br>of", "late  fee", f"{'-' * 300}a phrase that is longer than others",
             "οδος&nbsp;fee", "q" * 71, "phrase that is longer than"]
    want = {(t, p) for t, text in enumerate(texts) for _, p in prose.Places(phrases).hits(text)}
    # Slices so small that texts are cut, and a table in several parts.
    monkeypatch.setattr(hashed, "SLICE", 50)
    monkeypatch.setattr(hashed, "PART_BITS", 12)
    keyed = durable(hashed.phrase_keys(specs, "n", "phrases"))
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(2)
    near = hashed.near_phrases(docs, hashed.asked(keyed))
    got = near.select("id", F.explode("_keys").alias("_key")).join(keyed.where("_spec is not null"), "_key").select("id", "_spec").collect()
    assert sorted(map(tuple, got)) == sorted(want) and len(want) >= 10


def test_long_tables_of_specs_read_documents_once(spark, monkeypatch):
    """Documents are read once, however long the table; specs that share a phrase with many take a pass of their own."""
    own = [MetricSpec(f"m{i}", unit="count", anchors=(f"mail{i}.", f"post {i};"), patterns=(rf"mail({i})\.", rf"post ({i});"), high=50.0,
                      entity_types=("A",) if i % 2 else ()) for i in range(400)]
    shared = [MetricSpec(f"s{i}", unit="count", anchors=("fee",), patterns=(rf"fee ({i}[0-9])",)) for i in range(8)]
    every = [MetricSpec("e", unit="count", anchors=("",), patterns=(r"([0-9]+) in all",))]
    rows = [(1, "A", "mail3. mail117. <b>Mail39.</b> fee 71"), (2, "B", "mail0. post<br> 17; post 18; mail18. 5 in all"), (None, None, "mail17. POST 4;"),
            (None, "A", "mail17. post 4; mail4."), (None, "A", "mail17. post 4; mail4."), (4, "A", "none"), (5, "A", None), (6, "A", ""),
            (7, None, "İ mail8. " + "x" * 4000 + " mail8. mail398.")]
    docs = spark.createDataFrame(rows, "doc_id int, kind string, text string")
    read = spark.sparkContext.accumulator(0)
    counted = docs.repartition(3).withColumn("text", F.udf(lambda t: read.add(1) or t, "string").asNondeterministic()(F.col("text")))

    def got(df, specs, **how):
        return sorted(map(str, prose.declared_metrics(df, spec_table(spark, specs), ["doc_id"], entity_type=df["kind"], **how).collect()))

    cases = ({}, {"stops": 1, "before": 0, "after": 12}, {"before": None, "after": None})
    want = [got(docs, own + shared + every, **how) for how in cases]
    # The phrase of eight specs and the empty one are looked up in a pass.
    monkeypatch.setattr(prose, "MOST_SPECS", 30)
    monkeypatch.setattr(prose, "MOST_SHARED", 6)
    assert [got(docs, own + shared + every, **how) for how in cases] == want and len(want[0]) == 11
    assert [x for x in want[0] if "metric='m" in x] == got(counted, own) and read.value == len(rows)
