"""End-to-end programmes on small in-code frames with the real schemas."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from abode.operators.quality import GateError
from abode.plans import attributes as E1
from abode.plans import measures as E2
from abode.plans.provenance import joined_row_counts, provenance_extract, renewables_provenance
from abode.rules import e1, e2
from abode.sources.landed import HeaderError
from abode.session import stage_table
from abode.sources.warehouse import warehouse_observations

K1, K2, K3, K4, K5, K6 = (100000000000 + i for i in range(1, 7))


@pytest.fixture(scope="module")
def e1_inputs(spark):
    db = spark.createDataFrame([
        ("S1", "", str(K1), "05/06/2019", "Owner occupied", "Cavity Wall Insulation", None, "ab1 2cd", 1),
        ("S1", "", str(K1), "5/6/2020", "Private rented", "non-eco funded measure", "Loft insulation TOP UP",
         "ab1", 2),
        ("S1", "", str(K2), "43500", "social", "air source heat pump", None, "x", 3),
        ("S1", "", "abc", "05/06/2019", "owner", "cavity wall insulation", None, "x", 4),
        ("S1", "", str(K3), "05/06/2019", "owner", "cavity wall insulation", None, "x", 5),
        ("S1", "", str(K4), None, "owner", "", " ", "x", 6),
        ("S1", "", str(K6), "05/06/2014", "Owner occupied", "flat roof insulation", None, "x", 7),
    ], "OLD_PCON_CODE string, PCON_CODE string, UPRN string, TIMESTAMP string, TENURE string, MEASURE string,"
       " Non_ECO_Measure string, POSTCODE string, seq long")
    sheet = spark.createDataFrame([
        (str(K2), "Owner", "2018/19", "solar photovoltaics", None, "31/02/2020", "AB1 2CD", 1),
        (str(K6), None, None, "Room in roof insulation", None, "01/03/2021", "AB1 2CD", 2),
    ], "UPRN string, TENURE string, FYEAR string, `Measure.as.provided.in.quarterly.data.submission` string,"
       " `If Non-ECO Funded Measure - Please Specify` string, `Completion.Date.(of.measure)` string,"
       " PCODE string, seq long")
    lookup = spark.createDataFrame([(float(K1), "S14000001"), (float(K2), "S14000002"), (float(K4), "S14000003"),
                                    (float(K6), "S14000006")], "UPRN double, PCON24CD string")
    flag_cols = {h: None for h in e1.FEED2_FLAG_HEADERS}

    def f2(uprn, date, tenure, seq, **flags):
        row = {"UPRN": uprn, "Master Completion Date": date, "Tenure": tenure, **flag_cols}
        for k, v in flags.items():
            row[k.replace("_", " ")] = v
        nums = {e1.FEED2_NUMERIC_HEADERS[n]: v for n, v in flags.get("nums", {}).items()}
        row.pop("nums", None)
        row.update({h: nums.get(h) for h in e1.FEED2_NUMERIC_HEADERS.values()})
        row["seq"] = seq
        return row

    rows = [
        f2(str(K1), "2020-05-01", "Owner", 1, **{"Cavity Wall Insulation": "Yes", "Solar PV": "yes"},
           nums={"PRE_SAP_SCORE": "55", "POST_SAP_SCORE": "70", "PRE_FUEL_BILL": "900"}),
        f2("#N/A", "2020-05-01", "Owner", 2),
        f2(str(K5), "2021-03-01", "private", 3, **{"Floor Insulation": "yes", "Air Source Heat Pump": "yes"}),
        f2(str(K1), "2008-02-03", None, 4, nums={"POST_SAP_SCORE": "75"}),
    ]
    cols = ["UPRN", "Master Completion Date", "Tenure", *e1.FEED2_FLAG_HEADERS,
            *e1.FEED2_NUMERIC_HEADERS.values(), "seq"]
    schema = ", ".join(f"`{c}` string" for c in cols[:-1]) + ", seq long"
    feed2 = spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], schema)

    homes = spark.createDataFrame([
        (1, "S99999999", "10", "20", "90", "91", "92", "93", "94", "95"),
        (2, "S99999999", "10", "20", "90", "91", "92", "93", "94", "95"),
        (3, "E12000001", "10", "20", "90", "91", "92", "93", "94", "95"),
    ], "HOME_ID long, GOV_REG_CODE string, PROPERTY_TYPE_CODE string, TENURE_CODE string, "
       "PROPERTY_AGE_CODE string, LOFT_INSULATION_CODE string, EXTERNAL_WALL_TYPE_CODE string, "
       "MAIN_HEATING_FUEL_CODE string, MAIN_HEATING_SYSTEM_CODE string, GLAZING_TYPE_CODE string")
    dictionary = spark.createDataFrame([("10", "Detached House"), ("20", "Owner Occupied"), ("90", "Unknown"),
                                        ("91", "Loft Insulation 150mm"), ("92", "Cavity Wall"),
                                        ("93", "Gas"), ("94", "Boiler"), ("95", "Other")],
                                       "DETAIL_LOOKUP_CODE string, DETAIL_LOOKUP_NAME string")
    details = spark.createDataFrame([
        (1, "20", dt.date(2014, 1, 1)), (2, "20", dt.date(2014, 6, 5)), (1, "93", dt.date(2017, 1, 1)),
        (1, "91", dt.date(2013, 1, 1)), (3, "20", dt.date(2014, 1, 1))],
        "HOMES_HOME_ID long, DETS_LKP_DET_LKP_ID string, DETAIL_DATE date")
    xref = spark.createDataFrame([(K1, 1), (K6, 2), (K3, 3)], f"UPRN long, {e1.XREF_HOME_COLUMN} long")
    return db, sheet, lookup, feed2, homes, dictionary, details, xref


@pytest.fixture(scope="module")
def e1_wide(spark, e1_inputs):
    db, sheet, lookup, feed2, homes, dictionary, details, xref = e1_inputs
    f1 = E1.clean_feed1(db, sheet, lookup)
    f2 = E1.clean_feed2(feed2)
    attrs = [(name, code, rule) for name, _out, code, rule, _ex, _p in e1.ATTRIBUTES if code]
    wh = warehouse_observations(homes, dictionary, details, xref, attrs, e1.WAREHOUSE_REGION)
    return f1, f2, E1.resolve_attributes(E1.observations(f1, f2, wh)).cache()


def test_feed1_cleaning(e1_wide):
    f1 = e1_wide[0]
    rows = {(r.UPRN, r.seq): r for r in f1.collect()}
    keys = {k for k, _ in rows}
    assert keys == {K1, K2, K6}  # "abc" has no key, K3 no constituency, K4 only blanks
    r2 = rows[(K1, 2)]
    assert r2.LOFT_INSULATION_NAME == "Loft Insulation 100-300mm" and r2.TIMESTAMP == dt.date(2020, 6, 5)
    serial = rows[(K2, 3)]
    assert serial.TIMESTAMP == dt.date(2019, 2, 2) and serial.RENEWABLES == "ASHP"
    sheet_row = [r for (k, s), r in rows.items() if k == K2 and s > 100][0]
    assert sheet_row.TIMESTAMP == dt.date(2018, 1, 1) and sheet_row.RENEWABLES == "SOLAR_PV"


def test_feed2_cleaning(e1_wide):
    f2 = {r.seq: r for r in e1_wide[1].collect()}
    assert set(f2) == {1, 3, 4}
    assert f2[1].WALL_CONSTRUCTION_NAME == "Cavity Wall Filled" and f2[1].POST_SAP_SCORE == 70.0
    assert f2[4].TIMESTAMP == dt.date(2015, 1, 1) and f2[4].YEAR == "2008"
    assert f2[3].RENEWABLES == "ASHP" and f2[3].FLOOR_INSULATION == "Floor Insulation (Unknown Floor Type)"


def test_resolution(e1_wide):
    wide = {r.UPRN: r for r in e1_wide[2].collect()}
    r1 = wide[K1]
    assert r1.PROPERTY_TYPE_NAME == "Detached House"
    assert r1.TENURE_NAME == "Privately Rented"  # newest (2020-06-05, feed 1)
    assert r1.SAP_SCORE == 70.0 and r1.SAP_FUEL_BILL == 900.0  # latest non-missing of post/pre
    assert r1.WALL_CONSTRUCTION_NAME == "Cavity Wall Filled"
    assert r1.MAIN_HEATING_FUEL_NAME == "Gas" and r1.TIMESTAMP_FUEL_TYPE == dt.date(2000, 1, 1)  # capped
    assert r1.SOLAR_PV == "Yes" and r1.RENEWABLE_COUNT == 1
    r6 = wide[K6]
    assert r6.TENURE_NAME == "Owner Occupied" and r6.SOURCE_PROPERTY_TENURE == e1.SOURCE_WAREHOUSE  # tie -> warehouse
    assert r6.RIR_INS == "Room in Roof Insulation" and r6.FLAT_ROOF_INS == "Flat Roof Insulation"


def test_master(e1_wide):
    master = E1.master(e1_wide[2])
    assert master.columns == e1.MASTER_COLUMNS + ["DATA_COUNT"]
    rows = {r.UPRN: r for r in master.collect()}
    assert len(rows) == master.count()  # one row per key
    assert all(1 <= r.DATA_COUNT <= 18 for r in rows.values() if r.UPRN != K3)
    assert rows[K1].SAP_SCORE == "70" and rows[K5].RENEWABLE_COUNT == "1" and rows[K6].RENEWABLE_COUNT == ""
    ts = E1.timestamped_master(e1_wide[2])
    assert ts.columns == E1.timestamped_columns() and len(ts.columns) == 1 + 13 * 3 + 16
    assert ts.columns[:4] == ["UPRN", "TIMESTAMP_PROPERTY_TYPE", "PROPERTY_TYPE_NAME", "SOURCE_PROPERTY_TYPE"]
    assert ts.columns[25:31] == ["TIMESTAMP_SAP_SCORE", "SOURCE_SAP_SCORE", "SAP_SCORE", "TIMESTAMP_SAP_FUEL_BILL", "SOURCE_SAP_FUEL_BILL", "SAP_FUEL_BILL"]
    stamped = {r.UPRN: r for r in ts.collect()}
    assert stamped[K1].SAP_SCORE == "70" and stamped[K6].RENEWABLE_COUNT is None and stamped[K6].SOLAR_PV is None
    table = E1.attribute_table(e1_wide[2], "PROPERTY_TENURE")
    assert table.columns == ["UPRN", "TIMESTAMP", "TENURE_NAME", "SOURCE"]


def test_region_filter_drops_other_regions(e1_wide):
    wide = {r.UPRN: r for r in e1_wide[2].collect()}
    assert K3 not in wide  # its home is outside the region and its feed row has no constituency


# ---------------------------------------------------------------------------
# Annual measures
# ---------------------------------------------------------------------------

CLAIM_COLS = list(e2.CLAIM_COLUMNS)


def _claim(**kv):
    base = {c: None for c in CLAIM_COLS}
    base.update({"Duplicate address check": kv.pop("dup", "d"), "Postcode": "BT1 1AA", "House type": "Detached",
                 "Tenure": "Owner", "Year built": "1950", "No. bedrooms": "3",
                 "Wall Insulation Category": "Cavity", "Wall insulation type": "Full",
                 "Predominant LI - depth": "Loft Insulation 100-300mm", "Fuel type before install": "Oil",
                 "New fuel type installed": "Gas", "New heating type installed": "Combi boiler",
                 "Total cost H.W.T. J (£)": "10", "Scheme Name": "S", "House number": "12",
                 "Address 1": "HIGH-STREET , ,", "Address 3": "N/A town"})
    base.update(kv)
    return base


@pytest.fixture(scope="module")
def claims(spark):
    rows = [
        _claim(dup="a"),
        _claim(dup="b", Remove="x"),
        _claim(dup="c", Postcode=None),             # blank singleton -> quarantine
        _claim(dup="d", Postcode=" "), _claim(dup="d", Postcode="BT9 9ZZ"),  # blank duplicate -> dropped
        _claim(dup="e", Postcode="BT2 2BB", **{"Year built": "1980", "Total cost water widget (£)": "-1"}),
    ]
    df = spark.createDataFrame([tuple(r[c] for c in CLAIM_COLS) for r in rows],
                               ", ".join(f"`{c}` string" for c in CLAIM_COLS))
    return E2.land_claims(df)


@pytest.fixture(scope="module")
def geo_inputs(spark):
    directory = spark.createDataFrame([("BT1 1AA", "N09000003", "P1"), ("BT2 2BB", "N09000099", "P2"),
                                       ("SW1 1AA", "E09000001", "P9")], "pcds string, lad25cd string, pcon24cd string")
    names = spark.createDataFrame([("P1", "Belfast East", 1), ("P1", "dup", 2), ("P2", "Strangford", 3)],
                                  "PCON24CD string, PCON24NM string, seq long")
    return E2.postcode_geography(directory), names


def test_claims_clean_and_gate(claims):
    cleaned, quarantined, offenders = E2.clean_claims(claims, dt.date(2025, 4, 1))
    assert cleaned.count() == 3 and quarantined.count() == 1 and offenders.count() == 0
    r = cleaned.where("duplicate_address = 'a'").first()
    assert (r.PROPERTY_TYPE, r.PROPERTY_AGE, r.WALL_INS, r.FY) == (
        "Detached House / Bungalow", "Built 1950-1966", "Cavity Wall Insulation (Pre-1976)", "FY2425")


def test_gate_fires_on_planted_error(claims):
    bad = claims.withColumn("house_type", F.when(F.col("duplicate_address") == "a", "Terrace")
                            .otherwise(F.col("house_type")))
    with pytest.raises(GateError) as err:
        E2.clean_claims(bad, dt.date(2025, 4, 1))
    assert err.value.counts == {"PROPERTY_TYPE": 1}
    clean, _, offenders = E2.clean_claims(bad, dt.date(2025, 4, 1), strict=False)
    assert offenders.count() == 1 and clean.where("PROPERTY_TYPE = 'ERROR'").count() == 0 and clean.count() == 2


def test_measures_and_extracts(spark, claims, geo_inputs):
    geo, names = geo_inputs
    cleaned, _, _ = E2.clean_claims(claims, dt.date(2025, 4, 1))
    rows = E2.explode_claim_measures(cleaned, geo, names)
    groups = {r.MEASURE_GROUP for r in rows.collect()}
    assert "Unknown" not in groups and "ERROR" not in groups
    assert rows.where("MEASURE = 'Hot Water Tank Insulation'").count() == 3
    clean, bad_geo = E2.geography_gate(rows, strict=False)
    assert clean.where("LAUA_NAME IS NULL OR LAUA_NAME = 'Unknown'").count() == 0 and clean.count() + bad_geo.count() == rows.count()
    assert bad_geo.where("LAUA_NAME = 'Unknown'").count() > 0  # district code without a name
    with pytest.raises(GateError):
        E2.geography_gate(rows, strict=True)
    belfast = rows.where("Postcode = 'BT1 1AA'").first()
    assert belfast.LAUA_NAME == "Belfast" and belfast.PCON_NAME == "Belfast East"  # the first landed row
    annual = E2.annual_extract(rows)
    assert annual.columns == e2.ANNUAL_COLUMNS
    dept = E2.department_extract(rows)
    assert dept.columns == e2.MASTER_COLUMNS
    r = dept.where("POSTCODE = 'BT1 1AA'").first()
    assert r.TOWN == "" and r.SUB_BUILDING == "" and r.COUNTY == ""



def test_refresh_master_and_history(spark, claims, geo_inputs):
    geo, names = geo_inputs
    cleaned, _, _ = E2.clean_claims(claims, dt.date(2025, 4, 1))
    new = E2.department_extract(E2.explode_claim_measures(cleaned, geo, names))
    prev_row = {c: None for c in e2.MASTER_COLUMNS}
    prev_row.update({"POSTCODE": "SW9 9XX", "LAUA_NAME": "Old District", "LAUA_CODE": "X1", "FY": "FY2324",
                     "STREET": "o'neill park"})
    prev_row2 = dict(prev_row, POSTCODE="BT2 2BB", LAUA_NAME="Ards", FY="FY2324")
    prev = spark.createDataFrame([tuple(r[c] for c in e2.MASTER_COLUMNS) for r in (prev_row, prev_row2)],
                                 ", ".join(f"{c} string" for c in e2.MASTER_COLUMNS))
    out = E2.refresh_master(prev, new, geo, names)
    assert out.count() == 2 + new.count()
    got = {r.POSTCODE: r for r in out.where("FY = 'FY2324'").collect()}
    assert got["SW9 9XX"].LAUA_NAME == "Old District"  # no lookup match: old value kept
    assert got["BT2 2BB"].LAUA_NAME == "Unknown"        # lookup says Unknown: Unknown wins
    assert got["SW9 9XX"].STREET == "O'neill Park"
    twice = E2.refresh_master(out, new, geo, names)
    assert twice.count() == out.count() + new.count()   # re-run appends again by default
    idem = E2.refresh_master(out, new, geo, names, replace_label=True)
    assert idem.count() == out.count()
    hist = spark.createDataFrame([("A", "B", "C", "D", "E", "F")],
                                 ", ".join(f"`{c}` string" for c in e2.HISTORY_COLUMNS))
    assert E2.append_history(hist, new).count() == 1 + new.count()


# ---------------------------------------------------------------------------
# Provenance extract
# ---------------------------------------------------------------------------

def test_provenance_extract(spark):
    master = spark.createDataFrame([(1, "Flat", 3, 0), (2, "House", 2, 1), (2, "House2", 2, 2), (3, "Flat", 1, 3)],
                                   "UPRN long, PROPERTY_TYPE_NAME string, DATA_COUNT int, seq long")
    ptype = spark.createDataFrame([(1, dt.date(2020, 1, 1), "A", 0), (1, dt.date(2010, 1, 1), "later row", 1), (1, None, "no date", 2),
                                   (2, None, "B", 3), (2, dt.date(2019, 1, 1), "C", 4)], "UPRN long, TIMESTAMP date, SOURCE string, seq long")
    ren = spark.createDataFrame([(1, dt.date(2021, 1, 1), "F1", None, "", 0)],
                                "UPRN long, ASHP_TIMESTAMP date, ASHP_SOURCE string, SOLAR_PV_TIMESTAMP date, "
                                "SOLAR_PV_SOURCE string, seq long")
    tables = {"PROPERTY_TYPE": ptype, **renewables_provenance(ren, ["ASHP", "SOLAR_PV"])}
    population = spark.createDataFrame([(1,), (2,)], "UPRN long")
    contract = ["UPRN", "PROPERTY_TYPE_NAME", "TIMESTAMP_PROPERTY_TYPE", "SOURCE_PROPERTY_TYPE",
                "TIMESTAMP_ASHP", "SOURCE_ASHP", "DATA_COUNT"]
    out = provenance_extract(master, tables, population, contract)
    assert out.columns == contract
    rows = {r.UPRN: r for r in out.collect()}
    assert set(rows) == {1, 2}                      # 3 is not in the population
    assert rows[2].PROPERTY_TYPE_NAME == "House"    # first row of a duplicated key
    assert rows[1].SOURCE_ASHP == "F1" and rows[2].SOURCE_ASHP is None
    assert rows[1].SOURCE_PROPERTY_TYPE == "A"      # first landed, not earliest date
    assert rows[2].SOURCE_PROPERTY_TYPE == "B" and rows[2].TIMESTAMP_PROPERTY_TYPE is None
    with pytest.raises(HeaderError):
        provenance_extract(master.drop("seq"), tables, population, contract)
    with pytest.raises(HeaderError):
        provenance_extract(master, {"PROPERTY_TYPE": ptype.drop("seq")}, population, contract)
    counts = joined_row_counts(master, tables, population, physical={"ASHP": "R", "SOLAR_PV": "R"}).first()
    # key 1: 1 x 3 rows, key 2: 2 x 2, key 3: outside
    assert tuple(counts) == (8, 1, 7, 7, 2)


# ---------------------------------------------------------------------------
# Runners: attribute resolution -> written tables -> provenance extract
# ---------------------------------------------------------------------------

def test_runners_end_to_end(spark, e1_inputs, scratch):
    from abode.plans import runs

    db, sheet, lookup, feed2, homes, dictionary, details, xref = e1_inputs
    inputs = dict(feed1_db=db, feed1_sheet=sheet, uprn_lookup=lookup, feed2_sheet=feed2, homes_fact=homes,
                  dictionary=dictionary, home_details=details, address_xref=xref)
    paths = runs.run_attribute_resolution(inputs, scratch)
    assert set(runs.ATTRIBUTE_FILES) <= set(paths) and "master" in paths
    dupes = {r.attr: int(r.n_duplicates) for r in spark.read.option("header", "true").csv(paths["duplicates"]).collect()}
    assert dupes["PROPERTY_TENURE"] >= 1  # K1 has several tenure observations
    assert "RENEWABLES" not in dupes and dupes["PROPERTY_TYPE"] == 0  # constants of the feeds are excluded before counting
    with pytest.raises(GateError):
        runs.run_attribute_resolution(inputs | {"previous_renewables": db}, f"{scratch}/drift")
    summary = spark.read.option("header", "true").csv(paths["data_count_summary"]).first()
    assert float(summary["min"]) >= 0 and float(summary["max"]) <= 18

    def load(name):
        stem = runs.ATTRIBUTE_FILES.get(name, runs.RENEWABLES_FILE)
        return (spark.read.option("header", "true").option("nullValue", "NA").option("escape", '"')
                .csv(f"{scratch}/{stem}").withColumn("UPRN", F.col("UPRN").cast("long")))

    table_list = spark.createDataFrame([(n,) for n in [*[v[1] for v in runs.PROVENANCE_VALUES[:10]], "RENEWABLES"]],
                                       "SQL_TABLES string")
    tables = runs.load_listed_tables(spark, table_list, load)
    master = (spark.read.option("header", "true").option("sep", "\t").csv(paths["master"])
              .withColumn("UPRN", F.col("UPRN").cast("long")))
    population = spark.createDataFrame([(K1,), (K2,), (K6,)], "UPRN long")
    path, report = runs.run_provenance_extract(master, tables, population, scratch, dt.date(2025, 4, 1))
    out = spark.read.option("header", "true").csv(path)
    assert out.columns == runs.PROVENANCE_CONTRACT and len(out.columns) == 47
    assert report["rows_before"] == report["rows_not_in_population"] + report["rows_in_population"]
    assert report["rows_after_dedup"] == out.count() == 3
    row = out.where(F.col("UPRN") == str(K6)).first()
    assert row.SOURCE_PROPERTY_TENURE == e1.SOURCE_WAREHOUSE and row.TIMESTAMP_PROPERTY_TENURE == "2014-06-05"


def test_annual_runner(spark, claims, geo_inputs, scratch):
    from abode.operators.sinks import current_versions
    from abode.plans import runs

    geo_dir = spark.createDataFrame([("BT1 1AA", "N09000003", "P1"), ("BT2 2BB", "N09000004", "P2"),
                                     ("BT9 9ZZ", "N09000005", "P2")],
                                    "pcds string, lad25cd string, pcon24cd string")
    _, names = geo_inputs
    prev = spark.createDataFrame([], ", ".join(f"{c} string" for c in e2.MASTER_COLUMNS))
    hist = spark.createDataFrame([], ", ".join(f"`{c}` string" for c in e2.HISTORY_COLUMNS))
    raw = claims.select(*[F.col(v).alias(k) for k, v in e2.CLAIM_COLUMNS.items()])
    run = lambda raw, **kv: runs.run_annual_measures(raw, geo_dir, names, prev, hist, scratch, dt.date(2025, 4, 1), **kv)
    read = lambda path: spark.read.option("header", "true").option("escape", '"').csv(path)
    paths = run(raw)
    master = spark.read.parquet(paths["master"])
    assert master.count() > 0 and master.columns == e2.MASTER_COLUMNS
    assert read(paths["annual"]).count() == master.count() == read(paths["master_report"]).count()
    assert read(paths["history_report"]).columns == list(e2.HISTORY_COLUMNS)
    assert spark.read.parquet(paths["cleaned"]).count() == 3 and read(paths["category_profile"]).count() > 0
    assert {r.value for r in read(paths["unseen_measures"]).collect()} == {r.MEASURE for r in master.collect()}
    assert current_versions(spark, scratch) == {"measures_master": paths["master"], "measures_history": paths["history"]}

    # a strict run with an offender writes it and publishes nothing; a lenient one goes on without it
    bad = raw.withColumn("House type", F.when(F.col("Duplicate address check") == "a", "Terrace").otherwise(F.col("House type")))
    with pytest.raises(GateError):
        run(bad)
    assert current_versions(spark, scratch)["measures_master"] == paths["master"]
    lenient = run(bad, strict=False)
    assert read(lenient["offenders_claims"]).count() == 1
    assert spark.read.parquet(lenient["cleaned"]).count() == 2
    for name in ("master", "history"):
        assert not any("ERROR" in map(str, r) for r in spark.read.parquet(lenient[name]).collect())
    # the same run again publishes anew, and earlier versions stay
    again = run(raw)
    assert again["master"] != paths["master"] and spark.read.parquet(paths["master"]).count() == spark.read.parquet(again["master"]).count()


def test_annual_update(spark, claims, geo_inputs, scratch):
    """The masters published in parts hold what the whole runner publishes, and so do the reports."""
    from abode.operators import sinks as S
    from abode.plans import runs

    geo_dir = spark.createDataFrame([("BT1 1AA", "N09000003", "P1"), ("BT2 2BB", "N09000004", "P2"),
                                     ("BT9 9ZZ", "N09000005", "P2")],
                                    "pcds string, lad25cd string, pcon24cd string")
    _, names = geo_inputs
    cells = {c: None for c in e2.MASTER_COLUMNS}
    rows = [cells | {"FY": "FY2021", "POSTCODE": "ZZ9 9ZZ", "STREET": "Far Road"},
            cells | {"FY": "FY2122", "POSTCODE": "BT2 2BB", "LAUA_NAME": "Ards", "STREET": "near road ,"}]
    prev = spark.createDataFrame([tuple(r[c] for c in e2.MASTER_COLUMNS) for r in rows], ", ".join(f"{c} string" for c in e2.MASTER_COLUMNS))
    hist = spark.createDataFrame([("A", "B", "C", "D", "E", "F")], ", ".join(f"`{c}` string" for c in e2.HISTORY_COLUMNS))
    raw = claims.select(*[F.col(v).alias(k) for k, v in e2.CLAIM_COLUMNS.items()])
    day = dt.date(2025, 4, 1)
    whole = runs.run_annual_measures(raw, geo_dir, names, prev, hist, f"{scratch}/whole", day)
    runs.import_masters(prev, hist, f"{scratch}/parts", day)
    paths = runs.run_annual_update(raw, geo_dir, names, f"{scratch}/parts", day)
    reports = runs.write_reports(spark, f"{scratch}/parts", day)
    text = lambda df: sorted(map(str, df.collect()))
    read = lambda path: spark.read.option("header", "true").option("escape", '"').csv(path)
    for name in ("master", "history"):
        assert text(S.read_published(spark, paths[name])) == text(spark.read.parquet(whole[name]))
        assert text(read(reports[f"{name}_report"])) == text(read(whole[f"{name}_report"]))
    assert paths["years"] == ["FY2122", sorted({r.FY for r in spark.read.parquet(whole["cleaned"]).collect()})[0]]
    assert text(read(paths["annual"])) == text(read(whole["annual"]))


def test_duplicates_come_with_the_write(spark, e1_inputs):
    """Observed numbers equal those of a separate count."""
    obs = E1.observations(E1.clean_feed1(*e1_inputs[:3]), E1.clean_feed2(e1_inputs[3]), None)
    obs = obs.union(obs.where("attr = 'PROPERTY_TENURE'"))
    counted, seen = E1.observe_duplicates(E1.resolve_attributes(obs, counts=True))
    assert counted.columns == E1.resolve_attributes(obs).columns
    kept = stage_table(counted, "counted")
    got = E1.observed_duplicates(spark, seen)
    assert sorted(got.collect()) == sorted(E1.duplicate_report(obs).collect()) and got.count() > 5
    assert sorted(map(str, kept.collect())) == sorted(map(str, E1.resolve_attributes(obs).collect()))
    empty, seen = E1.observe_duplicates(E1.resolve_attributes(obs.limit(0), counts=True))
    stage_table(empty, "counted")
    assert E1.observed_duplicates(spark, seen).count() == 0



def test_claims_invariants_on_driver_tables(spark):
    """Kept + blank-postcode rows = unmarked input; quarantine only holds singletons."""
    from abode.plans import catalogue_feeds as CF
    from abode.plans.catalogue import _split_select, table

    sf = "/root/testdata/sf0.001"
    claims = table(spark, sf, "orders").selectExpr(*_split_select(f"SELECT {CF._claims_select('spark')} FROM orders"))
    cleaned, quarantined, offenders = E2.clean_claims(claims, dt.date(2025, 4, 1), strict=False)
    unmarked = claims.where("remove_marker IS NULL")
    blank = unmarked.where("Postcode IS NULL OR Postcode IN ('', ' ')")
    assert cleaned.count() + offenders.count() + blank.count() == unmarked.count()
    assert quarantined.where("dupe_check <> 1").count() == 0 and quarantined.count() <= blank.count()
    some_error = " OR ".join(f"{c} = 'ERROR'" for c in e2.GATED_COLUMNS)
    assert cleaned.where(some_error).count() == 0 and offenders.where(f"NOT ({some_error})").count() == 0 < offenders.count()


def test_master_one_row_per_key_on_driver_tables(spark):
    import __spark_entry__ as entry

    master = entry.entry(spark)
    assert master.count() == master.select("UPRN").distinct().count()
    assert master.where("DATA_COUNT < 1 OR DATA_COUNT > 18").count() == 0


def test_numeric_attribute_table(e1_wide):
    t = E1.attribute_table(e1_wide[2], "SAP_SCORE")
    assert t.columns == ["UPRN", "TIMESTAMP", "SOURCE", "SAP_SCORE"]
    assert {r.UPRN: r.SAP_SCORE for r in t.collect()}[K1] == "70"


@pytest.mark.parametrize("raw,value,gated", [
    ("house_type", "Terrace", "PROPERTY_TYPE"),
    ("tenure_raw", "council", "TENURE"),
    ("year_built", "1600", "PROPERTY_AGE"),
    ("bedrooms_raw", "eleven", "BEDROOMS"),
    ("wall_category", "Loft", "WALL_INS"),
    ("wall_type", "mixed", "WALL_INS_FILL"),
    ("loft_depth", "Loft Insulation 0 - 270mm", "LOFT_INSULATION_NI"),
    ("loft_depth", "Loft Insulation 25-300mm", "LOFT_INSULATION"),
    ("fuel_before", "Foil", "MAIN_HEATING_FUEL"),
    ("fuel_after", "wood", "FS_FUEL_AFTER"),
    ("heating_after", "", "MAIN_HEATING_SYSTEM"),
])
def test_each_gate_fires_once(spark, claims, raw, value, gated):
    from abode.operators.quality import gate_counts

    planted = claims.withColumn(raw, F.when(F.col("duplicate_address") == "a", F.lit(value)).otherwise(F.col(raw)))
    cleaned, _, offenders = E2.clean_claims(planted, dt.date(2025, 4, 1), strict=False)
    assert sum(gate_counts(cleaned, e2.GATED_COLUMNS).first().asDict().values()) == 0
    counts = gate_counts(offenders, e2.GATED_COLUMNS).first().asDict()
    assert counts == {c: (1 if c == gated else 0) for c in e2.GATED_COLUMNS}


def test_gates_silent_without_planted_rows(spark, claims):
    from abode.operators.quality import gate_counts

    cleaned, _, offenders = E2.clean_claims(claims, dt.date(2025, 4, 1), strict=False)
    assert sum(gate_counts(cleaned, e2.GATED_COLUMNS).first().asDict().values()) == 0
    assert offenders.count() == 0


def test_command_line_attributes(spark, e1_inputs, scratch):
    from abode.__main__ import main

    names = ["feed1_db", "feed1_sheet", "uprn_lookup", "feed2_sheet", "homes_fact", "dictionary",
             "home_details", "address_xref"]
    args = ["attributes", "--out", f"{scratch}/out"]
    for name, df in zip(names, e1_inputs):
        path = f"{scratch}/in/{name}"
        if name in ("feed1_sheet", "feed2_sheet"):  # worksheets land as all-text CSV
            df.write.option("header", "true").csv(path)
            args += ["--input", f"{name}=csv:{path}"]
        else:
            df.write.parquet(path)
            args += ["--input", f"{name}={path}"]
    result = main(args, spark=spark)
    master = spark.read.option("header", "true").option("sep", "\t").csv(result["master"])
    assert "DATA_COUNT" in master.columns
    # same master as the in-memory run (text seq ordered numerically)
    expected = E1.master(E1.resolve_attributes(E1.observations(
        E1.clean_feed1(*e1_inputs[:3]), E1.clean_feed2(e1_inputs[3]),
        warehouse_observations(*e1_inputs[4:], [(n, c, r) for n, _o, c, r, _x, _p in e1.ATTRIBUTES if c],
                               e1.WAREHOUSE_REGION))))
    assert sorted(tuple(v or "" for v in r) for r in master.collect()) == sorted(
        tuple(str(v) for v in r) for r in expected.collect())  # empty TSV fields read back as NULL


def test_feeds_need_their_declared_columns(e1_inputs):
    db, sheet, lookup, feed2 = e1_inputs[:4]
    for args in ((db.drop("seq"), sheet, lookup), (db, sheet.drop("seq"), lookup), (db, sheet.drop("FYEAR"), lookup)):
        with pytest.raises(HeaderError):
            E1.clean_feed1(*args)
    for column in ("seq", "Solar PV", "Tenure", "Base Cost (EPCDATA::FuelCost)"):
        with pytest.raises(HeaderError):
            E1.clean_feed2(feed2.drop(column))


def test_number_text(spark):
    values = [65.0, 0.5, 12345678.25, 0.0001, -3.0, 1e15, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert [r[0] for r in df.select(E1._number_text("x")).collect()] == ["65", "0.5", "12345678.25", "0.0001", "-3", "1000000000000000", None]
