"""Programme runners: read inputs, run a whole programme, write its outputs.

Each runner cuts lineage at the natural checkpoints of its programme
(``staging`` under ``spark.checkpoint.dir``), so that every output is a cheap
projection of one materialised frame and a lost executor never forces a
recompute from the raw feeds. What a run staged goes when it ends.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from abode.functions import text as X
from abode.functions.dates import fiscal_label
from abode.operators import columns as P
from abode.operators import quality as Q
from abode.operators import sinks as S
from abode.plans import attributes as E1
from abode.plans import measures as E2
from abode.plans.provenance import joined_row_counts, provenance_extract, renewables_provenance
from abode.rules import e1, e2
from abode.session import staging
from abode.sources.warehouse import warehouse_observations

# Output folder stems of the attribute tables, keyed by attribute.
ATTRIBUTE_FILES = {name: f"attr_{name.lower()}" for name, *_ in e1.ATTRIBUTES}
RENEWABLES_FILE = "attr_renewables"
#: Technologies that the renewables table contributes to the provenance extract.
RENEWABLES_PARTS = ["BATTERY", "SOLAR_PV", "SOLAR_THERMAL", "BIO_BOILER", "ASHP"]

# The 47-column provenance extract contract.
PROVENANCE_VALUES = [
    ("PROPERTY_TYPE_NAME", "PROPERTY_TYPE"), ("TENURE_NAME", "PROPERTY_TENURE"),
    ("PROPERTY_AGE_NAME", "PROPERTY_AGE"), ("LOFT_INSULATION_NAME", "LOFT_INSULATION"),
    ("WALL_CONSTRUCTION_NAME", "WALL_CONSTRUCTION"), ("MAIN_HEATING_FUEL_NAME", "FUEL_TYPE"),
    ("MAIN_HEATING_SYSTEM_NAME", "HEATING_SYSTEM"), ("GLAZING_TYPE_NAME", "GLAZ_TYPE"),
    ("SAP_SCORE", "SAP_SCORE"), ("SAP_FUEL_BILL", "SAP_FUEL_BILL"),
    ("BATTERY", "BATTERY"), ("SOLAR_PV", "SOLAR_PV"), ("SOLAR_THERMAL", "SOLAR_THERMAL"),
    ("ASHP", "ASHP"), ("BIO_BOILER", "BIO_BOILER"),
]
PROVENANCE_CONTRACT = ["UPRN"] + [c for value, suffix in PROVENANCE_VALUES
                                  for c in (value, f"TIMESTAMP_{suffix}", f"SOURCE_{suffix}")] + ["DATA_COUNT"]


def run_attribute_resolution(inputs: dict[str, DataFrame], out_root: str) -> dict[str, str]:
    """Feeds + warehouse -> 13 attribute CSVs, renewables CSV, two masters (TSV), reports.

    ``inputs`` keys: feed1_db, feed1_sheet, uprn_lookup, feed2_sheet, homes_fact,
    dictionary, home_details, address_xref, and optionally previous_renewables,
    whose columns the new renewables table must not exceed.
    """
    spark = inputs["feed1_db"].sparkSession
    root = out_root.rstrip("/")
    with staging(spark) as stage:
        f1 = E1.clean_feed1(inputs["feed1_db"], inputs["feed1_sheet"], inputs["uprn_lookup"])
        f2 = E1.clean_feed2(inputs["feed2_sheet"])
        attrs = [(name, code, rule) for name, _o, code, rule, _x, _p in e1.ATTRIBUTES if code]
        wh = warehouse_observations(inputs["homes_fact"], inputs["dictionary"], inputs["home_details"],
                                    inputs["address_xref"], attrs, e1.WAREHOUSE_REGION,
                                    e1.WAREHOUSE_CONSTANT_DATE, e1.WAREHOUSE_CAP_YEAR, e1.WAREHOUSE_CAP_DATE,
                                    e1.SOURCE_WAREHOUSE)
        obs = stage(E1.observations(f1, f2, wh), "observations")
        counted, seen = E1.observe_duplicates(E1.resolve_attributes(obs, counts=True))
        wide = stage(counted, "attribute-wide")
        renewables, master = E1.renewables_table(wide), stage(E1.master(wide), "property-master")
        if "previous_renewables" in inputs:
            Q.check_columns(renewables, inputs["previous_renewables"].columns)
        Q.assert_unique(master, "UPRN")
        reports = {
            "duplicates": (E1.observed_duplicates(spark, seen), "duplicate_report"),
            "observed_categories": (Q.frequency_by(obs, "attr", "value"), "observed_categories"),
            "category_profile": (Q.frequency(master, [c for c in e1.MASTER_COLUMNS if c != "UPRN"]), "category_profile"),
            "data_count_summary": (Q.five_number(master, "DATA_COUNT", exact=True), "data_count_summary"),
            "data_count_frequency": (Q.frequency(master, ["DATA_COUNT"]), "data_count_frequency"),
            "RENEWABLES": (renewables, RENEWABLES_FILE),
            **{name: (E1.attribute_table(wide, name), stem) for name, stem in ATTRIBUTE_FILES.items()},
        }
        paths = {name: S.write_attribute_csv(df, f"{root}/{stem}") for name, (df, stem) in reports.items()}
        paths["master"] = S.write_tsv(master, f"{root}/property_master")
        paths["master_timestamped"] = S.write_tsv(E1.timestamped_master(wide), f"{root}/property_master_timestamped")
    return paths


def run_attribute_update(obs: DataFrame, out_root: str, as_of: _dt.date) -> dict[str, str]:
    """Observations of new feeds -> new versions of the resolve state and of the wide master.

    The state published last is read and merged, so earlier feeds are not read again. Another
    update that was published meanwhile makes this one fail (``PublishConflict``), and it can be repeated.
    """
    spark, number = obs.sparkSession, S.publication_number(obs.sparkSession, out_root)
    before = S.current_versions(spark, out_root).get("attribute_state")
    with staging(spark) as stage:
        state = stage(E1.attribute_state(obs, spark.read.parquet(before) if before else None), "attribute-state")
        return S.publish({"attribute_state": state, "attribute_wide": E1.resolve_attributes(state)}, out_root, as_of, expected=number)


def ordered(df: DataFrame, key: str = "UPRN") -> DataFrame:
    """``df`` with a landed order. One without ``seq`` must have unique keys: then any order is the same."""
    if "seq" in df.columns:
        return df.withColumn("seq", P.order_number("seq"))
    Q.assert_unique(df, key)
    return df.withColumn("seq", F.lit(0).cast("long"))


def load_listed_tables(spark: SparkSession, table_list: DataFrame | Sequence[str],
                       load: Callable[[str], DataFrame]) -> dict[str, DataFrame]:
    """Metadata-driven scan: one table per listed name (the list is small and
    bounded, so it is read to the driver; the tables themselves are not)."""
    names = table_list if not isinstance(table_list, DataFrame) else \
        [r[0] for r in table_list.select(table_list.columns[0]).collect()]
    tables: dict[str, DataFrame] = {}
    for name in names:
        t = ordered(load(name))
        if name == "RENEWABLES":
            tables.update(renewables_provenance(t, RENEWABLES_PARTS))
        else:
            tables[name] = t.select("UPRN", "TIMESTAMP", "SOURCE", "seq")
    return tables


def run_provenance_extract(master: DataFrame, tables: dict[str, DataFrame], population: DataFrame,
                           out_root: str, as_of: _dt.date) -> tuple[str, dict]:
    """47-column provenance CSV (dated) + row counts before and after each step."""
    master = ordered(master)
    with staging(master.sparkSession) as stage:
        extract = stage(provenance_extract(master, tables, population, PROVENANCE_CONTRACT), "provenance")
        path = S.write_quoted_csv(extract, S.dated_path(out_root, "provenance_extract", as_of))
    shared = {part: "RENEWABLES" for part in RENEWABLES_PARTS}
    return path, joined_row_counts(master, tables, population, physical=shared).first().asDict()


def _new_year(claims_raw: DataFrame, directory: DataFrame, pcon_lookup: DataFrame, known: DataFrame, root: str,
              as_of: _dt.date, strict: bool, stage: Callable[[DataFrame, str], DataFrame], paths: dict[str, str]) -> DataFrame:
    """The gated department extract of a year; all its other outputs are written and added to ``paths``."""
    spark, label = claims_raw.sparkSession, fiscal_label(as_of)

    def write(name: str, df: DataFrame, stem: str) -> None:
        paths[name] = S.write_attribute_csv(df, f"{root}/{stem}_FY-{label}")

    def stop_at(offenders: DataFrame, name: str) -> None:
        written = Observation(name)  # counted by the write itself
        write(name, offenders.observe(written, F.count(F.lit(1)).alias("rows")), name)
        bad = written.get["rows"]
        if strict and bad:
            raise Q.GateError(f"{bad} rows in {paths[name]}", {name: bad}, offenders)

    classified, quarantined = E2.classify_claims(E2.land_claims(claims_raw), as_of, stage)
    classified = stage(classified, f"claims-{label}")
    write("quarantine", quarantined, "quarantine")
    write("category_profile", Q.frequency(classified, e2.GATED_COLUMNS), "category_profile")
    cleaned, offenders = Q.gate(classified, e2.GATED_COLUMNS, strict=False)
    stop_at(offenders, "offenders_claims")
    paths["cleaned"] = f"{root}/cleaned_claims_FY-{label}"
    cleaned.write.mode("overwrite").parquet(paths["cleaned"])
    cleaned = spark.read.parquet(paths["cleaned"])

    geo = E2.postcode_geography(directory)
    measured = stage(E2.explode_claim_measures(cleaned, geo, pcon_lookup, stage=stage), f"measures-{label}")
    write("unseen_measures", Q.unseen_values(measured, "MEASURE", known), "unseen_measures")
    rows, bad_rows = E2.geography_gate(measured, strict=False)
    stop_at(bad_rows, "offenders_measures")

    paths["annual"] = S.write_quoted_csv(E2.annual_extract(rows), f"{root}/annual_measures_FY-{label}")
    return E2.department_extract(rows)


def _known_measures(master: DataFrame) -> DataFrame:
    return master.select("MEASURE").where("MEASURE IS NOT NULL").distinct()


def run_annual_measures(
    claims_raw: DataFrame, directory: DataFrame, pcon_lookup: DataFrame,
    previous_master: DataFrame, previous_history: DataFrame, out_root: str, as_of: _dt.date,
    strict: bool = True, replace_label: bool = False, encoding: str = "windows-1252",
) -> dict[str, str]:
    """Yearly claims -> cleaned Parquet, annual CSV, two report CSVs, new versions of both
    cumulative masters, profiles, quarantine and offenders.

    Offenders of every gate are written first; a strict run with offenders then
    stops, another goes on without those rows. ``encoding`` is that of the two
    reports. Returns the path of every output; those of the masters point to
    the published versions.
    """
    root, paths = out_root.rstrip("/"), {}
    with staging(claims_raw.sparkSession) as stage:
        new = _new_year(claims_raw, directory, pcon_lookup, _known_measures(previous_master), root, as_of, strict, stage, paths)
        geo = E2.postcode_geography(directory)
        master = E2.refresh_master(previous_master, new, geo, pcon_lookup, replace_label, stage)
        history = E2.append_history(previous_history, new)
        published = S.publish({"measures_master": master, "measures_history": history}, root, as_of)
        paths |= {"master": published["measures_master"], "history": published["measures_history"]}
        for name, df in (("master", master), ("history", history)):
            paths[f"{name}_report"] = S.write_quoted_csv(df, f"{root}/{name}_report_{as_of.year}", encoding=encoding)
    return paths


def import_masters(master: DataFrame, history: DataFrame, out_root: str, as_of: _dt.date) -> dict[str, S.Version]:
    """Publish both cumulative masters for ``run_annual_update``: the master in parts by FY label; the
    history, which has no label, as one part."""
    sortable = master.select(*e2.MASTER_COLUMNS, X.paste_na(*e2.SORT_KEY_COLUMNS).alias("_add"))
    return S.publish({"measures_master": S.Parts(sortable, "FY", ("POSTCODE", "_add"), e2.MASTER_COLUMNS),
                      "measures_history": S.Parts(history)}, out_root, as_of, expected=0)


def run_annual_update(
    claims_raw: DataFrame, directory: DataFrame, pcon_lookup: DataFrame, out_root: str, as_of: _dt.date,
    strict: bool = True, replace_label: bool = False,
) -> dict:
    """``run_annual_measures`` on the masters published in parts under ``out_root``.

    Writes the outputs of the year, then its part of both masters and the parts of those earlier years in
    which the refresh changes a row; ``refresh_published`` has the rest. ``write_reports`` writes the reports.
    """
    spark, root, paths = claims_raw.sparkSession, out_root.rstrip("/"), {}
    number, before = S.publication_number(spark, root), S.current_versions(spark, root)
    with staging(spark) as stage:
        known = _known_measures(S.read_published(spark, before["measures_master"]))
        new = _new_year(claims_raw, directory, pcon_lookup, known, root, as_of, strict, stage, paths)
        # Read by three plans: the changed years, the master and the history.
        new = stage(new, f"extract-{fiscal_label(as_of)}")
        published, paths["years"] = refresh_published(new, E2.postcode_geography(directory), pcon_lookup, root, as_of, replace_label, stage, number)
    return paths | {"master": published["measures_master"], "history": published["measures_history"]}


def refresh_published(new: DataFrame, geography: DataFrame, pcon_lookup: DataFrame, root: str, as_of: _dt.date, replace_label: bool,
                      stage: Callable[[DataFrame, str], DataFrame], expected: int | None = None) -> tuple[dict[str, S.Version], list[str | None]]:
    """Append a year to both published masters: (what is published now, the years that were written).

    Only changed years of the master are read whole and written; the folders of the others are
    published again. The history gets the new rows as one more folder of their year;
    ``replace_label`` puts them in place of that year's rows, imported ones excepted, which have no
    label. A publisher who was faster makes this one fail (``PublishConflict``), and it can be repeated.
    """
    spark = new.sparkSession
    number = S.publication_number(spark, root) if expected is None else expected
    before = dict(S.publications(spark, root))[number]
    years = E2.changed_years(S.read_published(spark, before["measures_master"]), new, geography, pcon_lookup)
    written = {S.part_label(y) for y in years}
    rows = E2.refreshed_rows(S.read_published(spark, before["measures_master"], years), new, geography, pcon_lookup, replace_label)
    master = S.Parts(stage(rows, "master"), "FY", ("POSTCODE", "_add"), e2.MASTER_COLUMNS,
                     {k: v for k, v in S.published_parts(before["measures_master"]).items() if k not in written})
    dropped = {S.part_label(r["FY"]) for r in new.select("FY").distinct().collect()} if replace_label else set()
    history = S.Parts(E2.history_columns(new, "FY"), "FY", (), list(e2.HISTORY_COLUMNS),
                      {k: v for k, v in S.published_parts(before["measures_history"]).items() if k not in dropped})
    return S.publish({"measures_master": master, "measures_history": history}, root, as_of, expected=number), years


def write_reports(spark: SparkSession, out_root: str, as_of: _dt.date, encoding: str = "windows-1252") -> dict[str, str]:
    """Both report CSVs of the masters published in parts; the master's rows by year, postcode and address."""
    root, now = out_root.rstrip("/"), S.current_versions(spark, out_root)
    master = S.read_published(spark, now["measures_master"])
    frames = {"master": E2.sort_master(master.withColumn("_add", X.paste_na(*e2.SORT_KEY_COLUMNS))),
              "history": S.read_published(spark, now["measures_history"])}
    return {f"{name}_report": S.write_quoted_csv(df, f"{root}/{name}_report_{as_of.year}", encoding=encoding) for name, df in frames.items()}
