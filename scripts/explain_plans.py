"""Print the physical plans of the headline queries over Parquet trip files.

    python scripts/explain_plans.py [sf_dir]              # raw plans
    python scripts/explain_plans.py [sf_dir] --markdown   # PLANS.md

The trip views are first written to Parquet below the session's checkpoint
folder (as the conversion job would), so the plans show what a query over
real trip files does: pruned ``ReadSchema``, ``PushedFilters``, exchanges,
broadcasts and limits.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

PICKUP = "tpep_pickup_datetime"

NOTES = {
    "Q1 hourly means": "Three pruned columns; the zero-coordinate test is pushed into the Parquet reader. Partial "
    "average per task, so the shuffle carries at most 25 rows per task (24 hours + null); the final sort is over "
    "those groups.",
    "Q2 longest trip, window": "Each task sorts its own rows and keeps one per vendor (partial `WindowGroupLimit`) "
    "before the shuffle, so a vendor holding a third of all trips still sends one row per task. Ties broken by "
    "minutes.",
    "Q2 longest trip": "The least of all per-vendor maxima is a scalar subquery (a hash aggregate); the second scan "
    "drops trips below it, first by a cheap bound of the distance. Equal distances combine in their tasks, and the largest "
    "distance of each vendor with its longest duration is a second small aggregate. Lazy, two scans, no sort, no join, same "
    "row as the window form.",
    "Q2 longest trip, SQL": "One SQL text: the maxima, the trips not below the least of them, and their join, ties kept. "
    "A sort-merge join of what is left: no broadcast from an estimate. The coordinate tests are pushed into the Parquet "
    "reader.",
    "Join back to the per-vendor maxima": "The same in the DataFrame API: few trips are left to shuffle and sort.",
    "Q3 same borough": "Trips are counted per (pickup id, drop-off id) first, so the lookup joins a few hundred "
    "counted pairs; the cross-role borough equality is a second join key. The trips cross the network only as "
    "per-task partial counts.",
    "Q3 same borough, lookup above the broadcast bound": "The same plan with sort-merge joins of the counted pairs.",
    "Q4 night trips": "Two pruned columns; the hour test cannot be pushed into Parquet (a function of the column), "
    "so it runs right after the scan. Partial count per vendor.",
    "Q4 night trips, converted table": "The stored pickup hour: the test reaches the Parquet reader, which skips the row "
    "groups of the day, as the files are clustered and sorted by the hour.",
    "Q5 top zone pairs": "Counted id pairs joined to the lookup for both roles, zone inequality as a join residual, "
    "then `TakeOrderedAndProject(10)`: a per-task top 10 and a 10-row merge, no global sort.",
    "Q6 revenue by borough": "Nine pruned columns, eight exact partial sums (integers in parts) per pickup id and task; the "
    "lookup joins at most one row per zone.",
    "Trip view (line items x orders x customers x suppliers)": "The only large shuffle in the project: line items "
    "and (order, customer nation) pairs are hash-partitioned by order key and sort-merge joined (`merge` hint: both "
    "sides grow with the data). Everything a line item decides alone is derived before that shuffle: the supplier "
    "nation replaces the supplier key and the two flag strings become the money columns they set, so each shuffled "
    "row is ~80 instead of ~96 bytes. Customers and suppliers are broadcast only because the size check proved them "
    "small; above the bound they become sort-merge joins too.",
}


def _trim(line: str) -> str:
    line = re.sub(r"#\d+L?", "", line.rstrip())
    line = re.sub(r", \[plan_id=\d+\]", "", line)
    line = re.sub(r"Location: InMemoryFileIndex\(1 paths\)\[[^\]]*\]?,? ?", "", line)
    line = re.sub(r"DataFilters: \[[^\]]*\]?,? ?", "", line)
    line = re.sub(r"\(6371\.0 \* \(ATAN2.*?\)\) AS haversine_km", "<haversine km> AS haversine_km", line)
    return line if len(line) <= 170 else line[:167] + "..."


def _explain(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("simple")
    return buf.getvalue()


def main() -> None:
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    markdown = "--markdown" in sys.argv
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    from farebox.functions.temporal import hour_name, with_stored_hour
    from farebox.operators.argmax import argmax_ties
    from farebox.plans import q1, q2
    from farebox.plans import zones as zq
    from farebox.session import local_session, scratch_path
    from farebox.sinks.writers import write_parquet
    from farebox.sources import tables

    spark = local_session("farebox-plans")
    spark.sparkContext.setLogLevel("ERROR")
    geo = spark.read.parquet(write_parquet(tables.geo_trips(spark, sf_dir), scratch_path(spark, "geo")))
    loc = spark.read.parquet(write_parquet(tables.loc_trips(spark, sf_dir), scratch_path(spark, "loc")))
    zones = spark.read.parquet(write_parquet(tables.zones(spark, sf_dir), scratch_path(spark, "zones"), files=1))

    hours = spark.read.parquet(write_parquet(with_stored_hour(geo, PICKUP), scratch_path(spark, "hours"), cluster=hour_name(PICKUP)))

    def big_lookup_q3():
        spark.conf.set("farebox.broadcast.maxRows", "1")
        try:
            return zq.same_borough(loc, zones)
        finally:
            spark.conf.unset("farebox.broadcast.maxRows")

    cases = {
        "Q1 hourly means": lambda: q1.hourly_avg(geo),
        "Q2 longest trip, window": lambda: q2.longest_window(geo),
        "Q2 longest trip": lambda: q2.longest(geo),
        "Q2 longest trip, SQL": lambda: q2.longest_sql(spark, geo),
        "Join back to the per-vendor maxima": lambda: argmax_ties(q2.with_distance(geo), "VendorID", "haversine_km",
                                                                  q2.OUTPUT, method="join"),
        "Q3 same borough": lambda: zq.same_borough(loc, zones),
        "Q3 same borough, lookup above the broadcast bound": big_lookup_q3,
        "Q4 night trips": lambda: zq.night_trips_sql(spark, geo),
        "Q4 night trips, converted table": lambda: zq.night_trips_sql(spark, hours),
        "Q5 top zone pairs": lambda: zq.top_zone_pairs(loc, zones),
        "Q6 revenue by borough": lambda: zq.revenue_by_borough(loc, zones),
        "Trip view (line items x orders x customers x suppliers)": lambda: tables.loc_trips(spark, sf_dir),
    }
    if not markdown:
        for title, build in cases.items():
            print(f"===== {title}")
            print(_explain(build()))
        spark.stop()
        return
    out = ["# Physical plans of the headline queries", "",
           f"Printed by `python scripts/explain_plans.py {sf_dir} --markdown` (trip views first written to Parquet, "
           "8 shuffle", "partitions). Expression ids, file locations and long expressions are trimmed. Read "
           "bottom-up.", ""]
    for title, build in cases.items():
        plan = [_trim(line) for line in _explain(build()).splitlines()
                if line.strip() and not line.startswith("== Physical")]
        out += [f"## {title}", "", NOTES[title], "", "```", *plan, "```", ""]
    spark.stop()
    print("\n".join(out))


if __name__ == "__main__":
    main()
