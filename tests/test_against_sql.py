"""Queries against their SQL on rows that the given sizes do not hold."""

import duckdb
import pytest

import __spark_entry__ as entry


def both(spark, folder, name, **tables):
    """Rows of the query and of its SQL over the tables, given as SQL text."""
    con = duckdb.connect()
    for t, sql in tables.items():
        con.execute(f"COPY ({sql}) TO '{folder}/{t}.parquet' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {t} AS FROM '{folder}/{t}.parquet'")
    got = entry.queries()[name](spark, str(folder))
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({entry.oracle_sql()[name]})").fetchall()
    return sorted(map(repr, (tuple(r) for r in got.collect()))), sorted(map(repr, want))


@pytest.mark.parametrize("name", ["D2_key_stars", "D2_weather_links"])
def test_wban_99999_of_an_isd_id_links_nothing(spark, tmp_path, name):
    got, want = both(spark, tmp_path, name, customer="SELECT range AS c_custkey FROM range(399900, 400100)")
    assert got == want and not any("isd:7299999" in r and "crn99999" in r for r in got)


def test_weather_links_of_sites_that_hold_several_keys_of_a_kind(spark, tmp_path):
    # station numbers are cut to five digits, so 400010 to 400019 are one station with 40001, with the airports of all
    rows = "SELECT range AS c_custkey FROM range(159960, 160060) UNION ALL SELECT range FROM range(1599960, 1600100) UNION ALL SELECT range FROM range(160000, 160010) UNION ALL SELECT NULL"
    got, want = both(spark, tmp_path, "D2_weather_links", customer=rows)
    assert got == want and any(r.count("same ICAO") > 1 for r in got) and any("GHCN" in r and "WBAN" in r and "ICAO" in r for r in got)


def test_pairs_of_weather_sites_are_not_shuffled(spark, tmp_path):
    duckdb.sql(f"COPY (SELECT range AS c_custkey FROM range(400)) TO '{tmp_path}/customer.parquet' (FORMAT parquet)")
    plan = entry.queries()["D2_weather_links"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    above, join, below = plan.partition("SortMergeJoin")
    assert join and "Exchange" in below and "Exchange" not in above and "Aggregate" not in above
